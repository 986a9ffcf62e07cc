"""Columns of the served datasets and of the report sections that queries and SQL compare."""

SERVED = {
    "gold_latest_price": (["symbol"], ["latest_price", "trade_time", "source"]),
    "gold_volume_1m": (["symbol", "window_start"], ["volume_1m", "notional_1m", "trade_count"]),
    "gold_volatility_5m": (["symbol"], ["window_start", "window_end", "interval", "observation_count", "volatility_5m"]),
    "gold_top_movers": (["symbol"], ["window_start", "window_end", "start_price", "end_price", "move_pct"]),
    "audit_quality_check_runs": (["audit_run_id", "dataset_name"], ["layer", "passed", "row_count", "violation_count"]),
    "audit_processing_state": (["state_key"], ["pipeline_name", "dataset_name", "last_processed_at", "metadata_json"]),
}

_RUNS = "audit_run_id checked_at environment job_name task_name dataset_count failed_dataset_count violation_count"
# Sections of the observability report.
SECTIONS = {
    "freshness": "dataset_name layer row_count distinct_symbol_count latest_timestamp timestamp_column age_minutes",
    "latest_prices": "symbol latest_price trade_time source",
    "volume": "symbol window_start volume_1m notional_1m trade_count",
    "volatility": "symbol window_start window_end volatility_5m",
    "top_movers": "symbol window_start window_end start_price end_price move_pct",
    "quality_runs": _RUNS,
    "quality_status": "checked_at dataset_name layer table_name passed row_count violation_count job_name task_name audit_run_id",
    "processing_state": "pipeline_name dataset_name source_layer target_layer watermark_column last_processed_at updated_at "
    "staleness_minutes metadata_json",
}
# Datasets of the dashboard.
DASHBOARD = {
    "kpis": "available_dataset_count worst_dataset_age_minutes freshest_dataset latest_price_symbol_count latest_trade_time "
    "failed_quality_dataset_count stale_watermark_count",
    "freshness": SECTIONS["freshness"],
    "latest_prices": SECTIONS["latest_prices"],
    "volume_trend": SECTIONS["volume"],
    "latest_volatility": "symbol window_start window_end interval observation_count volatility_5m",
    "top_movers": SECTIONS["top_movers"],
    "quality_runs": _RUNS.replace("environment ", ""),
    "quality_status": SECTIONS["quality_status"],
    "processing_state": SECTIONS["processing_state"],
}
TIMES = {
    "latest_timestamp", "trade_time", "window_start", "window_end", "checked_at", "last_processed_at", "updated_at", "latest_trade_time",
}
DOUBLES = {
    "age_minutes", "latest_price", "volume_1m", "notional_1m", "volatility_5m", "start_price", "end_price", "move_pct",
    "staleness_minutes", "worst_dataset_age_minutes",
}
