"""The stored tables: columns, merge keys, event timestamp and storage partitioning."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

# Column lists are fixed values: names, order and types of the stored tables.
_BRONZE_TRADES = """
source string, event_type string, symbol string, trade_id bigint, price string, quantity string,
trade_time timestamp, event_time timestamp, buyer_order_id bigint, seller_order_id bigint,
is_market_maker boolean, ingested_at timestamp, raw_payload string
"""
_BRONZE_KLINES = """
source string, event_type string, symbol string, `interval` string, open_time timestamp,
close_time timestamp, open string, high string, low string, close string, volume string,
quote_volume string, trade_count int, is_closed boolean, event_time timestamp,
ingested_at timestamp, raw_payload string
"""
_SILVER_TRADES = """
symbol string, trade_id bigint, price double, quantity double, trade_time timestamp,
event_time timestamp, ingested_at timestamp, buyer_order_id bigint, seller_order_id bigint,
is_market_maker boolean, source string, notional double, raw_payload string
"""
_SILVER_KLINES = """
symbol string, `interval` string, open_time timestamp, close_time timestamp, open double,
high double, low double, close double, volume double, quote_volume double, trade_count int,
is_closed boolean, event_time timestamp, ingested_at timestamp, source string, raw_payload string
"""
_LATEST_PRICE = "symbol string, latest_price double, trade_time timestamp, source string"
_VOLUME_1M = """
symbol string, window_start timestamp, volume_1m double, notional_1m double, trade_count int
"""
_VOLATILITY_5M = """
symbol string, window_start timestamp, window_end timestamp, `interval` string,
observation_count int, volatility_5m double
"""
_TOP_MOVERS = """
symbol string, window_start timestamp, window_end timestamp, start_price double,
end_price double, move_pct double
"""
_QUALITY_RUNS = """
audit_run_id string, checked_at timestamp, environment string, job_name string, task_name string,
dataset_name string, layer string, table_name string, storage_path string, passed boolean,
row_count bigint, min_row_count bigint, violation_count int, violations_json string,
schema_passed boolean, null_checks_passed boolean, duplicate_check_passed boolean,
freshness_check_passed boolean, bounds_check_passed boolean, summary_json string
"""
_PROCESSING_STATE = """
state_key string, pipeline_name string, dataset_name string, source_layer string,
target_layer string, watermark_column string, last_processed_at timestamp, updated_at timestamp,
metadata_json string
"""
# Own tables: what pipelines have consumed, measures and keys by date, and the first and last close of each series.
_CONSUMED_FILES = """
pipeline_name string, dataset_name string, file string, row_count bigint, first_date date, last_date date,
newest_arrival timestamp, consumed_at timestamp
"""
_QUALITY_MEASURES = """
dataset_name string, measured_date date, measure string, total bigint, low double, high double, newest timestamp
"""
_QUALITY_KEYS = "dataset_name string, measured_at timestamp, one bigint, two bigint"
_SERIES_ENDS = """
symbol string, `interval` string, first_open_time timestamp, first_close double, last_open_time timestamp,
last_close_time timestamp, last_close double
"""
_QUARANTINE = "raw_payload string, payload_kind string, reason string, ingested_at timestamp"


@dataclass(frozen=True)
class Table:
    layer: str
    name: str
    ddl: str
    keys: tuple[str, ...] = ()
    timestamp: str | None = None
    # Timestamp column whose UTC date partitions the stored files; None keeps one directory.
    dated_by: str | None = None

    @property
    def full_name(self) -> str:
        return f"{self.layer}.{self.name}"

    @property
    def dataset(self) -> str:
        return f"{self.layer}_{self.name}"

    @property
    def columns(self) -> list[str]:
        return [name for name, _ in self.fields]

    @property
    def casts(self) -> dict[str, str]:
        """Types of the columns that are not text, for rows that arrive as text."""
        return {name: kind for name, kind in self.fields if kind != "string"}

    @property
    def fields(self) -> list[tuple[str, str]]:
        return [_split(part) for part in self.ddl.split(",")]

    @property
    def date_follows_key(self) -> bool:
        """True when a key can never move to another date partition."""
        return self.dated_by is None or self.dated_by in self.keys

    def empty(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([], self.ddl)

    def conform(self, df: DataFrame) -> DataFrame:
        """Project to the stored column order and types; absent columns become null."""
        present = set(df.columns)
        return df.selectExpr(
            *[
                f"CAST({f'`{name}`' if name in present else 'NULL'} AS {kind}) AS `{name}`"
                for name, kind in self.fields
            ]
        )


def _split(part: str) -> tuple[str, str]:
    name, kind = part.split()
    return name.strip("`"), kind


TABLES = {
    table.full_name: table
    for table in (
        Table("bronze", "trades_live_raw", _BRONZE_TRADES, ("symbol", "trade_id"), "event_time", "ingested_at"),
        Table("bronze", "klines_history_raw", _BRONZE_KLINES, ("symbol", "interval", "open_time"), "open_time", "ingested_at"),
        Table("bronze", "klines_live_raw", _BRONZE_KLINES, ("symbol", "interval", "open_time"), "event_time", "ingested_at"),
        Table("bronze", "quarantine", _QUARANTINE, (), "ingested_at", "ingested_at"),
        Table("silver", "trades", _SILVER_TRADES, ("symbol", "trade_id"), "trade_time", "trade_time"),
        Table("silver", "klines_1m", _SILVER_KLINES, ("symbol", "interval", "open_time"), "open_time", "open_time"),
        Table("gold", "latest_price", _LATEST_PRICE, ("symbol",), "trade_time"),
        Table("gold", "volume_1m", _VOLUME_1M, ("symbol", "window_start"), "window_start", "window_start"),
        Table("gold", "volatility_5m", _VOLATILITY_5M, ("symbol", "interval", "window_start"), "window_end", "window_start"),
        Table("gold", "top_movers", _TOP_MOVERS, ("symbol",), "window_end"),
        Table("gold", "series_ends", _SERIES_ENDS, ("symbol", "interval")),
        Table("audit", "quality_check_runs", _QUALITY_RUNS, ("audit_run_id", "dataset_name"), "checked_at"),
        Table("audit", "processing_state", _PROCESSING_STATE, ("state_key",), "updated_at"),
        Table("audit", "quality_measures", _QUALITY_MEASURES, ("dataset_name", "measured_date", "measure")),
        Table("audit", "quality_keys", _QUALITY_KEYS, ("dataset_name", "measured_at", "one", "two"), "measured_at", "measured_at"),
        Table("audit", "consumed_files", _CONSUMED_FILES, ("pipeline_name", "dataset_name", "file")),
    )
}

# The six datasets that dashboards read, in publishing order (fixed values).
SERVING_DATASETS = {
    "gold_latest_price": "gold.latest_price",
    "gold_volume_1m": "gold.volume_1m",
    "gold_volatility_5m": "gold.volatility_5m",
    "gold_top_movers": "gold.top_movers",
    "audit_quality_check_runs": "audit.quality_check_runs",
    "audit_processing_state": "audit.processing_state",
}


def dotted(*parts: str | None) -> str:
    """A catalog name of the parts that are given."""
    return ".".join(filter(None, parts))


def table_ddl(table: Table, catalog: str | None = None, file_format: str = "parquet") -> str:
    qualified = dotted(catalog, table.layer, table.name)
    columns = ", ".join(f"`{name}` {kind}" for name, kind in table.fields)
    return f"CREATE TABLE IF NOT EXISTS {qualified} ({columns}) USING {file_format}"


def create_tables(spark: SparkSession, catalog: str | None = None, file_format: str = "parquet") -> list[str]:
    """Create every schema and table that does not exist yet; return the table names."""
    for layer in dict.fromkeys(table.layer for table in TABLES.values()):
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {dotted(catalog, layer)}")
    for table in TABLES.values():
        spark.sql(table_ddl(table, catalog, file_format))
    return list(TABLES)


def table_schemas(spark: SparkSession) -> DataFrame:
    """One row per stored column, in storage order."""
    frames = [
        spark.createDataFrame(
            [
                (table.full_name, position, name, kind, name in table.keys)
                for position, (name, kind) in enumerate(table.fields)
            ],
            "table_name string, position int, column_name string, data_type string, is_key boolean",
        )
        for table in TABLES.values()
    ]
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result
