"""Report bundles over whichever stored datasets exist."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame

from candlewick.operators import reports
from candlewick.schemas import SERVING_DATASETS
from candlewick.sinks.lake import Store


def optional_datasets(lake: Store) -> dict[str, DataFrame | None]:
    return {dataset: lake.optional(table) for dataset, table in SERVING_DATASETS.items()}


def _present(report: dict[str, DataFrame | None]) -> dict[str, DataFrame]:
    return {name: df for name, df in report.items() if df is not None}


def quality_audit_report(audit: DataFrame) -> dict[str, DataFrame]:
    return {
        "recent_runs": reports.quality_recent_runs(audit),
        "latest_failures": reports.quality_latest_failures(audit),
        "dataset_health": reports.quality_dataset_health(audit),
        "failed_datasets": reports.quality_failed_datasets(audit),
    }


def observability_report(
    datasets: dict[str, DataFrame | None], as_of: datetime | None = None
) -> dict[str, DataFrame]:
    """Freshness, market and quality sections; a section without its dataset is left out."""
    prices, volume, volatility, movers, audit, state = (datasets.get(d) for d in SERVING_DATASETS)
    return _present(
        {
            "freshness": reports.freshness_overview(datasets, as_of),
            "latest_prices": None if prices is None else reports.latest_prices(prices),
            "volume": None if volume is None else volume.orderBy(volume.window_start.desc(), "symbol"),
            "volatility": None if volatility is None else reports.volatility_history(volatility),
            "top_movers": None if movers is None else reports.movers_report(movers, limit=None),
            "quality_runs": None if audit is None else reports.quality_recent_runs(audit),
            "quality_status": None if audit is None else reports.quality_latest_status(audit),
            "processing_state": None if state is None else reports.processing_state_status(state, as_of),
        }
    )


def dashboard(
    datasets: dict[str, DataFrame | None],
    symbols: Sequence[str] | None = None,
    hours: int = 6,
    limit: int = 10,
    as_of: datetime | None = None,
) -> dict[str, DataFrame]:
    """The dashboard's datasets under its symbol, look-back and top-n choices."""
    prices, volume, volatility, movers, audit, state = (datasets.get(d) for d in SERVING_DATASETS)
    return _present(
        {
            "kpis": reports.dashboard_kpis(datasets, symbols, as_of),
            "freshness": reports.freshness_overview(datasets, as_of),
            "latest_prices": None if prices is None else reports.latest_prices(prices, symbols),
            "volume_trend": None if volume is None else reports.recent_volume(volume, symbols, hours, as_of),
            "latest_volatility": None if volatility is None else reports.latest_volatility(volatility, symbols, limit),
            "top_movers": None if movers is None else reports.movers_report(movers, symbols, limit),
            "quality_runs": None if audit is None else reports.quality_recent_runs(audit, with_environment=False),
            "quality_status": None if audit is None else reports.quality_latest_status(audit),
            "processing_state": None if state is None else reports.processing_state_status(state, as_of),
        }
    )
