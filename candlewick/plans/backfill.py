"""History files to bronze and, when asked, straight to silver."""

from __future__ import annotations

from datetime import datetime

from candlewick.operators.silver import NEWEST, silver_klines
from candlewick.sinks.lake import Store
from candlewick.sinks.workspace import new_folder
from candlewick.sources.history import explode_candles, project_candles, read_history_groups, rejected_candles


def backfill_history(
    lake: Store,
    path: str,
    layout: str = "lines",
    write_silver: bool = True,
    ingested_at: datetime | None = None,
    silver_mode: str = "merge",
) -> dict[str, str]:
    """Replace the bronze history with the files' candles; unusable input goes to quarantine.

    ``silver_mode="merge"`` merges the candles into silver by key and keeps newer stored ones, so live candles
    survive; ``overwrite`` replaces silver. The files are parsed once: candles and faults are written together
    and read back. A repeated backfill of the same files at the same ``ingested_at`` quarantines nothing twice.
    """
    if silver_mode not in ("merge", "overwrite"):
        raise ValueError(f"unknown silver mode: {silver_mode}")
    spark = lake.spark
    folder = new_folder(spark, "backfill")
    parsed = explode_candles(read_history_groups(spark, path, layout))
    parsed.write.parquet(folder)
    exploded = spark.read.schema(parsed.schema).parquet(folder)
    outcome = {"bronze.klines_history_raw": lake.overwrite("bronze.klines_history_raw", project_candles(exploded, ingested_at))}
    rejected = rejected_candles(exploded, ingested_at)
    stored = lake.optional("bronze.quarantine")
    if stored is not None:
        rejected = rejected.join(stored, ["raw_payload", "payload_kind", "reason", "ingested_at"], "left_anti")
    if not rejected.isEmpty():
        outcome["bronze.quarantine"] = lake.append("bronze.quarantine", rejected)
    if write_silver:
        candles = silver_klines(lake.read("bronze.klines_history_raw"))
        if silver_mode == "merge":
            outcome["silver.klines_1m"] = lake.upsert("silver.klines_1m", candles, newer_than=NEWEST)
        else:
            outcome["silver.klines_1m"] = lake.overwrite("silver.klines_1m", candles)
    return outcome
