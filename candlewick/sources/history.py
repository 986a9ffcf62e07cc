"""Candle history files: groups of positional candle arrays."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.functions.time import as_of_column, epoch_ms_to_second
from candlewick.schemas import TABLES

# Fixed values of the history format.
HISTORY_SOURCE = "binance_history"
REST_SOURCE = "binance_rest"
HISTORY_EVENT = "kline_history"
DEFAULT_INTERVAL = "1m"
MINIMUM_CELLS = 11
# A candle array read as text keeps its exact cells for ``raw_payload``.
GROUP_SCHEMA = "symbol string, interval string, source string, klines array<string>"
# Cell number of each candle value (fixed values).
CELLS = {
    "open_time": 0, "open": 1, "high": 2, "low": 3, "close": 4, "volume": 5,
    "close_time": 6, "quote_volume": 7, "trade_count": 8,
}


def listed(texts: DataFrame, column: str, *kept: str) -> DataFrame:
    """One row per element of the JSON lists in ``column``: ``element`` as JSON text.

    A text that is no readable list stays as one row, itself the element, with a ``fault``.
    """
    elements = F.from_json(column, "array<string>")
    as_rows = F.transform(elements, lambda e: F.struct(e.alias("element"), F.lit(None).cast("string").alias("fault")))
    whole = F.array(F.struct(F.col(column).alias("element"), F.lit("not a JSON list").alias("fault")))
    written = texts.where(F.trim(column) != "")
    return written.select(*kept, F.explode(F.when(elements.isNull(), whole).otherwise(as_rows)).alias("_row")).select(*kept, "_row.*")


def read_history_groups(spark: SparkSession, path: str, layout: str = "lines") -> DataFrame:
    """History groups from JSON files, with their text as ``raw_payload`` and a ``fault`` when unreadable.

    ``layout="lines"``: one group per line, so large files are split between tasks.
    ``layout="document"``: every file is one group or a list of groups and is read by one task.
    """
    texts = spark.read.text(path, wholetext=layout == "document").where(F.trim("value") != "")
    if layout == "document":
        whole = F.trim("value", F.lit(" \t\r\n"))
        list_text = F.when(whole.startswith("["), whole).otherwise(F.concat(F.lit("["), whole, F.lit("]")))
        groups = listed(texts.select(list_text.alias("value")), "value")
    else:
        groups = texts.select(F.col("value").alias("element"), F.lit(None).cast("string").alias("fault"))
    opened = groups.withColumn("group", F.from_json("element", GROUP_SCHEMA))
    return opened.select(
        "group.symbol",
        F.coalesce("group.interval", F.lit(DEFAULT_INTERVAL)).alias("interval"),
        F.coalesce("group.source", F.lit(HISTORY_SOURCE)).alias("source"),
        "group.klines",
        F.col("element").alias("raw_payload"),
        "fault",
    )


def read_rest_candles(spark: SparkSession, path: str, interval: str = DEFAULT_INTERVAL) -> DataFrame:
    """Landed snapshot responses (a bare list of candle arrays per line) under ``symbol=…`` folders."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    return lines.select(
        F.upper("symbol").alias("symbol"),
        F.lit(interval).alias("interval"),
        F.lit(REST_SOURCE).alias("source"),
        F.from_json("value", "array<string>").alias("klines"),
        F.col("value").alias("raw_payload"),
        F.lit(None).cast("string").alias("fault"),
    )


def explode_candles(groups: DataFrame) -> DataFrame:
    """One row per candle array, with a ``reason`` where it cannot be used.

    A group without a readable list of candles is one row, its text the payload.
    """
    fault = F.coalesce("fault", F.when(F.col("klines").isNull(), F.lit("no readable list of candles")))
    none = F.array(F.struct(F.col("raw_payload").alias("payload"), fault.alias("fault")))
    candles = F.transform("klines", lambda k: F.struct(k.alias("payload"), F.lit(None).cast("string").alias("fault")))
    rows = groups.select("symbol", "interval", "source", F.explode(F.when(fault.isNotNull(), none).otherwise(candles)).alias("_row"))
    rows = rows.select("symbol", "interval", "source", F.col("_row.payload").alias("raw_payload"), F.col("_row.fault").alias("_fault"))
    rows = rows.withColumn("cells", F.from_json("raw_payload", "array<string>"))
    reason = (
        F.when(F.col("_fault").isNotNull(), F.col("_fault"))
        .when(F.col("symbol").isNull(), F.lit("history group without symbol"))
        .when(F.col("cells").isNull(), F.lit("candle is not an array"))
        .when(F.size("cells") < MINIMUM_CELLS, F.lit("candle with fewer than 11 cells"))
        .when(_cell("open_time").try_cast("bigint").isNull(), F.lit("candle without open time"))
        .when(_cell("close_time").try_cast("bigint").isNull(), F.lit("candle without close time"))
    )
    return rows.withColumn("reason", reason).drop("_fault")


def _cell(name: str) -> Column:
    # ``get`` gives null past the end, where an index would fail.
    return F.get("cells", F.lit(CELLS[name]))


def project_candles(exploded: DataFrame, ingested_at: datetime | Column | None = None) -> DataFrame:
    """Usable candle arrays as ``bronze.klines_history_raw`` rows."""
    close_time = epoch_ms_to_second(_cell("close_time"))
    usable = exploded.where("reason IS NULL").select(
        "source",
        F.lit(HISTORY_EVENT).alias("event_type"),
        "symbol",
        "interval",
        epoch_ms_to_second(_cell("open_time")).alias("open_time"),
        close_time.alias("close_time"),
        *[_cell(name).alias(name) for name in ("open", "high", "low", "close", "volume", "quote_volume")],
        _cell("trade_count").try_cast("int").alias("trade_count"),
        F.lit(True).alias("is_closed"),
        close_time.alias("event_time"),
        as_of_column(ingested_at).alias("ingested_at"),
        "raw_payload",
    )
    return TABLES["bronze.klines_history_raw"].conform(usable)


def rejected_candles(exploded: DataFrame, ingested_at: datetime | Column | None = None) -> DataFrame:
    rejected = exploded.where("reason IS NOT NULL").select(
        "raw_payload",
        F.lit(HISTORY_EVENT).alias("payload_kind"),
        "reason",
        as_of_column(ingested_at).alias("ingested_at"),
    )
    return TABLES["bronze.quarantine"].conform(rejected)


def history_scan(
    spark: SparkSession, path: str, layout: str = "lines", ingested_at: datetime | Column | None = None
) -> DataFrame:
    return project_candles(explode_candles(read_history_groups(spark, path, layout)), ingested_at)


def rest_candles_scan(
    spark: SparkSession, path: str, interval: str = DEFAULT_INTERVAL, ingested_at: datetime | Column | None = None
) -> DataFrame:
    return project_candles(explode_candles(read_rest_candles(spark, path, interval)), ingested_at)
