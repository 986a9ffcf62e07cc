"""Landed live messages and trade snapshots."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.functions.time import as_of_column, epoch_ms_to_second
from candlewick.operators.payloads import LIVE_SOURCE, parse_market
from candlewick.schemas import TABLES
from candlewick.sources.history import REST_SOURCE, listed

# Fields of a trade in a snapshot response.
SNAPSHOT_TRADE = ("id", "price", "qty", "time", "isBuyerMaker")


def read_messages(spark: SparkSession, path: str, layout: str = "lines") -> DataFrame:
    """Messages as ``raw_payload`` text.

    ``layout="lines"``: one message per line, split between tasks. ``layout="document"``: every
    file holds one message or a list of them and is read by one task; a file that is not readable
    JSON stays as one message, which no parser takes.
    """
    if layout == "lines":
        return spark.read.text(path).select(F.col("value").alias("raw_payload"))
    whole = spark.read.text(path, wholetext=True).where(F.trim("value") != "")
    text = F.trim("value", F.lit(" \t\r\n"))
    list_text = F.when(text.startswith("["), text).otherwise(F.concat(F.lit("["), text, F.lit("]")))
    messages = F.from_json(list_text, "array<variant>")
    # A JSON null in the list is a message, too.
    told = F.transform(messages, lambda m: F.coalesce(F.to_json(m), F.lit("null")))
    return whole.select(F.explode(F.when(messages.isNull(), F.array("value")).otherwise(told)).alias("raw_payload"))


def live_scan(
    spark: SparkSession,
    path: str,
    layout: str = "lines",
    source: str = LIVE_SOURCE,
    ingested_at: datetime | Column | None = None,
) -> DataFrame:
    """Parsed messages: ``trade`` and ``kline`` structs plus the fault of unusable ones."""
    return parse_market(read_messages(spark, path, layout), source, ingested_at)


def read_rest_trades(spark: SparkSession, path: str) -> DataFrame:
    """Elements of landed trade snapshots (a list of trades per line) under ``symbol=…`` folders.

    ``trade`` is the element's JSON text; ``reason`` names the fault of a line that is no list and of an
    element that is no object.
    """
    responses = spark.read.text(path).select(F.upper("symbol").alias("symbol"), "value")
    trades = listed(responses, "value", "symbol").withColumnRenamed("element", "trade")
    is_object = F.coalesce(F.schema_of_variant(F.try_parse_json("trade")).startswith("OBJECT"), F.lit(False))
    reason = F.coalesce("fault", F.when(~is_object, F.lit("trade is not an object")))
    return trades.select("symbol", "trade", reason.alias("reason"))


def project_rest_trades(elements: DataFrame, ingested_at: datetime | Column | None = None) -> DataFrame:
    """Usable snapshot elements as ``bronze.trades_live_raw`` rows."""
    trades = elements.where("reason IS NULL").select("*", F.json_tuple("trade", *SNAPSHOT_TRADE).alias(*SNAPSHOT_TRADE))
    trade_time = epoch_ms_to_second(F.col("time"))
    return TABLES["bronze.trades_live_raw"].conform(
        trades.select(
            F.lit(REST_SOURCE).alias("source"),
            F.lit("trade").alias("event_type"),
            "symbol",
            F.col("id").try_cast("bigint").alias("trade_id"),
            "price",
            F.col("qty").alias("quantity"),
            trade_time.alias("trade_time"),
            trade_time.alias("event_time"),
            F.coalesce(F.col("isBuyerMaker").try_cast("boolean"), F.lit(False)).alias("is_market_maker"),
            as_of_column(ingested_at).alias("ingested_at"),
            # Variant text has its keys sorted.
            F.to_json(F.try_parse_json("trade")).alias("raw_payload"),
        )
    )


def rejected_rest_trades(elements: DataFrame, ingested_at: datetime | Column | None = None) -> DataFrame:
    rejected = elements.where("reason IS NOT NULL").select(
        F.coalesce("trade", F.lit("null")).alias("raw_payload"),
        F.lit("trade_snapshot").alias("payload_kind"),
        "reason",
        as_of_column(ingested_at).alias("ingested_at"),
    )
    return TABLES["bronze.quarantine"].conform(rejected)


def rest_trades_scan(spark: SparkSession, path: str, ingested_at: datetime | Column | None = None) -> DataFrame:
    return project_rest_trades(read_rest_trades(spark, path), ingested_at)
