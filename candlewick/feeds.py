"""The driver's ``events`` table seen as a trade feed, and everything the engine reads derived from it.

symbol = event type and user group, price = value, quantity = ``props.k``. All derivations run over
the whole table; deliveries, envelopes and faults are chosen by attributes of the events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.operators.gold import rolling_volatility, top_movers, volume_1m
from candlewick.schemas import TABLES
from candlewick.sources.history import HISTORY_SOURCE

# Event types whose messages arrive in a stream envelope, and that also have live candles.
WRAPPED = ("view", "click")
LIVE_CANDLES = ("purchase", "view")
INTERVAL = "1h"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    quantity = F.get_json_object("props", "$.k").cast("double")
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.concat(F.upper("event_type"), F.lit("-"), (F.col("user_id") % 8).cast("string")).alias("symbol"),
        F.col("event_id").alias("trade_id"),
        F.col("value").alias("price"),
        quantity.alias("quantity"),
        F.col("ts").cast("timestamp").alias("trade_time"),
        F.col("event_type").alias("source"),
    )


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver-shaped trades, one per event."""
    rows = events(spark, sf_dir).withColumns(
        {
            "event_time": F.col("trade_time"),
            "ingested_at": F.col("trade_time"),
            "is_market_maker": F.lit(False),
            "notional": F.round(F.col("price") * F.col("quantity"), 8),
        }
    )
    return TABLES["silver.trades"].conform(rows)


def bronze_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text-typed deliveries: some first ones lack the price, low quantities are delivered twice.

    The second delivery is one second younger, arrives a minute later and corrects the price by +1.
    """
    base = events(spark, sf_dir).withColumn("event_type", F.lit("trade"))
    first = base.withColumns({"event_time": F.col("trade_time"), "ingested_at": F.col("trade_time")})
    lacking = F.col("quantity").isin(14.0, 99.0)
    first = first.withColumn("price", F.when(~lacking, F.col("price")))
    again = base.where(F.col("quantity") < 15).withColumns(
        {
            "price": F.col("price") + 1,
            "event_time": F.col("trade_time") + F.expr("INTERVAL 1 SECOND"),
            "ingested_at": F.col("trade_time") + F.expr("INTERVAL 60 SECONDS"),
        }
    )
    return TABLES["bronze.trades_live_raw"].conform(first.unionByName(again))


def candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver-shaped hourly candles built from all trades."""
    when = F.struct("trade_time", "trade_id")
    hourly = events(spark, sf_dir).groupBy("symbol", F.date_trunc("hour", "trade_time").alias("open_time")).agg(
        F.min_by("price", when).alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", when).alias("close"),
        F.sum("quantity").alias("volume"),
        F.count(F.lit(1)).cast("int").alias("trade_count"),
    )
    close_time = F.col("open_time") + F.expr("INTERVAL 3599 SECONDS")
    return TABLES["silver.klines_1m"].conform(
        hourly.withColumns(
            {
                "interval": F.lit(INTERVAL),
                "close_time": close_time,
                "is_closed": F.lit(True),
                "event_time": close_time,
                "ingested_at": close_time + F.expr("INTERVAL 60 SECONDS"),
                "source": F.lit(HISTORY_SOURCE),
            }
        )
    )


def bronze_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = candles(spark, sf_dir).withColumn("event_type", F.lit("kline_history"))
    return TABLES["bronze.klines_history_raw"].conform(rows)


def bronze_live_klines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live candles of some symbols: one update while open, then the closed one, a cent higher."""
    kind = F.lower(F.substring_index("symbol", "-", 1))
    base = candles(spark, sf_dir).where(kind.isin(*LIVE_CANDLES))
    base = base.withColumns({"event_type": F.lit("kline"), "source": F.lit("binance_live")})
    half = F.col("open_time") + F.expr("INTERVAL 30 MINUTES")
    running = base.withColumns(
        {"close": F.col("open"), "is_closed": F.lit(False), "event_time": half, "ingested_at": half}
    )
    closed = base.withColumns(
        {
            "close": F.col("close") + 0.01,
            "event_time": F.col("close_time") + F.expr("INTERVAL 1 SECOND"),
            "ingested_at": F.col("close_time") + F.expr("INTERVAL 61 SECONDS"),
        }
    )
    return TABLES["bronze.klines_live_raw"].conform(running.unionByName(closed))


def _millis(moment: Column) -> Column:
    return F.unix_millis(moment)


def trade_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One text message per event: bare or in an envelope; some ``error`` events are broken."""
    rows = events(spark, sf_dir)
    moment = _millis(F.col("trade_time"))
    head = [
        F.lit("trade").alias("e"), moment.alias("E"), F.col("symbol").alias("s"), F.col("trade_id").alias("t"),
    ]
    price = F.col("price").cast("string").alias("p")
    tail = [F.col("quantity").cast("string").alias("q"), moment.alias("T"), F.lit(False).alias("m")]
    body = F.to_json(F.struct(*head, price, *tail))
    broken = F.col("source") == "error"
    quantity = F.col("quantity")
    text = (
        F.when(broken & (quantity == 50), F.substring(body, 1, 20))
        .when(broken & (quantity == 51), F.to_json(F.struct(*head, *tail)))
        .when(broken & (quantity == 52), F.concat(F.lit("["), body, F.lit("]")))
        .when(broken & (quantity == 53), F.lit("connection lost"))
        .when(
            F.col("source").isin(*WRAPPED),
            F.concat(F.lit('{"stream":"'), F.col("symbol"), F.lit('@trade","data":'), body, F.lit("}")),
        )
        .otherwise(body)
    )
    return rows.select("trade_id", text.alias("raw_payload"))


def kline_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One enveloped text message per live candle update."""
    rows = bronze_live_klines(spark, sf_dir)
    fields = {
        "t": _millis(F.col("open_time")), "T": _millis(F.col("close_time")) + 999, "s": F.col("symbol"),
        "i": F.col("interval"), "o": F.col("open"), "c": F.col("close"), "h": F.col("high"), "l": F.col("low"),
        "v": F.col("volume"), "n": F.col("trade_count"), "x": F.col("is_closed"),
    }
    candle = F.struct(*[value.alias(key) for key, value in fields.items()])
    body = F.to_json(
        F.struct(
            F.lit("kline").alias("e"), _millis(F.col("event_time")).alias("E"), F.col("symbol").alias("s"),
            candle.alias("k"),
        )
    )
    stream = F.concat(F.lit('{"stream":"'), F.col("symbol"), F.lit('@kline","data":'), body, F.lit("}"))
    return rows.select(stream.alias("raw_payload"))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trade_messages(spark, sf_dir).select("raw_payload").unionByName(kline_messages(spark, sf_dir))


def gold_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return volume_1m(trades(spark, sf_dir))


def gold_volatility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rolling_volatility(candles(spark, sf_dir))


def gold_movers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_movers(candles(spark, sf_dir))
