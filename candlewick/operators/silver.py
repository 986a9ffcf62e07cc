"""Bronze text rows to typed, deduplicated silver rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.functions.rows import newest_per_key
from candlewick.schemas import TABLES

# Fixed value: source name of records that carry none.
DEFAULT_SOURCE = "binance"
NEWEST = ("event_time", "ingested_at")


def tag_source(records: DataFrame, source: str) -> DataFrame:
    return records.withColumn("source", F.lit(source))


def trade_defaults(bronze: DataFrame) -> DataFrame:
    """Fill the optional trade fields from the required ones."""
    bronze = TABLES["bronze.trades_live_raw"].conform(bronze)
    return bronze.withColumns(
        {
            "event_time": F.coalesce("event_time", "trade_time"),
            "ingested_at": F.coalesce("ingested_at", "event_time", "trade_time"),
            "source": F.coalesce("source", F.lit(DEFAULT_SOURCE)),
            "is_market_maker": F.coalesce("is_market_maker", F.lit(False)),
        }
    )


def kline_defaults(bronze: DataFrame) -> DataFrame:
    """Fill the optional candle fields from the required ones."""
    bronze = TABLES["bronze.klines_live_raw"].conform(bronze)
    return bronze.withColumns(
        {
            "event_time": F.coalesce("event_time", "close_time"),
            "ingested_at": F.coalesce("ingested_at", "close_time"),
            "source": F.coalesce("source", F.lit(DEFAULT_SOURCE)),
            "trade_count": F.coalesce("trade_count", F.lit(0)),
            "is_closed": F.coalesce("is_closed", F.lit(True)),
        }
    )


def _typed(bronze: DataFrame, doubles: tuple[str, ...]) -> DataFrame:
    """Numbers arrive as text; unreadable ones become null instead of failing the job."""
    return bronze.withColumns({name: F.col(name).try_cast("double") for name in doubles})


def project_trades(bronze: DataFrame) -> DataFrame:
    typed = _typed(bronze, ("price", "quantity"))
    typed = typed.withColumn("notional", F.round(F.col("price") * F.col("quantity"), 8))
    return TABLES["silver.trades"].conform(typed).dropna(
        subset=["symbol", "trade_id", "price", "quantity", "trade_time"]
    )


def project_klines(bronze: DataFrame) -> DataFrame:
    typed = _typed(bronze, ("open", "high", "low", "close", "volume", "quote_volume"))
    return (
        TABLES["silver.klines_1m"]
        .conform(typed)
        .where(F.col("is_closed"))
        .dropna(subset=["symbol", "interval", "open_time", "close_time", "open", "high", "low", "close", "volume"])
    )


def silver_trades(bronze: DataFrame) -> DataFrame:
    """Typed trades, one per (symbol, trade_id), the newest delivery winning."""
    return newest_trades(project_trades(bronze))


def newest_trades(typed: DataFrame) -> DataFrame:
    # The numeric key first: its sort prefix settles nearly every comparison.
    return newest_per_key(typed, ("trade_id", "symbol"), NEWEST)


def silver_klines(bronze: DataFrame) -> DataFrame:
    """Typed closed candles, one per (symbol, interval, open_time), the newest delivery winning."""
    return newest_per_key(project_klines(bronze), ("open_time", "symbol", "interval"), NEWEST)


def union_klines(history: DataFrame, live: DataFrame) -> DataFrame:
    return history.unionByName(live, allowMissingColumns=True)
