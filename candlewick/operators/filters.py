"""Row filters, casts and one-pass checks over stored tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.functions.time import as_of_column, utc


def filter_symbols(df: DataFrame, symbols: Sequence[str] | None) -> DataFrame:
    """Keep the named symbols; an empty list keeps all."""
    wanted = [s.strip().upper() for s in symbols or () if s.strip()]
    if not wanted or "symbol" not in df.columns:
        return df
    return df.where(F.col("symbol").isin(wanted))


def look_back(df: DataFrame, column: str, hours: int, as_of: datetime | Column | None = None) -> DataFrame:
    if isinstance(as_of, datetime):
        # A literal bound reaches the scan as a pushed filter.
        return df.where(F.col(column) >= F.lit(utc(as_of) - timedelta(hours=int(hours))))
    return df.where(F.col(column) >= as_of_column(as_of) - F.make_interval(hours=F.lit(int(hours))))


def after_watermark(
    df: DataFrame, column: str, last_processed_at: datetime | None, overlap_seconds: int = 0
) -> DataFrame:
    """Rows newer than the stored watermark minus the overlap; without a watermark, all rows."""
    bound = watermark_bound(last_processed_at, overlap_seconds)
    return df if bound is None else df.where(F.col(column) > F.lit(bound))


def watermark_bound(last_processed_at: datetime | None, overlap_seconds: int = 0) -> datetime | None:
    if last_processed_at is None:
        return None
    return utc(last_processed_at) - timedelta(seconds=max(overlap_seconds, 0))


def cast_to_schema(df: DataFrame, casts: Mapping[str, str]) -> DataFrame:
    """Cast the mapped columns that exist; unreadable text becomes null."""
    return df.withColumns({c: F.col(c).try_cast(kind) for c, kind in casts.items() if c in df.columns})


def max_watermark(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.max(column).alias("max_timestamp"))


def negative_klines(klines: DataFrame) -> DataFrame:
    bad = reduce(lambda a, b: a | b, [F.col(c) < 0 for c in ("open", "high", "low", "close", "volume")])
    return klines.where(bad).select(
        "symbol", "interval", "open_time", "close_time", "open", "high", "low", "close", "volume"
    )


def trade_null_counts(trades: DataFrame) -> DataFrame:
    return trades.agg(
        *[
            F.count_if(F.col(c).isNull()).alias(f"null_{c}_count")
            for c in ("symbol", "trade_id", "price", "quantity", "trade_time")
        ]
    )


def trade_duplicates(trades: DataFrame) -> DataFrame:
    counted = trades.groupBy("symbol", "trade_id").agg(F.count(F.lit(1)).alias("duplicate_count"))
    return counted.where("duplicate_count > 1")


def latest_trade_time(latest_prices: DataFrame, as_of: datetime | Column | None = None) -> DataFrame:
    return latest_prices.agg(
        F.max("trade_time").alias("latest_trade_time"), F.max(as_of_column(as_of)).alias("checked_at")
    )
