"""Silver to gold, in full or for what changed since the stored watermarks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candlewick.functions.time import utc_date
from candlewick.operators.filters import after_watermark, watermark_bound
from candlewick.operators.gold import (
    TOP_MOVERS, WINDOW_SIZE, latest_price, merge_ends, minute_of, moves_of_ends, rank_movers, rolling_volatility, series_ends,
    volume_1m,
)
from candlewick.plans import ledger
from candlewick.plans.silver_build import consumes_by_ledger
from candlewick.plans.state import OVERLAP_SECONDS, WATERMARK, State, batch_extent, last_watermarks, save_state
from candlewick.sinks.lake import Store
from candlewick.sinks.workspace import new_folder

PIPELINE = "build_gold_metrics"
TRADES, KLINES, ENDS = "silver.trades", "silver.klines_1m", "gold.series_ends"
# Candles of several widths are series of their own.
SERIES = ("symbol", "interval")
# Days before the earliest change that are searched for lead-in candles first.
LEAD_IN_DAYS = 7


def latest_price_update(
    changed: DataFrame, stored: DataFrame | None, moved: DataFrame | None = None, all_trades: DataFrame | None = None
) -> DataFrame:
    """Newest price of the symbols that traded: arriving trades against the stored prices.

    A stored price whose own trade was ``moved`` to another time no longer holds: such symbols are looked up
    in ``all_trades``.
    """
    candidates = changed.select(
        "symbol", "price", "trade_time", "event_time", "ingested_at", "source", "trade_id"
    )
    if stored is not None:
        affected = changed.select("symbol").distinct()
        kept = stored.join(affected, "symbol", "left_semi")
        if moved is not None and all_trades is not None:
            stale = moved.select("symbol", "trade_time").distinct()
            renewed = kept.join(stale, ["symbol", "trade_time"], "left_semi").select("symbol")
            kept = kept.join(stale, ["symbol", "trade_time"], "left_anti")
            candidates = candidates.unionByName(all_trades.join(renewed, "symbol", "left_semi").select(*candidates.columns))
        kept = kept.select(
            "symbol",
            F.col("latest_price").alias("price"),
            "trade_time",
            F.col("trade_time").alias("event_time"),
            F.col("trade_time").alias("ingested_at"),
            "source",
        )
        candidates = candidates.unionByName(kept, allowMissingColumns=True)
    return latest_price(candidates)


def affected_minutes(changed: DataFrame) -> DataFrame:
    return changed.select("symbol", minute_of("trade_time").alias("window_start")).distinct()


def volume_update(changed: DataFrame, all_trades: DataFrame) -> DataFrame:
    """Every minute that received a trade, recomputed from all its trades."""
    keyed = all_trades.withColumn("window_start", minute_of("trade_time"))
    touched = keyed.join(affected_minutes(changed), ["symbol", "window_start"], "left_semi")
    return volume_1m(touched)


def first_changes(changed: DataFrame) -> DataFrame:
    """The earliest changed candle of each affected series."""
    return changed.groupBy(*SERIES).agg(F.min("open_time").alias("_changed"))


def lead_in(all_klines: DataFrame, changes: DataFrame, depth: int) -> DataFrame:
    """Per affected series: the start of the ``depth`` candles before its first change, and how many exist."""
    newest = Window.partitionBy(*SERIES).orderBy(F.col("open_time").desc())
    before = all_klines.select(*SERIES, "open_time").join(changes, list(SERIES))
    return (
        before.where(F.col("open_time") < F.col("_changed"))
        .withColumn("_rank", F.row_number().over(newest))
        .where(F.col("_rank") <= depth)
        .groupBy(*SERIES)
        .agg(F.min("open_time").alias("_from"), F.count(F.lit(1)).alias("_depth"))
    )


def volatility_update(
    changed: DataFrame,
    all_klines: DataFrame,
    window_size: int = WINDOW_SIZE,
    bounded: bool = True,
    changes: DataFrame | None = None,
) -> DataFrame:
    """Volatility windows of the series that received a candle.

    A candle changes the windows that start at most ``window_size - 1`` candles before it, and all
    later ones may shift. ``bounded`` therefore recomputes each series from ``window_size`` candles
    before its earliest change (one more than the windows need, for the first return) instead of
    from its first candle; the result equals a full recompute. Join strategies are left to AQE.
    """
    series = list(SERIES)
    if not bounded:
        affected = changed.select(*series).distinct()
        return rolling_volatility(all_klines.join(affected, series, "left_semi"), window_size, by=SERIES)
    changes = first_changes(changed) if changes is None else changes
    # Without that many earlier candles the series is recomputed from its first one.
    starts = changes.join(lead_in(all_klines, changes, window_size), series, "left").select(
        *series, F.when(F.col("_depth") == window_size, F.col("_from")).alias("_from")
    )
    scoped = all_klines.join(starts, series)
    scoped = scoped.where(F.col("_from").isNull() | (F.col("open_time") >= F.col("_from")))
    windows = rolling_volatility(scoped.drop("_from"), window_size, by=SERIES)
    # A window that starts on the very first lead-in candle lacks that candle's return.
    return (
        windows.join(starts, series)
        .where(F.col("_from").isNull() | (F.col("window_start") > F.col("_from")))
        .drop("_from")
    )


def changed_volatility(lake: Store, changed: DataFrame, window_size: int) -> DataFrame:
    """``volatility_update`` over as few date partitions as hold the affected windows.

    Series with their lead-in in the recent partitions are computed from these; only the rows of
    the others, such as sparse or new ones, are sought in the whole table.
    """
    changes = first_changes(changed).persist()
    try:
        series = list(SERIES)
        total, earliest = changes.agg(F.count(F.lit(1)), utc_date(F.min("_changed"))).first()
        recent = lake.read(KLINES, from_date=earliest - timedelta(days=LEAD_IN_DAYS))
        ready = written(lake.spark, lead_in(recent, changes, window_size).where(F.col("_depth") == window_size).select(*series))
    finally:
        changes.unpersist()
    changes = first_changes(changed)
    near = volatility_update(changed, recent, window_size, changes=changes.join(ready, series, "left_semi"))
    if ready.count() == total:
        return near
    others = changes.join(ready, series, "left_anti")
    far = volatility_update(changed, lake.read(KLINES).join(others.select(*series), series, "left_semi"), window_size, changes=others)
    return near.unionByName(far)


def written(spark: SparkSession, df: DataFrame) -> DataFrame:
    """A small intermediate result as files in the shared folder."""
    folder = new_folder(spark, "gold")
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def stale_prices(prices: DataFrame, trades: DataFrame, dates: Sequence[date]) -> DataFrame:
    """``symbol`` and ``trade_time`` of stored prices at ``dates`` whose trade is no longer there in ``trades`` of these dates."""
    here = prices.where(utc_date("trade_time").isin(list(dates))).select("symbol", "trade_time")
    return here.join(trades.select("symbol", "trade_time"), ["symbol", "trade_time"], "left_anti")


@dataclass
class _Changes:
    """What a source has for gold: changed rows, how many, its watermark after them, and how it was found."""

    rows: DataFrame
    count: int
    newest: datetime | None
    last: datetime | None
    batch: ledger.Arrivals | None = None


def _changes(lake: Store, table: str, last: datetime | None, overlap: int | None) -> _Changes:
    """By the ledger, all rows of the dates that merges have rewritten; by watermark, rows that arrived after it."""
    if overlap is None:
        batch = ledger.arrivals(lake, table, PIPELINE)
        newest = max((m for m in (batch.newest, last) if m is not None), default=None)
        return _Changes(batch.rows, batch.row_count, newest, last, batch)
    rows = after_watermark(lake.read(table, arrived_after=watermark_bound(last, overlap)), WATERMARK, last, overlap)
    return _Changes(rows, *batch_extent(rows), last)


def build_gold(
    lake: Store,
    mode: str = "merge",
    overlap_seconds: int = OVERLAP_SECONDS,
    window_size: int = WINDOW_SIZE,
    movers: int = TOP_MOVERS,
    updated_at: datetime | None = None,
    consume: str | None = None,
) -> dict[str, str]:
    """Build the four gold tables; outputs whose source did not change are ``skipped``. ``consume`` as in ``build_silver``.

    Movers come from the stored ends of each series, merged with the changed candles; candles are not read again for them.
    """
    incremental = mode == "merge"
    by_ledger = consumes_by_ledger(lake, consume) and incremental
    overlap = None if by_ledger else overlap_seconds
    since = last_watermarks(lake, PIPELINE) if incremental else {}
    outcome: dict[str, str] = {}
    states: list[State] = []
    read: list[ledger.Arrivals] = []

    def write(table: str, rows: DataFrame) -> None:
        outcome[table] = lake.upsert(table, rows) if incremental else lake.overwrite(table, rows)

    def advance(source: str, changes: _Changes, targets: list[str]) -> None:
        metadata = {"targets": targets, "write_mode": mode}
        states.append(State(PIPELINE, source.partition(".")[2], "silver", "gold", changes.newest, metadata))
        if changes.batch:
            read.append(changes.batch)

    changes = _changes(lake, TRADES, since.get("trades"), overlap)
    if changes.count and changes.newest is not None:
        prices = lake.optional("gold.latest_price") if incremental else None
        days = None
        if changes.last is not None:
            days, moved = _touched_days(lake, changes, prices, overlap)
            write("gold.latest_price", latest_price_update(changes.rows, prices, moved, lake.read(TRADES)))
            outcome["gold.volume_1m"] = lake.replace_dates("gold.volume_1m", volume_1m(lake.read(TRADES, days)), days)
        else:
            write("gold.latest_price", latest_price_update(changes.rows, prices))
            write("gold.volume_1m", volume_1m(changes.rows))
        advance(TRADES, changes, ["latest_price", "volume_1m"])
    else:
        outcome["gold.latest_price"] = outcome["gold.volume_1m"] = "skipped"

    changes = _changes(lake, KLINES, since.get("klines_1m"), overlap)
    if changes.count and changes.newest is not None:
        if changes.last is None:
            write("gold.volatility_5m", rolling_volatility(changes.rows, window_size, by=SERIES))
        else:
            write("gold.volatility_5m", changed_volatility(lake, changes.rows, window_size))
        ends = lake.optional(ENDS) if incremental and changes.last is not None else None
        if ends is not None:
            lake.upsert(ENDS, merge_ends(ends, series_ends(changes.rows)))
        else:
            lake.overwrite(ENDS, series_ends(changes.rows if changes.last is None else lake.read(KLINES)))
        # The ranking is global: it replaces the table, which drops symbols that fell out.
        ranking = rank_movers(moves_of_ends(lake.read(ENDS)), movers)
        outcome["gold.top_movers"] = (
            lake.upsert("gold.top_movers", ranking, delete_unmatched=True)
            if incremental
            else lake.overwrite("gold.top_movers", ranking)
        )
        advance(KLINES, changes, ["volatility_5m", "top_movers"])
    else:
        outcome["gold.volatility_5m"] = outcome["gold.top_movers"] = "skipped"

    if read:
        ledger.consume(lake, PIPELINE, read, updated_at)
    if incremental:
        outcome["audit.processing_state"] = save_state(lake, states, updated_at)
    return outcome


def _touched_days(lake: Store, changes: _Changes, prices: DataFrame | None, overlap: int | None) -> tuple[list[date], DataFrame | None]:
    """Days with a trade that came or that a redelivery took away, and stored prices that no longer hold."""
    if changes.batch:
        days = changes.batch.dates()
        return days, stale_prices(prices, lake.read(TRADES, days), days) if prices is not None else None
    bound = watermark_bound(changes.last, overlap)
    moved = after_watermark(lake.moved(TRADES, bound), WATERMARK, changes.last, overlap)
    touched = changes.rows.select("trade_time").union(moved.select("trade_time"))
    return [row[0] for row in touched.select(utc_date("trade_time")).distinct().collect()], moved
