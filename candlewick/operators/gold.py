"""Market metrics over silver trades and candles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.functions.rows import newest_per_key
from candlewick.schemas import TABLES

WINDOW_SIZE = 5
TOP_MOVERS = 10
# A week of one-second candles is some 600,000 rows; of hourly ones 168, so lead-in rows stay few.
SLICE_DAYS = 7


def minute_of(moment: str | Column) -> Column:
    return F.date_trunc("minute", moment)


def latest_price(trades: DataFrame, ties: str = "last") -> DataFrame:
    """Newest trade per symbol.

    Order: trade_time, event_time, ingested_at, then trade_id. ``ties="first"`` looks at
    trade_time alone and lets the lowest trade_id win. The newest time of each symbol is a hash
    aggregate, combined in every task; only the trades at that time are compared further, so no
    task sorts its trades and a symbol with most of the rows costs nothing extra.
    """
    if "trade_id" not in trades.columns:
        trades = trades.withColumn("trade_id", F.lit(None).cast("bigint"))
    order = ["_earlier"] if ties == "first" else ["event_time", "ingested_at", "trade_id"]
    latest = trades.groupBy(F.col("symbol").alias("_symbol")).agg(F.max("trade_time").alias("_latest"))
    at_it = F.col("symbol").eqNullSafe(F.col("_symbol")) & F.col("trade_time").eqNullSafe(F.col("_latest"))
    last = trades.withColumn("_earlier", -F.col("trade_id")).join(latest, at_it, "left_semi")
    newest = newest_per_key(last.select("symbol", "price", "trade_time", "source", *order), ["symbol"], order)
    return newest.select("symbol", F.col("price").alias("latest_price"), "trade_time", "source")


def volume_1m(trades: DataFrame) -> DataFrame:
    """Quantity, notional and trade count per symbol and minute."""
    return trades.groupBy("symbol", minute_of("trade_time").alias("window_start")).agg(
        F.round(F.sum("quantity"), 8).alias("volume_1m"),
        F.round(F.sum("notional"), 8).alias("notional_1m"),
        F.count(F.lit(1)).cast("int").alias("trade_count"),
    )


def _slice_of(open_time: str, days: int) -> Column:
    return F.floor(F.unix_seconds(F.col(open_time).cast("timestamp")) / F.lit(days * 86_400))


def _with_lead_in(candles: DataFrame, by: list[str], order: list[str], depth: int, days: int) -> DataFrame:
    """Cut each series into time slices and give every slice the ``depth`` rows before it.

    Slices are independent window partitions, so one long series spreads over many tasks. The
    lead-in rows are found from the last ``depth`` rows of every slice: Spark keeps only those
    before the shuffle, and a run of ``depth`` of them ending at a slice's first one is exactly
    what precedes that slice, whatever the gaps.
    """
    columns = candles.columns
    sliced = candles.withColumn("_slice", _slice_of("open_time", days))
    newest = Window.partitionBy(*by, "_slice").orderBy(*[F.col(c).desc() for c in order])
    tails = sliced.withColumn("_rank", F.row_number().over(newest)).where(F.col("_rank") <= depth)
    series = Window.partitionBy(*by).orderBy(*order)
    lead_in = (
        tails.withColumn("_earlier", F.lag("_slice").over(series))
        .withColumn("_rows", F.collect_list(F.struct(*columns)).over(series.rowsBetween(-depth, -1)))
        .where(F.col("_earlier") < F.col("_slice"))
        .select("_slice", F.explode("_rows").alias("_row"))
        .select("_row.*", "_slice", F.lit(True).alias("_lead_in"))
    )
    return sliced.withColumn("_lead_in", F.lit(False)).unionByName(lead_in)


def rolling_volatility(
    candles: DataFrame,
    window_size: int = WINDOW_SIZE,
    by: Sequence[str] = ("symbol",),
    returns: str = "lagged",
    slice_days: int | None = SLICE_DAYS,
) -> DataFrame:
    """Population deviation of close-to-close returns over the last ``window_size`` candles.

    ``returns="lagged"``: the first candle of a window counts with its return against the candle
    before the window. ``returns="in_window"``: only returns between candles of the window count.
    ``by`` names the series; candles must be unique per series and open_time.
    ``slice_days=None`` keeps each series in one window partition.
    """
    if returns not in ("lagged", "in_window"):
        raise ValueError(f"unknown returns mode: {returns}")
    by = list(by)
    order = ["open_time", "close_time"]
    rows = candles.select(*dict.fromkeys([*by, "symbol", "interval", *order, "close"]))
    keys = by
    if slice_days is not None:
        # The oldest candle of a frame needs one more row for its return.
        rows, keys = _with_lead_in(rows, by, order, window_size, slice_days), [*by, "_slice"]
    else:
        rows = rows.withColumn("_lead_in", F.lit(False))

    series = Window.partitionBy(*keys).orderBy(*order)
    returns_of = series.rowsBetween(1 - window_size if returns == "lagged" else 2 - window_size, 0)
    close, before = F.col("close"), F.lag("close").over(series)
    rows = rows.withColumns(
        {
            "_return": F.when(before != 0, close / before - 1.0),
            # The candle that a full window begins with; without one the window is not full yet.
            "window_start": F.lag("open_time", window_size - 1).over(series),
        }
    )
    rows = rows.withColumns({"_deviation": F.stddev_pop("_return").over(returns_of), "_returns": F.count("_return").over(returns_of)})
    full = rows.where(~F.col("_lead_in") & F.col("window_start").isNotNull() & (F.col("_returns") > 0))
    return full.select(
        "symbol", "window_start", F.col("close_time").alias("window_end"), "interval",
        F.lit(window_size).cast("int").alias("observation_count"), F.round("_deviation", 8).alias("volatility_5m"),
    )


def price_moves(candles: DataFrame, by: Sequence[str] = ("symbol",)) -> DataFrame:
    """First and last close per series and the move between them in percent.

    Only fixed-width aggregation buffers, so Spark combines rows by hash in the scan stage.
    """
    return _moves(
        candles.groupBy(*dict.fromkeys([*by, "symbol"])).agg(
            F.min("open_time").alias("window_start"),
            F.max_by("close_time", "open_time").alias("window_end"),
            F.min_by("close", "open_time").alias("start_price"),
            F.max_by("close", "open_time").alias("end_price"),
        )
    )


def _moves(ends: DataFrame) -> DataFrame:
    start, end = F.col("start_price"), F.col("end_price")
    move = F.when(start == 0, F.lit(0.0)).otherwise((end - start) / start * 100.0)
    return ends.withColumn("move_pct", F.round(move, 8)).select(*TABLES["gold.top_movers"].columns)


def series_ends(candles: DataFrame) -> DataFrame:
    """First and last close of every series (symbol and candle width): all that a move needs, and mergeable."""
    return candles.groupBy("symbol", "interval").agg(
        F.min("open_time").alias("first_open_time"), F.min_by("close", "open_time").alias("first_close"),
        F.max("open_time").alias("last_open_time"), F.max_by("close_time", "open_time").alias("last_close_time"),
        F.max_by("close", "open_time").alias("last_close"),
    )


def merge_ends(stored: DataFrame, arriving: DataFrame) -> DataFrame:
    """The ends of the arriving series, stored ends counted in.

    Of two ends at the same time the arriving one is the newer version of that candle, so a corrected end replaces the stored
    one. Stored series without an arriving candle are not in the result; they stay as they are.
    """
    known = stored.join(arriving.select("symbol", "interval"), ["symbol", "interval"], "left_semi").withColumn("_known", F.lit(1))
    both = arriving.withColumn("_known", F.lit(0)).unionByName(known)
    first = F.min(F.struct("first_open_time", "_known", "first_close"))
    last = F.max(F.struct("last_open_time", -F.col("_known"), "last_close_time", "last_close"))
    merged = both.groupBy("symbol", "interval").agg(first.alias("_first"), last.alias("_last"))
    return merged.select(
        "symbol", "interval", "_first.first_open_time", "_first.first_close", "_last.last_open_time", "_last.last_close_time", "_last.last_close"
    )


def moves_of_ends(ends: DataFrame) -> DataFrame:
    """``price_moves`` of all candles, from the ends of their series."""
    return _moves(
        ends.groupBy("symbol").agg(
            F.min("first_open_time").alias("window_start"),
            F.max_by("last_close_time", "last_open_time").alias("window_end"),
            F.min_by("first_close", "first_open_time").alias("start_price"),
            F.max_by("last_close", "last_open_time").alias("end_price"),
        )
    )


def rank_movers(moves: DataFrame, limit: int | None = TOP_MOVERS) -> DataFrame:
    ranked = moves.orderBy(F.abs("move_pct").desc(), F.col("symbol").asc())
    return ranked if limit is None else ranked.limit(int(limit))


def top_movers(candles: DataFrame, limit: int = TOP_MOVERS, by: Sequence[str] = ("symbol",)) -> DataFrame:
    """The symbols with the largest absolute move over all their candles."""
    return rank_movers(price_moves(candles, by), limit)
