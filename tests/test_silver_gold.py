from __future__ import annotations

import random
from datetime import timedelta
from statistics import pstdev

import pytest
from pyspark.sql import functions as F

from tests.fixtures import ARRIVED, CLOSES, at, candles, raw, trade_lines

from candlewick.operators import gold, payloads, silver
from candlewick.operators.filters import after_watermark, filter_symbols, look_back
from candlewick.schemas import TABLES


def bronze(spark):
    return payloads.parse_trades(raw(spark, trade_lines()), ingested_at=ARRIVED)


def test_duplicate_trades_collapse(spark):
    assert bronze(spark).count() == 6
    assert silver.silver_trades(bronze(spark)).count() == 5


def test_newest_delivery_wins_in_any_order(spark):
    rows = [("A", 1, "1.0", at(0), at(5)), ("A", 1, "2.0", at(9), at(5)), ("A", 1, "3.0", at(9), at(6)), ("A", 1, "4.0", None, at(99))]
    ddl = "symbol string, trade_id bigint, price string, event_time timestamp, ingested_at timestamp"
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, ddl).withColumns({"quantity": F.lit("1"), "trade_time": F.lit(at(0))})
        assert [r.price for r in silver.silver_trades(df).collect()] == [3.0]


def test_unusable_trades_are_dropped(spark):
    ddl = "symbol string, trade_id bigint, price string, quantity string, trade_time timestamp"
    good = ("A", 1, "1.5", "2", at(0))
    rows = [good, (None, 2, "1", "1", at(0)), ("A", None, "1", "1", at(0)), ("A", 3, "abc", "1", at(0)),
            ("A", 4, "1", None, at(0)), ("A", 5, "1", "1", None)]
    (row,) = silver.silver_trades(spark.createDataFrame(rows, ddl)).collect()
    assert (row.trade_id, row.notional) == (1, 3.0)


def test_trade_defaults(spark):
    df = spark.createDataFrame([("A", 1, "1", "1", at(3))], "symbol string, trade_id bigint, price string, quantity string, trade_time timestamp")
    (row,) = silver.trade_defaults(df).collect()
    assert row.event_time == row.ingested_at == row.trade_time
    assert (row.source, row.is_market_maker) == ("binance", False)


def test_open_candles_do_not_reach_silver(spark):
    closed = candles(spark, {"A": [1, 2, 3]})
    running = closed.withColumn("is_closed", F.when(F.col("close") == 2, False))
    assert silver.silver_klines(closed).count() == 3
    assert silver.silver_klines(running).count() == 0


def test_union_fills_missing_columns(spark):
    both = silver.union_klines(candles(spark, {"A": [1]}), candles(spark, {"A": [2]}).drop("quote_volume", "source"))
    assert both.count() == 2
    assert both.where("source IS NULL").count() == 1


def test_latest_price_and_volume(spark):
    trades = silver.silver_trades(bronze(spark))
    assert {r.symbol: r.latest_price for r in gold.latest_price(trades).collect()} == {"BTCUSDT": 65050.0, "ETHUSDT": 3535.0}
    volume = {(r.symbol, r.window_start.minute): r for r in gold.volume_1m(trades).collect()}
    assert volume["BTCUSDT", 0].volume_1m == 0.3
    assert volume["BTCUSDT", 0].trade_count == 2
    assert volume["ETHUSDT", 1].notional_1m == 5280.0


def test_latest_price_ties(spark):
    rows = [("A", t, float(t), at(0), at(0), at(0), "x") for t in (3, 9, 5)]
    ddl = "symbol string, trade_id bigint, price double, trade_time timestamp, event_time timestamp, ingested_at timestamp, source string"
    df = spark.createDataFrame(rows, ddl)
    assert gold.latest_price(df).first().latest_price == 9.0
    assert gold.latest_price(df, ties="first").first().latest_price == 3.0


def test_top_movers(spark):
    rows = gold.top_movers(candles(spark, CLOSES)).collect()
    assert [(r.symbol, r.move_pct) for r in rows] == [("ETHUSDT", 1.28571429), ("BTCUSDT", 0.61538462)]
    assert [r.symbol for r in gold.top_movers(candles(spark, {"Z": [0, 5], "B": [2, 1], "A": [1, 1.5]}), limit=2).collect()] == ["A", "B"]


def test_volatility_of_the_two_readings(spark):
    df = candles(spark, CLOSES)
    lagged = gold.rolling_volatility(df).orderBy("symbol", "window_start").collect()
    inside = gold.rolling_volatility(df, returns="in_window").orderBy("symbol", "window_start").collect()
    assert [r.volatility_5m for r in lagged[:2]] == [0.00119544, 0.00109403]
    assert [r.volatility_5m for r in inside[:2]] == [0.00119544, 0.00121082]
    assert len(lagged) == len(inside) == 3
    assert all(r.observation_count == 5 and r.volatility_5m > 0 for r in lagged)


def test_volatility_needs_enough_candles_and_a_return(spark):
    assert gold.rolling_volatility(candles(spark, {"A": [1, 2, 3, 4]})).count() == 0
    assert gold.rolling_volatility(candles(spark, {"A": [0, 0, 0, 0, 0]})).count() == 0
    (row,) = gold.rolling_volatility(candles(spark, {"A": [0, 0, 0, 0, 0, 5]})).where("volatility_5m IS NULL").collect() or [None]
    assert row is None
    with pytest.raises(ValueError):
        gold.rolling_volatility(candles(spark, {"A": [1]}), returns="other")


def brute_force(series: dict, size: int, in_window: bool, step: int) -> dict:
    found = {}
    for symbol, closes in series.items():
        rows = [(i, c) for i, c in enumerate(closes) if c is not None]
        returns = [None] + [(b / a - 1) if a else None for (_, a), (_, b) in zip(rows, rows[1:])]
        for end in range(size - 1, len(rows)):
            first = end - size + 1
            used = [r for r in returns[first + in_window : end + 1] if r is not None]
            if used:
                found[symbol, at(rows[first][0] * step)] = pstdev(used)
    return found


@pytest.mark.parametrize("returns", ["lagged", "in_window"])
@pytest.mark.parametrize("slice_days", [None, 1, 3])
@pytest.mark.parametrize("size", [2, 5])
def test_sliced_volatility_equals_row_by_row(spark, returns, slice_days, size):
    rng = random.Random(size * 7 + (slice_days or 0))
    step = 5 * 3600
    series = {
        symbol: [None if rng.random() < gaps else rng.choice([0, 1, 2, 5, 10]) for _ in range(80)]
        for symbol, gaps in (("DENSE", 0.0), ("GAPS", 0.5), ("SPARSE", 0.93))
    }
    df = candles(spark, series, step_seconds=step).repartition(4)
    rows = gold.rolling_volatility(df, window_size=size, returns=returns, slice_days=slice_days).collect()
    expected = brute_force(series, size, returns == "in_window", step)
    actual = {(r.symbol, r.window_start): r.volatility_5m for r in rows}
    assert len(rows) == len(expected)
    for (symbol, moment), value in expected.items():
        assert actual[symbol, moment.replace(tzinfo=None)] == pytest.approx(value, abs=2e-8)


def test_mixed_intervals_can_be_kept_apart(spark):
    minutes, fives = candles(spark, {"A": [1, 2, 3, 4, 5]}), candles(spark, {"A": [9, 8, 7, 6, 5]}, "5m", 300)
    apart = gold.rolling_volatility(minutes.unionByName(fives), by=("symbol", "interval"))
    assert {r.interval for r in apart.collect()} == {"1m", "5m"}
    moves = gold.price_moves(minutes.unionByName(fives), by=("symbol", "interval"))
    assert moves.count() == 2


def test_silver_schemas_match_the_stored_tables(spark):
    trades = silver.silver_trades(bronze(spark))
    assert [c for c, _ in trades.dtypes] == TABLES["silver.trades"].columns
    klines = silver.silver_klines(candles(spark, {"A": [1]}))
    assert [c for c, _ in klines.dtypes] == TABLES["silver.klines_1m"].columns
    volatility = gold.rolling_volatility(candles(spark, CLOSES))
    assert dict(volatility.dtypes)["observation_count"] == "int"


def test_filters(spark):
    df = spark.createDataFrame([("A", at(0)), ("B", at(60)), ("C", at(120))], "symbol string, t timestamp")
    assert filter_symbols(df, [" a", "", "c "]).count() == 2
    assert filter_symbols(df, []).count() == 3
    assert after_watermark(df, "t", at(60)).count() == 1
    assert after_watermark(df, "t", at(60), 1).count() == 2
    assert after_watermark(df, "t", at(60), -99).count() == 1
    assert after_watermark(df, "t", None).count() == 3
    late = at(120) + timedelta(hours=1)
    assert look_back(df, "t", 1, late).count() == 1
    assert look_back(df, "t", 1, F.lit(late)).count() == 1
    assert look_back(df, "t", 1).count() == 0
