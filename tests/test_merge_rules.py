"""Repeated keys, moved trades, several candle widths, time zones and plans of the merges."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.fixtures import CLOSES, at, candles
from tests.test_incremental import BRONZE, rows_of

from candlewick.operators import gold, silver
from candlewick.operators.merging import merge_rows, not_beaten
from candlewick.plans import gold_build, silver_build
from candlewick.schemas import TABLES
from candlewick.sinks.catalog import CatalogTables
from candlewick.sinks.lake import Lake


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


def bronze(spark, *rows):
    return TABLES["bronze.trades_live_raw"].conform(spark.createDataFrame(rows, BRONZE))


def delivery(symbol, trade_id, price, second, arrival):
    return (symbol, trade_id, price, "2", at(second), at(second), at(arrival), "s")


def test_moved_trades_leave_their_old_minute(spark, lake):
    first = [delivery("A", 1, "5", 0, 1000), delivery("A", 2, "6", 30, 1000), delivery("A", 3, "9", 7200, 1000), delivery("B", 1, "7", 60, 1000)]
    # The newest trade of A goes back in time, another to the next day; B's only trade leaves its minute empty.
    again = [delivery("A", 3, "8", 3600, 5000), delivery("A", 1, "5", 90_000, 5000), delivery("A", 1, "5.5", 40, 9000), delivery("B", 1, "7", 600, 5000)]
    again = [(*r[:5], at(r_event), *r[6:]) for r, r_event in zip(again, (8000, 91_000, 92_000, 9000), strict=True)]
    for part in (first, again[:2] + again[3:], again[2:3]):
        lake.append("bronze.trades_live_raw", bronze(spark, *part))
        silver_build.build_silver(lake, overlap_seconds=0)
        gold_build.build_gold(lake, overlap_seconds=0)
    trades = silver.silver_trades(bronze(spark, *first, *again))
    assert rows_of(lake.read("silver.trades")) == rows_of(trades)
    assert rows_of(lake.read("gold.volume_1m")) == rows_of(gold.volume_1m(trades))
    assert rows_of(lake.read("gold.latest_price")) == rows_of(gold.latest_price(trades))
    assert lake.moved("silver.trades").count() == 4


def test_repeated_keys_are_refused(spark, lake):
    row = ("A", at(0), 1.0, 1.0, 1)
    once, twice = (spark.createDataFrame([row] * n, TABLES["gold.volume_1m"].ddl) for n in (1, 2))
    for store in (lake, CatalogTables(spark)):
        with pytest.raises(ValueError, match="more than once"):
            store.upsert("gold.volume_1m", twice)
    lake.upsert("gold.volume_1m", once)
    with pytest.raises(ValueError, match="more than once"):
        lake.upsert("gold.volume_1m", twice)
    assert lake.read("gold.volume_1m").count() == 1


def test_dates_are_utc_in_any_session(spark, lake):
    zone = spark.conf.get("spark.sql.session.timeZone")
    late = at(9 * 3600 + 1800)  # 23:30 UTC
    try:
        for name in ("UTC", "Asia/Tokyo", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", name)
            lake.upsert("gold.volume_1m", spark.createDataFrame([("A", late, 1.0, 1.0, 1)], TABLES["gold.volume_1m"].ddl))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert lake.read("gold.volume_1m").count() == 1
    assert lake.read("gold.volume_1m", dates=[late.date()]).count() == 1


def test_two_candle_widths_are_two_series(spark, lake):
    minutes = candles(spark, CLOSES)
    wide = candles(spark, {s: [c * 2 for c in v] for s, v in CLOSES.items()}).withColumn("interval", F.lit("3m"))
    both = minutes.unionByName(wide)
    cut = F.col("open_time") < F.lit(at(240))
    for part in (both.where(cut), both.where(~cut).withColumn("ingested_at", F.lit(at(90_000)))):
        lake.append("silver.klines_1m", part)
        gold_build.build_gold(lake, overlap_seconds=0)
    expected = gold.rolling_volatility(both, by=("symbol", "interval"))
    assert rows_of(lake.read("gold.volatility_5m")) == rows_of(expected)
    assert expected.groupBy("interval").count().count() == 2


def test_guarded_merge_condition(spark):
    rows = [(1, 5, 4), (2, 4, 5), (3, 5, 5), (4, None, 5), (5, 5, None), (6, None, None)]
    df = spark.createDataFrame(rows, "id int, new int, old int")
    sides = df.select("id", F.struct(F.col("new").alias("t")).alias("source"), F.struct(F.col("old").alias("t")).alias("kept"))
    assert [r.id for r in sides.where(not_beaten("source", "kept", ["t"])).orderBy("id").collect()] == [1, 3, 5, 6]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_price_does_not_sort_trades(spark):
    trades = silver.silver_trades(bronze(spark, delivery("A", 1, "5", 0, 0)))
    assert "SortAggregate" not in plan_of(gold.latest_price(trades))


def test_small_batches_leave_stored_rows_in_place(spark, tmp_path):
    ddl = TABLES["gold.volume_1m"].ddl
    folder = str(tmp_path / "stored")
    spark.createDataFrame([("A", at(i * 60), 1.0, 1.0, 1) for i in range(50)], ddl).write.parquet(folder)
    stored = spark.read.schema(ddl).parquet(folder)
    # By estimate the batch is large; counted, it is small.
    batch = stored.union(stored).union(stored).where("trade_count > 0").limit(1).withColumn("window_start", F.lit(at(0)) + F.expr("INTERVAL 1 DAY"))
    merged = merge_rows(stored, batch, TABLES["gold.volume_1m"].keys, small=True)
    kept = plan_of(merged).split("Union")[1].split("BroadcastExchange")[0]
    assert "BroadcastHashJoin" in kept and "Exchange hashpartitioning" not in kept
    assert merged.count() == 51
