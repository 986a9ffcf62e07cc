from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tests.fixtures import CLOSES, at, candles

from candlewick.operators import gold, silver
from candlewick.operators.merging import merge_rows
from candlewick.plans import backfill, gold_build, silver_build, state
from candlewick.schemas import TABLES
from candlewick.sinks.lake import Lake

BRONZE = "symbol string, trade_id bigint, price string, quantity string, trade_time timestamp, event_time timestamp, ingested_at timestamp, source string"


def deliveries(seed: int, count: int = 120) -> list[tuple]:
    """Random trade deliveries with repeats, corrections and unreadable prices, by arrival second."""
    rng = random.Random(seed)
    rows = []
    for arrival in range(count):
        symbol, trade_id = rng.choice("ABC"), rng.randrange(40)
        trade_second = trade_id * 37
        price = rng.choice(["x", None]) if rng.random() < 0.1 else f"{rng.randrange(1, 900) / 100}"
        event = trade_second + rng.randrange(0, 500)
        rows.append((symbol, trade_id, price, "2", at(trade_second), at(event), at(arrival * 100), "s"))
    return rows


def rows_of(df):
    return sorted(tuple(str(v) for v in r) for r in df.collect())


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


@pytest.mark.parametrize("seed", [1])
def test_batches_equal_one_build(spark, lake, tmp_path, seed):
    rows = deliveries(seed)
    rng = random.Random(seed)
    cuts = sorted(rng.sample(range(1, len(rows)), 2))
    frame = lambda part: TABLES["bronze.trades_live_raw"].conform(spark.createDataFrame(part, BRONZE))
    series = {s: [rng.randrange(0, 9) for _ in range(30)] for s in "AB"}
    klines = candles(spark, series).withColumn("ingested_at", F.col("close_time"))
    bronze_klines = TABLES["bronze.klines_history_raw"].conform(klines.withColumn("event_type", F.lit("kline_history")))
    third = [(0, 10), (10, 20), (20, 30)]
    for (start, end), (low, high) in zip(zip([0, *cuts], [*cuts, len(rows)]), third):
        lake.append("bronze.trades_live_raw", frame(rows[start:end]))
        inside = (F.col("open_time") >= F.lit(at(low * 60))) & (F.col("open_time") < F.lit(at(high * 60)))
        lake.append("bronze.klines_history_raw", bronze_klines.where(inside))
        silver_build.build_silver(lake)
        gold_build.build_gold(lake)

    expected_trades = silver.silver_trades(frame(rows))
    assert rows_of(lake.read("silver.trades")) == rows_of(expected_trades)
    assert rows_of(lake.read("gold.volume_1m")) == rows_of(gold.volume_1m(expected_trades))
    expected_klines = silver.silver_klines(bronze_klines)
    assert rows_of(lake.read("silver.klines_1m")) == rows_of(expected_klines)
    assert rows_of(lake.read("gold.volatility_5m")) == rows_of(gold.rolling_volatility(expected_klines))
    assert rows_of(lake.read("gold.top_movers")) == rows_of(gold.top_movers(expected_klines))


@pytest.mark.parametrize("step_days, recent_only", [(1, True), (9, False)])
def test_lead_in_beyond_the_recent_partitions(spark, lake, monkeypatch, step_days, recent_only):
    """Candles a day apart find their lead-in in the recent partitions, those nine days apart do not."""
    rng = random.Random(step_days)
    df = candles(spark, {s: [rng.randrange(1, 9) for _ in range(16)] for s in "AB"}, step_seconds=step_days * 86_400)
    old, new = df.where(F.col("open_time") < F.lit(at(14 * step_days * 86_400))), df.where(F.col("open_time") >= F.lit(at(14 * step_days * 86_400)))
    opened = []
    real = Lake.read
    monkeypatch.setattr(Lake, "read", lambda self, name, *a, **k: opened.append((name, k)) or real(self, name, *a, **k))
    for part in (old, new):
        lake.append("silver.klines_1m", part)
        opened.clear()
        gold_build.build_gold(lake)
    whole = [k for name, k in opened if name == "silver.klines_1m" and not k]
    assert len(whole) == (1 if recent_only else 2)
    assert rows_of(real(lake, "gold.volatility_5m")) == rows_of(gold.rolling_volatility(df))


@pytest.mark.parametrize("seed", range(2))
def test_bounded_volatility_update_equals_full_recompute(spark, seed):
    """Late, changed and inserted candles anywhere in the series."""
    rng = random.Random(seed)
    full = {s: [rng.choice([None, 0, 1, 2, 5, 9]) for _ in range(40)] for s in ("A", "B", "NEW")}
    old = {s: list(c) for s, c in full.items() if s != "NEW"}
    for s in old:
        for i in rng.sample(range(len(old[s])), 3):
            old[s][i] = rng.choice([None, 3, 4])
    stored, now = candles(spark, old).persist(), candles(spark, full).persist()
    same = ["symbol", "open_time", "close"]
    changed = now.join(stored.select(*same), same, "left_anti")
    # A candle that disappears is not a case of the feed: keep those of the old state.
    now = merge_rows(stored, changed, TABLES["silver.klines_1m"].keys).persist()
    update = gold_build.volatility_update(changed, now)
    result = merge_rows(gold.rolling_volatility(stored), update, ["symbol", "window_start"])
    expected = gold.rolling_volatility(now)
    assert rows_of(result) == rows_of(expected)
    whole = gold_build.volatility_update(changed, now, bounded=False)
    assert rows_of(whole) == rows_of(expected.where(F.col("symbol").isin([r[0] for r in changed.select("symbol").distinct().collect()])))


def test_latest_price_keeps_newer_stored_rows(spark):
    stored = spark.createDataFrame([("A", 9.0, at(100), "old"), ("Z", 1.0, at(0), "old")], TABLES["gold.latest_price"].ddl)
    ddl = "symbol string, trade_id bigint, price double, trade_time timestamp, event_time timestamp, ingested_at timestamp, source string"
    late = spark.createDataFrame([("A", 1, 5.0, at(50), at(50), at(500), "late")], ddl)
    tie = spark.createDataFrame([("A", 1, 5.0, at(100), at(100), at(100), "tie")], ddl)
    assert [(r.symbol, r.latest_price) for r in gold_build.latest_price_update(late, stored).collect()] == [("A", 9.0)]
    assert gold_build.latest_price_update(tie, stored).first().source == "tie"


def test_unchanged_sources_are_skipped(spark, lake):
    klines = TABLES["bronze.klines_history_raw"].conform(candles(spark, CLOSES))
    lake.append("bronze.klines_history_raw", klines)
    first = silver_build.build_silver(lake, overlap_seconds=0)
    assert first["silver.trades"] == "skipped"
    assert first["silver.klines_1m"] == "created"
    second = silver_build.build_silver(lake, overlap_seconds=0)
    assert second["silver.klines_1m"] == "skipped"
    assert second["audit.processing_state"] == "skipped"
    assert gold_build.build_gold(lake, overlap_seconds=0)["gold.volatility_5m"] == "created"
    assert set(gold_build.build_gold(lake, overlap_seconds=0).values()) == {"skipped"}


def test_overwrite_mode_rebuilds_without_state(spark, lake):
    lake.append("bronze.klines_history_raw", TABLES["bronze.klines_history_raw"].conform(candles(spark, CLOSES)))
    assert silver_build.build_silver(lake, mode="overwrite", trades=False) == {"silver.klines_1m": "overwrite"}
    outcome = gold_build.build_gold(lake, mode="overwrite")
    assert outcome["gold.top_movers"] == "overwrite"
    assert not lake.exists("audit.processing_state")
    with pytest.raises(ValueError):
        silver_build.build_silver(lake, trades=False, klines=False)


def test_state_rows_and_watermarks(spark, lake):
    assert state.load_state(lake).count() == 0
    assert state.last_watermarks(lake, "p") == {}
    assert state.save_state(lake, []) == "skipped"
    first = state.State("p", "d", "bronze", "silver", at(0.25), {"b": 1, "a": at(0)})
    assert state.save_state(lake, [first], at(10)) == "created"
    (row,) = state.load_state(lake, "p").collect()
    assert row.state_key == "p:d"
    assert row.metadata_json == '{"a": "2024-03-24 14:00:00+00:00", "b": 1}'
    assert state.last_watermarks(lake, "p") == {"d": at(0.25)}
    state.save_state(lake, [state.State("p", "d", "bronze", "silver", at(99)), state.State("q", "d", "s", "g", None)], at(20))
    assert state.load_state(lake).count() == 2
    assert state.last_watermarks(lake, "p") == {"d": at(99)}
    assert state.last_watermarks(lake, "q") == {"d": None}


def test_backfill(spark, lake, tmp_path):
    import json

    from tests.fixtures import ARRIVED, history_groups

    groups = history_groups()
    groups[0]["klines"].append([1, 2, 3])
    (tmp_path / "h.json").write_text(json.dumps(groups))
    outcome = backfill.backfill_history(lake, str(tmp_path / "h.json"), "document", ingested_at=ARRIVED)
    assert outcome["bronze.quarantine"] == "append"
    assert lake.read("bronze.klines_history_raw").count() == 11
    assert lake.read("silver.klines_1m").count() == 11
    gold_build.build_gold(lake)
    assert [r.symbol for r in lake.read("gold.top_movers").orderBy(F.abs("move_pct").desc()).collect()] == ["ETHUSDT", "BTCUSDT"]
    assert lake.read("gold.volatility_5m").count() == 3
