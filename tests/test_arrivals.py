"""The ledger of consumed files, late arrivals, and the stored ends of series."""

from __future__ import annotations

import random
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.fixtures import CLOSES, at, candles
from tests.test_incremental import BRONZE, deliveries, rows_of

from candlewick.operators import gold, silver
from candlewick.plans import gold_build, ledger, silver_build
from candlewick.schemas import TABLES
from candlewick.sinks.catalog import CatalogTables
from candlewick.sinks.lake import Lake


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


def bronze(spark, rows):
    return TABLES["bronze.trades_live_raw"].conform(spark.createDataFrame(rows, BRONZE))


def late_batches(seed: int):
    """Deliveries in three batches cut without regard to their arrival times."""
    rows = deliveries(seed)
    random.Random(seed).shuffle(rows)
    return rows[:50], rows[50:90], rows[90:]


def late_candles(spark):
    klines = candles(spark, {s: [random.Random(s).randrange(1, 9) for _ in range(30)] for s in ("A", "B", "LATE")})
    return TABLES["bronze.klines_history_raw"].conform(klines.withColumns({"event_type": F.lit("kline_history"), "ingested_at": F.col("close_time")}))


def test_rows_older_than_the_watermark_reach_silver_and_gold(spark, lake):
    batches, klines = late_batches(3), late_candles(spark)
    parts = ["symbol = 'A'", "symbol = 'B' AND minute(open_time) >= 15", "symbol = 'LATE' OR (symbol = 'B' AND minute(open_time) < 15)"]
    for trades, part in zip(batches, parts):
        lake.append("bronze.trades_live_raw", bronze(spark, trades))
        lake.append("bronze.klines_history_raw", klines.where(part))
        silver_build.build_silver(lake)
        gold_build.build_gold(lake)
    trades, closed = silver.silver_trades(bronze(spark, sum(batches, []))), silver.silver_klines(klines)
    assert rows_of(lake.read("silver.trades")) == rows_of(trades)
    assert rows_of(lake.read("gold.volume_1m")) == rows_of(gold.volume_1m(trades))
    # Of trades at one time the direct table knows arrival and id, the stored price does not: compare price times.
    when = lambda df: rows_of(df.select("symbol", "trade_time"))
    assert when(lake.read("gold.latest_price")) == when(gold.latest_price(trades))
    assert rows_of(lake.read("silver.klines_1m")) == rows_of(closed)
    assert rows_of(lake.read("gold.volatility_5m")) == rows_of(gold.rolling_volatility(closed))
    assert rows_of(lake.read("gold.top_movers")) == rows_of(gold.top_movers(closed))


def test_the_watermark_alone_loses_them(spark, lake):
    for rows in late_batches(3):
        lake.append("bronze.trades_live_raw", bronze(spark, rows))
        silver_build.build_silver(lake, klines=False, consume="watermark")
    assert lake.read("silver.trades").count() < silver.silver_trades(bronze(spark, deliveries(3))).count()
    silver_build.build_silver(lake, klines=False)  # the ledger has nothing of this table yet
    assert rows_of(lake.read("silver.trades")) == rows_of(silver.silver_trades(bronze(spark, deliveries(3))))


def test_only_unread_files_are_opened_and_a_repeat_changes_nothing(spark, lake, monkeypatch):
    first, second, third = late_batches(5)
    table = "bronze.trades_live_raw"
    lake.append(table, bronze(spark, first + second))
    silver_build.build_silver(lake, klines=False)
    known = set(lake.read(table).inputFiles())
    lake.append(table, bronze(spark, third))
    batch = ledger.arrivals(lake, table, silver_build.PIPELINE)
    assert set(batch.rows.inputFiles()) == set(lake.read(table).inputFiles()) - known
    assert batch.row_count == len(third) and not batch.gone
    # A crash after the data and before the ledger: the batch is read and merged again.
    with monkeypatch.context() as patch:
        patch.setattr(ledger, "consume", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            silver_build.build_silver(lake, klines=False)
    before = rows_of(lake.read("silver.trades"))
    assert silver_build.build_silver(lake, klines=False)["silver.trades"] == "merged"
    assert rows_of(lake.read("silver.trades")) == before == rows_of(silver.silver_trades(bronze(spark, first + second + third)))
    assert silver_build.build_silver(lake, klines=False)["silver.trades"] == "skipped"
    assert lake.read(ledger.LEDGER).agg(F.sum("row_count")).first()[0] == len(first + second + third)


def test_rewritten_files_leave_the_ledger(spark, lake):
    table = "bronze.trades_live_raw"
    for i in range(10):
        lake.append(table, bronze(spark, deliveries(i, 5)))
        silver_build.build_silver(lake, klines=False)
    assert ledger.consumed(lake, silver_build.PIPELINE, table).count() == len(lake.read(table).inputFiles()) >= 10
    before = rows_of(lake.read("silver.trades"))
    lake.compact(table, more_than=2)
    silver_build.build_silver(lake, klines=False)
    assert ledger.consumed(lake, silver_build.PIPELINE, table).count() == len(lake.read(table).inputFiles())
    assert rows_of(lake.read("silver.trades")) == before


def test_consuming_is_checked(spark, lake):
    with pytest.raises(ValueError, match="unknown way"):
        silver_build.build_silver(lake, consume="all")
    with pytest.raises(ValueError, match="plain files"):
        silver_build.build_silver(CatalogTables(spark, file_format="delta"), consume="ledger")
    assert not silver_build.consumes_by_ledger(CatalogTables(spark, file_format="delta"), None)


@pytest.mark.parametrize("seed", range(3))
def test_merged_ends_equal_all_candles(spark, seed):
    """Late, corrected, inserted and new candles, also at the ends of a series and in two widths."""
    rng = random.Random(seed)
    versions = {(s, w, i): rng.randrange(0, 9) for s in "ABC" for w in ("1m", "5m") for i in range(5, 15)}
    frame = lambda cells: TABLES["silver.klines_1m"].conform(spark.createDataFrame(
        [(s, w, at(i * 60 + (w == "5m")), at(i * 60 + 59), float(c)) for (s, w, i), c in cells.items()],
        "symbol string, `interval` string, open_time timestamp, close_time timestamp, close double"))
    ends = gold.series_ends(frame(versions))
    for _ in range(3):
        batch = {(rng.choice("ABCD"), rng.choice(("1m", "5m")), rng.choice([2, 5, 9, 14, 20])): rng.randrange(0, 9) for _ in range(5)}
        versions |= batch
        merged = gold.merge_ends(ends, gold.series_ends(frame(batch)))
        kept = ends.join(merged, ["symbol", "interval"], "left_anti")
        ends = spark.createDataFrame(kept.unionByName(merged).collect(), TABLES["gold.series_ends"].ddl)
    assert rows_of(ends) == rows_of(gold.series_ends(frame(versions)).select(*ends.columns))
    assert rows_of(gold.moves_of_ends(ends)) == rows_of(gold.price_moves(frame(versions)))


def test_movers_do_not_read_all_candles(spark, lake, monkeypatch):
    klines = candles(spark, CLOSES)
    old, new = klines.where(F.col("open_time") < F.lit(at(240))), klines.where(F.col("open_time") >= F.lit(at(240)))
    lake.upsert("silver.klines_1m", old)
    gold_build.build_gold(lake)
    lake.upsert("silver.klines_1m", new.withColumn("open_time", F.col("open_time") + F.expr("INTERVAL 400 DAYS")))
    opened, ranked = [], []
    real, rank = Lake.read, gold_build.rank_movers
    monkeypatch.setattr(Lake, "read", lambda self, name, *a, **k: opened.append(name) or real(self, name, *a, **k))
    monkeypatch.setattr(gold_build, "rank_movers", lambda moves, n: ranked.append(moves.inputFiles()) or rank(moves, n))
    gold_build.build_gold(lake)
    assert ranked[0] and all("/gold/series_ends/" in f for f in ranked[0])
    assert rows_of(real(lake, "gold.top_movers")) == rows_of(gold.top_movers(real(lake, "silver.klines_1m")))


@pytest.mark.parametrize("library", ["ahocorasick", "tokenizers", "zstandard", "public_tokenizers", "pyarrow", "numpy"])
def test_market_queries_survive_a_missing_library(library):
    """With a library of the text operators missing, the entry still imports and has the market queries."""
    script = (
        f"import sys; sys.modules[{library!r}] = None\n"
        "import __spark_entry__ as entry\n"
        "from candlewick.registry.queries import QUERIES\n"
        "assert QUERIES.keys() <= entry.queries().keys() and len(QUERIES) > 80, len(entry.queries())\n"
    )
    root = Path(__file__).resolve().parent.parent
    done = subprocess.run([sys.executable, "-c", script], cwd=root, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr[-800:]
