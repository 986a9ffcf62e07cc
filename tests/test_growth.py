"""Work that a merge must not repeat: exchanges of its sides, evaluations of its batch."""

from __future__ import annotations

from candlewick.operators.merging import merge_rows
from candlewick.schemas import TABLES
from candlewick.sinks.lake import Lake
from tests.fixtures import at

DDL = "k string, n int, v string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_a_guarded_merge_exchanges_each_side_once(spark):
    stored = spark.createDataFrame([("a", 1, "old")], DDL)
    batch = spark.createDataFrame([("a", 2, "new")], DDL)
    plan = merge_rows(stored, batch, ["k"], ["n"])._jdf.queryExecution().sparkPlan().toString()
    # One window over both sides and no join: before, the stored rows were read twice and joined three times.
    assert plan.count("Join") == 0 and plan.count("Window [") == 1


def test_a_guarded_merge_keeps_what_the_joins_kept(spark):
    """Newer, equal, older, null and repeated stored rows."""
    stored = spark.createDataFrame(
        [("a", 1, "s"), ("b", 2, "s"), ("c", 3, "s"), (None, 1, "s"), ("d", None, "s"), ("e", 5, "s1"), ("e", 1, "s2"),
         ("f", 1, "s1"), ("f", 2, "s2"), ("g", 1, "s"), ("h", 1, "s")], DDL)
    batch = spark.createDataFrame(
        [("a", 2, "b"), ("b", 2, "b"), ("c", 2, "b"), (None, 2, "b"), ("d", None, "b"), ("e", 4, "b"), ("f", 3, "b"),
         ("h", None, "b"), ("i", None, "b")], DDL)
    expected = [("a", 2, "b"), ("b", 2, "b"), ("c", 3, "s"), (None, 2, "b"), ("d", None, "b"), ("e", 5, "s1"), ("e", 1, "s2"),
                ("f", 3, "b"), ("g", 1, "s"), ("h", 1, "s"), ("i", None, "b")]
    assert rows(merge_rows(stored, batch, ["k"], ["n"])) == sorted(expected, key=str)
    assert rows(merge_rows(stored, batch, ["k"], ["n"], small=True)) == sorted(expected, key=str)


def test_a_batch_is_evaluated_once(spark, tmp_path):
    """Whatever a merge asks of its batch: the rows are computed once and the staged files go."""
    lake = Lake(spark, str(tmp_path))
    table, seen = TABLES["gold.volume_1m"], spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    for quantity in (1.0, 2.0):
        source = table.conform(spark.createDataFrame([("A", at(0), quantity, 1.0, 1)], table.ddl))
        lake.upsert("gold.volume_1m", source.mapInArrow(counted, table.ddl), newer_than=("volume_1m",))
    assert seen.value == 2
    assert [r.volume_1m for r in lake.read("gold.volume_1m").collect()] == [2.0]
    assert not lake._children(f"{lake.path('gold.volume_1m')}/_staged")
