from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.fixtures import at

from candlewick.operators.merging import merge_into_table, merge_rows
from candlewick.schemas import TABLES, create_tables, table_schemas
from candlewick.sinks.lake import CommitConflict, Lake
from candlewick.sources import datasets

DAY = 86_400


def volume(spark, *rows):
    """Rows of (symbol, day number, volume)."""
    return spark.createDataFrame([(s, at(d * DAY), float(v), 0.0, 1) for s, d, v in rows], TABLES["gold.volume_1m"].ddl)


def trades(spark, *rows):
    """Rows of (symbol, trade id, price, day of the trade, event second)."""
    ddl = "symbol string, trade_id bigint, price double, trade_time timestamp, event_time timestamp, ingested_at timestamp"
    df = spark.createDataFrame([(s, i, float(p), at(d * DAY), at(e), at(e)) for s, i, p, d, e in rows], ddl)
    return TABLES["silver.trades"].conform(df)


def volumes(lake):
    return {(r.symbol, r.window_start.day): r.volume_1m for r in lake.read("gold.volume_1m").collect()}


def prices(lake):
    return sorted((r.symbol, r.trade_id, r.price) for r in lake.read("silver.trades").collect())


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


def test_missing_table_reads_empty(lake):
    assert not lake.exists("gold.volume_1m")
    assert lake.read("gold.volume_1m").count() == 0
    assert lake.optional("gold.volume_1m") is None


def test_upsert_creates_updates_and_inserts(spark, lake):
    assert lake.upsert("gold.volume_1m", volume(spark, ("A", 0, 1), ("B", 1, 2))) == "created"
    assert lake.upsert("gold.volume_1m", volume(spark, ("B", 1, 9), ("C", 2, 3))) == "merged"
    assert volumes(lake) == {("A", 24): 1.0, ("B", 25): 9.0, ("C", 26): 3.0}
    again = lake.upsert("gold.volume_1m", volume(spark, ("B", 1, 9), ("C", 2, 3)))
    assert again == "merged"
    assert volumes(lake) == {("A", 24): 1.0, ("B", 25): 9.0, ("C", 26): 3.0}


def test_upsert_rewrites_only_touched_dates(spark, lake):
    lake.upsert("gold.volume_1m", volume(spark, ("A", 0, 1), ("B", 1, 2)))
    before = set(lake.current("gold.volume_1m")["directories"])
    lake.upsert("gold.volume_1m", volume(spark, ("B", 1, 9)))
    after = set(lake.current("gold.volume_1m")["directories"])
    (kept,) = before & after
    assert kept.endswith("2024-03-24")


def test_reading_chosen_dates(spark, lake):
    lake.overwrite("gold.volume_1m", volume(spark, ("A", 0, 1), ("B", 1, 2), ("C", 2, 3)))
    assert {r.symbol for r in lake.read("gold.volume_1m", ["2024-03-25", "2024-03-26"]).collect()} == {"B", "C"}


def test_a_key_that_moves_to_another_date_is_not_doubled(spark, lake):
    lake.upsert("silver.trades", trades(spark, ("A", 1, 1, 0, 0), ("A", 2, 2, 1, 0)))
    lake.upsert("silver.trades", trades(spark, ("A", 1, 5, 3, 9)))
    assert prices(lake) == [("A", 1, 5.0), ("A", 2, 2.0)]


def test_the_last_batch_wins_unless_guarded(spark, lake):
    newer, older = trades(spark, ("A", 1, 2, 0, 50)), trades(spark, ("A", 1, 1, 0, 10))
    lake.upsert("silver.trades", newer)
    lake.upsert("silver.trades", older, newer_than=("event_time", "ingested_at"))
    assert prices(lake) == [("A", 1, 2.0)]
    lake.upsert("silver.trades", older)
    assert prices(lake) == [("A", 1, 1.0)]


def test_an_arriving_tie_replaces_the_stored_row(spark, lake):
    lake.upsert("silver.trades", trades(spark, ("A", 1, 7, 0, 10)))
    lake.upsert("silver.trades", trades(spark, ("A", 1, 3, 0, 10)), newer_than=("event_time", "ingested_at"))
    assert prices(lake) == [("A", 1, 3.0)]


def test_delete_unmatched_replaces_the_table(spark, lake):
    lake.upsert("gold.volume_1m", volume(spark, ("A", 0, 1), ("B", 1, 2)))
    lake.upsert("gold.volume_1m", volume(spark, ("B", 1, 3)), delete_unmatched=True)
    assert volumes(lake) == {("B", 25): 3.0}


def test_null_keys_match(spark):
    ddl = "k string, v int"
    merged = merge_rows(spark.createDataFrame([(None, 1), ("a", 2)], ddl), spark.createDataFrame([(None, 9)], ddl), ["k"])
    assert sorted((r.v for r in merged.collect())) == [2, 9]
    with pytest.raises(ValueError):
        merge_rows(merged, merged, [])


def test_null_dates_are_kept(spark, lake):
    row = trades(spark, ("A", 1, 1, 0, 0)).withColumn("trade_time", F.lit(None).cast("timestamp"))
    lake.append("silver.trades", row)
    lake.upsert("silver.trades", row.withColumn("price", F.lit(4.0)))
    assert prices(lake) == [("A", 1, 4.0)]


def test_append_and_replayed_stream_batch(spark, lake):
    rows = volume(spark, ("A", 0, 1))
    assert lake.append("gold.volume_1m", rows, ("stream", 0)) == "append"
    assert lake.append("gold.volume_1m", rows, ("stream", 0)) == "replayed"
    assert lake.append("gold.volume_1m", rows, ("stream", 1)) == "append"
    assert lake.read("gold.volume_1m").count() == 2


def test_only_directories_with_newer_arrivals_are_opened(spark, lake):
    lake.append("silver.trades", trades(spark, ("A", 1, 1, 0, 10), ("A", 2, 1, 1, 500)))
    lake.append("silver.trades", trades(spark, ("A", 3, 1, 0, 900)))
    ids = lambda second: sorted(r.trade_id for r in lake.read("silver.trades", arrived_after=at(second)).collect())
    assert ids(0) == [1, 2, 3]
    assert ids(10) == [2, 3]
    assert ids(600) == [3]
    assert ids(900) == []
    assert lake.read("silver.trades", from_date="2024-03-25").count() == 1


def test_compaction_keeps_rows_and_arrivals(spark, lake):
    for i in range(4):
        lake.append("silver.trades", trades(spark, ("A", i, i, 0, i)), ("stream", i))
    lake.append("silver.trades", trades(spark, ("B", 9, 9, 1, 9)))
    assert lake.compact("silver.trades", more_than=4) == 0
    assert lake.compact("silver.trades", more_than=3) == 1
    assert len(lake.current("silver.trades")["directories"]) == 2
    assert len(prices(lake)) == 5
    assert lake.append("silver.trades", trades(spark, ("A", 3, 3, 0, 3)), ("stream", 3)) == "replayed"
    assert lake.read("silver.trades", arrived_after=at(3)).count() == 1


def test_readers_keep_their_commit(spark, lake):
    lake.overwrite("gold.volume_1m", volume(spark, ("A", 0, 1)))
    seen = lake.read("gold.volume_1m")
    lake.overwrite("gold.volume_1m", volume(spark, ("A", 0, 2)))
    assert seen.first().volume_1m == 1.0
    assert volumes(lake) == {("A", 24): 2.0}


def test_second_writer_of_a_commit_fails(spark, lake):
    lake.overwrite("gold.volume_1m", volume(spark, ("A", 0, 1)))
    base = lake._base("gold.volume_1m")
    lake.append("gold.volume_1m", volume(spark, ("B", 0, 1)))
    with pytest.raises(CommitConflict):
        lake._commit("gold.volume_1m", base, {}, {})


def test_a_cut_off_commit_file_is_ignored_by_readers_and_held_by_writers(spark, lake, tmp_path):
    lake.overwrite("gold.volume_1m", volume(spark, ("A", 0, 1)))
    torn = tmp_path / "lake" / "gold" / "volume_1m" / "_commits" / f"{2:012d}.json"
    torn.write_text('{"direct')
    assert volumes(lake) == {("A", 24): 1.0}
    with pytest.raises(CommitConflict):
        lake.append("gold.volume_1m", volume(spark, ("B", 0, 1)))
    import os

    os.utime(torn, (0, 0))
    lake.append("gold.volume_1m", volume(spark, ("B", 0, 1)))
    assert len(volumes(lake)) == 2


def test_expire_removes_only_unused_directories(spark, lake):
    lake.upsert("gold.volume_1m", volume(spark, ("A", 0, 1), ("B", 1, 2)))
    for value in (3, 4):
        lake.upsert("gold.volume_1m", volume(spark, ("B", 1, value)))
    assert lake.expire("gold.volume_1m", keep=1) == 0
    assert lake.expire("gold.volume_1m", keep=1, min_age_hours=0) == 2
    assert volumes(lake) == {("A", 24): 1.0, ("B", 25): 4.0}
    assert lake.expire("gold.volume_1m", keep=1, min_age_hours=0) == 0


def test_every_table_round_trips(spark, lake):
    for name, table in TABLES.items():
        lake.overwrite(name, table.empty(spark))
        assert lake.read(name).dtypes == table.empty(spark).dtypes


def test_catalog_tables(spark):
    assert len(create_tables(spark)) == len(TABLES)
    for name, table in TABLES.items():
        assert spark.table(name).dtypes == table.empty(spark).dtypes
    assert table_schemas(spark).where("is_key").count() == sum(len(t.keys) for t in TABLES.values())
    assert datasets.Target("gold.latest_price").exists(spark)
    assert not datasets.Target("gold.nothing").exists(spark)
    # Parquet tables take no row-level merge; the engine says so instead of losing rows.
    with pytest.raises(PySparkException):
        merge_into_table(TABLES["gold.latest_price"].empty(spark), "gold.latest_price", ["symbol"])


def test_datasets_by_path(spark, tmp_path):
    target = datasets.Target(path=str(tmp_path / "data"))
    assert not target.exists(spark)
    assert target.read_or_empty(spark, "gold.volume_1m").count() == 0
    target.write(volume(spark, ("A", 0, 1)), "append")
    target.write(volume(spark, ("A", 0, 2)), "append")
    assert target.read_or_empty(spark, "gold.volume_1m").count() == 2
    for call in (datasets.Target().read, datasets.Target().exists):
        with pytest.raises(ValueError):
            call(spark)


def test_source_choice():
    choice = dict(schemas={"gold": "g"}, tables={"gold": {"latest_price": "lp"}}, catalog="c")
    assert datasets.choose_source("gold", "latest_price", "/b/", registered=True, **choice) == datasets.Target("c.g.lp", "/b/gold/latest_price")
    assert datasets.choose_source("gold", "latest_price", "/b", **choice) == datasets.Target(None, "/b/gold/latest_price")
    assert datasets.choose_source("gold", "other", None, registered=True, **choice) == datasets.Target()
