from __future__ import annotations

import json

import pytest

from tests.fixtures import TRADES, at, live_messages, trade_event

from candlewick.operators import gold, silver
from candlewick.schemas import TABLES
from candlewick.sinks.lake import Lake
from candlewick.streaming.ingest import message_stream, stream_ingest
from candlewick.streaming.silver import stream_silver
from candlewick.streaming import volume
from candlewick.streaming.volume import late_trades, stream_volume_1m, stream_volume_updates


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


def run(writer):
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    assert query.exception() is None


def land(folder, name, messages):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(m if isinstance(m, str) else json.dumps(m) for m in messages))


def test_ingest_resumes_and_never_doubles(spark, lake, tmp_path):
    landing, checkpoint = tmp_path / "landing", str(tmp_path / "checkpoint")
    land(landing, "1.txt", [*live_messages(), "garbage"])
    ingest = lambda: stream_ingest(message_stream(spark, str(landing), 1), lake, checkpoint, write_silver=True)
    run(ingest())
    run(ingest())
    counts = lambda: [lake.read(t).count() for t in (
        "bronze.trades_live_raw", "bronze.klines_live_raw", "bronze.quarantine", "silver.trades", "silver.klines_1m")]
    assert counts() == [2, 3, 1, 2, 2]
    land(landing, "2.txt", [trade_event(*row) for row in TRADES])
    run(ingest())
    assert counts() == [8, 3, 1, 5, 2]


def test_trade_only_ingest(spark, lake, tmp_path):
    land(tmp_path / "landing", "1.txt", live_messages())
    stream = message_stream(spark, str(tmp_path / "landing"))
    run(stream_ingest(stream, lake, str(tmp_path / "checkpoint"), klines=False))
    assert lake.read("bronze.trades_live_raw").count() == 2
    assert not lake.exists("bronze.klines_live_raw")


def test_streamed_silver_equals_batch(spark, lake, tmp_path):
    from tests.test_incremental import BRONZE, deliveries

    rows = deliveries(5)
    table = TABLES["bronze.trades_live_raw"]
    folder = tmp_path / "bronze"
    for i in range(0, len(rows), 50):
        table.conform(spark.createDataFrame(rows[i : i + 50], BRONZE)).coalesce(1).write.mode("append").parquet(str(folder))
    stream = spark.readStream.schema(table.empty(spark).schema).option("maxFilesPerTrigger", 1).parquet(str(folder))
    run(stream_silver(stream, lake, str(tmp_path / "checkpoint")))
    expected = silver.silver_trades(table.conform(spark.createDataFrame(rows, BRONZE)))
    key = lambda df: sorted((r.symbol, r.trade_id, r.price, r.event_time) for r in df.collect())
    assert key(lake.read("silver.trades")) == key(expected)


def test_streamed_volume_equals_batch_on_closed_minutes(spark, tmp_path):
    ddl = "symbol string, trade_id bigint, quantity double, notional double, trade_time timestamp"
    trades = [("A", i, 1.0, 2.0, at(i * 20)) for i in range(40)]
    folder = tmp_path / "trades"
    for i in range(0, 40, 10):
        # Each file repeats its first trade; a redelivery inside the lateness counts once.
        part = trades[i : i + 10] + trades[i : i + 1]
        spark.createDataFrame(part, ddl).coalesce(1).write.mode("append").parquet(str(folder))
    stream = spark.readStream.schema(ddl).option("maxFilesPerTrigger", 1).parquet(str(folder))
    out = str(tmp_path / "out")
    writer = stream_volume_1m(stream).writeStream.format("parquet").option("path", out)
    run(writer.option("checkpointLocation", str(tmp_path / "checkpoint")))
    found = {r.window_start: (r.volume_1m, r.trade_count) for r in spark.read.parquet(out).collect()}
    batch = gold.volume_1m(spark.createDataFrame(trades, ddl)).collect()
    expected = {r.window_start: (r.volume_1m, r.trade_count) for r in batch}
    closed = at(39 * 20 - 120).replace(tzinfo=None)
    assert found == {w: v for w, v in expected.items() if (closed - w).total_seconds() >= 60}
    assert len(found) >= 8


def test_late_trades_are_left_out(spark, tmp_path):
    ddl = "symbol string, trade_id bigint, quantity double, notional double, trade_time timestamp"
    folder = tmp_path / "trades"
    for part in ([("A", 1, 1.0, 1.0, at(0))], [("A", 2, 1.0, 1.0, at(3600))], [("A", 3, 1.0, 1.0, at(3660))],
                 [("A", 4, 7.0, 7.0, at(1))], [("A", 5, 1.0, 1.0, at(9000))]):
        spark.createDataFrame(part, ddl).coalesce(1).write.mode("append").parquet(str(folder))
    stream = spark.readStream.schema(ddl).option("maxFilesPerTrigger", 1).parquet(str(folder))
    out = str(tmp_path / "out")
    run(stream_volume_1m(stream).writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "c")))
    rows = spark.read.parquet(out).orderBy("window_start").collect()
    assert [r.volume_1m for r in rows] == [1.0, 1.0, 1.0]


def test_late_trades_are_counted_and_repaired(spark, lake, tmp_path, monkeypatch):
    """Ordered files with late, corrected, moved and repeated trades end equal to the batch table."""
    ddl = "symbol string, trade_id bigint, price double, quantity double, trade_time timestamp, event_time timestamp, ingested_at timestamp, notional double"
    row = lambda name, quantity, second, arrival, event=None: (
        "A", name, 1.0, quantity, at(second), at(second if event is None else event), at(arrival), quantity)
    files = [
        [row(1, 1.0, 0, 10), row(2, 2.0, 30, 40), row(3, 3.0, 70, 80)],
        [row(4, 4.0, 3600, 3601), row(5, 5.0, 3661, 3662)],
        [row(6, 6.0, 10, 3700), row(5, 5.0, 3661, 3662), row(7, 7.0, 3650, 3701)],  # one far behind, one repeat, one in time
        [row(3, 3.5, 71, 3800, 90), row(1, 1.0, 90_000, 3801, 95)],  # a late correction, and a trade that moves to the next day
        [row(3, 9.0, 70, 80)],  # an old delivery again: the newer stored one stays
    ]
    trades = TABLES["silver.trades"]
    folder, out = tmp_path / "trades", str(tmp_path / "checkpoint")
    seen = []
    for part in files:
        trades.conform(spark.createDataFrame(part, ddl)).coalesce(1).write.mode("append").parquet(str(folder))
        stream = spark.readStream.schema(trades.empty(spark).schema).parquet(str(folder))
        run(stream_volume_updates(stream, lake, out))
        seen += part
        newest = silver.newest_trades(trades.conform(spark.createDataFrame(seen, ddl)))
        key = lambda df: sorted(tuple(str(v) for v in r) for r in df.collect())
        assert key(lake.read("gold.volume_1m")) == key(gold.volume_1m(newest))
    # Behind the newest earlier trade less two minutes: 6; 3 corrected; 3 again. The trade that moved is not.
    assert late_trades(lake) == {"rows": 11, "late_rows": 3}
    # A batch that is replayed after a crash counts once.
    volume._count(lake, "stream_volume_1m", 4, {"rows": 1, "late": 1, "newest": 0}, None)
    assert late_trades(lake) == {"rows": 11, "late_rows": 3}
    assert late_trades(lake, "another") == {"rows": 0, "late_rows": 0}
