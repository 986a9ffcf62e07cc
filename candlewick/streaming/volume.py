"""One-minute volume of a stream: closed minutes as a windowed aggregate, or running totals that late trades repair."""

from __future__ import annotations

import json
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from candlewick.functions.time import utc_date
from candlewick.operators.gold import minute_of
from candlewick.operators.silver import NEWEST, newest_trades
from candlewick.plans.gold_build import volume_update
from candlewick.plans.state import State, last_watermarks, load_state, save_state
from candlewick.schemas import TABLES
from candlewick.sinks.lake import Store
from candlewick.sinks.workspace import drop_folder, new_folder

LATENESS = "2 minutes"
TRADES, VOLUME = "silver.trades", "gold.volume_1m"


def stream_volume_1m(trades: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Volume, notional and count per symbol and minute of a stream of silver-shaped trades.

    Redeliveries inside the lateness are dropped; a minute is emitted once, after the watermark
    passes its end. State is bounded by the lateness, not by the length of the stream. Later rows are dropped: see
    ``stream_volume_updates`` where they must count.
    """
    fresh = trades.withWatermark("trade_time", lateness).dropDuplicatesWithinWatermark(["symbol", "trade_id"])
    minutes = fresh.groupBy("symbol", F.window("trade_time", "1 minute").alias("minute")).agg(
        F.round(F.sum("quantity"), 8).alias("volume_1m"),
        F.round(F.sum("notional"), 8).alias("notional_1m"),
        F.count(F.lit(1)).cast("int").alias("trade_count"),
    )
    return minutes.select(
        "symbol", F.col("minute.start").alias("window_start"), "volume_1m", "notional_1m", "trade_count"
    ).select(*TABLES[VOLUME].columns)


def stream_volume_updates(
    trades: DataFrame, lake: Store, checkpoint: str, lateness: timedelta = timedelta(minutes=2), name: str = "stream_volume_1m"
) -> DataStreamWriter:
    """Merge each micro-batch of silver-shaped trades and the new totals of its minutes into the store.

    After every batch the volume table equals the batch table of all trades so far: a minute with a new, late, corrected or
    moved trade is computed again from its stored trades, of which only the touched dates and minutes are read; a minute
    that lost its last trade goes. There is no state to outgrow memory. Trades behind the watermark (newest trade of the
    earlier batches less ``lateness``) are counted while the batch is read and kept with the stream's state, see
    ``late_trades``. A replayed batch changes nothing and is counted once.
    """

    def land(batch: DataFrame, batch_id: int) -> None:
        before = last_watermarks(lake, name).get("trades")
        batch = TABLES[TRADES].conform(batch)
        late = F.col("trade_time") <= F.lit(before - lateness) if before else F.lit(False)
        seen = Observation()
        fresh = newest_trades(batch).observe(
            seen, F.count(F.lit(1)).alias("rows"), F.count_if(late).alias("late"), F.max(F.unix_micros("trade_time")).alias("newest"),
            F.min(F.unix_micros("ingested_at")).alias("arrived"),
        )
        if batch.isEmpty():
            return
        folder = new_folder(lake.spark, "minutes")
        # Before the merge, from the batch's own narrow columns: its rows are deduplicated once, on their way into the table.
        batch.select("symbol", minute_of("trade_time").alias("window_start")).distinct().write.parquet(folder)
        try:
            lake.upsert(TRADES, fresh, newer_than=NEWEST)
            renew(lake.spark.read.schema("symbol string, window_start timestamp").parquet(folder), seen.get)
            _count(lake, name, batch_id, seen.get, before)
        finally:
            drop_folder(lake.spark, folder)

    def renew(touched: DataFrame, found: dict) -> None:
        # A trade that a redelivery moved leaves the minute it was in.
        since = _moment(found["arrived"]) - timedelta(microseconds=1) if found["arrived"] is not None else None
        left = lake.moved(TRADES, since).select("symbol", minute_of("trade_time").alias("window_start"))
        minutes = touched.unionByName(left).distinct()
        spans = minutes.groupBy(utc_date("window_start").alias("day")).agg(
            F.min(F.unix_micros("window_start")).alias("first"), F.max(F.unix_micros("window_start")).alias("last")
        ).collect()
        days, first, last = [s.day for s in spans], min(s.first for s in spans), max(s.last for s in spans)
        inside = (F.col("trade_time") >= F.lit(_moment(first))) & (F.col("trade_time") < F.lit(_moment(last) + timedelta(minutes=1)))
        totals = volume_update(minutes.withColumn("trade_time", F.col("window_start")), lake.read(TRADES, days).where(inside))
        others = lake.read(VOLUME, days).join(minutes, ["symbol", "window_start"], "left_anti")
        lake.replace_dates(VOLUME, others.unionByName(totals), days)

    return trades.writeStream.outputMode("update").foreachBatch(land).option("checkpointLocation", checkpoint)


def _moment(micros: int) -> datetime:
    return datetime.fromtimestamp(0, timezone.utc) + timedelta(microseconds=micros)


def _stored(lake: Store, name: str) -> dict:
    row = load_state(lake, name).select("metadata_json").first()
    return json.loads(row[0]) if row else {"batch": -1, "rows": 0, "late_rows": 0}


def _count(lake: Store, name: str, batch_id: int, found: dict, before: datetime | None) -> None:
    counts = _stored(lake, name)
    if batch_id <= counts["batch"]:
        return
    newest = _moment(found["newest"])
    sums = {"batch": batch_id, "rows": counts["rows"] + found["rows"], "late_rows": counts["late_rows"] + found["late"]}
    save_state(lake, [State(name, "trades", "silver", "gold", max(newest, before) if before else newest, sums, "trade_time")])


def late_trades(lake: Store, name: str = "stream_volume_1m") -> dict[str, int]:
    """``rows`` that the stream has taken and ``late_rows`` among them, which lay behind its watermark."""
    counts = _stored(lake, name)
    return {"rows": counts["rows"], "late_rows": counts["late_rows"]}
