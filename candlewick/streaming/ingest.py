"""Landed message files to bronze tables, as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from candlewick.operators.payloads import LIVE_SOURCE, klines_of, parse_market, quarantine_of, trades_of
from candlewick.operators.silver import NEWEST, silver_klines, silver_trades
from candlewick.sinks.lake import Store


def message_stream(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    """New message files of a folder; ``files_per_trigger`` bounds one micro-batch."""
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(path)
    return lines.select(F.col("value").alias("raw_payload"))


def stream_ingest(
    messages: DataFrame,
    lake: Store,
    checkpoint: str,
    source: str = LIVE_SOURCE,
    klines: bool = True,
    write_silver: bool = False,
    name: str = "live_ingest",
    compact_every: int = 50,
) -> DataStreamWriter:
    """Parse each micro-batch once and append trades, candles and unusable messages.

    A batch that is replayed after a crash is recognised by its id, so nothing lands twice.
    ``klines=False`` keeps only trades. ``write_silver`` also merges the batch into silver. Every
    ``compact_every`` batches the many small directories of a date are joined, where the store has such.
    """
    landed = ["bronze.trades_live_raw", "bronze.quarantine", *(["bronze.klines_live_raw"] if klines else [])]

    def land(batch: DataFrame, batch_id: int) -> None:
        # The three tables read one parsed batch; losing a cached block only re-reads its files.
        parsed = parse_market(batch, source).persist()
        try:
            lake.append("bronze.trades_live_raw", trades_of(parsed), (name, batch_id))
            if klines:
                lake.append("bronze.klines_live_raw", klines_of(parsed), (name, batch_id))
            lake.append("bronze.quarantine", quarantine_of(parsed), (name, batch_id))
            if write_silver:
                lake.upsert("silver.trades", silver_trades(trades_of(parsed)), newer_than=NEWEST)
                if klines:
                    lake.upsert("silver.klines_1m", silver_klines(klines_of(parsed)), newer_than=NEWEST)
        finally:
            parsed.unpersist()
        if (batch_id + 1) % compact_every == 0 and hasattr(lake, "compact"):
            for table in landed:
                lake.compact(table)

    return messages.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
