"""Bronze streams to silver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from candlewick.operators.silver import NEWEST, silver_klines, silver_trades
from candlewick.sinks.lake import Store


def stream_silver(bronze: DataFrame, lake: Store, checkpoint: str, kind: str = "trades") -> DataStreamWriter:
    """Deduplicate each micro-batch and merge it by key.

    Newer stored rows stay, so the result does not depend on how the stream was cut into batches,
    and a replayed batch changes nothing.
    """
    build, table = {
        "trades": (silver_trades, "silver.trades"),
        "klines": (silver_klines, "silver.klines_1m"),
    }[kind]

    def merge(batch: DataFrame, batch_id: int) -> None:
        lake.upsert(table, build(batch), newer_than=NEWEST)

    return bronze.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
