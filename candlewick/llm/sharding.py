"""Shuffled shards by a two-pass external shuffle."""

from __future__ import annotations



import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


#: Bytes of records that a worker shuffles in memory, and what a row counts beside its text.
BUCKET_BYTES, ROW_BYTES = 32 << 20, 16


def shard_of(key: Column, shards: int, seed: int = 0) -> Column:
    """The shard of a key among ``shards``; with one more shard, keys move only into the new one.

    Shard ``j`` takes over a key with chance 1/(j+1), by a hash of key and ``j``; the last that does so keeps it.
    """
    takes = lambda j: F.pmod(F.xxhash64(key, j + F.lit(seed)), j + F.lit(1)) == 0
    if shards == 1:
        return F.lit(0)
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(shards - 1)), F.lit(0), lambda last, j: F.when(takes(j), j).otherwise(last)
    )


def write_shards(
    docs: DataFrame, path: str, shards: int = 40, seed: int = 0, key: str = "doc_id", text: str = "text",
    bucket_bytes: int = BUCKET_BYTES,
) -> None:
    """Writes all rows, shuffled, as Parquet under ``path``, one folder for each shard.

    Law ``key``: id and shard count alone decide the shard. Pass one scatters the rows of each shard by seeded
    hashes into buckets of about ``bucket_bytes`` (as many as the shard's bytes need, so a crowded shard has more).
    Pass two shuffles each bucket by Fisher-Yates, from its rows in a fixed order, and writes it. Files hold
    ``record`` (the whole row), ``grown_shard`` (the shard if there were one more), ``bucket`` and ``position``;
    a shard's order is that of bucket and position. The same rows and seed give the same shards.

    Null ids go to one shard, null texts count no bytes, ties between equal rows need no order. Rows of equal id and
    text share a bucket as long as they fit in one; a larger group is dealt over as many as it needs. An empty table
    gives one file without rows, so that it can be read. Columns of any name may be present.
    """
    record = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(
        record.alias("record"), shard_of(F.col(key), shards, seed).alias("shard"),
        shard_of(F.col(key), shards + 1, seed).alias("grown_shard"), F.col(key).alias("key"),
        F.xxhash64(key, text).alias("mark"), (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).alias("size"),
    )
    groups = rows.groupBy("shard", "mark").agg(F.sum("size").alias("size"))
    large = F.collect_list(F.when(F.col("size") > bucket_bytes, F.struct("mark", "size")))
    found = groups.groupBy("shard").agg(F.sum("size").alias("size"), large.alias("large")).collect()  # a row for each shard
    if not found:
        empty = f"record {docs.schema.simpleString()}, grown_shard int, bucket int, position long, shard int"
        docs.sparkSession.createDataFrame([], empty).write.parquet(path)
        return
    sizes = {r.shard: r.size for r in found}
    salts = [(r.shard, g.mark, -(-g.size // bucket_bytes)) for r in found for g in r.large]
    rows = _salted(rows, salts, docs)
    buckets = F.array(*[F.lit(max(1, -(-(sizes.get(s) or 0) // bucket_bytes))) for s in range(shards)])
    scattered = rows.withColumn(
        "bucket", F.pmod(F.xxhash64("mark", F.lit(seed + 1)) + F.col("salt"), F.element_at(buckets, F.col("shard") + 1)).cast("int")
    )

    def shuffled(name: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.take(pc.sort_indices(rows, sort_keys=[("key", "ascending"), ("mark", "ascending")]))
        order = np.arange(rows.num_rows)
        np.random.default_rng([seed, *(n.as_py() for n in name)]).shuffle(order)  # Fisher-Yates
        position = np.empty(rows.num_rows, np.int64)
        position[order] = np.arange(rows.num_rows)
        rows = rows.append_column("position", pa.array(position)).take(pa.array(order))
        return rows.select(["record", "shard", "grown_shard", "bucket", "position"])

    out = scattered.select("record", "shard", "grown_shard", "key", "mark", "bucket").groupBy("shard", "bucket").applyInArrow(
        shuffled, f"record {docs.schema.simpleString()}, shard int, grown_shard int, bucket int, position long"
    )
    out.sortWithinPartitions("shard", "bucket", "position").write.partitionBy("shard").parquet(path)


def _salted(rows: DataFrame, salts: list[tuple[int, int, int]], docs: DataFrame) -> DataFrame:
    """Adds ``salt`` to rows: 0, or for groups larger than a bucket (shard, mark, salts) one of as many numbers.

    Equal rows of these groups are counted first and come back in equal shares, a share for each number, so neither the
    order nor the partitions of the rows decide who gets which; rows that differ elsewhere start at another number.
    """
    if not salts:
        return rows.withColumn("salt", F.lit(0))
    large = F.broadcast(rows.sparkSession.createDataFrame(salts, "shard int, mark long, salts int"))
    small = rows.join(large, ["shard", "mark"], "left_anti").withColumn("salt", F.lit(0))
    hashed = [F.col(f"record.`{f.name}`") for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    once = rows.join(large, ["shard", "mark"]).groupBy(*rows.columns, "salts").agg(F.count("*").alias("n"))
    shares = once.withColumn("share", F.explode(F.sequence(F.lit(0), F.least(F.col("n").cast("int"), F.col("salts")) - 1)))
    shares = shares.withColumns({
        "salt": F.pmod(F.xxhash64(*hashed) + F.col("share"), F.col("salts")).cast("int"),
        "n": F.floor(F.col("n") / F.col("salts")) + (F.col("share") < F.col("n") % F.col("salts")).cast("int"),
    }).repartition("shard", "mark", "share", "salt")
    copies = shares.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    return small.unionByName(copies.select(*small.columns))


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """Rows of written shards with ``slot``, their place in the shard."""
    return with_slots(spark.read.parquet(path))


def with_slots(rows: DataFrame) -> DataFrame:
    """Adds ``slot`` to rows that have ``shard``, ``bucket`` and ``position``; drop wide columns before, if not needed."""
    counts = rows.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return rows.join(starts, ["shard", "bucket"]).withColumn("slot", F.col("before") + F.col("position")).drop("before")


def digests(rows: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Law, shard and slot of written rows, with size and checksum of their texts."""
    body = F.col(f"record.{text}")
    narrow = rows.select(
        F.col(f"record.{key}").alias("doc_id"),
        (F.coalesce(F.octet_length(body), F.lit(0)).cast("long") + ROW_BYTES).alias("size"),
        F.crc32(F.coalesce(body, F.lit(""))).alias("text_crc32"),
        F.lit("key").alias("law"), F.col("shard").cast("int").alias("shard"), F.col("grown_shard").cast("int").alias("grown_shard"),
        "bucket", "position",
    )
    return with_slots(narrow).drop("bucket", "position")
