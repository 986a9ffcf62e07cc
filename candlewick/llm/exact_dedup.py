"""Exact deduplication by a tree-merge of sorted digest runs."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.tables import whole, written

#: A level merges 2**BITS runs.
BITS = 3
_NO_ID = np.iinfo(np.int64).min

RUN = "digest string, n_bytes long, mark long, keep_id long, group_size long, repeats long"
_RUN = pa.schema([("digest", pa.string()), *((name, pa.int64()) for name in ("n_bytes", "mark", "keep_id", "group_size", "repeats"))])


def _merge(keep: str):
    """Merges sorted rows of one digest to one, over batch borders too; ``keep`` is ``largest`` or ``smallest``."""

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch]).cast(_RUN)
            rows = _adjacent(pa.concat_tables([held, rows]) if held is not None else rows, keep)
            held = rows.slice(rows.num_rows - 1)
            yield from rows.slice(0, rows.num_rows - 1).to_batches()
        if held is not None:
            yield from held.to_batches()

    return merged


def _adjacent(rows: pa.Table, keep: str) -> pa.Table:
    rows = rows.combine_chunks()
    same = np.ones(rows.num_rows - 1, bool)
    # Equal digests are one text only if length and second hash agree.
    for name in ("digest", "n_bytes", "mark"):
        column = rows.column(name)
        same &= pc.equal(column.slice(1), column.slice(0, rows.num_rows - 1)).to_numpy(zero_copy_only=False)
    starts = np.flatnonzero(np.concatenate(([True], ~same)))
    # Any id goes before none.
    none = _NO_ID if keep == "largest" else np.iinfo(np.int64).max
    ids = rows.column("keep_id").fill_null(none).to_numpy()
    repeats = rows.column("repeats").to_numpy()
    best = (np.maximum if keep == "largest" else np.minimum).reduceat(ids, starts)
    here = ids == np.repeat(best, np.diff(np.append(starts, len(ids))))
    first = rows.take(pa.array(starts))
    out = {
        "keep_id": pa.array(best, mask=best == none),
        "group_size": pa.array(np.add.reduceat(rows.column("group_size").to_numpy(), starts)),
        "repeats": pa.array(np.add.reduceat(np.where(here, repeats, 0), starts)),
    }
    return pa.table({name: out.get(name, first.column(name)) for name in rows.column_names}, schema=_RUN)


def digest_rows(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Id, SHA-256 of the text (null as empty), its length in bytes and a second hash."""
    body = whole(text)
    return docs.select(
        F.col(key).cast("long").alias("doc_id"), F.sha2(body, 256).alias("digest"),
        F.octet_length(body).cast("long").alias("n_bytes"), F.xxhash64(body).alias("mark"),
    )


def merged_runs(rows: DataFrame, keep: str = "largest", bits: int = BITS, levels: int | None = None) -> DataFrame:
    """One row for each digest, from the tree of merges: ``keep_id``, ``group_size``, ``repeats`` (rows with that id).

    Every partition first sorts and merges its own rows to one run. At each level partitions whose numbers differ
    only in the level's bits exchange parts of their runs: each gets the digests whose hash has its number in these
    bits, and merges what the others send. After the last level a digest is in one partition alone. Copies shrink
    to one row before every exchange, so a group of any size sends at most one row from each partition. There are as
    many levels as ``spark.sql.shuffle.partitions`` asks for, unless their number is given.
    """
    levels = levels or max(1, math.ceil(math.log2(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))) / bits))
    count, fan = 1 << (bits * levels), 1 << bits
    order = ("digest", "n_bytes", "mark")
    run = rows.select(
        *order, F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(1).cast("long").alias("repeats")
    ).sortWithinPartitions(*order).mapInArrow(_merge(keep), RUN)
    place = F.pmod(F.spark_partition_id(), F.lit(count))
    goal = F.pmod(F.xxhash64("digest"), F.lit(count)).cast("int")
    for level in range(levels):
        low = bits * level
        own, wanted = place.bitwiseAND(F.lit((count - 1) ^ ((fan - 1) << low))), goal.bitwiseAND(F.lit((fan - 1) << low))
        sent = run.withColumn("place", own.bitwiseOR(wanted)).repartitionById(count, F.col("place"))
        run = sent.drop("place").sortWithinPartitions(*order).mapInArrow(_merge(keep), RUN)
        place = F.spark_partition_id()
    return run


def exact_duplicates(
    docs: DataFrame, keep: str = "largest", key: str = "doc_id", text: str = "text", bits: int = BITS, levels: int | None = None
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``, ``repeats``.

    Texts are equal when they are the same bytes; null counts as empty, so empty texts are one group. Of a group the
    row with the largest (or smallest) id stays; any id goes before a null one, and a group of null ids has a null
    ``keep_id``. Rows that repeat id and text are one document: all are marked kept, and ``repeats`` tells their
    number. An empty table gives no row; other columns are not read. Digests are written once to the shared folder.
    """
    rows = written(digest_rows(docs, key, text), "digests")
    groups = merged_runs(rows, keep, bits, levels)
    joined = rows.join(groups, ["digest", "n_bytes", "mark"])
    return joined.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"), "repeats",
    )


def drop_copies(docs: DataFrame, keep: str = "largest", key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without copies: one row of each group of equal texts, all columns."""
    found = written(exact_duplicates(docs, keep, key, text), "exact-groups")
    gone = found.filter(~F.col("kept")).select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_digest")).distinct()
    digest = F.sha2(F.coalesce(docs[text], F.lit("")), 256)
    left = docs.join(gone, docs[key].eqNullSafe(gone["_id"]) & (digest == gone["_digest"]), "left_anti")
    if found.filter("kept and repeats > 1").isEmpty():
        return left
    # A null text and an empty one are equal, so the digest tells rows apart, under a name that no column has.
    name = max(docs.columns, key=len) + "_digest"
    return left.withColumn(name, F.sha2(whole(text), 256)).dropDuplicates([key, name]).drop(name)
