"""Near-duplicates by minhash with tensored banding.

Every set of shingles gets two small collections of sketches, each sketch a hash of a few minhashes. A table key is a
pair of sketches, one from each collection: ``tables`` times ``tables`` keys come from ``2 * tables`` sketches. Sets
that share a key are candidates. Links are confirmed on the full sets.

Equal sets are one node from the start. Of the nodes that share a key all are first compared with one of them, the
pivot. Then only first sketches are left whose nodes still lie in several components; where they lie, pairs of nodes
from different components that share a key are compared by longer signatures, and what comes near the threshold on full
sets. These comparisons stay inside a task, which gives one link for each two components it joins. So no link between
components is passed over, and a large group of near copies costs a few rows for each of its nodes.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.components import components
from candlewick.llm.shingles import set_digest, shingles_of, sketcher
from candlewick.llm.tables import sliced, whole, written

#: Minhashes of a sketch; chance that a link of exactly the threshold has no common key.
ROWS, MISSED = 4, 1e-4
#: Minhashes of a long signature, and standard deviations below the threshold where a pair is given up.
SIGNATURE, DEVIATIONS = 512, 4.0
#: Nodes that one task compares with each other at once, and shingles that it then holds.
TILE, TILE_SHINGLES = 4096, 8_000_000
#: Rows of ids that are broadcast at most; more are joined by a shuffle.
BROADCAST_ROWS = 500_000


def tables_for(percent: int, rows: int = ROWS, missed: float = MISSED) -> int:
    """Sketches in each collection, so that a pair at the threshold shares a key with chance ``1 - missed``."""
    alike = (percent / 100) ** rows
    return math.ceil(math.log(missed / 2) / math.log(1 - alike)) if alike < 1 else 1


def sketches(docs: DataFrame, words: int, tables: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``mark`` (hash of the text), ``n_shingles``, ``node`` (digest of the set, null for an empty one), and
    both collections of sketches."""
    schema = pa.schema([
        ("doc_id", pa.int64()), ("mark", pa.int64()), ("n_shingles", pa.int64()), ("node", pa.binary()),
        ("first", pa.list_(pa.int64())), ("second", pa.list_(pa.int64())),
    ])

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = sketcher(tables, ROWS, 0)
        for batch in (part for batch in batches for part in sliced(batch)):
            rows = []
            for name, mark, body in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                shingles = shingles_of(body, words)
                if len(shingles):
                    keys = sketch(shingles)
                    rows.append((name, mark, len(shingles), set_digest(shingles), keys[:tables], keys[tables:]))
                else:
                    rows.append((name, mark, 0, None, None, None))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.xxhash64(whole(text)).alias("mark"), whole(text).alias("text"))
    return rows.mapInArrow(made, "doc_id long, mark long, n_shingles long, node binary, first array<long>, second array<long>")


def keyed(nodes: DataFrame, tables: int) -> DataFrame:
    """``key``, its ``table`` and ``node`` for all pairs of a first and a second sketch that any other node can share.

    A first sketch that only one node has makes no candidates, so its pairs are not formed.
    """
    firsts = nodes.select("node", F.posexplode("first").alias("i", "sketch"))
    shared = firsts.groupBy("sketch").agg(F.count("*").alias("n")).filter("n > 1").select("sketch")
    mine = firsts.join(shared, "sketch").groupBy("node").agg(F.collect_list(F.struct("i", "sketch")).alias("mine"))  # at most ``tables``
    pairs = nodes.select("node", "second").join(mine, "node").select("node", "second", F.explode("mine").alias("one"))
    pairs = pairs.select("node", "one", F.posexplode("second").alias("j", "other"))
    return pairs.select(F.xxhash64("one.sketch", "other").alias("key"), (F.col("one.i") * tables + F.col("j")).alias("table"), "node")


def buckets(keys: DataFrame) -> DataFrame:
    """``key``, ``table``, ``node``, ``pivot`` of keys with several nodes; of keys with the same nodes only that of the
    first table is kept."""
    mark = F.xxhash64("node")
    found = keys.groupBy("key").agg(
        F.count("*").alias("n"), F.min("node").alias("pivot"), F.min("table").alias("table"), F.bit_xor(mark).alias("mixed"),
        F.bit_xor(F.xxhash64(mark, F.lit(1))).alias("mixed_again"),
    ).filter("n > 1")
    once = found.groupBy("n", "pivot", "mixed", "mixed_again").agg(F.min_by("key", "table").alias("key"))
    return keys.join(once.select("key", "pivot"), "key")


def full_sets(docs: DataFrame, wanted: DataFrame, words: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``node``, its whole set as sorted ``shingles``, and a long ``signature``, for nodes given with a document id."""
    few = wanted.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), whole(text).alias("text"))
    ids = wanted.select(F.col("rep").alias("_id"), "node")
    rows = rows.join(F.broadcast(ids) if few else ids, F.col("doc_id").eqNullSafe(F.col("_id"))).select("node", "text")
    schema = pa.schema([("node", pa.binary()), ("shingles", pa.list_(pa.int64())), ("signature", pa.binary())])

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = sketcher(SIGNATURE // 2, 1, 1)
        for batch in batches:
            for part in sliced(batch):
                out = []
                for node, body in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    shingles = shingles_of(body, words)
                    if set_digest(shingles) == node:  # else the id stands at another text, too
                        out.append((node, shingles.view(np.int64), sketch(shingles).astype(np.uint8).tobytes()))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    made_rows = rows.mapInArrow(made, "node binary, shingles array<long>, signature binary")
    here = docs.select(F.col(key).cast("long").alias("doc_id"))
    again = here.join(F.broadcast(ids) if few else ids, F.col("doc_id").eqNullSafe(F.col("_id"))).groupBy("doc_id").agg(F.count("*").alias("n"))
    return written(made_rows if again.filter("n > 1").isEmpty() else made_rows.dropDuplicates(["node"]), "shingle-sets")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (``a``, ``b``) whose full sets are alike enough."""
    one = sets.select(F.col("node").alias("a"), F.col("shingles").alias("of_a"))
    other = sets.select(F.col("node").alias("b"), F.col("shingles").alias("of_b"))
    both = pairs.join(one, "a").join(other, "b").withColumn("common", F.size(F.array_intersect("of_a", "of_b")))
    union = F.size("of_a") + F.size("of_b") - F.col("common")
    return both.filter(F.col("common").cast("long") * 100 >= union.cast("long") * percent).select("a", "b")


def _tiles(rows: DataFrame, run: Callable[[pa.Table], Iterator[pa.RecordBatch]], ddl: str) -> DataFrame:
    """``run`` over each tile, ``sketch``, ``left``, ``right``, of a table."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            part = pa.Table.from_batches([batch])
            part = pa.concat_tables([held, part]).combine_chunks() if held is not None else part
            tiles = np.stack([part.column(c).to_numpy() for c in ("sketch", "left", "right")], axis=1)
            start = 0
            for stop in (np.flatnonzero((tiles[1:] != tiles[:-1]).any(axis=1)) + 1).tolist():
                yield from run(part.slice(start, stop - start))
                start = stop
            held = part.slice(start)
        if held is not None and held.num_rows:
            yield from run(held)

    dealt = rows.repartition("sketch", "left", "right").sortWithinPartitions("sketch", "left", "right", "node")
    return dealt.mapInArrow(each, ddl)


class _Tile:
    """Nodes with one first sketch in common, of one block or of two."""

    def __init__(self, rows: pa.Table, tables: int, least: int):
        self.least = least
        self.nodes = rows.column("node").to_pylist()
        labels = rows.column("label").to_pylist()
        numbers = {label: i for i, label in enumerate(dict.fromkeys(labels))}
        self.component = np.array([numbers[x] for x in labels])
        self.block, self.left = rows.column("block").to_numpy(), rows.column("left")[0].as_py()
        self.alone = self.left == rows.column("right")[0].as_py()
        self.table = rows.column("table")[0].as_py()
        self.marks = np.frombuffer(b"".join(rows.column("signature").to_pylist()), np.uint8).reshape(len(labels), SIGNATURE)
        self.first, self.second = (rows.column(c).combine_chunks().flatten().to_numpy().reshape(len(labels), tables) for c in ("first", "second"))

    def partners(self, i: int) -> np.ndarray:
        """Nodes of other components that share a key with node ``i``, first in this table, and may be alike."""
        if not self.alone and self.block[i] != self.left:
            return np.zeros(0, np.int64)
        others = np.flatnonzero((self.component != self.component[i]) & ((np.arange(len(self.nodes)) > i) if self.alone else (self.block != self.left)))
        others = others[np.argmax(self.first[others] == self.first[i], axis=1) == self.table] if len(others) else others
        others = others[(self.second[others] == self.second[i]).any(axis=1)] if len(others) else others
        return others[np.count_nonzero(self.marks[others] == self.marks[i], axis=1) >= self.least] if len(others) else others


def _between(labels: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int, tables: int) -> DataFrame:
    """Links between nodes of different components, enough to join all components that links join.

    Nodes with a first sketch in common make a bucket, where pairs with a second sketch in common are sought; a pair is
    looked at in the first table that it shares. A bucket of more than ``TILE`` nodes or ``TILE_SHINGLES`` shingles is cut into blocks, each pair of
    blocks being a tile. A tile first tells which nodes may have a partner, by long signatures; only their full sets are
    brought to it and compared there, and it gives one link for each two components that it joins. So the rows are as many
    as the nodes of its buckets, however many pairs a family of near copies has, up to ``TILE`` nodes.
    """
    limit = percent / 100 - DEVIATIONS * math.sqrt(percent / 100 * (1 - percent / 100) / SIGNATURE)
    least = math.floor(SIGNATURE * (limit + (1 - limit) / 256))
    placed = sets.select("node", F.size("shingles").alias("n")).join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    slots = placed.join(nodes.select("node", "first"), "node").select("node", "n", "label", F.posexplode("first").alias("table", "sketch"))
    blocks = F.ceil(F.greatest(F.count("*") / TILE, F.sum("n") / TILE_SHINGLES)).cast("int")
    alive = slots.groupBy("sketch").agg(F.min("label").alias("low"), F.max("label").alias("high"), blocks.alias("blocks")).filter("low < high")
    rows = slots.join(alive.select("sketch", "blocks"), "sketch")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select(
        "sketch", "table", F.least("block", "with").alias("left"), F.greatest("block", "with").alias("right"), "block", "node", "label"
    )
    short = lambda c: F.transform(c, lambda x: F.shiftright(x, 32).cast("int")).alias(c)
    rows = rows.join(sets.select("node", "signature"), "node").join(nodes.select("node", short("first"), short("second")), "node")

    def hopeful(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        tile = _Tile(rows, tables, least)
        chosen = np.zeros(len(tile.nodes), bool)
        for i in range(len(tile.nodes)):
            near = tile.partners(i)
            chosen[near] = True
            chosen[i] |= len(near) > 0
        if chosen.any():
            yield from rows.filter(pa.array(chosen)).combine_chunks().to_batches()

    def linked(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        tile = _Tile(rows, tables, least)
        column = rows.column("shingles").combine_chunks()
        sizes = np.diff(column.offsets.to_numpy())
        starts = np.cumsum(sizes) - sizes
        distinct, numbers = np.unique(column.flatten().to_numpy(), return_inverse=True)
        inside, a, b = np.zeros(len(distinct), np.int32), [], []
        for i in range(len(tile.nodes)):
            near = tile.partners(i)
            if not len(near):
                continue
            mine = numbers[starts[i] : starts[i] + sizes[i]]
            inside[mine] = 1
            common = np.add.reduceat(inside[numbers], starts)[near].astype(np.int64)
            inside[mine] = 0
            for j in near[common * 100 >= (sizes[near] + sizes[i] - common) * percent].tolist():
                if tile.component[i] != tile.component[j]:
                    tile.component[tile.component == tile.component[j]] = tile.component[i]
                    a.append(min(tile.nodes[i], tile.nodes[j]))
                    b.append(max(tile.nodes[i], tile.nodes[j]))
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    fields = "sketch long, table int, left int, right int, block int, node binary, label binary, signature binary, first array<int>, second array<int>"
    order = ["sketch", "table", "left", "right", "block", "node", "label", "signature", "first", "second"]
    some = written(_tiles(rows.select(*order), hopeful, fields), "hopeful")
    return _tiles(some.join(sets.select("node", "shingles"), "node").select(*order, "shingles"), linked, "a binary, b binary")


def _labels(docs: DataFrame, drawn: DataFrame, words: int, percent: int, tables: int, key: str, text: str) -> DataFrame | None:
    """Component labels of all nodes that have a link to another node."""
    nodes = written(
        drawn.filter("node is not null").groupBy("node").agg(F.first("first").alias("first"), F.first("second").alias("second"), F.min("doc_id").alias("rep")),
        "nodes",
    )
    members = written(buckets(written(keyed(nodes, tables), "keys")), "buckets")
    candidates = members.select("node").distinct()
    sets = full_sets(docs, nodes.select("node", "rep").join(candidates, "node"), words, key, text)
    stars = members.filter("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    links = written(confirmed(stars, sets, percent), "links")
    labels = components(links)
    more = written(_between(labels, nodes, sets, percent, tables), "links")
    if more.isEmpty():
        return labels
    # Links between components join whole components.
    named = lambda c: labels.select(F.col("node").alias(c), F.col("label").alias(f"{c}_label"))
    between = more.join(named("a"), "a", "left").join(named("b"), "b", "left")
    ends = between.select(F.coalesce("a_label", "a").alias("a"), F.coalesce("b_label", "b").alias("b"))
    higher = components(ends).select(F.col("node").alias("label"), F.col("label").alias("top"))
    lower = labels.select("node", "label").join(higher, "label", "left").select("node", F.coalesce("top", "label").alias("label"))
    alone = higher.select(F.col("label").alias("node"), F.col("top").alias("label")).join(labels, "node", "left_anti")
    return written(lower.union(alone), "labels")


def near_duplicates(
    docs: DataFrame, words: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``mark``, ``n_shingles``, ``node``, ``component_id``, ``kept``.

    A text's words are runs of anything but ASCII space, after lower-casing A-Z; its set are its distinct
    ``words``-word shingles, or all its words as one if they are fewer. Texts are linked when their sets share at least
    ``percent`` hundredths of their union; ``component_id`` is the smallest id that links reach, ``kept`` tells whether
    that is the row's own. Null, empty and blank texts have no set, are linked with nothing and kept. Rows that
    repeat id and text are alike in all columns; a null id counts as larger than any other. An empty table gives no
    row; other columns are not read. ``node`` is the digest of the set, ``mark`` a hash of the text.

    Links are found with chance 1 - 1e-4 or more for each pair at the threshold (see ``tables_for``) and are exact.
    """
    tables = tables_for(percent)
    drawn = written(sketches(docs, words, tables, key, text), "sketches")
    labels = _labels(docs, drawn, words, percent, tables, key, text)
    rows = drawn.select("doc_id", "mark", "n_shingles", "node").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = rows.filter("label is not null").groupBy("label").agg(F.min("doc_id").alias("least"))
    out = rows.join(least, "label", "left").withColumn("component_id", F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(F.col("least")))
    return out.select("doc_id", "mark", "n_shingles", "node", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_copies(docs: DataFrame, words: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``near_duplicates`` keeps, all columns: of each component the document with the
    smallest id, and all rows without words."""
    found = near_duplicates(docs, words, percent, key, text)
    gone = written(found.filter("not kept").select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark")).distinct(), "near-copies")
    here = docs[key].eqNullSafe(gone["_id"]) & (F.xxhash64(F.coalesce(docs[text], F.lit(""))) == gone["_mark"])
    return docs.join(gone, here, "left_anti")
