"""Prefixes that conversations share, found with z-fast tries.

Distinct conversations are sorted by range, so that every task holds neighbours. A task inserts them, batch by batch,
into a z-fast trie: a table of compacted nodes by the prefix that ends at the two-fattest depth of their edge. A fat
binary search in it finds where a conversation leaves the trie with about log2(turns) look-ups. Edges are then expanded to
one row for each prefix, and the tasks' rows for the same prefix are summed up. A trie of bounded size is expanded and
begun anew; so neither a common first turn nor a common conversation makes a large task.

The smallest and largest place of a prefix in the sorted order bound its subtree: sums over subtrees are differences of
running sums, whatever the depth.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.llm.tables import written

#: Conversations' turns that a trie takes before it is expanded and begun anew.
TURNS = 400_000
#: Ids in a piece of a list that lies in several tasks.
PIECE = 65_536
ROOT = bytes(16)


def paths(conversations: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id`` and ``path``: its turns in order, each a ``step`` (digest of role and text) and its ``chars``.

    Null turns come first; turns of one number follow by role and MD5 of the text. Null roles and texts are empty.
    Rows without conversation belong to none. A path holds digests, never texts.
    """
    name, said = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    mark = F.md5(said)
    rows = conversations.filter(F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("conv_id"),
        F.struct(
            F.col(turn).isNotNull().alias("numbered"), F.col(turn).cast("long").alias("turn"), name.alias("role"), mark.alias("mark"),
            F.unhex(F.md5(F.concat(F.md5(name), mark))).alias("step"), F.char_length(said).alias("chars"),
        ).alias("said"),
    )
    turns = F.transform(F.array_sort(F.collect_list("said")), lambda x: F.struct(x["step"].alias("step"), x["chars"].alias("chars")))
    return rows.groupBy("conv_id").agg(turns.alias("path"))


def rebuilt(own: DataFrame, every: int = 100, most: int = 6) -> DataFrame:
    """Paths that begin with turns of another conversation: the first ``h`` of that with the next lower round number
    (by ``every``), where it exists, then a conversation's own turns after its first ``h``; ``h`` is crc32 of the decimal
    id modulo ``most``."""
    heads = own.filter(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("_base"), F.slice("path", 1, most - 1).alias("_head"))
    count = (F.crc32(F.encode(F.col("conv_id").cast("string"), "UTF-8")) % most).cast("int")
    joined = own.withColumn("_h", count).join(heads, F.col("conv_id") - F.col("conv_id") % every == F.col("_base"), "left")
    first = F.when(F.col("_head").isNotNull(), F.slice("_head", F.lit(1), F.col("_h")))
    rest = F.slice("path", F.col("_h") + 1, F.greatest(F.size("path"), F.lit(1)))
    return joined.select("conv_id", F.when(first.isNull(), rest).otherwise(F.concat(first, rest)).alias("path"))


@dataclass(slots=True)
class _Node:
    """A compacted node: the prefixes longer than ``low``, up to ``extent``, of ``path``."""

    low: int
    extent: int
    path: list[bytes]
    chars: list[int]
    children: dict[bytes, _Node] = field(default_factory=dict)
    end: tuple | None = None


def _fattest(low: int, high: int) -> int:
    """The number in (low, high] that the largest power of two divides."""
    return high & (-1 << ((low ^ high).bit_length() - 1))


class ZFastTrie:
    """Prefix hashes in, compacted nodes by their handles: the prefix at the two-fattest depth of a node's edge."""

    def __init__(self) -> None:
        self.root = _Node(-1, 0, [ROOT], [0])
        self.handles: dict[bytes, _Node] = {}
        self.turns = 0

    def _enter(self, node: _Node) -> None:
        self.handles[node.path[_fattest(node.low, node.extent)]] = node

    def locate(self, path: list[bytes]) -> tuple[_Node, _Node | None]:
        """The deepest node whose extent begins ``path``, and its child on whose edge ``path`` leaves the trie, if any."""
        found, low, high = self.root, 0, len(path) - 1
        while low < high:
            depth = _fattest(low, high)
            node = self.handles.get(path[depth])
            if node is None:
                high = depth - 1
            elif node.extent < len(path) and path[node.extent] == node.path[node.extent]:
                found, low = node, node.extent
            else:
                high = depth - 1
        return found, found.children.get(path[found.extent + 1]) if len(path) > found.extent + 1 else None

    def insert(self, path: list[bytes], chars: list[int], end: tuple) -> None:
        """``path`` begins with the root's hash; ``end`` is kept at its last prefix."""
        above, child = self.locate(path)
        last = len(path) - 1
        self.turns += last
        if child is not None:  # cut the edge where the path leaves it
            same, differs = above.extent + 1, min(child.extent, last) + 1
            while differs - same > 1:
                middle = (same + differs) // 2
                same, differs = (middle, differs) if path[middle] == child.path[middle] else (same, middle)
            del self.handles[child.path[_fattest(child.low, child.extent)]]
            cut = _Node(above.extent, same, child.path, child.chars, {child.path[same + 1]: child})
            above.children[path[cut.low + 1]] = cut
            child.low = same
            self._enter(cut)
            self._enter(child)
            above = cut
        if above.extent < last:
            leaf = _Node(above.extent, last, path, chars)
            above.children[path[above.extent + 1]] = leaf
            self._enter(leaf)
            above = leaf
        above.end = end

    def expanded(self) -> Iterator[tuple]:
        """One row for each prefix: hash, depth, parent's hash, characters, conversations, smallest id, first and last
        place, and the two halves of the name of what ends there."""
        sums: dict[int, list] = {}
        stack: list[tuple[_Node, bool]] = [(self.root, False)]
        while stack:
            node, ready = stack.pop()
            if not ready:
                stack.append((node, True))
                stack.extend((child, False) for child in node.children.values())
                continue
            parts = [sums.pop(id(child)) for child in node.children.values()]
            if node.end:
                count, least, place, *name = node.end
                parts.append([count, least, place, place])
            total = [sum(p[0] for p in parts), min(p[1] for p in parts), min(p[2] for p in parts), max(p[3] for p in parts)]
            sums[id(node)] = total
            for depth in range(node.low + 1, node.extent + 1):
                ended = name if node.end and depth == node.extent else [None, None]
                yield (node.path[depth], depth, node.path[depth - 1] if depth else None, node.chars[depth], *total, *ended)


_NODES = pa.schema([
    ("node", pa.binary()), ("depth", pa.int64()), ("parent", pa.binary()), ("chars", pa.int64()), ("n_convs", pa.int64()), ("least", pa.int64()),
    ("low", pa.int64()), ("high", pa.int64()), ("one", pa.int64()), ("two", pa.int64()),
])
_NODES_DDL = "node binary, depth long, parent binary, chars long, n_convs long, least long, low long, high long, one long, two long"


def _tries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows(trie: ZFastTrie) -> Iterator[pa.RecordBatch]:
        out = []
        for row in trie.expanded():
            out.append(row)
            if len(out) == 16_384:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _NODES)], schema=_NODES)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _NODES)], schema=_NODES)

    trie, filled = ZFastTrie(), False
    for batch in batches:
        for turns, *end in zip(*(batch.column(c).to_pylist() for c in ("path", "n", "least", "place", "one", "two")), strict=True):
            path, chars = [ROOT], [0]
            for step in turns:
                path.append(hashlib.blake2b(path[-1] + step["step"], digest_size=16).digest())
                chars.append(step["chars"])
            trie.insert(path, chars, tuple(end))
            filled = True
        if trie.turns > TURNS:
            yield from rows(trie)
            trie, filled = ZFastTrie(), False
    if filled:
        yield from rows(trie)


def _name(path: str = "path") -> list[Column]:
    """128 bits that stand for a path."""
    return [F.xxhash64(path).alias("one"), F.xxhash64(F.lit(1), F.col(path)).alias("two")]


def id_digests(members: DataFrame) -> DataFrame:
    """``one``, ``two`` and ``ids_sha256``: SHA-256 of the decimal ``conv_id`` of each name, ascending, joined by commas.

    Ids are listed in pieces of ``PIECE`` consecutive numbers, so a name that most conversations have is listed by many
    tasks; its pieces are then digested one after the other as they stream by.
    """
    block = F.floor(F.col("conv_id") / PIECE)
    listed = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string")), ",")
    pieces = members.groupBy("one", "two", block.alias("block")).agg(listed.alias("ids"))
    schema = pa.schema([("one", pa.int64()), ("two", pa.int64()), ("ids_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, digest = None, None
        for batch in batches:
            out = []
            for one, two, ids in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if (one, two) == name:
                    digest.update(b"," + ids.encode())
                else:
                    if name:
                        out.append((*name, digest.hexdigest()))
                    name, digest = (one, two), hashlib.sha256(ids.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
        if name:
            yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((*name, digest.hexdigest()), schema)], schema=schema)

    dealt = pieces.repartition("one", "two").sortWithinPartitions("one", "two", "block").select("one", "two", "ids")
    return dealt.mapInArrow(run, "one long, two long, ids_sha256 string")


def _running(ends: DataFrame) -> DataFrame:
    """``place`` with sums of ``leaves`` and ``saved`` over it and all places before: within a range by a window, over the
    ranges by a few offsets."""
    part = F.shiftright("place", 33)
    ranges = ends.groupBy(part.alias("range")).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row for each task of the sort
    offsets = ranges.select("range", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in ("leaves", "saved")])
    inside = Window.partitionBy("range").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    rows = ends.withColumn("range", part).join(F.broadcast(offsets), "range")
    return rows.select("place", *[(F.sum(c).over(inside) + F.col(f"{c}_before")).alias(c) for c in ("leaves", "saved")])


def prefix_trie(named: DataFrame) -> DataFrame:
    """One row for each distinct prefix of the paths in ``named`` (see ``paths``): ``node``, ``depth``, ``parent``, ``conv_id``
    (smallest member), ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``.

    The root has no parent and stands for all conversations, also those without turns. A leaf is its own only leaf.
    ``saved_tokens`` sums (members - 1) times characters of the last text over the subtree. A conversation counts once;
    equal conversations share all their prefixes. An empty table gives no row. ``node`` is a digest of the prefix.
    """
    kept = written(named.select("conv_id", "path", *_name()), "paths")
    ends = kept.groupBy("path", "one", "two").agg(F.count("*").alias("n"), F.min("conv_id").alias("least"))
    sorted_ends = ends.repartitionByRange("path").sortWithinPartitions("path")
    placed = written(sorted_ends.withColumn("place", F.monotonically_increasing_id()), "distinct-paths")
    made = placed.select("path", "n", "least", "place", "one", "two").mapInArrow(_tries, _NODES_DDL)
    nodes = written(
        made.groupBy("node", "depth", "parent", "chars").agg(
            F.sum("n_convs").alias("n_convs"), F.min("least").alias("least"), F.min("low").alias("low"), F.max("high").alias("high"),
            F.max("one").alias("one"), F.max("two").alias("two"),
        ),
        "prefixes",
    )
    below = nodes.filter("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(below, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long"))
    nodes = nodes.withColumns({"leaves": (F.col("n_children") == 0).cast("long"), "saved": (F.col("n_convs") - 1) * F.col("chars")})
    nodes = written(nodes, "prefixes")
    up = nodes.select(F.col("node").alias("parent"), F.col("least").alias("parent_conv_id"))
    digests = id_digests(kept)
    running = written(_running(nodes.groupBy(F.col("low").alias("place")).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))), "sums")
    # What a path adds to the sorted order at and below a depth, then what the paths after it add, up to the last member.
    deeper = Window.partitionBy("low").orderBy(F.col("depth").desc()).rowsBetween(Window.unboundedPreceding, 0)
    own = nodes.select("*", F.sum("leaves").over(deeper).alias("own_leaves"), F.sum("saved").over(deeper).alias("own_saved"))
    at = lambda name: running.select(F.col("place").alias(name), F.col("leaves").alias(f"{name}_leaves"), F.col("saved").alias(f"{name}_saved"))
    full = own.join(at("low"), "low").join(at("high"), "high").join(up, "parent", "left").join(digests, ["one", "two"], "left")
    total = lambda what: F.col(f"own_{what}") + F.col(f"high_{what}") - F.col(f"low_{what}")
    return full.select(
        "node", "depth", "parent", F.col("least").alias("conv_id"), "parent_conv_id", "n_convs", "n_children", total("leaves").alias("n_leaves"),
        total("saved").alias("saved_tokens"), F.coalesce("ids_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
