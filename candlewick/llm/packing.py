"""Packing of token ids into windows by multiway differencing."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.tables import sliced, whole
from candlewick.llm.tokens import byte_level

#: Remainders that are levelled together, and bytes of ids in an output batch.
GROUP, BATCH_BYTES = 1024, 4 << 20


def differencing(sizes: list[int], windows: int) -> list[list[int]]:
    """Karmarkar-Karp: item numbers in ``windows`` lists of nearly equal sums.

    A partial partition holds the loads of its windows in falling order; windows without an item are left out. The
    two partial partitions with the widest spread merge, the heaviest windows of one on the lightest of the other.
    """
    nodes: list[tuple[int, int] | None] = [None] * len(sizes)
    heap = [(-size, number, np.array([size]), np.array([number])) for number, size in enumerate(sizes)]
    heapq.heapify(heap)
    serial = len(sizes)
    while len(heap) > 1:
        _, _, a, a_nodes = heapq.heappop(heap)
        _, _, b, b_nodes = heapq.heappop(heap)
        both = max(0, len(a) + len(b) - windows)
        a_own, b_own = len(a) - both, len(b) - both
        joined = np.arange(len(nodes), len(nodes) + both)
        nodes.extend(zip(a_nodes[a_own:].tolist(), b_nodes[b_own:][::-1].tolist(), strict=True))
        loads = np.concatenate((a[:a_own], b[:b_own], a[a_own:] + b[b_own:][::-1]))
        named = np.concatenate((a_nodes[:a_own], b_nodes[:b_own], joined))
        order = np.argsort(-loads, kind="stable")
        loads, named = loads[order], named[order]
        if len(loads) == windows:
            loads = loads - loads[-1]
        heapq.heappush(heap, (-int(loads[0]), serial, loads, named))
        serial += 1
    out: list[list[int]] = []
    for top in heap[0][3].tolist() if heap else []:
        items, stack = [], [top]
        while stack:
            node = stack.pop()
            if nodes[node] is None:
                items.append(node)
            else:
                stack.extend(nodes[node])
        out.append(items)
    return out + [[] for _ in range(windows - len(out))]


#: A piece: document id, start among the document's ids, ids as bytes, ids of the document.
Piece = tuple[int | None, int, bytes, int]


def _length(piece: Piece) -> int:
    return len(piece[2]) // 4


def _cut(piece: Piece, at: int) -> tuple[Piece, Piece]:
    key, start, ids, total = piece
    return (key, start, ids[: 4 * at], total), (key, start + at, ids[4 * at :], total)


def level(pieces: list[Piece], capacity: int) -> tuple[list[list[Piece]], list[Piece]]:
    """Full windows, and the pieces of the last one, which is not full.

    Differencing spreads the pieces over as many windows as they can fill. What exceeds a window's capacity is cut
    off and fills the room in others; what finds no room raises the number of windows by one.
    """
    total = sum(map(_length, pieces))
    if total < capacity:
        return [], pieces
    windows, surplus, room = [], [], []
    for items in differencing([_length(p) for p in pieces], total // capacity):
        window, left = [], capacity
        for piece in sorted((pieces[i] for i in items), key=_length, reverse=True):
            if left >= _length(piece):
                window.append(piece)
                left -= _length(piece)
                continue
            kept, rest = _cut(piece, left)
            if left:
                window.append(kept)
            surplus.append(rest)
            left = 0
        windows.append(window)
        if left:
            room.append((left, window))
    surplus.sort(key=_length)
    for left, window in sorted(room, key=lambda x: -x[0]):
        while left:
            piece = surplus.pop()
            if _length(piece) > left:
                piece, rest = _cut(piece, left)
                surplus.append(rest)
            window.append(piece)
            left -= _length(piece)
    return windows, surplus


def powers(pieces: list[Piece]) -> Iterator[list[Piece]]:
    """The pieces in windows whose lengths are falling powers of two, so that none of them is padded."""
    left, waiting = sum(map(_length, pieces)), pieces[::-1]
    while left:
        room = 1 << (left.bit_length() - 1)
        left -= room
        window = []
        while room:
            piece = waiting.pop()
            if _length(piece) > room:
                piece, rest = _cut(piece, room)
                waiting.append(rest)
            window.append(piece)
            room -= _length(piece)
        yield window


PACKED = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
])


class _Sequences:
    """Numbers the windows of a task and gathers their rows into batches."""

    def __init__(self):
        self.next_id = TaskContext.get().partitionId() << 33
        self.rows, self.bytes = [], 0

    def add(self, window: list[Piece]) -> None:
        offset = 0
        for piece in window:
            key, start, ids, total = piece
            self.rows.append((key, start, _length(piece), ids, total, self.next_id, offset))
            offset += _length(piece)
            self.bytes += len(ids)
        self.next_id += 1

    def ready(self, least: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
        if self.rows and self.bytes >= least:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*self.rows), PACKED)], schema=PACKED)
            self.rows, self.bytes = [], 0


def pack(
    docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 1, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Pieces of all documents in sequences of at most ``capacity`` ids: key (as ``doc_id``), ``start``, ``length``,
    ``ids`` (little-endian unsigned 32-bit), ``doc_tokens``, ``sequence_id``, ``offset``.

    Every document is followed by ``end_id``, so a null or empty text is one piece of one id. A document longer than
    a sequence fills whole sequences first; what remains of the documents is levelled in groups by Karmarkar-Karp,
    and a group hands its last, unfinished sequence on to the next. What a task has left at its end is cut into sequences
    whose lengths are powers of two, which need no padding: so the number of tasks does not matter (ten such sequences
    a task at most, for 2048), and no shuffle is needed: ids never leave the task that made them. Repeated rows and null keys are packed like any
    other row, an empty table gives no row, other columns are not read. A task holds the remainders of one group,
    each shorter than a sequence. A task that is run again gives the same rows under the same sequence ids.
    """
    end = np.array([end_id], "<u4").tobytes()

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, out, pool = byte_level(tokenizer), _Sequences(), []
        for batch in (part for batch in batches for part in sliced(batch)):
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = encoder.ids(body) + end
                total = len(ids) // 4
                rest: Piece = (name, 0, ids, total)
                while _length(rest) >= capacity:
                    full, rest = _cut(rest, capacity)
                    out.add([full])
                    yield from out.ready()
                if rest[2]:
                    pool.append(rest)
                if len(pool) >= GROUP:
                    windows, pool = level(pool, capacity)
                    for window in windows:
                        out.add(window)
                    yield from out.ready()
        windows, rest = level(pool, capacity)
        for window in [*windows, *powers(rest)]:
            out.add(window)
        yield from out.ready(0)

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), whole(text).alias("text"))
    return rows.mapInArrow(packed, "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
