"""Exact search for the largest inner products, pruned by segment statistics of several resolutions.

A vector is cut into segments; of each its mean and deviation are kept. Over a segment of n components an inner product
is at most n times (product of means + product of deviations), which is the lower bound of the distance put in terms
of products. Bounds of few segments are computed first, those of more only for what is left, and exact products for
what outlasts the finest. Bounds of a block are matrix products, as the products themselves.

Queries are taken in blocks of bounded size, each broadcast to all vectors; vectors are never shuffled or replicated.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.llm.tables import written
from candlewick.sinks.workspace import new_folder

#: Segments of each resolution, coarse to fine.
LEVELS = (4, 16, 32)
#: Queries that are broadcast at once (half of it is aimed at), and rows and columns of a tile of bounds.
BLOCK, TILE_QUERIES, TILE_VECTORS = 8192, 1024, 2048
#: Components are below this, so that inner products of up to 8,192 dimensions are exact in a long.
LARGEST = 1 << 25
_NONE = np.iinfo(np.int64).max
SCALE = 64


def quantized(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id`` and ``v``: floor(64 * x) of every component.

    Rows without id and vectors that are null or hold a null, a NaN, an infinity or a component whose 64-fold is 2^25 or
    more take no part.
    """
    value = lambda x: x.cast("double") * SCALE
    sound = F.forall(vector, lambda x: F.coalesce(~F.isnan(value(x)) & (F.abs(value(x)) < LARGEST), F.lit(False)))
    numbers = F.when(sound, F.transform(vector, lambda x: F.floor(value(x)).cast("int")))
    return vectors.select(F.col(key).cast("long").alias("vec_id"), numbers.alias("v")).filter("vec_id is not null and v is not null")


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """The lists as rows of one matrix; shorter ones are filled up with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (lengths == width).all():
        return flat.reshape(len(lengths), width).astype(np.int64)
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of all segments, scaled so that the inner product of two rows bounds that of the vectors."""
    width = x.shape[1]
    cuts = np.unique(np.linspace(0, width, min(segments, width) + 1).astype(int))[:-1]
    sizes = np.diff(np.append(cuts, width))
    sums = np.add.reduceat(x, cuts, axis=1)
    squares = np.add.reduceat(x * x, cuts, axis=1)
    spread = np.sqrt(np.maximum(squares - sums * sums / sizes, 0))
    return np.concatenate([sums / np.sqrt(sizes), spread], axis=1)


class Best:
    """The best scores of each query so far: highest first, ties to smaller ids."""

    def __init__(self, queries: int, k: int, least: np.ndarray | None = None):
        self.k = k
        self.scores = np.full((queries, k), -_NONE, np.int64)
        self.ids = np.full((queries, k), _NONE, np.int64)
        #: A score below this is not among the best.
        self.least = np.full(queries, -_NONE, np.int64) if least is None else least.copy()

    def add(self, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        if not len(rows):
            return
        met = np.unique(rows)
        every = np.concatenate([np.repeat(met, self.k), rows])
        names = np.concatenate([self.ids[met].ravel(), ids])
        marks = np.concatenate([self.scores[met].ravel(), scores])
        order = np.lexsort((names, -marks, every))
        every, names, marks = every[order], names[order], marks[order]
        starts = np.flatnonzero(np.append(True, every[1:] != every[:-1]))
        rank = np.arange(len(every)) - np.repeat(starts, np.diff(np.append(starts, len(every))))
        kept = rank < self.k
        self.scores[every[kept], rank[kept]] = marks[kept]
        self.ids[every[kept], rank[kept]] = names[kept]
        self.least[met] = np.maximum(self.least[met], self.scores[met, -1])


class Queries:
    """A block of queries with their statistics."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, levels: Sequence[int]):
        self.ids, self.exact, self.levels = ids, vectors, levels
        self.largest = int(np.abs(vectors).max(initial=0))
        floats = vectors.astype(np.float64)
        self.floats, self.bounds = floats, [statistics(floats, n) for n in levels]
        self.norms = np.sqrt((floats * floats).sum(axis=1))

    def compare(self, best: Best, ids: np.ndarray, vectors: np.ndarray) -> None:
        """Take vectors into the best of all queries."""
        for at in range(0, len(ids), TILE_VECTORS):
            names, tile = ids[at : at + TILE_VECTORS], vectors[at : at + TILE_VECTORS]
            floats = tile.astype(np.float64)
            stats = [statistics(floats, n) for n in self.levels]
            norm = np.sqrt((floats * floats).sum(axis=1)).max(initial=0)
            sure = self.largest * int(np.abs(tile).max(initial=0)) * tile.shape[1] < 1 << 53
            for start in range(0, len(self.ids), TILE_QUERIES):
                mine = slice(start, start + TILE_QUERIES)
                # Bounds are rounded; scores are whole numbers.
                least = best.least[mine] - 0.5 - 1e-9 * self.norms[mine] * norm
                left = np.arange(len(names))
                alive = self.ids[mine][:, None] != names[None, :]
                for bound, other in zip(self.bounds, stats):
                    alive &= bound[mine] @ other[left].T >= least[:, None]
                    column = alive.any(axis=0)
                    left, alive = left[column], alive[:, column]
                    if not len(left):
                        break
                if not len(left):
                    continue
                if sure:
                    scores = (self.floats[mine] @ floats[left].T).astype(np.int64)
                else:
                    scores = self.exact[mine] @ tile[left].T
                alive &= scores >= best.least[mine][:, None]
                if len(left) > best.k:  # of one tile no more than its own best, with all ties
                    top = np.partition(np.where(alive, scores, -_NONE), len(left) - best.k, axis=1)[:, len(left) - best.k]
                    alive &= scores >= top[:, None]
                row, column = np.nonzero(alive)
                best.add(row + start, names[left[column]], scores[row, column])


def _found(best: Best) -> Iterator[pa.RecordBatch]:
    row, rank = np.nonzero(best.scores > -_NONE)
    for at in range(0, len(row), 65_536):
        r, c = row[at : at + 65_536], rank[at : at + 65_536]
        yield pa.RecordBatch.from_arrays([pa.array(r.astype(np.int64)), pa.array(best.ids[r, c]), pa.array(best.scores[r, c])], names=["query", "vec_id", "score"])


def _width_of(vectors: DataFrame) -> int:
    return vectors.agg(F.max(F.size("v"))).first()[0] or 0


def _dealt(queries: DataFrame, block: int) -> tuple[DataFrame, int]:
    """The queries with a block number; no block holds more than ``block``."""
    parts = max(1, -(-2 * queries.count() // block))
    while True:
        dealt = queries.withColumn("block", F.pmod(F.xxhash64("vec_id", "v"), F.lit(parts)).cast("int"))
        if dealt.groupBy("block").count().filter(F.col("count") > block).isEmpty():
            return dealt, parts
        parts *= 2


def top_products(
    vectors: DataFrame, chosen: Column, k: int = 20, key: str = "vec_id", vector: str = "embedding", levels: Sequence[int] = LEVELS, block: int = BLOCK
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: the ``k`` vectors with the highest inner products of every
    query (rows where ``chosen`` holds), or all if there are fewer. Ties go to the smaller id.

    Products are of the whole numbers of ``quantized``, which also tells what takes no part, so they are exact. A vector is
    compared with rows of another id only. Shorter vectors count as filled up with zeros. Queries that repeat id and
    vector are one, other repeated rows are rows of their own. No vectors or no queries give no row; other columns are
    not read. Memory of a task: a block of queries, their best, and a tile of bounds.
    """
    spark = vectors.sparkSession
    numbers = written(quantized(vectors, key, vector).withColumn("chosen", F.coalesce(chosen, F.lit(False))), "vectors")
    every = numbers.select("vec_id", "v")
    width = max(_width_of(numbers), 1)
    queries, parts = _dealt(written(numbers.filter("chosen").select("vec_id", "v").distinct(), "queries"), block)
    folder = new_folder(spark, "found")
    found_ddl = "query long, vec_id long, score long"

    def scan(rows: DataFrame, asked: Queries, least: np.ndarray | None) -> DataFrame:
        shared = spark.sparkContext.broadcast((asked, least))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            mine, floor = shared.value
            best = Best(len(mine.ids), k, floor)
            for batch in batches:
                if len(batch):
                    mine.compare(best, batch.column(0).to_numpy(), _matrix(batch.column(1), width))
            yield from _found(best)

        return rows.mapInArrow(run, found_ddl)

    for number in range(parts):
        rows = queries.filter(F.col("block") == number).select("vec_id", "v").toArrow()  # ``block`` rows at most
        if rows.num_rows:
            asked = Queries(rows.column(0).to_numpy(), _matrix(rows.column(1).combine_chunks(), width), levels)
            # Among the queries themselves there are k scores that the k best of all can't fall below.
            seeds = scan(queries.filter(F.col("block") == number).select("vec_id", "v").coalesce(1), asked, None)
            least = np.full(rows.num_rows, -_NONE, np.int64)
            known = seeds.groupBy("query").agg(F.count("*").alias("n"), F.min("score").alias("least")).filter(F.col("n") == k)
            for query, score in known.select("query", "least").collect():
                least[query] = score
            names = spark.createDataFrame(pa.table({"query": pa.array(range(rows.num_rows), pa.int64()), "query_id": rows.column(0)}))
            best = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")
            ranked = scan(every, asked, least).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            ranked.join(F.broadcast(names), "query").select("query_id", "rank", "vec_id", "score").write.parquet(f"{folder}/part={number}")
    ddl = "query_id long, rank int, vec_id long, score long"
    if queries.isEmpty():
        return spark.createDataFrame([], ddl)
    return spark.read.schema(f"{ddl}, part int").parquet(folder).drop("part")
