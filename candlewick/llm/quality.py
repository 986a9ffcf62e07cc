"""Quality scores by nearest-neighbour voting among labelled latent-semantic vectors.

Terms of a text are the shapes of its words, pairs of neighbouring shapes, short words, and repetitions; long words are
cut into pieces that are terms each, so texts without spaces count to their end. Vectors are tf-idf weights of these terms, projected to their leading singular directions. A document's score is the vote of its
nearest labelled vectors by cosine, each label weighted by its similarity.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.llm.tables import sliced, written
from candlewick.llm.tokens import Recent

#: Terms by kind: repetition, short words, word shapes, pairs of shapes.
REPEATS, SHORT, SHAPES, PAIRS = 2, 254, 256, 512
TERMS = REPEATS + SHORT + SHAPES + PAIRS
#: Labelled documents the model is fitted on (the bound of what is gathered and broadcast), directions, neighbours.
SAMPLE, DIRECTIONS, NEIGHBOURS = 4096, 64, 16
#: Votes are weighted by this power of the cosine, so that the nearest count most.
POWER = 8
#: Documents multiplied at once with all labelled vectors.
BLOCK = 256
#: Characters of a piece of a long word; a rest as short as a short word stays with the last piece.
PIECE, SHORTEST = 64, 4
#: Words remembered in each of two generations, some 200 bytes a word in every worker.
KEPT_WORDS = 100_000

_SHAPE = {c: "A" if chr(c).isupper() else "a" if chr(c).isalpha() else "0" if chr(c).isdecimal() else chr(c) for c in range(0x250)}


def _term(word: str) -> int:
    """A word's hash, shape number and short-word number in one integer."""
    shape, last, run = [], "", 0
    for c in word.translate(_SHAPE):
        run = run + 1 if c == last else 1
        last = c
        if run <= 2:
            shape.append(c)
    h = zlib.crc32(word.encode("utf-8", "surrogatepass"))
    short = 1 + zlib.crc32(word.lower().encode("utf-8", "surrogatepass")) % SHORT if len(word) <= SHORTEST else 0
    return h << 20 | (zlib.crc32("".join(shape).encode("utf-8", "surrogatepass")) % SHAPES) << 10 | short


def _pieces(word: str) -> list[str]:
    ends = [*range(PIECE, len(word) - SHORTEST, PIECE), len(word)]
    return [word[a:b] for a, b in zip([0, *ends], ends)]


class Counter:
    """Term counts of texts, as square roots of rates."""

    def __init__(self):
        self.known = Recent(_term, KEPT_WORDS)

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        out = np.zeros((len(texts), TERMS), np.float32)
        for row, text in zip(out, texts):
            words = (text or "").split()
            if not words:
                continue
            again = 0
            if max(map(len, words)) > PIECE:
                again = sum(a == b and len(a) > PIECE for a, b in zip(words, words[1:]))
                words = [p for word in words for p in (_pieces(word) if len(word) > PIECE else (word,))]
            packed = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
            marks, shapes, short = packed >> 20, packed >> 10 & 1023, packed & 1023
            n = len(words)
            row[0] = np.count_nonzero(marks[1:] == marks[:-1]) + again
            row[1] = n - len(np.unique(marks))
            row[REPEATS : REPEATS + SHORT] = np.bincount(short, minlength=SHORT + 1)[1:]
            row[REPEATS + SHORT :][:SHAPES] = np.bincount(shapes, minlength=SHAPES)
            pairs = (shapes[1:] * 31 + shapes[:-1] * 17) % PAIRS
            row[REPEATS + SHORT + SHAPES :] = np.bincount(pairs, minlength=PAIRS)
            row /= n
        return np.sqrt(out)


def _unit(rows: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, length, out=np.zeros_like(rows), where=length > 0)


@dataclass(frozen=True)
class Model:
    """Weights of terms, singular directions, labelled unit vectors, their labels; ``prior`` for texts without words."""

    idf: np.ndarray
    directions: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float

    def project(self, counts: np.ndarray) -> np.ndarray:
        return _unit(_unit(counts * self.idf) @ self.directions)

    def score(self, counts: np.ndarray, neighbours: int = NEIGHBOURS) -> np.ndarray:
        k = min(neighbours, len(self.labels))
        if not k:
            return np.full(len(counts), self.prior)
        out = []
        for at in range(0, len(counts), BLOCK):
            cosines = self.project(counts[at : at + BLOCK]) @ self.vectors.T
            near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
            weights = np.clip(np.take_along_axis(cosines, near, axis=1), 0, None).astype(np.float64) ** POWER
            total = weights.sum(axis=1)
            votes = (weights * self.labels[near]).sum(axis=1)
            out.append(np.where(total > 0, votes / np.where(total > 0, total, 1), self.prior))
        return np.clip(np.concatenate(out), 0, 1) if out else np.zeros(0)


def fitted(counts: np.ndarray, labels: np.ndarray, directions: int = DIRECTIONS, known: tuple[int, np.ndarray] | None = None) -> Model:
    """A model of labelled counts; ``known`` are the documents and each term's documents that idf comes from, if not these."""
    prior = float(labels.mean()) if len(labels) else 0.5
    if not len(labels):
        return Model(np.ones(TERMS, np.float32), np.zeros((TERMS, 1), np.float32), np.zeros((0, 1), np.float32), labels, prior)
    n, frequencies = known or (len(counts), np.count_nonzero(counts, axis=0))
    idf = (np.log((1 + n) / (1 + frequencies)) + 1).astype(np.float32)
    weighted = _unit(counts * idf)
    _, basis = np.linalg.eigh((weighted.T @ weighted).astype(np.float64))
    basis = np.ascontiguousarray(basis[:, ::-1][:, :directions], np.float32)
    return Model(idf, basis, _unit(weighted @ basis), labels.astype(np.float64), prior)


def document_frequencies(docs: DataFrame, text: str = "text") -> tuple[int, np.ndarray]:
    """Rows of ``docs`` and, for each term, the rows that have it; a task sends one number for each term."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = Counter(), np.zeros(TERMS + 1, np.int64)
        for batch in (part for batch in batches for part in sliced(batch, BLOCK)):
            total[:TERMS] += np.count_nonzero(count(batch.column(0).to_pylist()), axis=0)
            total[TERMS] += batch.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(TERMS + 1)), pa.array(total)], names=["term", "n"])

    sums = docs.select(F.col(text).alias("text")).mapInArrow(found, "term long, n long").groupBy("term").agg(F.sum("n"))
    total = np.zeros(TERMS + 1, np.int64)
    for term, n in sums.collect():
        total[term] = n
    return int(total[TERMS]), total[:TERMS]


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE) -> Model:
    """A model of at most ``sample`` labelled documents, those with the smallest hashes of their ids.

    Only labels of ids that are not held out are learned. Null labels and ids are left out; an id labelled more than
    once has the rounded mean. The terms' weights come from all rows of ``docs``. Without any labelled document the model scores everything 0.5.
    """
    known = labels.filter(F.col(label).isNotNull() & F.col(key).isNotNull() & ~held_out(F.col(key)))
    known = known.groupBy(F.col(key).alias("_id")).agg((F.avg(label) >= 0.5).cast("int").alias("_label"))
    here = known.join(docs.select(F.col(key).alias("_id")), "_id", "left_semi")
    chosen = written(here.orderBy(F.xxhash64("_id"), "_id").limit(sample), "labelled")
    rows = docs.select(F.col(key).alias("_id"), F.col(text).alias("text")).join(F.broadcast(chosen), "_id")  # sample rows

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = Counter()
        for batch in (part for batch in batches for part in sliced(batch, BLOCK)):
            found = count(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([r.tobytes() for r in found], pa.binary())], names=["_id", "_label", "counts"]
            )

    # An id that stands in several rows is learned once, from its first text.
    one = rows.groupBy("_id", "_label").agg(F.min("text").alias("text"))
    got = one.select("_id", "_label", "text").mapInArrow(counts, "_id long, _label int, counts binary").toArrow()
    order = np.argsort(got.column("_id").to_numpy(), kind="stable")
    matrix = np.frombuffer(b"".join(got.column("counts").to_pylist()), np.float32).reshape(-1, TERMS)
    frequencies = document_frequencies(docs, text) if len(order) else None
    return fitted(matrix[order], got.column("_label").to_numpy()[order].astype(np.float64), known=frequencies)


@lru_cache(maxsize=2)
def _model(shared: Broadcast) -> Model:
    return shared.value


def score(text: Column, model: Broadcast) -> Column:
    """Score of a text column, between 0 and 1."""

    @F.arrow_udf("double")
    def scores(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        count = Counter()
        for batch in batches:
            out = [_model(model).score(count(part.to_pylist())) for part in sliced(batch, BLOCK)]
            yield pa.array(np.concatenate(out) if out else np.zeros(0), pa.float64())

    return scores(text)


def quality_scores(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
    threshold: float = 0.7, sample: int = SAMPLE,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``held_out``, ``score``, ``predicted`` (1 from ``threshold`` on).

    The score depends on the text alone. A null, empty or blank text has the labelled share of good documents; equal
    texts have equal scores. Null ids count as not held out. Long texts are read whole, an empty table gives no
    row, other columns are not read. Broadcast: at most ``sample`` vectors. No shuffle of the documents.
    """
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, key, text, label, sample))
    rows = docs.select(F.col(key).alias("doc_id"), held_out(F.col(key)).alias("held_out"), score(F.col(text), shared).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def drop_poor(docs: DataFrame, labels: DataFrame, text: str = "text", threshold: float = 0.7, **options) -> DataFrame:
    """The rows of ``docs`` with a score of ``threshold`` or more, all columns."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, text=text, **options))
    return docs.filter(score(F.col(text), shared) >= threshold)
