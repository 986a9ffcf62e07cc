"""Benchmark decontamination with an Aho-Corasick automaton over the windows of all items.

One automaton takes about 180 MB for each MB of benchmark text, in every worker. Benchmarks beyond ``most_bytes`` are
dealt over several automata of that size, used one after another; the hits of a text are united, so the result is the
same as that of one automaton.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce

import ahocorasick
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.llm.tables import sliced, written

#: Words of a window; bytes of benchmark text in one automaton (some 360 MB in a worker).
WINDOW, MOST_BYTES = 10, 2 << 20

# A-Z become a-z; every other ASCII character that is no digit and no a-z becomes a space; the rest is kept.
_PLAIN = bytes(
    b + 32 if 65 <= b <= 90 else b if b > 127 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)
_WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def words(text: str) -> list[bytes]:
    """Normalised words: runs of digits, letters a-z after lower-casing A-Z, and characters beyond ASCII."""
    return text.encode("utf-8", "surrogatepass").translate(_PLAIN).split()


@dataclass(frozen=True)
class Windows:
    """Distinct words, and each distinct window as word numbers with the items that have it."""

    numbers: dict[bytes, int]
    windows: dict[tuple[int, ...], tuple[str, ...]]


def text_bytes(benchmark: DataFrame, texts: tuple[str, ...] = ("text",)) -> int:
    return benchmark.agg(sum((F.coalesce(F.sum(F.octet_length(t)), F.lit(0)) for t in texts), F.lit(0)).alias("n")).first()[0]


def windows_of(benchmark: DataFrame, key: str = "item_id", texts: tuple[str, ...] = ("text",), window: int = WINDOW, most_bytes: int = MOST_BYTES) -> Windows:
    """The windows of all items. Raises if the texts are larger than ``most_bytes``: nothing unbounded is gathered."""
    size = text_bytes(benchmark, texts)
    if size > most_bytes:
        raise ValueError(f"the benchmark texts have {size} bytes; an automaton may hold {most_bytes}")
    return _gathered(benchmark, key, texts, window)


def _gathered(benchmark: DataFrame, key: str, texts: tuple[str, ...], window: int) -> Windows:
    numbers: dict[bytes, int] = {}
    found: dict[tuple[int, ...], set[str]] = {}
    for item, *bodies in benchmark.select(F.col(key).cast("string"), *texts).collect():
        for body in bodies:
            ids = [numbers.setdefault(w, len(numbers) + 1) for w in words(body or "")]
            for start in range(max(1, len(ids) - window + 1)) if ids else ():
                found.setdefault(tuple(ids[start : start + window]), set()).add(item or "")
    return Windows(numbers, {w: tuple(sorted(items)) for w, items in found.items()})


class Scanner:
    """Finds all windows in a text in one pass over its words."""

    def __init__(self, windows: Windows):
        self.numbers = windows.numbers
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for ids, items in windows.windows.items():
            self.automaton.add_word(ids, (len(ids), items))
        if windows.windows:
            self.automaton.make_automaton()

    def scan(self, text: str) -> tuple[int, list[tuple[int, int]], set[str]]:
        """Number of words, hit words as ranges (first, beyond last) without overlap, and items found."""
        found = words(text)
        if not self.numbers or not found:
            return len(found), [], set()
        ids = tuple([self.numbers.get(w, 0) for w in found])
        ranges: list[tuple[int, int]] = []
        items: set[str] = set()
        for end, (length, names) in self.automaton.iter(ids):
            start, stop = end - length + 1, end + 1
            while ranges and ranges[-1][1] >= start:
                start = min(start, ranges.pop()[0])
            ranges.append((start, stop))
            items.update(names)
        return len(found), ranges, items

    def spans(self, text: str, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """Ranges of words as character ranges of the original text."""
        if not ranges:
            return []
        starts, stops = dict.fromkeys(r[0] for r in ranges), dict.fromkeys(r[1] - 1 for r in ranges)
        for number, match in enumerate(_WORD.finditer(text)):
            if number in starts:
                starts[number] = match.start()
            if number in stops:
                stops[number] = match.end()
        return [(starts[a], stops[b - 1]) for a, b in ranges]


@lru_cache(maxsize=1)
def _scanner(windows: Broadcast) -> Scanner:
    return Scanner(windows.value)


RANGES = "array<struct<first: long, beyond: long, start: long, stop: long>>"
HIT = f"n_words long, n_hit long, items array<string>, ranges {RANGES}"
_RANGES = pa.list_(pa.struct([(n, pa.int64()) for n in ("first", "beyond", "start", "stop")]))
_HIT = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())), ("ranges", _RANGES)])


def hits(text: Column, windows: Broadcast) -> Column:
    """What the windows hit in a text column: word counts, sorted item ids, hit ranges by word and by character."""

    @F.arrow_udf(f"struct<{HIT}>")
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scanner = _scanner(windows)
        for batch in batches:
            rows = []
            for body in (body for part in sliced(batch) for body in part.to_pylist()):
                n, ranges, items = scanner.scan(body or "")
                rows.append({
                    "n_words": n, "n_hit": sum(b - a for a, b in ranges), "items": sorted(items),
                    "ranges": [
                        {"first": a, "beyond": b, "start": start, "stop": stop}
                        for (a, b), (start, stop) in zip(ranges, scanner.spans(body or "", ranges), strict=True)
                    ],
                })
            yield pa.array(rows, _HIT)

    return found(text)


def cut_items(benchmark: DataFrame, key: str, texts: tuple[str, ...], window: int, windows: int) -> DataFrame:
    """Items as ``item`` and ``body``: slices of at most so many windows, whose words overlap by a window less one.
    All slices of an item together have its windows, and no others."""
    rows = benchmark.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("item"), F.explode(F.array(*texts)).alias("body"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = words(body or "")
                for start in range(0, max(1, len(found) - window + 1) if found else 0, windows):
                    part = b" ".join(found[start : start + windows + window - 1]).decode("utf-8", "surrogatepass")
                    yield pa.RecordBatch.from_arrays([pa.array([item]), pa.array([part])], names=["item", "body"])

    return rows.mapInArrow(cut, "item string, body string")


def _united(lists: pa.Array) -> pa.Array:
    """Ranges without overlap from ranges of several automata."""
    out = []
    for ranges in lists.to_pylist():
        own: list[dict] = []
        for r in sorted(ranges, key=lambda r: (r["first"], r["beyond"])):
            if own and own[-1]["beyond"] >= r["first"]:
                if r["beyond"] > own[-1]["beyond"]:
                    own[-1] |= {"beyond": r["beyond"], "stop": r["stop"]}
            else:
                own.append(dict(r))
        out.append(own)
    return pa.array(out, _RANGES)


def _hits_in_parts(
    docs: DataFrame, benchmark: DataFrame, text: str, item_key: str, item_texts: tuple[str, ...], window: int, size: int, most_bytes: int,
) -> DataFrame:
    """Hits of each distinct text that has any: ``_digest`` (SHA-256), ``items``, ``ranges``.

    Slices of items are dealt by hash over automata of about two thirds of ``most_bytes``. Each automaton scans all
    texts in a job of its own, which writes its hits, and is given up before the next one is built.
    """
    slices = written(cut_items(benchmark, item_key, item_texts, window, max(1, most_bytes // 256)), "benchmark-slices")
    count = -(-3 * size // (2 * most_bytes))
    found = []
    for number in range(count):
        own = slices.filter(F.pmod(F.xxhash64("item", "body"), F.lit(count)) == number)
        shared = docs.sparkSession.sparkContext.broadcast(_gathered(own, "item", ("body",), window))
        scanned = docs.select(F.col(text).alias("text"), hits(F.col(text), shared).alias("hit")).filter("hit.n_hit > 0")
        once = scanned.groupBy(F.sha2("text", 256).alias("_digest")).agg(F.first("hit").alias("hit"))
        found.append(written(once.select("_digest", "hit.items", "hit.ranges"), "benchmark-hits"))
        shared.destroy()
    # A text has one row from each automaton at most.
    joined = reduce(DataFrame.unionByName, found).groupBy("_digest").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"), F.flatten(F.collect_list("ranges")).alias("ranges")
    )
    return joined.select("_digest", "items", F.arrow_udf(_united, RANGES)("ranges").alias("ranges"))


def contamination(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
    item_texts: tuple[str, ...] = ("text",), window: int = WINDOW, most_bytes: int = MOST_BYTES,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_words``, ``n_hit``, ``items``, ``spans``, ``contaminated``.

    A window is ``window`` consecutive words of an item's text; an item with fewer words, but not none, is one
    window. A word inside any occurrence of a window is hit; ``items`` are the items whose windows occur, ``spans``
    the hit words as character ranges of the original text. Null or empty texts have no words and are clean. Items
    with one id count as one, an item without id has the id "". An empty benchmark hits nothing. While the benchmark
    has ``most_bytes`` at most, its windows are broadcast and every text is read once, without a shuffle. Beyond, texts
    are scanned at once, by one automaton after another, and rows meet their hits in a join.
    """
    size = text_bytes(benchmark, item_texts)
    context = docs.sparkSession.sparkContext
    if size <= most_bytes:
        shared = context.broadcast(_gathered(benchmark, item_key, item_texts, window))
        rows = docs.select(F.col(key).alias("doc_id"), hits(F.col(text), shared).alias("hit")).select("doc_id", "hit.*")
    else:
        found = _hits_in_parts(docs, benchmark, text, item_key, item_texts, window, size, most_bytes)
        counted = hits(F.col(text), context.broadcast(Windows({}, {})))["n_words"]
        rows = docs.select(F.col(key).alias("doc_id"), counted.alias("n_words"), F.sha2(text, 256).alias("_digest"))
        rows = rows.join(found, "_digest", "left").select(
            "doc_id", "n_words", F.aggregate(F.coalesce("ranges", F.array().cast(RANGES)), F.lit(0).cast("long"), lambda n, r: n + r["beyond"] - r["first"]).alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"), F.coalesce("ranges", F.array().cast(RANGES)).alias("ranges"),
        )
    spans = F.transform("ranges", lambda r: F.struct(r["start"].alias("start"), r["stop"].alias("stop")))
    return rows.select("doc_id", "n_words", "n_hit", "items", spans.alias("spans"), (F.col("n_hit") > 0).alias("contaminated"))


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "item_id", texts: tuple[str, ...] = ("text",),
    window: int = WINDOW, most_bytes: int = MOST_BYTES,
) -> DataFrame:
    """The rows of ``docs`` that no window hits, all columns; ``key`` and ``texts`` are columns of the benchmark."""
    size = text_bytes(benchmark, texts)
    if size > most_bytes:
        found = _hits_in_parts(docs, benchmark, text, key, texts, window, size, most_bytes).select("_digest")
        hit = F.sha2(docs[text], 256) == found["_digest"]
        return docs.join(found, hit, "left_anti")
    shared = docs.sparkSession.sparkContext.broadcast(_gathered(benchmark, key, texts, window))
    return docs.filter(hits(F.col(text), shared)["n_hit"] == 0)


def digests(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )
