"""Token counts and token ids of whole texts, with the public tokenizer libraries.

Counts come from batch encoding: long texts are cut at safe places, and batches are balanced by bytes.

Ids: a byte-level tokenizer cuts a text into short pieces and encodes every piece by itself. The same piece therefore has
the same ids wherever it stands: ``ByteLevelEncoder`` cuts texts at exactly these boundaries, gives unknown pieces to
the library's model and remembers the answers of the last few hundred thousand pieces. Texts with special strings, or
with characters whose Unicode class changed between library versions, go to the library itself, long ones in parts.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.llm.tables import sliced, whole

#: Characters of a part of a long text; UTF-8 bytes that a batch given to a library holds at most, unless one part
#: alone is longer.
PART_CHARS, BATCH_BYTES = 1 << 18, 1 << 20
#: Pieces remembered in each of two generations (some 200 bytes a piece); long pieces are not kept.
KEPT_PIECES, LONGEST_KEPT = 250_000, 48

# Letters, numbers and spaces below U+0250, the same in every Unicode version in use.
_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_NUMBERS = "0-9²³¹¼-¾"
_SPACES = "\t-\r \u00a0"
#: The byte-level split rule over these characters.
PIECES = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[{_NUMBERS}]+| ?[^{_SPACES}{_LETTERS}{_NUMBERS}]+"
    f"|[{_SPACES}]+(?![^{_SPACES}])|[{_SPACES}]+"
)
#: Any other character: the controls that libraries class differently, and all from U+0250 on.
UNSETTLED = re.compile("[\x1c-\x1f\x85ɐ-\U0010ffff]")
#: A letter, then a space and a letter: a byte-level tokenizer always starts a new piece at that space.
_BOUNDARY = re.compile("(?<=[A-Za-z])(?= [A-Za-z])")


class Recent(dict):
    """Answers of ``compute`` for recent keys; two generations of ``kept`` bound the memory and keep frequent keys."""

    def __init__(self, compute: Callable, kept: int | None = None):
        super().__init__()
        self.compute, self.older, self.kept = compute, {}, kept or KEPT_PIECES

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
        if len(key) <= LONGEST_KEPT:
            if len(self) >= self.kept:
                self.older = dict(self)
                self.clear()
            self[key] = value
        return value


def parts(text: str, most: int | None = None) -> Iterator[str]:
    """The text in parts of about ``most`` characters, cut only where a byte-level tokenizer starts a new piece."""
    at, most = 0, most or PART_CHARS
    while len(text) - at > most:
        found = _BOUNDARY.search(text, at + most)
        if not found:
            break
        yield text[at : found.start()]
        at = found.start()
    yield text[at:]


class ByteLevelEncoder:
    """Ids of a byte-level BPE file of the ``tokenizers`` library, without added special tokens."""

    def __init__(self, path: str):
        self.library = _library(path)
        self.specials = sorted(t.content for t in self.library.get_added_tokens_decoder().values())
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = iter(range(256, 512))
        self.letters = {b: chr(b) if b in printable else chr(next(others)) for b in range(256)}
        self._ids = Recent(self._piece)

    def _piece(self, piece: str) -> bytes:
        shown = piece.encode().decode("latin-1").translate(self.letters)
        return np.array([t.id for t in self.library.model.tokenize(shown)], "<u4").tobytes()

    def _settled(self, text: str) -> bool:
        return not any(s in text for s in self.specials) and UNSETTLED.search(text) is None

    def _by_library(self, text: str) -> Iterator[np.ndarray]:
        cut = all(" " not in s for s in self.specials)
        for part in parts(text) if cut else [text]:
            yield np.array(self.library.encode(part, add_special_tokens=False).ids, "<u4")

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if self._settled(text):
            return b"".join(map(self._ids.__getitem__, PIECES.findall(text)))
        return b"".join(x.tobytes() for x in self._by_library(text))


class BatchCounter:
    """Lengths from the library's batch encoding. Long texts are cut where the tokenizer is byte-level."""

    def __init__(self, path: str):
        self.cut = lambda text: [text]
        if path.endswith(".model"):
            import sentencepiece

            library = sentencepiece.SentencePieceProcessor(model_file=path)
            self.encode = lambda texts: map(len, library.encode(texts, num_threads=1))
        else:
            library = _library(path)
            self.encode = lambda texts: map(len, library.encode_batch(texts, add_special_tokens=False))
            specials = [t.content for t in library.get_added_tokens_decoder().values()]
            if _is_byte_level(path) and all(" " not in s for s in specials):
                self.cut = parts

    def counts(self, texts: list[str]) -> list[int]:
        found = [0] * len(texts)
        for batch in balanced((number, part) for number, text in enumerate(texts) for part in self.cut(text)):
            for (number, _), n in zip(batch, self.encode([part for _, part in batch]), strict=True):
                found[number] += n
        return found


def balanced(numbered: Iterable[tuple[int, str]]) -> Iterator[list[tuple[int, str]]]:
    """Parts with the numbers of their texts, in their order, in batches of about equal size in bytes."""
    batch, size = [], 0
    for number, part in numbered:
        weight = len(part.encode("utf-8", "surrogatepass"))
        if batch and size + weight > BATCH_BYTES:
            yield batch
            batch, size = [], 0
        batch.append((number, part))
        size += weight
    if batch:
        yield batch


def _library(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()
    return library


def _is_byte_level(path: str) -> bool:
    if not path.endswith(".json"):
        return False
    with open(path, encoding="utf-8") as file:
        kind = json.load(file)
    before, model = kind.get("pre_tokenizer") or {}, kind.get("model") or {}
    return (
        before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
        and not kind.get("normalizer") and model.get("type") == "BPE" and not model.get("dropout")
    )


@lru_cache(maxsize=4)
def byte_level(path: str) -> ByteLevelEncoder:
    """One encoder for each worker process."""
    if not _is_byte_level(path):
        raise ValueError(f"{path} is no plain byte-level BPE file")
    return ByteLevelEncoder(path)


@lru_cache(maxsize=4)
def counter(path: str) -> BatchCounter:
    return BatchCounter(path)


def token_count(text: Column, tokenizer: str) -> Column:
    """Tokens of a text column; only the lengths leave the Python workers."""

    @F.arrow_udf("long")
    def lengths(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        count = counter(tokenizer)
        for batch in batches:
            found = [n for part in sliced(batch) for n in count.counts(["" if t is None else t for t in part.to_pylist()])]
            yield pa.array(found, pa.int64())

    return lengths(text)


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 512, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: the key, ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit`` (more than ``limit``).

    ``tokenizer`` is the path of a vocabulary file at the same place on every machine. A null or empty text has no
    bytes and no tokens. Repeated rows and null keys are counted like any other; other columns are not read. No
    shuffle: a lost task is simply run again.
    """
    rows = docs.select(F.col(key).alias(key), whole(text).alias("text"))
    counted = rows.select(key, F.octet_length("text").cast("long").alias("n_bytes"), token_count(F.col("text"), tokenizer).alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
