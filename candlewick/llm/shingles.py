"""Word shingles of whole texts as sorted sets of 64-bit hashes, and minhash sketches of them."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_IN_WORD = np.array([b != 0x20 and not 0x09 <= b <= 0x0D for b in range(256)])
_START, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
#: Bytes of a text that are hashed at once, and of a word that is hashed with its neighbours; longer ones alone.
PART, LONG_WORD = 1 << 20, 4096
#: Shingles that are hashed at once, so that very long texts need little memory.
SLICE = 512

# A word's hash is the sum of its bytes' random values, each times the power of an odd number by its place.
_VALUES = np.random.default_rng(20240101).integers(0, 1 << 64, 256, np.uint64) | np.uint64(1)
_POWERS = np.cumprod(np.full(LONG_WORD, 0xD6E8FEB86659FD93, np.uint64), dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _STEP
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _parts(data: bytes) -> Iterator[bytes]:
    """The text in parts of about ``PART`` bytes, cut between words."""
    at = 0
    while len(data) - at > PART:
        cut = re.compile(rb"[\x20\x09-\x0D]").search(data, at + PART)
        if not cut:
            break
        yield data[at : cut.start()]
        at = cut.start()
    yield data[at:]


def _hashes_of(data: bytes) -> np.ndarray:
    inside = _IN_WORD[np.frombuffer(data, np.uint8)]
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False]))))
    starts, stops = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = stops - starts
    long = np.flatnonzero(lengths > LONG_WORD)
    for w in long:
        inside[starts[w] : stops[w]] = False
    short = np.where(lengths > LONG_WORD, 0, lengths)
    body = np.frombuffer(data, np.uint8)[inside]
    offsets = np.concatenate(([0], np.cumsum(short)[:-1]))
    place = np.arange(len(body)) - np.repeat(offsets, short)
    sums = np.zeros(len(starts), np.uint64)
    held = short > 0
    if len(body):
        sums[held] = np.add.reduceat(_VALUES[body] * _POWERS[place], offsets[held])
    out = _mixed(sums + lengths.astype(np.uint64) * _START)
    for w in long:
        out[w] = int.from_bytes(hashlib.blake2b(data[starts[w] : stops[w]], digest_size=8).digest(), "little")
    return out


def word_hashes(text: str) -> np.ndarray:
    """64-bit hashes of the words: runs of anything but space and \\x09-\\x0D, after lower-casing A-Z."""
    data = text.encode("utf-8", "surrogatepass").translate(_LOWER)
    return np.concatenate([_hashes_of(part) for part in _parts(data)])


def shingles_of(text: str | None, size: int) -> np.ndarray:
    """The set of ``size``-word shingles, sorted; a shorter text is one shingle of all its words, one without words none."""
    hashes = word_hashes(text or "")
    size = min(size, len(hashes))
    if not size:
        return hashes
    out = np.full(len(hashes) - size + 1, np.uint64(size + 1), np.uint64)
    for i in range(size):
        out = _mixed(out + hashes[i : i + len(out)] * _START)
    out.sort()
    return out[np.concatenate(([True], out[1:] != out[:-1]))]


def set_digest(shingles: np.ndarray) -> bytes:
    """Sixteen bytes that stand for a whole set."""
    return hashlib.blake2b(shingles.astype("<u8").tobytes(), digest_size=16).digest()


class Sketcher:
    """Two collections of ``tables`` sketches each, every sketch a hash of ``rows`` minhashes."""

    def __init__(self, tables: int, rows: int, seed: int = 0):
        self.tables, self.rows = tables, rows
        draw = np.random.default_rng(seed)
        count = 2 * tables * rows
        self.factors = draw.integers(0, 1 << 32, count, np.uint32) | np.uint32(1)
        self.masks = draw.integers(0, 1 << 32, count, np.uint32)

    def __call__(self, shingles: np.ndarray) -> np.ndarray:
        """Signed 64-bit sketches, those of the first collection before those of the second."""
        short = (shingles >> np.uint64(32)).astype(np.uint32)
        least = np.full(len(self.factors), np.uint32(0xFFFFFFFF))
        room = np.empty((min(SLICE, len(short)), len(least)), np.uint32)
        for at in range(0, len(short), SLICE):
            part = short[at : at + SLICE]
            hashed = room[: len(part)]
            np.bitwise_xor(part[:, None], self.masks[None, :], out=hashed)
            np.multiply(hashed, self.factors[None, :], out=hashed)
            np.minimum(least, hashed.min(axis=0), out=least)
        grid = least.astype(np.uint64).reshape(2 * self.tables, self.rows)
        out = np.arange(1, 2 * self.tables + 1, dtype=np.uint64)  # table numbers keep equal values apart
        for i in range(self.rows):
            out = _mixed(out * _START + grid[:, i])
        return out.view(np.int64)


@lru_cache(maxsize=4)
def sketcher(tables: int, rows: int, seed: int) -> Sketcher:
    return Sketcher(tables, rows, seed)
