"""Plain Python versions of what the text operators return."""

from __future__ import annotations

import re
import zlib
from collections import defaultdict

from tokenizers import Tokenizer


def library_ids(path: str, texts: list[str]) -> list[list[int]]:
    tokenizer = Tokenizer.from_file(path)
    return [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def crc_of_ids(ids: list[int]) -> int:
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))


def lower(text: str) -> str:
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text)


def shingle_set(text: str | None, size: int) -> set[tuple[str, ...]]:
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))
    if not words:
        return set()
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))}


def near_duplicates(docs: list[tuple[int, str | None]], size: int, percent: int) -> dict[int, tuple[int, int, bool]]:
    """By id: set size, component, kept. Compares every pair that shares a shingle."""
    sets = {key: shingle_set(text, size) for key, text in docs}
    by_shingle = defaultdict(list)
    for key, shingles in sets.items():
        for s in shingles:
            by_shingle[s].append(key)
    common = defaultdict(int)
    for keys in by_shingle.values():
        for i, a in enumerate(keys):
            for b in keys[i + 1 :]:
                common[a, b] += 1
    parent = {key: key for key in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, b), n in common.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            low, high = sorted((top(a), top(b)))
            parent[high] = low
    return {key: (len(s), top(key), top(key) == key) for key, s in sets.items()}


def bench_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))


def contamination(docs, items, window: int = 10) -> dict[int, tuple[int, int, list[str]]]:
    windows = defaultdict(set)
    for item, text in items:
        words = bench_words(text)
        n = min(window, len(words))
        for i in range(len(words) - n + 1) if n else ():
            windows[tuple(words[i : i + n])].add(str(item))
    lengths = {len(w) for w in windows}
    out = {}
    for key, text in docs:
        words, hit, named = bench_words(text), set(), set()
        for n in lengths:
            for i in range(len(words) - n + 1):
                found = windows.get(tuple(words[i : i + n]))
                if found:
                    hit.update(range(i, i + n))
                    named |= found
        out[key] = (len(words), len(hit), sorted(named))
    return out
