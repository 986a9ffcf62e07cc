"""Prefix tries, repairs and product search against plain Python, with odd tables."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import defaultdict

import pytest

from candlewick.llm import prefix_trie, repair, search


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def odd_conversations():
    """Shared beginnings, equal conversations, nulls, ties, one long conversation, one hot first turn."""
    rng = random.Random(11)
    rows = []
    for conv in range(260):
        said = ["Hello there." if conv % 3 else "Hi."] + [rng.choice(["Yes.", "No!", "why", "", " \t", "Tell me more?"]) for _ in range(rng.randrange(6))]
        for turn, text in enumerate(said):
            rows.append((conv, turn, rng.choice(["user", "assistant", "system", "user", "tool"]) if turn else "user", text))
    rows += [(300, turn, "user" if turn % 2 == 0 else "assistant", f"line {turn}.") for turn in range(700)]
    rows += [(301, None, "user", "late"), (301, 0, None, None), (301, 0, "user", "b."), (301, 0, "user", "a."), (301, 0, "user", "a.")]
    rows += [(302, None, None, None), (400, 5, "", ""), (None, 0, "user", "nobody."), (None, None, "assistant", "no"), (-7, 0, "user", "x.")]
    return rows


CONVERSATION = "conv_id long, turn long, role string, text string, node long, path string, audit string, kind int, place int"


@pytest.fixture
def conversations(spark):
    return spark.createDataFrame([(*r, 1, "p", "a", 2, 3) for r in odd_conversations()], CONVERSATION)


def ordered(rows, blank: str):
    """Turns of each conversation: null turns first, then by role and MD5 of the text."""
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = role if role is not None else blank, text if text is not None else blank
        convs[conv].append((turn is not None, turn or 0, role, hashlib.md5(text.encode()).hexdigest(), text))
    return {conv: sorted(turns) for conv, turns in convs.items()}


def plain_trie(paths):
    nodes = defaultdict(list)
    for conv, path in paths.items():
        for depth in range(len(path) + 1):
            nodes[path[:depth]].append(conv)
    children = defaultdict(int)
    for node in nodes:
        if node:
            children[node[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, members in nodes.items():
        for depth in range(len(node) + 1):
            leaves[node[:depth]] += node not in children
            saved[node[:depth]] += (len(members) - 1) * (len(node[-1][1]) if node else 0)
    out = []
    for node, members in nodes.items():
        ends = sorted(c for c in members if len(paths[c]) == len(node))
        out.append((
            min(members), len(node), min(nodes[node[:-1]]) if node else None, len(members), children.get(node, 0), leaves[node],
            saved[node], sha(",".join(map(str, ends))),
        ))
    return sorted(out, key=repr)


NODE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def as_nodes(df):
    return sorted((tuple(r[c] for c in NODE) for r in df.collect()), key=repr)


@pytest.mark.parametrize("turns", [5, 400_000])
def test_trie_of_rebuilt_conversations(conversations, monkeypatch, turns):
    monkeypatch.setattr(prefix_trie, "TURNS", turns)  # few turns: tries are expanded many times
    monkeypatch.setattr(prefix_trie, "PIECE", 50)  # lists of ids come in several pieces
    own = {c: tuple((role, text) for *_, role, _, text in turns) for c, turns in ordered(odd_conversations(), "").items() if c is not None}
    rebuilt = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 6
        rebuilt[conv] = own.get(conv - int(math.fmod(conv, 100)), ())[:h] + turns[h:]
    assert as_nodes(prefix_trie.prefix_trie(prefix_trie.rebuilt(prefix_trie.paths(conversations)))) == plain_trie(rebuilt)
    assert as_nodes(prefix_trie.prefix_trie(prefix_trie.paths(conversations.union(conversations.limit(0))))) == plain_trie(own)


def test_trie_of_no_conversations(conversations):
    assert prefix_trie.prefix_trie(prefix_trie.paths(conversations.limit(0))).count() == 0


def test_z_fast_trie_locates_and_expands_all_prefixes():
    rng = random.Random(3)
    for _ in range(200):
        trie, kept = prefix_trie.ZFastTrie(), {}
        for place in range(rng.randrange(1, 40)):
            steps = tuple(rng.randrange(2) for _ in range(rng.randrange(20)))
            if steps not in kept:
                path = [prefix_trie.ROOT, *(bytes([len(steps[:i]), *steps[:i]]) for i in range(1, len(steps) + 1))]
                trie.insert(path, [0] * len(path), (1, place, place, place, 0))
                kept[steps] = place
        prefixes = {steps[:i] for steps in kept for i in range(len(steps) + 1)}
        rows = list(trie.expanded())
        assert len(rows) == len(prefixes)
        for node, depth, _, _, count, least, *_, one, _ in rows:
            steps = tuple(node[1:]) if depth else ()
            members = [place for s, place in kept.items() if s[:depth] == steps]
            assert (count, least) == (len(members), min(members)) and one == kept.get(steps)


def plain_repair(rows):
    """Cheapest audit by one pass over layers of labels (cost, audit, lines)."""
    none = (1 << 60, "", ())

    def inserted(labels):
        labels = list(labels)
        for _ in range(4):
            for state, label in enumerate(list(labels)):
                end = repair.TURN[state]
                if label != none:
                    labels[end] = min(labels[end], (label[0] + 5, label[1] + "I", (*label[2], f"{repair.ROLES[end]}:")))
        return labels

    labels = inserted([(0, "", ()), none, none, none])
    for role, text, fault in rows:
        after = [none] * 4
        for state, (cost, audit, lines) in enumerate(labels):
            if (cost, audit, lines) == none:
                continue
            after[state] = min(after[state], (cost + 2, audit + "D", lines))
            if fault in ("", "t"):
                more, end = 5 if fault else 0, repair.TURN[state]
                after[end] = min(after[end], (cost + 1 + more, audit + "R", (*lines, f"{repair.ROLES[end]}:{text}")))
                if role[:1] in repair.KEPT[state]:
                    end = repair.KEPT[state][role[:1]]
                    after[end] = min(after[end], (cost + more, audit + "K", (*lines, f"{role}:{text}")))
        labels = inserted(after)
    return min(labels[0], labels[3])


def plain_report(turns):
    damaged = []
    for numbered, turn, role, _, text in turns:
        name = f"{turns.conv if turns.conv is not None else ' '}:{turn if numbered else ' '}"
        kind = zlib.crc32(name.encode()) % 20
        role = "user" if kind == 4 else role
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        damaged += [(turn if numbered else None, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    if not damaged:
        return (0, 0, 0, 0, 0, 0, "", sha(""))
    seen, judged, count = set(), [], defaultdict(int)
    for _, role, text in damaged:
        bare = text.rstrip(" \t\n\x0b\x0c\r")
        fault = "b" if not bare else "d" if (role, text) in seen else "" if bare[-1] in ".!?" else "t"
        seen.add((role, text))
        count[fault] += 1
        judged.append((role, text, fault))
    numbers = [t for t, *_ in damaged if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(damaged, damaged[1:]))
    cost, audit, lines = plain_repair(judged)
    return (gaps, count["b"], count["d"], count["t"], illegal, cost, audit, sha("\n".join(lines)))


class Turns(list):
    conv: int | None = None


REPORT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def test_repairs(conversations):
    reports, turns = repair.repair(repair.damage(conversations))
    found = {r.conv_id: tuple(r[c] for c in REPORT) for r in repair.digests(conversations, reports, turns).collect()}
    expected = {}
    for conv, rows in ordered(odd_conversations(), " ").items():
        own = Turns(rows)
        own.conv = conv
        expected[conv] = plain_report(own)
    assert found == expected


def test_no_conversations_need_no_repair(conversations):
    none = conversations.limit(0)
    assert repair.digests(none, *repair.repair(repair.damage(none))).count() == 0


def test_cheapest_audits_equal_a_plain_pass():
    rng, names = random.Random(1), {"": repair.FINE, "b": repair.BLANK, "d": repair.DUPLICATE, "t": repair.CUT}
    for _ in range(4000):
        roles = rng.choice(["ua", "suuaa", "suax"])
        rows = [(rng.choice(roles), rng.choice(rng.choice(["", "t", "bdt"]) or [""])) for _ in range(rng.randrange(10))]
        plain = plain_repair([(role, "x", fault) for role, fault in rows])
        assert repair.cheapest([(role, names[fault]) for role, fault in rows]) == plain[:2]


def plain_search(rows, k):
    numbers = [
        (name, [math.floor(64 * x) for x in v]) for name, v in rows
        if name is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for query, q in dict.fromkeys((n, tuple(v)) for n, v in numbers if n % 20 == 0):
        scores = sorted((-sum(a * b for a, b in zip(q, v)), name) for name, v in numbers if name != query)
        out += [(query, rank + 1, name, -score) for rank, (score, name) in enumerate(scores[:k])]
    return sorted(out)


def found_by(vectors, **more):
    from pyspark.sql import functions as F

    return sorted(tuple(r) for r in search.top_products(vectors, F.col("vec_id") % 20 == 0, **more).select("query_id", "rank", "vec_id", "score").collect())


@pytest.mark.parametrize("block", [8192, 4])
def test_search(spark, monkeypatch, block):
    monkeypatch.setattr(search, "TILE_VECTORS", 37)
    monkeypatch.setattr(search, "TILE_QUERIES", 3)
    rng = random.Random(7)
    centres = [[rng.gauss(0, 1) for _ in range(19)] for _ in range(4)]
    rows = [(i, [c + rng.gauss(0, 0.2) for c in centres[i % 4]]) for i in range(300)]
    rows += [(1000 + i, rows[3][1]) for i in range(60)]  # ties
    rows += [(rows[20][0], rows[20][1]), (rows[5][0], rows[5][1]), (40, [1.0] * 19)]  # repeated rows and ids
    rows += [(2000, None), (2020, [None] * 19), (2040, [float("nan")] * 19), (2060, [float("inf")] * 19), (None, [1.0] * 19)]
    rows += [(2080, []), (2100, [1000.5, -3.25]), (2101, [400000.0] * 19), (2120, [-400000.0] * 19)]  # short ones, large ones
    vectors = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "vec_id long, embedding array<double>, v int, query int, score int")
    assert found_by(vectors, k=20, block=block) == plain_search(rows, 20)


def test_search_in_few_or_no_vectors(spark):
    vectors = spark.createDataFrame([(0, [1.0, 2.0]), (1, [0.5, 0.5]), (20, [0.0, -1.0])], "vec_id long, embedding array<float>")
    assert found_by(vectors, k=20) == plain_search([(0, [1.0, 2.0]), (1, [0.5, 0.5]), (20, [0.0, -1.0])], 20)
    assert found_by(vectors.limit(0), k=20) == []


def test_coarse_statistics_bound_products():
    import numpy as np

    x = np.random.default_rng(2).integers(-50, 50, (80, 21)).astype(float)
    exact = x @ x.T
    for segments in (1, 4, 16, 64):
        s = search.statistics(x, segments)
        assert (s @ s.T >= exact - 1e-6).all()
    assert np.allclose(np.diag(search.statistics(x, 4) @ search.statistics(x, 4).T), np.diag(exact))
