"""Repair of conversations by the cheapest edits, found by Dijkstra from both ends of the edit lattice.

A lattice node is a number of rows taken and what the kept roles end in; an edit is an edge. A forward search from the
start and a reverse search from the accepted ends settle nodes by cost until no cheaper or equally cheap crossing can
come. An audit (the edits' initials) leads to exactly one node, so two audits are compared where their paths part in
the tree of the forward search; in the reverse search the first letter decides. No audit is written out before the
last choice, so a long conversation needs memory for its nodes only.

Texts are shuffled once: faults are found from digests, and repaired rows are made while rows stream by in order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from heapq import heappop, heappush
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.llm.tables import written

#: ASCII white space; a text of nothing else is blank.
SPACE = " \t\n\x0b\x0c\r"
#: Cost of an edit; a row that ends early and is not deleted costs ``TRUNCATED`` more.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: What the kept roles end in: nothing yet, a system turn, a user turn, an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
#: State after a rerole or an insertion (there is one choice), and after a kept role of a given initial.
TURN = (USER, USER, ASSISTANT, USER)
KEPT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
ROLES = {USER: "user", ASSISTANT: "assistant"}
#: Faults of a row: none, no text, said before, no mark at its end.
FINE, BLANK, DUPLICATE, CUT = range(4)


def damage(conversations: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id``, ``turn``, ``role``, ``text`` of damaged rows, with what orders rows of one turn: ``tie``, ``mark``, ``copy``.

    The rest of crc32 of ``conv_id:turn`` by 20 tells what happens: 0 drops the row, 1 empties its text, 2 removes its
    full stops, exclamation and question marks, 3 repeats it, 4 makes its role ``user``. Null is one space in roles,
    texts and that string; a null turn stays null. Rows of one turn follow by role and MD5 of the text before damage.
    """
    conv, number = F.col(key).cast("long"), F.col(turn).cast("long")
    name, said = F.coalesce(F.col(role), F.lit(" ")), F.coalesce(F.col(text), F.lit(" "))
    spoken = lambda c: F.coalesce(c.cast("string"), F.lit(" "))
    kind = F.crc32(F.encode(F.concat(spoken(conv), F.lit(":"), spoken(number)), "UTF-8")) % 20
    rows = conversations.select(conv.alias("conv_id"), number.alias("turn"), name.alias("tie"), said.alias("said"), kind.alias("kind"))
    rows = rows.filter("kind <> 0").withColumn("copy", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    return rows.select(
        "conv_id", "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("tie")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("said", ".!?", "")).otherwise(F.col("said")).alias("text"),
        "tie", F.md5("said").alias("mark"), "copy",
    )


#: Order of a conversation's rows.
ORDER = ("turn", "tie", "mark", "copy")


def _order() -> list[Column]:
    return [F.col("turn").asc_nulls_first(), *[F.col(c) for c in ORDER[1:]]]


def faults(rows: DataFrame) -> DataFrame:
    """``conv_id``, ``place`` (from 1), ``turn``, ``initial`` of the role, ``fault``: the first that holds of no text,
    role and text said before, no full stop, exclamation or question mark at the end. Reads texts, keeps digests."""
    stripped = F.rtrim("text", F.lit(SPACE))
    narrow = rows.select(
        "conv_id", *ORDER, "role", F.md5("text").alias("digest"), (stripped == "").alias("blank"),
        F.substring(stripped, -1, 1).isin(".", "!", "?").alias("ended"),
    )
    placed = narrow.withColumn("place", F.row_number().over(Window.partitionBy("conv_id").orderBy(*_order())))
    seen = F.row_number().over(Window.partitionBy("conv_id", "role", "digest").orderBy("place"))
    fault = F.when(F.col("blank"), BLANK).when(F.col("seen") > 1, DUPLICATE).when(F.col("ended"), FINE).otherwise(CUT)
    return placed.withColumn("seen", seen).select("conv_id", "place", "turn", F.substring("role", 1, 1).alias("initial"), fault.alias("fault"))


class _Paths:
    """Shortest paths from the start as a tree with jump pointers, so that two audits are compared in few steps."""

    def __init__(self, root: int):
        self.parent, self.jump, self.depth, self.letter = {root: root}, {root: root}, {root: 0}, {root: ""}

    def add(self, node: int, parent: int, letter: str) -> None:
        over = self.jump[parent]
        even = self.depth[parent] - self.depth[over] == self.depth[over] - self.depth[self.jump[over]]
        self.parent[node], self.letter[node] = parent, letter
        self.jump[node], self.depth[node] = (self.jump[over] if even else parent), self.depth[parent] + 1

    def _above(self, node: int, depth: int) -> int:
        while self.depth[node] > depth:
            over = self.jump[node]
            node = over if self.depth[over] >= depth else self.parent[node]
        return node

    def before(self, one: tuple[int, str], other: tuple[int, str]) -> bool:
        """Whether the audit of ``one`` (a node and the letter after it) comes before that of ``other``."""
        (p, p_letter), (q, q_letter) = one, other
        depth = min(self.depth[p], self.depth[q])
        a, b = self._above(p, depth), self._above(q, depth)
        if a == b:  # one path goes on from the other's node
            step = lambda node, letter: letter if node == a else self.letter[self._above(node, depth + 1)]
            return step(p, p_letter) < step(q, q_letter)
        while self.parent[a] != self.parent[b]:
            a, b = (self.jump[a], self.jump[b]) if self.jump[a] != self.jump[b] else (self.parent[a], self.parent[b])
        return self.letter[a] < self.letter[b]

    def audit(self, node: int) -> str:
        letters = []
        while self.depth[node]:
            letters.append(self.letter[node])
            node = self.parent[node]
        return "".join(reversed(letters))


def _after(rows: list[tuple[str, int]], node: int) -> Iterator[tuple[int, str, int]]:
    """Cost, letter and end of every edit at a node (four times the rows taken, plus the state)."""
    i, state = divmod(node, 4)
    yield INSERT, "I", 4 * i + TURN[state]
    if i < len(rows):
        initial, fault = rows[i]
        yield DELETE, "D", node + 4
        if fault in (FINE, CUT):
            more = TRUNCATED if fault == CUT else 0
            yield REROLE + more, "R", 4 * i + 4 + TURN[state]
            if initial in KEPT[state]:
                yield KEEP + more, "K", 4 * i + 4 + KEPT[state][initial]


def _before(rows: list[tuple[str, int]], node: int) -> Iterator[tuple[int, str, int]]:
    """Cost, letter and start of every edit that leads to a node."""
    i = node // 4
    for start in range(4 * i, 4 * i + 4):
        if TURN[start % 4] == node % 4:
            yield INSERT, "I", start
    if i:
        for start in range(4 * i - 4, 4 * i):
            yield from ((cost, letter, start) for cost, letter, end in _after(rows, start) if end == node)


def cheapest(rows: list[tuple[str, int]]) -> tuple[int, str]:
    """Cost and audit of the cheapest repair of rows given by role initial and fault; of equally cheap ones the least audit."""
    ends = (4 * len(rows) + START, 4 * len(rows) + ASSISTANT)
    paths = _Paths(0)
    there, back = {0: 0}, dict.fromkeys(ends, 0)
    come: dict[int, tuple[int, str]] = {}  # best step so far to a node that the forward search has reached
    go: dict[int, tuple[str, int]] = {}  # best step from a node that the reverse search has reached
    forward, reverse = [(0, 0)], [(0, -end) for end in ends]
    done, met = set(), set()
    best = min((back[x] for x in there if x in back), default=1 << 62)
    # Steps without cost take a row, so in this order a node's label is final when the node is.
    while forward and reverse and forward[0][0] + reverse[0][0] <= best:
        if forward[0][0] <= reverse[0][0]:
            cost, node = heappop(forward)
            if node in done:
                continue
            done.add(node)
            if node:
                paths.add(node, *come[node])
            for more, letter, end in _after(rows, node):
                if end in done:
                    continue
                total = cost + more
                if total < there.get(end, 1 << 62):
                    there[end], come[end] = total, (node, letter)
                    heappush(forward, (total, end))
                    best = min(best, total + back.get(end, 1 << 62))
                elif total == there[end] and paths.before((node, letter), come[end]):
                    come[end] = (node, letter)
        else:
            cost, node = heappop(reverse)
            node = -node
            if node in met:
                continue
            met.add(node)
            for more, letter, start in _before(rows, node):
                if start in met:
                    continue
                total = cost + more
                if total < back.get(start, 1 << 62):
                    back[start], go[start] = total, (letter, node)
                    heappush(reverse, (total, -start))
                    best = min(best, total + there.get(start, 1 << 62))
                elif total == back[start] and letter < go[start][0]:
                    go[start] = (letter, node)
    # Every cheapest path leaves what the forward search has settled by one edge, to a node that the reverse search has settled.
    choice: tuple[int, str, int | None] | None = None
    for node in done:
        crossings = [(letter, end) for more, letter, end in _after(rows, node) if end not in done and end in met and there[node] + more + back[end] == best]
        if node in ends and there[node] == best:
            crossings.append(("", None))
        for letter, end in crossings:
            if choice is None or paths.before((node, letter), choice[:2]):
                choice = (node, letter, end)
    node, letter, end = choice
    letters = [paths.audit(node), letter]
    while end is not None and (end not in ends or back[end]):
        step, end = go[end]
        letters.append(step)
    return best, "".join(letters)


def _groups(batches: Iterator[pa.RecordBatch], columns: int) -> Iterator[list[tuple]]:
    """Rows of sorted batches, in runs of one first value; a run is given in parts of a batch."""
    for batch in batches:
        values = [batch.column(i).to_pylist() for i in range(columns)]
        start = 0
        for stop in chain((i for i in range(1, len(batch)) if values[0][i] != values[0][i - 1]), [len(batch)]):
            if stop > start:
                yield list(zip(*(v[start:stop] for v in values)))
            start = stop


def plans(found: DataFrame) -> DataFrame:
    """One row per conversation of ``faults``: ``conv_id``, ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``, ``cost``, ``audit``."""
    schema = pa.schema([("conv_id", pa.int64()), *[(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], ("audit", pa.string())])

    def planned(conv: int | None, rows: list[tuple[str, int]], turns: list[int], distinct: int) -> tuple:
        count = [0, 0, 0, 0]
        for _, fault in rows:
            count[fault] += 1
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        gaps = min(turns[1] - turns[0] + 1 - distinct, (1 << 63) - 1) if turns else 0
        return (conv, gaps, count[BLANK], count[DUPLICATE], count[CUT], illegal, *cheapest(rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, conv, rows, turns, distinct = [], None, [], [], 0
        for part in _groups(batches, 4):
            if rows and part[0][0] != conv:
                out.append(planned(conv, rows, turns, distinct))
                rows, turns, distinct = [], [], 0
                if len(out) >= 1024:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                    out = []
            conv = part[0][0]
            for _, turn, initial, fault in part:
                rows.append((initial, fault))
                if turn is not None:
                    distinct += not turns or turn != turns[1]
                    turns = [turns[0] if turns else turn, turn]
        if rows:
            out.append(planned(conv, rows, turns, distinct))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    rows = found.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "place").select("conv_id", "turn", "initial", "fault")
    ddl = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
    return rows.mapInArrow(run, ddl)


def repaired(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """The repaired turns, ``conv_id``, ``place`` (from 0), ``role``, ``text``: each conversation's in one partition, in order.

    ``audits`` has ``conv_id`` and ``audit`` of every conversation in ``rows``. Its row comes before the conversation's
    own in one sorted stream, so no conversation is held.
    """
    plan = audits.select("conv_id", F.lit(0).alias("kind"), *[F.lit(None).cast(t).alias(c) for c, t in rows.select(*ORDER).dtypes], F.lit("").alias("role"), F.col("audit").alias("text"))
    both = plan.unionByName(rows.select("conv_id", F.lit(1).alias("kind"), *ORDER, "role", "text"))
    dealt = both.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "kind", *_order()).select("conv_id", "kind", "role", "text")
    schema = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, audit, at, state, place = None, "", 0, START, 0
        out: list[tuple] = []

        def inserted() -> None:
            nonlocal at, state, place
            while audit[at : at + 1] == "I":
                at, state = at + 1, TURN[state]
                out.append((conv, place, ROLES[state], ""))
                place += 1

        for part in _groups(batches, 4):
            for number, kind, role, text in part:
                if not kind:  # the plan of the next conversation; the one before is at its end
                    conv, audit, at, state, place = number, text, 0, START, 0
                else:
                    edit = audit[at]
                    at += 1
                    if edit != "D":
                        state = TURN[state] if edit == "R" else KEPT[state][role[:1]]
                        out.append((conv, place, ROLES[state] if edit == "R" else role, text))
                        place += 1
                inserted()
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                out.clear()

    return dealt.mapInArrow(run, "conv_id long, place long, role string, text string")


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Reports (see ``plans``) and repaired turns (see ``repaired``) of the conversations in ``rows``.

    ``rows`` has the columns of ``damage``. Kept, reroled and inserted turns follow an optional system turn in pairs of
    user and assistant, or there are none. Rows without text or said before are deleted; every edit has a cost, and of
    the cheapest ones the least audit is taken. Rows without conversation are one conversation; an empty table gives
    no row; other columns are not read. A conversation's initials and lattice are held in one task, its texts are not.
    """
    reports = written(plans(faults(rows)), "repair-plans")
    return reports, repaired(rows, reports.select("conv_id", "audit"))


def digests(conversations: DataFrame, reports: DataFrame, turns: DataFrame) -> DataFrame:
    """The reports of every conversation, with ``repaired_sha256`` over its repaired ``role:text`` lines; those without
    rows have zeros and an empty audit. ``turns`` must come in the order of ``repaired``."""
    schema = pa.schema([("conv", pa.int64()), ("repaired_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, conv = None, None
        for batch in batches:
            out = []
            for number, place, role, text in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if not place:
                    if digest:
                        out.append((conv, digest.hexdigest()))
                    digest, conv = hashlib.sha256(), number
                digest.update(f"{'' if not place else chr(10)}{role}:{text}".encode("utf-8", "surrogatepass"))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
        if digest:
            yield pa.RecordBatch.from_pylist([{"conv": conv, "repaired_sha256": digest.hexdigest()}], schema=schema)

    sums = turns.mapInArrow(run, "conv long, repaired_sha256 string")
    every = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    names = reports.columns[1:]
    found = reports.select(F.col("conv_id").alias("_conv"), *names)
    joined = every.join(found, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").join(sums, F.col("conv_id").eqNullSafe(F.col("conv")), "left")
    return joined.select(
        "conv_id", *[F.coalesce(c, F.lit("" if c == "audit" else 0).cast("string" if c == "audit" else "long")).alias(c) for c in names],
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
