"""The registered text queries against SQL and against plain Python, over whole tables."""

from __future__ import annotations

import zlib
from collections import defaultdict

import duckdb
import pytest
from tests.compare import DATA, database, difference, spark_result, sql_result

from candlewick.llm.queries import ORACLES, QUERIES, TOKENIZER
from tests.llm import brute

SF = "0.001"


@pytest.fixture(scope="module")
def docs():
    return duckdb.sql(f"SELECT doc_id, text FROM '{DATA}/sf{SF}/documents.parquet' ORDER BY doc_id").fetchall()


def rows(spark, name):
    return QUERIES[name](spark, f"{DATA}/sf{SF}").collect()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    actual = spark_result(QUERIES[name](spark, f"{DATA}/sf{SF}"))
    assert difference(actual, sql_result(database(SF), ORACLES[name])) is None


def test_packing_holds_every_id_once(spark, docs):
    ids = dict(zip([d[0] for d in docs], brute.library_ids(TOKENIZER, [d[1] or "" for d in docs]), strict=True))
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows(spark, "op1_packing"):
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert pieces.keys() == ids.keys()
    for key, own in pieces.items():
        whole = [*ids[key], 1]
        at = 0
        for r in sorted(own, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(whole)
            assert brute.crc_of_ids(whole[at : at + r.length]) == r.ids_crc32
            at += r.length
        assert at == len(whole)
    padding = 0
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert 0 < at <= 2048
        padding += 2048 - at if at & (at - 1) else 0
    assert padding == 0  # a power of two is not padded


def test_sharding_law(spark, docs):
    found = rows(spark, "op2_sharding")
    assert sorted(r.doc_id for r in found) == [d[0] for d in docs]
    text, slots = dict(docs), defaultdict(list)
    for r in found:
        body = (text[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law) == (len(body) + 16, zlib.crc32(body), "key")
        assert 0 <= r.shard < 40 and r.grown_shard in (r.shard, 40)
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_quality_on_held_out_rows(spark):
    found = {r.doc_id: r for r in QUERIES["op3_quality"](spark, f"{DATA}/sf0.01").collect()}
    labels = duckdb.sql(f"SELECT doc_id, quality FROM '{DATA}/sf0.01/labels.parquet'").fetchall()
    held = [(found[k], q) for k, q in labels if found[k].held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in found.values())
    assert held and sum(r.predicted == q for r, q in held) >= 0.98 * len(held)


def test_token_counts(spark, docs):
    found = {r.doc_id: r for r in rows(spark, "op4_token_counts")}
    for (key, text), ids in zip(docs, brute.library_ids(TOKENIZER, [d[1] or "" for d in docs]), strict=True):
        assert (found[key].n_bytes, found[key].n_tokens, found[key].over_limit) == (len((text or "").encode()), len(ids), len(ids) > 512)


def test_near_duplicates(spark, docs):
    expected = brute.near_duplicates(docs, 3, 85)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows(spark, "op5_near_dedup")} == expected


def test_token_files(spark, docs):
    found = {r.doc_id: r for r in rows(spark, "op7_token_files")}
    start = 0
    for (key, _), ids in zip(docs, brute.library_ids(TOKENIZER, [d[1] or "" for d in docs]), strict=True):
        r = found[key]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids) + 1, brute.crc_of_ids([*ids, 0]))
        start += len(ids) + 1
