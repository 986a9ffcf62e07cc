"""The corpus pipeline's stages, each against a plain version on what its predecessor kept."""

from __future__ import annotations

import duckdb
from tests.compare import DATA

import corpus_pipeline
from candlewick.llm.queries import QUERIES, TOKENIZER
from candlewick.llm.tables import written
from tests.llm import brute

SF = f"{DATA}/sf0.001"


def texts(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = texts(docs)
        docs = written(stage(spark, docs, SF), f"test-{name}")
        assert docs.columns == columns
        kept[name] = (before, texts(docs))
        assert docs.count() == len(kept[name][1]) and kept[name][1].items() <= before.items()

    before, after = kept["quality"]
    scores = {r.doc_id: r.predicted for r in QUERIES["op3_quality"](spark, SF).collect()}
    assert set(after) == {k for k, predicted in scores.items() if predicted}
    labels = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{SF}/labels.parquet'").fetchall())
    right = [(k in after) == bool(quality) for k, quality in labels.items()]
    assert sum(right) >= 0.95 * len(right)

    before, after = kept["exact_dedup"]
    largest = {}
    for key, text in before.items():
        largest[text or ""] = max(key, largest.get(text or "", -1))
    assert set(after) == set(largest.values())

    before, after = kept["near_dedup"]
    assert set(after) == {k for k, (_, _, stays) in brute.near_duplicates(list(before.items()), 5, 80).items() if stays}

    before, after = kept["decontamination"]
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
    found = brute.contamination(list(before.items()), items)
    assert set(after) == {k for k, (_, n_hit, _) in found.items() if not n_hit} and len(after) < len(before)

    ids = brute.library_ids(TOKENIZER, [t or "" for t in after.values()])
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert sum(r.length for r in pieces) == sum(len(i) + 1 for i in ids) and {r.doc_id for r in pieces} == set(after)


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF)
    assert rows.count() > 0 and rows.groupBy("sequence_id").sum("length").where("`sum(length)` > 2048").isEmpty()
