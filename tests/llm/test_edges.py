"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing columns, damage."""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from candlewick.llm import (
    chat, decontamination, exact_dedup, near_dedup, packing, quality, sharding, shingles, token_files, tokens, warc,
)
from candlewick.llm.queries import TOKENIZER
from tests.llm import brute

LONG = " ".join(f"word{i % 997} naïve" for i in range(60_000))
TEXTS = [
    (1, "one two three four five six seven"), (2, None), (3, ""), (4, " \t\n "), (5, "one two three four five six seven"),
    (6, LONG), (7, "special <|endoftext|> inside"), (8, "ſpécial 漢字  \x1c\x85 emoji 🙂 it's"), (9, "A"), (10, "x" * 5000),
]


@pytest.fixture
def docs(spark):
    """Documents with columns whose names operators use themselves."""
    rows = [(k, t, "s", 7, "r", 1, 2.5, "h", "d") for k, t in TEXTS]
    more = "shard string, node int, record string, _id int, _score double, _hit string, _digest string"
    return spark.createDataFrame(rows, f"doc_id long, text string, {more}")


@pytest.fixture
def none(docs):
    return docs.limit(0)


@pytest.fixture
def repeated(docs):
    """Every row twice, and rows without an id."""
    return docs.union(docs).union(docs.limit(2).withColumn("doc_id", F.lit(None).cast("long")))


def test_token_counts(docs, none, repeated):
    expected = [len(i) for i in brute.library_ids(TOKENIZER, [t or "" for _, t in TEXTS])]
    found = {r.doc_id: r for r in tokens.count_tokens(docs, TOKENIZER).collect()}
    assert [found[k].n_tokens for k, _ in TEXTS] == expected
    assert [found[k].n_bytes for k, _ in TEXTS] == [len((t or "").encode()) for _, t in TEXTS]
    assert tokens.count_tokens(none, TOKENIZER).count() == 0
    assert tokens.count_tokens(repeated, TOKENIZER).count() == 22


def test_pieces_equal_the_library_on_odd_texts():
    rng = random.Random(5)
    letters = "ab  \n\t\r'sdt'll1²¼½.,!?-_éßÑ ×÷ªº\xa0<|endoftext|>漢🙂\x00\x1f\x85"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(3000)]
    encoder = tokens.ByteLevelEncoder(TOKENIZER)
    for text, ids in zip(texts, brute.library_ids(TOKENIZER, texts), strict=True):
        assert np.frombuffer(encoder.ids(text), "<u4").tolist() == ids


def test_long_texts_are_cut_safely(monkeypatch):
    text = "漢 " + " ".join(f"word {i} it's" for i in range(300))
    assert len(list(tokens.parts(text, 40))) > 50 and "".join(tokens.parts(text, 40)) == text
    encoder = tokens.ByteLevelEncoder(TOKENIZER)
    cut = [i for part in tokens.parts(text, 40) for i in encoder.library.encode(part, add_special_tokens=False).ids]
    assert cut == brute.library_ids(TOKENIZER, [text])[0]


def test_batches_of_cut_texts_count_like_whole_ones(monkeypatch):
    monkeypatch.setattr(tokens, "PART_CHARS", 40)
    monkeypatch.setattr(tokens, "BATCH_BYTES", 300)
    texts = [t or "" for _, t in TEXTS[:5] + TEXTS[6:]] + ["é漢 " * 90, "x", " ".join(f"word {i} it's <|endoftext|> a" for i in range(200))]
    counter = tokens.counter.__wrapped__(TOKENIZER)
    assert counter.counts(texts) == [len(i) for i in brute.library_ids(TOKENIZER, texts)]
    cut = [(i, p) for i, t in enumerate(texts) for p in counter.cut(t)]
    batches = list(tokens.balanced(iter(cut)))
    assert [x for b in batches for x in b] == cut and len(cut) > len(texts)
    assert all(len(b) == 1 or sum(len(p.encode()) for _, p in b) <= 300 for b in batches)


def test_other_tokenizers_count_whole_texts():
    import public_tokenizers
    import sentencepiece

    texts = ["One two", "", "x y z" * 50]
    lower = public_tokenizers.path("word_bpe_49k.json")
    assert tokens.counter(lower).counts(texts) == [len(i) for i in brute.library_ids(lower, texts)]
    pieces = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=pieces)
    assert tokens.counter(pieces).counts(texts) == [len(library.encode(t)) for t in texts]


def test_remembered_pieces_stay_bounded(monkeypatch):
    monkeypatch.setattr(tokens, "KEPT_PIECES", 3)
    recent = tokens.Recent(len)
    assert [recent["x" * (i % 7)] for i in range(50)] == [i % 7 for i in range(50)]
    assert len(recent) <= 3 and len(recent.older) <= 3


def check_packed(rows, count):
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    for own in sequences.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == np.concatenate(([0], np.cumsum([r.length for r in own])[:-1])).tolist()
        assert sum(r.length for r in own) <= 2048
    assert sum(r.length for r in rows) == count
    return pieces


def test_packing(docs, none, repeated):
    ids = dict(zip([k for k, _ in TEXTS], brute.library_ids(TOKENIZER, [t or "" for _, t in TEXTS]), strict=True))
    total = sum(len(i) + 1 for i in ids.values())
    pieces = check_packed(packing.pack(docs, TOKENIZER).collect(), total)
    for key, own in pieces.items():
        joined = b"".join(bytes(r.ids) for r in sorted(own, key=lambda r: r.start))
        assert np.frombuffer(joined, "<u4").tolist() == [*ids[key], 1]
    assert packing.pack(none, TOKENIZER).count() == 0
    check_packed(packing.pack(repeated, TOKENIZER).collect(), 2 * total + sum(len(ids[k]) + 1 for k in (1, 2)))


@pytest.mark.parametrize("tasks", [1, 64])
def test_nothing_is_padded_whatever_the_tasks(spark, tasks):
    rng = random.Random(tasks)
    rows = [(k, " ".join(rng.choice(("one", "two words", "Donaudampf")) for _ in range(rng.randrange(900)))) for k in range(300)]
    total = sum(len(i) + 1 for i in brute.library_ids(TOKENIZER, [t for _, t in rows]))
    found = packing.pack(spark.createDataFrame(rows, "doc_id long, text string").repartition(tasks), TOKENIZER).collect()
    check_packed(found, total)
    lengths = {}
    for r in found:
        lengths[r.sequence_id] = lengths.get(r.sequence_id, 0) + r.length
    assert all(n & (n - 1) == 0 for n in lengths.values())
    assert sum(n < 2048 for n in lengths.values()) <= 11 * tasks


def test_differencing_gives_near_equal_windows():
    rng = random.Random(3)
    sizes = [rng.randrange(1, 2048) for _ in range(400)]
    windows = packing.differencing(sizes, 150)
    assert sorted(i for w in windows for i in w) == list(range(400))
    loads = [sum(sizes[i] for i in w) for w in windows]
    assert max(loads) - min(loads) < 600 < max(sizes)
    assert packing.differencing([], 3) == [[], [], []] and packing.differencing([5], 2) == [[0], []]
    pieces = [(i, 0, b"abcd" * n, n) for i, n in enumerate(sizes)]
    full, rest = packing.level(pieces, 2048)
    assert {sum(len(p[2]) // 4 for p in w) for w in full} == {2048} and sum(len(p[2]) // 4 for p in rest) < 2048
    assert len(full) == sum(sizes) // 2048


def test_sharding(spark, docs, none, repeated, tmp_path):
    sharding.write_shards(docs, f"{tmp_path}/a", shards=3, bucket_bytes=2000)
    sharding.write_shards(docs.repartition(4), f"{tmp_path}/b", shards=3, bucket_bytes=2000)
    order = lambda p: sorted((r.shard, r.slot, r.record.doc_id, r.record.shard) for r in sharding.read_shards(spark, p).collect())
    assert order(f"{tmp_path}/a") == order(f"{tmp_path}/b")  # whatever order the rows come in
    assert sharding.read_shards(spark, f"{tmp_path}/a").where("bucket > 0").count() > 0
    sharding.write_shards(repeated, f"{tmp_path}/c", shards=3)
    rows = sharding.digests(spark.read.parquet(f"{tmp_path}/c")).collect()
    assert len(rows) == 22 and len({(r.shard, r.slot) for r in rows}) == 22
    sharding.write_shards(none, f"{tmp_path}/d", shards=3)


def test_shards_of_an_empty_table_are_read(spark, none, docs, tmp_path):
    sharding.write_shards(none, f"{tmp_path}/none", shards=3)
    sharding.write_shards(docs, f"{tmp_path}/some", shards=3)
    empty, some = (spark.read.parquet(f"{tmp_path}/{name}") for name in ("none", "some"))
    assert empty.count() == 0 and empty.dtypes == some.dtypes
    assert sharding.read_shards(spark, f"{tmp_path}/none").count() == 0
    assert sharding.digests(empty).collect() == []


def test_large_groups_of_equal_rows_are_dealt_over_buckets(spark, tmp_path):
    rows = [(7, "again and again", 1)] * 400 + [(None, "no id", i) for i in range(400)] + [(i, f"text {i}", 1) for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, other int")
    found = []
    for name, part in (("a", 3), ("b", 5)):
        sharding.write_shards(docs.repartition(part), f"{tmp_path}/{name}", shards=3, bucket_bytes=1000)
        got = sharding.read_shards(spark, f"{tmp_path}/{name}").collect()
        key = lambda r: (r[0] if r[0] is not None else -1, *r[1:])
        assert sorted(((r.record.doc_id, r.record.text, r.record.other) for r in got), key=key) == sorted(rows, key=key)
        slots = {}
        for r in got:
            slots.setdefault(r.shard, []).append(r.slot)
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        for which in (7, None):
            per = {}
            for r in got:
                if r.record.doc_id == which:
                    per[r.bucket] = per.get(r.bucket, 0) + 1
            assert max(per.values()) <= 90 and len(per) >= 8  # about 32 rows of 31 bytes, or 47 of 21, are a bucket
        found.append(sorted((r.shard, r.bucket, r.record.doc_id or 0, r.record.text) for r in got))
    assert found[0] == found[1]


def test_one_more_shard_takes_only_into_itself(spark):
    keys = spark.range(20_000).select("id", *[sharding.shard_of(F.col("id"), n).alias(f"s{n}") for n in (1, 4, 5)])
    counts = {r.s5: r["count"] for r in keys.groupBy("s5").count().collect()}
    assert all(3700 < n < 4300 for n in counts.values()) and len(counts) == 5
    assert keys.where("s4 <> s5 AND s5 <> 4").isEmpty() and keys.where("s1 <> 0").isEmpty()


def labelled(spark):
    rng = random.Random(1)
    good = [(i, " ".join(rng.choice("the of and house tree walks in green".split()) for _ in range(60)) + ".", 1) for i in range(100)]
    poor = [(i, " ".join(rng.choice("BUY NOW FREE WIN".split()) + "!!!" for _ in range(60)), 0) for i in range(100, 200)]
    return spark.createDataFrame(good + poor, "doc_id long, text string, quality int")


def test_quality(spark, docs, none, repeated):
    train = labelled(spark)
    labels = train.select("doc_id", "quality").union(spark.createDataFrame([(None, 1), (3, None)], "doc_id long, quality int"))
    found = quality.quality_scores(train, labels).join(train, "doc_id").collect()
    assert len(found) == 200 and all(r.predicted == r.quality for r in found if r.held_out)
    everything = quality.quality_scores(repeated.unionByName(train.select("doc_id", "text"), allowMissingColumns=True), labels).collect()
    assert len(everything) == 222 and all(0 <= r.score <= 1 for r in everything)
    assert quality.quality_scores(none, labels).count() == 0
    assert {r.score for r in quality.quality_scores(docs, labels.limit(0)).collect()} == {0.5}
    kept = quality.drop_poor(train, labels)
    assert kept.columns == train.columns and kept.where("quality = 0").isEmpty() and kept.count() == 100


def test_texts_without_spaces_count_to_their_end():
    rng = random.Random(2)
    head = "".join(rng.choice("天地玄黃宇宙洪荒") for _ in range(64))
    good, spam = head + "".join(rng.choice("日月盈昃辰宿列張") for _ in range(3000)), head + "$!#%" * 750
    count = quality.Counter()
    rows = count([good, spam, good + "完", spam[:-1] + "x"])
    assert len({r.tobytes() for r in rows}) == 4
    model = quality.fitted(count([good, spam]), np.array([1.0, 0.0]))
    assert (model.score(count([good, spam])) > 0.7).tolist() == [True, False]
    # Words up to a piece's length are one term each; a piece is never a short word; repeated long words count.
    assert quality._pieces("x" * 64) == ["x" * 64] and [len(p) for p in quality._pieces("x" * 132)] == [64, 68]
    assert "".join(quality._pieces(good)) == good and min(map(len, quality._pieces(good))) > 4
    assert count([f"{good} {good}"])[0, 0] > 0


def test_idf_counts_all_documents(spark, docs):
    train = labelled(spark)
    texts = [r.text for r in train.union(docs.select("doc_id", "text", F.lit(0))).collect()]
    model = quality.fit(train.select("doc_id", "text").union(docs.select("doc_id", "text")), train.select("doc_id", "quality"), sample=5)
    frequencies = np.count_nonzero(quality.Counter()(texts), axis=0)
    assert np.allclose(model.idf, np.log((1 + len(texts)) / (1 + frequencies)) + 1) and len(model.labels) == 5


def test_exact_duplicates(spark, docs, none, repeated):
    for keep, best in (("largest", max), ("smallest", min)):
        found = {r.doc_id: r for r in exact_dedup.exact_duplicates(docs, keep).collect()}
        groups = {}
        for k, t in TEXTS:
            groups.setdefault(t or "", []).append(k)
        for k, t in TEXTS:
            own = groups[t or ""]
            assert (found[k].keep_id, found[k].group_size, found[k].kept) == (best(own), len(own), k == best(own))
            assert found[k].text_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    assert exact_dedup.exact_duplicates(none).count() == 0
    rows = exact_dedup.exact_duplicates(repeated, bits=1, levels=3).collect()
    assert len(rows) == 22 and {r.repeats for r in rows} == {2}
    kept = exact_dedup.drop_copies(repeated)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 6, 7, 8, 9, 10]


def test_runs_merge_over_batch_borders():
    rows = sorted((f"d{i % 5}", 1, 1, i, 1, 1) for i in range(40))
    table = pa.table(list(map(list, zip(*rows, strict=True))), schema=exact_dedup._RUN)
    merged = pa.Table.from_batches(list(exact_dedup._merge("smallest")(iter(table.to_batches(max_chunksize=3)))))
    assert merged.column("keep_id").to_pylist() == [0, 1, 2, 3, 4] and merged.column("group_size").to_pylist() == [8] * 5
    # One digest with another length is another text.
    table = table.set_column(1, "n_bytes", pa.array([1] * 4 + [2] * 36))
    assert pa.Table.from_batches(list(exact_dedup._merge("largest")(iter(table.cast(exact_dedup._RUN).to_batches())))).num_rows == 6


def near_texts():
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(4000)]
    base, out = [rng.choice(vocabulary) for _ in range(200)], []
    for i in range(120):  # one large family: near copies, and copies of these drifting away
        words = (base if i % 3 else out[-1].split() if out else base)[:]
        for _ in range(rng.randrange(1, 8)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        out.append(" ".join(words))
    out += [" ".join(rng.choice(vocabulary) for _ in range(100)) for _ in range(30)]
    return [*enumerate(out, 100), *TEXTS]


@pytest.mark.parametrize("size, percent", [(3, 85), (5, 80)])
def test_near_duplicates(spark, monkeypatch, size, percent):
    monkeypatch.setattr(near_dedup, "TILE", 16)  # the family spans several tiles
    texts = near_texts()
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    found = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(docs, size, percent).collect()}
    assert found == brute.near_duplicates(texts, size, percent)


def test_near_duplicates_of_odd_tables(docs, none, repeated):
    assert near_dedup.near_duplicates(none).count() == 0
    rows = near_dedup.near_duplicates(repeated).collect()
    assert len(rows) == 22
    assert {r.component_id for r in rows if r.doc_id in (1, 5)} == {1}
    kept = near_dedup.drop_near_copies(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 4, 6, 7, 8, 9, 10]


def test_shingles_in_parts_are_the_same(monkeypatch):
    texts = [t for _, t in TEXTS if t]
    whole = [shingles.shingles_of(t, 3) for t in texts]
    assert [len(s) for s in whole] == [len(brute.shingle_set(t, 3)) for t in texts]
    monkeypatch.setattr(shingles, "PART", 30)
    assert all((a == shingles.shingles_of(t, 3)).all() for a, t in zip(whole, texts, strict=True))


def test_warc_round_trip(spark, tmp_path):
    page = "<html>" + "x" * 200 + "</html>"
    rows = [
        (3, "http://a/\r\nb", page, 1), (1, None, page, 1), (2, "u", "short", 1), (4, "u", "short", 1), (5, "u", None, 1),
        (6, "u", "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n", 1), (None, "u", page, 1), (3, "http://a/\r\nb", page, 1),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest int")
    warc.write_warc(pages, f"{tmp_path}/w", archive_bytes=300)
    found = warc.read_warc(spark, f"{tmp_path}/w").collect()
    assert len({r.file for r in found}) > 1 and all(r.gap is None for r in found) and len(found) == 8
    kinds = sorted((r.page_id or 0, r.record_type, r.refers_to or 0, r.payload_bytes) for r in found)
    n = len(page)
    assert kinds == sorted([
        (3, "revisit", 1, n), (3, "revisit", 1, n), (1, "response", 0, n), (2, "response", 0, 5), (4, "response", 0, 5),
        (5, "response", 0, 0), (6, "response", 0, len(rows[5][2])), (0, "revisit", 1, n),
    ])
    assert {bytes(r.payload) for r in found if r.page_id == 6} == {rows[5][2].encode()}
    warc.write_warc(pages.limit(0), f"{tmp_path}/none")
    assert warc.read_warc(spark, f"{tmp_path}/none").count() == 0


def archive(compressed: bool) -> tuple[bytes, list[int]]:
    out, starts = b"", []
    for i in range(12):
        block = b"HTTP/1.1 200 OK\r\n\r\n" + b"payload %d " % i * 40 + (b"\r\n\r\nWARC/1.1\r\nnot a record" if i == 5 else b"")
        head = f"WARC/1.1\r\nWARC-Type: response\r\nX-Page-Id: {i}\r\nWARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}\r\n"
        head += f"Content-Type: application/http\r\nContent-Length: {len(block)}\r\n\r\n"
        record = head.encode() + block + b"\r\n\r\n"
        starts.append(len(out))
        out += gzip.compress(record) if compressed else record
    return out, [*starts, len(out)]


@pytest.mark.parametrize("compressed", [False, True])
def test_salvage(compressed):
    data, starts = archive(compressed)
    ids = lambda d: [int(x.fields["x-page-id"]) for x in warc.salvage(d) if isinstance(x, warc.Record)]
    assert ids(data) == list(range(12))
    hurt = bytearray(data)
    for i in (2, 3, 7):
        middle = (starts[i] + starts[i + 1]) // 2
        hurt[middle : middle + 9] = b"\x00DAMAGED!"
    found = list(warc.salvage(bytes(hurt)))
    assert ids(bytes(hurt)) == [0, 1, 4, 5, 6, 8, 9, 10, 11]
    gaps = [(x.start, x.stop) for x in found if isinstance(x, warc.Gap)]
    assert gaps == [(starts[2], starts[4]), (starts[7], starts[8])]
    # Records and gaps cover the file.
    assert [x.start for x in found] == [0, *[x.stop for x in found[:-1]]] and found[-1].stop == len(data)
    cut = list(warc.salvage(data[: starts[11] + 20]))
    assert isinstance(cut[-1], warc.Gap) and len(cut) == 12
    assert [type(x) for x in warc.salvage(b"junk" + data)][:2] == [warc.Gap, warc.Record]
    assert list(warc.salvage(b"")) == [] and isinstance(next(iter(warc.salvage(b"nothing here"))), warc.Gap)


def digested(i: int, digest, name: str = "Block", inside: bytes = b"") -> bytes:
    """A plain record with a digest as ``digest`` writes it."""
    payload = b"payload %d " % i * 40 + inside
    block = b"HTTP/1.1 200 OK\r\n\r\n" + payload
    head = f"WARC/1.1\r\nWARC-Type: response\r\nX-Page-Id: {i}\r\n"
    head += f"WARC-{name}-Digest: {digest(block if name == 'Block' else payload)}\r\n" if digest else ""
    return head.encode() + b"Content-Type: application/http\r\nContent-Length: %d\r\n\r\n" % len(block) + block + b"\r\n\r\n"


def sha1_base32(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def page_ids(found):
    return [int(x.fields["x-page-id"]) for x in found if isinstance(x, warc.Record)]


def test_members_of_several_records(spark, tmp_path):
    records = [digested(i, sha1_base32) for i in range(5)]
    middle = bytearray(b"".join(records[1:4]))
    middle[len(records[1]) + 250] ^= 1  # in the payload of record 2
    members = [gzip.compress(records[0]), gzip.compress(bytes(middle)), gzip.compress(records[4])]
    found = list(warc.salvage(b"".join(members)))
    assert page_ids(found) == [0, 1, 3, 4]
    start, n = len(members[0]), len(records[1])
    assert [(x.start, x.stop, x.member) for x in found] == [
        (0, start, None), (start, start + n, start), (start + n, start + n + len(records[2]), start),
        (start + n + len(records[2]), start + len(middle), start), (start + len(members[1]), sum(map(len, members)), None),
    ]
    assert isinstance(found[2], warc.Gap) and found[2].reason == "block digest"
    assert page_ids(warc.salvage(gzip.compress(b"".join(records)))) == [0, 1, 2, 3, 4]
    # A damaged or cut member gives the records before the fault, once, whether compressed or stored.
    rng = random.Random(4)
    more = [digested(i, sha1_base32, inside=rng.randbytes(30_000)) for i in range(6)]
    for level in (0, 6):
        whole = gzip.compress(b"".join(more), level)
        assert page_ids(warc.salvage(whole[: len(whole) * 5 // 12] + members[2])) == [0, 1, 4]
        hurt = bytearray(whole + members[2])
        hurt[len(whole) - 6] ^= 1  # the checksum alone
        assert page_ids(warc.salvage(bytes(hurt))) == [0, 1, 2, 3, 4, 5, 4]
    with open(f"{tmp_path}/a.warc.gz", "wb") as file:
        file.write(b"".join(members))
    rows = warc.read_warc(spark, str(tmp_path)).collect()
    expected = [(0, None), (1, start), (3, start), (4, None)]
    assert [(r.page_id, r.member) for r in sorted(rows, key=lambda r: r.page_id or 0) if r.gap is None] == expected
    assert [(r.gap, r.member) for r in rows if r.gap] == [("block digest", start)]


@pytest.mark.parametrize("name", ["Block", "Payload"])
@pytest.mark.parametrize("digest", [
    sha1_base32, lambda b: "SHA-1:" + hashlib.sha1(b).hexdigest().upper(), lambda b: "md5:" + hashlib.md5(b).hexdigest(),
    lambda b: "md5:" + base64.b32encode(hashlib.md5(b).digest()).decode(), lambda b: "sha256:" + base64.b32encode(hashlib.sha256(b).digest()).decode(),
    lambda b: "sha512:" + hashlib.sha512(b).hexdigest(), lambda b: "sha1:" + base64.b64encode(hashlib.sha1(b).digest()).decode(),
])
def test_usual_digests_are_checked(name, digest):
    records = [digested(i, digest, name) for i in range(3)]
    assert page_ids(warc.salvage(b"".join(records))) == [0, 1, 2]
    hurt = bytearray(b"".join(records))
    hurt[len(records[0]) + len(records[1]) - 20] ^= 1
    assert page_ids(warc.salvage(bytes(hurt))) == [0, 2]
    # Inside a damaged payload only a record with a right digest is taken.
    for inner, taken in ((digested(8, digest, name), [8]), (digested(8, None), []), (digested(8, lambda b: digest(b + b"x"), name), [])):
        outer = bytearray(digested(7, digest, name, b"\r\n" + inner))
        outer[-len(inner) - 40] ^= 1
        assert page_ids(warc.salvage(bytes(outer) + records[0])) == [*taken, 0]


def test_payload_digests_of_other_bytes_are_no_damage():
    body = b"5\r\nhello\r\n0\r\n\r\n"
    block = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n" + body
    for payload, field in ((body, ""), (b"hello", ""), (b"whole of several segments", "WARC-Segment-Number: 1\r\n")):
        head = f"WARC/1.1\r\nWARC-Type: response\r\nX-Page-Id: 1\r\nWARC-Payload-Digest: {sha1_base32(payload)}\r\n{field}"
        head += f"Content-Type: application/http\r\nContent-Length: {len(block)}\r\n\r\n"
        assert page_ids(warc.salvage(head.encode() + block + b"\r\n\r\n")) == [1]


def test_token_files(spark, docs, none, repeated, tmp_path):
    path = f"{tmp_path}/t"
    token_files.write_tokens(docs, path, TOKENIZER, file_bytes=100_000, frame_bytes=64)
    expected = {k: [*ids, 0] for (k, _), ids in zip(TEXTS, brute.library_ids(TOKENIZER, [t or "" for _, t in TEXTS]), strict=True)}
    rows = token_files.with_starts(token_files.read_tokens(spark, path)).collect()
    assert len({r.file for r in rows}) > 1
    start = 0
    for r in sorted(rows, key=lambda r: r.doc_id):
        assert np.frombuffer(bytes(r.ids), "<u4").tolist() == expected[r.doc_id] and r.start == start
        start += r.n_tokens
    asked = token_files.read_tokens(spark, path, keys=[5, 9, 77]).collect()
    assert {r.doc_id for r in asked} == {5, 9}
    token_files.write_tokens(none, f"{tmp_path}/none", TOKENIZER)
    assert token_files.read_tokens(spark, f"{tmp_path}/none").count() == 0
    token_files.write_tokens(repeated.where("doc_id is not null"), f"{tmp_path}/twice", TOKENIZER)
    assert token_files.digests(token_files.read_tokens(spark, f"{tmp_path}/twice")).count() == 20
    with pytest.raises(Exception, match="no id"):
        token_files.write_tokens(repeated, f"{tmp_path}/null", TOKENIZER)


def test_frames_are_independent_and_checked():
    import zstandard

    writer = token_files.FrameWriter(frame_bytes=40)
    ids = {k: np.arange(k, k + 5, dtype="<u4").tobytes() for k in (1, 2, 2_000, 2_001, 9_000)}
    frames = [f for k, b in ids.items() for f in writer.add(k, b)] + list(writer.close())
    data = b"".join(f + token_files.SEPARATOR.encode() for f in frames)
    assert zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()  # a plain zstandard stream
    reader = token_files.FrameReader(data)
    assert dict(reader.documents()) == ids
    reader = token_files.FrameReader(data)
    assert dict(reader.requested([2_000])) == {2_000: ids[2_000]} and reader.opened == 2 < len(reader.frames) + 1
    hurt = bytearray(data)
    hurt[reader.frames[0][0] + 12] ^= 255
    hurt = token_files.FrameReader(bytes(hurt))
    assert dict(hurt.requested([9_000])) == {9_000: ids[9_000]}
    with pytest.raises(token_files.DamagedFile):
        list(hurt.documents())
    for broken in (b"", data[:-20], data[5:]):
        with pytest.raises(token_files.DamagedFile):
            token_files.FrameReader(broken)


def test_layouts_become_canonical_turns(spark):
    records = [
        ({"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a", "name": "n"}]}, "messages", [("user", "q"), ("assistant", "a")]),
        ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": None}]}, "from_value", [("user", "q"), ("assistant", "")]),
        ({"prompt": "p", "response": "r", "id": 5}, "prompt_response", [("user", "p"), ("assistant", "r")]),
        ({"prompt": "p", "completion": "r"}, "prompt_completion", [("user", "p"), ("assistant", "r")]),
        ({"instruction": "i", "output": "o"}, "instruction", [("user", "i"), ("assistant", "o")]),
        ({"instruction": "i", "input": "x", "output": "o"}, "instruction_input", [("user", "i\n\nx"), ("assistant", "o")]),
        ({"instruction": "i", "input": "", "output": "o"}, "instruction_input", [("user", "i"), ("assistant", "o")]),
        ({"other": 1}, None, None), ([1], None, None),
    ]
    lines = [(i, json.dumps(r)) for i, (r, _, _) in enumerate(records)] + [(98, None), (99, "{cut")]
    found = {r.i: r for r in chat.json_turns(spark.createDataFrame(lines, "i int, body string"), "body").collect()}
    for i, (_, layout, turns) in enumerate(records):
        assert found[i].layout == layout
        assert (found[i].turns and [(t.role, t.text) for t in found[i].turns]) == turns
    assert found[98].turns is None and found[99].turns is None
    with pytest.raises(ValueError):
        chat.typed_turns(spark.range(1).select(F.struct("id").alias("record")))


def test_each_conversation_takes_the_layout_of_its_form(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", None), (2, 0, "assistant", "a"), (2, 1, "user", "b"), (3, 0, "human", "h"), (3, 1, "gpt", "g")]
    rows += [(4, 0, None, None), (5, 0, "user", "long " * 5_000_000), (5, 1, "system", '"\\u0000\x01')]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {r.conv_id: r for r in chat.format_conversations(frame).select("conv_id", "layout", "turns").collect()}
    assert {k: r.layout for k, r in found.items()} == {1: "prompt_response", 2: "from_value", 3: "messages", 4: "messages", 5: "messages"}
    for key, r in found.items():
        assert [tuple(t) for t in r.turns] == [(role or "", text or "") for k, _, role, text in rows if k == key]


def test_chat_is_read_back_exactly(spark):
    odd = ["", None, "<|", "<\\|im_end|>", "\\<\\\\|x", "a\n<|im_end|>\n<|im_start|>assistant\nb", "100% %0A", "é🙂"]
    rows = [(7, i, ("user", "assistant", "sys\ntem <|%")[i % 3], t, "x") for i, t in enumerate(odd)]
    rows += [(8, 0, None, "t", "x"), (8, 0, "assistant", "t", "x"), (8, 0, "assistant", "t", "x"), (None, 1, "assistant", None, "x")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, segments string")
    done = chat.format_conversations(frame)
    found = {r.conv_id: r for r in done.withColumn("back", chat.read_turns(F.col("formatted"))).withColumn("masked", chat.masked_text(F.col("segments"))).collect()}
    assert all([tuple(t) for t in r.turns] == [tuple(t) for t in r.back] for r in found.values())
    assert found[7].masked == "".join(odd[i] or "" for i in (1, 4, 7)) and len(found[8].back) == 3 and found[None].masked == ""
    assert found[7].formatted.count("<|") == 2 * len(odd)
    assert all("".join(s.text for s in r.segments) == r.formatted for r in found.values())
    assert chat.digests(chat.format_conversations(frame.limit(0))).count() == 0
    plan = chat.digests(done)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_contamination(spark, docs, none, repeated):
    items = [(1, "What is one two three four five six seven eight nine ten eleven"), (2, "ONE, two; three"), (3, None), (4, ""), (2, "word5 naïve word6"), (None, "zzz")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    texts = [*TEXTS, (20, "x ONE-two_three! y"), (21, "is one two three four five six seven eight nine ... ten"), (22, "a zzz")]
    rows = spark.createDataFrame(texts, "doc_id long, text string")
    found = {r.doc_id: r for r in decontamination.contamination(rows, bench).collect()}
    named = [(k if k is not None else "", t) for k, t in items]
    assert {k: (r.n_words, r.n_hit, list(r["items"])) for k, r in found.items()} == brute.contamination(texts, named)
    assert [dict(texts)[20][s.start : s.stop] for s in found[20].spans] == ["ONE-two_three"]
    assert decontamination.contamination(none, bench).count() == 0
    assert decontamination.contamination(rows, bench.limit(0)).where("contaminated").isEmpty()
    assert decontamination.contamination(repeated, bench).count() == 22
    kept = decontamination.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and {1, 5, 6}.isdisjoint(r.doc_id for r in kept.collect())
    with pytest.raises(ValueError, match="bytes"):
        decontamination.windows_of(bench, most_bytes=10)
    # Several automata, small ones, find what one finds.
    for most in (200, 40):
        parts = {r.doc_id: r for r in decontamination.contamination(rows, bench, most_bytes=most).collect()}
        assert parts == found
        assert decontamination.contamination(none, bench, most_bytes=most).count() == 0
    assert decontamination.contamination(repeated, bench, most_bytes=40).count() == 22
    both = [decontamination.drop_contaminated(docs, bench, most_bytes=m) for m in (1 << 20, 40)]
    assert both[1].columns == docs.columns and sorted(both[0].collect()) == sorted(both[1].collect())


def test_a_large_family_around_the_threshold(spark):
    """Texts of which nearly all pairs come close to the threshold and few reach it: no link is lost, equal to all pairs."""
    rng = random.Random(1)
    base = [f"w{rng.randrange(5000)}" for _ in range(220)]
    texts = []
    for i in range(2000):
        body = list(base)
        for _ in range(rng.choice([2, 3, 4])):
            body[rng.randrange(220)] = f"x{rng.randrange(10**9)}"
        texts.append((i, " ".join(body)))
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(8)
    sets = [shingles.shingles_of(t, 3) for _, t in texts]
    sizes = np.array([len(s) for s in sets])
    starts, (distinct, numbers) = np.cumsum(sizes) - sizes, np.unique(np.concatenate(sets), return_inverse=True)
    for percent in (85, 95):  # most pairs link, few do
        label = np.arange(len(sets))
        for i in range(len(sets)):
            inside = np.zeros(len(distinct), np.int64)
            inside[numbers[starts[i] : starts[i] + sizes[i]]] = 1
            common = np.add.reduceat(inside[numbers], starts)
            near = np.flatnonzero(common * 100 >= (sizes + sizes[i] - common) * percent)
            label[np.isin(label, label[near])] = label[near].min()
        found = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(docs, 3, percent).collect()}
        assert found == dict(enumerate(label.tolist()))
