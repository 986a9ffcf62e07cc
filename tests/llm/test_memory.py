"""What a worker keeps between tasks is bounded."""

from __future__ import annotations

import pyarrow as pa

from candlewick.llm import quality, tables


def test_remembered_words_are_bounded_below_the_pieces_of_a_tokenizer(monkeypatch):
    monkeypatch.setattr(quality, "KEPT_WORDS", 50)
    counter = quality.Counter()
    texts = [" ".join(f"w{i}x{j}" for j in range(40)) for i in range(20)]
    found = counter(texts)
    assert len(counter.known) + len(counter.known.older) <= 100
    assert (found == quality.Counter()(texts)).all()


def test_arrow_gives_back_unused_memory_after_a_batch(monkeypatch):
    class Pool:
        released = 0

        def release_unused(self):
            Pool.released += 1

    monkeypatch.setattr(tables.pa, "default_memory_pool", lambda: Pool())
    assert [len(part) for part in tables.sliced(pa.array(range(5)), 2)] == [2, 2, 1]
    assert Pool.released == 1
