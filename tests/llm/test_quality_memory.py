"""The quality classifier's workers: a word costs a few bytes, and a batch's texts are not all Python objects at once."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa

from paralith.llm import quality_model
from paralith.llm.common import slices


def test_slices_keep_all_rows_in_order():
    batches = [pa.record_batch([pa.array(range(a, b))], names=["x"]) for a, b in ((0, 7), (7, 7), (7, 8), (8, 1500))]
    parts = list(slices(batches, 5))
    assert [x for p in parts for x in p.column(0).to_pylist()] == list(range(1500))
    assert max(p.num_rows for p in parts) == 5 and min(p.num_rows for p in parts) > 0
    assert list(slices([])) == []


def test_many_words_take_little_memory():
    """60,000 words, whose vectors alone would be 15 MB."""
    contexts = quality_model.HashedRows()
    v = quality_model.WordVectors(contexts, np.zeros((contexts.rows, quality_model.DIM), np.float32))
    tracemalloc.start()
    try:
        for start in range(0, 60_000, 500):
            v.pooled(" ".join(f"w{k}" for k in range(start, start + 500)))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(v.rows) == 60_000
    assert peak < 24e6


def test_words_keep_their_vectors_when_the_table_grows_and_starts_anew(monkeypatch):
    rng = np.random.default_rng(3)
    contexts = quality_model.HashedRows(101)
    matrix = rng.normal(size=(101, quality_model.DIM)).astype(np.float32)
    texts = [" ".join(f"W{k}-x{k % 13}!" * (1 + k % 2) for k in range(a, a + 700)) for a in (0, 600, 2000, 0)]
    alone = [quality_model.WordVectors(contexts, matrix).pooled(t) for t in texts]
    for most in (300_000, 1000):
        monkeypatch.setattr(quality_model, "MOST_WORDS", most)
        v = quality_model.WordVectors(contexts, matrix)
        assert np.allclose([v.pooled(t) for t in texts], alone, atol=1e-5)
    word = "W5-x5!W5-x5!"
    got = v.vectors(np.array([v.rows[word]]))[0]
    own = quality_model.index_vectors(quality_model._hashes([word.lower()], 1))[0] + matrix[contexts.get(word.lower())]
    shape = quality_model.index_vectors(quality_model._hashes([quality_model.shape_of(word)], 2))[0]
    assert np.array_equal(got, np.concatenate([own, shape]))
