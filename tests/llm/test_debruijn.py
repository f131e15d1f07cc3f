"""Repeated passages equal those that a table of all windows finds."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import debruijn
from tidemark.llm.debruijn import K, Batch, _Hashes, sliding, span_hashes


def plain(rows, k=K):
    """All windows of all texts, counted."""
    texts = [(doc_id, (text or "").encode().split()) for doc_id, text in rows]
    seen = Counter(tuple(w[i : i + k]) for _, w in texts for i in range(len(w) - k + 1))
    out = []
    for doc_id, w in texts:
        gone = {j for i in range(len(w) - k + 1) if seen[tuple(w[i : i + k])] > 1 for j in range(i, i + k)}
        out.append((doc_id, len(w), len(gone), hashlib.sha256(b" ".join(x for j, x in enumerate(w) if j not in gone)).hexdigest()))
    return sorted(out, key=str)


def found(spark, rows, **how):
    got = debruijn.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string"), **how)
    return sorted(map(tuple, got.collect()), key=str)


def words(rng, n, vocabulary=10_000):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


@pytest.fixture(scope="module")
def passages():
    """Texts that share passages of every length around a window's, whole or in part, at the ends and within."""
    rng = random.Random(5)
    one, two = words(rng, 60), words(rng, 36)
    rows = [
        words(rng, 20) + one + words(rng, 50), one[10:] + words(rng, 40), words(rng, 40) + one[:50], one, one,  # whole, from within, at both ends
        words(rng, 3) + two[:34] + words(rng, 30), two[:34] + words(rng, 4), two + words(rng, 9), two[1:] + words(rng, 2),  # a word short, and just long enough
        words(rng, 5) + one[:40] + two + one[20:], ["a"] * 100, ["a"] * 36 + ["b"], ["x", "y"] * 50, words(rng, 35) * 3,  # branches, loops, repeats within
        words(rng, 34), [], words(rng, 35), words(rng, 4000) + one + words(rng, 4000),
    ]
    out = [(k, " ".join(r)) for k, r in enumerate(rows)]
    return [*out, (None, None), (3, out[3][1]), (None, out[0][1].replace(" ", "\n\t ")), (90, "é ü 　 z\x1cz " * 40)]


def test_equals_all_windows(spark, passages):
    assert found(spark, passages) == plain(passages)


@pytest.mark.parametrize("k, seed", [(2, 1), (3, 3), (7, 3)])
def test_small_alphabets(spark, k, seed):
    """Words of few kinds: nodes with many edges, loops and ties everywhere."""
    rng = random.Random(k)
    rows = [(n, " ".join(words(rng, rng.randrange(60), 2 + n % 7))) for n in range(60)]
    assert found(spark, rows, k=k, seed=seed) == plain(rows, k)


def test_every_batch_and_bucket_size(spark, passages, monkeypatch):
    """A text a batch and few buckets give the same: what a task holds decides nothing."""
    monkeypatch.setattr(debruijn, "BUCKETS", (1, 3))
    rows = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 1)
    try:
        assert found(spark, passages) == plain(passages)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)


def test_hot_passage(spark):
    """Most rows hold one passage, a third are one text: no row is lost."""
    rng = random.Random(1)
    shared, copy = " ".join(words(rng, 50)), " ".join(words(rng, 200))
    rows = [(k, copy if k % 3 == 0 else " ".join(words(rng, 20)) + " " + shared + " " + " ".join(words(rng, 20))) for k in range(900)]
    assert found(spark, rows) == plain(rows)


def test_colliding_hashes(spark, passages, monkeypatch):
    """What only hashes hold alike is found by reading the paths at their places."""
    weak = debruijn.span_hashes
    monkeypatch.setattr(debruijn, "span_hashes", lambda w, size: weak(w, size) & np.uint64(0xFFF000000000FFFF) if size == K else weak(w, size) & np.uint64(0xFFFF0000000003FF))
    rows = passages + [(100 + k, " ".join(words(random.Random(k), 300))) for k in range(40)]
    assert found(spark, rows) == plain(rows)


def test_seeds_are_those_of_each_edge():
    rng = random.Random(2)
    texts = [" ".join(words(rng, n, 40)).encode() for n in (35, 36, 100, 34, 400)]
    batch = Batch(texts, [b""] * len(texts), _Hashes(), K, 16)
    want = set()
    for start, end in zip(batch.starts.tolist(), batch.ends.tolist()):
        for i in range(start, end - K + 1):
            own = batch.seeds[i : i + K - 16 + 1]
            want |= {i + j for j in np.flatnonzero(own == own.min()).tolist()}
    assert set(batch.seed_places().tolist()) == want


def test_spans_and_sliding():
    w = np.array([3, 1, 4, 1, 5, 3, 1, 4, 1], np.uint64)
    h = span_hashes(w, 4)
    assert len(h) == 6 and h[0] == h[5] and len(set(h.tolist())) == 5 and not len(span_hashes(w, 10))
    assert sliding(np.minimum, w, 3).tolist() == [1, 1, 1, 1, 1, 1, 1] and sliding(np.maximum, w, 9).tolist() == [5] and not len(sliding(np.minimum, w[:2], 5))
