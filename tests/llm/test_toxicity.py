"""Toxicity on labels that were held out, and the counterfactual penalty."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import toxicity
from tidemark.llm.common import table

DOCS, LABELS = "doc_id bigint, text string, score int", "doc_id bigint, quality int, toxic int"


def test_held_out(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    rows = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
    assert len(rows) == docs.count()
    out = [(truth[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in truth]
    assert sum(a == b for a, b in out) >= 0.9 * len(out)
    assert all(r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in rows)
    kept = {r.doc_id for r in toxicity.drop_toxic(docs, toxicity.fit(docs, labels)).collect()}
    assert kept == {r.doc_id for r in rows if not r.predicted}


def test_odd_rows(spark):
    rows = [(k, "you idiot fool" if k % 2 else "a fine day", 0) for k in range(60)] + [(100, None, 1), (101, "", 1), (None, "you idiot", 1), (1, "you idiot fool", 0)]
    labels = [(k, 1, k % 2) for k in range(60)] + [(100, 1, 1), (None, 1, 1), (5, 1, 0), (7, None, None), (999, 0, 1)]
    docs = spark.createDataFrame(rows, DOCS)
    model = toxicity.fit(docs, spark.createDataFrame(labels, LABELS))
    got = toxicity.score(docs, model).collect()
    assert len(got) == len(rows)
    assert {(r.doc_id or 0) % 2: r.predicted for r in got if r.doc_id is not None and r.doc_id < 60} == {0: 0, 1: 1}
    assert [r.held_out for r in got if r.doc_id is None] == [False]
    assert toxicity.drop_toxic(docs, model).columns == docs.columns
    empty = docs.limit(0)
    assert toxicity.score(empty, toxicity.fit(empty, spark.createDataFrame([], LABELS))).collect() == []


def test_one_class(spark):
    docs = spark.createDataFrame([(1, "a b c", 0), (2, "d e f", 0)], DOCS)
    model = toxicity.fit(docs, spark.createDataFrame([(1, 1, 0), (2, 1, 0)], LABELS))
    assert {r.predicted for r in toxicity.score(docs, model).collect()} == {0}


def test_penalty_evens_out_groups():
    """Insults mostly beside one group: without the penalty its name weighs, with it hardly."""
    rng = np.random.default_rng(0)
    texts = []
    for k in range(400):
        toxic = k % 2
        group = "muslim" if rng.random() < (0.9 if toxic else 0.1) else "christian"
        insult = "idiot" if toxic and rng.random() < 0.7 else "person"
        texts.append((f"my {group} neighbour is a {insult}", toxic))
    rows = [(np.array(sorted(toxicity.features_of(set(t.split()))), np.int64), y) for t, y in texts]
    pairs = [(np.array(sorted(toxicity.features_of(a - b)), np.int64), np.array(sorted(toxicity.features_of(b - a)), np.int64)) for t, _ in texts for a, b in toxicity.swapped(t)]

    def gap(swaps):
        scorer = toxicity.Scorer(toxicity.train(rows, swaps, 0.5))
        return abs(scorer.score(b"my muslim neighbour is a person") - scorer.score(b"my christian neighbour is a person"))

    assert len(pairs) == 2000
    assert gap(pairs) < 0.3 * gap([])
    scorer = toxicity.Scorer(toxicity.train(rows, pairs, 0.5))
    assert scorer.score(b"idiot") > 0.5


def test_swaps():
    assert toxicity.swapped("No mention.") == []
    (before, after), = toxicity.swapped("Men work. Fine day.")
    assert before - after == {"men"} and after - before == {"women"}


def test_all_swaps_of_a_text_count():
    text = "A muslim spoke. " * 30 + "A gay woman and an old man spoke to a blind man. " + "No mention. " * 50 + "The deaf indian listened."
    pairs = toxicity.swapped(text)
    assert len(pairs) == 30 * 5 + (4 + 1 + 1 + 1 + 2) + (2 + 5)
    want = Counter((toxicity._packed(x - y), toxicity._packed(y - x)) for x, y in ((toxicity.features_of(a), toxicity.features_of(b)) for a, b in pairs))
    got = toxicity.changes(text)
    assert got == want and sum(got.values()) == len(pairs) and len(got) < 40


def test_carriers():
    """One sentence of each text lends itself to the swaps of one kind, whatever the text mentions."""
    kinds = Counter()
    for k in range(300):
        text = f"Nobody here {k}. Another sentence, longer than that! Third one\nfourth line"
        found = list(toxicity._carried(text))
        terms = {t for _, term, instead in found for t in (term, instead)}
        kind, = (x for x in toxicity.IDENTITY if terms == set(x))
        kinds[kind] += 1
        sentences = [set(toxicity._WORD.findall(x)) for x in toxicity._SENTENCE.findall(text.lower())]
        assert len(found) == len(kind) * (len(kind) - 1)
        for words, term, _ in found:
            assert term in words and any(len(s - words) == 1 and words - {term} < s for s in sentences)
    assert set(kinds) == set(toxicity.IDENTITY)
    assert list(toxicity._carried("")) == list(toxicity._carried(" .!\n")) == []
    mentioned = "The gay man is old."
    assert toxicity.changes(mentioned, carrier=True).total() == toxicity.changes(mentioned).total() + len(list(toxicity._carried(mentioned)))


def fitted(spark, sf):
    """The training rows and swaps of the driver's tables, made without Spark."""
    labels = {r.doc_id: r.toxic for r in table(spark, sf, "labels").collect() if zlib.crc32(str(r.doc_id).encode()) % 5}
    texts = {r.doc_id: r.text or "" for r in table(spark, sf, "documents").select("doc_id", "text").collect()}
    rows, swaps = [], Counter()
    for doc in sorted(labels):
        rows.append((np.array(sorted(toxicity.features_of(set(toxicity._WORD.findall(texts[doc].lower())))), np.int64), labels[doc]))
        swaps += toxicity.changes(texts[doc], carrier=True)
    pairs = [tuple(np.frombuffer(x, np.int32) for x in p) for p in sorted(swaps)]
    return rows, pairs, [swaps[p] for p in sorted(swaps)], texts


def test_penalty_takes_effect_on_the_tables(spark, monkeypatch):
    """Insults lend their beginnings to terms that name groups: transgender begins like trash. With the
    penalty such neutral mentions score like the others of their kind, without it they don't."""
    rows, pairs, times, texts = fitted(spark, "/root/testdata/sf0.01")
    share = sum(y for _, y in rows) / len(rows)
    assert sum(times) > 1000 and any(len(a) or len(b) for a, b in pairs)

    def gaps():
        scorer = toxicity.Scorer(toxicity.train(rows, pairs, share, times))
        mentions = [[scorer.score(f"we met a {term} neighbour today".encode()) for term in kind] for kind in toxicity.IDENTITY]
        return [max(m) - min(m) for m in mentions], max(max(m) for m in mentions) - scorer.score(b"we met a neighbour today")

    fair, fair_rise = gaps()
    monkeypatch.setattr(toxicity, "FAIRNESS", 0.0)
    plain, plain_rise = gaps()
    assert max(plain) > 0.01 and max(fair) < max(plain) / 10
    assert plain_rise > 0.01 and fair_rise < plain_rise / 10


def dense(rows, pairs, share, times):
    """The same model by brute force: whole matrices, the loss's gradient written out."""
    labels = np.array([y for _, y in rows], float)
    x = np.zeros((len(rows), toxicity.BUCKETS), np.int8)
    for k, (own, _) in enumerate(rows):
        x[k, own] = 1
    docs, rate = x.sum(axis=0, dtype=float), labels.mean()
    z = np.abs((x[labels == 1].sum(axis=0, dtype=float) - docs * rate)) / np.sqrt(np.maximum(docs, 1) * rate * (1 - rate))
    chosen = np.flatnonzero((docs >= toxicity.LEAST_DOCS) & (z >= toxicity.TELLING))
    x = x[:, chosen].astype(float)
    where = {b: k for k, b in enumerate(chosen.tolist())}
    d = np.zeros((len(pairs), len(chosen)))
    for k, (lost, gained) in enumerate(pairs):
        for own, sign in ((lost, -1), (gained, 1)):
            for b in own:
                if b in where:
                    d[k, where[b]] += sign
    cost = np.where(labels == 1, toxicity.MISSED * share / rate, (1 - share) / (1 - rate))
    cost /= cost.sum()
    t = np.array(times, float)
    w, bias = np.zeros(len(chosen)), np.log(share / (1 - share))
    state = np.zeros((2, len(chosen) + 1))
    for step in range(1, toxicity.ROUNDS + 1):
        error = cost * (1 / (1 + np.exp(-(x @ w + bias))) - labels)
        slope = np.append(x.T @ error + toxicity.RIDGE * w + 2 * toxicity.FAIRNESS / t.sum() * d.T @ (t * (d @ w)), error.sum())
        state = np.array([0.9, 0.999])[:, None] * state + np.array([0.1, 0.001])[:, None] * np.array([slope, slope**2])
        move = toxicity.RATE * state[0] / (1 - 0.9**step) / (np.sqrt(state[1] / (1 - 0.999**step)) + 1e-9)
        w, bias = w - move[:-1], bias - move[-1]
    return {b: w[k] for b, k in where.items()}, bias


def test_scores_by_brute_force(spark):
    """Every document of the table, scored by a model fitted and applied with dense matrices."""
    sf = "/root/testdata/sf0.001"
    rows, pairs, times, texts = fitted(spark, sf)
    weights, bias = dense(rows, pairs, sum(y for _, y in rows) / len(rows), times)
    docs = table(spark, sf, "documents")
    got = toxicity.score(docs, toxicity.fit(docs, table(spark, sf, "labels"))).collect()
    assert len(got) == len(texts) and any(weights)
    for r in got:
        seen = toxicity.features_of(set(toxicity._WORD.findall(texts[r.doc_id].lower())))
        assert r.score == pytest.approx(1 / (1 + np.exp(-bias - sum(weights.get(b, 0) for b in seen))), abs=2e-3)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)


def test_an_id_repeated_very_often_counts_once(spark):
    rows = [(k, f"text {k} " + ("idiot" if k % 2 else "friend"), 0) for k in range(40)]
    many = [(1, f"other text {k % 7}", 0) for k in range(3000)]
    labels = spark.createDataFrame([(k, 1, k % 2) for k in range(40)], LABELS)
    seen = []
    original, toxicity.train = toxicity.train, lambda rows, *rest: seen.append(len(rows)) or original(rows, *rest)
    try:
        toxicity.fit(spark.createDataFrame(rows + many, DOCS), labels)
    finally:
        toxicity.train = original
    assert seen == [sum(zlib.crc32(str(k).encode()) % 5 > 0 for k in range(40))]


def test_pairs_that_occur_often():
    rows = [(np.array(sorted(toxicity.features_of({w})), np.int64), y) for w, y in (("idiot", 1), ("man", 1), ("woman", 0), ("friend", 0)) for _ in range(20)]
    pair = [tuple(np.array(sorted(toxicity.features_of({w})), np.int64) for w in p) for p in (("man", "woman"), ("idiot", "friend"))]
    one = toxicity.train(rows, [pair[0]] * 3 + [pair[1]], 0.5)
    two = toxicity.train(rows, pair, 0.5, [3, 1])
    assert one.weights.keys() == two.weights.keys() and all(abs(x - two.weights[b]) < 1e-6 for b, x in one.weights.items())
