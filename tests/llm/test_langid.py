"""Language identification on labels that were held out, and the network's arithmetic."""

from __future__ import annotations

import zlib

import numpy as np
import pytest

from tidemark.llm import langid
from tidemark.llm.common import table

DOCS = "doc_id bigint, text string, lang string, score int"


@pytest.fixture(scope="module")
def fitted(spark, sf):
    docs = table(spark, sf, "documents")
    return docs, langid.fit(docs)


def test_held_out_accuracy(fitted):
    docs, net = fitted
    truth = {r.doc_id: r.lang for r in docs.collect()}
    rows = langid.identify(docs, net).collect()
    assert len(rows) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    judged = [r.lang_pred == truth[r.doc_id] for r in rows if r.held_out and truth[r.doc_id]]
    assert sum(judged) >= 0.95 * len(judged)
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_rows(spark, fitted):
    _, net = fitted
    rows = [(1, None, "en", 1), (2, "", None, 1), (3, "123 $$$", "fr", 1), (None, "the and of the", "en", 1), (4, "x" * 200_000, "en", None), (4, "x" * 200_000, "en", None)]
    got = sorted(langid.identify(spark.createDataFrame(rows, DOCS), net).collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    assert [r.lang_pred == langid.UNKNOWN for r in got] == [False, True, True, True, False, False]
    assert [r.score for r in got[1:4]] == [0, 0, 0] and got[0].held_out is False and got[4] == got[5]


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "some text", None, 1)], DOCS)
    net = langid.fit(docs)
    assert [tuple(r)[2:] for r in langid.identify(docs, net).collect()] == [("und", 0.0)]
    assert langid.identify(docs.limit(0), langid.fit(docs.limit(0))).collect() == []


def test_applied_equals_trained(fitted):
    _, net = fitted
    windows, counts = langid.cut([b"the quick brown fox" * 40, b"", b"a"])
    assert counts.tolist() == [3, 1, 1]
    top, _ = net.pooled(windows)
    plain = np.log(langid.softmax(np.maximum(top + net.bias, 0) @ net.weights + net.offset))
    assert np.allclose(langid.Applied(net).log_probabilities(windows), plain, atol=1e-4)


def test_windows_hold_every_run():
    text = bytes(range(1, 256)) * 3
    windows, _ = langid.cut([text], window=32, overlap=4)
    runs = {bytes(w[k : k + 5]) for w in windows for k in range(28)}
    assert all(text[k : k + 5] in runs for k in range(len(text) - 4))


def brute(net, text):
    """Language and score of a text: windows by slicing, each filter's response at each place, their maxima, the
    softmax, and the mean of the windows' log-probabilities."""
    lowered = bytes(b + 32 if 65 <= b <= 90 else b for b in text)
    overlap = max(langid.WIDTHS) - 1
    step, windows, at = langid.WINDOW - overlap, [], 0
    while True:
        windows.append(lowered[at : at + langid.WINDOW].ljust(langid.WINDOW, b"\0"))
        at += step
        if at + overlap >= len(lowered):
            break
    total = 0
    for window in windows:
        top = []
        for table_ in net.tables:
            width = len(table_)
            places = [sum(table_[k][window[p + k]] for k in range(width)) for p in range(langid.WINDOW - width + 1)]
            top.append(np.max(places, axis=0))
        logits = np.maximum(np.concatenate(top) + net.bias, 0) @ net.weights + net.offset
        total = total + logits - np.log(np.exp(logits - logits.max()).sum()) - logits.max()
    mean = total / len(windows)
    chance = np.exp(mean - mean.max()) / np.exp(mean - mean.max()).sum()
    return net.languages[int(chance.argmax())], float(chance.max())


def test_judged_by_brute_force(spark, fitted):
    """Every document of the table, and texts at the edges of windows."""
    docs, net = fitted
    sizes = [1, 4, 5, 251, 252, 253, 256, 257, 260, 504, 508, 509, 760, 20_000]
    own = [(-k, ("der die das und THE OF le les élan " * 800)[: n], None, 0) for k, n in enumerate(sizes, 1)]
    rows = [(r.doc_id, r.text) for r in docs.collect()] + [(d, t) for d, t, _, _ in own]
    got = {r.doc_id: r for r in langid.identify(docs.select("doc_id", "text").unionByName(spark.createDataFrame(own, DOCS).select("doc_id", "text")), net).collect()}
    assert len(got) == len(rows)
    for doc, text in rows:
        if not text or not any(c.isalpha() for c in text):
            assert (got[doc].lang_pred, got[doc].score) == (langid.UNKNOWN, 0)
        elif len(text) < 8_000 or doc < 0:
            lang, score = brute(net, text.encode())
            assert got[doc].score == pytest.approx(score, abs=1e-4)
            assert got[doc].lang_pred == lang or abs(score - 0.5) < 1e-3


def test_sample_is_of_whole_texts(spark):
    """Windows as in judging, from every part of the texts, no more of a language than asked, none of fold 0."""
    long = "".join(f"<{k:06d}>" for k in range(40_000))
    rows = [(k, long, "xx", 0) for k in range(20)] + [(100 + k, f"short {k}", "yy", 0) for k in range(30)] + [(200, None, "yy", 0), (201, "", "yy", 0), (202, "no language", None, 0), (None, "no id", "yy", 0)]
    got = langid.training_sample(spark.createDataFrame(rows, DOCS), 300).collect()
    learned = [d for d, *_ in rows if d is not None and zlib.crc32(str(d).encode()) % 5]
    every = {bytes(w).rstrip(b"\0") for w in langid.cut([long.encode()])[0]}
    xs = [bytes(r.window) for r in got if r.lang == "xx"]
    assert len(xs) == 300 and set(xs) <= every
    places = sorted(int(x[x.index(b"<") + 1 :][:6]) for x in xs)
    assert [sum(a <= p < a + 10_000 for p in places) > 40 for a in range(0, 40_000, 10_000)] == [True] * 4
    assert sorted(bytes(r.window).decode() for r in got if r.lang == "yy") == sorted(f"short {d - 100}" for d in learned if 100 <= d < 200)


def test_repeated_ids_lose_no_language(spark):
    """A language whose rows all share one id, and one whose rows are copies of one row, are learned like others."""
    rows = [(n, f"the {n} and that of", "en", 1) for n in range(3000)]
    for doc_id in (1, 2, 3, 4):
        own = [(doc_id, f"mot {n} et ce de la", "fr", 1) for n in range(5000)] + [(doc_id, "una sola riga", "it", 1)] * 5000
        sample = langid.training_sample(spark.createDataFrame(rows + own, DOCS).repartition(8), 300)
        found = {r.lang: r["count"] for r in sample.groupBy("lang").count().collect()}
        assert found == {"en": 300, "fr": 300, "it": 1}
