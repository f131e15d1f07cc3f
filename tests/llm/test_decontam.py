"""The FM-index and decontamination against plain search."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import decontam
from tidemark.llm.common import table
from tidemark.llm.fmindex import FMIndex, suffix_order

DOCS, ITEMS = "doc_id bigint, text string", "item_id bigint, text string"


def brute_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, window=13):
    windows = {}
    for item, text in items:
        w = brute_words(text)
        for k in range(max(1, len(w) - window + 1) if w else 0):
            windows.setdefault(tuple(w[k : k + window]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, own = brute_words(text), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if (key := tuple(w[k : k + n])) in windows:
                    hit.update(range(k, k + n))
                    own |= windows[key]
        names = sorted(str(i) for i in own if i is not None)
        out.append((doc, len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return Counter(out)


def check(spark, docs, items, **options):
    found = decontam.contamination(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), **options)
    assert Counter(map(tuple, decontam.digest(found).collect())) == brute(docs, items)


@pytest.mark.parametrize("symbols", [2, 3, 5, 90])
def test_index(symbols):
    rng = np.random.default_rng(symbols)
    for _ in range(12):
        text = np.append(rng.integers(0, symbols, int(rng.integers(1, 300))), 0)
        index = FMIndex(text, symbols, sample=4)
        lengths = rng.integers(1, 7, 40)
        patterns = np.where(np.arange(7) < lengths[:, None], rng.integers(1, symbols, (40, 7)), 0)
        low, high = index.search(patterns, lengths)
        for p, n, a, b in zip(patterns, lengths, low, high):
            want = [k for k in range(len(text) - n + 1) if (text[k : k + n] == p[:n]).all()]
            assert sorted(index.locate(np.arange(a, max(a, b))).tolist()) == want


def test_suffix_order_of_copies():
    text = np.array([1, 2, 1, 2, 1, 0] * 20 + [1, 2, 1, 0])
    order = suffix_order(text, 3)
    ends = {k: next(j for j in range(k, len(text)) if text[j] == 0) for k in range(len(text))}
    assert order.tolist() == sorted(range(len(text)), key=lambda k: (*((int(x), 0) for x in text[k : ends[k]]), (0, ends[k])))


@pytest.mark.parametrize("options", [{}, {"block_bytes": 8_000}, {"block_bytes": 3_000, "shard_words": 500}])
def test_table(spark, sf, options):
    """Whole tables, with one block of phrases and with several."""
    docs = [(r.doc_id, r.text) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]
    items = [(r.item_id, r.text) for r in table(spark, sf, "benchmark").collect()]
    assert decontam.block_count(spark.createDataFrame(items, ITEMS), options.get("block_bytes", decontam.BLOCK_BYTES)) > 1 or not options
    check(spark, docs, items, **options)


def test_packed_phrases():
    """Windows and their owners as a plain dictionary has them."""
    items = [(k, " ".join(f"w{(k * j) % 7}" for j in range(n)).encode()) for k, n in enumerate([0, 1, 5, 12, 13, 14, 40, 40, 3, 3])] + [(3, b"w0 w1"), (None, b"w0 w1 w2"), (4, None)]
    made, want = decontam.Phrases.of(items), {}
    for item, text in items:
        words = [made.numbers[w] for w in decontam.words_of(text)]
        for k in range(max(1, len(words) - 12) if words else 0):
            want.setdefault(tuple(words[k : k + 13]), set()).add(None if item is None else str(item))
    got = {tuple(w[:n].tolist()): {made.items[i] for i in made.owners[a:b]} for w, n, a, b in zip(made.windows, made.lengths, made.starts[:-1], made.starts[1:], strict=True)}
    assert got == want and len(made.windows) == len(want) and not any(w[n:].any() for w, n in zip(made.windows, made.lengths))
    assert len(decontam.Phrases.of([]).windows) == len(decontam.Phrases.of([(1, b"?!")]).windows) == 0


@pytest.mark.parametrize("block_bytes", [decontam.BLOCK_BYTES, 8_000])
def test_cleaned_table(spark, sf, block_bytes):
    """What stays and what it says, by brute force: words of clean places and all that isn't between hit words."""
    docs, bench = table(spark, sf, "documents"), table(spark, sf, "benchmark")
    windows = Counter()
    for r in bench.collect():
        w = brute_words(r.text)
        windows.update(tuple(w[k : k + 13]) for k in range(max(1, len(w) - 12) if w else 0))
    sizes, want, cut = {len(w) for w in windows}, {}, 0
    for r in docs.collect():
        spots = [m.span() for m in re.finditer(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", r.text or "")]
        w, hit = brute_words(r.text), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit.update(range(k, k + n))
        if hit and 20 * len(hit) >= len(w):
            continue
        text = r.text
        for k in sorted(hit, reverse=True):
            text = text[: spots[k][0]] + text[spots[k + 1][0] if k + 1 in hit else spots[k][1] :]
        cut += bool(hit)
        want[r.doc_id] = (text, len(text) if hit else r.n_chars, r.lang, r.source)
    got = decontam.decontaminate(docs, bench, block_bytes=block_bytes)
    assert got.columns == docs.columns
    assert {r.doc_id: (r.text, r.n_chars, r.lang, r.source) for r in got.collect()} == want and len(want) < docs.count()


LONG = " ".join(f"w{k % 97}" for k in range(3000))
PASSAGE = "The Quick, brown fox; jumps over (the) lazy dog and 2 more cats than ever before it"
ODD_DOCS = [(1, PASSAGE), (1, PASSAGE), (2, None), (3, ""), (4, "..!"), (None, f"x {PASSAGE} y"), (5, f"{LONG} {PASSAGE} {LONG}"), (6, f"{PASSAGE} {PASSAGE}"), (7, "Éa été"), (8, "short item here"), (9, "a short item here again")]
ODD_ITEMS = [(10, PASSAGE), (9, PASSAGE.upper()), (3, "short item"), (3, "été"), (None, "here again"), (4, None), (5, ""), (6, "?!")]


@pytest.mark.parametrize("options", [{}, {"shard_words": 40}, {"block_bytes": 60}, {"block_bytes": 60, "shard_words": 40}])
def test_odd_rows(spark, options):
    check(spark, ODD_DOCS, ODD_ITEMS, **options)


def test_empty(spark):
    check(spark, [], ODD_ITEMS)
    check(spark, ODD_DOCS, [])


def test_filter_keeps_columns(spark):
    docs = spark.createDataFrame([(1, PASSAGE, 5), (2, "clean", 6), (3, None, None)], "doc_id bigint, text string, n_hit int")
    for block_bytes in (60, 1 << 20):
        kept = decontam.drop_contaminated(docs, spark.createDataFrame(ODD_ITEMS, ITEMS), block_bytes=block_bytes)
        assert kept.columns == docs.columns
        assert sorted(map(tuple, kept.collect())) == [(2, "clean", 6), (3, None, None)]


def test_removal():
    text = "Keep this. The quick brown fox, end".encode()
    assert decontam.without_spans(text, [(2, 4)]) == b"Keep this.  brown fox, end"
    assert decontam.without_spans(text, []) == text


def test_passages_are_removed_from_texts(spark):
    docs = spark.createDataFrame([(1, f"Keep, {PASSAGE}! and this."), (2, None), (3, "clean")], DOCS)
    items = spark.createDataFrame([(1, PASSAGE)], ITEMS)
    got = {r.doc_id: r.text for r in decontam.remove_passages(docs, items).collect()}
    assert got == {1: "Keep, ! and this.", 2: None, 3: "clean"}
    assert all(not r.n_hit for r in decontam.contamination(decontam.remove_passages(docs, items), items).collect())
