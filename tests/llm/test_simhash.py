"""SimHash groups against all pairs."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from tidemark.llm import simhash, vptree
from tidemark.llm.common import table

DOCS = "doc_id bigint, text string"


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, prints):
    """Smallest reachable id of each row, by a matrix of all pairs."""
    prints = np.array(prints, np.uint64)
    a, b = np.nonzero(np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 4)
    label = vptree.connected(len(prints), a, b)
    least = {}
    for i, l in zip(ids, label.tolist(), strict=True):
        if i is not None:
            least[l] = min(i, least.get(l, i))
    return [least.get(l) for l in label.tolist()]


def check(spark, rows, **options):
    got = simhash.digest(simhash.groups(spark.createDataFrame(rows, DOCS), **options)).collect()
    prints = [brute_fingerprint(t) for _, t in rows]
    want = zip([i for i, _ in rows], [f"{p:016x}" for p in prints], brute_components([i for i, _ in rows], prints), strict=True)
    assert Counter(map(tuple, got)) == Counter(want)


def test_table(spark, sf):
    rows = [(r.doc_id, r.text) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]
    check(spark, rows)


def test_odd_rows(spark):
    check(spark, [(3, None), (1, ""), (2, " \t\n"), (5, "One"), (4, "one"), (4, "one"), (None, "null id here now"), (9, "É a b c d"), (8, "x y z"), (7, "w " * 9000)])


def test_empty(spark):
    assert simhash.groups(spark.createDataFrame([], DOCS)).collect() == []


def test_same_hash_as_engine(spark):
    assert spark.sql("select xxhash64('a b c d')").first()[0] == simhash._signed(xxhash.xxh64_intdigest(b"a b c d", 42))


@pytest.mark.parametrize("cell_points", [2_000_000, 40])
def test_dense_groups(spark, cell_points):
    """A dense ball, chains and strangers; small cells are dealt over pairs of parts."""
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 64, 400, dtype=np.uint64)
    parts, ball, chain = [base], np.repeat(base[:1], 500), base[1:60]
    for _ in range(3):
        ball = ball ^ (np.uint64(1) << rng.integers(0, 64, len(ball)).astype(np.uint64))
    for _ in range(6):
        for _ in range(3):
            chain = chain ^ (np.uint64(1) << rng.integers(0, 64, len(chain)).astype(np.uint64))
        parts.append(chain)
    points = np.unique(np.concatenate([*parts, ball]))
    frame = spark.createDataFrame([(int(x),) for x in points.view(np.int64)], "fingerprint bigint")
    roots = {r.node: r.root for r in simhash.group_roots(frame, cell_points=cell_points).collect()}
    a, b = np.nonzero(np.bitwise_count(points[:, None] ^ points[None, :]) <= 4)
    label = vptree.connected(len(points), a, b)
    signed = points.view(np.int64).tolist()
    got = [roots.get(x, x) for x in signed]
    assert len(set(zip(got, label.tolist()))) == len(set(got)) == len(set(label.tolist()))


def test_keep_one(spark):
    rows = [(2, "a b c d e", 1), (1, "a b c d e", 1), (1, "a b c d e", 1), (3, "quite another text of words", 1), (None, "a b c d e", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, __hash int").withColumnRenamed("__hash", "__HASH")
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect())) == [(1, "a b c d e", 1), (3, "quite another text of words", 1)]


def test_levels_follow_the_count():
    assert [simhash.levels_for(n) for n in (0, 10_000_000)] == [3, 3]
    assert 3 < simhash.levels_for(10**10) < simhash.levels_for(10**12) <= simhash.MOST_LEVELS
    near = simhash._later_neighbours(2, 1)
    assert near == [(1, -1), (1, 1)]


@pytest.mark.parametrize("levels", [5, 8])
def test_more_levels(spark, levels):
    rng = np.random.default_rng(levels)
    prints = {int(x) for x in rng.integers(0, 1 << 64, 40, np.uint64)}
    prints |= {x ^ 1 << int(a) ^ 1 << int(b) for x in list(prints)[:20] for a, b in [rng.integers(0, 64, 2)] if a != b}
    points = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in sorted(prints)], "fingerprint bigint")
    vantage, masks = simhash._vantage_points(levels), simhash._masks(simhash.BLOCKS)
    homes = {(r.block, r.fingerprint & (1 << 64) - 1): r.cell for r in simhash.shard_routes(points, levels=levels).where("home").collect()}
    for (block, x), cell in homes.items():
        assert cell == sum(((x ^ v) & masks[block]).bit_count() + 32 << 7 * (levels - 1 - k) for k, v in enumerate(vantage))
    assert len(homes) == 3 * len(prints)
    order = sorted(prints)
    found = [(order.index(r.a & (1 << 64) - 1), order.index(r.b & (1 << 64) - 1)) for r in simhash.links(points, levels=levels).collect()]
    a, b = np.nonzero(np.bitwise_count(np.array(order, np.uint64)[:, None] ^ np.array(order, np.uint64)[None, :]) <= 4)
    want = vptree.connected(len(order), a, b)
    got = vptree.connected(len(order), np.array([x for x, _ in found]), np.array([y for _, y in found]))
    assert len(found) >= 15 and {tuple(np.flatnonzero(got == g)) for g in got} == {tuple(np.flatnonzero(want == w)) for w in want}
