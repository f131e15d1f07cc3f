"""The lookup table against a plain filling, and placement against it."""

from __future__ import annotations

import re
from collections import Counter

import pytest
import xxhash

from tidemark.llm import queries, sharding
from tidemark.llm.common import table

NAMES = [f"shard-{k:03d}" for k in range(64)]


def brute_fill(names, slots):
    orders = []
    for n in names:
        offset, skip = sharding.preference(n, slots)
        orders.append([(offset + j * skip) % slots for j in range(slots)])
    owner, at = {}, [0] * len(names)
    while len(owner) < slots:
        for k, order in enumerate(orders):
            if len(owner) == slots:
                break
            while order[at[k]] in owner:
                at[k] += 1
            owner[order[at[k]]] = k
    return [owner[s] for s in range(slots)]


def brute_slot(key, slots=sharding.SLOTS):
    if key is None:
        h = xxhash.xxh64_intdigest((0).to_bytes(4, "little"), 42)
    else:
        h = xxhash.xxh64_intdigest(str(key).encode(), 42)
    return (h - (1 << 64) if h >> 63 else h) % slots


@pytest.mark.parametrize("count, slots", [(1, 7), (3, 7), (7, 7), (5, 101), (64, 1009)])
def test_fill(count, slots):
    table = sharding.fill(NAMES[:count], slots)
    assert table == brute_fill(NAMES[:count], slots)
    shares = Counter(table)
    assert max(shares.values()) - min(shares.values()) <= 1


def test_little_moves_when_a_shard_goes():
    before, after = sharding.fill(NAMES, 10_007), sharding.fill(NAMES[:-1], 10_007)
    moved = sum(a != b for a, b in zip(before, after) if a != 63)
    assert moved < 0.05 * 10_007


def test_turns_weigh():
    shares = Counter(sharding.fill(["a", "b"], 1009, [3, 1]))
    assert abs(shares[0] - 3 * shares[1]) <= 4


def test_bad_arguments():
    for names, slots, turns in (([], 7, None), (["a", "a"], 7, None), (["a"], 8, None), (["a", "b"], 7, [0, 0]), (["a"], 7, [1, 1]), (NAMES, 7, None)):
        with pytest.raises(ValueError):
            sharding.fill(names, slots, turns)


def test_table(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id")
    placed = sharding.place(docs, "doc_id", NAMES)
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|ExistingRDD|Cartesian|SortMerge", plan)
    slots = sharding.fill(NAMES)
    want = [(r.doc_id, s := brute_slot(r.doc_id), slots[s]) for r in docs.collect()]
    assert Counter(map(tuple, placed.collect())) == Counter(want)


def test_odd_rows(spark):
    rows = [(1, "a", 9), (1, "a", 9), (None, None, None), (2, "", 1), (3, "x" * 100_000, 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, shard int")
    placed = sharding.place(docs, "source", NAMES[:5], 101)
    assert placed.columns == ["doc_id", "source", "slot", "shard"]
    slots = sharding.fill(NAMES[:5], 101)
    assert Counter(map(tuple, placed.collect())) == Counter((d, s, k := brute_slot(s, 101), slots[k]) for d, s, _ in rows)
    assert sharding.place(docs.limit(0), "source", NAMES[:5], 101).collect() == []


def test_hot_key_is_split(spark):
    docs = spark.range(3000).selectExpr("id doc_id", "if(id % 3 = 0, 'hot', concat('k', id % 50)) source")
    placed = sharding.place(docs, "source", NAMES[:8], 101, split_rows=100, split_by="doc_id").collect()
    assert len(placed) == 3000
    per_slot = Counter(r.slot for r in placed if r.source == "hot")
    assert len(per_slot) > 5 and max(per_slot.values()) < 400
    assert all(len({r.slot for r in placed if r.source == s}) == 1 for s in ("k1", "k2"))


def test_query_places_whole_rows_and_splits_hot_keys(spark, sf, tmp_path):
    docs = table(spark, sf, "documents")
    hot = spark.range(3000).selectExpr("if(id < 1500, NULL, -5L) doc_id", "concat('text ', id) text")
    docs.unionByName(hot, allowMissingColumns=True).write.parquet(f"{tmp_path}/documents.parquet")
    given = spark.read.parquet(f"{tmp_path}/documents.parquet")
    placed = queries.op3_sharding(spark, str(tmp_path))
    assert placed.columns == [*given.columns, "slot", "shard"]
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|ExistingRDD|Cartesian|SortMerge", plan)
    rows = placed.collect()
    assert Counter(map(tuple, (r[:-2] for r in rows))) == Counter(map(tuple, given.collect()))
    slots = sharding.fill(NAMES)
    assert all(slots[r.slot] == r.shard for r in rows)
    for key in (None, -5):
        parts = Counter(r.slot for r in rows if r.doc_id == key)
        assert len(parts) == 2 and max(parts.values()) < 900
    assert all(r.slot == brute_slot(r.doc_id) for r in rows if r.doc_id not in (None, -5))


def test_many_split_keys_are_joined_without_a_broadcast(spark, monkeypatch):
    """Beyond the bound the keys' counts are joined by key, with the same shards."""
    from tidemark.llm import common

    rows = [(k % 7 if k % 3 else None, f"t{k % 50}", k) for k in range(600)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, slot int")
    names = [f"s{k}" for k in range(5)]

    def placed():
        return sharding.place(docs, "doc_id", names, slots=101, split_rows=20, split_by="text")

    one = sorted(map(str, placed().collect()))
    monkeypatch.setattr(common, "MOST_BROADCAST", 1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        two = placed()
        assert sorted(map(str, two.collect())) == one and len(one) == 600
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
