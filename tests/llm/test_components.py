"""Connected components beside a plain search, hubs included."""

from __future__ import annotations

import random

import pytest

from tidemark.llm import components


def brute(links):
    near = {}
    for a, b in links:
        if a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    out = {}
    for start in sorted(near):
        if start in out:
            continue
        waiting = [start]
        while waiting:
            node = waiting.pop()
            if node not in out:
                out[node] = start
                waiting += near[node]
    return out


def cases():
    draw = random.Random(6)
    chain = [(k, k + 1) for k in range(-30, 60)]
    hubs = [(1000, k) for k in range(1001, 1400)] + [(2000, k) for k in range(1500, 1999)] + [(1399, 3000), (3000, 1500)]
    some = [(draw.randrange(300), draw.randrange(300)) for _ in range(200)]
    return {"none": [], "self": [(1, 1)], "chain": chain, "hubs": hubs, "some": some + some, "all": chain + hubs + [(a + 5000, b + 5000) for a, b in some]}


@pytest.mark.parametrize("least", [5, 1000])
@pytest.mark.parametrize("name", cases())
def test_components(spark, monkeypatch, name, least):
    monkeypatch.setattr(components, "LEAST", least)
    links = cases()[name]
    got = components.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    assert {r.node: r.root for r in got} == brute(links) and len(got) == len(brute(links))


def test_heavy_nodes_are_few(spark, monkeypatch):
    """However many pairs there are, the looked-up table has a bounded number of rows."""
    monkeypatch.setattr(components, "LEAST", 1)
    monkeypatch.setattr(components, "HEAVY", 8)
    pairs = spark.range(4000).selectExpr("id % 50 AS u", "id AS v")
    least = max(components.LEAST, 2 * 4000 // components.HEAVY)
    assert pairs.groupBy("u").count().where(f"count > {least}").count() <= components.HEAVY / 2
    got = {(r.u, r.v, r.m) for r in components._toward_minimum(pairs, 4000).collect()}
    assert got == {(k % 50, k, min(k % 50, k % 50)) for k in range(4000)}
