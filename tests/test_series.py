"""Series in blocks beside windows and plain loops; as-of reads, hash trees, medians and sweeps beside brute force."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.operators import asof, hashtree, select, sweep
from tidemark.operators.scan import BLOCK, Blocks, apply, compose


@pytest.fixture(scope="module")
def moves(spark):
    """One series with most rows, one over exactly a few blocks, many of one row, and one without a key."""
    rng = random.Random(4)
    rows = [("hot" if k % 5 else rng.choice(["a", "b", None, f"only{k}"]), k, rng.choice([None, 1, -1, 7, -9]), rng.choice(["x", "x", "y", None])) for k in range(2000)]
    return spark.createDataFrame(rows, "key string, at int, move bigint, state string"), rows


def by_key(rows):
    out: dict = {}
    for r in sorted(rows, key=lambda r: r[1]):
        out.setdefault(r[0], []).append(r)
    return out


@pytest.mark.parametrize("count", [1, 3, 16])
def test_scans_equal_windows(moves, count):
    frame, rows = moves
    blocks = Blocks(frame, ["key"], ["at"], count)
    # The long series lies in most of the blocks.
    assert blocks.rows.where("key = 'hot'").select(BLOCK).distinct().count() >= count * 3 // 5
    window = W.partitionBy("key").orderBy("at")
    want = frame.select("key", "at", F.sum("move").over(window.rowsBetween(W.unboundedPreceding, 0)).alias("total"), F.lag("state").over(window).alias("before"))
    assert set(blocks.running_sum(F.col("move")).select("key", "at", "total").collect()) == set(want.select("key", "at", "total").collect())
    assert set(blocks.previous("state").select("key", "at", "before_state").collect()) == set(want.select("key", "at", "before").collect())
    changes = []
    for key, own in by_key(rows).items():
        n = 0
        for k, r in enumerate(own):
            if not k or own[k - 1][3] != r[3]:
                n += 1
                changes.append((key, r[1], n))
    assert sorted(map(tuple, blocks.transitions("state").select("key", "at", "ordinal").collect()), key=str) == sorted(changes, key=str)


@pytest.mark.parametrize("count", [1, 7])
def test_clamped_states(spark, moves, count):
    frame, rows = moves
    batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for size in (13, batch):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
            want = []
            for key, own in by_key(rows).items():
                x = 5
                for r in own:
                    x = min(20, max(0, x + (r[2] or 0)))
                    want.append((key, r[1], x))
            got = Blocks(frame, ["key"], ["at"], count).clamped("move", 0, 20, 5, "level").select("key", "at", "level").collect()
            assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)


def test_maps_compose():
    rng = random.Random(1)
    for _ in range(500):
        f, g = ((rng.randint(-30, 30), *sorted((rng.randint(0, 20), rng.randint(0, 20)))) for _ in range(2))
        assert all(apply(compose(f, g), x) == apply(g, apply(f, x)) for x in range(-5, 26))


def test_no_rows(spark):
    blocks = Blocks(spark.createDataFrame([], "key string, at int, move bigint"), ["key"], ["at"])
    assert blocks.running_sum(F.col("move")).count() == blocks.previous("move").count() == blocks.clamped("move", 0, 1, 0).count() == 0


DAY = datetime(2026, 8, 1)


def test_as_of(spark):
    rng = random.Random(8)
    states = [(f"k{rng.randrange(20)}", "ab"[rng.randrange(2)], DAY + timedelta(seconds=rng.choice([0.25, 0.5, 1, 3600, 86_400]) * rng.randrange(50)) if rng.random() < 0.9 else None, n) for n in range(300)]
    states = [(f"{g}{k}", g, t, n) for k, g, t, n in states]
    asked = [(n, "abc"[n % 3], DAY + timedelta(seconds=rng.choice([0.25, 1800.5, 40_000]) * rng.randrange(100))) for n in range(60)] + [(60, "a", None), (61, None, DAY), (62, "a", DAY - timedelta(days=1)), (63, "a", DAY + timedelta(days=9000))]
    frame = spark.createDataFrame(states, "key string, g string, known timestamp_ntz, n int")
    got = asof.as_of(frame, spark.createDataFrame(asked, "d int, g string, at timestamp_ntz"), "g", "key", "known", "at", ["n"])
    want = set()
    for d, g, at in asked:
        for key in {s[0] for s in states}:
            own = [s for s in states if s[0] == key and s[1] == g and s[2] is not None and at is not None and s[2] <= at]
            if own:
                want.add((d, key, max(own, key=lambda s: (s[2], s[3]))[3]))
    assert set(map(tuple, got.select("d", "key", "n").collect())) == want and got.count() == len(want)
    # A correction after all decisions changes nothing.
    late = frame.unionByName(frame.where("known IS NOT NULL").withColumn("known", F.lit(datetime(2100, 1, 1)).cast("timestamp_ntz")))
    again = asof.as_of(late, spark.createDataFrame(asked, "d int, g string, at timestamp_ntz"), "g", "key", "known", "at", ["n"])
    assert set(map(tuple, again.select("d", "key", "n").collect())) == want


def test_pieces_cover_once(spark):
    pairs = [(a, z) for a in range(0, 40, 3) for z in range(a, 70, 5)]
    rows = spark.createDataFrame(pairs, "a long, z long").select("a", "z", asof.pieces(F.col("a"), F.col("z"), 8).alias("p")).collect()
    for r in rows:
        assert sorted(x for level, at in r.p for x in range(at << level, at + 1 << level)) == list(range(r.a, r.z + 1))


def test_hash_tree(spark):
    rows = [(n, f"m{n % 3}", n % 30, None if n % 7 == 0 else n % 5) for n in range(600)]
    other = [r if r[0] != 100 else (100, "m1", 10, 99) for r in rows if r[0] != 31] + [(900, "m2", 2, 1)]
    schema = "id int, month string, day int, v int"
    a, b = spark.createDataFrame(rows, schema), spark.createDataFrame(other, schema)
    levels = {"month": F.col("month"), "day": F.col("day")}
    assert sorted(map(tuple, hashtree.differences(a, b, levels, "id", ["v"]).collect())) == [(31, "missing"), (100, "changed"), (900, "extra")]
    assert hashtree.differences(a, a, levels, "id", ["v"]).count() == 0
    left, right = (hashtree.digests(x, levels, ["id", "v"]) for x in (a, b))
    # Buckets that are equal are never met: 3 of 30 are left.
    assert sorted(map(tuple, hashtree.changed(left, right, ["month", "day"]).collect())) == [("m1", 1), ("m1", 10), ("m2", 2)]
    # Neither a null beside a zero nor a repeated row goes unseen.
    none, zero = spark.createDataFrame([(1, "m", 1, None)], schema), spark.createDataFrame([(1, "m", 1, 0)], schema)
    assert [r.kind for r in hashtree.differences(none, zero, levels, "id", ["v"]).collect()] == ["changed"]


@pytest.mark.parametrize("values", [[1.0], [2.0, 1.0], [5.0] * 900 + [1.0, 9.0], [float(n % 10) for n in range(1001)], [float(n) for n in range(1000)], [3.0] * 501 + [4.0] * 501, [1e300, -1e300, 1e-300, 0.0] * 50, []])
def test_medians(spark, values):
    rng = random.Random(3)
    rng.shuffle(values)
    frame = spark.createDataFrame([(v,) for v in [*values, None, None]], "v double")
    ranked = sorted(values)
    n = len(ranked)
    want = None if not n else ranked[n // 2] if n % 2 else (ranked[n // 2 - 1] + ranked[n // 2]) / 2
    assert select.median(frame, F.col("v"), few=4) == want
    for k in range(0, n, max(1, n // 7)):
        assert select.kth(frame, F.col("v"), k, few=4, accuracy=20) == ranked[k]


def test_sweep(spark):
    at = lambda h: DAY + timedelta(hours=h)
    rows = [("a", 1, 3), ("a", 2, 4), ("a", 4, 5), ("a", 7, 8), ("a", 7, 8), ("a", 9, 9), ("a", 8, 6), ("a", -5, 1), ("a", 11, 99), ("b", 0, 12), ("c", 1, 2)]
    frame = spark.createDataFrame([(k, at(s), at(e)) for k, s, e in rows] + [("b", None, at(3)), ("b", at(3), None)], "k string, s timestamp_ntz, e timestamp_ntz")
    bounds = spark.createDataFrame([(k, at(0), at(12)) for k in "abd"] + [("c", at(5), at(5))], "k string, s timestamp_ntz, e timestamp_ntz")
    got = sorted((r.k, r.kind, (r.s - DAY).total_seconds() / 3600, (r.e - DAY).total_seconds() / 3600) for r in sweep.coverage(frame, bounds, ["k"], "s", "e").collect())
    assert got == [("a", "gap", 5, 7), ("a", "gap", 8, 11), ("a", "overlap", 2, 3), ("a", "overlap", 7, 8), ("d", "gap", 0, 12)]


def test_days_on_which_clocks_change(spark):
    """Hours of prices and five minutes of load on days of 23 and 25 hours, a stretch missing from each."""
    from datetime import date

    from tidemark.functions import timez

    days = spark.createDataFrame([(p, d) for p in ("lmp", "load") for d in (date(2026, 3, 8), date(2026, 11, 1))], "product string, market_date date")
    first, last = timez.day_bounds(F.col("market_date"))
    bounds = days.select("product", "market_date", first.alias("s"), last.alias("e"))
    step = F.when(F.col("product") == "lmp", F.expr("interval 60 minutes")).otherwise(F.expr("interval 5 minutes"))
    rows = bounds.select("product", "market_date", F.explode(F.sequence("s", F.col("e") - step, step)).alias("s"), step.alias("by"))
    rows = rows.select("product", "market_date", "s", (F.col("s") + F.col("by")).alias("e"))
    assert rows.where("product = 'lmp'").groupBy("market_date").count().orderBy("market_date").collect() == [(date(2026, 3, 8), 23), (date(2026, 11, 1), 25)]
    assert sweep.coverage(rows, bounds, ["product", "market_date"], "s", "e").count() == 0
    holes = rows.where("NOT (hour(s) = 12)").unionByName(rows.where("hour(s) = 15 AND product = 'load'"))
    got = sweep.coverage(holes, bounds, ["product", "market_date"], "s", "e")
    assert sorted((r.product, str(r.market_date), r.kind, r.s.hour, r.e.hour) for r in got.collect()) == sorted(
        (p, d, k, h, h + 1) for d in ("2026-03-08", "2026-11-01") for p, k, h in (("lmp", "gap", 12), ("load", "gap", 12), ("load", "overlap", 15))
    )
