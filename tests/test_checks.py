"""Orphans behind a filter, stored distinct counts, assertions, parameters and loads beside plain Python."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidemark.operators import asserts, bloom, distinct
from tidemark.sources import tables


@pytest.mark.parametrize("most_words", [bloom.MOST_WORDS, 0])
def test_orphans(spark, most_words):
    """One key holds half the child's rows; keys are texts, some null; with no filter the rows are the same."""
    rng = random.Random(2)
    child = [f"k{rng.randrange(400)}" if k % 2 else "hot" for k in range(3000)] + [None] * 5
    parent = [f"k{k}" for k in range(0, 20_000, 3)] * 2 + [None]
    seen = Observation()
    frame = bloom.orphans(spark.createDataFrame([(k,) for k in child], "c string"), "c", spark.createDataFrame([(k,) for k in parent], "p string"), "p", seen, most_words)
    want = Counter(k for k in child if k is not None and k not in set(parent))
    assert {r.c: r.n for r in frame.collect()} == dict(want) and "hot" in want
    meets = sum(k in set(child) for k in parent if k)
    if most_words:
        # 13,334 rows of the parent have a key; a tenth of those that the child lacks may pass.
        assert meets <= seen.get["n"] <= meets + len(parent) // 10
    else:
        assert seen.get["n"] == len(parent) - 1


def test_orphans_of_nothing(spark):
    some, none = spark.createDataFrame([(1,), (1,), (None,)], "k bigint"), spark.createDataFrame([], "k bigint")
    assert bloom.orphans(none, "k", some, "k").count() == 0
    assert [tuple(r) for r in bloom.orphans(some, "k", none, "k").collect()] == [(1, 2)]
    assert [tuple(r) for r in bloom.orphans(some.withColumnRenamed("k", "n"), "n", none.withColumnRenamed("k", "n"), "n").collect()] == [(1, 2)]
    with pytest.raises(ValueError, match="different types"):
        bloom.orphans(some, "k", spark.createDataFrame([], "k string"), "k")


def test_filter_loses_no_key(spark):
    keys = spark.range(-5000, 5000).select(F.sha2(F.col("id").cast("string"), 256).alias("k"))
    words = bloom.words_for(10_000)
    made = bloom.filter_of(keys, "k", words)
    assert bloom.maybe(keys, "k", made, words).count() == 10_000
    others = spark.range(10**6, 10**6 + 50_000).select(F.sha2(F.col("id").cast("string"), 256).alias("k"))
    assert bloom.maybe(others, "k", made, words).count() < 5_000


def test_distinct_of_builds(spark, tmp_path):
    """Three builds whose rows overlap; numbers of both signs, beyond one stretch, and nulls; then coarser levels."""
    rng = random.Random(5)
    builds = [[(rng.choice(["a", "b", None]), rng.randrange(4), rng.choice([None, -1, 0, 32_767, 32_768, 32_769, -32_768, -40_000, rng.randrange(100_000)])) for _ in range(500)] for _ in range(3)]
    for k, rows in enumerate(builds):
        frame = spark.createDataFrame(rows, "hub string, day int, x bigint")
        distinct.bitmaps(frame, {"hub": F.col("hub"), "day": F.col("day")}, F.col("x")).write.parquet(str(tmp_path / str(k)))
    stored = distinct.merged([spark.read.parquet(str(tmp_path / str(k))) for k in range(3)], ["hub", "day"])
    rows = spark.createDataFrame([r for b in builds for r in b], "hub string, day int, x bigint")
    for levels in (["hub", "day"], ["hub"], ["day"], []):
        want = rows.groupBy(*levels).agg(F.count("*"), F.count_distinct("x"))
        assert sorted(map(str, distinct.counts(stored, levels).collect())) == sorted(str(r).replace("count(1)", "n").replace("count(DISTINCT x)", "distinct_n") for r in want.collect())
    with pytest.raises(ValueError, match="bits"):
        distinct.bitmaps(rows, {"bits": F.col("hub")}, F.col("x"))


def test_distinct_of_nothing(spark):
    none = spark.createDataFrame([], "day int, x bigint")
    assert distinct.counts(distinct.bitmaps(none, {"day": F.col("day")}, F.col("x")), ["day"]).count() == 0
    nulls = spark.createDataFrame([(1, None), (1, None)], "day int, x bigint")
    assert [tuple(r) for r in distinct.counts(distinct.bitmaps(nulls, {"day": F.col("day")}, F.col("x")), ["day"]).collect()] == [(1, 2, 0)]


def test_assertions(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    good = rows.where("k IS NOT NULL")
    assert asserts.each(good, F.col("k") > 0, "k is too small").count() == 2
    assert asserts.all_of(good, F.count("*") == 2, good, "two rows").count() == 2
    for broken in (asserts.each(good, F.col("k") > 1, "no such k"), asserts.each(rows, F.col("k") > 0, "no such k"), asserts.all_of(good, F.count("*") == 3, good, "no such k"), asserts.all_of(good, F.max("k") > 5, rows.where("k > 9"), "no such k")):
        with pytest.raises(Exception, match="no such k"):
            broken.collect()
    # A pruned column doesn't take its assertion with it.
    with pytest.raises(Exception, match="no such k"):
        asserts.each(rows, F.col("k") > 0, "no such k").select("v").count()


def test_parameters(spark):
    schema = StructType([StructField("k", LongType(), False), StructField("v", StringType())])
    none = tables.parameters(spark, [], schema)
    assert none.schema == schema and none.count() == 0
    assert [tuple(r) for r in tables.parameters(spark, [(1, None)], schema).collect()] == [(1, None)]
    for wrong in ([(None, "a")], [("1", "a")], [(1,)]):
        with pytest.raises(Exception):  # noqa: B017 - types, nulls and lengths have errors of their own
            tables.parameters(spark, wrong, schema).collect()


def test_counted_writes(spark, tmp_path):
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("counted", "one job")
    rows = spark.range(1000).withColumn("even", F.col("id") % 2 == 0)
    assert tables.write_counted(rows, str(tmp_path / "a"), even=F.count_if("even")) == {"n": 1000, "even": 500}
    assert len(jobs.getJobIdsForGroup("counted")) == 1
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    for k, none in enumerate((rows.where("id < 0"), spark.createDataFrame([], "id int"), rows.where("false"))):
        assert tables.write_counted(none, str(tmp_path / f"none{k}"))["n"] == 0
        assert spark.read.parquet(str(tmp_path / f"none{k}")).count() == 0
    with pytest.raises(Exception, match="(?i)exist"):
        tables.write_counted(rows, str(tmp_path / "a"))


def test_replacing_partitions(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "v int, day string"
    tables.replace_partitions(spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], schema), path, "day")
    for _ in range(2):
        tables.replace_partitions(spark.createDataFrame([(7, "b"), (8, "b"), (9, "c")], schema), path, "day")
        assert sorted(map(str, (tuple(r) for r in spark.read.schema(schema).parquet(path).collect()))) == sorted(map(str, [(1, "a"), (7, "b"), (8, "b"), (9, "c"), (3, None)]))
    tables.replace_partitions(spark.createDataFrame([], schema), path, "day")
    assert spark.read.schema(schema).parquet(path).count() == 5
