"""Changes found by the stream are those of a batch over all rows, also after a restart in mid-stream."""

from __future__ import annotations

import random
import time

from pyspark.sql import functions as F

from tidemark.operators.scan import Blocks
from tidemark.streaming import changes

SCHEMA = "logical_key string, content_hash string, at bigint"


def feed(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    time.sleep(0.05)


def run(spark, tmp, name="c"):
    source = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{tmp}/in")
    query = changes.write(source, f"{tmp}/out-{name}", f"{tmp}/checkpoint-{name}")
    assert query.awaitTermination(240) is not False and query.exception() is None
    return sorted(map(tuple, spark.read.parquet(f"{tmp}/out-{name}").select("logical_key", "content_hash", "at", "ordinal").collect()), key=str)


def batch(spark, tmp):
    rows = spark.read.schema(SCHEMA).parquet(f"{tmp}/in")
    return sorted(map(tuple, Blocks(rows, ["logical_key"], ["at"]).transitions("content_hash").select("logical_key", "content_hash", "at", "ordinal").collect()), key=str)


def test_a_state_that_comes_back(spark, tmp_path):
    for at, content in enumerate(["A", "A", "B", "A", None, None, "A"]):
        feed(spark, f"{tmp_path}/in", [("k", content, at)])
    got = run(spark, tmp_path)
    assert [(r[1], r[3]) for r in sorted(got, key=lambda r: r[2])] == [("A", 1), ("B", 2), ("A", 3), (None, 4), ("A", 5)]


def test_restart_in_mid_stream(spark, tmp_path):
    rng = random.Random(6)
    at = 0
    for step in range(6):
        rows = []
        for _ in range(120):
            at += 1
            rows.append((rng.choice(["hot"] * 5 + ["a", "b", "c", f"new{at}"]), rng.choice("ABC"), at))
        rng.shuffle(rows)
        feed(spark, f"{tmp_path}/in", rows)
        if step in (1, 3):
            assert run(spark, tmp_path) == batch(spark, tmp_path)
    one, again = run(spark, tmp_path), run(spark, tmp_path)
    assert one == again == batch(spark, tmp_path) == run(spark, tmp_path, "fresh")
    assert max(r[3] for r in one if r[0] == "hot") > 100
