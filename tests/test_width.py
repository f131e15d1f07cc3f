"""What travels between tasks: rankings and comparisons carry no columns they don't use, and tasks grow in number, not in size."""

from __future__ import annotations

import re
from datetime import timedelta

from pyspark.sql import functions as F

from tests.test_queries import plan
from tidemark.functions.identity import packed, unpacked
from tidemark.operators import bloom, quality
from tidemark.plans import generated, load, models, relational


def widths(text, node):
    """Input columns of each such node of a formatted plan."""
    return [int(n) for n in re.findall(rf"^\(\d+\) {node}[^\n]*\nInput \[(\d+)\]", text, re.M)]


def test_states_are_ranked_without_their_contents(spark, sf):
    for product in ("lmp", "load"):
        raw = generated.tables(spark, sf, product)
        text = plan(models.fact(raw, product))
        assert min(widths(text, "Window")) <= 9 and "SortAggregate" not in text
        fact, whole = models.fact(raw, product), models.current(models.history(raw, product))
        assert fact.count() > 0 and fact.exceptAll(whole).isEmpty() and whole.exceptAll(fact).isEmpty()


def test_observations_are_kept_without_what_follows_from_them(spark, sf):
    raw = generated.tables(spark, sf)
    contents = raw["lmp_contents"]
    assert contents.count() == contents.select("content_id").distinct().count() == raw["lmp_state_transitions"].select("content_id").distinct().count()
    read = re.search(r"Scan parquet[^\n]*\nOutput \[(\d+)\]", plan(contents))
    assert int(read[1]) <= 9


def test_reconciled_rows_travel_as_a_key_and_a_digest(spark, sf):
    raw = generated.tables(spark, sf)
    states, fact = models.history(raw, "lmp"), generated.fact_of(raw, "lmp")
    text = plan(quality.reconcile(raw, "lmp", states, fact))
    dealt = [int(n) for n in re.findall(r"^\(\d+\) Exchange\nInput \[(\d+)\][^\n]*\nArguments: hashpartitioning\(transition_id", text, re.M)]
    assert dealt and max(dealt) == 2
    some = states.agg(F.min("transition_id")).first()[0]
    moved = F.when(F.col("transition_id") == some, F.col("state_known_at") + F.lit(timedelta(microseconds=1))).otherwise(F.col("state_known_at"))
    before = {tuple(r) for r in quality.reconcile(raw, "lmp", states, fact).collect()}
    after = {tuple(r) for r in quality.reconcile(raw, "lmp", states.withColumn("state_known_at", moved), fact).collect()}
    assert after - before == {("history", some)} and not before - after


def test_contents_of_no_fact_meet_no_rule(spark, sf):
    raw = generated.tables(spark, sf)
    assert "LeftSemi" in plan(quality.valid_facts(raw, "lmp", generated.fact_of(raw, "lmp")))


def test_slices_are_counted_by_tasks_that_follow_the_size(spark, sf):
    rows = spark.read.parquet(f"{sf}/lineitem.parquet")
    text = plan(relational.verify_slices(spark, sf))
    assert f"hashpartitioning(l_orderkey#{re.search(r'hashpartitioning.l_orderkey#(\d+)', text)[1]}L, {8 * rows.rdd.getNumPartitions()})" in text
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        splits = spark.read.parquet(f"{sf}/lineitem.parquet").rdd.getNumPartitions()
        assert splits > rows.rdd.getNumPartitions() and f", {8 * splits})" in plan(relational.verify_slices(spark, sf))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_any_text_comes_back_from_its_bytes(spark):
    texts = ["", "0", "00", "ab", "abc", "AB", "aB", "61", "a", "00ab", "01ab", "xyz", "Ж?", "a" * 64, "a" * 64 + "?", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("p", packed(F.col("t"))).withColumn("back", unpacked(F.col("p")))
    got = rows.collect()
    assert all(r.t == r.back for r in got) and len({bytes(r.p) for r in got if r.p is not None}) == len(texts) - 1
    assert {len(r.p) for r in got if r.t == "a" * 64} == {33}


def test_ids_that_are_no_hex_give_the_same_states(spark, sf):
    raw = dict(generated.tables(spark, sf, "load"))
    for name, columns in (("load_contents", ("content_id", "logical_key")), ("load_state_transitions", ("transition_id", "content_id", "logical_key"))):
        raw[name] = raw[name].withColumns({c: F.concat(F.lit("no hex "), F.col(c)) for c in columns})
    states = models.history(raw, "load")
    found, whole = models.fact(raw, "load", generated._ranked), models.current(states)
    assert found.count() > 0 and found.exceptAll(whole).isEmpty() and whole.exceptAll(found).isEmpty()
    whole = states.select("transition_id", "logical_key", "content_id").withColumn("n", F.length("transition_id"))
    assert whole.where("n <> 71 OR logical_key NOT LIKE 'no hex %' OR content_id NOT LIKE 'no hex %'").isEmpty()
    wrong = quality.reconcile(raw, "load", fact=found.where("hour(interval_start_utc) > 0")).where("contract = 'current'")
    assert wrong.count() > 0 and wrong.where("offending_id NOT LIKE 'no hex %'").isEmpty()


def test_states_stay_where_they_lie_while_their_runs_are_looked_up(spark, sf, monkeypatch):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        raw = generated.tables(spark, sf, "load")
        few = models.stg_transitions(raw, "load")
        assert "BroadcastHashJoin" in plan(few) and "SortMergeJoin" not in plan(few)
        monkeypatch.setattr(generated, "MOST_RUNS", 0)
        many = models.stg_transitions(generated.tables(spark, sf, "load"), "load")
        assert "SortMergeJoin" in plan(many) and few.count() > 0 and few.exceptAll(many).isEmpty() and many.exceptAll(few).isEmpty()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_ids_are_dealt_out_as_bytes(spark, sf):
    raw = generated.tables(spark, sf, "load")
    for frame in (models.history(raw, "load"), models.latest(raw, "load"), quality.reconcile(raw, "load", fact=generated.fact_of(raw, "load"))):
        assert "unhex" in plan(frame)


def test_whole_contents_are_dealt_out_behind_a_filter(spark, sf, monkeypatch):
    raw = generated.tables(spark, sf, "load")
    filtered = models.fact(raw, "load", generated._ranked)
    assert "__bits" in plan(filtered)
    monkeypatch.setattr(bloom.cut, "__defaults__", (0,))
    whole = models.fact(raw, "load", generated._ranked)
    assert "__bits" not in plan(whole) and filtered.exceptAll(whole).isEmpty() and whole.exceptAll(filtered).isEmpty()


def test_contents_far_from_a_fact_are_left_where_they_lie(spark, sf):
    raw = generated.tables(spark, sf, "load")
    fact = generated.fact_of(raw, "load")
    wrong = fact.withColumn("load", F.when(F.hour("interval_start_utc") % 2 == 0, -F.col("load") - 1).otherwise(F.col("load")).cast("decimal(38,9)"))
    few = generated.near(raw, "load", wrong)
    assert fact.count() <= few["load_contents"].count() < raw["load_contents"].count()
    cut, whole = quality.valid_facts(few, "load", wrong), quality.valid_facts(raw, "load", wrong)
    assert 0 < cut.count() < fact.count() and cut.exceptAll(whole).isEmpty() and whole.exceptAll(cut).isEmpty()
    assert "__bits" in plan(load.spoiled(spark, sf, "load"))
