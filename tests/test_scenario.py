"""The revision story: counts, current values, quality tests that find corruption, and stored facts."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark.errors import SchemaError
from tidemark.operators import quality, upsert
from tidemark.plans import models, scenario

WANT = {"initial": (1, 1, [10]), "repeat": (1, 1, [10]), "revision": (2, 2, [20]), "reappearance": (2, 3, [10]), "late": (3, 4, [10, 10])}


@pytest.fixture(scope="module")
def story(spark):
    return {step: {n: f.cache() for n, f in scenario.build(spark, step).items()} for step in scenario.STEPS}


@pytest.mark.parametrize("step", scenario.STEPS)
@pytest.mark.parametrize("product", ["lmp", "load"])
def test_steps(story, step, product):
    tables = story[step]
    contents, states, values = WANT[step]
    assert models.stg_contents(tables, product).count() == contents
    assert models.history(tables, product).count() == states
    fact = models.fact(tables, product)
    assert sorted(int(r[product if product == "lmp" else "load"]) for r in fact.collect()) == values
    assert quality.reconcile(tables, product, fact=fact).count() == 0 == quality.valid_facts(tables, product, fact).count()


def test_reappearance_keeps_its_clock(story):
    row = models.fact(story["reappearance"], "lmp").first()
    assert (row.state_ordinal, str(row.first_seen_at), str(row.state_known_at)) == (3, "2026-09-01 00:01:00", "2026-09-01 00:31:00")


def test_clocks_choose_nothing(story):
    tables = dict(story["reappearance"])
    states = tables["lmp_state_transitions"]
    tables["lmp_state_transitions"] = states.withColumn("known_at", F.when(F.col("ordinal") == 1, F.lit("2030-01-01").cast("timestamp_ntz")).otherwise(F.col("known_at")))
    assert models.fact(tables, "lmp").first().state_ordinal == 3


def test_missing_contents_give_no_fact(story, spark):
    tables = dict(story["late"])
    tables["lmp_contents"] = tables["lmp_contents"].limit(0)
    assert models.fact(tables, "lmp").count() == 0


@pytest.mark.parametrize("product", ["lmp", "load"])
def test_corruption_is_found(story, product):
    tables = story["late"]
    fact = models.fact(tables, product)
    for bad in (fact.withColumn("transition_id", F.lit("x")), fact.withColumn("state_known_at", F.lit("2030-01-01").cast("timestamp_ntz"))):
        assert {r.contract for r in quality.reconcile(tables, product, fact=bad).collect()} == {"current"}
    gone = dict(tables)
    value = product if product == "lmp" else "load"
    gone[f"{product}_contents"] = tables[f"{product}_contents"].where(F.col(value) != 20)
    assert {r.contract for r in quality.reconcile(gone, product, states=models.history(gone, product), fact=fact).collect()} == {"history"}
    assert quality.valid_facts(tables, product, fact.withColumn("unit", F.lit("kW"))).count() == fact.count()


def test_incremental_equals_full_refresh(story):
    for before, after in zip(scenario.STEPS, scenario.STEPS[1:]):
        for product in ("lmp", "load"):
            stored = models.fact(story[before], product)
            new = upsert.candidates(models.history(story[after], product), stored)
            made, full = upsert.merged(stored, new), models.fact(story[after], product)
            assert made.select(*full.columns).exceptAll(full).count() == 0 == full.exceptAll(made.select(*full.columns)).count()


def test_marts(story):
    built = models.build(story["late"])
    summary = built["mart_daily_lmp_summary"]
    assert {(str(r.market_date), r.observation_count, r.expected_hour_count) for r in summary.collect()} == {("2026-08-01", 1, 24), ("2025-08-01", 1, 24)}
    health = {(r.product, str(r.requested_date)): r for r in built["mart_ingestion_health"].collect()}
    row = health["lmp", "2026-08-01"]
    assert (row.run_count, row.succeeded_run_count, row.failed_run_count, row.started_run_count, row.unfinalized_run_count) == (7, 4, 1, 1, 1)
    assert (row.successful_rows_accepted, row.successful_new_contents, row.successful_new_transitions) == (4, 2, 3)
    assert quality.valid_daily_summary(summary).count() == 0
    mart = built["mart_battery_optimization_inputs"]
    assert quality.reconcile_battery_inputs(built["fct_hourly_lmp"], mart).count() == 0
    bad = quality.reconcile_battery_inputs(built["fct_hourly_lmp"], mart.withColumn("unit", F.lit("x")).unionByName(mart.limit(1)))
    assert {r.violation for r in bad.collect()} == {"missing_or_changed", "extra_or_changed", "invalid", "duplicate_grain"}


def test_clock_change_days(spark):
    rows = [("CAISO", "DAY_AHEAD_HOURLY", scenario.HUB, d, v) for d, v in (("2026-03-08", -5), ("2026-11-01", 10))]
    fact = spark.createDataFrame(rows, "source string, market string, location string, market_date string, lmp int").selectExpr("source", "market", "location", "cast(market_date as date) market_date", "cast(lmp as decimal(38,9)) lmp")
    got = {str(r.market_date): (r.expected_hour_count, r.negative_price_interval_count) for r in models.daily_summary(fact).collect()}
    assert got == {"2026-03-08": (23, 1), "2026-11-01": (25, 0)}


def test_as_of(story):
    from datetime import datetime

    at = models.as_of(story["late"], "lmp", datetime(2026, 9, 1, 0, 25)).collect()
    assert [int(r.lmp) for r in at] == [20]


def test_contract_drift(story):
    from tidemark.schemas import assert_contract, fact_columns

    with pytest.raises(SchemaError):
        assert_contract(models.fact(story["late"], "lmp").withColumn("lmp", F.lit("1")), fact_columns("lmp"), "fct")


def test_generic_tests(spark):
    frame = spark.createDataFrame([(1, "a"), (1, "b"), (2, None)], "k int, v string")
    assert quality.not_null(frame, "v").count() == 1 and quality.unique(frame, "k").count() == 1
    assert quality.accepted_values(frame, "v", ["a"]).count() == 1 and quality.unique_grain(frame, ["k", "v"]).count() == 0
    assert quality.relationships(frame, "k", spark.createDataFrame([(1,)], "id int"), "id").count() == 1


def test_models_as_views(spark, story):
    models.register_views(models.build(story["late"]))
    row = spark.sql("SELECT count(*) AS n, count(DISTINCT logical_key) AS k FROM fct_hourly_lmp JOIN stg_ingestion_runs ON state_run_id = run_id WHERE status = 'SUCCEEDED'").first()
    assert (row.n, row.k) == (2, 2)
