"""Data tests: a test is a plan that returns what offends, so an empty result passes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions import timez
from tidemark.functions.identity import CONTENT_SCHEMA, KEY_SCHEMA, packed, unpacked
from tidemark.plans.models import FACTS, STATE_ORDER, battery_inputs, history
from tidemark.schemas import BATTERY_INPUTS, HUBS, MEASURES, PRODUCTS, SOURCE

Tables = Mapping[str, DataFrame]


def differs(a: Column, b: Column) -> Column:
    """IS DISTINCT FROM."""
    return ~a.eqNullSafe(b)


def not_null(frame: DataFrame, column: str) -> DataFrame:
    return frame.where(F.col(column).isNull())


def accepted_values(frame: DataFrame, column: str, values: list) -> DataFrame:
    return frame.where(~F.col(column).isin(*values))


def unique_grain(frame: DataFrame, columns: list[str]) -> DataFrame:
    """Keys that occur more than once."""
    return frame.groupBy(*columns).agg(F.count("*").alias("n")).where("n > 1")


def unique(frame: DataFrame, column: str) -> DataFrame:
    return unique_grain(frame.where(F.col(column).isNotNull()), [column])


def relationships(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Keys of children without a parent."""
    keys = parent.select(F.col(key).alias("__key")).distinct()
    return child.where(F.col(column).isNotNull()).join(keys, F.col(column) == F.col("__key"), "left_anti").select(column)


def reconcile(tables: Tables, product: str, states: DataFrame | None = None, fact: DataFrame | None = None) -> DataFrame:
    """(contract, offending_id): transitions that history misses, invents or changes, and keys whose fact
    isn't the latest state, ranked here from the raw rows alone."""
    runs = tables["ingestion_runs"].where("status = 'SUCCEEDED'").select("run_id")
    states = states if states is not None else history(tables, product)
    fact = fact if fact is not None else tables[FACTS[product]]
    raw = ("transition_id", "logical_key", "content_id", "content_hash", "ordinal", "commit_sequence", "known_at")
    own = ("transition_id", "logical_key", "content_id", "content_hash", "state_ordinal", "commit_sequence", "state_known_at")

    def told(names: tuple[str, ...]) -> Column:
        # A digest of the compared values travels in their place: as text, which holds microseconds too, without the null ones.
        return F.unhex(F.sha2(F.to_json(F.struct(*[F.col(n).cast("string").alias(str(k)) for k, n in enumerate(names)])), 256)).alias("__told")

    def offending(expected: DataFrame, actual: DataFrame, key: str, contract: str) -> DataFrame:
        e, a = expected.select(packed(F.col(key)).alias(key), "__told").alias("e"), actual.select(packed(F.col(key)).alias(key), told(own)).alias("a")
        both = e.join(a, F.col(f"e.{key}") == F.col(f"a.{key}"), "full")
        wrong = F.col(f"e.{key}").isNull() | F.col(f"a.{key}").isNull() | differs(F.col("e.__told"), F.col("a.__told"))
        return both.where(wrong).select(F.lit(contract).alias("contract"), unpacked(F.coalesce(F.col(f"e.{key}"), F.col(f"a.{key}"))).alias("offending_id"))

    eligible = tables[f"{product}_state_transitions"].select("run_id", "transition_id", "logical_key", "ordinal", "commit_sequence", told(raw)).join(runs, "run_id")
    order = W.partitionBy("logical_key").orderBy(F.desc("ordinal"), *[F.desc(c) for c in STATE_ORDER[1:]])
    expected = eligible.withColumn("__r", F.row_number().over(order)).where("__r = 1")
    return offending(eligible, states, "transition_id", "history").unionByName(offending(expected, fact, "logical_key", "current"))


def valid_facts(tables: Tables, product: str, fact: DataFrame | None = None) -> DataFrame:
    """Keys of facts that break a rule of lineage, time, clock or domain."""
    own = PRODUCTS[product]
    fact = (fact if fact is not None else tables[FACTS[product]]).alias("f")
    runs = tables["ingestion_runs"].select("run_id", "status", "knowledge_at")
    # Contents of no fact are left behind before whole rows of contents are dealt out.
    contents = tables[f"{product}_contents"].join(fact.select("content_id"), "content_id", "left_semi")
    joined = (
        fact.join(runs.alias("r"), F.col("f.state_run_id") == F.col("r.run_id"), "left")
        .join(runs.alias("cr"), F.col("f.first_run_id") == F.col("cr.run_id"), "left")
        .join(contents.alias("c"), F.col("f.content_id") == F.col("c.content_id"), "left")
    )
    f, c = (lambda n: F.col(f"f.{n}")), (lambda n: F.col(f"c.{n}"))
    start, end = f("interval_start_utc"), f("interval_end_utc")
    place = ("market", "location") if product == "lmp" else ("area",)
    rules = [F.col(f"{r}.status").isNull() | (F.col(f"{r}.status") != "SUCCEEDED") for r in ("r", "cr")]
    rules += [c("content_id").isNull(), f("source") != SOURCE, f("logical_key_schema") != KEY_SCHEMA, f("content_hash_schema") != CONTENT_SCHEMA]
    rules += [differs(f(n), c(n)) for n in ("logical_key", "content_hash", "source", "product", "source_dataset", "market_date", "interval_start_utc", "interval_end_utc", "unit", *place)]
    seconds = F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), start)
    rules += [start.isNull(), end.isNull(), F.timestamp_diff("SECOND", start, end) != own["seconds"], seconds % own["seconds"] != 0, f("market_date") != timez.pacific_date(start)]
    rules += [f("state_known_at").isNull(), f("first_seen_at").isNull(), differs(f("state_known_at"), F.col("r.knowledge_at")), differs(f("first_seen_at"), F.col("cr.knowledge_at")), f("first_seen_at") > f("state_known_at")]
    rules += [x for m in MEASURES[product] for x in (f(m).isNull(), f(m) != c(m))]
    rules.append(f("unit") != own["unit"])
    rules += [f("market") != own["market"], ~f("location").isin(*HUBS)] if product == "lmp" else [f("area") != own["area"], f("load") < 0]
    broken = rules[0]
    for rule in rules[1:]:
        broken = broken | rule
    return joined.where(broken).select(f("logical_key").alias("logical_key"))


def valid_daily_summary(summary: DataFrame) -> DataFrame:
    n, hours, low = F.col("observation_count"), F.col("expected_hour_count"), F.col("negative_price_interval_count")
    average = F.col("average_lmp_usd_per_mwh")
    broken = (n < 1) | (n > hours) | ~hours.isin(23, 24, 25) | (low < 0) | (low > n) | (average < F.col("minimum_lmp_usd_per_mwh")) | (average > F.col("maximum_lmp_usd_per_mwh"))
    return summary.where(broken).select("market_date", "location")


def reconcile_battery_inputs(fact: DataFrame, mart: DataFrame) -> DataFrame:
    """Whole rows compared in both directions, then constants, nulls, times and grain."""
    expected, start = battery_inputs(fact), F.col("interval_start_utc")
    wrong = F.lit(False)
    for name in BATTERY_INPUTS:
        wrong = wrong | F.col(name).isNull()
    own = PRODUCTS["lmp"]
    wrong = wrong | (F.col("source") != SOURCE) | (F.col("market") != own["market"]) | (F.col("unit") != own["unit"]) | (F.col("logical_key_schema") != KEY_SCHEMA) | (F.col("content_hash_schema") != CONTENT_SCHEMA)
    wrong = wrong | (F.timestamp_diff("SECOND", start, F.col("interval_end_utc")) != 3600) | (start != F.date_trunc("hour", start).cast("timestamp_ntz")) | (F.col("market_date") != timez.pacific_date(start))
    found = [("missing_or_changed", expected.subtract(mart)), ("extra_or_changed", mart.subtract(expected)), ("invalid", mart.where(wrong)), ("duplicate_grain", unique_grain(mart, ["location", "interval_start_utc"]))]
    out = None
    for name, frame in found:
        tagged = frame.select(F.lit(name).alias("violation"))
        out = tagged if out is None else out.unionByName(tagged)
    return out


def verify_slices(fact: DataFrame, runs: DataFrame, place: str | None, first, last) -> DataFrame:
    """(market_date, hub, n, keys, ineligible) of each slice within dates, for the check after a build."""
    hub = F.col(place) if place else F.lit("")
    states = runs.select(F.col("run_id").alias("state_run_id"), "status")
    rows = fact.where(F.col("market_date").between(F.lit(first), F.lit(last))).join(states, "state_run_id", "left")
    return rows.groupBy("market_date", hub.alias("hub")).agg(F.count("*").alias("n"), F.count_distinct("logical_key").alias("keys"), F.count_if(differs(F.col("status"), F.lit("SUCCEEDED"))).alias("ineligible"))


def slices(fact: DataFrame, place: str | None) -> DataFrame:
    """(market_date, hub, n, keys, high, runs) of each slice of a fact, to be kept beside its files. A date is written
    whole, so slices of several builds never share rows; a slice has no more runs than its day has intervals."""
    hub = F.col(place) if place else F.lit("")
    return fact.groupBy("market_date", hub.alias("hub")).agg(F.count("*").alias("n"), F.count_distinct("logical_key").alias("keys"), F.max("commit_sequence").alias("high"), F.collect_set("state_run_id").alias("runs"))


def judged_slices(kept: DataFrame, runs: DataFrame) -> DataFrame:
    """(market_date, hub, n, keys, ineligible) of kept slices, the last being the number of runs without success."""
    states = runs.select(F.col("run_id").alias("__run"), "status")
    each = kept.select("market_date", "hub", "n", "keys", F.explode_outer("runs").alias("__run")).join(states, "__run", "left")
    return each.groupBy("market_date", "hub", "n", "keys").agg(F.count_if(differs(F.col("status"), F.lit("SUCCEEDED"))).alias("ineligible"))


def coverage(prices: DataFrame, days: DataFrame) -> DataFrame:
    """Hours of each (location, market_date) of ``days`` that ``prices`` lack, have twice or have beyond it."""
    first, last = timez.day_bounds(F.col("market_date"))
    step = F.expr("interval 1 hour")
    wanted = days.select("location", "market_date", F.explode(F.sequence(first, last - step, step)).alias("interval_start_utc"))
    have = prices.groupBy("location", "market_date", "interval_start_utc").agg(F.count("*").alias("n"))
    both = wanted.withColumn("wanted", F.lit(1)).join(have, ["location", "market_date", "interval_start_utc"], "full")
    return both.where(F.col("wanted").isNull() | differs(F.col("n"), F.lit(1)))
