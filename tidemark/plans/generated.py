"""The engine's own functions over raw tables that follow from the ``events`` table, at any scale.

An event is an observation of the price of its hour at one of the hubs, or of the load of one of three intervals of
its hour; later events of the same key are revisions. A run brings the r-th revisions of one market date (and hub), and
some runs fail or are never finalised.
So planning, facts, health and every data test meet repeats, late states and ineligible rows in numbers that grow
with the table. The SQL beside each query works from ``events`` alone.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions import timez
from tidemark.functions.identity import CONTENT_SCHEMA, KEY_SCHEMA, WAREHOUSE_SCHEMA
from tidemark.operators import bloom, normalize, quality, revision, upsert
from tidemark.plans import models
from tidemark.schemas import HUBS, NUMERIC, PRODUCTS, RAW, SOURCE, VERSION
from tidemark.session import ensure_checkpoint_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

_ZERO = datetime(2026, 9, 1)
MOST_RUNS = 1 << 20  # Fixed value: runs that are sent to all executors at most, about 100 MB; more are dealt out.
_PROVENANCE = {"retrieved_at_utc": _ZERO, "source_url": "events", "source_method": "generated", "library_version": "1"}


def query(sql: str) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__], ORACLES[f.__name__] = f, _MARKET + sql
        return f

    return register


def _location(hub_no: Column, product: str) -> Column:
    return F.element_at(F.array(*map(F.lit, HUBS)), (hub_no + 1).cast("int")) if product == "lmp" else F.lit(None).cast("string")


def numbered(spark: SparkSession, sf_dir: str, product: str = "lmp") -> DataFrame:
    """Events as priced hours of hubs, or loads of intervals, with their revision r, the first one of their value and the last one."""
    third, hour = F.col("event_id") % 3, F.date_trunc("hour", "ts").cast("timestamp_ntz")
    if product == "lmp":
        hub_no, start = third, hour
    else:
        hub_no, start = F.lit(0).cast("bigint"), hour + F.make_dt_interval(mins=(third * 5).cast("int"))
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "event_type", hub_no.alias("hub_no"), start.alias("interval_start_utc"), F.col("value").cast(NUMERIC).alias(product))
    key = W.partitionBy("hub_no", "interval_start_utc")
    rows = rows.withColumn("r", F.row_number().over(key.orderBy("event_id")).cast("bigint")).withColumn("last_r", F.max("r").over(key))
    return rows.withColumn("first_r", F.min("r").over(W.partitionBy("hub_no", "interval_start_utc", product)))


def brought(rows: DataFrame, product: str = "lmp") -> DataFrame:
    """The rows with what follows from hub, time and revision: place, date and the run that brings each."""
    rows = rows.withColumn("location", _location(F.col("hub_no"), product)).withColumn("market_date", timez.pacific_date(F.col("interval_start_utc")))
    state = (F.col("r") + F.dayofmonth("market_date") + F.col("hub_no")) % 7
    return rows.select(
        "*",
        F.md5(F.concat_ws("/", "r", "market_date", "location")).alias("run_id"),
        F.when(state == 5, "FAILED").when(state == 6, "COMMITTED").otherwise("SUCCEEDED").alias("status"),
        (F.col("r") * 10_000 + F.dayofyear("market_date") * 3 + F.col("hub_no")).alias("commit_sequence"),
    ).withColumn("known", F.when(F.col("status") == "SUCCEEDED", F.lit(_ZERO).cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("r").cast("int"))))


def observations(spark: SparkSession, sf_dir: str, product: str = "lmp") -> DataFrame:
    """Numbered events, and the run that brings each."""
    return brought(numbered(spark, sf_dir, product), product).drop("first_r", "last_r")


def identified(rows: DataFrame, product: str = "lmp") -> DataFrame:
    """Observations with the columns and identities of normalised ones."""
    return normalize.with_identity(product, _normalised(rows, product))


def _normalised(rows: DataFrame, product: str) -> DataFrame:
    own = PRODUCTS[product]
    fixed = {k: own[k] for k in ("product", "source_dataset", "unit", "market", "area") if k in own} | {"source": SOURCE, "source_url": "events", "source_method": "generated", "library_version": "1"}
    numbers = {"energy": 30, "congestion": -2, "loss": 0.5} if product == "lmp" else {}
    made = rows.withColumns({k: F.lit(v) for k, v in fixed.items()} | {k: F.lit(v).cast(NUMERIC) for k, v in numbers.items()})
    return made.withColumns({"interval_end_utc": F.col("interval_start_utc") + F.make_dt_interval(secs=F.lit(own["seconds"])), "retrieved_at_utc": F.lit(_ZERO).cast("timestamp_ntz")})


def kept(frame: DataFrame, name: str) -> DataFrame:
    """The frame, written once as Parquet to the shared checkpoint folder, so that plans read only the columns they
    need and know its size. The folder (``name-*``) is the caller's to delete, like a checkpoint."""
    folder = f"{ensure_checkpoint_dir(frame.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    frame.write.option("compression", "zstd").parquet(folder)
    return frame.sparkSession.read.parquet(folder)


def stored(spark: SparkSession, sf_dir: str, product: str) -> DataFrame:
    """Identified observations, their identities computed once. Only what can't be told from the rest is kept; constants and
    runs are columns of the plan that reads it."""
    rows = identified(brought(numbered(spark, sf_dir, product), product), product)
    narrow = kept(rows.select("hub_no", "interval_start_utc", product, "r", "first_r", "last_r", "logical_key", "content_hash", "content_id"), f"{product}-observations")
    whole = _normalised(brought(narrow, product), product)
    return whole.withColumns({"logical_key_schema": F.lit(KEY_SCHEMA), "content_hash_schema": F.lit(CONTENT_SCHEMA)})


def _shaped(frame: DataFrame, table: str, made: dict[str, Column]) -> DataFrame:
    return frame.select(*[made.get(f.name, F.col(f.name) if f.name in frame.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in RAW[table]])


def tables(spark: SparkSession, sf_dir: str, product: str = "lmp") -> dict[str, DataFrame]:
    """The raw tables: a transition for each observation, contents once with their first run, and all runs. Identities
    and runs are computed once and kept, as the tables are joined with each other many times."""
    rows = stored(spark, sf_dir, product)
    transitions = _shaped(rows, f"{product}_state_transitions", {"transition_id": F.sha2(F.concat_ws("/", "run_id", "logical_key"), 256), "ordinal": F.col("r"), "known_at": F.col("known")})
    contents = _shaped(rows.where("r = first_r"), f"{product}_contents", {"first_run_id": F.col("run_id"), "first_seen_at": F.col("known")})
    per_run = brought(rows.groupBy("hub_no", "r", "market_date").agg(F.count("*").alias("n"), F.min("interval_start_utc").alias("interval_start_utc")), product)
    runs = _shaped(
        per_run,
        "ingestion_runs",
        {
            "request_id": F.md5(F.concat_ws("/", "market_date", "location")), "source": F.lit(SOURCE), "product": F.lit(product), "requested_date": F.col("market_date"), "requested_location": F.col("location"),
            "started_at": F.lit(_ZERO), "commit_completed": F.col("status") != "FAILED", "package_version": F.lit(VERSION), "library_version": F.lit("1"), "warehouse_schema": F.lit(WAREHOUSE_SCHEMA),
            "logical_key_schema": F.lit(KEY_SCHEMA), "content_hash_schema": F.lit(CONTENT_SCHEMA), "knowledge_at": F.col("known"), "completed_at": F.col("known"), "rows_accepted": F.col("n"), "new_transitions": F.col("n"), "new_contents": F.lit(0),
        },
    )
    runs = kept(runs, "runs")
    # A run brings many rows: those stay where they lie, if there aren't too many runs.
    runs = F.broadcast(runs) if runs.count() <= MOST_RUNS else runs
    return {"ingestion_runs": runs, f"{product}_contents": contents, f"{product}_state_transitions": transitions}


# Eligible states are those whose run and whose content's first run succeeded.
_MARKET = """
WITH ev AS (SELECT event_id, event_type, event_id % 3 AS hub_no, (['TH_NP15_GEN-APND', 'TH_SP15_GEN-APND', 'TH_ZP26_GEN-APND'])[event_id % 3 + 1] AS location, date_trunc('hour', ts) AS h, CAST(value AS DECIMAL(38,9)) AS v FROM events),
numbered AS (SELECT *, CAST((h AT TIME ZONE 'UTC') AT TIME ZONE 'America/Los_Angeles' AS DATE) AS market_date, row_number() OVER (PARTITION BY hub_no, h ORDER BY event_id) AS r FROM ev),
judged AS (SELECT *, min(r) OVER (PARTITION BY hub_no, h, v) AS first_r, (r + day(market_date) + hub_no) % 7 AS s FROM numbered),
keyed AS (SELECT *, CASE s WHEN 5 THEN 'FAILED' WHEN 6 THEN 'COMMITTED' ELSE 'SUCCEEDED' END AS status, (first_r + day(market_date) + hub_no) % 7 < 5 AS seen, r * 10000 + dayofyear(market_date) * 3 + hub_no AS seq,
  strftime(h, '%Y-%m-%dT%H:%M:%S.%f') || 'Z' AS a, strftime(h + INTERVAL 1 HOUR, '%Y-%m-%dT%H:%M:%S.%f') || 'Z' AS z FROM judged),
obs AS (SELECT *, sha256('{"interval_end_utc":"' || z || '","interval_start_utc":"' || a || '","location":"' || location || '","market":"DAY_AHEAD_HOURLY","product":"day_ahead_hourly_lmp","schema":"observation-key/v1","source":"CAISO"}') AS key,
  sha256('{"congestion":"-2","energy":"30","interval_end_utc":"' || z || '","interval_start_utc":"' || a || '","lmp":"' || CASE WHEN v = 0 THEN '0' ELSE rtrim(rtrim(CAST(v AS VARCHAR), '0'), '.') END || '","location":"' || location
  || '","loss":"0.5","market":"DAY_AHEAD_HOURLY","product":"day_ahead_hourly_lmp","schema":"observation-content/v1","source":"CAISO","unit":"USD/MWh"}') AS hash FROM keyed),
eligible AS (SELECT * FROM obs WHERE status = 'SUCCEEDED' AND seen),
fact AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY hub_no, h ORDER BY r DESC) AS k FROM eligible) WHERE k = 1)
"""


@query("""SELECT location, h AS interval_start_utc,
CASE WHEN event_type = 'error' THEN 'location type' WHEN count(*) FILTER (event_type <> 'error') OVER (PARTITION BY hub_no, h) > 1 THEN 'duplicate' ELSE '' END AS violations, CASE WHEN event_type <> 'error' THEN key END AS logical_key,
CASE WHEN event_type <> 'error' THEN hash END AS content_hash,
CASE WHEN event_type <> 'error' THEN sha256('{"content_hash":"' || hash || '","content_hash_schema":"observation-content/v1","logical_key":"' || key || '","logical_key_schema":"observation-key/v1","schema":"warehouse-content/v1"}') END AS content_id
FROM obs""")
def market_identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as one source frame, judged and identified; what breaks a rule says so and has no identity, and a key
    that comes twice is a duplicate."""
    rows = observations(spark, sf_dir)
    start, own = F.col("interval_start_utc"), PRODUCTS["lmp"]
    given = {"Time": start, "Interval Start": start, "Interval End": start + F.expr("interval 1 hour"), "Market": F.lit(own["market"]), "Location": F.col("location")}
    given |= {"Location Type": F.when(F.col("event_type") == "error", "Node").otherwise(own["location_type"]), "LMP": F.col("lmp")}
    given |= {k: F.lit(v).cast(NUMERIC) for k, v in (("Energy", 30), ("Congestion", -2), ("Loss", 0.5))}
    judged = normalize.judged("lmp", rows.select(*[c.alias(n) for n, c in given.items()]), _PROVENANCE)
    return judged.select("location", "interval_start_utc", F.array_join("violations", ",").alias("violations"), "logical_key", "content_hash", "content_id")


_RUN = "5" * 32


_PLAN = f""", moved AS (SELECT *, max(r) OVER (PARTITION BY key) AS m, lag(v) OVER (PARTITION BY key ORDER BY r) AS before FROM obs)
SELECT key AS logical_key, h AS interval_start_utc, r AS ordinal, 8::BIGINT AS commit_sequence, first_r = r AS new_content,
sha256('{{"key":"' || key || '","run_id":"{_RUN}","schema":"state-transition/v1"}}') AS transition_id FROM moved WHERE r = m AND before IS DISTINCT FROM v"""


def planned(spark: SparkSession, sf_dir: str, product: str) -> DataFrame:
    """What the last observation of each key changes beside all earlier ones: a transition where it differs from the one
    before, and a content where no earlier one is like it (a value that returns has a transition only)."""
    rows = stored(spark, sf_dir, product)
    batch, before = rows.where("r = last_r"), rows.where("r < last_r")
    latest = before.where("r = last_r - 1").select("logical_key", "content_hash", F.col("r").alias("ordinal"))
    contents, transitions = revision.changes(product, _RUN, batch, before.select("content_id"), latest, 7)
    found = transitions.join(contents.select("content_id", F.lit(True).alias("new")), "content_id", "left")
    return found.select("logical_key", "interval_start_utc", "ordinal", "commit_sequence", F.coalesce("new", F.lit(False)).alias("new_content"), "transition_id")


@query(_PLAN)
def market_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the last observations of prices change."""
    return planned(spark, sf_dir, "lmp")


_FACT = """SELECT key AS logical_key, market_date, CAST(v AS DOUBLE) AS lmp, r AS state_ordinal, seq AS commit_sequence, strftime(TIMESTAMP '2026-09-01' + to_hours(first_r), '%Y-%m-%d %H:%M:%S') AS first_seen,
strftime(TIMESTAMP '2026-09-01' + to_hours(r), '%Y-%m-%d %H:%M:%S') AS known FROM fact"""


def _fact_columns(fact: DataFrame) -> DataFrame:
    def text(name: str) -> Column:
        return F.date_format(name, "yyyy-MM-dd HH:mm:ss")

    return fact.select("logical_key", "market_date", F.col("lmp").cast("double").alias("lmp"), "state_ordinal", "commit_sequence", text("first_seen_at").alias("first_seen"), text("state_known_at").alias("known"))


@query(_FACT)
def market_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current states by a full refresh."""
    return _fact_columns(models.fact(tables(spark, sf_dir), "lmp", _ranked))


@query(_FACT)
def market_fact_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from a fact that knows first and second revisions only, by candidates above its mark."""
    return _fact_columns(incremental(tables(spark, sf_dir), "lmp", 2))


def incremental(raw: dict[str, DataFrame], product: str, most: int) -> DataFrame:
    """A kept fact of the first ``most`` revisions, merged with what is above its mark."""
    name = f"{product}_state_transitions"
    fact = kept(models.latest(raw | {name: raw[name].where(F.col("ordinal") <= most)}, product, _ranked), f"{product}-fact")
    return upsert.merged(fact, kept(upsert.candidates_of(raw, product, fact, _ranked), f"{product}-candidates"))


def _ranked(rows: DataFrame) -> DataFrame:
    return kept(rows, "ranked")


def near(raw: dict[str, DataFrame], product: str, fact: DataFrame) -> dict[str, DataFrame]:
    """The raw tables, from which most contents that no row of a kept fact names are left out, so that few are dealt out."""
    name = f"{product}_contents"
    return raw | {name: bloom.cut(raw[name], "content_id", fact.where("content_id IS NOT NULL"))}


def fact_of(raw: dict[str, DataFrame], product: str) -> DataFrame:
    """The full refresh, kept as a fact is, so that what reads it several times works it out once."""
    return kept(models.fact(raw, product, _ranked), f"{product}-fact")


@query("""SELECT location AS requested_location, market_date AS requested_date, count(DISTINCT r) AS run_count, count(DISTINCT r) FILTER (status = 'SUCCEEDED') AS succeeded_run_count,
count(DISTINCT r) FILTER (status = 'FAILED') AS failed_run_count, count(DISTINCT r) FILTER (status = 'COMMITTED') AS unfinalized_run_count,
strftime(TIMESTAMP '2026-09-01' + to_hours(max(r) FILTER (status = 'SUCCEEDED')), '%Y-%m-%d %H:%M:%S') AS latest, count(*) FILTER (status = 'SUCCEEDED') AS successful_rows_accepted FROM obs GROUP BY 1, 2""")
def market_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of each date and hub by outcome."""
    health = models.ingestion_health(tables(spark, sf_dir))
    return health.select("requested_location", "requested_date", "run_count", "succeeded_run_count", "failed_run_count", "unfinalized_run_count", F.date_format("latest_successful_knowledge_at", "yyyy-MM-dd HH:mm:ss").alias("latest"), "successful_rows_accepted")


@query(""", latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY r DESC) AS k FROM obs WHERE status = 'SUCCEEDED') WHERE k = 1)
SELECT 'history' AS contract, count(*) AS offenders FROM obs WHERE status = 'SUCCEEDED' AND NOT seen
UNION ALL SELECT 'current', count(*) FROM latest l LEFT JOIN (SELECT * FROM fact WHERE NOT (hub_no = 2 AND hour(h) = 3)) f ON f.key = l.key WHERE f.key IS NULL OR f.r <> l.r OR hour(f.h) % 5 = 0""")
def market_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offenders in history, where contents of unfinished runs are left out, and in a fact with wrong and missing rows."""
    raw = tables(spark, sf_dir)
    hour = F.hour("interval_start_utc")
    fact = fact_of(raw, "lmp").where(~((F.col("location") == HUBS[2]) & (hour == 3)))
    fact = fact.withColumn("commit_sequence", F.when(hour % 5 == 0, F.col("commit_sequence") + 1).otherwise(F.col("commit_sequence")))
    kinds = spark.range(2).select(F.when(F.col("id") == 0, "history").otherwise("current").alias("contract"))
    found = quality.reconcile(raw, "lmp", fact=fact).groupBy("contract").agg(F.count("*").alias("offenders"))
    return kinds.join(found, "contract", "left").select("contract", F.coalesce("offenders", F.lit(0)).alias("offenders"))


@query("SELECT key AS logical_key FROM fact WHERE hour(h) % 5 = 0 OR day(market_date) = 9")
def market_valid_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of facts that break a rule: another unit, or a clock that isn't their run's."""
    raw = tables(spark, sf_dir)
    fact = fact_of(raw, "lmp")
    fact = fact.withColumn("unit", F.when(F.hour("interval_start_utc") % 5 == 0, "kWh").otherwise(F.col("unit")))
    fact = fact.withColumn("state_known_at", F.when(F.dayofmonth("market_date") == 9, F.col("state_known_at") + F.expr("interval 1 minute")).otherwise(F.col("state_known_at")))
    return quality.valid_facts(near(raw, "lmp", fact), "lmp", fact)


@query("""SELECT market_date, location FROM fact GROUP BY 1, 2, hub_no HAVING hub_no = 2 OR day(market_date) % 4 = 0""")
def market_summary_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days of a summary with more hours than a day has, or an average beyond the extremes."""
    days = models.daily_summary(models.fact(tables(spark, sf_dir), "lmp", _ranked))
    days = days.withColumn("observation_count", F.when(F.col("location") == HUBS[2], F.col("observation_count") + 30).otherwise(F.col("observation_count")))
    days = days.withColumn("average_lmp_usd_per_mwh", F.when(F.dayofmonth("market_date") % 4 == 0, F.col("maximum_lmp_usd_per_mwh") + 1).otherwise(F.col("average_lmp_usd_per_mwh")))
    return quality.valid_daily_summary(days)


@query("""SELECT * FROM (SELECT 'missing_or_changed' AS violation, count(*) AS n FROM fact WHERE hour(h) % 6 = 0 OR hour(h) % 9 = 1 OR (hub_no = 1 AND hour(h) = 4)
UNION ALL SELECT 'extra_or_changed', count(*) FROM fact WHERE (hour(h) % 6 = 0 OR hour(h) % 9 = 1) AND NOT (hub_no = 1 AND hour(h) = 4)
UNION ALL SELECT 'invalid', count(*) FROM fact WHERE hour(h) % 9 = 1 UNION ALL SELECT 'duplicate_grain', count(*) FROM fact WHERE hub_no = 0 AND hour(h) = 7) WHERE n > 0""")
def market_inputs_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mart with changed prices, another unit, a missing hour and repeated rows, beside its fact."""
    fact = fact_of(tables(spark, sf_dir), "lmp")
    hour = F.hour("interval_start_utc")
    mart = models.battery_inputs(fact).where(~((F.col("location") == HUBS[1]) & (hour == 4)))
    mart = mart.withColumn("lmp", F.when(hour % 6 == 0, (F.col("lmp") + 1).cast(NUMERIC)).otherwise(F.col("lmp"))).withColumn("unit", F.when(hour % 9 == 1, "kWh").otherwise(F.col("unit")))
    mart = mart.unionByName(mart.where((F.col("location") == HUBS[0]) & (hour == 7)))
    return quality.reconcile_battery_inputs(fact, mart).groupBy("violation").agg(F.count("*").alias("n"))


@query("SELECT market_date, location AS hub, count(*) AS n, count(DISTINCT key) AS keys, count(*) FILTER (hour(h) = 5) AS ineligible FROM fact WHERE market_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-25' GROUP BY 1, 2")
def market_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, keys and rows without an eligible run in each slice that a build is checked by."""
    raw = tables(spark, sf_dir)
    fact = models.fact(raw, "lmp", _ranked).withColumn("state_run_id", F.when(F.hour("interval_start_utc") == 5, "unknown").otherwise(F.col("state_run_id")))
    return quality.verify_slices(fact, raw["ingestion_runs"], "location", date(2024, 1, 5), date(2024, 1, 25))


@query(""", days AS (SELECT DISTINCT location, market_date FROM fact), wanted AS (
SELECT location, market_date, x AS h FROM days, unnest(generate_series((CAST(market_date AS TIMESTAMP) AT TIME ZONE 'America/Los_Angeles') AT TIME ZONE 'UTC', ((CAST(market_date + 1 AS TIMESTAMP) AT TIME ZONE 'America/Los_Angeles') AT TIME ZONE 'UTC') - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS t(x))
SELECT location, market_date, h AS interval_start_utc, CASE WHEN hour(h) = 9 AND EXISTS (SELECT 1 FROM fact f WHERE f.location = w.location AND f.h = w.h) THEN 2 ELSE 0 END::BIGINT AS n
FROM wanted w WHERE hour(h) = 9 OR NOT EXISTS (SELECT 1 FROM fact f WHERE f.location = w.location AND f.h = w.h)""")
def market_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours that days lack, or have twice."""
    fact = fact_of(tables(spark, sf_dir), "lmp").select("location", "market_date", "interval_start_utc")
    twice = fact.unionByName(fact.where(F.hour("interval_start_utc") == 9))
    gaps = quality.coverage(twice, fact.select("location", "market_date").distinct())
    return gaps.select("location", "market_date", "interval_start_utc", F.coalesce("n", F.lit(0)).alias("n"))
