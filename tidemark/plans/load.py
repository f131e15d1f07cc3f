"""The load twin of the generated market, and every rule of both products' facts broken once.

An event is the load of the first, second or third five minutes of its hour, so a key has revisions at every scale.
The engine's functions are those of prices; only the product differs.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import normalize, quality
from tidemark.plans import generated, models
from tidemark.plans.generated import Query, observations, tables
from tidemark.schemas import MEASURES, NUMERIC

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

_LOAD = """
WITH ev AS (SELECT event_id, event_type, 0 AS hub_no, date_trunc('hour', ts) + to_minutes(5 * (event_id % 3)) AS h, CAST(value AS DECIMAL(38,9)) AS v FROM events),
numbered AS (SELECT *, CAST((h AT TIME ZONE 'UTC') AT TIME ZONE 'America/Los_Angeles' AS DATE) AS market_date, row_number() OVER (PARTITION BY h ORDER BY event_id) AS r FROM ev),
judged AS (SELECT *, min(r) OVER (PARTITION BY h, v) AS first_r, (r + day(market_date)) % 7 AS s FROM numbered),
keyed AS (SELECT *, CASE s WHEN 5 THEN 'FAILED' WHEN 6 THEN 'COMMITTED' ELSE 'SUCCEEDED' END AS status, (first_r + day(market_date)) % 7 < 5 AS seen, r * 10000 + dayofyear(market_date) * 3 AS seq,
  strftime(h, '%Y-%m-%dT%H:%M:%S.%f') || 'Z' AS a, strftime(h + INTERVAL 5 MINUTE, '%Y-%m-%dT%H:%M:%S.%f') || 'Z' AS z FROM judged),
obs AS (SELECT *, sha256('{"area":"CAISO","interval_end_utc":"' || z || '","interval_start_utc":"' || a || '","product":"system_load_5min","schema":"observation-key/v1","source":"CAISO"}') AS key,
  sha256('{"area":"CAISO","interval_end_utc":"' || z || '","interval_start_utc":"' || a || '","load":"' || CASE WHEN v = 0 THEN '0' ELSE rtrim(rtrim(CAST(v AS VARCHAR), '0'), '.') END
  || '","product":"system_load_5min","schema":"observation-content/v1","source":"CAISO","unit":"MW"}') AS hash FROM keyed),
eligible AS (SELECT * FROM obs WHERE status = 'SUCCEEDED' AND seen),
fact AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY h ORDER BY r DESC) AS k FROM eligible) WHERE k = 1)
"""


def query(sql: str, given: str = _LOAD):
    def register(f: Query) -> Query:
        QUERIES[f.__name__], ORACLES[f.__name__] = f, given + sql
        return f

    return register


@query(""", told AS (SELECT *, CASE event_type WHEN 'error' THEN 'label' WHEN 'view' THEN 'duration' WHEN 'click' THEN 'negative load' WHEN 'signup' THEN 'alignment' ELSE '' END AS wrong FROM obs)
SELECT event_id, CASE WHEN wrong <> '' THEN wrong WHEN count(*) FILTER (wrong = '') OVER (PARTITION BY h) > 1 THEN 'duplicate' ELSE '' END AS violations,
CASE WHEN wrong = '' THEN key END AS logical_key, CASE WHEN wrong = '' THEN hash END AS content_hash FROM told""")
def load_identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as one frame of loads, judged and identified; each kind of event but purchases breaks a rule of its own."""
    rows, kind = observations(spark, sf_dir, "load"), F.col("event_type")
    start = F.col("interval_start_utc") + F.make_dt_interval(mins=F.when(kind == "signup", 1).otherwise(0))
    end = start + F.make_dt_interval(mins=F.when(kind == "view", 6).otherwise(5))
    label = start + F.make_dt_interval(mins=F.when(kind == "error", 5).otherwise(0))
    load = F.when(kind == "click", -F.col("load") - 1).otherwise(F.col("load")).cast(NUMERIC)
    given = {"Time": label, "Interval Start": start, "Interval End": end, "Load": load, "event_id": F.col("event_id")}
    judged = normalize.judged("load", rows.select(*[c.alias(n) for n, c in given.items()]), generated._PROVENANCE, keep=("event_id",))
    return judged.select("event_id", F.array_join("violations", ",").alias("violations"), "logical_key", "content_hash")


@query(generated._PLAN)
def load_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the last observations of load change."""
    return generated.planned(spark, sf_dir, "load")


_FACT = generated._FACT.replace("AS lmp", "AS load")


def _fact_columns(fact: DataFrame) -> DataFrame:
    return generated._fact_columns(fact.withColumnRenamed("load", "lmp")).withColumnRenamed("lmp", "load")


@query(_FACT)
def load_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current loads by a full refresh."""
    return _fact_columns(models.fact(tables(spark, sf_dir, "load"), "load", generated._ranked))


@query(_FACT)
def load_fact_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from a fact that knows first revisions only."""
    return _fact_columns(generated.incremental(tables(spark, sf_dir, "load"), "load", 1))


@query(""", latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY r DESC) AS k FROM obs WHERE status = 'SUCCEEDED') WHERE k = 1)
SELECT 'history' AS contract, count(*) AS offenders FROM obs WHERE status = 'SUCCEEDED' AND NOT seen
UNION ALL SELECT 'current', count(*) FROM latest l LEFT JOIN (SELECT * FROM fact WHERE minute(h) <> 10 OR hour(h) % 3 <> 0) f ON f.key = l.key WHERE f.key IS NULL OR f.r <> l.r OR hour(f.h) % 5 = 0""")
def load_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offenders in the history of load, and in a fact with wrong and missing rows."""
    raw = tables(spark, sf_dir, "load")
    hour, minute = F.hour("interval_start_utc"), F.minute("interval_start_utc")
    fact = generated.fact_of(raw, "load").where((minute != 10) | (hour % 3 != 0))
    fact = fact.withColumn("commit_sequence", F.when(hour % 5 == 0, F.col("commit_sequence") + 1).otherwise(F.col("commit_sequence")))
    kinds = spark.range(2).select(F.when(F.col("id") == 0, "history").otherwise("current").alias("contract"))
    found = quality.reconcile(raw, "load", fact=fact).groupBy("contract").agg(F.count("*").alias("offenders"))
    return kinds.join(found, "contract", "left").select("contract", F.coalesce("offenders", F.lit(0)).alias("offenders"))


@query("SELECT market_date, '' AS hub, count(*) AS n, count(DISTINCT key) AS keys, count(*) FILTER (hour(h) = 5) AS ineligible FROM fact WHERE market_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-25' GROUP BY 1")
def load_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, keys and rows without an eligible run in each day of load that a build is checked by."""
    raw = tables(spark, sf_dir, "load")
    fact = models.fact(raw, "load", generated._ranked).withColumn("state_run_id", F.when(F.hour("interval_start_utc") == 5, "unknown").otherwise(F.col("state_run_id")))
    return quality.verify_slices(fact, raw["ingestion_runs"], None, date(2024, 1, 5), date(2024, 1, 25))


# Every rule once ---------------------------------------------------------------------------------


def _spoils(product: str, raw: dict[str, DataFrame]) -> list[tuple[str, dict[str, Column]]]:
    """Ways to break a rule: a name, and the columns that are changed for it."""
    minute, start, end = F.expr("interval 1 minute"), F.col("interval_start_utc"), F.col("interval_end_utc")
    text = ["source", "product", "source_dataset", "unit", "logical_key_schema", "content_hash_schema", "logical_key", "content_hash", "content_id", "state_run_id", "first_run_id", *(("market", "location") if product == "lmp" else ("area",))]
    failed = raw["ingestion_runs"].where("status = 'FAILED'").agg(F.min("run_id")).scalar()
    far = F.lit(datetime(2030, 1, 1)).cast("timestamp_ntz")
    out = [("none", {}), *[(f"other {n}", {n: F.concat(F.col(n), F.lit("?"))}) for n in text]]
    out += [("failed state run", {"state_run_id": failed}), ("failed first run", {"first_run_id": failed})]
    out += [("date", {"market_date": F.date_add("market_date", 1)}), ("alignment", {"interval_start_utc": start + minute, "interval_end_utc": end + minute}), ("duration", {"interval_end_utc": end + minute})]
    out += [(f"no {n}", {n: F.lit(None)}) for n in ("interval_start_utc", "interval_end_utc", "state_known_at", "first_seen_at", *MEASURES[product])]
    out += [("state clock", {"state_known_at": F.col("state_known_at") + minute}), ("first clock", {"first_seen_at": F.col("first_seen_at") - minute}), ("seen after known", {"first_seen_at": far})]
    out += [(f"changed {n}", {n: (F.col(n) + 1).cast(NUMERIC)}) for n in MEASURES[product]]
    return [*out, ("negative load", {"load": -F.col("load") - 1})] if product == "load" else out


def spoiled(spark: SparkSession, sf_dir: str, product: str) -> DataFrame:
    """Facts dealt out over the ways to break a rule: how many there are of each, and how many the data test finds."""
    raw = tables(spark, sf_dir, product)
    ways = _spoils(product, raw)
    way = (F.dayofyear("market_date") * 7 + F.hour("interval_start_utc")) % len(ways)
    fact = generated.fact_of(raw, product).withColumn("way", way)
    kinds = dict(fact.dtypes)
    changed: dict[str, Column] = {}
    for k, (_, columns) in enumerate(ways):
        for name, value in columns.items():
            changed[name] = F.when(F.col("way") == k, value.cast(kinds[name])).otherwise(changed.get(name, F.col(name)))
    bad = fact.withColumns(changed)
    found = quality.valid_facts(generated.near(raw, product, bad), product, bad.drop("way")).select("logical_key", F.lit(1).alias("found"))
    names = F.array(*[F.lit(n) for n, _ in ways])
    rule = F.element_at(names, F.col("way") + 1)
    return bad.join(found, "logical_key", "left").groupBy(rule.alias("rule")).agg(F.count("*").alias("facts"), F.count("found").alias("offenders"))


def _spoiled_sql(names: list[str]) -> str:
    listed = ", ".join(f"'{n}'" for n in names)
    return f"SELECT ([{listed}])[way + 1] AS rule, count(*) AS facts, count(*) FILTER (way > 0) AS offenders FROM (SELECT (dayofyear(market_date) * 7 + hour(h)) % {len(names)} AS way FROM fact) GROUP BY 1"


# The names of the ways above in their order, for the SQL.
_TEXT_WAYS = "source product source_dataset unit logical_key_schema content_hash_schema logical_key content_hash content_id state_run_id first_run_id".split()
_OTHER_WAYS = ["failed state run", "failed first run", "date", "alignment", "duration", "no interval_start_utc", "no interval_end_utc", "no state_known_at", "no first_seen_at"]
_CLOCK_WAYS = ["state clock", "first clock", "seen after known"]


def _ways(place: list[str], measures: tuple[str, ...], last: list[str]) -> list[str]:
    return ["none", *[f"other {n}" for n in [*_TEXT_WAYS, *place]], *_OTHER_WAYS, *[f"no {n}" for n in measures], *_CLOCK_WAYS, *[f"changed {n}" for n in measures], *last]


@query(_spoiled_sql(_ways(["area"], MEASURES["load"], ["negative load"])))
def load_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each rule of facts of load, broken on its own."""
    return spoiled(spark, sf_dir, "load")


@query(_spoiled_sql(_ways(["market", "location"], MEASURES["lmp"], [])), generated._MARKET)
def market_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each rule of facts of prices, broken on its own."""
    return spoiled(spark, sf_dir, "lmp")
