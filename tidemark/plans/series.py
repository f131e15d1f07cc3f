"""Queries of ordered series without a task that holds a series: scans, as-of reads, digests of buckets, medians, sweeps.

Their keys are few and have very many rows each (event types), which is what windows by key are bad at.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import asof, hashtree, select, sweep
from tidemark.operators.scan import Blocks
from tidemark.plans import generated, models
from tidemark.schemas import HUBS
from tidemark.session import ensure_checkpoint_dir
from tidemark.streaming import changes

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return register


def _events(spark: SparkSession, sf_dir: str, *columns: str | Column) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(*columns)


_MOVE = "CASE WHEN user_id % 2 = 0 THEN 1 ELSE -1 END * CAST(CAST(value AS DECIMAL(18,4)) * 10000 AS BIGINT)"


def _move() -> Column:
    return F.when(F.col("user_id") % 2 == 0, 1).otherwise(-1) * (F.col("value").cast("decimal(18,4)") * 10_000).cast("bigint")


@query(f"SELECT event_type, event_id, CAST(sum({_MOVE}) OVER (PARTITION BY event_type ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total FROM events")
def scan_running_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A running sum of a series in every task at once."""
    moves = _events(spark, sf_dir, "event_type", "event_id", _move().alias("move"))
    return Blocks(moves, ["event_type"], ["event_id"]).running_sum(F.col("move")).select("event_type", "event_id", "total")


@query("""SELECT event_type, event_id, state, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS ordinal FROM (
  SELECT event_type, event_id, floor(value / 20) AS state, lag(floor(value / 20)) OVER (PARTITION BY event_type ORDER BY event_id) AS before FROM events) WHERE before IS DISTINCT FROM state""")
def scan_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of a state, numbered; a state that comes back is a change again."""
    states = _events(spark, sf_dir, "event_type", "event_id", F.floor(F.col("value") / 20).cast("double").alias("state"))
    return Blocks(states, ["event_type"], ["event_id"]).transitions("state")


@query("""SELECT event_type, count(*) AS n, count(*) FILTER (gap > 1800) AS gaps, CAST(max(gap) AS BIGINT) AS longest FROM (
  SELECT event_type, CAST(floor(epoch(ts)) AS BIGINT) - CAST(floor(epoch(lag(ts) OVER (PARTITION BY event_type ORDER BY ts, event_id))) AS BIGINT) AS gap FROM events) GROUP BY 1""")
def scan_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gaps between neighbours of a series."""
    seconds = F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.date_trunc("second", F.col("ts")).cast("timestamp_ntz"))
    rows = Blocks(_events(spark, sf_dir, "event_type", "event_id", "ts", seconds.alias("s")), ["event_type"], ["ts", "event_id"]).previous("s")
    gap = F.col("s") - F.col("before_s")
    return rows.groupBy("event_type").agg(F.count("*").alias("n"), F.count_if(gap > 1800).alias("gaps"), F.max(gap).alias("longest"))


@query(f"""WITH RECURSIVE m AS (SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS k, {_MOVE} AS move FROM events),
walk AS (SELECT DISTINCT event_type, CAST(0 AS BIGINT) AS k, CAST(0 AS BIGINT) AS event_id, CAST(1000000 AS BIGINT) AS state FROM m
  UNION ALL SELECT m.event_type, m.k, m.event_id, least(2000000, greatest(0, w.state + m.move)) FROM walk w JOIN m ON m.event_type = w.event_type AND m.k = w.k + 1)
SELECT event_type, event_id, state FROM walk WHERE k > 0""")
def clamped_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A store that is filled and emptied and can do neither beyond its bounds."""
    moves = _events(spark, sf_dir, "event_type", "event_id", _move().alias("move"))
    return Blocks(moves, ["event_type"], ["event_id"]).clamped("move", 0, 2_000_000, 1_000_000).select("event_type", "event_id", "state")


@query("""SELECT CAST(user_id AS VARCHAR) AS logical_key, event_type AS content_hash, event_id AS at, CAST(sum(1) OVER (PARTITION BY user_id ORDER BY event_id) AS BIGINT) AS ordinal FROM (
  SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS before FROM events) WHERE before IS DISTINCT FROM event_type""")
def stream_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of each user's latest event type, by a stream with a state for each user."""
    # A stream's path is a folder or a pattern; this pattern is the table, be it a file or a folder.
    events = spark.readStream.schema(spark.read.parquet(f"{sf_dir}/events.parquet").schema).parquet(f"{sf_dir}/events.parque[t]")
    rows = events.select(F.col("user_id").cast("string").alias("logical_key"), F.col("event_type").alias("content_hash"), F.col("event_id").alias("at"))
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/changes-{uuid.uuid4().hex}"
    stream = changes.write(rows, f"{folder}/out", f"{folder}/state")
    stream.awaitTermination()
    return spark.read.parquet(f"{folder}/out")


#: Minutes after the first known revisions' day at which decisions are taken.
_DECIDED = (30, 60, 150, 299, 100_000)


@query(generated._MARKET + f""", asked AS (SELECT d.market_date, m FROM (SELECT DISTINCT market_date FROM eligible) d, (VALUES {", ".join(f"({m})" for m in _DECIDED)}) AS v(m)),
seen AS (SELECT a.market_date, a.m, e.key, e.v, e.r, row_number() OVER (PARTITION BY a.market_date, a.m, e.key ORDER BY e.r DESC) AS k FROM asked a JOIN eligible e ON e.market_date = a.market_date AND 60 * e.r <= a.m)
SELECT market_date, CAST(m AS INTEGER) AS minutes, count(*) AS n, CAST(sum(r) AS BIGINT) AS revisions, CAST(sum(v) AS DOUBLE) AS total FROM seen WHERE k = 1 GROUP BY 1, 2""")
def market_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of several decisions about a market date knew: no correction that came later counts."""
    states = models.history(generated.tables(spark, sf_dir), "lmp")
    minutes = F.explode(F.array(*map(F.lit, _DECIDED))).alias("minutes")
    asked = states.select("market_date").distinct().select("market_date", minutes)
    asked = asked.withColumn("decided_at", F.lit(generated._ZERO).cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("minutes")))
    known = asof.as_of(states, asked, "market_date", "logical_key", "state_known_at", "decided_at", ["state_ordinal"])
    return known.groupBy("market_date", "minutes").agg(F.count("*").alias("n"), F.sum("state_ordinal").alias("revisions"), F.sum("lmp").cast("double").alias("total"))


@query(generated._MARKET + """SELECT key AS logical_key, CASE WHEN hub_no = 2 AND hour(h) = 3 THEN 'missing' ELSE 'changed' END AS kind FROM fact
WHERE day(market_date) % 5 = 0 AND ((hub_no = 2 AND hour(h) = 3) OR hour(h) % 5 = 0)""")
def market_hash_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts that a copy lacks or holds otherwise, found by digests of months, days and hubs."""
    fact = models.fact(generated.tables(spark, sf_dir), "lmp").select("logical_key", "market_date", "location", "interval_start_utc", "content_id", "state_ordinal", "commit_sequence").checkpoint()
    hour, some = F.hour("interval_start_utc"), F.dayofmonth("market_date") % 5 == 0
    copy = fact.where(~(some & (F.col("location") == HUBS[2]) & (hour == 3)))
    copy = copy.withColumn("commit_sequence", F.when(some & (hour % 5 == 0), F.col("commit_sequence") + 1).otherwise(F.col("commit_sequence")))
    levels = {"month": F.trunc("market_date", "month"), "day": F.col("market_date"), "hub": F.col("location")}
    return hashtree.differences(fact, copy, levels, "logical_key", ["content_id", "state_ordinal", "commit_sequence"])


@query("""SELECT median(l_extendedprice) AS middle, median(l_quantity) AS ties, median(CASE WHEN l_returnflag <> 'N' THEN l_discount END) AS some, median(CASE WHEN l_quantity < 0 THEN 1.0 END) AS none FROM lineitem""")
def medians_by_counting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact medians of many values, of few values many times, of a column with nulls, and of none."""
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_extendedprice", "l_quantity", F.when(F.col("l_returnflag") != "N", F.col("l_discount")).alias("d"), F.when(F.col("l_quantity") < 0, 1.0).alias("e"))
    found = [select.median(rows, F.col(c)) for c in rows.columns]
    return spark.range(1).select(*[F.lit(v).cast("double").alias(n) for n, v in zip(("middle", "ties", "some", "none"), found, strict=True)])


@query("""WITH iv AS (SELECT event_type, ts AS s, ts + to_seconds(CAST(floor(value * 20) AS BIGINT)) AS e FROM events),
b AS (SELECT event_type, date_trunc('day', min(s)) AS f, date_trunc('day', max(s)) + INTERVAL 1 DAY AS t FROM iv GROUP BY 1),
c AS (SELECT event_type, greatest(s, f) AS s, least(e, t) AS e FROM iv JOIN b USING (event_type) WHERE greatest(s, f) < least(e, t)),
p AS (SELECT event_type, x, sum(d) AS d FROM (SELECT event_type, s AS x, 1 AS d FROM c UNION ALL SELECT event_type, e, -1 FROM c UNION ALL SELECT event_type, f, 0 FROM b UNION ALL SELECT event_type, t, 0 FROM b) GROUP BY 1, 2),
q AS (SELECT event_type, x, sum(d) OVER w AS depth, lead(x) OVER w AS nx FROM p WINDOW w AS (PARTITION BY event_type ORDER BY x)),
r AS (SELECT *, CASE WHEN depth = 0 THEN 'gap' WHEN depth > 1 THEN 'overlap' ELSE 'covered' END AS kind FROM q WHERE nx IS NOT NULL),
g AS (SELECT *, CASE WHEN kind IS DISTINCT FROM lag(kind) OVER (PARTITION BY event_type ORDER BY x) THEN 1 ELSE 0 END AS turn FROM r),
h AS (SELECT *, sum(turn) OVER (PARTITION BY event_type ORDER BY x) AS no FROM g)
SELECT event_type, kind, min(x) AS start, max(nx) AS "end" FROM h WHERE kind <> 'covered' GROUP BY event_type, kind, no""")
def coverage_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stretches of time that no event of a type lasts through, or several do."""
    events = _events(spark, sf_dir, "event_type", F.col("ts").alias("start"), (F.col("ts") + F.make_dt_interval(secs=F.floor(F.col("value") * 20).cast("decimal(18,6)"))).alias("end"))
    bounds = events.groupBy("event_type").agg(F.date_trunc("day", F.min("start")).cast("timestamp_ntz").alias("start"), (F.date_trunc("day", F.max("start")) + F.expr("interval 1 day")).cast("timestamp_ntz").alias("end"))
    return sweep.coverage(events, bounds, ["event_type"], "start", "end")
