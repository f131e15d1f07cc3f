"""Relational operators on the driver's tables.

Roles: ``orders`` play ingestion runs ('F' is SUCCEEDED), ``lineitem`` transitions and contents,
``events`` an observation log. Every query is a plan over whole tables; scans read only the columns they
name, and sides of joins are broadcast only where Spark finds them small.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions import timez

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _money(name: str) -> Column:
    return F.col(name).cast("decimal(18,4)")


def _when(condition: Column) -> Column:
    """The number of rows for which the condition is true."""
    return F.sum(F.when(condition, 1).otherwise(0)).cast("bigint")


def latest(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key. The rank is limited to one before rows are shuffled."""
    ranked = rows.withColumn("state_rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return ranked.where("state_rank = 1").drop("state_rank")


# Joins ------------------------------------------------------------------------------------------


@query("""SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_extendedprice FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey WHERE o.o_orderstatus = 'F'""")
def eligibility_inner_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contents whose run succeeded."""
    runs = _table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select("o_orderkey")
    rows = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return rows.join(runs, rows.l_orderkey == runs.o_orderkey).drop("o_orderkey")


@query("""SELECT l.l_orderkey AS state_run_id, l.l_linenumber AS state_ordinal, p.p_name AS content_name, l.l_quantity AS state_value
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey WHERE o.o_orderstatus = 'F'""")
def history_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eligible transitions joined to their contents and renamed; one without content is dropped."""
    rows = _table(spark, sf_dir, "lineitem").join(_table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select("o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    parts = _table(spark, sf_dir, "part").select("p_partkey", "p_name")
    joined = rows.join(parts, rows.l_partkey == parts.p_partkey)
    return joined.select(F.col("l_orderkey").alias("state_run_id"), F.col("l_linenumber").alias("state_ordinal"), F.col("p_name").alias("content_name"), F.col("l_quantity").alias("state_value"))


#: Tasks for each split that the scan reads (at most ``spark.sql.files.maxPartitionBytes``).
_TASKS_A_SPLIT = 8


@query("""SELECT year(l.l_shipdate) AS ship_year, l.l_returnflag, count(*) AS n, count(DISTINCT l.l_orderkey) AS n_keys,
count(*) FILTER (o.o_orderstatus IS DISTINCT FROM 'F') AS ineligible
FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1, 2""")
def verify_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, distinct keys and rows without an eligible run of each slice. Rows and runs are dealt out by key over as many
    tasks as the rows' size asks for, so a task's memory doesn't follow the table; a key's slices are then counted where
    it lies, and only sums of tasks travel on."""
    rows = _table(spark, sf_dir, "lineitem").select("l_orderkey", F.year("l_shipdate").cast("bigint").alias("ship_year"), "l_returnflag")
    runs = _table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    tasks = _TASKS_A_SPLIT * rows.rdd.getNumPartitions()
    dealt, eligible = rows.repartition(tasks, "l_orderkey"), runs.repartition(tasks, "o_orderkey")
    joined = dealt.join(eligible, dealt.l_orderkey == eligible.o_orderkey, "left")
    lost = F.count_if(~F.col("o_orderstatus").eqNullSafe(F.lit("F")))
    keys = joined.groupBy("l_orderkey", "ship_year", "l_returnflag").agg(F.count("*").alias("n"), lost.alias("ineligible"))
    return keys.groupBy("ship_year", "l_returnflag").agg(F.sum("n").alias("n"), F.count("l_orderkey").alias("n_keys"), F.sum("ineligible").alias("ineligible"))


@query("""SELECT (SELECT count(*) FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey WHERE o.o_orderstatus = 'F') AS contents,
(SELECT count(*) FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN orders o ON l.l_orderkey = o.o_orderkey
 WHERE o.o_orderstatus = 'F' AND p.p_size <= 25) AS transitions""")
def inspect_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two counts over different joins, as one row."""
    rows = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    runs = _table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    parts = _table(spark, sf_dir, "part").where("p_size <= 25").select(F.col("p_partkey").alias("l_partkey"))
    eligible = rows.join(runs, "l_orderkey")
    one, two = eligible.agg(F.count("*").alias("contents")), eligible.join(parts, "l_partkey").agg(F.count("*").alias("transitions"))
    return spark.range(1).select(one.scalar().alias("contents"), two.scalar().alias("transitions"))


@query("""WITH changed AS (SELECT event_id, CASE WHEN event_id % 100 = 0 THEN NULL WHEN event_id % 101 = 0 THEN value + 1 ELSE value END AS value
 FROM events WHERE event_id % 103 <> 0)
SELECT coalesce(e.event_id, c.event_id) AS offending_id, e.event_id IS NULL AS only_right, c.event_id IS NULL AS only_left
FROM events e FULL OUTER JOIN changed c ON e.event_id = c.event_id
WHERE e.event_id IS NULL OR c.event_id IS NULL OR e.value IS DISTINCT FROM c.value""")
def null_safe_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that two versions of a table don't share, nulls compared as values."""
    left = _table(spark, sf_dir, "events").select(F.col("event_id").alias("a_id"), F.col("value").alias("a"))
    value = F.when(F.col("a_id") % 100 == 0, None).when(F.col("a_id") % 101 == 0, F.col("a") + 1).otherwise(F.col("a"))
    right = left.where("a_id % 103 <> 0").select(F.col("a_id").alias("b_id"), value.alias("b"))
    both = left.join(right, F.col("a_id") == F.col("b_id"), "full")
    differ = F.col("a_id").isNull() | F.col("b_id").isNull() | ~F.col("a").eqNullSafe(F.col("b"))
    return both.where(differ).select(F.coalesce("a_id", "b_id").alias("offending_id"), F.col("a_id").isNull().alias("only_right"), F.col("b_id").isNull().alias("only_left"))


@query("""SELECT o.o_orderkey FROM orders o WHERE NOT EXISTS
(SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey AND c.c_mktsegment <> 'BUILDING')""")
def relationship_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Child rows whose key is missing among the parents."""
    parents = _table(spark, sf_dir, "customer").where("c_mktsegment <> 'BUILDING'").select("c_custkey")
    rows = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return rows.join(parents, rows.o_custkey == parents.c_custkey, "left_anti").select("o_orderkey")


@query("""SELECT c.c_custkey FROM customer c WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'P')""")
def exists_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows for which a partner exists, each once."""
    runs = _table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select("o_custkey")
    keys = _table(spark, sf_dir, "customer").select("c_custkey")
    return keys.join(runs, keys.c_custkey == runs.o_custkey, "left_semi")


@query("""WITH old AS (SELECT * FROM events WHERE event_id % 3 = 0), batch AS (SELECT * FROM events WHERE event_id % 2 = 0)
SELECT event_id, user_id, 'old' AS origin FROM old UNION ALL
SELECT event_id, user_id, 'new' AS origin FROM batch WHERE event_id NOT IN (SELECT event_id FROM old)""")
def insert_only_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored rows and those of a batch whose key isn't stored yet."""
    rows = _table(spark, sf_dir, "events").select("event_id", "user_id")
    old, batch = rows.where("event_id % 3 = 0"), rows.where("event_id % 2 = 0")
    new = batch.join(old.select("event_id"), "event_id", "left_anti")
    return old.withColumn("origin", F.lit("old")).unionByName(new.withColumn("origin", F.lit("new")))


# Windows and current state ----------------------------------------------------------------------


@query("""SELECT user_id, event_type, event_id, ts, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS r FROM events
) WHERE r = 1""")
def current_state_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest event of each (user, type); ties on time go to the larger id."""
    events = _table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "ts", "value")
    return latest(events, ["user_id", "event_type"], [F.desc("ts"), F.desc("event_id")])


@query("""WITH day AS (SELECT CAST(min(ts) AS DATE) + 7 AS d FROM events), ranked AS (
  SELECT user_id, event_type, event_id, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS r
  FROM events, day WHERE CAST(ts AS DATE) = d)
SELECT user_id, count(*) AS n_states, string_agg(event_type || ':' || event_id, ',' ORDER BY event_type) AS states
FROM ranked WHERE r = 1 GROUP BY user_id""")
def latest_snapshot_as_struct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of one day, each user's latest state of every type as an ordered array of structs, then as text."""
    events = _table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "ts")
    first = events.agg(F.date_add(F.min("ts").cast("date"), 7)).scalar()
    day = events.where(F.col("ts").cast("date") == first)
    now = latest(day, ["user_id", "event_type"], [F.desc("event_id")])
    states = now.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("event_type", "event_id"))).alias("latest"))
    text = F.array_join(F.transform("latest", lambda s: F.concat_ws(":", s["event_type"], s["event_id"].cast("string"))), ",")
    return states.select("user_id", F.size("latest").cast("bigint").alias("n_states"), text.alias("states"))


@query("""SELECT event_id, user_id, event_type FROM events
WHERE event_id > (SELECT coalesce(max(event_id), 0) FROM events WHERE event_id <= (SELECT CAST(floor(max(event_id) * 0.9) AS BIGINT) FROM events))""")
def incremental_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows above the stored high-water mark; the mark is a scalar subquery that reaches the scan."""
    events = _table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    stored = events.where(F.col("event_id") <= events.agg(F.floor(F.max("event_id") * 0.9)).scalar())
    mark = stored.agg(F.coalesce(F.max("event_id"), F.lit(0))).scalar()
    return events.where(F.col("event_id") > mark)


@query("""SELECT user_id, event_type, event_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS r FROM events) WHERE r = 1""")
def upsert_equals_full_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State built from the first nine tenths of the log, then brought up to date by the rest."""
    events = _table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "value")
    mark = events.agg(F.floor(F.max("event_id") * 0.9)).scalar()
    keys, order = ["user_id", "event_type"], [F.desc("event_id")]
    stored = latest(events.where(F.col("event_id") <= mark), keys, order)
    new = latest(events.where(F.col("event_id") > mark), keys, order)
    return stored.join(new, keys, "left_anti").unionByName(new)


@query("""SELECT user_id, event_id, event_type, CAST(sum(1) OVER (PARTITION BY user_id ORDER BY event_id) AS BIGINT) AS ordinal FROM (
  SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS before FROM events) WHERE before IS DISTINCT FROM event_type""")
def change_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State changes of each key in order of arrival, numbered; a repeated state changes nothing."""
    events = _table(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    by_user = W.partitionBy("user_id").orderBy("event_id")
    changed = events.withColumn("before", F.lag("event_type").over(by_user)).where(~F.col("before").eqNullSafe(F.col("event_type")))
    return changed.select("user_id", "event_id", "event_type", F.row_number().over(by_user).cast("bigint").alias("ordinal"))


@query("""SELECT user_id, count(*) AS n, count(*) FILTER (gap > 3600) AS gaps, CAST(max(gap) AS BIGINT) AS longest FROM (
  SELECT user_id, CAST(floor(epoch(ts)) AS BIGINT) - CAST(floor(epoch(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id))) AS BIGINT) AS gap FROM events)
GROUP BY user_id""")
def contiguity_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gaps of over an hour between neighbouring events of a user."""
    events = _table(spark, sf_dir, "events").select("user_id", "event_id", "ts")
    seconds = F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.date_trunc("second", F.col("ts")).cast("timestamp_ntz"))
    by_user = W.partitionBy("user_id").orderBy("ts", "event_id")
    gap = F.col("s") - F.lag("s").over(by_user)
    gaps = events.withColumn("s", seconds).withColumn("gap", gap)
    return gaps.groupBy("user_id").agg(F.count("*").alias("n"), F.count_if(F.col("gap") > 3600).alias("gaps"), F.max("gap").alias("longest"))


@query("""SELECT user_id, event_id, CAST(2 + sum(d) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS soc FROM (
  SELECT user_id, event_id, CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(18,4)) ELSE -CAST(value AS DECIMAL(18,4)) END AS d FROM events)""")
def soc_running_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A running state from its increments, exact in decimals."""
    step = F.when(F.col("event_type") == "purchase", _money("value")).otherwise(-_money("value"))
    frame = W.partitionBy("user_id").orderBy("event_id").rowsBetween(W.unboundedPreceding, 0)
    events = _table(spark, sf_dir, "events").select("user_id", "event_id", step.alias("d"))
    return events.select("user_id", "event_id", (F.lit(2) + F.sum("d").over(frame)).cast("double").alias("soc"))


# Aggregates -------------------------------------------------------------------------------------


@query("""SELECT event_type, CAST(ts AS DATE) AS market_date, count(*) AS observation_count,
CAST((2 * CAST(sum(CAST(value AS DECIMAL(18,4))) * 10000 AS HUGEINT) * 10000 + count(*)) // (2 * count(*)) AS DOUBLE) / 1e8 AS average_value, CAST(min(value) AS DOUBLE) AS minimum_value, CAST(max(value) AS DOUBLE) AS maximum_value,
CAST(sum(CASE WHEN value < 10 THEN 1 ELSE 0 END) AS BIGINT) AS low_value_count FROM events GROUP BY 1, 2""")
def daily_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count, mean, extremes and a conditional count of each series and day."""
    events = _table(spark, sf_dir, "events").select("event_type", F.col("ts").cast("date").alias("market_date"), "value")
    return events.groupBy("event_type", "market_date").agg(
        F.count("*").alias("observation_count"),
        F.avg(_money("value")).cast("double").alias("average_value"),
        F.min("value").alias("minimum_value"),
        F.max("value").alias("maximum_value"),
        _when(F.col("value") < 10).alias("low_value_count"),
    )


@query("""SELECT CAST(o_orderdate AS DATE) AS market_date, count(*) AS n, CAST(date_diff('hour',
 (CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AT TIME ZONE 'America/Los_Angeles') AT TIME ZONE 'UTC',
 (CAST(CAST(o_orderdate AS DATE) + 1 AS TIMESTAMP) AT TIME ZONE 'America/Los_Angeles') AT TIME ZONE 'UTC') AS BIGINT) AS expected_hour_count
FROM orders GROUP BY 1, CAST(o_orderdate AS DATE)""")
def daily_summary_expected_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours of each Pacific day: 23 and 25 where clocks change."""
    days = _table(spark, sf_dir, "orders").groupBy(F.col("o_orderdate").cast("date").alias("market_date")).agg(F.count("*").alias("n"))
    return days.withColumn("expected_hour_count", timez.expected_hours(F.col("market_date")))


@query("""SELECT CAST((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/Los_Angeles' AS DATE) AS market_date, count(*) AS n, min(event_id) AS first_event
FROM events GROUP BY 1""")
def pacific_market_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of each Pacific date."""
    events = _table(spark, sf_dir, "events").select("event_id", timez.pacific_date(F.col("ts")).alias("market_date"))
    return events.groupBy("market_date").agg(F.count("*").alias("n"), F.min("event_id").alias("first_event"))


@query("""SELECT c_mktsegment, CASE WHEN o_orderpriority LIKE '1%' THEN NULL ELSE o_orderpriority END AS requested_location, count(*) AS run_count,
CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS succeeded_run_count,
CAST(sum(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) AS BIGINT) AS started_run_count,
max(CASE WHEN o_orderstatus = 'F' THEN o_orderdate END) AS latest_successful,
CAST(sum(CASE WHEN o_orderstatus = 'F' THEN o_custkey ELSE 0 END) AS BIGINT) AS successful_rows
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2""")
def ingestion_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs by outcome, failures and unfinished ones included; the null location is one group."""
    runs = _table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus", "o_orderdate", F.when(~F.col("o_orderpriority").startswith("1"), F.col("o_orderpriority")).alias("requested_location"))
    customers = _table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    good = F.col("o_orderstatus") == "F"
    return (
        runs.join(customers, runs.o_custkey == customers.c_custkey)
        .groupBy("c_mktsegment", "requested_location")
        .agg(
            F.count("*").alias("run_count"),
            _when(good).alias("succeeded_run_count"),
            _when(F.col("o_orderstatus") == "P").alias("started_run_count"),
            F.max(F.when(good, F.col("o_orderdate"))).alias("latest_successful"),
            F.sum(F.when(good, F.col("o_custkey")).otherwise(0)).alias("successful_rows"),
        )
    )


@query("""WITH d AS (SELECT CAST(ts AS DATE) AS day, CAST(sum(CAST(value AS DECIMAL(18,4))) AS DECIMAL(38,4)) AS v FROM events GROUP BY 1)
SELECT CAST(sum(v) AS DOUBLE) AS total, CAST(median(CAST(v AS DOUBLE)) AS DOUBLE) AS median_daily, (SELECT day FROM d ORDER BY v DESC, day LIMIT 1) AS best_day,
(SELECT day FROM d ORDER BY v, day LIMIT 1) AS worst_day, count(*) AS days FROM d""")
def aggregate_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sum, median, best and worst day; ties go to the earliest."""
    days = _table(spark, sf_dir, "events").groupBy(F.col("ts").cast("date").alias("day")).agg(F.sum(_money("value")).alias("v"))
    return days.agg(
        F.sum("v").cast("double").alias("total"),
        F.median(F.col("v").cast("double")).alias("median_daily"),
        F.min(F.struct((-F.col("v")).alias("v"), F.col("day")))["day"].alias("best_day"),
        F.min(F.struct("v", "day"))["day"].alias("worst_day"),
        F.count("*").alias("days"),
    )


@query("""SELECT CAST(ts AS DATE) AS day, sha256('{' || string_agg('"' || lpad(CAST(event_id AS VARCHAR), 12, '0') || '":"' || event_type || '"', ',' ORDER BY event_id)
|| ',"schema":"batch-content/v1"}') AS batch_hash FROM events GROUP BY 1""")
def batch_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A digest of each day's keys and values that no order of arrival changes."""
    key = F.lpad(F.col("event_id").cast("string"), 12, "0")
    days = _table(spark, sf_dir, "events").groupBy(F.col("ts").cast("date").alias("day")).agg(F.array_sort(F.collect_list(F.struct(key.alias("k"), F.col("event_type").alias("v")))).alias("pairs"))
    with_schema = F.concat("pairs", F.array(F.struct(F.lit("schema").alias("k"), F.lit("batch-content/v1").alias("v"))))
    return days.select("day", F.sha2(F.to_json(F.map_from_entries(with_schema)), 256).alias("batch_hash"))


@query("SELECT sha256(coalesce(text, '')) AS content_hash, count(*) AS n, min(doc_id) AS first_doc FROM documents GROUP BY 1")
def content_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct contents by digest: 64 characters of each text are shuffled."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("content_hash"))
    return docs.groupBy("content_hash").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_doc"))


@query("SELECT coalesce(max(event_id), 0) AS high_water, count(*) AS n, count(DISTINCT user_id) AS users FROM events WHERE event_id < 0 OR user_id % 2 = 0")
def high_water_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A global maximum with a default, beside an exact distinct count."""
    events = _table(spark, sf_dir, "events").where("event_id < 0 OR user_id % 2 = 0")
    return events.agg(F.coalesce(F.max("event_id"), F.lit(0)).alias("high_water"), F.count("*").alias("n"), F.count_distinct("user_id").alias("users"))


# Filters, sorts, sets ---------------------------------------------------------------------------


@query("SELECT o_orderkey, o_orderdate, o_orderstatus FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 25")
def recent_runs_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest runs, at most 25, without a full sort."""
    return _table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus").orderBy(F.desc("o_orderdate"), "o_orderkey").limit(25)


@query("""SELECT o_orderkey, o_orderstatus, o_orderdate FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1996-12-31'
AND o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus NOT IN ('P') ORDER BY o_orderkey""")
def bounded_range_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A range, a list and an exclusion, all pushed to the scan."""
    date = F.col("o_orderdate")
    low, high = (F.lit(d).cast("timestamp_ntz") for d in ("1996-01-01", "1996-12-31"))
    rows = _table(spark, sf_dir, "orders").where(date.between(low, high) & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & ~F.col("o_orderstatus").isin("P"))
    return rows.select("o_orderkey", "o_orderstatus", "o_orderdate").orderBy("o_orderkey")


@query("""WITH a AS (SELECT user_id, event_type FROM events WHERE event_id % 2 = 0), b AS (SELECT user_id, event_type FROM events WHERE event_id % 3 = 0)
SELECT 'missing_or_changed' AS violation, * FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
UNION ALL SELECT 'extra_or_changed', * FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""")
def except_both_ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distinct rows of either side that the other lacks, tagged."""
    events = _table(spark, sf_dir, "events")
    a, b = (events.where(f"event_id % {k} = 0").select("user_id", "event_type") for k in (2, 3))
    tag = F.lit("missing_or_changed").alias("violation"), F.lit("extra_or_changed").alias("violation")
    return a.subtract(b).select(tag[0], "*").unionByName(b.subtract(a).select(tag[1], "*"))


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def unique_grain_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n")).where("n > 1")


@query("SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_orderstatus NOT IN ('F', 'O') GROUP BY 1")
def accepted_values_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").where(~F.col("o_orderstatus").isin("F", "O")).groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query("""SELECT count(*) FILTER (event_id IS NULL) AS event_id_nulls, count(*) FILTER (props IS NULL) AS props_nulls,
count(*) FILTER (nullif(event_type, 'click') IS NULL) AS click_or_null FROM events""")
def not_null_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nulls of several columns in one pass."""
    nulls = [F.count_if(c.isNull()).alias(n) for n, c in (("event_id_nulls", F.col("event_id")), ("props_nulls", F.col("props")), ("click_or_null", F.nullif(F.col("event_type"), F.lit("click"))))]
    return _table(spark, sf_dir, "events").agg(*nulls)


@query("""SELECT l.l_orderkey, l.l_linenumber FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey LEFT JOIN part p ON l.l_partkey = p.p_partkey
WHERE o.o_orderstatus IS NULL OR o.o_orderstatus <> 'F' OR p.p_partkey IS NULL OR p.p_size IS DISTINCT FROM 15 OR l.l_shipdate < o.o_orderdate
OR l.l_quantity IS NULL OR l.l_discount NOT BETWEEN 0 AND 0.05""")
def valid_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts that break any of several rules, null-safe and not, after outer joins."""
    rows = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "l_quantity", "l_discount")
    runs = _table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    parts = _table(spark, sf_dir, "part").select("p_partkey", "p_size")
    joined = rows.join(runs, rows.l_orderkey == runs.o_orderkey, "left").join(parts, rows.l_partkey == parts.p_partkey, "left")
    broken = (
        F.col("o_orderstatus").isNull()
        | (F.col("o_orderstatus") != "F")
        | F.col("p_partkey").isNull()
        | ~F.col("p_size").eqNullSafe(F.lit(15))
        | (F.col("l_shipdate") < F.col("o_orderdate"))
        | F.col("l_quantity").isNull()
        | ~F.col("l_discount").between(0, 0.05)
    )
    return joined.where(broken).select("l_orderkey", "l_linenumber")


@query("""SELECT event_id FROM events WHERE CAST(floor(epoch(ts)) AS BIGINT) % 300 <> 0 AND ts <> date_trunc('hour', ts)""")
def alignment_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instants that stand on neither five minutes nor the hour."""
    ts = F.col("ts")
    seconds = F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), ts)
    whole = F.date_trunc("hour", ts).cast("timestamp_ntz")
    return _table(spark, sf_dir, "events").where((seconds % 300 != 0) & (ts != whole)).select("event_id")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem WHERE NOT
 (abs(l_extendedprice * (1 - l_discount) - l_extendedprice) <= greatest(1e-8 * greatest(abs(l_extendedprice * (1 - l_discount)), abs(l_extendedprice)), 1e-5))""")
def isclose_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of numbers that differ beyond a relative and an absolute tolerance."""
    a, b = F.col("l_extendedprice") * (1 - F.col("l_discount")), F.col("l_extendedprice")
    return _table(spark, sf_dir, "lineitem").where(~isclose(a, b)).select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


def isclose(a: Column, b: Column, relative: float = 1e-8, absolute: float = 1e-5) -> Column:
    return F.abs(a - b) <= F.greatest(F.lit(relative) * F.greatest(F.abs(a), F.abs(b)), F.lit(absolute))


@query(r"""SELECT o_orderkey, t AS price_text, length(regexp_extract(t, '^-?0*([0-9]*)', 1)) <= 5
 AND length(rtrim(regexp_extract(t, '\.([0-9]+)$', 1), '0')) <= 1 AS exact
FROM (SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS t FROM orders)""")
def exact_numeric_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether decimal text fits so many digits without rounding, decided before any cast."""
    text = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    whole = F.length(F.regexp_extract("price_text", r"^-?0*([0-9]*)", 1))
    fraction = F.length(F.rtrim(F.regexp_extract("price_text", r"\.([0-9]+)$", 1), F.lit("0")))
    return _table(spark, sf_dir, "orders").select("o_orderkey", text.alias("price_text")).withColumn("exact", (whole <= 5) & (fraction <= 1))


# Identities and calendars -----------------------------------------------------------------------


@query("""SELECT event_id, sha256('{"event_type":"' || event_type || '","schema":"observation-key/v1","ts":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z","user_id":"' || user_id || '"}') AS logical_key FROM events""")
def digest_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SHA-256 of canonical JSON for each row."""
    from tidemark.functions.identity import KEY_SCHEMA, digest

    key = digest(KEY_SCHEMA, {"event_type": F.col("event_type"), "ts": timez.utc_text(F.col("ts")), "user_id": F.col("user_id").cast("string")})
    return _table(spark, sf_dir, "events").select("event_id", key.alias("logical_key"))


@query("""WITH e AS (SELECT DISTINCT date_trunc('hour', ts) AS hour FROM events), b AS (SELECT CAST(min(hour) AS DATE) + 1 AS lo, CAST(max(hour) AS DATE) - 1 AS hi FROM e),
days AS (SELECT CAST(d AS DATE) AS day FROM b, unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS t(d)),
bounds AS (SELECT day, (CAST(day AS TIMESTAMP) AT TIME ZONE 'America/Los_Angeles') AT TIME ZONE 'UTC' AS a, (CAST(day + 1 AS TIMESTAMP) AT TIME ZONE 'America/Los_Angeles') AT TIME ZONE 'UTC' AS z FROM days)
SELECT day, CAST(date_diff('hour', a, z) AS BIGINT) AS expected, count(e.hour) AS present FROM bounds LEFT JOIN e ON e.hour >= a AND e.hour < z GROUP BY day, a, z""")
def day_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours that each Pacific day should have and has; days come from a sequence, so none is missed."""
    hours = _table(spark, sf_dir, "events").select(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour")).distinct()
    span = hours.agg(F.date_add(F.min("hour").cast("date"), 1).alias("lo"), F.date_sub(F.max("hour").cast("date"), 1).alias("hi")).where("lo <= hi")
    days = span.select(F.explode(F.sequence("lo", "hi")).alias("day")).withColumn("expected", timez.expected_hours(F.col("day")))
    present = hours.groupBy(timez.pacific_date(F.col("hour")).alias("day")).agg(F.count("*").alias("present"))
    return days.join(present, "day", "left").select("day", "expected", F.coalesce("present", F.lit(0)).alias("present"))


@query("""SELECT CAST(d AS DATE) AS day, product, location FROM (SELECT CAST(min(ts) AS DATE) AS a, CAST(max(ts) AS DATE) AS z FROM events), unnest(generate_series(CAST(a AS TIMESTAMP), CAST(z AS TIMESTAMP), INTERVAL 1 DAY)) AS t(d),
(VALUES ('lmp', 'TH_NP15_GEN-APND'), ('lmp', 'TH_SP15_GEN-APND'), ('load', '')) AS v(product, location)""")
def backfill_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inclusive dates of the log by products and hubs."""
    days = _table(spark, sf_dir, "events").agg(F.min("ts").cast("date").alias("a"), F.max("ts").cast("date").alias("z")).select(F.explode(F.sequence("a", "z")).alias("day"))
    units = F.array(*[F.struct(F.lit(p).alias("product"), F.lit(h).alias("location")) for p, h in (("lmp", "TH_NP15_GEN-APND"), ("lmp", "TH_SP15_GEN-APND"), ("load", ""))])
    return days.select("day", F.inline(units))
