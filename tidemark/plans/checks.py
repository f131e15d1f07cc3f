"""Queries of checks and loads: orphans behind a filter, stored distinct counts, assertions, parameters, replacing loads."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tidemark.operators import asserts, bloom, distinct
from tidemark.session import ensure_checkpoint_dir
from tidemark.sources import tables

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


def _folder(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@query("""SELECT l_orderkey, count(*) AS n FROM lineitem l WHERE l_returnflag = 'R'
AND NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey AND o.o_orderstatus <> 'P') GROUP BY 1""")
def filtered_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returned lines whose order is not among the settled ones; orders meet the join behind a Bloom filter."""
    lines = _table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select("l_orderkey")
    return bloom.orphans(lines, "l_orderkey", _table(spark, sf_dir, "orders").where("o_orderstatus <> 'P'").select("o_orderkey"), "o_orderkey")


@query("""SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n, count(DISTINCT user_id) AS distinct_n FROM events
GROUP BY GROUPING SETS ((event_type, CAST(ts AS DATE)), (event_type), ())""")
def stored_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct users of days, of types and of all, merged from the stored bitmaps of three builds that share days."""
    events = _table(spark, sf_dir, "events").select("event_id", "event_type", "user_id", F.col("ts").cast("date").alias("day"))
    folder = _folder(spark, "distinct")
    for build in range(3):
        own = events.where(F.col("event_id") % 3 == build)
        distinct.bitmaps(own, {"event_type": F.col("event_type"), "day": F.col("day")}, F.col("user_id")).write.parquet(f"{folder}/build={build}")
    stored = spark.read.parquet(folder)
    levels = (["event_type", "day"], ["event_type"], [])
    out = None
    for own in levels:
        found = distinct.counts(stored, own)
        shaped = found.select(*[(F.col(c) if c in own else F.lit(None)).cast(stored.schema[c].dataType).alias(c) for c in levels[0]], "n", "distinct_n")
        out = shaped if out is None else out.unionByName(shaped)
    return out


@query("""SELECT event_id, x IS NULL AS absent, COALESCE(len(x), 0) AS n FROM (
SELECT event_id, CASE event_type WHEN 'view' THEN NULL WHEN 'error' THEN [] ELSE str_split(props, '"') END AS x FROM events)""")
def array_length_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lengths of arrays that may be null or empty: both are 0, and only one is absent."""
    kind = F.col("event_type")
    x = F.when(kind == "view", F.lit(None)).when(kind == "error", F.array().cast("array<string>")).otherwise(F.split("props", '"'))
    return _table(spark, sf_dir, "events").select("event_id", x.isNull().alias("absent"), F.coalesce(F.array_size(x), F.lit(0)).cast("bigint").alias("n"))


#: What the parameters say of order states.
_WEIGHTS = [("F", 1.5), ("O", None), ("X", 4.0)]
_WEIGHT_SCHEMA = StructType([StructField("state", StringType(), False), StructField("weight", DoubleType())])


@query("""WITH p(state, weight) AS (VALUES ('F', 1.5), ('O', NULL), ('X', 4.0)), given AS (SELECT 'some' AS parameters, * FROM p),
o AS (SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1)
SELECT k.parameters, o.o_orderstatus, o.n, g.state IS NOT NULL AS named, CAST(g.weight AS DOUBLE) AS weight
FROM o CROSS JOIN (VALUES ('some'), ('none')) AS k(parameters) LEFT JOIN given g ON g.parameters = k.parameters AND g.state = o.o_orderstatus""")
def parameter_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by state beside a typed table of parameters, and beside one without rows."""
    orders = _table(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(F.count("*").alias("n"))
    out = None
    for name, rows in (("some", _WEIGHTS), ("none", [])):
        given = tables.parameters(spark, rows, _WEIGHT_SCHEMA)
        found = orders.join(given, F.col("o_orderstatus") == F.col("state"), "left").select(F.lit(name).alias("parameters"), "o_orderstatus", "n", F.col("state").isNotNull().alias("named"), "weight")
        out = found if out is None else out.unionByName(found)
    return out


@query("SELECT l_returnflag, count(*) AS n, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity FROM lineitem GROUP BY 1")
def asserted_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines by flag, under assertions that run with them: each has a quantity above zero and a flag, and as many have an
    order as there are."""
    lines = _table(spark, sf_dir, "lineitem").select("l_returnflag", "l_quantity")
    told = asserts.each(lines, (F.col("l_quantity") > 0) & F.col("l_returnflag").isNotNull(), "a line without a quantity or a flag")
    sums = told.groupBy("l_returnflag").agg(F.count("*").alias("n"), F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("quantity"))
    ordered = _table(spark, sf_dir, "lineitem").select("l_orderkey")
    return asserts.all_of(sums, F.count("l_orderkey") == F.count("*"), ordered, "a line without an order")


@query("SELECT event_type, count(*) AS n, count(DISTINCT now()) AS clocks, count(*) FILTER (CAST(ts AS TIMESTAMPTZ) > now()) AS later FROM events GROUP BY 1")
def statement_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A statement has one clock, whatever the tasks and retries; it tells what is later, and no commit's time."""
    rows = _table(spark, sf_dir, "events").select("event_type", "ts", F.current_timestamp().alias("now"))
    return rows.groupBy("event_type").agg(F.count("*").alias("n"), F.count_distinct("now").alias("clocks"), F.count_if(F.col("ts") > F.col("now")).alias("later"))


@query("""SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n, CASE WHEN day(ts) % 3 = 0 THEN 2 ELSE 1 END AS load_no FROM events
WHERE day(ts) % 3 <> 0 OR event_type <> 'error' GROUP BY ALL""")
def replacing_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first load of all dates; then every third date is loaded again, without errors, and replaced whole."""
    rows = _table(spark, sf_dir, "events").select(F.col("ts").cast("date").alias("day"), "event_type")
    path, again = _folder(spark, "load"), F.dayofmonth("day") % 3 == 0
    tables.replace_partitions(rows.withColumn("load_no", F.lit(1)), path, "day")
    tables.replace_partitions(rows.where(again & (F.col("event_type") != "error")).withColumn("load_no", F.lit(2)), path, "day")
    loaded = spark.read.schema("event_type string, load_no int, day date").parquet(path)
    return loaded.groupBy("day", "event_type", "load_no").agg(F.count("*").alias("n"))
