"""Queries of the market engine over generated and driver tables: normalisation, models, tests, dispatch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import timez
from tidemark.functions.identity import decimal_text
from tidemark.operators import dispatch
from tidemark.operators.dispatch import Battery
from tidemark.plans import scenario

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

REFERENCE = Battery(energy_capacity_mwh=4, max_charge_mw=1, max_discharge_mw=1, charge_efficiency=0.95, discharge_efficiency=0.95, initial_soc_mwh=2, terminal_soc_mwh=2)


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def hourly_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a market: the mean value of an hour is its price, hours without events cost 50, and only
    whole Pacific days within the events' span count. Shaped like battery inputs."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("h"), F.col("value").cast("decimal(18,4)").alias("v"))
    means = events.groupBy("h").agg(F.avg("v").cast("decimal(38,9)").alias("lmp"))
    span = events.agg(F.date_add(timez.pacific_date(F.min("h")), 1).alias("a"), F.date_sub(timez.pacific_date(F.max("h")), 1).alias("z")).where("a <= z")
    days = span.select(F.explode(F.sequence("a", "z")).alias("market_date"))
    first, last = timez.day_bounds(F.col("market_date"))
    hours = days.select("market_date", F.explode(F.sequence(first, last - F.expr("interval 1 hour"), F.expr("interval 1 hour"))).alias("h"))
    priced = hours.join(means, "h", "left")
    return priced.select(F.lit(scenario.HUB).alias("location"), "market_date", F.col("h").alias("interval_start_utc"), F.coalesce("lmp", F.lit(50).cast("decimal(38,9)")).alias("lmp"))


_PRICES = """
WITH e AS (SELECT date_trunc('hour', ts) AS h, CAST(value AS DECIMAL(18,4)) AS v FROM events),
b AS (SELECT CAST((min(h) AT TIME ZONE 'UTC') AT TIME ZONE 'America/Los_Angeles' AS DATE) + 1 AS a, CAST((max(h) AT TIME ZONE 'UTC') AT TIME ZONE 'America/Los_Angeles' AS DATE) - 1 AS z FROM e),
d AS (SELECT CAST(x AS DATE) AS market_date FROM b, unnest(generate_series(CAST(a AS TIMESTAMP), CAST(z AS TIMESTAMP), INTERVAL 1 DAY)) AS t(x)),
s AS (SELECT market_date, (CAST(market_date AS TIMESTAMP) AT TIME ZONE 'America/Los_Angeles') AT TIME ZONE 'UTC' AS first, (CAST(market_date + 1 AS TIMESTAMP) AT TIME ZONE 'America/Los_Angeles') AT TIME ZONE 'UTC' AS last FROM d),
hours AS (SELECT market_date, x AS h FROM s, unnest(generate_series(first, last - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS t(x)),
prices AS (SELECT market_date, h, CAST(coalesce(m, 50) AS DOUBLE) AS lmp FROM hours LEFT JOIN (SELECT h AS eh, avg(v) AS m FROM e GROUP BY 1) ON h = eh)
"""


@query(_PRICES + """SELECT market_date, count(*) AS observation_count, CAST(round(min(lmp), 5) AS DOUBLE) AS minimum_price, CAST(round(max(lmp), 5) AS DOUBLE) AS maximum_price,
CAST(sum(CASE WHEN lmp < 45 THEN 1 ELSE 0 END) AS BIGINT) AS low_price_count FROM prices GROUP BY 1""")
def battery_inputs_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the benchmark's days hold, by day."""
    lmp = F.col("lmp").cast("double")
    return hourly_prices(spark, sf_dir).groupBy("market_date").agg(
        F.count("*").alias("observation_count"), F.round(F.min(lmp), 5).alias("minimum_price"), F.round(F.max(lmp), 5).alias("maximum_price"), F.sum(F.when(lmp < 45, 1).otherwise(0)).cast("bigint").alias("low_price_count")
    )


@query("""SELECT o_orderkey, CASE WHEN p = 0 THEN '0' ELSE rtrim(rtrim(CAST(p AS VARCHAR), '0'), '.') END AS canonical FROM (SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(38,9)) AS p FROM orders)""")
def canonical_decimals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decimals as canonical text."""
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", decimal_text(F.col("o_totalprice").cast("decimal(38,9)")).alias("canonical"))


@query("""SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z' AS utc, CAST((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/Los_Angeles' AS DATE) AS market_date,
CAST(date_diff('hour', (CAST(CAST((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/Los_Angeles' AS DATE) AS TIMESTAMP) AT TIME ZONE 'America/Los_Angeles') AT TIME ZONE 'UTC', date_trunc('hour', ts)) AS BIGINT) AS hour_of_day
FROM events""")
def market_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UTC text, market date and the hour within the market day of each event."""
    ts = F.col("ts")
    day = timez.pacific_date(ts)
    hour = F.timestamp_diff("HOUR", timez.day_start(day), F.date_trunc("hour", ts).cast("timestamp_ntz"))
    return spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", timez.utc_text(ts).alias("utc"), day.alias("market_date"), hour.cast("bigint").alias("hour_of_day"))


# The value of each state at each hour, backward from the last one, over all states that whole steps reach.
_DISPATCH = _PRICES.replace("WITH e AS", "WITH RECURSIVE e AS", 1) + """, n AS (SELECT unnest(generate_series(0, 25)) AS k),
shifts AS (SELECT a.k * 0.95 - b.k / 0.95 AS x FROM n a, n b WHERE a.k + b.k <= 25),
states AS (SELECT DISTINCT round(least(4, greatest(0, g + sign * x)), 10) AS s FROM shifts, (VALUES (0.0::DOUBLE), (4.0), (2.0)) AS v(g), (VALUES (1), (-1)) AS w(sign) WHERE g + sign * x BETWEEN -1e-9 AND 4 + 1e-9),
steps AS MATERIALIZED (SELECT f.s AS here, t.s AS there, greatest(f.s - t.s, 0) * 0.95 - greatest(t.s - f.s, 0) / 0.95 AS sold FROM states f, states t WHERE t.s - f.s BETWEEN -1 / 0.95 - 1e-9 AND 0.95 + 1e-9),
hourly AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY market_date ORDER BY h) AS k FROM prices),
days AS (SELECT market_date, count(*) AS interval_count, min(lmp) AS low, max(lmp) AS high FROM hourly GROUP BY 1),
worth AS (
  SELECT market_date, interval_count AS k, 2.0::DOUBLE AS s, 0.0::DOUBLE AS v FROM days
  UNION ALL
  SELECT w.market_date, w.k - 1, t.here, max(w.v + p.lmp * t.sold) FROM worth w JOIN hourly p ON p.market_date = w.market_date AND p.k = w.k JOIN steps t ON t.there = w.s WHERE w.k > 0 GROUP BY 1, 2, 3
), best AS (SELECT d.market_date, interval_count, low, high, round(w.v, 4) + 0.0 AS value FROM days d JOIN worth w ON w.market_date = d.market_date AND w.k = 0 AND w.s = 2)
"""


@query(_DISPATCH + """SELECT 'TH_NP15_GEN-APND' AS location, market_date, interval_count, round(low, 5) AS minimum_price, round(high, 5) AS maximum_price, value AS objective_usd,
value AS value_of_vectors, true AS vectors_hold FROM best""")
def battery_backtest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best dispatch of each day: its objective, the same from its vectors, and whether these break no rule."""
    days = dispatch.judged_days(dispatch.dispatch_days(hourly_prices(spark, sf_dir), REFERENCE), REFERENCE)
    worth = F.aggregate(F.zip_with(F.col("prices"), F.zip_with("discharge_mw", "charge_mw", lambda d, c: d - c), lambda p, x: p * x), F.lit(0.0), lambda a, x: a + x)
    return days.select(
        "location", "market_date", "interval_count", F.round("minimum_price", 5).alias("minimum_price"), F.round("maximum_price", 5).alias("maximum_price"),
        (F.round("objective_usd", 4) + 0.0).alias("objective_usd"), (F.round(worth, 4) + 0.0).alias("value_of_vectors"), (F.size("broken") == 0).alias("vectors_hold"),
    )


@query(_PRICES + """SELECT DISTINCT market_date, (['none', 'length', 'ends', 'state', 'power', 'balance', 'value'])[day(market_date) % 7 + 1] AS rule, true AS named, day(market_date) % 7 = 0 AS held FROM prices""")
def battery_broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dispatches spoiled in one way a day: each breaks the rule that it was spoiled for, and what was left alone holds."""
    days, kind = dispatch.dispatch_days(hourly_prices(spark, sf_dir), REFERENCE), F.dayofmonth("market_date") % 7

    def first(name: str, by: float):
        return F.concat(F.array(F.element_at(name, 1) + by), F.slice(name, 2, F.size(name)))

    soc = F.when(kind == 1, F.slice("soc_mwh", 2, F.size("soc_mwh"))).when(kind == 2, first("soc_mwh", 0.5)).when(kind == 3, F.transform("soc_mwh", lambda x: x + 5)).otherwise(F.col("soc_mwh"))
    charge = F.when(kind == 4, first("charge_mw", 2.0)).when(kind == 5, first("charge_mw", 0.001)).otherwise(F.col("charge_mw"))
    gross = F.col("gross_arbitrage_value_usd") + F.when(kind == 6, 1).otherwise(0)
    judged = dispatch.judged_days(days.withColumns({"soc_mwh": soc, "charge_mw": charge, "gross_arbitrage_value_usd": gross}), REFERENCE)
    rule = F.element_at(F.array(*map(F.lit, ("none", "length", "ends", "state", "power", "balance", "value"))), (kind + 1).cast("int"))
    return judged.select("market_date", rule.alias("rule"), F.when(kind == 0, F.lit(True)).otherwise(F.array_contains("broken", rule)).alias("named"), (F.size("broken") == 0).alias("held"))


@query(_DISPATCH + """SELECT count(*) AS days, round(sum(value), 2) AS total_gross_arbitrage_value_usd, round(avg(value), 2) AS average_daily_gross_value_usd,
round(median(value), 2) AS median_daily_gross_value_usd, arg_min(market_date, (-value, market_date)) AS best_day, arg_min(market_date, (value, market_date)) AS worst_day, true AS shares_are_whole FROM best""")
def battery_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row over all days of the benchmark."""
    days = dispatch.day_metrics(dispatch.dispatch_days(hourly_prices(spark, sf_dir), REFERENCE), REFERENCE)
    whole = F.abs(F.col("charging_percent") + F.col("discharging_percent") + F.col("idle_percent") - 100) < 1e-6
    money = [F.round(c, 2).alias(c) for c in ("total_gross_arbitrage_value_usd", "average_daily_gross_value_usd", "median_daily_gross_value_usd")]
    return dispatch.totals(days).select(F.col("day_count").alias("days"), *money, "best_day", "worst_day", whole.alias("shares_are_whole"))
