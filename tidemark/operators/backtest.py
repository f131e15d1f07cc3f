"""A daily perfect-foresight benchmark: checked inputs, a dispatch for each day, and totals."""

from __future__ import annotations

import json
import platform
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.errors import SchemaError, ValidationError
from tidemark.functions import timez
from tidemark.functions.identity import CONTENT_SCHEMA, KEY_SCHEMA, exact_numeric
from tidemark.operators import dispatch, quality
from tidemark.operators.dispatch import Battery
from tidemark.operators.guard import planned_bytes
from tidemark.operators.revision import Request
from tidemark.schemas import BATTERY_INPUTS, BATTERY_JSON, HUBS, NUMERIC, PRODUCTS, SOURCE, VERSION

MOST_DAYS = 7


def requests(first: date, last: date, location: str) -> list[Request]:
    """A price request for each of 1 to 7 inclusive days."""
    if type(first) is not date or type(last) is not date:
        raise ValidationError("boundaries must be calendar dates")
    count = (last - first).days + 1
    if not 1 <= count <= MOST_DAYS:
        raise ValidationError(f"a backtest has 1 to {MOST_DAYS} days")
    return [Request("lmp", first + timedelta(days=k), location) for k in range(count)]


def read_prices(mart: DataFrame, first: date, last: date, location: str) -> DataFrame:
    """The mart's columns of one hub and a range of days, in order; range and hub reach the scan."""
    return mart.select(*BATTERY_INPUTS).where(F.col("market_date").between(F.lit(first), F.lit(last)) & (F.col("location") == location)).orderBy("interval_start_utc")


def read_json(spark: SparkSession, path: str) -> DataFrame:
    """Mart rows from a JSON array. Prices are read as text and become decimals only if that is exact."""
    try:
        rows = spark.read.schema(BATTERY_JSON).option("multiLine", True).option("mode", "FAILFAST").json(path)
        bad = rows.where(~exact_numeric(F.col("lmp"))).count()
    except Exception as error:
        if "MALFORMED_RECORD" in str(error) or "PATH_NOT_FOUND" in str(error) or "FAILED_READ_FILE" in str(error):
            raise ValidationError(f"bad input file: {path}") from error
        raise
    if bad:
        raise ValidationError(f"{bad} prices are no exact decimals")
    times = {n: timez.parse_instant(F.col(n)) for n in ("interval_start_utc", "interval_end_utc", "first_seen_at", "state_known_at")}
    return rows.withColumns({**times, "lmp": F.col("lmp").cast(NUMERIC), "market_date": F.expr("try_cast(market_date AS date)")}).select(*BATTERY_INPUTS)


def checked_inputs(prices: DataFrame, plan: list[Request]) -> DataFrame:
    """The prices, if every row is whole and every day has each of its hours once. All days are checked
    before any is solved."""
    if missing := sorted(set(BATTERY_INPUTS) - set(prices.columns)):
        raise SchemaError(f"missing columns: {missing}")
    own, location = PRODUCTS["lmp"], plan[0].location
    broken = F.lit(False)
    for name in BATTERY_INPUTS:
        broken = broken | F.col(name).isNull()
    for name in ("logical_key", "content_id", "content_hash", "transition_id", "state_run_id"):
        broken = broken | (F.trim(name) == "")
    for name, value in (("source", SOURCE), ("market", own["market"]), ("unit", own["unit"]), ("logical_key_schema", KEY_SCHEMA), ("content_hash_schema", CONTENT_SCHEMA)):
        broken = broken | (F.col(name) != value)
    start = F.col("interval_start_utc")
    broken = broken | ~F.col("location").isin(*HUBS) | (F.col("state_ordinal") < 1) | (F.col("commit_sequence") < 1) | (F.col("market_date") != timez.pacific_date(start))
    broken = broken | (start != F.date_trunc("hour", start).cast("timestamp_ntz")) | (F.timestamp_diff("SECOND", start, F.col("interval_end_utc")) != 3600)
    outside = (F.col("location") != location) | ~F.col("market_date").between(F.lit(plan[0].day), F.lit(plan[-1].day))
    found = prices.agg(F.count("*").alias("n"), F.count_if(F.coalesce(broken, F.lit(True))).alias("broken"), F.count_if(F.coalesce(outside, F.lit(True))).alias("outside"), F.count_distinct("logical_key").alias("keys")).first()
    for wrong, what in ((found.broken, "rows with missing or wrong fields"), (found.outside, "rows outside the dates or hub"), (found.n - found.keys, "repeated logical keys")):
        if wrong:
            raise ValidationError(f"{wrong} {what}")
    days = prices.sparkSession.createDataFrame([(r.location, r.day) for r in plan], "location string, market_date date")
    if gaps := quality.coverage(prices, days).select("market_date").distinct().orderBy("market_date").limit(3).collect():
        raise ValidationError(f"days without each hour once: {[str(g.market_date) for g in gaps]}")
    return prices


def backtest(prices: DataFrame, first: date, last: date, location: str, battery: Battery) -> tuple[DataFrame, DataFrame]:
    """(days, totals) of a benchmark with independent days that end as they begin."""
    plan = requests(first, last, location)
    if battery.initial_soc_mwh != battery.terminal_soc_mwh:
        raise ValidationError("a daily benchmark ends each day with the state it began with")
    days = dispatch.day_metrics(dispatch.dispatch_days(checked_inputs(prices, plan), battery).drop("prices"), battery)
    return days, dispatch.totals(days)


def report(prices: DataFrame, days: DataFrame, totals: DataFrame, battery: Battery, kind: str) -> str:
    """JSON of a result: decimals and dates as text, no number that isn't finite."""
    inputs: dict[str, list] = {}
    for r in prices.orderBy("interval_start_utc").collect():
        inputs.setdefault(str(r.market_date), []).append(r.asDict())
    body = {
        "input_kind": kind,
        "query": {"bytes_processed": planned_bytes(prices)},
        "versions": {"tidemark": VERSION, "spark": prices.sparkSession.version, "python": platform.python_version()},
        "backtest": {
            "config": battery.__dict__,
            "days": [r.asDict(recursive=True) | {"inputs": inputs[str(r.market_date)]} for r in days.orderBy("market_date").collect()],
            "aggregate": totals.first().asDict(),
            "result_schema": "daily-battery-benchmark/v1",
            "logical_key_schema": KEY_SCHEMA,
            "content_hash_schema": CONTENT_SCHEMA,
        },
    }
    return json.dumps(body, default=str, indent=2, allow_nan=False)


#: Panels of a day: what they show, in which unit, and from which columns.
PANELS = (("Price", "USD/MWh", lambda d: d["prices"]), ("Power, charging below zero", "MW", lambda d: [y - x for x, y in zip(d["charge_mw"], d["discharge_mw"], strict=True)]), ("State of charge", "MWh", lambda d: d["soc_mwh"]))


def _panel(title: str, unit: str, values: list[float]) -> str:
    low, high = min(0, *values), max(0, *values)
    span = (high - low) or 1

    def y(value: float) -> float:
        return 140 - 120 * (value - low) / span

    points = " ".join(f"{90 + 670 * k / max(1, len(values) - 1):.1f},{y(v):.1f}" for k, v in enumerate(values))
    marks = "".join(f'<text x="84" y="{y(v) + 4:.1f}" text-anchor="end">{v:.2f} {unit}</text>' for v in dict.fromkeys((low, 0.0, high)))
    hours = "".join(f'<text x="{90 + 670 * k / max(1, len(values) - 1):.1f}" y="158" text-anchor="middle">{k}</text>' for k in range(0, len(values), 6))
    return f'<h3>{title} ({unit})</h3><svg viewBox="0 0 780 164" font-size="11"><line x1="90" x2="760" y1="{y(0):.1f}" y2="{y(0):.1f}" stroke="#bbb"/><polyline fill="none" stroke="#26547c" stroke-width="2" points="{points}"/>{marks}{hours}</svg>'


def figure(days: list[dict], path: str) -> None:
    """Prices, power and state of charge of each solved day (a row of days with ``prices``) by hour, as an HTML page
    with one SVG panel each; needs no chart library."""
    parts = [f"<h2>{d['location']} {d['market_date']}: {d['objective_usd']:.2f} USD</h2>" + "".join(_panel(title, unit, list(of(d))) for title, unit, of in PANELS) for d in days]
    with open(path, "w", encoding="utf-8") as file:
        file.write(f"<!DOCTYPE html><meta charset='utf-8'><title>Battery dispatch</title>{''.join(parts)}")
