"""Source frames to typed observations with identities: rules are columns, not row objects.

A source frame has the columns a client of the market's service returns. Rows are judged by predicates
collected into an array of broken rules; ``checked`` looks for any in one pass and raises, otherwise
returns the rows. Timestamps are text with an explicit offset, or typed ones taken as UTC.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import SchemaError, SourceFailed, ValidationError
from tidemark.functions import identity, timez
from tidemark.schemas import HUBS, MEASURES, NUMERIC, PRODUCTS, SOURCE, require_columns

TIMES = ("Time", "Interval Start", "Interval End")
COLUMNS = {"lmp": (*TIMES, "Market", "Location", "Location Type", "LMP", "Energy", "Congestion", "Loss"), "load": (*TIMES, "Load")}


def _instant(frame: DataFrame, name: str) -> Column:
    kind, column = frame.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, T.StringType):
        return timez.parse_instant(column)
    if isinstance(kind, T.TimestampNTZType):
        return column
    if isinstance(kind, T.TimestampType):
        return F.convert_timezone(F.current_timezone(), F.lit("UTC"), column.cast("timestamp_ntz"))
    raise SchemaError(f"{name} must be a timestamp or ISO text")


def _number(frame: DataFrame, name: str) -> tuple[Column, Column]:
    """The exact decimal, null where there is none; and whether it is one without rounding."""
    kind, column = frame.schema[name].dataType, F.col(f"`{name}`")
    if not isinstance(kind, T.NumericType):
        raise SchemaError(f"{name} must be numeric")
    value = F.expr(f"try_cast(cast(`{name}` AS string) AS {NUMERIC})")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        finite = ~F.isnan(column) & ~column.isin(float("inf"), float("-inf"))
        return value, F.coalesce(finite & (value.cast(kind) == column), F.lit(False))
    return value, F.coalesce(value == column, F.lit(False))


def judged(product: str, frame: DataFrame, provenance: dict[str, object], keep: tuple[str, ...] = ()) -> DataFrame:
    """Observations with identities and an array ``violations`` of the rules that each breaks; columns of the frame
    named in ``keep`` come along."""
    require_columns(frame, COLUMNS[product])
    own = PRODUCTS[product]
    texts = {k: F.lit(v) for k, v in provenance.items() if k != "retrieved_at_utc"}
    if set(texts) != {"source_url", "source_method", "library_version"} or not all(provenance.values()) or not isinstance(provenance.get("retrieved_at_utc"), datetime):
        raise ValidationError("provenance fields must be present")
    start, end = _instant(frame, "Interval Start"), _instant(frame, "Interval End")
    rules: list[tuple[str, Column]] = []
    columns: dict[str, Column] = {"source": F.lit(SOURCE), "product": F.lit(own["product"]), "source_dataset": F.lit(own["source_dataset"]), "unit": F.lit(own["unit"]), "interval_start_utc": start, "interval_end_utc": end}
    if product == "lmp":
        columns |= {"market": F.col("Market").cast("string"), "location": F.col("Location").cast("string")}
        rules += [("location", F.col("location").isin(*HUBS)), ("market", F.col("market") == own["market"]), ("location type", F.col("`Location Type`") == own["location_type"])]
    else:
        columns["area"] = F.lit(own["area"])
    exact = {}
    for name in MEASURES[product]:
        given = {"lmp": "LMP"}.get(name, name.capitalize())
        columns[name], exact[name] = _number(frame, given)
    rows = frame.select(*[c.alias(n) for n, c in columns.items()], _instant(frame, "Time").alias("__label"), F.col("`Location Type`") if product == "lmp" else F.lit(None).alias("__none"), *[c.alias(f"__exact_{n}") for n, c in exact.items()], *keep)
    begin = F.col("interval_start_utc")
    seconds = F.timestamp_diff("MICROSECOND", begin, F.col("interval_end_utc"))
    minutes = own["seconds"] // 60
    rules += [
        ("interval start", begin.isNotNull()),
        ("interval end", F.col("interval_end_utc").isNotNull()),
        ("label", F.col("__label").eqNullSafe(begin)),
        ("duration", seconds == own["seconds"] * 1_000_000),
        ("alignment", (F.date_trunc("minute", begin).cast("timestamp_ntz") == begin) & (F.minute(begin) % minutes == 0)),
        *[(f"number {n}", F.col(f"__exact_{n}")) for n in exact],
    ]
    if product == "load":
        day = timez.pacific_date(begin)
        rules += [("negative load", F.col("load") >= 0), ("fall-back day", timez.expected_hours(day) <= 24)]
    broken = F.filter(F.array(*[F.when(F.coalesce(ok, F.lit(False)), F.lit(None).cast("string")).otherwise(name) for name, ok in rules]), lambda x: x.isNotNull())
    rows = rows.withColumn("violations", broken)
    for name, value in texts.items():
        rows = rows.withColumn(name, value)
    rows = rows.withColumn("retrieved_at_utc", F.lit(provenance["retrieved_at_utc"].replace(tzinfo=None)).cast("timestamp_ntz")).withColumn("market_date", timez.pacific_date(begin))
    rows = with_identity(product, rows)
    per_key = F.count("*").over(W.partitionBy("logical_key"))
    return rows.withColumn("violations", F.when(F.col("logical_key").isNotNull() & (per_key > 1), F.array_append("violations", F.lit("duplicate"))).otherwise(F.col("violations"))).drop("__label", "__none", "Location Type", *[f"__exact_{n}" for n in exact])


def _identity_fields(product: str) -> dict[str, Column]:
    place = {"market": F.col("market"), "location": F.col("location")} if product == "lmp" else {"area": F.col("area")}
    return {"source": F.col("source"), "product": F.col("product"), **place, "interval_start_utc": timez.utc_text(F.col("interval_start_utc")), "interval_end_utc": timez.utc_text(F.col("interval_end_utc"))}


def with_identity(product: str, rows: DataFrame) -> DataFrame:
    """Adds logical_key, content_hash and content_id; null where a rule is broken already."""
    whole = F.size("violations") == 0 if "violations" in rows.columns else F.lit(True)
    fields = _identity_fields(product)
    content = {**fields, "unit": F.col("unit"), **{m: identity.decimal_text(F.col(m)) for m in MEASURES[product]}}
    none = F.lit(None).cast("string")
    keyed = rows.withColumn("logical_key", F.when(whole, identity.digest(identity.KEY_SCHEMA, fields)).otherwise(none)).withColumn("content_hash", F.when(whole, identity.digest(identity.CONTENT_SCHEMA, content)).otherwise(none))
    stored = {"logical_key": F.col("logical_key"), "content_hash": F.col("content_hash"), "logical_key_schema": F.lit(identity.KEY_SCHEMA), "content_hash_schema": F.lit(identity.CONTENT_SCHEMA)}
    return (
        keyed.withColumn("content_id", F.when(whole, identity.digest(identity.STORED_CONTENT_SCHEMA, stored)).otherwise(none))
        .withColumn("logical_key_schema", F.lit(identity.KEY_SCHEMA))
        .withColumn("content_hash_schema", F.lit(identity.CONTENT_SCHEMA))
    )


def checked(rows: DataFrame) -> DataFrame:
    """The rows without their column of violations; an error if any has one or there are none."""
    found = rows.agg(F.count("*").alias("n"), F.count_if(F.size("violations") > 0).alias("bad"), F.min(F.when(F.size("violations") > 0, F.array_join("violations", ", "))).alias("first")).first()
    if not found.n:
        raise SourceFailed("the source returned no observations")
    if found.bad:
        raise ValidationError(f"{found.bad} of {found.n} observations break a rule, such as: {found.first}")
    return rows.drop("violations")


def normalize(product: str, frame: DataFrame, provenance: dict[str, object]) -> DataFrame:
    """Validated observations in order of interval and place."""
    order = ["interval_start_utc", "location"] if product == "lmp" else ["interval_start_utc"]
    return checked(judged(product, frame, provenance)).orderBy(*order)


def printable(product: str, rows: DataFrame) -> DataFrame:
    """A view for people and JSON: decimals as text, both clocks, provenance."""
    start, end = F.col("interval_start_utc"), F.col("interval_end_utc")
    return rows.select(
        *[c.alias(n) for n, c in _identity_fields(product).items()],
        "unit",
        *[identity.decimal_text(F.col(m)).alias(m) for m in MEASURES[product]],
        "source_dataset",
        F.lit(timez.PACIFIC).alias("source_timezone"),
        timez.pacific_text(start).alias("interval_start_pacific"),
        timez.pacific_text(end).alias("interval_end_pacific"),
        "logical_key",
        "content_hash",
        timez.utc_text(F.col("retrieved_at_utc")).alias("retrieved_at_utc"),
        "source_url",
        "source_method",
        "library_version",
    )
