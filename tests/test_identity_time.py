"""Golden identities, canonical texts, and days on which clocks change."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions import identity, timez
from tidemark.operators.revision import Request, plain_digest, valid_run_id
from tidemark.plans import scenario


def test_golden_price(spark):
    from tidemark.operators.normalize import normalize

    row = normalize("lmp", scenario.source_frame(spark, "lmp", "10"), scenario.PROVENANCE).first()
    assert row.content_id == "0cf68bb04435dfa4e25cd2f9fd45c91cc9ae3c3a98873778e60c6ef882806f21"
    assert row.logical_key == "cf571303ddf88ca63ad582177cf916e977e32398ccfe3d9b8b1adee40823c1ea"
    assert row.content_hash == "081f838e335128cc035c6ae244a5cd6b644df1c669f2554143630548282a29b9"


def test_golden_requests():
    request = Request("lmp", date(2026, 8, 2), scenario.HUB)
    assert request.request_id == "eb8dfd6e60c18468e4bdb199ea2bd08a5a1e82129da85096f652004490670729"
    assert request.unit_run_id("3fdcca7e53a0440c8ea4fdd0403d452c") == "13ad8ff858bb5a02aec95f0b0b6a3d7e"
    assert request.unit_run_id("09b48fd791f94b66bcfd32d7269bfbbd") == "29dfb40badd650bcbc80d4e1ad79a803"


def test_decimal_text(spark):
    cases = {"10": "10", "10.500": "10.5", "0.000000001": "0.000000001", "-0.5": "-0.5", "0": "0", "-0.000": "0", "1200": "1200", "-1000": "-1000", "12345678901234567890123456789.123456789": "12345678901234567890123456789.123456789"}
    frame = spark.createDataFrame([(k,) for k in cases], "s string").select("s", identity.decimal_text(F.col("s").cast("decimal(38,9)")).alias("t"))
    assert {r.s: r.t for r in frame.collect()} == cases
    assert spark.range(1).select(identity.decimal_text(F.lit(None).cast("decimal(38,9)"))).first()[0] is None


def test_exact_numeric(spark):
    good = ["1", "-1.5", "0.123456789", "1.1234567890", "00012", "9" * 29, ".5", "-0"]
    bad = ["0.0000000005", "9" * 30, "1e5", "", "abc", "1.1234567891", "--1", "1.2.3", " 1"]
    frame = spark.createDataFrame([(x,) for x in [*good, *bad, None]], "s string").select("s", identity.exact_numeric(F.col("s")).alias("ok"))
    assert {r.s for r in frame.collect() if r.ok} == set(good)


def test_digest_equals_plain_and_refuses(spark):
    fields = {"b": "x", "a": 'quote " and \\', "zone": "y"}
    made = spark.range(1).select(identity.digest("s/v1", {k: F.lit(v) for k, v in fields.items()})).first()[0]
    assert made == plain_digest("s/v1", fields)
    for value in (F.lit(None), F.lit("é")):
        with pytest.raises(Exception, match="must be ASCII text"):
            spark.range(1).select(identity.digest("s/v1", {"a": value})).collect()


@pytest.mark.parametrize("day, hours", [("2026-03-08", 23), ("2025-03-09", 23), ("2025-11-02", 25), ("2026-11-01", 25), ("2026-08-01", 24)])
def test_day_lengths(spark, day, hours):
    got = spark.range(1).select(timez.expected_hours(F.lit(day).cast("date"))).first()[0]
    assert got == hours == Request("load", date.fromisoformat(day)).hours if date.fromisoformat(day) < date.today() else got == hours


def test_times(spark):
    cases = {
        "2026-08-01T00:00:00-07:00": datetime(2026, 8, 1, 7), "2026-08-01T07:00:00Z": datetime(2026, 8, 1, 7), "2026-08-01 07:00:00.123456+00:00": datetime(2026, 8, 1, 7, 0, 0, 123456),
        "2026-08-01T07:00:00": None, "2026-08-01T07:00:00.1234567Z": None, "2026-13-01T07:00:00Z": None, "x": None, None: None,
    }
    frame = spark.createDataFrame([(k,) for k in cases], "s string").select("s", timez.parse_instant(F.col("s")).alias("t"))
    assert {r.s: r.t for r in frame.collect()} == cases
    one = spark.sql("select timestamp_ntz'2026-11-01 09:30:00' t").select(timez.utc_text(F.col("t")).alias("u"), timez.pacific_text(F.col("t")).alias("p"), timez.pacific_date(F.col("t")).alias("d")).first()
    assert tuple(one) == ("2026-11-01T09:30:00.000000Z", "2026-11-01T01:30:00-08:00", date(2026, 11, 1))


def test_run_ids():
    assert valid_run_id("0" * 32) == "0" * 32
    for bad in ("", "x" * 32, "0" * 31, "A" * 32, "00000000-0000-0000-0000-000000000000", None):
        with pytest.raises(Exception, match="run id"):
            valid_run_id(bad)


def test_requests_are_bounded():
    for args in (("gas", date(2026, 8, 1)), ("lmp", date(2026, 8, 1)), ("lmp", date(2026, 8, 1), "X"), ("load", date(2026, 8, 1), scenario.HUB), ("load", date(2999, 1, 1)), ("load", datetime(2026, 8, 1))):
        with pytest.raises(Exception):
            Request(*args)
