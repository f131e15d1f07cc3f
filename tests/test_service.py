"""The data source that calls a client on executors: slices, pruning, faults and the stream of days."""

from __future__ import annotations

import os
import subprocess
import sys
from collections import Counter
from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.clients.folder import POINTER
from tidemark.errors import ValidationError
from tidemark.schemas import HUBS
from tidemark.session import make_importable
from tidemark.sources import market

CLIENT = "tests.clients.folder:"


@pytest.fixture()
def calls(spark, tmp_path_factory):
    """Calls so far, by product and day."""
    make_importable(spark)
    market.register(spark)
    folder = str(tmp_path_factory.mktemp("calls"))
    with open(POINTER, "w") as file:
        file.write(folder)
    return lambda: Counter(tuple(n.split("_")[:2]) for n in os.listdir(folder))


def read(spark, **options):
    return spark.read.format("market_service").options(client=CLIENT + "days", **options).load()


def test_a_slice_for_each_day_and_hub(spark, calls):
    frame = read(spark, first="2026-03-07", last="2026-03-09")
    assert frame.rdd.getNumPartitions() == 9
    assert {(r.market_date.day, r.n) for r in frame.groupBy("market_date", "hub").agg(F.count("*").alias("n")).collect()} == {(7, 24), (8, 23), (9, 24)}


def test_options_leave_slices_out(spark, calls):
    frame = read(spark, first="2026-08-02", last="2026-08-03", hubs=f"{HUBS[0]},{HUBS[2]}")
    assert frame.count() == 96 and calls() == {("lmp", "2026-08-02"): 2, ("lmp", "2026-08-03"): 2}
    assert read(spark, first="2026-08-03", last="2026-08-02").count() == 0


def test_plans_over_one_frame_lose_nothing(spark, calls):
    frame = read(spark, first="2026-08-01", last="2026-08-02")
    one, other = frame.where("market_date = date'2026-08-01'"), frame.where(f"hub = '{HUBS[1]}'")
    assert (one.count(), other.count(), frame.count(), one.unionByName(other).count()) == (72, 48, 144, 120)


def test_a_failing_slice_alone_is_called_again(tmp_path):
    """Two tries of a task: the slice that fails once is called twice, the others once."""
    said = subprocess.run([sys.executable, "-c", _RETRY, str(tmp_path)], cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))), capture_output=True, text=True, timeout=240)
    assert said.returncode == 0, said.stderr[-2000:]
    assert Counter(n.split("_")[1] for n in os.listdir(tmp_path)) == {"2026-08-01": 1, "2026-08-02": 2, "2026-08-03": 1}


_RETRY = """
import sys
from pyspark.sql import SparkSession
from tests.clients.folder import POINTER
from tidemark.sources import market
with open(POINTER, "w") as file:
    file.write(sys.argv[1])
spark = SparkSession.builder.master("local[2,2]").config("spark.ui.enabled", "false").getOrCreate()
market.register(spark)
options = dict(client="tests.clients.folder:flaky", first="2026-08-01", last="2026-08-03", hubs="TH_NP15_GEN-APND")
assert len(spark.read.format("market_service").options(**options).load().collect()) == 72
"""


def test_load_has_no_hub(spark, calls):
    frame = read(spark, product="load", first="2026-08-01", last="2026-08-02")
    assert frame.where("hub IS NULL").count() == 576 and set(calls()) == {("load", "2026-08-01"), ("load", "2026-08-02")}


def test_a_day_without_rows_is_an_error(spark, calls):
    frame = spark.read.format("market_service").options(client=CLIENT + "away", first="2026-08-01", last="2026-08-02").load()
    with pytest.raises(Exception, match="no observations of 2026-08-02"):
        frame.collect()
    assert spark.read.format("market_service").options(client=CLIENT + "away", first="2026-08-01", last="2026-08-01").load().count() == 72


def test_many_days_are_normalised(spark, calls):
    rows = market.fetch_days(spark, "lmp", date(2026, 8, 1), date(2026, 8, 3), CLIENT + "days", HUBS[:2])
    assert rows.where("size(violations) > 0").count() == 0 and rows.select("logical_key").distinct().count() == rows.count() == 144
    wrong = market.fetch_days(spark, "lmp", date(2026, 8, 1), date(2026, 8, 2), CLIENT + "astray", HUBS[:1])
    found = {(str(r.market_date), tuple(r.violations)): r.n for r in wrong.groupBy("market_date", "violations").agg(F.count("*").alias("n")).collect()}
    assert found == {("2026-08-01", ()): 24, ("2026-08-03", ("not asked for",)): 24}


def test_the_stream_goes_on_where_it_stopped(spark, calls, tmp_path):
    def run(last):
        stream = spark.readStream.format("market_service").options(client=CLIENT + "days", first="2026-08-01", last=last, hubs=HUBS[0]).load()
        query = stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start(str(tmp_path / "out"))
        query.awaitTermination()
        return {str(r.market_date): r["count"] for r in spark.read.parquet(str(tmp_path / "out")).groupBy("market_date").count().collect()}

    assert run("2026-08-02") == {"2026-08-01": 24, "2026-08-02": 24}
    assert run("2026-08-03") == {"2026-08-01": 24, "2026-08-02": 24, "2026-08-03": 24}
    assert calls() == {("lmp", f"2026-08-0{k}"): 1 for k in (1, 2, 3)}


def test_options_are_checked(spark, calls):
    with pytest.raises(ValidationError):
        market._Service({"client": "nobody", "first": "2026-08-01"})
    with pytest.raises(ValidationError):
        market._Service({"client": "a:b", "product": "gas", "first": "2026-08-01"})
