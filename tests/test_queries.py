"""Every query with SQL equals it in DuckDB at the smallest scale; plans keep their promises."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from tidemark.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    connection = duckdb.connect()
    connection.sql("SET TimeZone='UTC'")
    for t in TABLES:
        connection.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return connection


def plain(x):
    return ("nan" if math.isnan(x) else f"{x:.9g}") if isinstance(x, float) else str(x)


@pytest.mark.parametrize("name", sorted(registry.oracles()))
def test_equals_sql(spark, sf, duck, name):
    frame, sql = registry.queries()[name](spark, sf), duck.sql(registry.oracles()[name])
    columns = sorted(frame.columns)
    assert columns == sorted(sql.columns)
    got = sorted(tuple(map(plain, r)) for r in frame.select(*columns).collect())
    assert got == sorted(tuple(map(plain, r)) for r in sql.project(", ".join(f'"{c}"' for c in columns)).fetchall())


def test_others_run(spark, sf):
    for name in set(registry.queries()) - set(registry.oracles()):
        assert registry.queries()[name](spark, sf).count() >= 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(registry.queries()) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def plan(frame):
    """The formatted plan, which names pushed filters in full."""
    return frame.sparkSession._jvm.PythonSQLUtils.explainString(frame._jdf.queryExecution(), "formatted")


def test_filters_and_columns_reach_the_scan(spark, sf):
    from tidemark.plans import relational

    text = plan(relational.bounded_range_read(spark, sf))
    assert "GreaterThanOrEqual(o_orderdate" in text and "In(o_orderpriority" in text and "o_totalprice" not in text
    assert "WindowGroupLimit" in plan(relational.current_state_latest(spark, sf))
    assert "TakeOrderedAndProject" in plan(relational.recent_runs_topk(spark, sf))
    assert "Subquery:1" in plan(relational.incremental_candidates(spark, sf)).replace(" ", "")
    for name, f in relational.QUERIES.items():
        assert "CartesianProduct" not in plan(f(spark, sf)), name


def test_workers_find_the_package(spark):
    from tidemark.session import make_importable

    make_importable(spark)
    make_importable(spark)
    paths = spark.sparkContext.environment["PYTHONPATH"].split(os.pathsep)
    assert paths.count(os.path.dirname(entry.__file__)) == 1
