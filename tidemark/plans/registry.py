"""All queries over the driver's tables, and the SQL that each is compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans import checks, generated, load, market, relational, series

_MODULES = (relational, market, generated, load, series, checks)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for m in _MODULES for name, f in m.QUERIES.items()}


def oracles() -> dict[str, str]:
    return {name: sql for m in _MODULES for name, sql in m.ORACLES.items()}
