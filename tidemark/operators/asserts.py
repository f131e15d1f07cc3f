"""Assertions that are part of a plan: a job that meets an offence fails with its message."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def each(frame: DataFrame, rule: Column, message: str) -> DataFrame:
    """The rows; the first that breaks the rule (a null breaks it) ends the job."""
    return frame.where(F.when(F.coalesce(rule, F.lit(False)), F.lit(True)).otherwise(F.raise_error(F.lit(message)).cast("boolean")))


def all_of(frame: DataFrame, rule: Column, over: DataFrame, message: str) -> DataFrame:
    """The rows, if an aggregate of ``over`` holds: a statement's row count, a sum. It is a subquery of the plan."""
    holds = over.agg(F.coalesce(rule, F.lit(False)).alias("holds")).scalar()
    return frame.where(F.when(holds, F.lit(True)).otherwise(F.raise_error(F.lit(message)).cast("boolean")))
