"""Small typed tables of parameters, writes that count what they write, and loads that replace dates."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def parameters(spark: SparkSession, rows: Iterable[tuple], schema: StructType) -> DataFrame:
    """Parameters as a table of the given types, also when there are none; another type, or a null where none may
    be, is an error."""
    return spark.createDataFrame(list(rows), schema, verifySchema=True)


def write_counted(frame: DataFrame, path: str, mode: str = "errorifexists", **figures: Column) -> dict[str, object]:
    """Writes Parquet and returns the rows' number, as ``n``, and other aggregates, observed by the job that writes."""
    seen = Observation()
    frame.observe(seen, F.count(F.lit(1)).alias("n"), *[c.alias(name) for name, c in figures.items()]).write.mode(mode).parquet(path)
    return {"n": 0, **dict.fromkeys(figures)} | seen.get


def replace_partitions(frame: DataFrame, path: str, column: str) -> None:
    """Replaces the values of ``column`` that the frame has, whole; others stay as they are. A job that fails changes nothing
    that readers see before its commit, and running it again gives the same. Rows are dealt by the column so that a value
    is few files, and a value with a great share of the rows is split over tasks."""
    frame.hint("rebalance", column).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)
