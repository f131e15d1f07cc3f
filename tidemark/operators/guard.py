"""A cap on what a plan may read, and a guard of output places, both checked before anything runs."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame

from tidemark.errors import StoreError

MOST_BYTES = 100 << 20


def planned_bytes(frame: DataFrame) -> int:
    """Bytes that the optimised plan's scans read, as Spark estimates them. Rows that the driver made have
    no estimate but Spark's default, and don't count."""
    unknown = frame.sparkSession._jsparkSession.sessionState().conf().defaultSizeInBytes()
    leaves = frame._jdf.queryExecution().optimizedPlan().collectLeaves()
    total = 0
    for k in range(leaves.size()):
        size = int(str(leaves.apply(k).stats().sizeInBytes()))
        total += size if size < unknown else 0
    return total


def within(frame: DataFrame, most: int = MOST_BYTES) -> DataFrame:
    """The frame, if its scans stay within ``most`` bytes."""
    if (size := planned_bytes(frame)) > most:
        raise StoreError(f"the plan reads about {size} bytes; the cap is {most}")
    return frame


def distinct_places(raw: str, analytics: str) -> None:
    """Analytics must not be written where raw tables are, nor inside or around that place."""

    def plain(path: str) -> str:
        return path.rstrip("/") if "://" in path else os.path.realpath(path)

    a, b = plain(raw), plain(analytics)
    if a == b or a.startswith(b + "/") or b.startswith(a + "/"):
        raise StoreError("analytics must have a place apart from the raw tables")
