"""Distinct counts that are stored and merged: bitmaps of whole numbers, one for each slice and stretch of 32,768 numbers.

Bitmaps of parts of a slice are merged by OR, so rows that were counted once need not be read again, and a coarser
level's count comes from the bitmaps of finer ones. They are exact. A stretch with any number takes 4 KB, so numbers should
be dense (ids, positions); a text is numbered first. Nulls are rows, but no distinct value.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Columns beside a slice's levels: the stretch (null: rows without a number), its rows and its bitmap.
STORED = ("bucket", "n", "bits")


def bitmaps(frame: DataFrame, levels: dict[str, Column], value: Column) -> DataFrame:
    """A row for each slice and stretch. Levels may not be named as the stored columns are."""
    if clash := sorted(set(levels) & set(STORED)):
        raise ValueError(f"levels named as stored columns: {', '.join(clash)}")
    rows = frame.select(*[c.alias(n) for n, c in levels.items()], value.cast("bigint").alias("__value"))
    number = F.col("__value")
    return rows.groupBy(*levels, F.bitmap_bucket_number(number).alias("bucket")).agg(F.count("*").alias("n"), F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits"))


def merged(parts: list[DataFrame], levels: list[str]) -> DataFrame:
    """Bitmaps of all parts, at the given levels or coarser ones."""
    rows = reduce(DataFrame.unionByName, [p.select(*levels, *STORED) for p in parts])
    return rows.groupBy(*levels, "bucket").agg(F.sum("n").alias("n"), F.bitmap_or_agg("bits").alias("bits"))


def counts(stored: DataFrame, levels: list[str]) -> DataFrame:
    """(levels, n, distinct_n) of stored bitmaps, whatever finer levels they have."""
    return merged([stored], levels).groupBy(*levels).agg(F.sum("n").alias("n"), F.sum(F.when(F.col("bucket").isNotNull(), F.bitmap_count("bits")).otherwise(0)).alias("distinct_n"))
