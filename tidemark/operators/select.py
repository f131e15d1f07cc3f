"""Exact order statistics by counting: no task and no driver ever holds the values.

Every pass asks a bounded sketch for two values that should lie close around the wanted rank, counts exactly what is below,
at, between and beyond them, and goes on within the part that holds the rank. The sketch only proposes; the
counts decide. As the values proposed are taken out of what is left, each pass makes it smaller.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Below so many values left they are sorted, and one is taken.
FEW = 10_000
#: A sketch is off by one part in so many.
ACCURACY = 100_000


def kth(frame: DataFrame, value: Column, k: int, few: int = FEW, accuracy: int = ACCURACY):
    """The value of rank ``k`` (from 0) among those that are not null."""
    rows = frame.select(value.alias("v")).where("v IS NOT NULL")
    total = rows.count()
    if not 0 <= k < total:
        raise IndexError(f"there are {total} values")
    while total > few:
        share = max(1.0 / accuracy, 2.0 / total)
        near = [min(1.0, max(0.0, (k + 0.5) / total + by * share)) for by in (-1, 1)]
        low, high = rows.agg(F.percentile_approx("v", near, accuracy)).first()[0]
        n = rows.agg(*[F.count_if(c) for c in (F.col("v") < low, F.col("v") == low, (F.col("v") > low) & (F.col("v") < high), F.col("v") == high)]).first()
        parts = [(n[0], F.col("v") < low, None), (n[1], None, low), (n[2], (F.col("v") > low) & (F.col("v") < high), None), (n[3] if high > low else 0, None, high), (total, F.col("v") > high, None)]
        for count, part, found in parts:
            if k < count:
                break
            k -= count
        if part is None:
            return found
        total = count if count != total else total - sum(p[0] for p in parts[:4])
        rows = rows.where(part)
    return rows.orderBy("v").offset(k).limit(1).first()["v"]


def median(frame: DataFrame, value: Column, few: int = FEW):
    """The middle value, or the mean of the two in the middle, as a double; None without values. Nulls don't count."""
    n = frame.agg(F.count(value)).first()[0]
    if not n:
        return None
    low = kth(frame, value, (n - 1) // 2, few)
    if n % 2:
        return float(low)
    up_to, above = frame.agg(F.count_if(value <= low), F.min(F.when(value > low, value))).first()
    return float(low) if up_to > n // 2 else (float(low) + float(above)) / 2
