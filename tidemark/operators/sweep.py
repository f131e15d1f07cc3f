"""Gaps and overlaps of intervals of any length, by a sweep over their ends.

Each interval is a step up and a step down; the running sum of steps is how many intervals cover the stretch to the
next end. Stretches that nothing covers are gaps, those covered twice or more are overlaps; neighbouring stretches of one kind
are one. Running sums are those of ``scan``, so a series may be of any length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.scan import Blocks


def coverage(intervals: DataFrame, bounds: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """(keys, kind, start, end) of the longest stretches within ``bounds`` (keys, start, end; one row a key) that no interval
    covers (``gap``) or several do (``overlap``). Intervals are closed at the start and open at the end; those that are empty, reversed or
    without an end count for nothing, as do keys without bounds."""
    own = bounds.select(*keys, F.col(start).alias("__from"), F.col(end).alias("__to"))
    cut = intervals.join(own, keys).select(*keys, F.greatest(start, "__from").alias("s"), F.least(end, "__to").alias("e"), F.col(start).alias("__s"), F.col(end).alias("__e"))
    cut = cut.where("s < e AND __s IS NOT NULL AND __e IS NOT NULL")
    inside = cut.select(*keys, F.explode(F.array(F.struct(F.col("s").alias("t"), F.lit(1).alias("by")), F.struct(F.col("e").alias("t"), F.lit(-1).alias("by")))).alias("x"))
    ends = own.where("__from < __to").select(*keys, F.explode(F.array(F.struct(F.col("__from").alias("t"), F.lit(0).alias("by")), F.struct(F.col("__to").alias("t"), F.lit(0).alias("by")))).alias("x"))
    steps = inside.unionByName(ends).select(*keys, "x.t", "x.by").groupBy(*keys, "t").agg(F.sum("by").alias("by"))
    blocks = Blocks(steps, keys, ["t"])
    depth = blocks.running_sum(F.col("by"), "depth").withColumn("kind", F.when(F.col("depth") == 0, "gap").when(F.col("depth") > 1, "overlap").otherwise("covered"))
    # A stretch begins where the kind changes and ends where it changes next.
    turns = Blocks(depth.select(*keys, "t", "kind"), keys, ["t"]).transitions("kind", "turn")
    following = turns.select(*keys, (F.col("turn") - 1).alias("turn"), F.col("t").alias("until"))
    found = turns.join(following, [*keys, "turn"], "left").join(own, keys)
    out = found.where("kind <> 'covered' AND t < __to").select(*keys, "kind", F.col("t").alias(start), F.coalesce("until", "__to").alias(end))
    return out
