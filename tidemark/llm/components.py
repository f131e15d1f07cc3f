"""Connected components of links that stay in Spark: alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import ensure_checkpoint_dir


#: Nodes with so many neighbours that they are joined for themselves: at most this many, whatever the input.
HEAVY, LEAST = 4096, 1000


def _toward_minimum(pairs: DataFrame, total: int) -> DataFrame:
    """Pairs (u, v) with m, the least of u and all its v.

    The minimum is aggregated before it is shuffled. To come back to the pairs it is joined, and a node with very
    many neighbours would be one task there. A node of more than ``2 total / HEAVY`` pairs, of which there are at
    most ``HEAVY / 2``, is therefore looked up in a broadcast table of at most so many rows; only pairs of the
    others are shuffled by u.
    """
    least = pairs.groupBy("u").agg(F.min("v").alias("m"), F.count("v").alias("n")).withColumn("m", F.least("u", "m"))
    heavy = F.col("n") > max(LEAST, 2 * total // HEAVY)
    broad = F.broadcast(least.where(heavy).select("u", F.col("m").alias("h")))
    looked = pairs.join(broad, "u", "left")
    light = looked.where("h is null").select("u", "v").join(least.where(~heavy).select("u", "m"), "u")
    return looked.where("h is not null").select("u", "v", F.col("h").alias("m")).unionByName(light)


def components(links: DataFrame) -> DataFrame:
    """``links``: columns a and b. Returns (node, root) for each node that has a link to another, root
    being the smallest node of its component.

    Each round is written to the checkpoint folder, so lost executors cost at most a round; rounds grow
    with the logarithm of the longest chain. Links of a node to itself and repeated links are harmless.
    """
    ensure_checkpoint_dir(links.sparkSession)
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct().checkpoint()
    before, total = None, edges.count()
    while total:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _toward_minimum(both, 2 * total).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct().checkpoint()
        small = _toward_minimum(large, total)
        small = small.select("u", F.col("m").alias("v")).unionByName(small.select(F.col("v").alias("u"), F.col("m").alias("v")))
        edges = small.where("u <> v").distinct().checkpoint()
        now = total, _ = tuple(edges.agg(F.count("u"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
