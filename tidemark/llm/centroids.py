"""Centroid clustering over distinct vectors with multiplicities, in whole numbers.

Vectors are quantised first, so many rows share one. They are grouped once, each distinct vector with its
number of rows, and every round of Lloyd's algorithm reads the distinct vectors only: a task assigns its vectors and sends
for each cluster the weighted sums of its entries, whole numbers that Spark adds up in any order to the same
centroids. Last, assignments are joined back to the rows by the vector; where one vector has a large part of
all rows, Spark splits that partition of the join.

What reaches the driver in a round is a sum for each cluster and dimension.

Defined results: vectors of another length than ``width``, null ones and those with null or non-finite entries are
dropped. First centroids are the rows with the smallest hashes; rows of one id, or without an id (their hash is null and
comes last), are taken by their vectors; fewer rows than clusters make fewer clusters. Equal rows may give
equal centroids, of which the first gets all vectors. A cluster without vectors keeps its centroid. Repeated rows have a row
each. Entries beyond 2^27 count as 2^27, so that every distance is a long. An empty table gives none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import slices
from tidemark.llm.vectors import matrix, usable, whole
from tidemark.session import ensure_checkpoint_dir

WIDTH, FACTOR, CLUSTERS, ROUNDS, SEED, MOST = 64, 1024, 8, 10, 3, 1 << 27
BLOCK_BYTES = 4 << 20

_COLUMNS = "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cluster, squared distance) of each row of ``x``; of equal distances the smaller number."""
    far = np.empty((len(centroids), len(x)), np.int64)
    for k, c in enumerate(centroids):
        d = x - c
        far[k] = np.einsum("ij,ij->i", d, d)
    cluster = far.argmin(0)
    return cluster, far[cluster, np.arange(len(x))]


def _weighted_sums(distinct: DataFrame, centroids: np.ndarray) -> dict[tuple[int, int], int]:
    """Sums of the clusters' entries over all rows, and at dimension -1 their rows."""
    count, width = centroids.shape

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            total = np.zeros((count, width + 1), np.int64)
            for part in slices(rows, BLOCK_BYTES):
                x, weight = matrix(part.column(0), width), part.column(1).to_numpy()
                cluster, _ = nearest(x, centroids)
                for k in np.unique(cluster).tolist():
                    own = cluster == k
                    total[k, 1:] += weight[own] @ x[own]
                    total[k, 0] += weight[own].sum()
            k, at = np.nonzero(np.repeat(total[:, :1] > 0, width + 1, axis=1))
            yield pa.RecordBatch.from_pydict({"cluster": k.astype(np.int32), "at": (at - 1).astype(np.int32), "s": total[k, at]})

    # The sums are decimals: a task's are longs, all tasks' together need not be.
    rows = distinct.select("x", "weight").mapInArrow(of_task, "cluster int, at int, s bigint").groupBy("cluster", "at").agg(F.sum(F.col("s").cast("decimal(28,0)")).alias("s")).collect()
    return {(r["cluster"], r["at"]): int(r["s"]) for r in rows}


def lloyd(distinct: DataFrame, centroids: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """The centroids after so many rounds over vectors x with their weights."""
    centroids = centroids.copy()
    for _ in range(rounds):
        before, sums = centroids.copy(), _weighted_sums(distinct, centroids)
        for k in range(len(centroids)):
            if weight := sums.get((k, -1), 0):
                centroids[k] = [sums[k, at] // weight for at in range(centroids.shape[1])]
        if (before == centroids).all():
            break  # all further rounds would change nothing
    return centroids


def first_centroids(kept: DataFrame, clusters: int = CLUSTERS, seed: int = SEED) -> np.ndarray:
    """The vectors of the rows whose ids have the smallest hashes."""
    hashed = kept.select(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256).alias("h"), "x")
    rows = hashed.orderBy(F.asc_nulls_last("h"), "x").limit(clusters).collect()
    return np.array([r["x"] for r in rows], np.int64)


def cluster(embeddings: DataFrame, width: int = WIDTH, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED) -> DataFrame:
    """A row for each row of ``embeddings`` (vec_id, embedding) with a usable vector."""
    spark: SparkSession = embeddings.sparkSession
    ensure_checkpoint_dir(spark)
    kept = embeddings.where(usable() & (F.size("embedding") == width)).select(F.col("vec_id").cast("bigint").alias("vec_id"), whole("embedding", FACTOR, 0, MOST).alias("x"))
    start = first_centroids(kept, clusters, seed)
    if not len(start):
        return spark.createDataFrame([], _COLUMNS)
    distinct = kept.groupBy("x").agg(F.count("*").alias("weight")).checkpoint()
    centroids = lloyd(distinct, start, rounds)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for part in slices(rows, BLOCK_BYTES):
                own, far = nearest(matrix(part.column(0), width), centroids)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(own.astype(np.int32)), pa.array(far)], names=["x", "weight", "cluster", "distance"])

    assigned = distinct.select("x", "weight").mapInArrow(assign, "x array<bigint>, weight bigint, cluster int, distance bigint")
    shares = {r["cluster"]: r["s"] for r in assigned.groupBy("cluster").agg(F.sum(F.col("weight") * F.col("distance")).alias("s")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    # A row a cluster, so the table that is broadcast has no more than ``clusters`` of them.
    about = spark.createDataFrame([(k, s, sum(shares.values()), digests[k]) for k, s in shares.items()], "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    back = kept.join(assigned.select("x", "cluster", "distance"), "x").drop("x")
    return back.join(F.broadcast(about), "cluster").select(*[f.split()[0] for f in _COLUMNS.split(", ")])
