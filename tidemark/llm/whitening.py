"""Whitening of embeddings: principal components by a one-sided Jacobi SVD of what TSQR leaves.

Entries become whole numbers, so means and deviations are exact. Each distinct vector counts once. Every task
centres its vectors before it multiplies anything and keeps one triangle R of them, by QR of the
triangle so far and the next block; triangles of tasks are stacked by ``FAN`` and reduced in the same way, in
Spark, until one is left, which is as large as the vectors are wide, whatever the rows. Rotations of pairs of its columns
make them orthogonal: their product is the components, the columns' lengths are the standard deviations. No
covariance is formed, so small deviations keep their digits.

Defined results: rows whose vector is null, empty, or holds null or non-finite entries are dropped; so are those
of another length than most vectors have. Repeated rows have a row each and count once. Null ids stay null.
A component along which nothing varies (beyond rounding) has ``whitened`` 0 and fails ``identity_error``, which is
then 1. Vectors of fewer than 16 entries have as many components. Entries beyond 2^40 count as 2^40. A ``deviation`` that no
long holds is refused. An empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import slices
from tidemark.llm.vectors import commonest_width, matrix, usable, whole
from tidemark.session import ensure_checkpoint_dir

FACTOR, ADDED, MOST = 64, 1_000_000, 1 << 40
COMPONENTS = 16
#: Triangles that one task of a reduction takes, and that the driver takes.
FAN = 32
#: Bytes of vectors in a block.
BLOCK_BYTES = 4 << 20

_COLUMNS = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - sums / n: the whole part exact, so that nothing is lost to the size of the mean."""
    mean = sums // n
    return (x - mean) - (sums - mean * n) / n


def triangle(blocks: Iterator[np.ndarray]) -> np.ndarray | None:
    """R of all blocks, one after the other."""
    r = None
    for block in blocks:
        r = np.linalg.qr(block if r is None else np.vstack((r, block)), mode="r")
    return r


def _rounds(width: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pairs of columns, each pair once, those of a round without a column in common."""
    ring = list(range(width + width % 2))
    out = []
    for _ in range(len(ring) - 1):
        pairs = [(min(a, b), max(a, b)) for a, b in zip(ring[: len(ring) // 2], ring[::-1]) if max(a, b) < width]
        out.append((np.array([p[0] for p in pairs], int), np.array([p[1] for p in pairs], int)))
        ring = [ring[0], ring[-1], *ring[1:-1]]
    return out


def one_sided_jacobi(r: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """(singular values, falling; right singular vectors as columns) of ``r``.

    Each rotation makes two columns orthogonal; once a sweep finds all pairs orthogonal to rounding, the columns
    are the left vectors times the singular values, and the rotations multiply up to the right vectors."""
    a, v = np.array(r, float), np.eye(r.shape[1])
    rounds, none = _rounds(r.shape[1]), np.finfo(float).tiny
    for _ in range(sweeps):
        largest = 0.0
        for p, q in rounds:
            x, y = a[:, p], a[:, q]
            xx, yy, xy = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            off = np.abs(xy) / np.maximum(np.sqrt(xx * yy), none)
            turn = off > 1e-16
            largest = max(largest, float(off.max(initial=0)))
            zeta = (yy - xx) / np.where(turn, 2 * xy, 1)
            t = np.where(zeta < 0, -1, 1) / (np.abs(zeta) + np.hypot(1, zeta))
            c = np.where(turn, 1 / np.sqrt(1 + t * t), 1.0)
            s = np.where(turn, c * t, 0.0)
            for m in (a, v):
                left, right = m[:, p].copy(), m[:, q].copy()
                m[:, p], m[:, q] = c * left - s * right, s * left + c * right
        if largest < 1e-15:
            break
    sigma = np.sqrt((a * a).sum(0))
    order = np.argsort(-sigma, kind="stable")
    v = v[:, order]
    # Either sign is right; the entry of largest size is made positive, so that a run equals the next.
    return sigma[order], v * np.where(v[np.abs(v).argmax(0), np.arange(v.shape[1])] < 0, -1.0, 1.0)


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[np.ndarray]:
    for rows in batches:
        for part in slices(rows, BLOCK_BYTES):
            yield matrix(part.column(0), width)


def tsqr(x: DataFrame, n: int, sums: np.ndarray, fan: int = FAN) -> np.ndarray:
    """R of the centred vectors of column x."""
    width = len(sums)
    types = "task bigint, r binary"

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = triangle(_centred(b, n, sums) for b in _blocks(batches, width))
        if r is not None:
            yield pa.RecordBatch.from_pydict({"task": [TaskContext.get().partitionId()], "r": [r.tobytes()]})

    def of_few(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        r = triangle(np.frombuffer(b).reshape(-1, width) for b in rows.sort_by("task").column("r").to_pylist())
        return pa.table({"task": [key[0].as_py()], "r": [r.tobytes()]})

    rs = x.mapInArrow(of_task, types).checkpoint()
    while rs.count() > fan:
        rs = rs.withColumn("task", F.floor(F.col("task") / fan)).groupBy("task").applyInArrow(of_few, types).checkpoint()
    return triangle(np.frombuffer(r["r"]).reshape(-1, width) for r in rs.orderBy("task").collect())


def _moments(x: DataFrame, n: int, sums: np.ndarray, onto: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and mean product of the projections on the columns of ``onto``."""
    count, width = onto.shape[1], len(sums)

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((count + 1, count))
        for block in _blocks(batches, width):
            w = _centred(block, n, sums) @ onto
            total += np.vstack((w.T @ w, w.sum(0)))
        yield pa.RecordBatch.from_pydict({"at": np.arange(total.size, dtype=np.int32), "v": total.ravel()})

    rows = x.mapInArrow(of_task, "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).collect()
    total = np.zeros((count + 1) * count)
    for r in rows:
        total[r["at"]] = r["v"]
    total = total.reshape(count + 1, count) / n
    return total[-1], total[:-1]


def _exact_deviations(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    far = n * np.abs(x - sums / n).max(initial=0) + n
    if far * far * x.shape[1] < 2.0**62:
        d = n * (x - sums // n) - sums % n
        return np.einsum("ij,ij->i", d, d)
    exact = [sum((n * int(c) - int(s)) ** 2 for c, s in zip(row, sums, strict=True)) for row in x]
    if max(exact) >= 1 << 63:
        raise OverflowError("a deviation is beyond a long")
    return np.array(exact, np.int64)


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """A row for each usable row of ``embeddings`` (vec_id, embedding) and component."""
    spark: SparkSession = embeddings.sparkSession
    ensure_checkpoint_dir(spark)
    kept = embeddings.where(usable()).select(F.col("vec_id").cast("bigint").alias("vec_id"), whole("embedding", FACTOR, ADDED, MOST).alias("x"))
    width = commonest_width(kept, "x")
    if width is None:
        return spark.createDataFrame([], _COLUMNS)
    kept = kept.where(F.size("x") == width)
    distinct = kept.select("x").distinct().checkpoint()
    n, *totals = distinct.agg(F.count("x"), *[F.sum(F.col("x")[k]) for k in range(width)]).first()
    sums = np.array(totals, np.int64)
    sigma, v = one_sided_jacobi(tsqr(distinct, n, sums))
    # Fewer vectors than entries leave fewer rows of R, but as many columns.
    variances = sigma**2 / n
    count = min(components, width)
    flat = sigma[:count] <= 1e-12 * max(sigma[0], 1e-300)
    onto = v[:, :count] * np.where(flat, 0.0, 1 / np.sqrt(np.where(flat, 1.0, variances[:count])))
    mean, products = _moments(distinct, n, sums, onto)
    error = float(np.abs(products - np.outer(mean, mean) - np.eye(count)).max())
    explained = variances[:count] / (variances.sum() or 1.0)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for part in slices(rows, BLOCK_BYTES):
                x, m = matrix(part.column(1), width), part.num_rows
                whitened = _centred(x, n, sums) @ onto
                ids = part.column(0).take(pa.array(np.repeat(np.arange(m), count)))
                numbers = [np.tile(np.arange(1, count + 1, dtype=np.int32), m), np.full(m * count, n), np.repeat(_exact_deviations(x, n, sums), count), whitened.ravel(), np.tile(explained, m), np.full(m * count, error)]
                yield pa.RecordBatch.from_arrays([ids, *map(pa.array, numbers)], names=[f.split()[0] for f in _COLUMNS.split(", ")])

    return kept.mapInArrow(project, _COLUMNS)
