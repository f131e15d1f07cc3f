"""Running values of ordered series, with a series of any length over as many tasks as it needs.

A window by key puts all rows of a key in one task. Here rows are dealt by ranges of (key, order), so a long
series lies in several neighbouring blocks, and only the last series of a block can go on in the next one. Each
block therefore has one summary; what stands before a block is folded from the summaries, one row a block, and a
pass within blocks does the rest.

    blocks = Blocks(frame, ["user_id"], ["event_id"])
    blocks.running_sum(F.col("step"))    # sums
    blocks.previous("state")             # neighbours, changes, ordinals
    blocks.clamped("step", 0, 40, 20)    # a state that stays within bounds

Rows of one key must differ in their order columns, or their order among themselves is Spark's choice. Nulls are
keys and order values like others, and come first. The frame is written once, to the checkpoint folder, as ranges
must be the same in every pass.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from tidemark.session import ensure_checkpoint_dir

BLOCK, FIRST, LAST = "__block", "__first", "__last"


class Blocks:
    """Rows in ranges of (key, order), each range a block."""

    def __init__(self, frame: DataFrame, keys: list[str], order: list[str], count: int | None = None):
        ensure_checkpoint_dir(frame.sparkSession)
        self.columns, self.keys, self.order = frame.columns, keys, order
        n = count or int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        ranged = frame.repartitionByRange(n, *keys, *order).sortWithinPartitions(*keys, *order)
        self.rows = ranged.withColumn(BLOCK, F.spark_partition_id()).checkpoint()
        key = F.struct(*keys)
        self.ends = self.rows.groupBy(BLOCK).agg(F.min(key).alias(FIRST), F.max(key).alias(LAST)).orderBy(BLOCK).collect()

    def _carried(self, summary: Column, fold: Callable[[Any, Any], Any]) -> dict[int, Any]:
        """What stands before each block: the fold of the summaries that its first series has in earlier blocks."""
        if len(self.ends) < 2:
            return {}
        spark = self.rows.sparkSession
        last = spark.createDataFrame([(r[BLOCK], r[LAST]) for r in self.ends], StructType().add(BLOCK, IntegerType()).add(LAST, self.rows.select(F.struct(*self.keys).alias("k")).schema["k"].dataType))
        tail = self.rows.join(F.broadcast(last), BLOCK).where(F.struct(*self.keys).eqNullSafe(F.col(LAST)))
        return self._fold({r[BLOCK]: r["s"] for r in tail.groupBy(BLOCK).agg(summary.alias("s")).collect()}, fold)

    def _fold(self, made: dict[int, Any], fold: Callable[[Any, Any], Any]) -> dict[int, Any]:
        out: dict[int, Any] = {}
        for before, own in zip(self.ends, self.ends[1:]):
            if own[FIRST] == before[LAST]:
                whole = before[FIRST] == before[LAST] and before[BLOCK] in out
                out[own[BLOCK]] = fold(out[before[BLOCK]], made[before[BLOCK]]) if whole else made[before[BLOCK]]
        return out

    def _with(self, carried: dict[int, Any], kind: Any, rows: DataFrame | None = None) -> DataFrame:
        """Rows with what is carried to them: the block's value for its first series, null for all others."""
        first = {r[BLOCK]: r[FIRST] for r in self.ends}
        schema = StructType().add(BLOCK, IntegerType()).add(FIRST, self.rows.select(F.struct(*self.keys).alias("k")).schema["k"].dataType).add("__carried", kind)
        table = self.rows.sparkSession.createDataFrame([(b, first[b], v) for b, v in carried.items()], schema)
        rows = self.rows if rows is None else rows
        # A row a block at most.
        joined = rows.join(F.broadcast(table), BLOCK, "left")
        return joined.withColumn("__carried", F.when(F.struct(*self.keys).eqNullSafe(F.col(FIRST)), F.col("__carried"))).drop(FIRST)

    def _own(self) -> W:
        return W.partitionBy(BLOCK, *self.keys).orderBy(*self.order)

    def running_sum(self, value: Column, name: str = "total", rows: DataFrame | None = None) -> DataFrame:
        """The frame's rows with the sum of ``value`` over their key's rows up to theirs, nulls being nothing; null
        before the first value. ``rows`` are the blocks' rows with further columns, if ``value`` needs them."""
        source = self.rows if rows is None else rows
        kind = source.select(F.sum(value).alias("v")).schema["v"].dataType
        tails = self if rows is None else self._on(rows)
        carried = tails._carried(F.sum(value), lambda a, b: a if b is None else b if a is None else a + b)
        total = F.sum(value).over(self._own().rowsBetween(W.unboundedPreceding, 0))
        added = F.when(F.col("__carried").isNull(), total).otherwise(F.col("__carried") + F.coalesce(total, F.lit(0)))
        return self._with(carried, kind, source).withColumn(name, added.cast(kind)).drop("__carried")

    def _on(self, rows: DataFrame) -> Blocks:
        """These blocks over rows with more columns."""
        made = object.__new__(Blocks)
        made.columns, made.keys, made.order, made.rows, made.ends = rows.columns, self.keys, self.order, rows, self.ends
        return made

    def previous(self, *columns: str, prefix: str = "before_") -> DataFrame:
        """The rows with ``columns`` of the row before, null for a key's first, and whether there is one (``has_before``)."""
        packed = F.struct(*columns)
        kind = self.rows.select(packed.alias("v")).schema["v"].dataType
        carried = self._carried(F.max_by(packed, F.struct(*self.order)), lambda _, b: b)
        found = F.coalesce(F.lag(packed).over(self._own()), F.col("__carried"))
        out = self._with(carried, kind).withColumn("__carried", found)
        return out.withColumns({f"{prefix}{c}": F.col("__carried")[c] for c in columns} | {"has_before": F.col("__carried").isNotNull()}).drop("__carried")

    def transitions(self, column: str, ordinal: str = "ordinal") -> DataFrame:
        """The rows whose ``column`` differs from the row before, numbered within their key. A null is a value."""
        rows = self.previous(column)
        changed = ~F.col("has_before") | ~F.col(column).eqNullSafe(F.col(f"before_{column}"))
        rows = rows.withColumn("__changed", changed.cast("bigint"))
        return self.running_sum(F.col("__changed"), ordinal, rows).where("__changed = 1").select(*self.columns, ordinal)

    def clamped(self, step: str, low: int, high: int, start: int, name: str = "state") -> DataFrame:
        """The rows with a state that begins at ``start`` for each key, moves by ``step`` (a long, null being 0) and
        stays within its bounds.

        One move is the map x -> min(high, max(low, x + step)). Such maps, with bounds of their own, are closed
        under composition, so moves are composed by doubling within a batch and from block to block."""
        columns, keys = [*self.columns, BLOCK], self.keys
        summary = f"{BLOCK} int, moves array<bigint>"

        def of_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            last, block = None, None
            for rows, heads, _ in _series(batches, keys):
                begin = int(np.flatnonzero(heads)[-1]) if heads.any() else 0
                c, lo, hi = _composed(_steps(rows, step)[begin:], np.arange(len(heads) - begin) == 0, low, high)
                end = (int(c[-1]), int(lo[-1]), int(hi[-1]))
                last = end if heads.any() or last is None else compose(last, end)
                block = rows.column(BLOCK)[0].as_py()
            if block is not None:
                yield pa.RecordBatch.from_pydict({BLOCK: pa.array([block], pa.int32()), "moves": [list(last)]})

        made = {r[BLOCK]: tuple(r["moves"]) for r in self.rows.select(*columns).mapInArrow(of_block, summary).collect()} if len(self.ends) > 1 else {}
        before = {b: apply(f, start) for b, f in self._fold(made, compose).items()}
        types = StructType([*(self.rows.schema[c] for c in self.columns), *StructType.fromDDL(f"{name} bigint").fields])

        def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            state = None
            for rows, heads, goes_on in _series(batches, keys):
                entry = state if goes_on else before.get(rows.column(BLOCK)[0].as_py(), start) if state is None else start
                c, lo, hi = _composed(_steps(rows, step), heads, low, high)
                first = np.cumsum(heads) <= heads[0]  # rows before the second series of this batch
                x = np.where(first, entry, start)
                values = np.minimum(hi, np.maximum(lo, x + c))
                state = int(values[-1])
                yield pa.RecordBatch.from_arrays([*(rows.column(n) for n in self_columns), pa.array(values)], names=[*self_columns, name])

        self_columns = list(self.columns)
        return self.rows.select(*columns).mapInArrow(within, types)


def compose(f: tuple, g: tuple) -> tuple:
    """First f, then g, each (added, low, high)."""
    return f[0] + g[0], min(max(f[1] + g[0], g[1]), g[2]), min(max(f[2] + g[0], g[1]), g[2])


def apply(f: tuple, x: int) -> int:
    return min(f[2], max(f[1], x + f[0]))


def _steps(rows: pa.RecordBatch, step: str) -> np.ndarray:
    return pc.fill_null(rows.column(rows.schema.get_field_index(step)), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def _series(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, bool]]:
    """Batches of one block with the rows at which a series begins, and whether the first one goes on from before."""
    last = None
    for rows in batches:
        if not rows.num_rows:
            continue
        heads = np.zeros(rows.num_rows, bool)
        for key in keys:
            column = rows.column(rows.schema.get_field_index(key))
            a, b = column[:-1], column[1:]
            heads[1:] |= pc.or_(pc.fill_null(pc.not_equal(a, b), False), pc.xor(a.is_null(), b.is_null())).to_numpy(zero_copy_only=False)
        own = [[rows.column(rows.schema.get_field_index(k))[at].as_py() for k in keys] for at in (0, -1)]
        goes_on = last is not None and own[0] == last
        heads[0] = last is not None and not goes_on
        yield rows, heads, goes_on
        last = own[1]


def _composed(step: np.ndarray, heads: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each row the composition of the moves from its series' first row in this batch, by doubling."""
    c, lo, hi, stop = step.copy(), np.full(len(step), low, np.int64), np.full(len(step), high, np.int64), heads.copy()
    by = 1
    while by < len(c) and not stop[by:].all():
        go = ~stop[by:]
        c2, lo2, hi2 = c[by:], lo[by:], hi[by:]
        lo[by:], hi[by:] = (np.where(go, np.minimum(np.maximum(x[:-by] + c2, lo2), hi2), y) for x, y in ((lo, lo2), (hi, hi2)))
        c[by:] = np.where(go, c[:-by] + c2, c2)
        stop[by:] |= stop[:-by]
        by *= 2
    return c, lo, hi
