"""What several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Bytes table that lower-cases A-Z and leaves every other byte, so also UTF-8, as it is.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: str | Column, folds: int = 5) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    key = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(key.cast("string")) % folds


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """True where the fold is 0; false for a null id, which is never learned from either."""
    return F.coalesce(fold(doc_id) == 0, F.lit(False))


def below(hash_: Column, most: int, count: int) -> Column:
    """True for about twice ``most`` of ``count`` rows, those with the smallest hashes; for all if there
    are not so many. A sample of the ``most`` smallest then takes no more than these from the tasks,
    however many tasks there are."""
    return hash_ <= F.lit(largest(most, count))


def largest(most: int, count: int) -> int:
    """The bound of ``below``: of ``count`` signed hashes about twice ``most`` are not above it."""
    if count <= 2 * most:
        return (1 << 63) - 1
    return int(2 * most / count * 2.0**64) - (1 << 63)


def fresh(frame: DataFrame, *names: str) -> list[str]:
    """Names for helper columns that the frame doesn't have, whatever their case."""
    taken, out = {c.lower() for c in frame.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


#: Rows of a few numbers or short texts that a broadcast may have.
MOST_BROADCAST = 1_000_000


def broadcast_if_small(frame: DataFrame, most: int | None = None) -> DataFrame:
    """The frame, marked for broadcast only if its rows have been counted and are no more than ``most``. Beyond that
    Spark joins it by its keys. What is costly to work out twice should come from a checkpoint."""
    most = MOST_BROADCAST if most is None else most
    return F.broadcast(frame) if frame.limit(most + 1).count() <= most else frame


def bytes_of(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column; Arrow holds them already, so nothing is re-encoded."""
    if pa.types.is_large_string(column.type):
        return column.cast(pa.large_binary()).to_pylist()
    return column.cast(pa.string()).cast(pa.binary()).to_pylist()


#: Bytes of Arrow data that one step of a Python worker works on; a longer single row goes alone.
SLICE_BYTES = 8 << 20


def annotate(
    docs: DataFrame, columns: list[str], added: str, of: Callable[[], Callable[[pa.RecordBatch], Iterable[pa.Array]]], most: int = SLICE_BYTES, read: tuple[str, ...] = ("text",)
) -> DataFrame:
    """``columns`` of ``docs`` without those in ``read`` and, behind them, the columns ``added`` (DDL), made from
    ``most`` bytes at a time.

    ``of`` is called once in each task and returns the function of a batch, which has all of ``columns``: what
    it loads stays in the worker and never travels with the plan, and what was only read doesn't travel back.
    Nothing is shuffled.
    """
    picked = docs.select(*columns)
    carried = [k for k, c in enumerate(columns) if c not in read]
    types = StructType([*(picked.schema[k] for k in carried), *StructType.fromDDL(added).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = of()
        for batch in batches:
            for part in slices(batch, most):
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in carried), *make(part)], names=[f.name for f in types])

    return picked.mapInArrow(run, types)


def keep_rows(docs: DataFrame, of: Callable[[], Callable[[pa.RecordBatch], list[bool]]]) -> DataFrame:
    """The rows of ``docs`` for which the function of a batch says true, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = of()
        for batch in batches:
            for part in slices(batch):
                yield part.filter(pa.array(keep(part), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def slices(batch: pa.RecordBatch, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in parts of about ``most`` bytes, so that a worker's memory follows neither the
    session's rows per batch nor the longest text. An empty batch is passed over."""
    rows = batch.num_rows
    if not rows:
        return
    step = max(1, int(rows * most / max(1, batch.nbytes)))
    for start in range(0, rows, step):
        yield batch.slice(start, step)
