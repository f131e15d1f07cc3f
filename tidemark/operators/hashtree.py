"""Reconciliation by digests of buckets: only buckets that differ are compared row by row.

A bucket's digest is the sum of its rows' hashes and their number, so it doesn't depend on the order of rows and is added up
where the rows are; repeated rows count. Digests of days add up to digests of months and of all. Levels are
compared from the top, and what equals goes no further.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SUMS = ("n", "a", "b")


def _hash(columns: list[str], salt: int) -> Column:
    return F.xxhash64(F.lit(salt), *[F.coalesce(F.xxhash64(F.lit(salt), c), F.lit(0)) for c in columns], *[F.col(c).isNull() for c in columns])


def digests(frame: DataFrame, levels: dict[str, Column], columns: list[str]) -> DataFrame:
    """A row for each bucket of the finest level: the levels, rows, and two sums of independent hashes."""
    sums = [F.sum(_hash(columns, salt).cast("decimal(38,0)")).alias(name) for salt, name in ((1, "a"), (2, "b"))]
    return frame.groupBy(*[c.alias(n) for n, c in levels.items()]).agg(F.count("*").alias("n"), *sums)


def rolled_up(leaves: DataFrame, levels: list[str]) -> DataFrame:
    """Digests of coarser buckets, from finer ones."""
    return leaves.groupBy(*levels).agg(*[F.sum(c).alias(c) for c in _SUMS])


def changed(left: DataFrame, right: DataFrame, levels: list[str]) -> DataFrame:
    """Buckets (``levels``, coarsest first) whose digests differ, or that one side lacks."""
    keys = levels[:1]
    for depth in range(1, len(levels) + 1):
        now = levels[:depth]
        a, b = (rolled_up(side, now).alias(n) for side, n in ((left, "a"), (right, "b")))
        same_place = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in now]
        both = a.join(b, same_place, "full").where(~F.struct(*[f"a.{s}" for s in _SUMS]).eqNullSafe(F.struct(*[f"b.{s}" for s in _SUMS])))
        found = both.select(*[F.coalesce(f"a.{k}", f"b.{k}").alias(k) for k in now])
        if depth < len(levels):
            # The finer level looks at buckets within these only.
            left, right = (side.join(found.select(*[F.col(k).alias(f"__{k}") for k in now]), [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in now], "left_semi") for side in (left, right))
        keys = now
    return found.select(*keys)


def differences(expected: DataFrame, actual: DataFrame, levels: dict[str, Column], key: str, columns: list[str]) -> DataFrame:
    """(key, kind) of rows that are missing, extra or changed, by a full join of the changed buckets alone.

    ``key`` is unique on each side; ``columns`` are compared, nulls being equal to nulls."""
    names = list(levels)
    compared = [key, *columns]
    left, right = (digests(side, levels, compared) for side in (expected, actual))
    buckets = changed(left, right, names).select(*[F.col(n).alias(f"__{n}") for n in names]).checkpoint()
    few = F.broadcast(buckets) if buckets.limit(100_001).count() <= 100_000 else buckets

    def within(side: DataFrame) -> DataFrame:
        return side.join(few, [c.eqNullSafe(F.col(f"__{n}")) for n, c in levels.items()], "left_semi").select(*compared)

    e, a = within(expected).alias("e"), within(actual).alias("a")
    both = e.join(a, F.col(f"e.{key}") == F.col(f"a.{key}"), "full")
    same = F.lit(True)
    for c in columns:
        same = same & F.col(f"e.{c}").eqNullSafe(F.col(f"a.{c}"))
    kind = F.when(F.col(f"a.{key}").isNull(), "missing").when(F.col(f"e.{key}").isNull(), "extra").when(~same, "changed")
    return both.select(F.coalesce(f"e.{key}", f"a.{key}").alias(key), kind.alias("kind")).where("kind IS NOT NULL")
