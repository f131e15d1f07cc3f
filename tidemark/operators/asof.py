"""What was known at each of many decision times: states valid from one knowledge time to the next.

A state of a key is known from its own time until the next state's. Decisions meet the states of their group
(a market date, say) that are valid at their time. Intervals are cut into dyadic pieces, so that this is a join on
(group, level, piece) for intervals of any length: a state has a few pieces a level at most, a decision one a level,
and they share exactly one piece if the state is valid then. Both sides are dealt by time as well as by group,
so a group with very many decisions or revisions is many keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Levels of pieces: seconds up to 2^36 seconds, which is over two thousand years.
LEVELS = 36
#: The second from which pieces count, long before any market.
_ZERO = -(1 << 34)


def _second(time: Column) -> Column:
    return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.date_trunc("second", time).cast("timestamp_ntz")) - _ZERO


def validity(states: DataFrame, key: str, known: str, order: list[str]) -> DataFrame:
    """States with the time until which they hold, ``valid_until``, null for the latest.

    States of one key that became known at once leave the last of them in ``order``; unknown times are never valid."""
    latest = W.partitionBy(key, known).orderBy(*[F.desc(c) for c in order])
    single = states.where(F.col(known).isNotNull()).withColumn("__r", F.row_number().over(latest)).where("__r = 1").drop("__r")
    return single.withColumn("valid_until", F.lead(known).over(W.partitionBy(key).orderBy(known)))


def pieces(first: Column, last: Column, levels: int = LEVELS) -> Column:
    """The dyadic pieces (level, at) that cover the whole numbers from ``first`` to ``last`` once each."""

    def of(k: Column) -> Column:
        size = F.pow(F.lit(2), k).cast("bigint")
        left = F.ceil(first / size).cast("bigint")
        right = F.floor((last + 1) / size).cast("bigint")
        odd = left % 2 == 1
        begins = F.when((left < right) & odd, left)
        ends = F.when((right % 2 == 1) & (F.when(odd, left + 1).otherwise(left) < right), right - 1)
        return F.transform(F.filter(F.array(begins, ends), lambda x: x.isNotNull()), lambda x: F.struct(k.alias("level"), x.alias("at")))

    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(levels)), of))


def as_of(states: DataFrame, decisions: DataFrame, group: str, key: str, known: str, at: str, order: list[str]) -> DataFrame:
    """Each decision (all its columns) with the states of its group that were known at its time, one a key.

    ``group`` names a column of both. A state that became known at the decision's very time counts; later
    corrections never do. Decisions without a time or a group see nothing."""
    valid = validity(states, key, known, order)
    end = F.coalesce(_second(F.col("valid_until")), F.lit((1 << LEVELS) - 1))
    cut = valid.withColumn("__p", F.explode(pieces(_second(F.col(known)), F.least(end, F.lit((1 << LEVELS) - 1)))))
    cut = cut.select("*", F.col("__p")["level"].alias("__level"), F.col("__p")["at"].alias("__at")).drop("__p")
    asked = decisions.where(F.col(at).isNotNull()).withColumn("__level", F.explode(F.sequence(F.lit(0), F.lit(LEVELS))))
    asked = asked.withColumn("__at", F.floor(_second(F.col(at)) / F.pow(F.lit(2), F.col("__level"))).cast("bigint"))
    met = asked.join(cut, [group, "__level", "__at"])
    # Within its first and last second a state may not hold yet, or no longer.
    true = (F.col(known) <= F.col(at)) & (F.col("valid_until").isNull() | (F.col(at) < F.col("valid_until")))
    return met.where(true).drop("__level", "__at")
