"""Orphans of a large parent: a Bloom filter of the child's keys cuts the parent before an exact anti join.

The child's keys are counted first, once each, so a key with a third of all rows is one row of the join. The filter has a
64-bit word for every ``KEYS_A_WORD`` keys, in which a key sets four bits; words are OR-ed where the rows are. It may let other
keys pass, never lose one, and the join decides. A filter of more than ``MOST_WORDS`` words isn't broadcast: the parent
is then joined whole.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.session import ensure_checkpoint_dir

KEYS_A_WORD = 6
MOST_WORDS = 1 << 20


def _word(key: Column, words: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(0), key), F.lit(words).cast("bigint"))


def _bits(key: Column) -> Column:
    """Four of 64 bits, from parts of a second hash."""
    one, hashed = F.lit(1).cast("bigint"), F.xxhash64(F.lit(1), key)
    places = [F.shiftrightunsigned(hashed, 6 * k).bitwiseAND(F.lit(63)).cast("int") for k in range(4)]
    return reduce(Column.bitwiseOR, [F.call_function("shiftleft", one, p) for p in places])


def words_for(keys: int) -> int:
    return max(1, -(-keys // KEYS_A_WORD))


def filter_of(keys: DataFrame, key: str, words: int) -> DataFrame:
    """The words that have a bit set."""
    return keys.groupBy(_word(F.col(key), words).alias("__word")).agg(F.bit_or(_bits(F.col(key))).alias("__bits"))


def maybe(frame: DataFrame, key: str, bloom: DataFrame, words: int) -> DataFrame:
    """Rows whose key may be in the filter: all that are, and few others."""
    own = _bits(F.col(key))
    return frame.join(F.broadcast(bloom), (_word(F.col(key), words) == F.col("__word")) & (F.col("__bits").bitwiseAND(own) == own), "left_semi")


def cut(parent: DataFrame, key: str, keys: DataFrame, most_words: int = MOST_WORDS) -> DataFrame:
    """The parent's rows whose key may be among those of ``keys``, a stored frame with a column of that name; the parent whole
    if there are too many of them. An exact join decides afterwards."""
    words = words_for(keys.count())
    return maybe(parent, key, filter_of(keys, key, words), words) if words <= most_words else parent


def orphans(child: DataFrame, column: str, parent: DataFrame, key: str, seen: Observation | None = None, most_words: int = MOST_WORDS) -> DataFrame:
    """(column, n): keys of ``child`` that ``parent`` lacks, and their rows. Nulls have no parent to miss. Keys are of one type.

    ``seen`` observes ``n``, the parent's rows that meet the join."""
    if child.schema[column].dataType != parent.schema[key].dataType:
        raise ValueError(f"{column} and {key} are of different types; cast one")
    ensure_checkpoint_dir(child.sparkSession)
    keys = child.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("__key")).agg(F.count("*").alias("n")).checkpoint()
    others = parent.select(F.col(key).alias("__parent")).where("__parent IS NOT NULL")
    if (words := words_for(keys.count())) <= most_words:
        others = maybe(others, "__parent", filter_of(keys, "__key", words), words)
    if seen is not None:
        others = others.observe(seen, F.count(F.lit(1)).alias("n"))
    found = keys.join(others.distinct(), F.col("__key") == F.col("__parent"), "left_anti")
    return found.select(F.col("__key").alias(column), "n")
