"""Shards by a permutation-filled lookup table, placed by native expressions only.

Every shard has an order of preference over the slots of a table of prime size, stepping by a skip of
its own from an offset of its own. Shards take turns, each claiming the first slot of its order that
is still free, until the table is full: shares differ by at most one slot, and when a shard goes, almost
only its own slots change hands. A key's hash modulo the table's size is its slot, and one look-up in the
broadcast table gives the shard. The table has ``SLOTS`` rows whatever the input, which bounds it.

A key that holds more than ``split_rows`` rows may be split: it then has as many slots as it needs parts,
and a second column deals its rows out over them. Only counts of keys are shuffled for that.

Defined results: null keys are one key of their own, apart from the empty text; repeated rows land on the
same shard; an empty table gives no rows.
"""

from __future__ import annotations

import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import broadcast_if_small, fresh

#: A prime, so that every skip visits every slot.
SLOTS = 65_537
SHARDS = 64
#: Rows from which the query splits a key.
SPLIT_ROWS = 1000


def preference(shard: str, slots: int) -> tuple[int, int]:
    """Offset and skip of a shard."""
    return xxhash.xxh64_intdigest(shard.encode(), 1) % slots, xxhash.xxh64_intdigest(shard.encode(), 2) % (slots - 1) + 1


def fill(shards: list[str], slots: int = SLOTS, turns: list[int] | None = None) -> list[int]:
    """The shard (its place in ``shards``) of each slot. ``turns``: slots that a shard claims in a round,
    1 if not given."""
    if not shards or len(set(shards)) < len(shards) or len(shards) > slots:
        raise ValueError("shards need different names, and no more of them than slots")
    if slots < 2 or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError("the number of slots must be a prime")
    turns = turns or [1] * len(shards)
    if len(turns) != len(shards) or min(turns) < 0 or not any(turns):
        raise ValueError("turns needs a number for each shard, not all 0")
    table, left = [-1] * slots, slots
    orders = [preference(s, slots) for s in shards]
    at = [offset for offset, _ in orders]
    while True:
        for k, (_, skip) in enumerate(orders):
            for _ in range(turns[k]):
                while table[at[k]] >= 0:
                    at[k] = (at[k] + skip) % slots
                table[at[k]] = k
                left -= 1
                if not left:
                    return table


def slot_table(spark: SparkSession, shards: list[str], slots: int = SLOTS, turns: list[int] | None = None) -> DataFrame:
    """(slot, shard) for each slot. The table is one literal of one, two or four bytes a slot that rows of
    a range read from, so it needs no rows made in Python."""
    width = 1 if len(shards) <= 1 << 8 else 2 if len(shards) <= 1 << 16 else 4
    packed = F.lit(bytearray(b"".join(k.to_bytes(width) for k in fill(shards, slots, turns))))
    at = (F.col("id") * width + 1).cast("int")
    shard = F.conv(F.hex(F.substring(packed, at, F.lit(width))), 16, 10).cast("int")
    return spark.range(slots).select(F.col("id").cast("int").alias("slot"), shard.alias("shard"))


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """The slot of a key; null is hashed as a number of its own that no text gives."""
    text = key.cast("string")
    return F.pmod(F.when(text.isNull(), F.xxhash64(F.lit(0))).otherwise(F.xxhash64(text)), F.lit(slots)).cast("int")


def place(docs: DataFrame, key: str, shards: list[str], slots: int = SLOTS, turns: list[int] | None = None, split_rows: int | None = None, split_by: str | None = None) -> DataFrame:
    """``docs`` with columns slot and shard (in place of any of these names).

    ``split_rows`` and ``split_by``: a key with more rows is spread over as many slots as parts of that
    size, each row by the hash of ``split_by``.
    """
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in ("slot", "shard")]
    table = F.broadcast(slot_table(docs.sparkSession, shards, slots, turns))
    slot = slot_of(F.col(key), slots)
    if split_rows is None:
        return docs.select(*rest, slot.alias("slot")).join(table, "slot").select(*rest, "slot", "shard")
    # A row for each key of more than split_rows rows: few as a rule, which is checked before they are broadcast.
    given, parts = fresh(docs, "__key", "__parts")
    large = docs.groupBy(F.col(key).alias(given)).count().where(F.col("count") > split_rows).select(given, F.ceil(F.col("count") / split_rows).cast("int").alias(parts))
    part = F.pmod(F.xxhash64(F.col(split_by)), F.coalesce(parts, F.lit(1)))
    spread = F.pmod(slot + F.when(part == 0, 0).otherwise(F.pmod(F.xxhash64(F.col(key), part), F.lit(slots))), F.lit(slots)).cast("int")
    joined = docs.join(broadcast_if_small(large), F.col(key).eqNullSafe(F.col(given)), "left").select(*rest, spread.alias("slot"))
    return joined.join(table, "slot").select(*rest, "slot", "shard")
