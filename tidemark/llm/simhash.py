"""SimHash near-duplicates, found exactly by vantage-point trees.

A text's fingerprint is the majority of the bits of its shingles' hashes. Of two fingerprints within
``MOST`` bits, at least one of three blocks of bits differs by no more than a third of that, so each
block is searched for itself with a small reach. Within a block, fingerprints are dealt to shards by
their distances to a few vantage points. The triangle bound says by how much a partner's distances can
differ, and flipping a bit changes every distance by one, so by parity few neighbouring shards remain:
a fingerprint is at home in one and visits those of them that come after its own. Each shard builds a
vantage-point tree of its own fingerprints and asks it for the links of its own and its visitors.

Only distinct fingerprints are dealt, so exact copies meet in an aggregate and never in a group. A
shard returns at most one link a fingerprint, enough to connect what all its links connect; dense
groups are cut short within the tree. A shard of more than ``CELL`` fingerprints is dealt out again
over pairs of parts, which bounds the memory of a task and loses no pair.

Defined results: a null or empty text has fingerprint 0 and is linked like any other. Repeated rows
each get a row. Null ids are passed over when the smallest id of a group is taken; a group without any
id has a null component.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import LOWER, annotate, broadcast_if_small, bytes_of, fresh
from tidemark.llm.components import components
from tidemark.llm.vptree import spanning_links
from tidemark.session import ensure_checkpoint_dir

SHINGLE, SEED, MOST, BLOCKS = 4, 42, 4, 3
#: Vantage points whose distances name a shard, for each block of bits: so many at least, and at most.
LEVELS, MOST_LEVELS = 3, 8
#: Fingerprints that one task holds at most, about 100 bytes each.
CELL = 2_000_000
_CHUNK = 1 << 15


def fingerprint(text: bytes | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The 64-bit fingerprint of a text, as an unsigned number."""
    words = text.translate(LOWER).split() if text else []
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    spans = zip(starts[:n].tolist(), ends[len(words) - n :].tolist(), strict=True)
    of = xxhash.xxh64_intdigest
    hashes = np.array([of(line[a:b], seed) for a, b in spans], "<u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, n, _CHUNK):
        ones += np.unpackbits(hashes[at : at + _CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, columns: list[str], shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """``columns`` but the first, which is the text, and the fingerprint as a signed number."""

    def of() -> Callable[[pa.RecordBatch], list[pa.Array]]:
        def make(batch: pa.RecordBatch) -> list[pa.Array]:
            made = np.array([fingerprint(t, shingle, seed) for t in bytes_of(batch.column(0))], np.uint64)
            return [pa.array(made.view(np.int64))]

        return make

    return annotate(docs, columns, "fingerprint bigint", of)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _masks(blocks: int) -> list[int]:
    edges = [64 * k // blocks for k in range(blocks + 1)]
    return [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]


def _vantage_points(count: int) -> list[int]:
    """Fixed points, the same for every input: hashes of their numbers."""
    return [xxhash.xxh64_intdigest(f"vantage {k}".encode(), SEED) for k in range(count)]


def _later_neighbours(levels: int, reach: int) -> list[tuple[int, ...]]:
    """By how much the distances of a partner in a later shard can differ: all by an amount of one parity."""
    found = {d for bits in range(reach + 1) for d in product(range(-bits, bits + 1, 2), repeat=levels)}
    return sorted(d for d in found if d > (0,) * levels)


def levels_for(count: int, cell_points: int = CELL) -> int:
    """Vantage points that make shards of so many fingerprints small. Each spreads them over about nine
    times as many shards and about doubles the rows dealt; pairs found are the same for any number."""
    levels = LEVELS
    while levels < MOST_LEVELS and count * (1 + 2 ** (levels - 1)) / 9**levels > cell_points / 4:
        levels += 1
    return levels


def shard_routes(points: DataFrame, most: int = MOST, blocks: int = BLOCKS, levels: int = LEVELS) -> DataFrame:
    """(block, cell, fingerprint, home): a row for the shard in which a fingerprint is at home and for
    each later one that may hold a partner, in every block."""
    homes = []
    for block, mask in enumerate(_masks(blocks)):
        # Five levels and more need more than 32 bits, eight take 56.
        cell: Column = F.lit(0).cast("bigint")
        for v in _vantage_points(levels):
            cell = cell * 128 + F.bit_count(F.col("fingerprint").bitwiseXOR(F.lit(_signed(v))).bitwiseAND(F.lit(_signed(mask)))) + 32
        homes.append(F.struct(F.lit(block).alias("block"), cell.alias("cell")))
    # A neighbour's number differs from the home's by the same amount everywhere.
    away = [sum(by << 7 * (levels - 1 - k) for k, by in enumerate(s)) for s in _later_neighbours(levels, most // blocks)]
    at = points.select("fingerprint", F.explode(F.array(*homes)).alias("h"))
    by = F.explode(F.array(*[F.lit(d).cast("bigint") for d in (0, *away)])).alias("by")
    return at.select("fingerprint", "h", by).select("h.block", (F.col("h.cell") + F.col("by")).alias("cell"), "fingerprint", (F.col("by") == 0).alias("home"))


def links(points: DataFrame, most: int = MOST, blocks: int = BLOCKS, levels: int | None = None, cell_points: int = CELL) -> DataFrame:
    """Links (a, b) between distinct fingerprints that connect all that lie within ``most`` bits."""
    routes = shard_routes(points, most, blocks, levels or levels_for(points.count(), cell_points))
    # A shard beyond cell_points is a row here: few as a rule, which is checked before they are broadcast.
    large = routes.groupBy("block", "cell").count().where(F.col("count") > cell_points).select("block", "cell", F.ceil(F.col("count") * 2 / cell_points).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("fingerprint"), F.col("parts")).cast("int")
    # Each part meets each other in one task and itself in all of its own, so every pair meets.
    tasks = F.when(F.col("parts").isNull(), F.array(F.lit(0))).otherwise(
        F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda t: F.least(part, t) * F.col("parts") + F.greatest(part, t))
    )
    dealt = routes.join(broadcast_if_small(large.checkpoint()), ["block", "cell"], "left").withColumn("task", F.explode(tasks)).select("block", "cell", "task", "fingerprint", "home")
    masks = _masks(blocks)

    def of_shard(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        found = rows.column("fingerprint").to_numpy().view(np.uint64)
        home = rows.column("home").to_numpy()
        own = found[home]
        if len(own):
            a, b = spanning_links(own, found[~home], most, np.uint64(masks[key[0].as_py()]), most // blocks)
        else:
            a = b = np.empty(0, np.uint64)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    return dealt.groupBy("block", "cell", "task").applyInArrow(of_shard, "a bigint, b bigint")


def group_roots(points: DataFrame, most: int = MOST, blocks: int = BLOCKS, levels: int | None = None, cell_points: int = CELL) -> DataFrame:
    """(node, root) for each distinct fingerprint that has a link."""
    return components(links(points, most, blocks, levels, cell_points))


def groups(docs: DataFrame, most: int = MOST, shingle: int = SHINGLE, seed: int = SEED, cell_points: int = CELL) -> DataFrame:
    """One row for each row of ``docs``: doc_id, fingerprint (signed), component_id."""
    ensure_checkpoint_dir(docs.sparkSession)
    own = fingerprints(docs.select("text", F.col("doc_id").cast("bigint").alias("doc_id")), ["text", "doc_id"], shingle, seed).checkpoint()
    least = own.groupBy("fingerprint").agg(F.min("doc_id").alias("least")).checkpoint()
    roots = group_roots(least.select("fingerprint"), most, cell_points=cell_points).checkpoint()
    labelled = least.join(roots, least.fingerprint == roots.node, "left").select("fingerprint", "least", F.coalesce("root", "fingerprint").alias("root"))
    smallest = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    by_print = labelled.join(smallest, "root").select("fingerprint", "component_id")
    return own.join(by_print, "fingerprint").select("doc_id", "fingerprint", "component_id")


def digest(grouped: DataFrame) -> DataFrame:
    """The columns of the contract: the fingerprint as 16 lowercase hex digits."""
    return grouped.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, most: int = MOST) -> DataFrame:
    """The rows of ``docs``, all columns, without near-duplicates: of each group the row with the
    smallest id stays (no id last), among several of that id the one with the smallest text hash, and
    of rows that share both just one."""
    ensure_checkpoint_dir(docs.sparkSession)
    none, key, hash_, row = fresh(docs, "__none", "__id", "__hash", "__row")
    names = [none, key, hash_]
    ident = [F.col("doc_id").isNull().alias(none), F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)).alias(key), F.coalesce(F.xxhash64("text"), F.lit(0)).alias(hash_)]
    own = fingerprints(docs.select("text", *ident), ["text", *names]).checkpoint()
    least = own.groupBy("fingerprint").agg(F.min(F.struct(*names)).alias("least")).checkpoint()
    roots = group_roots(least.select("fingerprint"), most)
    labelled = least.join(roots, least.fingerprint == roots.node, "left").select("least", F.coalesce("root", "fingerprint").alias("root"))
    stay = labelled.groupBy("root").agg(F.min("least").alias("s")).select(*[F.col("s")[n].alias(n) for n in names])
    # Whether rows repeat is told by ids and hashes; their texts are grouped only where they do.
    stay = stay.join(own.groupBy(*names).agg((F.count("*") > 1).alias(row)), names).checkpoint()
    kept = docs.select("*", *ident).join(broadcast_if_small(stay), names)
    if stay.where(row).isEmpty():
        return kept.select(*[kept[f"`{c}`"] for c in docs.columns])
    single, several = kept.where(~F.col(row)), kept.where(row)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    one = several.groupBy(*names).agg(F.first(F.struct(*columns)).alias(row)).select(*[F.col(row)[c].alias(c) for c in docs.columns])
    return single.select(*columns).unionByName(one)
