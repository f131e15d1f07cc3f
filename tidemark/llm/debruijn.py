"""Long repeated passages, found on the de Bruijn graph of the corpus' words.

An edge of the graph is ``k`` consecutive words of a text, its nodes are the ``k - 1`` words that two edges
share. An edge that begins at two places or more is repeated, and all of its words go.

1. *Seeds.* Of an edge's short spans of words, the one with the smallest hash is its seed; equal edges have
   equal seeds. Seeds are a tenth of all places. Only edges whose seed is repeated can be repeated.
2. *Edges.* Those are hashed with the word before and the word after. An edge is repeated if its hash is;
   the path through it branches on a side where the words beside its places differ (the end of a text counts as
   a word of its own).
3. *Paths.* Repeated edges between which nothing branches are one path. All places of an edge lie in as many
   equal places of its path, so a path is compacted where it stands, and one digest of its words stands for
   all of its edges.
4. *Coordinates.* Each place of a path is read in its text, from the first word of its first edge to the last
   of its last one. A path whose words occur once only came of colliding hashes, and its words stay.

Seeds and edges meet by hash in buckets: a batch of texts sends each of its distinct hashes once, packed,
with the place where it first stands, and gets back which are repeated. A passage in a third of all
documents is thus one entry a batch. Equal texts have equal results, so what is found goes back by a text's
digest; the join with the texts is split by Spark where copies make one partition large.

Defined results: a null or empty text has no words, a text of fewer than ``k`` words loses none. Rows that
repeat are documents like any other, so texts of ``k`` words and more that two rows share go whole. A null id
stays null. Other columns of ``docs`` are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import broadcast_if_small, bytes_of, slices
from tidemark.session import ensure_checkpoint_dir

#: Words of an edge, and of a seed in it.
K, SEED = 35, 16
#: Bytes of text a bucket is there for, and the least and the most buckets.
BUCKET_BYTES, BUCKETS = 16 << 20, (128, 1 << 16)
#: Compressed bytes of text that a batch holds.
BATCH_BYTES = 3 << 20
#: Words whose hashes a task remembers.
VOCABULARY = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_NONE, _MIXED = np.uint32(0), np.uint32(0xFFFFFFFF)
_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)


class _Hashes(dict):
    """Hashes of words; forgets all when it has too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= VOCABULARY:
            self.clear()
        made = self[word] = xxhash.xxh64_intdigest(word)
        return made


class _Powers:
    """Powers of the base and of its inverse modulo 2^64, as many as have been asked for."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, count: int) -> tuple[np.ndarray, np.ndarray]:
        if count > len(self.up):
            self.up, self.down = (np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(2 * count, b, np.uint64)))) for b in (_BASE, pow(_BASE, -1, 1 << 64)))
        return self.up[:count], self.down[:count]


_powers = _Powers()


def span_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of each ``size`` consecutive hashes of words."""
    n = len(words)
    if n < size:
        return np.empty(0, np.uint64)
    up, down = _powers(n)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(words * up)))
    out = (sums[size:] - sums[:-size]) * down[: n - size + 1]
    for shift, factor in ((31, 0x7FB5D329728EA185), (27, 0x81DADEF4BC2DD44D)):
        out ^= out >> np.uint64(shift)
        out *= np.uint64(factor)
    return out ^ (out >> np.uint64(33))


def sliding(least: Callable, values: np.ndarray, size: int) -> np.ndarray:
    """``least`` (np.minimum or np.maximum) of each ``size`` consecutive values."""
    have = 1
    while have < size:
        step = min(have, size - have)
        values = least(values[: max(0, len(values) - step)], values[step:])
        have += step
    return values


class Batch:
    """Texts of at least ``k`` words, one behind the other as hashes of words."""

    def __init__(self, texts: list[bytes], keys: list[bytes], hashes: _Hashes, k: int, seed: int) -> None:
        self.k, self.seed = k, seed
        split = [(key, words) for key, words in zip(keys, map(bytes.split, texts), strict=True) if len(words) >= k]
        self.keys = [key for key, _ in split]
        sizes = np.array([len(w) for _, w in split], np.int64)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        self.words = np.concatenate([np.fromiter(map(hashes.__getitem__, w), np.uint64, len(w)) for _, w in split]) if split else np.empty(0, np.uint64)
        self.seeds = span_hashes(self.words, seed)
        self.smallest = sliding(np.minimum, self.seeds, k - seed + 1)
        #: Where k words do not reach into the next text.
        self.whole = np.arange(len(self.smallest)) + k <= np.repeat(self.ends, sizes)[: len(self.smallest)]

    def seed_places(self) -> np.ndarray:
        """Places that are the seed of an edge there."""
        if not len(self.words):
            return np.empty(0, np.int64)
        around = np.zeros(self.k - self.seed, np.uint64)
        of_edges = np.concatenate((around, np.where(self.whole, self.smallest, 0), around))
        return np.flatnonzero(sliding(np.maximum, of_edges, self.k - self.seed + 1) == self.seeds)

    def edges_at(self, seeds: np.ndarray) -> np.ndarray:
        """Edges whose seed stands at one of these places."""
        known = np.full(len(self.seeds), _TOP)
        known[seeds] = self.seeds[seeds]
        return np.flatnonzero(self.whole & (sliding(np.minimum, known, self.k - self.seed + 1) == self.smallest))

    def beside(self, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The words before and after each edge as numbers of 32 bits, none at the ends of its text."""
        short = (self.words % np.uint64(0xFFFFFFFE)).astype(np.uint32) + np.uint32(1)
        text = np.searchsorted(self.starts, edges, "right") - 1
        before = np.where(edges > self.starts[text], short[edges - 1], _NONE)
        after = edges + self.k
        return before, np.where(after < self.ends[text], short[np.minimum(after, len(short) - 1)], _NONE)


#: What a batch sends to a bucket: hashes, the first place of each, whether there are more, what stands
#: beside it. The batch's texts, and further places with the first of the same hash, travel along.
_SENT = "bucket int, batch string, hash binary, place binary, many binary, before binary, after binary, texts binary, starts binary, others binary, first binary"
_NAMES = [f.split()[0] for f in _SENT.split(", ")]


def _packed(name: str, batch: Batch, places: np.ndarray, hashes: np.ndarray, beside: tuple[np.ndarray, np.ndarray] | None, buckets: int) -> Iterator[pa.RecordBatch]:
    if not len(places):
        return
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    begin = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    count = np.diff(np.append(begin, len(ordered)))
    distinct, first, at = ordered[begin], places[order[begin]].astype("<u4"), places[order].astype("<u4")
    sides = []
    for side in beside or ():
        low, high = (f.reduceat(side[order], begin) for f in (np.minimum, np.maximum))
        sides.append(np.where(low == high, low, _MIXED).astype("<u4"))
    of = ((distinct >> np.uint64(48)) * np.uint64(buckets) >> np.uint64(16)).astype(np.int64)
    cuts = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1], [True])))
    rows: dict[str, list] = {n: [] for n in _NAMES}

    def add(**row) -> None:
        for n in _NAMES:
            rows[n].append(row.get(n))

    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        extra = {n: s[a:b].tobytes() for n, s in zip(("before", "after"), sides)}
        add(bucket=int(of[a]), batch=name, hash=distinct[a:b].astype("<u8").tobytes(), place=first[a:b].tobytes(), many=(count[a:b] > 1).tobytes(), **extra)
    later = np.ones(len(at), bool)
    later[begin] = False
    add(bucket=int(of[0]), batch=name, texts=b"".join(batch.keys), starts=batch.starts.astype("<u4").tobytes(), others=at[later].tobytes(), first=np.repeat(first, count)[later].tobytes())
    yield pa.RecordBatch.from_arrays([pa.array(rows[n], t) for n, t in zip(_NAMES, [pa.int32(), pa.string(), *[pa.binary()] * 9], strict=True)], names=_NAMES)


def _sum_up(rows: pa.Table) -> pa.Table:
    """Of one bucket: for each batch the first places of its repeated hashes and the sides on which they branch."""
    entries = rows.filter(rows.column("hash").is_valid())
    kept = rows.filter(rows.column("texts").is_valid())

    def joined(name: str, kind: str) -> np.ndarray:
        return np.frombuffer(b"".join(entries.column(name).to_pylist()), kind)

    hashes = joined("hash", "<u8")
    out = {n: kept.column(n).to_pylist() for n in ("batch", "texts", "starts", "others", "first")} | {"place": [None] * kept.num_rows, "branch": [None] * kept.num_rows}
    if len(hashes):
        order = np.argsort(hashes, kind="stable")
        ordered = hashes[order]
        begin = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
        count = np.diff(np.append(begin, len(ordered)))
        again = (count > 1) | np.logical_or.reduceat(joined("many", bool)[order], begin)
        branch = np.zeros(len(begin), np.uint8)
        if entries.column("before").null_count == 0:
            for bit, name in ((1, "before"), (2, "after")):
                side = joined(name, "<u4")[order]
                low, high = (f.reduceat(side, begin) for f in (np.minimum, np.maximum))
                branch |= np.where((low != high) | (high == _MIXED), bit, 0).astype(np.uint8)
        repeated, branches = np.empty(len(hashes), bool), np.empty(len(hashes), np.uint8)
        repeated[order], branches[order] = np.repeat(again, count), np.repeat(branch, count)
        places, end = joined("place", "<u4"), 0
        for batch, blob in zip(entries.column("batch").to_pylist(), entries.column("hash").to_pylist(), strict=True):
            start, end = end, end + len(blob) // 8
            if (own := repeated[start:end]).any():
                out["batch"].append(batch)
                out["place"].append(places[start:end][own].tobytes())
                out["branch"].append(branches[start:end][own].tobytes())
                for n in ("texts", "starts", "others", "first"):
                    out[n].append(None)
    return pa.table({n: pa.array(v, pa.string() if n == "batch" else pa.binary()) for n, v in out.items()})


def _given_back(rows: pa.Table, paths: bool) -> pa.Table:
    """Of one batch: the repeated places of each text, or the paths as first edges and numbers of edges."""
    row = next(r for r in rows.select(["texts", "starts", "others", "first"]).to_pylist() if r["texts"] is not None)
    found = [b for b in rows.select(["place", "branch"]).to_pylist() if b["place"] is not None]
    none = {"text": pa.array([], pa.binary()), "at": pa.array([], pa.binary()), "size": pa.array([], pa.binary())}
    if not found:
        return pa.table(none)
    place, branch = (np.frombuffer(b"".join(b[n] for b in found), kind) for n, kind in (("place", "<u4"), ("branch", np.uint8)))
    order = np.argsort(place)
    place, branch = place[order], branch[order]
    others, first = (np.frombuffer(row[n], "<u4") for n in ("others", "first"))
    at = np.minimum(np.searchsorted(place, first), len(place) - 1)
    hit = place[at] == first
    place, branch = np.concatenate((place, others[hit])), np.concatenate((branch, branch[at[hit]]))
    order = np.argsort(place)
    place, branch = place[order], branch[order]
    size = np.ones(len(place), "<u4")
    if paths:
        begins = np.concatenate(([True], (place[1:] != place[:-1] + 1) | (branch[1:] & 1 > 0) | (branch[:-1] & 2 > 0)))
        where = np.flatnonzero(begins)
        place, size = place[where], np.diff(np.append(where, len(place))).astype("<u4")
    starts = np.frombuffer(row["starts"], "<u4")
    text = np.searchsorted(starts, place, "right") - 1
    cuts = np.flatnonzero(np.concatenate(([True], text[1:] != text[:-1], [True])))
    spans = list(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True))
    own = (place - starts[text]).astype("<u4")
    return pa.table({"text": [row["texts"][16 * text[a] : 16 * text[a] + 16] for a, _ in spans], "at": [own[a:b].tobytes() for a, b in spans], "size": [size[a:b].tobytes() for a, b in spans]}, pa.schema([(n, pa.binary()) for n in none]))


def _exchange(sent: DataFrame, paths: bool) -> DataFrame:
    """(text, at, size) of each text with something repeated."""
    back = sent.groupBy("bucket").applyInArrow(_sum_up, "batch string, texts binary, starts binary, others binary, first binary, place binary, branch binary")
    own = back.groupBy("batch").applyInArrow(lambda rows: _given_back(rows, paths), "text binary, at binary, size binary")
    # Equal texts of several batches have equal rows.
    return own.groupBy("text").agg(F.first(F.struct("at", "size")).alias("found")).select("text", "found.at", "found.size")


def _batch_name(number: int, keys: list[bytes]) -> str:
    """The same again if the task is run again, and no other's."""
    return f"{TaskContext.get().partitionId()}-{number}-{xxhash.xxh64_hexdigest(b''.join(keys))}"


def _seeds(docs: DataFrame, k: int, seed: int, buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, number = _Hashes(), 0
        for rows in batches:
            for part in slices(rows):
                texts = [t or b"" for t in bytes_of(part.column(0))]
                batch = Batch(texts, [xxhash.xxh3_128_digest(t) for t in texts], hashes, k, seed)
                places = batch.seed_places()
                yield from _packed(_batch_name(number, batch.keys), batch, places, batch.seeds[places], None, buckets)
                number += 1

    return docs.select("text").mapInArrow(run, _SENT)


def _compressed(docs: DataFrame) -> DataFrame:
    """The texts by their digests, small enough to be moved."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(1).compress
        for rows in batches:
            for part in slices(rows):
                texts = [t or b"" for t in bytes_of(part.column(0))]
                yield pa.RecordBatch.from_arrays([part.column(1), pa.array([xxhash.xxh3_128_digest(t) for t in texts], pa.binary()), pa.array(map(squeeze, texts), pa.binary())], names=["doc_id", "text", "body"])

    return docs.select("text", F.col("doc_id").cast("bigint").alias("doc_id")).mapInArrow(run, "doc_id bigint, text binary, body binary")


def _edges(texts: DataFrame, seeds: DataFrame, k: int, seed: int, buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, number, grow = _Hashes(), 0, zstandard.ZstdDecompressor().decompress
        for rows in batches:
            for part in slices(rows, BATCH_BYTES):
                batch = Batch([grow(b) for b in part.column("body").to_pylist()], part.column("text").to_pylist(), hashes, k, seed)
                own = [start + np.frombuffer(at, "<u4") for start, at in zip(batch.starts.tolist(), part.column("at").to_pylist(), strict=True)]
                places = batch.edges_at(np.concatenate(own))
                yield from _packed(_batch_name(number, batch.keys), batch, places, span_hashes(batch.words, k)[places], batch.beside(places), buckets)
                number += 1

    return texts.join(seeds.select("text", "at"), "text").select("text", "body", "at").mapInArrow(run, _SENT)


def path_digests(words: list[bytes], at: np.ndarray, size: np.ndarray, k: int) -> list[bytes]:
    """A digest of the words of each path, from its first edge's first to its last one's last."""
    return [hashlib.blake2b(b" ".join(words[a : a + n + k - 1]), digest_size=16).digest() for a, n in zip(at.tolist(), size.tolist(), strict=True)]


def _cut(found: DataFrame, k: int) -> DataFrame:
    """What stays of each text without the words of its paths, but for paths in ``alone``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grow = zstandard.ZstdDecompressor().decompress
        for rows in batches:
            for part in slices(rows, BATCH_BYTES):
                n_words, n_removed, kept, paths = [], [], [], []
                for body, at, size, alone in zip(*(part.column(n).to_pylist() for n in ("body", "at", "size", "alone")), strict=True):
                    words, digests = grow(body).split(), []
                    stay = np.ones(len(words), bool)
                    if at is not None:
                        at, size = np.frombuffer(at, "<u4").astype(np.int64), np.frombuffer(size, "<u4").astype(np.int64)
                        digests = path_digests(words, at, size, k)
                        if alone:
                            true = np.array([d not in set(alone) for d in digests], bool)
                            at, size = at[true], size[true]
                        change = np.zeros(len(words) + 1, np.int64)
                        np.add.at(change, at, 1)
                        np.add.at(change, at + size + k - 1, -1)
                        stay = np.cumsum(change[:-1]) == 0
                    n_words.append(len(words))
                    n_removed.append(len(words) - int(stay.sum()))
                    kept.append(hashlib.sha256(b" ".join([w for w, s in zip(words, stay.tolist()) if s] if n_removed[-1] else words)).hexdigest())
                    paths.append(digests)
                columns = [part.column("doc_id"), part.column("text"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept), pa.array(paths, pa.list_(pa.binary()))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text", "n_words", "n_removed", "kept_sha256", "paths"])

    return found.mapInArrow(run, "doc_id bigint, text binary, n_words bigint, n_removed bigint, kept_sha256 string, paths array<binary>")


def remove_repeats(docs: DataFrame, k: int = K, seed: int = SEED) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_words, n_removed, kept_sha256."""
    ensure_checkpoint_dir(docs.sparkSession)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = min(max(BUCKETS[0], size // BUCKET_BYTES), BUCKETS[1])
    texts = _compressed(docs)
    seeds = _exchange(_seeds(docs, k, seed, buckets), paths=False)
    paths = _exchange(_edges(texts, seeds, k, seed, buckets), paths=True)
    found = texts.join(paths, "text", "left").select("doc_id", "text", "body", "at", "size")
    cut = _cut(found.withColumn("alone", F.lit(None).cast("array<binary>")), k).checkpoint()
    alone = cut.select(F.explode("paths").alias("path")).groupBy("path").count().where("count = 1").select("path").checkpoint()
    out = ("doc_id", "n_words", "n_removed", "kept_sha256")
    if alone.isEmpty():
        return cut.select(*out)
    # Colliding hashes: rare, so as a rule a few texts, but any number is right.
    wrong = cut.select("text", F.explode("paths").alias("path")).join(broadcast_if_small(alone), "path").groupBy("text").agg(F.collect_set("path").alias("alone")).checkpoint()
    few = broadcast_if_small(wrong)
    again = _cut(texts.join(few, "text").join(paths, "text").select("doc_id", "text", "body", "at", "size", "alone"), k)
    return cut.join(few, "text", "left_anti").select(*out).unionByName(again.select(*out))
