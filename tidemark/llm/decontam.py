"""Benchmark decontamination: an FM-index for each shard of documents, searched for test phrases.

A phrase is a window of consecutive words of a benchmark item. The words of a shard's documents are
numbered by the phrases' vocabulary; any other word is the end of a run, as no phrase can hold it. The
index is searched backward for all phrases at once, occurrences are located from kept suffix places,
and overlapping ones merge into spans of words, from which counts, item ids and cleaned texts come.

Shards are cut out of the batches a task reads, so documents aren't shuffled: an index holds the phrases' words
of a few megabytes of text. The phrases travel by broadcast in blocks of about ``BLOCK_BYTES`` of item text, one
at a time: one block is the usual case; of several, each is searched in all documents, what it hits is written
to the checkpoint folder, and it is destroyed before the next is made. Their spans are merged by document.

Cleaning drops contaminated documents, takes the passages out of the others, or both.

Defined results: a null or empty text has no words, hits or items. Repeated documents each get a row.
A null item has no words; an item with a null id marks words but isn't listed. Repeated item ids are
one item with the windows of all its texts. With no benchmark nothing is hit.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bytes_of, fresh, slices
from tidemark.llm.fmindex import FMIndex
from tidemark.session import ensure_checkpoint_dir

WINDOW = 13
#: Text of benchmark items that is broadcast and searched at once. The driver holds about 25 bytes for each.
BLOCK_BYTES = 4 << 20
#: Words in one index; a longer document is cut into pieces that overlap by a window.
SHARD_WORDS = 1 << 19

_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_WORDS).split() if text else []


@dataclass
class Phrases:
    """The distinct windows of some items: a row of word numbers each, and the items that have it."""

    numbers: dict[bytes, int]
    windows: np.ndarray
    lengths: np.ndarray
    owners: np.ndarray  # pairs (window, item) in order of the window
    starts: np.ndarray  # where a window's pairs begin
    items: list[str | None]

    @classmethod
    def of(cls, items: list[tuple[object, bytes | None]], window: int = WINDOW) -> Phrases:
        numbers: dict[bytes, int] = {}
        names: dict[str | None, int] = {}
        own, sizes, ids = [], [], []
        for item, text in items:
            words = np.array([numbers.setdefault(w, len(numbers) + 1) for w in words_of(text)], np.int32)
            if len(words):
                own.append(words)
                sizes.append(len(words))
                ids.append(names.setdefault(None if item is None else str(item), len(names)))
        if not own:
            return cls(numbers, np.zeros((0, 1), np.int32), *(np.zeros(n, np.int64) for n in (0, 0, 1)), [])
        # A row for each place at which a window begins; what lies behind the item's end is cut to zeros.
        size, width = np.array(sizes), min(window, max(sizes))
        count = np.maximum(1, size - window + 1)
        item = np.repeat(np.arange(len(size)), count)
        nth = np.arange(len(item)) - np.repeat(np.cumsum(count) - count, count)
        line = np.concatenate([*own, np.zeros(width, np.int32)])
        table = np.lib.stride_tricks.sliding_window_view(line, width)[(np.cumsum(size) - size)[item] + nth]
        length = np.minimum(window, size[item] - nth)
        table = np.where(np.arange(width) < length[:, None], table, 0).astype(np.int32)
        _, first, number = np.unique(table.view(f"V{4 * width}").ravel(), return_index=True, return_inverse=True)
        pairs = np.unique(number.astype(np.int64) << 32 | np.array(ids)[item])
        starts = np.searchsorted(pairs >> 32, np.arange(len(first) + 1))
        return cls(numbers, table[first], length[first], pairs & 0xFFFFFFFF, starts, list(names))


@dataclass
class Found:
    """For each document of a shard: its words, the marked ones, its spans [from, to) and item ids."""

    words: list[int]
    hits: list[int]
    spans: list[list[tuple[int, int]]]
    items: list[list[str]]


def _search(pieces: list[tuple[int, int, np.ndarray]], phrases: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, place and window of each occurrence in pieces (document, first word, word numbers)."""
    gap = np.zeros(1, np.int64)
    text = np.concatenate([x for _, _, numbers in pieces for x in (numbers, gap)])
    starts = np.cumsum([0, *(len(numbers) + 1 for _, _, numbers in pieces)])[:-1]
    kept = text > 0
    kept[1:] |= text[:-1] > 0  # one 0 ends a run as well as many
    place = np.flatnonzero(kept)
    index = FMIndex(text[kept], len(phrases.numbers) + 1)
    low, high = index.search(phrases.windows, phrases.lengths)
    count = high - low
    window = np.repeat(np.arange(len(count)), count)
    row = np.arange(len(window)) + np.repeat(low - np.cumsum(count) + count, count)
    at = place[index.locate(row)]
    piece = np.searchsorted(starts, at, "right") - 1
    document = np.array([d for d, _, _ in pieces], np.int64)[piece]
    return document, at - starts[piece] + np.array([f for _, f, _ in pieces], np.int64)[piece], window


def find(texts: list[bytes | None], phrases: Phrases, shard_words: int = SHARD_WORDS) -> Found:
    """All occurrences of the phrases in these texts, index by index."""
    n, overlap = len(texts), int(phrases.lengths.max(initial=1)) - 1
    get = phrases.numbers.get
    counts, shard, size, parts = [0] * n, [], 0, []

    def flush() -> None:
        nonlocal shard, size
        if shard and len(phrases.windows):
            parts.append(_search(shard, phrases))
        shard, size = [], 0

    for d, text in enumerate(texts):
        words = words_of(text)
        counts[d] = len(words)
        for first in range(0, max(1, len(words) - overlap), shard_words):
            own = words[first : first + shard_words + overlap]
            numbers = np.array([get(w, 0) for w in own], np.int64)
            if numbers.any():
                if size and size + len(numbers) > shard_words:
                    flush()
                shard.append((d, first, numbers))
                size += len(numbers)
    flush()
    found = Found(counts, [0] * n, [[] for _ in range(n)], [[] for _ in range(n)])
    if not any(len(document) for document, _, _ in parts):
        return found
    document, at, window = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((at, document))
    document, at, end = document[order], at[order], (at + phrases.lengths[window])[order]
    for d in np.unique(document):
        lo, hi = np.searchsorted(document, (d, d + 1))
        found.spans[d] = merged(at[lo:hi], end[lo:hi])
        found.hits[d] = sum(b - a for a, b in found.spans[d])
    pairs = np.unique(np.stack((document, window[order])), axis=1)
    many = phrases.starts[pairs[1] + 1] - phrases.starts[pairs[1]]
    own = phrases.owners[np.repeat(phrases.starts[pairs[1]] - np.cumsum(many) + many, many) + np.arange(many.sum())]
    for d, k in np.unique(np.stack((np.repeat(pairs[0], many), own)), axis=1).T.tolist():
        if phrases.items[k] is not None:
            found.items[d].append(phrases.items[k])
    return found


def merged(start: np.ndarray, end: np.ndarray) -> list[tuple[int, int]]:
    """The union of spans in order of their starts."""
    reach = np.maximum.accumulate(end)
    new = np.append(True, start[1:] > reach[:-1])
    return list(zip(start[new].tolist(), reach[np.append(new[1:], True)].tolist(), strict=True))


def is_contaminated(words: int, hits: int) -> bool:
    return hits > 0 and 20 * hits >= words


def block_count(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> int:
    return max(1, -(-(benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // block_bytes))


def phrase_blocks(benchmark: DataFrame, blocks: int, window: int = WINDOW) -> Iterator[Phrases]:
    """The items in so many blocks, made one after another."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("binary").alias("text")).where("text is not null")
    for k in range(blocks):
        part = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k)
        # Of an item that is in the table more than once only different texts count.
        yield Phrases.of(sorted({(r.item, bytes(r.text)) for r in part.collect()}, key=lambda x: (x[0] is None, x)), window)


_COLUMNS = "doc_id bigint, n_words bigint, n_hit bigint, spans array<struct<first:int,last:int>>, items array<string>"


def _spans(docs: DataFrame, sent: Broadcast, hit_only: bool, shard_words: int) -> DataFrame:
    """One row a document (or only those with a hit), keyed by id and text digest when ``hit_only``."""
    picked = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = _COLUMNS + (", digest string" if hit_only else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                texts = bytes_of(part.column(1))
                found = find(texts, sent.value, shard_words)
                rows = [k for k in range(len(texts)) if found.hits[k] or not hit_only]
                spans = pa.array([[{"first": a, "last": b} for a, b in found.spans[k]] for k in rows], pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())])))
                columns = [part.column(0).take(pa.array(rows, pa.int64())), pa.array([found.words[k] for k in rows], pa.int64()), pa.array([found.hits[k] for k in rows], pa.int64()), spans, pa.array([found.items[k] for k in rows], pa.list_(pa.string()))]
                if hit_only:
                    columns.append(pa.array([hashlib.sha256(texts[k]).hexdigest() for k in rows], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in ("doc_id", "n_words", "n_hit", "spans", "items", "digest")[: len(columns)]])

    return picked.mapInArrow(run, schema)


def _hits(docs: DataFrame, benchmark: DataFrame, blocks: int, window: int, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(doc_id, digest, spans, items) of the documents with a hit, block after block."""
    ensure_checkpoint_dir(docs.sparkSession)
    hit = None
    for phrases in phrase_blocks(benchmark, blocks, window):
        sent = docs.sparkSession.sparkContext.broadcast(phrases)
        own = _spans(docs, sent, True, shard_words).checkpoint()
        sent.destroy()
        hit = own if hit is None else hit.unionByName(own)
    joined = hit.groupBy("doc_id", "digest").agg(
        F.array_sort(F.flatten(F.collect_set("spans"))).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items")
    )
    step = "CASE WHEN size(acc) > 0 AND element_at(acc, -1).last >= x.first THEN concat(slice(acc, 1, size(acc) - 1), array(named_struct('first', element_at(acc, -1).first, 'last', greatest(element_at(acc, -1).last, x.last)))) ELSE concat(acc, array(x)) END"
    return joined.withColumn("spans", F.expr(f"aggregate(spans, slice(spans, 1, 0), (acc, x) -> {step})"))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES, shard_words: int = SHARD_WORDS) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_words, n_hit, merged spans of word places
    [first, last) and the item ids found, sorted as text.

    With one block of phrases nothing is shuffled. With several, the documents are searched for each
    block, and only those that have a hit are gathered, by id and text digest, to merge their spans.
    """
    blocks = block_count(benchmark, block_bytes)
    if blocks == 1:
        sent = docs.sparkSession.sparkContext.broadcast(next(phrase_blocks(benchmark, 1, window)))
        return _spans(docs, sent, False, shard_words).withColumn("items", F.array_sort("items"))
    joined = _hits(docs, benchmark, blocks, window, shard_words)
    counted = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.sha2(F.col("text").cast("binary"), 256).alias("digest"), word_count(F.col("text")).alias("n_words"))
    out = counted.alias("d").join(joined.alias("j"), F.expr("d.doc_id <=> j.doc_id AND d.digest = j.digest"), "left")
    return out.selectExpr(
        "d.doc_id",
        "d.n_words",
        "coalesce(aggregate(j.spans, 0L, (a, x) -> a + (x.last - x.first)), 0L) n_hit",
        "coalesce(j.spans, cast(array() AS array<struct<first:int,last:int>>)) spans",
        "coalesce(j.items, cast(array() AS array<string>)) items",
    )


def word_count(text: Column) -> Column:
    """The number of words as a native expression; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")).cast("bigint"), F.lit(0).cast("bigint"))


def digest(found: DataFrame) -> DataFrame:
    """The columns of the contract from those of ``contamination``."""
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs``, all columns, that no benchmark contaminates."""
    return _cleaned(docs, benchmark, True, False, window, block_bytes, "")


def remove_passages(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES, length: str = "n_chars") -> DataFrame:
    """The rows of ``docs``, all columns, their texts without the merged spans of benchmark phrases. The column
    ``length``, if there is one, follows a text that changed."""
    return _cleaned(docs, benchmark, False, True, window, block_bytes, length)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES, length: str = "n_chars") -> DataFrame:
    """The rows that no benchmark contaminates, without what passages they hold all the same."""
    return _cleaned(docs, benchmark, True, True, window, block_bytes, length)


def _cleaned(docs: DataFrame, benchmark: DataFrame, drop: bool, remove: bool, window: int, block_bytes: int, length: str) -> DataFrame:
    blocks, at = block_count(benchmark, block_bytes), docs.columns.index("text")
    size_at = docs.columns.index(length) if length in docs.columns else None
    names, n = [f"`{c}`" for c in docs.columns], len(docs.columns)
    if blocks == 1:
        sent, source = docs.sparkSession.sparkContext.broadcast(next(phrase_blocks(benchmark, 1, window))), docs
    else:
        ident, digest, spans = fresh(docs, "__id", "__digest", "__spans")
        hits = _hits(docs, benchmark, blocks, window).select(F.col("doc_id").alias(ident), F.col("digest").alias(digest), F.col("spans").alias(spans))
        same = F.col("doc_id").cast("bigint").eqNullSafe(F.col(ident)) & (F.sha2(F.col("text").cast("binary"), 256) == F.col(digest))
        sent, source = None, docs.join(hits, same, "left").select(*names, spans)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                texts = bytes_of(part.column(at))
                if sent is not None:
                    found = find(texts, sent.value)
                    counts, own = found.words, found.spans
                else:
                    own = [[(s["first"], s["last"]) for s in x or ()] for x in part.column(n).to_pylist()]
                    counts = [len(words_of(t)) if x else 0 for t, x in zip(texts, own, strict=True)]
                columns = list(part.columns[:n])
                if remove and any(own):
                    new = [None if t is None else (without_spans(t, x) if x else t).decode() for t, x in zip(texts, own, strict=True)]
                    columns[at] = pa.array(new, part.schema.field(at).type)
                    if size_at is not None:
                        sizes = [len(t) if x else old for t, x, old in zip(new, own, columns[size_at].to_pylist(), strict=True)]
                        columns[size_at] = pa.array(sizes, part.schema.field(size_at).type)
                made = pa.RecordBatch.from_arrays(columns, names=part.schema.names[:n])
                kept = [not (drop and is_contaminated(words, sum(b - a for a, b in x))) for words, x in zip(counts, own, strict=True)]
                yield made if all(kept) else made.filter(pa.array(kept, pa.bool_()))

    return source.mapInArrow(run, docs.schema)


def without_spans(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the words in these spans and what stands between them."""
    edges = [m.span() for m in re.finditer(rb"[^ ]+", text.translate(_WORDS))]
    out, at = [], 0
    for first, last in spans:
        out.append(text[at : edges[first][0]])
        at = edges[last - 1][1]
    return b"".join([*out, text[at:]])
