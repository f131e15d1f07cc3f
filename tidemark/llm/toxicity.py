"""A toxicity classifier that is held to give a text the same score whichever group it mentions.

Features are the words of a text and their beginnings, hashed; each counts once, so one insult in a
long text weighs as much as in a short one. The model is logistic. Besides the labels' loss it has a
counterfactual penalty: in labelled sentences that mention a group, the identity term is swapped for
others of its kind, and the squared change of the score is added to the loss. Words that merely name a
group so lose what weight chance, biased labels, or insults with the same beginning gave them.

Few labelled documents may mention a group at all. So each sampled one also lends a sentence as a carrier:
chosen by hash from the whole text, with a term of a kind chosen by hash in the place of one of its words, and
swapped like a mention.

The model is fitted on a bounded sample (``PER_CLASS`` labelled documents of each class, whole texts,
every swap in them, all mentions and the carrier, each for all others of its kind); weights restore the classes'
shares among all labels. Every row is scored over its whole text.

Defined results: a null or empty text gets the score of a text without features. Documents with
contradicting labels, null labels or null ids are not learned from; of several texts with one id the one with
the smallest hash is. Without labels of both classes every score is the share of the class there is, or 0.
Repeated rows each get the same row.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import annotate, below, bytes_of, fold, held_out, keep_rows

#: The training sample: documents of each class.
PER_CLASS = 4000
BUCKETS, STEMS = 1 << 20, (3, 4, 5, 6)
#: A feature is in the model if so many sampled documents have it, and if its share of toxic documents is so
#: many standard errors from that of all. Without the second, rare words that chance put into toxic documents
#: would explain the sample away.
LEAST_DOCS, TELLING = 3, 4.0
ROUNDS, RATE, RIDGE, FAIRNESS = 250, 0.05, 1e-3, 1.0
#: How much more a missed toxic document costs than a clean one that is rejected.
MISSED = 3.0
CACHE = 300_000

# Terms that name groups of people, by kind; a term is swapped for others of its kind.
IDENTITY = (
    ("women", "men"),
    ("woman", "man"),
    ("female", "male"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "indigenous"),
    ("american", "mexican", "chinese", "african", "european", "indian"),
    ("young", "old"),
    ("blind", "deaf", "disabled"),
)

_OTHER = {t: kind for kind in IDENTITY for t in kind}
_WORD = re.compile(r"[^\W_]+")
_SENTENCE = re.compile(r"[^.!?\n]+")


def features(word: str) -> tuple[int, ...]:
    """Buckets of a word and of its beginnings."""
    parts = [f"={word}", *(word[:n] for n in STEMS if n <= len(word))]
    return tuple(zlib.crc32(p.encode()) % BUCKETS for p in parts)


def features_of(words: set[str]) -> set[int]:
    return {b for w in words for b in features(w)}


def swapped(text: str) -> list[tuple[set[str], set[str]]]:
    """Words of sentences that mention a group, and the words with another term of that kind: all of a text."""
    return [(words, words - {term} | {instead}) for words, term, instead in _swaps(text)]


def changes(text: str, carrier: bool = False) -> Counter[tuple[bytes, bytes]]:
    """How often a swap of the text, or also one in its carrier, loses and gains which buckets. Most mentions of a
    term change the same, so there are few of them, however long the text is."""
    out: Counter[tuple[bytes, bytes]] = Counter()
    last, held = None, Counter[int]()
    for words, term, instead in chain(_swaps(text), _carried(text) if carrier else ()):
        if words is not last:
            last, held = words, Counter(b for w in words for b in set(features(w)))
        new = set(features(instead))
        out[_packed({b for b in features(term) if held[b] == 1} - new), _packed(new - held.keys())] += 1
    return out


def _swaps(text: str) -> Iterator[tuple[set[str], str, str]]:
    for sentence in _SENTENCE.finditer(text.lower()):
        words = set(_WORD.findall(sentence[0]))
        for term in sorted(words & _OTHER.keys()):
            for instead in _OTHER[term]:
                if instead != term:
                    yield words, term, instead


def _carried(text: str) -> Iterator[tuple[set[str], str, str]]:
    """The swaps of a carrier: a sentence of the text in which one word gives way to a term."""
    lower = text.lower()
    sentences = [m.span() for m in _SENTENCE.finditer(lower) if _WORD.search(m[0])]
    if not sentences:
        return
    draw = zlib.crc32(text.encode())
    first, last = sentences[draw % len(sentences)]
    words = sorted(set(_WORD.findall(lower, first, last)))
    kind = IDENTITY[draw // 7 % len(IDENTITY)]
    rest = set(words) - {words[draw // 101 % len(words)], *kind}
    for term in kind:
        mention = rest | {term}
        for instead in kind:
            if instead != term:
                yield mention, term, instead


@dataclass
class Model:
    bias: float
    weights: dict[int, float] = field(default_factory=dict)


class Scorer:
    """Scores whole texts; keeps which of the model's features a word has."""

    def __init__(self, model: Model):
        self.model = model
        self._known: dict[str, tuple[int, ...]] = {}

    def score(self, text: bytes | None) -> float:
        known, weights = self._known, self.model.weights
        seen: set[int] = set()
        for word in set(_WORD.findall(text.decode().lower())) if text else ():
            own = known.get(word)
            if own is None:
                own = tuple(b for b in features(word) if b in weights)
                if len(known) >= CACHE:
                    known.clear()
                if len(word) < 64:
                    known[word] = own
            if own:
                seen.update(own)
        total = self.model.bias + sum(weights[b] for b in sorted(seen))
        return float(1 / (1 + np.exp(-min(60.0, max(-60.0, total)))))


def train(rows: list[tuple[np.ndarray, int]], pairs: list[tuple[np.ndarray, np.ndarray]], share: float, times: list[int] | None = None) -> Model:
    """rows: buckets and label of each document; pairs: buckets lost and gained by a swap; share: of
    label 1 among all labels; times: how often each pair occurs, once if not given."""
    labels = np.array([y for _, y in rows], np.float64)
    if not len(rows):
        return Model(_logit(0.0))
    if labels.min() == labels.max():
        return Model(_logit(labels[0]))
    # A sample has some ten million entries; four bytes each keep the driver small.
    sizes = np.array([len(b) for b, _ in rows])
    owner, bucket = np.repeat(np.arange(len(rows), dtype=np.int32), sizes), np.concatenate([b for b, _ in rows]).astype(np.int32, copy=False)
    docs = np.bincount(bucket, minlength=BUCKETS)
    hits = np.bincount(bucket[labels[owner] == 1], minlength=BUCKETS)
    rate = labels.mean()
    telling = np.abs(hits - docs * rate) / np.sqrt(np.maximum(docs, 1) * rate * (1 - rate))
    telling[(docs < LEAST_DOCS) | (telling < TELLING)] = 0
    chosen = np.flatnonzero(telling > 0)
    number = np.full(BUCKETS, -1, np.int32)
    number[chosen] = np.arange(len(chosen))
    column = number[bucket]
    inside = column >= 0
    owner, column = owner[inside], column[inside]
    del bucket, inside
    lost = [(k, number[b], -1.0) for k, (gone, new) in enumerate(pairs) for b in gone if number[b] >= 0]
    gained = [(k, number[b], 1.0) for k, (gone, new) in enumerate(pairs) for b in new if number[b] >= 0]
    swaps = np.array(lost + gained, np.float64).reshape(-1, 3)
    pair, place, sign = swaps[:, 0].astype(int), swaps[:, 1].astype(int), swaps[:, 2]
    often = np.ones(len(pairs)) if times is None else np.array(times, np.float64)
    weight = np.where(labels == 1, MISSED * share / rate, (1 - share) / (1 - rate))
    weight /= weight.sum()
    w, bias = np.zeros(len(chosen)), _logit(share)
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for step in range(1, ROUNDS + 1):
        z = np.bincount(owner, weights=w[column], minlength=len(rows)) + bias
        error = weight * (1 / (1 + np.exp(-np.clip(z, -60, 60))) - labels)
        slope = np.bincount(column, weights=error[owner], minlength=len(w)) + RIDGE * w
        if len(pairs):
            change = often * np.bincount(pair, weights=sign * w[place], minlength=len(pairs))
            slope += 2 * FAIRNESS / often.sum() * np.bincount(place, weights=sign * change[pair], minlength=len(w))
        m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope * slope
        mb, vb = 0.9 * mb + 0.1 * error.sum(), 0.999 * vb + 0.001 * error.sum() ** 2
        w -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
        bias -= RATE * (mb / (1 - 0.9**step)) / (np.sqrt(vb / (1 - 0.999**step)) + 1e-9)
    return Model(float(bias), {int(b): float(x) for b, x in zip(chosen, w, strict=True) if abs(x) > 1e-3})


def _logit(p: float) -> float:
    p = min(1 - 1e-9, max(1e-9, float(p)))
    return float(np.log(p / (1 - p)))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    able = labels.where((fold("doc_id") != 0) & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most")).where("toxic = most").select("doc_id", "toxic")
    counts = {r.toxic: r["count"] for r in able.groupBy("toxic").count().collect()}
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    sample = None
    for y in (0, 1):
        own = able.where((F.col("toxic") == y) & below(F.xxhash64("doc_id"), per_class, counts.get(y, 0))).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        sample = own if sample is None else sample.unionByName(own)

    def of() -> Callable[[pa.RecordBatch], list[pa.Array]]:
        def make(batch: pa.RecordBatch) -> list[pa.Array]:
            own, lost, gained, times = [], [], [], []
            for text in bytes_of(batch.column(1)):
                plain = (text or b"").decode()
                own.append(_packed(features_of(set(_WORD.findall(plain.lower())))))
                pairs = changes(plain, carrier=True)
                lost.append([a for a, _ in pairs])
                gained.append([b for _, b in pairs])
                times.append(list(pairs.values()))
            many = pa.list_(pa.binary())
            return [pa.array(own, pa.binary()), pa.array(lost, many), pa.array(gained, many), pa.array(times, pa.list_(pa.int64()))]

        return make

    # The sample has at most two per_class rows, so it is broadcast and only its documents are shuffled, one text of
    # each id: aggregated before that, however often an id is repeated.
    found = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(sample), "doc_id")
    picked = found.groupBy("doc_id").agg(F.min_by(F.struct("text", "toxic"), F.xxhash64("text")).alias("r")).select("doc_id", "r.text", "r.toxic")
    made = annotate(picked, ["doc_id", "text", "toxic"], "own binary, lost array<binary>, gained array<binary>, times array<bigint>", of)
    rows, swaps = [], Counter[tuple[bytes, bytes]]()
    for r in sorted(made.collect(), key=lambda r: (r.doc_id, r.own)):
        rows.append((np.frombuffer(r.own, np.int32), int(r.toxic)))
        for lost, gained, times in zip(r.lost, r.gained, r.times, strict=True):
            swaps[lost, gained] += times
    order = sorted(swaps)
    pairs = [(np.frombuffer(a, np.int32), np.frombuffer(b, np.int32)) for a, b in order]
    return train(rows, pairs, share, [swaps[p] for p in order])


def _packed(buckets: set[int]) -> bytes:
    """Buckets in order, as plain bytes: a sample's features are read by the driver."""
    return np.array(sorted(buckets), np.int32).tobytes()


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted for each row of ``docs``; only doc_id and text are read."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def of() -> Callable[[pa.RecordBatch], list[pa.Array]]:
        scorer = Scorer(sent.value)
        return lambda batch: [pa.array([scorer.score(t) for t in bytes_of(batch.column(1))], pa.float64())]

    scored = annotate(docs, ["doc_id", "text"], "score double", of)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, all columns, that score below one half."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def of() -> Callable[[pa.RecordBatch], list[bool]]:
        scorer = Scorer(sent.value)
        return lambda batch: [scorer.score(t) < 0.5 for t in bytes_of(batch.column(batch.schema.get_field_index("text")))]

    return keep_rows(docs, of)
