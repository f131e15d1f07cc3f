"""Language identification by a byte convolutional network in numpy.

Filters of several widths run over the bytes of a fixed-length window, the maximum of each filter over
the window is kept, and a softmax layer gives the languages' probabilities. A whole text is cut into
windows that overlap by the longest filter less one, so no run of bytes is lost; its log-probabilities
are the means of its windows'.

A filter's response to a run of bytes is a sum of one table entry a byte. Training updates the tables
at the places of the maxima only. For application, entries of two neighbouring bytes are summed
beforehand, so a filter of width four costs two look-ups.

What the network learns from are labelled windows: those of the whole texts of all documents to learn from,
cut as for judging. It is fitted on a bounded sample of them (``PER_LANGUAGE`` windows of each language, those
with the smallest hashes over all texts, so any place of any text may be among them); all rows are judged,
over whole texts.

Defined results: ``und`` with score 0 for a null text, one without a letter, and where no document
has a language to learn from. Repeated rows each get the same row. Rows without an id are judged, but
never learned from.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import LOWER, annotate, bytes_of, fold, held_out, largest

UNKNOWN = "und"
WIDTHS, FILTERS, WINDOW = (2, 3, 4, 5), 16, 256
#: The training sample: windows of each language, languages.
PER_LANGUAGE, MOST_LANGUAGES = 800, 500
EPOCHS, BATCH, RATE, DECAY = 30, 96, 0.02, 1e-5
_STEP = 64
_LETTER = regex.compile(r"\p{L}")


def cut(texts: list[bytes], window: int = WINDOW, overlap: int = WIDTHS[-1] - 1) -> tuple[np.ndarray, np.ndarray]:
    """Windows of all texts, filled up with zeros, and the number of windows of each text."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    counts = np.maximum(1, -((overlap - sizes) // (window - overlap)))
    room = (counts - 1) * (window - overlap) + window
    ends = np.cumsum(room)
    line = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    for text, end, space in zip(texts, ends.tolist(), room.tolist(), strict=True):
        line[end - space : end - space + len(text)] = np.frombuffer(text, np.uint8)
    owner = np.repeat(np.arange(len(texts)), counts)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = (ends - room)[owner] + nth * (window - overlap)
    # Views of the line are gathered as bytes; an array of places would take eight times as much.
    return np.lib.stride_tricks.sliding_window_view(line, window)[starts] if len(starts) else np.zeros((0, window), np.uint8), counts


@dataclass
class Network:
    languages: list[str]
    tables: list[np.ndarray]  # of each width: [place, byte, filter]
    bias: np.ndarray
    weights: np.ndarray
    offset: np.ndarray

    @classmethod
    def start(cls, languages: list[str], seed: int = 7) -> Network:
        random = np.random.default_rng(seed)
        tables = [random.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS]
        many = FILTERS * len(WIDTHS)
        return cls(languages, tables, np.zeros(many, np.float32), random.normal(0, 0.1, (many, len(languages))).astype(np.float32), np.zeros(len(languages), np.float32))

    def pooled(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The filters' maxima over each window, and where they stand."""
        top, at = [], []
        for table in self.tables:
            n = windows.shape[1] - len(table) + 1
            answer = table[0][windows[:, :n]]
            for k in range(1, len(table)):
                answer += table[k][windows[:, k : k + n]]
            where = answer.argmax(axis=1)
            at.append(where)
            top.append(np.take_along_axis(answer, where[:, None], axis=1)[:, 0])
        return np.concatenate(top, axis=1), np.concatenate(at, axis=1)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(texts: list[bytes], languages: list[str], seed: int = 7) -> Network:
    """Adam over mini-batches of windows; languages weigh alike."""
    names = sorted(set(languages))
    net = Network.start(names, seed)
    windows, counts = cut([t.translate(LOWER) for t in texts])
    label = np.repeat(np.array([names.index(x) for x in languages]), counts)
    weight = (1 / np.bincount(label, minlength=len(names)))[label] * len(label) / len(names)
    random = np.random.default_rng(seed)
    parts = [*net.tables, net.bias, net.weights, net.offset]
    first, second, step = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts], 0
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        for own in np.array_split(random.permutation(len(windows)), max(1, len(windows) // BATCH)):
            part = windows[own]
            top, at = net.pooled(part)
            seen = np.maximum(top + net.bias, 0)
            error = softmax(seen @ net.weights + net.offset)
            error[np.arange(len(own)), label[own]] -= 1
            error *= (weight[own] / len(own))[:, None].astype(np.float32)
            back = error @ net.weights.T * (seen > 0)
            slopes = []
            for k, table in enumerate(net.tables):
                mine, where = back[:, k * FILTERS : (k + 1) * FILTERS], at[:, k * FILTERS : (k + 1) * FILTERS]
                slope = np.zeros_like(table)
                for place in range(len(table)):
                    byte = np.take_along_axis(part, where + place, axis=1)
                    np.add.at(slope[place], (byte, np.arange(FILTERS)[None, :]), mine)
                slopes.append(slope)
            slopes += [back.sum(axis=0), seen.T @ error, error.sum(axis=0)]
            step += 1
            for p, g, m, v in zip(parts, slopes, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * ((m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8) + DECAY * p)
    return net


class Applied:
    """A network made ready for many windows: sums of two bytes' entries, buffers that stay in cache."""

    def __init__(self, net: Network):
        self.net = net
        self.plans: list[list[tuple[int, bool, np.ndarray]]] = []
        for table in net.tables:
            plan, k = [], 0
            while k < len(table):
                if k + 1 < len(table):
                    plan.append((k, True, (table[k][:, None, :] + table[k + 1][None, :, :]).reshape(65536, FILTERS)))
                    k += 2
                else:
                    plan.append((k, False, table[k]))
                    k += 1
            self.plans.append(plan)

    def log_probabilities(self, windows: np.ndarray) -> np.ndarray:
        out = np.empty((len(windows), len(self.net.languages)), np.float32)
        length = windows.shape[1]
        for at in range(0, len(windows), _STEP):
            part = windows[at : at + _STEP].astype(np.intp)
            pairs = part[:, :-1] * 256 + part[:, 1:]
            top = []
            for table, plan in zip(self.net.tables, self.plans, strict=True):
                n, answer = length - len(table) + 1, None
                for k, double, entries in plan:
                    found = np.take(entries, (pairs if double else part)[:, k : k + n], axis=0, mode="clip")
                    if answer is None:
                        answer = found
                    else:
                        answer += found
                top.append(answer.max(axis=1))
            score = np.maximum(np.concatenate(top, axis=1) + self.net.bias, 0) @ self.net.weights + self.net.offset
            score -= score.max(axis=1, keepdims=True)
            out[at : at + _STEP] = score - np.log(np.exp(score).sum(axis=1, keepdims=True))
        return out

    def judge(self, texts: list[bytes | None]) -> tuple[list[str], list[float]]:
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        able = [k for k, t in enumerate(texts) if t and _LETTER.search(t.decode())]
        if not able or not self.net.languages:
            return names, scores
        windows, counts = cut([texts[k].translate(LOWER) for k in able])
        means = np.add.reduceat(self.log_probabilities(windows), np.cumsum(counts) - counts, axis=0) / counts[:, None]
        chance = softmax(means.astype(np.float64))
        for k, best, row in zip(able, chance.argmax(axis=1).tolist(), chance, strict=True):
            names[k], scores[k] = self.net.languages[best], float(row[best])
        return names, scores


def training_sample(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """window (bytes) and lang of the windows with the smallest hashes in each language, folds but 0 only.

    Rows of one language, id and text are one document. Windows are numbered where the texts lie and drawn by the
    hash of id, text and number, against a bound that follows from the language's count of distinct windows: so about
    twice the windows wanted are cut out and ranked, and neither a language with most rows, nor a text with very many copies, nor
    one very long text makes that step larger or leaves a language out.
    """
    step = WINDOW - WIDTHS[-1] + 1
    able = docs.where((fold("doc_id") != 0) & F.col("lang").isNotNull() & (F.length("text") > 0))
    able = able.select("doc_id", "lang", F.xxhash64("text").alias("of"), F.col("text").cast("binary").alias("bytes"))
    windows = F.greatest(F.lit(1), F.ceil((F.length("bytes") - (WINDOW - step)) / step)).cast("int")
    single = able.select("lang", "doc_id", "of", windows.alias("n")).distinct()
    counts = single.groupBy("lang").agg(F.sum(F.col("n").cast("bigint")).alias("n")).limit(MOST_LANGUAGES + 1).collect()
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"at most {MOST_LANGUAGES} languages")
    # The bound of each language is an expression, so the draw needs no join.
    bound = F.lit(None).cast("bigint")
    for r in counts:
        bound = F.when(F.col("lang") == r.lang, F.lit(largest(per_language, r.n))).otherwise(bound)
    drawn = F.filter(F.sequence(F.lit(0), windows - 1), lambda k: F.xxhash64("doc_id", "of", k) <= F.col("bound"))
    cut_out = able.withColumn("bound", bound).select("lang", "doc_id", "of", "bytes", F.explode(drawn).alias("k"))
    picked = cut_out.select("lang", F.xxhash64("doc_id", "of", "k").alias("hash"), F.substring("bytes", F.col("k") * step + 1, F.lit(WINDOW)).alias("window")).distinct()
    rank = W.partitionBy("lang").orderBy("hash", "window")
    return picked.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= per_language).select("window", "lang")


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Network:
    rows = sorted((r.lang, bytes(r.window)) for r in training_sample(docs.select("doc_id", "text", "lang"), per_language).collect())
    rows = [(lang, window) for lang, window in rows if _LETTER.search(window.decode(errors="ignore"))]
    return train([window for _, window in rows], [lang for lang, _ in rows]) if rows else Network.start([])


def identify(docs: DataFrame, net: Network) -> DataFrame:
    """doc_id, held_out, lang_pred, score for each row of ``docs``; only doc_id and text are read."""
    sent = docs.sparkSession.sparkContext.broadcast(net)

    def of() -> Callable[[pa.RecordBatch], list[pa.Array]]:
        ready = Applied(sent.value)

        def make(batch: pa.RecordBatch) -> list[pa.Array]:
            names, scores = ready.judge(bytes_of(batch.column(1)))
            return [pa.array(names, pa.string()), pa.array(scores, pa.float64())]

        return make

    return annotate(docs, ["doc_id", "text"], "lang_pred string, score double", of).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
