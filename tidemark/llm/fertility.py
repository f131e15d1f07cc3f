"""Quality rules from how public tokenisers take a text apart.

Three measures for each vocabulary: characters per token, the share of tokens that are no whole
characters (bytes for which the vocabulary has nothing longer), and the entropy of the text's tokens.
Prose of a script a vocabulary knows lies in a band; noise, encoded data, and text of another encoding
take few characters per token or many lone bytes, and repetition has little entropy. Bands depend on the
script that most letters of the text belong to. A text is rejected if it is outside its script's band in
any vocabulary that was asked; each vocabulary has bands of its own, wide where it knows a script badly.
A script that no vocabulary asked knows is spelled in bytes, prose like noise; of the measures only entropy
judges it then ("Other": Bengali, Georgian, Telugu, Ethiopic and all that ``BANDS`` doesn't name).

The base rules count words, symbols, repeated lines and words in repeated three-word windows. Everything
is counted over whole texts, row by row, without a shuffle.

Defined results: a null or empty text has no words and fails the base rules. Repeated rows each get a row.
"""

from __future__ import annotations

import base64
import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache, lru_cache
from string import ascii_letters

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import annotate, bytes_of
from tidemark.llm.piece import model_path

VOCABULARIES = ("byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken")
SYMBOLS = b"#*$%&|<>"
#: A longer text is encoded in parts of about so many characters. It is cut only where the vocabulary's own
#: pattern parts words, so the tokens are those of the whole text.
STRETCH = 1 << 18
# What the pattern takes for white space. Runs of it from 4096 on go around the pattern, which fails on very long ones.
_BLANK = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_LONG_RUN, _EDGE = re.compile(f"[{_BLANK}]{{4096,}}"), re.compile(f"(?<=[^{_BLANK}])[{_BLANK}]")


@dataclass(frozen=True)
class Band:
    """What prose may have: characters per token, share of lone bytes, bits of entropy."""

    least_chars: float
    most_chars: float
    most_bytes: float
    least_entropy: float


# Bands of each script, for the vocabulary of mostly English text and for that of many languages.
BANDS: dict[str, dict[str, Band]] = {
    "byte_bpe_50k.tiktoken": {
        "Latin": Band(1.7, 9.0, 0.25, 5.0),
        "Greek": Band(0.4, 6.0, 0.70, 4.0),
        "Cyrillic": Band(0.4, 6.0, 0.70, 4.0),
        "Arabic": Band(0.71, 6.0, 0.82, 4.0),
        "Hebrew": Band(0.78, 6.0, 0.79, 3.8),
        # It spells the others in bytes, noise and prose alike; one character is four bytes at most.
        "Other": Band(0.25, 9.0, 1.0, 2.8),
    },
    "byte_bpe_multi_50k.tiktoken": {
        "Latin": Band(2.05, 9.0, 0.15, 5.0),
        "Greek": Band(0.7, 7.0, 0.60, 4.5),
        "Cyrillic": Band(1.0, 8.0, 0.50, 4.5),
        "Han": Band(0.60, 8.0, 0.72, 3.5),
        "Japanese": Band(0.84, 8.0, 0.40, 3.5),
        "Hangul": Band(0.85, 8.0, 0.65, 3.5),
        "Arabic": Band(1.25, 8.0, 0.20, 4.0),
        "Hebrew": Band(1.45, 8.0, 0.14, 4.0),
        "Devanagari": Band(0.76, 8.0, 0.77, 3.5),
        "Thai": Band(0.93, 8.0, 0.34, 3.5),
        "Tamil": Band(0.98, 8.0, 0.40, 3.5),
        "Armenian": Band(0.73, 8.0, 0.85, 3.5),
        "Other": Band(0.25, 9.0, 1.0, 2.8),
    },
}


#: How the names of a script's letters begin.
_SCRIPTS = {"LATIN": "Latin", "GREEK": "Greek", "CYRILLIC": "Cyrillic", "CJK": "Han", "IDEOGRAPHIC": "Han", "HIRAGANA": "Japanese", "KATAKANA": "Japanese", "HANGUL": "Hangul", "ARABIC": "Arabic", "HEBREW": "Hebrew", "DEVANAGARI": "Devanagari", "THAI": "Thai", "TAMIL": "Tamil", "ARMENIAN": "Armenian"}
_ASCII_LETTERS, _BEYOND = ascii_letters.encode(), re.compile(r"[^\x00-\x7f]")


@lru_cache(maxsize=1 << 16)
def _script_of(letter: str) -> str:
    name = unicodedata.name(letter, "")
    return next((s for start, s in _SCRIPTS.items() if name.startswith(start)), "Other")


def script(text: str) -> str:
    """The script of most letters; Latin if there are none."""
    if text.isascii():
        return "Latin"
    plain = text.encode("ascii", "ignore")
    counts = Counter({"Latin": len(plain) - len(plain.translate(None, _ASCII_LETTERS))})
    for letter, n in Counter(_BEYOND.findall(text)).items():
        if letter.isalpha():
            counts[_script_of(letter)] += n
    return min(counts, key=lambda s: (-counts[s], s))


class Vocabulary:
    """A public byte-level vocabulary and which of its tokens are no whole characters."""

    def __init__(self, name: str):
        import public_tokenizers
        import tiktoken

        with open(model_path(name), "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self.encoding = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._one_word = cache(lambda: tiktoken.Encoding(f"{name}, one word", pat_str="(?s:.+)", mergeable_ranks=ranks, special_tokens={}))
        self.lone = np.zeros(max(ranks.values()) + 1, bool)
        for token, rank in ranks.items():
            try:
                token.decode()
            except UnicodeDecodeError:
                self.lone[rank] = True

    def encode(self, text: str) -> np.ndarray:
        """The ids of the whole text, as if it were encoded at once."""
        parts, at = [], 0
        for run in _LONG_RUN.finditer(text):
            first, last = run.span()
            # The last blank goes with what follows, the others are one word of the pattern.
            last -= last < len(text)
            parts += self._plain(text[at:first])
            parts.append(np.asarray(self._one_word().encode_to_numpy(text[first:last], disallowed_special=())))
            at = last
        parts += self._plain(text[at:] if at else text)
        return parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.empty(0, np.uint32)

    def _plain(self, text: str) -> Iterator[np.ndarray]:
        """Ids in parts that end before a blank behind another character, where a word of the pattern ends too."""
        at = 0
        while at < len(text):
            edge = _EDGE.search(text, at + STRETCH) if len(text) - at > STRETCH else None
            end = edge.start() if edge else len(text)
            yield np.array(self.encoding.encode_ordinary(text[at:end] if end - at < len(text) else text), np.uint32)
            at = end

    def measures(self, text: str) -> tuple[float, float, float]:
        """Characters per token, share of lone bytes, entropy in bits; zeros for an empty text."""
        ids = self.encode(text)
        if not len(ids):
            return 0.0, 0.0, 0.0
        ordered = np.sort(ids)
        edges = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
        share = np.diff(np.append(edges, len(ids))) / len(ids)
        return len(text) / len(ids), float(self.lone[ids].mean()), float(-(share * np.log2(share)).sum())


@lru_cache(maxsize=4)
def vocabulary(name: str) -> Vocabulary:
    return Vocabulary(name)


def in_band(measures: tuple[float, float, float], band: Band) -> bool:
    chars, lone, entropy = measures
    return band.least_chars <= chars <= band.most_chars and lone <= band.most_bytes and entropy >= band.least_entropy


@dataclass
class Base:
    words: int
    word_chars: int
    symbols: int
    dup_lines: int
    repeat_words: int

    @property
    def failed(self) -> bool:
        return self.words < 50 or 100 * self.repeat_words > 50 * self.words


def base(text: bytes) -> Base:
    """Counts over one text; words are what ASCII white space parts."""
    words = text.split()
    sizes = sum(map(len, words))
    # A byte that begins no character only continues one; white space is one byte and one character.
    chars = len(text.decode()) - (len(text) - sizes)
    lines, seen, again = text.split(b"\n"), set(), 0
    if len(set(lines)) < len(lines):
        for line in lines:
            if line in seen:
                again += bool(line.split())
            else:
                seen.add(line)
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(windows)) < len(windows):
        counts, upto = Counter(windows), 0
        for k, window in enumerate(windows):
            if counts[window] > 1:
                repeated += k + 3 - max(k, upto)
                upto = k + 3
    return Base(len(words), chars, len(text) - len(text.translate(None, SYMBOLS)), again, repeated)


_COLUMNS = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean, script string, fertility array<struct<vocabulary:string,chars_per_token:double,lone_bytes:double,entropy:double>>"


def judge(docs: DataFrame, vocabularies: tuple[str, ...] = VOCABULARIES, bands: dict[str, dict[str, Band]] = BANDS) -> DataFrame:
    """doc_id, the base counts, whether the base rules failed, whether the text is kept, its script and
    the measures of each vocabulary. Only doc_id and text are read."""

    def of() -> Callable[[pa.RecordBatch], list[pa.Array]]:
        loaded = [(name, vocabulary(name)) for name in vocabularies]

        def make(batch: pa.RecordBatch) -> list[pa.Array]:
            rows = []
            for text in bytes_of(batch.column(1)):
                b = base(text or b"")
                plain = (text or b"").decode()
                kind = script(plain)
                measured = [(name, v.measures(plain)) for name, v in loaded]
                fits = all(in_band(m, bands[name].get(kind, bands[name]["Other"])) for name, m in measured)
                rows.append((b.words, b.word_chars, b.symbols, b.dup_lines, b.repeat_words, b.failed, fits and not b.failed, kind, [{"vocabulary": n, "chars_per_token": m[0], "lone_bytes": m[1], "entropy": m[2]} for n, m in measured]))
            types = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.string(), pa.list_(pa.struct([("vocabulary", pa.string()), ("chars_per_token", pa.float64()), ("lone_bytes", pa.float64()), ("entropy", pa.float64())]))]
            return [pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]

        return make

    return annotate(docs, ["doc_id", "text"], _COLUMNS, of)
