"""SentencePiece encoding and decoding that keeps the place of every piece in the original bytes.

A model file is read without the library. Normalisation takes, at each place of the text, the longest
prefix that the compiled character map holds, or one character if none, and records for every byte it
writes the byte of the source that it came from. Places whose byte begins no key of the map are passed
over together, so a map without keys costs one copy. The normalised text falls into stretches that begin
with word marks; as no piece holds a mark behind another character, stretches are merged for themselves
and kept in a bounded cache. A model for which that does not hold is merged whole. Pieces follow by
joining the best-scored neighbours, the leftmost first among equals, for many short stretches at once;
characters without a piece become byte pieces. Spans of pieces are looked up in the record of source
bytes: consecutive, and together the whole text.

Defined results: a null text counts as empty, an empty text has no ids and decodes to an empty text.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import struct
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import annotate, bytes_of

MODEL = "piece_bpe_32k.model"
MARK = "▁"
#: Stretches that a worker's cache holds before it starts anew, and characters of the longest it keeps.
CACHE, SHORT = 200_000, 32
#: Widths of the tables in which short stretches are merged, by length, and rows of a table.
_WIDTHS = [next(w for w in (4, 6, 8, 10, 12, 16, 24, SHORT) if n <= w) for n in range(SHORT + 1)]
STEP_ROWS = 1 << 13
#: Bytes of texts that are encoded together, and stretches of a long text: what a step holds in memory.
STEP_BYTES, STEP_STRETCHES = 1 << 20, 1 << 17
#: Bytes of texts whose ids and starts go back to Spark in one batch of several times that size.
BATCH_BYTES = 1 << 20
#: Pieces' kinds in a model file.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def model_path(name: str) -> str:
    """The place of a public vocabulary file; a path of its own is taken as it is."""
    if "/" in name:
        return name
    import public_tokenizers

    return str(public_tokenizers.path(name))


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 127) << shift
        shift += 7
        if byte < 128:
            return value, at


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbers and values of a protocol buffer message."""
    at = 0
    while at < len(data):
        tag, at = _varint(data, at)
        wire = tag & 7
        if wire == 0:
            value, at = _varint(data, at)
        else:
            size, at = _varint(data, at) if wire == 2 else ({1: 8, 5: 4}[wire], at)
            value, at = data[at : at + size], at + size
        yield tag >> 3, value


class CharacterMap:
    """The compiled map: a double-array trie from byte strings to places in a block of replacements."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = struct.unpack_from(f"<{size // 4}I", blob, 4) if size else ()
        self.texts = blob[4 + size :] if size else b""
        #: Finds the next place at which a key may begin; None if there are no keys.
        self.start: re.Pattern[bytes] | None = None
        if self.units:
            base = (self.units[0] >> 10) << ((self.units[0] & 512) >> 6)
            first = [b for b in range(256) if (base ^ b) < size // 4 and self.units[base ^ b] & 0x800000FF == b]
            self.start = re.compile(b"[" + b"".join(b"\\x%02x" % b for b in first) + b"]") if first else None

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest key that the text has at this place."""
        units = self.units
        if not units:
            return None
        best, node = None, 0
        unit = units[0]
        node ^= (unit >> 10) << ((unit & 512) >> 6)
        for k in range(at, len(text)):
            node ^= text[k]
            if node >= len(units) or units[node] & 0x800000FF != text[k]:
                break
            unit = units[node]
            node ^= (unit >> 10) << ((unit & 512) >> 6)
            if unit >> 8 & 1:
                best = k + 1 - at, units[node] & 0x7FFFFFFF
        if best is None:
            return None
        return best[0], self.texts[best[1] : self.texts.index(b"\0", best[1])]


class PieceModel:
    """The model file's vocabulary and rules of normalisation."""

    def __init__(self, data: bytes):
        self.pieces: list[str] = []
        kinds: list[int] = []
        scores: list[float] = []
        self.charsmap, self.dummy_prefix, self.squeeze, self.escape = CharacterMap(b""), True, True, True
        for number, value in _fields(data):
            if number == 1:
                own = dict(_fields(value))
                self.pieces.append(own[1].decode())
                scores.append(struct.unpack("<f", own[2])[0] if 2 in own else 0.0)
                kinds.append(own.get(3, NORMAL))
            elif number == 3:
                own = dict(_fields(value))
                self.charsmap = CharacterMap(own.get(2, b""))
                self.dummy_prefix, self.squeeze, self.escape = (bool(own.get(k, 1)) for k in (3, 4, 5))
        if USER in kinds:
            raise ValueError("models with user-defined symbols are not supported")
        self.unknown = kinds.index(UNKNOWN)
        self.number = {p: k for k, p in enumerate(self.pieces) if kinds[k] == NORMAL}
        order = {score: rank for rank, score in enumerate(sorted({scores[k] for k in self.number.values()}, reverse=True))}
        self.rank = {p: order[scores[k]] for p, k in self.number.items()}
        self.byte = {int(self.pieces[k][3:5], 16): k for k, kind in enumerate(kinds) if kind == BYTE}
        self.kinds = kinds
        self.by_stretch = not any(MARK in p.lstrip(MARK) for p in self.number)
        #: What a piece is in the decoded text, and how many bytes of the normalised text it takes.
        self.written = [bytes([int(p[3:5], 16)]) if kind == BYTE else b"" if kind == CONTROL else " ⁇ ".encode() if kind == UNKNOWN else p.replace(MARK, " ").encode() for p, kind in zip(self.pieces, kinds, strict=True)]
        self.width = np.array([1 if kind == BYTE else len(p.encode()) for p, kind in zip(self.pieces, kinds, strict=True)], np.int64)


@lru_cache(maxsize=4)
def load(name: str = MODEL) -> PieceModel:
    with open(model_path(name), "rb") as file:
        return PieceModel(file.read())


def _mapped(charsmap: CharacterMap, text: bytes) -> Iterator[tuple[bool, int, bytes]]:
    """The text in parts: runs without a key, which stay as they are, and what the map writes for the longest
    key at a place. Each part is (mapped, place in the source, bytes)."""
    done = at = 0
    while charsmap.start is not None and (m := charsmap.start.search(text, at)) is not None:
        at = m.start()
        found = charsmap.longest(text, at)
        if found is None:
            at += 1
            continue
        if at > done:
            yield False, done, text[done:at]
        yield True, at, found[1]
        done = at = at + found[0]
    if done < len(text):
        yield False, done, text[done:]


def normalise(model: PieceModel, text: bytes) -> tuple[bytes, np.ndarray]:
    """The normalised text and, for each of its bytes and its end, the source byte it stands for."""
    kind = np.int32 if len(text) < 1 << 31 else np.int64
    if not text:
        return b"", np.zeros(1, kind)
    parts, places, spaced = [], [], model.squeeze
    for mapped, at, part in _mapped(model.charsmap, text):
        place = np.full(len(part), at, kind) if mapped else np.arange(at, at + len(part), dtype=kind)
        if model.squeeze and mapped:
            place = place[len(part) - len(part.lstrip(b" ")) if spaced else 0 :]
            part = part.lstrip(b" ") if spaced else part
        elif model.squeeze:
            space = np.frombuffer(part, np.uint8) == 32
            kept = ~(space & np.concatenate(([spaced], space[:-1])))
            part, place = np.frombuffer(part, np.uint8)[kept].tobytes(), place[kept]
        if part:
            parts.append(part)
            places.append(place)
            spaced = part.endswith(b" ") if model.squeeze else spaced
    plain, origin = b"".join(parts), np.concatenate(places) if places else np.empty(0, kind)
    end = len(text)
    if model.squeeze:
        if (n := len(plain.rstrip(b" "))) < len(plain):
            end = int(origin[n])
            plain, origin = plain[:n], origin[:n]
        if not plain:
            return b"", np.array([len(text)], kind)
    if model.dummy_prefix:
        plain, origin = b" " + plain, np.concatenate((origin[:1], origin))
    if model.escape:
        origin = _thrice(plain, origin)
        plain = plain.replace(b" ", MARK.encode())
    return plain, np.append(origin, kind(end))


def _thrice(plain: bytes, origin: np.ndarray) -> np.ndarray:
    """The record with the entry of each space three times, as its mark has three bytes; step by step, as counts
    take eight bytes each."""
    source = np.frombuffer(plain, np.uint8)
    return np.concatenate([np.repeat(origin[k : k + STEP_BYTES], np.where(source[k : k + STEP_BYTES] == 32, 3, 1)) for k in range(0, len(plain), STEP_BYTES)])


#: From this many characters on, the best pair comes from a heap; below, from a scan.
_SCAN = 160
_NONE = 1 << 30
_LETTER = "[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]"


def merge(model: PieceModel, stretch: str) -> list[int]:
    """The ids of a normalised stretch."""
    symbols = _merge_scan(model, stretch) if len(stretch) < _SCAN else _merge_heap(model, stretch)
    ids = list(map(model.number.get, symbols))
    if None not in ids:
        return ids
    out: list[int] = []
    for k, symbol in zip(ids, symbols, strict=True):
        if k is not None:
            out.append(k)
        elif model.byte:
            out.extend(model.byte[b] for b in symbol.encode())
        else:
            out.append(model.unknown)
    return out


def _merge_scan(model: PieceModel, stretch: str) -> list[str]:
    rank = model.rank.get
    symbols = list(stretch)
    ranks = [rank(a + b, _NONE) for a, b in zip(symbols, symbols[1:])]
    while ranks:
        best = min(ranks)
        if best == _NONE:
            break
        k = ranks.index(best)
        symbols[k : k + 2] = [symbols[k] + symbols[k + 1]]
        del ranks[k]
        if k < len(ranks):
            ranks[k] = rank(symbols[k] + symbols[k + 1], _NONE)
        if k:
            ranks[k - 1] = rank(symbols[k - 1] + symbols[k], _NONE)
    return symbols


def _merge_heap(model: PieceModel, stretch: str) -> list[str]:
    rank = model.rank.get
    symbols: list[str | None] = list(stretch)
    n = len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, k, a + b) for k, (a, b) in enumerate(zip(symbols, symbols[1:])) if (r := rank(a + b, _NONE)) != _NONE]
    heapq.heapify(heap)
    while heap:
        _, k, joined = heapq.heappop(heap)
        if symbols[k] is None or after[k] >= n or symbols[k] + symbols[after[k]] != joined:
            continue
        gone = after[k]
        symbols[k], symbols[gone] = joined, None
        after[k] = after[gone]
        if after[k] < n:
            before[after[k]] = k
        for left in (before[k], k):
            if left >= 0 and after[left] < n and (r := rank(pair := symbols[left] + symbols[after[left]], _NONE)) != _NONE:
                heapq.heappush(heap, (r, left, pair))
    return [s for s in symbols if s is not None]


class Pairs:
    """Which neighbours join, to what and how early, as sorted arrays: so many stretches are merged at once.

    Symbols are the pieces' numbers; a character without a piece is its code point behind them."""

    def __init__(self, model: PieceModel):
        self.model, self.pieces = model, len(model.pieces)
        points = np.arange(0x110000, dtype=np.int32) + self.pieces
        for p, k in model.number.items():
            if len(p) == 1:
                points[ord(p)] = k
        self.points = points

        def symbol(part: str) -> int | None:
            return int(points[ord(part)]) if len(part) == 1 else model.number.get(part)

        rows = []
        for p, n in model.number.items():
            for k in range(1, len(p)):
                left, right = symbol(p[:k]), symbol(p[k:])
                if left is not None and right is not None:
                    rows.append((left << 32 | right, model.rank[p], n))
        keys, ranks, made = (np.array(x, np.int64) for x in zip(*rows, strict=True)) if rows else (np.empty(0, np.int64),) * 3
        order = np.argsort(keys)
        self.keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.ranks, self.made = np.append(ranks[order], _NONE).astype(np.int32), np.append(made[order], 0).astype(np.int32)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The place of each pair, the last one where the two don't join."""
        key = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self.keys, key)
        at[self.keys[at] != key] = len(self.keys) - 1
        return at.astype(np.int32)

    def merge(self, stretches: list[str]) -> Iterator[tuple[str, bytes]]:
        """Each stretch of at most ``SHORT`` characters and its ids, four bytes each."""
        by_width: dict[int, list[str]] = {}
        for s in stretches:
            by_width.setdefault(_WIDTHS[len(s)], []).append(s)
        for width, own in by_width.items():
            for at in range(0, len(own), STEP_ROWS):
                part = own[at : at + STEP_ROWS]
                sizes = np.fromiter(map(len, part), np.int64, len(part))
                table = np.full((len(part), width), -1, np.int32)
                table[np.arange(width) < sizes[:, None]] = self.points[np.frombuffer("".join(part).encode("utf-32-le"), "<u4")]
                out = self._merged(table)
                ends = ((out >= 0).sum(axis=1) * 4).tolist()
                whole = (out.max(axis=1) < self.pieces).tolist()
                line, step = out.tobytes(), 4 * width
                for k, (s, end) in enumerate(zip(part, ends, strict=True)):
                    ids = line[k * step : k * step + end]
                    yield s, ids if whole[k] else self._spelled(ids)

    def _spelled(self, packed: bytes) -> bytes:
        """Ids with characters that have no piece as byte pieces."""
        model, out = self.model, []
        for k in struct.unpack(f"<{len(packed) // 4}i", packed):
            if k < self.pieces:
                out.append(k)
            elif model.byte:
                out.extend(model.byte[b] for b in chr(k - self.pieces).encode())
            else:
                out.append(model.unknown)
        return _packed(out)

    def _merged(self, table: np.ndarray) -> np.ndarray:
        """Rows of symbols, filled up with -1, when nothing in them joins any more."""
        width, none = table.shape[1], len(self.keys) - 1
        out, column = table.copy(), np.arange(width)
        pairs = self.find(table[:, :-1], table[:, 1:])
        row, rank = np.arange(len(table)), self.ranks[pairs]
        while True:
            here = np.arange(len(row))
            best = rank.argmin(axis=1)
            live = rank[here, best] < _NONE
            if not live.all():
                out[row[~live]] = table[~live]
                table, pairs, row, best = table[live], pairs[live], row[live], best[live]
                here = here[: len(row)]
            if not len(row):
                return out
            made = self.made[pairs[here, best]]
            # What stands behind the right one of the two moves one to the left.
            ahead = column[:-1] > best[:, None]
            table[:, :-1] = np.where(ahead, table[:, 1:], table[:, :-1])
            table[:, -1] = -1
            table[here, best] = made
            pairs[:, :-1] = np.where(ahead[:, :-1], pairs[:, 1:], pairs[:, :-1])
            pairs[:, -1] = none
            inner, led = np.flatnonzero(best < width - 1), np.flatnonzero(best)
            pairs[inner, best[inner]] = self.find(made[inner], table[inner, best[inner] + 1])
            pairs[led, best[led] - 1] = self.find(table[led, best[led] - 1], made[led])
            rank = self.ranks[pairs]


class PieceCodec:
    """Encodes and decodes; keeps the ids of stretches that it has met."""

    def __init__(self, model: PieceModel):
        self.model, self.pairs = model, Pairs(model)
        self._ids: dict[str, bytes] = {}
        # Where no piece has a letter before a character, a stretch may end between them; so too at line ends.
        behind = {b for p in model.number for a, b in zip(p, p[1:]) if re.match(_LETTER, a)}
        apart = "".join(re.escape(chr(k)) for k in range(128) if not chr(k).isalpha() and chr(k) not in behind)
        line = "" if any("\n" in p for p in model.number) else r"\n"
        word = f"{MARK}*{_LETTER}+(?=[{apart}{MARK}]|$)|" if apart and MARK not in behind else ""
        self._stretch = re.compile(f"{word}{MARK}*[^{MARK}{line}]+|{MARK}+" + (f"|{line}" if line else ""))

    def _learn(self, stretches: set[str]) -> None:
        """Puts the ids of all these stretches into the cache, short ones together."""
        known = self._ids
        new = stretches - known.keys()
        if len(known) + len(new) > CACHE:
            known.clear()
            new = stretches
        known.update(self.pairs.merge([s for s in new if len(s) <= SHORT]))
        for s in new:
            if len(s) > SHORT:
                known[s] = _packed(merge(self.model, s))

    def _taken(self, stretches: list[str]) -> bytes:
        """The ids of stretches that are in the cache, where long ones don't stay."""
        return b"".join(map(self._ids.__getitem__, stretches))

    def _forget(self, stretches: Iterable[str]) -> None:
        for s in stretches:
            if len(s) > SHORT:
                self._ids.pop(s, None)

    def _pieces(self, normal: str) -> Iterator[list[str]]:
        """The text's stretches, so many at a time."""
        if not self.model.by_stretch:
            yield [normal] if normal else []
        elif len(normal) <= STEP_BYTES:
            yield self._stretch.findall(normal)
        else:
            found = map(re.Match.group, self._stretch.finditer(normal))
            while own := list(islice(found, STEP_STRETCHES)):
                yield own

    def encode_all(self, texts: Iterable[bytes | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of each text, and the source byte at which each piece begins, with the text's length at the end."""
        held: list[tuple[str, np.ndarray]] = []
        size = 0
        for text in texts:
            normal, origin = normalise(self.model, text or b"")
            held.append((normal.decode(), origin))
            size += len(normal)
            if size >= STEP_BYTES:
                yield from self._encoded(held)
                held, size = [], 0
        yield from self._encoded(held)

    def _encoded(self, held: list[tuple[str, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if len(held) == 1:
            normal, origin = held.pop()
            parts = []
            for own in self._pieces(normal):
                self._learn(every := set(own))
                parts.append(self._taken(own))
                self._forget(every)
            yield self._placed(b"".join(parts), origin)
            return
        found = [[s for own in self._pieces(normal) for s in own] for normal, _ in held]
        self._learn(every := {s for own in found for s in own})
        for own, (_, origin) in zip(found, held, strict=True):
            yield self._placed(self._taken(own), origin)
        self._forget(every)

    def _placed(self, packed: bytes, origin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ids = np.frombuffer(packed, "<i4")
        at = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(self.model.width[ids], out=at[1:])
        return ids, origin[at]

    def encode_array(self, text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
        return next(self.encode_all([text]))

    def encode(self, text: bytes | None) -> tuple[list[int], np.ndarray]:
        ids, places = self.encode_array(text)
        return ids.tolist(), places

    def decode(self, ids: list[int]) -> str:
        """The text of the pieces, without the mark that stands before the first."""
        model, written = self.model, self.model.written
        data = b"".join([written[k] for k in ids])
        if ids and (model.dummy_prefix or model.squeeze):
            first = next((k for k in ids if model.kinds[k] != CONTROL), None)
            if first is not None and model.kinds[first] == NORMAL and data[:1] == b" ":
                data = data[1:]
        try:
            return data.decode()
        except UnicodeDecodeError:
            return _replaced(data)


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}i", *ids)


def _replaced(data: bytes) -> str:
    """UTF-8 with U+FFFD for every single byte that belongs to no whole character."""
    out, at = [], 0
    while at < len(data):
        try:
            out.append(data[at:].decode())
            break
        except UnicodeDecodeError as error:
            out.append(data[at : at + error.start].decode())
            out.append("�")
            at += error.start + 1
    return "".join(out)


_DIGEST = "n_tokens bigint, ids_sha256 string, decoded_sha256 string, covered_bytes bigint"


def encoded_digests(docs: DataFrame, name: str = MODEL) -> DataFrame:
    """doc_id with the number of ids, digests of the ids and of their decoding, and the bytes of the
    text that the pieces' spans cover together."""

    def of() -> Callable[[pa.RecordBatch], list[pa.Array]]:
        codec = PieceCodec(load(name))
        as_text = [str(k) for k in range(len(codec.model.pieces))]

        def make(batch: pa.RecordBatch) -> list[pa.Array]:
            counts, digests, decoded, covered = [], [], [], []
            for own, places in codec.encode_all(bytes_of(batch.column(1))):
                ids = own.tolist()
                counts.append(len(ids))
                digests.append(hashlib.sha256(",".join([as_text[k] for k in ids]).encode()).hexdigest())
                decoded.append(hashlib.sha256(codec.decode(ids).encode()).hexdigest())
                covered.append(int(places[-1] - places[0]))
            return [pa.array(counts, pa.int64()), pa.array(digests, pa.string()), pa.array(decoded, pa.string()), pa.array(covered, pa.int64())]

        return make

    return annotate(docs, ["doc_id", "text"], _DIGEST, of)


def encode(docs: DataFrame, name: str = MODEL) -> DataFrame:
    """doc_id, n_tokens, ids, and starts: the byte of the text at which each piece begins, its length in
    bytes last. The text itself is ``text`` cut at the starts."""

    def of() -> Callable[[pa.RecordBatch], list[pa.Array]]:
        codec = PieceCodec(load(name))

        def make(batch: pa.RecordBatch) -> list[pa.Array]:
            ids, places, ends = [], [], [0]
            for own, at in codec.encode_all(bytes_of(batch.column(1))):
                ids.append(own)
                places.append(at.astype(np.int32))
                ends.append(ends[-1] + len(own))
            offsets = np.array(ends, np.int32)
            return [
                pa.array(np.diff(offsets).astype(np.int64)),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids))),
                pa.ListArray.from_arrays(pa.array(offsets + np.arange(len(offsets), dtype=np.int32)), pa.array(np.concatenate(places))),
            ]

        return make

    return annotate(docs, ["doc_id", "text"], "n_tokens bigint, ids array<int>, starts array<int>", of, BATCH_BYTES)


def decode(encoded: DataFrame, name: str = MODEL) -> DataFrame:
    """doc_id and the text of ``ids``; null ids give null."""

    def of() -> Callable[[pa.RecordBatch], list[pa.Array]]:
        codec = PieceCodec(load(name))

        def make(batch: pa.RecordBatch) -> list[pa.Array]:
            return [pa.array([None if ids is None else codec.decode(ids) for ids in batch.column(1).to_pylist()], pa.string())]

        return make

    return annotate(encoded, ["doc_id", "ids"], "text string", of, read=("ids",))
