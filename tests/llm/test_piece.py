"""SentencePiece coding against the library, and offsets against the text."""

from __future__ import annotations

import hashlib
import random
import struct
from collections import Counter

import numpy as np
import pytest
import sentencepiece

from tidemark.llm import piece
from tidemark.llm.common import table

ODD = ["", " ", "   ", "  a  b ", " hello\nworld\t", "</s><s> x", "▁a▁b", "▁▁ ▁x", "\x00a", "áﬁ ①", "😀 é", "﻿x", "a" * 3000, "ab " * 500, "<0x0A>", "中文 字" * 100, " " * 400 + "x", "á‍🏳️", "x" + " " * 900]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=piece.model_path(piece.MODEL))


@pytest.fixture(scope="module")
def codec():
    return piece.PieceCodec(piece.load())


def test_odd_texts(library, codec):
    for text in ODD:
        ids, places = codec.encode(text.encode())
        assert ids == library.encode(text)
        assert codec.decode(ids) == library.decode(ids)
        assert b"".join(text.encode()[a:b] for a, b in zip(places, places[1:])) == text.encode()


def test_any_ids_decode(library, codec):
    random.seed(3)
    for _ in range(300):
        ids = [random.randrange(3, 32000) if random.random() < 0.6 else random.randrange(3, 259) for _ in range(random.randrange(1, 9))]
        assert codec.decode(ids) == library.decode(ids)


def test_heap_and_scan_agree():
    model = piece.load()
    random.seed(5)
    for _ in range(200):
        text = "".join(random.choice("▁▁abthei ") for _ in range(random.randrange(1, 90)))
        assert piece._merge_scan(model, text) == piece._merge_heap(model, text)


def test_table(spark, sf, library):
    docs = table(spark, sf, "documents")
    want = []
    for r in docs.select("doc_id", "text").collect():
        ids = library.encode(r.text or "")
        want.append((r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest(), len((r.text or "").encode())))
    assert Counter(map(tuple, piece.encoded_digests(docs).collect())) == Counter(want)


def test_odd_rows_and_round_trip(spark):
    rows = [(k, t, 1) for k, t in enumerate(ODD)] + [(0, ODD[4], 1), (None, "null id", 2), (99, None, 3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, ids int")
    coded = piece.encode(docs)
    assert coded.columns == ["doc_id", "n_tokens", "ids", "starts"]
    back = Counter((r.doc_id, r.text) for r in piece.decode(coded).collect())
    assert back == Counter((k, (t or "").replace("▁", " ")) for k, t, _ in rows)
    assert piece.encode(docs.limit(0)).collect() == piece.encoded_digests(docs.limit(0)).collect() == []


def compiled(keys: dict[bytes, bytes]) -> bytes:
    """A character map of these keys: a double array laid out node by node."""
    texts, at = b"", {}
    for value in keys.values():
        at[value] = len(texts)
        texts += value + b"\0"
    units, used = {0: 0}, {0}

    def lay(node, prefix):
        children = sorted({k[len(prefix)] for k in keys if k.startswith(prefix) and len(k) > len(prefix)})
        labels = children + ([0] if prefix in keys else [])
        if not labels:
            return
        base = next(b for b in range(1, 1 << 20) if all((node ^ b ^ c) not in used for c in labels) and b < 1 << 21)
        used.update(node ^ base ^ c for c in labels)
        units[node] = units.get(node, 0) | base << 10 | (256 if prefix in keys else 0)
        if prefix in keys:
            units[node ^ base] = 1 << 31 | at[keys[prefix]]
        for c in children:
            units[node ^ base ^ c] = c
            lay(node ^ base ^ c, prefix + bytes([c]))

    lay(0, b"")
    size = max(units) + 1
    return struct.pack("<I", 4 * size) + struct.pack(f"<{size}I", *(units.get(k, 0) for k in range(size))) + texts


def test_character_map_takes_the_longest_prefix():
    cmap = piece.CharacterMap(compiled({b"a": b"1", b"abc": b"xy", "é".encode(): b"e", b"b": b""}))
    assert cmap.longest(b"abcd", 0) == (3, b"xy")
    assert cmap.longest(b"abd", 0) == (1, b"1")
    assert cmap.longest("é".encode(), 0) == (2, b"e")
    assert cmap.longest(b"b", 0) == (1, b"")
    assert cmap.longest(b"z", 0) is None


def varint(n):
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def with_rules(rule: str, squeeze: bool, prefix: bool = True) -> bytes:
    """The public model with a normaliser of the library's own rules behind its own; nothing is trained."""
    given = sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=prefix, escape_whitespaces=True, remove_extra_whitespaces=squeeze).serialized_model_proto()
    spec = next(bytes(v) for k, v in piece._fields(given) if k == 3)
    with open(piece.model_path(piece.MODEL), "rb") as file:
        return file.read() + b"\x1a" + varint(len(spec)) + spec


TRICKY = [
    "ﬁne ﬂow", "①②③ Ⅳ", "ＦＵＬＬ　ｗｉｄｔｈ", "e\u0301le\u0300ve", "  two  spaces  ", "\u3000ideographic\u3000", "½ cup ¼", "ｶﾞｷﾞ ﾊﾟ", "a\u00a0b\u2003c", "\u200bzero\u200b width", "가각 \u1112\u1161\u11ab", "line\nline\r\n\ttab",
    "㍿ ㌔ ﷺ", "x\u0000y", "Ω K Å", "…‥", "", " ", "\u3000", "ß ﬀ ŉ", "中文字 ①", "😀\ufe0f é", "ŐőŰű Ĳ ĳ",
]


@pytest.mark.parametrize("rule, squeeze, prefix", [("nmt_nfkc", True, True), ("nfkc", True, True), ("nmt_nfkc_cf", True, True), ("nmt_nfkc", False, True), ("nfkc_cf", False, True), ("nmt_nfkc", True, False), ("identity", True, True)])
def test_normalising_models_agree_with_the_library(rule, squeeze, prefix):
    """Normalised bytes, the source of each of them, and the pieces' spans."""
    made = with_rules(rule, squeeze, prefix)
    own, library = piece.PieceModel(made), sentencepiece.SentencePieceProcessor(model_proto=made)
    plain = sentencepiece.SentencePieceNormalizer(model_proto=made)
    codec = piece.PieceCodec(own)
    random.seed(11)
    words = " ".join(TRICKY).split(" ")
    texts = TRICKY + [" ".join(random.choice(words) for _ in range(random.randrange(1, 30))) for _ in range(60)]
    for text in texts:
        normal, origin = piece.normalise(own, text.encode())
        assert normal.decode() == plain.normalize(text)
        chars = {len(text[:k].encode()): k for k in range(len(text) + 1)}
        expected = plain.normalize(text, with_offsets=True)[1]
        begins = [k for k in range(len(normal)) if normal[k] & 0xC0 != 0x80] + [len(normal)]
        if normal:
            assert [chars[int(origin[k])] for k in begins] == list(expected), text
        ids, places = codec.encode(text.encode())
        assert ids == library.encode(text)
        assert len(places) == len(ids) + 1 and (np.diff(places) >= 0).all()
        if ids:
            spans = library.encode(text, return_type="proto").pieces
            # Byte pieces of one character share its place; the library gives the last of them its span.
            whole = {k for k, p in enumerate(spans) if own.kinds[p.id] != piece.BYTE} | {len(ids)}
            pairs = [k for k in range(len(ids)) if k in whole and k + 1 in whole]
            assert [(places[k], places[k + 1]) for k in pairs] == [(spans[k].begin, spans[k].end) for k in pairs], text
        assert codec.decode(ids) == library.decode(ids)


def test_normalisation_with_alignment():
    model = piece.load()
    own = piece.PieceModel.__new__(piece.PieceModel)
    own.__dict__ = dict(model.__dict__, charsmap=piece.CharacterMap(compiled({"ﬁ".encode(): b"fi", b"\t": b" "})), squeeze=True)
    text = "  aﬁ \t b ".encode()
    normal, origin = piece.normalise(own, text)
    assert normal.decode() == "▁afi▁b"
    assert origin.tolist() == [2, 2, 2, 2, 3, 3, 6, 6, 6, 9, 10]
    plain, at = piece.normalise(model, " aé".encode())
    assert plain.decode() == "▁▁aé" and at.tolist() == [0, 0, 0, 0, 0, 0, 1, 2, 3, 4]
    assert piece.normalise(own, b"   ")[0] == b"" and np.array_equal(piece.normalise(own, b"")[1], [0])


def test_many_stretches_at_once_agree_with_one_by_one(library):
    codec, model = piece.PieceCodec(piece.load()), piece.load()
    random.seed(8)
    stretches = sorted({"".join(random.choice("▁abtheinglosc.,$#é\n中😀") for _ in range(random.randrange(1, piece.SHORT + 1))) for _ in range(4000)})
    assert dict(codec.pairs.merge(stretches)) == {s: piece._packed(piece.merge(model, s)) for s in stretches}


def test_small_cache_and_steps_change_nothing(library, monkeypatch):
    for name, value in (("CACHE", 5), ("STEP_BYTES", 64), ("STEP_STRETCHES", 3), ("STEP_ROWS", 2)):
        monkeypatch.setattr(piece, name, value)
    texts = [*ODD, "one two three four five six seven eight nine ten " * 9]
    own = list(piece.PieceCodec(piece.load()).encode_all(t.encode() for t in texts))
    for text, (ids, places) in zip(texts, own, strict=True):
        assert ids.tolist() == library.encode(text)
        assert b"".join(text.encode()[a:b] for a, b in zip(places, places[1:])) == text.encode()


def test_very_long_texts(library):
    random.seed(2)
    for text in ("x" * 200_000, "word " * 300_000, " " * 100_000 + "a", "".join(random.choice("aeiou \n") for _ in range(1_500_000))):
        ids, places = piece.PieceCodec(piece.load()).encode(text.encode())
        assert ids == library.encode(text) and places[0] == 0 and places[-1] == len(text) and (np.diff(places) >= 0).all()
