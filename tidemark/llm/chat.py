"""Chat formatting with a template taken as a black box.

A template turns the turns of a conversation into a text. Where a turn landed in that text is found by
rendering successive prefixes: while each output begins with the one before, what it adds is the turn's
span. Within the span the turn's own text is located by rendering again with a probe in its place. Where
an output does not begin with the one before, the template rewrites history; the spans are then found in
the last output only, by probing each turn of the whole conversation.

The default template marks turns with control strings and escapes these within texts, by a backslash
behind their first character (one more if there are some already), so that the formatted text can be
taken apart again exactly: an escaped text holds no control string, and as control strings have their
first character nowhere else, none arises where texts and marks meet.

A template is a black box, so n turns take 2n outputs of it, each as long as what is there by then: the work is
quadratic in copied bytes, though not in passes of the escapes. 2,000 turns take about 0.3 s.

A conversation is formatted in one row of one task; its turns are gathered by one shuffle of ids and
texts. Turns stand in order of (turn, role, text), nulls first. Defined results: a null text or role is an
empty one; a null conversation id is a conversation of its own; repeated rows are repeated turns.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import annotate

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]

BEGIN, END = "<s>", "</s>"
# What stands before and behind the text of a turn of each role; any other role is spelled out.
_MARKS = {"system": ("[SYS]", "[/SYS]"), "user": ("[INST]", "[/INST]"), "assistant": ("[OUT]", END)}
_OTHER = ("[ROLE]", "[TEXT]", "[/ROLE]")
_CONTROL = re.compile(r"([<\[])(\\*)(/?s>|/?(?:SYS|INST|ROLE)\]|(?:OUT|TEXT)\])")
_ESCAPED = re.compile(r"([<\[])\\(\\*)(/?s>|/?(?:SYS|INST|ROLE)\]|(?:OUT|TEXT)\])")


def escape(text: str) -> str:
    return _CONTROL.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


class Marks:
    """The default template. It holds its last outputs: where a prefix of the turns is that of one of them, only the
    last turn is written anew, so successive prefixes of a conversation cost a copy each and no pass of escapes."""

    def __init__(self) -> None:
        self._last: list[tuple[list[Turn], str]] = []

    def __call__(self, turns: list[Turn]) -> str:
        done, out = next(((n, text) for own, text in self._last if (n := len(own)) == len(turns) - 1 and own == turns[:n]), (0, BEGIN))
        out = "".join([out, *(self._turn(*turn) for turn in turns[done:])])
        # A probe in place of the last turn starts from the prefix before it, two outputs back.
        self._last = [*self._last[-2:], (list(turns), out)]
        return out

    @staticmethod
    def _turn(role: str, text: str) -> str:
        if role in _MARKS:
            before, behind = _MARKS[role]
            return f"{before}{escape(text)}{behind}"
        return f"{_OTHER[0]}{escape(role)}{_OTHER[1]}{escape(text)}{_OTHER[2]}"


def default_template(turns: list[Turn]) -> str:
    return Marks()(turns)


_TURN = re.compile(
    "|".join(
        [*(f"{re.escape(a)}(?P<{role}>.*?){re.escape(b)}" for role, (a, b) in _MARKS.items()), f"{re.escape(_OTHER[0])}(?P<role>.*?){re.escape(_OTHER[1])}(?P<text>.*?){re.escape(_OTHER[2])}"]
    ),
    re.DOTALL,
)


def read_back(formatted: str) -> list[Turn]:
    """The turns of a text that the default template made."""
    if not formatted.startswith(BEGIN):
        raise ValueError("not a formatted conversation")
    turns, at = [], len(BEGIN)
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if m is None:
            raise ValueError(f"no turn at {at}")
        found = m.groupdict()
        if found["role"] is not None:
            turns.append((unescape(found["role"]), unescape(found["text"])))
        else:
            turns += [(role, unescape(found[role])) for role in _MARKS if found[role] is not None]
        at = m.end()
    return turns


@dataclass
class Rendered:
    """The formatted text; of each turn the span of its text; whether history was rewritten."""

    text: str
    spans: list[tuple[int, int]]
    rewrites: bool


_PROBE = "\x02probe\x03"


def _common(a: str, b: str) -> int:
    """The length of the common beginning, by halving."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def _located(template: Template, turns: list[Turn], k: int, output: str, before: str) -> tuple[int, int]:
    """Where the text of turn k stands in ``output``, which the template made of ``turns`` and which begins with
    ``before``, what it made of the turns before k (or nothing)."""
    role, probe, start = turns[k][0], _PROBE, len(before)
    while output.find(probe, start) >= 0:
        probe += _PROBE[-1]
    probed = template([*turns[:k], (role, probe), *turns[k + 1 :]])
    at = probed.find(probe, start) if probed.startswith(before) else -1
    if at < 0 or probed[start:at] != output[start:at]:
        # The template leaves the text out, or changes what is before it: nothing can be told apart.
        at = _common(probed, output)
        return at, at
    behind = len(probed) - at - len(probe)
    end = len(output) - behind
    if end < at or output[end:] != probed[at + len(probe) :]:
        return at, at
    return at, end


def render(template: Template, turns: list[Turn]) -> Rendered:
    """Formats turn by turn, comparing each output with the one before. Of a template that rewrites nothing, each
    turn costs two outputs and a comparison of what they begin with, and beyond that work on the turn alone."""
    before, spans, rewrites = template([]), [], False
    for k in range(len(turns)):
        output = template(turns[: k + 1])
        if not output.startswith(before):
            rewrites = True
            break
        spans.append(_located(template, turns[: k + 1], k, output, before))
        before = output
    if rewrites:
        before = template(turns)
        spans = [_located(template, turns, k, before, "") for k in range(len(turns))]
    return Rendered(before, spans, rewrites)


def conversations(rows: DataFrame) -> DataFrame:
    """(conv_id, turns): a row for each conversation, its turns an ordered array of (turn, role, text)."""
    turn = F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.select("conv_id", turn.alias("t")).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def format_conversations(rows: DataFrame, template: Template | None = None, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """conv_id, the formatted text, the spans [first, last) of its characters that are under the loss mask,
    and whether the template rewrites history, for each conversation of (conv_id, turn, role, text)."""

    def of() -> Callable[[pa.RecordBatch], list[pa.Array]]:
        made_by = template or Marks()

        def make(batch: pa.RecordBatch) -> list[pa.Array]:
            texts, masks, rewrites = [], [], []
            for turns in batch.column(1).to_pylist():
                own = [(t["role"], t["text"]) for t in turns]
                made = render(made_by, own)
                texts.append(made.text)
                masks.append([{"first": a, "last": b} for (role, _), (a, b) in zip(own, made.spans, strict=True) if role in loss_roles])
                rewrites.append(made.rewrites)
            return [pa.array(texts, pa.string()), pa.array(masks, pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))), pa.array(rewrites, pa.bool_())]

        return make

    return annotate(conversations(rows), ["conv_id", "turns"], "formatted string, loss array<struct<first:int,last:int>>, rewrites boolean", of, read=("turns",))


def digest(formatted: DataFrame) -> DataFrame:
    """The columns of the contract, read back from the formatted texts and their masks."""

    def of() -> Callable[[pa.RecordBatch], list[pa.Array]]:
        def make(batch: pa.RecordBatch) -> list[pa.Array]:
            rows = []
            for text, mask in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                turns = read_back(text)
                learned = "".join(unescape(text[m["first"] : m["last"]]) for m in mask)
                whole = "".join(f"{role}\n{own}\n" for role, own in turns)
                rows.append((len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest(), len(text)))
            types = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            return [pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]

        return make

    return annotate(formatted, ["conv_id", "formatted", "loss"], "n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint", of, read=("formatted", "loss"))
