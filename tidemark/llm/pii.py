"""Personal data replaced by pseudonyms of the same format, so that equal values stay linked.

A value counts when its check holds: a card number its check digit, a bank account its remainder, a
date the calendar, and so on. The value is read as a number of the set of values of its format, and a
keyed Feistel network permutes that set; where the result is outside the valid ones, it is permuted
again until it is inside, which keeps the whole a permutation. So a pseudonym is as valid as the value,
the same value gives the same pseudonym in every document, different values different ones, and who has
the key can go back. Digits and letters are permuted within their kinds, separators stay.

Any number of a phone's format counts, assigned or not: ten national digits after +1 or alone, nine to
fifteen in all after another +. Whether an area code or exchange begins with 0 or 1 stays as it is.

Digits or capitals beside a value don't hide it: within a run of groups the other starts and lengths are
tried until the check holds, a country's own length first for accounts. Card numbers in groups that no card
has count alone, or between blanks if no group has less than four digits. What stands beside a value can make a longer run pass by chance
(one in ten for cards); then that run is the value, and it may come back with other ends.

Kinds: card and account numbers, phone numbers, social security numbers, IPv4 addresses, mail addresses,
calendar dates, and secrets (access key ids, values of passwords and tokens), which are personal too. A
secret is what is set to a name that holds such a word (client_secret=, AWS_SECRET_KEY:), of any length
from 8 on; it ends before the first character other than ASCII letters, digits and ``_-+/.``.

Only ASCII digits and letters make values; those of other scripts are text like any other, also beside one.
The key comes from the session (``spark.tidemark.pii.key``). On a cluster that names none, each application draws one
at random, as whoever knows the key can undo the pseudonyms; they are undone and linked within that application only,
unless ``key_of`` is asked for the key and it is kept.

Texts are processed whole and row by row; nothing is shuffled. Defined results: a null text stays null
with no finding; an empty one stays empty. The text around a finding is unchanged byte for byte.
"""

from __future__ import annotations

import hashlib
import re
import secrets
from bisect import bisect
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import date
from functools import cache
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import annotate, bytes_of, slices

#: Where a session names its key, and the key of local sessions that name none: tests and trials only.
KEY_SETTING, LOCAL_KEY = "spark.tidemark.pii.key", b"local trials only"
ROUNDS = 8
#: Characters of a secret that are permuted as one number.
BLOCK = 256


class Permutation:
    """A keyed permutation of range(size): a Feistel network over two unequal halves, walked until it
    stays inside."""

    def __init__(self, key: bytes, tweak: str, size: int):
        self.key, self.tweak, self.size = hashlib.blake2b(key, digest_size=32).digest(), tweak.encode(), size
        self.a = isqrt(max(0, size - 1)) + 1
        self.b = -(-size // self.a) if size else 1

    def _mix(self, turn: int, half: int, most: int) -> int:
        data = self.tweak + b"|%d|%d|%d" % (self.size, turn, half)
        if (bits := most.bit_length() + 64) <= 192:
            return int.from_bytes(hashlib.blake2b(data, key=self.key, digest_size=24).digest()) % most
        # As many bits as the half has, or its first characters would stay.
        wide = b"".join(hashlib.blake2b(b"%d|" % k + data, key=self.key).digest() for k in range(-(-bits // 512)))
        return int.from_bytes(wide) % most

    def _once(self, x: int) -> int:
        left, right = divmod(x, self.b)
        for turn in range(0, ROUNDS, 2):
            left = (left + self._mix(turn, right, self.a)) % self.a
            right = (right + self._mix(turn + 1, left, self.b)) % self.b
        return left * self.b + right

    def _back_once(self, x: int) -> int:
        left, right = divmod(x, self.b)
        for turn in range(ROUNDS - 2, -1, -2):
            right = (right - self._mix(turn + 1, left, self.b)) % self.b
            left = (left - self._mix(turn, right, self.a)) % self.a
        return left * self.b + right

    def forth(self, x: int, valid: Callable[[int], bool] = lambda _: True) -> int:
        return self._walk(self._once, x, valid)

    def back(self, x: int, valid: Callable[[int], bool] = lambda _: True) -> int:
        return self._walk(self._back_once, x, valid)

    def _walk(self, step: Callable[[int], int], x: int, valid: Callable[[int], bool]) -> int:
        if self.size < 2:
            return x
        x = step(x)
        while x >= self.size or not valid(x):
            x = step(x)
        return x


_DIGITS, _LOWER, _UPPER, _HEX = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789abcdef"


def _sets(text: str, hexadecimal: bool = False) -> list[str]:
    """The characters that may stand at each place: others of the same kind, or only itself."""
    if hexadecimal and set(text) <= set(_HEX):
        return [_HEX] * len(text)
    return [next((s for s in (_DIGITS, _LOWER, _UPPER) if c in s), c) for c in text]


def _number(text: str, sets: list[str]) -> tuple[int, int]:
    value, size = 0, 1
    for c, s in zip(text, sets, strict=True):
        value, size = value * len(s) + s.index(c), size * len(s)
    return value, size


def _spelled(value: int, sets: list[str]) -> str:
    out = []
    for s in reversed(sets):
        value, k = divmod(value, len(s))
        out.append(s[k])
    return "".join(reversed(out))


def luhn(digits: str) -> int:
    """The remainder that is 0 for a valid number."""
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) << (k & 1)
        total += d - 9 if d > 9 else d
    return total % 10


def iban_ok(text: str) -> bool:
    moved = text[4:] + text[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _into(text: str, digits: str) -> str:
    """The text with its digits replaced in order."""
    given = iter(digits)
    return "".join(next(given) if c in _DIGITS else c for c in text)


_FIRST, _LAST = date(1900, 1, 1).toordinal(), date(2099, 12, 31).toordinal()


@dataclass(frozen=True)
class Pseudonyms:
    """Pseudonyms of each kind of value; ``back`` undoes them."""

    key: bytes
    reverse: bool = False

    def _permute(self, tweak: str, value: int, size: int, valid: Callable[[int], bool] = lambda _: True) -> int:
        p = Permutation(self.key, tweak, size)
        return (p.back if self.reverse else p.forth)(value, valid)

    def _text(self, tweak: str, text: str, hexadecimal: bool = False, valid: Callable[[str], bool] = lambda _: True) -> str:
        sets = _sets(text, hexadecimal)
        value, size = _number(text, sets)
        return _spelled(self._permute(tweak, value, size, lambda x: valid(_spelled(x, sets))), sets)

    def card(self, text: str) -> str | None:
        digits = re.sub(r"[^0-9]", "", text)
        if not 13 <= len(digits) <= 19 or luhn(digits) or len(set(digits)) == 1:
            return None

        def whole(inner: str) -> str:
            body = digits[0] + inner
            return body + str(-luhn(body + "0") % 10)

        return _into(text, whole(self._text(f"card{len(digits)}{digits[0]}", digits[1:-1], valid=lambda d: len(set(whole(d))) > 1)))

    def iban(self, text: str) -> str | None:
        plain = text.replace(" ", "")
        if not 15 <= len(plain) <= 34 or not iban_ok(plain):
            return None
        body = self._text(f"iban{plain[:2]}", plain[4:])
        check = 98 - int("".join(str(int(c, 36)) for c in body + plain[:2] + "00")) % 97
        given = iter(f"{plain[:2]}{check:02d}{body}")
        return "".join(" " if c == " " else next(given) for c in text)

    def ssn(self, text: str) -> str | None:
        def valid(d: str) -> bool:
            return d[:3] not in ("000", "666") and d[0] != "9" and d[3:5] != "00" and d[5:] != "0000"

        digits = re.sub(r"[^0-9]", "", text)
        return _into(text, self._text("ssn", digits, valid=valid)) if valid(digits) else None

    def phone(self, text: str) -> str | None:
        digits = re.sub(r"[^0-9]", "", text)
        if not 9 <= len(digits) <= 15:
            return None
        if text.startswith("+"):
            code = re.match(r"\+([0-9]{1,3})[^0-9]", text)
            keep = code[1] if code else digits[:2]
        else:
            keep = "1" if len(digits) == 11 and digits[0] == "1" else ""
        rest = digits[len(keep) :]
        north_american = keep == "1" or not text.startswith("+")

        if north_american and len(rest) != 10:
            return None

        def valid(d: str) -> bool:
            if north_american:
                return all((d[k] in "01") == (rest[k] in "01") for k in (0, 3))
            return (d[0] == "0") == (rest[0] == "0")

        return _into(text, keep + self._text(f"phone{len(rest)}", rest, valid=valid))

    def ip(self, text: str) -> str | None:
        parts = text.split(".")
        if any(int(p) > 255 or p != str(int(p)) for p in parts):
            return None

        def special(x: int) -> bool:
            a, b = x >> 24, x >> 16 & 255
            return a in (0, 10, 127) or a >= 224 or (a, b) in ((169, 254), (192, 168)) or a == 172 and 16 <= b < 32 or a == 100 and 64 <= b < 128

        value = int.from_bytes(bytes(map(int, parts)))
        kind = special(value)
        return ".".join(map(str, self._permute("ip", value, 1 << 32, lambda x: special(x) == kind).to_bytes(4)))

    def mail(self, text: str) -> str | None:
        local, domain = text.rsplit("@", 1)
        return f"{self._text('mail', local)}@{domain}"

    def date(self, text: str) -> str | None:
        sign = re.search(r"[^0-9]", text)[0]
        a, b, c = text.split(sign)
        first = len(a) == 4
        orders = ((0, 1, 2),) if first else ((2, 0, 1), (2, 1, 0)) if sign == "/" else ((2, 1, 0), (2, 0, 1))
        for order in orders:
            year, month, day = (int((a, b, c)[k]) for k in order)
            try:
                ordinal = date(year, month, day).toordinal()
            except ValueError:
                continue
            if not _FIRST <= ordinal <= _LAST:
                return None

            def written(x: int, order: tuple[int, ...] = order) -> str:
                d = date.fromordinal(x + _FIRST)
                out = [""] * 3
                for k, part in zip(order, (f"{d.year:04d}", f"{d.month:02d}", f"{d.day:02d}"), strict=True):
                    out[k] = part
                return sign.join(out)

            def readable(x: int, order: tuple[int, ...] = order) -> bool:
                """Read again, the pseudonym is taken in the same order as the value."""
                if first or order == orders[0]:
                    return True
                return int(written(x).split(sign)[orders[0][1]]) > 12

            return written(self._permute("date" if order == orders[0] else "date2", ordinal - _FIRST, _LAST - _FIRST + 1, readable))
        return None

    def key_id(self, text: str) -> str | None:
        return text[:4] + self._text("key", text[4:])

    def secret(self, text: str) -> str | None:
        """Whole, in blocks; each block's permutation follows from the pseudonyms of those before it."""
        hexadecimal, out, before = set(text) <= set(_HEX), [], b""
        for at in range(0, len(text), BLOCK):
            given = text[at : at + BLOCK]
            out.append(self._text("secret" + before.hex(), given, hexadecimal))
            before = hashlib.blake2b(before + (given if self.reverse else out[-1]).encode(), digest_size=16).digest()
        return "".join(out)


Make, Free = Callable[[str], "str | None"], Callable[[int, int], bool]
Values = Iterator[tuple[int, int, str]]
_WORD = re.compile(r"\w")


def _plain(pattern: re.Pattern[str]) -> Callable[[str, Make, Free], Values]:
    """Values that are group 1 of a pattern."""

    def read(text: str, make: Make, free: Free) -> Values:
        for m in pattern.finditer(text):
            if free(*m.span(1)) and (new := make(m[1])) is not None:
                yield *m.span(1), new

    return read


_SETTING = re.compile(r"(?<![A-Za-z0-9_\-])([A-Za-z0-9_\-]++)[\"']?+\s*+[=:]\s*+[\"']?+([A-Za-z0-9_\-+/.]{8,}+)")
#: Secretaries and tokenizers are no secrets.
_NAME = re.compile(r"(?i:password|passwd|secret(?!ar[iy]|ion|ive|ly|e[ds]?(?![a-z]))|token(?!i[sz])|api[_-]?key)")


def _secrets(text: str, make: Make, free: Free) -> Values:
    """Values set to a name that holds one of the words, as in db_password or AWS_SECRET_KEY."""
    at = 0
    while m := _SETTING.search(text, at):
        # What follows may itself be a name that is set, as in a=b_token=c.
        named = _NAME.search(m[1]) is not None
        if named and _NAME.search(m[2]) and _SETTING.match(text, m.start(2)):
            named = False
        at = m.end() if named else m.end(1)
        if named and free(*m.span(2)) and (new := make(m[2])) is not None:
            yield *m.span(2), new


# Characters of a bank account number by country.
_IBAN_SIZES = {
    country: size
    for size, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
        23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
        29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for country in countries.split()
}
_IBAN_START = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?= ?[A-Z0-9]{4})")
_IBANS = {n: re.compile(rf"[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{(n - 4) // 4}}}" + (rf" ?[A-Z0-9]{{{(n - 4) % 4}}}" if n % 4 else "") + "(?![A-Za-z0-9])") for n in range(15, 35)}


def _ibans(text: str, make: Make, free: Free) -> Values:
    """At every start the length of its country; then, where nothing was found, the others, the longest first."""
    for lengths in (lambda own: [own] if own else [], lambda own: sorted(_IBANS.keys() - {own}, reverse=True)):
        for start in _IBAN_START.finditer(text):
            for n in lengths(_IBAN_SIZES.get(start[0][:2])):
                m = _IBANS[n].match(text, start.start())
                if m and free(*m.span()) and (new := make(m[0])) is not None:
                    yield *m.span(), new
                    break


_RUN, _GROUP = re.compile(r"(?<![\w+\-])[0-9](?:[ \-]?[0-9]){12,}"), re.compile(r"[0-9]+")
#: Digit groups of printed cards, all with one separator; a single group is one of them too.
_SHAPES = {(4, 4, 4, 4), (4, 6, 5), (4, 6, 4), (4, 4, 4, 4, 3)}


def _cards(loose: bool) -> Callable[[str, Make, Free], Values]:
    """Numbers of 13 to 19 digits within runs of digit groups. First those in the shape of a card, the
    longest first, and whole runs; ``loose``: other stretches of groups of four digits or more between blanks."""

    def read(text: str, make: Make, free: Free) -> Values:
        for run in _RUN.finditer(text):
            groups = [g.span() for g in _GROUP.finditer(text, *run.span())]
            found = []
            for i, (a, _) in enumerate(groups):
                digits = 0
                for j in range(i, len(groups)):
                    b = groups[j][1]
                    digits += b - groups[j][0]
                    if digits > 19:
                        break
                    if digits < 13 or _WORD.match(text, b):
                        continue
                    shape = tuple(y - x for x, y in groups[i : j + 1])
                    shaped = i == j or shape in _SHAPES and len({text[y] for _, y in groups[i:j]}) == 1
                    if loose:
                        apart = (i == 0 or text[a - 1] == " ") and (j + 1 == len(groups) or text[b] == " ")
                        if apart and not shaped and min(shape) >= 4:
                            found.append((0, -digits, a, b))
                    elif shaped or j - i + 1 == len(groups):
                        found.append((0 if shaped else 1, -digits, a, b))
            for _, _, a, b in sorted(found):
                if free(a, b) and (new := make(text[a:b])) is not None:
                    yield a, b, new

    return read


_ABROAD = re.compile(r"\+[0-9]{1,3}[ \-.]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ \-.]?[0-9]{2,4}){1,5}(?![\w])")
_ABROAD_START = re.compile(r"(?<![\w+])\+(?=[0-9])")


def _phones(text: str, make: Make, free: Free) -> Values:
    """Numbers after +: the longest that passes and overlaps nothing found before."""
    for start in _ABROAD_START.finditer(text):
        m = _ABROAD.match(text, a := start.start())
        ends = sorted((g.end() for g in _GROUP.finditer(text, a, m.end())), reverse=True) if m else []
        for b in ends:
            if _ABROAD.fullmatch(text, a, b) and free(a, b) and (new := make(text[a:b])) is not None:
                yield a, b, new
                break


# Kinds in order of precedence: name, what the text must hold at all, and what reads its values.
_KINDS = (
    ("secret", "=:", _secrets),
    ("key_id", "A", _plain(re.compile(r"(?<![A-Za-z0-9])((?:AKIA|ASIA)[A-Z0-9]{16})(?![A-Za-z0-9])"))),
    ("mail", "@", _plain(re.compile(r"(?<![A-Za-z0-9._%+\-])([A-Za-z0-9._%+\-]{1,64}@(?:[A-Za-z0-9\-]{1,63}\.){1,8}[A-Za-z]{2,24})(?![A-Za-z0-9\-])"))),
    ("iban", "", _ibans),
    ("ip", ".", _plain(re.compile(r"(?<![\w.])((?:[0-9]{1,3}\.){3}[0-9]{1,3})(?![\w]|\.[0-9])"))),
    ("date", "-/.", _plain(re.compile(r"(?<![\w.\-/])([0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{4}/[0-9]{2}/[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|[0-9]{2}-[0-9]{2}-[0-9]{4})(?![\w\-/]|\.[0-9])"))),
    ("ssn", "-", _plain(re.compile(r"(?<![\w\-])([0-9]{3}-[0-9]{2}-[0-9]{4})(?![\w\-])"))),
    ("card", "", _cards(loose=False)),
    ("phone", "+", _phones),
    ("phone", "", _plain(re.compile(r"(?<![\w+\-.(])((?:1[ \-.])?(?:\([0-9]{3}\) ?|[0-9]{3}[\-.])[0-9]{3}[\-.][0-9]{4})(?![\w]|[\-.][0-9])"))),
    ("card", "", _cards(loose=True)),
)
_ANY = re.compile(r"[0-9@=:]")


def replace(text: str, names: Pseudonyms) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with pseudonyms, and kind, start and end of each finding in the given text."""
    if not _ANY.search(text):
        return text, []
    starts: list[int] = []
    kept: list[tuple[int, int, str, str]] = []

    def free(start: int, end: int) -> bool:
        k = bisect(starts, start)
        return (k == 0 or kept[k - 1][1] <= start) and (k == len(kept) or kept[k][0] >= end)

    for kind, needs, read in _KINDS:
        if needs and not any(c in text for c in needs):
            continue
        for start, end, new in read(text, getattr(names, kind), free):
            k = bisect(starts, start)
            starts.insert(k, start)
            kept.insert(k, (start, end, kind, new))
    out, at = [], 0
    for start, end, _, new in kept:
        out += [text[at:start], new]
        at = end
    return "".join([*out, text[at:]]), [(kind, start, end) for start, end, kind, _ in kept]


@cache
def _drawn(application: str) -> bytes:
    """An application's own key, which stays in its driver and goes with it."""
    return secrets.token_bytes(32)


def key_of(spark: SparkSession) -> bytes:
    """The session's key; without one that of local trials, or on a cluster one that the application has drawn."""
    if named := spark.conf.get(KEY_SETTING, ""):
        return named.encode()
    context = spark.sparkContext
    return LOCAL_KEY if context.master.startswith("local") else _drawn(context.applicationId)


def pseudonymise(docs: DataFrame, key: bytes | None = None, reverse: bool = False, length: str = "n_chars") -> DataFrame:
    """``docs`` with all its columns, their text replaced. Where a replaced text has another length, the
    column ``length``, if there is one, follows it."""
    names = Pseudonyms(key or key_of(docs.sparkSession), reverse)
    at = docs.columns.index("text")
    size_at = docs.columns.index(length) if length in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                given = [None if t is None else t.decode() for t in bytes_of(part.column(at))]
                made = [None if t is None else replace(t, names)[0] for t in given]
                columns = list(part.columns)
                columns[at] = pa.array(made, part.schema.field(at).type)
                if size_at is not None:
                    sizes = [n if new is None or len(new) == len(old) else len(new) for n, old, new in zip(columns[size_at].to_pylist(), given, made, strict=True)]
                    columns[size_at] = pa.array(sizes, part.schema.field(size_at).type)
                yield pa.RecordBatch.from_arrays(columns, schema=part.schema)

    return docs.mapInArrow(run, docs.schema)


_FOUND = pa.list_(pa.struct([("kind", pa.string()), ("first", pa.int32()), ("last", pa.int32())]))


def findings(docs: DataFrame, key: bytes | None = None) -> DataFrame:
    """doc_id, the replaced text, n_found, and the findings as (kind, first, last) in characters of the
    given text."""
    names = Pseudonyms(key or key_of(docs.sparkSession))

    def of() -> Callable[[pa.RecordBatch], list[pa.Array]]:
        def make(batch: pa.RecordBatch) -> list[pa.Array]:
            texts, spans = [], []
            for t in bytes_of(batch.column(1)):
                new, found = (None, []) if t is None else replace(t.decode(), names)
                texts.append(new)
                spans.append([{"kind": k, "first": a, "last": b} for k, a, b in found])
            return [pa.array(texts, pa.string()), pa.array(spans, _FOUND)]

        return make

    made = annotate(docs.select("doc_id", F.col("text").alias("__given")), ["doc_id", "__given"], "text string, found array<struct<kind:string,first:int,last:int>>", of, read=("__given",))
    return made.select("doc_id", "text", F.size("found").cast("bigint").alias("n_found"), "found")
