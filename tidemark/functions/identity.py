"""Canonical texts and SHA-256 identities as native expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names of the identities' versions.
KEY_SCHEMA = "observation-key/v1"
CONTENT_SCHEMA = "observation-content/v1"
STORED_CONTENT_SCHEMA = "warehouse-content/v1"
TRANSITION_SCHEMA = "state-transition/v1"
REQUEST_SCHEMA = "bounded-request/v1"
BATCH_SCHEMA = "batch-content/v1"
WAREHOUSE_SCHEMA = "warehouse/v1"
UNIT_NAMESPACE = "backfill-unit/v1:"


def packed(text: Column) -> Column:
    """Text as bytes that ``unpacked`` turns back: lowercase hex as the bytes it spells, half as wide, after a 1; any
    other text as it is, after a 0. So equal bytes are equal texts, whatever the ids look like."""
    spelled = F.unhex(text)
    return F.when(F.lower(F.hex(spelled)) == text, F.concat(F.unhex(F.lit("01")), spelled)).otherwise(F.concat(F.unhex(F.lit("00")), F.encode(text, "UTF-8")))


def unpacked(held: Column) -> Column:
    rest = F.substring(held, 2, 2**31 - 1)
    return F.when(F.substring(held, 1, 1) == F.unhex(F.lit("01")), F.lower(F.hex(rest))).otherwise(F.decode(rest, "UTF-8"))


def decimal_text(value: Column) -> Column:
    """Fixed point without trailing zeros of the fraction; any zero is ``0``."""
    plain = F.regexp_replace(value.cast("decimal(38,9)").cast("string"), r"\.?0+$", "")
    zero = value.cast("decimal(38,9)") == F.lit(0)
    return F.when(value.isNull(), F.lit(None).cast("string")).when(zero, "0").otherwise(plain)


def exact_numeric(text: Column) -> Column:
    """True for decimal text that 29 whole and 9 fraction digits hold without rounding."""
    plain = F.regexp_extract(text, r"^-?0*(\d*)(?:\.(\d*?)0*)?$", 0) == text
    whole = F.regexp_extract(text, r"^-?0*(\d*)(?:\.(\d*?)0*)?$", 1)
    fraction = F.regexp_extract(text, r"^-?0*(\d*)(?:\.(\d*?)0*)?$", 2)
    digits = text.rlike(r"^-?(\d+(\.\d*)?|\.\d+)$")
    return F.coalesce(digits & plain & (F.length(whole) <= 29) & (F.length(fraction) <= 9), F.lit(False))


def digest(schema: str, fields: Mapping[str, Column]) -> Column:
    """SHA-256 of compact JSON with sorted keys, ``schema`` among them.

    All values are text. JSON leaves null fields out and doesn't escape what is beyond ASCII, so a null
    or non-ASCII value raises rather than give another identity.
    """
    for_all = {"schema": F.lit(schema), **fields}
    checked = []
    for name in sorted(for_all):
        value = for_all[name].cast("string")
        good = value.isNotNull() & ~value.rlike(r"[^\x00-\x7F]")
        checked.append(F.when(good, value).otherwise(F.raise_error(F.lit(f"identity field {name} must be ASCII text"))).alias(name))
    return F.sha2(F.to_json(F.struct(*checked)), 256)
