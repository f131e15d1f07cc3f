"""Pacific market days on UTC instants, without a dependence on the session's zone.

Timestamps without a zone hold UTC wall time; ``convert_timezone`` moves them between zones exactly,
in a gap or an overlap of clock changes as elsewhere.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PACIFIC = "America/Los_Angeles"


def _utc(ts: Column) -> Column:
    """A UTC wall time without zone; a value with one is turned into it."""
    return ts.cast("timestamp_ntz")


def pacific_time(ts: Column) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(PACIFIC), _utc(ts))


def pacific_date(ts: Column) -> Column:
    """The market date of an instant."""
    return pacific_time(ts).cast("date")


def day_start(day: Column) -> Column:
    """The UTC wall time at which a Pacific day begins; midnight is never in a gap or overlap there."""
    return F.convert_timezone(F.lit(PACIFIC), F.lit("UTC"), day.cast("timestamp_ntz"))


def day_bounds(day: Column) -> tuple[Column, Column]:
    return day_start(day), day_start(F.date_add(day, 1))


def expected_hours(day: Column) -> Column:
    """23, 24 or 25."""
    first, last = day_bounds(day)
    return F.timestamp_diff("HOUR", first, last).cast("bigint")


def utc_text(ts: Column) -> Column:
    """UTC with six fraction digits and Z."""
    return F.date_format(_utc(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def pacific_text(ts: Column) -> Column:
    """Local time with its offset, as ISO text. Minutes of fraction-free instants only carry seconds."""
    local = pacific_time(ts)
    minutes = F.timestamp_diff("MINUTE", _utc(ts), local)
    sign = F.when(minutes < 0, "-").otherwise("+")
    offset = F.format_string("%s%02d:%02d", sign, (F.abs(minutes) / 60).cast("int"), (F.abs(minutes) % 60).cast("int"))
    whole = F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(local, ".SSSSSS")
    return F.concat(whole, F.when(micros == ".000000", "").otherwise(micros), offset)


#: ISO text with an explicit offset and at most microseconds.
OFFSET_PATTERN = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?(Z|[+-]\d{2}:?\d{2})$"


def parse_instant(text: Column) -> Column:
    """The UTC wall time of ISO text; null unless an offset is spelled out and the time exists."""
    instant = F.try_to_timestamp(text)
    zoned = F.convert_timezone(F.current_timezone(), F.lit("UTC"), instant.cast("timestamp_ntz"))
    return F.when(text.rlike(OFFSET_PATTERN), zoned)
