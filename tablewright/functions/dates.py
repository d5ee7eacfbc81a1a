"""ISO-8601 text to timestamps, by integer arithmetic on the parts.

Parts may run over: month 13 is January of the next year and 31 February is a
day in March.  Fraction digits beyond the third are cut, fewer than three are
taken as that many milliseconds, and two-digit years are in the 1900s.  Times
without a zone are taken as UTC.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted date texts and their parts.
ISO_PATTERN = (
    r"^(\d{4}|[+-]\d{6})(?:-?(\d{2})(?:-?(\d{2}))?)?"
    r"(?:[ T]?(\d{2}):?(\d{2})(?::?(\d{2})(?:[,.](\d{1,}))?)?"
    r"(?:(Z)|([+-])(\d{2})(?::?(\d{2}))?)?)?\z"
)
_PARTS = (
    "year", "month", "day", "hour", "minute", "second", "fraction",
    "zulu", "sign", "offset_hour", "offset_minute",
)
# The widest distance from 1970 that a date may have.
LARGEST_MILLIS = 8_640_000_000_000_000


def iso_parts(c: Column) -> Column:
    """The parts of a date text as an array, null where the text is no date.

    One match gives all parts: they are written side by side and split again.
    """
    joined = F.regexp_replace(c, ISO_PATTERN, "|".join(f"${i + 1}" for i in range(len(_PARTS))))
    return F.when(c.rlike(ISO_PATTERN), F.split(joined, r"\|"))


def _part(parts: Column, name: str) -> Column:
    return F.get(parts, F.lit(_PARTS.index(name)))


def _number(parts: Column, name: str) -> Column:
    return F.coalesce(F.nullif(_part(parts, name), F.lit("")).cast("bigint"), F.lit(0))


def _from_zero(parts: Column, name: str) -> Column:
    """A part that counts from 1, as a distance; 0 and nothing count as 1."""
    return F.greatest(_number(parts, name), F.lit(1)) - 1


def iso_precision(c: Column) -> Column:
    """Number of fraction digits, null without a fraction."""
    fraction = F.regexp_extract(c, ISO_PATTERN, _PARTS.index("fraction") + 1)
    return F.length(F.nullif(fraction, F.lit("")))


def iso_is_utc(c: Column) -> Column:
    """True if the text is a date that ends in Z."""
    return c.rlike(ISO_PATTERN) & F.endswith(c, F.lit("Z"))


def millis_of(parts: Column) -> Column:
    """Milliseconds since 1970 of the parts, null beyond the range of dates."""
    year = _number(parts, "year")
    month = _from_zero(parts, "month")
    year = year + F.when(year.between(0, 99), 1900).otherwise(0) + F.floor(month / 12)
    first = F.make_date(year.cast("int"), (month % 12 + 1).cast("int"), F.lit(1))
    days = F.unix_date(first) + _from_zero(parts, "day")
    offset = _number(parts, "offset_hour") * 60 + _number(parts, "offset_minute")
    sign = F.when(_part(parts, "sign") == "+", -1).otherwise(1)
    minutes = days * 1440 + _number(parts, "hour") * 60 + _number(parts, "minute") + sign * offset
    thousandths = F.substring(_part(parts, "fraction"), 1, 3)
    millis = F.coalesce(F.nullif(thousandths, F.lit("")).cast("bigint"), F.lit(0))
    total = (minutes * 60 + _number(parts, "second")) * 1000 + millis
    return F.when(parts.isNotNull() & (F.abs(total) <= LARGEST_MILLIS), total)


def iso_millis_of(text: str) -> int | None:
    """Milliseconds since 1970 of one constant text, worked out in the driver."""
    found = re.match(ISO_PATTERN.replace(r"\z", r"\Z"), text, re.ASCII)
    if not found:
        return None
    part = dict(zip(_PARTS, found.groups(default="")))
    n = {name: int(value) if value.lstrip("+-").isdigit() else 0 for name, value in part.items()}
    years, month = divmod(max(n["month"], 1) - 1, 12)
    year = n["year"] + years + (1900 if 0 <= n["year"] <= 99 else 0)
    if not dt.MINYEAR <= year <= dt.MAXYEAR:
        return None
    days = dt.date(year, month + 1, 1).toordinal() - dt.date(1970, 1, 1).toordinal()
    days += max(n["day"], 1) - 1
    offset = n["offset_hour"] * 60 + n["offset_minute"]
    minutes = days * 1440 + n["hour"] * 60 + n["minute"]
    minutes += -offset if part["sign"] == "+" else offset
    return (minutes * 60 + n["second"]) * 1000 + int(part["fraction"][:3] or 0)


def timestamp_of(parts: Column) -> Column:
    """Timestamp of the parts.

    The parts are used many times over.  Where they can be a column of their own,
    compute them in a projection before this one; Spark keeps the two apart.
    """
    return F.timestamp_millis(millis_of(parts))


def iso_timestamp(c: Column) -> Column:
    """Timestamp of an ISO text, null where the text is no date.

    The lambda holds the parts, so that a single expression matches only once.
    """
    return F.get(F.transform(F.array(iso_parts(c)), timestamp_of), F.lit(0))
