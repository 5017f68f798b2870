"""Dates and durations found in course feeds and pages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed
from .core import ColumnOrName, blank_to_null, col, strip

_NUMBER = r"[0-9.]+"


def parse_duration(c: ColumnOrName, leading_only: bool = False, strict: bool = False) -> Column:
    """Duration text to hours.

    Text mentioning minutes is divided by 60 and rounded to two digits, text
    mentioning hours and bare numbers are taken as hours, anything else is NULL.
    Minutes are looked for first, so ``'5 hours 30 minutes'`` is 0.08; ``strict``
    adds the two units instead (5.5).

    ``leading_only`` takes the number at the very start of the text (0 when there is
    none) rather than the first number anywhere.
    """
    text = F.trim(col(c).cast("string"))
    lowered = F.lower(text)
    minutes = F.contains(lowered, F.lit("min"))
    hours = F.contains(lowered, F.lit("hour")) | F.contains(lowered, F.lit("hr"))
    if leading_only:
        digits = F.regexp_extract(col(c).cast("string"), f"^({_NUMBER})", 1)
        number = F.when(digits == "", F.lit(0.0)).otherwise(digits.try_cast("double"))
        plain = text.try_cast("double")
    else:
        number = F.regexp_extract(text, f"({_NUMBER})", 1).try_cast("double")
        plain = F.when(F.rlike(text, F.lit(f"^{_NUMBER}$")), text.try_cast("double"))
    parsed = F.when(text == "", F.lit(None).cast("double"))
    if strict:
        h = F.regexp_extract(lowered, r"([0-9]+(?:\.[0-9]+)?)\s*(?:hour|hr)", 1).try_cast("double")
        m = F.regexp_extract(lowered, r"([0-9]+(?:\.[0-9]+)?)\s*min", 1).try_cast("double")
        both = h.isNotNull() & m.isNotNull()
        parsed = parsed.when(both, F.round(h + m / 60.0, 2))
    return parsed.when(minutes, F.round(number / 60.0, 2)).when(hours, number).otherwise(plain)


def parse_feed_date(c: ColumnOrName) -> Column:
    """``month/day/year`` text to a date, NULL when it is not one."""
    return F.to_date(F.try_to_timestamp(F.trim(col(c)), F.lit(fixed.FEED_DATE_FORMAT)))


def parse_iso_date(c: ColumnOrName) -> Column:
    """ISO date or timestamp text to a date, NULL when it is not one."""
    return col(c).try_cast("date")


def parse_page_date(c: ColumnOrName) -> Column:
    """Date text in a known page format to ``yyyy-MM-dd``, else the first such text in it."""
    text = strip(c)
    # A time of day is dropped before the calendar formats are tried.
    day = F.regexp_replace(
        text, r"^([0-9]{4}-[0-9]{1,2}-[0-9]{1,2})T[0-9:]+(\.[0-9]{1,6}Z|Z)?$", "$1"
    )
    tried = [F.try_to_timestamp(day, F.lit(f)) for f in fixed.PAGE_DATE_FORMATS]
    parsed = F.date_format(F.coalesce(*tried), "yyyy-MM-dd")
    found = blank_to_null(F.regexp_extract(text, r"([0-9]{4}-[0-9]{2}-[0-9]{2})", 1))
    return F.coalesce(parsed, found)


def date_parts(c: ColumnOrName) -> list[Column]:
    """``day``, ``month``, ``quarter`` and ``year`` of a date."""
    d = col(c)
    return [
        F.dayofmonth(d).alias("day"),
        F.month(d).alias("month"),
        F.quarter(d).alias("quarter"),
        F.year(d).alias("year"),
    ]


def hours_text(c: ColumnOrName) -> Column:
    """Whole seconds as ``'X.X hours'``; ``''`` for missing or zero seconds.

    The digit is that of the exact binary quotient (halves to even), as formatting a
    double with one decimal gives.
    """
    seconds = col(c).cast("long")
    below = F.floor(seconds / F.lit(360)).cast("long")
    # Only odd multiples of 180 s are ties on paper. There the sign of
    # 20 * quotient - odd number, computed without rounding by splitting the
    # quotient into two short halves, tells which side the double lies on.
    quotient = seconds.cast("double") / F.lit(3600.0)
    shifted = quotient * F.lit(134217729.0)
    high = shifted - (shifted - quotient)
    low = quotient - high
    error = (high * 20 - (below * 2 + 1)) + low * 20
    up = (error > 0) | ((error == 0) & (below % 2 == 1))
    tie = F.pmod(seconds, F.lit(360)) == 180
    tenths = F.when(tie, below + F.when(up, 1).otherwise(0)).otherwise(
        F.floor((seconds + 180) / F.lit(360)).cast("long")
    )
    text = F.concat(
        F.floor(tenths / F.lit(10)).cast("string"), F.lit("."), (tenths % 10).cast("string"), F.lit(" hours")
    )
    return F.when(seconds != 0, text).otherwise("")


_ISO_DURATION = (
    r"^P(?:([0-9]+)Y)?(?:([0-9]+)M)?(?:([0-9]+)W)?(?:([0-9]+)D)?"
    r"(?:T(?:([0-9]+)H)?(?:([0-9]+)M)?(?:([0-9]+)S)?)?"
)
_ISO_UNITS = ["year", "month", "week", "day", "hour", "minute", "second"]


def iso_duration_words(c: ColumnOrName) -> Column:
    """ISO-8601 duration as words (``PT1H30M`` is ``1 hour, 30 minutes``); other text as is."""
    raw = col(c)
    words = []
    for group, unit in enumerate(_ISO_UNITS, start=1):
        digits = blank_to_null(F.regexp_extract(raw, _ISO_DURATION, group))
        plural = F.when(digits.try_cast("decimal(38,0)") == 1, F.lit("")).otherwise(F.lit("s"))
        words.append(F.concat(digits, F.lit(f" {unit}"), plural))
    text = F.concat_ws(", ", *words)
    return F.when(text != "", text).otherwise(strip(raw))
