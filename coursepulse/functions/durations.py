"""Duration texts to minutes, in the three dialects the page sources use."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import HOUR_UNIT, MINUTE_UNIT, column, first_group, strip, whole_number

# Fixed patterns of the duration texts.
WHITE = r"[\s\x1C-\x1F\x85\p{Z}]*"  # no-break and wide spaces too
HOURS_PATTERN = rf"(\d+){WHITE}시간"
MINUTES_PATTERN = rf"(\d+){WHITE}분"


def _clock(c: Column) -> tuple[Column, list[Column]]:
    """Number of colon parts (NULL without a colon) and the first three as integers."""
    parts = F.split(strip(c), ":")
    count = F.when(c.contains(":"), F.size(parts))
    return count, [whole_number(F.get(parts, F.lit(i))) for i in range(3)]


def _worded(c: Column) -> Column:
    hours = whole_number(first_group(c, HOURS_PATTERN))
    minutes = whole_number(first_group(c, MINUTES_PATTERN))
    return F.coalesce(hours * 60, F.lit(0)) + F.coalesce(minutes, F.lit(0))


def _seconds(c: Column) -> Column:
    return F.round(c / 60, 2)


def parse_duration_daily(text: Column | str) -> Column:
    """Minutes to two places: worded form, replaced by h:m:s or m:s where there is a colon.

    A colon form with a non-integer part gives 0; ``duration_rejected`` marks it.
    """
    c = column(text)
    count, (a, b, s) = _clock(c)
    minutes = (
        F.when(count == 3, a * 60 + b + _seconds(s))
        .when(count == 2, a + _seconds(b))
        .otherwise(_worded(c).cast("double"))
    )
    return F.coalesce(F.round(minutes, 2), F.lit(0.0))


def parse_duration_full(text: Column | str) -> Column:
    """As the daily dialect, unrounded; two parts are m:s only if the first exceeds 60, else h:m."""
    c = column(text)
    count, (a, b, s) = _clock(c)
    minutes = (
        F.when(count == 3, a * 60 + b + s / 60)
        .when((count == 2) & (a > 60), a + b / 60)
        .when(count == 2, (a * 60 + b).cast("double"))
        .otherwise(_worded(c).cast("double"))
    )
    return F.coalesce(minutes, F.lit(0.0))


def duration_rejected(text: Column | str) -> Column:
    """True where a two- or three-part colon form holds something that is not an integer."""
    c = column(text)
    count, (a, b, s) = _clock(c)
    bad = ((count == 3) & (a.isNull() | b.isNull() | s.isNull())) | (
        (count == 2) & (a.isNull() | b.isNull())
    )
    return F.coalesce(bad, F.lit(False))


def parse_duration_strict(text: Column | str) -> Column:
    """Minutes, or NULL for anything empty, malformed, zero or negative; bare digits are minutes."""
    c = strip(column(text))
    count, (a, b, s) = _clock(c)
    worded = F.split(c, HOUR_UNIT)
    after = F.get(worded, F.lit(1))
    hours = whole_number(strip(F.get(worded, F.lit(0))))
    rest = whole_number(strip(F.replace(after, F.lit(MINUTE_UNIT), F.lit(""))))
    minutes = (
        F.when(count == 3, a * 60 + b + _seconds(s))
        .when(count == 2, a + _seconds(b))
        .when(count.isNotNull(), F.lit(0.0))
        .when(
            c.contains(HOUR_UNIT),
            F.when(after.contains(MINUTE_UNIT), hours * 60 + rest).otherwise(hours * 60).cast("double"),
        )
        .when(
            c.contains(MINUTE_UNIT),
            whole_number(strip(F.replace(c, F.lit(MINUTE_UNIT), F.lit("")))).cast("double"),
        )
        .when(c.rlike(r"^\d+$"), whole_number(c).cast("double"))
    )
    return F.when(minutes > 0, minutes)
