"""Text helpers shared by the extraction functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the rendered output.
HOUR_UNIT = "시간"
MINUTE_UNIT = "분"
DAY_UNIT = "일"


def column(c: Column | str) -> Column:
    """A column, or the column of that name."""
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column) -> Column:
    """Remove all leading and trailing white space, not spaces only."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def first_group(c: Column, pattern: str, group: int = 1) -> Column:
    """A group of the first match, NULL when there is no match or the group is empty."""
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def whole_number(c: Column) -> Column:
    """The text as an integer, NULL when it is not one."""
    return c.try_cast("bigint")


def hours_minutes(minutes: Column) -> Column:
    """Minutes as hours and minutes; negative values keep the sign in both parts."""
    return F.concat(
        F.floor(minutes / 60).cast("string"), F.lit(HOUR_UNIT + " "),
        F.floor(minutes % 60).cast("string"), F.lit(MINUTE_UNIT),
    )


def days_hours(minutes: Column) -> Column:
    """Minutes as days and hours."""
    return F.concat(
        F.floor(minutes / 1440).cast("string"), F.lit(DAY_UNIT + " "),
        F.floor((minutes % 1440) / 60).cast("string"), F.lit(HOUR_UNIT),
    )
