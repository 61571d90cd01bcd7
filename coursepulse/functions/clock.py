"""Dates. Every operator takes ``as_of`` so that a result can be replayed for any day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import column

AsOf = dt.date | dt.datetime | str | Column | None


def as_of_date(as_of: AsOf = None) -> Column:
    """``as_of`` as a DATE column; None means the current date."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of.cast("date")
    return F.lit(str(as_of)[:10]).cast("date")


def as_of_time(as_of: AsOf = None, data_type="timestamp") -> Column:
    """``as_of`` as a timestamp of the stored column's own type; None means now."""
    if as_of is None:
        return F.current_timestamp().cast(data_type)
    if isinstance(as_of, Column):
        return as_of.cast(data_type)
    return F.lit(str(as_of)).cast(data_type)


def week_start(day: Column | str) -> Column:
    """Monday of the week that ``day`` falls in."""
    return F.trunc(day, "week")


def day_name(ts: Column | str) -> Column:
    """Full English weekday name."""
    return F.date_format(ts, "EEEE")


def on_day(ts: Column | str, day: Column) -> Column:
    """``ts`` falls on ``day``, as a half-open range so that Parquet min/max pruning applies."""
    ts = column(ts)
    return (ts >= day) & (ts < F.date_add(day, 1))


def visible_as_of(df: DataFrame, ts_col: str, as_of: AsOf = None) -> DataFrame:
    """Rows whose ``ts_col`` is not later than the day ``as_of``."""
    return df.filter(F.col(ts_col) < F.date_add(as_of_date(as_of), 1))
