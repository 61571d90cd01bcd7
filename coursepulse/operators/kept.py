"""Figures that are kept up to date with the tables, and the reports that read them instead of the rows.

A kept table follows from one other table part by part: ``RULES`` say which of its parts change with a part of the other,
and which parts of the other they are made of. A lecture that is opened again takes its completion back, as the days of
its part are counted anew; a week that comes late corrects the one after it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clock import AsOf, as_of_date, day_name
from .completions import TODAY_LABEL, YESTERDAY_LABEL
from .delta import weekly_delta


class Rule(NamedTuple):
    """``source``: the table that a kept one follows from; ``follow``: its parts that change with a part of the source;
    ``needs``: parts of the source that a part is made of; ``make``: its rows from those of the source, which have the
    name of their part in the last column, as the result has."""

    source: str
    follow: Callable[[str], list[str]]
    needs: Callable[[str], list[str]]
    make: Callable[[DataFrame], DataFrame]


def _moved(week: str, days: int) -> list[str]:
    """The part of a week and the one so many days on; rows without a date have a part of their own."""
    try:
        return [week, str(dt.date.fromisoformat(week) + dt.timedelta(days))]
    except (ValueError, OverflowError):
        return [week]


def completion_days(lectures: DataFrame, *by: str) -> DataFrame:
    """Lectures, those with a length, and minutes per course, day of completion and state."""
    return lectures.groupBy(*by, "course_id", F.to_date("completed_at").alias("completed_date"), "is_completed").agg(
        F.count("*").alias("lecture_count"), F.count("lecture_time").alias("timed_count"), F.sum("lecture_time").alias("study_minutes"))


RULES = {
    "completion_days": Rule("lectures", lambda part: [part], lambda part: [part], lambda rows: completion_days(rows, "part")),
    "weekly_deltas": Rule("course_progress_snapshots", lambda week: _moved(week, 7), lambda week: _moved(week, -7), weekly_delta),
}


def _stats(day: Column | None = None) -> list[Column]:
    """The figures of the reports, of one day if it is given; counts are 0 and sums NULL where nothing was completed."""
    def of(column: str) -> Column:
        return F.sum(F.col(column) if day is None else F.when(F.col("completed_date") == day, F.col(column)))

    minutes = of("study_minutes")
    return [F.coalesce(of("lecture_count"), F.lit(0)).alias("lecture_count"), minutes.alias("study_minutes"),
            F.round(minutes / 60, 2).alias("study_hours")]


def _between(days: DataFrame, first: Column, last: Column) -> DataFrame:
    return days.filter((F.col("completed_date") >= first) & (F.col("completed_date") <= last))


def completed_today_stats(days: DataFrame, as_of: AsOf = None) -> DataFrame:
    """``completions.completed_today_stats`` from ``completion_days``."""
    today = as_of_date(as_of)
    return _between(days, today, today).agg(*_stats())


def completed_today_by_course(days: DataFrame, courses: DataFrame, as_of: AsOf = None) -> DataFrame:
    """``completions.completed_today_by_course`` from ``completion_days``."""
    today = as_of_date(as_of)
    return (
        _between(days, today, today).groupBy("course_id").agg(*_stats())
        .join(courses.select("course_id", "course_title"), "course_id")
        .select("course_title", "lecture_count", "study_minutes", "study_hours")
        .orderBy(F.desc("lecture_count"))
    )


def daily_stats_7d(days: DataFrame, as_of: AsOf = None) -> DataFrame:
    """``completions.daily_stats_7d`` from ``completion_days``."""
    today = as_of_date(as_of)
    return (
        _between(days, F.date_sub(today, 7), today).groupBy("completed_date").agg(*_stats())
        .select("completed_date", day_name("completed_date").alias("day_name"), "lecture_count", "study_minutes", "study_hours")
        .orderBy(F.desc("completed_date"))
    )


def month_stats(days: DataFrame, as_of: AsOf = None) -> DataFrame:
    """``completions.month_stats`` from ``completion_days``."""
    today = as_of_date(as_of)
    return _between(days, F.trunc(today, "month"), today).agg(*_stats()).withColumn(
        "per_day", F.round(F.col("lecture_count") / F.day(F.last_day(today)), 1))


def today_vs_yesterday(days: DataFrame, as_of: AsOf = None) -> DataFrame:
    """``completions.today_vs_yesterday`` from ``completion_days``; always two rows."""
    today = as_of_date(as_of)
    yesterday = F.date_sub(today, 1)
    (n_today, _, h_today), (n_before, _, h_before) = _stats(today), _stats(yesterday)
    totals = _between(days, yesterday, today).agg(
        n_today.alias("n_today"), h_today.alias("h_today"), n_before.alias("n_before"), h_before.alias("h_before"))
    return totals.select(F.stack(
        F.lit(2), F.lit(TODAY_LABEL), F.col("n_today"), F.col("h_today"), F.lit(YESTERDAY_LABEL), F.col("n_before"), F.col("h_before"),
    ).alias("day_label", "lecture_count", "study_hours"))


def weekday_pattern_30d(days: DataFrame, as_of: AsOf = None) -> DataFrame:
    """``completions.weekday_pattern_30d`` from ``completion_days``."""
    today = as_of_date(as_of)
    return (
        _between(days, F.date_sub(today, 30), today)
        .groupBy(F.dayofweek("completed_date").alias("day_number"), day_name("completed_date").alias("day_name"))
        .agg(F.sum("lecture_count").alias("lecture_count"),
             F.round(F.try_divide(F.sum("study_minutes"), F.sum("timed_count")), 2).alias("avg_minutes"))
        .orderBy("day_number")
        .select("day_name", "lecture_count", "avg_minutes")
    )
