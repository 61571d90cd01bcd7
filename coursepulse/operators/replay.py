"""Reports for every day of a range in one pass.

Most reports look back from ``as_of`` over a fixed number of days. Their figures per day or week do not depend on ``as_of``, so
they are made once, from the days that any of the wanted ones looks back on, and each row is then given to the days whose
window holds it. A report of thirty days reads the facts once, not thirty times, and only rows that are aggregated
already are multiplied.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.clock import AsOf, as_of_date
from .completions import daily_stats
from .snapshots import trend


def days_between(first: Column, last: Column) -> Column:
    """The days from ``first`` to ``last`` as an array, empty where there is none."""
    return F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<date>"))


def spread(rows: DataFrame, day: str, first: AsOf, last: AsOf, window: int) -> DataFrame:
    """``rows`` for each ``as_of`` from ``first`` to ``last`` whose window of ``window`` days back holds the row's ``day``."""
    from_day = F.greatest(as_of_date(first), F.col(day))
    to_day = F.least(as_of_date(last), F.date_add(F.col(day), window))
    return rows.select(F.explode(days_between(from_day, to_day)).alias("as_of"), *rows.columns)


def trend_4w_days(snapshots: DataFrame, first: AsOf, last: AsOf) -> DataFrame:
    """``trend_4w`` with its ``as_of``, for every day of the range."""
    seen = snapshots.filter((F.col("snapshot_date") >= F.date_sub(as_of_date(first), 28)) & (F.col("snapshot_date") <= as_of_date(last)))
    return spread(trend(seen), "snapshot_date", first, last, 28)


def daily_stats_7d_days(lectures: DataFrame, first: AsOf, last: AsOf) -> DataFrame:
    """``daily_stats_7d`` with its ``as_of``, for every day of the range."""
    at = F.col("completed_at")
    seen = lectures.filter((at >= F.date_sub(as_of_date(first), 7)) & (at < F.date_add(as_of_date(last), 1)))
    return spread(daily_stats(seen), "completed_date", first, last, 7)


def idle_courses_days(snapshots: DataFrame, courses: DataFrame, first: AsOf, last: AsOf, weeks: int = 2) -> DataFrame:
    """``idle_courses`` with its ``as_of``, for every day of the range.

    A snapshot is the last one of its course until the next. So each gives one stretch of idle days, which
    begins after ``weeks`` and ends before the next snapshot; the time before the first snapshot is a stretch as well.
    Of the snapshots before the range only the newest of each course counts.
    """
    start, end = as_of_date(first), as_of_date(last)
    seen = snapshots.filter(F.col("snapshot_date") <= end).select("course_id", "snapshot_date")
    before = seen.filter(F.col("snapshot_date") < start).groupBy("course_id").agg(F.max("snapshot_date").alias("snapshot_date"))
    dates = before.unionByName(seen.filter(F.col("snapshot_date") >= start).distinct())
    unfinished = courses.filter(F.col("total_lecture_time") > F.col("study_time")).select(
        "course_id", "course_title", "progress_rate", (F.col("total_lecture_time") - F.col("study_time")).alias("remaining"))
    # A row without a date stands for the time before the first snapshot.
    none = unfinished.select("course_id", F.lit(None).cast("date").alias("snapshot_date"))
    following = F.lead("snapshot_date").over(Window.partitionBy("course_id").orderBy(F.col("snapshot_date").asc_nulls_first()))
    stretches = dates.unionByName(none).withColumn("following", following)
    idle_from = F.coalesce(F.greatest(start, F.date_add(F.col("snapshot_date"), 7 * weeks + 1)), start)
    idle_to = F.coalesce(F.date_sub(F.col("following"), 1), end)
    idle = stretches.select("course_id", F.col("snapshot_date").alias("last_snapshot"),
                            F.explode(days_between(idle_from, F.least(idle_to, end))).alias("as_of"))
    return unfinished.join(idle, "course_id").select("as_of", "course_title", "progress_rate", "remaining", "last_snapshot")
