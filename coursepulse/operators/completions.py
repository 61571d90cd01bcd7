"""Questions over completed lectures.

A day, week or month is a half-open range on ``completed_at`` that reaches the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.clock import AsOf, as_of_date, day_name, on_day, visible_as_of

# Fixed labels of the two-day comparison.
TODAY_LABEL = "오늘"
YESTERDAY_LABEL = "어제"

# Tie-break after completed_at: the natural lecture key, then the titles.
LECTURE_ORDER = ("section_number", "chapter_number", "lecture_number", "lecture_title", "lecture_time")


def _hours(minutes: Column) -> Column:
    return F.round(minutes / 60, 2)


def _stats() -> list[Column]:
    return [
        F.count("*").alias("lecture_count"),
        F.sum("lecture_time").alias("study_minutes"),
        _hours(F.sum("lecture_time")).alias("study_hours"),
    ]


def _with_title(lectures: DataFrame, courses: DataFrame) -> DataFrame:
    return lectures.join(courses.select("course_id", "course_title"), "course_id")


def completed_today(lectures: DataFrame, courses: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Lectures completed on the day, latest first."""
    return (
        _with_title(lectures.filter(on_day("completed_at", as_of_date(as_of))), courses)
        .select("course_title", "section_title", "lecture_title", "lecture_time", "completed_at")
        .orderBy(F.desc("completed_at"))
    )


def completed_today_stats(lectures: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Count, minutes and hours of the day; one row, sums NULL on an empty day."""
    return lectures.filter(on_day("completed_at", as_of_date(as_of))).agg(*_stats())


def completed_today_by_course(lectures: DataFrame, courses: DataFrame, as_of: AsOf = None) -> DataFrame:
    """The day's count, minutes and hours per course, aggregated before the title is joined."""
    per_course = (
        lectures.filter(on_day("completed_at", as_of_date(as_of))).groupBy("course_id").agg(*_stats())
    )
    return (
        _with_title(per_course, courses)
        .select("course_title", "lecture_count", "study_minutes", "study_hours")
        .orderBy(F.desc("lecture_count"))
    )


def _last_days(lectures: DataFrame, days: int, as_of: AsOf) -> DataFrame:
    """From ``days`` before the day, the day included."""
    return visible_as_of(lectures, "completed_at", as_of).filter(
        F.col("completed_at") >= F.date_sub(as_of_date(as_of), days)
    )


def completed_last_7d(lectures: DataFrame, courses: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Lectures completed in the last seven days and today, latest first."""
    return (
        _with_title(_last_days(lectures, 7, as_of), courses)
        .orderBy(F.desc("completed_at"))
        .select(
            F.to_date("completed_at").alias("completed_date"),
            "course_title", "section_title", "lecture_title", "lecture_time",
        )
    )


def daily_stats_7d(lectures: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Count, minutes and hours per day of the last seven days and today."""
    return daily_stats(_last_days(lectures, 7, as_of)).orderBy(F.desc("completed_date"))


def daily_stats(lectures: DataFrame) -> DataFrame:
    """The figures of ``daily_stats_7d`` for every day."""
    return lectures.groupBy(F.to_date("completed_at").alias("completed_date")).agg(*_stats()).select(
        "completed_date", day_name("completed_date").alias("day_name"), "lecture_count", "study_minutes", "study_hours")


def completed_on(lectures: DataFrame, courses: DataFrame, day: AsOf) -> DataFrame:
    """Lectures completed on a given day with the time of day, earliest first."""
    return (
        _with_title(lectures.filter(on_day("completed_at", as_of_date(day))), courses)
        .orderBy("completed_at")
        .select(
            "course_title", "section_title", "lecture_title", "lecture_time",
            F.date_format("completed_at", "HH:mm:ss").alias("completed_time"),
        )
    )


def month_stats(lectures: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Count, minutes and hours of the month so far, and count per day of the full month."""
    today = as_of_date(as_of)
    first = F.trunc(today, "month")
    in_month = (F.col("completed_at") >= first) & (F.col("completed_at") < F.add_months(first, 1))
    return (
        visible_as_of(lectures, "completed_at", as_of).filter(in_month)
        .agg(*_stats())
        .withColumn("per_day", F.round(F.col("lecture_count") / F.day(F.last_day(today)), 1))
    )


def _completed(lectures: DataFrame, as_of: AsOf) -> DataFrame:
    return visible_as_of(lectures, "completed_at", as_of).filter("is_completed")


def _completion_order() -> list[Column]:
    return [F.desc("completed_at"), *(F.asc(c) for c in LECTURE_ORDER)]


def _recent_columns() -> list[Column | str]:
    return [
        "course_title", "section_title", "lecture_title",
        F.to_date("completed_at").alias("completed_date"), "lecture_time",
    ]


def recent_completed(lectures: DataFrame, courses: DataFrame, limit: int = 50, as_of: AsOf = None) -> DataFrame:
    """First ``limit`` lectures completed until ``as_of`` by course, latest first within a course.

    Each course contributes a row or more, so only the ``limit`` lowest course ids can matter. They
    are found from the id column alone; the wide rows are then joined to that list, which Spark knows to be
    no longer than ``limit``.
    """
    done = _completed(lectures, as_of)
    first_courses = (
        courses.select("course_id", "course_title")
        .join(done.select("course_id").distinct(), "course_id", "left_semi")
        .orderBy("course_id")
        .limit(limit)
    )
    return (
        done.join(first_courses, "course_id")
        .orderBy("course_id", *_completion_order())
        .limit(limit)
        .select(*_recent_columns())
    )


def recent_completed_per_course(
    lectures: DataFrame, courses: DataFrame, n: int = 5, as_of: AsOf = None
) -> DataFrame:
    """Latest ``n`` lectures of every course completed until ``as_of``.

    Spark cuts each group to ``n`` rows before the shuffle, so a hot course does not travel whole.
    """
    latest_first = Window.partitionBy("course_id").orderBy(*_completion_order())
    newest = (
        _completed(lectures, as_of).withColumn("rank", F.row_number().over(latest_first)).filter(F.col("rank") <= n)
    )
    return (
        _with_title(newest, courses)
        .orderBy("course_id", "rank")
        .select("course_id", "rank", *_recent_columns())
    )


def today_vs_yesterday(lectures: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Count and hours of the day and of the day before, from one scan; always two rows."""
    today = as_of_date(as_of)
    yesterday = F.date_sub(today, 1)
    is_today = F.col("completed_at") >= today
    both = lectures.filter((F.col("completed_at") >= yesterday) & (F.col("completed_at") < F.date_add(today, 1)))
    totals = both.agg(
        F.count_if(is_today).alias("n_today"),
        _hours(F.sum(F.when(is_today, F.col("lecture_time")))).alias("h_today"),
        F.count_if(~is_today).alias("n_before"),
        _hours(F.sum(F.when(~is_today, F.col("lecture_time")))).alias("h_before"),
    )
    return totals.select(
        F.stack(
            F.lit(2),
            F.lit(TODAY_LABEL), F.col("n_today"), F.col("h_today"),
            F.lit(YESTERDAY_LABEL), F.col("n_before"), F.col("h_before"),
        ).alias("day_label", "lecture_count", "study_hours")
    )


def weekday_pattern_30d(lectures: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Total count and mean lecture length per weekday of the last 30 days, Sunday first."""
    return (
        _last_days(lectures, 30, as_of)
        .groupBy(
            F.dayofweek("completed_at").alias("day_number"), day_name("completed_at").alias("day_name")
        )
        .agg(
            F.count("*").alias("lecture_count"),
            F.round(F.avg("lecture_time"), 2).alias("avg_minutes"),
        )
        .orderBy("day_number")
        .select("day_name", "lecture_count", "avg_minutes")
    )
