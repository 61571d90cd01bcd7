"""Questions over the weekly progress snapshots.

Joins to ``courses`` happen after the snapshots have been filtered or aggregated to one row per
course. No side is hinted: Spark broadcasts ``courses`` when its measured size allows and sorts
otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clock import AsOf, as_of_date, visible_as_of
from ..functions.text import days_hours, hours_minutes
from .delta import latest_date, latest_week_delta, weekly_delta

# Fixed values of the weekly goal report.
GOAL_MINUTES = 180
OK_MINUTES = 120
GOAL_REACHED = "✅ 목표달성"
GOAL_NEAR = "⚠️ 양호"
GOAL_MISSED = "❌ 미달성"


def _studied(column: str = "weekly_study"):
    """The week's minutes where there was study, else NULL."""
    return F.when(F.col(column) > 0, F.col(column))


def _unfinished(courses: DataFrame) -> DataFrame:
    return courses.filter(F.col("total_lecture_time") > F.col("study_time"))


def _remaining():
    return F.col("total_lecture_time") - F.col("study_time")


def current_week_status(snapshots: DataFrame, courses: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Progress of every course at the newest snapshot date, most studied first."""
    seen = visible_as_of(snapshots, "snapshot_date", as_of)
    return (
        seen.filter(F.col("snapshot_date") == latest_date(seen))
        .join(courses.select("course_id", "course_title"), "course_id")
        .select(
            "course_title", "progress_rate", "study_time",
            hours_minutes(F.col("study_time")).alias("study_hm"), "snapshot_date",
        )
        .orderBy(F.desc("study_time"))
    )


def week_over_week(snapshots: DataFrame, courses: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Study of the newest week per course, courses without any left out."""
    seen = visible_as_of(snapshots, "snapshot_date", as_of)
    return (
        latest_week_delta(seen)
        .filter(F.col("weekly_study") > 0)
        .join(courses.select("course_id", "course_title"), "course_id")
        .select(
            "course_title",
            F.col("weekly_study").alias("weekly_minutes"),
            hours_minutes(F.col("weekly_study")).alias("weekly_hm"),
            "progress_delta", "progress_rate", _remaining().alias("remaining"),
        )
        .orderBy(F.desc("weekly_minutes"))
    )


def trend_4w(snapshots: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Courses, cumulative study and mean progress per week of the last four weeks.

    Progress is averaged as a decimal so that the two-place rounding does not depend on the order
    in which partitions are added up.
    """
    seen = visible_as_of(snapshots, "snapshot_date", as_of).filter(F.col("snapshot_date") >= F.date_sub(as_of_date(as_of), 28))
    return trend(seen).orderBy(F.desc("snapshot_date"))


def trend(snapshots: DataFrame) -> DataFrame:
    """The figures of ``trend_4w`` for every snapshot date."""
    return (
        snapshots.groupBy("snapshot_date")
        .agg(
            F.count_distinct("course_id").alias("course_count"),
            F.sum("study_time").alias("total_study"),
            F.round(F.avg(F.col("progress_rate").cast("decimal(18,6)")), 2).cast("double").alias("avg_progress"),
        )
        .select(
            "snapshot_date", "course_count", "total_study",
            days_hours(F.col("total_study")).alias("total_dh"), "avg_progress",
        )
    )


def weekly_volume_4w(snapshots: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Minutes studied per week of the last four weeks.

    The week before the first one is read as well, as its rows are the base of the first delta.
    """
    today = as_of_date(as_of)
    first_day = F.date_sub(today, 28)
    seen = visible_as_of(snapshots, "snapshot_date", as_of).filter(
        F.col("snapshot_date") >= F.date_sub(first_day, 7)
    )
    return (
        weekly_delta(seen)
        .filter(F.col("snapshot_date") >= first_day)
        .groupBy("snapshot_date")
        .agg(
            F.count_if(F.col("weekly_study") > 0).alias("studied_courses"),
            F.sum("weekly_study").alias("weekly_minutes"),
            F.round(F.avg(_studied()), 2).alias("avg_minutes"),
        )
        .select(
            "snapshot_date", "studied_courses", "weekly_minutes",
            hours_minutes(F.col("weekly_minutes")).alias("weekly_hm"), "avg_minutes",
        )
        .orderBy(F.desc("snapshot_date"))
    )


def course_pattern(snapshots: DataFrame, courses: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Study habit per course over its whole history, courses with two or more weeks."""
    per_course = (
        weekly_delta(visible_as_of(snapshots, "snapshot_date", as_of))
        .groupBy("course_id")
        .agg(
            F.count("*").alias("week_count"),
            F.avg(_studied()).alias("avg_exact"),
            F.max("weekly_study").alias("max_weekly"),
        )
        .filter(F.col("week_count") >= 2)
    )
    facts = courses.select(
        "course_id", "course_title", "progress_rate", _remaining().alias("remaining")
    )
    return (
        per_course.join(facts, "course_id")
        .orderBy(F.desc("avg_exact"))
        .select(
            "course_title", "week_count", F.round("avg_exact", 2).alias("avg_weekly"), "max_weekly",
            "progress_rate", "remaining", hours_minutes(F.col("remaining")).alias("remaining_hm"),
        )
    )


def goal_attainment(
    snapshots: DataFrame, courses: DataFrame, as_of: AsOf = None,
    goal: int = GOAL_MINUTES, near: int = OK_MINUTES,
) -> DataFrame:
    """All minutes of the newest week against the weekly goal; one row even without snapshots."""
    seen = visible_as_of(snapshots, "snapshot_date", as_of)
    total = F.col("total_minutes")
    return (
        latest_week_delta(seen)
        .join(courses.select("course_id"), "course_id")
        .agg(F.max("snapshot_date").alias("snapshot_date"), F.sum("weekly_study").alias("total_minutes"))
        .select(
            "snapshot_date", "total_minutes", hours_minutes(total).alias("total_hm"),
            F.lit(goal).alias("goal_minutes"),
            F.round(F.try_divide(total, F.lit(goal)) * 100, 2).alias("attainment_rate"),
            F.when(total >= goal, GOAL_REACHED).when(total >= near, GOAL_NEAR).otherwise(GOAL_MISSED)
            .alias("status"),
        )
    )


def completion_forecast(snapshots: DataFrame, courses: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Weeks to finish each course at its mean pace of the last four weeks, soonest first.

    The quotient is taken from sum and count, so that a whole number of weeks is not pushed up by
    the rounding error of the mean.
    """
    today = as_of_date(as_of)
    first_day = F.date_sub(today, 28)
    seen = visible_as_of(snapshots, "snapshot_date", as_of).filter(
        F.col("snapshot_date") >= F.date_sub(first_day, 7)
    )
    pace = (
        weekly_delta(seen)
        .filter((F.col("snapshot_date") >= first_day) & (F.col("weekly_study") > 0))
        .groupBy("course_id")
        .agg(F.sum("weekly_study").alias("minutes"), F.count("weekly_study").alias("weeks"))
    )
    facts = _unfinished(courses).select(
        "course_id", "course_title", "progress_rate", _remaining().alias("remaining")
    )
    return (
        facts.join(pace, "course_id")
        .select(
            "course_title", "progress_rate", "remaining",
            F.round(F.col("minutes") / F.col("weeks"), 2).alias("avg_weekly"),
            F.ceil(F.col("remaining") * F.col("weeks") / F.col("minutes")).alias("weeks_left"),
        )
        .withColumn("finish_date", F.date_add(today, (F.col("weeks_left") * 7).cast("int")))
        .orderBy("weeks_left")
    )


def snapshot_history(snapshots: DataFrame, courses: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Every snapshot with its course title, newest first."""
    return (
        visible_as_of(snapshots, "snapshot_date", as_of)
        .join(courses.select("course_id", "course_title"), "course_id")
        .select(
            "snapshot_date", "course_title", "progress_rate", "study_time", "total_lecture_time", "created_at"
        )
        .orderBy(F.desc("snapshot_date"), "course_title")
    )


def idle_courses(
    snapshots: DataFrame, courses: DataFrame, as_of: AsOf = None, weeks: int = 2
) -> DataFrame:
    """Unfinished courses whose last snapshot is older than ``weeks`` or missing."""
    last_seen = (
        visible_as_of(snapshots, "snapshot_date", as_of)
        .groupBy("course_id")
        .agg(F.max("snapshot_date").alias("last_snapshot"))
    )
    overdue = F.col("last_snapshot") < F.date_sub(as_of_date(as_of), 7 * weeks)
    return (
        _unfinished(courses)
        .join(last_seen, "course_id", "left")
        .filter(overdue | F.col("last_snapshot").isNull())
        .select("course_title", "progress_rate", _remaining().alias("remaining"), "last_snapshot")
        .orderBy(F.desc("progress_rate"))
    )
