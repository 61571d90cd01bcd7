"""Weekly study from cumulative snapshots.

The week's study is the cumulative value minus the row exactly seven days earlier. It is not the
previous row: after a missed week the whole cumulative value counts.

Both functions also take the kept table ``weekly_deltas``, which has the differences, and then work out nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _since(current: Column, previous: Column) -> Column:
    return current - F.coalesce(previous, F.lit(0))


def weekly_delta(snapshots: DataFrame) -> DataFrame:
    """Snapshots plus ``weekly_study`` and ``progress_delta``, for every week.

    (course_id, snapshot_date) is unique, so a window group holds at most one row per week of
    history. A range frame needs one shuffle where a self-join needs two.
    """
    if "weekly_study" in snapshots.columns:
        return snapshots
    week_before = (
        Window.partitionBy("course_id")
        .orderBy(F.unix_date("snapshot_date"))
        .rangeBetween(-7, -7)
    )
    return snapshots.withColumns({
        "weekly_study": _since(F.col("study_time"), F.max("study_time").over(week_before)),
        "progress_delta": _since(F.col("progress_rate"), F.max("progress_rate").over(week_before)),
    })


def latest_date(snapshots: DataFrame) -> Column:
    """Newest snapshot date as a scalar subquery."""
    return snapshots.select(F.max("snapshot_date")).scalar()


def latest_week_delta(snapshots: DataFrame) -> DataFrame:
    """``weekly_delta`` of the newest date only.

    Reads just the newest date and the one seven days before it, and folds the two rows of a course
    in a hash aggregate instead of sorting the history.
    """
    newest = latest_date(snapshots)
    if "weekly_study" in snapshots.columns:
        return snapshots.filter(F.col("snapshot_date") == newest).drop("created_at")
    two_weeks = snapshots.filter(
        (F.col("snapshot_date") == newest) | (F.col("snapshot_date") == F.date_sub(newest, 7))
    ).withColumn("is_newest", F.col("snapshot_date") == newest)

    def pick(column: str, current: bool) -> Column:
        wanted = F.col("is_newest") if current else ~F.col("is_newest")
        return F.max(F.when(wanted, F.col(column)))

    return (
        two_weeks.groupBy("course_id")
        .agg(
            pick("snapshot_date", True).alias("snapshot_date"),
            pick("progress_rate", True).alias("progress_rate"),
            pick("study_time", True).alias("study_time"),
            pick("total_lecture_time", True).alias("total_lecture_time"),
            pick("study_time", False).alias("prev_study_time"),
            pick("progress_rate", False).alias("prev_progress_rate"),
        )
        .filter(F.col("snapshot_date").isNotNull())
        .select(
            "course_id", "snapshot_date", "progress_rate", "study_time", "total_lecture_time",
            _since(F.col("study_time"), F.col("prev_study_time")).alias("weekly_study"),
            _since(F.col("progress_rate"), F.col("prev_progress_rate")).alias("progress_delta"),
        )
    )
