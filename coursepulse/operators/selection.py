"""Which courses to fetch next, and which ones are not covered by their lectures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clock import AsOf, as_of_time


def courses_to_update(
    courses: DataFrame, course_id: int | None = None, target_only: bool = False,
    skip_recent: bool = False, as_of: AsOf = None,
) -> DataFrame:
    """Ids and urls to fetch; a given ``course_id`` overrides both other options.

    ``skip_recent`` leaves out courses updated within 24 hours before ``as_of``.
    """
    wanted = F.col("url").isNotNull()
    if course_id is not None:
        wanted &= F.col("course_id") == F.lit(course_id)
    else:
        if target_only:
            wanted &= F.col("is_target_course")
        if skip_recent:
            now = as_of_time(as_of, courses.schema["updated_at"].dataType)
            day_before = now - F.expr("INTERVAL 1 DAY")
            wanted &= (F.col("updated_at") < day_before) | F.col("updated_at").isNull()
    return courses.filter(wanted).select("course_id", "url")


def course_lookup(courses: DataFrame) -> DataFrame:
    return courses.select("course_id", "course_title", "url")


def coverage_audit(courses: DataFrame, lectures: DataFrame, tolerance: float = 0.1) -> DataFrame:
    """Courses whose lectures add up to something off by more than ``tolerance`` of the declared length.

    Lectures are summed per course first, with partial sums before the shuffle, so the join sees
    one row per course on both sides.
    """
    collected = lectures.groupBy("course_id").agg(F.sum("lecture_time").alias("collected"))
    expected = F.col("total_lecture_time")
    actual = F.coalesce(F.col("collected"), F.lit(0.0))
    return (
        courses.filter(F.col("url").isNotNull() & (expected > 0))
        .join(collected, "course_id", "left")
        .select(
            "course_id", "url", "course_title", expected.alias("expected_time"),
            actual.alias("actual_time"), (expected - actual).alias("diff"),
        )
        .filter(F.abs("diff") > F.col("expected_time") * tolerance)
        .orderBy(F.desc("diff"))
    )
