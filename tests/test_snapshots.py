import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from coursepulse.functions.clock import week_start
from coursepulse.operators import delta, snapshots as s
from coursepulse.plans.labels import LABELS, with_labels


def by_week(df):
    return {(r.course_id, str(r.snapshot_date)): r.weekly_study for r in df.collect()}


def test_missed_week_counts_in_full(snapshots):
    df = snapshots((1, "2024-01-01", 10.0), (1, "2024-01-08", 25.0), (1, "2024-01-22", 60.0))
    assert by_week(delta.weekly_delta(df)) == {
        (1, "2024-01-01"): 10.0, (1, "2024-01-08"): 15.0, (1, "2024-01-22"): 60.0}


def test_null_and_decreasing_study(snapshots):
    df = snapshots((1, "2024-01-01", None), (1, "2024-01-08", 25.0), (1, "2024-01-15", 20.0), (1, "2024-01-22", None))
    assert by_week(delta.weekly_delta(df)) == {
        (1, "2024-01-01"): None, (1, "2024-01-08"): 25.0, (1, "2024-01-15"): -5.0, (1, "2024-01-22"): None}


def test_frame_and_two_week_forms_equal_the_self_join(snapshots):
    rng = random.Random(7)
    monday = dt.date(2024, 1, 1)
    rows = [
        (c, str(monday + dt.timedelta(weeks=w)), rng.choice([None, *map(float, range(40))]))
        for c in range(60) for w in range(8) if rng.random() < 0.7
    ]
    df = snapshots(*rows)
    prev = df.select(
        "course_id", F.date_add("snapshot_date", 7).alias("snapshot_date"), F.col("study_time").alias("before"))
    joined = df.join(prev, ["course_id", "snapshot_date"], "left").withColumn(
        "weekly_study", F.col("study_time") - F.coalesce("before", F.lit(0)))
    want = by_week(joined)
    assert by_week(delta.weekly_delta(df)) == want
    newest = max(day for _, day in want)
    assert by_week(delta.latest_week_delta(df)) == {k: v for k, v in want.items() if k[1] == newest}


@pytest.mark.parametrize("minutes, status", [
    (119.0, s.GOAL_MISSED), (120.0, s.GOAL_NEAR), (179.0, s.GOAL_NEAR), (180.0, s.GOAL_REACHED)])
def test_goal_thresholds(snapshots, courses, minutes, status):
    row = s.goal_attainment(
        snapshots((1, "2024-01-29", minutes)), courses((1, minutes, 500.0)), "2024-01-30").first()
    assert (row.total_minutes, row.status) == (minutes, status)


def test_goal_has_one_row_without_snapshots(snapshots, courses):
    df = s.goal_attainment(snapshots((1, "2024-01-29", 5.0)).limit(0), courses((1, 0.0, 10.0)), "2024-01-30")
    assert [tuple(r) for r in df.collect()] == [(None, None, None, 180, None, s.GOAL_MISSED)]


def test_negative_remaining_time_keeps_the_sign(snapshots, courses):
    df = s.course_pattern(
        snapshots((1, "2024-01-01", 5.0), (1, "2024-01-08", 9.0)), courses((1, 530.0, 500.0)), "2024-01-30")
    assert df.first().remaining_hm == "-1시간 -30분"


def test_snapshots_after_the_day_are_not_seen(snapshots, courses):
    df = snapshots((1, "2024-01-22", 5.0), (1, "2024-01-29", 50.0))
    assert s.week_over_week(df, courses((1, 5.0, 10.0)), "2024-01-28").first().weekly_minutes == 5.0
    assert s.week_over_week(df, courses((1, 5.0, 10.0)), "2024-01-29").first().weekly_minutes == 45.0


def test_first_of_four_weeks_uses_the_week_before(snapshots):
    df = snapshots((1, "2023-12-25", 30.0), (1, "2024-01-01", 50.0))
    rows = s.weekly_volume_4w(df, "2024-01-29").collect()
    assert [(str(r.snapshot_date), r.weekly_minutes) for r in rows] == [("2024-01-01", 20.0)]


def test_forecast_of_a_whole_number_of_weeks(snapshots, courses):
    rows = [(1, "2024-01-15", 30.0), (1, "2024-01-22", 30.0 + 20.0), (1, "2024-01-29", 50.0 + 50.0)]
    df = s.completion_forecast(snapshots(*rows), courses((1, 100.0, 200.0)), "2024-01-30")
    row = df.first()
    assert (row.weeks_left, str(row.finish_date)) == (3, "2024-02-20")


def test_idle_courses(snapshots, courses):
    df = s.idle_courses(
        snapshots((1, "2024-01-15", 5.0), (2, "2024-01-16", 5.0), (4, "2024-01-01", 5.0)),
        courses((1, 1.0, 9.0), (2, 1.0, 9.0), (3, 1.0, 9.0), (4, 9.0, 9.0)), "2024-01-30")
    assert sorted(r.course_title for r in df.collect()) == ["Course no 1", "Course no 3"]


def test_reports_are_sorted(snapshots, courses):
    df = snapshots((1, "2024-01-29", 5.0), (2, "2024-01-29", 9.0), (3, "2024-01-29", 7.0))
    rows = s.current_week_status(df, courses((1, 0.0, 9.0), (2, 0.0, 9.0), (3, 0.0, 9.0)), "2024-01-30").collect()
    assert [r.study_time for r in rows] == [9.0, 7.0, 5.0]


@pytest.mark.parametrize("day, monday", [
    ("2024-01-01", "2024-01-01"), ("2024-01-07", "2024-01-01"), ("2023-12-31", "2023-12-25"), ("2023-01-01", "2022-12-26")])
def test_week_start(spark, day, monday):
    assert str(spark.range(1).select(week_start(F.lit(day).cast("date"))).first()[0]) == monday


def test_original_labels(snapshots, courses):
    df = s.week_over_week(snapshots((1, "2024-01-29", 5.0)), courses((1, 5.0, 9.0)), "2024-01-30")
    assert with_labels(df, "week_over_week").columns == LABELS["week_over_week"]
