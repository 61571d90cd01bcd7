"""What the physical plans over stored tables must and must not contain."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from coursepulse.operators import completions as d
from coursepulse.operators import maintenance as m
from coursepulse.operators import selection, snapshots as s
from coursepulse.operators.history import LECTURE_KEY, completion_history
from coursepulse.sources.schemas import COURSES, ITEMS, LECTURES, SNAPSHOTS

DAY = "2024-01-30"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("stored"))
    now = dt.datetime(2024, 1, 30)
    for name, schema, row in [
        ("courses", COURSES, (1, "t", 1.0, 1.0, 9.0, "u", None, True, now)),
        ("lectures", LECTURES, (1, 1, "p", None, None, 1, "l", 1.0, True, 1, now)),
        ("snapshots", SNAPSHOTS, (1, dt.date(2024, 1, 29), 1.0, 1.0, 9.0, now)),
    ]:
        spark.createDataFrame([row], schema).write.parquet(f"{root}/{name}")
    spark.createDataFrame([], ITEMS).write.parquet(f"{root}/items")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    yield {name: spark.read.parquet(f"{root}/{name}") for name in ("courses", "lectures", "snapshots", "items")}
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def plan(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


def build(t):
    return {
        "current_week_status": s.current_week_status(t["snapshots"], t["courses"], DAY),
        "week_over_week": s.week_over_week(t["snapshots"], t["courses"], DAY),
        "weekly_volume_4w": s.weekly_volume_4w(t["snapshots"], DAY),
        "course_pattern": s.course_pattern(t["snapshots"], t["courses"], DAY),
        "goal_attainment": s.goal_attainment(t["snapshots"], t["courses"], DAY),
        "idle_courses": s.idle_courses(t["snapshots"], t["courses"], DAY),
        "completed_today": d.completed_today(t["lectures"], t["courses"], DAY),
        "completed_today_by_course": d.completed_today_by_course(t["lectures"], t["courses"], DAY),
        "recent_completed_per_course": d.recent_completed_per_course(t["lectures"], t["courses"]),
        "coverage_audit": selection.coverage_audit(t["courses"], t["lectures"]),
        "upsert_courses": m.upsert_courses(t["courses"], t["items"], DAY),
        "upsert_snapshots": m.upsert_snapshots(t["snapshots"], t["items"], DAY),
        "upsert_lectures": m.upsert_lectures(t["lectures"], t["items"], DAY),
    }


def test_no_cross_joins_no_python_no_broadcast_by_hint(stored):
    for name, df in build(stored).items():
        text = plan(df)
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "BroadcastHashJoin"):
            assert bad not in text, (name, bad)


def test_day_ranges_reach_the_scan(stored):
    for df in (d.completed_today(stored["lectures"], stored["courses"], DAY), d.month_stats(stored["lectures"], DAY),
               d.today_vs_yesterday(stored["lectures"], DAY), d.weekday_pattern_30d(stored["lectures"], DAY)):
        assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(completed_at", plan(df))


def test_only_needed_columns_are_read(stored):
    assert "ReadSchema: struct<lecture_time:double,completed_at:timestamp>" in plan(d.completed_today_stats(stored["lectures"], DAY))
    assert re.search(r"ReadSchema: struct<course_id:bigint,lecture_time:double>", plan(
        selection.coverage_audit(stored["courses"], stored["lectures"])))


def test_groups_are_cut_before_the_shuffle(stored):
    text = plan(d.recent_completed_per_course(stored["lectures"], stored["courses"], 5))
    assert re.search(r"row_number\(\), 5, Partial", text)
    for df in (selection.coverage_audit(stored["courses"], stored["lectures"]),
               d.completed_today_by_course(stored["lectures"], stored["courses"], DAY)):
        assert "partial_sum(lecture_time" in plan(df)


def test_old_weeks_are_not_shuffled_by_a_snapshot_upsert(stored):
    text = plan(m.upsert_snapshots(stored["snapshots"], stored["items"], DAY))
    history, this_week = text.split("FileScan parquet")[:2]
    assert "Union" in history and "Exchange" not in history
    assert "EqualNullSafe(snapshot_date,2024-01-29)" in text or "EqualTo(snapshot_date,2024-01-29)" in text


@pytest.mark.parametrize("spacing", [1, 1 << 45])
def test_history_spreads_a_hot_key(spark, spacing):
    """A key with most of the log is combined before it is shuffled, however its arrival numbers are spaced."""
    n = 20_003
    rest = F.when(F.col("id") % 5 == 4, F.col("id") % 9)
    log = spark.range(n).select(
        F.coalesce(rest, F.lit(1)).alias("course_id"), F.floor(F.col("id") / 1_000_000).cast("int").alias("section_number"),
        F.when(F.col("id") < 0, 1).alias("chapter_number"), F.floor(F.col("id") / 1_000_000).cast("int").alias("lecture_number"),
        (F.col("id") % 7 != 0).alias("is_completed"),
        F.timestamp_seconds(F.col("id")).alias("observed_at"), (F.col("id") * spacing).alias("seq"))
    df = completion_history(log)
    # Last open observation of course 1, and the first done one after it.
    mine = [i for i in range(n) if i % 5 != 4 or i % 9 == 1]
    start = next(i for i in mine if i > max(j for j in mine if j % 7 == 0))
    row = df.filter("course_id = 1").first()
    assert row.is_completed and row.completed_at == dt.datetime(1970, 1, 1) + dt.timedelta(seconds=start)
    text = plan(df)
    assert "Window" not in text and re.search(r"partial_max\(CASE WHEN", text) and "partial_min(struct" in text
