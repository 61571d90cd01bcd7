import datetime as dt

import pytest
from pyspark.sql import functions as F

from coursepulse.operators import completions, replay, snapshots as progress

from .conftest import values

DAYS = [dt.date(2024, 1, 1) + dt.timedelta(n) for n in range(0, 45, 4)]
FIRST, LAST = "2024-01-03", "2024-02-06"


def each_day(report):
    """The report of every day of the range, with its day."""
    days = [dt.date.fromisoformat(FIRST) + dt.timedelta(n) for n in range(35)]
    return sorted(((day, *row) for day in days for row in report(str(day))), key=repr)


def snapshot_rows():
    return [(course, str(day), float(10 * course + i)) for course in (1, 2, 3) for i, day in enumerate(DAYS) if (course + i) % 3 or course == 3]


def test_trend_of_every_day(snapshots):
    rows = snapshots(*snapshot_rows())
    got = replay.trend_4w_days(rows, FIRST, LAST)
    assert values(got) == each_day(lambda day: progress.trend_4w(rows, day).collect())


def test_idle_courses_of_every_day(snapshots, courses):
    rows = snapshots(*[(1, "2023-10-02", 5.0), (1, "2023-12-04", 5.0), (2, "2024-01-08", 1.0), (3, "2024-01-29", 1.0), (3, "2024-02-05", 2.0),
                       (4, "2024-01-01", 1.0), (5, "2024-03-04", 1.0), (9, "2024-01-01", 1.0)])
    held = courses(*[(c, 10.0, 5.0 if c == 4 else 100.0 + c) for c in range(1, 8)])
    got = replay.idle_courses_days(rows, held, FIRST, LAST)
    assert values(got) == each_day(lambda day: progress.idle_courses(rows, held, day).collect())
    assert replay.idle_courses_days(rows.limit(0), held.limit(0), FIRST, LAST).count() == 0


def test_daily_stats_of_every_day(lectures):
    rows = lectures(*[(1, 1, None, n, 10.0, f"{day} {n % 24:02}:30:00") for n, day in enumerate(DAYS)], (1, 1, None, 99, 5.0, None))
    got = replay.daily_stats_7d_days(rows, FIRST, LAST)
    assert values(got) == each_day(lambda day: completions.daily_stats_7d(rows, day).collect())


def test_only_aggregated_rows_are_spread(snapshots):
    """Rows are grouped by their date before they are given to days."""
    plan = replay.trend_4w_days(snapshots(*snapshot_rows()), FIRST, LAST)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("Aggregate")


@pytest.mark.parametrize(("first", "last"), [("2024-02-06", "2024-01-03"), ("2020-01-01", "2020-01-05")])
def test_ranges_without_rows(snapshots, first, last):
    assert replay.trend_4w_days(snapshots(*snapshot_rows()), first, last).count() == 0


def test_spread_keeps_the_columns(spark):
    rows = spark.sql("SELECT DATE'2024-01-02' AS day, 5 AS n")
    got = replay.spread(rows, "day", "2024-01-01", "2024-01-04", 1).select(F.col("as_of").cast("string"), "n")
    assert values(got) == [("2024-01-02", 5), ("2024-01-03", 5)]
