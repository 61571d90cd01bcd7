import datetime as dt
import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def snapshots(spark):
    """Build a snapshot table from (course, date, study[, progress, total]) rows."""
    def build(*rows):
        full = []
        for course, day, study, *rest in rows:
            progress, total = (rest + [10.0, 1000.0][len(rest):])[:2]
            full.append((course, dt.date.fromisoformat(day), progress, study, total, None))
        return spark.createDataFrame(
            full, "course_id BIGINT, snapshot_date DATE, progress_rate DOUBLE, study_time DOUBLE, "
                  "total_lecture_time DOUBLE, created_at TIMESTAMP")
    return build


@pytest.fixture
def courses(spark):
    """Build a course table from (id, study, total[, url, updated_at]) rows."""
    def build(*rows):
        full = []
        for course, study, total, *rest in rows:
            url, updated = (rest + [f"https://x/classroom/{course}", None][len(rest):])[:2]
            full.append((course, f"Course no {course}", 50.0, study, total, url, None, course % 2 == 1,
                         dt.datetime.fromisoformat(updated) if updated else None))
        return spark.createDataFrame(
            full, "course_id BIGINT, course_title STRING, progress_rate DOUBLE, study_time DOUBLE, "
                  "total_lecture_time DOUBLE, url STRING, display_order INT, is_target_course BOOLEAN, "
                  "updated_at TIMESTAMP")
    return build


@pytest.fixture
def lectures(spark):
    """Build a lecture table from (course, section, chapter, lecture, minutes, completed_at) rows."""
    def build(*rows):
        full = [
            (c, s, f"Part {s}", ch, None, n, f"Lecture {n}", m, at is not None, n,
             dt.datetime.fromisoformat(at) if at else None)
            for c, s, ch, n, m, at in rows
        ]
        return spark.createDataFrame(
            full, "course_id BIGINT, section_number INT, section_title STRING, chapter_number INT, "
                  "chapter_title STRING, lecture_number INT, lecture_title STRING, lecture_time DOUBLE, "
                  "is_completed BOOLEAN, sort_order INT, completed_at TIMESTAMP")
    return build


def values(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
