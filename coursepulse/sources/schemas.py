"""Table and record schemas."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "BIGINT": T.LongType(), "INT": T.IntegerType(), "DOUBLE": T.DoubleType(), "STRING": T.StringType(),
    "BOOLEAN": T.BooleanType(), "DATE": T.DateType(), "TIMESTAMP": T.TimestampType(),
}


def _struct(columns: str) -> T.StructType:
    """Struct from ``name TYPE, …`` without needing a session."""
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


COURSES = _struct(
    "course_id BIGINT, course_title STRING, progress_rate DOUBLE, study_time DOUBLE, "
    "total_lecture_time DOUBLE, url STRING, display_order INT, is_target_course BOOLEAN, "
    "updated_at TIMESTAMP"
)

LECTURES = _struct(
    "course_id BIGINT, section_number INT, section_title STRING, chapter_number INT, "
    "chapter_title STRING, lecture_number INT, lecture_title STRING, lecture_time DOUBLE, "
    "is_completed BOOLEAN, sort_order INT, completed_at TIMESTAMP"
)

SNAPSHOTS = _struct(
    "course_id BIGINT, snapshot_date DATE, progress_rate DOUBLE, study_time DOUBLE, "
    "total_lecture_time DOUBLE, created_at TIMESTAMP"
)

CRAWL_LOGS = _struct(
    "log_id BIGINT, course_id BIGINT, crawl_status STRING, error_message STRING, logged_at TIMESTAMP"
)

# Pages that could not be read, and why.
REJECTED_PAGES = _struct("page_id BIGINT, url STRING, rejected STRING, logged_at TIMESTAMP")

# Lectures that came with a key that was taken, and why they were set aside.
REJECTED_LECTURES = T.StructType([*LECTURES.fields, *_struct("seq BIGINT, reason STRING, logged_at TIMESTAMP").fields])

# Figures that follow from the lectures (by the day of completion, NULL without) and from the snapshots.
COMPLETION_DAYS = _struct(
    "course_id BIGINT, completed_date DATE, is_completed BOOLEAN, lecture_count BIGINT, timed_count BIGINT, study_minutes DOUBLE"
)
WEEKLY_DELTAS = T.StructType([*SNAPSHOTS.fields, *_struct("weekly_study DOUBLE, progress_delta DOUBLE").fields])

TABLES = {
    "courses": COURSES,
    "lectures": LECTURES,
    "course_progress_snapshots": SNAPSHOTS,
    "crawl_logs": CRAWL_LOGS,
    "rejected_pages": REJECTED_PAGES,
    "rejected_lectures": REJECTED_LECTURES,
    "completion_days": COMPLETION_DAYS,
    "weekly_deltas": WEEKLY_DELTAS,
}

PAGES = _struct("page_id BIGINT, url STRING, html STRING")

# Nested curriculum of one course, as the page extraction produces it.
LESSONS = T.ArrayType(_struct("title STRING, duration STRING, is_completed BOOLEAN"))
CHAPTERS = T.ArrayType(
    T.StructType([
        T.StructField("chapter_number", T.IntegerType()),
        T.StructField("chapter_title", T.StringType()),
        T.StructField("lessons", LESSONS),
    ])
)
SECTIONS = T.ArrayType(
    T.StructType([
        T.StructField("section", T.StringType()),
        T.StructField("section_number", T.IntegerType()),
        T.StructField("complete_count", T.LongType()),
        T.StructField("total_count", T.LongType()),
        T.StructField("chapters", CHAPTERS),
        T.StructField("lessons", LESSONS),
    ])
)

# Course boxes of one listing page.
BOXES = T.ArrayType(_struct("href STRING, data_course_id STRING, data_id STRING, data_key STRING"))

# One crawled record: a course, a lecture, or something else that is passed through.
# ``seq`` is its arrival number, ``position`` its place among the records of one number (NULL: the
# only one), ``payload`` the text of other records.
ITEMS = _struct(
    "item_type STRING, seq BIGINT, position INT, course_id STRING, course_title STRING, progress_rate DOUBLE, "
    "study_time DOUBLE, total_lecture_time DOUBLE, url STRING, display_order INT, "
    "section_number INT, section_title STRING, chapter_number INT, chapter_title STRING, "
    "lecture_number INT, lecture_title STRING, lecture_time DOUBLE, is_completed BOOLEAN, "
    "sort_order INT, payload STRING"
)
