"""Nested curricula to lecture rows.

A curriculum is one row, so numbering happens inside the row with array functions: no shuffle, and
no window over a course.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.durations import duration_rejected, parse_duration_daily, parse_duration_full
from ..functions.links import course_id_from_classroom, course_link
from ..sources.schemas import CHAPTERS, LESSONS

Duration = Callable[[Column], Column]


def _or_empty(array: Column, array_type) -> Column:
    return F.coalesce(array, F.array().cast(array_type))


def _number(index: Column) -> Column:
    return (index + 1).cast("int")


def _lessons(lessons: Column, section_number, section_title, chapter_number, chapter_title, untitled=None):
    def one(lesson: Column, index: Column) -> Column:
        return F.struct(
            section_number.alias("section_number"),
            section_title.alias("section_title"),
            chapter_number.cast("int").alias("chapter_number"),
            chapter_title.cast("string").alias("chapter_title"),
            _number(index).alias("lecture_number"),
            F.coalesce(
                lesson["title"], F.lit(untitled), F.concat(F.lit("Lecture "), _number(index).cast("string"))
            ).alias("lecture_title"),
            lesson["duration"].alias("duration"),
            F.coalesce(lesson["is_completed"], F.lit(False)).alias("is_completed"),
        )

    return F.transform(_or_empty(lessons, LESSONS), one)


def _section_title(section: Column, number: Column) -> Column:
    return F.coalesce(section["section"], F.concat(F.lit("Section "), number.cast("string")))


def lesson_array(sections: Column) -> Column:
    """Lessons of a nested curriculum as one array, chapters kept."""
    no_chapter = F.lit(None)

    def of_section(section: Column) -> Column:
        number = section["section_number"]
        title = _section_title(section, number)
        by_chapter = F.flatten(F.transform(
            _or_empty(section["chapters"], CHAPTERS),
            lambda chapter: _lessons(
                chapter["lessons"], number, title, chapter["chapter_number"], chapter["chapter_title"]
            ),
        ))
        direct = _lessons(section["lessons"], number, title, no_chapter, no_chapter)
        return F.when(F.size(section["chapters"]) > 0, by_chapter).otherwise(direct)

    return F.flatten(F.transform(sections, of_section))


def lesson_array_flat(sections: Column, count_empty: bool = False, untitled: str | None = None) -> Column:
    """Lessons of a curriculum without chapters as one array, sections numbered by position."""
    if not count_empty:
        sections = F.filter(sections, lambda section: F.size(section["lessons"]) > 0)

    def of_section(section: Column, index: Column) -> Column:
        number = _number(index)
        return _lessons(
            section["lessons"], number, _section_title(section, number), F.lit(None), F.lit(None), untitled
        )

    return F.flatten(F.transform(sections, of_section))


def timed(lessons: DataFrame, duration: Duration) -> DataFrame:
    """Lessons with the duration text turned into ``lecture_time`` and ``duration_rejected``."""
    text = F.nullif(F.col("duration"), F.lit(""))
    return lessons.withColumns({
        "lecture_time": duration(text), "duration_rejected": duration_rejected(text),
    }).drop("duration")


def _emit(curricula: DataFrame, lessons: Column, duration: Duration) -> DataFrame:
    """One row per lesson. Only the numbering is done in the array; texts are parsed in plain columns."""
    kept = [F.col(c) for c in curricula.columns if c != "sections"]
    rows = (
        curricula.select(*kept, F.posexplode(lessons).alias("position", "lesson"))
        .select(*kept, "lesson.*", _number(F.col("position")).alias("sort_order"))
    )
    return timed(rows, duration)


def flatten_curriculum(curricula: DataFrame, duration: Duration = parse_duration_daily) -> DataFrame:
    """Lecture rows with chapters.

    Section numbers are the page's own and may have gaps; lecture numbers restart in every chapter
    (or section without chapters); ``sort_order`` runs through the course. ``duration_rejected``
    marks malformed clock texts, which count as 0 minutes.
    """
    return _emit(curricula, lesson_array(F.col("sections")), duration)


def flatten_curriculum_flat(
    curricula: DataFrame, duration: Duration = parse_duration_full,
    count_empty: bool = False, untitled: str | None = None,
) -> DataFrame:
    """Lecture rows without chapters.

    Sections are numbered densely among the non-empty ones; ``count_empty`` numbers them by their
    position in the list instead. ``untitled`` replaces missing lecture titles.
    """
    return _emit(curricula, lesson_array_flat(F.col("sections"), count_empty, untitled), duration)


def rejected_durations(lectures: DataFrame) -> DataFrame:
    """Lecture rows whose clock text could not be read."""
    return lectures.filter("duration_rejected")


def section_summary(curricula: DataFrame) -> DataFrame:
    """Per section of a course: its lessons and completed lessons, and the counts that the page itself declares.

    Counted inside the row; sections without lessons are left out.
    """
    def of_section(section: Column) -> Column:
        by_chapter = F.flatten(F.transform(section["chapters"], lambda chapter: chapter["lessons"]))
        lessons = F.coalesce(F.when(F.size(section["chapters"]) > 0, by_chapter), section["lessons"])
        return F.struct(
            section["section_number"].alias("section_number"),
            F.size(lessons).cast("bigint").alias("lesson_count"),
            F.size(F.filter(lessons, lambda lesson: lesson["is_completed"])).cast("bigint").alias("complete_count"),
            section["complete_count"].cast("bigint").alias("declared_complete"),
            section["total_count"].cast("bigint").alias("total_count"),
        )

    kept = [F.col(c) for c in curricula.columns if c != "sections"]
    return curricula.select(*kept, F.inline(F.transform("sections", of_section))).filter("lesson_count > 0")


def resolve_course_links(listings: DataFrame, site: str) -> DataFrame:
    """Kept links of every listing page with their 1-based position among the kept ones.

    ``listings`` has one row per page, ``boxes ARRAY<STRUCT<href, data_course_id, data_id,
    data_key>>`` in page order.
    """
    links = F.filter(
        F.transform(
            "boxes",
            lambda box: course_link(box["href"], box["data_course_id"], box["data_id"], box["data_key"], site),
        ),
        lambda link: link.isNotNull(),
    )
    kept = [F.col(c) for c in listings.columns if c != "boxes"]
    return listings.select(*kept, F.posexplode(links).alias("position", "url")).withColumn(
        "position", _number(F.col("position"))
    )


def placeholder_courses(links: DataFrame) -> DataFrame:
    """Course records of newly found links: placeholder title, zero progress, position as order."""
    course_id = course_id_from_classroom("url")
    return links.select(
        *[c for c in links.columns if c not in ("position", "url")],
        course_id.alias("course_id"),
        F.concat(F.lit("Course "), course_id).alias("course_title"),
        F.lit(0.0).alias("progress_rate"),
        F.lit(0.0).alias("study_time"),
        F.lit(0.0).alias("total_lecture_time"),
        "url",
        F.col("position").alias("display_order"),
    )
