"""Archived pages to course and lecture records."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.durations import parse_duration_daily
from ..functions.links import course_id_from_classroom
from ..functions.page_fields import (
    course_title, is_authenticated, progress_rate, study_minutes, total_minutes,
)
from ..operators.curriculum import lesson_array, lesson_array_flat, timed
from ..operators.extraction import extract_pages
from ..sources.schemas import ITEMS
from .readings import StoredReadings
from .update import REJECTED_ITEM

#: Figures of the visible text.
METRICS = {"progress_rate": progress_rate, "study_time": study_minutes, "total_lecture_time": total_minutes}


def drop_unauthenticated(pages: DataFrame) -> DataFrame:
    """Pages that are not a login page; pages without a title or url are dropped too."""
    return pages.filter(is_authenticated("page_title", "url"))


def course_records(pages: DataFrame) -> DataFrame:
    """Course fields of pages with url, page_title, h1 and body_text; other columns stay."""
    return _course_fields(drop_unauthenticated(pages))


def _course_fields(pages: DataFrame, known: bool = False) -> DataFrame:
    """``known``: pages have the metrics already."""
    own = ("page_title", "h1", "body_text", "url", *(METRICS if known else ()))
    return (
        pages.withColumn("course_id", course_id_from_classroom("url"))
        .select(
            *[c for c in pages.columns if c not in own],
            "course_id",
            course_title("page_title", "h1", "course_id").alias("course_title"),
            *[(F.col(name) if known else of("body_text")).alias(name) for name, of in METRICS.items()],
            "url",
        )
    )


def page_items(
    pages: DataFrame, profile: str = "classroom", duration: Callable[[Column], Column] = parse_duration_daily, rejects: bool = False,
    readings: StoredReadings | None = None,
) -> DataFrame:
    """Item records of archived pages: each page's course record, then its lectures.

    A page is read once; both kinds of record are elements of one array that is then exploded.
    They arrive in the order of their pages (``seq``) and of their ``position`` in the page. With ``rejects`` a page that
    cannot be read gives one record of its own kind, with the reason as its ``payload``; so one reading has both results. With
    ``readings`` (of the same profile) only markup that is not stored there is parsed.
    """
    if readings is not None and readings.profile != profile:
        raise ValueError(f"the readings are of profile {readings.profile!r}, not {profile!r}")
    lessons_of = lesson_array if profile == "classroom" else lesson_array_flat
    fields = ("url", "page_title", "h1", "sections", *(["rejected"] if rejects else []))
    if readings is not None:  # the metrics are made where the text is
        read = readings.extract(pages, fields, {name: of("body_text") for name, of in METRICS.items()})
    else:
        read = extract_pages(pages, profile, (*fields, "body_text"))
    signed_in = F.coalesce(is_authenticated("page_title", "url"), F.lit(False))
    unread = F.col("rejected").isNotNull() if rejects else F.lit(False)
    found = _course_fields(read.filter(signed_in | unread), readings is not None)
    raw = T.StructType([*ITEMS, T.StructField("duration", T.StringType())])

    def item(item_type: str, position: Column, values: dict[str, Column]) -> Column:
        own = {
            "item_type": F.lit(item_type),
            "seq": F.col("page_id"),
            "position": position,
            "course_id": F.col("course_id"),
            "course_title": F.col("course_title"),
            **values,
        }
        return F.struct(*[own.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in raw])

    course_fields = ("progress_rate", "study_time", "total_lecture_time", "url")
    course = item("course", F.lit(0), {c: F.col(c) for c in course_fields})
    lesson_fields = (
        "section_number", "section_title", "chapter_number", "chapter_title",
        "lecture_number", "lecture_title", "is_completed", "duration",
    )
    lectures = F.transform(
        lessons_of(F.col("sections")),
        lambda row, i: item("lecture", i + 1, {**{c: row[c] for c in lesson_fields}, "sort_order": i + 1}),
    )
    records = F.concat(F.array(course), lectures)
    if rejects:
        reject = item(REJECTED_ITEM, F.lit(0), {"url": F.col("url"), "course_title": F.lit(None), "payload": F.col("rejected")})
        records = F.when(unread, F.array(reject)).otherwise(records)
    items = timed(found.select(F.inline(records)), duration)
    minutes = F.when(F.col("item_type") == "lecture", F.col("lecture_time"))
    return items.withColumn("lecture_time", minutes).select(*ITEMS.fieldNames(), "duration_rejected")
