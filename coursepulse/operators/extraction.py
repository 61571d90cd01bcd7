"""Archived pages to page fields and nested curricula.

Reading markup is the one step Spark has no expression for. It runs as ``mapInArrow`` over the page
table: each page is independent, so the work splits by input partition without a shuffle.
"""

from __future__ import annotations

import dataclasses
import sys
from collections.abc import Sequence

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.links import CLASSROOM_PATH
from ..functions.text import strip
from ..sources.schemas import BOXES, SECTIONS
from . import markup

# Tasks get this module and the reader with the function, so executors need no copy of the package.
for _module in (sys.modules[__name__], markup):
    cloudpickle.register_pickle_by_value(_module)


@dataclasses.dataclass(frozen=True)
class Outline:
    """Selectors of a page source whose outline is static markup."""

    sections: str
    section_title: str
    lessons: str
    lesson_title: str
    duration: str
    page_title: str
    lists: str | None = None


# Fixed selectors of the page sources.
OUTLINES = {
    "static": Outline(
        sections=".curriculum-section, .course-section, section.curriculum",
        section_title=".section-title, h2, h3",
        lessons=".lesson-item, .curriculum-item, li",
        lesson_title=".lesson-title, a, span",
        duration=".duration, .time",
        page_title="h1.title, h1",
        lists="ul.curriculum, ol.curriculum, div.curriculum ul, div.curriculum ol",
    ),
    "outline": Outline(
        sections=".curriculum-section, .ac-curriculum",
        section_title=".section-title, h3, .title",
        lessons=".curriculum-item, .ac-curriculum-item, li.lecture",
        lesson_title=".lecture-title, .title, a",
        duration=".duration, .time",
        page_title="h1.title, h1",
    ),
    "purpose": Outline(
        sections='.curriculum-section, section[data-purpose="curriculum-section"]',
        section_title=".section-title, h2, .ud-heading-xl",
        lessons='.curriculum-item, .lecture-item, li[data-purpose="curriculum-item"]',
        lesson_title=".lecture-title, span, button",
        duration=".duration, .content-summary",
        page_title='h1[data-purpose="lead-title"], h1',
    ),
}

# Fixed class names of the classroom page.
CLASSROOM = {
    "section": ".classroom-sidebar-clip__chapter",
    "section_title": ".classroom-sidebar-clip__chapter__title__text",
    "complete": ".classroom-sidebar-clip__chapter__title__number__complete",
    "total": ".classroom-sidebar-clip__chapter__title__number__total",
    "chapter": ".classroom-sidebar-clip__chapter__part",
    "chapter_title": ".classroom-sidebar-clip__chapter__part__title",
    "lesson": ".classroom-sidebar-clip__chapter__clip",
    "lesson_title": ".classroom-sidebar-clip__chapter__clip__title",
    "lesson_time": ".classroom-sidebar-clip__chapter__clip__time",
}
COMPLETE_CLASS = "classroom-sidebar-clip__chapter__clip--complete"

# Fixed selectors of the listing page.
LISTING_BOX = ".vn-me-courses__box"
LISTING_BUTTON = 'button[data-e2e="classroom-enter-button"]'

PROFILES = ("classroom", "classroom_flat", *OUTLINES)

EXTRACTED = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("page_title", T.StringType()),
    T.StructField("h1", T.StringType()),
    T.StructField("body_text", T.StringType()),
    T.StructField("sections", SECTIONS),
    T.StructField("rejected", T.StringType()),
])
LARGEST_COUNT = 2**63 - 1
#: Markup whose results a task gathers before it hands them on.
HELD_CHARS = 4_000_000
#: Why a page without markup is rejected.
NO_MARKUP = "no markup"


def _section(title, number, lessons, chapters=None, complete=None, total=None):
    return {
        "section": title, "section_number": number, "complete_count": complete,
        "total_count": total, "chapters": chapters, "lessons": lessons,
    }


def _classroom_reader(with_chapters: bool):
    """Sections of a classroom page; empty ones and ones with unreadable counts are left out."""
    part = {name: markup.Selector(selector) for name, selector in CLASSROOM.items()}

    def text_of(page, element, name, default):
        found = page.first(element, part[name])
        return default if found is None else page.text(found)

    of_title, of_time = part["lesson_title"], part["lesson_time"]

    def lessons_of(page, element):
        first, text, lessons = page.first, page.text, []
        for i, lesson in enumerate(page.find(element, part["lesson"]), 1):
            title, time = first(lesson, of_title), first(lesson, of_time)
            lessons.append({
                "title": f"Lecture {i}" if title is None else text(title),
                "duration": "" if time is None else text(time),
                "is_completed": COMPLETE_CLASS in lesson.attrs.get("class", ""),
            })
        return lessons

    def chapter_of(title):
        while title is not None and not part["chapter"].matches(title):
            title = title.parent
        return title

    def read(page):
        for number, section in enumerate(page.everywhere(part["section"]), 1):
            title = text_of(page, section, "section_title", f"Section {number}")
            try:
                complete = int(text_of(page, section, "complete", "0"))
                total = int(text_of(page, section, "total", "0"))
            except ValueError:
                continue
            if max(abs(complete), abs(total)) > LARGEST_COUNT:
                continue
            titles = page.find(section, part["chapter_title"]) if with_chapters else []
            if titles:
                holders = [(i, t, chapter_of(t)) for i, t in enumerate(titles, 1)]
                chapters = [
                    {"chapter_number": i, "chapter_title": page.text(t), "lessons": lessons_of(page, holder)}
                    for i, t, holder in holders if holder is not None
                ]
                chapters = [c for c in chapters if c["lessons"]]
                if chapters:
                    yield _section(title, number, None, chapters, complete, total)
            else:
                lessons = lessons_of(page, section)
                if lessons:
                    yield _section(title, number, lessons, None, complete, total)

    return read


def _outline_reader(outline: Outline):
    """Titled sections of a static page, kept also without lessons; else its plain lists."""
    part = {
        name: markup.Selector(selector)
        for name, selector in dataclasses.asdict(outline).items() if selector
    }
    items = markup.Selector("li")

    def text_in(page, element, name):
        return page.first_text(page.find(element, part[name], include_self=True))

    def lesson(title, duration):
        return {
            "title": title.strip(), "duration": duration.strip() if duration else None, "is_completed": False,
        }

    def titled(page):
        for section in page.everywhere(part["sections"]):
            title = text_in(page, section, "section_title")
            if not title:
                continue
            found = page.find(section, part["lessons"], include_self=True)
            texts = [(text_in(page, e, "lesson_title"), text_in(page, e, "duration")) for e in found]
            yield title.strip(), [lesson(t, d) for t, d in texts if t]

    def listed(page):
        for number, holder in enumerate(page.everywhere(part["lists"]), 1):
            texts = [
                page.first_text(page.inside(e)) or "" for e in page.find(holder, items, include_self=True)
            ]
            lessons = [lesson(t, None) for t in texts if t.strip()]
            if lessons:
                yield f"Section {number}", lessons

    def read(page):
        sections = list(titled(page))
        if not sections and outline.lists:
            sections = list(listed(page))
        for number, (title, lessons) in enumerate(sections, 1):
            yield _section(title, number, lessons)

    return read


def _read_rows(batches, row, arrow_schema):
    """Apply ``row`` to every (page_id, url, html) of the batches and give what is not None; a task holds the results of
    ``HELD_CHARS`` of markup at most, or of one page, besides the batch it reads."""
    import gc

    import pyarrow as pa

    # A page is a tree without reference cycles; collecting between pages only costs time.
    gc.disable()
    try:
        for batch in batches:
            rows, held = [], 0
            for values in zip(*[batch.column(name) for name in ("page_id", "url", "html")]):
                page_id, url, html = (value.as_py() for value in values)
                found = row(page_id, url, html)
                if found is not None:
                    rows.append(found)
                held += len(html or "")
                if held >= HELD_CHARS and rows:
                    yield pa.RecordBatch.from_pylist(rows, arrow_schema)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, arrow_schema)
    finally:
        gc.enable()


def rejected_pages(pages: DataFrame, profile: str = "classroom") -> DataFrame:
    """page_id, url and reason of the pages that cannot be read. All fields are read, and only these pages are sent."""
    return _extract(pages, profile, None, ("page_id", "url", "rejected"), True)


def extract_pages(pages: DataFrame, profile: str = "classroom", fields: Sequence[str] | None = None) -> DataFrame:
    """Page title, first heading, visible text and nested curriculum of every archived page.

    ``pages`` has page_id, url and html. ``profile`` is one of ``PROFILES``. Of ``fields`` (all by default) only those
    asked for are looked up and sent, page_id always. A page without a curriculum has an empty ``sections``. A page
    that cannot be read does not end the job: its fields are NULL and ``rejected`` says why.
    """
    return _extract(pages, profile, fields, fields, False)


def _extract(pages: DataFrame, profile: str, fields: Sequence[str] | None, sent: Sequence[str] | None, rejects: bool) -> DataFrame:
    """``extract_pages`` with ``fields`` looked up and ``sent`` sent, of all pages or of the ``rejects``."""
    if profile not in PROFILES:
        raise ValueError(f"unknown profile {profile!r}, expected one of {PROFILES}")
    outline = OUTLINES.get(profile)
    own_heading = outline.page_title if outline else "h1"
    wanted = T.StructType([f for f in EXTRACTED if f.name == "page_id" or sent is None or f.name in sent])
    arrow_schema = to_arrow_schema(wanted)

    def read_batches(batches):
        read = _outline_reader(outline) if outline else _classroom_reader(profile == "classroom")
        of_title, of_heading, of_body = (markup.Selector(s) for s in ("title", own_heading, "body"))

        def heading_of(page):
            headings = page.everywhere(of_heading)
            if outline:
                return page.first_text(headings)
            return page.text(headings[0]) if headings else None

        def body_of(page):
            bodies = page.everywhere(of_body)
            return page.text(bodies[0] if bodies else page.root)

        readers = {
            "page_title": lambda page: page.first_text(page.everywhere(of_title)),
            "h1": heading_of,
            "body_text": body_of,
            "sections": lambda page: list(read(page)),
        }
        readers = {name: reader for name, reader in readers.items() if fields is None or name in fields}

        def row(page_id, url, html):
            known = {"page_id": page_id, "url": url}
            if html is None:
                return known | {"rejected": NO_MARKUP}
            try:
                page = markup.Page(html)
                read_fields = {name: reader(page) for name, reader in readers.items()}
                return None if rejects else known | read_fields
            except Exception as error:  # one page must not end the job; the reason is kept
                return known | {"rejected": f"{type(error).__name__}: {error}"[:500]}

        yield from _read_rows(batches, row, arrow_schema)

    return pages.select("page_id", "url", "html").mapInArrow(read_batches, wanted)


def outline_records(pages: DataFrame, profile: str) -> DataFrame:
    """url, title, curriculum and its size for pages that have a static curriculum."""
    return (
        extract_pages(pages, profile, ("url", "h1", "sections"))
        .filter(F.size("sections") > 0)
        .select(
            "page_id", "url", F.coalesce(strip(F.col("h1")), F.lit("Unknown Title")).alias("title"),
            F.col("sections").alias("curriculum"), F.size("sections").alias("total_sections"),
        )
    )


def extract_listings(pages: DataFrame) -> DataFrame:
    """Course boxes of archived listing pages, as ``resolve_course_links`` takes them.

    A box gives the href of its first classroom link and the data attributes of its enter button, or
    of its first button where the enter button has none. A page that cannot be read has NULL boxes.
    """
    schema = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("boxes", BOXES)])
    arrow_schema = to_arrow_schema(schema)
    names = {"data_course_id": "data-course-id", "data_id": "data-id", "data_key": "data-key"}

    def read_batches(batches):
        box, enter, button, link = (markup.Selector(s) for s in (LISTING_BOX, LISTING_BUTTON, "button", "a"))

        def read_box(page, element):
            hrefs = (e.attrs.get("href", "") for e in page.find(element, link))
            buttons = page.find(element, enter)[:1] + page.find(element, button)[:1]
            marked = [e.attrs for e in buttons if any(e.attrs.get(name) for name in names.values())]
            attrs = marked[0] if marked else {}
            found = {field: attrs.get(name) for field, name in names.items()}
            return {"href": next((h for h in hrefs if CLASSROOM_PATH in h), None), **found}

        def row(page_id, url, html):
            try:
                page = markup.Page(html or "")
                return {"page_id": page_id, "boxes": [read_box(page, e) for e in page.everywhere(box)]}
            except Exception:  # one page must not end the job: NULL boxes mark it
                return {"page_id": page_id, "boxes": None}

        yield from _read_rows(batches, row, arrow_schema)

    return pages.select("page_id", "url", "html").mapInArrow(read_batches, schema)
