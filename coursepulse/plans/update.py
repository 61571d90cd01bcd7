"""One batch of crawled records against the tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clock import AsOf, as_of_date, as_of_time, week_start
from ..operators.history import LECTURE_KEY
from ..operators.maintenance import (
    delete_lectures, insert_lectures, last_per_course, log_rows, merge_courses, merge_snapshots, upsert_lectures,
    valid_course_items, valid_lecture_items,
)
from ..operators.selection import coverage_audit
from ..sources.published import OUTBOX, CommitConflict, PublishedTables
from ..sources.scratch import PACKED, drop_folder, lean

COURSE_ITEM = "course"
LECTURE_ITEM = "lecture"
REJECTED_ITEM = "rejected_page"


class Routed(NamedTuple):
    """A batch by record type; ``other`` passes through unchanged."""

    courses: DataFrame
    lectures: DataFrame
    other: DataFrame


def route_items(items: DataFrame) -> Routed:
    kind = F.col("item_type")
    known = F.coalesce(kind.isin(COURSE_ITEM, LECTURE_ITEM, REJECTED_ITEM), F.lit(False))
    return Routed(items.filter(kind == COURSE_ITEM), items.filter(kind == LECTURE_ITEM), items.filter(~known))


def rejected_items(items: DataFrame) -> DataFrame:
    """The records of pages that could not be read."""
    return items.filter(F.col("item_type") == REJECTED_ITEM)


def rejected_rows(rejected: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Table rows of the records of pages that could not be read."""
    return rejected.select(F.col("seq").alias("page_id"), "url", F.col("payload").alias("rejected"), as_of_time(as_of).alias("logged_at"))


def apply_items(
    tables: dict[str, DataFrame], items: DataFrame, as_of: AsOf = None, lectures_stored: bool = True,
) -> dict[str, DataFrame]:
    """The four tables after a batch: courses, snapshots and log from course records, lectures from the rest.

    Records of other types concern no table; ``route_items`` gives them. Without ``lectures_stored`` there are no lectures yet.
    """
    routed = route_items(items)
    # Ids are read and records reduced to the last of each course once, for courses and snapshots alike.
    valid = valid_course_items(routed.courses)
    last = last_per_course(valid)
    return {
        "courses": merge_courses(tables["courses"], last, as_of),
        "course_progress_snapshots": merge_snapshots(tables["course_progress_snapshots"], last, as_of),
        "crawl_logs": tables["crawl_logs"].unionByName(log_rows(valid, as_of)),
        "lectures": upsert_lectures(tables["lectures"], routed.lectures, as_of, lectures_stored),
    }


def publish_items(
    tables: PublishedTables, items: DataFrame, as_of: AsOf = None, mark: tuple[str, int] | None = None,
    pass_on: Callable[[DataFrame], None] | None = None, attempts: int = 50,
) -> int:
    """Apply a batch to the published tables in one commit and return its number.

    The records are written to ``staging`` under the tables' root first, so ``items`` is evaluated once whatever it
    takes to make it. Only the parts the batch falls into are read and rewritten. ``as_of`` None is the time at the
    start. ``mark`` is a stream's name and its batch number: a batch that this stream has brought before is
    skipped. Writers may work beside each other: a commit that meets the parts of this batch makes it apply the batch
    again to what is there now, at most ``attempts`` times.

    ``pass_on`` gets the records of other types. They are part of the commit and stay in its outbox until ``pass_on`` has
    returned, so if it fails they are given again when the batch is replayed or another one comes. Without
    ``pass_on`` nobody waits for them and they are not kept.
    """
    spark = tables.spark
    number = applied(tables, mark)
    if number is None:
        if as_of is None:
            as_of = spark.range(1).select(F.current_timestamp().cast("string")).first()[0]
        with staged(tables, items) as records:
            while number is None:
                attempts -= 1
                try:
                    number = _publish(tables, records, as_of, mark, pass_on is not None)
                except CommitConflict:
                    if attempts <= 0:
                        raise
                    number = applied(tables, mark)
    if pass_on:
        tables.deliver(pass_on)
    return number


def publish_lectures(
    tables: PublishedTables, rows: DataFrame, as_of: AsOf = None, mark: tuple[str, int] | None = None,
    null_safe: bool = True, attempts: int = 50,
) -> int:
    """Add lectures to the published ones in one commit, each key once (``insert_lectures``), and return its number.

    Rows whose key is taken go to ``rejected_lectures`` with the reason, in the same commit. Only the parts that the rows fall
    into are read. ``mark`` and ``attempts`` are those of ``publish_items``.
    """
    number = applied(tables, mark)
    if number is not None:
        return number
    with staged(tables, rows) as records:
        while number is None:
            attempts -= 1
            last = tables.newest()
            parts = tables.touched("lectures", records, last)
            stored = tables.read("lectures", parts, last)
            taken, aside = insert_lectures(stored, records, null_safe)
            changes = {"lectures": (stored.unionByName(taken), parts)} if parts else {}
            if not aside.isEmpty():
                changes["rejected_lectures"] = (aside.withColumn("logged_at", as_of_time(as_of)), [])
            try:
                number = tables.publish(changes, last, mark, rebase=True)
            except CommitConflict:
                if attempts <= 0:
                    raise
                number = applied(tables, mark)
    return number


def applied(tables: PublishedTables, mark: tuple[str, int] | None) -> int | None:
    """The newest commit if the stream's batch is in the tables, else None."""
    last = tables.newest()
    return last.number if mark and mark[1] <= last.marks.get(mark[0], -1) else None


def _publish(tables: PublishedTables, records: DataFrame, as_of: AsOf, mark: tuple[str, int] | None, keep_others: bool) -> int:
    """One attempt, on top of the newest commit."""
    last = tables.newest()
    routed, rejected = route_items(records), rejected_items(records)
    week = str(records.sparkSession.range(1).select(week_start(as_of_date(as_of))).first()[0])
    # What the batch concerns, in one job: parts of tables, and whether there are records of the other kinds.
    found = tables.touched_by({
        "courses": valid_course_items(routed.courses), "lectures": valid_lecture_items(routed.lectures),
        "rejected_pages": rejected, **({OUTBOX: routed.other} if keep_others else {}),
    }, last)
    parts = {"courses": found["courses"], "lectures": found["lectures"], "course_progress_snapshots": [week], "crawl_logs": []}
    # Lectures of sections that are not stored come beside those of their part, which stay where they are.
    concerned = [name for name in parts if parts["lectures" if name == "lectures" else "courses"]]
    parts["lectures"] = tables.to_rewrite("lectures", valid_lecture_items(routed.lectures), ["course_id", "section_number"], parts["lectures"], last)
    stored = {name: tables.read(name, parts[name], last) for name in parts}
    changed = apply_items(stored, records, as_of, bool(parts["lectures"]))
    # Tables that no record of the batch concerns are left as they are.
    changes = {name: (changed[name], parts[name]) for name in concerned}
    if found["rejected_pages"]:
        changes["rejected_pages"] = (rejected_rows(rejected, as_of), [])
    others = routed.other if found.get(OUTBOX) else None
    return tables.publish(changes, last, mark, others, rebase=True, added=("lectures",))


@contextmanager
def staged(tables: PublishedTables, rows: DataFrame) -> Iterator[DataFrame]:
    """``rows`` as written beside the tables; the files go when the work on them ends."""
    folder = f"{tables.root}/staging/{uuid.uuid4().hex}"
    with lean(rows.sparkSession):
        rows.write.options(**PACKED).parquet(folder)
    try:
        yield tables.spark.read.schema(rows.schema).parquet(folder)
    finally:
        drop_folder(tables.spark, folder)


def recollect(
    courses: DataFrame, lectures: DataFrame, fresh: DataFrame, as_of: AsOf = None,
    tolerance: float = 0.1, preserve_completed_at: bool = False,
) -> DataFrame:
    """Lectures with those of every badly covered course deleted and collected again.

    ``fresh`` holds lecture records; only those of the audited courses are used. Lectures that come
    back done get ``as_of`` as completion time, or their old one with ``preserve_completed_at``.
    """
    gaps = coverage_audit(courses, lectures, tolerance).select("course_id")
    valid = valid_lecture_items(fresh).join(gaps, "course_id", "left_semi")
    rebuilt = upsert_lectures(delete_lectures(lectures, gaps), valid, as_of)
    if not preserve_completed_at:
        return rebuilt
    before = lectures.filter("completed_at IS NOT NULL").groupBy(*LECTURE_KEY).agg(
        F.min("completed_at").alias("old_completed_at")
    )
    same_key = F.lit(True)
    for name in LECTURE_KEY:
        same_key &= F.col(f"r.{name}").eqNullSafe(F.col(f"b.{name}"))
    kept = F.when(F.col("r.is_completed"), F.coalesce(F.col("b.old_completed_at"), F.col("r.completed_at")))
    return rebuilt.alias("r").join(before.alias("b"), same_key, "left").select(*[
        (kept if c == "completed_at" else F.col(f"r.{c}")).alias(c) for c in lectures.columns
    ])
