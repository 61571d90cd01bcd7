"""Keyed table maintenance: each function returns the new content of the table.

Batches are reduced to one row per key before they meet the stored table, so the joins are one to
one and no key is hot.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.clock import AsOf, as_of_date, as_of_time, week_start
from ..functions.durations import parse_duration_strict
from ..functions.links import course_id_from_path
from ..functions.text import whole_number
from .curriculum import flatten_curriculum_flat
from .history import LECTURE_KEY, arrival, fold_batch, matchable

UNKNOWN_TITLE = "Unknown Title"
COURSE_FIELDS = ["course_title", "progress_rate", "study_time", "total_lecture_time", "url", "display_order"]
LECTURE_FIELDS = ["section_title", "chapter_title", "lecture_title", "lecture_time", "sort_order"]


def valid_course_items(items: DataFrame) -> DataFrame:
    """Course records with the id read from their url; records without one are left out.

    The record's own ``course_id`` is not used. Id 0 counts as missing. Fields that the batch does
    not carry at all are NULL, or ``Unknown Title``.
    """
    missing = {c: F.lit(None) for c in COURSE_FIELDS if c not in items.columns}
    if "course_title" in missing:
        missing["course_title"] = F.lit(UNKNOWN_TITLE)
    return (
        items.withColumns(missing)
        .withColumn("course_id", course_id_from_path("url"))
        .filter(F.col("course_id") > 0)
    )


def last_per_course(valid: DataFrame) -> DataFrame:
    """course_id and ``item``, the valid record that arrived last per course, picked with partial aggregation."""
    return valid.groupBy("course_id").agg(F.max_by(F.struct(*COURSE_FIELDS), arrival(valid)).alias("item"))


def upsert_courses(
    courses: DataFrame, items: DataFrame, as_of: AsOf = None, keep_nonnull: bool = False
) -> DataFrame:
    """Courses after a batch of course records.

    A record overwrites all its fields, also with NULL (a batch without ``display_order`` clears
    it), and sets ``updated_at``; ``is_target_course`` stays. ``keep_nonnull`` keeps stored values
    where the record has none. New courses have no ``updated_at``.
    """
    return merge_courses(courses, last_per_course(valid_course_items(items)), as_of, keep_nonnull)


def merge_courses(courses: DataFrame, batch: DataFrame, as_of: AsOf = None, keep_nonnull: bool = False) -> DataFrame:
    """``upsert_courses`` for records that are reduced already."""
    stored = courses.withColumn("stored", F.lit(True))
    seen = F.col("item").isNotNull()

    def merged(name: str) -> Column:
        new = F.col("item")[name].cast(courses.schema[name].dataType)
        return F.when(seen, F.coalesce(new, F.col(name)) if keep_nonnull else new).otherwise(F.col(name))

    now = as_of_time(as_of, courses.schema["updated_at"].dataType)
    changed = {name: merged(name) for name in COURSE_FIELDS}
    changed["updated_at"] = F.when(seen & F.col("stored"), now).otherwise(F.col("updated_at"))
    changed["is_target_course"] = F.when(F.col("stored"), F.col("is_target_course")).otherwise(F.lit(False))
    return (
        stored.join(batch, "course_id", "full_outer")
        .select("course_id", *[changed.get(c, F.col(c)).alias(c) for c in courses.columns if c != "course_id"])
    )


def upsert_snapshots(snapshots: DataFrame, items: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Snapshots after a batch of course records: the last record of a course in a week wins.

    Only the week of ``as_of`` is joined. Earlier weeks pass through unshuffled.
    """
    return merge_snapshots(snapshots, last_per_course(valid_course_items(items)), as_of)


def merge_snapshots(snapshots: DataFrame, batch: DataFrame, as_of: AsOf = None) -> DataFrame:
    """``upsert_snapshots`` for records that are reduced already."""
    week = week_start(as_of_date(as_of))
    values = ["progress_rate", "study_time", "total_lecture_time"]
    this_week = F.col("snapshot_date").eqNullSafe(week)
    seen = F.col("item").isNotNull()
    created = as_of_time(as_of, snapshots.schema["created_at"].dataType)
    merged = (
        snapshots.filter(this_week)
        .join(batch, "course_id", "full_outer")
        .select(
            "course_id", week.alias("snapshot_date"),
            *[F.when(seen, F.col("item")[v].cast("double")).otherwise(F.col(v)).alias(v) for v in values],
            F.when(F.col("snapshot_date").isNull(), created).otherwise(F.col("created_at")).alias("created_at"),
        )
    )
    return snapshots.filter(~this_week).unionByName(merged)


def crawl_log(items: DataFrame, as_of: AsOf = None, status: str = "success", error: str | None = None) -> DataFrame:
    """Log rows for the valid course records of a batch, with an id that a replay gives again."""
    return log_rows(valid_course_items(items), as_of, status, error)


def log_rows(valid: DataFrame, as_of: AsOf = None, status: str = "success", error: str | None = None) -> DataFrame:
    """``crawl_log`` for records that are known to be valid."""
    now = as_of_time(as_of)
    return valid.select(
        F.xxhash64("course_id", arrival(valid), now).alias("log_id"),
        "course_id",
        F.lit(status).alias("crawl_status"),
        F.lit(error).cast("string").alias("error_message"),
        now.alias("logged_at"),
    )


def valid_lecture_items(items: DataFrame) -> DataFrame:
    """Lecture records with an integer course id; others are left out."""
    if items.schema["course_id"].dataType.typeName() != "string":
        return items.filter(F.col("course_id").isNotNull()).withColumn("course_id", F.col("course_id").cast("bigint"))
    return items.filter(F.col("course_id").rlike(r"^\d+$")).withColumn(
        "course_id", whole_number(F.col("course_id"))
    ).filter(F.col("course_id").isNotNull())


def upsert_lectures(lectures: DataFrame, items: DataFrame, as_of: AsOf = None, any_stored: bool = True) -> DataFrame:
    """Lectures after a batch of lecture records, folded in arrival order onto the stored state.

    open to done sets ``completed_at`` to ``as_of``, done to open clears it, an unchanged state (and
    a stored NULL state) keeps it. New lectures get ``as_of`` when they arrive done. Chapter numbers
    match null-safely; a NULL section or lecture number never matches, so such records are inserted.
    Of stored rows that share a key the first by ``sort_order`` is updated, the others stay. Without ``any_stored`` the stored
    table is known to be empty, so the records meet nothing and are not dealt out by key again.
    """
    valid = valid_lecture_items(items)
    now = as_of_time(as_of, lectures.schema["completed_at"].dataType)
    batch = fold_batch(valid.filter(matchable()), LECTURE_FIELDS, now)
    done = F.coalesce(F.col("is_completed"), F.lit(False))
    inserted = valid.filter(~matchable()).select(*[
        (F.when(done, now) if c == "completed_at" else done if c == "is_completed" else F.col(c))
        .cast(lectures.schema[c].dataType).alias(c)
        for c in lectures.columns
    ])
    if not any_stored:
        own = {"completed_at": F.when(F.col("last.is_completed"), F.col("run_start"))} | {c: F.col(c) for c in LECTURE_KEY}
        return batch.select(*[
            (own[c] if c in own else F.col("last")[c]).cast(lectures.schema[c].dataType).alias(c) for c in lectures.columns
        ]).unionByName(inserted)
    batch = batch.select(*LECTURE_KEY, F.struct("last", "any_open", "any_done", "run_start").alias("new"))

    # Stored rows and the batch's one row per key meet in one window, which groups NULL chapters too.
    stored = lectures.filter(matchable()).withColumn("stored", F.lit(True))
    typed = batch.select(*[F.col(c).cast(lectures.schema[c].dataType).alias(c) for c in LECTURE_KEY], "new")
    both = stored.unionByName(typed.withColumn("stored", F.lit(False)), allowMissingColumns=True)
    same_key = Window.partitionBy(*LECTURE_KEY)
    others = [c for c in lectures.columns if c not in (*LECTURE_KEY, "sort_order")]
    first = Window.partitionBy(*LECTURE_KEY).orderBy(F.desc("stored"), "sort_order", *others)
    met = both.withColumn("place", F.row_number().over(first)).withColumn("new", F.max("new").over(same_key))

    new, old = F.col("new.last"), F.col("is_completed")
    seen = F.col("new").isNotNull() & (F.col("place") == 1)
    was_open = ~F.col("stored") | ~F.coalesce(old, F.lit(True))
    was_done = F.coalesce(old, F.lit(False))
    arrived_done = F.when(F.col("new.any_open") | was_open, F.col("new.run_start")).otherwise(F.col("completed_at"))
    arrived_open = F.when(~F.col("new.any_done") & ~was_done, F.col("completed_at"))
    completed_at = (
        F.when(~seen, F.col("completed_at"))
        .when(new["is_completed"], arrived_done)
        .otherwise(arrived_open)
    )

    def merged(name: str) -> Column:
        if name in LECTURE_KEY:
            return F.col(name)
        if name == "completed_at":
            return completed_at
        return F.when(seen, new[name].cast(lectures.schema[name].dataType)).otherwise(F.col(name))

    # A key that no stored row has is new: its own row of the batch comes first.
    result = met.filter("stored OR place = 1").select(*[merged(c).alias(c) for c in lectures.columns])
    return result.unionByName(lectures.filter(~matchable())).unionByName(inserted)


def replace_curriculum(lectures: DataFrame, curricula: DataFrame) -> DataFrame:
    """Lectures with those of the given curricula replaced: renumbered, open, no chapters.

    Of several curricula of a course the last counts: by ``seq`` where there is such a column, else by content.
    """
    order = "seq" if "seq" in curricula.columns else F.struct(*[c for c in curricula.columns if c != "course_id"])
    rest = [c for c in curricula.columns if c != "course_id"]
    last = curricula.groupBy("course_id").agg(F.max_by(F.struct(*rest), order).alias("last")).select("course_id", "last.*")
    fresh = flatten_curriculum_flat(last, parse_duration_strict, count_empty=True, untitled="")
    types = lectures.schema
    fixed = {"is_completed": F.lit(False), "completed_at": F.lit(None)}
    rows = fresh.select(*[
        fixed.get(c, F.col(c)).cast(types[c].dataType).alias(c) for c in lectures.columns
    ])
    return delete_lectures(lectures, last).unionByName(rows)


def delete_lectures(lectures: DataFrame, courses: DataFrame) -> DataFrame:
    """Lectures of the other courses."""
    return lectures.join(courses.select("course_id"), "course_id", "left_anti")


def count_deleted(lectures: DataFrame, courses: DataFrame) -> DataFrame:
    """How many lectures ``delete_lectures`` takes away, from counts per course."""
    per_course = lectures.groupBy("course_id").agg(F.count("*").alias("n"))
    return per_course.join(courses.select("course_id"), "course_id", "left_semi").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("deleted")
    )


def set_target(courses: DataFrame, course_ids: Iterable[int], flag: bool = True) -> DataFrame:
    """Courses with the target flag of the listed ids set or cleared."""
    listed = F.coalesce(F.col("course_id").isin(list(course_ids)), F.lit(False))
    return courses.withColumn("is_target_course", F.when(listed, F.lit(flag)).otherwise(F.col("is_target_course")))


# Why a lecture was set aside.
KEY_STORED = "key is stored"
KEY_EARLIER = "key came earlier"


def insert_lectures(lectures: DataFrame, rows: DataFrame, null_safe: bool = True) -> tuple[DataFrame, DataFrame]:
    """Rows to be added under the rule that a lecture key occurs once: those that are taken, and those set aside.

    ``rows`` have the columns of ``lectures`` and ``seq``, their arrival number. A row whose key is stored is set aside, and of
    rows with the same key all but the first to arrive (of one number, the least by all columns); ``reason`` says which. A
    row without course, section or lecture number breaks no rule, nor, unless ``null_safe``, one without a chapter.
    """
    ruled = matchable() if null_safe else matchable() & F.col("chapter_number").isNotNull()
    # Equal rows travel as one, and a key has one row on the other side of each join, so a hot key is split.
    each = rows.select(*lectures.columns, "seq").groupBy(*lectures.columns, "seq").agg(F.count("*").alias("copies"))
    each = each.withColumn("place", F.struct("seq", *[c for c in lectures.columns]))
    first = each.filter(ruled).groupBy(*LECTURE_KEY).agg(F.min("place").alias("first"))
    stored = lectures.filter(ruled).select(*LECTURE_KEY).distinct()

    def same(a: str, b: str) -> Column:
        equal = F.lit(True)
        for name in LECTURE_KEY:
            equal &= F.col(f"{a}.{name}").eqNullSafe(F.col(f"{b}.{name}"))
        return equal

    keys = first.alias("f").join(stored.withColumn("held", F.lit(True)).alias("h"), same("f", "h"), "left").select("f.*", "held")
    judged = each.alias("r").join(keys.alias("k"), same("r", "k"), "left").select("r.*", "first", "held")
    taken = F.when(F.col("first").isNull(), F.col("copies")).when(F.col("held"), 0).otherwise(
        F.col("place").eqNullSafe(F.col("first")).cast("bigint"))

    def times(n: Column) -> DataFrame:
        return judged.withColumn("n", n).filter("n > 0").withColumn("time", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))

    reason = F.when(F.col("held"), KEY_STORED).otherwise(KEY_EARLIER).alias("reason")
    return times(taken).select(lectures.columns), times(F.col("copies") - taken).select(*lectures.columns, "seq", reason)
