"""The registered queries: every operator over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from coursepulse.functions import clock, durations, links, page_fields
from coursepulse.operators import completions as done
from coursepulse.operators import curriculum, delta, extraction, maintenance, replay, selection
from coursepulse.operators import snapshots as progress
from coursepulse.operators.history import LECTURE_KEY, compact_observations, completion_history, merge_observations
from coursepulse.plans import collect, update
from coursepulse.plans.readings import StoredReadings
from coursepulse.sources import migrations
from coursepulse.sources.published import PublishedTables
from coursepulse.sources.readers import read_page_archive, read_table
from coursepulse.sources.scratch import PACKED, lean, scratch_folder
from coursepulse.sources.schemas import CRAWL_LOGS, ITEMS, LECTURES, PAGES, TABLES
from coursepulse.sources.writers import write_feed
from coursepulse.streaming.items import stream_items, stream_pages

from .views import BATCH_DAY, BATCH_TIME, COMPLETION_DAY, SITE, SNAPSHOT_DAY, Views

Query = Callable[[SparkSession, str], DataFrame]
# Micro-batches of the checked streams, and parts of their tables.
STREAM_PARTS = 4
STREAM_BUCKETS = 8
# First and last day of the checked ranges.
SNAPSHOT_DAYS = ("2024-01-01", "2024-01-30")
COMPLETION_DAYS = ("1998-05-15", "1998-06-13")
KINDS = ("courses", "course_progress_snapshots", "lectures", "crawl_logs")


def _on(build: Callable[[Views], DataFrame]) -> Query:
    return lambda spark, folder: build(Views(spark, folder))


def _with_snapshots(operator) -> Query:
    return _on(lambda v: operator(v.snapshots(), v.courses(), SNAPSHOT_DAY))


def _with_lectures(operator) -> Query:
    return _on(lambda v: operator(v.lectures(), v.courses(), COMPLETION_DAY))


def _text_items(rows: DataFrame) -> DataFrame:
    """Records with every item column, missing ones NULL."""
    return rows.select(*[
        (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in ITEMS
    ])


def _gaps(v: Views) -> DataFrame:
    return selection.coverage_audit(v.courses(), v.lectures())


def _batch(v: Views) -> DataFrame:
    """The course records, and the lecture records since the batch day."""
    return _text_items(v.course_items()).unionByName(_text_items(v.batch_items()))


def _stored(v: Views) -> dict[str, DataFrame]:
    """The tables as they were before the batch."""
    return {
        "courses": v.courses(), "course_progress_snapshots": v.snapshots(), "lectures": v.stored_lectures(),
        "crawl_logs": v.spark.createDataFrame([], CRAWL_LOGS),
    }


def _all_columns(tables: dict[str, DataFrame], kinds: tuple[str, ...] = KINDS) -> DataFrame:
    """All rows of the tables with the name of their table; columns that a table lacks are NULL.

    The ids of log rows are hashes and stay out.
    """
    def typed(name: str) -> DataFrame:
        columns = [
            F.col(f.name).cast("timestamp_ntz" if f.dataType.typeName() == "timestamp" else f.dataType).alias(f.name)
            for f in TABLES[name] if f.name != "log_id"
        ]
        return tables[name].select(F.lit(name).alias("kind"), *columns)

    rows = typed(kinds[0])
    for name in kinds[1:]:
        rows = rows.unionByName(typed(name), allowMissingColumns=True)
    return rows


def _apply_items(v: Views) -> DataFrame:
    """All tables, every column, after the batch meets the stored state."""
    return _all_columns(update.apply_items(_stored(v), _batch(v), BATCH_TIME))


def _arrive(spark: SparkSession, folder: str, rows: DataFrame, part: Column, start: Callable[[], StreamingQuery]) -> None:
    """Rows come to the stream's folder part by part; after each the stream takes what has come, in one micro-batch.

    A part is made when it comes, from the rows that belong to it alone.
    """
    for number in range(STREAM_PARTS):
        with lean(spark):
            rows.filter(part == number).write.options(**PACKED).mode("append").parquet(folder)
        start().awaitTermination()


def _stream_items(spark: SparkSession, folder: str) -> DataFrame:
    """The batch as a stream that comes in parts, into published tables that hold the state before; every
    column of the tables that they end up with."""
    v = Views(spark, folder)
    scratch = scratch_folder(spark, "stream")
    tables = PublishedTables(spark, f"{scratch}/tables", STREAM_BUCKETS)
    tables.publish({name: (rows, []) for name, rows in _stored(v).items()})  # no parts to replace yet
    # Lecture records in the order of their numbers, course records (one a course) dealt out.
    batch = _batch(v)
    low, high = v.batch_items().agg(F.min("seq"), F.max("seq")).first()
    in_order = F.floor((F.col("seq") - low) * STREAM_PARTS / (high - low + 1))
    part = F.when(F.col("item_type") == "course", F.col("seq") % STREAM_PARTS).otherwise(in_order)
    _arrive(spark, f"{scratch}/items", batch, part, lambda: stream_items(
        spark.readStream.schema(ITEMS).parquet(f"{scratch}/items"), tables, f"{scratch}/checkpoint", BATCH_TIME))
    return _all_columns({name: tables.read(name) for name in TABLES})


def _stream_pages(spark: SparkSession, folder: str) -> DataFrame:
    """The classroom pages as a stream that comes in parts, into empty tables; every column of what they end up with."""
    v = Views(spark, folder)
    scratch = scratch_folder(spark, "pages")
    tables = PublishedTables(spark, f"{scratch}/tables", STREAM_BUCKETS)
    part = F.pmod(F.col("page_id"), F.lit(STREAM_PARTS))
    _arrive(spark, f"{scratch}/pages", v.classroom_pages().select("page_id", "url", "html"), part,
            lambda: stream_pages(spark.readStream.schema(PAGES).parquet(f"{scratch}/pages"), tables, f"{scratch}/checkpoint", BATCH_TIME))
    return _all_columns({name: tables.read(name) for name in TABLES}, (*KINDS, "rejected_pages"))


def _delivered(v: Views) -> DataFrame:
    """Conversation turns as records that no table takes, in a batch with course records; what the receiver of the
    outbox has in the end."""
    scratch = scratch_folder(v.spark, "delivered")
    tables = PublishedTables(v.spark, f"{scratch}/tables", STREAM_BUCKETS)
    others = v.table("conversations").select(F.lit("turn").alias("item_type"), F.col("conv_id").alias("seq"),
                                             F.col("turn").alias("position"), F.col("text").alias("payload"))
    batch = _text_items(others).unionByName(_text_items(v.course_items().withColumn("item_type", F.lit("course"))))
    update.publish_items(tables, batch, BATCH_TIME, pass_on=lambda rows: rows.write.mode("append").parquet(f"{scratch}/taken"))
    return v.spark.read.schema(ITEMS).parquet(f"{scratch}/taken").select("item_type", "seq", "position", "payload")


def _kept_weeks(v: Views) -> DataFrame:
    """The snapshots come in three commits, every third week at a time, so that most weeks come late; the kept differences."""
    tables = PublishedTables(v.spark, f"{scratch_folder(v.spark, 'weeks')}/tables", STREAM_BUCKETS)
    tables.maintain("weekly_deltas")
    week = F.pmod(F.unix_date("snapshot_date") / 7, F.lit(3)).cast("int")
    for turn in (2, 0, 1):
        tables.publish({"course_progress_snapshots": (v.snapshots().filter(week == turn), [])})
    return tables.read("weekly_deltas").withColumn("created_at", F.col("created_at").cast("timestamp_ntz"))


def _kept_days(v: Views) -> DataFrame:
    """The stored lectures, then the batch that completes and opens some of them; the kept figures by course and day."""
    tables = PublishedTables(v.spark, f"{scratch_folder(v.spark, 'days')}/tables", STREAM_BUCKETS)
    tables.publish({"lectures": (v.stored_lectures(), [])})
    tables.maintain("completion_days")
    update.publish_items(tables, _text_items(v.batch_items()), BATCH_TIME)
    return tables.read("completion_days").groupBy("course_id", "completed_date", "is_completed").agg(
        *[F.sum(c).alias(c) for c in ("lecture_count", "timed_count", "study_minutes")])


def _insert_lectures(v: Views) -> DataFrame:
    """The observations of the batch days as new lectures; the lectures then stored and those set aside."""
    tables = PublishedTables(v.spark, f"{scratch_folder(v.spark, 'insert')}/tables", STREAM_BUCKETS)
    tables.publish({"lectures": (v.stored_lectures(), [])})
    new = v.observations().filter(F.col("observed_at") >= F.lit(BATCH_DAY).cast("date")).withColumn(
        "completed_at", F.when(F.col("is_completed"), F.col("observed_at")))
    update.publish_lectures(tables, new.select(*LECTURES.fieldNames(), "seq"), BATCH_TIME)
    return _all_columns({name: tables.read(name) for name in TABLES}, ("lectures", "rejected_lectures"))


def _merged_history(v: Views) -> DataFrame:
    """The observations as three logs that overlap in time, each compacted, two of them merged before the third."""
    rows = v.observations().select(*LECTURE_KEY, "is_completed", "observed_at", "seq")
    logs = [compact_observations(rows.filter(F.pmod(F.xxhash64("seq"), F.lit(3)) == n)) for n in range(3)]
    return completion_history(merge_observations(merge_observations(logs[2], logs[0]), logs[1]))


def _recollect(v: Views) -> DataFrame:
    return update.recollect(v.courses(), v.lectures(), v.lecture_items(), BATCH_TIME)


def _log(v: Views) -> DataFrame:
    log = maintenance.crawl_log(v.course_items(), BATCH_TIME)
    return log.drop("log_id").withColumn("logged_at", F.col("logged_at").cast("timestamp_ntz"))


def _old_lectures(v: Views) -> DataFrame:
    """Lectures as stored before the chapter and completion columns existed."""
    return v.lectures().drop("chapter_number", "chapter_title", "completed_at")


def _migrated(v: Views) -> DataFrame:
    rows = migrations.add_columns(_old_lectures(v), LECTURES)
    return rows.withColumn("completed_at", F.col("completed_at").cast("timestamp_ntz"))


def _minutes(parse) -> Query:
    return _on(lambda v: v.page_text().select("page_id", parse("duration").alias("minutes")))


def _flat(v: Views) -> DataFrame:
    rows = curriculum.flatten_curriculum_flat(v.curricula())
    return rows.drop("chapter_number", "chapter_title", "duration_rejected")


def _classroom(v: Views) -> DataFrame:
    """Lectures read back from the classroom pages, chapters kept."""
    found = extraction.extract_pages(v.classroom_pages(), "classroom", ("sections",)).select("page_id", "sections")
    return curriculum.flatten_curriculum(found).drop("duration_rejected")


def _classroom_flat(v: Views) -> DataFrame:
    found = extraction.extract_pages(v.classroom_pages(), "classroom_flat", ("sections",)).select("page_id", "sections")
    return curriculum.flatten_curriculum_flat(found).drop("chapter_number", "chapter_title", "duration_rejected")


def _section_counts(v: Views) -> DataFrame:
    """Title and counts of every readable section of the classroom pages."""
    return extraction.extract_pages(v.classroom_pages(), "classroom", ("sections",)).select(
        "page_id", F.inline("sections")
    ).drop("chapters", "lessons")


def _rejected_pages(v: Views) -> DataFrame:
    """The classroom pages that could not be read, and why."""
    return extraction.rejected_pages(v.classroom_pages()).select("page_id", "rejected")


def _read_back(v: Views) -> DataFrame:
    """The lecture table as written and read back with its declared schema."""
    root = scratch_folder(v.spark, "table")
    migrations.add_columns(v.lectures(), LECTURES).write.parquet(f"{root}/lectures")
    rows = read_table(v.spark, root, "lectures")
    return rows.withColumn("completed_at", F.col("completed_at").cast("timestamp_ntz"))


def _archive(v: Views) -> DataFrame:
    """The raw pages through the archive reader."""
    pages = read_page_archive(v.spark, f"{v.folder}/pages.parquet")
    return pages.select("page_id", "url", F.length("html").alias("length"))


def _feed(v: Views) -> DataFrame:
    """The course records as a feed of JSON lines, read back."""
    path = scratch_folder(v.spark, "feed")
    write_feed(_text_items(v.course_items()), path)
    return v.spark.read.schema(ITEMS).json(path).select(
        "seq", "course_id", "course_title", "progress_rate", "study_time", "total_lecture_time", "url")


def _described(v: Views) -> DataFrame:
    """Columns of three given tables, and how many rows have them filled."""
    def described(name: str) -> DataFrame:
        table = v.table(name)
        filled = table.agg(*[F.count(c).alias(c) for c in table.columns])
        counts = filled.unpivot([], table.columns, "col_name", "filled")
        return migrations.describe_table(table).join(counts, "col_name").withColumn("table_name", F.lit(name))

    return described("lineitem").unionByName(described("events")).unionByName(described("documents"))


def _outline(profile: str) -> Query:
    """One row per section of the static pages, its lessons joined to a text."""
    def build(v: Views) -> DataFrame:
        lessons = F.transform("lessons", lambda x: F.concat(
            x["title"], F.lit("|"), F.coalesce(x["duration"], F.lit("-"))))
        return (
            extraction.outline_records(v.outline_pages(profile), profile)
            .select("page_id", "title", "total_sections", F.inline("curriculum"))
            .select("page_id", "title", "total_sections", "section_number", "section",
                    F.array_join(lessons, "\n").alias("lessons"))
        )

    return _on(build)


def _page_headings(v: Views) -> DataFrame:
    """Title and first heading of the raw pages."""
    return extraction.extract_pages(v.table("pages"), fields=("page_title", "h1", "sections")).select(
        "page_id", "page_title", "h1", F.size("sections").alias("sections"))


def _page_items(v: Views) -> DataFrame:
    """Course and lecture records of the classroom pages, each page read once."""
    return _item_columns(collect.page_items(v.classroom_pages()))


def _item_columns(items: DataFrame) -> DataFrame:
    return items.select(
        "item_type", "seq", "position", "course_id", "course_title", "progress_rate", "study_time", "total_lecture_time",
        "url", "section_number", "section_title", "chapter_number", "lecture_number", "lecture_title", "lecture_time",
        "is_completed", "sort_order", "duration_rejected",
    )


def _reread_pages(v: Views) -> DataFrame:
    """Records of the classroom pages after an earlier archive, in which every third page had other markup, was read into
    the same store."""
    readings = StoredReadings(v.spark, scratch_folder(v.spark, "readings"))
    older = F.when(F.col("page_id") % 3 == 0, F.replace("html", F.lit("Course number"), F.lit("Older number"))).otherwise(F.col("html"))
    archives = scratch_folder(v.spark, "archives")
    with lean(v.spark):
        v.classroom_pages().select("page_id", "url", "html").write.options(**PACKED).parquet(f"{archives}/new")
    pages = read_page_archive(v.spark, f"{archives}/new")
    readings.add(pages.withColumn("html", older))
    return _item_columns(collect.page_items(pages, readings=readings))


QUERIES: dict[str, Query] = {
    # Snapshots
    "week_over_week": _with_snapshots(progress.week_over_week),
    "weekly_delta": _on(lambda v: delta.weekly_delta(
        clock.visible_as_of(v.snapshots(), "snapshot_date", SNAPSHOT_DAY))),
    "current_week_status": _with_snapshots(progress.current_week_status),
    "trend_4w": _on(lambda v: progress.trend_4w(v.snapshots(), SNAPSHOT_DAY)),
    "weekly_volume_4w": _on(lambda v: progress.weekly_volume_4w(v.snapshots(), SNAPSHOT_DAY)),
    "course_pattern": _with_snapshots(progress.course_pattern),
    "goal_attainment": _with_snapshots(progress.goal_attainment),
    "completion_forecast": _with_snapshots(progress.completion_forecast),
    "snapshot_history": _with_snapshots(progress.snapshot_history),
    "idle_courses": _with_snapshots(progress.idle_courses),
    "visible_as_of": _on(lambda v: clock.visible_as_of(v.snapshots(), "snapshot_date", SNAPSHOT_DAY)),
    "trend_4w_days": _on(lambda v: replay.trend_4w_days(v.snapshots(), *SNAPSHOT_DAYS)),
    "idle_courses_days": _on(lambda v: replay.idle_courses_days(v.snapshots(), v.courses(), *SNAPSHOT_DAYS)),
    # Completed lectures
    "daily_stats_7d_days": _on(lambda v: replay.daily_stats_7d_days(v.lectures(), *COMPLETION_DAYS)),
    "completed_today": _with_lectures(done.completed_today),
    "completed_today_stats": _on(lambda v: done.completed_today_stats(v.lectures(), COMPLETION_DAY)),
    "completed_today_by_course": _with_lectures(done.completed_today_by_course),
    "completed_last_7d": _with_lectures(done.completed_last_7d),
    "daily_stats_7d": _on(lambda v: done.daily_stats_7d(v.lectures(), COMPLETION_DAY)),
    "completed_on": _with_lectures(done.completed_on),
    "month_stats": _on(lambda v: done.month_stats(v.lectures(), COMPLETION_DAY)),
    "recent_completed": _on(lambda v: done.recent_completed(v.lectures(), v.courses(), as_of=COMPLETION_DAY)),
    "recent_completed_per_course": _on(lambda v: done.recent_completed_per_course(
        v.lectures(), v.courses(), as_of=COMPLETION_DAY)),
    "today_vs_yesterday": _on(lambda v: done.today_vs_yesterday(v.lectures(), COMPLETION_DAY)),
    "weekday_pattern_30d": _on(lambda v: done.weekday_pattern_30d(v.lectures(), COMPLETION_DAY)),
    # Selection and audit
    "courses_to_update": _on(lambda v: selection.courses_to_update(v.courses(), target_only=True)),
    "courses_to_update_stale": _on(lambda v: selection.courses_to_update(
        v.courses(), skip_recent=True, as_of=SNAPSHOT_DAY)),
    "course_lookup": _on(lambda v: selection.course_lookup(v.courses())),
    "coverage_audit": _on(_gaps),
    "recollect": _on(_recollect),
    # Table checks and migrations
    "duplicate_keys": _on(lambda v: migrations.duplicate_keys(v.lectures())),
    "duplicate_keys_unique": _on(lambda v: migrations.duplicate_keys(v.lectures(), null_safe=False)),
    "chapter_mix": _on(lambda v: migrations.chapter_mix(v.stored_lectures().withColumn(
        "lecture_title", F.concat(F.lit("Lecture "), F.col("lecture_number").cast("string"))))),
    "add_columns": _on(_migrated),
    "describe_table": _on(_described),
    "read_table": _on(_read_back),
    "write_feed": _on(_feed),
    # Maintenance
    "week_start": _on(lambda v: v.table("events").select("event_id", clock.week_start("ts").alias("week"))),
    "completion_history": _on(lambda v: completion_history(
        v.observations().select(*LECTURE_KEY, "is_completed", "observed_at", "seq"))),
    "upsert_courses": _on(lambda v: maintenance.upsert_courses(v.courses(), v.course_items(), BATCH_TIME)),
    "upsert_snapshots": _on(lambda v: maintenance.upsert_snapshots(v.snapshots(), v.course_items(), BATCH_TIME)),
    "crawl_log": _on(_log),
    "upsert_lectures": _on(lambda v: maintenance.upsert_lectures(v.stored_lectures(), v.batch_items(), BATCH_TIME)),
    "replace_curriculum": _on(lambda v: maintenance.replace_curriculum(v.lectures(), v.curricula())),
    "delete_lectures": _on(lambda v: maintenance.delete_lectures(v.lectures(), _gaps(v))),
    "count_deleted": _on(lambda v: maintenance.count_deleted(v.lectures(), _gaps(v))),
    "set_target": _on(lambda v: maintenance.set_target(v.courses(), [3, 7, 11])),
    "apply_items": _on(_apply_items),
    "stream_items": _stream_items,
    "stream_pages": _stream_pages,
    "deliver_items": _on(_delivered),
    "merged_history": _on(_merged_history),
    "kept_weeks": _on(_kept_weeks),
    "kept_days": _on(_kept_days),
    "insert_lectures": _on(_insert_lectures),
    # Page fields
    "course_id_from_classroom": _on(lambda v: v.page_text().select(
        "page_id", links.course_id_from_classroom("url").alias("text_id"))),
    "course_id_from_path": _on(lambda v: v.page_text().select(
        "page_id", links.course_id_from_path("url").alias("course_id"))),
    "course_title": _on(lambda v: v.page_text().select("page_id", page_fields.course_title(
        "page_title", "h1", links.course_id_from_classroom("url")).alias("course_title"))),
    "page_metrics": _on(lambda v: v.page_text().select(
        "page_id",
        page_fields.progress_rate("body_text").alias("progress_rate"),
        page_fields.study_minutes("body_text").alias("study_time"),
        page_fields.total_minutes("body_text").alias("total_lecture_time"))),
    "parse_duration_daily": _minutes(durations.parse_duration_daily),
    "parse_duration_full": _minutes(durations.parse_duration_full),
    "parse_duration_strict": _minutes(durations.parse_duration_strict),
    "rejected_durations": _on(lambda v: v.page_text().filter(
        durations.duration_rejected("duration")).select("page_id", "duration")),
    "drop_unauthenticated": _on(lambda v: collect.drop_unauthenticated(v.page_text()).select("page_id", "url")),
    "course_records": _on(lambda v: collect.course_records(v.page_text().drop("duration"))),
    # Pages
    "extract_curriculum_classroom": _on(_classroom),
    "extract_curriculum_classroom_flat": _on(_classroom_flat),
    "extract_section_counts": _on(_section_counts),
    "extract_curriculum_static": _outline("static"),
    "extract_curriculum_outline": _outline("outline"),
    "extract_curriculum_purpose": _outline("purpose"),
    "page_headings": _on(_page_headings),
    "page_items": _on(_page_items),
    "reread_pages": _on(_reread_pages),
    "rejected_pages": _on(_rejected_pages),
    "read_page_archive": _on(_archive),
    "extract_listings": _on(lambda v: curriculum.placeholder_courses(curriculum.resolve_course_links(
        extraction.extract_listings(v.listing_pages()), SITE))),
    # Curricula and links
    "flatten_curriculum": _on(lambda v: curriculum.flatten_curriculum(v.curricula()).drop("duration_rejected")),
    "flatten_curriculum_flat": _on(_flat),
    "section_summary": _on(lambda v: curriculum.section_summary(v.curricula())),
    "resolve_course_links": _on(lambda v: curriculum.resolve_course_links(v.listings(), SITE)),
    "placeholder_courses": _on(lambda v: curriculum.placeholder_courses(
        curriculum.resolve_course_links(v.listings(), SITE))),
}
