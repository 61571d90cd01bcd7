import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from coursepulse.operators import maintenance as m
from coursepulse.operators.history import completion_history
from coursepulse.plans import update
from coursepulse.sources import migrations
from coursepulse.sources.schemas import COURSES, CRAWL_LOGS, ITEMS, LECTURES, SNAPSHOTS

from .conftest import values

NOW = "2024-01-31 10:00:00"
NOW_TIME = dt.datetime.fromisoformat(NOW)
OLD_TIME = dt.datetime(2023, 5, 5)


def items(spark, *rows):
    """Item records from dicts, numbered in order."""
    full = [tuple({"seq": n, **row}.get(name) for name in ITEMS.fieldNames()) for n, row in enumerate(rows)]
    return spark.createDataFrame(full, ITEMS)


def lecture(course_id, section, chapter, number, done, title="t"):
    return {"item_type": "lecture", "course_id": course_id, "section_number": section, "chapter_number": chapter,
            "lecture_number": number, "is_completed": done, "lecture_title": title, "lecture_time": 5.0}


def stored(spark, *rows):
    full = [(c, s, "old", ch, None, n, "old", 1.0, done, 1, at) for c, s, ch, n, done, at in rows]
    return spark.createDataFrame(full, LECTURES)


def state(df):
    return values(df.select("course_id", "section_number", "chapter_number", "lecture_number", "is_completed", "completed_at"))


@pytest.mark.parametrize("before, after, at_before, at_after", [
    (None, [False], None, None),
    (None, [True], None, NOW_TIME),
    (False, [True], None, NOW_TIME),
    (True, [False], OLD_TIME, None),
    (True, [True], OLD_TIME, OLD_TIME),
    (False, [False], None, None),
    ("null", [True], OLD_TIME, OLD_TIME),
    ("null", [True], None, None),
    ("null", [False, True], None, NOW_TIME),
    ("null", [False], OLD_TIME, OLD_TIME),
    (True, [False, True], OLD_TIME, NOW_TIME),
    (True, [True, False], OLD_TIME, None),
    (False, [True, False, True, True], None, NOW_TIME),
    (False, [None], None, None),
])
def test_completion_transitions(spark, before, after, at_before, at_after):
    base = [] if before is None else [(1, 1, None, 1, None if before == "null" else before, at_before)]
    df = m.upsert_lectures(
        stored(spark, *base), items(spark, *[lecture("1", 1, None, 1, done) for done in after]), NOW)
    assert state(df) == [(1, 1, None, 1, bool(after[-1]), at_after)]
    assert df.first().lecture_title == "t"


def model_upsert(table, records):
    """Row-at-a-time update of a list of stored dicts."""
    for r in records:
        cid = r["course_id"]
        if not (cid or "").isdigit():
            continue
        key = (int(cid), r["section_number"], r["chapter_number"], r["lecture_number"])
        hit = None
        if None not in (key[0], key[1], key[3]):
            hit = next((row for row in table if row["key"] == key), None)
        new = bool(r["is_completed"])
        if hit is None:
            table.append({"key": key, "done": new, "at": NOW_TIME if new else None, "title": r["lecture_title"]})
            continue
        if hit["done"] is False and new:
            hit["at"] = NOW_TIME
        elif hit["done"] is True and not new:
            hit["at"] = None
        hit.update(done=new, title=r["lecture_title"])
    return sorted(((*row["key"], row["done"], row["at"], row["title"]) for row in table), key=repr)


@pytest.mark.parametrize("seed", [1, 3])
def test_batch_equals_row_by_row(spark, seed):
    rng = random.Random(seed)
    keys = [(c, s, ch, n) for c in range(1, 5) for s in (1, None) for ch in (None, 1) for n in (1, 2)]
    table = [
        {"key": k, "done": done, "at": OLD_TIME if done else None, "title": "old"}
        for k in keys if None not in (k[0], k[1], k[3]) and rng.random() < 0.6
        for done in [rng.choice([True, False, None])]
    ]
    records = []
    for n in range(300):
        c, s, ch, l = rng.choice(keys)
        records.append(lecture(rng.choice([str(c), str(c), f"x{c}", None]), s, ch, l, rng.random() < 0.5, f"t{n}"))
    base = stored(spark, *[(*row["key"], row["done"], row["at"]) for row in table])
    df = m.upsert_lectures(base, items(spark, *records), NOW)
    got = values(df.select("course_id", "section_number", "chapter_number", "lecture_number", "is_completed",
                           "completed_at", "lecture_title"))
    assert got == model_upsert(table, records)


@pytest.mark.parametrize("spacing", [1, 1 << 40])
def test_completion_history_equals_the_fold(spark, spacing):
    rng = random.Random(5)
    log = [
        # The first key holds a third of the log.
        (1 if n % 3 == 0 else rng.randrange(6), rng.choice([1, None, 2]), None, 1, rng.random() < 0.6,
         dt.datetime(2024, 1, 1) + dt.timedelta(minutes=n), n * spacing)
        for n in range(400)
    ]
    want, lone = {}, []
    for c, s, ch, l, done, at, _ in log:
        if s is None:
            lone.append((c, s, ch, l, done, at if done else None))
            continue
        was, since = want.get((c, s, ch, l), (False, None))
        want[(c, s, ch, l)] = (done, (since if was else at) if done else None)
    df = spark.createDataFrame(
        log, "course_id BIGINT, section_number INT, chapter_number INT, lecture_number INT, is_completed BOOLEAN, "
             "observed_at TIMESTAMP, seq BIGINT").repartition(7)
    got = values(completion_history(df))
    assert got == sorted([(*k, *v) for k, v in want.items()] + lone, key=repr)


def course(url, title="A course title", **rest):
    return {"item_type": "course", "url": url, "course_title": title, "progress_rate": 5.0, "study_time": 6.0,
            "total_lecture_time": 7.0, **rest}


def base_courses(spark):
    return spark.createDataFrame(
        [(1, "Old", 1.0, 2.0, 3.0, "https://x/classroom/1", 4, True, OLD_TIME)], COURSES)


def test_course_upsert_overwrites_also_with_null(spark):
    batch = items(spark, course("https://x/classroom/1", "first"), course("https://x/classroom/1", "second", study_time=None))
    row = m.upsert_courses(base_courses(spark), batch, NOW).first()
    assert (row.course_title, row.study_time, row.display_order, row.is_target_course, row.updated_at) == (
        "second", None, None, True, NOW_TIME)
    kept = m.upsert_courses(base_courses(spark), batch, NOW, keep_nonnull=True).first()
    assert (kept.study_time, kept.display_order) == (2.0, 4)


def test_course_upsert_takes_the_id_from_the_url(spark):
    batch = items(
        spark, course("https://x/classroom/2/", course_id="99"), course("https://x/classroom/3?q=1", course_id="3"),
        course("https://x/classroom/abc"), course("https://x/classroom/0"), course(None))
    df = m.upsert_courses(base_courses(spark), batch, NOW)
    assert values(df.select("course_id", "updated_at", "is_target_course")) == [
        (1, OLD_TIME, True), (2, None, False)]
    assert values(m.crawl_log(batch, NOW).select("course_id", "crawl_status", "error_message")) == [(2, "success", None)]


def test_course_upsert_without_a_title_column(spark):
    batch = items(spark, course("https://x/classroom/1")).drop("course_title", "display_order")
    assert m.upsert_courses(base_courses(spark), batch, NOW).first().course_title == "Unknown Title"


@pytest.mark.parametrize("as_of, week", [
    ("2024-01-29", "2024-01-29"), ("2024-02-04", "2024-01-29"), ("2024-01-01", "2024-01-01"), ("2023-12-31", "2023-12-25")])
def test_snapshot_upsert(spark, as_of, week):
    base = spark.createDataFrame(
        [(1, dt.date.fromisoformat(week), 1.0, 1.0, 1.0, OLD_TIME), (1, dt.date(2023, 1, 2), 0.5, 0.5, 0.5, OLD_TIME)],
        SNAPSHOTS)
    batch = items(spark, course("https://x/classroom/1", progress_rate=8.0), course("https://x/classroom/1", progress_rate=9.0),
                  course("https://x/classroom/2"))
    df = m.upsert_snapshots(base, batch, as_of)
    assert values(df.select("course_id", F.col("snapshot_date").cast("string"), "progress_rate", "created_at")) == sorted([
        (1, "2023-01-02", 0.5, OLD_TIME), (1, week, 9.0, OLD_TIME),
        (2, week, 5.0, dt.datetime.fromisoformat(as_of))], key=repr)


def test_replace_curriculum(spark):
    base = stored(spark, (1, 1, None, 1, True, OLD_TIME), (2, 1, None, 1, True, OLD_TIME))
    curricula = spark.sql("""
        SELECT 1L AS course_id, array(
            named_struct('section', 'Empty', 'section_number', 4, 'complete_count', 0, 'total_count', 0,
                'chapters', CAST(NULL AS array<struct<chapter_number:int,chapter_title:string,lessons:array<struct<title:string,duration:string,is_completed:boolean>>>>),
                'lessons', CAST(array() AS array<struct<title:string,duration:string,is_completed:boolean>>)),
            named_struct('section', CAST(NULL AS string), 'section_number', 9, 'complete_count', 0, 'total_count', 0,
                'chapters', CAST(NULL AS array<struct<chapter_number:int,chapter_title:string,lessons:array<struct<title:string,duration:string,is_completed:boolean>>>>),
                'lessons', array(named_struct('title', 'a', 'duration', '2:30', 'is_completed', true),
                                 named_struct('title', CAST(NULL AS string), 'duration', 'x', 'is_completed', true)))) AS sections""")
    df = m.replace_curriculum(base, curricula)
    assert df.schema.fieldNames() == LECTURES.fieldNames()
    assert values(df.filter("course_id = 1").select(
        "section_number", "section_title", "lecture_number", "lecture_title", "lecture_time", "is_completed", "sort_order",
        "completed_at")) == [(2, "Section 2", 1, "a", 2.5, False, 1, None), (2, "Section 2", 2, "", None, False, 2, None)]
    assert df.filter("course_id = 2").count() == 1


def test_replace_curriculum_takes_the_last_of_a_course(spark):
    lessons = "array<struct<title:string,duration:string,is_completed:boolean>>"
    shape = (f"course_id long, seq long, sections array<struct<section:string,section_number:int,complete_count:long,total_count:long,"
             f"chapters:array<struct<chapter_number:int,chapter_title:string,lessons:{lessons}>>,lessons:{lessons}>>")
    def curriculum(seq, title):
        return (1, seq, [("Part", 1, 0, 1, None, [(title, "2:30", False)])])
    curricula = spark.createDataFrame([curriculum(1 << 60, "later"), curriculum(5, "earlier")], shape)
    df = m.replace_curriculum(stored(spark, (1, 7, None, 7, True, OLD_TIME)), curricula)
    assert [r.lecture_title for r in df.collect()] == ["later"]


def test_of_stored_rows_with_one_key_the_first_is_updated(spark):
    base = stored(spark, (1, 1, None, 1, False, None), (1, 1, None, 1, False, None)).withColumn(
        "sort_order", F.when(F.monotonically_increasing_id() % 2 == 0, 1).otherwise(2))
    df = m.upsert_lectures(base, items(spark, lecture("1", 1, None, 1, True)), NOW)
    assert state(df) == [(1, 1, None, 1, False, None), (1, 1, None, 1, True, NOW_TIME)]


def test_records_of_one_page_arrive_in_their_order(spark):
    batch = items(spark, *[{**lecture("1", 1, None, 1, done), "seq": 2**63 - 1, "position": n} for n, done in enumerate([True, False, True])])
    assert state(m.upsert_lectures(stored(spark, (1, 1, None, 1, True, OLD_TIME)), batch, NOW)) == [(1, 1, None, 1, True, NOW_TIME)]


def test_set_target(spark):
    rows = spark.createDataFrame([(i, f"c{i}", None, None, None, None, None, i == 1, None) for i in (1, 2, 3)], COURSES)
    assert values(m.set_target(rows, [2, 3]).select("course_id", "is_target_course")) == [(1, True), (2, True), (3, True)]
    assert values(m.set_target(rows, [1], False).select("course_id", "is_target_course")) == [(1, False), (2, False), (3, False)]


def test_route_items_passes_other_records_through(spark):
    batch = items(spark, course("https://x/classroom/1"), lecture("1", 1, None, 1, True),
                  {"item_type": "outline", "payload": "{}"}, {"item_type": None, "payload": "?"})
    routed = update.route_items(batch)
    assert [df.count() for df in routed] == [1, 1, 2]


def test_recollect_can_keep_completion_times(spark):
    courses = spark.createDataFrame(
        [(1, "bad", 0.0, 0.0, 100.0, "u", None, False, None), (2, "good", 0.0, 0.0, 1.0, "u", None, False, None)], COURSES)
    base = stored(spark, (1, 1, None, 1, True, OLD_TIME), (2, 1, None, 1, True, OLD_TIME))
    fresh = items(spark, lecture("1", 1, None, 1, True), lecture("1", 1, None, 2, True), lecture("2", 1, None, 9, True))
    again = update.recollect(courses, base, fresh, NOW)
    assert state(again) == [(1, 1, None, 1, True, NOW_TIME), (1, 1, None, 2, True, NOW_TIME), (2, 1, None, 1, True, OLD_TIME)]
    kept = update.recollect(courses, base, fresh, NOW, preserve_completed_at=True)
    assert state(kept) == [(1, 1, None, 1, True, OLD_TIME), (1, 1, None, 2, True, NOW_TIME), (2, 1, None, 1, True, OLD_TIME)]


def test_key_checks(spark):
    df = stored(spark, (1, 1, None, 1, True, None), (1, 1, None, 1, True, None), (1, 1, 2, 1, True, None), (1, 1, 2, 1, True, None))
    assert values(migrations.duplicate_keys(df)) == [(1, 1, 2, 1, 2), (1, 1, None, 1, 2)]
    assert values(migrations.duplicate_keys(df, null_safe=False)) == [(1, 1, 2, 1, 2)]
    assert values(migrations.chapter_mix(df)) == [(1, 1, "old", 2, 4)]


def test_added_columns_are_null(spark):
    old = spark.createDataFrame([(1, "u", "extra")], "course_id BIGINT, url STRING, note STRING")
    df = migrations.add_columns(old, COURSES)
    assert df.columns == [*COURSES.fieldNames(), "note"] and df.first().display_order is None
    shown = migrations.describe_table(df).collect()
    assert tuple(shown[0]) == ("course_id", "bigint", True)


def test_empty_tables_and_batches(spark):
    tables = {"courses": spark.createDataFrame([], COURSES), "lectures": spark.createDataFrame([], LECTURES),
              "course_progress_snapshots": spark.createDataFrame([], SNAPSHOTS), "crawl_logs": spark.createDataFrame([], CRAWL_LOGS)}
    after = update.apply_items(tables, items(spark), NOW)
    assert {name: df.count() for name, df in after.items()} == dict.fromkeys(tables, 0)
