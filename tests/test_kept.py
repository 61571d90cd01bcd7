import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from coursepulse.operators import completions, delta, kept, maintenance as m, snapshots as progress
from coursepulse.plans.update import publish_items, publish_lectures
from coursepulse.sources.published import CommitConflict, Commit, PublishedTables
from coursepulse.sources.schemas import LECTURES, SNAPSHOTS

from .conftest import values
from .test_maintenance import items, lecture

DAY = "2024-02-03"


def days_of(tables):
    found = tables.read("completion_days").groupBy("course_id", "completed_date", "is_completed").agg(
        F.sum("lecture_count"), F.sum("timed_count"), F.sum("study_minutes"))
    return values(found)


def test_days_follow_every_batch(spark, tmp_path, courses):
    """After each batch the kept days are those of the lectures, and so are the reports that read them."""
    rng = random.Random(5)
    tables = PublishedTables(spark, str(tmp_path), buckets=4)
    publish_items(tables, items(spark, lecture("1", 1, None, 1, True)), "2024-01-20 08:00:00")
    tables.maintain("completion_days")
    named = courses(*[(c, 1.0, 9.0) for c in range(1, 6)])
    for day in ("2024-01-31", "2024-02-02", DAY):
        rows = [lecture(str(rng.randrange(1, 6)), rng.randrange(1, 4), rng.choice([None, 1]), rng.randrange(4), rng.random() < 0.7)
                for _ in range(60)]
        publish_items(tables, items(spark, *rows), f"{day} 10:00:00")
        lectures, days = tables.read("lectures"), tables.read("completion_days")
        assert days_of(tables) == values(kept.completion_days(lectures))
        for report in ("completed_today_stats", "daily_stats_7d", "month_stats", "today_vs_yesterday", "weekday_pattern_30d"):
            assert values(getattr(kept, report)(days, DAY)) == values(getattr(completions, report)(lectures, DAY)), report
        assert values(kept.completed_today_by_course(days, named, DAY)) == values(completions.completed_today_by_course(lectures, named, DAY))
    assert tables.read("lectures").filter("NOT is_completed").count() > 0
    tables.rebucket("lectures", 3)
    assert days_of(tables) == values(kept.completion_days(tables.read("lectures")))


def test_empty_days(spark, tmp_path):
    tables = PublishedTables(spark, str(tmp_path), buckets=2)
    tables.maintain("completion_days")
    tables.maintain("weekly_deltas")
    none, lectures = tables.read("completion_days"), spark.createDataFrame([], LECTURES)
    for report in ("completed_today_stats", "daily_stats_7d", "month_stats", "today_vs_yesterday", "weekday_pattern_30d"):
        assert values(getattr(kept, report)(none, DAY)) == values(getattr(completions, report)(lectures, DAY)), report
    assert tables.read("weekly_deltas").count() == 0 and tables.newest().kept == ("completion_days", "weekly_deltas")


def test_only_touched_weeks_are_read_and_a_late_one_corrects_its_successor(spark, tmp_path, snapshots, courses, monkeypatch):
    tables = PublishedTables(spark, str(tmp_path))
    weeks = [str(dt.date(2024, 1, 1) + dt.timedelta(7 * n)) for n in range(6)]
    rows = {week: [(c, week, 10.0 * n * c + c) for c in (1, 2, 3) if (n + c) % 4] for n, week in enumerate(weeks)}

    def add(*which):
        tables.publish({"course_progress_snapshots": (snapshots(*[r for week in which for r in rows[week]]), list(which))})

    add(weeks[0], weeks[1])
    tables.maintain("weekly_deltas")
    add(weeks[3], weeks[5])
    read, before = [], tables.newest()
    plain = PublishedTables.read
    monkeypatch.setattr(PublishedTables, "read", lambda self, name, parts=None, commit=None: (
        read.append(sorted(parts or [])), plain(self, name, parts, commit))[1])
    add(weeks[2])  # late
    monkeypatch.undo()
    assert read == [weeks[1:4]]
    after = tables.newest()
    moved = {part for (name, part), path in after.paths.items() if name == "weekly_deltas" and before.paths.get((name, part)) != path}
    assert moved == {weeks[2], weeks[3]}
    add(weeks[4])
    stored, kept_rows = tables.read("course_progress_snapshots"), tables.read("weekly_deltas")
    assert values(kept_rows) == values(delta.weekly_delta(stored).select(kept_rows.columns))
    named = courses(*[(c, 1.0, 900.0 + c) for c in (1, 2, 3)])
    for report in ("week_over_week", "course_pattern", "goal_attainment", "completion_forecast"):
        assert values(getattr(progress, report)(kept_rows, named, "2024-02-06")) == values(getattr(progress, report)(stored, named, "2024-02-06")), report
    assert values(progress.weekly_volume_4w(kept_rows, "2024-02-06")) == values(progress.weekly_volume_4w(stored, "2024-02-06"))
    # A week that is emptied takes its differences along.
    tables.publish({"course_progress_snapshots": (spark.createDataFrame([], SNAPSHOTS), [weeks[3]])})
    stored, kept_rows = tables.read("course_progress_snapshots"), tables.read("weekly_deltas")
    assert values(kept_rows) == values(delta.weekly_delta(stored).select(kept_rows.columns))


def test_writers_of_neighbouring_weeks_meet(spark, tmp_path, snapshots):
    """The later week's differences were made without the earlier one, so its commit is refused; weeks far apart go together."""
    tables = PublishedTables(spark, str(tmp_path))
    tables.maintain("weekly_deltas")
    seen = tables.newest()
    tables.publish({"course_progress_snapshots": (snapshots((1, "2024-01-01", 5.0)), ["2024-01-01"])}, seen)
    with pytest.raises(CommitConflict):
        tables.publish({"course_progress_snapshots": (snapshots((1, "2024-01-08", 9.0)), ["2024-01-08"])}, seen, rebase=True)
    tables.publish({"course_progress_snapshots": (snapshots((1, "2024-03-04", 9.0)), ["2024-03-04"])}, seen, rebase=True)
    assert values(tables.read("weekly_deltas").select(F.col("snapshot_date").cast("string"), "weekly_study")) == [
        ("2024-01-01", 5.0), ("2024-03-04", 9.0)]


def test_manifests_from_before_there_were_kept_tables():
    assert Commit.from_text('{"number": 3, "paths": [], "buckets": {}, "marks": {}}').kept == ()


def new(spark, *rows):
    """Lectures from (course, section, chapter, lecture, title, seq)."""
    full = [(c, s, "S", ch, None, n, title, 1.0, False, 1, None, seq) for c, s, ch, n, title, seq in rows]
    return spark.createDataFrame(full, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in LECTURES) + ", seq long")


ROWS = [(1, 1, None, 1, "a", 3), (1, 1, None, 1, "b", 1), (1, 1, 1, 1, "c", 2), (1, None, 1, 1, "d", 4), (1, None, 1, 1, "e", 5),
        (2, 1, 1, 1, "f", 6), (2, 1, 1, 1, "f", 6), (2, 1, 1, 1, "f", 6), (9, 1, 1, 1, "g", 7), (9, 1, None, 2, "h", 8)]


@pytest.mark.parametrize(("null_safe", "taken", "aside"), [
    (True, "bcdef", [("a", "key came earlier"), ("f", "key came earlier"), ("f", "key came earlier"), ("g", "key is stored"), ("h", "key is stored")]),
    (False, "abcdefh", [("f", "key came earlier"), ("f", "key came earlier"), ("g", "key is stored")]),
])
def test_a_key_is_taken_once(spark, null_safe, taken, aside):
    stored = new(spark, (9, 1, 1, 1, "old", 0), (9, 1, None, 2, "old", 0)).drop("seq")
    kept_rows, rejected = m.insert_lectures(stored, new(spark, *ROWS), null_safe)
    assert kept_rows.columns == stored.columns
    assert sorted(r.lecture_title for r in kept_rows.collect()) == list(taken)
    assert values(rejected.select("lecture_title", "reason")) == aside
    for rows in m.insert_lectures(stored, new(spark), null_safe):
        assert rows.count() == 0


def test_rejected_lectures_are_part_of_the_commit(spark, tmp_path):
    tables = PublishedTables(spark, str(tmp_path), buckets=2)
    tables.maintain("completion_days")
    assert publish_lectures(tables, new(spark, *ROWS), DAY, ("s", 0)) == 2
    assert publish_lectures(tables, new(spark, *ROWS), DAY, ("s", 0)) == 2  # the same batch again
    assert tables.read("lectures").count() == 7 and tables.read("rejected_lectures").count() == 3
    assert publish_lectures(tables, new(spark, (3, 1, 1, 1, "x", 9)), DAY, ("s", 1)) == 3
    assert tables.read("lectures").count() == 8 and tables.read("rejected_lectures").count() == 3
    assert tables.read("completion_days").agg(F.sum("lecture_count")).first()[0] == 8
    assert publish_lectures(tables, new(spark), DAY) == 4  # nothing came
    assert not set(tables.newest().paths) - {key for key in tables.newest().paths if key[0] in ("lectures", "completion_days", "rejected_lectures")}
