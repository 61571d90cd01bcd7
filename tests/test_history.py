import random

import pytest
from pyspark.sql import functions as F

from coursepulse.operators.history import (
    LECTURE_KEY, compact_observations, completion_history, fold_batch, fold_observations, merge_observations,
)

from .conftest import values

SCHEMA = ("course_id long, section_number int, chapter_number int, lecture_number int, lecture_title string, is_completed boolean, "
          "observed_at string, seq long, position int")


def made_log(spark, seed, n=160):
    rng = random.Random(seed)
    rows = []
    for seq in range(n):
        key = (rng.choice([1, 2]), rng.choice([1, 1, 1, None]), rng.choice([None, 1]), rng.choice([1, 2, 2]))
        rows.append((*key, f"t{seq}", rng.choice([True, True, False, None]), f"2024-01-{seq % 28 + 1:02}", seq // 2, seq % 2))
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("seed", range(2))
def test_any_cut_in_any_grouping(spark, seed):
    """Pieces that interleave, merged as ((c a) (d b)) and all at once, give the history of the whole log."""
    log = made_log(spark, seed)
    want = values(completion_history(log))
    pieces = [log.filter(F.pmod(F.xxhash64(F.lit(seed), "seq"), F.lit(4)) == n) for n in range(4)]
    a, b, c, d = map(compact_observations, pieces)
    assert values(completion_history(merge_observations(merge_observations(c, a), merge_observations(d, b)))) == want
    assert values(completion_history(merge_observations(b, d, a, c))) == want
    assert values(completion_history(merge_observations(pieces[2], a.unionByName(pieces[3]), b))) == want
    once = compact_observations(log)
    assert values(compact_observations(once)) == values(once)


@pytest.mark.parametrize("seed", range(2))
def test_settled_logs_keep_three_rows_a_key(spark, seed):
    log = made_log(spark, seed, 240)
    early, late = log.filter("seq < 80"), log.filter("seq >= 80")
    settled = compact_observations(early, settled=80)
    per_key = settled.filter("section_number IS NOT NULL").groupBy("course_id", "section_number", "chapter_number", "lecture_number").count()
    assert per_key.agg(F.max("count")).first()[0] <= 3
    assert values(completion_history(merge_observations(settled, late))) == values(completion_history(log))


def test_an_open_observation_that_comes_late(spark):
    """It splits a run of done ones: the completion moves to the first done one after it."""
    rows = [(1, 1, None, 1, "t", done, f"day {seq}", seq, None) for seq, done in ((1, True), (5, True), (9, True))]
    done = compact_observations(spark.createDataFrame(rows, SCHEMA))
    late = spark.createDataFrame([(1, 1, None, 1, "t", False, "day 4", 4, None)], SCHEMA)
    assert completion_history(done).first().completed_at == "day 1"
    assert completion_history(merge_observations(late, done)).first().completed_at == "day 5"


def test_columns_and_empty_logs(spark):
    """Columns of the names used inside pass through; rows are what they were."""
    log = made_log(spark, 9, 20).selectExpr("*", "1 AS arrival", "2 AS newest", "3 AS row", "4 AS `meta.url`")
    assert compact_observations(log).columns == log.columns
    assert set(values(compact_observations(log))) <= set(values(log))
    assert compact_observations(log.limit(0)).count() == 0 and compact_observations(log.limit(0), settled=3).count() == 0


def test_observations_of_one_time_need_no_join(spark):
    """``fold_batch`` is ``fold_observations`` where all were made at one time."""
    draw = random.Random(3)
    rows = [(draw.randrange(3), 1, draw.choice([None, 1]), draw.randrange(3), draw.choice([True, False, None]), n, f"t{n}") for n in range(60)]
    # Two observations of the same number and place, one open and one done.
    rows += [(9, 1, None, 1, True, 100, "x"), (9, 1, None, 1, False, 100, "x"), (9, 1, None, 2, True, 101, "y")]
    log = spark.createDataFrame(rows, "course_id long, section_number int, chapter_number int, lecture_number int, is_completed boolean, seq long, title string")
    now = F.lit("2024-01-31 00:00:00").cast("timestamp")
    want = fold_observations(log.withColumn("observed_at", now), ["title"], "observed_at")
    got = fold_batch(log, ["title"], now)
    assert got.columns == want.columns
    certain = "NOT (course_id = 9 AND lecture_number = 1)"
    assert sorted(map(repr, got.filter(certain).collect())) == sorted(map(repr, want.filter(certain).collect()))
    assert got.filter(f"NOT ({certain})").select("run_start", "any_open", "any_done").collect() == [(None, True, True)]
    assert got.count() == want.count() and "Join" not in got._sc._jvm.PythonSQLUtils.explainString(got._jdf.queryExecution(), "simple")
    assert set(LECTURE_KEY) < set(got.columns)
