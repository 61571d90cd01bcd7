"""Completion history: the fold of an ordered observation log, as set operations.

An item-at-a-time reader flips a lecture between open and done. The last state and the time of the
flip that led to it depend only on where the last "open" observation stands, so the fold has a
closed form: one aggregation finds the last observation and the last open one of every key, and a
second one, over the done observations joined to that, the first after it. Both combine on the map
side, and the join has one row per key on the other side, so a key that holds a third of the log is
split by adaptive execution. Nothing depends on how arrival numbers are spaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LECTURE_KEY = ("course_id", "section_number", "chapter_number", "lecture_number")
# A NULL in one of these never matches a stored row; a NULL chapter does.
MATCHED_KEY = ("course_id", "section_number", "lecture_number")


def matchable() -> Column:
    """The record has a key that can match a stored one."""
    matched = F.lit(True)
    for name in MATCHED_KEY:
        matched &= F.col(name).isNotNull()
    return matched


def arrival(df: DataFrame) -> Column:
    """Arrival order of records: ``seq``, and ``position`` among records of one number where there is that column."""
    return F.struct("seq", *([F.coalesce("position", F.lit(0)).alias("position")] if "position" in df.columns else []))


def fold_observations(log: DataFrame, attributes: list[str], time: str) -> DataFrame:
    """One row per lecture key.

    ``last`` holds the attributes and ``is_completed`` of the last observation, ``any_open`` and
    ``any_done`` tell which states occurred, ``run_start`` is the time of the first done observation
    after the last open one.
    """
    key = list(LECTURE_KEY)
    done = F.col("is_completed")
    states = log.withColumns({"is_completed": F.coalesce(done, F.lit(False)), "arrival": arrival(log)})
    per_key = states.groupBy(*key).agg(
        F.max_by(F.struct(*attributes, "is_completed"), "arrival").alias("last"),
        F.max(F.when(~done, F.col("arrival"))).alias("last_open"),
        F.bool_or(done).alias("any_done"),
    )
    same_key = F.lit(True)
    for name in key:
        same_key &= F.col(f"l.{name}").eqNullSafe(F.col(f"k.{name}"))
    after_open = F.col("k.last_open").isNull() | (F.col("l.arrival") > F.col("k.last_open"))
    # Only keys that end done have a run.
    ends_done = per_key.filter("last.is_completed").select(*key, "last_open")
    runs = (
        states.filter(done).select(*key, "arrival", F.col(time).alias("time")).alias("l")
        .join(ends_done.alias("k"), same_key)
        .filter(after_open)
        .groupBy(*[F.col(f"l.{name}") for name in key])
        .agg(F.min(F.struct("l.arrival", "l.time"))["time"].alias("run_start"))
    )
    same_key = F.lit(True)
    for name in key:
        same_key &= F.col(f"k.{name}").eqNullSafe(F.col(f"r.{name}"))
    return per_key.alias("k").join(runs.alias("r"), same_key, "left").select(
        *[F.col(f"k.{name}") for name in key], "last", F.col("last_open").isNotNull().alias("any_open"), "any_done", "run_start")


def fold_batch(log: DataFrame, attributes: list[str], time: Column) -> DataFrame:
    """``fold_observations`` of observations that were all made at ``time``, in one aggregation: whether a key has a done
    observation after the last open one is all that has to be known."""
    done = F.col("is_completed")
    states = log.withColumns({"is_completed": F.coalesce(done, F.lit(False)), "arrival": arrival(log)})
    per_key = states.groupBy(*LECTURE_KEY).agg(
        F.max_by(F.struct(*attributes, "is_completed"), "arrival").alias("last"),
        F.max(F.when(~done, F.col("arrival"))).alias("last_open"),
        F.max(F.when(done, F.col("arrival"))).alias("last_done"),
    )
    runs = F.col("last.is_completed") & (F.col("last_open").isNull() | (F.col("last_done") > F.col("last_open")))
    return per_key.select(
        *LECTURE_KEY, "last", F.col("last_open").isNotNull().alias("any_open"), F.col("last_done").isNotNull().alias("any_done"),
        F.when(runs, time).alias("run_start"))


def compact_observations(log: DataFrame, settled: int | None = None) -> DataFrame:
    """The observations of ``log`` that can still decide a completion history, unchanged.

    Of each key these are the last observation, the last open one, and the done ones after that. Nothing else matters
    whatever is added, so logs can be cut in any way, compacted, united in any grouping and compacted again:
    ``completion_history`` of what is left is that of all observations. With ``settled``, the arrival number below which no
    observation is going to be added, only the first done one after the last open one is kept of those below it,
    which leaves three rows a key. Rows stay rows, so a key of very many is not gathered anywhere. Records without a matching key stand
    for themselves and stay.
    """
    rows = log.select(F.struct(*[F.col(f"`{c}`") for c in log.columns]).alias("row"), *LECTURE_KEY, matchable().alias("matched"),
                      F.coalesce("is_completed", F.lit(False)).alias("done"), arrival(log).alias("arrival"))
    matched = rows.filter("matched")

    def with_key(left: DataFrame, right: DataFrame) -> DataFrame:
        same = F.lit(True)
        for name in LECTURE_KEY:
            same &= F.col(f"l.{name}").eqNullSafe(F.col(f"k.{name}"))
        return left.alias("l").join(right.alias("k"), same).select("l.*", *[f"k.{c}" for c in right.columns if c not in LECTURE_KEY])

    ends = matched.groupBy(*LECTURE_KEY).agg(F.max("arrival").alias("newest"), F.max(F.when(~F.col("done"), F.col("arrival"))).alias("last_open"))
    after_open = F.col("done") & (F.col("last_open").isNull() | (F.col("arrival") > F.col("last_open")))
    met = with_key(matched, ends)
    if settled is not None:
        firsts = met.filter(after_open).groupBy(*LECTURE_KEY).agg(F.min("arrival").alias("first_done"))
        # A key that ends open has no first one; its rows are found without.
        open_end = ends.filter("newest = last_open").select(*LECTURE_KEY, F.lit(None).cast(firsts.schema["first_done"].dataType).alias("first_done"))
        met = with_key(met, firsts.unionByName(open_end))
        after_open &= (F.col("arrival.seq") >= settled) | (F.col("arrival") == F.col("first_done"))
    decides = (F.col("arrival") == F.col("newest")) | F.coalesce(F.col("arrival") == F.col("last_open"), F.lit(False)) | after_open
    return met.filter(decides).select("row.*").unionByName(rows.filter("NOT matched").select("row.*"))


def merge_observations(*logs: DataFrame, settled: int | None = None) -> DataFrame:
    """Compacted logs, or whole ones, as one compacted log, in whatever order they come."""
    merged = logs[0]
    for more in logs[1:]:
        merged = merged.unionByName(more)
    return compact_observations(merged, settled)


def completion_history(observations: DataFrame) -> DataFrame:
    """Current lecture state from a log of (key, is_completed, observed_at, seq) observations.

    ``completed_at`` is the time of the first done observation after the last open one. Records
    without a matching key each stand for themselves.
    """
    attributes = [
        c for c in observations.columns if c not in (*LECTURE_KEY, "seq", "position", "is_completed", "observed_at")
    ]
    folded = fold_observations(observations.filter(matchable()), attributes, "observed_at")
    done = F.col("last.is_completed")
    matched = folded.select(
        *LECTURE_KEY, *[F.col(f"last.{c}") for c in attributes], done,
        F.when(done, F.col("run_start")).alias("completed_at"),
    )
    lone_done = F.coalesce(F.col("is_completed"), F.lit(False))
    unmatched = observations.filter(~matchable()).select(
        *LECTURE_KEY, *attributes, lone_done.alias("is_completed"),
        F.when(lone_done, F.col("observed_at")).alias("completed_at"),
    )
    return matched.unionByName(unmatched)
