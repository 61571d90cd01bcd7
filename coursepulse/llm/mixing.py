"""Mixing sources to target weights with a low-discrepancy schedule, in DataFrame operations only.

Targets: sources in the order of their names (null last) weigh 5, 2, 1, 5, 2, 1, …; they share ``share`` times all
words, but none more than ``most`` times its own; what a full source cannot take goes to the others by weight.

Schedule: slot i stands at the fractional part of (i + 1/2) / golden ratio. The source whose stretch of the
cumulative weights holds that point gets the slot, so every stretch of the schedule has nearly the final mix. Slots
are ranked within their source; the slot of rank r takes block r modulo the number of blocks. Blocks are equal
stretches of the source's words in shuffled order (by md5 of the id), so many that the source's slots take its target.

Hot sources: the running word count of a source is a sum over small hash ranges and then within each range, so no
window holds a whole source. The number of slots does not grow with the input, only with the number of sources.

Defined cases: a null text has size 0 and is taken 0 words; null is a source of its own, the last; null ids are
shuffled as the empty text; repeated rows are separate documents; without any words all targets are 0; an empty table
gives an empty mix. Other columns are ignored. Reruns agree, as nothing is random.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import WORD, free_name, stage

GOLDEN = 0.6180339887498949
SLOTS = 1 << 18
SLOTS_PER_SOURCE = 512
LEAST_SLOTS = 64
RANGE_DOCS = 4096


class Mix(NamedTuple):
    """``sources``: one row per source; ``schedule``: slot, source_no, rank, epoch, block; ``documents``: words taken."""

    sources: DataFrame
    schedule: DataFrame
    documents: DataFrame


def targets(sources: DataFrame, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Adds source_no, weight and target to (source, source_size, docs)."""
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    numbered = sources.withColumn("source_no", F.row_number().over(ordered) - 1).withColumn(
        "weight", F.element_at(F.array(F.lit(5.0), F.lit(2.0), F.lit(1.0)), (F.col("source_no") % 3 + 1).cast("int")))
    # Sources fill up in the order of size / weight. Each that does raises the level of those after it, up to the
    # first that does not; from there on the level computed in this way falls again, so the highest one holds.
    filling = Window.orderBy(F.col("source_size") / F.col("weight"), "source_no")
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    cap = F.col("source_size") * F.lit(most)
    levels = numbered.withColumn("level", F.try_divide(
        F.sum("source_size").over(everything) * F.lit(share) - F.coalesce(F.sum(cap).over(before), F.lit(0.0)),
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    level = F.max("level").over(everything)
    return levels.withColumn("target", F.least(cap, level * F.col("weight"))).drop("level")


def schedule(sources: DataFrame, slots: int) -> DataFrame:
    """slot, source_no and rank of every slot. Grid cells make the search for a point's source an equality join."""
    everything = Window.partitionBy()
    running = Window.orderBy("source_no")
    # Small sources get a few slots at least; their blocks are smaller in turn.
    stake = F.when(F.col("target") > 0, F.greatest(F.col("target"), F.sum("target").over(everything) * (LEAST_SLOTS / slots)))
    stretches = (
        sources.withColumn("stake", F.coalesce(stake, F.lit(0.0)))
        .withColumn("high", F.try_divide(F.sum("stake").over(running), F.sum("stake").over(everything)))
        .withColumn("low", F.coalesce(F.lag("high").over(running), F.lit(0.0)))
        .filter("stake > 0")
        .withColumn("high", F.when(F.lead("source_no").over(running).isNull(), F.lit(1.0)).otherwise(F.col("high")))
        .select("source_no", "low", "high",
                F.explode(F.sequence(F.floor(F.col("low") * 1024), F.least(F.floor(F.col("high") * 1024), F.lit(1023)))).alias("cell"))
    )
    step = (F.col("id") + 0.5) * GOLDEN
    points = sources.sparkSession.range(slots).select(F.col("id").alias("slot"), (step - F.floor(step)).alias("point"))
    rank = Window.partitionBy("source_no").orderBy("slot")
    return (
        points.withColumn("cell", F.floor(F.col("point") * 1024)).join(stretches, "cell")
        .filter("point >= low AND point < high")
        .select("slot", "source_no", (F.row_number().over(rank) - 1).alias("rank"))
    )


def mix(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", share: float = 1.5,
        most: float = 2.0, slots: int | None = None) -> Mix:
    """Targets, schedule and the words that the mix takes of each document."""
    sized = stage(docs.select(
        F.col(id_col).alias("id"), F.col(source).alias("source"),
        F.size(F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(f"({WORD})"))).cast("bigint").alias("size"),
        F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit(""))).alias("shuffle")), "sizes")
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    sources = stage(targets(totals, share, most), "sources")
    if slots is None:
        slots = max(SLOTS, SLOTS_PER_SOURCE * sources.count())
    ranked = schedule(sources, slots)
    blocks = ranked.groupBy("source_no").agg(F.count("*").alias("slots"))
    # So many blocks that slots times block size comes to the target, and no block is taken more than `most` times.
    sources = stage(sources.join(blocks, "source_no", "left").withColumn(
        "blocks", F.ceil(F.try_divide(F.col("slots") * F.col("source_size"), F.col("target")))), "sources")
    planned = stage(
        ranked.join(sources.select("source_no", "blocks"), "source_no")
        .select("slot", "source_no", "rank", F.expr("rank div blocks").alias("epoch"), (F.col("rank") % F.col("blocks")).alias("block")),
        "schedule")
    placed = _placed(sized, sources)
    first, last = (F.expr(f"(({at}) * blocks - 1) div source_size") for at in ("start + 1", "start + size"))
    pieces = placed.withColumn("block", F.explode_outer(F.when((F.col("size") > 0) & F.col("blocks").isNotNull(), F.sequence(first, last))))
    begin, end = (F.expr(f"({at}) * source_size div blocks") for at in ("block", "block + 1"))
    overlap = F.least(F.col("start") + F.col("size"), end) - F.greatest(F.col("start"), begin)
    times = planned.groupBy("source_no", "block").agg(F.count("*").alias("times"))
    taken = (
        pieces.join(times, ["source_no", "block"], "left")
        .groupBy("source_no", "range", "place", "id", "size", "source", "source_size", "target")
        .agg(F.coalesce(F.sum(overlap * F.col("times")), F.lit(0)).cast("bigint").alias("taken"))
    )
    return Mix(sources, planned, taken.select("id", "source", "size", "source_size", "target", "taken"))


def _placed(sized: DataFrame, sources: DataFrame) -> DataFrame:
    """``start``: the words of the source before each document in shuffled order; (source_no, range, place) is its key."""
    lead = F.conv(F.substring("shuffle", 1, 8), 16, 10).cast("bigint")
    ranged = (
        sized.join(sources, sized["source"].eqNullSafe(sources["source"]))
        .select(sized["id"], sized["source"], sized["size"], sized["shuffle"], "source_no", "source_size", "target", "blocks",
                F.shiftright(lead * F.ceil(F.col("docs") / RANGE_DOCS), 32).alias("range"))
    )
    of_source = Window.partitionBy("source_no").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy("source_no", "range").agg(F.sum("size").alias("words")).select(
        "source_no", "range", F.coalesce(F.sum("words").over(of_source), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("source_no", "range").orderBy("shuffle", "id", "size")
    return (
        ranged.join(offsets, ["source_no", "range"])
        .withColumn("place", F.row_number().over(inside))
        .withColumn("start", F.col("offset") + F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    )


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The rows of the mix, with their own columns: a document as often as the mix takes its words, to the nearest whole
    number (0, 1 or 2 times by default). Rows that share an id, null included, are taken equally often."""
    own, times, time = (free_name(docs, name) for name in ("mixed_id", "mixed_times", "mixed_time"))
    taken = mix(docs, id_col, text, source, **options).documents.groupBy(F.col("id").alias(own)).agg(
        F.coalesce(F.round(F.try_divide(F.sum("taken"), F.sum("size"))), F.lit(0)).cast("int").alias(times))
    return (
        docs.join(taken.filter(F.col(times) > 0), F.col(f"`{id_col}`").eqNullSafe(F.col(own)))
        .withColumn(time, F.explode(F.sequence(F.lit(1), F.col(times))))
        .select(*[F.col(f"`{c}`") for c in docs.columns])
    )
