"""What the two removers of repeated passages share: from texts to the windows that are repeated, and to what is left.

A sequence (the words or the bytes of a text) is looked at in windows of ``window`` units. Each window has an anchor,
its least stretch of ``block`` units by hash; equal windows have equal anchors. The steps:

1. ``anchors``: all anchors of all documents, sorted by the hash of their stretch. Those that are unique drop out. Of
   the others, those that agree in everything that any of their windows can hold (their hull) are settled at once,
   those that a task finds itself before anything is shuffled.
2. ``surroundings``: what is around the anchors that are left, taken from the texts.
3. ``extend``: anchors of one hash meet in one task, in order, and the windows around them are compared. A hash of more than
   ``DEALT_ROWS`` anchors is dealt to several tasks, and a group of more than ``GROUP_ROWS`` goes through a task in pieces; the
   different windows of their pieces meet again in an aggregation.
4. ``remove``: the windows found to be repeated are laid over their document, and what they cover is cut out.

No pairs of occurrences are made: the work is linear in the number of anchors, however large a group is. Texts are
compressed before they are shuffled. Every step is a table in the shared folder.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import anchors as anchor
from .shared import each_row, ship, stage

GROUP_ROWS = 20_000
DEALT_ROWS = 512
BATCH_WINDOWS = 500_000


class Rule(NamedTuple):
    """``units``: a text's units as 64-bit numbers; ``cut``: what is left of a text under a mask of covered units;
    ``window``, ``block``: lengths in units; ``plain``: units are the bytes themselves; ``first_stays``: of equal
    windows the first does not count as repeated."""

    units: Callable[[bytes], np.ndarray]
    cut: Callable[[bytes, np.ndarray], bytes]
    window: int
    block: int
    plain: bool
    first_stays: bool

    @property
    def reach(self) -> int:
        """The most units of a window on one side of its anchor."""
        return self.window - self.block


class Anchors(NamedTuple):
    """Of one text: running sums of its units; the anchors' positions and hashes; the windows of anchor k start at
    ``starts[k]`` up to, but not at, ``starts[k + 1]``."""

    running: np.ndarray
    at: np.ndarray
    hashes: np.ndarray
    starts: np.ndarray


def find_anchors(units: np.ndarray, rule: Rule) -> Anchors:
    running = anchor.sums(units)
    hashes = anchor.stretches(running, rule.block)
    owner = anchor.least(hashes, rule.reach + 1)
    first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    return Anchors(running, owner[first], hashes[owner[first]], np.append(first, len(owner)))


def pack(docs: DataFrame) -> DataFrame:
    """id and the compressed UTF-8 bytes of the body, null being empty."""
    ship(docs.sparkSession)

    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeezer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            packed = pa.array([squeezer.compress(t.as_py()) for t in batch["body"]], pa.binary())
            yield pa.RecordBatch.from_arrays([batch["id"], packed], ["id", "packed"])

    return _bytes(docs).mapInArrow(squeeze, f"id {docs.schema['id'].dataType.simpleString()}, packed binary")


def _bytes(docs: DataFrame) -> DataFrame:
    return docs.select("id", F.encode(F.coalesce("body", F.lit("")), "UTF-8").alias("body"))


def anchors(docs: DataFrame, rule: Rule) -> DataFrame:
    """hash, id, at, settled, open: the anchors that others share. Settled ones have only repeated windows; the open ones
    (and among them a settled one that stands for its copies) go on."""
    ship(docs.sparkSession)
    kinds = {"hash": np.int64, "hull": np.int64, "at": np.int32, "whole": np.bool_, "done": np.bool_, "twice": np.bool_}

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[str, list[np.ndarray]] = {k: [] for k in (*kinds, "row")}
            held = 0
            for row, body in enumerate(batch["body"]):
                units = rule.units(body.as_py())
                if len(units) < rule.window:
                    continue
                own = find_anchors(units, rule)
                low, high = own.at - rule.reach, own.at + rule.window
                whole = (low >= 0) & (high <= len(units))  # else the text ends before the hull does
                hull = np.zeros(len(own.at), np.uint64)
                hull[whole] = anchor.stretch(own.running, low[whole], high[whole])
                for name, values in (("hash", own.hashes.view(np.int64)), ("hull", hull.view(np.int64)), ("at", own.at),
                                     ("whole", whole), ("row", np.full(len(own.at), row))):
                    found[name].append(values)
                held += len(own.at)
                if held >= BATCH_WINDOWS:
                    yield _anchor_rows(found, batch["id"], kinds)
                    found, held = {k: [] for k in found}, 0
            if held:
                yield _anchor_rows(found, batch["id"], kinds)

    every = _bytes(docs).mapInArrow(find, f"id {docs.schema['id'].dataType.simpleString()}, hash long, hull long, at int, "
                                          "whole boolean, done boolean, twice boolean")
    same_hash = Window.partitionBy("hash")
    same_hull = Window.partitionBy("hash", "hull", "whole", "done")
    ranked = (
        every.withColumn("shared", F.count("*").over(same_hash)).filter("shared > 1 OR done OR twice")
        .withColumn("place", F.row_number().over(same_hull.orderBy("id", "at")))
        .withColumn("copies", F.count("*").over(same_hull))
        .withColumn("gone", F.col("done") | (F.col("whole") & (F.col("place") > 1)))
        .withColumn("others", F.count_if(~F.col("gone")).over(same_hash))
        .withColumn("settled", F.col("gone") if rule.first_stays else F.col("gone") | F.col("twice") | (F.col("whole") & (F.col("copies") > 1)))
        .withColumn("open", ~F.col("gone") & (F.col("others") > 1))
    )
    return ranked.filter("settled OR open").select("hash", "id", "at", "settled", "open")


def _anchor_rows(found: dict[str, list[np.ndarray]], ids: pa.Array, kinds: dict) -> pa.RecordBatch:
    """The anchors found so far. Of those with equal hulls all but the first are done here: they are repeated whatever
    else there is. They no longer stand for their hash, and are dealt out by a number of their own instead, so that a
    passage that fills a third of all texts goes to its hash's task once for each batch."""
    row = np.concatenate(found["row"])
    columns = {k: np.concatenate(found[k]) for k in ("hash", "hull", "at", "whole")}
    rank = np.empty(len(ids), np.int64)
    rank[pc.sort_indices(ids).to_numpy()] = np.arange(len(ids))
    order = np.lexsort((columns["at"], rank[row]))
    key = anchor.mix(columns["hash"].view(np.uint64) ^ anchor.mix(columns["hull"].view(np.uint64)))
    alone = ~columns["whole"]
    key[alone] = anchor.mix(key[alone] + anchor.mix(np.flatnonzero(alone).astype(np.uint64)))  # no hull: equal to none
    _, first, group, copies = np.unique(key[order], return_index=True, return_inverse=True, return_counts=True)
    leads = np.zeros(len(order), bool)
    leads[order[first]] = True
    often = np.empty(len(order), np.int64)
    often[order] = copies[group]
    columns["done"], columns["twice"] = ~leads, leads & (often > 1)
    columns["hash"][~leads] = anchor.mix(key[~leads] + anchor.mix(np.flatnonzero(~leads).astype(np.uint64))).view(np.int64)
    return pa.RecordBatch.from_pydict({"id": ids.take(pa.array(row))} | {k: pa.array(columns[k].astype(kind)) for k, kind in kinds.items()})


def surroundings(packed: DataFrame, opened: DataFrame, rule: Rule) -> DataFrame:
    """hash, id, at, first, held: for each open anchor the windows whose anchor it is. The first of them starts ``first``
    units before it; ``held`` is the bytes that they span, or else their hashes."""
    ship(packed.sparkSession)
    wanted = opened.groupBy("id").agg(F.collect_list("at").alias("places"))
    out_type = f"hash long, id {packed.schema['id'].dataType.simpleString()}, at int, first int, held binary"

    def around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opener = zstandard.ZstdDecompressor()
        for batch in batches:
            out: dict[str, list] = {k: [] for k in ("hash", "row", "at", "first", "held")}
            size = 0
            for row in range(len(batch)):
                body = opener.decompress(batch["packed"][row].as_py())
                own = find_anchors(rule.units(body), rule)
                windows = None if rule.plain else anchor.stretches(own.running, rule.window)
                for k in np.flatnonzero(np.isin(own.at, batch["places"][row].as_py())).tolist():
                    low, high = int(own.starts[k]), int(own.starts[k + 1])
                    held = body[low:high - 1 + rule.window] if rule.plain else windows[low:high].tobytes()
                    for name, value in (("hash", own.hashes[k].view(np.int64)), ("row", row), ("at", own.at[k]), ("first", own.at[k] - low), ("held", held)):
                        out[name].append(value)
                    size += len(held)
                if size >= 8 * BATCH_WINDOWS:
                    yield _surrounding_rows(out, batch["id"])
                    out, size = {k: [] for k in out}, 0
            if size:
                yield _surrounding_rows(out, batch["id"])

    return packed.join(wanted, "id").select("id", "packed", "places").mapInArrow(around, out_type)


def _surrounding_rows(out: dict[str, list], ids: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        "hash": pa.array(out["hash"], pa.int64()), "id": ids.take(pa.array(out["row"], pa.int64())), "at": pa.array(out["at"], pa.int32()),
        "first": pa.array(out["first"], pa.int32()), "held": pa.array(out["held"], pa.binary())})


def extend(around: DataFrame, opened: DataFrame, rule: Rule, group_rows: int = GROUP_ROWS, dealt_rows: int = DEALT_ROWS) -> DataFrame:
    """id, low, high: runs of starts of repeated windows. ``opened``: the anchors (with their hash) that ``around`` surrounds."""
    ship(around.sparkSession)
    id_type = around.schema["id"].dataType.simpleString()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: pa.Table | None = None
        cut_hash = None  # a group that went through in part already
        for batch in batches:
            waiting = pa.Table.from_batches([batch]) if waiting is None else pa.concat_tables([waiting, pa.Table.from_batches([batch])])
            while waiting.num_rows > group_rows:
                hashes = waiting["hash"].to_numpy()
                last = int(np.searchsorted(hashes, hashes[group_rows]))  # the group at the limit waits, unless it began before
                split = last == 0
                size = group_rows if split else last
                yield from _compare(waiting.slice(0, size), rule, {cut_hash, hashes[0] if split else None})
                cut_hash = hashes[size - 1] if split else None
                waiting = waiting.slice(size)
        if waiting is not None and waiting.num_rows:
            yield from _compare(waiting, rule, {cut_hash})

    often = opened.groupBy("hash").agg(F.count("*").alias("anchors")).filter(F.col("anchors") > dealt_rows).select(
        "hash", F.ceil(F.col("anchors") / dealt_rows).alias("tasks"))
    dealt = around.join(stage(often, "often"), "hash", "left").withColumn(
        "dealt", F.coalesce(F.pmod(F.xxhash64("id", "at"), F.col("tasks")), F.lit(-1))).drop("tasks")
    met = stage(dealt.repartition("hash", "dealt").sortWithinPartitions("hash", "id", "at")
                .mapInArrow(meet, f"id {id_type}, low int, high int, hash long, shift int, content long"), "met")
    # Of a window that stands in several pieces there is one row for each of them.
    pieces = met.filter("content IS NOT NULL")
    window = ["hash", "shift", "content"]
    all_of = pieces.groupBy(*window).agg(F.min(F.struct("id", "low")).alias("first"), F.count("*").alias("copies")).filter("copies > 1")
    repeated = pieces.join(all_of, window)
    if rule.first_stays:
        repeated = repeated.filter(F.struct("id", "low") != F.col("first"))
    return met.filter("content IS NULL").select("id", "low", "high").unionByName(repeated.select("id", "low", "high"))


def _compare(rows: pa.Table, rule: Rule, cut: set) -> Iterator[pa.RecordBatch]:
    """Runs of repeated windows among anchors in order of (hash, id, at). For the hashes in ``cut`` and those that are dealt, which have
    anchors elsewhere too, also one row for each different window: its first start, shift and content."""
    rows = rows.combine_chunks()
    at, first = rows["at"].to_numpy(), rows["first"].to_numpy()
    contents = []
    for held in rows["held"]:
        raw = held.as_py()
        contents.append(anchor.stretches(anchor.sums(np.frombuffer(raw, np.uint8).astype(np.uint64)), rule.window) if rule.plain
                        else np.frombuffer(raw, np.uint64))
    counts = np.array([len(c) for c in contents])
    content = np.concatenate(contents)
    row = np.repeat(np.arange(len(counts)), counts)
    begin = np.concatenate([[0], np.cumsum(counts)[:-1]])
    inside = np.arange(len(content)) - begin[row]
    shift = first[row] - inside  # units from the window's start to the anchor
    hashes = rows["hash"].to_numpy()[row]
    cut = np.union1d(rows["hash"].to_numpy()[rows["dealt"].to_numpy() >= 0], np.array(list(cut - {None}), np.int64))
    key = anchor.mix(anchor.mix(hashes.view(np.uint64) + shift.astype(np.uint64)) + content)
    _, leader, group, copies = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
    repeated = leader[group] != np.arange(len(key)) if rule.first_stays else copies[group] > 1
    before = np.concatenate([[False], repeated[:-1]]) & (inside > 0)
    after = np.concatenate([repeated[1:], [False]]) & np.concatenate([inside[1:] > 0, [False]])
    opens, closes = np.flatnonzero(repeated & ~before), np.flatnonzero(repeated & ~after)
    start = at[row] - shift
    if len(opens):
        yield _run_rows(rows["id"], row[opens], start[opens], start[closes])
    if len(cut):
        lead = leader[np.isin(hashes[leader], cut)]
        if len(lead):
            yield _run_rows(rows["id"], row[lead], start[lead], start[lead], hashes[lead], shift[lead], content[lead])


def _run_rows(ids: pa.ChunkedArray, row, low, high, hashes=None, shift=None, content=None) -> pa.RecordBatch:
    taken = ids.take(pa.array(row)).combine_chunks()
    n = len(row)
    nothing = {"hash": pa.nulls(n, pa.int64()), "shift": pa.nulls(n, pa.int32()), "content": pa.nulls(n, pa.int64())}
    known = nothing if hashes is None else {
        "hash": pa.array(hashes, pa.int64()), "shift": pa.array(shift.astype(np.int32)), "content": pa.array(content.view(np.int64))}
    return pa.RecordBatch.from_pydict({"id": taken, "low": pa.array(low.astype(np.int32)), "high": pa.array(high.astype(np.int32))} | known)


def repeated_runs(docs: DataFrame, packed: DataFrame, rule: Rule, group_rows: int = GROUP_ROWS) -> DataFrame:
    """id, low, high: runs of starts of repeated windows, of all documents."""
    shared = stage(anchors(docs, rule), "anchors")
    settled = shared.filter("settled").select("id", F.greatest(F.col("at") - rule.reach, F.lit(0)).alias("low"), F.col("at").alias("high"))
    opened = shared.filter("open")
    return settled.unionByName(extend(surroundings(packed, opened, rule), opened, rule, group_rows, min(group_rows, DEALT_ROWS)))


def remove(docs: DataFrame, rule: Rule, id_col: str, text: str, group_rows: int = GROUP_ROWS, bodies: bool = True) -> DataFrame:
    """Per document: id, n_units, n_removed, n_spans, kept_sha256, spans (runs of removed units, end exclusive) and, if
    ``bodies``, kept (what is left, as bytes)."""
    given = each_row(docs, id_col, F.coalesce(F.col(f"`{text}`"), F.lit("")), "body")
    rows = given.rows
    packed = pack(rows)
    runs = stage(repeated_runs(rows, packed, rule, group_rows).groupBy("id").agg(
        F.sort_array(F.collect_list(F.struct("low", "high"))).alias("runs")), "runs")
    id_type = rows.schema["id"].dataType.simpleString()
    out_type = (f"id {id_type}, n_units long, n_removed long, n_spans long, kept_sha256 string, "
                "spans array<struct<start: int, end: int>>" + ", kept binary" * bodies)
    span_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opener = zstandard.ZstdDecompressor()
        for batch in batches:
            for start in range(0, len(batch), 512):
                part = batch.slice(start, 512)
                out: dict[str, list] = {k: [] for k in ("n_units", "n_removed", "n_spans", "kept_sha256", "spans", "kept")}
                for packed_body, own in zip(part["packed"], part["runs"], strict=True):
                    body = opener.decompress(packed_body.as_py())
                    n = len(rule.units(body))
                    edges = np.zeros(n + 1, np.int64)
                    if own.is_valid:
                        fields = own.values.flatten()
                        np.add.at(edges, fields[0].to_numpy(), 1)
                        np.add.at(edges, fields[1].to_numpy() + rule.window, -1)
                    covered = np.cumsum(edges[:n]) > 0
                    change = np.flatnonzero(np.diff(np.concatenate([[False], covered, [False]]).astype(np.int8)))
                    kept = rule.cut(body, covered)
                    for name, value in (("n_units", n), ("n_removed", int(covered.sum())), ("n_spans", len(change) // 2),
                                        ("kept_sha256", hashlib.sha256(kept).hexdigest()),
                                        ("spans", [{"start": a, "end": b} for a, b in change.reshape(-1, 2).tolist()]), ("kept", kept)):
                        out[name].append(value)
                columns = {"id": part["id"], "n_units": pa.array(out["n_units"], pa.int64()), "n_removed": pa.array(out["n_removed"], pa.int64()),
                           "n_spans": pa.array(out["n_spans"], pa.int64()), "kept_sha256": pa.array(out["kept_sha256"], pa.string()),
                           "spans": pa.array(out["spans"], span_type)}
                yield pa.RecordBatch.from_pydict(columns | ({"kept": pa.array(out["kept"], pa.binary())} if bodies else {}))

    return given.named(packed.join(runs, "id", "left").select("id", "packed", "runs").mapInArrow(cut, out_type), "id")
