"""Exact deduplication through an extendible-hash index on shared files.

Texts are equal when they are identical after every run of ASCII white space is one space. The index maps the 64-bit
hash of a normalised text to its entries. A directory of hash prefixes says which bucket owns a key range; it starts at
``FIRST_DEPTH`` bits, and a bucket of more than ``BUCKET_BYTES`` of texts or ``BUCKET_ROWS`` rows is split by the next bit of the
hash, which doubles the directory when its depth is reached. Each bucket is read, in the order of its hashes, and written by the one
task that owns its range. The owner lets different texts of one hash follow each other in a chain and decides by comparing bytes
whether a text is in the chain; neither a hash nor a digest decides.

Hot texts: a scan task keeps the texts it has met (up to ``HELD_BYTES`` of them) and writes each once, with its least id and
its count, so a text that a third of all rows carry comes to its owner as about one row per task. Documents are remembered by the
number of that row, and join the owner's answers by it; no such number is hot beyond its task. Owners read one hash at a time, so
memory is bounded by a chain, not by a bucket. Every step is a table in the shared folder; a lost executor repeats its task.

Defined cases: null is the empty text; an id that is null never stays when the group has another one; rows that
repeat an id and its text get the same result; an empty table gives an empty index; other columns are ignored. Ids are numbers, texts or dates.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from typing import Any, NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .shared import BATCH_BYTES, SPACE, ship, stage, without

FIRST_DEPTH = 0
BUCKET_BYTES = 16 << 20
BUCKET_ROWS = 500_000
HELD_BYTES = 32 << 20
ANSWER_ROWS = 20_000
ENTRY = ["hash", "chain", "text_sha256", "keep_id", "group_size"]


class Index(NamedTuple):
    """``entries``: one row per distinct text with the bucket that holds it; ``directory``: slot, bucket, depth for
    every slot of ``depth`` leading bits; ``members``: the entry of every indexed row, by its id."""

    entries: DataFrame
    directory: DataFrame
    depth: int
    members: DataFrame


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def _leading(hash_column: Column, depth: int) -> Column:
    """The ``depth`` leading bits of a 64-bit hash."""
    return F.shiftrightunsigned(hash_column, 64 - depth) if depth else F.lit(0).cast("bigint")


def build(docs: DataFrame, id_col: str = "doc_id", text: str = "text", bucket_rows: int = BUCKET_ROWS, bucket_bytes: int = BUCKET_BYTES,
          depth: int = FIRST_DEPTH) -> Index:
    """Index all rows. ``depth``: bits of the first directory."""
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType
    gathered = _gather(docs.select(F.col(id_col).alias("id"), normalised(F.col(text)).alias("body")), kind)
    texts = gathered.filter("body IS NOT NULL").select("key", "hash", "body", "keep_id", "rows")
    directory, depth = _directory(texts, bucket_rows, bucket_bytes, depth)
    owned = texts.withColumn("slot", _leading(F.col("hash"), depth)).join(directory, "slot")
    answers = stage(_owners(owned.drop("slot"), kind), "index", BATCH_BYTES)
    members = gathered.filter("body IS NULL").select("id", "key").join(answers, "key").drop("key", "first")
    return Index(answers.filter("first").select("bucket", "depth", *ENTRY), directory, depth, members)


def _gather(rows: DataFrame, kind: T.DataType) -> DataFrame:
    """Two kinds of rows. With ``body``: a text as one task has met it, under a key of its own, with its least id and the number of
    its rows. Without: the id of a row and the key of its text."""
    schema = T.StructType().add("key", "long").add("id", kind).add("hash", "long").add("body", "binary").add("keep_id", kind).add("rows", "long")
    arrow = to_arrow_schema(schema)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = TaskContext.get().partitionId() << 40
        held: dict[bytes, list[Any]] = {}
        size = 0

        def flushed() -> Iterator[pa.RecordBatch]:
            return _text_batches(((k, None, h, body, least, n) for body, (k, h, least, n) in held.items()), arrow)

        for batch in batches:
            keys = []
            for i, h, body in zip(*(batch[c].to_pylist() for c in ("id", "hash", "body"))):
                entry = held.get(body)
                if entry is None:
                    if size > HELD_BYTES:
                        yield from flushed()
                        held.clear()
                        size = 0
                    entry = held[body] = [key, h, i, 0]
                    key += 1
                    size += len(body) + 200
                entry[2] = _least(entry[2], i)
                entry[3] += 1
                keys.append(entry[0])
            nothing = [pa.nulls(len(keys), f.type) for f in arrow]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), batch["id"].cast(arrow.field("id").type), *nothing[2:]], schema=arrow)
        yield from flushed()

    hashed = rows.select("id", F.xxhash64("body").alias("hash"), F.col("body").cast("binary").alias("body"))
    return stage(hashed.mapInArrow(gather, schema), "texts", BATCH_BYTES)


def _text_batches(rows: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The rows in batches of about ``BATCH_BYTES`` of texts, so that what a task holds is never copied whole."""
    at, some, size = schema.get_field_index("body"), [], 0

    def packed() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some), schema)], schema=schema)

    for row in rows:
        some.append(row)
        size += len(row[at]) + 200
        if size >= BATCH_BYTES:
            yield packed()
            some, size = [], 0
    if some:
        yield packed()


def _least(a: Any, b: Any) -> Any:
    """The smaller id; one that is null counts as the greatest."""
    if a is None or b is None:
        return b if a is None else a
    return min(a, b)


def _directory(texts: DataFrame, bucket_rows: int, bucket_bytes: int, depth: int) -> tuple[DataFrame, int]:
    """slot, bucket, depth for every slot of the depth that is reached, by splitting overfull buckets bit by bit. Only sizes are read."""
    hashes = stage(texts.groupBy("hash").agg(F.count("*").alias("rows"), F.sum(F.octet_length("body")).alias("bytes")), "hashes")
    level, owners = hashes, None
    while True:
        sizes = level.groupBy(_leading(F.col("hash"), depth).alias("bucket")).agg(
            F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"), F.min("hash").alias("low"), F.max("hash").alias("high"))
        # A chain of one hash cannot be split; its bucket may be overfull.
        over = ((F.col("rows") > bucket_rows) | (F.col("bytes") > bucket_bytes)) & (F.col("low") != F.col("high")) & F.lit(depth < 63)
        sizes = stage(sizes.select("bucket", over.alias("over")), "sizes")
        settled = sizes.filter("NOT over").select("bucket", F.lit(depth).alias("depth"))
        owners = settled if owners is None else owners.unionByName(settled)
        full = sizes.filter("over").select("bucket")
        if full.isEmpty():
            break
        # A half that got no hash is a bucket too, an empty one.
        halves = full.select(F.explode(F.array(F.col("bucket") * 2, F.col("bucket") * 2 + 1)).alias("bucket"))
        filled = hashes.select(_leading(F.col("hash"), depth + 1).alias("bucket")).distinct()
        owners = owners.unionByName(halves.join(filled, "bucket", "left_anti").select("bucket", F.lit(depth + 1).alias("depth")))
        level = hashes.withColumn("bucket", _leading(F.col("hash"), depth)).join(full, "bucket", "left_semi") if depth else hashes
        depth += 1
    width = F.expr(f"shiftleft(1L, {depth} - depth)")
    slots = owners.withColumn("slot", F.explode(F.sequence(F.col("bucket") * width, (F.col("bucket") + 1) * width - 1)))
    return stage(slots.select("slot", "bucket", "depth"), "directory"), depth


def _owners(texts: DataFrame, kind: T.DataType) -> DataFrame:
    """For every given row of a text its entry, found by the task that owns the bucket; ``first`` marks one row per entry."""
    schema = (T.StructType().add("key", "long").add("bucket", "long").add("depth", "integer").add("hash", "long").add("chain", "integer")
              .add("text_sha256", "string").add("keep_id", kind).add("group_size", "long").add("first", "boolean"))
    arrow = to_arrow_schema(schema)

    def settled(place: tuple, chain: list[list[Any]]) -> Iterator[tuple]:
        named = [(least, hashlib.sha256(body).hexdigest(), n, keys) for body, least, n, keys in chain]
        by_digest = sorted(named, key=lambda e: e[1])
        ordered = sorted((e for e in by_digest if e[0] is not None), key=lambda e: e[0]) + [e for e in by_digest if e[0] is None]
        for number, (least, digest, n, keys) in enumerate(ordered, 1):
            for at, key in enumerate(keys):
                yield key, *place, number, digest, least, n, at == 0

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place: tuple | None = None
        chain: list[list[Any]] = []  # body, least id, rows, keys of each text of one hash
        answers: list[tuple] = []

        def packed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*answers), arrow)], schema=arrow)

        for batch in batches:
            for bucket, depth, h, key, body, least, n in zip(*(
                    batch[c].to_pylist() for c in ("bucket", "depth", "hash", "key", "body", "keep_id", "rows"))):
                if place != (bucket, depth, h):
                    answers += settled(place, chain) if place else ()
                    place, chain = (bucket, depth, h), []
                    if len(answers) >= ANSWER_ROWS:
                        yield packed()
                        answers.clear()
                for entry in chain:
                    if entry[0] == body:
                        entry[1], entry[2] = _least(entry[1], least), entry[2] + n
                        entry[3].append(key)
                        break
                else:
                    chain.append([body, least, n, [key]])
        answers += settled(place, chain) if place else ()
        if answers:
            yield packed()

    return texts.repartition("bucket", "depth").sortWithinPartitions("bucket", "depth", "hash", "key").mapInArrow(own, schema)


def lookup(docs: DataFrame, index: Index, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document whose text is in an index made before: its id, the entry, and whether it is the row that stays.

    The directory gives the bucket of a document's hash; hash and digest select the entry of its chain, as the texts are not kept.
    """
    body = normalised(F.col(text))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(body).alias("hash"), F.sha2(body, 256).alias("text_sha256"))
    owned = rows.withColumn("slot", _leading(F.col("hash"), index.depth)).join(index.directory, "slot")
    return owned.join(index.entries, ["bucket", "depth", "hash", "text_sha256"]).select(
        "id", "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256", "bucket", "chain")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text: str = "text", unnamed: bool = True, **options) -> DataFrame:
    """The rows that stay, with their own columns: of equal texts one row of the smallest id. ``unnamed``: rows without an id
    stay too; otherwise one of them stays where no row of the text has an id."""
    found = deduplicate(docs, id_col, text, **options).filter("group_size > 1" if not unnamed else "group_size > 1 AND id IS NOT NULL")
    moved = found.groupBy("id", F.col("text_sha256").alias("digest")).agg(F.first("kept").alias("kept"), F.count("*").alias("rows"))
    return without(docs, stage(moved.filter("NOT kept OR rows > 1"), "moved"), F.col(id_col), F.sha2(normalised(F.col(text)), 256))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per document: its id, the entry that its owner found by bytes, and whether it is the row that stays."""
    members = build(docs, id_col, text, **options).members
    return members.select("id", "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256", "bucket", "chain")
