"""MinHash near-duplicates by a multi-index Hamming join.

A document is the set of its distinct shingles of ``SHINGLE`` words. Its signature is ``SYMBOLS`` minima, of which
``BITS`` bits each are kept. The signature is split into chunks; by the pigeonhole principle two signatures that differ
in at most ``REACH`` symbols agree in one of the exact chunks, or in all symbols but one of a chunk that allows an
error. Each chunk is a key, an erring chunk one key for each symbol left out, so every pair within ``REACH`` shares a key.
Most pairs beyond ``REACH`` share one too: a pair of similarity 0.85 shares none with a probability of about 1e-9, one of 0.8
with 1e-7. Pairs that share a key are confirmed on their full sets; the signature alone links nothing.

Hot groups: documents of equal sets are one class, found by an aggregation. The documents of a key are first compared
with the smallest of them and with the smallest of their part of the key only. What hangs together then needs no more links; in a second round
pairs of different components that share a key are compared, so a group of very many copies of one another is never
expanded into its pairs. That round makes a pair once, at the first key that the two share, and only if a signature of
``LONG`` bits leaves the threshold possible: a pair at the threshold is further apart with a probability below 1e-6.

Defined cases: null and empty texts have the empty set and are linked with nothing; a text of fewer words is one shingle,
all its words; every row is a document and gives a row; rows without an id come after all others, so their component has an id
if any of it has, and else null; an empty table gives an empty result; other columns are ignored. Texts are read whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import anchors as anchor
from .links import components
from .repeats import pack
from .shared import BATCH_BYTES, each_row, keyed, ship, stage, text_digest, without

SHINGLE = 5
BITS = 16
CHUNK = 4
EXACT, ERRING = 4, 8  # chunks without and with one error
SYMBOLS = CHUNK * (EXACT + ERRING)
REACH = EXACT + 2 * ERRING - 1
LONG = 2048  # one-bit minima that tell pairs apart before their sets are compared
ROWS = 256  # documents that a task holds at a time
PARTS = 16  # parts of a key's documents, each with a second document to compare with
_SEEDS = anchor.mix(np.arange(1, 2 * (SYMBOLS + LONG) + 1, dtype=np.uint64))
_FACTORS, _SHIFTS = _SEEDS[::2] | np.uint64(1), _SEEDS[1::2]


def shingles(body: bytes) -> np.ndarray:
    """Sorted hashes of the distinct shingles of a text; A-Z count as a-z."""
    raw = np.frombuffer(body.lower(), np.uint8) if body else np.zeros(0, np.uint8)  # bytes.lower() changes A-Z only
    start, end = anchor.word_bounds(raw)
    if not len(start):
        return np.zeros(0, np.uint64)
    words = anchor.stretch(anchor.sums(raw.astype(np.uint64)), start, end)
    return np.unique(anchor.stretches(anchor.sums(words), min(SHINGLE, len(words))))


def _minima(shingle_set: np.ndarray, orders: slice, block: int) -> np.ndarray:
    """Minima of the set under multiplicative orders, mixed."""
    factors, shifts = _FACTORS[orders], _SHIFTS[orders]
    least = np.full(len(factors), 2**64 - 1, np.uint64)
    for start in range(0, len(shingle_set), block):
        part = shingle_set[start:start + block, None] * factors
        part += shifts
        np.minimum(least, part.min(axis=0), out=least)
    return anchor.mix(least)


def signature(shingle_set: np.ndarray) -> np.ndarray:
    """``SYMBOLS`` minima of the set, ``BITS`` bits of each."""
    return _minima(shingle_set, slice(0, SYMBOLS), 1024) & np.uint64((1 << BITS) - 1)


def long_signature(shingle_set: np.ndarray) -> np.ndarray:
    """``LONG`` further minima, one bit of each, packed into 64-bit numbers."""
    bits = _minima(shingle_set, slice(SYMBOLS, SYMBOLS + LONG), 64) & np.uint64(1)
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def most_apart(percent: int) -> int:
    """Bits in which long signatures of sets at the threshold differ at most: mean and five standard deviations."""
    share = (1 - percent / 100) / 2
    return math.ceil(LONG * share + 5 * math.sqrt(LONG * share * (1 - share)))


def _fold(symbols: np.ndarray, place: int) -> np.ndarray:
    """One number for a row of symbols at a place of the signature."""
    packed = np.zeros(len(symbols), np.uint64)
    for column in symbols.T:
        packed = (packed << np.uint64(BITS)) | column
    return anchor.mix(packed ^ anchor.mix(np.full(len(symbols), place + 1, np.uint64)))


def chunk_keys(signatures: np.ndarray) -> np.ndarray:
    """The keys of each signature (rows): exact chunks, then erring chunks with each symbol left out in turn."""
    chunks = signatures.reshape(len(signatures), EXACT + ERRING, CHUNK)
    keys = [_fold(chunks[:, c], c) for c in range(EXACT)]
    for c in range(EXACT, EXACT + ERRING):
        for gap in range(CHUNK):
            keys.append(_fold(np.delete(chunks[:, c], gap, axis=1), c * CHUNK + gap + EXACT))
    return np.stack(keys, axis=1)


def sketches(packed: DataFrame) -> DataFrame:
    """id, n (size of the set), one, two (a 128-bit fingerprint of the set), keys."""
    ship(packed.sparkSession)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(start, ROWS) for whole in batches for start in range(0, len(whole), ROWS)):
            sets = [shingles(body.as_py()) for body in batch["body"]]
            prints = np.array([[s.sum(dtype=np.uint64), np.bitwise_xor.reduce(anchor.mix(s + np.uint64(7)))] if len(s) else [0, 0] for s in sets],
                              np.uint64).reshape(-1, 2).view(np.int64)
            keys = chunk_keys(np.array([signature(s) for s in sets], np.uint64).reshape(-1, SYMBOLS)).view(np.int64)
            yield pa.RecordBatch.from_pydict({
                "id": batch["id"], "n": pa.array([len(s) for s in sets], pa.int64()), "one": pa.array(prints[:, 0]), "two": pa.array(prints[:, 1]),
                "keys": pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1, dtype=np.int32) * keys.shape[1]), pa.array(keys.ravel()))})

    id_type = packed.schema["id"].dataType.simpleString()
    body = packed.select("id", F.encode(F.coalesce("body", F.lit("")), "UTF-8").alias("body"))
    return body.mapInArrow(sketch, f"id {id_type}, n long, one long, two long, keys array<long>")


def full_sets(packed: DataFrame, ids: DataFrame) -> DataFrame:
    """id, shingles (the packed full set) and bits (the long signature) of the documents in ``ids``."""
    ship(packed.sparkSession)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opener = zstandard.ZstdDecompressor()
        for part in (whole.slice(start, ROWS) for whole in batches for start in range(0, len(whole), ROWS)):
            found = [shingles(opener.decompress(b.as_py())) for b in part["packed"]]
            yield pa.RecordBatch.from_pydict({
                "id": part["id"], "shingles": pa.array([x.tobytes() for x in found], pa.binary()),
                "bits": pa.array([long_signature(x) for x in found], pa.list_(pa.int64()))})

    id_type = packed.schema["id"].dataType.simpleString()
    return packed.join(ids, "id", "left_semi").mapInArrow(sets, f"id {id_type}, shingles binary, bits array<long>")


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b) whose sets have 100 * common >= percent * united."""
    ship(pairs.sparkSession)
    id_type = pairs.schema["a"].dataType.simpleString()

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(start, ROWS) for whole in batches for start in range(0, len(whole), ROWS)):
            same = []
            for left, right in zip(batch["left"], batch["right"], strict=True):
                x, y = np.frombuffer(left.as_py(), np.uint64), np.frombuffer(right.as_py(), np.uint64)
                common = len(x) + len(y) - len(np.union1d(x, y))
                same.append(100 * common >= percent * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([batch["a"], batch["b"]], ["a", "b"]).filter(pa.array(same, pa.bool_()))

    sided = pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("left")), "a").join(
        sets.select(F.col("id").alias("b"), F.col("shingles").alias("right")), "b")
    return sided.select("a", "b", "left", "right").mapInArrow(check, f"a {id_type}, b {id_type}")


def near_copies(docs: DataFrame, id_col: str = "doc_id", text: str = "text", percent: int = 85) -> DataFrame:
    """One row per document: id, n_shingles, component_id (the smallest id that its links reach, itself included)."""
    given = each_row(docs, id_col, F.coalesce(F.col(f"`{text}`"), F.lit("")), "body")
    rows = given.rows
    sketched = stage(sketches(rows), "sketches", BATCH_BYTES)
    classes = stage(sketched.filter("n > 0").groupBy("one", "two", "n").agg(F.min("id").alias("rep"), F.first("keys").alias("keys")), "classes")
    # Documents that share a key, found by counts that combine before they are shuffled.
    keyed = classes.select("rep", "n", F.posexplode("keys").alias("place", "key"))
    shared = keyed.groupBy("key").agg(F.min("rep").alias("leader"), F.count("*").alias("documents")).filter("documents > 1")
    members = stage(keyed.join(shared.select("key", "leader"), "key").withColumn("part", F.pmod(F.xxhash64("rep"), F.lit(PARTS))), "members")
    seconds = members.groupBy("key", "part").agg(F.min("rep").alias("second"))
    sets = stage(full_sets(pack(rows), members.select(F.col("rep").alias("id")).distinct()), "sets", BATCH_BYTES)
    first_pairs = stage(
        members.join(seconds, ["key", "part"])
        .select(F.explode(F.array_distinct(F.array("leader", "second"))).alias("a"), F.col("rep").alias("b"))
        .filter("a != b").distinct(), "pairs")
    first_links = stage(confirm(first_pairs, sets, percent), "links", BATCH_BYTES)
    # Keys whose documents are not all in one component, with what tells two documents apart.
    labelled = stage(
        members.select("key", "place", "rep", "n").join(components(first_links).withColumnRenamed("node", "rep"), "rep", "left")
        .withColumn("component", F.coalesce("component", "rep")), "labelled")
    mixed = labelled.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low != high")
    apart = labelled.join(mixed.select("key"), "key")
    joined = stage(apart.join(classes.select("rep", "keys"), "rep").join(
        sets.select(F.col("id").alias("rep"), "bits"), "rep"), "apart")
    left, right = (joined.select("key", *[F.col(c).alias(f"{side}_{c}") for c in ("place", "rep", "n", "component", "keys", "bits")])
                   for side in ("left", "right"))
    differing = " + ".join(f"bit_count(left_bits[{i}] ^ right_bits[{i}])" for i in range(LONG // 64))
    second_pairs = (
        left.join(right, "key")
        .filter((F.col("left_rep") < F.col("right_rep")) & (F.col("left_component") != F.col("right_component"))
                & (F.least("left_n", "right_n") * 100 >= F.greatest("left_n", "right_n") * percent)
                & F.expr(f"{differing} <= {most_apart(percent)}")
                & F.expr("NOT exists(zip_with(slice(left_keys, 1, left_place), slice(right_keys, 1, left_place), (x, y) -> x = y), z -> z)"))
        .select(F.col("left_rep").alias("a"), F.col("right_rep").alias("b")).distinct()
        .join(first_pairs, ["a", "b"], "left_anti")
    )
    links = first_links.unionByName(stage(confirm(second_pairs, sets, percent), "links", BATCH_BYTES))
    labels = components(links).withColumnRenamed("node", "rep")
    owners = classes.select("one", "two", "n", "rep").join(labels, "rep", "left").select(
        "one", "two", "n", F.coalesce("component", "rep").alias("component"))
    found = sketched.select("id", "one", "two", "n").join(owners, ["one", "two", "n"], "left").select(
        "id", F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"))
    return given.named(found, "id", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text", percent: int = 85, by_row: bool = False) -> DataFrame:
    """The documents without those that a smaller id is linked with, directly or not; with their own columns.

    ``by_row``: rows that share an id, or have none, are documents of their own if their texts differ (in the order of ids and
    digests, null last), and of rows with the same id and text one stays. Otherwise all rows of an id stay or go together and
    rows without an id stay.
    """
    keys = keyed(docs, id_col, text) if by_row else None
    if keys is None:
        gone = near_copies(docs, id_col, text, percent).filter("id != component_id").select(F.col("id").alias("gone_id"))
        return docs.join(gone, docs[f"`{id_col}`"] == gone["gone_id"], "left_anti")
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("body"), text_digest(text).alias("digest"))
    numbered = rows.join(keys, rows["id"].eqNullSafe(keys["id"]) & (rows["digest"] == keys["digest"])).select("key", "body")
    found = near_copies(numbered, "key", "body", percent).select(F.col("id").alias("key"), (F.col("id") == F.col("component_id")).alias("kept"))
    moved = stage(keys.join(found, "key").filter("NOT kept OR rows > 1").select("id", "digest", "kept"), "moved")
    return without(docs, moved, F.col(id_col), text_digest(text))
