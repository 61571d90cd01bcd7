"""A sparse document-term matrix: one dictionary for the whole corpus, rows in compressed shards.

Documents are read once. A task packs its documents into shards of about ``SHARD_BYTES`` of text (one document at
least): offsets of the rows, numbers of the words, counts. A shard sends each of its words once, however often they stand in
it, so a word that is everywhere costs one entry a shard. The dictionary is cut into parts by ranges of crc32, as many as
keep a part in ``PART_WORDS`` entries on average; a shard numbers its words in the order of crc32, so that what it sends to a part is one
run of them and travels as one packed row. The part's task goes through these rows one after the other, gives every word
that it has not met the next place, and sends the places back. A word's term is its part and its place; words are compared by
their bytes, crc32 only deals them out. The places are written once, so a lost executor cannot number words anew.

Words are maximal runs of bytes other than ASCII white space.

Defined cases: null and empty texts are rows without words; an empty table gives no shards and an empty dictionary;
repeated rows are rows of their own; ``payload`` columns travel with the documents whatever their names are.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import ship, stage

SHARD_BYTES = 16 << 20
PART_WORDS = 250_000
LEAST_PARTS = 64
PLACE_BITS = 40  # of a term; what is above them is the part

CSR = T.StructType([T.StructField(name, T.BinaryType()) for name in ("offsets", "terms", "counts")])


class Matrix(NamedTuple):
    """``shards``: offsets (int64), terms (int64) and counts (int32) as bytes, and ``docs``, the payload of each row in
    order. ``dictionary``: word (its bytes) and term."""

    shards: DataFrame
    dictionary: DataFrame


def rows_of(offsets: bytes, terms: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Per row of a shard: the sum of its counts and how many terms are not zero."""
    ends, per_term = np.frombuffer(offsets, np.int64), np.frombuffer(counts, np.int32)
    if len(np.frombuffer(terms, np.int64)) != ends[-1]:
        raise ValueError("the offsets of a shard do not fit its terms")
    sums = np.concatenate([[0], np.cumsum(per_term, dtype=np.int64)])
    return sums[ends[1:]] - sums[ends[:-1]], np.diff(ends)


def _pack(data: bytes) -> bytes:
    return zstandard.compress(data, 1)


def _unpack(data: pa.Scalar) -> bytes:
    return zstandard.decompress(data.as_py())


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(crc32, words), np.uint32, len(words))


class _Shard:
    """Documents of one task until there are enough."""

    def __init__(self):
        self.numbers: dict[bytes, int] = {}
        self.terms: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.sizes: list[int] = []
        self.docs: list[dict] = []
        self.bytes = 0

    def add(self, body: bytes, payload: dict) -> None:
        numbers, found = self.numbers, Counter(body.split())
        self.terms.append(np.array([numbers.setdefault(w, len(numbers)) for w in found], np.int32))
        self.counts.append(np.array(list(found.values()), np.int32))
        self.sizes.append(len(found))
        self.docs.append(payload)
        self.bytes += len(body)

    def packed(self, schema: pa.Schema, task: int, number: int) -> pa.RecordBatch:
        """Words in the order of crc32, numbered so; the terms of a row ascend and are written as differences."""
        words = list(self.numbers)
        order = np.argsort(_hashes(words), kind="stable")
        place = np.empty(len(words), np.int64)
        place[order] = np.arange(len(words))
        row = np.repeat(np.arange(len(self.sizes), dtype=np.int64) << 32, self.sizes)
        key = row | place[np.concatenate(self.terms)]
        ascending = np.argsort(key)
        terms = (key[ascending] & 0xFFFFFFFF).astype(np.int32)
        made = {
            "shard": task << 32 | number, "n_words": len(words), "words": _pack(b" ".join([words[i] for i in order])),
            "offsets": np.cumsum([0, *self.sizes], dtype=np.int64).tobytes(), "terms": _pack(np.diff(terms, prepend=np.int32(0)).tobytes()),
            "counts": _pack(np.concatenate(self.counts)[ascending].tobytes()), "docs": self.docs}
        return pa.RecordBatch.from_pylist([made], schema)


def document_terms(docs: DataFrame, payload: dict[str, Column], text: str = "text", describe: Callable[[bytes], dict] | None = None,
                   described: T.StructType | None = None) -> Matrix:
    """The matrix of ``text``. ``payload``: what is kept of each document besides its row; ``describe`` adds fields to it that
    are made of the whole text in the same reading, of the types ``described``."""
    ship(docs.sparkSession)
    # The documents' own columns stay apart from those of this module.
    rows = docs.select(F.coalesce(F.col(f"`{text}`").cast("binary"), F.lit(b"")).alias("body"),
                       F.struct(*[c.alias(name) for name, c in payload.items()]).alias("payload"))
    fields = [*rows.schema["payload"].dataType.fields, *(described.fields if described else [])]
    schema = T.StructType([T.StructField("shard", T.LongType()), T.StructField("n_words", T.LongType()), T.StructField("words", T.BinaryType()),
                           *CSR.fields, T.StructField("docs", T.ArrayType(T.StructType(fields)))])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema

        task, number, packed = TaskContext.get().partitionId(), 0, to_arrow_schema(schema)
        shard = _Shard()
        for batch in batches:
            for body, kept in zip(batch["body"], batch["payload"], strict=True):
                body = body.as_py()
                shard.add(body, kept.as_py() | (describe(body) if describe else {}))
                if shard.bytes >= SHARD_BYTES:
                    yield shard.packed(packed, task, number)
                    shard, number = _Shard(), number + 1
        if shard.docs:
            yield shard.packed(packed, task, number)

    local = stage(rows.mapInArrow(read, schema), "shards")
    places = stage(_places(local), "places")
    return Matrix(_renumbered(local, places), _dictionary(places))


def _places(local: DataFrame) -> DataFrame:
    """part, shard, places (of the run of words that the shard sends to the part), and first and new: the words met in it for the
    first time, with the place of the first of them."""
    total = local.agg(F.sum("n_words").alias("n")).first()["n"] or 0
    parts = max(LEAST_PARTS, math.ceil(total / PART_WORDS))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, packed in zip(batch["shard"].to_pylist(), batch["words"], strict=True):
                words = _unpack(packed).split()
                part = (_hashes(words).astype(np.uint64) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
                starts = np.nonzero(np.diff(part, prepend=-1))[0].tolist()
                runs = [_pack(b" ".join(words[a:b])) for a, b in zip(starts, [*starts[1:], len(words)], strict=True)]
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array(part[starts], pa.int64()), "shard": pa.array([shard] * len(runs), pa.int64()), "words": pa.array(runs, pa.binary())})

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: dict[bytes, int] = {}
        current = None
        for batch in batches:
            places, firsts, new = [], [], []
            for part, packed in zip(batch["part"].to_pylist(), batch["words"], strict=True):
                if part != current:
                    met, current = {}, part
                words, first = _unpack(packed).split(), len(met)
                found = np.array([met.setdefault(w, len(met)) for w in words], np.int64)
                places.append(_pack(found.tobytes()))
                firsts.append(first)
                new.append(_pack(b" ".join([words[i] for i in np.nonzero(found >= first)[0]])))
            yield pa.RecordBatch.from_pydict({
                "part": batch["part"], "shard": batch["shard"], "places": pa.array(places, pa.binary()),
                "first": pa.array(firsts, pa.int64()), "new": pa.array(new, pa.binary())})

    runs = local.select("shard", "words").mapInArrow(deal, "part long, shard long, words binary")
    return runs.repartition("part").sortWithinPartitions("part", "shard").mapInArrow(
        place, "part long, shard long, places binary, first long, new binary")


def _dictionary(places: DataFrame) -> DataFrame:
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, first, packed in zip(batch["part"].to_pylist(), batch["first"].to_pylist(), batch["new"], strict=True):
                words = _unpack(packed).split()
                start = (part << PLACE_BITS) + first
                yield pa.RecordBatch.from_pydict({"word": pa.array(words, pa.binary()), "term": pa.array(np.arange(start, start + len(words)))})

    return places.select("part", "first", "new").mapInArrow(unpack, "word binary, term long")


def _renumbered(local: DataFrame, places: DataFrame) -> DataFrame:
    """Shards whose terms are those of the dictionary. A shard's runs are in the order of its words, part after part."""
    runs = places.groupBy("shard").agg(F.sort_array(F.collect_list(F.struct("part", "places"))).alias("runs"))
    joined = local.drop("words", "n_words").join(runs, "shard", "left")

    def renumber(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms, counts = [], []
            for old, count, own in zip(batch["terms"], batch["counts"], batch["runs"], strict=True):
                new = [np.frombuffer(zstandard.decompress(run["places"]), np.int64) + (run["part"] << PLACE_BITS) for run in own.as_py() or []]
                local_terms = np.cumsum(np.frombuffer(_unpack(old), np.int32), dtype=np.int32)
                terms.append(np.concatenate([np.zeros(0, np.int64), *new])[local_terms].tobytes())
                counts.append(_unpack(count))
            yield pa.RecordBatch.from_arrays([batch["offsets"], pa.array(terms, pa.binary()), pa.array(counts, pa.binary()), batch["docs"]],
                                             ["offsets", "terms", "counts", "docs"])

    return joined.select("offsets", "terms", "counts", "docs", "runs").mapInArrow(
        renumber, T.StructType([*CSR.fields, joined.schema["docs"]]))
