"""How five document filters act together, in every order they can be applied.

A document fails A with fewer than ``least_words`` words, B when fewer than half of its words are different ones, C when more than
three of a hundred code points are among A-Z, D when it holds one of ``#$%&*|``, E when its text stands in a row of a smaller id.

A and B are read off a sparse document-term matrix (``terms``): the sum of a row is its number of words, its nonzero
entries are the different ones. C, D and a digest of the text for E come from the same reading. After that a document
is a set of failed filters, and everything the report says of the 120 orders follows from how many documents of each part
have each of the 32 sets; so only those counts meet the orders.

Defined cases: null text is empty (it fails A, and E beside another empty one); null ``part`` is the empty string; a null id is greater than all others
and equal ids are not smaller than each other; repeated rows count each; several labels of an id count as one with the
greatest values, and labels without an id are nobody's; an empty table gives an empty report; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import stage
from .terms import document_terms, rows_of

FILTERS = "ABCDE"
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
MARKS = b"#$%&*|"
_READ = T.StructType([T.StructField("digest", T.BinaryType()), T.StructField("c", T.BooleanType()), T.StructField("d", T.BooleanType())])


def _describe(body: bytes) -> dict:
    capitals = len(body) - len(body.translate(None, CAPITALS))
    points = len(body.decode("utf-8", "replace"))
    return {"digest": hashlib.sha256(body).digest(), "c": 100 * capitals > 3 * points, "d": len(body.translate(None, MARKS)) < len(body)}


def failed_filters(docs: DataFrame, id_col: str = "doc_id", text: str = "text", part: str = "lang", least_words: int = 200) -> DataFrame:
    """One row per document: id, part, n_words, n_distinct, and a to e, whether it fails the filter."""
    matrix = document_terms(docs, {"id": F.col(f"`{id_col}`"), "part": F.coalesce(F.col(f"`{part}`").cast("string"), F.lit(""))},
                            text, _describe, _READ)
    kept = matrix.shards.schema["docs"].dataType.elementType
    schema = T.StructType([*kept.fields, T.StructField("n_words", T.LongType()), T.StructField("n_distinct", T.LongType())])

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for offsets, terms, counts, rows in zip(*(batch[c] for c in ("offsets", "terms", "counts", "docs")), strict=True):
                words, distinct = rows_of(offsets.as_py(), terms.as_py(), counts.as_py())
                yield pa.RecordBatch.from_arrays([*rows.values.flatten(), pa.array(words), pa.array(distinct)], names=schema.names)

    rows = stage(matrix.shards.mapInArrow(unpack, schema), "rows")
    # Of texts that stand once nothing is to be joined; of the others one row per text, the smallest id. As a written table, so
    # that the rows of a text that stands very often are split among tasks.
    again = stage(rows.groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("rows")).filter("rows > 1"), "again")
    later = F.col("first").isNotNull() & (F.col("id").isNull() | (F.col("id") > F.col("first")))
    return rows.join(again.drop("rows"), "digest", "left").select(
        "id", "part", "n_words", "n_distinct", (F.col("n_words") < least_words).alias("a"),
        (100 * F.col("n_distinct") < 50 * F.col("n_words")).alias("b"), "c", "d", later.alias("e"))


def interactions(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", part: str = "lang",
                 quality: str = "quality", toxic: str = "toxic", least_words: int = 200) -> DataFrame:
    """One row per part, order of the filters and step. kept: after this step; removed: by it; redundant: fail its filter but were
    removed before; unique_fails: fail its filter alone; good_lost, toxic_lost: removed by it with that label 1; shapley: removed by its
    filter, summed over all orders."""
    found = failed_filters(docs, id_col, text, part, least_words)
    marks = labels.filter(F.col(f"`{id_col}`").isNotNull()).groupBy(F.col(f"`{id_col}`").alias("id")).agg(
        F.max((F.col(f"`{quality}`") == 1).cast("int")).alias("good"), F.max((F.col(f"`{toxic}`") == 1).cast("int")).alias("toxic"))
    failed = sum((F.col(name).cast("int") * (1 << i) for i, name in enumerate("abcde")), F.lit(0))
    sets = stage(found.join(marks, "id", "left").groupBy("part", failed.alias("failed")).agg(
        F.count("*").alias("n"), F.count_if(F.col("good") == 1).alias("good"), F.count_if(F.col("toxic") == 1).alias("toxic")), "sets")

    def total(condition: Column, value: str | Column = "n") -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col(value) if isinstance(value, str) else value)), F.lit(0)).cast("long")

    # A literal of 600 entries: the order, the step, its filter's bit and those of the filters before it.
    steps = [("".join(order), step + 1, 1 << FILTERS.index(letter), sum(1 << FILTERS.index(x) for x in order[:step]))
             for order in permutations(FILTERS) for step, letter in enumerate(order)]
    every = F.array(*[F.struct(*[F.lit(x).alias(n) for x, n in zip(s, ("filter_order", "step", "bit", "earlier"), strict=True)]) for s in steps])
    fails = F.col("failed").bitwiseAND(F.col("bit")) > 0
    gone = F.col("failed").bitwiseAND(F.col("earlier")) > 0
    # A document is removed by one of the filters it fails, by each in as many orders as by the others.
    share = F.col("n") * (F.lit(120) / F.bit_count("failed")).cast("long")
    return sets.select("*", F.inline(every)).groupBy("part", "filter_order", "step").agg(
        total(~fails & ~gone).alias("kept"), total(fails & ~gone).alias("removed"), total(fails & gone).alias("redundant"),
        total(F.col("failed") == F.col("bit")).alias("unique_fails"), total(fails & ~gone, "good").alias("good_lost"),
        total(fails & ~gone, "toxic").alias("toxic_lost"), total(fails, share).alias("shapley"))
