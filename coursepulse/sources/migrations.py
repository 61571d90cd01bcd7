"""Additive schema changes and the key checks that go with them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.history import LECTURE_KEY


def add_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the columns of ``schema`` it lacks, NULL in existing rows, in schema order.

    Columns outside the schema stay at the end.
    """
    declared = [
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema
    ]
    return df.select(*declared, *[c for c in df.columns if c not in schema.fieldNames()])


def duplicate_keys(lectures: DataFrame, null_safe: bool = True) -> DataFrame:
    """Lecture keys that occur more than once.

    With ``null_safe`` two NULL chapters are equal; without it rows with a NULL in the key never
    collide, as in a database unique key.
    """
    rows = lectures if null_safe else lectures.dropna(subset=list(LECTURE_KEY))
    return rows.groupBy(*LECTURE_KEY).agg(F.count("*").alias("row_count")).filter(F.col("row_count") > 1)


def chapter_mix(lectures: DataFrame) -> DataFrame:
    """Lectures stored under several chapter keys: same course, section and title."""
    # A NULL chapter counts as one key beside the numbered ones.
    keys = F.count_distinct(F.coalesce(F.col("chapter_number").cast("string"), F.lit("none")))
    return (
        lectures.groupBy("course_id", "section_number", "lecture_title")
        .agg(keys.alias("chapter_keys"), F.count("*").alias("row_count"))
        .filter(F.col("chapter_keys") > 1)
    )


def describe_table(df: DataFrame) -> DataFrame:
    """Column names, types and nullability of a table."""
    rows = [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema]
    return df.sparkSession.createDataFrame(rows, "col_name STRING, data_type STRING, nullable BOOLEAN")
