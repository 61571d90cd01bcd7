"""What the operators of this folder have in common: staged tables, the package in the tasks, words by ASCII code."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import scratch_folder

#: Words and the white space between them, by ASCII code.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"

#: Bytes of a batch between Spark and the Python workers in steps that move texts or sets (Spark's own bound is 64 MB, held on both sides).
BATCH_BYTES = 1 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, so that tasks import it as the driver does."""
    if spark.sparkContext.applicationId not in _shipped:
        package = Path(__file__).parents[1]
        packed = Path(tempfile.mkdtemp(prefix="llm-package-"), f"{package.name}.zip")
        with zipfile.ZipFile(packed, "w") as archive:
            for file in package.rglob("*.py"):
                archive.write(file, file.relative_to(package.parent))
        spark.sparkContext.addPyFile(str(packed))
        _shipped.add(spark.sparkContext.applicationId)


@contextmanager
def _batches(spark: SparkSession, batch_bytes: int | None) -> Iterator[None]:
    """Batches of about ``batch_bytes`` for the actions inside; a setting that the session has already holds."""
    if batch_bytes is None or spark.conf.get(BATCH_SETTING, None) is not None:
        yield
        return
    spark.conf.set(BATCH_SETTING, str(batch_bytes))
    try:
        yield
    finally:
        spark.conf.unset(BATCH_SETTING)


def stage(df: DataFrame, name: str, batch_bytes: int | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: it is computed once, and a lost executor costs nothing.

    ``batch_bytes`` bounds the batches that its Python steps get, beyond which a batch has one row more.
    """
    path = scratch_folder(df.sparkSession, name)
    with _batches(df.sparkSession, batch_bytes):
        df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.staged_in = path
    return table


def forget(*tables: DataFrame) -> None:
    """Delete the folders of staged tables, as ``stage`` gave them, that no later step reads."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.staged_in)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def free_name(df: DataFrame, name: str) -> str:
    """``name`` with as many underscores as it takes that no column of ``df`` has it; case does not tell columns apart."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def remainder(id_column: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null for a null id."""
    return F.crc32(id_column.cast("string").cast("binary")) % parts


class Rows(NamedTuple):
    """``rows``: id and value of every given row, each under an id of its own; ``names``: id and the given one (``given``), or None
    where the given ids serve."""

    rows: DataFrame
    names: DataFrame | None

    def named(self, result: DataFrame, *columns: str) -> DataFrame:
        """``result`` with the given ids in ``columns``."""
        if self.names is None:
            return result
        order = result.columns
        for column in columns:
            own = self.names.select(F.col("id").alias(column), "given")
            result = result.join(own, column, "left").drop(column).withColumnRenamed("given", column)
        return result.select(*order)


def each_row(docs: DataFrame, id_col: str, value: Column, name: str) -> Rows:
    """The rows of ``docs`` as id and ``name`` (the ``value``, which can be ordered), none left out.

    Where every row has an id of its own, that is it. Otherwise rows are numbered in the order of their ids, null last, then
    of their values; equal rows follow each other. Numbers are written once, so that they stay what they are.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), value.alias(name))
    again = rows.groupBy("id").agg(F.count("*").alias("rows")).filter("rows > 1 OR id IS NULL")
    if again.isEmpty():
        return Rows(rows, None)
    # Equal rows travel as one; only ids and digests are sorted.
    digest = F.sha2(F.to_json(F.struct(name)), 256).alias("digest")
    each = stage(rows.groupBy("id", digest).agg(F.max(name).alias(name), F.count("*").alias("rows")), "each")
    numbers = stage(each.select("id", "digest", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))).alias("copy"))
                    .orderBy(F.col("id").asc_nulls_last(), "digest", "copy").withColumn("number", F.monotonically_increasing_id()), "numbers")
    same = numbers["id"].eqNullSafe(each["id"]) & (numbers["digest"] == each["digest"])
    owned = stage(numbers.join(each, same).select(F.col("number").alias("id"), numbers["id"].alias("given"), name), "rows")
    return Rows(owned.select("id", name), owned.select("id", "given"))


def without(docs: DataFrame, moved: DataFrame, id_column: Column, digest: Column) -> DataFrame:
    """``docs`` without the rows of the ids and digests in ``moved`` (id, digest, kept; a staged table): where ``kept`` one of the
    rows stays, the first by all columns that can be ordered."""
    def ordered(kind: str) -> bool:
        return "map<" not in kind and "variant" not in kind

    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), id_column.alias("id"), digest.alias("digest"))

    def same(other: DataFrame) -> Column:
        return rows["id"].eqNullSafe(other["id"]) & (rows["digest"] == other["digest"])

    rest = rows.join(moved, same(moved), "left_anti").select("row.*")
    again = moved.filter("kept")
    if again.isEmpty():
        return rest
    order = F.struct(*[F.col(f"row.`{f.name}`") for f in docs.schema if ordered(f.dataType.simpleString())])
    one = rows.join(again, same(again), "left_semi").groupBy("id", "digest").agg(F.min_by("row", order).alias("row"))
    return rest.unionByName(one.select("row.*"))


def keyed(docs: DataFrame, id_col: str, text: str) -> DataFrame | None:
    """id, digest, key, rows: a number for each different id and text, in the order of the ids with null last; none if all
    rows have an id of their own. Written once, so that a key stays what it is."""
    ids = docs.groupBy(F.col(id_col).alias("id")).agg(F.count("*").alias("rows")).filter("rows > 1 OR id IS NULL")
    if ids.isEmpty():
        return None
    each = docs.groupBy(F.col(id_col).alias("id"), text_digest(text).alias("digest")).agg(F.count("*").alias("rows"))
    return stage(each.orderBy(F.col("id").asc_nulls_last(), "digest").withColumn("key", F.monotonically_increasing_id()), "keys")


def text_digest(text: str) -> Column:
    return F.sha2(F.coalesce(F.col(text), F.lit("")), 256)
