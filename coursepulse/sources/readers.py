"""Readers for tables and page archives."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .schemas import PAGES, TABLES


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table stored as ``root/name`` in Parquet, with its declared schema.

    Columns that older files lack read as NULL.
    """
    return spark.read.schema(TABLES[name]).parquet(f"{root}/{name}")


def read_jdbc(
    spark: SparkSession, url: str, table: str, partition_column: str | None = None,
    lower: int | None = None, upper: int | None = None, partitions: int | None = None, **options: str,
) -> DataFrame:
    """A database table, read in ``partitions`` ranges of ``partition_column`` when one is given."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
    if partition_column is not None:
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", lower).option("upperBound", upper).option("numPartitions", partitions)
        )
    return reader.load()


def read_page_archive(
    spark: SparkSession, path: str, source_format: str = "parquet", schema: T.StructType = PAGES,
    partitions: int | None = None,
) -> DataFrame:
    """Archived pages (page_id, url, html) from Parquet or JSON lines.

    Reading markup is bound by the processor. An archive of few large splits is better written again in smaller row
    groups, or read with a smaller ``spark.sql.files.maxPartitionBytes``; ``partitions`` deals the pages out
    over the network instead, which is for small archives only.
    """
    pages = spark.read.format(source_format).schema(schema).load(path)
    return pages.repartition(partitions) if partitions else pages
