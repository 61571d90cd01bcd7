"""Feed export and database writes."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_feed(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Records as UTF-8 JSON lines."""
    df.write.mode(mode).json(path)


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", **options: str) -> None:
    """Rows to a database table."""
    df.write.format("jdbc").option("url", url).option("dbtable", table).options(**options).mode(mode).save()


def append_crawl_log(log: DataFrame, path: str) -> None:
    """Log rows added to the log table."""
    log.write.mode("append").parquet(path)
