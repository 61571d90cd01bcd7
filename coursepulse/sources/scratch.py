"""Folders for tables that live as long as a job, and what keeps the disk that a job takes small."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import SparkSession

#: Options of what is written: about half the size of the default.
PACKED = {"compression": "zstd"}
CLEANUP_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def lean(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of every action inside go when it ends, not when the driver happens to collect its garbage.

    For actions whose DataFrames are not executed again. A setting that the session has already holds.
    """
    if spark.conf.get(CLEANUP_SETTING, None) is not None:
        yield
        return
    spark.conf.set(CLEANUP_SETTING, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP_SETTING)


@cache
def _own_folder() -> str:
    folder = tempfile.mkdtemp(prefix="scratch-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return f"file://{folder}"


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder for ``name`` below ``spark.checkpoint.dir``.

    Where the setting is absent a one-machine session (``local``, ``local[n]``) gets a folder of its own, which goes
    when the program ends; any other session is refused, as its executors would not see each other's files.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = _own_folder()
    return f"{base.rstrip('/')}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


def drop_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
