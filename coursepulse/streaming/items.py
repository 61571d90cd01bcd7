"""Streams of item records and of archived pages into the published tables."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..functions.clock import AsOf
from ..functions.durations import parse_duration_daily
from ..plans.collect import page_items
from ..plans.readings import StoredReadings
from ..plans.update import publish_items
from ..sources.published import PublishedTables


def stream_items(
    items: DataFrame, tables: PublishedTables, checkpoint: str, as_of: AsOf = None, trigger: dict | None = None,
    pass_on: Callable[[DataFrame], None] | None = None,
) -> StreamingQuery:
    """Start the query that applies every micro-batch of item records as one commit.

    Arrival order (``seq``) decides; there is no watermark, as no record is ever late. The commit stores the batch under
    the id that Spark gave the checkpoint: a batch replayed after a failure is recognised and skipped, while
    another stream, or the same source under a new checkpoint, counts for itself. Several streams may write the same tables.
    If ``pass_on`` fails the stream ends, and the batch that a new start replays gives the records again.
    """
    return _publishing(items, lambda batch: batch, tables, checkpoint, as_of, trigger, pass_on)


def stream_pages(
    pages: DataFrame, tables: PublishedTables, checkpoint: str, as_of: AsOf = None, trigger: dict | None = None,
    profile: str = "classroom", duration: Callable[[Column], Column] = parse_duration_daily, readings: StoredReadings | None = None,
) -> StreamingQuery:
    """Start the query that reads every micro-batch of archived pages (page_id, url, html) and applies it as one commit.

    A page is read once. Its records and, where it cannot be read, the reason become visible together: courses, lectures,
    snapshots and logs as ``stream_items`` has them, and rows of ``rejected_pages``. Pages count in the order of their
    ids within a micro-batch, and of the micro-batches. With ``readings`` pages whose markup was read before are not parsed again.
    """
    def read(batch: DataFrame) -> DataFrame:
        return page_items(batch, profile, duration, True, readings).drop("duration_rejected")

    return _publishing(pages, read, tables, checkpoint, as_of, trigger)


def _publishing(source, records, tables, checkpoint, as_of, trigger, pass_on=None) -> StreamingQuery:
    session = source.sparkSession

    def apply_batch(batch: DataFrame, batch_id: int) -> None:
        stream = json.loads(session.read.text(f"{checkpoint}/metadata", wholetext=True).first()[0])["id"]
        publish_items(tables, records(batch), as_of, (stream, batch_id), pass_on)

    return (
        source.writeStream.foreachBatch(apply_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
