"""Streams of envelope files and of landed rows (J3 as a stream).

Both use ``foreachBatch`` with ``availableNow``: a scheduled run takes every
file that arrived since the last one, in batches of bounded size, and stops.
The checkpoint takes the part of the stored watermark.  A micro-batch that is
repeated after a failure changes nothing: landing upserts by key, and versions
staged twice are one curated row.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidemark.plans.jobs import ingest_batch, refresh_curated, stage_increment
from tidemark.plans.landing import Batch
from tidemark.registry import TableSpec
from tidemark.sources.envelopes import finish_envelopes, stream_envelopes
from tidemark.sources.lake import Lake


def _run(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ingest_stream(
    lake: Lake,
    envelope_path: str,
    checkpoint: str,
    *,
    source_system: str,
    snapshot_date: date,
    ingested_at: Callable[[int], datetime],
    files_per_trigger: int | None = None,
) -> StreamingQuery:
    """New envelope files into landing; ``ingested_at`` gives a batch its instant."""

    def handle(envelopes: DataFrame, number: int) -> None:
        batch = Batch(f"stream-{number}", snapshot_date, ingested_at(number), source_system)
        ingest_batch(lake, finish_envelopes(envelopes), batch)

    return _run(stream_envelopes(lake.spark, envelope_path, files_per_trigger), handle, checkpoint)


def curate_stream(
    lake: Lake, spec: TableSpec, feed_path: str, checkpoint: str, files_per_trigger: int | None = None
) -> StreamingQuery:
    """An append-only feed of landed rows into staging and curated.

    Each micro-batch rewrites only the curated months it touches.
    """
    reader = lake.spark.readStream.schema(spec.schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)

    def handle(rows: DataFrame, _number: int) -> None:
        staged = stage_increment(lake, spec, rows)
        refresh_curated(lake, spec, {part.month for part in staged}, staged)

    return _run(reader.parquet(feed_path), handle, checkpoint)
