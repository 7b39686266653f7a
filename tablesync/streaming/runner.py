"""Scheduled loads as a stream: each start takes what is new and stops.

The checkpoint remembers which files were taken, so no watermark filter is needed
and late rows still arrive. A batch may be delivered twice; its stream and number are
published in the same pointer as its rows, so a batch that is already in is skipped.
Numbers belong to one stream: another checkpoint is another stream, with numbers of its
own. Prune and refresh need the whole source and stay batch jobs.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tablesync.plans.job import Run, safe_names
from tablesync.plans.report import SyncReport
from tablesync.session import SharedFiles
from tablesync.sources.snapshot import SnapshotTarget
from tablesync.spec import SyncOptions, TableSpec


def apply_batch(
    spec: TableSpec,
    target: SnapshotTarget,
    batch: DataFrame,
    stream_id: str,
    batch_id: int,
    options: SyncOptions | None = None,
    since_watermark: bool = False,
    parents: Mapping[str, SnapshotTarget] | None = None,
) -> SyncReport | None:
    """Apply one batch of a stream unless it is already published.

    ``since_watermark`` drops rows below the stored watermark, as a batch run with
    the same incremental column would.
    """
    options = options or SyncOptions()
    if options.full_refresh:
        raise ValueError("a refresh needs the whole source")
    pointer = target.pointer()
    if pointer is None:
        raise ValueError(f"target table does not exist: {spec.name}")
    if batch_id <= pointer.batches.get(stream_id, -1):
        return None
    session = batch.sparkSession
    spec, batch = safe_names(spec, batch, target)
    run = Run(
        session,
        spec,
        batch,
        target.using(session),
        options,
        pointer,
        partial=True,
        batch=(stream_id, batch_id),
        take_late_rows=not since_watermark,
        parents=parents or {},
    )
    return run.execute()


def stream_id_of(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark wrote into a checkpoint when its stream first started."""
    return json.loads(SharedFiles(spark, checkpoint).read_text("metadata"))["id"]


def run_available(
    spec: TableSpec,
    stream: DataFrame,
    target: SnapshotTarget,
    checkpoint: str,
    options: SyncOptions | None = None,
    since_watermark: bool = False,
) -> None:
    """Apply everything the stream has now, batch by batch, then stop."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        stream_id = stream_id_of(batch.sparkSession, checkpoint)
        apply_batch(spec, target, batch, stream_id, batch_id, options, since_watermark)

    writer = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()


def read_stream(
    spark: SparkSession, path: str, schema, files_per_batch: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)
