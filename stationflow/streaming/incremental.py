"""Incremental trip ingestion with Structured Streaming.

The reference's scheduled flow picks up newly published quarter files and
ingests them. Here a file stream over the raw folder tracks which trip CSVs
are new (the checkpoint records every file handed to a micro-batch); each
micro-batch runs the batch ingest (``plans.ingest.ingest_trip_files``) over
exactly its files. The stream reads only file paths (``binaryFile`` without
its content column), so the CSV rows are read once, by the ingest job.

A micro-batch that fails is re-run with the same files; the lake write
replaces whole quarter partitions and the manifest upsert replaces records
by file name, so a re-run leaves the same result.

A quarter re-published under a file name already seen is not a new file to
the stream; run the batch ingest for that.
"""

from __future__ import annotations

import datetime as dt
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..plans.ingest import IngestResult, ingest_trip_files

# The binaryFile source's fixed schema; only ``path`` is selected, so file
# contents are never read by the stream.
BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"
from ..sources.trips import TRIP_CSV_GLOB


def new_trip_files(spark: SparkSession, input_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A stream of the paths of trip CSVs arriving in ``input_dir``."""
    reader = (
        spark.readStream.format("binaryFile")
        .schema(BINARY_FILE_SCHEMA)
        .option("pathGlobFilter", TRIP_CSV_GLOB)
        .option("recursiveFileLookup", "false")
        .option("maxFileAge", "36500d")  # a file's own date says nothing about whether it is new here
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(input_dir).select("path")


def ingest_new_trip_files(spark: SparkSession, input_dir: str, lake_dir: str, manifest_path: str,
                          checkpoint: str, available_now: bool = True,
                          max_files_per_trigger: int | None = None,
                          on_batch: Callable[[int, IngestResult], None] | None = None,
                          clock: Callable[[], dt.datetime] | None = None) -> StreamingQuery:
    """Start the incremental ingest. With ``available_now`` the query takes
    every file present, ingests it in micro-batches and stops; otherwise it
    keeps watching the folder (``processingTime`` trigger of one minute).
    ``clock`` gives each batch's ``ingested_at`` (UTC now by default)."""
    now = clock or (lambda: dt.datetime.now(dt.timezone.utc))

    def run_batch(batch: DataFrame, batch_id: int) -> None:
        # One row per new file: the list is bounded by the files per batch.
        files = sorted(r["path"] for r in batch.select("path").distinct().collect())
        if not files:
            return
        result = ingest_trip_files(spark, files, input_dir, lake_dir, manifest_path, now())
        if on_batch is not None:
            on_batch(batch_id, result)

    writer = (
        new_trip_files(spark, input_dir, max_files_per_trigger)
        .writeStream.foreachBatch(run_batch)
        .option("checkpointLocation", checkpoint)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
