"""Incremental Bronze ingest as a Structured Streaming job.

Landed page documents (JSON lines, one page per line) are read as a file
stream with a fixed schema, flattened by the payload scan (A1) and merged
(lines that are no such document go to a quarantine table beside Bronze)
into Bronze in ``foreachBatch``: the lowest page of a fetch wins per (series,
date), over any number of triggers and in whatever order pages land, because
stored rows keep their page and fetch (``layers.merge_pages``); rows of earlier
fetches win (A7).  A call of ``ingest_stream`` is one fetch unless calls are
given the same ``fetch`` name, as a restart after a failure should be.  The stream checkpoint
records which files were consumed; a replayed batch appends nothing because
its rows are already stored, and writes its quarantine folder again (one for
each stream, known by its checkpoint, and batch), so the job survives executor
and driver loss.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import layers, payload


def _merge_batch(spark: SparkSession, bronze_path: str, checkpoint_path: str, fetch: str):
    stream = hashlib.sha256(checkpoint_path.encode()).hexdigest()[:16]

    def merge(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # read for the quarantine and for the rows
        try:
            corrupt = payload.corrupt_pages(batch)
            if not corrupt.isEmpty():  # a replayed batch writes its folder again
                corrupt.write.mode("overwrite").parquet(
                    f"{quarantine_path(bronze_path)}/stream={stream}/batch_id={batch_id}")
            rows = payload.normalize_ohlcv(batch, extra_cols=["page_no"])
            layers.merge_pages(spark, rows, bronze_path, fetch)
        finally:
            batch.unpersist()
    return merge


def quarantine_path(bronze_path: str) -> str:
    return bronze_path.rstrip("/") + "_quarantine"


def ingest_stream(spark: SparkSession, landing_path: str, bronze_path: str,
                  checkpoint_path: str, max_files_per_trigger: int | None = None, fetch: str | None = None):
    """Start the ingest; with the default ``availableNow`` trigger it
    processes every landed file once and stops.  Returns the query."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    pages = payload.parse_pages(reader.text(landing_path))
    return (pages.writeStream
                 .foreachBatch(_merge_batch(spark, bronze_path, checkpoint_path, fetch or uuid.uuid4().hex))
                 .option("checkpointLocation", checkpoint_path)
                 .trigger(availableNow=True)
                 .start())


def land_pages(docs: DataFrame, landing_path: str) -> None:
    """Write page documents as JSON lines (what the fetcher lands)."""
    docs.write.mode("append").json(landing_path)
