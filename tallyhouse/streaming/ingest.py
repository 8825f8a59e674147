"""File arrival as a stream: each micro-batch of files lands in the raw tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tallyhouse.plans.landing import check_inbox, land, land_readable
from tallyhouse.sources.lines import exact_path, read_lines, stream_files


def batch_label(batch: DataFrame, batch_id: int) -> str:
    """Name of a micro-batch: the same on replay, different for another checkpoint."""
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{query}-{batch_id}"


def start_ingest(
    spark: SparkSession,
    inbox: str,
    root: str,
    checkpoint: str,
    run_date: dt.date | None = None,
    archive: bool = False,
    max_files: int = 1000,
    once: bool = True,
    interval: str = "1 minute",
    **options: str,
) -> StreamingQuery:
    """Land files as they arrive below `inbox`, all present ones and stop if `once` is set.

    A file is known by its path: content that changes under an old name is not read again, use
    `land_files` for such drops. A batch that dies is replayed with the same files, the same load
    time and the same label, so it replaces its own rows. A file of a batch that has gone or cannot be read is
    turned away in the log, and the others of its batch land without it.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        files = batch.collect()  # at most max_files
        if not files:
            return
        loaded_at = files[0].loaded_at

        def land_paths(paths: list[str], label: str) -> None:
            land(read_lines(spark, [exact_path(path) for path in paths], loaded_at), root, label, run_date, archive, max_files)

        land_readable(spark, root, sorted(file.path for file in files), batch_label(batch, batch_id), land_paths, run_date)

    trigger = {"availableNow": True} if once else {"processingTime": interval}
    return (
        stream_files(spark, check_inbox(inbox), max_files, **options)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
