"""Structured Streaming form of the audit (T1, T2, T4; V3 through the registry).

A file stream of map-stage items (parquet) is consumed lot by lot with
``foreachBatch``; each micro-batch runs :func:`process_batch` against the
registry snapshot published by the previous one, so versions carry across
micro-batches (V3). The checkpoint commits a micro-batch only after
``foreachBatch`` returns: a failed store leaves the batch to be retried
(T2), and every write inside is keyed by the batch id, so the retry
replaces rather than duplicates. ``maxFilesPerTrigger`` bounds a
micro-batch by file count; ``trigger(availableNow=True)`` drains what is
there and stops.

The 3-second burst rule (K2) is not a session window: Spark merges a gap of
exactly the threshold, the original splits it; a streaming variant can use a
gap of ``threshold - 1 microsecond``, which is exact at microsecond
precision (see :func:`burst_window`).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..plans.batch_run import AuditPaths, process_batch
from ..plans.end_to_end import audit_lots, place_lots, rules_on_pages
from ..session import materialize
from ..sources.raw_files import route
from .lots import stream_burst_lots, stream_page_lots


def items_stream(spark: SparkSession, path: str, schema: T.StructType, max_files: int = 1,
                 archive_dir: str | None = None) -> DataFrame:
    """Map-stage items arriving as parquet files under ``path``.

    S10 in streaming form: with ``archive_dir`` the source moves each file
    there after its micro-batch committed (``cleanSource=archive``), so a
    failed store leaves the file in place.
    """
    r = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    if archive_dir:
        r = r.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return r.parquet(path)


def run_stream(spark: SparkSession, items: DataFrame, paths: AuditPaths, checkpoint: str,
               batch_ts_fn=None, available_now: bool = True):
    """Start the audit stream; returns the StreamingQuery (caller awaits it)."""
    def body(batch_df: DataFrame, batch_id: int) -> None:
        ts = (batch_ts_fn or (lambda b: dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")))(batch_id)
        if batch_df.isEmpty():
            return
        process_batch(batch_df.sparkSession, batch_df, paths, f"{batch_id:08d}", ts)

    w = items.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def files_stream(spark: SparkSession, path: str, page_counts: DataFrame, max_files: int = 1000,
                 glob: str = "*") -> DataFrame:
    """T1 from the files on: routed raw files (S4, S5) as they arrive under ``path``,
    metadata only, with their page counts (``page_counts``: file_name, n_pages; an image
    has one, a PDF that is not in it is unreadable)."""
    raw = (spark.readStream.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
           .option("maxFilesPerTrigger", max_files).load(path))
    files = route(raw.select(F.regexp_extract("path", r"([^/]*)$", 1).alias("file_name"), F.col("modificationTime").alias("mtime")))
    files = files.where(~F.col("junk") & (F.col("kind") != "other")).select("file_name", "mtime", "kind")
    return files.join(page_counts.select("file_name", F.col("n_pages").cast("long").alias("n_pages")), "file_name", "left")


def lots_stream(files: DataFrame, options: C.AuditOptions = C.DEFAULTS, idle_seconds: float | None = None) -> DataFrame:
    """Closed lots (kind, lot_no, file_name, n_pages, mtime) of a stream of routed files;
    the end of the listing is a row of each kind without a file_name."""
    pdf = stream_page_lots(files.where("kind = 'pdf'"), options.pdf_chunk_max_pages, "kind", idle_seconds)
    images = stream_burst_lots(files.where("kind = 'image'"), options.physical_chunk_size, options.burst_gap_seconds, "kind",
                               idle_seconds=idle_seconds)
    return pdf.unionByName(images).select(F.col("lane").alias("kind"), "lot_no", "file_name", "n_pages",
                                          F.timestamp_micros("t_us").alias("mtime"))


def run_file_stream(spark: SparkSession, lots: DataFrame, texts, paths: AuditPaths, checkpoint: str,
                    analyzer=rules_on_pages, options: C.AuditOptions = C.DEFAULTS, batch_ts_fn=None,
                    available_now: bool = True):
    """The audit over a stream of closed lots: each trigger's lots go through pages,
    analyzer and ``process_batch``. ``texts``: function of a table of file names that
    gives (file_name, page_no, text) of their pages."""
    def body(batch_df: DataFrame, batch_id: int) -> None:
        ts = (batch_ts_fn or (lambda b: dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")))(batch_id)
        closed = materialize(batch_df, "closed-lots")  # the stateful plan runs once
        if closed.isEmpty():
            return
        placed = place_lots(closed.where("kind = 'pdf'"), closed.where("kind = 'image'"), options)
        audit = audit_lots(placed, texts(closed.select("file_name")), analyzer)
        process_batch(closed.sparkSession, audit.items, paths, f"{batch_id:08d}", ts, files=audit.files)

    w = lots.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def burst_window(stream: DataFrame, time_col: str, gap_seconds: float, watermark: str = "10 minutes",
                 key_cols: list[str] | None = None) -> DataFrame:
    """Streaming burst detection: a session window whose gap is one
    microsecond under the threshold, with a watermark for late files."""
    gap_us = int(round(gap_seconds * 1_000_000)) - 1
    w = F.session_window(F.col(time_col), f"{gap_us} microseconds")
    return (stream.withWatermark(time_col, watermark)
            .groupBy(*(key_cols or []), w.alias("burst"))
            .agg(F.count(F.lit(1)).alias("n_files")))
