"""A ledger of processed files that a new listing need not read.

Each batch's files are a partition of the ledger, and beside it stands a Bloom
filter of their names: rows (word, bits) of a bit map sized by the batch. A listing
probes the filters; only files with a hit are looked up exactly, and only in the
partitions whose filter was hit. A filter is never wrong about a file that is in
the ledger, so no file is taken twice, and the exact look-up decides every hit, so
none is lost.

Filters are built by an aggregate (bits of a word by OR) and probed by a join on
(batch size class, word), so neither names nor filters pass through the driver; it
sees the numbers of the partitions with hits. A ledger written before there were
filters counts as hit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .pointer import path_exists

PROBES = 5
BITS_PER_FILE = 16
LEAST_BITS = 10


def _filter_path(ledger_path: str) -> str:
    return f"{ledger_path.rstrip('/')}_filters"


def _probes(names: DataFrame, key: str, log_bits) -> DataFrame:
    """``names`` with (log_bits, word, bit) of each probe."""
    at = F.array(*[F.shiftrightunsigned(F.xxhash64(key, F.lit(k)), 16) for k in range(PROBES)])
    return names.withColumn("log_bits", log_bits).withColumn("at", F.explode(at)).withColumn(
        "at", F.col("at").bitwiseAND(F.expr("shiftleft(1L, log_bits) - 1"))).select(
        *names.columns, "log_bits", F.expr("at div 64").alias("word"), F.expr("cast(at % 64 as int)").alias("bit"))


def mark(spark: SparkSession, files: DataFrame, ledger_path: str, batch_id: str, key: str = "file_name",
         bits_per_file: int = BITS_PER_FILE) -> None:
    """Add the batch's files and their filter; written again, both are replaced. The
    filter goes first: files without one would be counted as hit, never as new."""
    base = ledger_path.rstrip("/")
    names = files.select(key).where(F.col(key).isNotNull()).distinct()
    n = names.count()
    log_bits = max(LEAST_BITS, (max(n, 1) * bits_per_file - 1).bit_length())
    words = _probes(names, key, F.lit(log_bits)).groupBy("log_bits", "word").agg(
        F.expr("bit_or(shiftleft(1L, bit))").alias("bits"))
    words.write.mode("overwrite").parquet(f"{_filter_path(base)}/batch={batch_id}")
    files.select(key).distinct().write.mode("overwrite").parquet(f"{base}/batch={batch_id}")


def _partitions(spark: SparkSession, path: str) -> list[str]:
    jvm = spark._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(hpath) if s.isDirectory() and s.getPath().getName().startswith("batch="))


def hits(spark: SparkSession, files: DataFrame, ledger_path: str, key: str = "file_name") -> DataFrame:
    """(key, batch): the files that a batch's filter may hold; reads filters only."""
    path = _filter_path(ledger_path)
    schema = "log_bits int, word bigint, bits bigint, batch string"
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema).select(F.lit("").alias(key), "batch")
    filters = spark.read.schema(schema).parquet(path)
    sizes = filters.select("log_bits").distinct()  # a few: powers of two
    names = files.select(key).where(F.col(key).isNotNull()).distinct()
    probes = _probes(names.crossJoin(F.broadcast(sizes.withColumnRenamed("log_bits", "lb"))), key, F.col("lb")).drop("lb")
    found = probes.join(filters, ["log_bits", "word"]).where(F.expr("getbit(bits, bit)") == 1)
    return found.groupBy(key, "batch").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= PROBES).select(key, "batch")


def unseen(spark: SparkSession, files: DataFrame, ledger_path: str, key: str = "file_name") -> DataFrame:
    """The rows of ``files`` whose name no batch of the ledger has."""
    base = ledger_path.rstrip("/")
    batches = _partitions(spark, base)
    if not batches:
        return files
    without = sorted(set(batches) - set(_partitions(spark, _filter_path(base))))
    likely = hits(spark, files, base, key)
    named = sorted({f"batch={r['batch']}" for r in likely.select("batch").distinct().collect()} & set(batches))
    if not named and not without:
        return files
    schema = files.select(key).schema
    rows = spark.read.schema(schema).parquet(*[f"{base}/{b}" for b in sorted({*named, *without})]).distinct()
    return files.join(rows, key, "left_anti")
