"""Raw file listing, junk purge, routing and the processed-file ledger.

S4 junk purge, S5 listing and routing, S10 processed ledger. Listing uses
Spark's ``binaryFile`` source with only metadata columns selected, so file
bytes are never read here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions import strings as S
from . import ledger


def list_raw_files(spark: SparkSession, path: str) -> DataFrame:
    """(file_name, path, mtime, length) of every file under ``path`` (no content read)."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return df.select(S.basename("path").alias("file_name"), "path",
                     F.col("modificationTime").alias("mtime"), "length")


def is_junk(name_col="file_name") -> F.Column:
    """System files (.db, .ini, .ds_store suffix, or a dot-name)."""
    n = S.col_(name_col)
    return F.lower(S.suffix(n)).isin(*C.JUNK_EXTENSIONS) | n.startswith(".")


def route(files: DataFrame, name_col: str = "file_name") -> DataFrame:
    """S4 + S5: flag junk, add ``ext`` and ``kind`` (pdf, image, other).

    Junk is filtered, never deleted from the source; ``other`` files go to
    rejects. ``number_lots`` numbers PDF lots before image lots.
    """
    ext = F.lower(S.suffix(name_col))
    kind = (F.when(ext == ".pdf", F.lit("pdf"))
            .when(ext.isin(*C.IMAGE_EXTENSIONS), F.lit("image"))
            .otherwise(F.lit("other")))
    return files.withColumn("ext", ext).withColumn("junk", is_junk(name_col)).withColumn("kind", kind)


def number_lots(lots: DataFrame, lot_col: str = "lot_no", kind_col: str = "kind") -> DataFrame:
    """``lot_id`` over both kinds: PDF lots keep their number, image lots are
    numbered behind the last of them (P14 and V1 take lots in that order)."""
    behind = lots.filter(F.col(kind_col) == "pdf").agg(   # one row
        (F.coalesce(F.max(lot_col), F.lit(-1)) + 1).alias("_behind"))
    return lots.crossJoin(F.broadcast(behind)).withColumn(
        "lot_id", F.col(lot_col) + F.when(F.col(kind_col) == "image", F.col("_behind")).otherwise(F.lit(0))).drop("_behind")


def unprocessed(files: DataFrame, processed: DataFrame | None, key: str = "file_name") -> DataFrame:
    """Files not yet in the processed manifest (written after the registry)."""
    if processed is None:
        return files
    return files.join(processed.select(key).distinct(), key, "left_anti")


def mark_processed(spark: SparkSession, batch_files: DataFrame, ledger_path: str, batch_id: str,
                   key: str = "file_name") -> None:
    """Append this batch's files and their filter to the ledger; one folder per batch
    id, so a retried batch overwrites its own entry instead of duplicating it."""
    ledger.mark(spark, batch_files, ledger_path, batch_id, key)
