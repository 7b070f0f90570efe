"""A report that grows by batches (A1, A2): a batch writes its own rows only.

``rows/batch=ID`` holds the batch's report columns as text, nulls as they are;
``flags/batch=ID`` one row: which columns the batch has at all. The rule "a column
absent from every row reads N/A, one absent from some is blank" is a matter of
reading: flags of all batches are merged by OR (a row a batch), and where a later
batch flips one, no stored row has to change. Writing a batch again replaces it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..sources.pointer import path_exists
from .report import REPORT_SOURCE


class ReportStore:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def add(self, results: DataFrame, batch_id: str) -> None:
        """Write (or replace) the batch's part; nothing else is read or written."""
        columns = [(F.col(REPORT_SOURCE[c]) if REPORT_SOURCE[c] in results.columns else F.lit(None)).cast("string").alias(c)
                   for c in C.REPORT_COLUMNS]
        rows = results.select(*columns)
        rows.write.mode("overwrite").parquet(f"{self.path}/rows/batch={batch_id}")
        written = self.spark.read.schema(rows.schema).parquet(f"{self.path}/rows/batch={batch_id}")
        written.agg(*[(F.count(F.col(f"`{c}`")) > 0).alias(c) for c in C.REPORT_COLUMNS]).write.mode("overwrite").parquet(
            f"{self.path}/flags/batch={batch_id}")

    def read(self) -> DataFrame | None:
        """The report over all batches, None when none was added."""
        if not path_exists(self.spark, f"{self.path}/flags"):
            return None
        schema = ", ".join(f"`{c}` string" for c in C.REPORT_COLUMNS)
        rows = self.spark.read.schema(schema).parquet(f"{self.path}/rows").select(*[f"`{c}`" for c in C.REPORT_COLUMNS])
        flags = self.spark.read.schema(schema.replace(" string", " boolean")).parquet(f"{self.path}/flags").agg(
            *[F.max(F.col(f"`{c}`")).alias(f"_has_{i}") for i, c in enumerate(C.REPORT_COLUMNS)])  # one row
        joined = rows.crossJoin(F.broadcast(flags))
        return joined.select(*[F.when(F.col(f"_has_{i}"), F.col(f"`{c}`")).otherwise(F.lit("N/A")).alias(c)
                               for i, c in enumerate(C.REPORT_COLUMNS)])
