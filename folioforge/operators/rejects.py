"""The reject ledger -- every skipping operator reports what it skipped.

Rows: (stage, key, reason, detail). Each builder is a filter or anti join
over the operator's own inputs; the ledger is their union.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import strings as S

COLUMNS = ["stage", "key", "reason", "detail"]


def _key(*cols) -> F.Column:
    return F.concat_ws("|", *[S.col_(c).cast("string") for c in cols])


def bad_payloads(validated: DataFrame, id_col: str = "payload_id") -> DataFrame:
    """Payloads that failed strict validation."""
    return validated.filter(~F.col("valid")).select(
        F.lit("payload").alias("stage"), _key(id_col).alias("key"), F.col("reason"),
        F.lit(None).cast("string").alias("detail"))


def unmatched_answers(answers: DataFrame, resolved: DataFrame, batch_cols: list[str],
                      id_col: str = "ord", given_col: str = "name_given") -> DataFrame:
    """Model-returned names that matched no page of the batch."""
    miss = answers.join(resolved.select(*batch_cols, id_col), [*batch_cols, id_col], "left_anti")
    return miss.select(F.lit("orientation").alias("stage"), _key(*batch_cols, id_col).alias("key"),
                       F.lit("unknown page name").alias("reason"), F.col(given_col).alias("detail"))


def unmatched_instructions(doc_pages: DataFrame, batch_pages: DataFrame, batch_cols: list[str]) -> DataFrame:
    """Page instructions whose cleaned name is not a page of the batch."""
    d = doc_pages.withColumn("_clean", S.clean_name("file_name"))
    bp = batch_pages.select(*batch_cols, F.col("file_name").alias("_clean"))
    miss = d.join(bp, [*batch_cols, "_clean"], "left_anti")
    return miss.select(F.lit("extraction").alias("stage"), _key(*batch_cols, "doc_idx", "pos").alias("key"),
                       F.lit("unknown page name").alias("reason"), F.col("file_name").alias("detail"))


def documents_without_folio(doc_pages: DataFrame, batch_pages: DataFrame, doc_folios: DataFrame,
                            batch_cols: list[str]) -> DataFrame:
    """M1: a document with matched pages but no folio gives no item (its pages are swallowed)."""
    d = doc_pages.withColumn("_clean", S.clean_name("file_name"))
    bp = batch_pages.select(*batch_cols, F.col("file_name").alias("_clean"))
    docs = d.join(bp, [*batch_cols, "_clean"], "left_semi").select(*batch_cols, "doc_idx").distinct()
    miss = docs.join(doc_folios.select(*batch_cols, "doc_idx"), [*batch_cols, "doc_idx"], "left_anti")
    return miss.select(F.lit("map").alias("stage"), _key(*batch_cols, "doc_idx").alias("key"),
                       F.lit("document without folio").alias("reason"), F.lit(None).cast("string").alias("detail"))


def ledger(*parts: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), [p.select(*COLUMNS) for p in parts])
