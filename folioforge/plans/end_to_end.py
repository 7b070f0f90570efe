"""From a file listing to result rows: the whole dataflow as one plan.

files -> routing (S4, S5) -> lots (K1, K2) -> batches (K3) -> pages (P1, P2) and
aliases (P3) -> analyzer -> page names (J1) -> gate (P14) and fallback (G8) ->
items and orphans (M1-M3, J2, J3) -> the tables that ``process_batch`` takes.

An analyzer is a function of the aliased pages (batch columns, pos, alias,
file_name, text) that returns logical documents (batch columns, doc_idx, folios,
pages: the names it gives, document_type, client_name, confidence_score,
reasoning), or these and its ``statuses`` (``call_analyzer``). ``statuses`` tells what
became of a batch (ok, failed, exhausted), a batch not in it is ok. A batch is one PDF, or ``vision_batch_size`` images.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..operators import packing as K
from ..operators import pages as P
from ..operators.analyzer import rule_analyzer
from ..session import materialize
from ..sources.raw_files import number_lots, route

BATCH = ["lot_id", "batch_no"]


@dataclass(frozen=True)
class Audit:
    """``items``: regular and orphan items for ``process_batch``. ``files``: the input
    files of the lots that were not held back, for the ledger. ``rejects``: X4."""

    items: DataFrame
    files: DataFrame
    rejects: DataFrame


def rules_on_pages(pages: DataFrame) -> DataFrame:
    """The default analyzer on aliased pages: names them by alias."""
    docs = rule_analyzer(pages, BATCH, "pos")
    named = docs.select(*BATCH, "doc_idx", F.posexplode("pages").alias("i", "p")).join(
        pages.select(*BATCH, F.col("pos").cast("string").alias("p"), "alias"), [*BATCH, "p"]).groupBy(*BATCH, "doc_idx").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("i", "alias"))), lambda x: x["alias"]).alias("pages"))
    return docs.drop("pages", "status").join(named, [*BATCH, "doc_idx"])


def lots_of_files(files: DataFrame, options: C.AuditOptions) -> DataFrame:
    """Routed files with lot_id, batch_no, origen, tipo_origen and their place in the batch."""
    pdf = K.pack_next_fit(files.filter("kind = 'pdf'"), options.pdf_chunk_max_pages)
    images = K.pack_bursts(files.filter("kind = 'image'").withColumn("n_pages", F.lit(1)),
                           options.physical_chunk_size, options.burst_gap_seconds)
    return place_lots(pdf, images, options)


def place_lots(pdf: DataFrame, images: DataFrame, options: C.AuditOptions) -> DataFrame:
    """Lots of PDFs (file_name, n_pages, lot_no) and of images (and mtime) as one table of
    batches: a PDF is a batch of its own; images stand in their batch by position."""
    pdf = pdf.withColumn("rank", F.row_number().over(Window.partitionBy("lot_no").orderBy("file_name")))
    images = K.pack_fixed(images, ["lot_no"], ["mtime", "file_name"], options.vision_batch_size)
    both = pdf.select("file_name", F.lit("pdf").alias("kind"), F.col("n_pages").cast("int").alias("n_pages"), "lot_no",
                      F.col("rank").cast("bigint").alias("batch_no"), F.lit(0).alias("place"), F.col("file_name").alias("origen"),
                      F.lit(C.ORIGIN_TYPE_PDF).alias("tipo_origen")).unionByName(
        images.select("file_name", F.lit("image").alias("kind"), F.lit(1).alias("n_pages"), "lot_no",
                      F.col("batch_no").cast("bigint").alias("batch_no"), F.col("pos").alias("place"),
                      F.lit(C.IMAGE_ORIGIN).alias("origen"), F.lit(C.ORIGIN_TYPE_IMAGES).alias("tipo_origen")))
    return number_lots(both)


def audit_from_files(files: DataFrame, texts: DataFrame, analyzer: Callable[[DataFrame], DataFrame] = rules_on_pages,
                     statuses: DataFrame | None = None, options: C.AuditOptions = C.DEFAULTS) -> Audit:
    """``files``: file_name, mtime, n_pages (null: unreadable). ``texts``: file_name,
    page_no, text of the pages. ``statuses``: batch columns, status."""
    routed = route(files)
    usable = routed.filter(~F.col("junk") & (F.col("kind") != "other"))
    unreadable = K.unreadable_files(usable.filter("kind = 'pdf'"))
    unrouted = routed.filter(~F.col("junk") & (F.col("kind") == "other")).select(
        F.lit("routing").alias("stage"), F.col("file_name").alias("key"), F.lit("unrouted_file").alias("reason"),
        F.col("ext").alias("detail"))
    audit = audit_lots(lots_of_files(usable, options), texts, analyzer, statuses)
    return Audit(audit.items, audit.files, unreadable.unionByName(unrouted).unionByName(audit.rejects))


def audit_lots(lots: DataFrame, texts: DataFrame, analyzer: Callable[[DataFrame], DataFrame] = rules_on_pages,
               statuses: DataFrame | None = None) -> Audit:
    """The audit of packed files (see ``place_lots``), however they were packed."""
    lots = materialize(lots, "file-lots")

    exploded = P.explode_pages(lots).join(texts, ["file_name", "page_no"], "left").select(
        *BATCH, "place", "page_no", F.col("page_name").alias("page"), "text")
    pages = P.alias_pages(exploded, BATCH, ["place", "page_no", "page"], "page").select(
        *BATCH, "pos", "alias", F.col("page").alias("file_name"), F.coalesce("text", F.lit("")).alias("text"))
    pages = materialize(pages, "batch-pages")

    told = analyzer(pages)
    if isinstance(told, tuple):  # an analyzer of its own statuses (``call_analyzer``)
        told, statuses = told
    batches = lots.groupBy(*BATCH).agg(F.min("origen").alias("origen"), F.min("tipo_origen").alias("tipo_origen"))
    if statuses is None:
        batches = batches.withColumn("status", F.lit("ok"))
    else:
        batches = batches.join(statuses.select(*BATCH, "status"), BATCH, "left").withColumn(
            "status", F.coalesce("status", F.lit("ok")))
    # Lots from the first exhausted one on are held back, with their files
    first_bad = batches.filter("status = 'exhausted'").agg(F.min("lot_id").alias("_bad"))   # one row

    def open_lots(df):
        return df.crossJoin(F.broadcast(first_bad)).filter(
            F.col("_bad").isNull() | (F.col("lot_id") < F.col("_bad"))).drop("_bad")
    batches, pages = open_lots(batches), open_lots(pages)

    told = materialize(open_lots(told), "documents")
    names = told.select(*BATCH, "doc_idx", F.posexplode("pages").alias("pos_given", "name_given"))
    found = P.resolve_names(names, pages, BATCH).withColumnRenamed("pos", "_pos").join(
        pages.select(*BATCH, F.col("pos").alias("_pos"), "file_name"), [*BATCH, "_pos"])
    real = found.groupBy(*BATCH, "doc_idx").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("pos_given", "file_name"))), lambda x: x["file_name"]).alias("paginas"))
    named = told.drop("pages").join(real, [*BATCH, "doc_idx"])
    whole = pages.groupBy(*BATCH).agg(F.transform(
        F.array_sort(F.collect_list(F.struct("pos", "file_name"))), lambda x: x["file_name"]).alias("paginas"))
    documents = materialize(P.fallback_documents(batches.join(whole, BATCH), named, BATCH), "documents")

    fields = documents.select(*BATCH, "doc_idx", F.col("document_type").alias("categoria"),
                              F.coalesce("client_name", F.lit(C.NOT_DETECTED)).alias("cliente"),
                              F.col("confidence_score").alias("confianza"), F.col("reasoning").alias("justificacion"))
    doc_pages = documents.select(*BATCH, "doc_idx", F.posexplode("paginas").alias("pos", "file_name"))
    doc_folios = documents.select(*BATCH, "doc_idx", F.posexplode("folios").alias("folio_idx", "folio"))
    batch_pages = pages.select(*BATCH, F.col("pos").alias("page_no"), "file_name")
    items = P.full_items(batches, batch_pages, fields, doc_pages, doc_folios, BATCH)

    loose = documents.filter(F.size("folios") == 0).select(
        F.lit("documents").alias("stage"), F.concat_ws("/", *[F.col(c).cast("string") for c in [*BATCH, "doc_idx"]]).alias("key"),
        F.lit("no_folio").alias("reason"), F.lit("its pages count as used").alias("detail"))
    failed = batches.filter("status = 'failed'").select(
        F.lit("analyzer").alias("stage"), F.concat_ws("/", *[F.col(c).cast("string") for c in BATCH]).alias("key"),
        F.lit("failed_batch").alias("reason"), F.col("origen").alias("detail"))
    return Audit(items, open_lots(lots).select("file_name"), failed.unionByName(loose))
