"""Page operators: explode, alias, name resolution, orientation, map stage.

P1 page explode, P2 image as one page, P3 page alias, P4 rotation
composition, P5 orientation answers, P6 assembly manifest, J1 name
resolution, J2 page-instruction semi join, J3 orphan anti join, M1 document
x folio expansion, M2 orphan items, M3 batch page count, G8 fallback
document, J8 fallback outer join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions import strings as S
from ..functions.predicates import valid_rotation
from ..session import spread


def page_name(file_name, page_no, n_pages) -> F.Column:
    """``<stem, ' '->'_'>_P%03d_T%03d.pdf`` (%03d widens past 999)."""
    base = F.regexp_replace(S.stem(file_name), " ", "_")
    return F.format_string("%s_P%03d_T%03d.pdf", base, S.col_(page_no), S.col_(n_pages))


def explode_pages(files: DataFrame, n_pages_col: str = "n_pages", name_col: str = "file_name") -> DataFrame:
    """One row per page of each file; a zero-page file gives no row.

    A narrow operator (no shuffle): ``sequence`` + ``explode`` per file row.
    Images are one-page files (``n_pages`` 1).
    """
    n = F.col(n_pages_col)
    pages = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    return (files.select("*", F.explode(pages).alias("page_no"))
            .withColumn("page_name", page_name(name_col, "page_no", n_pages_col)))


def alias_pages(pages: DataFrame, batch_cols: list[str], order_cols: list[str],
                name_col: str = "page_name") -> DataFrame:
    """``page_%03d<suffix>`` by position in the batch, input order kept.

    The window is partitioned by the inference batch (bounded: one PDF or 15
    images).
    """
    w = Window.partitionBy(*batch_cols).orderBy(*order_cols)
    return (pages.withColumn("pos", F.row_number().over(w))
            .withColumn("alias", F.format_string("page_%03d%s", F.col("pos"), S.suffix(name_col))))


def resolve_names(answers: DataFrame, aliased: DataFrame, batch_cols: list[str],
                  given_col: str = "name_given") -> DataFrame:
    """Model-returned name -> page of the batch.

    Clean (strip, unquote, lower); match on the full alias or on its stem;
    the first alias in page order wins; unmatched answers are dropped.
    Two equi joins (not one OR-condition, which would plan as a nested loop),
    then the first candidate per answer.
    """
    a = (answers.withColumn("_given", F.lower(S.clean_name(given_col)))
         .withColumn("_given_stem", S.stem("_given")))
    p = aliased.select(*batch_cols, "pos", "alias",
                       F.lower("alias").alias("_alias_l"), F.lower(S.stem("alias")).alias("_alias_stem"))
    by_name = a.join(p, [*(a[c] == p[c] for c in batch_cols), a["_given"] == p["_alias_l"]]) \
        .select(a["*"], p["pos"])
    by_stem = a.join(p, [*(a[c] == p[c] for c in batch_cols), a["_given_stem"] == p["_alias_stem"]]) \
        .select(a["*"], p["pos"])
    cand = by_name.unionByName(by_stem)
    keys = [c for c in a.columns if c not in ("_given", "_given_stem")]
    return cand.groupBy(*keys).agg(F.min("pos").alias("pos"))


def orientation(aliased: DataFrame, answers: DataFrame, batch_cols: list[str]) -> DataFrame:
    """P5 + P4 + F3: final rotation of every page of the batch.

    The orientation payload is strict: one invalid rotation rejects the whole
    answer of its batch (no rotation applied there). Otherwise valid,
    resolved answers add up per page: ``pmod(sum(degrees), 360)``; pages with
    no answer keep rotation 0.
    """
    bad = answers.groupBy(*batch_cols).agg(
        F.max(F.when(valid_rotation("rotation_degrees"), 0).otherwise(1)).alias("_bad"))
    ok_answers = answers.join(bad.filter("_bad = 0").select(*batch_cols), batch_cols, "left_semi")
    resolved = resolve_names(ok_answers, aliased, batch_cols)
    turns = resolved.groupBy(*batch_cols, "pos").agg(F.sum("rotation_degrees").alias("_deg"))
    return (aliased.join(turns, [*batch_cols, "pos"], "left")
            .withColumn("rotation", F.pmod(F.coalesce("_deg", F.lit(0)), F.lit(360)).cast("int"))
            .drop("_deg"))


def compose_rotation(current, degrees) -> F.Column:
    """``(current + degrees) % 360``; 0 is a no-op."""
    return F.pmod(S.col_(current) + S.col_(degrees), F.lit(360))


def map_documents(batch_pages: DataFrame, doc_pages: DataFrame, doc_folios: DataFrame,
                  batch_cols: list[str]) -> tuple[DataFrame, DataFrame]:
    """J2 + M1 + M3 + J3 + M2: documents -> (items, orphan items).

    ``batch_pages``: batch cols, page_no, file_name (real page names).
    ``doc_pages``: batch cols, doc_idx, pos, file_name (as the model named them).
    ``doc_folios``: batch cols, doc_idx, folio_idx, folio.
    Instructions whose cleaned name is not a page of the batch are dropped;
    a document left with no page is dropped; a document with no folio gives
    no item but its pages still count as used.
    """
    count = batch_pages.groupBy(*batch_cols).agg(F.count(F.lit(1)).cast("int").alias("paginas_original"))
    instr = doc_pages.withColumn("_clean", S.clean_name("file_name")).drop("file_name")
    bp = batch_pages.select(*batch_cols, "page_no", "file_name")
    matched = instr.join(bp, [*(instr[c] == bp[c] for c in batch_cols), instr["_clean"] == bp["file_name"]]) \
        .select(*[instr[c] for c in batch_cols], "doc_idx", "pos", bp["page_no"], bp["file_name"])
    docs = matched.groupBy(*batch_cols, "doc_idx").agg(
        F.array_sort(F.collect_list(F.struct("pos", "page_no", "file_name"))).alias("_pages"))
    docs = docs.select(*batch_cols, "doc_idx",
                       F.transform("_pages", lambda x: F.struct(x["file_name"].alias("path"),
                                                                F.lit(0).alias("rotation"))).alias("paginas"))
    items = (docs.join(doc_folios, [*batch_cols, "doc_idx"])
             .join(count, batch_cols)
             .withColumn("is_orphan", F.lit(False)))
    used = matched.select(*batch_cols, "file_name").distinct()
    orphans = (bp.join(used, [*batch_cols, "file_name"], "left_anti")
               .join(count, batch_cols)
               .select(*batch_cols, "page_no", "file_name",
                       F.lit(C.ERROR_ILLEGIBLE).alias("folio"),
                       F.lit(C.ORPHAN_CATEGORY_ITEM).alias("categoria"),
                       F.lit(C.NOT_DETECTED).alias("cliente"),
                       F.lit(0).alias("confianza"),
                       F.lit(C.ORPHAN_REASON).alias("justificacion"),
                       F.concat(F.lit(C.ORPHAN_PREFIX), S.stem("file_name")).alias("orphan_name"),
                       F.array(F.struct(F.col("file_name").alias("path"), F.lit(0).alias("rotation"))).alias("paginas"),
                       F.lit(True).alias("is_orphan"), "paginas_original"))
    return items, orphans


def full_items(batches: DataFrame, batch_pages: DataFrame, documents: DataFrame, doc_pages: DataFrame,
               doc_folios: DataFrame, batch_cols: list[str]) -> DataFrame:
    """M1 + M2 with every field of the document and the batch: the items that
    ``reduce_items`` and the orphan rows take unchanged.

    ``batches``: batch cols, lot_id, origen, tipo_origen. ``documents``: batch
    cols, doc_idx, categoria, cliente, confianza, justificacion. The others as
    in ``map_documents``. ``seq`` numbers the items of a lot by origin, batch,
    document and folio, orphans behind their batch's documents; a lot is bounded.

    Plan: each input is shuffled once, by the batch (bounded: one PDF or 15 images),
    and what is made of them once, by the lot. One left join of the pages tells both
    the documents' pages and the orphans, which go on as documents of one page and no
    fields. What all orphans share is filled in behind the shuffle.
    """
    def by_batch(df, *columns):
        return spread(df.select(*batch_cols, *columns).dropna(subset=batch_cols), *batch_cols)

    batch = Window.partitionBy(*batch_cols).orderBy("file_name")
    pages = by_batch(batch_pages, "page_no", "file_name").select(
        "*", F.count(F.lit(1)).over(batch.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        .cast("int").alias("paginas_original"), F.row_number().over(batch).alias("_nth"))
    told = by_batch(doc_pages, "doc_idx", "pos", S.clean_name("file_name").alias("file_name"), F.lit(True).alias("_told"))
    pages = pages.join(told, [*batch_cols, "file_name"], "left") \
        .withColumn("_loose", F.when(F.col("_told").isNull(), F.col("_nth")))
    doc = Window.partitionBy(*batch_cols, "doc_idx", "_loose").orderBy("pos", "page_no", "file_name")
    docs = pages.select(
        *batch_cols, "doc_idx", "_loose", "page_no", "file_name", "paginas_original", F.row_number().over(doc).alias("_at"),
        F.collect_list(F.struct(F.col("file_name").alias("path"), F.lit(0).alias("rotation")))
        .over(doc.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("paginas")).filter("_at = 1")
    key = [*batch_cols, "doc_idx"]
    folios = by_batch(doc_folios, "doc_idx", "folio_idx", "folio", F.lit(True).alias("_folio"))
    fields = by_batch(documents, "doc_idx", "categoria", "cliente", "confianza", "justificacion", F.lit(True).alias("_fields"))
    loose = F.col("_loose").isNotNull()
    items = docs.join(folios, key, "left").join(fields, key, "left").filter(loose | (F.col("_folio") & F.col("_fields")))

    # a document number that no document has, behind them all
    items = items.select(
        *batch_cols, F.when(loose, F.lit(2 ** 62)).otherwise(F.col("doc_idx").cast("bigint")).alias("doc_idx"),
        F.when(loose, F.col("page_no").cast("bigint")).otherwise(F.col("folio_idx").cast("bigint")).alias("folio_idx"),
        "folio", "categoria", "cliente", "confianza", "justificacion", "paginas", "paginas_original", loose.alias("is_orphan"))
    of_batch = [c for c in ("lot_id", "origen", "tipo_origen") if c not in batch_cols]
    items = spread(items.join(by_batch(batches, *of_batch), batch_cols), "lot_id")
    lot = Window.partitionBy("lot_id").orderBy("origen", *batch_cols, "doc_idx", "folio_idx")
    items = items.withColumn("seq", F.row_number().over(lot).cast("bigint"))

    def filled(name, value):
        return F.when(F.col("is_orphan"), value).otherwise(F.col(name)).alias(name)

    orphan_name = F.concat(F.lit(C.ORPHAN_PREFIX), S.stem(F.col("paginas")[0]["path"]))
    return items.select(
        *batch_cols, filled("folio", F.lit(C.ERROR_ILLEGIBLE)), filled("categoria", F.lit(C.ORPHAN_CATEGORY_ITEM)),
        filled("cliente", F.lit(C.NOT_DETECTED)), filled("confianza", F.lit(0)),
        filled("justificacion", F.lit(C.ORPHAN_REASON)), "paginas", "paginas_original", "is_orphan",
        F.when(F.col("is_orphan"), orphan_name).alias("orphan_name"), *of_batch, "seq")


def fallback_documents(batches: DataFrame, documents: DataFrame, batch_cols: list[str]) -> DataFrame:
    """J8 + G8: a batch whose analysis failed still yields one document with all
    its pages, folio ERROR_DOCUMENTO_ILEGIBLE.

    ``batches``: batch cols + ``paginas`` (all real page names, in order) and,
    when the analyzer tells it, ``status``: then exactly the batches of status
    ``failed`` get the fallback, and an ``ok`` batch without documents leaves its
    pages to become orphans. Without ``status`` a batch without documents counts
    as failed. ``documents``: batch cols + the logical-document columns.
    """
    if "status" in batches.columns:
        failed = batches.filter(F.col("status") == "failed")
        documents = documents.join(failed.select(*batch_cols), batch_cols, "left_anti")
    else:
        failed = batches.join(documents.select(*batch_cols).distinct(), batch_cols, "left_anti")
    fb = failed.select(*batch_cols, F.lit(0).cast("long").alias("doc_idx"),
                       F.array(F.lit(C.ERROR_ILLEGIBLE)).alias("folios"),
                       "paginas",
                       F.lit(C.NOT_IDENTIFIED).alias("document_type"),
                       F.lit(None).cast("string").alias("client_name"),
                       F.lit(0).alias("confidence_score"),
                       F.lit(C.FALLBACK_REASON).alias("reasoning"),
                       F.lit(True).alias("is_fallback"))
    return documents.unionByName(fb, allowMissingColumns=True)


def pages_text(pages_col) -> F.Column:
    """Ordered page list flattened to text ``path:rotation,...`` (for manifests/reports)."""
    return F.array_join(F.transform(S.col_(pages_col),
                                    lambda p: F.concat(p["path"], F.lit(":"), p["rotation"].cast("string"))), ",")


def assembly_manifest(versioned_with_pages: DataFrame) -> DataFrame:
    """P6 + V2: one manifest per output route; the last writer of a route wins.

    Input: non-discarded events with ``ruta``, ``paginas``, ordered by
    (lot_id, seq, cat_idx); the last writer per route is an aggregate, so a
    route written from many lots (one image origin) is not one window.
    """
    from .scans import last_per_key
    last = last_per_key(versioned_with_pages.select("ruta", "origen", "lot_id", "seq", "cat_idx", "paginas"),
                        ["ruta"], ["lot_id", "seq", "cat_idx"])
    return last.select("ruta", "origen", "lot_id", "seq", "cat_idx",
                       F.size("paginas").alias("n_pages"), pages_text("paginas").alias("paginas"))
