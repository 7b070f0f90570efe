"""Files to stored results: routing, lots, pages, analyzer, items, orphans, registry, ledger."""

import pytest
from pyspark.sql import functions as F

from folioforge.config import AuditOptions
from folioforge.operators import registry as R
from folioforge.plans.batch_run import AuditPaths, process_batch
from folioforge.plans.end_to_end import BATCH, audit_from_files

OPTIONS = AuditOptions(pdf_chunk_max_pages=10, physical_chunk_size=3, vision_batch_size=2)


@pytest.fixture()
def listing(spark):
    files = [("a.pdf", 0, 3), ("b b.pdf", 0, 9), ("c.pdf", 0, 1), ("broken.pdf", 0, None), ("z.pdf", 0, 2), ("notes.txt", 0, None),
             ("Thumbs.db", 0, None), ("i1.jpg", 100, None), ("i2.jpg", 101, None), ("i3.png", 102, None), ("i4.png", 103, None)]
    files = spark.createDataFrame(files, "file_name string, s long, n_pages int").withColumn(
        "mtime", F.timestamp_seconds("s")).drop("s")
    texts = spark.createDataFrame(
        [("a.pdf", 1, "FACTURA\nFolio: A1, Folio: A2\nCliente: Villas SA"), ("a.pdf", 2, "hoja"), ("a.pdf", 3, "Sello digital"),
         ("b b.pdf", 1, "nada"), ("c.pdf", 1, "FACTURA Folio: A1\nSello digital"), ("z.pdf", 1, "FACTURA Folio: R9\nSello digital"),
         ("i1.jpg", 1, "FACTURA Folio: A7\nCliente: Norte"), ("i2.jpg", 1, "Sello digital"), ("i3.png", 1, "FACTURA sin numero\nSello digital"),
         ("i4.png", 1, "suelta")], "file_name string, page_no int, text string")
    return files, texts


def items_of(audit):
    return {(r.lot_id, r.batch_no, r.folio, r.paginas[0].path): r for r in audit.items.collect()}


def test_files_to_stored_results(spark, listing, tmpdir_):
    audit = audit_from_files(*listing, options=OPTIONS)
    items = items_of(audit)
    # lots of PDFs by name and pages: a.pdf | b b.pdf, c.pdf | z.pdf; the images' lot is behind them
    first = items[0, 1, "A1", "a_P001_T003.pdf"]
    assert (first.categoria, first.cliente, first.confianza, first.origen, first.paginas_original) == ("Factura", "Villas SA", 90, "a.pdf", 3)
    assert [p.path for p in first.paginas] == ["a_P001_T003.pdf", "a_P002_T003.pdf", "a_P003_T003.pdf"]
    assert (0, 1, "A2", "a_P001_T003.pdf") in items
    assert items[1, 2, "A1", "c_P001_T001.pdf"].origen == "c.pdf"
    assert sum(r.is_orphan for k, r in items.items() if k[:2] == (1, 1)) == 9          # nothing found on b b.pdf
    image = items[3, 0, "A7", "i1_P001_T001.pdf"]
    assert image.origen == "LOTE_FOTOGRAFICO_CONSOLIDADO" and image.paginas_original == 2
    assert items[3, 1, "ERROR_DOCUMENTO_ILEGIBLE", "i4_P001_T001.pdf"].orphan_name == "HUERFANO_i4_P001_T001"
    assert not any(k[3].startswith("i3") for k in items)                               # no folio: pages used, no item
    assert {(r.reason, r.key) for r in audit.rejects.collect()} == {
        ("unreadable_file", "broken.pdf"), ("unrouted_file", "notes.txt"), ("no_folio", "3/1/1")}

    paths = AuditPaths(f"{tmpdir_}/out")
    results = process_batch(spark, audit.items, paths, "b1", "2026-01-01 00:00:00", report_every_batch=False, files=audit.files)
    got = {(r.folio, r.archivo_original): (r.version, r.status) for r in results.collect()}
    assert got["A1", "a.pdf"] == (1, "OK") and got["A1", "c.pdf"] == (2, "OK") and got["A7", "LOTE_FOTOGRAFICO_CONSOLIDADO"] == (1, "OK")
    # nine pages of b b.pdf, the page of z.pdf behind its closed document, i4
    assert results.filter("categoria = 'Revisión Manual Requerida'").count() == 11
    assert R.current(spark, paths.registry).filter("folio = 'A1'").count() == 2
    done = {r.file_name for r in spark.read.parquet(paths.processed).collect()}
    assert done == {"a.pdf", "b b.pdf", "c.pdf", "z.pdf", "i1.jpg", "i2.jpg", "i3.png", "i4.png"}


def test_failed_and_exhausted_batches(spark, listing):
    statuses = spark.createDataFrame([(0, 1, "failed"), (2, 1, "exhausted")], "lot_id long, batch_no long, status string")
    audit = audit_from_files(*listing, statuses=statuses, options=OPTIONS)
    items = items_of(audit)
    assert {k[:2] for k in items} == {(0, 1), (1, 1), (1, 2)}                           # lot 2 and all later are held back
    (fallback,) = [r for k, r in items.items() if k[:2] == (0, 1)]
    assert fallback.folio == "ERROR_DOCUMENTO_ILEGIBLE" and len(fallback.paginas) == 3 and fallback.confianza == 0
    assert {r.file_name for r in audit.files.collect()} == {"a.pdf", "b b.pdf", "c.pdf"}
    assert "failed_batch" in {r.reason for r in audit.rejects.collect()}


def test_own_analyzer_with_names_as_a_model_gives_them(spark, listing):
    def analyzer(pages):
        one = pages.groupBy(*BATCH).agg(F.min("pos").alias("doc_idx"))
        return one.select(*BATCH, F.col("doc_idx").cast("bigint").alias("doc_idx"), F.array(F.lit("X 1")).alias("folios"),
                          F.array(F.lit(' "PAGE_001" '), F.lit("page_777.pdf")).alias("pages"), F.lit("Pedido").alias("document_type"),
                          F.lit(None).cast("string").alias("client_name"), F.lit(70).alias("confidence_score"), F.lit("m").alias("reasoning"))
    items = items_of(audit_from_files(*listing, analyzer=analyzer, options=OPTIONS))
    own = items[0, 1, "X 1", "a_P001_T003.pdf"]
    assert len(own.paginas) == 1 and own.cliente == "NO DETECTADO" and not own.is_orphan
    assert items[0, 1, "ERROR_DOCUMENTO_ILEGIBLE", "a_P002_T003.pdf"].is_orphan
