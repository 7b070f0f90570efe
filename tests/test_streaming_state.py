"""Streaming audit across micro-batches, context store, idempotent publish."""

import os

import pytest
from pyspark.sql import functions as F

from folioforge.operators import registry as R
from folioforge.plans.batch_run import AuditPaths, process_batch
from folioforge.sources.state import ContextStore, read_audit_log, log_summary
from folioforge.streaming.stream import items_stream, run_stream

ITEM = ("lot_id int, seq long, folio string, categoria string, cliente string, confianza int, "
        "justificacion string, origen string, tipo_origen string, paginas_original int, "
        "paginas array<struct<path:string,rotation:int>>")


def _batch(spark, rows):
    return spark.createDataFrame(rows, ITEM)


def test_stream_versions_carry_across_batches(spark, tmpdir_):
    src = f"{tmpdir_}/items"
    b1 = _batch(spark, [(0, 1, "A1", "Factura", "X", 80, "r1", "a.pdf", "PDF", 1, [("a_P001.pdf", 0)])])
    b2 = _batch(spark, [(1, 2, "A1", "Factura", "Y", 70, "r2", "b.pdf", "PDF", 1, [("b_P001.pdf", 0)]),
                        (1, 3, "A1", "Factura", "Z", 60, "r3", "a.pdf", "PDF", 1, [("a_P001.pdf", 0)])])
    b1.coalesce(1).write.parquet(f"{src}/p1")
    b2.coalesce(1).write.parquet(f"{src}/p2")
    paths = AuditPaths(f"{tmpdir_}/out")
    stream = items_stream(spark, f"{src}/*", b1.schema, max_files=1)
    q = run_stream(spark, stream, paths, f"{tmpdir_}/ckpt", batch_ts_fn=lambda b: "2026-01-01 00:00:00")
    q.awaitTermination(300)
    reg = {(r.folio, r.archivo_original): r for r in R.current(spark, paths.registry).collect()}
    assert reg[("A1", "a.pdf")].version == 1 and reg[("A1", "b.pdf")].version == 2
    assert reg[("A1", "a.pdf")].confianza_promedio == 80        # the lower score was discarded
    res = spark.read.parquet(paths.results)
    assert res.count() == 2                                      # NUEVO + VERSIONAR, DESCARTAR dropped
    store = ContextStore(spark, paths.context).load()
    assert store["stats"].first().total_documentos_procesados == 2
    reports = sorted(os.listdir(paths.report))
    assert reports and reports[-1].startswith("Auditoria_Integridad_2025123")   # 2026-01-01 UTC in Monterrey
    assert spark.read.option("header", True).csv(f"{paths.report}/{reports[-1]}").count() == 2
    done = {(r.batch, r.file_name) for r in spark.read.parquet(paths.processed).collect()}
    assert done == {(0, "a.pdf"), (1, "a.pdf"), (1, "b.pdf")}    # also the input whose event was discarded


def test_batch_retry_is_idempotent(spark, tmpdir_):
    from folioforge.plans.batch_run import write_cumulative_report
    b = _batch(spark, [(0, 1, "P9", "Remisión", "X", 95, "r", "c.pdf", "PDF", 1, [("c_P001.pdf", 0)])])
    paths = AuditPaths(f"{tmpdir_}/out")
    process_batch(spark, b, paths, "00000001", "2026-01-01 00:00:00", report_every_batch=False)
    process_batch(spark, b, paths, "00000001", "2026-01-01 00:00:00", report_every_batch=False)  # retried
    assert not os.path.exists(paths.report)
    target = write_cumulative_report(spark, paths, "2026-01-01 00:00:00")
    assert spark.read.option("header", True).csv(target).count() == 1
    assert R.current(spark, paths.registry).count() == 1
    assert ContextStore(spark, paths.context).load()["stats"].first().total_documentos_procesados == 1


def test_context_store_missing_and_corrupt(spark, tmpdir_):
    store = ContextStore(spark, f"{tmpdir_}/ctx")
    assert store.load()["prefixes"].count() == 4                 # missing -> seeds
    os.makedirs(f"{tmpdir_}/ctx2")
    with open(f"{tmpdir_}/ctx2/_current", "w") as f:
        f.write("/nonexistent/version\n")
    assert ContextStore(spark, f"{tmpdir_}/ctx2").load()["stats"].first().total_documentos_procesados == 0


OITEM = ITEM + ", is_orphan boolean, orphan_name string"


def _tables(spark, paths):
    """All that a batch stores, as comparable rows."""
    state = ContextStore(spark, paths.context).load()
    out = {"registry": R.current(spark, paths.registry), "results": spark.read.parquet(paths.results),
           "processed": spark.read.parquet(paths.processed), **state}
    return {k: sorted(map(str, df.select(*sorted(df.columns)).collect())) for k, df in out.items()}


def test_retry_after_each_write_equals_a_clean_run(spark, tmpdir_, monkeypatch):
    """A batch that fails after any of its writes and runs again leaves what one run leaves."""
    from folioforge.plans import batch_run as BR
    first = _batch(spark, [(0, 1, "A1", "Factura", "X", 40, "r", "a.pdf", "PDF", 1, [("a_P001.pdf", 0)])])
    second = spark.createDataFrame(
        [(0, 1, "A1", "Factura", "X", 50, "r1", "b.pdf", "PDF", 1, [("b_P001.pdf", 0)], False, None),
         (0, 2, "A 1", "Factura", "Y", 90, "r2", "b.pdf", "PDF", 1, [("b_P002.pdf", 0)], None, None),
         (1, 3, "A1", "Factura", "Z", 45, "r3", "a.pdf", "PDF", 1, [("a_P001.pdf", 0)], False, None),
         (1, 4, "ERROR_DOCUMENTO_ILEGIBLE", "Página Huérfana", "NO DETECTADO", 0, "h", "a.pdf", "PDF", 1,
          [("a_P002.pdf", 0)], True, "HUERFANO_a_P002")], OITEM)

    def run(paths):
        BR.process_batch(spark, second, paths, "b2", "2026-01-02 00:00:00", report_every_batch=False)

    clean = AuditPaths(f"{tmpdir_}/clean")
    BR.process_batch(spark, first, clean, "b1", "2026-01-01 00:00:00", report_every_batch=False)
    run(clean)
    want = _tables(spark, clean)
    strip = lambda t, base: {k: [r.replace(base, "") for r in v] for k, v in t.items()}
    assert sum("Revisión Manual Requerida" in r for r in want["results"]) == 1
    steps = [(BR.R, "write_snapshot"), (BR.R, "point_at"), (BR.ContextStore, "save"), (BR, "mark_processed")]
    for k, (owner, name) in enumerate(steps):
        paths = AuditPaths(f"{tmpdir_}/retry{k}")
        BR.process_batch(spark, first, paths, "b1", "2026-01-01 00:00:00", report_every_batch=False)
        real = getattr(owner, name)

        def fail(*a, _real=real, **b):
            _real(*a, **b)
            raise OSError("lost")
        with monkeypatch.context() as m:
            m.setattr(owner, name, fail)
            with pytest.raises(OSError):
                run(paths)
        run(paths)
        assert strip(_tables(spark, paths), paths.base) == strip(want, clean.base), name


def test_constraint_violation_stores_nothing(spark, tmpdir_):
    paths = AuditPaths(f"{tmpdir_}/out")
    long = "A" + "9" * 120          # folio longer than its column
    bad = _batch(spark, [(0, 1, long, "Factura", "X", 40, "r", "a.pdf", "PDF", 1, [("a_P001.pdf", 0)])])
    with pytest.raises(ValueError, match="length:folio"):
        process_batch(spark, bad, paths, "b1", "2026-01-01 00:00:00")
    assert R.current(spark, paths.registry) is None
    assert not os.path.exists(paths.results) and not os.path.exists(paths.processed)


def test_unreadable_pointer_is_not_an_empty_registry(spark, tmpdir_):
    paths = AuditPaths(f"{tmpdir_}/out")
    item = [(0, 1, "A1", "Factura", "X", 40, "r", "a.pdf", "PDF", 1, [("a_P001.pdf", 0)])]
    process_batch(spark, _batch(spark, item), paths, "b1", "2026-01-01 00:00:00", report_every_batch=False)
    with open(f"{paths.registry}/_current", "w"):
        pass
    for crc in (f"{paths.registry}/._current.crc",):
        if os.path.exists(crc):
            os.remove(crc)
    with pytest.raises(ValueError, match="empty pointer"):
        process_batch(spark, _batch(spark, item), paths, "b2", "2026-01-01 00:00:00", report_every_batch=False)


def test_ledger_lists_input_files(spark, tmpdir_):
    from folioforge.plans.batch_run import pending_files
    paths = AuditPaths(f"{tmpdir_}/out")
    os.makedirs(f"{tmpdir_}/raw")
    for name in ("a.pdf", "b.pdf", "c.jpg", "d.jpg", "late.pdf", "Thumbs.db"):
        with open(f"{tmpdir_}/raw/{name}", "w") as f:
            f.write("x")
    items = _batch(spark, [(0, 1, "A1", "Factura", "X", 40, "r", "a.pdf", "PDF", 1, [("a_P001.pdf", 0)]),
                           (0, 2, "A1", "Factura", "X", 10, "r", "a.pdf", "PDF", 1, [("a_P002.pdf", 0)])])
    files = spark.createDataFrame([("a.pdf",), ("b.pdf",), ("c.jpg",), ("d.jpg",)], "file_name string")
    assert pending_files(spark, f"{tmpdir_}/raw", paths).count() == 5
    process_batch(spark, items, paths, "b1", "2026-01-01 00:00:00", report_every_batch=False, files=files)
    assert [r.file_name for r in pending_files(spark, f"{tmpdir_}/raw", paths).collect()] == ["late.pdf"]


def test_recent_documents_keep_arrival_order_across_batches(spark):
    from folioforge.sources.state import _recent_with_ord
    stored = ContextStore(spark, "/nonexistent").seeds()["recent"]
    for lot, folio in ((9, "A1"), (0, "A2"), (0, "A3"), (0, "A4")):
        rows = spark.createDataFrame([(lot, 1, 0, folio, "Factura", "X")],
                                     "lot_id int, seq long, cat_idx int, folio string, categoria string, cliente string")
        stored = _recent_with_ord(rows, "2026-01-01 00:00:00", stored, 2)
    assert [r.folio for r in stored.orderBy(F.col("_ord").desc()).collect()] == ["A4", "A3"]


def test_audit_log_source(spark, tmpdir_):
    p = f"{tmpdir_}/log.jsonl"
    with open(p, "w") as f:
        f.write('{"timestamp":"2026-01-01T00:00:00","level":"INFO","logger":"x","message":"m","module":"proc",'
                '"function":"run","line":3}\n{"timestamp":"2026-01-01T00:00:01","level":"ERROR","logger":"x",'
                '"message":"e","module":"proc","function":"run","line":4,"exception":"boom"}\n')
    got = {(r.level, r.module): r.n for r in log_summary(read_audit_log(spark, p)).collect()}
    assert got == {("INFO", "proc"): 1, ("ERROR", "proc"): 1}
    assert read_audit_log(spark, p).filter(F.col("exception").isNotNull()).count() == 1


def test_pandas_analyzer_per_batch(spark):
    import pandas as pd

    from folioforge.operators.analyzer import pandas_analyzer

    pages = spark.createDataFrame([(1, 1, "a_P001.pdf"), (1, 2, "a_P002.pdf"), (2, 1, "b_P001.pdf")],
                                  "batch_id int, page_no int, file_name string")

    def one_doc(pdf: pd.DataFrame) -> pd.DataFrame:   # stands for a model call on one batch
        names = list(pdf.sort_values("page_no")["file_name"])
        return pd.DataFrame([{"batch_id": int(pdf["batch_id"].iloc[0]), "doc_idx": 0, "folios": ["A1"],
                              "pages": names, "document_type": "Factura", "client_name": None,
                              "confidence_score": 90, "reasoning": "r", "status": "ok"}])

    out = {r.batch_id: r for r in pandas_analyzer(pages, ["batch_id"], one_doc).collect()}
    assert out[1].pages == ["a_P001.pdf", "a_P002.pdf"] and out[2].pages == ["b_P001.pdf"]


def test_burst_window_splits_at_exact_threshold(spark):
    from folioforge.streaming.stream import burst_window
    secs = [0.0, 2.999999, 5.999998, 8.999998, 20.0]   # gaps: <3, <3, =3 (split), >3 (split)
    df = spark.createDataFrame([(i, s) for i, s in enumerate(secs)], "id int, s double") \
        .withColumn("mtime", F.timestamp_micros(F.round(F.col("s") * 1_000_000).cast("long")))
    sizes = sorted(r.n_files for r in burst_window(df, "mtime", 3.0).collect())
    assert sizes == [1, 1, 3]


def test_stateful_stream_versions_match_batch(spark, tmpdir_):
    import random

    from folioforge.operators.versions import resolve_versions
    from folioforge.streaming.versions_state import OUT_SCHEMA, stream_versions

    rng = random.Random(4)
    rows, seq = [], 0
    for lot in range(6):
        for _ in range(15):
            seq += 1
            rows.append((rng.choice(["A1", "ERR"]), "Factura", rng.choice(["o1", "o2", "o3", "o4"]), lot, seq, 0,
                         rng.randint(0, 100)))
    schema = "folio_key string, cat string, origen string, lot_id int, seq long, cat_idx int, confianza int"
    reg = spark.createDataFrame([("A1", "Factura", "o2", 1, 60), ("A1", "Factura", "o4", 2, None)],
                                "folio_key string, cat string, origen string, version int, score int")
    for lot in range(6):   # one file per lot, streamed in lot order
        spark.createDataFrame([r for r in rows if r[3] == lot], schema).coalesce(1) \
            .write.parquet(f"{tmpdir_}/ev/lot={lot}")
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmpdir_}/ev/lot=*")
    q = (stream_versions(src, reg).writeStream.format("memory").queryName("t3_versions")
         .option("checkpointLocation", f"{tmpdir_}/ckpt").trigger(availableNow=True).start())
    q.awaitTermination(300)
    got = {(r.seq, r.cat_idx): (r.version, r.accion) for r in spark.table("t3_versions").collect()}
    exp_df = resolve_versions(spark.createDataFrame(rows, schema), reg, materialize_events=False)
    exp = {(r.seq, r.cat_idx): (r.version, r.accion) for r in exp_df.collect()}
    assert len(OUT_SCHEMA) == 9 and got == exp


def test_stream_archives_committed_sources(spark, tmpdir_):
    src, arch = f"{tmpdir_}/in", f"{tmpdir_}/archive"
    b1 = _batch(spark, [(0, 1, "A7", "Factura", "X", 90, "r", "a.pdf", "PDF", 1, [("a_P001.pdf", 0)])])
    b2 = _batch(spark, [(1, 2, "R8", "Remisión", "Y", 85, "r", "b.pdf", "PDF", 1, [("b_P001.pdf", 0)])])
    b1.coalesce(1).write.parquet(f"{src}/p1")
    b2.coalesce(1).write.parquet(f"{src}/p2")
    paths = AuditPaths(f"{tmpdir_}/out")
    stream = items_stream(spark, f"{src}/*", b1.schema, max_files=1, archive_dir=arch)
    q = run_stream(spark, stream, paths, f"{tmpdir_}/ckpt", batch_ts_fn=lambda b: "2026-01-01 00:00:00")
    q.awaitTermination(300)
    assert spark.read.parquet(paths.results).count() == 2
    archived = [f for _, _, fs in os.walk(arch) for f in fs if f.endswith(".parquet")]
    assert len(archived) >= 1       # files of committed micro-batches were moved out of the input
