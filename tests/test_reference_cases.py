"""The original test cases, restated as tiny tables."""

import io
import os
import zipfile

from pyspark.sql import functions as F

from folioforge import config as C
from folioforge.operators import analyzer as AN
from folioforge.operators import context as CX
from folioforge.operators import pages as P
from folioforge.operators import payloads as PV
from folioforge.operators import registry as R
from folioforge.operators import report as RP
from folioforge.operators.reduce import reduce_items
from folioforge.operators.results import assemble_results
from folioforge.operators.versions import resolve_versions
from folioforge.sources import archives as AR

ITEM = ("lot_id int, seq long, folio string, categoria string, cliente string, confianza int, "
        "justificacion string, origen string, tipo_origen string, paginas_original int, "
        "paginas array<struct<path:string,rotation:int>>")


def _items(spark, rows):
    return spark.createDataFrame(rows, ITEM)


def _one(spark, key, cat, origin, conf, reg_rows):
    ev = spark.createDataFrame([(key, cat, origin, 0, 1, 0, conf)],
                               "folio_key string, cat string, origen string, lot_id int, seq long, cat_idx int, "
                               "confianza int")
    reg = spark.createDataFrame(reg_rows, "folio_key string, cat string, origen string, version int, score int")
    r = resolve_versions(ev, reg).first()
    return r.version, r.accion


def test_version_rules(spark):
    assert _one(spark, "A1", "Factura", "a.pdf", 90, []) == (1, "NUEVO")
    assert _one(spark, "A1", "Factura", "a.pdf", 90, [("A1", "Factura", "a.pdf", 1, 50)]) == (1, "SOBRESCRIBIR")
    assert _one(spark, "A1", "Factura", "a.pdf", 50, [("A1", "Factura", "a.pdf", 1, 90)]) == (1, "DESCARTAR")
    assert _one(spark, "A1", "Factura", "b.pdf", 50, [("A1", "Factura", "a.pdf", 1, 90)]) == (2, "VERSIONAR")
    assert _one(spark, "A1", "Factura", "a.pdf", 90, [("A1", "Factura", "a.pdf", 1, None)]) == (1, "SOBRESCRIBIR")
    # category isolation: a Remisión row does not version a Factura
    assert _one(spark, "A1", "Factura", "b.pdf", 50, [("A1", "Remisión", "a.pdf", 1, 90)]) == (1, "NUEVO")


def test_pdf_to_result_with_version(spark):
    items = _items(spark, [(0, 1, "A12052", "Factura", "Cliente A", 95, "ok", "factura_multiple.pdf", "PDF", 1,
                            [("factura_multiple_P001_T001.pdf", 0)])])
    res = assemble_results(reduce_items(items)).collect()
    assert len(res) == 1
    r = res[0]
    assert (r.folio, r.categoria, r.version, r.status, r.ruta) == ("A12052", "Factura", 1, "OK", "Factura/A12052.pdf")


def test_orphan_gives_second_row(spark):
    bp = spark.createDataFrame([(1, 1, "doc_P001.pdf"), (1, 2, "doc_P002.pdf")], "batch_id int, page_no int, file_name string")
    dp = spark.createDataFrame([(1, 0, 0, "doc_P001.pdf")], "batch_id int, doc_idx int, pos int, file_name string")
    df = spark.createDataFrame([(1, 0, 0, "FOLIO_VALIDO")], "batch_id int, doc_idx int, folio_idx int, folio string")
    items, orphans = P.map_documents(bp, dp, df, ["batch_id"])
    assert items.count() == 1 and orphans.count() == 1
    o = orphans.first()
    assert o.orphan_name == "HUERFANO_doc_P002" and o.folio == C.ERROR_ILLEGIBLE
    orphan_rows = orphans.select(F.lit(0).alias("lot_id"), F.col("page_no").cast("long").alias("seq"),
                                 F.lit("doc.pdf").alias("origen"), "orphan_name", "justificacion")
    it = items.select(F.lit(0).alias("lot_id"), F.lit(1).cast("long").alias("seq"), "folio",
                      F.lit("Factura").alias("categoria"), F.lit("Cliente B").alias("cliente"),
                      F.lit(90).alias("confianza"), F.lit("x").alias("justificacion"), F.lit("doc.pdf").alias("origen"),
                      F.lit("PDF").alias("tipo_origen"), "paginas_original", "paginas")
    res = assemble_results(reduce_items(it), orphans=orphan_rows).collect()
    assert len(res) == 2
    valid = [r for r in res if r.folio == "FOLIO_VALIDO"][0]
    assert valid.paginas_final == 1
    orphan = [r for r in res if r.folio != "FOLIO_VALIDO"][0]
    assert orphan.ruta == "Revision_Manual_Requerida/HUERFANO_doc_P002.pdf" and orphan.status == "REVISIÓN MANUAL"


def test_discard_gives_no_row(spark):
    items = _items(spark, [(0, 1, "FOLIO_DUPLICADO", "Factura", "C", 40, "x", "dup.pdf", "PDF", 1, [("p1.pdf", 0)])])
    reg = spark.createDataFrame([("FOLIO_DUPLICADO", "Factura", "dup.pdf", 1, 90)],
                                "folio_key string, cat string, origen string, version int, score int")
    assert assemble_results(reduce_items(items), reg).count() == 0


def test_images_from_two_batches_merge(spark):
    o = C.IMAGE_ORIGIN
    items = _items(spark, [
        (0, 1, "FOLIO_IMG", "Ticket", "N/A", 95, "Parte 1.", o, C.ORIGIN_TYPE_IMAGES, 2, [("img_0.pdf", 0), ("img_1.pdf", 0)]),
        (0, 2, "FOLIO_IMG", "Ticket", "N/A", 95, "Parte 2.", o, C.ORIGIN_TYPE_IMAGES, 1, [("img_2.pdf", 0)]),
    ])
    res = assemble_results(reduce_items(items)).collect()
    assert len(res) == 1 and res[0].paginas_final == 3
    assert res[0].justificacion == "Parte 1. | Parte 2."


def test_multiplex_and_path_guard(spark):
    items = _items(spark, [
        (0, 1, "A 1", "Factura, Remisión", None, 99, "x", "s.pdf", "PDF", 1, [("p.pdf", 0)]),
        (0, 2, "B/2", "Orden/compra", "NO DETECTADO", 70, "y", "s.pdf", "PDF", 1, [("q.pdf", 0)]),
        (0, 3, "##", " , ", "Zeta", 10, "z", "s.pdf", "PDF", 1, [("r.pdf", 0)]),
    ])
    res = {(r.folio, r.categoria): r for r in assemble_results(reduce_items(items)).collect()}
    assert res[("A 1", "Factura")].ruta == "Factura/A1.pdf" and res[("A 1", "Remisión")].ruta == "Remisión/A1.pdf"
    err = res[("B/2", "Orden/compra")]
    assert err.status == "ERROR_ENSAMBLAJE" and err.ruta.startswith("ERROR_ENSAMBLAJE/B2_") and err.tipo_original is None
    none = res[("##", "No_identificado")]
    assert none.ruta == "No_identificado/ERROR_FORMATO_INVALIDO.pdf" and none.cliente == "Zeta"


def test_payload_rules(spark):
    rows = [(1, '{"file_name":"a.pdf","rotation_degrees":90,"role":"INICIO","confidence_score":95}'),
            (2, '{"file_name":"a.pdf","rotation_degrees":90,"role":"PORTADA","confidence_score":95}'),
            (3, '{"file_name":"a.pdf","rotation_degrees":90,"role":"INICIO","confidence_score":105}'),
            (4, '{"file_name":"a.pdf","rotation_degrees":"90","role":"INICIO","confidence_score":95}'),
            (5, '{"file_name":"a.pdf","rotation_degrees":45,"role":"INICIO","confidence_score":95}'),
            (6, '{mal')]
    df = spark.createDataFrame(rows, "payload_id int, body string")
    got = {r.payload_id: r.reason for r in PV.validate_payloads(df).collect()}
    assert got == {1: None, 2: "role", 3: "confidence", 4: "type:rotation_degrees", 5: "rotation", 6: "malformed"}


def test_page_names_and_rotation(spark):
    files = spark.createDataFrame([("test doc.pdf", 2), ("empty.pdf", 0)], "file_name string, n_pages int")
    names = [r.page_name for r in P.explode_pages(files).orderBy("page_no").collect()]
    assert names == ["test_doc_P001_T002.pdf", "test_doc_P002_T002.pdf"]
    r = spark.range(1).select(P.compose_rotation(F.lit(270), F.lit(180)).alias("a"),
                              P.compose_rotation(F.lit(90), F.lit(0)).alias("b")).first()
    assert (r.a, r.b) == (90, 90)


def test_orientation_applied_and_strict(spark):
    pages = spark.createDataFrame([(1, 1, "x_P001.pdf"), (1, 2, "x_P002.pdf"), (2, 1, "y_P001.pdf")],
                                  "batch_id int, page_no int, file_name string")
    aliased = P.alias_pages(pages, ["batch_id"], ["page_no"], name_col="file_name")
    ans = spark.createDataFrame([(1, 1, ' "PAGE_002" ', 90), (1, 2, "page_002.pdf", 180),
                                 (1, 3, "page_009.pdf", 90), (2, 1, "page_001.pdf", 45)],
                                "batch_id int, ord int, name_given string, rotation_degrees int")
    got = {(r.batch_id, r.page_no): r.rotation for r in P.orientation(aliased, ans, ["batch_id"]).collect()}
    assert got == {(1, 1): 0, (1, 2): 270, (2, 1): 0}   # batch 2 has an invalid answer: none applied


def test_exhaustion_drops_lot_and_later(spark):
    docs = spark.createDataFrame([(0, "ok"), (1, "failed"), (2, "exhausted"), (3, "ok")], "lot_id int, status string")
    assert sorted(r.lot_id for r in AN.gate_failed_lots(docs).collect()) == [0, 1]


def test_context_update(spark):
    res = spark.createDataFrame([(0, 1, 0, "A12052", "Factura", "VILLAS")],
                                "lot_id int, seq long, cat_idx int, folio string, categoria string, cliente string")
    st = CX.stats(res, CX.seed_stats(spark)).first()
    assert (st.total_documentos_procesados, st.total_folios_extraidos, st.total_no_detectados) == (1, 1, 0)
    pre = {r.prefix: r for r in CX.prefixes(res, CX.seed_prefixes(spark)).collect()}
    assert pre["A"].tipo_asociado == "Factura" and pre["A"].frecuencia == 1
    assert [r.cliente for r in CX.clients(res).collect()] == ["VILLAS"]


def test_report_fills_missing_columns(spark):
    res = spark.createDataFrame([("F1", "Factura", "c.pdf", "OK")], "folio string, categoria string, archivo_original string, status string")
    row = RP.report(res).first().asDict()
    assert list(row) == C.REPORT_COLUMNS
    assert row["Folio"] == "F1" and row["Cliente"] == "N/A" and row["Justificación"] == "N/A"


def test_upsert_dedup_and_update(spark):
    stored = R.registry_from_keys(spark.createDataFrame([("A1", "Factura", "a.pdf", 1, 50)],
                                                        "folio_key string, cat string, origen string, version int, score int"),
                                  "2025-01-01 00:00:00")
    res = spark.createDataFrame(
        [(0, 1, 0, "A1", "A1", 1, "Factura", "X", "a.pdf", 1, "OK", 91, "Factura/A1.pdf"),
         (0, 2, 0, "A1", "A1", 1, "Factura", "Y", "a.pdf", 2, "OK", 95, "Factura/A1.pdf"),
         (0, 3, 0, "B2", "B2", 1, "Remisión", "Z", "b.pdf", 1, "OK", 99, "Remisión/B2.pdf")],
        "lot_id int, seq long, cat_idx int, folio string, folio_key string, version int, categoria string, "
        "cliente string, archivo_original string, paginas_final int, status string, confianza int, ruta string")
    out = {r.folio: r for r in R.upsert(stored, res, "2026-01-01 00:00:00").collect()}
    assert out["A1"].cliente == "Y" and out["A1"].confianza_promedio == 95          # last wins, updated
    assert out["A1"].fecha_procesamiento.year == 2025                              # not touched on conflict
    assert out["B2"].estado_conciliacion == "PENDIENTE" and out["B2"].fecha_procesamiento.year == 2026
    assert R.constraint_violations(R.upsert(stored, res, "2026-01-01 00:00:00")).count() == 0


def test_archive_flatten(spark, tmpdir_):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as zf:
        for name in ["a/b/doc.pdf", "a/c/doc.pdf", "__MACOSX/._doc.pdf", "x/", "~tmp.pdf", "note.txt", "IMG.JPEG"]:
            if not name.endswith("/"):
                zf.writestr(name, b"%PDF")
    os.makedirs(f"{tmpdir_}/in")
    with open(f"{tmpdir_}/in/one.zip", "wb") as f:
        f.write(buf.getvalue())
    with open(f"{tmpdir_}/in/bad.zip", "wb") as f:
        f.write(b"not a zip")
    members = AR.archive_members(AR.read_archives(spark, f"{tmpdir_}/in"))
    assert members.filter(F.col("error").isNotNull()).count() == 1
    kept = AR.member_flags(members.filter(F.col("error").isNull())).filter("keep")
    flat = sorted(r.flat_name for r in AR.flat_names(kept).collect())
    assert len(flat) == 3 and "IMG.JPEG" in flat and "doc.pdf" in flat
    assert any(n.startswith("doc_") and n.endswith(".pdf") and len(n) == len("doc_123456.pdf") for n in flat)


def test_surviving_document_is_last_writer(spark):
    from folioforge.operators.versions import surviving
    ev = spark.createDataFrame(
        [("A1", "Factura", "a.pdf", 1, 0, 1, 0, "SOBRESCRIBIR", "p1"), ("A1", "Factura", "a.pdf", 1, 1, 5, 0, "SOBRESCRIBIR", "p2"),
         ("A1", "Factura", "a.pdf", 1, 2, 9, 0, "DESCARTAR", "p3"), ("A1", "Factura", "b.pdf", 2, 0, 3, 0, "VERSIONAR", "p4")],
        "folio_key string, cat string, origen string, version int, lot_id int, seq long, cat_idx int, accion string, "
        "payload string")
    got = {(r.origen, r.version): r.payload for r in surviving(ev).collect()}
    assert got == {("a.pdf", 1): "p2", ("b.pdf", 2): "p4"}


def test_lots_are_semantic_unless_global_scope(spark):
    o = C.IMAGE_ORIGIN
    items = _items(spark, [(0, 1, "F1", "Ticket", "N", 90, "a", o, C.ORIGIN_TYPE_IMAGES, 2, [("i0.pdf", 0)]),
                           (3, 9, "F1", "Ticket", "N", 95, "b", o, C.ORIGIN_TYPE_IMAGES, 1, [("i1.pdf", 0)])])
    assert sorted((r.lot_id, r.paginas_final) for r in reduce_items(items).collect()) == [(0, 1), (3, 1)]
    merged = reduce_items(items, scope="global").collect()
    assert [(r.lot_id, r.paginas_final, r.justificacion) for r in merged] == [(0, 2, "a | b")]


def test_nested_payload_cases(spark):
    import json

    from folioforge.operators import payloads as PL
    doc = {"folios": ["A-100"], "page_roles": [{"file_name": "page_001.pdf", "role": "INICIO", "evidence": "e"}],
           "ordered_file_names": ["page_001.pdf"], "document_type": "Factura", "client_name": "Empresa X",
           "confidence_score": 95, "reasoning": "r"}
    role = doc["page_roles"][0]
    cases = [({"documents": [doc]}, []), ({"documents": [{k: v for k, v in doc.items() if k != "client_name"}]}, []),
             ({"documents": []}, []), ({"documents": [doc, doc | {"confidence_score": 105}]}, ["documents[1].confidence_score:value"]),
             ({"documents": [doc | {"page_roles": [role, role | {"role": "PORTADA"}]}]}, ["documents[0].page_roles[1].role:value"]),
             ({"documents": [doc | {"folios": "A1", "confidence_score": "95"}]}, ["documents[0].confidence_score:type", "documents[0].folios:type"]),
             ({}, ["documents:missing"]), (None, ["payload:type"])]
    rows = [(i, json.dumps(b)) for i, (b, _) in enumerate(cases)] + [(98, "{bad"), (99, None)]
    got = {r.payload_id: r for r in PL.validate_response(spark.createDataFrame(rows, "payload_id int, body string")).collect()}
    for i, (_, want) in enumerate(cases):
        assert got[i].problems == want and got[i].valid == (not want)
    assert got[0].parsed.documents[0].page_roles[0].role == "INICIO" and got[3].parsed is None
    assert got[98].problems == got[99].problems == ["payload:malformed"]
    turn = PL.validate_response(spark.createDataFrame(
        [(1, '{"orientations":[{"file_name":"a","rotation_degrees":90,"reasoning":"r"}]}'),
         (2, '{"orientations":[{"file_name":"a","rotation_degrees":45,"reasoning":"r"},{"file_name":"b","rotation_degrees":"90","reasoning":"r"}]}')],
        "payload_id int, body string"), PL.ORIENTATION, PL.ORIENTATION_TYPE)
    assert {r.payload_id: r.problems for r in turn.collect()} == {
        1: [], 2: ["orientations[0].rotation_degrees:value", "orientations[1].rotation_degrees:type"]}
    assert PL.response_rejects(turn, "payload_id", "orientation").count() == 2


def test_fallback_follows_the_status(spark):
    from folioforge.operators.pages import fallback_documents
    batches = spark.createDataFrame([(1, ["a"], "ok"), (2, ["b"], "failed"), (3, ["c"], "ok"), (4, ["d"], "exhausted")],
                                    "batch_id int, paginas array<string>, status string")
    docs = spark.createDataFrame([(1, 0, ["A1"], ["a"], "Factura", "X", 90, "r"), (2, 0, ["Z"], ["b"], "Otro", None, 1, "partial")],
                                 "batch_id int, doc_idx long, folios array<string>, paginas array<string>, document_type string, "
                                 "client_name string, confidence_score int, reasoning string")
    out = {r.batch_id: (r.folios, r.is_fallback) for r in fallback_documents(batches, docs, ["batch_id"]).collect()}
    assert out == {1: (["A1"], None), 2: (["ERROR_DOCUMENTO_ILEGIBLE"], True)}


def test_image_lots_follow_pdf_lots(spark):
    from folioforge.sources.raw_files import number_lots
    rows = [("pdf", 0), ("pdf", 1), ("image", 0), ("image", 1)]
    assert {(r.kind, r.lot_no): r.lot_id for r in number_lots(spark.createDataFrame(rows, "kind string, lot_no long")).collect()} == {
        ("pdf", 0): 0, ("pdf", 1): 1, ("image", 0): 2, ("image", 1): 3}
    assert [r.lot_id for r in number_lots(spark.createDataFrame(rows[2:], "kind string, lot_no long")).orderBy("lot_no").collect()] == [0, 1]


def test_rule_analyzer_reads_all_folios_and_the_rfc(spark):
    from folioforge.operators.analyzer import rule_analyzer
    pages = [("o", 1, "FACTURA\nFolio: A1 y Folio: R-2\nRFC: ABC010203XY1"), ("o", 2, "Folio: A1, folio #A3"),
             ("o", 3, "Sello digital Total(MXN)"), ("o", 4, "FACTURA sin datos\nCliente: Villas SA, Norte\nRFC: ABC010203XY1\nSello digital"),
             ("q", 1, "FACTURA\nNota: R-77\nSello digital")]
    df = spark.createDataFrame(pages, "origin string, page_no int, text string")
    out = {(r.origin, r.doc_idx): r for r in rule_analyzer(df, ["origin"], "page_no", header=["FACTURA"], footer=["Sello"]).collect()}
    assert out["o", 1].folios == ["A1", "R-2", "A3"] and out["o", 1].client_name == "ABC010203XY1"
    assert out["o", 1].pages == ["1", "2", "3"] and out["o", 1].document_type == "Factura"
    assert out["o", 2].folios == [] and out["o", 2].client_name == "Villas SA"
    assert out["q", 1].folios == []
    own = rule_analyzer(df, ["origin"], "page_no", header=["FACTURA"], footer=["Sello"], patterns={"folio": r"Nota: (\S+)"})
    assert {r.origin: r.folios for r in own.collect() if r.origin == "q"} == {"q": ["R-77"]}
