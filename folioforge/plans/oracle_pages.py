"""DuckDB oracles of the page operators."""

from __future__ import annotations

from .fixtures import oracle
from .oracle_sql import GROUPS_CTES, clean, folder, stem, suffix, versions_ctes


def page_explode_sql() -> str:
    return oracle(["files"], f"""
SELECT file_id, file_name, lane, n_pages, CAST(p AS INTEGER) AS page_no,
  printf('%s_P%03d_T%03d.pdf', replace({stem('file_name')}, ' ', '_'), p, n_pages) AS page_name
FROM (SELECT *, unnest(range(1, n_pages + 1)) AS p FROM files)""")


def page_alias_sql() -> str:
    return oracle(["files"], f"""
x AS (SELECT file_id, CAST(p AS INTEGER) AS page_no,
        printf('%s_P%03d_T%03d.pdf', replace({stem('file_name')}, ' ', '_'), p, n_pages) AS page_name
      FROM (SELECT *, unnest(range(1, n_pages + 1)) AS p FROM files)),
y AS (SELECT *, CAST(row_number() OVER (PARTITION BY file_id ORDER BY page_no) AS INTEGER) AS pos FROM x)
SELECT file_id, page_no, page_name, pos, printf('page_%03d%s', pos, {suffix('page_name')}) AS alias FROM y""")


ALIASED = f"""
p0 AS (SELECT batch_id, page_no, file_name,
         CAST(row_number() OVER (PARTITION BY batch_id ORDER BY page_no) AS INTEGER) AS pos FROM batch_pages),
pa AS (SELECT *, printf('page_%03d%s', pos, {suffix('file_name')}) AS alias FROM p0),
pa2 AS (SELECT *, lower(alias) AS al, lower({stem('alias')}) AS ast FROM pa)"""


def _resolved(answers: str) -> str:
    return f"""
a1 AS (SELECT *, lower({clean('name_given')}) AS g FROM {answers}),
a2 AS (SELECT *, {stem('g')} AS gs FROM a1),
c AS (SELECT a2.batch_id, a2.ord, a2.name_given, a2.rotation_degrees, min(pa2.pos) AS pos
      FROM a2 JOIN pa2 ON a2.batch_id = pa2.batch_id AND (pa2.al = a2.g OR pa2.ast = a2.gs)
      GROUP BY a2.batch_id, a2.ord, a2.name_given, a2.rotation_degrees)"""


def name_resolution_sql() -> str:
    return oracle(["batch_pages", "answers"], ALIASED.strip() + "," + _resolved("answers") + """
SELECT c.batch_id, c.ord, c.name_given, c.pos, pa.file_name FROM c JOIN pa USING (batch_id, pos)""")


def orientation_sql() -> str:
    return oracle(["batch_pages", "answers"], ALIASED.strip() + """,
bad AS (SELECT batch_id FROM answers GROUP BY batch_id HAVING bool_or(rotation_degrees NOT IN (0, 90, 180, 270))),
okans AS (SELECT * FROM answers WHERE batch_id NOT IN (SELECT batch_id FROM bad)),""" + _resolved("okans") + """,
t AS (SELECT batch_id, pos, sum(rotation_degrees) AS deg FROM c GROUP BY batch_id, pos)
SELECT pa.batch_id, pa.page_no, pa.file_name, pa.pos, pa.alias,
  CAST(((coalesce(t.deg, 0) % 360) + 360) % 360 AS INTEGER) AS rotation
FROM pa LEFT JOIN t USING (batch_id, pos)""")


MAPPED = f"""
cnt AS (SELECT batch_id, CAST(count(*) AS INTEGER) AS paginas_original FROM batch_pages GROUP BY batch_id),
mt AS (SELECT d.batch_id, d.doc_idx, d.pos, b.page_no, b.file_name
       FROM doc_pages d JOIN batch_pages b ON d.batch_id = b.batch_id AND {clean('d.file_name')} = b.file_name)"""


def items_from_docs_sql() -> str:
    return oracle(["batch_pages", "doc_pages", "doc_folios"], MAPPED.strip() + """,
docs AS (SELECT batch_id, doc_idx, string_agg(file_name, ',' ORDER BY pos, page_no, file_name) AS paginas,
                CAST(count(*) AS INTEGER) AS n_pages FROM mt GROUP BY batch_id, doc_idx)
SELECT docs.batch_id, docs.doc_idx, f.folio_idx, f.folio, docs.paginas, docs.n_pages, cnt.paginas_original
FROM docs JOIN doc_folios f USING (batch_id, doc_idx) JOIN cnt USING (batch_id)""")


def orphans_sql() -> str:
    return oracle(["batch_pages", "doc_pages", "doc_folios"], MAPPED.strip() + f"""
SELECT b.batch_id, b.page_no, b.file_name, 'HUERFANO_' || {stem('b.file_name')} AS orphan_name,
  'ERROR_DOCUMENTO_ILEGIBLE' AS folio, 'Página Huérfana' AS categoria, 0 AS confianza, cnt.paginas_original
FROM batch_pages b JOIN cnt USING (batch_id)
WHERE NOT EXISTS (SELECT 1 FROM mt WHERE mt.batch_id = b.batch_id AND mt.file_name = b.file_name)""")


PAGE_UNION = """
pf AS (SELECT lot_id, folio_key, categoria, origen, pagina, min(seq) AS fs FROM i
       GROUP BY lot_id, folio_key, categoria, origen, pagina),
pu AS (SELECT lot_id, folio_key, categoria, origen,
              string_agg(pagina || ':0', ',' ORDER BY fs) AS paginas, CAST(count(*) AS INTEGER) AS n_pages
       FROM pf GROUP BY lot_id, folio_key, categoria, origen)"""


def page_union_sql() -> str:
    return oracle(["items"], GROUPS_CTES.strip() + "," + PAGE_UNION + """
SELECT lot_id, folio_key, categoria, origen, paginas, n_pages FROM pu""")


def assembly_manifest_sql() -> str:
    return oracle(["items"], GROUPS_CTES.strip() + ",\n" + versions_ctes(False).strip() + "," + PAGE_UNION + f""",
r AS (SELECT v.*, {folder('cat')} || '/' || CASE WHEN version = 1 THEN folio_key || '.pdf'
                ELSE folio_key || '_v' || CAST(version AS VARCHAR) || '.pdf' END AS ruta
      FROM v WHERE accion <> 'DESCARTAR'),
w AS (SELECT *, row_number() OVER (PARTITION BY ruta ORDER BY lot_id DESC, seq DESC, cat_idx DESC) AS route_rn FROM r)
SELECT w.ruta, w.origen, w.lot_id, w.seq, CAST(w.cat_idx AS INTEGER) AS cat_idx, pu.n_pages, pu.paginas
FROM w JOIN pu USING (lot_id, folio_key, categoria, origen) WHERE route_rn = 1""")


FULL_ITEMS = """
lots AS (SELECT *, lot_no + CASE WHEN kind = 'image' THEN (SELECT coalesce(max(lot_no), -1) + 1 FROM batches WHERE kind = 'pdf')
                                 ELSE 0 END AS lot_id FROM batches),
page_of AS (SELECT batch_id, doc_idx, min(file_name) AS pagina FROM mt GROUP BY batch_id, doc_idx),
al AS (SELECT f.batch_id, p.doc_idx, f.folio_idx, f.folio, d.categoria, d.cliente, d.confianza, d.justificacion, p.pagina,
         CAST(NULL AS VARCHAR) AS orphan_name
       FROM page_of p JOIN doc_folios f USING (batch_id, doc_idx) JOIN doc_fields d USING (batch_id, doc_idx)
       UNION ALL
       SELECT b.batch_id, 4611686018427387904, b.page_no, 'ERROR_DOCUMENTO_ILEGIBLE', 'Página Huérfana', 'NO DETECTADO', 0,
         'Fragmento excluido por la inferencia.', b.file_name, 'HUERFANO_' || %s
       FROM batch_pages b WHERE NOT EXISTS (SELECT 1 FROM mt WHERE mt.batch_id = b.batch_id AND mt.file_name = b.file_name)),
every AS (SELECT al.*, lots.lot_id, lots.origen, cnt.paginas_original AS orig_pages,
          CASE WHEN kind = 'pdf' THEN 'PDF' ELSE 'IMÁGENES MIXTAS' END AS tipo_origen,
          row_number() OVER (PARTITION BY lots.lot_id ORDER BY lots.origen, al.batch_id, al.doc_idx, al.folio_idx) AS seq
        FROM al JOIN lots USING (batch_id) JOIN cnt USING (batch_id))""" % stem("b.file_name")
FULL_FIXTURES = ["batch_pages", "doc_pages", "doc_folios", "batches", "doc_fields"]


def items_full_sql() -> str:
    return oracle(FULL_FIXTURES, MAPPED.strip() + "," + FULL_ITEMS + """
SELECT batch_id, lot_id, seq, origen, tipo_origen, folio, categoria, cliente, confianza, justificacion, pagina,
  orig_pages AS paginas_original, orphan_name IS NOT NULL AS is_orphan, orphan_name FROM every""")


def _results_with_orphans() -> str:
    from .oracle_sql import GROUPS_CTES, results_body, versions_ctes
    groups = GROUPS_CTES.strip().replace(
        "CAST(count(*) OVER (PARTITION BY lot_id, origen) AS INTEGER) AS paginas_original", "orig_pages AS paginas_original")
    return (MAPPED.strip() + "," + FULL_ITEMS + ",\nitems AS (SELECT * FROM every WHERE orphan_name IS NULL),\n" + groups
            + ",\n" + versions_ctes(False).strip() + ",\nres AS (" + results_body() + """
UNION ALL
SELECT lot_id, seq, 0, 'ERROR_DOCUMENTO_ILEGIBLE', 'ERROR_DOCUMENTO_ILEGIBLE', 1, 'Revisión Manual Requerida', NULL, origen,
  NULL, NULL, 1, 'REVISIÓN MANUAL', NULL, 'Revision_Manual_Requerida/' || orphan_name || '.pdf', justificacion
FROM every WHERE orphan_name IS NOT NULL)""")


def results_with_orphans_sql() -> str:
    return oracle(FULL_FIXTURES, _results_with_orphans() + "\nSELECT * FROM res")


def report_with_orphans_sql() -> str:
    from .. import config as C
    from ..operators.report import REPORT_SOURCE
    cols = ", ".join(f'CAST({REPORT_SOURCE[d]} AS VARCHAR) AS "{d}"' for d in C.REPORT_COLUMNS)
    return oracle(FULL_FIXTURES, _results_with_orphans() + f"\nSELECT {cols} FROM res")
