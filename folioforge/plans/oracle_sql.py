"""DuckDB text of the oracles (independent restatements, not generated from the Spark plans)."""

from __future__ import annotations

from ..functions.strings import WORD, WS
from .fixtures import oracle


def strip_ws(x: str) -> str:
    return f"regexp_replace({x}, '^[{WS}]+|[{WS}]+$', '', 'g')"


def folio_key(x: str) -> str:
    kept = f"regexp_replace({x}, '[^{WORD}-]', '', 'g')"
    return f"CASE WHEN {kept} = '' THEN 'ERROR_FORMATO_INVALIDO' ELSE {kept} END"


def folder(x: str) -> str:
    kept = strip_ws(f"regexp_replace({x}, '[^{WORD}{WS}-]', '', 'g')")
    f = f"regexp_replace({kept}, '[{WS}]+', '_', 'g')"
    return f"CASE WHEN {f} = '' THEN '_' ELSE {f} END"


def unsafe(x: str) -> str:
    return f"(contains({x}, '..') OR contains({x}, '/') OR contains({x}, '\\'))"


def cat_list(x: str) -> str:
    parts = f"list_filter(list_transform(string_split({x}, ','), lambda c: {strip_ws('c')}), lambda c: c <> '')"
    return f"CASE WHEN len({parts}) = 0 THEN ['No_identificado'] ELSE {parts} END"


# items -> groups (G1-G7, G12 on one-page items) -> multiplexed events
GROUPS_CTES = f"""
i AS (SELECT *, {folio_key('folio')} AS folio_key,
             CAST(count(*) OVER (PARTITION BY lot_id, origen) AS INTEGER) AS paginas_original
      FROM items),
jr AS (SELECT lot_id, folio_key, categoria, origen, justificacion, min(seq) AS js
       FROM i GROUP BY lot_id, folio_key, categoria, origen, justificacion),
jg AS (SELECT lot_id, folio_key, categoria, origen, string_agg(justificacion, ' | ' ORDER BY js) AS justificacion
       FROM jr GROUP BY lot_id, folio_key, categoria, origen),
g0 AS (SELECT lot_id, folio_key, categoria, origen, min(seq) AS seq, arg_min(folio, seq) AS folio,
              coalesce(arg_min(cliente, seq) FILTER (WHERE cliente IS NOT NULL AND cliente <> '' AND cliente <> 'NO DETECTADO'),
                       'NO DETECTADO') AS cliente,
              max(confianza) AS confianza,
              CASE WHEN lower(arg_min(origen, seq)) LIKE '%.pdf' THEN 'PDF' ELSE 'IMÁGENES MIXTAS' END AS tipo_origen,
              arg_min(paginas_original, seq) AS paginas_original,
              CAST(count(DISTINCT pagina) AS INTEGER) AS paginas_final
       FROM i GROUP BY lot_id, folio_key, categoria, origen),
g AS (SELECT g0.*, jg.justificacion FROM g0 JOIN jg USING (lot_id, folio_key, categoria, origen)),
m0 AS (SELECT g.*, {cat_list('categoria')} AS cats FROM g),
m AS (SELECT m0.* EXCLUDE (cats), unnest(cats) AS cat, unnest(range(len(cats))) AS cat_idx FROM m0)
"""


def versions_ctes(with_registry: bool) -> str:
    """The window restatement of V1 over guarded events ``m``."""
    if with_registry:
        reg = """
rg AS (SELECT folio_key, cat, origen, min(version) AS version,
              arg_min(coalesce(score, 0), version) AS score FROM registry GROUP BY folio_key, cat, origen),
rm AS (SELECT folio_key, cat, max(version) AS mv FROM registry GROUP BY folio_key, cat),
e0 AS (SELECT m.*, r.version AS rv, CASE WHEN r.version IS NOT NULL THEN r.score END AS rs, coalesce(rm.mv, 0) AS mv
       FROM m LEFT JOIN rg r ON m.folio_key = r.folio_key AND m.cat = r.cat AND m.origen = r.origen
              LEFT JOIN rm ON m.folio_key = rm.folio_key AND m.cat = rm.cat
       WHERE NOT """ + unsafe("m.cat") + "),"
    else:
        reg = "e0 AS (SELECT m.*, CAST(NULL AS INTEGER) AS rv, CAST(NULL AS INTEGER) AS rs, 0 AS mv FROM m WHERE NOT " \
              + unsafe("m.cat") + "),"
    return reg + """
e AS (SELECT e0.*,
    max(confianza) OVER (PARTITION BY folio_key, cat, origen ORDER BY lot_id, seq, cat_idx
                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev,
    row_number() OVER (PARTITION BY folio_key, cat, origen ORDER BY lot_id, seq, cat_idx) AS rn,
    row_number() OVER (PARTITION BY folio_key, cat ORDER BY lot_id, seq, cat_idx) AS gn
  FROM e0),
f AS (SELECT *, sum(CASE WHEN rn = 1 AND rv IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY folio_key, cat
        ORDER BY lot_id, seq, cat_idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS born FROM e),
h AS (SELECT *, max(CASE WHEN rn = 1 THEN born END) OVER (PARTITION BY folio_key, cat, origen) AS birth FROM f),
v AS (SELECT h.*, CAST(coalesce(rv, mv + birth) AS INTEGER) AS version,
  CASE WHEN rv IS NULL AND rn = 1 AND mv = 0 AND gn = 1 THEN 'NUEVO' WHEN rv IS NULL AND rn = 1 THEN 'VERSIONAR'
       WHEN confianza >= greatest(coalesce(rs, -1), coalesce(prev, -1)) THEN 'SOBRESCRIBIR' ELSE 'DESCARTAR' END AS accion
  FROM h)
"""


VERSION_EVENT_COLS = "lot_id, seq, CAST(cat_idx AS INTEGER) AS cat_idx, folio_key, cat, origen, confianza, version, accion"


def version_events_sql(with_registry: bool) -> str:
    fixtures = ["items", "registry"] if with_registry else ["items"]
    return oracle(fixtures, GROUPS_CTES.strip() + ",\n" + versions_ctes(with_registry).strip()
                  + f"\nSELECT {VERSION_EVENT_COLS} FROM v")


def results_body() -> str:
    ok = f"""
SELECT lot_id, seq, CAST(cat_idx AS INTEGER) AS cat_idx, folio, folio_key, version, cat AS categoria, cliente,
  origen AS archivo_original, tipo_origen AS tipo_original, paginas_original, paginas_final,
  CASE WHEN confianza > 80 THEN 'OK' ELSE 'REVISIÓN MANUAL' END AS status, confianza,
  {folder('cat')} || '/' || CASE WHEN version = 1 THEN folio_key || '.pdf'
                               ELSE folio_key || '_v' || CAST(version AS VARCHAR) || '.pdf' END AS ruta,
  justificacion
FROM v WHERE accion <> 'DESCARTAR'"""
    err = f"""
SELECT lot_id, seq, CAST(cat_idx AS INTEGER) AS cat_idx, folio, folio_key, 1 AS version, cat AS categoria, cliente,
  origen AS archivo_original, CAST(NULL AS VARCHAR) AS tipo_original, CAST(NULL AS INTEGER) AS paginas_original,
  0 AS paginas_final, 'ERROR_ENSAMBLAJE' AS status, 0 AS confianza,
  'ERROR_ENSAMBLAJE/' || folio_key || '_' ||
    substr(sha256(concat_ws('|', CAST(lot_id AS VARCHAR), folio_key, categoria, origen, CAST(cat_idx AS VARCHAR))), 1, 8)
    || '.pdf' AS ruta,
  'Fallo sistema de archivos: Ruta de destino contiene caracteres de navegación no permitidos: ' || cat AS justificacion
FROM m WHERE {unsafe('cat')}"""
    return ok + "\nUNION ALL" + err


def results_sql(with_registry: bool = False) -> str:
    fixtures = ["items", "registry"] if with_registry else ["items"]
    return oracle(fixtures, GROUPS_CTES.strip() + ",\n" + versions_ctes(with_registry).strip()
                  + "\n" + results_body())


BATCH_TS = "2026-01-01 00:00:00"
STORED_TS = "2025-12-31 00:00:00"

STORED_CTE = f"""
s AS (SELECT sha256(concat_ws('|', folio_key, cat, CAST(version AS VARCHAR), origen)) AS id,
        folio_key AS folio, folio_key, cat AS categoria, CAST(version AS INTEGER) AS version,
        'NO_DETECTADA' AS divisa, 'NO DETECTADO' AS cliente, origen AS archivo_original, 1 AS paginas_consolidado,
        CASE WHEN score > 80 THEN 'OK' ELSE 'REVISIÓN MANUAL' END AS status, CAST(score AS INTEGER) AS confianza_promedio,
        {folder('cat')} || '/' || CASE WHEN version = 1 THEN folio_key || '.pdf'
                                     ELSE folio_key || '_v' || CAST(version AS VARCHAR) || '.pdf' END AS ruta_servidor,
        CAST(NULL AS VARCHAR) AS justificacion, 'PENDIENTE' AS estado_conciliacion,
        CAST(NULL AS VARCHAR) AS id_docto_firebird, TIMESTAMP '{STORED_TS}' AS fecha_procesamiento
      FROM registry)
"""

UPSERT_CTES = f"""
res AS ({results_body()}),
b0 AS (SELECT coalesce(folio, 'ERROR_SIN_FOLIO') AS folio, folio_key,
        coalesce(categoria, 'No identificado') AS categoria, CAST(coalesce(version, 1) AS INTEGER) AS version,
        coalesce(archivo_original, 'DESCONOCIDO') AS archivo_original, 'NO_DETECTADA' AS divisa,
        coalesce(cliente, 'NO DETECTADO') AS cliente, CAST(coalesce(paginas_final, 1) AS INTEGER) AS paginas_consolidado,
        coalesce(status, 'PENDIENTE') AS status, CAST(coalesce(confianza, 0) AS INTEGER) AS confianza_promedio,
        coalesce(ruta, 'ERROR_RUTA_VACIA') AS ruta_servidor, lot_id, seq, cat_idx FROM res),
b AS (SELECT * EXCLUDE (rn, lot_id, seq, cat_idx), TRUE AS present FROM (
        SELECT *, row_number() OVER (PARTITION BY folio, categoria, version, archivo_original
                                     ORDER BY lot_id DESC, seq DESC, cat_idx DESC) AS rn FROM b0) WHERE rn = 1),
{STORED_CTE.strip()},
u AS (SELECT
    CASE WHEN s.id IS NOT NULL THEN s.id
         ELSE sha256(concat_ws('|', b.folio, b.categoria, CAST(b.version AS VARCHAR), b.archivo_original)) END AS id,
    coalesce(s.folio, b.folio) AS folio,
    CASE WHEN b.present THEN b.folio_key ELSE s.folio_key END AS folio_key,
    coalesce(s.categoria, b.categoria) AS categoria, coalesce(s.version, b.version) AS version,
    CASE WHEN b.present THEN b.divisa ELSE s.divisa END AS divisa,
    CASE WHEN b.present THEN b.cliente ELSE s.cliente END AS cliente,
    coalesce(s.archivo_original, b.archivo_original) AS archivo_original,
    CASE WHEN b.present THEN b.paginas_consolidado ELSE s.paginas_consolidado END AS paginas_consolidado,
    CASE WHEN b.present THEN b.status ELSE s.status END AS status,
    CASE WHEN b.present THEN b.confianza_promedio ELSE s.confianza_promedio END AS confianza_promedio,
    CASE WHEN b.present THEN b.ruta_servidor ELSE s.ruta_servidor END AS ruta_servidor,
    s.justificacion AS justificacion,
    coalesce(s.estado_conciliacion, 'PENDIENTE') AS estado_conciliacion,
    s.id_docto_firebird AS id_docto_firebird,
    coalesce(s.fecha_procesamiento, TIMESTAMP '{BATCH_TS}') AS fecha_procesamiento
  FROM s FULL OUTER JOIN b ON s.folio = b.folio AND s.categoria = b.categoria AND s.version = b.version
                          AND s.archivo_original = b.archivo_original)
"""


def upsert_sql() -> str:
    return oracle(["items", "registry"], GROUPS_CTES.strip() + ",\n" + versions_ctes(True).strip() + ",\n"
                  + UPSERT_CTES.strip() + "\nSELECT * FROM u")


NOT_NULL = ["id", "folio", "categoria", "version", "archivo_original", "paginas_consolidado",
            "status", "confianza_promedio", "ruta_servidor"]
LENGTHS = {"folio": 100, "categoria": 100, "divisa": 20, "cliente": 255, "archivo_original": 255,
           "status": 50, "ruta_servidor": 500, "estado_conciliacion": 50, "id_docto_firebird": 100}


def constraints_sql() -> str:
    parts = [
        "SELECT 'primary_key' AS rule, id AS key, count(*) AS n FROM u GROUP BY id HAVING count(*) > 1",
        "SELECT 'natural_key', concat_ws('|', folio, categoria, CAST(version AS VARCHAR), archivo_original), count(*)"
        " FROM u GROUP BY folio, categoria, version, archivo_original HAVING count(*) > 1",
        "SELECT 'unique_route', ruta_servidor, count(*) FROM u GROUP BY ruta_servidor HAVING count(*) > 1",
    ]
    for c in NOT_NULL:
        parts.append(f"SELECT 'not_null:{c}', coalesce(id, '∅'), count(*) FROM u WHERE {c} IS NULL GROUP BY 2")
    for c, n in LENGTHS.items():
        parts.append(f"SELECT 'length:{c}', coalesce(id, '∅'), count(*) FROM u WHERE length({c}) > {n} GROUP BY 2")
    return oracle(["items", "registry"], GROUPS_CTES.strip() + ",\n" + versions_ctes(True).strip() + ",\n"
                  + UPSERT_CTES.strip() + "\n" + "\nUNION ALL\n".join(parts))


# --- path and name helpers (DuckDB / RE2) -----------------------------------
def basename(x: str) -> str:
    return f"regexp_extract({x}, '(?s)([^/]*)/*$', 1)"


def stem(x: str) -> str:
    return f"regexp_replace({basename(x)}, '(?s)^(.+)\\.[^.]+$', '\\1')"


def suffix(x: str) -> str:
    return f"regexp_extract({basename(x)}, '(?s)^.+(\\.[^.]+)$', 1)"


def clean(x: str) -> str:
    return f"regexp_replace({strip_ws(x)}, '^[''\"]+|[''\"]+$', '', 'g')"
