"""DuckDB oracles of the context memory, report and run totals."""

from __future__ import annotations

from .. import config as C
from .fixtures import oracle
from .oracle_sql import (GROUPS_CTES, cat_list, folder, results_body, strip_ws, unsafe,
                         versions_ctes)

RES = GROUPS_CTES.strip() + ",\n" + versions_ctes(False).strip() + f",\nres AS ({results_body()})"
BATCH_TS = "2026-01-01 00:00:00"

VALID = ("folio IS NOT NULL AND folio <> '' AND NOT starts_with(folio, 'ERROR') "
         "AND NOT starts_with(folio, 'HUERFANO')")
KNOWN = "cliente IS NOT NULL AND cliente <> '' AND cliente <> 'NO DETECTADO'"


def main_cat(x: str) -> str:
    return f"CASE WHEN {x} IS NULL OR {x} = '' THEN 'No identificado' ELSE {strip_ws(f'split_part({x}, {chr(39)},{chr(39)}, 1)')} END"


SEEDS = "(VALUES " + ", ".join(f"('{p}', '{t}', {i})" for i, (p, t) in enumerate(C.PREFIX_SEEDS)) + \
        ") AS sd(prefix, tipo, ord)"

CTX = RES + f""",
vr AS (SELECT *, upper(regexp_extract(folio, '(\\p{{L}})', 1)) AS prefix,
              row_number() OVER (ORDER BY lot_id, seq, cat_idx) AS r FROM res WHERE {VALID}),
pb AS (SELECT prefix, count(*) AS b_freq, arg_min({main_cat('categoria')}, r) AS t, min(r) AS fo
       FROM vr WHERE prefix <> '' GROUP BY prefix),
pm AS (SELECT coalesce(sd.prefix, pb.prefix) AS prefix, coalesce(sd.tipo, pb.t) AS tipo_asociado,
              CAST(coalesce(pb.b_freq, 0) AS BIGINT) AS frecuencia, sd.ord AS s_ord, pb.fo
       FROM {SEEDS} FULL OUTER JOIN pb ON sd.prefix = pb.prefix),
pst AS (SELECT prefix, tipo_asociado, frecuencia,
               CAST(coalesce(s_ord, {len(C.PREFIX_SEEDS) - 1} + row_number() OVER (PARTITION BY s_ord IS NULL ORDER BY fo))
                    AS BIGINT) AS ord FROM pm),
ex AS (SELECT prefix, list_reduce(list(folio ORDER BY r),
                 lambda s, f: CASE WHEN list_contains(s, f) THEN s ELSE list_append(s, f)[-3:] END,
                 []::VARCHAR[]) AS e
       FROM vr WHERE prefix <> '' GROUP BY prefix),
cl AS (SELECT upper(cliente) AS cliente, count(*) AS frecuencia, min(r) AS fo FROM vr WHERE {KNOWN} GROUP BY 1),
tc AS (SELECT cliente, CAST(frecuencia AS BIGINT) AS frecuencia,
              CAST(row_number() OVER (ORDER BY frecuencia DESC, fo) AS INTEGER) AS rank
       FROM cl ORDER BY frecuencia DESC, fo LIMIT {C.DEFAULTS.top_clients})"""


def stats_sql() -> str:
    return oracle(["items"], RES + f"""
SELECT CAST(count(*) AS BIGINT) AS total_documentos_procesados,
       CAST(count(*) FILTER (WHERE {VALID}) AS BIGINT) AS total_folios_extraidos,
       CAST(count(*) - count(*) FILTER (WHERE {VALID}) AS BIGINT) AS total_no_detectados FROM res""")


def prefixes_sql() -> str:
    return oracle(["items"], CTX + "\nSELECT prefix, tipo_asociado, frecuencia, ord FROM pst")


def examples_sql() -> str:
    return oracle(["items"], CTX + """
SELECT pst.prefix, coalesce(array_to_string(ex.e, ', '), '') AS ejemplos FROM pst LEFT JOIN ex USING (prefix)""")


def clients_top_sql() -> str:
    return oracle(["items"], CTX + "\nSELECT cliente, frecuencia, rank FROM tc")


def recent_sql() -> str:
    return oracle(["items"], RES + f"""
SELECT {main_cat('categoria')} AS tipo, folio, cliente, TIMESTAMP '{BATCH_TS}' AS ts,
       CAST(row_number() OVER (ORDER BY lot_id DESC, seq DESC, cat_idx DESC) AS INTEGER) AS rank
FROM res WHERE {VALID} ORDER BY lot_id DESC, seq DESC, cat_idx DESC LIMIT {C.DEFAULTS.recent_documents}""")


def digest_sql() -> str:
    line = C.CONTEXT_DIGEST_PREFIX_LINE.replace("'", "''")
    line = "'" + line.replace("{p}", "' || prefix || '").replace("{ex}", "' || ej || '") \
        .replace("{t}", "' || tipo_asociado || '") + "'"

    def lit(s):
        return "'" + s.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"
    cats = "(VALUES " + ", ".join(f"({i}, '{c}')" for i, c in enumerate(C.CATEGORIES)) + ") AS ct(ord, name)"
    return oracle(["items"], CTX + f""",
ps AS (SELECT pst.prefix, pst.tipo_asociado, pst.ord, coalesce(array_to_string(ex.e, ', '), '') AS ej
       FROM pst LEFT JOIN ex USING (prefix)),
pl AS (SELECT CASE WHEN count(*) > 0 THEN {lit(C.CONTEXT_DIGEST_PREFIX_TITLE)} || chr(10) ||
                   string_agg({line}, chr(10) ORDER BY ord) END AS t FROM ps),
cc AS (SELECT CASE WHEN count(*) > 0 THEN {lit(C.CONTEXT_DIGEST_CLIENT_TITLE)} || chr(10) ||
                   string_agg('  - ' || cliente, chr(10) ORDER BY rank) END AS t FROM tc),
ca AS (SELECT string_agg('''' || name || '''', ', ' ORDER BY ord) AS catalogo FROM {cats})
SELECT concat_ws(chr(10), {lit(C.CONTEXT_DIGEST_HEADER)}, {lit(C.CONTEXT_DIGEST_INTRO)}, pl.t, cc.t,
                 {lit(C.CONTEXT_DIGEST_FOOTER)}) AS digest, ca.catalogo
FROM pl, cc, ca""")


def report_sql() -> str:
    def c(src, disp):
        return f"CASE WHEN (SELECT count({src}) FROM res) = 0 THEN 'N/A' ELSE CAST({src} AS VARCHAR) END AS \"{disp}\""
    from ..operators.report import REPORT_SOURCE
    cols = ", ".join(c(REPORT_SOURCE[d], d) for d in C.REPORT_COLUMNS)
    return oracle(["items"], RES + f"\nSELECT {cols} FROM res")


def run_totals_sql() -> str:
    return oracle(["items"], RES + """
SELECT CAST(count(DISTINCT lot_id) AS BIGINT) AS lots, CAST(count(*) AS BIGINT) AS rows, count(*) = 0 AS empty FROM res""")


def folder_names_sql() -> str:
    return oracle(["items"], f"""
c AS (SELECT DISTINCT unnest({cat_list('categoria')}) AS cat FROM items)
SELECT cat, {folder('cat')} AS folder FROM c""")
