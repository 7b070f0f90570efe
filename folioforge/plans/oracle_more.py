"""DuckDB oracles: routing, rejects, fallback, alias substitution, rule documents, category guard."""

from __future__ import annotations

from .. import config as C
from .fixtures import oracle
from .oracle_pages import ALIASED, _resolved
from .oracle_rules import ROLE_CTES, payload_validation_sql
from .oracle_sql import basename, cat_list, clean, strip_ws, suffix, unsafe


def raw_routing_sql() -> str:
    return oracle(["members"], f"""
r AS (SELECT archive, ord, {basename('member')} AS file_name FROM members WHERE NOT ends_with(member, '/'))
SELECT archive, ord, file_name, lower({suffix('file_name')}) AS ext,
  lower({suffix('file_name')}) IN ('.db', '.ini', '.ds_store') OR starts_with(file_name, '.') AS junk,
  CASE WHEN lower({suffix('file_name')}) = '.pdf' THEN 'pdf'
       WHEN lower({suffix('file_name')}) IN ('.jpg', '.jpeg', '.png') THEN 'image' ELSE 'other' END AS kind
FROM r""")


def rejects_sql() -> str:
    pv = payload_validation_sql()
    pv_body = pv[pv.index("p AS (SELECT payload_id"):]
    pv_body = pv_body[:pv_body.index("SELECT payload_id, reason IS NULL")]
    pv_body = pv_body.replace("\nc AS (", "\npc AS (").replace("FROM c)", "FROM pc)")
    return oracle(["payloads", "batch_pages", "answers", "doc_pages", "doc_folios"],
                  pv_body.rstrip() + ",\n" + ALIASED.strip() + "," + _resolved("answers") + f""",
dc AS (SELECT d.*, {clean('d.file_name')} AS cl FROM doc_pages d),
dm AS (SELECT DISTINCT dc.batch_id, dc.doc_idx FROM dc JOIN batch_pages b ON dc.batch_id = b.batch_id AND dc.cl = b.file_name)
SELECT 'payload' AS stage, CAST(payload_id AS VARCHAR) AS key, reason, CAST(NULL AS VARCHAR) AS detail
  FROM r WHERE reason IS NOT NULL
UNION ALL
SELECT 'orientation', CAST(a.batch_id AS VARCHAR) || '|' || CAST(a.ord AS VARCHAR), 'unknown page name', a.name_given
  FROM answers a WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.batch_id = a.batch_id AND c.ord = a.ord)
UNION ALL
SELECT 'extraction', CAST(dc.batch_id AS VARCHAR) || '|' || CAST(dc.doc_idx AS VARCHAR) || '|' || CAST(dc.pos AS VARCHAR),
       'unknown page name', dc.file_name
  FROM dc WHERE NOT EXISTS (SELECT 1 FROM batch_pages b WHERE b.batch_id = dc.batch_id AND b.file_name = dc.cl)
UNION ALL
SELECT 'map', CAST(dm.batch_id AS VARCHAR) || '|' || CAST(dm.doc_idx AS VARCHAR), 'document without folio', CAST(NULL AS VARCHAR)
  FROM dm WHERE NOT EXISTS (SELECT 1 FROM doc_folios f WHERE f.batch_id = dm.batch_id AND f.doc_idx = dm.doc_idx)""")


def fallback_documents_sql() -> str:
    return oracle(["batch_pages", "doc_pages"], f"""
SELECT batch_id, CAST(0 AS BIGINT) AS doc_idx, 'ERROR_DOCUMENTO_ILEGIBLE' AS folios,
  string_agg(file_name, ',' ORDER BY page_no) AS paginas, 'No identificado' AS document_type, 0 AS confidence_score,
  '{C.FALLBACK_REASON}' AS reasoning
FROM batch_pages b WHERE NOT EXISTS (SELECT 1 FROM doc_pages d WHERE d.batch_id = b.batch_id)
GROUP BY batch_id""")


def alias_substitution_sql() -> str:
    return oracle(["batch_pages", "answers"], ALIASED.strip() + """,
am AS (SELECT batch_id, list({'a': alias, 'n': file_name} ORDER BY pos) AS m FROM pa GROUP BY batch_id)
SELECT a.batch_id, a.ord, a.name_given,
  CASE WHEN am.m IS NULL THEN a.name_given ELSE list_reduce(am.m, lambda s, e: replace(s, e.a, e.n), a.name_given) END
    AS name_given_real
FROM answers a LEFT JOIN am USING (batch_id)""")


def rule_documents_sql() -> str:
    from ..operators.rules import FIELD_PATTERNS
    cats = "[" + ", ".join(f"'{c}'" for c in C.CATEGORIES) + "]"
    fo_re = FIELD_PATTERNS["folio"].replace("'", "''")
    cl_re = FIELD_PATTERNS["cliente"].replace("'", "''")
    seeds = " ".join(f"WHEN '{p}' THEN '{t}'" for p, t in C.PREFIX_SEEDS)
    th = f"list_filter({cats}, lambda c: list_contains(th, c))"
    return oracle(["page_text"], ROLE_CTES + f""",
sg AS (SELECT rl.*, CAST(sum(CASE WHEN role IN ('INICIO', 'UNICA') THEN 1 ELSE 0 END) OVER (PARTITION BY origin
         ORDER BY page_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS segment FROM rl),
dp AS (SELECT sg.*, pt.text FROM sg JOIN page_text pt USING (origin, page_no) WHERE role <> 'HUERFANA' AND segment > 0),
dh AS (SELECT *, list_filter({cats}, lambda c: contains(lower(text), lower(c))) AS hits,
         nullif(regexp_extract(text, '{fo_re}', 1), '') AS fo,
         nullif({strip_ws(f"regexp_extract(text, '{cl_re}', 1)")}, '') AS cl,
         CASE role WHEN 'INICIO' THEN 0 WHEN 'UNICA' THEN 0 WHEN 'INTERMEDIA' THEN 1 WHEN 'CIERRE' THEN 2 ELSE 3 END AS rr
       FROM dp),
dg AS (SELECT origin, segment, string_agg(CAST(page_no AS VARCHAR), ',' ORDER BY rr, page_no) AS pages,
         CAST(count(*) AS INTEGER) AS n_pages,
         arg_min(fo, page_no) FILTER (WHERE fo IS NOT NULL) AS folio,
         arg_min(cl, page_no) FILTER (WHERE cl IS NOT NULL) AS client_name,
         flatten(list(hits)) AS th,
         max(CASE WHEN role IN ('INICIO', 'UNICA') THEN 1 ELSE 0 END) AS s,
         max(CASE WHEN role IN ('CIERRE', 'UNICA') THEN 1 ELSE 0 END) AS e
       FROM dh GROUP BY origin, segment)
SELECT origin, segment AS doc_idx, coalesce(folio, '') AS folios, pages, n_pages,
  CASE WHEN len({th}) > 0 THEN array_to_string({th}, ', ')
       ELSE CASE upper(regexp_extract(folio, '(\\p{{L}})', 1)) {seeds} ELSE 'No identificado' END END AS document_type,
  client_name, CASE WHEN s = 1 AND e = 1 THEN 90 ELSE 40 END AS confidence_score
FROM dg""")


def category_guard_sql() -> str:
    cats = "(VALUES " + ", ".join(f"('{c}')" for c in C.CATEGORIES) + ") AS ct(name)"
    return oracle(["items"], f"""
c AS (SELECT unnest({cat_list('categoria')}) AS cat FROM items)
SELECT cat, {unsafe('cat')} AS unsafe, cat IN (SELECT name FROM {cats}) AS allowed, CAST(count(*) AS BIGINT) AS n
FROM c GROUP BY cat""")
