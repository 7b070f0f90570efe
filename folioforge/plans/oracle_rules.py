"""DuckDB oracles of ingest filters, payload validation and the rule operators."""

from __future__ import annotations

from .. import config as C
from .fixtures import oracle
from .oracle_sql import basename, stem, strip_ws, suffix


def _starts_any(x: str) -> str:
    return "(" + " OR ".join(f"starts_with({x}, '{p}')" for p in C.IGNORED_PREFIXES) + ")"


ALLOWED = ", ".join(f"'{e}'" for e in C.ALLOWED_EXTENSIONS)

FLAGS = f"""
mf AS (SELECT archive, ord, member, {basename('member')} AS file_name,
         NOT ends_with(member, '/') AND {basename('member')} <> '' AND lower({suffix('member')}) IN ({ALLOWED}) AS base_ok,
         len(list_filter(list_filter(string_split(member, '/'), lambda p: p <> '' AND p <> '.'),
                         lambda p: {_starts_any('p')})) > 0 AS bad_part
       FROM members),
mk AS (SELECT archive, ord, member, file_name, base_ok AND NOT {_starts_any('file_name')} AS keep,
              base_ok AND NOT bad_part AS keep_path FROM mf)"""


def member_filter_sql() -> str:
    return oracle(["members"], FLAGS + "\nSELECT archive, ord, member, file_name, keep, keep_path FROM mk")


def flat_names_sql() -> str:
    return oracle(["members"], FLAGS + f""",
fk AS (SELECT *, row_number() OVER (PARTITION BY file_name ORDER BY archive, ord) AS rn FROM mk WHERE keep)
SELECT archive, ord, member, file_name,
  CASE WHEN rn > 1 THEN {stem('file_name')} || '_' || substr(sha256(concat_ws('|', archive, member, CAST(ord AS VARCHAR))), 1, 6)
            || {suffix('file_name')} ELSE file_name END AS flat_name
FROM fk""")


ROLES = ", ".join(f"'{r}'" for r in C.ROLES)


def payload_validation_sql() -> str:
    return oracle(["payloads"], f"""
p AS (SELECT payload_id, try_cast(body AS JSON) AS j FROM payloads),
c AS (SELECT payload_id, j, json_type(j) AS top, json_type(j, '$.file_name') AS t_fn,
             json_type(j, '$.rotation_degrees') AS t_rot, json_type(j, '$.role') AS t_role,
             json_type(j, '$.confidence_score') AS t_conf FROM p),
r AS (SELECT payload_id, j, CASE
    WHEN j IS NULL OR top <> 'OBJECT' THEN 'malformed'
    WHEN coalesce(t_fn, '') <> 'VARCHAR' THEN 'type:file_name'
    WHEN coalesce(t_rot, '') NOT IN ('UBIGINT', 'BIGINT') THEN 'type:rotation_degrees'
    WHEN coalesce(t_role, '') <> 'VARCHAR' THEN 'type:role'
    WHEN coalesce(t_conf, '') NOT IN ('UBIGINT', 'BIGINT') THEN 'type:confidence_score'
    WHEN CAST(j->>'$.rotation_degrees' AS BIGINT) NOT IN (0, 90, 180, 270) THEN 'rotation'
    WHEN j->>'$.role' NOT IN ({ROLES}) THEN 'role'
    WHEN CAST(j->>'$.confidence_score' AS BIGINT) NOT BETWEEN 0 AND 100 THEN 'confidence'
  END AS reason FROM c)
SELECT payload_id, reason IS NULL AS valid, reason,
  CASE WHEN reason IS NULL THEN j->>'$.file_name' END AS file_name,
  CASE WHEN reason IS NULL THEN CAST(j->>'$.rotation_degrees' AS INTEGER) END AS rotation_degrees,
  CASE WHEN reason IS NULL THEN j->>'$.role' END AS role,
  CASE WHEN reason IS NULL THEN CAST(j->>'$.confidence_score' AS INTEGER) END AS confidence_score
FROM r""")


ROLE_CTES = """
pt AS (SELECT origin, page_no, contains(lower(text), 'ation') AS h, contains(lower(text), 'ment') AS f FROM page_text),
an AS (SELECT *, CASE WHEN h AND f THEN 'UNICA' WHEN h THEN 'INICIO' WHEN f THEN 'CIERRE' END AS anchor FROM pt),
nb AS (SELECT *,
    last_value(anchor IGNORE NULLS) OVER (PARTITION BY origin ORDER BY page_no
                                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prv,
    first_value(anchor IGNORE NULLS) OVER (PARTITION BY origin ORDER BY page_no
                                           ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nxt FROM an),
rl AS (SELECT origin, page_no,
    coalesce(anchor, CASE WHEN prv = 'INICIO' AND nxt = 'CIERRE' THEN 'INTERMEDIA' ELSE 'HUERFANA' END) AS role FROM nb)"""


def page_roles_sql() -> str:
    return oracle(["page_text"], ROLE_CTES + "\nSELECT origin, page_no, role FROM rl")


def segmentation_sql() -> str:
    return oracle(["page_text"], ROLE_CTES + """
SELECT origin, page_no, role,
  CAST(sum(CASE WHEN role IN ('INICIO', 'UNICA') THEN 1 ELSE 0 END) OVER (PARTITION BY origin ORDER BY page_no
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS segment
FROM rl""")


def prefix_type_sql() -> str:
    seeds = ", ".join(f"('{p}', '{t}')" for p, t in C.PREFIX_SEEDS)
    parts = f"list_filter(list_transform(string_split(coalesce(categoria, ''), ','), lambda c: {strip_ws('c')}), lambda c: c <> '')"
    return oracle(["items"], f"""
x AS (SELECT seq, folio, categoria, upper(regexp_extract(folio, '(\\p{{L}})', 1)) AS prefix FROM items)
SELECT x.seq, x.folio, x.categoria, x.prefix, r.rule_type,
  CASE WHEN len({parts}) > 0 THEN categoria ELSE coalesce(r.rule_type, 'No identificado') END AS tipo
FROM x LEFT JOIN (VALUES {seeds}) r(prefix, rule_type) ON x.prefix = r.prefix""")


def double_type_sql() -> str:
    cats = "[" + ", ".join(f"'{c}'" for c in C.CATEGORIES) + "]"
    hits = f"list_filter({cats}, lambda c: contains(lower(text), lower(c)))"
    return oracle(["page_text"], f"""
SELECT origin, page_no, array_to_string({hits}, ', ') AS document_type, CAST(len({hits}) AS INTEGER) AS n_types
FROM page_text""")
