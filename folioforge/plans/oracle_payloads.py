"""DuckDB oracles of the nested payload rules, on JSON functions."""

from __future__ import annotations

from .fixtures import oracle

INTS = "('BIGINT', 'UBIGINT')"


def _scalar(table: str, path: str, field: str, kind: str, required: bool = True, bad: str | None = None) -> str:
    """Rows (payload_id, problem) of one field of the JSON objects ``o`` of a table."""
    t = f"json_type(o, '$.{field}')"
    good = f"{t} = 'VARCHAR'" if kind == "string" else f"{t} IN {INTS}"
    gone = f"({t} IS NULL OR {t} = 'NULL')"
    out = (f"SELECT payload_id, {path} || '.{field}' || CASE WHEN {t} IS NULL THEN ':missing' ELSE ':type' END AS problem "
           f"FROM {table} WHERE json_type(o) = 'OBJECT' AND " + (f"({gone} OR NOT {good})" if required else f"(NOT {gone} AND NOT {good})"))
    if bad:
        out += f"\nUNION ALL SELECT payload_id, {path} || '.{field}:value' FROM {table} WHERE json_type(o) = 'OBJECT' AND {good} AND {bad}"
    return out


def _array(table: str, path: str, field: str) -> str:
    t = f"json_type(o, '$.{field}')"
    return (f"SELECT payload_id, {path} || '{field}' || CASE WHEN {t} IS NULL THEN ':missing' ELSE ':type' END AS problem "
            f"FROM {table} WHERE json_type(o) = 'OBJECT' AND ({t} IS NULL OR {t} <> 'ARRAY')")


def _objects(table: str, path: str) -> str:
    return f"SELECT payload_id, {path} || ':type' AS problem FROM {table} WHERE json_type(o) <> 'OBJECT'"


def _items(table: str, path: str, field: str) -> str:
    """The items of an array field as (payload_id, o, path)."""
    return f"""(SELECT payload_id, unnest(json_extract(o, '$.{field}[*]')) AS o,
        {path} || '{field}[' || (generate_subscripts(json_extract(o, '$.{field}[*]'), 1) - 1) || ']' AS path
      FROM {table} WHERE json_type(o, '$.{field}') = 'ARRAY')"""


def _wrap(view: str, ctes: str, parts: list[str]) -> str:
    return oracle([view], f"""
p AS (SELECT payload_id, CASE WHEN json_valid(body) THEN body::JSON END AS o FROM {view}),
{ctes},
problem AS (SELECT payload_id, 'payload:malformed' AS problem FROM p WHERE o IS NULL
UNION ALL {_objects('p', "'payload'")}
UNION ALL """ + "\nUNION ALL ".join(parts) + f""")
SELECT v.payload_id, count(problem) = 0 AS valid, coalesce(string_agg(problem, ',' ORDER BY problem), '') AS problems
FROM {view} v LEFT JOIN problem USING (payload_id) GROUP BY v.payload_id""")


def extraction_validation_sql() -> str:
    names = "(SELECT payload_id, unnest(json_extract(o, '$.{0}[*]')) AS o, path || '.{0}[' || (generate_subscripts(json_extract(o, '$.{0}[*]'), 1) - 1) || ']' AS path FROM d WHERE json_type(o, '$.{0}') = 'ARRAY')"
    ctes = f"""d AS {_items('p', "''", 'documents')},
r AS {names.format('page_roles')},
f AS (SELECT * FROM {names.format('folios')} UNION ALL SELECT * FROM {names.format('ordered_file_names')})"""
    return _wrap("extractions", ctes, [
        _array("p", "''", "documents"), _objects("d", "path"),
        *[_array("d", "path || '.'", x) for x in ("folios", "page_roles", "ordered_file_names")],
        _scalar("d", "path", "document_type", "string"), _scalar("d", "path", "client_name", "string", False),
        _scalar("d", "path", "confidence_score", "int", True, "CAST(json_extract(o, '$.confidence_score') AS BIGINT) NOT BETWEEN 0 AND 100"),
        _scalar("d", "path", "reasoning", "string"),
        "SELECT payload_id, path || ':type' FROM f WHERE json_type(o) <> 'VARCHAR'",
        _objects("r", "path"), _scalar("r", "path", "file_name", "string"), _scalar("r", "path", "evidence", "string"),
        _scalar("r", "path", "role", "string", True,
                "json_extract_string(o, '$.role') NOT IN ('INICIO', 'INTERMEDIA', 'CIERRE', 'UNICA', 'HUERFANA')")])


def orientation_validation_sql() -> str:
    return _wrap("orientation_answers", f"""d AS {_items('p', "''", 'orientations')}""", [
        _array("p", "''", "orientations"), _objects("d", "path"), _scalar("d", "path", "file_name", "string"),
        _scalar("d", "path", "rotation_degrees", "int", True, "CAST(json_extract(o, '$.rotation_degrees') AS BIGINT) NOT IN (0, 90, 180, 270)"),
        _scalar("d", "path", "reasoning", "string")])
