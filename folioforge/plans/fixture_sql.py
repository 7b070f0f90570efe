"""Fixture views: the audit's domain tables derived from the driver tables.

Each view is one SQL text that runs unchanged in Spark SQL and DuckDB, so the
Spark side and the oracle side start from identical inputs.
"""

from __future__ import annotations

FIXTURE_SQL = {
    "items": """
SELECT ((l_orderkey*8 + l_linenumber)*1000000 + l_partkey)*10000 + l_suppkey AS seq,
  CAST(floor(l_orderkey / 500) AS INT) AS lot_id,
  concat(CASE CAST(l_partkey % 7 AS INT) WHEN 0 THEN 'A' WHEN 1 THEN 'P' WHEN 2 THEN 'R' WHEN 3 THEN 'O'
              WHEN 4 THEN 'a ' WHEN 5 THEN 'B/' ELSE '' END,
         CASE WHEN l_partkey % 97 = 0 THEN '##' ELSE CAST(l_orderkey % 200 AS STRING) END) AS folio,
  CASE WHEN l_partkey % 53 = 0 THEN ' , ' WHEN l_partkey % 59 = 0 THEN 'Orden/compra'
       WHEN l_returnflag = 'A' THEN 'Factura' WHEN l_returnflag = 'N' THEN 'Remisión'
       ELSE 'Factura, Remisión' END AS categoria,
  CASE WHEN c_acctbal < 0 THEN 'NO DETECTADO' WHEN c_custkey % 11 = 0 THEN NULL ELSE c_name END AS cliente,
  CAST((l_partkey*7 + l_linenumber*13 + l_suppkey) % 101 AS INT) AS confianza,
  concat('motivo ', CAST(l_linenumber AS STRING)) AS justificacion,
  concat('scan_', CAST(l_suppkey % 5 AS STRING), '.pdf') AS origen,
  concat('L', CAST(l_orderkey AS STRING), '_P', lpad(CAST(l_linenumber AS STRING), 3, '0')) AS pagina
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
""",
    "files": """
SELECT o_orderkey AS file_id,
  concat('scan ', lpad(CAST(o_orderkey AS STRING), 8, '0'), '.pdf') AS file_name,
  CAST(o_custkey % 25 AS INT) AS lane, CAST(coalesce(n, 0) + 1 AS INT) AS n_pages
FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey) x ON l_orderkey = o_orderkey
""",
    "images": """
SELECT event_id,
  concat('img_', lpad(CAST(event_id AS STRING), 8, '0'), CASE CAST(event_id % 3 AS INT) WHEN 0 THEN '.jpg' WHEN 1 THEN '.JPEG' ELSE '.png' END) AS file_name,
  CAST(user_id % 10 AS INT) AS lane, ts AS mtime
FROM events
""",
    "registry": """
SELECT folio_key, cat, origen, CAST(row_number() OVER (PARTITION BY folio_key, cat ORDER BY origen) AS INT) AS version, score
FROM (SELECT folio_key, cat, origen, max(score) AS score FROM (
  SELECT concat(CASE CAST(p_partkey % 4 AS INT) WHEN 0 THEN 'A' WHEN 1 THEN 'P' WHEN 2 THEN 'R' ELSE 'O' END,
                CAST(CAST(floor(p_partkey / 4) AS INT) % 200 AS STRING)) AS folio_key,
         CASE WHEN p_size % 2 = 0 THEN 'Factura' ELSE 'Remisión' END AS cat,
         concat('scan_', CAST(p_size % 7 AS STRING), '.pdf') AS origen,
         CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_size * 2 END AS score
  FROM part) t0 GROUP BY folio_key, cat, origen) t1
""",
    "batch_pages": """
SELECT o_custkey AS batch_id, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS INT) AS page_no, o_orderkey,
  concat('c', CAST(o_custkey AS STRING), '_O', lpad(CAST(o_orderkey AS STRING), 6, '0'), '.pdf') AS file_name
FROM orders
""",
    "doc_pages": """
SELECT o_custkey AS batch_id, o_orderkey AS doc_idx, 0 AS pos,
  CASE WHEN o_orderkey % 13 = 0 THEN 'inventado.pdf'
       WHEN o_orderkey % 5 = 0 THEN concat(' "c', CAST(o_custkey AS STRING), '_O', lpad(CAST(o_orderkey AS STRING), 6, '0'), '.pdf" ')
       ELSE concat('c', CAST(o_custkey AS STRING), '_O', lpad(CAST(o_orderkey AS STRING), 6, '0'), '.pdf') END AS file_name
FROM orders WHERE o_orderpriority <> '5-LOW'
""",
    "doc_folios": """
SELECT o_custkey AS batch_id, o_orderkey AS doc_idx, 0 AS folio_idx, concat('A', CAST(o_orderkey AS STRING)) AS folio
FROM orders WHERE o_orderpriority <> '5-LOW' AND o_orderkey % 41 <> 0
UNION ALL SELECT o_custkey, o_orderkey, 1, concat('R-', CAST(o_orderkey AS STRING)) FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderkey % 41 <> 0
""",
    "batches": """
SELECT c_custkey AS batch_id, CASE WHEN c_custkey % 4 = 0 THEN 'image' ELSE 'pdf' END AS kind,
  CAST(CASE WHEN c_custkey % 4 = 0 THEN floor(c_custkey / 32) ELSE floor(c_custkey / 8) END AS BIGINT) AS lot_no,
  CASE WHEN c_custkey % 4 = 0 THEN 'LOTE_FOTOGRAFICO_CONSOLIDADO'
       ELSE concat('scan ', lpad(CAST(CAST(floor(c_custkey / 2) AS BIGINT) AS STRING), 8, '0'), '.pdf') END AS origen
FROM customer
""",
    "doc_fields": """
SELECT o_custkey AS batch_id, o_orderkey AS doc_idx,
  CASE CAST(o_orderkey % 5 AS INT) WHEN 0 THEN 'Factura, Remisión' WHEN 1 THEN 'Factura' WHEN 2 THEN ' , '
       WHEN 3 THEN '../Pedido' ELSE 'Remisión' END AS categoria,
  CASE WHEN c_acctbal < 0 THEN 'NO DETECTADO' ELSE c_name END AS cliente,
  CAST((o_orderkey * 7) % 101 AS INT) AS confianza, concat('motivo ', CAST(o_orderkey % 9 AS STRING)) AS justificacion
FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderpriority <> '5-LOW'
""",
    "answers": """
SELECT o_custkey AS batch_id, CAST(rn AS INT) AS ord,
  CASE CAST(o_orderkey % 4 AS INT) WHEN 0 THEN concat('page_', lpad(CAST(rn AS STRING), 3, '0'), '.pdf') WHEN 1 THEN concat(' PAGE_', lpad(CAST(rn AS STRING), 3, '0'), '.PDF')
       WHEN 2 THEN concat('"page_', lpad(CAST(rn AS STRING), 3, '0'), '"') ELSE 'page_999.pdf' END AS name_given,
  CAST((o_orderkey % 5) * 90 AS INT) AS rotation_degrees
FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders) t0
""",
    "members": """
SELECT concat('zip_', CAST(page_id % 7 AS STRING), '.zip') AS archive, page_id AS ord,
  concat(CASE CAST(page_id % 6 AS INT) WHEN 0 THEN '__MACOSX/' WHEN 1 THEN '.oculto/' ELSE 'a/b/' END,
         CASE CAST(page_id % 5 AS INT) WHEN 0 THEN '._' WHEN 1 THEN '~' ELSE '' END,
         'doc_', CAST(page_id % 40 AS STRING),
         CASE CAST(page_id % 7 AS INT) WHEN 0 THEN '.txt' WHEN 1 THEN '/' WHEN 2 THEN '.PDF' WHEN 3 THEN '.jpeg' ELSE '.pdf' END) AS member
FROM pages
""",
    "payloads": """
SELECT o_orderkey AS payload_id,
  CASE WHEN o_orderkey % 17 = 0 THEN '{mal' ELSE concat('{"file_name":"p', CAST(o_orderkey AS STRING), '.pdf","rotation_degrees":',
    CASE CAST(o_orderkey % 7 AS INT) WHEN 5 THEN '"90"' WHEN 6 THEN '45' ELSE CAST((o_orderkey % 7) % 4 * 90 AS STRING) END,
    ',"role":"', CASE CAST(o_orderkey % 6 AS INT) WHEN 0 THEN 'INICIO' WHEN 1 THEN 'INTERMEDIA' WHEN 2 THEN 'CIERRE' WHEN 3 THEN 'UNICA' WHEN 4 THEN 'HUERFANA' ELSE 'PORTADA' END,
    '","confidence_score":', CAST(o_orderkey % 110 AS STRING), '}') END AS body
FROM orders
""",
    "extractions": """
SELECT o_orderkey AS payload_id,
  CASE WHEN o_orderkey % 23 = 0 THEN '{mal' WHEN o_orderkey % 29 = 0 THEN '{"documents":{}}' WHEN o_orderkey % 31 = 0 THEN '{"documents":[]}'
       WHEN o_orderkey % 37 = 0 THEN '[1]' WHEN o_orderkey % 41 = 0 THEN '{"documents":[3,{"folios":[]}]}'
  ELSE concat('{"documents":[{"folios":', CASE CAST(o_orderkey % 11 AS INT) WHEN 0 THEN '["A",1]' WHEN 1 THEN '"A1"' ELSE concat('["A', CAST(o_orderkey AS STRING), '"]') END,
    ',"page_roles":[{"file_name":"p1.pdf","role":"', CASE CAST(o_orderkey % 6 AS INT) WHEN 0 THEN 'INICIO' WHEN 1 THEN 'INTERMEDIA' WHEN 2 THEN 'CIERRE' WHEN 3 THEN 'UNICA' WHEN 4 THEN 'HUERFANA' ELSE 'PORTADA' END,
    '","evidence":', CASE WHEN o_orderkey % 13 = 0 THEN 'null' ELSE '"e"' END, '},{"file_name":"p2.pdf","role":"CIERRE","evidence":"f"}],"ordered_file_names":["p1.pdf","p2.pdf"],"document_type":"Factura"',
    CASE CAST(o_orderkey % 4 AS INT) WHEN 0 THEN ',"client_name":null' WHEN 1 THEN ',"client_name":"C"' WHEN 2 THEN ',"client_name":7' ELSE '' END,
    ',"confidence_score":', CASE CAST(o_orderkey % 7 AS INT) WHEN 0 THEN '105' WHEN 1 THEN '"90"' WHEN 2 THEN '90.5' ELSE CAST(o_orderkey % 101 AS STRING) END,
    CASE WHEN o_orderkey % 17 = 0 THEN '' ELSE ',"reasoning":"r"' END, '}',
    CASE WHEN o_orderkey % 3 = 0 THEN concat(',{"folios":[],"page_roles":[],"ordered_file_names":[],"document_type":"Pedido","confidence_score":', CAST(o_orderkey % 120 AS STRING), ',"reasoning":"s"}') ELSE '' END, ']}') END AS body
FROM orders
""",
    "orientation_answers": """
SELECT o_orderkey AS payload_id, CASE WHEN o_orderkey % 27 = 0 THEN '{"orientations":null}' ELSE
  concat('{"orientations":[{"file_name":"p', CAST(o_orderkey AS STRING), '.pdf","rotation_degrees":',
    CASE CAST(o_orderkey % 9 AS INT) WHEN 7 THEN '"90"' WHEN 8 THEN '45' ELSE CAST((o_orderkey % 4) * 90 AS STRING) END,
    CASE WHEN o_orderkey % 19 = 0 THEN '' ELSE ',"reasoning":"t"' END, '},{"file_name":', CASE WHEN o_orderkey % 5 = 0 THEN 'null' ELSE '"q.pdf"' END,
    ',"rotation_degrees":270,"reasoning":"u"}]}') END AS body
FROM orders
""",
    "page_text": """
SELECT source AS origin, doc_id AS page_no, text, contains(lower(text), 'ation') AS has_header, contains(lower(text), 'ment') AS has_footer FROM documents
""",
}
