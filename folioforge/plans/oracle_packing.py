"""DuckDB oracles of the packing folds: recursive CTEs over lanes."""

from __future__ import annotations

from .fixtures import oracle

NEXT_FIT_MAX = 20
BURST_MAX = 50
BURST_GAP_S = 300
BATCH_SIZE = 15


def pack_next_fit_sql() -> str:
    return oracle(["files"], f"""
f AS (SELECT file_id, lane, n_pages, row_number() OVER (PARTITION BY lane ORDER BY file_name) AS rn FROM files),
r AS (SELECT lane, rn, file_id, n_pages AS cur, CAST(0 AS BIGINT) AS lot_no FROM f WHERE rn = 1
      UNION ALL
      SELECT f.lane, f.rn, f.file_id,
             CASE WHEN r.cur + f.n_pages > {NEXT_FIT_MAX} THEN f.n_pages ELSE r.cur + f.n_pages END,
             CASE WHEN r.cur + f.n_pages > {NEXT_FIT_MAX} THEN r.lot_no + 1 ELSE r.lot_no END
      FROM r JOIN f ON f.lane = r.lane AND f.rn = r.rn + 1)
SELECT file_id, lane, lot_no FROM r""", recursive=True)


BURSTS = f"""
f AS (SELECT event_id, file_name, lane, mtime,
             row_number() OVER (PARTITION BY lane ORDER BY mtime, file_name) AS rn FROM images),
r AS (SELECT lane, rn, event_id, file_name, mtime, 1 AS cnt, CAST(0 AS BIGINT) AS lot_no FROM f WHERE rn = 1
      UNION ALL
      SELECT f.lane, f.rn, f.event_id, f.file_name, f.mtime,
             CASE WHEN r.cnt >= {BURST_MAX} AND epoch_us(f.mtime) - epoch_us(r.mtime) >= {BURST_GAP_S * 1000000}
                  THEN 1 ELSE r.cnt + 1 END,
             CASE WHEN r.cnt >= {BURST_MAX} AND epoch_us(f.mtime) - epoch_us(r.mtime) >= {BURST_GAP_S * 1000000}
                  THEN r.lot_no + 1 ELSE r.lot_no END
      FROM r JOIN f ON f.lane = r.lane AND f.rn = r.rn + 1)"""


def pack_bursts_sql() -> str:
    return oracle(["images"], BURSTS + "\nSELECT event_id, lane, lot_no FROM r", recursive=True)


def pack_fixed_sql() -> str:
    return oracle(["images"], BURSTS + f""",
p AS (SELECT event_id, lane, lot_no,
             CAST(row_number() OVER (PARTITION BY lane, lot_no ORDER BY mtime, file_name) AS INTEGER) AS pos FROM r)
SELECT event_id, lane, lot_no, pos, CAST(floor((pos - 1) / {BATCH_SIZE}) AS INTEGER) AS batch_no FROM p""",
                  recursive=True)


def pack_next_fit_global_sql(max_pages: int) -> str:
    return oracle(["files"], f"""
f AS (SELECT file_id, n_pages, row_number() OVER (ORDER BY file_name) AS rn FROM files),
r AS (SELECT rn, file_id, n_pages AS cur, CAST(0 AS BIGINT) AS lot_no FROM f WHERE rn = 1
      UNION ALL
      SELECT f.rn, f.file_id,
             CASE WHEN r.cur + f.n_pages > {max_pages} THEN f.n_pages ELSE r.cur + f.n_pages END,
             CASE WHEN r.cur + f.n_pages > {max_pages} THEN r.lot_no + 1 ELSE r.lot_no END
      FROM r JOIN f ON f.rn = r.rn + 1)
SELECT file_id, lot_no FROM r""", recursive=True)


def pack_bursts_global_sql() -> str:
    return oracle(["images"], f"""
f AS (SELECT event_id, file_name, mtime, row_number() OVER (ORDER BY mtime, file_name) AS rn FROM images),
r AS (SELECT rn, event_id, mtime, 1 AS cnt, CAST(0 AS BIGINT) AS lot_no FROM f WHERE rn = 1
      UNION ALL
      SELECT f.rn, f.event_id, f.mtime,
             CASE WHEN r.cnt >= {BURST_MAX} AND epoch_us(f.mtime) - epoch_us(r.mtime) >= {BURST_GAP_S * 1000000}
                  THEN 1 ELSE r.cnt + 1 END,
             CASE WHEN r.cnt >= {BURST_MAX} AND epoch_us(f.mtime) - epoch_us(r.mtime) >= {BURST_GAP_S * 1000000}
                  THEN r.lot_no + 1 ELSE r.lot_no END
      FROM r JOIN f ON f.rn = r.rn + 1)
SELECT event_id, lot_no FROM r""", recursive=True)
