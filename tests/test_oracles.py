"""Every registered query against its DuckDB oracle (the driver's correctness gate).

Runs at sf0.01 (where the item order is total); set FOLIOFORGE_SKIP_ORACLES=1
to skip, FOLIOFORGE_ORACLE_SF to point at another scale.
"""

import hashlib
import os

import duckdb
import pytest

import __spark_entry__ as E
from folioforge.plans.fixtures import BASE_TABLES
from folioforge.plans.queries import ORACLES, QUERIES

SF = os.environ.get("FOLIOFORGE_ORACLE_SF", "/root/testdata/sf0.01")
SKIP = os.environ.get("FOLIOFORGE_SKIP_ORACLES") == "1"


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        return f"{v:.6g}"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("\x1f".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    yield con
    con.close()


@pytest.mark.skipif(SKIP, reason="oracle suite skipped")
@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    rel = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in rel.description]
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert _digest(df.columns, srows) == _digest(ocols, orows)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "folio" in df.columns
