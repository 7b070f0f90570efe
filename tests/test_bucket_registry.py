"""The registry in buckets: copy on write, violations across old and new rows, retries."""

import os
import random

import pytest
from pyspark.sql import functions as F

from folioforge.operators import bucket_registry as B
from folioforge.operators import registry as R

RESULT = ("lot_id int, seq long, cat_idx int, folio string, folio_key string, categoria string, version int, archivo_original string, "
          "cliente string, paginas_final int, status string, confianza int, ruta string")


def results(spark, rows):
    """rows: (folio, categoria, version, origin, score, route)"""
    return spark.createDataFrame([(0, i, 0, f, None, c, v, o, "X", 1, "OK", s, r) for i, (f, c, v, o, s, r) in enumerate(rows)], RESULT)


def put(spark, base, batch, rows, ts="2026-01-01 00:00:00"):
    old = R.base_of_batch(spark, base, batch)
    target = R.write_snapshot(spark, B.PendingUpsert(spark, old, results(spark, rows), base, ts), base, batch)
    R.point_at(spark, target, base)
    return B.load(spark, target, base)


def files(base):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(base) for f in fs if f.endswith(".parquet")}


def rows_of(df):
    return sorted(map(tuple, df.select(*R.REGISTRY_COLUMNS).collect()), key=str)


def test_equals_whole_table_upserts(spark, tmpdir_, monkeypatch):
    for name, value in {"LANES": 4, "PARTS": 2, "INDEX_BUCKETS": 4}.items():
        monkeypatch.setattr(B, name, value)
    rng = random.Random(1)
    base, plain = f"{tmpdir_}/reg", None
    for batch in range(3):
        rows = []
        for _ in range(60):
            f, c, v, o = f"A{rng.randrange(15)}", rng.choice(["Factura", "Remisión"]), rng.randint(1, 2), f"{rng.randrange(6)}.pdf"
            rows.append((f, c, v, o, rng.randint(0, 100), f"{c}/{f}_{v}_{o}_{rng.randrange(2)}"))
        ts = f"2026-01-0{batch + 1} 00:00:00"
        stored = plain if plain is not None else spark.createDataFrame([], B.ROW_SCHEMA)
        plain = spark.createDataFrame(R.upsert(stored, results(spark, rows), ts).collect(), B.ROW_SCHEMA)
        manifest = put(spark, base, f"b{batch}", rows, ts)
        assert rows_of(manifest.read(spark)) == rows_of(plain)
        got = sorted(map(tuple, manifest.read(spark, "unique").collect()), key=str)
        assert got == sorted(map(tuple, B.entries_of(plain).collect()), key=str)
    assert rows_of(R.current(spark, base)) == rows_of(plain)


def test_untouched_buckets_keep_their_files(spark, tmpdir_):
    base = f"{tmpdir_}/reg"
    first = put(spark, base, "b1", [(f"A{i}", "Factura", 1, "a.pdf", 50, f"r/{i}") for i in range(200)])
    before = files(base)
    second = put(spark, base, "b2", [("A7", "Factura", 1, "a.pdf", 90, "r/seven"), ("NEW", "Factura", 1, "n.pdf", 10, "r/new")])
    assert {p: t for p, t in files(base).items() if p in before} == before
    moved = [b for b, p in second.tables["rows"].items() if first.tables["rows"].get(b) != p]
    assert 1 <= len(moved) <= 2 and len(second.tables["rows"]) > 20
    assert sum("b2" in p for p in second.tables["unique"].values()) <= 5
    got = {r.folio: r for r in R.current(spark, base).collect()}
    assert len(got) == 201 and got["A7"].confianza_promedio == 90 and got["A7"].ruta_servidor == "r/seven"
    stale = B.unreferenced(spark, [second], base)
    assert stale and all("b1" in p for p in stale) and B.unreferenced(spark, [first, second], base) == []


def test_route_taken_by_a_row_that_the_batch_does_not_read(spark, tmpdir_):
    base = f"{tmpdir_}/reg"
    put(spark, base, "b1", [(f"A{i}", "Factura", 1, "a.pdf", 50, f"r/{i}") for i in range(40)])
    before = rows_of(R.current(spark, base))
    with pytest.raises(ValueError, match="unique_route r/31"):
        put(spark, base, "b2", [("ZZ", "Remisión", 1, "z.pdf", 50, "r/31")])
    assert rows_of(R.current(spark, base)) == before
    # the route is free once its owner has moved away, in the same batch or an earlier one
    put(spark, base, "b3", [("A31", "Factura", 1, "a.pdf", 50, "r/elsewhere"), ("ZZ", "Remisión", 1, "z.pdf", 50, "r/31")])
    put(spark, base, "b4", [("YY", "Remisión", 1, "y.pdf", 50, "r/9b"), ("A9", "Factura", 1, "a.pdf", 50, "r/9c")])
    put(spark, base, "b5", [("WW", "Remisión", 1, "w.pdf", 50, "r/9")])
    assert R.constraint_violations(R.current(spark, base)).count() == 0
    with pytest.raises(ValueError, match="length:categoria"):
        put(spark, base, "b6", [("A1", "F" * 101, 1, "a.pdf", 50, "r/long")])


def test_retry_gives_the_same_manifest(spark, tmpdir_, monkeypatch):
    base, rows = f"{tmpdir_}/reg", [(f"A{i}", "Factura", 1, "a.pdf", 50, f"r/{i}") for i in range(30)]
    put(spark, base, "b1", rows)
    change = [("A3", "Factura", 1, "a.pdf", 99, "r/3x"), ("B1", "Factura", 1, "b.pdf", 1, "r/b")]
    with monkeypatch.context() as m:
        m.setattr(B, "write_pointer", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            put(spark, base, "b2", change)
    written = files(base)
    again = put(spark, base, "b2", change)
    assert {p: t for p, t in files(base).items() if p in written} == written  # complete folders are kept
    assert put(spark, base, "b2", change).dump() == again.dump()              # and after it was published
    assert R.current(spark, base).count() == 31


def test_hot_key_spreads_over_parts(spark, tmpdir_):
    rows = [("ERROR_DOCUMENTO_ILEGIBLE", "No identificado", 1, f"{i}.pdf", 0, f"r/{i}") for i in range(300)]
    manifest = put(spark, f"{tmpdir_}/reg", "b1", rows)
    assert len(manifest.tables["rows"]) == B.PARTS
    keys = spark.createDataFrame([("ERROR_DOCUMENTO_ILEGIBLE", "No identificado"), ("nothing", "x")], "folio_key string, cat string")
    assert manifest.lookup(spark, keys).count() == 300
    scan = manifest.lookup(spark, keys.where("cat = 'x'"))
    assert scan.where(F.col("folio") == "ERROR_DOCUMENTO_ILEGIBLE").count() in (0, 300)  # other lanes are not read


def test_older_snapshot_becomes_buckets(spark, tmpdir_):
    base = f"{tmpdir_}/reg"
    old = R.upsert(spark.createDataFrame([], B.ROW_SCHEMA), results(spark, [("A1", "Factura", 1, "a.pdf", 5, "r/1")]), "2026-01-01 00:00:00")
    R.publish(spark, old, base, "b0")
    put(spark, base, "b1", [("A2", "Factura", 1, "a.pdf", 5, "r/2")])
    assert sorted(r.folio for r in R.current(spark, base).collect()) == ["A1", "A2"]
    with pytest.raises(ValueError, match="unique_route"):
        put(spark, base, "b2", [("A3", "Factura", 1, "a.pdf", 5, "r/1")])
