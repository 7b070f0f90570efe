"""Ledger with filters (S10), the report that grows by batches (A1, A2), the packing scan (K1, K2)."""

import os
import random

from pyspark.sql import functions as F

from folioforge.operators import packing as K
from folioforge.operators import report as RP
from folioforge.operators.report_store import ReportStore
from folioforge.sources import ledger as L


def names(spark, rows):
    return spark.createDataFrame([(n, i) for i, n in enumerate(rows)], "file_name string, i int")


def unseen(spark, rows, base):
    return sorted(r.file_name for r in L.unseen(spark, names(spark, rows), base).collect())


def test_nothing_twice_nothing_lost(spark, tmpdir_):
    rng, base = random.Random(1), f"{tmpdir_}/processed"
    assert unseen(spark, ["a"], base) == ["a"]
    pool, done = [f"f{i}.pdf" for i in range(3000)], set()
    for batch, n in enumerate((1, 40, 700)):
        some = rng.sample(pool, n)
        L.mark(spark, names(spark, some + some[:3]), base, f"b{batch}")
        done |= set(some)
        listing = rng.sample(pool, 900)
        assert unseen(spark, listing, base) == sorted(set(listing) - done)
    L.mark(spark, names(spark, ["again.pdf"]), base, "b2")  # a retry replaces its batch
    assert unseen(spark, ["again.pdf", "é ñ.pdf"], base) == ["é ñ.pdf"]
    assert sorted({r.batch for r in L.hits(spark, names(spark, ["again.pdf"]), base).collect()}) == ["b2"]


def test_false_hits_are_decided_exactly(spark, tmpdir_):
    base = f"{tmpdir_}/processed"
    old = [f"old{i}.pdf" for i in range(4000)]
    L.mark(spark, names(spark, old), base, "b0", bits_per_file=1)  # a crowded filter: most names hit it
    new = [f"new{i}.pdf" for i in range(500)]
    false = L.hits(spark, names(spark, new), base).count()
    assert false > 300
    assert unseen(spark, new + old[:50], base) == sorted(new)


def test_new_files_read_filters_only(spark, tmpdir_):
    base = f"{tmpdir_}/processed"
    L.mark(spark, names(spark, [f"old{i}" for i in range(1000)]), base, "b0")
    for f in os.listdir(f"{base}/batch=b0"):  # the names themselves are gone: nothing may look for them
        if f.endswith(".parquet"):
            with open(f"{base}/batch=b0/{f}", "wb") as out:
                out.write(b"broken")
    fresh = [f"new{i}" for i in range(200)]
    hit = {r.file_name for r in L.hits(spark, names(spark, fresh), base).collect()}
    assert len(hit) < 5
    fresh = [n for n in fresh if n not in hit]
    assert unseen(spark, fresh, base) == sorted(fresh)


def test_a_ledger_without_filters_is_read(spark, tmpdir_):
    base = f"{tmpdir_}/processed"
    names(spark, ["x", "y"]).select("file_name").write.parquet(f"{base}/batch=old")
    L.mark(spark, names(spark, ["z"]), base, "new")
    assert unseen(spark, ["w", "x", "z"], base) == ["w"]


RESULT = "folio string, categoria string, cliente string, archivo_original string, paginas_final int, status string, confianza int"


def test_report_by_batches_equals_a_full_rewrite(spark, tmpdir_):
    store = ReportStore(spark, f"{tmpdir_}/rep")
    assert store.read() is None
    batches = {"b1": [("A1", "Factura", None, "a.pdf", 1, "OK", 90)], "b2": [("A2", "Factura", None, "b.pdf", None, "OK", None)],
               "b3": [("A3", None, "Z", "c.pdf", 2, "OK", 1)], "b4": []}
    whole = None
    for k, (batch, rows) in enumerate(batches.items()):
        df = spark.createDataFrame(rows, RESULT)
        if batch == "b3":
            df = df.withColumn("ruta", F.lit("r"))  # a column that the others lack
        before = {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(f"{tmpdir_}/rep/rows") for f in fs}
        store.add(df, batch)
        after = {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(f"{tmpdir_}/rep/rows") for f in fs}
        assert {f: t for f, t in after.items() if f in before} == before  # one batch, one partition
        whole = df if whole is None else whole.unionByName(df, allowMissingColumns=True)
        want = sorted(map(tuple, RP.report(whole).collect()), key=str)
        got = store.read()
        assert got.columns == RP.report(whole).columns and sorted(map(tuple, got.collect()), key=str) == want
    store.add(spark.createDataFrame([("A9", "x", None, "z.pdf", 1, "OK", 3)], RESULT), "b3")  # replaced: its flags go too
    rows = store.read().collect()
    assert len(rows) == 3 and {r["Ruta del Archivo"] for r in rows} == {"N/A"} and {r["Cliente"] for r in rows} == {"N/A"}


def fold(rows, step):
    out, state = {}, {}
    for lane, name, feat, t in sorted(rows, key=lambda r: (r[0], r[3], r[1])):
        s, lot, last = state.get(lane, (None, 0, None))
        s, close = step(s, feat, t, last)
        lot += close
        state[lane] = (s, lot, t)
        out[lane, name] = lot
    return out


def test_scan_of_tables_over_many_partitions(spark, monkeypatch):
    """Three levels of the scan (blocks of 3 over 25 partitions), a hot lane, lanes that begin and end anywhere."""
    monkeypatch.setattr(K, "FAN", 3)
    rng = random.Random(7)
    lanes = ["a"] * 3 + ["h"] * 30 + list("xyz")
    rows = [(rng.choice(lanes), f"f{i:04d}", rng.choice([0, 1, 2, 5, 9, 11]), 0) for i in range(600)]
    df = spark.createDataFrame([(lane, n, p) for lane, n, p, _ in rows], "lane string, file_name string, n_pages int")

    def step(s, n, t, last):
        close = s is not None and s + n > 10
        return (n if s is None or close else s + n), close
    got = K.ordered_fold(df, K.NextFit(10), "lane", ["file_name"], feat_col="n_pages", num_partitions=25)
    assert {(r.lane, r.file_name): r.lot_no for r in got.collect()} == fold(rows, step)
    assert not any(hasattr(K, name) for name in ("_compose",))

    t, timed = 0, []
    for i in range(500):
        t += rng.choice([0, 1_000_000, 3_000_000, 5_000_000])
        timed.append((rng.choice(lanes), f"f{i:04d}", 1, t))
    df = spark.createDataFrame([(lane, n, u) for lane, n, _, u in timed], "lane string, file_name string, u long").withColumn(
        "mtime", F.timestamp_micros("u"))

    def burst(s, n, t, last):
        close = s is not None and s >= 4 and t - last >= 3_000_000
        return (1 if s is None or close else s + 1), close
    df = df.withColumn("_t", F.unix_micros("mtime"))
    got = K.ordered_fold(df, K.BurstLots(4), "lane", ["_t", "file_name"], gap_col="_t", gap_threshold_us=3_000_000, num_partitions=25)
    assert {(r.lane, r.file_name): r.lot_no for r in got.collect()} == fold(timed, burst)
