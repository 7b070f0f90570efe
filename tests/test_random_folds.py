"""Randomized checks of the order-dependent operators against sequential folds."""

import random

from pyspark.sql import functions as F

from folioforge.operators import context as CX
from folioforge.operators import packing as K
from folioforge.operators import versions
from folioforge.operators.scans import BLK, running_max
from folioforge.operators.versions import resolve_versions
from tests.folds import examples_expected, lots_of_bursts, lots_of_pages, versions_expected


import pytest  # noqa: E402


@pytest.mark.parametrize("seed,block", [(7, 512), (8, 512), (9, 512), (10, 1), (11, 2), (12, 3)])
def test_versions_match_sequential_fold(spark, monkeypatch, seed, block):
    monkeypatch.setattr(versions, "LOT_BLOCK", block)
    rng = random.Random(seed)
    ev_rows, reg_rows, seq_events = [], [], []
    registry = {}
    for key in ["A1", "A2", "ERR"]:
        for cat in ["Factura", "Remisión"]:
            if rng.random() < 0.5:
                for v, o in enumerate(rng.sample(["o1", "o2", "o3", "o4"], rng.randint(1, 3)), start=1):
                    s = rng.choice([None, 10, 50, 90])
                    registry.setdefault((key, cat), []).append((o, v, s))
                    reg_rows.append((key, cat, o, v, s))
    seq = 0
    for lot in range(10):
        for _ in range(rng.randint(5, 25)):
            seq += 1
            key, cat = rng.choice(["A1", "A2", "ERR", "ERR", "ERR"]), rng.choice(["Factura", "Remisión"])
            origin, conf = rng.choice([f"o{i}" for i in range(1, 13)]), rng.randint(0, 100)
            for cat_idx in range(rng.choice([1, 1, 2])):
                ev_rows.append((key, cat, origin, lot, seq, cat_idx, conf))
                seq_events.append((key, cat, origin, conf))
    expected = versions_expected(seq_events, registry)
    events = spark.createDataFrame(ev_rows, "folio_key string, cat string, origen string, lot_id int, "
                                            "seq long, cat_idx int, confianza int")
    reg = spark.createDataFrame(reg_rows, "folio_key string, cat string, origen string, version int, score int")
    got = resolve_versions(events, reg).orderBy("lot_id", "seq", "cat_idx").select("version", "accion").collect()
    assert [(r.version, r.accion) for r in got] == expected


def test_scores_of_one_origin_over_very_many_lots(spark):
    """All image lots share one origin: its carries are windows over blocks of lots, not over its lots."""
    n, block = 20_000, versions.LOT_BLOCK
    events = spark.range(n).select(
        F.lit("ERR").alias("folio_key"), F.lit("No").alias("cat"), F.lit("images").alias("origen"),
        F.col("id").cast("int").alias("lot_id"), F.col("id").alias("seq"), F.lit(0).alias("cat_idx"),
        ((F.col("id") * 7919) % 9973).cast("int").alias("confianza"))
    best, expected = -1, []
    for i in range(n):
        c = i * 7919 % 9973
        expected.append("NUEVO" if not i else "SOBRESCRIBIR" if c >= best else "DESCARTAR")
        best = max(best, c)
    got = resolve_versions(events).orderBy("lot_id").select("version", "accion").collect()
    assert [r.accion for r in got] == expected and {r.version for r in got} == {1}
    lots = events.select("origen", "lot_id", "confianza")
    rows, blocks = running_max(lots, ["origen"], "lot_id", "confianza", "before", block)
    assert blocks.count() == -(-n // block)
    assert rows.groupBy("origen", BLK).count().agg(F.max("count")).first()[0] == block


def test_next_fit_matches_fold_across_partitions(spark):
    rng = random.Random(11)
    rows, by_lane = [], {}
    for i in range(3000):
        lane = 0 if rng.random() < 0.4 else rng.randint(1, 6)   # lane 0 is hot
        n = rng.choice([0, 1, 2, 3, 5, 8, 25])                   # zero and oversized files
        rows.append((i, f"f{i:06d}", lane, n))
        by_lane.setdefault(lane, []).append((f"f{i:06d}", n, i))
    df = spark.createDataFrame(rows, "file_id long, file_name string, lane int, n_pages int")
    out = K.ordered_fold(df, K.NextFit(20), "lane", ["file_name"], feat_col="n_pages", num_partitions=13)
    got = {r.file_id: r.lot_no for r in out.collect()}
    for lane, files in by_lane.items():
        files.sort()
        exp = lots_of_pages([n for _, n, _ in files], 20)
        assert [got[i] for _, _, i in files] == exp, lane


def test_bursts_match_fold_across_partitions(spark):
    rng = random.Random(5)
    rows, by_lane = [], {}
    t = {lane: 0.0 for lane in range(4)}
    for i in range(2500):
        lane = rng.choice([0, 0, 0, 1, 2, 3])
        t[lane] += rng.choice([0.5, 1.0, 2.999999, 3.0, 3.000001, 10.0])
        rows.append((i, f"img{i:05d}", lane, t[lane]))
        by_lane.setdefault(lane, []).append((t[lane], f"img{i:05d}", i))
    df = spark.createDataFrame(rows, "event_id long, file_name string, lane int, secs double") \
        .withColumn("mtime", F.timestamp_micros(F.round(F.col("secs") * 1_000_000).cast("long")))
    out = K.pack_bursts(df, 7, 3.0, lane_col="lane")
    got = {r.event_id: r.lot_no for r in out.collect()}
    for lane, ims in by_lane.items():
        ims.sort()
        exp = lots_of_bursts([round(tt * 1e6) for tt, _, _ in ims], 7, 3_000_000)  # exact microseconds
        assert [got[i] for _, _, i in ims] == exp, lane


def test_examples_match_fold(spark):
    rng = random.Random(3)
    rows, seqs = [], {}
    seq = 0
    for lot in range(8):
        for _ in range(rng.randint(5, 40)):
            seq += 1
            pool = ["A1", "A2", "A3", "A4"] if lot % 2 else [f"A{rng.randint(1, 30)}", f"P{rng.randint(1, 5)}"]
            f = rng.choice(pool)
            rows.append((lot, seq, 0, f, "Factura", "x"))
            seqs.setdefault(f[0], []).append(f)
    res = spark.createDataFrame(rows, "lot_id int, seq long, cat_idx int, folio string, categoria string, cliente string")
    got = {r.prefix: r.ejemplos for r in CX.examples(res, CX.seed_prefixes(spark)).collect()}
    for p, fs in seqs.items():
        assert got[p] == examples_expected(fs), p
    assert got["R"] == [] and got["O"] == []


def test_packing_without_page_count_or_time(spark):
    files = spark.createDataFrame([("a", 5), ("b", None), ("c", 5), ("d", 1)], "file_name string, n_pages int")
    assert {r.file_name: r.lot_no for r in K.pack_next_fit(files, 10).collect()} == {"a": 0, "c": 0, "d": 1}
    assert [r.key for r in K.unreadable_files(files).collect()] == ["b"]
    images = spark.createDataFrame([("x", None), ("w", None), ("p", 10.0), ("q", 11.0), ("r", 30.0)], "file_name string, s double") \
        .withColumn("mtime", F.timestamp_micros(F.round(F.col("s") * 1_000_000).cast("long")))
    assert {r.file_name: r.lot_no for r in K.pack_bursts(images, 1, 3.0).collect()} == {"w": 0, "x": 1, "p": 2, "q": 2, "r": 3}
    assert K.pack_next_fit(files.limit(0), 10).count() == 0


def test_pass2_carries_state_over_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        test_next_fit_matches_fold_across_partitions(spark)
        test_bursts_match_fold_across_partitions(spark)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_examples_fold_a_tail_where_each_lot_has_one_result(spark):
    """One result a lot: the fold still starts at a window of distinct folios, not at the beginning."""
    rows = [(lot, lot, 0, f"A{lot % 4000}", "Factura", "X") for lot in range(3000)]
    df = spark.createDataFrame(rows, "lot_id int, seq long, cat_idx int, folio string, categoria string, cliente string")
    out = CX.examples(df, CX.seed_prefixes(spark))
    got = {r.prefix: r.ejemplos for r in out.collect()}
    assert got["A"] == examples_expected([r[3] for r in rows])
    assert out.filter("prefix = 'A'").count() == 1
