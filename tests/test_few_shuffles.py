"""Few shuffles, and none kept: items of a batch and a lot, versions by key, written tables."""

import random

from pyspark.sql import functions as F

from folioforge import session
from folioforge.operators import pages as P
from folioforge.operators import versions as V
from folioforge.operators.reduce import reduce_items
from folioforge.operators.results import assemble_results, results_of_items
from folioforge.plans import queries as Q
from folioforge.plans.batch_run import split_orphans

SF = "/root/testdata/sf0.001"
EVENT = "folio_key string, cat string, origen string, lot_id int, seq long, cat_idx int, confianza int, note string"
REG = "folio_key string, cat string, origen string, version int, score int"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_results_with_orphans_shuffle_each_input_once(spark):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set(session.ALL_KEYS_CONF, "false")
    try:
        items = _plan(Q._full_items(spark, SF))
        # pages twice (the view numbers them), instructions, folios, orders and customers, batches; items by their lot
        assert items.count("Exchange hashpartitioning(") <= 8 and items.count("Exchange hashpartitioning(lot_id") == 1
    finally:
        spark.conf.unset(session.ALL_KEYS_CONF)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    plan = _plan(Q.q_results_with_orphans(spark, SF))
    # events and orphans are read as written; the events are shuffled once, by their key
    assert plan.count("Exchange ") == 1 and "hashpartitioning(folio_key" in plan and "orders" not in plan


def test_a_written_table_leaves_no_shuffle_files(spark):
    def files():
        blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks().mkString(" ")
        return {b for b in blocks.split() if b.startswith("shuffle_")}
    before = files()
    df = spark.range(2000).groupBy((F.col("id") % 50).alias("k")).agg(F.sum("id").alias("s"))
    written = session.materialize(df, "test", part_of_keys=True)
    assert not files() - before
    assert sorted(map(tuple, written.collect())) == sorted(map(tuple, df.collect()))
    assert spark.conf.get(session.CLEANUP_CONF) == "false" and spark.conf.get(session.ALL_KEYS_CONF) == "true"


def test_versions_by_key_are_those_by_blocks(spark, monkeypatch):
    """Hot and other keys, stored origins, repeated places, missing seqs, confidences and keys."""
    rnd = random.Random(7)
    rows, seq = [], 0
    for _ in range(900):
        seq += rnd.randrange(1, 4)
        key = "HOT" if rnd.random() < 0.4 else f"A{rnd.randrange(40)}"
        rows.append((rnd.choice([key] * 19 + [None]), rnd.choice("xy"), rnd.choice(["o1", "o2", f"o{rnd.randrange(50)}", None]),
                     rnd.choice([seq % 7, rnd.randrange(2000), None]), seq if rnd.random() < 0.9 else -seq, rnd.randrange(2),
                     rnd.choice([None, *range(0, 100, 9)]), f"n{seq}"))
    rows += [("A1", "x", "q1", 1, None, 0, 5, "u1"), ("A1", "x", "q2", 1, None, 0, 5, "u2"), ("A1", "x", "q1", 1, 3, 0, 4, "u3")]
    ev = spark.createDataFrame(rows, EVENT)
    reg = spark.createDataFrame([("HOT", "x", "o1", 3, 50), ("HOT", "x", "o1", 2, None), ("A1", "x", "o2", 1, 20), ("A2", "y", None, 4, 1),
                                 ("HOT", "y", "other", 9, 9), ("A3", "x", "o1", None, 90), (None, "x", "o1", 5, 5), ("Z", "x", "o1", 5, 5)], REG)

    def rows_of(df):
        return sorted(map(str, df.select(*ev.columns, "version", "accion").collect()))
    for registry in (None, reg):
        want = rows_of(V.resolve_versions(ev, registry, materialize_events=False))
        n, hot = V.hot_buckets(ev, registry)
        assert not hot
        assert rows_of(V.resolve_versions(ev, registry)) == want
        with monkeypatch.context() as m:
            m.setattr(V, "FEW_EVENTS", 10)
            n, hot = V.hot_buckets(ev, registry)
            assert 0 < len(hot) < n and ev.filter(~V.key_bucket(n).isin(*hot)).count() > 0
            assert rows_of(V.resolve_versions(ev, registry)) == want


def _odd_batches(spark):
    """Repeated and missing names, pages named twice, documents without pages, folios or fields, batches without a lot."""
    pages = spark.createDataFrame([(1, 1, "a.pdf"), (1, 2, "b.pdf"), (1, 2, "b.pdf"), (1, 3, None), (1, 4, "c.pdf"), (1, 5, "d.pdf"),
                                   (2, 1, "a.pdf"), (2, 2, "z.tar.pdf"), (3, 1, "x.pdf"), (None, 1, "a.pdf"), (9, 1, "no lot.pdf")],
                                  "batch_id long, page_no int, file_name string")
    told = spark.createDataFrame([(1, 10, 0, " 'a.pdf' "), (1, 10, 1, "c.pdf"), (1, 11, 0, "b.pdf"), (1, 12, 0, "invented.pdf"),
                                  (1, 13, 0, "c.pdf"), (1, None, 0, "d.pdf"), (2, 10, 0, "a.pdf"), (1, 14, 0, None), (None, 10, 0, "a.pdf")],
                                 "batch_id long, doc_idx long, pos int, file_name string")
    folios = spark.createDataFrame([(1, 10, 0, "A1"), (1, 10, 1, "A2"), (1, 11, 0, "A1"), (1, 12, 0, "B"), (1, None, 0, "N"), (2, 10, 0, None),
                                    (None, 10, 0, "A1")], "batch_id long, doc_idx long, folio_idx int, folio string")
    fields = spark.createDataFrame([(1, 10, "Factura, X", "C", 50, "r"), (1, 11, "Factura, X", None, 60, None), (1, 13, "F", "D", 7, "s"),
                                    (2, 10, "../F", "E", 8, "t"), (1, None, "F", "G", 1, "u")],
                                   "batch_id long, doc_idx long, categoria string, cliente string, confianza int, justificacion string")
    lots = spark.createDataFrame([(1, 5, "s.pdf", "PDF"), (2, 5, "s.pdf", "PDF"), (3, None, "t.pdf", "PDF"), (None, 5, "s.pdf", "PDF")],
                                 "batch_id long, lot_id long, origen string, tipo_origen string")
    return lots, pages, fields, told, folios


def test_full_items_of_odd_batches(spark):
    lots, pages, fields, told, folios = _odd_batches(spark)
    got = P.full_items(lots, pages, fields, told, folios, ["batch_id"])
    items, orphans = P.map_documents(pages, told, folios, ["batch_id"])
    cols = ["batch_id", "folio", "categoria", "cliente", "confianza", "justificacion", "paginas", "paginas_original", "is_orphan"]
    want = items.join(fields, ["batch_id", "doc_idx"]).select(*cols, F.lit(None).cast("string").alias("orphan_name")) \
        .unionByName(orphans.select(*cols, "orphan_name")).join(lots, ["batch_id"])
    assert got.columns == [*want.columns, "seq"]
    rows = sorted(got.collect(), key=lambda r: r.seq)
    assert sorted(str(r[:-1]) for r in rows) == sorted(str(tuple(r)) for r in want.collect()) and len(rows) == 7
    by_lot = {}
    for r in rows:
        by_lot.setdefault(r.lot_id, []).append((r.seq, r.batch_id, r.is_orphan))
    assert by_lot == {5: [(1, 1, False), (2, 1, False), (3, 1, False), (4, 1, True), (5, 2, False), (6, 2, True)], None: [(1, 3, True)]}


def test_results_of_items_are_those_of_two_tables(spark):
    items = session.materialize(P.full_items(*_odd_batches(spark), ["batch_id"]), "test").withColumn(
        "justificacion", F.when(~F.col("is_orphan") | (F.col("seq") % 2 == 0), F.col("justificacion")))
    regular, orphans = split_orphans(items)
    for columns in (None, ["seq", "folio", "version", "ruta"], ["lot_id", "justificacion", "categoria"]):
        want = assemble_results(reduce_items(regular), None, orphans, columns)
        got = results_of_items(items, None, columns)
        assert got.columns == want.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
