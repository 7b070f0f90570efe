"""Physical plan checks: the shapes the operators promise."""

from folioforge.operators import context as CX
from folioforge.operators import pages as P
from folioforge.operators import rules as RU
from folioforge.plans.audit import groups_from_view
from folioforge.plans.fixtures import fixture

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_name_resolution_is_two_equi_joins(spark):
    bp = fixture(spark, SF, "batch_pages")
    aliased = P.alias_pages(bp, ["batch_id"], ["page_no"], name_col="file_name")
    plan = _plan(P.resolve_names(fixture(spark, SF, "answers"), aliased, ["batch_id"]))
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_prefix_rules_broadcast(spark):
    items = fixture(spark, SF, "items")
    plan = _plan(RU.prefix_type(items, RU.prefix_rules(spark)))
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan


def test_top_clients_take_ordered(spark):
    res = spark.createDataFrame([(0, 1, 0, "A1", "Factura", "X")],
                                "lot_id int, seq long, cat_idx int, folio string, categoria string, cliente string")
    top = CX.top_clients(CX.clients(res))
    assert "TakeOrderedAndProject" in _plan(top)


def test_scan_prunes_columns(spark):
    df = fixture(spark, SF, "files").select("file_id", "n_pages")
    plan = df._jdf.queryExecution().executedPlan().toString()
    # orders is read without its unused columns
    assert "o_totalprice" not in plan and "o_orderdate" not in plan


def test_page_role_windows_are_partitioned(spark):
    pt = fixture(spark, SF, "page_text").select("origin", "page_no", "text") \
        .withColumn("has_header", RU.has_any("text", ["ation"])).withColumn("has_footer", RU.has_any("text", ["ment"]))
    plan = _plan(RU.page_roles(pt, ["origin"], "page_no"))
    # every window is keyed: no "Window [...], [], [...]" (an unpartitioned window)
    assert "], [], [" not in plan


def test_version_resolution_windows_are_partitioned(spark):
    from folioforge.operators.versions import resolve_versions
    ev = spark.createDataFrame([("A1", "Factura", "a.pdf", 0, 1, 0, 90), ("A1", "Factura", "b.pdf", 1, 2, 0, 80)],
                               "folio_key string, cat string, origen string, lot_id int, seq long, cat_idx int, "
                               "confianza int")
    plan = _plan(resolve_versions(ev, materialize_events=False))   # one plan, the per-lot and per-block windows in it
    assert plan.count("Window [") >= 5 and "], [], [" not in plan
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_block_rows_of_events_are_a_hash_aggregate(spark):
    """The summary of all events sorts nothing, and orders (lot, seq) as a pair: also for negative and largest seqs."""
    from folioforge.operators import versions as V
    rows = [("A", "c", "o", 3, -2 ** 63, 0, 5), ("A", "c", "o", 2, 2 ** 63 - 1, 0, 9), ("A", "c", "o", 2, -7, 0, 1),
            ("A", "c", "p", 0, 4, 0, 70), ("A", "c", "q", 0, 2, 0, 70)]
    ev = spark.createDataFrame(rows, "folio_key string, cat string, origen string, lot_id int, seq long, cat_idx int, "
                                     "confianza int")
    blocks = V.block_rows(V.lot_blocks(ev, "lot_id", 512))
    assert "SortAggregate" not in _plan(blocks) and "HashAggregate" in _plan(blocks)
    firsts = {r.origen: (r.first_lot, int(r.first_at) - r.first_lot * 2 ** 64, r.best) for r in blocks.collect()}
    assert firsts == {"o": (2, -7, 9), "p": (0, 4, 70), "q": (0, 2, 70)}
    got = {(r.origen, r.lot_id, r.seq): (r.version, r.accion) for r in V.resolve_versions(ev).collect()}
    assert got == {("q", 0, 2): (1, "NUEVO"), ("p", 0, 4): (2, "VERSIONAR"), ("o", 2, -7): (3, "VERSIONAR"),
                   ("o", 2, 2 ** 63 - 1): (3, "SOBRESCRIBIR"), ("o", 3, -2 ** 63): (3, "DESCARTAR")}


def test_events_are_written_with_wanted_columns_only(spark, monkeypatch):
    from folioforge.operators import versions as V
    from folioforge.operators.results import RESULT_COLUMNS, VERSION_NEEDS, assemble_results, version_events
    written = {}

    def told(df, name="stage"):
        written[name] = set(df.columns)
        return df
    monkeypatch.setattr(V, "materialize", told)
    groups = groups_from_view(fixture(spark, SF, "items"))
    whole = assemble_results(groups)
    assert whole.columns == RESULT_COLUMNS and "paginas" not in written["events"]
    some = ["lot_id", "seq", "cat_idx", "folio"]
    assert assemble_results(groups, columns=some).columns == some
    assert written["events"] == {"lot_id", "seq", "folio_key", "origen", "confianza", "folio", "cat_idx", "cat"}
    version_events(groups.select(*VERSION_NEEDS))
    assert written["events"] == {*VERSION_NEEDS, "cat_idx", "cat"}


def test_groups_of_the_view_are_shuffled_and_sorted_once(spark):
    """No aggregate that sorts and serializes each group twice, no page count where no one reads it."""
    groups = groups_from_view(fixture(spark, SF, "items"))
    few, whole = _plan(groups.select("lot_id", "folio_key", "confianza")), _plan(groups)
    for plan, windows in ((few, 1), (whole, 2)):
        assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
        assert plan.count("Window [") == windows and plan.count("hashpartitioning(lot_id") == 1
        # that of the line items' join, if any, comes before: (lot, origin) is sorted within the one order of the groups
        assert plan.count("Sort [lot_id") == 1


def test_line_items_are_joined_once_with_what_is_known_of_their_orders(spark):
    plan = fixture(spark, SF, "items")._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join Inner" in line]
    assert len(joins) == 2 and "l_orderkey" in joins[0] and "o_custkey" in joins[1]


def test_a_group_takes_its_first_item_in_order(spark):
    """Groups of several items, seqs that tie or are missing, clients that are not known, a null key."""
    from folioforge.operators.reduce import reduce_items
    page = [("p1", 0)]
    rows = [(0, 5, "A-1!", "Factura", "X", 40, "b", "o", "t", 7, [("p2", 0), ("p1", 0)]),
            (0, 4, "A-1", "Factura", "NO DETECTADO", 90, "a", "o", "t", 7, page),
            (0, 4, "A-1?", "Factura", None, 10, None, "o", "t", 7, page),
            (0, 9, None, "Factura", "Y", None, "c", "o", "t", 7, [(None, 0)]),
            (1, None, "B", "Factura", "W", 3, "d", "o", "t", 7, page), (1, 2, "B!", "Factura", "V", 2, "e", "o", "u", 8, page)]
    items = spark.createDataFrame(rows, "lot_id int, seq long, folio string, categoria string, cliente string, confianza int, "
                                        "justificacion string, origen string, tipo_origen string, paginas_original int, "
                                        "paginas array<struct<path:string,rotation:int>>")
    got = {(r.lot_id, r.folio_key): (r.seq, r.folio, r.cliente, r.confianza, r.justificacion, r.tipo_origen,
                                     r.paginas_original, [p.path for p in r.paginas], r.paginas_final, r.n)
           for r in reduce_items(items, count_as="n").collect()}
    assert got == {(0, "A-1"): (4, "A-1", "X", 90, "a | b", "t", 7, ["p1", "p2"], 2, 3),
                   (0, None): (9, None, "Y", None, "c", "t", 7, [], 0, 1),
                   (1, "B"): (2, "B", "W", 3, "d | e", "t", 7, ["p1"], 1, 2)}


def test_examples_look_behind_a_last_block_without_a_window(spark):
    """The last block of A has too few folios to fix the state, that of P has enough; R has no window at all."""
    rows = [(lot, 10 * lot + k, 0, f"A{k}") for lot in (0, 700) for k in range(12)] + [(1500, 20000, 0, "A3"), (1500, 20001, 0, "A10")]
    rows += [(lot, 30000 + 100 * lot + k, 0, f"P{k % 11}") for lot in (1, 1501) for k in range(15)]
    rows += [(2, 90000 + k, 0, f"R{k % 4}") for k in range(9)]
    res = spark.createDataFrame(rows, "lot_id int, seq long, cat_idx int, folio string")
    want = {}
    for *_, folio in sorted(rows):
        held = want.setdefault(folio[0], [])
        if folio not in held:
            held[:] = [*held, folio][-3:]
    got = {r.prefix: r.ejemplos for r in CX.examples(res, CX.seed_prefixes(spark)).collect()}
    assert {p: got[p] for p in want} == want and not any(got[p] for p in set(got) - set(want))


def test_a_written_table_of_results_for_examples_and_upsert(spark, monkeypatch):
    """Examples read the results several times: they are written once; an upsert's events carry what it stores only."""
    from folioforge.operators import versions as V
    from folioforge.plans import queries as Q
    written = []

    def told(df, name="stage"):
        written.append((name, set(df.columns)))
        return df
    monkeypatch.setattr(V, "materialize", told)
    monkeypatch.setattr(Q, "materialize", told)
    Q.q_context_examples(spark, SF)
    assert [c for n, c in written if n == "results"] == [{*CX.ORDER, "folio"}]
    written.clear()
    Q.q_constraint_violations(spark, SF)
    events = [c for n, c in written if n == "events"]
    assert len(events) == 1 and not events[0] & {"justificacion", "tipo_origen", "paginas_original"}


def test_recent_documents_take_ordered(spark):
    res = spark.createDataFrame([(0, 1, 0, "A1", "Factura", "X"), (0, 2, 0, "P2", "Remisión", "Y")],
                                "lot_id int, seq long, cat_idx int, folio string, categoria string, cliente string")
    rec = CX.recent(res, "2026-01-01 00:00:00", n=20)
    assert "TakeOrderedAndProject" in _plan(rec)
    assert [r.folio for r in rec.orderBy("rank").collect()] == ["P2", "A1"]
