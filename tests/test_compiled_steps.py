"""The steps that every item goes through: compiled, done once, in as many tasks as the session names."""

import itertools

from pyspark.sql import functions as F

from folioforge.functions import strings as S
from folioforge.operators.reduce import multiplex, reduce_items
from folioforge.operators.results import VERSION_NEEDS
from folioforge.plans.audit import groups_from_view
from folioforge.plans.fixtures import fixture

SF = "/root/testdata/sf0.001"


def _named(spark):
    return multiplex(groups_from_view(fixture(spark, SF, "items")).select(*VERSION_NEEDS))


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_names_of_a_category_are_made_once_and_compiled(spark):
    """No function on arrays, and no filter on the names that is pushed down to the scan of the line items."""
    plan = _optimized(_named(spark))
    assert "lambda" not in plan
    assert not [line for line in plan.splitlines() if "Filter" in line and "l_returnflag" in line]


def test_folio_characters_are_replaced_once_per_item(spark):
    items = spark.createDataFrame([(0, 1, "a 1", "F", "X", 1, "r", "o", [("p", 0)])],
                                  "lot_id int, seq long, folio string, categoria string, cliente string, confianza int, "
                                  "justificacion string, origen string, paginas array<struct<path:string,rotation:int>>")
    groups = reduce_items(items).select("folio_key", "confianza")
    assert _optimized(groups).count("regexp_replace") == 1
    assert [tuple(r) for r in groups.collect()] == [("a1", 1)]


def test_items_and_events_are_spread_over_the_sessions_partitions(spark):
    from folioforge.operators.versions import resolve_versions
    n = spark.conf.get("spark.sql.shuffle.partitions")
    groups = groups_from_view(fixture(spark, SF, "items"))._jdf.queryExecution().executedPlan().toString()
    assert f", {n}), REPARTITION_BY_NUM" in groups
    ev = spark.createDataFrame([("A1", "Factura", "a.pdf", 0, 1, 0, 90)],
                               "folio_key string, cat string, origen string, lot_id int, seq long, cat_idx int, confianza int")
    plan = resolve_versions(ev, materialize_events=False)._jdf.queryExecution().executedPlan().toString()
    assert f", {n}), REPARTITION_BY_NUM" in plan


def _want(c):
    if c is None:
        return []
    return [x for x in (p.strip() for p in c.split(",")) if x] or ["No_identificado"]


def test_category_names_of_odd_texts(spark):
    """Commas and white space of all kinds at the ends and between names; a NULL category has no event."""
    texts = ["".join(t) for t in itertools.product(["", ",", " ", " ", "\t", "a", "é b"], repeat=4)]
    texts += ["Factura, Remisión", "a,\nb ,c", "\x7f , a", "a,\x7f", "x,,, y ,", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, categoria string")
    got = {i: [] for i in range(len(texts))}
    for r in sorted(multiplex(df).collect(), key=lambda r: (r.i, r.cat_idx)):
        got[r.i].append(r.cat)
    assert got == {i: _want(t) for i, t in enumerate(texts)}
    lists = {r.i: r.n for r in df.select("i", S.category_list("categoria").alias("n")).filter(F.col("n").isNotNull()).collect()}
    assert lists == {i: _want(t) for i, t in enumerate(texts) if t is not None}


def test_reasons_are_not_collected_for_pages_alone(spark):
    groups = groups_from_view(fixture(spark, SF, "items"))
    assert "motivo" not in _optimized(groups.select("lot_id", "paginas")) and "motivo" in _optimized(groups)
