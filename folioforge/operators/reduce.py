"""Reduce stage: items -> one group per (lot, folio key, raw category, origin).

G1 folio key, G2 grouping, G3 ordered distinct page union, G4 first known
client, G5 max confidence, G6 ordered distinct reasons, G7 first-by-order
fields, G9 category multiplex, G12 page totals.

Item order (every "first") is the ``seq`` column: lot, origin, document
index, folio index folded into one total order by the caller.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions import strings as S
from ..functions.predicates import known_client

GROUP_KEYS = ["lot_id", "folio_key", "categoria", "origen"]
#: the same keys in the order groups are sorted by: (lot, origin), the batch of a view's items, is a prefix
SORT_KEYS = ["lot_id", "origen", "folio_key", "categoria"]

PAGE = "struct<path:string,rotation:int>"


def with_single_page(items: DataFrame, page_col: str = "pagina") -> DataFrame:
    """Items carrying one page name -> the general ``paginas`` array form."""
    return items.withColumn(
        "paginas", F.array(F.struct(F.col(page_col).alias("path"), F.lit(0).alias("rotation"))))


def with_folio_key(items: DataFrame) -> DataFrame:
    return items.withColumn("_kept", S.folio_chars("folio")) \
        .withColumn("folio_key", S.or_bad_format("_kept")).drop("_kept")


def reduce_items(items: DataFrame, scope: str = "lot", count_as: str | None = None,
                 apart: list[str] | None = None) -> DataFrame:
    """Group non-orphan items and fold each group into one document.

    Input columns: lot_id, seq, folio, categoria, cliente, confianza,
    justificacion, origen, paginas (array<struct<path, rotation>>) and, if the
    caller does not add them to the groups, tipo_origen and paginas_original. ``scope="global"`` merges a
    folio across lots (lot_id is then reported as the first lot of the group).
    ``count_as`` names a further column for the number of items of the group.
    ``apart``: a boolean column, and further ones that the groups get with it. An item that it
    holds for (an orphan) is in no group: told by its ``seq``, it stays a row of its own, its reason as it is.

    Plan: one sort by the group keys and ``seq``, one window per group whose
    first row is the document. Most groups are one item, so an aggregate would
    combine nothing map-side, but sort and serialize each group twice. Windows
    over what no one reads are pruned with it (reasons and pages are collected
    apart, so that either goes alone). The ordered distinct page union is built
    inside the group's array (a group is bounded by one lot, so the in-array
    dedup stays small).
    """
    df = with_folio_key(items)
    if scope != "lot":
        # first lot of each cross-lot group: a map-side-combined aggregate joined
        # back (not a window, which would put a hot group into one task)
        keys = GROUP_KEYS[1:]
        first_lot = df.groupBy(*keys).agg(F.min("lot_id").alias("_first_lot"))
        df = df.join(first_lot, keys).withColumn("lot_id", F.col("_first_lot")).drop("_first_lot")
    firsts = [c for c in ("folio", "tipo_origen", "paginas_original") if c in df.columns]
    firsts += apart or []
    own = [F.when(F.col(apart[0]), F.col("seq"))] if apart else []
    order = Window.partitionBy(*SORT_KEYS, *own).orderBy("seq", *firsts)
    group = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    g = df.select(
        *GROUP_KEYS, *firsts, F.row_number().over(order).alias("_at"),
        F.min("seq").over(group).alias("seq"),
        F.min(F.when(known_client("cliente"), F.struct("seq", "cliente"))).over(group).alias("first_client"),
        F.max("confianza").over(group).alias("confianza"),
        F.count(F.lit(1)).over(group).alias("_n"),
        F.collect_list(F.struct("seq", "justificacion")).over(group).alias("_reasons"),
        F.collect_list(F.struct("seq", "paginas")).over(group).alias("_pages"),
    ).filter("_at = 1")

    def ordered(rows, field):
        return F.transform(F.array_sort(rows), lambda x: x[field])

    # most groups are one item: nothing to sort, to compare or to join there
    reasons, pages = F.col("_reasons"), F.col("_pages")
    reason = F.coalesce(reasons[0]["justificacion"], F.lit(""))
    if apart:
        reason = F.when(F.col(apart[0]), reasons[0]["justificacion"]).otherwise(reason)
    return g.select(
        *GROUP_KEYS, "seq", "folio",
        F.coalesce(F.col("first_client.cliente"), F.lit(C.NOT_DETECTED)).alias("cliente"),
        "confianza",
        F.when(F.size(reasons) == 1, reason).otherwise(
            F.array_join(F.array_distinct(ordered(reasons, "justificacion")), " | ")).alias("justificacion"),
        *firsts[1:],
        F.when(F.size(pages) == 1, pages[0]["paginas"]).otherwise(F.flatten(ordered(pages, "paginas"))).alias("_all_pages"),
        *([F.col("_n").alias(count_as)] if count_as else []),
    ).withColumn("paginas", F.when((F.size("_all_pages") == 1) & F.col("_all_pages")[0]["path"].isNotNull(),
                                   F.col("_all_pages"))
                 .otherwise(first_by_path("_all_pages"))).drop("_all_pages") \
        .withColumn("paginas_final", F.size("paginas"))


def first_by_path(pages) -> F.Column:
    """Keep the first occurrence of each page path, order kept."""
    pages = F.col(pages) if isinstance(pages, str) else pages
    paths = F.transform(pages, lambda p: p["path"])
    return F.filter(pages, lambda p, i: F.array_position(paths, p["path"]) == i + 1)


def multiplex(groups: DataFrame) -> DataFrame:
    """One event per category named in the raw category (split on ',').

    The names are a column of their own before the explode: the explode's own
    argument would be interpreted row by row, this one is compiled. The outer
    explode, since for an inner one Spark infers a filter on the names, which it
    pushes down to the scan of the items: they would be made twice, there for
    each item. A group without a raw category (NULL) has no event.
    """
    named = groups.withColumn("_names", S.category_list("categoria"))
    return named.select(*[F.col(c) for c in groups.columns], F.posexplode_outer("_names").alias("cat_idx", "cat")) \
        .filter(F.col("cat").isNotNull())
