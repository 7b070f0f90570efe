"""Context memory as incremental aggregates over results.

State tables: ``stats`` (one row), ``prefixes`` (prefix, tipo_asociado,
frecuencia, ejemplos, ord), ``clients`` (cliente, frecuencia, first_ord),
``recent`` (tipo, folio, cliente, ts, ord). Each batch is one aggregate per
table merged into the stored state (full outer join + coalesce).

Result order is (lot_id, seq, cat_idx).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..functions import strings as S
from ..functions.predicates import known_client, valid_folio
from .rules import folio_prefix

ORDER = ["lot_id", "seq", "cat_idx"]
#: lots in a block of the example windows
LOT_BLOCK = 512
SYNC = 9  # consecutive pairwise-distinct folios that fix the last-three state

PREFIX_SCHEMA = T.StructType([
    T.StructField("prefix", T.StringType()), T.StructField("tipo_asociado", T.StringType()),
    T.StructField("frecuencia", T.LongType()), T.StructField("ejemplos", T.ArrayType(T.StringType())),
    T.StructField("ord", T.LongType()),
])


def seed_prefixes(spark: SparkSession) -> DataFrame:
    """Base structure: the seeded prefix rules, frequency 0, no examples."""
    rows = [(p, t, 0, [], i) for i, (p, t) in enumerate(C.PREFIX_SEEDS)]
    return spark.createDataFrame(rows, PREFIX_SCHEMA)


def seed_stats(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(0, 0, 0)], "total_documentos_procesados long, total_folios_extraidos long, "
                                              "total_no_detectados long")


def categories(spark: SparkSession, names=None) -> DataFrame:
    return spark.createDataFrame([(i, c) for i, c in enumerate(names or C.CATEGORIES)], "ord int, name string")


def _ordered(results: DataFrame) -> DataFrame:
    return results.withColumn("_ord", F.struct(*ORDER))


def stats(results: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Documents, valid folios, not detected; added to the stored counters."""
    v = valid_folio("folio")
    batch = results.agg(F.count(F.lit(1)).alias("d"), F.count_if(v).alias("f"))
    batch = batch.select(F.col("d").alias("total_documentos_procesados"),
                         F.col("f").alias("total_folios_extraidos"),
                         (F.col("d") - F.col("f")).alias("total_no_detectados"))
    if stored is None:
        return batch
    return batch.unionByName(stored.select(*batch.columns)).agg(
        *[F.sum(c).alias(c) for c in batch.columns])


def _valid_rows(results: DataFrame) -> DataFrame:
    return _ordered(results).filter(valid_folio("folio"))


def prefixes(results: DataFrame, stored: DataFrame) -> DataFrame:
    """C2 + C7: frequency per prefix; a new prefix takes the main category of its
    first sighting; the stored type wins. New prefixes are appended in
    first-sighting order after the stored ones."""
    rows = _valid_rows(results).withColumn("prefix", folio_prefix("folio")).filter(F.col("prefix") != "")
    batch = rows.groupBy("prefix").agg(
        F.count(F.lit(1)).alias("b_freq"),
        F.min(F.struct("_ord", S.main_category("categoria").alias("t"))).alias("_first"))
    s = stored.select("prefix", F.col("tipo_asociado").alias("s_tipo"), F.col("frecuencia").alias("s_freq"),
                      F.col("ejemplos").alias("s_ej"), F.col("ord").alias("s_ord"))
    m = s.join(batch, "prefix", "full_outer")
    # m has one row per prefix letter (bounded by the alphabet): unpartitioned windows are fine here
    w_new = Window.orderBy(F.col("_first._ord"))
    max_ord = F.max("s_ord").over(Window.partitionBy(F.lit(1)))
    m = m.withColumn("_max", F.coalesce(max_ord, F.lit(-1)))
    new = m.filter(F.col("s_ord").isNull()).withColumn("ord", F.col("_max") + F.row_number().over(w_new))
    old = m.filter(F.col("s_ord").isNotNull()).withColumn("ord", F.col("s_ord"))
    m = old.unionByName(new)
    return m.select("prefix",
                    F.coalesce("s_tipo", F.col("_first.t")).alias("tipo_asociado"),
                    (F.coalesce("s_freq", F.lit(0)) + F.coalesce("b_freq", F.lit(0))).alias("frecuencia"),
                    F.coalesce("s_ej", F.array().cast("array<string>")).alias("ejemplos"),
                    F.col("ord").cast("long").alias("ord"))


def _latest_sync(rows: DataFrame) -> DataFrame:
    """(prefix, _start): where each prefix's latest window of ``SYNC`` distinct folios inside one block starts."""
    w = Window.partitionBy("prefix", "_blk").orderBy("_ord")
    window = F.array(*[F.lead("folio", k).over(w) for k in range(SYNC)])
    rows = rows.withColumn("_sync", F.size(F.array_distinct(F.filter(window, lambda x: x.isNotNull()))) == SYNC)
    return rows.filter("_sync").groupBy("prefix").agg(F.max("_ord").alias("_start"))


def examples(results: DataFrame, stored: DataFrame, keep: int = 3) -> DataFrame:
    """Last ``keep`` distinct examples per prefix (a FIFO that skips held folios).

    Exact and skew-safe: ``SYNC`` consecutive pairwise-distinct folios fix the
    state whatever came before, so each prefix is folded only from the start
    of its latest such window, starting from the stored examples. Windows are
    looked for inside (prefix, block of ``LOT_BLOCK`` lots): a block is bounded,
    and holds a window also where each lot has a single result. The latest one is
    in the prefix's last block, if that holds any; the other blocks are shuffled
    and sorted for those prefixes only whose last block holds none. Without a window
    the fold runs over the whole batch of that prefix. ``results`` are read several
    times: give a written table.
    """
    rows = (_valid_rows(results).withColumn("prefix", folio_prefix("folio")).filter(F.col("prefix") != "")
            .select("prefix", F.floor(F.col("lot_id") / LOT_BLOCK).alias("_blk"), "_ord", "folio"))
    last = rows.groupBy("prefix").agg(F.max("_blk").alias("_blk"))   # one row per prefix letter
    start = _latest_sync(rows.join(F.broadcast(last), ["prefix", "_blk"]))
    older = last.join(F.broadcast(start), "prefix", "left_anti").select("prefix")
    start = start.unionByName(_latest_sync(rows.join(F.broadcast(older), "prefix")))
    tail = (rows.join(F.broadcast(start), "prefix", "left")  # one row per prefix letter
            .filter(F.col("_start").isNull() | (F.col("_ord") >= F.col("_start"))))
    folded = tail.groupBy("prefix").agg(F.array_sort(F.collect_list(F.struct("_ord", "folio"))).alias("_seq"))
    st = stored.select("prefix", F.col("ejemplos").alias("_init"))
    d = st.join(folded, "prefix", "full_outer").withColumn(
        "_init", F.coalesce("_init", F.array().cast("array<string>")))
    fold = F.aggregate(
        F.col("_seq"), F.col("_init"),
        lambda s, x: F.when(F.array_contains(s, x["folio"]), s).otherwise(
            F.slice(F.concat(s, F.array(x["folio"])), F.greatest(F.size(s) + 2 - keep, F.lit(1)), keep)))
    return d.select("prefix", F.when(F.col("_seq").isNull(), F.col("_init")).otherwise(fold).alias("ejemplos"))


def clients(results: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """C4: frequency per upper-cased known client of a valid-folio result."""
    rows = _valid_rows(results).filter(known_client("cliente"))
    batch = rows.groupBy(F.upper("cliente").alias("cliente")).agg(
        F.count(F.lit(1)).alias("frecuencia"), F.min("_ord").alias("first_ord"))
    if stored is None:
        return batch
    s = stored.select("cliente", F.col("frecuencia").alias("s_f"), F.col("first_ord").alias("s_o"))
    m = s.join(batch, "cliente", "full_outer")
    return m.select("cliente", (F.coalesce("s_f", F.lit(0)) + F.coalesce("frecuencia", F.lit(0))).alias("frecuencia"),
                    F.coalesce("s_o", "first_ord").alias("first_ord"))


def top_clients(clients_df: DataFrame, n: int = 15) -> DataFrame:
    """The n most frequent clients, ties in first-seen order (a top-k report)."""
    top = clients_df.orderBy(F.col("frecuencia").desc(), F.col("first_ord").asc()).limit(n)
    return top.withColumn("rank", F.row_number().over(
        Window.orderBy(F.col("frecuencia").desc(), F.col("first_ord").asc())))


def recent(results: DataFrame, batch_ts: str, stored: DataFrame | None = None, n: int = 20) -> DataFrame:
    """The last n valid-folio documents (a top-k report)."""
    rows = _valid_rows(results).select(
        S.main_category("categoria").alias("tipo"), "folio", "cliente",
        F.to_timestamp(F.lit(batch_ts)).alias("ts"), "_ord")
    if stored is not None:
        rows = stored.unionByName(rows)
    top = rows.orderBy(F.col("_ord").desc()).limit(n)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.col("_ord").desc()))).drop("_ord")


def digest(prefix_state: DataFrame, client_top: DataFrame, cats: DataFrame) -> DataFrame:
    """C8 + C9: the context text handed to the analyzer, plus the category
    catalogue as a quoted comma list. One aggregate over the small state tables."""
    line_fmt = (C.CONTEXT_DIGEST_PREFIX_LINE.replace("{p}", "%1$s").replace("{ex}", "%2$s")
                .replace("{t}", "%3$s"))
    pl = prefix_state.select(
        (F.lit(10) + F.col("ord")).alias("k"),
        F.format_string(line_fmt, "prefix", F.array_join("ejemplos", ", "),
                        F.coalesce("tipo_asociado", F.lit(C.NOT_IDENTIFIED))).alias("line"))
    cl = client_top.select((F.lit(1_000_000_000) + F.col("rank")).alias("k"),
                           F.concat(F.lit("  - "), F.col("cliente")).alias("line"))
    p_title = prefix_state.agg(F.count(F.lit(1)).alias("n")).filter("n > 0") \
        .select(F.lit(2).cast("long").alias("k"), F.lit(C.CONTEXT_DIGEST_PREFIX_TITLE).alias("line"))
    c_title = client_top.agg(F.count(F.lit(1)).alias("n")).filter("n > 0") \
        .select(F.lit(999_999_999).cast("long").alias("k"), F.lit(C.CONTEXT_DIGEST_CLIENT_TITLE).alias("line"))
    fixed = cats.sparkSession.createDataFrame(
        [(0, C.CONTEXT_DIGEST_HEADER), (1, C.CONTEXT_DIGEST_INTRO), (2_000_000_000, C.CONTEXT_DIGEST_FOOTER)],
        "k long, line string")
    lines = (fixed.select("k", "line").unionByName(p_title).unionByName(pl.select(F.col("k").cast("long"), "line"))
             .unionByName(c_title).unionByName(cl.select(F.col("k").cast("long"), "line"))
             .withColumn("kind", F.lit("line")))
    cat_rows = cats.select(F.col("ord").cast("long").alias("k"),
                           F.concat(F.lit("'"), F.col("name"), F.lit("'")).alias("line"), F.lit("cat").alias("kind"))
    srt = F.array_sort(F.collect_list(F.struct("kind", "k", "line")))
    return lines.unionByName(cat_rows).agg(srt.alias("a")).select(
        F.array_join(F.transform(F.filter("a", lambda x: x["kind"] == "line"), lambda x: x["line"]), "\n")
        .alias("digest"),
        F.array_join(F.transform(F.filter("a", lambda x: x["kind"] == "cat"), lambda x: x["line"]), ", ")
        .alias("catalogo"))
