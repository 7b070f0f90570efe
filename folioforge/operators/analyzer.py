"""Inference step (P13, Y1, P14, J7): pluggable analyzers and their gates.

An analyzer turns the pages of inference batches into logical documents.
Two forms plug in:

* a DataFrame function ``pages -> documents`` (runs in Catalyst); the
  default is :func:`rule_analyzer`, the model's stated rules (P7-P12);
* a pandas function run per batch with ``applyInPandas`` (one Python call per
  batch, Arrow transfer, batches spread over tasks);
* an outside service, called by :func:`call_analyzer` with a bounded number of
  calls in flight per task, batches in order, a status for each.

Every analyzer output carries ``status`` (ok, failed, exhausted); P14
drops the lot of the first exhausted batch and every later lot.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator
from concurrent.futures import Future, ThreadPoolExecutor

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..session import materialize, ship_package
from . import rules as RU

DOCUMENT_SCHEMA = T.StructType([
    T.StructField("doc_idx", T.LongType()),
    T.StructField("folios", T.ArrayType(T.StringType())),
    T.StructField("pages", T.ArrayType(T.StringType())),
    T.StructField("document_type", T.StringType()),
    T.StructField("client_name", T.StringType()),
    T.StructField("confidence_score", T.IntegerType()),
    T.StructField("reasoning", T.StringType()),
    T.StructField("status", T.StringType()),
])


def rule_analyzer(pages: DataFrame, part_cols: list[str], order_col: str = "page_no",
                  text_col: str = "text", header: list[str] | None = None,
                  footer: list[str] | None = None, block: int = 4096,
                  patterns: dict[str, str] | None = None) -> DataFrame:
    """Default analyzer: roles (P7) -> segments (P9) -> one document per segment.

    Pages in P8 order (INICIO, INTERMEDIA*, CIERRE; then page number); the
    type is every type with evidence on the document's pages (P11) or, when
    none, the rule of the first folio's prefix (P10/J4). ``folios`` are all
    labelled folios of the pages, distinct, in page order; the client is the first
    labelled client, else the first labelled RFC (P12; ``patterns`` overrides the
    label patterns). HUERFANA pages belong to no document (they become
    orphans downstream). Confidence: 90 when the document has both a start
    and a close, else 40.
    """
    d = pages.withColumn("has_header", RU.has_any(text_col, header or C.HEADER_ANCHORS)) \
        .withColumn("has_footer", RU.has_any(text_col, footer or C.FOOTER_ANCHORS))
    d = RU.segments(RU.page_roles(d, part_cols, order_col, block=block), part_cols, order_col, block=block)
    d = d.filter((F.col("role") != "HUERFANA") & (F.col("segment") > 0))
    d = (d.withColumn("_types", RU.double_type(text_col))
         .withColumn("_folios", RU.extract_all(text_col, "folio", patterns))
         .withColumn("_client", F.get(RU.extract_all(text_col, "cliente", patterns), F.lit(0)))
         .withColumn("_rfc", F.get(RU.extract_all(text_col, "rfc", patterns), F.lit(0))))
    key = F.struct(RU.role_rank("role").alias("r"), F.col(order_col).alias("o"))
    g = d.groupBy(*part_cols, "segment").agg(
        F.array_sort(F.collect_list(F.struct(key.alias("k"), F.col(order_col).cast("string").alias("p"))))
        .alias("_pages"),
        F.array_sort(F.collect_list(F.when(F.size("_folios") > 0, F.struct(F.col(order_col).alias("o"), F.col("_folios").alias("v")))))
        .alias("_f"),
        F.min(F.when(F.col("_rfc").isNotNull(), F.struct(F.col(order_col).alias("o"), F.col("_rfc").alias("v"))))
        .alias("_r"),
        F.min(F.when(F.col("_client").isNotNull(), F.struct(F.col(order_col).alias("o"), F.col("_client").alias("v"))))
        .alias("_c"),
        F.array_distinct(F.flatten(F.collect_list(F.split(F.when(F.col("_types") != "", F.col("_types")), ", "))))
        .alias("_t"),
        F.max(F.col("role").isin("INICIO", "UNICA").cast("int")).alias("_s"),
        F.max(F.col("role").isin("CIERRE", "UNICA").cast("int")).alias("_e"),
    )
    cats = F.array(*[F.lit(c) for c in C.CATEGORIES])
    types = F.array_join(F.filter(cats, lambda c: F.array_contains("_t", c)), ", ")
    folios = F.array_distinct(F.flatten(F.transform("_f", lambda x: x["v"])))
    folio = F.get(folios, F.lit(0))
    prefix_rule = F.coalesce(*[F.when(RU.folio_prefix(folio) == p, F.lit(t)) for p, t in C.PREFIX_SEEDS],
                             F.lit(C.NOT_IDENTIFIED))
    return g.select(
        *part_cols, F.col("segment").alias("doc_idx"),
        folios.alias("folios"),
        F.transform("_pages", lambda x: x["p"]).alias("pages"),
        F.when(types != "", types).otherwise(prefix_rule).alias("document_type"),
        F.coalesce("_c.v", "_r.v").alias("client_name"),
        F.when((F.col("_s") == 1) & (F.col("_e") == 1), F.lit(90)).otherwise(F.lit(40)).alias("confidence_score"),
        F.lit("reglas de anclas").alias("reasoning"),
        F.lit("ok").alias("status"))


def pandas_analyzer(pages: DataFrame, batch_cols: list[str], fn: Callable, schema: T.StructType = DOCUMENT_SCHEMA
                    ) -> DataFrame:
    """Run ``fn(pandas pages of one batch) -> pandas documents`` per batch.

    Batches are bounded (one PDF or ``vision_batch_size`` images), so each
    group fits a task; the output schema is the logical-document schema plus
    the batch columns.
    """
    ship_package(pages.sparkSession)
    out = T.StructType([pages.schema[c] for c in batch_cols] + list(schema.fields))
    return pages.groupBy(*batch_cols).applyInPandas(fn, out)


class Exhausted(Exception):
    """Raised by a call when the service's quota is used up: the lot and all later lots are held."""


def in_order(jobs: Iterator, call: Callable, in_flight: int) -> Iterator[tuple]:
    """(job, future) for each job, in the jobs' order, while at most ``in_flight`` calls
    run or wait to be taken; the next job is drawn only when a place is free."""
    window: deque[tuple[object, Future]] = deque()
    with ThreadPoolExecutor(max_workers=in_flight) as pool:
        for job in jobs:
            if len(window) == in_flight:
                first = window.popleft()
                first[1].exception()  # waits
                yield first
            window.append((job, pool.submit(call, job)))
        while window:
            first = window.popleft()
            first[1].exception()
            yield first


def _batches_of(frames: Iterator[pd.DataFrame], batch_cols: list[str]) -> Iterator[pd.DataFrame]:
    """Consecutive rows of equal batch columns, over frame borders."""
    held = None
    for pdf in frames:
        if held is not None:
            pdf = pd.concat([held, pdf], ignore_index=True)
        if not len(pdf):
            continue
        keys = pdf[batch_cols]
        new = (keys != keys.shift()).any(axis=1)
        starts = [*new[new].index, len(pdf)]
        for a, b in zip(starts[:-2], starts[1:-1]):
            yield pdf.iloc[a:b].reset_index(drop=True)
        held = pdf.iloc[starts[-2]:].reset_index(drop=True)
    if held is not None:
        yield held


def call_analyzer(pages: DataFrame, batch_cols: list[str], call: Callable[[pd.DataFrame], list[dict]], order_col: str = "pos",
                  in_flight: int = 3, tasks: int | None = None, profile=None) -> tuple[DataFrame, DataFrame]:
    """P13 with an outside service: (documents, statuses).

    ``call`` takes the pages of one batch (in ``order_col`` order) and returns its
    documents as dicts of the logical-document fields; it may block. Each task keeps
    at most ``in_flight`` calls running, so ``tasks`` * ``in_flight`` bounds the
    service's load (tasks: the shuffle width by default). Results leave in batch
    order, whatever order calls finish in. A call that raises :class:`Exhausted` gives
    its batch the status ``exhausted``; later lots of that task are not called any
    more and get the same (the gate P14 drops them anyway). Any other error gives
    ``failed``, and an empty list of documents is ``ok``.

    Answers are written once (``spark.checkpoint.dir``) before anything reads them:
    a later failure repeats no call. ``profile``: a ``ResourceProfile`` for this stage
    alone, on clusters that allow it.
    """
    spark = pages.sparkSession
    ship_package(spark)
    lot = batch_cols[0]
    names = DOCUMENT_SCHEMA.fieldNames()
    schema = T.StructType([pages.schema[c] for c in batch_cols] + list(DOCUMENT_SCHEMA.fields))

    def run(frames):
        gate: list = []  # lots that met an exhausted quota in this task

        def one(batch: pd.DataFrame):
            if gate and batch[lot].iloc[0] > min(gate):
                raise Exhausted("held behind an exhausted lot")
            try:
                return call(batch)
            except Exhausted:
                gate.append(batch[lot].iloc[0])
                raise
        for batch, done in in_order(_batches_of(frames, batch_cols), one, in_flight):
            error = done.exception()
            status = "ok" if error is None else "exhausted" if isinstance(error, Exhausted) else "failed"
            rows = [{"reasoning": None if error is None else f"{type(error).__name__}: {error}", "status": status}]
            rows += [{**d, "doc_idx": i, "status": status} for i, d in enumerate(done.result())] if error is None else []
            key = {c: batch[c].iloc[0] for c in batch_cols}
            out = pd.DataFrame([{**dict.fromkeys(names), **key, **r} for r in rows])[[*batch_cols, *names]]
            yield out.astype({"doc_idx": "Int64", "confidence_score": "Int32"})
    width = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = pages.repartition(width, *batch_cols).sortWithinPartitions(*batch_cols, order_col)
    more = {"profile": profile} if profile is not None else {}
    told = materialize(ordered.mapInPandas(run, schema, **more), "analyzer-calls")
    statuses = told.where("doc_idx IS NULL").select(*batch_cols, "status", F.col("reasoning").alias("detail"))
    return told.where("doc_idx IS NOT NULL"), statuses


def gate_failed_lots(documents: DataFrame, lot_col: str = "lot_id") -> DataFrame:
    """Quota exhaustion in any batch drops that lot and every later lot.

    One global aggregate (a single value) decides the cut; ``failed``
    batches keep their fallback document (see pages.fallback_documents).
    """
    first_bad = (documents.filter(F.col("status") == "exhausted").agg(F.min(lot_col).alias("_first_bad"))
                 .withColumn("_k", F.lit(1)))
    return (documents.withColumn("_k", F.lit(1)).join(F.broadcast(first_bad), "_k")  # one-row side
            .filter(F.col("_first_bad").isNull() | (F.col(lot_col) < F.col("_first_bad")))
            .drop("_first_bad", "_k"))


def substitute_aliases(texts: DataFrame, aliased: DataFrame, batch_cols: list[str], text_col: str,
                       alias_col: str = "alias", name_col: str = "file_name", pos_col: str = "pos") -> DataFrame:
    """Replace every page alias in free text by the real page name,
    sequentially in alias order. The alias map is per batch (bounded)."""
    amap = aliased.groupBy(*batch_cols).agg(
        F.array_sort(F.collect_list(F.struct(F.col(pos_col).alias("p"), F.col(alias_col).alias("a"),
                                             F.col(name_col).alias("n")))).alias("_map"))
    d = texts.join(amap, batch_cols, "left")
    fold = F.aggregate(F.coalesce("_map", F.array().cast("array<struct<p:int,a:string,n:string>>")),
                       F.col(text_col), lambda s, e: F.replace(s, e["a"], e["n"]))
    return d.withColumn(f"{text_col}_real", fold).drop("_map")
