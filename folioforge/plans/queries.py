"""Registered queries (Spark) and their DuckDB oracles.

Every query reads the driver tables in ``sf_dir`` (through the fixture views)
and runs over the whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as CF
from ..operators import registry as R
from ..operators.results import VERSION_NEEDS, assemble_results, results_of_items, version_events
from ..sources.raw_files import number_lots
from ..operators import payloads as PL
from . import oracle_payloads as OPL
from . import oracle_sql as O
from .audit import groups_from_view
from ..session import materialize
from .fixtures import fixture

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


VERSION_EVENT_COLS = ["lot_id", "seq", "cat_idx", "folio_key", "cat", "origen", "confianza", "version", "accion"]


@register("version_events", O.version_events_sql(False))
def q_version_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = groups_from_view(fixture(spark, sf_dir, "items")).select(*VERSION_NEEDS)
    return version_events(groups).select(*VERSION_EVENT_COLS)


@register("version_with_registry", O.version_events_sql(True))
def q_version_with_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = groups_from_view(fixture(spark, sf_dir, "items")).select(*VERSION_NEEDS)
    return version_events(groups, fixture(spark, sf_dir, "registry")).select(*VERSION_EVENT_COLS)


@register("results", O.results_sql(False))
def q_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assemble_results(groups_from_view(fixture(spark, sf_dir, "items")))


def _upserted(spark: SparkSession, sf_dir: str) -> DataFrame:
    reg_keys = fixture(spark, sf_dir, "registry")
    stored = R.registry_from_keys(reg_keys, O.STORED_TS)
    res = assemble_results(groups_from_view(fixture(spark, sf_dir, "items")), R.as_version_source(stored),
                           columns=R.RESULT_NEEDS)
    return R.upsert(stored, materialize(res, "results"), O.BATCH_TS)


@register("upsert", O.upsert_sql())
def q_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _upserted(spark, sf_dir)


@register("constraint_violations", O.constraints_sql())
def q_constraint_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.constraint_violations(_upserted(spark, sf_dir))


# --- pages ------------------------------------------------------------------
from ..operators import pages as P  # noqa: E402
from ..operators.results import category_folder  # noqa: E402
from ..functions import strings as S  # noqa: E402
from . import oracle_pages as OP  # noqa: E402


@register("page_explode", OP.page_explode_sql())
def q_page_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = fixture(spark, sf_dir, "files")
    return P.explode_pages(files).select("file_id", "file_name", "lane", "n_pages", "page_no", "page_name")


@register("page_alias", OP.page_alias_sql())
def q_page_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = P.explode_pages(fixture(spark, sf_dir, "files"))
    return P.alias_pages(pages, ["file_id"], ["page_no"]).select("file_id", "page_no", "page_name", "pos", "alias")


def _aliased_batches(spark, sf_dir):
    bp = fixture(spark, sf_dir, "batch_pages")
    return P.alias_pages(bp, ["batch_id"], ["page_no"], name_col="file_name")


@register("name_resolution", OP.name_resolution_sql())
def q_name_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    aliased = _aliased_batches(spark, sf_dir)
    res = P.resolve_names(fixture(spark, sf_dir, "answers"), aliased, ["batch_id"])
    return res.join(aliased.select("batch_id", "pos", "file_name"), ["batch_id", "pos"]) \
        .select("batch_id", "ord", "name_given", "pos", "file_name")


@register("orientation", OP.orientation_sql())
def q_orientation(spark: SparkSession, sf_dir: str) -> DataFrame:
    aliased = _aliased_batches(spark, sf_dir)
    return P.orientation(aliased, fixture(spark, sf_dir, "answers"), ["batch_id"]) \
        .select("batch_id", "page_no", "file_name", "pos", "alias", "rotation")


def _mapped(spark, sf_dir):
    return P.map_documents(fixture(spark, sf_dir, "batch_pages"), fixture(spark, sf_dir, "doc_pages"),
                           fixture(spark, sf_dir, "doc_folios"), ["batch_id"])


@register("items_from_docs", OP.items_from_docs_sql())
def q_items_from_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    items, _ = _mapped(spark, sf_dir)
    return items.select("batch_id", "doc_idx", "folio_idx", "folio",
                        F.array_join(F.transform("paginas", lambda p: p["path"]), ",").alias("paginas"),
                        F.size("paginas").alias("n_pages"), "paginas_original")


def _full_items(spark, sf_dir):
    lots = number_lots(fixture(spark, sf_dir, "batches")).withColumn(
        "tipo_origen", F.when(F.col("kind") == "pdf", F.lit(CF.ORIGIN_TYPE_PDF)).otherwise(F.lit(CF.ORIGIN_TYPE_IMAGES)))
    return P.full_items(lots, *[fixture(spark, sf_dir, t) for t in ("batch_pages", "doc_fields", "doc_pages", "doc_folios")],
                        ["batch_id"])


def _results_with_orphans(spark, sf_dir, *columns):
    return results_of_items(_full_items(spark, sf_dir), None, [*columns] or None)


@register("items_full", OP.items_full_sql())
def q_items_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _full_items(spark, sf_dir).select(
        "batch_id", "lot_id", "seq", "origen", "tipo_origen", "folio", "categoria", "cliente", "confianza", "justificacion",
        F.col("paginas")[0]["path"].alias("pagina"), "paginas_original", "is_orphan", "orphan_name")


@register("results_with_orphans", OP.results_with_orphans_sql())
def q_results_with_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _results_with_orphans(spark, sf_dir)


@register("report_with_orphans", OP.report_with_orphans_sql())
def q_report_with_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators import report as RP
    return RP.report(materialize(_results_with_orphans(spark, sf_dir, *RP.REPORT_SOURCE.values()), "results"))


@register("orphans", OP.orphans_sql())
def q_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, orphans = _mapped(spark, sf_dir)
    return orphans.select("batch_id", "page_no", "file_name", "orphan_name", "folio", "categoria",
                          "confianza", "paginas_original")


@register("page_union", OP.page_union_sql())
def q_page_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = groups_from_view(fixture(spark, sf_dir, "items"))
    return g.select("lot_id", "folio_key", "categoria", "origen",
                    P.pages_text("paginas").alias("paginas"), F.col("paginas_final").alias("n_pages"))


@register("assembly_manifest", OP.assembly_manifest_sql())
def q_assembly_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = version_events(groups_from_view(fixture(spark, sf_dir, "items")).select(*VERSION_NEEDS, "paginas"))
    ev = ev.filter(F.col("accion") != "DESCARTAR").withColumn(
        "ruta", F.concat(category_folder("cat"), F.lit("/"), S.output_name("folio_key", "version")))
    return P.assembly_manifest(ev)


# --- packing ----------------------------------------------------------------
from ..operators import packing as K  # noqa: E402
from . import oracle_packing as OK  # noqa: E402


@register("pack_next_fit", OK.pack_next_fit_sql())
def q_pack_next_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = fixture(spark, sf_dir, "files")
    return K.pack_next_fit(files, OK.NEXT_FIT_MAX, lane_col="lane").select("file_id", "lane", "lot_no")


def _bursts(spark, sf_dir):
    return K.pack_bursts(fixture(spark, sf_dir, "images"), OK.BURST_MAX, OK.BURST_GAP_S, lane_col="lane")


@register("pack_bursts", OK.pack_bursts_sql())
def q_pack_bursts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bursts(spark, sf_dir).select("event_id", "lane", "lot_no")


@register("pack_next_fit_global", OK.pack_next_fit_global_sql(CF.DEFAULTS.pdf_chunk_max_pages))
def q_pack_next_fit_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 over all files as one sequence (the original's single listing)."""
    files = fixture(spark, sf_dir, "files")
    return K.pack_next_fit(files, CF.DEFAULTS.pdf_chunk_max_pages).select("file_id", "lot_no")


@register("pack_bursts_global", OK.pack_bursts_global_sql())
def q_pack_bursts_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2 over all images as one sequence."""
    return K.pack_bursts(fixture(spark, sf_dir, "images"), OK.BURST_MAX, OK.BURST_GAP_S).select("event_id", "lot_no")


@register("pack_fixed", OK.pack_fixed_sql())
def q_pack_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    lots = _bursts(spark, sf_dir)
    return K.pack_fixed(lots, ["lane", "lot_no"], ["mtime", "file_name"], OK.BATCH_SIZE) \
        .select("event_id", "lane", "lot_no", "pos", "batch_no")


# --- ingest filters, payloads, rules ----------------------------------------
from ..operators import rules as RU  # noqa: E402
from ..sources import archives as AR  # noqa: E402
from . import oracle_rules as ORU  # noqa: E402


@register("member_filter", ORU.member_filter_sql())
def q_member_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return AR.member_flags(fixture(spark, sf_dir, "members")) \
        .select("archive", "ord", "member", "file_name", "keep", "keep_path")


@register("flat_names", ORU.flat_names_sql())
def q_flat_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = AR.member_flags(fixture(spark, sf_dir, "members")).filter("keep")
    return AR.flat_names(kept).select("archive", "ord", "member", "file_name", "flat_name")


def _told(df):
    return df.select("payload_id", "valid", F.array_join("problems", ",").alias("problems"))


@register("extraction_validation", OPL.extraction_validation_sql())
def q_extraction_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _told(PL.validate_response(fixture(spark, sf_dir, "extractions")))


@register("orientation_validation", OPL.orientation_validation_sql())
def q_orientation_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _told(PL.validate_response(fixture(spark, sf_dir, "orientation_answers"), PL.ORIENTATION, PL.ORIENTATION_TYPE))


@register("payload_validation", ORU.payload_validation_sql())
def q_payload_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return PL.validate_payloads(fixture(spark, sf_dir, "payloads")).select(
        "payload_id", "valid", "reason", "file_name", "rotation_degrees", "role", "confidence_score")


def _roles(spark, sf_dir):
    pt = fixture(spark, sf_dir, "page_text").select("origin", "page_no", "text")
    pt = pt.withColumn("has_header", RU.has_any("text", ["ation"])) \
        .withColumn("has_footer", RU.has_any("text", ["ment"]))
    return RU.page_roles(pt, ["origin"], "page_no")


@register("page_roles", ORU.page_roles_sql())
def q_page_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _roles(spark, sf_dir).select("origin", "page_no", "role")


@register("segmentation", ORU.segmentation_sql())
def q_segmentation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return RU.segments(_roles(spark, sf_dir), ["origin"], "page_no").select("origin", "page_no", "role", "segment")


@register("prefix_type", ORU.prefix_type_sql())
def q_prefix_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = fixture(spark, sf_dir, "items").select("seq", "folio", "categoria")
    return RU.prefix_type(items, RU.prefix_rules(spark)).select("seq", "folio", "categoria", "prefix",
                                                                 "rule_type", "tipo")


@register("double_type", ORU.double_type_sql())
def q_double_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    pt = fixture(spark, sf_dir, "page_text")
    return pt.select("origin", "page_no", RU.double_type("text").alias("document_type")) \
        .withColumn("n_types", F.when(F.col("document_type") == "", 0)
                    .otherwise(F.size(F.split("document_type", ", "))).cast("int"))


# --- context memory, report, totals ----------------------------------------
from ..operators import context as CX  # noqa: E402
from ..operators import report as RP  # noqa: E402
from ..functions.predicates import unsafe_category  # noqa: E402
from . import oracle_context as OC  # noqa: E402


def _results(spark, sf_dir, *columns):
    return assemble_results(groups_from_view(fixture(spark, sf_dir, "items")), columns=[*columns] or None)


@register("context_stats", OC.stats_sql())
def q_context_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return CX.stats(_results(spark, sf_dir, "folio"), CX.seed_stats(spark))


@register("context_prefixes", OC.prefixes_sql())
def q_context_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return CX.prefixes(_results(spark, sf_dir, *CX.ORDER, "folio", "categoria"), CX.seed_prefixes(spark)) \
        .select("prefix", "tipo_asociado", "frecuencia", "ord")


@register("context_examples", OC.examples_sql())
def q_context_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    res = materialize(_results(spark, sf_dir, *CX.ORDER, "folio"), "results")
    ex = CX.examples(res, CX.seed_prefixes(spark), CF.DEFAULTS.prefix_examples)
    return ex.select("prefix", F.array_join("ejemplos", ", ").alias("ejemplos"))


@register("context_clients_top", OC.clients_top_sql())
def q_context_clients_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = CX.top_clients(CX.clients(_results(spark, sf_dir, *CX.ORDER, "folio", "cliente")), CF.DEFAULTS.top_clients)
    return top.select("cliente", "frecuencia", F.col("rank").cast("int").alias("rank"))


@register("context_recent", OC.recent_sql())
def q_context_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    rec = CX.recent(_results(spark, sf_dir, *CX.ORDER, "folio", "categoria", "cliente"), OC.BATCH_TS, n=CF.DEFAULTS.recent_documents)
    return rec.select("tipo", "folio", "cliente", "ts", F.col("rank").cast("int").alias("rank"))


@register("context_digest", OC.digest_sql())
def q_context_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    res = materialize(_results(spark, sf_dir, *CX.ORDER, "folio", "categoria", "cliente"), "results")
    seeds = CX.seed_prefixes(spark)
    pst = CX.prefixes(res, seeds).drop("ejemplos").join(CX.examples(res, seeds), "prefix", "left")
    top = CX.top_clients(CX.clients(res), CF.DEFAULTS.top_clients)
    return CX.digest(pst, top, CX.categories(spark))


@register("report", OC.report_sql())
def q_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return RP.report(materialize(_results(spark, sf_dir, *RP.REPORT_SOURCE.values()), "results"))


@register("run_totals", OC.run_totals_sql())
def q_run_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return RP.run_totals(_results(spark, sf_dir, "lot_id"))


def _categories(spark, sf_dir):
    return fixture(spark, sf_dir, "items").select(F.explode(S.category_list("categoria")).alias("cat"))


@register("folder_names", OC.folder_names_sql())
def q_folder_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _categories(spark, sf_dir).distinct().select("cat", S.folder_name("cat").alias("folder")) \
        .select("cat", F.when(F.col("folder") == "", "_").otherwise(F.col("folder")).alias("folder"))


@register("category_guard", None)
def q_category_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F7 + F11: per category, the path guard and the allowed-catalogue flag
    (a left join on the category catalogue, broadcast: it is a fixed list)."""
    counts = _categories(spark, sf_dir).groupBy("cat").agg(F.count(F.lit(1)).alias("n"))
    allowed = CX.categories(spark).select(F.col("name").alias("cat"), F.lit(True).alias("allowed"))
    return counts.join(F.broadcast(allowed), "cat", "left").select(
        "cat", unsafe_category("cat").alias("unsafe"), F.coalesce("allowed", F.lit(False)).alias("allowed"), "n")


# --- routing, rejects, fallback, aliases, rule analyzer ---------------------
from ..operators import analyzer as AN  # noqa: E402
from ..operators import rejects as RJ  # noqa: E402
from ..sources import raw_files as RF  # noqa: E402
from . import oracle_more as OM  # noqa: E402

ORACLES["category_guard"] = OM.category_guard_sql()


@register("raw_routing", OM.raw_routing_sql())
def q_raw_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = fixture(spark, sf_dir, "members").filter(~F.col("member").endswith("/"))
    files = m.select("archive", "ord", S.basename("member").alias("file_name"))
    return RF.route(files).select("archive", "ord", "file_name", "ext", "junk", "kind")


@register("rejects", OM.rejects_sql())
def q_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    answers = fixture(spark, sf_dir, "answers")
    bp = fixture(spark, sf_dir, "batch_pages")
    dp = fixture(spark, sf_dir, "doc_pages")
    aliased = P.alias_pages(bp, ["batch_id"], ["page_no"], name_col="file_name")
    resolved = P.resolve_names(answers, aliased, ["batch_id"])
    return RJ.ledger(
        RJ.bad_payloads(PL.validate_payloads(fixture(spark, sf_dir, "payloads"))),
        RJ.unmatched_answers(answers, resolved, ["batch_id"]),
        RJ.unmatched_instructions(dp, bp, ["batch_id"]),
        RJ.documents_without_folio(dp, bp, fixture(spark, sf_dir, "doc_folios"), ["batch_id"]))


@register("fallback_documents", OM.fallback_documents_sql())
def q_fallback_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    bp = fixture(spark, sf_dir, "batch_pages")
    batches = bp.groupBy("batch_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("page_no", "file_name"))),
                    lambda x: x["file_name"]).alias("paginas"))
    docs = fixture(spark, sf_dir, "doc_pages").select("batch_id", "doc_idx").distinct()
    out = P.fallback_documents(batches, docs, ["batch_id"]).filter(F.coalesce("is_fallback", F.lit(False)))
    return out.select("batch_id", "doc_idx", F.array_join("folios", ",").alias("folios"),
                      F.array_join("paginas", ",").alias("paginas"), "document_type", "confidence_score",
                      "reasoning")


@register("alias_substitution", OM.alias_substitution_sql())
def q_alias_substitution(spark: SparkSession, sf_dir: str) -> DataFrame:
    aliased = _aliased_batches(spark, sf_dir)
    return AN.substitute_aliases(fixture(spark, sf_dir, "answers"), aliased, ["batch_id"], "name_given") \
        .select("batch_id", "ord", "name_given", "name_given_real")


@register("rule_documents", OM.rule_documents_sql())
def q_rule_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    pt = fixture(spark, sf_dir, "page_text").select("origin", "page_no", "text")
    docs = AN.rule_analyzer(pt, ["origin"], "page_no", header=["ation"], footer=["ment"])
    return docs.select("origin", "doc_idx", F.array_join("folios", ",").alias("folios"),
                       F.array_join("pages", ",").alias("pages"), F.size("pages").alias("n_pages"),
                       "document_type", "client_name", "confidence_score")
