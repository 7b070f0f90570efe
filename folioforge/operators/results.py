"""Results of a batch: versioned documents, error rows and orphan rows.

X1 error rows, X2 orphan rows, X3 ragged union, F7 path guard, F8 status,
F9 discard filter, G10 folder, G11 output name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import strings as S
from ..functions.predicates import status_of, unsafe_category
from ..session import materialize
from .reduce import multiplex, reduce_items
from .versions import resolve_versions, resolve_written

RESULT_COLUMNS = ["lot_id", "seq", "cat_idx", "folio", "folio_key", "version", "categoria", "cliente",
                  "archivo_original", "tipo_original", "paginas_original", "paginas_final",
                  "status", "confianza", "ruta", "justificacion"]


def category_folder(cat) -> F.Column:
    """G10, with '_' for a category made only of removed characters."""
    f = S.folder_name(cat)
    return F.when(f == "", F.lit("_")).otherwise(f)


#: columns of a group that a result column is made of, beside those that versions need
VERSION_NEEDS = ["lot_id", "seq", "folio_key", "categoria", "origen", "confianza"]
RESULT_NEEDS = {"folio": "folio", "cliente": "cliente", "tipo_original": "tipo_origen",
                "paginas_original": "paginas_original", "paginas_final": "paginas_final",
                "justificacion": "justificacion"}


def version_events(groups: DataFrame, registry: DataFrame | None = None) -> DataFrame:
    """G9 + F7 + V1: one versioned event per (group, category); unsafe categories excluded."""
    ev = multiplex(groups)
    return resolve_versions(ev.filter(~unsafe_category("cat")), registry)


def assemble_results(groups: DataFrame, registry: DataFrame | None = None,
                     orphans: DataFrame | None = None, columns: list[str] | None = None) -> DataFrame:
    """All result rows of the batch, in the form of RESULT_COLUMNS, or those of them in ``columns``.

    Events with an unsafe category (F7) go through version resolution with
    the rest -- their (key, category) groups hold only unsafe events, so they
    cannot affect any other event -- and come out as error rows (X1) in the
    same projection: one pass, no branch re-reading the events. Of a group's
    columns the events carry those that the wanted result columns are made of
    (never its page list), since they are written and shuffled as they are.
    """
    columns = columns or RESULT_COLUMNS
    return _result_rows(resolve_versions(_events(groups, columns), registry), orphans, columns)


def results_of_items(items: DataFrame, registry: DataFrame | None = None,
                     columns: list[str] | None = None) -> DataFrame:
    """``assemble_results`` of items and orphan items (``is_orphan``, ``orphan_name``) that are one table.

    The items are made and reduced once: orphans go along as rows of their own
    (``reduce_items``) and are written with the events. Two filters of the items would
    make them twice, with all their shuffles.
    """
    columns = columns or RESULT_COLUMNS
    apart = ["is_orphan", "orphan_name"]
    groups = reduce_items(items.withColumn("is_orphan", F.coalesce("is_orphan", F.lit(False))), apart=apart)
    # one row of an orphan, whatever its category
    raw = F.when(F.col("is_orphan"), F.lit(C.ORPHAN_CATEGORY_ITEM)).otherwise(F.col("categoria"))
    ev = materialize(_events(groups.withColumn("categoria", raw), columns, [*apart, "justificacion"]), "events",
                     part_of_keys=True)   # a batch or a lot is bounded
    orphans = ev.filter("is_orphan").select("lot_id", "seq", "origen", "orphan_name", "justificacion")
    unwanted = apart if "justificacion" in columns else [*apart, "justificacion"]
    return _result_rows(resolve_written(ev.filter("not is_orphan").drop(*unwanted), registry), orphans, columns)


def _events(groups: DataFrame, columns: list[str], more: list[str] = []) -> DataFrame:
    """One event per (group, category), with what ``columns`` are made of, and ``more``."""
    needs = dict.fromkeys([*VERSION_NEEDS, *[RESULT_NEEDS[c] for c in columns if c in RESULT_NEEDS], *more])
    ev = multiplex(groups.select(*needs))
    return ev if "ruta" in columns else ev.drop("categoria")   # only the tag of an error row needs the raw category


def _result_rows(v: DataFrame, orphans: DataFrame | None, columns: list[str]) -> DataFrame:
    bad = unsafe_category("cat")

    def pick(err, ok):
        return F.when(bad, err).otherwise(ok)

    def ruta():
        tag = S.short_hex(8, "lot_id", "folio_key", "categoria", "origen", "cat_idx")
        return pick(F.concat(F.lit(C.ERROR_ASSEMBLY + "/"), F.col("folio_key"), F.lit("_"), tag, F.lit(".pdf")),
                    F.concat(category_folder("cat"), F.lit("/"), S.output_name("folio_key", "version")))

    made = {
        "version": lambda: pick(F.lit(1), F.col("version")),
        "categoria": lambda: F.col("cat"),
        "archivo_original": lambda: F.col("origen"),
        "tipo_original": lambda: pick(F.lit(None).cast("string"), F.col("tipo_origen")),
        "paginas_original": lambda: pick(F.lit(None).cast("int"), F.col("paginas_original").cast("int")),
        "paginas_final": lambda: pick(F.lit(0), F.col("paginas_final").cast("int")),
        "status": lambda: pick(F.lit(C.ERROR_ASSEMBLY), status_of("confianza")),
        "confianza": lambda: pick(F.lit(0), F.col("confianza")),
        "ruta": ruta,
        "justificacion": lambda: pick(F.concat(F.lit(C.ASSEMBLY_FAILURE_PREFIX + C.PATH_GUARD_MESSAGE), F.col("cat")),
                                      F.col("justificacion")),
    }
    out = v.filter(bad | (F.col("accion") != C.ACTION_DISCARD)).select(
        *[made[c]().alias(c) if c in made else F.col(c) for c in columns])
    if orphans is not None:
        loose = orphan_rows(orphans)
        out = out.unionByName(loose.select(*[c for c in columns if c in loose.columns]), allowMissingColumns=True)
    return out.select(*columns)


def orphan_rows(orphans: DataFrame) -> DataFrame:
    """One review row per orphan page; no versioning, no client, no confidence.

    ``orphans``: lot_id, seq, origen, orphan_name, justificacion.
    """
    return orphans.select(
        "lot_id", "seq", F.lit(0).alias("cat_idx"),
        F.lit(C.ERROR_ILLEGIBLE).alias("folio"), F.lit(C.ERROR_ILLEGIBLE).alias("folio_key"),
        F.lit(1).alias("version"),
        F.lit(C.ORPHAN_CATEGORY_RESULT).alias("categoria"),
        F.col("origen").alias("archivo_original"),
        F.lit(1).alias("paginas_final"),
        F.lit(C.STATUS_REVIEW).alias("status"),
        F.concat(F.lit(C.ORPHAN_FOLDER + "/"), F.col("orphan_name"), F.lit(".pdf")).alias("ruta"),
        "justificacion")
