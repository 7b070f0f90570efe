"""One audit batch end to end, and the batch driver around it.

``process_batch`` is the body both the batch run and the streaming
``foreachBatch`` execute: map-stage items in, then

    reduce -> multiplex -> versions (vs the published registry) -> results
    -> materialize results -> upsert of the registry buckets it touches, checked
    -> results -> pointer to the new manifest -> context update -> report -> ledger

Ordering follows the original's "store, then move": the registry snapshot
is published before the processed manifest is written, and every write is
keyed by the batch id so a retried batch replaces its own output.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions import strings as S
from ..operators import registry as R
from ..operators import report as RP
from ..operators.bucket_registry import PendingUpsert
from ..operators.reduce import multiplex, reduce_items
from ..operators.report_store import ReportStore
from ..operators.results import assemble_results
from ..session import materialize
from ..sources import ledger
from ..sources.raw_files import list_raw_files, mark_processed, route
from ..sources.state import ContextStore, update_context


@dataclass(frozen=True)
class AuditPaths:
    base: str

    @property
    def registry(self) -> str:
        return f"{self.base}/registry"

    @property
    def results(self) -> str:
        return f"{self.base}/results"

    @property
    def context(self) -> str:
        return f"{self.base}/context"

    @property
    def report(self) -> str:
        return f"{self.base}/report"

    @property
    def report_rows(self) -> str:
        return f"{self.base}/report_rows"

    @property
    def processed(self) -> str:
        return f"{self.base}/processed"


def empty_registry_table(spark: SparkSession) -> DataFrame:
    schema = ("id string, folio string, folio_key string, categoria string, version int, divisa string, "
              "cliente string, archivo_original string, paginas_consolidado int, status string, "
              "confianza_promedio int, ruta_servidor string, justificacion string, "
              "estado_conciliacion string, id_docto_firebird string, fecha_procesamiento timestamp")
    return spark.createDataFrame([], schema)


def split_orphans(items: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Regular items, and the orphan items in the form of ``orphan_rows``."""
    if "is_orphan" not in items.columns:
        return items, None
    orphan = F.coalesce(F.col("is_orphan"), F.lit(False))
    name = F.concat(F.lit(C.ORPHAN_PREFIX), S.stem(F.col("paginas")[0]["path"]))
    if "orphan_name" in items.columns:
        name = F.coalesce("orphan_name", name)
    return items.filter(~orphan), items.filter(orphan).select(
        "lot_id", "seq", "origen", name.alias("orphan_name"), "justificacion")


def input_files(items: DataFrame, files: DataFrame | None) -> DataFrame:
    """(file_name) of the batch's input files. ``files`` lists them; without
    it, the items' ``source_file`` or else their origin stands for them, whatever
    became of the items (discarded, orphan, no result)."""
    if files is not None:
        return files.select("file_name")
    column = "source_file" if "source_file" in items.columns else "origen"
    return items.select(F.col(column).alias("file_name")).filter(F.col("file_name").isNotNull())


def pending_files(spark: SparkSession, raw_path: str, paths: AuditPaths) -> DataFrame:
    """Routed raw files that no stored batch has processed yet."""
    files = route(list_raw_files(spark, raw_path)).filter(~F.col("junk"))
    return ledger.unseen(spark, files, paths.processed)


def process_batch(spark: SparkSession, items: DataFrame, paths: AuditPaths, batch_id: str, batch_ts: str,
                  orphans: DataFrame | None = None, check_constraints: bool = True,
                  report_every_batch: bool = True, files: DataFrame | None = None) -> DataFrame:
    """Run one batch of map-stage items through the audit; returns its results.

    Items with ``is_orphan`` become orphan rows, beside those of ``orphans``.
    The batch resolves against the snapshot that was current when it first
    began, so a retry writes what the first try wrote. The new snapshot is
    checked (U4) before any result is stored; a violation raises and leaves
    registry, results and ledger as they were. ``files`` are the batch's input
    files for the processed ledger (see ``input_files``).

    A batch adds its own rows to the report store. ``report_every_batch`` exports the
    cumulative report after each batch, as the original does (A2); with ``False`` it
    is exported when wanted with :func:`write_cumulative_report` (same rows).
    """
    base = R.base_of_batch(spark, paths.registry, batch_id)
    regular, own_orphans = split_orphans(items)
    if own_orphans is not None:
        orphans = own_orphans if orphans is None else orphans.unionByName(own_orphans, allowMissingColumns=True)
    groups = reduce_items(regular)
    if base is None:
        stored = empty_registry_table(spark)
    else:  # the lanes of the batch's keys only
        groups = materialize(groups, f"groups-{batch_id}")
        stored = base.lookup(spark, multiplex(groups))
    results = assemble_results(groups, R.as_version_source(stored), orphans)
    results = materialize(results, f"results-{batch_id}")
    pending = PendingUpsert(spark, base, results, paths.registry, batch_ts)
    snapshot = R.write_snapshot(spark, pending, paths.registry, batch_id, check_constraints)
    results.write.mode("overwrite").parquet(f"{paths.results}/batch={batch_id}")
    ReportStore(spark, paths.report_rows).add(results, batch_id)
    R.point_at(spark, snapshot, paths.registry)
    store = ContextStore(spark, paths.context)
    store.save(update_context(store.load(), results, batch_ts), batch_id)
    if report_every_batch:
        write_cumulative_report(spark, paths, batch_ts)
    # Sources are marked processed only after the registry was published
    mark_processed(spark, input_files(items, files), paths.processed, batch_id)
    return results


def write_cumulative_report(spark: SparkSession, paths: AuditPaths, batch_ts: str) -> str:
    """A1-A3: the report over every batch so far (from the report store; results of an
    older run without one are projected anew), under a name stamped with the batch
    time in the report time zone."""
    name = spark.range(1).select(RP.report_name(batch_ts)).first()[0]   # one literal
    target = f"{paths.report}/{name}"
    rows = ReportStore(spark, paths.report_rows).read()
    RP.write_report(RP.report(spark.read.parquet(paths.results)) if rows is None else rows, target)
    return target
