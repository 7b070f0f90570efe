"""Registry of stored documents: dedup, defaults, upsert, constraints, publish.

U1 batch dedup (last wins), U2 defaults, U3 upsert on the natural key,
U4 constraint report, U5 insert-only defaults, U6 all-or-nothing publish.

A stored registry is what a small pointer names, so readers see either the old
or the new state. The batch run stores it in hash buckets, copied on write (see
``bucket_registry``); ``upsert`` and ``publish`` on whole tables are the plain
form. On a table format with MERGE support the same logic is one
``DataFrame.mergeInto``; the plans here are the portable form.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions import strings as S
from ..sources.pointer import path_exists, read_pointer, write_pointer
from .bucket_registry import Manifest, PendingUpsert, is_manifest, load
from .results import category_folder
from .scans import last_per_key

NO_SNAPSHOT = "-"
NATURAL_KEY = ["folio", "categoria", "version", "archivo_original"]
UPDATED = ["divisa", "cliente", "paginas_consolidado", "status", "confianza_promedio", "ruta_servidor"]
REGISTRY_COLUMNS = ["id", "folio", "folio_key", "categoria", "version", "divisa", "cliente",
                    "archivo_original", "paginas_consolidado", "status", "confianza_promedio",
                    "ruta_servidor", "justificacion", "estado_conciliacion", "id_docto_firebird",
                    "fecha_procesamiento"]

#: result columns that an upsert reads
RESULT_NEEDS = ["lot_id", "seq", "cat_idx", "folio", "folio_key", "categoria", "version", "archivo_original",
                "cliente", "paginas_final", "status", "confianza", "ruta"]

# column -> max length (String(n) in the stored schema)
LENGTHS = {"folio": 100, "categoria": 100, "divisa": 20, "cliente": 255, "archivo_original": 255,
           "status": 50, "ruta_servidor": 500, "estado_conciliacion": 50, "id_docto_firebird": 100}
NOT_NULL = ["id", "folio", "categoria", "version", "archivo_original", "paginas_consolidado",
            "status", "confianza_promedio", "ruta_servidor"]


def row_id(*cols) -> F.Column:
    """Deterministic id from the natural key (stands for a random uuid)."""
    return F.sha2(F.concat_ws("|", *[F.col(c).cast("string") for c in cols]), 256)


def batch_rows(results: DataFrame) -> DataFrame:
    """U1 + U2: one row per natural key, last result wins, absent values defaulted."""
    vals = results.select(
        "lot_id", "seq", "cat_idx",
        F.coalesce("folio", F.lit(C.ERROR_NO_FOLIO)).alias("folio"),
        F.coalesce("folio_key", S.folio_key(F.coalesce("folio", F.lit(C.ERROR_NO_FOLIO)))).alias("folio_key"),
        F.coalesce("categoria", F.lit(C.NOT_IDENTIFIED)).alias("categoria"),
        F.coalesce("version", F.lit(1)).cast("int").alias("version"),
        F.coalesce("archivo_original", F.lit(C.UNKNOWN_ORIGIN)).alias("archivo_original"),
        F.lit(C.CURRENCY_DEFAULT).alias("divisa"),
        F.coalesce("cliente", F.lit(C.NOT_DETECTED)).alias("cliente"),
        F.coalesce("paginas_final", F.lit(1)).cast("int").alias("paginas_consolidado"),
        F.coalesce("status", F.lit(C.STATUS_PENDING)).alias("status"),
        F.coalesce("confianza", F.lit(0)).cast("int").alias("confianza_promedio"),
        F.coalesce("ruta", F.lit(C.ERROR_EMPTY_ROUTE)).alias("ruta_servidor"))
    # orphans of one origin share the key, so the key can be hot: last-wins by aggregate
    return last_per_key(vals, NATURAL_KEY, ["lot_id", "seq", "cat_idx"]).drop("lot_id", "seq", "cat_idx")


def upsert(stored: DataFrame, results: DataFrame, batch_ts: str) -> DataFrame:
    """Insert new keys, update the six mutable columns of existing keys.

    Rows of the stored snapshot the batch does not touch pass through an anti
    join; only touched rows are merged. Join strategy is left to AQE: the batch
    keys are broadcast when their measured size is under the threshold.
    """
    return merge_rows(stored, batch_rows(results), batch_ts)


def merge_rows(stored: DataFrame, b: DataFrame, batch_ts: str) -> DataFrame:
    """U3 with the batch's rows already deduplicated (``batch_rows``)."""
    keys = b.select(*NATURAL_KEY)
    untouched = stored.join(keys, NATURAL_KEY, "left_anti")
    touched = stored.join(keys, NATURAL_KEY, "left_semi")
    old = touched.select(*NATURAL_KEY, *[F.col(c).alias(f"old_{c}") for c in
                                         ["id", "justificacion", "estado_conciliacion",
                                          "id_docto_firebird", "fecha_procesamiento"]])
    merged = b.join(old, NATURAL_KEY, "left").select(
        F.coalesce("old_id", row_id(*NATURAL_KEY)).alias("id"),
        *NATURAL_KEY, "folio_key", *UPDATED,
        F.col("old_justificacion").alias("justificacion"),
        F.coalesce("old_estado_conciliacion", F.lit(C.RECONCILIATION_DEFAULT)).alias("estado_conciliacion"),
        F.col("old_id_docto_firebird").alias("id_docto_firebird"),
        F.coalesce("old_fecha_procesamiento", F.to_timestamp(F.lit(batch_ts))).alias("fecha_procesamiento"))
    return untouched.select(*REGISTRY_COLUMNS).unionByName(merged.select(*REGISTRY_COLUMNS))


def registry_from_keys(reg: DataFrame, stored_ts: str) -> DataFrame:
    """A stored registry built from (folio_key, cat, origen, version, score) rows."""
    return reg.select(
        row_id("folio_key", "cat", "version", "origen").alias("id"),
        F.col("folio_key").alias("folio"), "folio_key",
        F.col("cat").alias("categoria"), F.col("version").cast("int").alias("version"),
        F.lit(C.CURRENCY_DEFAULT).alias("divisa"), F.lit(C.NOT_DETECTED).alias("cliente"),
        F.col("origen").alias("archivo_original"), F.lit(1).alias("paginas_consolidado"),
        F.when(F.col("score") > C.OK_THRESHOLD, F.lit(C.STATUS_OK)).otherwise(F.lit(C.STATUS_REVIEW)).alias("status"),
        F.col("score").cast("int").alias("confianza_promedio"),
        F.concat(category_folder("cat"), F.lit("/"), S.output_name("folio_key", "version")).alias("ruta_servidor"),
        F.lit(None).cast("string").alias("justificacion"),
        F.lit(C.RECONCILIATION_DEFAULT).alias("estado_conciliacion"),
        F.lit(None).cast("string").alias("id_docto_firebird"),
        F.to_timestamp(F.lit(stored_ts)).alias("fecha_procesamiento"))


def as_version_source(registry: DataFrame) -> DataFrame:
    """Registry rows in the form version resolution reads."""
    return registry.select("folio_key", F.col("categoria").alias("cat"),
                           F.col("archivo_original").alias("origen"), "version",
                           F.col("confianza_promedio").alias("score"))


def constraint_violations(registry: DataFrame) -> DataFrame:
    """U4: one row per violated rule and offending key: (rule, key, n).

    Duplicate checks are aggregations (map-side combined); null and length
    checks are one narrow pass. A non-empty result aborts a publish.
    """
    def dup(rule, cols):
        k = F.concat_ws("|", *[F.col(c).cast("string") for c in cols])
        return (registry.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
                .select(F.lit(rule).alias("rule"), k.alias("key"), "n"))

    out = dup("primary_key", ["id"]).unionByName(dup("natural_key", NATURAL_KEY)) \
        .unionByName(dup("unique_route", ["ruta_servidor"]))
    return out.unionByName(row_violations(registry))


def row_violations(rows: DataFrame) -> DataFrame:
    """The rules that a row breaks by itself (nulls, lengths): (rule, key, n)."""
    checks = [(f"not_null:{c}", F.col(c).isNull()) for c in NOT_NULL] + \
             [(f"length:{c}", F.length(c) > n) for c, n in LENGTHS.items()]
    flagged = rows.select(
        F.explode(F.filter(F.array(*[F.when(cond, F.lit(name)) for name, cond in checks]),
                           lambda x: x.isNotNull())).alias("rule"),
        F.coalesce(F.col("id"), F.lit("∅")).alias("key"))
    return flagged.groupBy("rule", "key").agg(F.count(F.lit(1)).alias("n"))


def write_snapshot(spark: SparkSession, snapshot: DataFrame | PendingUpsert, base_path: str, batch_id: str,
                   check: bool = True) -> str:
    """Write the snapshot of a batch aside and check it; returns its folder, or its
    manifest for a ``PendingUpsert`` (only the buckets it touches are written).

    Idempotent by batch id: a snapshot already completed for this id is kept (a
    retried batch does not write twice). Constraint violations raise.
    """
    if isinstance(snapshot, PendingUpsert):
        return snapshot.write(batch_id, check)
    target = f"{base_path.rstrip('/')}/snapshots/batch={batch_id}"
    if not path_exists(spark, target + "/_SUCCESS"):
        snapshot.write.mode("overwrite").parquet(target)
    if check:
        found = constraint_violations(spark.read.parquet(target)).limit(3).collect()
        if found:
            raise ValueError(f"registry batch {batch_id} violates constraints; not published: "
                             + "; ".join(f"{r['rule']} {r['key']} ({r['n']})" for r in found))
    return target


def point_at(spark: SparkSession, target: str, base_path: str) -> None:
    """Make a written snapshot the current one (an atomic rename)."""
    write_pointer(spark, f"{base_path.rstrip('/')}/_current", target)


def publish(spark: SparkSession, snapshot: DataFrame, base_path: str, batch_id: str,
            check: bool = True) -> str:
    """Write the snapshot aside, check it, then point the registry at it. A
    violation leaves the previous snapshot current."""
    target = write_snapshot(spark, snapshot, base_path, batch_id, check)
    point_at(spark, target, base_path)
    return target


def current(spark: SparkSession, base_path: str) -> DataFrame | None:
    """The published snapshot, or None when nothing was published yet; a pointer
    that cannot be read raises."""
    target = read_pointer(spark, f"{base_path.rstrip('/')}/_current")
    if target is None:
        return None
    return load(spark, target, base_path).read(spark) if is_manifest(target) else spark.read.parquet(target)


def base_of_batch(spark: SparkSession, base_path: str, batch_id: str) -> Manifest | None:
    """The registry a batch starts from, pinned under its id before it writes
    anything: a retry resolves against the same state as the first try, also
    when that try had published its own."""
    base = base_path.rstrip("/")
    pin = f"{base}/bases/batch={batch_id}"
    target = read_pointer(spark, pin)
    if target is None:
        target = read_pointer(spark, f"{base}/_current") or NO_SNAPSHOT
        write_pointer(spark, pin, target)
    return None if target == NO_SNAPSHOT else load(spark, target, base)
