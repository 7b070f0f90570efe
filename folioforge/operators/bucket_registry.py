"""The registry as hash buckets, copied on write.

A stored registry is a *manifest*: for each bucket the folder that holds its
rows. A batch reads and rewrites only the buckets that its keys fall into; the
new manifest names the new folders for these and the old ones for all others,
so an upsert costs what its buckets hold, not what the registry holds.

* Rows: bucket = lane of (folio key, category), times ``PARTS``, plus a part by
  origin. All rows of a natural key share a bucket, a version lookup reads the
  ``PARTS`` buckets of its lane, and a hot key (every unreadable PDF) is spread
  over all parts.
* Unique columns (route, id): an index table in buckets by the value: (rule, value,
  natural key of its owner). A batch takes its keys' old entries out of the buckets
  they stand in, and puts the new ones in; a value with two owners is a violation,
  also when the other owner is stored in a row bucket that the batch never reads.

Writing goes aside under the batch's id; the manifest is one small file, written
by an atomic rename, and becomes current by the registry's pointer. A retry finds
its written folders complete and makes the same manifest. The driver sees bucket
numbers only (``LANES * PARTS`` and ``INDEX_BUCKETS`` at most).
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import strings as S
from ..session import materialize
from ..sources.pointer import path_exists, read_pointer, write_pointer

LANES, PARTS = 32, 8
INDEX_BUCKETS = 64
#: rule -> the column that must be unique
UNIQUE = {"unique_route": "ruta_servidor", "primary_key": "id"}
TABLES = ("rows", "unique")
KEY = ["folio", "categoria", "version", "archivo_original"]
ROW_SCHEMA = ("id string, folio string, folio_key string, categoria string, version int, divisa string, cliente string, "
              "archivo_original string, paginas_consolidado int, status string, confianza_promedio int, ruta_servidor string, "
              "justificacion string, estado_conciliacion string, id_docto_firebird string, fecha_procesamiento timestamp")
INDEX_SCHEMA = "rule string, value string, folio string, categoria string, version int, archivo_original string"


def lane_of(folio_key: Column, categoria: Column) -> Column:
    return F.pmod(F.xxhash64(folio_key, categoria), F.lit(LANES)).cast("int")


def bucket_of_row() -> Column:
    """The bucket of a registry row, a function of its natural key alone."""
    part = F.pmod(F.xxhash64("archivo_original"), F.lit(PARTS))
    return (lane_of(S.folio_key("folio"), F.col("categoria")) * PARTS + part).cast("int")


def bucket_of_value() -> Column:
    return F.pmod(F.xxhash64("rule", "value"), F.lit(INDEX_BUCKETS)).cast("int")


def entries_of(rows: DataFrame) -> DataFrame:
    """The index entries of registry rows."""
    both = F.array(*[F.struct(F.lit(rule).alias("rule"), F.col(c).alias("value")) for rule, c in UNIQUE.items()])
    return rows.select(F.explode(both).alias("u"), *KEY).select("u.rule", "u.value", *KEY)


class Manifest:
    """Which folder holds each bucket of the rows and of each index."""

    def __init__(self, base: str, batch: str = "", tables: dict[str, dict[int, str]] | None = None):
        self.base, self.batch = base.rstrip("/"), batch
        self.tables = tables or {t: {} for t in TABLES}

    def read(self, spark: SparkSession, table: str = "rows", buckets: list[int] | None = None) -> DataFrame:
        """The rows of the table, or of some of its buckets; files of others are not opened."""
        schema = ROW_SCHEMA if table == "rows" else INDEX_SCHEMA
        at = self.tables[table]
        paths = [f"{self.base}/{at[b]}" for b in (sorted(at) if buckets is None else sorted(buckets)) if b in at]
        return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)

    def lookup(self, spark: SparkSession, keys: DataFrame) -> DataFrame:
        """Rows of the lanes that ``keys`` (folio_key, cat) fall into."""
        lanes = [r["lane"] for r in keys.select(lane_of(F.col("folio_key"), F.col("cat")).alias("lane")).distinct().collect()]
        return self.read(spark, "rows", [lane * PARTS + p for lane in lanes for p in range(PARTS)])

    def dump(self) -> str:
        return json.dumps({"batch": self.batch, "tables": self.tables}, sort_keys=True)


def is_manifest(target: str) -> bool:
    return target.endswith(".json")


def load(spark: SparkSession, target: str, base: str) -> Manifest:
    """The manifest at ``target``; a whole-snapshot folder of an older store becomes
    buckets once, under ``base``."""
    if not is_manifest(target):
        return from_snapshot(spark, spark.read.parquet(target), base, "import-" + target.rstrip("/").rsplit("=", 1)[-1])
    text = read_pointer(spark, target)
    if text is None:
        raise ValueError(f"no manifest at {target}")
    found = json.loads(text)
    return Manifest(base, found["batch"], {t: {int(b): p for b, p in at.items()} for t, at in found["tables"].items()})


def manifest_path(base: str, batch_id: str) -> str:
    return f"{base.rstrip('/')}/manifests/batch={batch_id}.json"


def from_snapshot(spark: SparkSession, rows: DataFrame, base: str, batch_id: str) -> Manifest:
    """Buckets and indexes of a whole registry table."""
    return _store(spark, Manifest(base), rows, rows.select(*KEY), _buckets(rows, bucket_of_row()), batch_id)[0]


def _put(spark: SparkSession, df: DataFrame, at: dict[int, str], base: str, table: str, batch_id: str, touched: list[int]) -> dict[int, str]:
    """Write the new content of the ``touched`` buckets; the table's folders after it."""
    folder = f"{table}/batch={batch_id}"
    if not path_exists(spark, f"{base}/{folder}/_SUCCESS"):
        # rebalance: a file or more for each bucket, large ones split by size, small ones packed into a task
        df.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{base}/{folder}")
    filled = {b for b in touched if path_exists(spark, f"{base}/{folder}/bucket={b}")}
    return {b: p for b, p in at.items() if b not in touched} | {b: f"{folder}/bucket={b}" for b in filled}


def _buckets(df: DataFrame, bucket: Column) -> list[int]:
    return sorted(r["b"] for r in df.select(bucket.alias("b")).distinct().collect())


def _store(spark: SparkSession, old: Manifest, merged: DataFrame, keys: DataFrame, touched: list[int], batch_id: str
           ) -> tuple[Manifest, DataFrame, list[int]]:
    """Write ``merged``, the new content of the ``touched`` buckets, and bring the index up
    to date for ``keys``. (manifest, rows of ``keys``, touched index buckets)."""
    base = old.base
    rows = _put(spark, merged.withColumn("bucket", bucket_of_row()), old.tables["rows"], base, "rows", batch_id, touched)
    written = Manifest(base, batch_id, {"rows": rows, "unique": {}})
    changed = written.read(spark, "rows", touched).join(keys, KEY, "left_semi")
    news = entries_of(changed)
    gone = entries_of(old.read(spark, "rows", touched).join(keys, KEY, "left_semi"))
    spots = _buckets(news.unionByName(gone), bucket_of_value())
    entries = old.read(spark, "unique", spots).join(keys, KEY, "left_anti").unionByName(news)
    unique = _put(spark, entries.withColumn("bucket", bucket_of_value()), old.tables["unique"], base, "unique", batch_id, spots)
    return Manifest(base, batch_id, {"rows": rows, "unique": unique}), changed, spots


class PendingUpsert:
    """A batch's upsert against the manifest it starts from, not yet written."""

    def __init__(self, spark: SparkSession, old: Manifest | None, results: DataFrame, base: str, batch_ts: str):
        self.spark, self.results, self.batch_ts = spark, results, batch_ts
        self.old = old or Manifest(base)

    def write(self, batch_id: str, check: bool) -> str:
        """Write touched buckets and indexes aside, check them, write the manifest; its path."""
        from .registry import batch_rows, merge_rows
        spark, base = self.spark, self.old.base
        target = manifest_path(base, batch_id)
        if path_exists(spark, target):
            return target
        batch = materialize(batch_rows(self.results), f"batch-rows-{batch_id}")  # read by merge, keys and buckets
        keys = batch.select(*KEY)
        touched = _buckets(keys, bucket_of_row())
        merged = merge_rows(self.old.read(spark, "rows", touched), batch, self.batch_ts)
        manifest, changed, spots = _store(spark, self.old, merged, keys, touched, batch_id)
        if check:
            found = violations(spark, manifest, changed, touched, spots).limit(3).collect()
            if found:
                raise ValueError(f"registry batch {batch_id} violates constraints; not published: "
                                 + "; ".join(f"{r['rule']} {r['key']} ({r['n']})" for r in found))
        write_pointer(spark, target, manifest.dump())
        return target


def violations(spark: SparkSession, manifest: Manifest, changed: DataFrame, touched: list[int], spots: list[int]) -> DataFrame:
    """U4 over what a batch can have broken: natural keys of the touched buckets,
    values of the touched index buckets (whoever owns them), and the changed rows'
    own rules. (rule, key, n), as ``registry.constraint_violations``."""
    from .registry import row_violations
    key = F.concat_ws("|", *[F.col(c).cast("string") for c in KEY])
    out = (manifest.read(spark, "rows", touched).groupBy(*KEY).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
           .select(F.lit("natural_key").alias("rule"), key.alias("key"), "n"))
    out = out.unionByName(manifest.read(spark, "unique", spots).groupBy("rule", "value").agg(F.count(F.lit(1)).alias("n")).where(
        "n > 1").select("rule", F.coalesce("value", F.lit("")).alias("key"), "n"))
    # buckets follow the folio, lookups the folio key: they must agree
    lost = changed.where(~S.folio_key("folio").eqNullSafe(F.col("folio_key"))).select(
        F.lit("folio_key").alias("rule"), F.coalesce("id", F.lit("∅")).alias("key"), F.lit(1).cast("bigint").alias("n"))
    return out.unionByName(row_violations(changed)).unionByName(lost)


def unreferenced(spark: SparkSession, manifests: list[Manifest], base: str) -> list[str]:
    """Bucket folders that none of ``manifests`` names, for the caller's retention policy."""
    base = base.rstrip("/")
    named = {p for m in manifests for at in m.tables.values() for p in at.values()}
    jvm = spark._jvm
    out = []
    for table in TABLES:
        root = jvm.org.apache.hadoop.fs.Path(f"{base}/{table}")
        fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
        for batch in fs.listStatus(root) if fs.exists(root) else []:
            for bucket in fs.listStatus(batch.getPath()):
                folder = f"{table}/{batch.getPath().getName()}/{bucket.getPath().getName()}"
                if bucket.isDirectory() and folder not in named:
                    out.append(folder)
    return sorted(out)
