"""Context state store (S9, Y2) and the audit-trail source.

The context memory is a set of small tables written under one base path
(any Hadoop path: local, HDFS, ``s3a://``). Each save writes a new version
folder and then moves a pointer, so a reader sees the old or the new state,
never half of one. A missing or unreadable state falls back to the seeds.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import context as CX
from .pointer import path_exists, read_pointer, write_pointer

TABLES = ["stats", "prefixes", "clients", "recent", "categories"]


class ContextStore:
    """Y2: pluggable store = base path + file format."""

    def __init__(self, spark: SparkSession, path: str, fmt: str = "parquet"):
        self.spark, self.path, self.fmt = spark, path.rstrip("/"), fmt

    def seeds(self) -> dict[str, DataFrame]:
        s = self.spark
        return {
            "stats": CX.seed_stats(s),
            "prefixes": CX.seed_prefixes(s),
            "clients": s.createDataFrame([], "cliente string, frecuencia long, "
                                             "first_ord struct<lot_id:int,seq:bigint,cat_idx:int>"),
            "recent": s.createDataFrame([], "tipo string, folio string, cliente string, ts timestamp, "
                                            "_ord struct<batch:bigint,lot_id:int,seq:bigint,cat_idx:int>"),
            "categories": CX.categories(s),
        }

    def load(self) -> dict[str, DataFrame]:
        """Current state; missing or corrupt -> base structure (seeds). Corrupt means
        that a table's folder is gone or Spark cannot read a schema from it; any
        other failure of a read is raised."""
        version = self.current_version()
        if version is None or not all(path_exists(self.spark, f"{version}/{t}") for t in TABLES):
            return self.seeds()
        out = {}
        for t in TABLES:
            try:
                out[t] = self.spark.read.format(self.fmt).load(f"{version}/{t}")
            except AnalysisException as e:
                if e.getCondition() in ("UNABLE_TO_INFER_SCHEMA", "CANNOT_READ_FILE_FOOTER"):
                    return self.seeds()
                raise
        return out

    def current_version(self) -> str | None:
        return read_pointer(self.spark, f"{self.path}/_current")

    def save(self, tables: dict[str, DataFrame], batch_id: str) -> str:
        """Write a new version, then move the pointer; a retried batch whose
        version is already current is a no-op. Only the clients grow with the
        data; the other tables are a few rows, one file each."""
        version = f"{self.path}/versions/batch={batch_id}"
        if self.current_version() == version:
            return version
        for t in TABLES:
            df = tables[t] if t == "clients" else tables[t].coalesce(1)
            df.write.mode("overwrite").format(self.fmt).save(f"{version}/{t}")
        write_pointer(self.spark, f"{self.path}/_current", version)
        return version


def update_context(state: dict[str, DataFrame], results: DataFrame, batch_ts: str,
                   top_n: int = 20, keep: int = 3) -> dict[str, DataFrame]:
    """Merge one batch of results into the stored context tables."""
    prefixes = CX.prefixes(results, state["prefixes"]).drop("ejemplos") \
        .join(CX.examples(results, state["prefixes"], keep), "prefix", "left")
    return {
        "stats": CX.stats(results, state["stats"]),
        "prefixes": prefixes.select("prefix", "tipo_asociado", "frecuencia",
                                    F.coalesce("ejemplos", F.array().cast("array<string>")).alias("ejemplos"),
                                    "ord"),
        "clients": CX.clients(results, state["clients"]),
        "recent": _recent_with_ord(results, batch_ts, state["recent"], top_n),
        "categories": state["categories"],
    }


def _recent_with_ord(results: DataFrame, batch_ts: str, stored: DataFrame, n: int) -> DataFrame:
    """C6 keeping the order key so the next batch can merge (last n overall). The
    key leads with the number of the batch, since lot ids restart in each run."""
    from ..functions import strings as S
    from ..functions.predicates import valid_folio
    last = stored.agg(F.coalesce(F.max("_ord.batch"), F.lit(0)).alias("_last"))   # one row
    rows = results.filter(valid_folio("folio")).crossJoin(F.broadcast(last)).select(
        S.main_category("categoria").alias("tipo"), "folio", "cliente",
        F.to_timestamp(F.lit(batch_ts)).alias("ts"),
        F.struct((F.col("_last") + 1).alias("batch"), "lot_id", "seq", "cat_idx").alias("_ord"))
    return stored.select("tipo", "folio", "cliente", "ts", "_ord").unionByName(rows).orderBy(F.col("_ord").desc()).limit(n)


AUDIT_LOG_SCHEMA = T.StructType([
    T.StructField("timestamp", T.StringType()), T.StructField("level", T.StringType()),
    T.StructField("logger", T.StringType()), T.StructField("message", T.StringType()),
    T.StructField("module", T.StringType()), T.StructField("function", T.StringType()),
    T.StructField("line", T.IntegerType()), T.StructField("exception", T.StringType()),
])


def read_audit_log(spark: SparkSession, path: str) -> DataFrame:
    """JSON-lines audit trail with a declared schema (no inference pass)."""
    return spark.read.schema(AUDIT_LOG_SCHEMA).json(path).withColumn("ts", F.to_timestamp("timestamp"))


def log_summary(log: DataFrame) -> DataFrame:
    """Entries per (level, module)."""
    return log.groupBy("level", "module").agg(F.count(F.lit(1)).alias("n"))


def rejects_as_log(rejects: DataFrame, batch_ts: str) -> DataFrame:
    """X4 rows in the audit-trail shape (level WARNING, one entry per reject)."""
    return rejects.select(F.lit(batch_ts).alias("timestamp"), F.lit("WARNING").alias("level"),
                          F.concat(F.lit("folioforge."), F.col("stage")).alias("logger"),
                          F.concat_ws(": ", F.col("reason"), F.col("key"), F.col("detail")).alias("message"),
                          F.col("stage").alias("module"), F.lit(None).cast("string").alias("function"),
                          F.lit(None).cast("int").alias("line"), F.lit(None).cast("string").alias("exception"))
