"""Audit report and run totals.

The report is the results table projected to the 11 display columns, in
order, as text. A column absent from *every* row reads ``N/A``; one absent
from some rows is blank. The "absent everywhere" flags come from one global
aggregate (one row) joined back by broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C

# display column -> results column
REPORT_SOURCE = {
    "Folio": "folio", "Categoría": "categoria", "Cliente": "cliente",
    "Archivo Original": "archivo_original", "Tipo Original": "tipo_original",
    "Páginas Original": "paginas_original", "Páginas Final": "paginas_final", "Status": "status",
    "Confianza": "confianza", "Ruta del Archivo": "ruta", "Justificación": "justificacion",
}


def report(results: DataFrame) -> DataFrame:
    """A1 + X3: the report rows (results of all lots so far; A2 rewrites it whole)."""
    cols = [REPORT_SOURCE[c] for c in C.REPORT_COLUMNS]
    present = [c for c in cols if c in results.columns]
    flags = results.agg(*[F.count(c).alias(f"_n_{c}") for c in present]).withColumn("_k", F.lit(1))
    d = results.withColumn("_k", F.lit(1)).join(F.broadcast(flags), "_k")
    out = []
    for disp in C.REPORT_COLUMNS:
        src = REPORT_SOURCE[disp]
        if src not in present:
            out.append(F.lit("N/A").alias(disp))
        else:
            out.append(F.when(F.col(f"_n_{src}") == 0, F.lit("N/A"))
                       .otherwise(F.col(src).cast("string")).alias(disp))
    return d.select(*out)


def report_name(batch_ts: str) -> F.Column:
    """A3: ``Auditoria_Integridad_<yyyyMMdd_HHmmss>`` in the report time zone."""
    local = F.from_utc_timestamp(F.to_timestamp(F.lit(batch_ts)), C.REPORT_TIMEZONE)
    return F.concat(F.lit(C.REPORT_NAME_PREFIX), F.date_format(local, "yyyyMMdd_HHmmss"))


def write_report(report_df: DataFrame, path: str, fmt: str = "csv") -> None:
    """S11 + A2: overwrite the cumulative report (CSV with header, or parquet)."""
    w = report_df.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.parquet(path)


def run_totals(results: DataFrame) -> DataFrame:
    """A4: lots and rows of the run; ``empty`` flags a run that produced nothing."""
    return results.agg(F.countDistinct("lot_id").alias("lots"), F.count(F.lit(1)).alias("rows")) \
        .withColumn("empty", F.col("rows") == 0)
