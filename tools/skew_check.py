"""Skew check for version resolution: one (key, category) holds a third of all events.

Builds events from the driver's ``lineitem`` table (whole table), forces every
third row onto the hot key (ERROR_DOCUMENTO_ILEGIBLE, No identificado), runs
``resolve_versions`` and reports, from Spark's event log, the largest share of
a stage's shuffle-read records handled by a single task. A one-task window over
the hot key would show a share of at least a third.

Mode ``roles`` does the same for page roles and segmentation (blocked
scans): one origin holds a third of all pages.

Mode ``examples`` does it for the last-three-examples fold: one folio prefix
holds a third of all results.

Usage: python tools/skew_check.py [sf_dir] [partitions] [versions|roles|examples]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from folioforge.operators import context as CX  # noqa: E402
from folioforge.operators import rules as RU  # noqa: E402
from folioforge.operators.versions import resolve_versions  # noqa: E402
from folioforge.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    parts = int(sys.argv[2]) if len(sys.argv) > 2 else 32
    mode = sys.argv[3] if len(sys.argv) > 3 else "versions"
    log_dir = tempfile.mkdtemp(prefix="skew-evlog-")
    spark = build_session(shuffle_partitions=parts, extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir, "spark.eventLog.compress": "false",
        "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    hot = (F.col("l_linenumber") % 3) == 0
    ev = li.select(
        F.when(hot, F.lit("ERROR_DOCUMENTO_ILEGIBLE")).otherwise(
            F.concat(F.lit("A"), (F.col("l_orderkey") % 997).cast("string"))).alias("folio_key"),
        F.when(hot, F.lit("No identificado")).otherwise(F.lit("Factura")).alias("cat"),
        F.concat(F.lit("scan_"), F.col("l_orderkey").cast("string"), F.lit(".pdf")).alias("origen"),
        F.floor(F.col("l_orderkey") / 500).cast("int").alias("lot_id"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("seq"),
        F.lit(0).alias("cat_idx"),
        ((F.col("l_partkey") * 7 + F.col("l_suppkey")) % 101).cast("int").alias("confianza"))
    if mode == "roles":
        ev = li.select(
            F.when(hot, F.lit("hot")).otherwise(F.concat(F.lit("o"), (F.col("l_orderkey") % 97).cast("string")))
            .alias("origin"),
            (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("page_no"),
            ((F.col("l_partkey") % 5) == 0).alias("has_header"), ((F.col("l_suppkey") % 7) == 0).alias("has_footer"))
        out = RU.segments(RU.page_roles(ev, ["origin"], "page_no"), ["origin"], "page_no")
        hot_col, hot_val = "origin", "hot"
    elif mode == "examples":
        letter = F.element_at(F.array(*[F.lit(c) for c in "BCDEFGHIJKLMNOPQ"]),
                              (F.col("l_orderkey") % 16 + 1).cast("int"))
        ev = li.select(
            F.floor(F.col("l_orderkey") / 500).cast("int").alias("lot_id"),
            (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("seq"), F.lit(0).alias("cat_idx"),
            F.concat(F.when(hot, F.lit("A")).otherwise(letter), F.col("l_partkey").cast("string")).alias("folio"),
            F.lit("Factura").alias("categoria"), F.lit("X").alias("cliente"))
        out = CX.examples(ev, CX.seed_prefixes(spark))
        ev = ev.withColumn("prefix", F.substring("folio", 1, 1))
        hot_col, hot_val = "prefix", "A"
    else:
        if mode == "births":   # one event, one origin a lot: births are as many as events
            ev = ev.withColumn("lot_id", F.col("seq").cast("int")).withColumn(
                "origen", F.concat(F.lit("scan_"), F.col("seq").cast("string"), F.lit(".pdf")))
        out = resolve_versions(ev)
        hot_col, hot_val = "folio_key", "ERROR_DOCUMENTO_ILEGIBLE"
    out.write.format("noop").mode("overwrite").save()
    n = ev.count()
    n_hot = ev.filter(F.col(hot_col) == hot_val).count()
    spark.stop()
    f = sorted(glob.glob(f"{log_dir}/*/events*") + glob.glob(f"{log_dir}/app*"))[0]
    reads: dict[int, list[int]] = {}
    for line in open(f).read().split("\n"):
        if not line.strip():
            continue
        e = json.loads(line)
        if e["Event"] == "SparkListenerTaskEnd" and e.get("Task Metrics"):
            r = e["Task Metrics"].get("Shuffle Read Metrics", {}).get("Total Records Read", 0)
            reads.setdefault(e["Stage ID"], []).append(r)
    worst = 0.0
    for sid, rs in sorted(reads.items()):
        tot = sum(rs)
        if tot >= n / 10:   # stages that read event-scale data
            share = max(rs) / tot
            worst = max(worst, share)
            print(f"stage {sid}: {len(rs)} tasks, {tot} records read, largest task {share:.1%}")
    print(json.dumps({"mode": mode, "rows": n, "hot_rows": n_hot, "hot_share": round(n_hot / n, 3),
                      "partitions": parts, "max_task_share": round(worst, 3)}))


if __name__ == "__main__":
    main()
