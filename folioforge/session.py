"""Spark session helpers.

The library never creates a session behind the caller's back: every operator
takes DataFrames. These helpers exist for tests, the bench and the entry
point, and for the one thing a job must read from the session: the shared
checkpoint folder used to cut lineage between the passes of a two-pass scan.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
ALL_KEYS_CONF = "spark.sql.requireAllClusterKeysForCoPartition"


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "folioforge", extra: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared (HDFS/object store)
    folder and is used as is. Only when it is unset and the master is local
    (tests) a fresh scratch folder is created and registered; elsewhere a
    machine-local folder would lose data, so that raises.
    """
    sc = spark.sparkContext
    current = spark.conf.get(CHECKPOINT_CONF, None) or sc.getCheckpointDir()
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    if not sc.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder that the driver and all executors share")
    scratch = tempfile.mkdtemp(prefix="folioforge-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set(CHECKPOINT_CONF, scratch)
    sc.setCheckpointDir(scratch)
    return sc.getCheckpointDir() or scratch


def spread(df, *keys):
    """``df`` shuffled by ``keys`` into the session's ``spark.sql.shuffle.partitions``.

    With the count given, adaptive execution does not merge them into a few more
    partitions than there are cores, of which the last ones then run alone.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def read_table(spark: SparkSession, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialize(df, name: str = "stage", part_of_keys: bool = False):
    """Cut lineage at a fan-out point: write the rows once as a parquet table
    under the shared ``spark.checkpoint.dir`` and read them back (never a
    local checkpoint, never a machine-local folder on a cluster).

    Consumers then read the written rows instead of recomputing (and
    re-pruning) the upstream plan, and a lost executor recomputes from this
    table, not from the raw inputs. Parquet is read back column by column, so
    each consumer scans only the columns it uses. The shuffle files of the write
    are given up with it: they would else lie beside those of the next pass until
    the driver happens to collect its garbage. (A later use of ``df`` itself plans
    shuffles of its own.) ``part_of_keys``: sides of a join that are both shuffled by
    some of its keys are not shuffled anew by all of them; for keys that are never hot.
    """
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/folioforge/{name}-{uuid.uuid4().hex}"
    conf = {CLEANUP_CONF: "true"} | ({ALL_KEYS_CONF: "false"} if part_of_keys else {})
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return spark.read.parquet(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``folioforge`` importable in Python workers (the ``--py-files``
    mechanism): zip the package once per application and ``addPyFile`` it.
    Needed by the operators that run Python on executors (packing folds,
    archive listing, pandas analyzers, keyed streaming state)."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    import zipfile

    import folioforge
    root = os.path.dirname(os.path.abspath(folioforge.__file__))
    fd, path = tempfile.mkstemp(prefix="folioforge-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w") as z:
        for dirpath, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)
