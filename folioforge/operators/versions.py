"""Version resolution against the registry.

The original resolves events one at a time, in arrival order per
(folio key, category), against a cache seeded from the registry:

* nothing known for (key, cat)            -> version 1, NUEVO
* same origin, confidence >= best so far  -> its version, SOBRESCRIBIR (best := conf)
* same origin, lower confidence           -> its version, DESCARTAR
* origin not seen yet                     -> max version + 1, VERSIONAR

Here the fold is restated as aggregates and windows:

* best so far of an origin = greatest(registry score, max confidence of the
  origin's earlier events). That running max is split in two: a carry over
  earlier blocks of ``LOT_BLOCK`` lots (a window over one row per (key, cat,
  origin, block)) and a running max inside the block (a window partitioned by
  (key, cat, origin, block)). No per-event window spans more than one block, so
  a hot key -- every failed PDF lands on (ERROR_DOCUMENTO_ILEGIBLE, No
  identificado) -- does not put all its events into one task.
* an origin is born at its first event unless the registry holds it; its
  version is the registry's max version + the rank of its birth among the
  new origins of the key: inside the birth lot, plus the births of earlier
  lots (a running sum over one row per (key, cat, lot), by blocks of lots).

Blocks are for keys that hold many events. Where a key has no more of them than
a small share of a task (``hot_buckets``), as nearly all keys have, the fold is
windows over the key's own events instead (``by_keys``): they are shuffled whole
once, by (key, cat), and nothing else is. By blocks the events are read twice,
their keys for one row per block and whole for the result, and shuffled whole
once, by (key, cat, origin, block); rows as many as the origins are shuffled some
ten times more. Both ways give the same rows.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..session import materialize, spread
from .scans import BLK, last_per_key, lot_blocks, running_sum

K = ["folio_key", "cat"]
KO = K + ["origen"]
KOB = KO + [BLK]

REGISTRY_KEYS_SCHEMA = T.StructType([
    T.StructField("folio_key", T.StringType()),
    T.StructField("cat", T.StringType()),
    T.StructField("origen", T.StringType()),
    T.StructField("version", T.IntegerType()),
    T.StructField("score", T.IntegerType()),
])


#: lots in a block of the score carries and of the birth ranks
LOT_BLOCK = 512


def empty_registry(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], REGISTRY_KEYS_SCHEMA)


def registry_lookup(registry: DataFrame, events: DataFrame) -> DataFrame:
    """Registry rows of the keys present in the batch; NULL score -> 0.

    An origin stored under two versions resolves to the lowest one.
    """
    keys = events.select(*K).distinct()
    reg = registry.select(*KO, "version", "score").join(keys, K, "left_semi")
    return reg.groupBy(*KO).agg(F.min(F.struct("version", F.coalesce("score", F.lit(0)).alias("rs"))).alias("r")) \
        .select(*KO, F.col("r.version").alias("rv"), F.col("r.rs").alias("rs"))


def resolve_versions(events: DataFrame, registry: DataFrame | None = None,
                     materialize_events: bool = True) -> DataFrame:
    """V1 over all events of the batch at once.

    ``events``: folio_key, cat, origen, lot_id, seq, cat_idx, confianza and any
    payload columns (kept). Order inside (key, cat) is (lot_id, seq, cat_idx).
    ``registry``: folio_key, cat, origen, version, score (or None = empty).
    Adds ``version`` (int) and ``accion``.

    Events are read several times, so they are materialized once (parquet under
    ``spark.checkpoint.dir``) unless ``materialize_events`` is False: then all keys
    go by blocks, in one plan. Give only the payload columns that are wanted: the
    others would be written and shuffled for nothing.
    """
    if not materialize_events:
        return by_blocks(events, registry, write_blocks=False)
    return resolve_written(materialize(events, "events"), registry)


def resolve_written(events: DataFrame, registry: DataFrame | None = None) -> DataFrame:
    """``resolve_versions`` of events that are written already."""
    n, hot = hot_buckets(events, registry)
    if not hot:
        return by_keys(events, registry)
    of_hot = key_bucket(n).isin(*hot)
    cold, warm = ((events.filter(x), registry and registry.filter(x)) for x in (~of_hot, of_hot))
    return by_keys(*cold).unionByName(by_blocks(*warm))


#: buckets of keys that are counted, for each shuffle partition
BUCKETS = 16
#: events of a bucket that are few for one task, however few there are in all
FEW_EVENTS = 10_000


def key_bucket(n: int) -> F.Column:
    return F.pmod(F.xxhash64(*K), F.lit(n))


def hot_buckets(events: DataFrame, registry: DataFrame | None = None) -> tuple[int, list[int]]:
    """How many buckets keys fall into, and those of them with so many events and stored
    origins that a key in them may take more than a quarter of an even task (a row per
    bucket is counted, not one per key)."""
    parts = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = BUCKETS * parts
    keys = events.select(key_bucket(n).alias("b"))
    if registry is not None:
        keys = keys.unionAll(registry.select(key_bucket(n).alias("b")))
    counts = keys.groupBy("b").agg(F.count(F.lit(1)).alias("n")).collect()
    limit = max(FEW_EVENTS, sum(r.n for r in counts) // (4 * parts))
    return n, [r.b for r in counts if r.n > limit]


def by_keys(events: DataFrame, registry: DataFrame | None) -> DataFrame:
    """The fold as windows over the events of each (key, cat), shuffled by it once, with
    what is stored of the key as further rows.

    Births are ranked by the first (lot, seq) of their origins; those without a seq
    come first in their lot, in the order of their origins, as in ``birth_ranks``.
    Events without a lot or an origin give no row; they count as events before the
    first lot, or of an origin of their own, as by blocks.
    """
    stored = "struct<version:int,score:int>"
    ev = events.dropna(subset=K).select("*", F.lit(None).cast(stored).alias("_stored"), F.lit(True).alias("_new"))
    if registry is not None:
        ev = ev.unionByName(registry.dropna(subset=K).select(
            *KO, F.struct("version", F.coalesce("score", F.lit(0)).alias("score")).cast(stored).alias("_stored"),
            F.lit(False).alias("_new")), allowMissingColumns=True)
    order = Window.partitionBy(*KO, "_new").orderBy("lot_id", "seq", "cat_idx")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ev = spread(ev, *K).select(
        "*", F.max("confianza").over(order.rowsBetween(Window.unboundedPreceding, -1)).alias("prev"),
        (F.row_number().over(order) == F.count(F.when(F.isnull("lot_id"), 1)).over(whole) + 1).alias("_at_first"),
        F.min(F.when(F.isnotnull("lot_id"), F.struct("lot_id", F.isnull("seq"), "seq"))).over(whole).alias("_first"))
    # the lowest version that the origin is stored under, and the greatest of the key
    ev = ev.withColumn("_origin", F.when(
        F.isnotnull("origen"), F.min("_stored").over(Window.partitionBy(*KO)))).select(
        "*", F.col("_origin.version").alias("rv"), F.col("_origin.score").alias("rs"),
        F.coalesce(F.max("_stored.version").over(Window.partitionBy(*K)), F.lit(0)).alias("mv")).filter("_new")
    births = Window.partitionBy(*K, F.isnull("rv")).orderBy("_first.lot_id", "_first.seq", "origen")
    ev = ev.withColumn("birth", F.dense_rank().over(births)).dropna(subset=["origen", "lot_id"])
    return ev.withColumn("version", F.coalesce("rv", F.col("mv") + F.col("birth")).cast("int")) \
        .withColumn("accion", action(F.col("rv").isNull() & F.col("_at_first"))) \
        .select(*events.columns, "version", "accion")


def action(born: F.Column) -> F.Column:
    """What becomes of an event by what is known of its origin: rs, prev, mv, birth."""
    best = F.greatest(F.coalesce("rs", F.lit(-1)), F.coalesce("prev", F.lit(-1)))
    # nothing stored for the key (mv = 0): its first-born origin is the key's first event
    return (F.when(born & (F.col("mv") == 0) & (F.col("birth") == 1), F.lit(C.ACTION_NEW))
            .when(born, F.lit(C.ACTION_VERSION))
            .when(F.col("confianza") >= best, F.lit(C.ACTION_OVERWRITE))
            .otherwise(F.lit(C.ACTION_DISCARD)))


def by_blocks(events: DataFrame, registry: DataFrame | None, write_blocks: bool = True) -> DataFrame:
    """The fold by blocks of lots: no key, however hot, has all its events in one task.

    The block rows are read by several branches, so they are materialized unless
    ``write_blocks`` is False.
    """
    events = lot_blocks(events, "lot_id", LOT_BLOCK)
    blocks = block_rows(events)
    if write_blocks:
        blocks = materialize(blocks, "blocks")
    # one row per (key, cat, origin): its first (lot, seq)
    origins = blocks.groupBy(*KO).agg(F.min("first_lot").alias("lot_id"), F.min("first_at").alias("at")).select(
        *KO, F.struct("lot_id", (F.col("at") - place("lot_id")).try_cast("bigint").alias("seq")).alias("first"))
    if registry is not None:
        reg = registry_lookup(registry, origins)
        max_ver = registry.join(origins.select(*K).distinct(), K, "left_semi") \
            .groupBy(*K).agg(F.max("version").alias("mv"))
        origins = origins.join(reg, KO, "left").join(max_ver, K, "left")
    else:
        origins = origins.select("*", F.lit(None).cast("int").alias("rv"),
                                 F.lit(None).cast("int").alias("rs"), F.lit(None).cast("int").alias("mv"))
    origins = origins.withColumn("mv", F.coalesce("mv", F.lit(0)))
    origins = origins.join(birth_ranks(origins), KO, "left").withColumn(
        "version", F.coalesce("rv", F.col("mv") + F.col("birth")).cast("int"))
    earlier = Window.partitionBy(*KO).orderBy(BLK).rowsBetween(Window.unboundedPreceding, -1)
    # what is known of an origin reaches its events by its blocks: no join of events on the origin alone
    blocks = blocks.select(*KOB, F.max("best").over(earlier).alias("carry")).join(
        origins.select(*KO, "first", "birth", "rv", "rs", "mv", "version"), KO)
    # the window before the join: one shuffle and one sort of the events serve both
    w = Window.partitionBy(*KOB).orderBy("lot_id", "seq", "cat_idx")
    ev = spread(events, *KOB).select(
        "*", F.max("confianza").over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("prev"),
        (F.row_number().over(w) == 1).alias("_first_in_block"))
    ev = ev.join(blocks, KOB).withColumn("prev", F.greatest("carry", "prev"))
    at_first = (F.col("lot_id") == F.col("first.lot_id")) & F.col("_first_in_block")
    born = F.col("rv").isNull() & at_first
    return ev.withColumn("accion", action(born)).drop("first", "birth", "rv", "rs", "mv", "carry", "prev",
                                                "_first_in_block", BLK)


def place(lot: str) -> F.Column:
    """A lot's place in the order of (lot, seq) as one number: lots are 2^64 apart, as many as there are seqs."""
    return F.col(lot).cast("decimal(18,0)") * F.lit(Decimal(2 ** 64))


def block_rows(events: DataFrame) -> DataFrame:
    """One row per (key, cat, origin, block of lots): best confidence, first lot and first (lot, seq).

    Distinct origins never share a seq (a seq belongs to one reduce group), so
    (lot, seq) orders origins totally. As one number (``place`` plus seq) it is a plain
    minimum, and this a hash aggregate; that of a struct would sort the events.
    """
    return events.groupBy(*KOB).agg(
        F.max("confianza").alias("best"), F.min("lot_id").alias("first_lot"),
        F.min(place("lot_id") + F.col("seq").cast("decimal(19,0)")).alias("first_at"))


def birth_ranks(origins: DataFrame) -> DataFrame:
    """Rank of each new origin's birth among the new origins of its key.

    A key with very many new origins (every failed PDF) is never one window: a rank
    inside (key, cat, birth lot), bounded by the lot, plus the births of earlier
    lots, a running sum over one row per (key, cat, lot) that goes by blocks of
    ``LOT_BLOCK`` lots. It holds where lots bear many origins each and where each
    birth has a lot of its own. Births of one lot without a seq take the order of
    their origins, so that reruns agree.
    """
    new = origins.filter(F.col("rv").isNull()).select(
        *KO, F.col("first.lot_id").alias("_bl"), F.col("first.seq").alias("_bs"))
    new = new.withColumn("_local", F.row_number().over(Window.partitionBy(*K, "_bl").orderBy("_bs", "origen")))
    lots = new.groupBy(*K, "_bl").agg(F.count(F.lit(1)).alias("_n"))
    lots = running_sum(lots, K, "_bl", "_n", "_upto", LOT_BLOCK)
    return new.join(lots.select(*K, "_bl", (F.col("_upto") - F.col("_n")).alias("_before")), [*K, "_bl"]).select(
        *KO, (F.col("_before") + F.col("_local")).cast("int").alias("birth"))


def surviving(versioned: DataFrame) -> DataFrame:
    """V2: per (key, cat, version, origin) the last non-discarded event wins the file."""
    return last_per_key(versioned.filter(F.col("accion") != C.ACTION_DISCARD),
                        ["folio_key", "cat", "version", "origen"], ["lot_id", "seq", "cat_idx"])
