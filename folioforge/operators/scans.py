"""Blocked prefix scans: running values over a possibly hot partition.

A window ``PARTITION BY origin ORDER BY page_no`` sends a whole origin to one
task. When an origin may hold a third of all rows, the scan is split:

* rows are grouped into blocks of ``block`` consecutive order values;
* a window inside (partition, block) gives the block-local value (bounded);
* one aggregate per (partition, block) gives the block summary;
* a window over the small block table carries summaries from earlier
  (or later) blocks;
* a join on (partition, block) combines carry and local value.

The row-level window, aggregate and join share one hash exchange on
(partition, block); only the block table (rows / block) is re-shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLK = "_blk"


def _blocks(df: DataFrame, order_col: str, block: int) -> DataFrame:
    return df.withColumn(BLK, F.floor(F.col(order_col) / F.lit(block)))


def lot_blocks(df: DataFrame, order_col: str, block: int) -> DataFrame:
    """``df`` with ``BLK``, the block of ``block`` consecutive order values of each row."""
    return _blocks(df, order_col, block)


def prev_value(df: DataFrame, part_cols: list[str], order_col: str, value_col: str, out_col: str,
               block: int = 4096) -> DataFrame:
    """Last non-null ``value_col`` strictly before each row (by ``order_col``) in its partition."""
    d = _blocks(df, order_col, block)
    kb = [*part_cols, BLK]
    local = F.last(value_col, ignorenulls=True).over(
        Window.partitionBy(*kb).orderBy(order_col).rowsBetween(Window.unboundedPreceding, -1))
    d = d.withColumn("_local", local)
    summ = d.groupBy(*kb).agg(
        F.max(F.when(F.col(value_col).isNotNull(), F.struct(F.col(order_col).alias("o"),
                                                            F.col(value_col).alias("v")))).alias("_s"))
    summ = summ.withColumn("_carry", F.last(F.col("_s.v"), ignorenulls=True).over(
        Window.partitionBy(*part_cols).orderBy(BLK).rowsBetween(Window.unboundedPreceding, -1)))
    return (d.join(summ.select(*kb, "_carry"), kb, "left")
            .withColumn(out_col, F.coalesce("_local", "_carry")).drop("_local", "_carry", BLK))


def next_value(df: DataFrame, part_cols: list[str], order_col: str, value_col: str, out_col: str,
               block: int = 4096) -> DataFrame:
    """First non-null ``value_col`` strictly after each row in its partition."""
    d = _blocks(df, order_col, block)
    kb = [*part_cols, BLK]
    local = F.first(value_col, ignorenulls=True).over(
        Window.partitionBy(*kb).orderBy(order_col).rowsBetween(1, Window.unboundedFollowing))
    d = d.withColumn("_local", local)
    summ = d.groupBy(*kb).agg(
        F.min(F.when(F.col(value_col).isNotNull(), F.struct(F.col(order_col).alias("o"),
                                                            F.col(value_col).alias("v")))).alias("_s"))
    summ = summ.withColumn("_carry", F.first(F.col("_s.v"), ignorenulls=True).over(
        Window.partitionBy(*part_cols).orderBy(BLK).rowsBetween(1, Window.unboundedFollowing)))
    return (d.join(summ.select(*kb, "_carry"), kb, "left")
            .withColumn(out_col, F.coalesce("_local", "_carry")).drop("_local", "_carry", BLK))


def running_sum(df: DataFrame, part_cols: list[str], order_col: str, value_col: str, out_col: str,
                block: int = 4096) -> DataFrame:
    """Inclusive running sum of ``value_col`` in order, per partition."""
    d = _blocks(df, order_col, block)
    kb = [*part_cols, BLK]
    local = F.sum(value_col).over(
        Window.partitionBy(*kb).orderBy(order_col).rowsBetween(Window.unboundedPreceding, 0))
    d = d.withColumn("_local", local)
    summ = d.groupBy(*kb).agg(F.sum(value_col).alias("_tot"))
    summ = summ.withColumn("_carry", F.sum("_tot").over(
        Window.partitionBy(*part_cols).orderBy(BLK).rowsBetween(Window.unboundedPreceding, -1)))
    return (d.join(summ.select(*kb, "_carry"), kb, "left")
            .withColumn(out_col, F.coalesce("_carry", F.lit(0)) + F.col("_local"))
            .drop("_local", "_carry", BLK))


def running_max(df: DataFrame, part_cols: list[str], order_col: str, value_col: str, out_col: str,
                block: int = 4096) -> tuple[DataFrame, DataFrame]:
    """Greatest ``value_col`` strictly before each row, in two tables that meet on (part_cols, ``BLK``).

    The first holds the rows with ``out_col``, the greatest value before them in
    their block (null: none); the second one row per block with ``out_col``, that of
    all earlier blocks. They are not joined here, so that the caller can widen the
    small table by what else it knows of a partition before both meet:
    ``greatest`` of the two columns is the running maximum.
    """
    d = _blocks(df, order_col, block)
    kb = [*part_cols, BLK]
    before = Window.orderBy(order_col).rowsBetween(Window.unboundedPreceding, -1)
    rows = d.withColumn(out_col, F.max(value_col).over(before.partitionBy(*kb)))
    blocks = d.groupBy(*kb).agg(F.max(value_col).alias("_max"))
    earlier = Window.partitionBy(*part_cols).orderBy(BLK).rowsBetween(Window.unboundedPreceding, -1)
    return rows, blocks.select(*kb, F.max("_max").over(earlier).alias(out_col))


def last_per_key(df: DataFrame, keys: list[str], order_cols: list[str]) -> DataFrame:
    """The row with the greatest ``order_cols`` per key ("last writer wins").

    A max-of-struct aggregate instead of ``row_number() = 1``: it combines
    map-side, so a hot key's final step sees one row per map task rather than
    all of the key's rows in one window. Column order is preserved.
    """
    rest = [c for c in df.columns if c not in keys and c not in order_cols]
    packed = F.max(F.struct(*[F.col(c) for c in order_cols + rest])).alias("_last")
    out = df.groupBy(*keys).agg(packed)
    return out.select(*[F.col(c) if c in keys else F.col(f"_last.{c}").alias(c) for c in df.columns])
