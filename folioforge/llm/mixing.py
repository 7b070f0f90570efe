"""Mixing sources to target weights with a low-discrepancy block schedule.

Method: each source's documents stand in a fixed shuffled order (by hash) and
its words are cut into blocks of ``BLOCK`` words. Slot i of the schedule maps
the golden-ratio point frac((i + 1) / phi) through the cumulative weights to a
source; the k-th slot of a source takes its block k, starting over after the
last. A source's last block is cut where its target is met; the few blocks that
the schedule's discrepancy leaves out are appended behind it. So each source
takes its rounded target exactly, in a well spread order.

Targets: sources, by code point and null last, weigh 3, 1, 2, repeating, and
share 150% of all words; a target stops at 2 times its source's size and the
excess is shared by weight among the rest (water filling, in closed form over
the sources in order of size/weight).

Running sums never order a whole source in one task: documents are dealt to
cells by their hash, sums run inside a cell and over the cells' totals.

Defined cases: null or empty texts have size 0 and are never taken; a null
source is a source; rows that are equal in all columns are separate documents,
in an order that does not matter; a null doc_id is a document. Extra columns
are ignored by ``mix`` and kept by ``take_text``.
A very long text is counted in its row; only word counts are shuffled until it is written.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioforge.llm.common import WORD, materialize, packed, text_id, unpacked

BLOCK = 1024
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
PER_CELL = 2000
PER_CHUNK = 1 << 16
GRID = 4096
GOLDEN = 0.6180339887498949


def sized(docs: DataFrame) -> DataFrame:
    """(rid, doc_id, source, tid, size) written once: rid numbers the rows."""
    n = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint")
    rid = F.col("rid") if "row" in docs.columns else F.monotonically_increasing_id()
    return materialize(docs.select(rid.alias("rid"), "doc_id", "source", text_id(F.col("text")).alias("tid"),
                                   n.alias("size")), "mix-sizes")


def targets(sizes: DataFrame) -> DataFrame:
    """(source, src, n_docs, source_size, target, goal), one row per source; src
    is its number in code point order, goal the words to take."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    # windows over one row per source
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in WEIGHTS]), ((F.col("src") - 1) % len(WEIGHTS) + 1))
    numbered = per.withColumn("src", F.row_number().over(order)).withColumn("w", w).withColumn(
        "cap", F.col("source_size") * float(MOST)).withColumn("ratio", F.col("cap") / F.col("w"))
    by_ratio = Window.orderBy("ratio", "src")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    every = Window.orderBy("ratio", "src").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum("source_size").over(every) * SHARE
    level = (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("w").over(after)
    filled = numbered.withColumn("level", level).withColumn("capped", F.col("ratio") <= F.col("level"))
    rate = F.min(F.when(~F.col("capped"), F.struct("ratio", "src", "level"))).over(every)["level"]
    out = filled.withColumn("rate", rate).withColumn(
        "target", F.when(F.col("capped"), F.col("cap")).otherwise(F.col("rate") * F.col("w")))
    return out.select("source", "src", "n_docs", "source_size", "target",
                      F.round("target").cast("bigint").alias("goal"))


def _needs(per_source: DataFrame) -> DataFrame:
    """Blocks of each source (n_blocks) and how many slots reach its goal (need)."""
    size, goal = F.col("source_size"), F.col("goal")
    blocks = F.ceil(size / BLOCK)
    need = F.when(size == 0, 0).otherwise(F.expr("goal div source_size") * blocks
                                          + F.ceil((goal % F.greatest(size, F.lit(1))) / BLOCK)).cast("bigint")
    return per_source.withColumn("n_blocks", blocks.cast("bigint")).withColumn("need", need)


def schedule(per_source: DataFrame) -> DataFrame:
    """(slot, src, pass, block): which block each slot of the mix takes."""
    spark = per_source.sparkSession
    needs = _needs(per_source).where("need > 0")
    every = Window.orderBy("src").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    upto = Window.orderBy("src").rowsBetween(Window.unboundedPreceding, 0)
    shares = needs.withColumn("hi", F.sum("need").over(upto) / F.sum("need").over(every)).withColumn(
        "lo", F.coalesce(F.lag("hi").over(Window.orderBy("src")), F.lit(0.0)))
    n_slots = needs.agg(F.sum("need")).collect()[0][0] or 0
    # the source of a point: equi join on grid cells, then its interval
    cells = shares.withColumn("cell", F.explode(F.sequence(
        F.floor(F.col("lo") * GRID), F.least(F.floor(F.col("hi") * GRID), F.lit(GRID - 1)))))
    points = spark.range(n_slots).select(F.col("id").alias("slot"), (F.col("id") + 1).cast("double").alias("i"))
    points = points.withColumn("u", F.col("i") * GOLDEN - F.floor(F.col("i") * GOLDEN)).withColumn(
        "cell", F.floor(F.col("u") * GRID)).withColumn("chunk", F.expr(f"slot div {PER_CHUNK}"))
    hits = points.join(cells, "cell").where("u >= lo AND (u < hi OR hi >= 1.0)").select(
        "slot", "src", "chunk")
    # the k-th slot of a source: rank inside a chunk, plus the chunks before
    counts = hits.groupBy("src", "chunk").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("src").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("src", "chunk", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    ranked = hits.withColumn("k", F.row_number().over(Window.partitionBy("src", "chunk").orderBy("slot")) - 1)
    placed = ranked.join(base, ["src", "chunk"]).select("src", (F.col("k") + F.col("base")).alias("k"), "slot")
    got = counts.groupBy("src").agg(F.sum("n").alias("got"))
    short = needs.join(got, "src", "left").where("need > coalesce(got, 0)").select(
        "src", F.explode(F.expr("sequence(coalesce(got, 0L), need - 1)")).alias("k")).select(
        "src", "k", (F.lit(n_slots) + F.col("k") * 1000000 + F.col("src")).alias("slot"))
    taken = placed.unionByName(short).join(needs.select("src", "need", "n_blocks"), "src").where("k < need")
    return taken.select("slot", "src", F.expr("k div n_blocks").alias("pass"), (F.col("k") % F.col("n_blocks")).alias("block"))


def pieces(sizes: DataFrame, per_source: DataFrame) -> DataFrame:
    """(rid, src, block, at, words): the words of each document in each block of
    its source; ``at`` is their place in the source's shuffled order."""
    n = sizes.count()
    cells = 1 << max(0, math.ceil(math.log2(max(n, 1) / PER_CELL)))
    h = F.xxhash64("doc_id", "tid", F.lit(17))
    src = per_source.select(F.col("source").alias("_s"), "src")
    rows = sizes.join(src, sizes["source"].eqNullSafe(src["_s"])).where("size > 0").select(
        "rid", "src", "size", h.alias("h"), F.pmod(F.shiftrightunsigned(h, 20), F.lit(cells)).alias("cell"))
    totals = rows.groupBy("src", "cell").agg(F.sum("size").alias("n"))
    earlier = Window.partitionBy("src").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select("src", "cell", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("src", "cell").orderBy("h", "rid").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("off", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(
        base, ["src", "cell"]).select("rid", "src", "size", (F.col("off") + F.col("base")).alias("start"))
    cut = placed.select("rid", "src", "size", "start", F.explode(F.expr(
        f"sequence(start div {BLOCK}, (start + size - 1) div {BLOCK})")).alias("block"))
    at = F.greatest("start", F.col("block") * BLOCK)
    end = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * BLOCK)
    return cut.select("rid", "src", "block", at.alias("at"), (end - at).alias("words"))


def passes(sizes: DataFrame, per_source: DataFrame) -> DataFrame:
    """(rid, pass, words, slot, at): the words of each document that each pass over
    its source takes, the first slot that takes them, and their place in the source."""
    slots = schedule(per_source)
    parts = pieces(sizes, per_source)
    goals = per_source.select("src", "goal", "source_size")
    joined = parts.join(slots, ["src", "block"]).join(goals, "src")
    left = F.col("goal") - F.col("pass") * F.col("source_size") - F.col("at")
    taken = joined.withColumn("words", F.greatest(F.lit(0), F.least("words", left))).where("words > 0")
    return taken.groupBy("rid", "pass").agg(F.sum("words").alias("words"), F.min(F.struct("slot", "at")).alias("x")).select(
        "rid", "pass", "words", "x.slot", "x.at")


def mix(docs: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken, slot_0, ...) of every row of
    ``docs``: slot_k is the first slot that takes it in pass k over its source."""
    sizes = sized(docs)
    per_source = materialize(targets(sizes), "mix-targets")
    slots = [f"slot_{k}" for k in range(MOST)]
    taken = passes(sizes, per_source).groupBy("rid").agg(F.sum("words").alias("taken"), *[
        F.min(F.when(F.col("pass") == k, F.col("slot"))).alias(name) for k, name in enumerate(slots)])
    src = per_source.select(F.col("source").alias("_s"), "source_size", "target")
    rows = sizes.join(src, sizes["source"].eqNullSafe(src["_s"])).join(taken, "rid", "left")
    return rows.select("doc_id", "size", "source_size", "target",
                       F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"), *slots)


def take_text(docs: DataFrame) -> DataFrame:
    """The mix as rows with the columns of ``docs``: a document once for each
    pass that takes it, its text cut behind the last word taken, n_chars (if
    there) counted anew. Rows are in order of the first slot that takes them, by
    ranges of slots."""
    rows = packed(docs, "doc_id", "text", "source").withColumn("rid", F.monotonically_increasing_id())
    kept = materialize(rows, "mix-docs")
    sizes = sized(kept)
    per_source = materialize(targets(sizes), "mix-targets")
    took = passes(sizes, per_source).join(sizes.select("rid", "size"), "rid").select("rid", "words", "size", "slot", "at")
    rows = kept.join(took, "rid").repartitionByRange("slot", "at").sortWithinPartitions("slot", "at")
    # the text up to the end of its last word taken: white space and words in turn
    n = F.col("words").cast("int")
    parts = F.zip_with(F.slice(F.split("text", WORD, -1), F.lit(1), n), F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), F.lit(1), n),
                       lambda white, word: F.concat(white, word))
    text = F.when(F.col("words") == F.col("size"), F.col("text")).otherwise(F.array_join(parts, ""))
    return unpacked(rows, docs, text, F.lit(True))
