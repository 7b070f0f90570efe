"""Line dedup: the first document that holds a line keeps it.

Method: line hashes are range-partitioned and sorted by (hash, document,
position); a window streams over each hash and marks rows of later documents.
The result is a sparse drop bitmap per document (64-bit words, empty words left
out), not text.

A line may stand in a third of all documents, so the pass runs twice. The first
pass ranges over (hash, salt), with the salt taken from the document: rows that
are not of the first document of their (hash, salt) are decided there. What is
left of a hash, at most one document per salt, meets in the second pass.

Defined cases: a null or empty text is one empty line; keys shorter than
``min_chars`` code points are never dropped; a null doc_id never takes part
(its lines stay and make nobody else's lines drop); rows that repeat a doc_id
are one document. Extra columns are ignored here and kept by ``apply_drops``.
A text and the array of its lines stand in one row of its task (some three times its
bytes), at any length that a string of Spark may have.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioforge.llm.common import let, line_key, packed, shuffle_width, text_id, unpacked

SALTS = 64


def line_rows(docs: DataFrame, min_chars: int) -> DataFrame:
    """(h1, h2, doc_id, tid, pos) of the lines whose key is long enough; h1 and
    h2 are two 64-bit hashes of the key."""
    lines = docs.where("doc_id is not null").select(
        "doc_id", text_id(F.col("text")).alias("tid"),
        F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("pos", "line"))
    keyed = lines.select("doc_id", "tid", "pos", line_key(F.col("line")).alias("key")).where(
        F.char_length("key") >= min_chars)
    return keyed.select(F.xxhash64("key").alias("h1"), F.xxhash64("key", F.lit(1)).alias("h2"),
                        "doc_id", "tid", "pos")


def dropped_lines(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """(doc_id, tid, pos) of every line that an earlier document holds."""
    width = shuffle_width(docs.sparkSession)
    salted = line_rows(docs, min_chars).withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    in_salt = Window.partitionBy("h1", "h2", "salt").orderBy("doc_id", "pos")
    first = (salted.repartitionByRange(width, "h1", "salt")
             .withColumn("late", F.col("doc_id") > F.first("doc_id").over(in_salt))
             .withColumn("salt", F.when(F.col("late"), F.col("salt")).otherwise(F.lit(-1))))
    in_hash = Window.partitionBy("h1", "h2", "salt").orderBy("doc_id", "pos")
    second = (first.repartitionByRange(width, "h1", "salt")
              .withColumn("late", F.col("late") | (F.col("doc_id") > F.first("doc_id").over(in_hash))))
    return second.where("late").select("doc_id", "tid", "pos")


def drop_bitmaps(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """(doc_id, tid, drops): drops is the document's bitmap as its non-empty
    64-bit words, array<struct<word, bits>> by word. Documents without a
    dropped line have no row."""
    words = dropped_lines(docs, min_chars).groupBy(
        "doc_id", "tid", F.expr("pos div 64").alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, pos % 64))").alias("bits"))
    return words.groupBy("doc_id", "tid").agg(
        F.array_sort(F.collect_list(F.struct("word", "bits"))).alias("drops"))


def _positions(drops):
    """Line numbers of a bitmap's set bits, ascending."""
    bits = F.sequence(F.lit(0), F.lit(63))
    return F.flatten(F.transform(drops, lambda w: F.transform(
        F.filter(bits, lambda b: F.getbit(w["bits"], b) == 1), lambda b: w["word"] * 64 + b)))


def _without(lines, gone):
    """``lines`` without the (ascending) positions ``gone``: the runs between them."""
    def runs(both):
        cuts = F.concat(F.array(F.lit(-1).cast("bigint")), both["gone"],
                        F.array(F.size(both["lines"]).cast("bigint")))
        return let(cuts, lambda c: F.flatten(F.zip_with(
            F.slice(c, F.lit(1), F.size(c) - 1), F.slice(c, F.lit(2), F.size(c) - 1),
            lambda a, b: F.slice(both["lines"], (a + 2).cast("int"), (b - a - 1).cast("int")))))
    return let(F.struct(lines.alias("lines"), gone.alias("gone")), runs)


def apply_drops(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``docs`` with ``_n_lines``, ``_n_dropped`` and ``_kept_text`` added."""
    keyed = docs.withColumn("_tid", text_id(F.col("text")))
    marks = bitmaps.select(F.col("doc_id").alias("_d"), F.col("tid").alias("_t"), F.col("drops").alias("_drops"))
    joined = keyed.join(marks, (keyed["doc_id"] == marks["_d"]) & (keyed["_tid"] == marks["_t"]), "left")
    lines = F.split(F.coalesce("text", F.lit("")), "\n")
    counted = joined.withColumn("_n_dropped", F.when(F.col("_drops").isNull(), F.lit(0).cast("bigint")).otherwise(
        F.aggregate("_drops", F.lit(0).cast("bigint"), lambda a, w: a + F.bit_count(w["bits"]))))
    return counted.select(
        *[counted[c] for c in docs.columns], "_n_dropped", F.size(lines).cast("bigint").alias("_n_lines"),
        F.when(F.col("_drops").isNull(), F.coalesce("text", F.lit(""))).otherwise(
            F.array_join(_without(lines, _positions(F.col("_drops"))), "\n")).alias("_kept_text"))


def line_dedup(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_text) of every row of ``docs``."""
    docs = docs.select("doc_id", "text")
    done = apply_drops(docs, drop_bitmaps(docs, min_chars))
    return done.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"),
                       F.col("_kept_text").alias("kept_text"))


def without_repeats(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """``docs`` with the dropped lines taken out of ``text`` (and n_chars counted anew
    where that changes it); every row stays, whatever other columns there are."""
    done = apply_drops(packed(docs, "doc_id", "text"), drop_bitmaps(docs.select("doc_id", "text"), min_chars))
    return unpacked(done, docs, F.col("_kept_text"), F.col("_n_dropped") > 0)
