"""Quality rules: text statistics, base rule and cross-document line frequency.

Method: normalised lines are hashed, distinct documents counted per (host,
line); lines held by more than ``max_share`` of the host's documents, and by more than
a few (``min_docs``), are boilerplate and are removed; a document with such lines
that keeps fewer than ``min_words`` words (what the base rule asks of any document), or
less than ``min_kept_share`` of its words, is depleted and rejected. The host is the
column ``source``. ``boilerplate`` tells the removed lines' positions, and
``without_boilerplate`` takes them out of the texts.

All per-row work is built-in functions; only hashes, counts and ids are
shuffled, never texts. Line counts are pre-aggregated before their shuffle, and
boilerplate lines, of which there are at most (lines / min_docs), are written as a
table of their own, so that AQE can split the join at the hot ones. A text's lines and
its windows of eight words stand in one row (some 20 bytes a window), so a text of
100 MB takes some 2 GB in its task.

Defined cases: null or empty texts have no words and fail the base rule; a null
host is a host of its own; a null doc_id is a document of its own text; rows
that agree in doc_id and text count as one document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.llm.common import WORD, let, line_key, materialize, packed, text_id, unpacked

WINDOW = 8
#: a line is boilerplate of a host beyond this share of its documents, and beyond a few of them
MAX_SHARE, MIN_DOCS = 0.02, 5


def _windows(words: Column) -> Column:
    """Hash and place of each window of eight words."""
    return F.when(F.size(words) < WINDOW, F.array().cast("array<struct<h:bigint,p:int>>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.size(words) - (WINDOW - 1)),
                    lambda p: F.struct(F.xxhash64(F.slice(words, p, F.lit(WINDOW))).alias("h"), p.alias("p"))))


def _covered(windows: Column) -> Column:
    """Words in windows whose hash stands there twice or more: windows sorted
    by hash, neighbours compared, their places merged in order."""
    def repeated(s):
        none = F.array(F.lit(None).cast("struct<h:bigint,p:int>"))
        body = F.size(s) - 1
        near = F.zip_with(
            F.arrays_zip(s.alias("s"), F.concat(none, F.slice(s, F.lit(1), body)).alias("before")),
            F.concat(F.slice(s, F.lit(2), body), none),
            lambda x, after: F.when((x["s"]["h"] == x["before"]["h"]) | (x["s"]["h"] == after["h"]), x["s"]["p"]))
        return F.array_sort(F.filter(near, lambda p: p.isNotNull()))
    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(1).alias("free"))

    def merge(acc, p):
        end = p + WINDOW
        return F.struct((acc["n"] + end - F.greatest(p, acc["free"])).cast("bigint").alias("n"), end.alias("free"))
    places = let(F.array_sort(windows), repeated)
    return F.aggregate(places, start, merge, lambda acc: acc["n"])


def text_stats(docs: DataFrame) -> DataFrame:
    """(doc_id, host, tid, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))

    def of_words(w):
        repeat = let(_windows(w), lambda v: F.when(
            F.size(F.array_distinct(F.transform(v, lambda x: x["h"]))) == F.size(v), F.lit(0).cast("bigint"))
            .otherwise(_covered(v)))
        return F.struct(F.size(w).cast("bigint").alias("n_words"), repeat.alias("n_repeat_words"))
    told = docs.select(
        "doc_id", F.col("source").alias("host"), text_id(F.col("text")).alias("tid"),
        let(words, of_words).alias("w"),
        F.char_length(F.regexp_replace(text, r"[\x20\x09-\x0D]+", "")).cast("bigint").alias("word_chars"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"))
    return told.select("doc_id", "host", "tid", "w.n_words", "word_chars", "n_symbols", "n_dup_lines",
                       "w.n_repeat_words")


def equal_rows(docs: DataFrame) -> DataFrame:
    """(host, doc_id, tid, copies): the documents, and how many equal rows each has."""
    return docs.groupBy(F.col("source").alias("host"), "doc_id", text_id(F.col("text")).alias("tid")).agg(
        F.count(F.lit(1)).alias("copies"))


def frequent_lines(docs: DataFrame, min_docs: int, max_share: float) -> tuple[DataFrame, DataFrame]:
    """The lines of each document with their word counts (those of all its equal
    rows), and the (host, line) pairs above the limit."""
    rows = docs.select("doc_id", F.col("source").alias("host"), text_id(F.col("text")).alias("tid"),
                       F.explode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("line"))
    rows = rows.where(F.col("line").rlike(WORD)).select(
        "doc_id", "host", "tid", F.xxhash64(line_key(F.col("line"))).alias("h"),
        F.regexp_count("line", F.lit(WORD)).alias("words"))
    # one row for each document and line; the documents of a line are then only counted
    lines = rows.groupBy("host", "h", "doc_id", "tid").agg(F.sum("words").alias("words"))
    hosts = equal_rows(docs).groupBy("host").agg(F.count(F.lit(1)).alias("n_docs"))
    counts = lines.groupBy("host", "h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > min_docs)
    many = counts.alias("c").join(hosts.alias("o"), F.col("c.host").eqNullSafe(F.col("o.host"))).where(
        F.col("n") > max_share * F.col("n_docs")).select("c.host", "h")
    return lines, materialize(many, "frequent-lines")


def boilerplate(docs: DataFrame, min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE) -> DataFrame:
    """(host, doc_id, tid, positions): the boilerplate lines of each document that has
    some, by their numbers from 0, ascending; rows equal in all three have one row."""
    _, many = frequent_lines(docs, min_docs, max_share)
    rows = docs.select("doc_id", F.col("source").alias("host"), text_id(F.col("text")).alias("tid"),
                       F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("pos", "line"))
    keyed = rows.where(F.col("line").rlike(WORD)).select("doc_id", "host", "tid", "pos", F.xxhash64(line_key(F.col("line"))).alias("h"))
    hit = keyed.alias("l").join(many.alias("m"), (F.col("l.h") == F.col("m.h")) & F.col("l.host").eqNullSafe(F.col("m.host")), "left_semi")
    return hit.groupBy("host", "doc_id", "tid").agg(F.array_sort(F.collect_set("pos")).alias("positions"))


def without_boilerplate(docs: DataFrame, min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE) -> DataFrame:
    """``docs`` with the boilerplate lines taken out of ``text`` (and n_chars, if there,
    counted anew where that changes it); every row stays."""
    rows = packed(docs, "doc_id", "text", "source").withColumn("tid", text_id(F.col("text"))).alias("r")
    gone = boilerplate(docs.select("doc_id", "text", "source"), min_docs, max_share).alias("g")
    joined = rows.join(gone, (F.col("r.tid") == F.col("g.tid")) & F.col("r.doc_id").eqNullSafe(F.col("g.doc_id"))
                       & F.col("r.source").eqNullSafe(F.col("g.host")), "left").select("r.*", "positions")
    lines = F.split(F.coalesce("text", F.lit("")), "\n")
    kept = F.array_join(F.filter(lines, lambda x, i: ~F.array_contains("positions", i)), "\n")
    return unpacked(joined, docs, kept, F.col("positions").isNotNull())


def quality_rules(docs: DataFrame, min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE, min_words: int = 20,
                  min_kept_share: float = 0.2) -> DataFrame:
    """One row per row of ``docs``: the statistics, base_failed, frequent_words
    (words in boilerplate lines) and kept."""
    docs = docs.select("doc_id", "text", "source")
    stats = text_stats(docs)
    lines, many = frequent_lines(docs, min_docs, max_share)
    lines, many = lines.alias("l"), many.alias("m")
    gone = lines.join(many, (F.col("l.h") == F.col("m.h")) & F.col("l.host").eqNullSafe(F.col("m.host")),
                      "left_semi").groupBy("doc_id", "tid", "host").agg(F.sum("words").alias("frequent_words"))
    gone, copies = gone.alias("g"), equal_rows(docs).where("copies > 1").alias("e")
    gone = gone.join(copies, (F.col("g.tid") == F.col("e.tid")) & F.col("g.doc_id").eqNullSafe(F.col("e.doc_id"))
                     & F.col("g.host").eqNullSafe(F.col("e.host")), "left").select(
        "g.doc_id", "g.tid", "g.host", F.expr("frequent_words div coalesce(copies, 1)").alias("frequent_words"))
    s, g = stats.alias("s"), gone.alias("g")
    joined = s.join(g, (F.col("s.tid") == F.col("g.tid")) & F.col("s.doc_id").eqNullSafe(F.col("g.doc_id"))
                    & F.col("s.host").eqNullSafe(F.col("g.host")), "left")
    n = F.col("n_words")
    failed = (n < 20) | (100 * F.col("n_repeat_words") > 30 * n)
    frequent = F.coalesce("frequent_words", F.lit(0)).cast("bigint")
    left = n - frequent
    depleted = (frequent > 0) & ((left < min_words) | (left < min_kept_share * n))
    return joined.select("s.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         failed.alias("base_failed"), (~failed & ~depleted).alias("kept"),
                         frequent.alias("frequent_words"))
