"""MinHash near-dedup with bottom-k sketches.

A document's set: its distinct shingles of ``SHINGLE`` words (fewer words: the
whole sequence as one). One hash function orders all shingles; a sketch is the
``KEEP`` least values of a set, kept with the top bit flipped, so that Spark's
signed order is theirs. Two sets of Jaccard similarity 0.75 share at least
``NEED`` values of their sketches, but for a chance of some 1e-8.

1. Documents with equal sets are one class, kept by its least doc_id.
2. Inverted lists of the retained values. A value of one class lists nobody. A
   class with fewer than NEED shared values has no partner; of the others only
   their rarest (shared - NEED + 1) values are listed: two classes that share
   NEED values share one of these. Lists are split by set size (a ratio of 4/3
   at most).
3. Each list compares its members with a few centres, not all pairs: the
   overlap of the union's sketch filters, exact sets decide. Components follow.
4. In lists of at most ``SHORT`` members the pairs that are still in different
   components and were not compared are compared the same way.
5. Members of longer lists, which passages held by many documents make, are
   listed once more by their whole sets: only the rarest quarter of a set, so a
   class meets others where three quarters of it are common. Classes connected
   by these lists are a block. In a block the classes outside its largest
   component meet all others, in chunks: a matrix product of the two chunks'
   sets counts all overlaps, and only linked pairs leave the task.

Sets hold 64-bit hashes of shingles. Rows with equal doc_id are one document;
rows with null doc_id are never linked (component_id null, kept). Null or empty
texts have an empty set and are linked with nothing. Extra columns are ignored.
A very long text is a chunk of its own (some 60 bytes of memory a byte of it).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.llm.common import materialize, packed, shuffle_width, text_id, unpacked
from folioforge.llm.components import components
from folioforge.llm.words import U64, chunks, mix, ngram_hashes, text_bytes, word_hashes

SHINGLE = 5
KEEP = 40
NEED = 12
PERCENT = 75
SALTS = 64
SHORT = 16
ASKED, BASE = 256, 1024


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The set of each text: sorted distinct hashes of its shingles."""
    words, first = word_hashes(data, offsets)
    grams = ngram_hashes(words, SHINGLE)
    out = []
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= SHINGLE:
            out.append(np.unique(grams[a:b - SHINGLE + 1]))
        elif b > a:
            out.append(ngram_hashes(words[a:b], int(b - a)) + U64(b - a))
        else:
            out.append(np.empty(0, U64))
    return out


def _sets_of(column: pa.Array):
    data, offsets = text_bytes(column)
    for i, j in chunks(offsets):
        part = offsets[i:j + 1]
        yield from shingle_sets(data[part[0]:part[-1]], part - part[0])


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, n, d1, d2, sketch): size and digest of each row's set, and its least values."""
    def run(batches):
        for b in batches:
            n, d1, d2, rows = [], [], [], []
            for s in _sets_of(b.column("text")):
                n.append(len(s))
                d1.append(np.add.reduce(mix(s), dtype=U64))
                d2.append(np.bitwise_xor.reduce(mix(s * U64(0x9E3779B97F4A7C15)), dtype=U64))
                rows.append((s[:KEEP] ^ U64(1 << 63)).view(np.int64))
            flat = np.concatenate(rows) if rows else np.empty(0, np.int64)
            ends = np.cumsum([0, *map(len, rows)], dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int32()), pa.array(np.array(d1, U64).view(np.int64)),
                 pa.array(np.array(d2, U64).view(np.int64)), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
                names=["doc_id", "n", "d1", "d2", "sketch"])
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        run, "doc_id bigint, n int, d1 bigint, d2 bigint, sketch array<bigint>")


def inverted_lists(classes: DataFrame, most: int | None) -> DataFrame:
    """(value, band, node, n): the lists that each class stands in, by the values
    in ``sketch``: two partners share PERCENT of the larger, at most ``most``."""
    posts = classes.select("node", F.explode("sketch").alias("value"))
    # a table of its own: with two plain shuffles AQE can split a hot value
    shared = materialize(posts.groupBy("value").agg(F.count(F.lit(1)).alias("freq")).where("freq > 1"), "shared")
    found = posts.join(shared, "value").groupBy("node").agg(
        F.array_sort(F.collect_list(F.struct("freq", "value"))).alias("found"))
    size = classes.select("node", "n", F.size("sketch").alias("m"))
    need = F.ceil(F.col("m") * PERCENT / 100).cast("int")
    need = need if most is None else F.least(F.lit(most), need)
    rows = found.join(size, "node").withColumn("rarest", F.size("found") - need + 1).where("rarest > 0").select(
        "node", "n", F.explode(F.slice("found", F.lit(1), F.col("rarest"))["value"]).alias("value"))
    band = F.floor(F.log(F.col("n").cast("double")) / float(np.log(100 / PERCENT)) + 1e-9).cast("int")
    return rows.select("value", F.explode(F.array(band, band + 1)).alias("band"), "node", "n")


def _alike(x: Column, y: Column) -> Column:
    """Whether two sketches leave the similarity possible: how much of the
    union's sketch both have. Exact where the sketches are whole sets."""
    union = F.slice(F.array_sort(F.array_union(x, y)), 1, KEEP)
    both = F.size(F.array_intersect(union, F.array_intersect(x, y)))
    return F.when(F.size(union) < KEEP, both * 100 >= F.size(union) * PERCENT).otherwise(both >= NEED + 2)


def promising(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) that the union's sketch does not rule out."""
    sk = classes.select("node", "sketch")
    a, b = sk.toDF("a", "sa"), sk.toDF("b", "sb")
    return pairs.join(a, "a").join(b, "b").where(_alike(F.col("sa"), F.col("sb"))).select("a", "b")


def _links(batches):
    """Streams (a, salt, node, text), a's own row first in its group; tells linked pairs."""
    group, own = None, None
    for b in batches:
        found = []
        heads = zip(b.column("a").to_pylist(), b.column("salt").to_pylist(), b.column("node").to_pylist())
        for (a, salt, node), s in zip(heads, _sets_of(b.column("text"))):
            if (a, salt) != group:
                group, own = (a, salt), []
            if node == a:
                own.append(s)
                continue
            for mine in own:
                # both sides sorted and distinct
                both = len(mine) + len(s) - len(np.unique(np.concatenate([mine, s])))
                if 100 * both >= PERCENT * (len(mine) + len(s) - both):
                    found.append((a, node))
                    break
        yield pa.RecordBatch.from_pydict({"a": pa.array([x for x, _ in found], pa.int64()),
                                          "b": pa.array([x for _, x in found], pa.int64())})


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough. a's text meets its
    partners in salted groups, one partner at a time."""
    width = shuffle_width(pairs.sparkSession)
    dealt = pairs.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(SALTS)).cast("int"))
    mine = dealt.select("a", "salt", F.col("a").alias("node")).distinct()
    other = dealt.select("a", "salt", F.col("b").alias("node"))
    rows = mine.unionByName(other).join(texts, "node").select("a", "salt", "node", "text")
    return rows.repartition(width, "a", "salt").sortWithinPartitions(
        "a", "salt", F.col("node") != F.col("a")).mapInArrow(_links, "a bigint, b bigint").distinct()


def _size_fits(n: Column, m: Column) -> Column:
    return F.least(n, m) * 100 >= F.greatest(n, m) * PERCENT


def star_pairs(lists: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(a, b) of each list's centres with its other members; and the centres by
    list, with the list's size."""
    one = F.struct("node", "n")
    centres = materialize(lists.groupBy("value", "band").agg(
        F.count(F.lit(1)).alias("members"), F.min(one).alias("c1"), F.max(one).alias("c2"),
        F.min(F.struct(F.xxhash64("node").alias("h"), "node", "n")).alias("c3")).where(
        "members > 1").withColumn("c3", F.struct("c3.node", "c3.n")), "centres")
    rows = lists.join(centres, ["value", "band"]).select(
        "node", "n", F.explode(F.array("c1", "c2", "c3")).alias("c"))
    pairs = rows.where((F.col("node") != F.col("c.node")) & _size_fits(F.col("n"), F.col("c.n"))).select(
        F.least("node", "c.node").alias("a"), F.greatest("node", "c.node").alias("b")).distinct()
    return pairs, centres


def rest_pairs(lists: DataFrame, centres: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs of a short list that no centre took part in and that are in different components."""
    short = centres.where(f"members BETWEEN 4 AND {SHORT}").select(
        "value", "band", F.array("c1.node", "c2.node", "c3.node").alias("done"))
    rows = lists.join(short, ["value", "band"]).where(~F.array_contains("done", F.col("node"))).join(
        labels, "node", "left").select("value", "band", "node", "n", F.coalesce("label", "node").alias("label"))
    rows = materialize(rows, "short-lists")
    x, y = rows.alias("x"), rows.alias("y")
    return x.join(y, (F.col("x.value") == F.col("y.value")) & (F.col("x.band") == F.col("y.band"))
                  & (F.col("x.node") < F.col("y.node")) & (F.col("x.label") != F.col("y.label"))
                  & _size_fits(F.col("x.n"), F.col("y.n"))).select(
        F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()


def _whole_sets(batches):
    for b in batches:
        rows = [s.view(np.int64) for s in _sets_of(b.column("text"))]
        yield pa.RecordBatch.from_arrays(
            [b.column("node"), pa.array([len(x) for x in rows], pa.int32()), pa.array(rows, pa.list_(pa.int64()))],
            names=["node", "n", "sketch"])


def _linked(asked: list[tuple], base: list[tuple]):
    """(a, b) of the asked (node, label, set) and the base that are linked and of different labels."""
    at = np.unique(np.concatenate([s for *_, s in asked]))
    at = at[np.isin(at, np.concatenate([s for *_, s in base]))]  # values of both sides

    def matrix(rows):
        out = np.zeros((len(rows), len(at)), np.float32)
        for k, (*_, s) in enumerate(rows):
            out[k, np.flatnonzero(np.isin(at, s, assume_unique=True))] = 1
        return out
    both = np.rint(matrix(asked) @ matrix(base).T).astype(np.int64)
    n, m = (np.array([len(s) for *_, s in rows]) for rows in (asked, base))
    label, other = (np.array([x for _, x, _ in rows]) for rows in (asked, base))
    hit = (100 * both >= PERCENT * (n[:, None] + m[None, :] - both)) & (label[:, None] != other[None, :])
    for i, j in zip(*np.nonzero(hit)):
        yield asked[i][0], base[j][0]


def _block_links(batches):
    """Streams (block, part, side, node, label, set), the base of a part before what is asked of it."""
    part, base, asked = None, [], []

    def tell():
        found = list(_linked(asked, base)) if asked and base else []
        asked.clear()
        return pa.RecordBatch.from_pydict({"a": pa.array([min(x) for x in found], pa.int64()),
                                           "b": pa.array([max(x) for x in found], pa.int64())})
    for b in batches:
        cols = [b.column(k).to_pylist() for k in ("block", "rc", "nc", "side", "node", "label")]
        for k, (block, rc, nc, side, node, label) in enumerate(zip(*cols)):
            if (block, rc, nc) != part:
                yield tell()
                part, base = (block, rc, nc), []
            own = (node, label, b.column("sketch")[k].values.to_numpy())
            (base if side == 0 else asked).append(own)
            if len(asked) >= ASKED:
                yield tell()
    yield tell()


def block_links(sets: DataFrame, labels: DataFrame) -> DataFrame:
    """Links (a, b) between components, among classes given by their whole sets."""
    width = shuffle_width(sets.sparkSession)
    lists = materialize(inverted_lists(sets, None), "whole-lists")
    heads = materialize(lists.groupBy("value", "band").agg(F.min("node").alias("a"), F.max("node").alias("z")).where("a < z"), "heads")
    edges = lists.join(heads, ["value", "band"]).select("a", F.col("node").alias("b"))
    blocks = components(edges).select("node", F.col("label").alias("block"))
    named = blocks.join(labels, "node", "left").select("node", "block", F.coalesce("label", "node").alias("label"))
    counts = named.groupBy("block", "label").agg(F.count(F.lit(1)).alias("k"))
    shapes = counts.groupBy("block").agg(F.max(F.struct("k", "label"))["label"].alias("largest"), F.sum("k").alias("total"),
                                         F.max("k").alias("most")).where("most < total")
    placed = named.join(shapes, "block").withColumn("h", F.xxhash64("node")).withColumn(
        "n_rc", F.ceil((F.col("total") - F.col("most")) / ASKED)).withColumn("n_nc", F.ceil(F.col("total") / BASE))
    rc, nc = F.pmod("h", "n_rc"), F.pmod(F.shiftright("h", 20), "n_nc")
    base = placed.select("block", F.explode(F.expr("sequence(0L, n_rc - 1)")).alias("rc"), nc.alias("nc"),
                         F.lit(0).alias("side"), "node", "label")
    asked = placed.where("label <> largest").select(
        "block", rc.alias("rc"), F.explode(F.expr("sequence(0L, n_nc - 1)")).alias("nc"), F.lit(1).alias("side"), "node", "label")
    rows = base.unionByName(asked).join(sets.select("node", "sketch"), "node")
    return rows.repartition(width, "block", "rc", "nc").sortWithinPartitions("block", "rc", "nc", "side").select(
        "block", "rc", "nc", "side", "node", "label", "sketch").mapInArrow(_block_links, "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs``."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    rows = materialize(sketches(docs), "sketches")
    linkable = rows.where("doc_id IS NOT NULL AND n > 0")
    classes = materialize(linkable.groupBy("d1", "d2", "n").agg(
        F.min("doc_id").alias("node"), F.first("sketch").alias("sketch")), "classes")
    lists = materialize(inverted_lists(classes, NEED), "lists")
    pairs, centres = star_pairs(lists)
    first = materialize(promising(pairs, classes), "pairs")
    crowds = lists.join(centres.select("value", "band", "members"), ["value", "band"]).groupBy("node").agg(
        (F.max("members") > SHORT).alias("crowded"))
    texts = materialize(docs.join(crowds, docs["doc_id"] == crowds["node"]).select("node", "crowded", "text"), "texts")
    links = materialize(verified(first, texts.drop("crowded")), "links")
    labels = materialize(components(links), "labels")
    more = rest_pairs(lists, centres, labels).join(first, ["a", "b"], "left_anti")
    rest = materialize(verified(materialize(promising(more, classes), "rest"), texts.drop("crowded")), "links")
    sets = materialize(texts.where("crowded").select("node", "text").mapInArrow(
        _whole_sets, "node bigint, n int, sketch array<bigint>"), "whole-sets")
    blocks = materialize(block_links(sets, labels), "links")
    # documents by class, classes by links, and rows that repeat a doc_id
    of_class = linkable.join(classes.select("d1", "d2", "n", "node"), ["d1", "d2", "n"]).where(
        "doc_id <> node").select(F.col("node").alias("a"), F.col("doc_id").alias("b"))
    found = components(links.unionByName(rest).unionByName(blocks).unionByName(of_class)).select(
        F.col("node").alias("doc_id"), "label")
    out = rows.join(found, "doc_id", "left")
    component = F.coalesce("label", "doc_id")
    return out.select("doc_id", F.col("n").cast("bigint").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with the document of the least doc_id of each group of near-duplicates;
    of rows that repeat a doc_id one stays; rows with null doc_id all stay."""
    kept = near_duplicates(docs.select("doc_id", "text")).where("kept AND doc_id IS NOT NULL").select(
        F.col("doc_id").alias("kept_id")).distinct()
    known = packed(docs, "doc_id", "text").where("doc_id IS NOT NULL").withColumn("tid", text_id(F.col("text")))
    first = Window.partitionBy("doc_id").orderBy("tid")
    stay = known.join(kept, known["doc_id"] == kept["kept_id"], "left_semi").withColumn(
        "nth", F.row_number().over(first)).where("nth = 1")
    return unpacked(stay, docs).unionByName(docs.where("doc_id IS NULL"))
