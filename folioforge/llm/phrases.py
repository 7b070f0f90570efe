"""Collocations: phrases of two or three words that stand together more often than alone.

Method: vertical partitioning of a word suffix tree, cut off at depth three.

1. *Prefixes.* Words are counted per language. A word of fewer than
   ``min_count`` occurrences starts no phrase, so it gets no subtree. A word
   above the memory budget of a group is split into its two-word prefixes, and
   such a pair above the budget into its three-word ones.
2. *Groups.* Prefixes are hashed to ``BUCKETS`` places, and places are packed
   into groups of at most ``budget`` suffixes each (a place above it alone).
3. *Subtrees.* Each suffix (at most three words, never across a piece) goes to
   the group of its prefix. A group's suffixes, sorted node by node, are its
   subtree read from left to right: equal suffixes are a leaf, and the
   occurrences of a phrase are the total of the leaves below its node. Groups
   know nothing of each other; rows are streamed, so memory follows the Arrow batch.

A piece is what stands between two of ``.,;:!?`` or line ends; words are parted
by blanks and tabs; A-Z count as lower case.

The score of a cut of a phrase after its first k words is
floor(1000000 * a * a / (l * r)), in decimals of 38 digits (exact for counts up
to 10^16); the least cut counts. A phrase inside a longer candidate with at
least ``inside`` percent of its occurrences is dropped, the rest ranked per
language.

What the driver and the broadcasts see: at most 3 * ``HOT`` hashes of prefixes
above the budget (the budget is at least a ``HOT``-th of all words), the places'
groups and a bit map of ``2**FILTER_BITS`` bits that says which words may be
frequent (never wrong about a frequent one). A chunk's equal suffixes are put
together by 64-bit hashes (a chance of some 1e-8 for two of a chunk's some
10^6 to meet wrongly); everything later compares the words themselves.

Defined cases: null texts are empty; a null language is ``und``; rows are
counted as they are, so repeated rows and null or repeated doc_ids count each;
a very long text is a chunk of its own (some 60 bytes of memory a byte of it);
ties are broken by phrase, in byte order; further columns are ignored; an empty
table has no phrases.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioforge.llm.common import materialize, shuffle_width
from folioforge.llm.words import U64, chunks, mix, powers, text_bytes

MIN_COUNT, TOP, INSIDE = 10, 2000, 50
BUDGET = 1 << 19
HOT = 1 << 14
BUCKETS = 1 << 16
FILTER_BITS = 26
CHUNK = 1 << 21
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_PIECE = np.zeros(256, bool)
_PIECE[[*b".,;:!?\n\x0b\x0c\r"]] = True
_ENDS = _PIECE.copy()
_ENDS[[9, 32]] = True
_SALT = (U64(0x9FB21C651E98DF25), U64(0xD1B54A32D192ED03), U64(0x8CB92BA72F3D8DD7))


class Words:
    """The words of a chunk of texts: ``hash`` (of word and language), ``text``,
    ``joined`` (whether the next word stands in the same piece), and their bytes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, langs: np.ndarray):
        inside = ~_ENDS[data]
        border = np.zeros(len(data) + 1, bool)
        border[offsets] = True
        starts = inside.copy()
        starts[1:] &= ~inside[:-1] | border[1:-1]
        at = np.flatnonzero(starts)
        self.count = len(at)
        if not len(at):
            return
        self.text = np.searchsorted(offsets, at, "right") - 1
        piece = np.cumsum(_PIECE[data])[at] + self.text
        self.joined = np.append(piece[1:] == piece[:-1], False)
        run = np.cumsum(inside)
        begin = run[at] - 1
        self.length = np.diff(np.append(begin, run[-1]))
        place = np.arange(int(run[-1])) - np.repeat(begin, self.length)
        letters = _LOWER[data[inside]]
        values = (letters.astype(U64) + U64(1)) * powers(int(self.length.max()))[place]
        self.hash = mix(np.add.reduceat(values, begin) + self.length.astype(U64) + langs[self.text])
        # the words, one blank behind each
        self.begin = begin + np.arange(len(at))
        self.letters = np.full(len(letters) + len(at), 32, np.uint8)
        self.letters[np.arange(len(letters)) + np.repeat(np.arange(len(at)), self.length)] = letters

    def phrases(self, first: np.ndarray, last: np.ndarray) -> pa.Array:
        """The words first[i] to last[i], one blank between."""
        length = self.begin[last] + self.length[last] - self.begin[first]
        stop = np.cumsum(length)
        take = np.arange(int(stop[-1]) if len(stop) else 0) + np.repeat(self.begin[first] - (stop - length), length)
        offsets = np.zeros(len(first) + 1, np.int64)
        offsets[1:] = stop
        return pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(offsets), pa.py_buffer(self.letters[take])).cast(pa.string())


def _chunks(batches):
    """(language of each text, Words) chunk by chunk."""
    for b in batches:
        data, offsets = text_bytes(b.column("text"))
        langs = b.column("lang").fill_null("und")
        names = langs.dictionary_encode()
        salt = np.array([_text_hash(x) for x in names.dictionary.to_pylist()], U64)[names.indices.to_numpy()]
        for i, j in chunks(offsets, CHUNK):
            part = offsets[i:j + 1]
            found = Words(data[part[0]:part[-1]], part - part[0], salt[i:j])
            if found.count:
                yield langs.slice(i, j - i), found


def _text_hash(text: str) -> int:
    out = 1469598103934665603
    for byte in text.encode():
        out = (out ^ byte) * 1099511628211 & 0xFFFFFFFFFFFFFFFF
    return out


def _group(keys: np.ndarray):
    """(first place, count) of each distinct key."""
    order = np.argsort(keys, kind="stable")
    at = np.flatnonzero(np.append(True, keys[order][1:] != keys[order][:-1]))
    return order[at], np.diff(np.append(at, len(keys)))


def _totals(keys: np.ndarray, n: np.ndarray):
    """(first place, sum of n) of each distinct key."""
    order = np.argsort(keys, kind="stable")
    at = np.flatnonzero(np.append(True, keys[order][1:] != keys[order][:-1])) if len(keys) else np.zeros(0, np.int64)
    return order[at], np.add.reduceat(n[order], at) if len(keys) else n


def _word_rows(batches):
    for langs, w in _chunks(batches):
        first, n = _group(w.hash)
        total = np.bincount(w.text, minlength=len(langs))
        yield pa.RecordBatch.from_arrays(
            [pa.concat_arrays([langs.take(pa.array(w.text[first])), langs]),
             pa.concat_arrays([w.phrases(first, first), pa.nulls(len(langs), pa.string())]),
             pa.array(np.append(w.hash[first].view(np.int64), np.zeros(len(langs), np.int64))), pa.array(np.append(n, total))],
            names=["lang", "word", "h", "n"])


def word_counts(docs: DataFrame, min_count: int) -> DataFrame:
    """(lang, word, h, f): words of ``min_count`` occurrences or more; with null
    word a row for each language that has words: all its occurrences."""
    rows = docs.select("lang", "text").mapInArrow(_word_rows, "lang string, word string, h bigint, n bigint")
    return rows.groupBy("lang", "word").agg(F.max("h").alias("h"), F.sum("n").alias("f")).where(
        ((F.col("f") >= min_count) | F.col("word").isNull()) & (F.col("f") > 0))


def _pair_key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a * _SALT[0] + b * _SALT[1])


def _is_in(keys: np.ndarray, sorted_set: np.ndarray) -> np.ndarray:
    if not len(sorted_set):
        return np.zeros(len(keys), bool)
    return sorted_set[np.minimum(np.searchsorted(sorted_set, keys), len(sorted_set) - 1)] == keys


def _hashes(df: DataFrame) -> np.ndarray:
    return np.sort(np.array([r["h"] for r in df.select("h").collect()], np.int64).view(U64))


def hot_pairs(docs: DataFrame, hot: np.ndarray, budget: int, total: int) -> np.ndarray:
    """Keys of two-word prefixes whose first words are in ``hot``: all above the
    budget, and none up to half of it. A chunk tells the pairs that have at least
    half the budget's share of its words; what other chunks keep back of a pair
    adds up to less than half the budget."""
    if not len(hot):
        return hot
    sent = docs.sparkSession.sparkContext.broadcast(hot)

    def count(batches):
        for _, w in _chunks(batches):
            at = np.flatnonzero(w.joined & _is_in(w.hash, sent.value))
            if len(at):
                keys = _pair_key(w.hash[at], w.hash[at + 1])
                first, n = _group(keys)
                much = 2 * n * total >= budget * w.count
                yield pa.RecordBatch.from_arrays([pa.array(keys[first[much]].view(np.int64)), pa.array(n[much])], names=["h", "n"])
    rows = docs.select("lang", "text").mapInArrow(count, "h bigint, n bigint")
    return _hashes(rows.groupBy("h").agg(F.sum("n").alias("n")).where(2 * F.col("n") > budget))


def frequent_bits(words: DataFrame) -> np.ndarray:
    """Bit map of the words' hashes, ``2**FILTER_BITS`` bits, put together from
    pages of 2**15 bits."""
    place = F.shiftrightunsigned("h", 64 - FILTER_BITS)
    pages = words.select(F.shiftright(place, 15).alias("page"), place.bitwiseAND(F.lit(0x7FFF)).alias("bit"))

    def page(batches):
        for b in batches:
            at = b.column("page").to_numpy() << 15 | b.column("bit").to_numpy()
            for p in np.unique(at >> 15):
                bits = np.zeros(1 << 15, bool)
                bits[at[at >> 15 == p] & 0x7FFF] = True
                yield pa.RecordBatch.from_arrays([pa.array([p]), pa.array([np.packbits(bits).tobytes()], pa.binary())], names=["page", "bits"])
    rows = pages.repartition("page").sortWithinPartitions("page").mapInArrow(page, "page bigint, bits binary")
    out = np.zeros((1 << FILTER_BITS) >> 3, np.uint8)
    for r in rows.toLocalIterator():  # a page comes once for each Arrow batch that holds some of it
        at = r["page"] << 12
        out[at:at + (1 << 12)] |= np.frombuffer(r["bits"], np.uint8)
    return out


def pack(loads: np.ndarray, budget: int) -> np.ndarray:
    """The group of each place: neighbours together up to the budget."""
    group, free, out = -1, -1, np.zeros(len(loads), np.int32)
    for i, load in enumerate(loads.tolist()):
        if load > free:
            group, free = group + 1, budget
        out[i] = group
        free -= load
    return out


def suffixes(docs: DataFrame, bits: np.ndarray, hot1: np.ndarray, hot2: np.ndarray, groups: np.ndarray) -> DataFrame:
    """(grp, key, n): the suffixes of two or three words that may be frequent, by
    group; ``key`` is the language, a line end and the words; n is below 0 where the
    node above is counted in another group."""
    sent = docs.sparkSession.sparkContext.broadcast((bits, hot1, hot2, groups))

    def cut(batches):
        bits, hot1, hot2, groups = sent.value
        for langs, w in _chunks(batches):
            place = w.hash >> U64(64 - FILTER_BITS)
            often = (bits[place >> U64(3)] >> (U64(7) - (place & U64(7))).astype(np.uint8) & 1).astype(bool)
            two = w.joined & often
            two[:-1] &= often[1:]
            at = np.flatnonzero(two)
            if not len(at):
                continue
            three = two[at + 1]  # the last word of a chunk is joined to nothing
            third = np.where(three, w.hash[np.minimum(at + 2, w.count - 1)], U64(0))
            pair = _pair_key(w.hash[at], w.hash[at + 1])
            whole = mix(pair + third * _SALT[2])
            first, n = _group(whole)
            at, three, pair, whole = at[first], three[first], pair[first], whole[first]
            # a prefix of three words is a leaf; the node above it gets rows of its own, without the third word
            split = _is_in(prefix := w.hash[at], hot1) & _is_in(pair, hot2) & three
            above, n_above = _totals(pair[split], n[split])
            above = np.flatnonzero(split)[above]
            prefix = np.where(split, whole, np.where(_is_in(prefix, hot1), pair, prefix))
            at, last = np.append(at, at[above]), np.append(at + 1 + three, at[above] + 1)
            keys = pc.binary_join_element_wise(langs.take(pa.array(w.text[at])), w.phrases(at, last), "\n")
            yield pa.RecordBatch.from_arrays(
                [pa.array(groups[mix(np.append(prefix, pair[above])) >> U64(48)]), keys,
                 pa.array(np.append(np.where(split, -n, n), n_above).astype(np.int32))], names=["grp", "key", "n"])
    return docs.select("lang", "text").mapInArrow(cut, "grp int, key string, n int")


class _Runs:
    """Totals of runs of equal keys in a sorted stream; the last run stays open."""

    def __init__(self, size: int, least: int):
        self.size, self.least, self.key, self.total = size, least, None, 0

    def add(self, keys: pa.Array, n: np.ndarray):
        if not len(keys):
            return
        if self.key is not None:
            keys = pa.concat_arrays([pa.array([self.key], pa.string()), keys])
            n = np.append(self.total, n)
        new = np.append(True, pc.not_equal(keys.slice(1), keys.slice(0, len(keys) - 1)).to_numpy(zero_copy_only=False))
        at = np.flatnonzero(new)
        total = np.add.reduceat(n, at)
        self.key, self.total = keys[int(at[-1])].as_py(), int(total[-1])
        often = np.flatnonzero(total[:-1] >= self.least)
        if len(often):
            yield self.rows(keys.take(pa.array(at[often])), total[often])

    def close(self):
        if self.total >= self.least:
            yield self.rows(pa.array([self.key], pa.string()), np.array([self.total]))

    def rows(self, keys: pa.Array, total: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([keys, pa.array(np.full(len(keys), self.size, np.int32)), pa.array(total.astype(np.int64))],
                                          names=["key", "size", "f"])


def _prefixes(keys: pa.Array):
    """(all keys cut behind their second word, which keys have three words)."""
    data, offsets = text_bytes(keys)
    owner = np.repeat(np.arange(len(keys)), np.diff(offsets))
    line = np.flatnonzero(data == 10)
    start = np.zeros(len(keys), np.int64)
    start[owner[line]] = line  # the last line end: words hold none
    blank = np.flatnonzero(data == 32)
    blank = blank[blank > start[owner[blank]]]
    nth = np.arange(len(blank)) - np.searchsorted(owner[blank], owner[blank])
    stop = offsets[1:].copy()
    second = blank[nth == 1]
    stop[owner[second]] = second
    three = stop < offsets[1:]
    length = stop - offsets[:-1]
    ends = np.cumsum(length)
    take = np.arange(int(ends[-1])) + np.repeat(offsets[:-1] - (ends - length), length)
    out = np.append(0, ends)
    return pa.LargeStringArray.from_buffers(len(keys), pa.py_buffer(out), pa.py_buffer(data[take])).cast(pa.string()), three


def subtrees(rows: DataFrame, min_count: int, width: int) -> DataFrame:
    """(lang, phrase, size, f): the nodes of ``min_count`` occurrences or more."""
    def walk(batches):
        pairs, triples = _Runs(2, min_count), _Runs(3, min_count)
        for b in batches:
            if not b.num_rows:
                continue
            keys, n = b.column("key"), b.column("n").to_numpy().astype(np.int64)
            heads, three = _prefixes(keys)
            inner = n > 0
            yield from pairs.add(heads if inner.all() else heads.filter(pa.array(inner)), n[inner])
            yield from triples.add(keys.filter(pa.array(three)), np.abs(n[three]))
        yield from pairs.close()
        yield from triples.close()
    dealt = rows.repartition(width, "grp").sortWithinPartitions("key")  # a node's leaves stand together
    nodes = dealt.select("key", "n").mapInArrow(walk, "key string, size int, f bigint")
    return nodes.select(F.regexp_extract("key", r"(?s)^(.*)\n[^\n]*$", 1).alias("lang"),
                        F.substring_index("key", "\n", -1).alias("phrase"), "size", "f")


def phrase_counts(docs: DataFrame, min_count: int = MIN_COUNT, budget: int = BUDGET) -> tuple[DataFrame, DataFrame]:
    """(words, phrases): ``word_counts``, and (lang, phrase, size, f) of the phrases
    of two and three words with ``min_count`` occurrences or more."""
    spark = docs.sparkSession
    words = materialize(word_counts(docs, min_count), "words")
    total = words.where("word IS NULL").agg(F.sum("f")).first()[0] or 0
    budget = max(budget, -(-total // HOT))
    known = words.where("word IS NOT NULL")
    hot1 = _hashes(known.where(F.col("f") > budget))
    hot2 = hot_pairs(docs, hot1, budget, total)
    loads = np.zeros(BUCKETS)
    sums = known.where(F.col("f") <= budget).mapInArrow(_places, "place int, f bigint").groupBy("place").agg(F.sum("f").alias("f"))
    for r in sums.collect():  # at most BUCKETS rows
        loads[r["place"]] = r["f"]
    loads += (total - loads.sum()) / BUCKETS  # what longer prefixes spread
    groups = pack(loads, budget)
    rows = suffixes(docs, frequent_bits(known), hot1, hot2, groups)
    width = max(shuffle_width(spark), min(int(groups[-1]) + 1, 4 * shuffle_width(spark)))
    return words, materialize(subtrees(rows, min_count, width), "phrases")


def _places(batches):
    for b in batches:
        place = (mix(b.column("h").to_numpy().view(U64)) >> U64(48)).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(place), b.column("f")], names=["place", "f"])


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP, inside: int = INSIDE,
                 budget: int = BUDGET) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``top`` phrases of each language."""
    words, phrases = phrase_counts(docs, min_count, budget)
    one = words.where("word IS NOT NULL").select("lang", "word", F.col("f").alias("f"))
    two = phrases.where("size = 2").select("lang", "phrase", "f")
    part = F.split("phrase", " ")
    cand = phrases.select("lang", "phrase", "size", F.col("f").alias("a"), part[0].alias("first"),
                          F.element_at(part, -1).alias("last"),
                          F.when(F.col("size") == 3, F.substring_index("phrase", " ", 2)).alias("head"),
                          F.when(F.col("size") == 3, F.substring_index("phrase", " ", -2)).alias("tail"))
    longer = cand.where("size = 3").select("lang", F.explode(F.array("head", "tail")).alias("phrase"), "a").groupBy(
        "lang", "phrase").agg(F.max("a").alias("most"))
    cand = (cand.join(one.toDF("lang", "first", "f_first"), ["lang", "first"])
            .join(one.toDF("lang", "last", "f_last"), ["lang", "last"]))
    pairs = cand.where("size = 2").join(materialize(longer, "longer"), ["lang", "phrase"], "left").where(
        f"most IS NULL OR 100 * CAST(most AS DECIMAL(38,0)) < {int(inside)} * CAST(a AS DECIMAL(38,0))")
    pairs = pairs.select("lang", "phrase", "a", F.col("f_first").alias("l1"), F.col("f_last").alias("r1"),
                         F.lit(None).cast("bigint").alias("l2"), F.lit(None).cast("bigint").alias("r2"))
    triples = (cand.where("size = 3").join(two.toDF("lang", "head", "f_head"), ["lang", "head"])
               .join(two.toDF("lang", "tail", "f_tail"), ["lang", "tail"])
               .select("lang", "phrase", "a", F.col("f_first").alias("l1"), F.col("f_tail").alias("r1"),
                       F.col("f_head").alias("l2"), F.col("f_last").alias("r2")))
    cut = "CAST(1000000 * CAST(a AS DECIMAL(16,0)) * CAST(a AS DECIMAL(16,0)) AS DECIMAL(38,0)) div " \
          "(CAST(l{0} AS DECIMAL(19,0)) * CAST(r{0} AS DECIMAL(19,0)))"
    both = pairs.unionByName(triples).withColumns({"s1": F.expr(cut.format(1)), "s2": F.expr(cut.format(2))})
    second = F.coalesce(F.col("s2") < F.col("s1"), F.lit(False))
    scored = both.select("lang", "phrase", "a", F.when(second, F.col("l2")).otherwise(F.col("l1")).alias("l"),
                         F.when(second, F.col("r2")).otherwise(F.col("r1")).alias("r"),
                         F.when(second, F.col("s2")).otherwise(F.col("s1")).alias("score"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    n = words.where("word IS NULL").select("lang", F.col("f").alias("n"))
    return best.join(n, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n",
                                       F.col("score").cast("bigint").alias("score"))
