"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams.

Features of a text: its distinct words, pairs of neighbours and pairs with one
word between (skip-grams), hashed to ``2**BITS`` places; words are runs of ASCII
letters, digits and non-ASCII bytes, A-Z lower-cased. Beginnings of long words
(``STEMS`` bytes) count like words, so that inflected and compound forms of one
word are learnt together. Places of fewer than
``MIN_DOCS`` sample texts stay out (they only learn single texts by heart). Each
coordinate has its own learning rate; the L1 term leaves few non-zero weights,
which are collected (at most 2**BITS of them) and broadcast.

Training uses at most ``TRAIN_ROWS`` labelled documents, those with the least
hash of doc_id, so reruns and any partitioning learn the same weights. Of rows
that repeat a doc_id the one of the least text hash trains. Features
of the sample are built in parallel; one task runs the passes over the sample,
which that parameter bounds. Scores cover every row and see the text only.

Defined cases: null and empty texts have no features and score the bias; labels
that are null are unused, repeated labels of a document count as the largest; a
null doc_id is scored, held out or not as crc32 of the empty text says; without
any usable label nothing is known to be toxic and the score is next to 0 for all.
A very long text is a chunk of its own (some 70 bytes of memory a byte of it).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioforge.llm.common import packed, text_id, unpacked
from folioforge.llm.words import PUNCT_BYTES, U64, chunks, mix, text_bytes, word_hashes

BITS = 20
TRAIN_ROWS = 12_000
PASSES = 3
MIN_DOCS = 3
STEMS = (5, 8)
ALPHA, BETA, L1, L2 = 2.0, 1.0, 5.0, 1.0


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2


def features(data: np.ndarray, offsets: np.ndarray):
    """(places, texts): the hashed word n-grams of a chunk, repeats included."""
    words, first = word_hashes(data, offsets, PUNCT_BYTES)
    texts = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    out, owner = [words], [texts]
    for gap, salt in ((1, 0x51ED270B), (2, 0xB5297A4D)):
        same = texts[gap:] == texts[:-gap]
        pair = mix(words[:-gap] * U64(0x9FB21C651E98DF25) + words[gap:] + U64(salt))
        out.append(pair[same])
        owner.append(texts[gap:][same])
    places = (np.concatenate(out) >> U64(64 - BITS)).astype(np.int32)
    return places, np.concatenate(owner)


def all_features(data: np.ndarray, offsets: np.ndarray):
    """``features`` and the places of each word's beginnings; a word no longer than one is its own."""
    places, texts = features(data, offsets)
    out, owner = [places], [texts]
    for cut in STEMS:
        stems, first = word_hashes(data, offsets, PUNCT_BYTES, cut)
        out.append((stems >> U64(64 - BITS)).astype(np.int32))
        owner.append(np.repeat(np.arange(len(offsets) - 1), np.diff(first)))
    return np.concatenate(out), np.concatenate(owner)


def _weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def ftrl(examples: list[np.ndarray], labels: np.ndarray, passes: int = PASSES):
    """Weights and bias after ``passes`` passes over the examples, each the
    distinct feature places of a text."""
    size = 1 << BITS
    seen = np.zeros(size, np.int64)
    for places in examples:
        seen[places] += 1
    examples = [x[seen[x] >= MIN_DOCS] for x in examples]
    z, n = np.zeros(size + 1), np.zeros(size + 1)  # the last place is the bias
    for _ in range(passes):
        for places, y in zip(examples, labels):
            at = np.append(places, size)
            w = _weights(z[at], n[at])
            w[-1] = -z[size] / ((BETA + np.sqrt(n[size])) / ALPHA)  # the bias has no penalty
            g = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35))) - y
            if not g:
                continue
            rate = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - rate * w
            n[at] += g * g
    return _weights(z[:-1], n[:-1]), -z[size] / ((BETA + np.sqrt(n[size])) / ALPHA)


def _examples(batches):
    for b in batches:
        data, offsets = text_bytes(b.column("text"))
        rows: list[bytes] = []
        for i, j in chunks(offsets):
            part = offsets[i:j + 1]
            places, texts = all_features(data[part[0]:part[-1]], part - part[0])
            order = np.argsort(texts, kind="stable")
            cuts = np.searchsorted(texts[order], np.arange(1, j - i))
            rows += [np.unique(x).tobytes() for x in np.split(places[order], cuts)]
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), b.column("toxic"), b.column("tid"), pa.array(rows, pa.binary())],
            names=["doc_id", "toxic", "tid", "places"])


def _train(batches):
    rows = pa.Table.from_batches([*batches], pa.schema([("doc_id", pa.int64()), ("toxic", pa.int32()), ("places", pa.binary())]))
    if not rows.num_rows:
        return
    order = mix(rows["doc_id"].to_numpy().astype(U64)).tolist()
    places, labels = rows["places"].to_pylist(), rows["toxic"].to_pylist()
    turn = sorted(range(len(order)), key=lambda i: (order[i], places[i]))
    weights, bias = ftrl([np.frombuffer(places[i], np.int32) for i in turn], np.array([labels[i] for i in turn], float))
    at = np.flatnonzero(weights).astype(np.int32)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(weights[at], bias))],
                                     names=["place", "weight"])


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> np.ndarray:
    """Weights by place, the bias last; from labelled rows that are not held out."""
    usable = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where(
        F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    sample = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(
        F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = docs.select("doc_id", "text", text_id(F.col("text")).alias("tid")).join(
        F.broadcast(sample), "doc_id")  # at most `rows` rows of 12 bytes
    found = texts.mapInArrow(_examples, "doc_id bigint, toxic int, tid bigint, places binary")
    examples = found.groupBy("doc_id").agg(F.min(F.struct("tid", "toxic", "places")).alias("x")).select(
        "doc_id", "x.toxic", "x.places")
    learnt = examples.repartition(1).mapInArrow(_train, "place int, weight double").collect()
    out = np.zeros((1 << BITS) + 1)
    out[-1] = -35.0
    for r in learnt:
        out[r["place"]] = r["weight"]  # place -1 is the bias
    return out


def score(docs: DataFrame, weights: np.ndarray, column: str = "score") -> DataFrame:
    """Every column of ``docs`` and ``column``, the score from 0 to 1, from ``text`` alone."""
    at = np.flatnonzero(weights[:-1]).astype(np.int32)
    sent = docs.sparkSession.sparkContext.broadcast((at, weights[at], float(weights[-1])))

    def run(batches):
        places, values, bias = sent.value
        w = np.zeros(1 << BITS)
        w[places] = values
        for b in batches:
            data, offsets = text_bytes(b.column("text"))
            total = np.full(b.num_rows, bias)
            for i, j in chunks(offsets):
                part = offsets[i:j + 1]
                hit, texts = all_features(data[part[0]:part[-1]], part - part[0])
                some = w[hit] != 0
                seen = np.unique(texts[some].astype(np.int64) << BITS | hit[some])
                total[i:j] += np.bincount(seen >> BITS, w[seen & ((1 << BITS) - 1)], j - i)
            found = pa.array(1.0 / (1.0 + np.exp(-np.clip(total, -35, 35))))
            yield pa.RecordBatch.from_arrays([*b.columns, found], names=[*b.schema.names, column])
    docs = docs.drop(column)
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(column, T.DoubleType())]))


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``."""
    scored = score(docs.select("doc_id", "text"), train(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more; null and empty texts stay."""
    scored = score(packed(docs, "text"), train(docs.select("doc_id", "text"), labels))
    empty = F.coalesce("text", F.lit("")) == ""
    return unpacked(scored.where((F.col("score") < threshold) | empty), docs)
