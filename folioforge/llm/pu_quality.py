"""Quality classifier by positive-unlabelled learning with a non-negative risk.

Trusted positives are documents labelled 1; unlabelled web text is any document
that is not held out. With the class prior pi, the risk of "everything unlabelled
is bad" is R = pi * E_p[loss(g, 1)] + max(0, E_u[loss(g, 0)] - pi * E_p[loss(g, 0)]):
the second part is the risk of the bad texts in the unlabelled ones, which is never
below 0; where a batch drives it there, the step goes the other way. With logistic
loss g is the log odds, so the score is the chance of label 1.

The prior is estimated from trusted positives and unlabelled text alone; documents
labelled 0 are not used at all. A first model tells positives from unlabelled text on
one half of the sample; on the other half, over all thresholds, the share of
unlabelled text above it divided by the share of positives above it bounds the prior
from above. The ratio is taken where it is least with margins for both sample sizes
added. The halves change places, and the mean of both is the prior.

Features see the text alone: rates of byte-class trigrams (upper and lower case,
digits, blanks, non-ASCII, each mark for itself), hashed to ``2**BITS`` places,
square roots of their shares, and a few plain figures (share of repeated lines and
words, word and line lengths, marks a word).

Training uses at most ``TRAIN_ROWS`` positives and as many unlabelled documents,
those with the least hashes of doc_id, one row of each doc_id; whole texts. Features
of the sample are built in parallel, and one task, which that parameter bounds (some
2 kB a row), runs the passes. Scores cover every row.

Defined cases: null and empty texts have no features and score the bias; null
labels are unused, repeated labels of a document count as the least; rows with null
doc_id are scored (held out or not as crc32 of the empty text says) and not trained
on; without any positive the score is 0.5 for all; very long texts are a chunk of
their own (some 40 bytes of memory a byte); further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioforge.llm.common import text_id
from folioforge.llm.words import U64, chunks, mix, text_bytes, word_hashes

BITS = 9
TRAIN_ROWS = 8_000
PASSES, BATCH, RATE, DECAY = 150, 1024, 0.1, 1e-4
PLAIN = 8
SIZE = (1 << BITS) + PLAIN

#: byte classes: lower, upper, digit, blank, line end, other control, non-ASCII, and each mark for itself
_CLASS = np.zeros(256, np.int64)
_CLASS[:32] = 5
_CLASS[[9, 32]] = 3
_CLASS[[10, 13]] = 4
_CLASS[128:] = 6
_MARKS = [i for i in range(33, 127) if not chr(i).isalnum()]
_CLASS[_MARKS] = 7 + np.arange(len(_MARKS))
_CLASS[48:58], _CLASS[65:91], _CLASS[97:123] = 2, 1, 0
_CLASSES = 7 + len(_MARKS)


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 1


def _repeats(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Values of each owner that stand there before."""
    order = np.lexsort((values, owner))
    same = (values[order][1:] == values[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    return np.bincount(owner[order][1:][same], minlength=n)


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(texts, SIZE) float32."""
    n = len(offsets) - 1
    out = np.zeros((n, SIZE), np.float32)
    if not len(data):
        return out
    kinds, owner = _CLASS[data], np.repeat(np.arange(n), np.diff(offsets))
    if len(data) > 2:
        whole = owner[2:] == owner[:-2]
        code = (kinds[:-2] * _CLASSES + kinds[1:-1]) * _CLASSES + kinds[2:]
        place = (mix(code[whole].astype(U64) + U64(1)) >> U64(64 - BITS)).astype(np.int64)
        grams = np.bincount(owner[2:][whole] << BITS | place, minlength=n << BITS).reshape(n, -1)
        out[:, :1 << BITS] = np.sqrt(grams / np.maximum(grams.sum(1, keepdims=True), 1))
    size = np.maximum(np.diff(offsets), 1)
    words, first = word_hashes(data, offsets)
    n_words = np.diff(first)
    word_owner = np.repeat(np.arange(n), n_words)
    edge = np.unique(np.concatenate([offsets, np.flatnonzero(data == 10) + 1]))
    lines, line_first = word_hashes(data, edge)
    line_owner = np.searchsorted(offsets, edge[:-1], "right") - 1
    sums = np.append(U64(0), np.cumsum(lines, dtype=U64))
    line_keys = sums[line_first[1:]] - sums[line_first[:-1]]
    filled = np.diff(line_first) > 0
    n_lines = np.maximum(np.bincount(line_owner[filled], minlength=n), 1)
    blank = np.isin(kinds, (3, 4, 5))
    letters = np.bincount(owner[~blank], minlength=n)
    marks = np.bincount(owner[kinds >= 7], minlength=n)
    some = np.maximum(n_words, 1)
    plain = (np.log1p(size) / 10, np.log1p(n_words) / 10, letters / some / 10, marks / some, np.log1p(size / n_lines) / 10,
             _repeats(words, word_owner, n) / some, _repeats(line_keys[filled], line_owner[filled], n) / n_lines,
             np.bincount(owner[kinds == 1], minlength=n) / np.maximum(letters, 1))
    out[:, 1 << BITS:] = np.stack(plain, 1)
    out[np.diff(offsets) == 0] = 0
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def nn_pu(positive: np.ndarray, unlabelled: np.ndarray, prior: float, passes: int = PASSES, seed: int = 7) -> np.ndarray:
    """Weights, the bias last, that minimise the non-negative risk (Adam over batches)."""
    rng = np.random.default_rng(seed)
    pos = np.hstack([positive, np.ones((len(positive), 1), positive.dtype)]).astype(np.float64)
    unl = np.hstack([unlabelled, np.ones((len(unlabelled), 1), unlabelled.dtype)]).astype(np.float64)
    w, m, v, t = np.zeros(pos.shape[1]), 0.0, 0.0, 0
    rounds = max(1, -(-len(unl) // BATCH))
    for turn in range(passes):
        p_lots = np.array_split(rng.permutation(len(pos)), min(rounds, len(pos)))
        u_lots = np.array_split(rng.permutation(len(unl)), rounds)
        for k in range(rounds):
            p, u = pos[p_lots[k % len(p_lots)]], unl[u_lots[k]]
            gp, gu = p @ w, u @ w
            bad_risk = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
            bad_step = u.T @ _sigmoid(gu) / len(u) - prior * (p.T @ _sigmoid(gp)) / len(p)
            step = -bad_step if bad_risk < 0 else prior * (p.T @ (_sigmoid(gp) - 1)) / len(p) + bad_step
            step = step + DECAY * np.append(w[:-1], 0)
            t += 1
            m, v = 0.9 * m + 0.1 * step, 0.999 * v + 0.001 * step * step
            w = w - RATE * (1 - turn / passes) * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w


def prior_bound(positive_scores: np.ndarray, unlabelled_scores: np.ndarray, doubt: float = 0.1) -> float:
    """Upper estimate of the share of positives among the unlabelled: the least ratio
    of shares above a threshold, margins for both sample sizes included."""
    p, u = np.sort(positive_scores), np.sort(unlabelled_scores)
    if not len(p) or not len(u):
        return 0.5
    at = np.unique(np.concatenate([p, u]))
    share = lambda x: 1 - np.searchsorted(x, at, "left") / len(x)
    margin = np.sqrt(np.log(4 / doubt) / 2) * (len(u) ** -0.5 + len(p) ** -0.5)
    above_p, above_u = share(p), share(u)
    fine = above_p > 0
    best = int(np.argmin((above_u[fine] + margin) / above_p[fine]))
    return float(np.clip(above_u[fine][best] / above_p[fine][best], 0.01, 0.99))


def estimated_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """The prior from positives and unlabelled text alone, each half judged by a model
    trained on the other."""
    found = []
    for turn in (0, 1):
        w = nn_pu(positive[turn::2], unlabelled[turn::2], 0.5, passes=max(PASSES // 3, 1))
        found.append(prior_bound(positive[1 - turn::2] @ w[:-1], unlabelled[1 - turn::2] @ w[:-1]))
    return float(np.mean(found))


def _examples(batches):
    for b in batches:
        data, offsets = text_bytes(b.column("text"))
        rows: list[bytes] = []
        for i, j in chunks(offsets):
            part = offsets[i:j + 1]
            rows += [x.tobytes() for x in features(data[part[0]:part[-1]], part - part[0])]
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), b.column("trusted"), b.column("web"), b.column("tid"), pa.array(rows, pa.binary())],
            names=["doc_id", "trusted", "web", "tid", "x"])


def _learn(batches):
    """One row: the prior and the weights."""
    kinds, rows = [], []
    for b in batches:
        order = mix(b.column("doc_id").to_numpy().astype(U64)).tolist()
        kinds += zip(order, b.column("trusted").to_pylist(), b.column("web").to_pylist())
        rows += b.column("x").to_pylist()
    turn = sorted(range(len(rows)), key=lambda i: (kinds[i][0], rows[i]))
    x = np.array([np.frombuffer(rows[i], np.float32) for i in turn], np.float32).reshape(-1, SIZE)
    positive = x[np.array([kinds[i][1] for i in turn], bool)]
    unlabelled = x[np.array([kinds[i][2] for i in turn], bool)]
    if not len(positive) or not len(unlabelled):
        return
    prior = estimated_prior(positive, unlabelled) if min(len(positive), len(unlabelled)) > 1 else 0.5
    w = nn_pu(positive, unlabelled, prior)
    yield pa.RecordBatch.from_arrays([pa.array([prior]), pa.array([w.tolist()], pa.list_(pa.float64()))], names=["prior", "weights"])


def train(docs: DataFrame, labels: DataFrame, column: str = "quality", rows: int = TRAIN_ROWS) -> tuple[float, np.ndarray]:
    """(prior, weights with the bias last) from rows that are not held out."""
    free = ~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull()
    yes, no = F.lit(True), F.lit(False)
    trusted = labels.select("doc_id", F.col(column).alias("label")).where(free & F.col("label").isNotNull()).groupBy(
        "doc_id").agg(F.min("label").alias("label")).where("label = 1").orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    web = docs.select("doc_id").where(free).distinct().orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id").limit(rows)
    sample = web.select("doc_id", no.alias("trusted"), yes.alias("web")).unionByName(
        trusted.select("doc_id", yes.alias("trusted"), no.alias("web"))).groupBy("doc_id").agg(
        F.max("trusted").alias("trusted"), F.max("web").alias("web"))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", text_id(F.col("text")).alias("tid")).join(
        F.broadcast(sample), "doc_id")  # at most 2 * `rows` rows of 10 bytes
    found = texts.mapInArrow(_examples, "doc_id bigint, trusted boolean, web boolean, tid bigint, x binary")
    one = found.groupBy("doc_id").agg(F.min(F.struct("tid", "trusted", "web", "x")).alias("e")).select(
        "doc_id", "e.trusted", "e.web", "e.x")
    learnt = one.repartition(1).mapInArrow(_learn, "prior double, weights array<double>").collect()
    if not learnt:
        return 0.5, np.zeros(SIZE + 1)
    return learnt[0]["prior"], np.array(learnt[0]["weights"])


def score(docs: DataFrame, weights: np.ndarray, column: str = "score") -> DataFrame:
    """Every column of ``docs`` and ``column``, the score from 0 to 1, from ``text`` alone."""
    sent = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches):
        w = sent.value
        for b in batches:
            data, offsets = text_bytes(b.column("text"))
            told = np.full(b.num_rows, w[-1])
            for i, j in chunks(offsets):
                part = offsets[i:j + 1]
                told[i:j] += features(data[part[0]:part[-1]], part - part[0]) @ w[:-1]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(_sigmoid(told))], names=[*b.schema.names, column])
    docs = docs.drop(column)
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(column, T.DoubleType())]))


def quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``."""
    _, weights = train(docs, labels)
    scored = score(docs.select("doc_id", "text"), weights)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
