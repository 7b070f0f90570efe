"""Document fingerprints: digests of statistically improbable byte windows.

Method: every window of 64 bytes gets a rank from its entropy; the further an
entropy lies from that of ordinary text, the rarer the window and the lower its
rank; windows of hardly any entropy (runs of one character) rank last. In each
run of 64 neighbouring windows the rarest scores a point; windows with at
least ``POPULAR`` points are features. A feature sets five of the 2048 bits
of a Bloom filter; after ``PER_FILTER`` features the next filter of the chain
begins. Two fingerprints compare filter by filter: the bits they share beyond
what chance gives, over the most they could share; each filter of the shorter
chain counts with its best partner.

The ranks are a fixed rule, so the fingerprint of a text depends on its bytes
alone and equal texts have equal fingerprints. A text too short for a run of 64
windows (under 127 bytes) has its first and its last 64 bytes as features. A
longer text without a popular window (short, periodic or of hardly any entropy)
is scored once more, windows of hardly any entropy too and equal ranks in order
of a hash of the window; its popular windows, or else its best, are features,
each content once, beside its first and its last 64 bytes.

Entropies of all windows come from integer sums: a window's value changes, from
one place to the next, by what the byte that enters and the byte that leaves
add for the number of equal bytes in the window. Everything is NumPy over
chunks of whole texts.

Defined cases: null and empty texts have an empty fingerprint, which is like
itself (1) and unlike all others (0); every other text has a feature; rows with
null doc_id stand first, rows with equal doc_id in order of their texts.
A very long text is held whole with its windows (some 60 bytes of memory a byte of it).
"""

from __future__ import annotations

import base64
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.llm.common import shuffle_width
from folioforge.llm.words import U64, chunks, mix

WIDTH = 64
POPULAR = 16
PER_FILTER = 160
BITS = 2048
HASHES = 5
#: entropy of ordinary text (bits a byte in a window of 64) and the least that makes a feature
USUAL, LEAST = 4.0, 1.5
_SCALE = 1 << 20
_c = np.arange(1, WIDTH + 1, dtype=np.float64)
#: what the c-th equal byte of a window adds to sum(c * log2 c), in fixed point
_GAIN = np.round(_SCALE * np.diff(np.append(0.0, _c * np.log2(_c)))).astype(np.int64)
_POP = np.array([bin(i).count("1") for i in range(256)], np.uint8)
_LAST = np.uint32(0xFFFFFFFF)


def _ranks(data: np.ndarray) -> np.ndarray:
    """The rank of the window at each place, lowest the rarest."""
    n = len(data)
    back, ahead = np.zeros(n, np.uint8), np.zeros(n, np.uint8)
    block = 1 << 16
    for s in range(0, n, block):  # equal bytes among the 63 before and behind, block by block for the cache
        e = min(n, s + block)
        for d in range(1, WIDTH):
            lo = max(s, d)
            if lo < e:
                same = (data[lo:e] == data[lo - d:e - d]).view(np.uint8)
                back[lo:e] += same
                ahead[lo - d:e - d] += same
    # sum over the first window, then what enters at i + 63 less what leaves at i - 1
    counts = np.bincount(data[:WIDTH], minlength=256)
    first = int(sum(_GAIN[:c].sum() for c in counts if c))
    steps = _GAIN[back[WIDTH:]] - _GAIN[ahead[:n - WIDTH]]
    total = first + np.concatenate([[0], np.cumsum(steps)])
    entropy = np.log2(WIDTH) - total / (_SCALE * WIDTH)
    far = np.abs(entropy - USUAL)
    ranks = np.round((8.0 - far) * 100000).astype(np.uint32)
    ranks[entropy < LEAST] = _LAST
    return ranks


def _second_features(data: np.ndarray) -> np.ndarray:
    """Hashes of the features of one text that has no popular window."""
    content, span = data.astype(U64), 1
    while span < WIDTH:  # a hash of each window, by doubling
        content = mix(content[:-span] * U64(0x9E3779B97F4A7C15) + content[span:])
        span *= 2
    key = _ranks(data).astype(U64) << U64(32) | content >> U64(32)
    best, span = np.arange(len(key)), 1
    while span < WIDTH:  # place of the least key (then the leftmost) of 64 neighbouring windows
        left, right = best[:-span], best[span:]
        best = np.where(key[left] <= key[right], left, right)
        span *= 2
    points = np.bincount(best, minlength=len(key))
    at = np.flatnonzero(points >= min(POPULAR, points.max()))
    at = np.unique(np.append(at, [0, len(key) - 1]))
    at = at[np.sort(np.unique(content[at], return_index=True)[1])]
    return _digest(np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, WIDTH)[at]))


def _features(data: np.ndarray, offsets: np.ndarray):
    """(hashes, texts) of the features of texts data[offsets[i]:offsets[i+1]]."""
    texts = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    hashes, owner = [], []
    n_win = len(data) - WIDTH + 1
    if n_win > 0:
        ranks = _ranks(data)
        whole = texts[:n_win] == texts[WIDTH - 1:]
        ranks[~whole] = _LAST
        # rarest (then leftmost) of 64 neighbouring windows, by doubling
        key = ranks.astype(U64) << U64(32) | np.arange(n_win, dtype=U64)
        run, span = key, 1
        while span < WIDTH and len(run) > span:
            run = np.minimum(run[:-span], run[span:])
            span *= 2
        if span == WIDTH:
            # a run of windows counts where all its windows are of one text
            same = whole[:len(run)] & whole[WIDTH - 1:][:len(run)] & (texts[:len(run)] == texts[WIDTH - 1:][:len(run)])
            best = run[same]
            points = np.bincount((best[best >> U64(32) != U64(_LAST)] & U64(_LAST)).astype(np.int64), minlength=n_win)
            at = np.flatnonzero(points >= POPULAR)
            if len(at):
                windows = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, WIDTH)[at])
                hashes.append(_digest(windows))
                owner.append(texts[at])
    size = np.diff(offsets)
    for i in np.flatnonzero((size > 0) & (size < 2 * WIDTH - 1)):
        text = data[offsets[i]:offsets[i + 1]]
        own = np.zeros((2, WIDTH), np.uint8)
        for row, part in zip(own, (text[:WIDTH], text[-WIDTH:])):
            row[:len(part)] = part
        hashes.append(_digest(own[:1] if size[i] <= WIDTH else own) + U64(min(size[i], WIDTH)))
        owner.append(np.full(len(hashes[-1]), i))
    have = np.zeros(len(size), bool)
    for o in owner:
        have[o] = True
    for i in np.flatnonzero((size >= 2 * WIDTH - 1) & ~have):
        hashes.append(_second_features(data[offsets[i]:offsets[i + 1]]))
        owner.append(np.full(len(hashes[-1]), i))
    if not hashes:
        return np.empty(0, U64), np.empty(0, np.int64)
    h, o = np.concatenate(hashes), np.concatenate(owner)
    order = np.argsort(o, kind="stable")
    return h[order], o[order]


def _digest(windows: np.ndarray) -> np.ndarray:
    h = np.zeros(len(windows), U64)
    for k, word in enumerate(windows.view("<u8").T):
        h = mix(h ^ (word * U64(0x9E3779B97F4A7C15 + 2 * k)))
    return h


def fingerprints(texts: list[bytes]) -> list[np.ndarray]:
    """A chain of Bloom filters, uint8 array (filters, 256), for each text."""
    offsets = np.cumsum([0, *map(len, texts)])
    out: list[np.ndarray] = []
    for i, j in chunks(offsets):
        part = offsets[i:j + 1] - offsets[i]
        data = np.frombuffer(b"".join(texts[i:j]), np.uint8)
        h, owner = _features(data, part)
        n = np.bincount(owner, minlength=j - i)
        place = np.arange(len(h)) - np.repeat(np.cumsum(n) - n, n)
        filters = -(-n // PER_FILTER)
        base = np.cumsum(filters) - filters
        row = base[owner] + place // PER_FILTER
        bits = np.zeros((int(filters.sum()), BITS), bool)
        for k in range(HASHES):
            bits[row, (h >> U64(11 * k)).astype(np.int64) & (BITS - 1)] = True
        packed = np.packbits(bits, axis=1)
        out += [packed[base[t]:base[t] + filters[t]] for t in range(j - i)]
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """0 to 1; equal fingerprints give 1."""
    if a.shape == b.shape and np.array_equal(a, b):
        return 1.0
    if not len(a) or not len(b):
        return 0.0
    if len(a) > len(b):
        a, b = b, a
    na, nb = _POP[a].sum(1, dtype=np.int64)[:, None], _POP[b].sum(1, dtype=np.int64)[None, :]
    both = np.empty((len(a), len(b)))
    for i, x in enumerate(a):
        both[i] = _POP[b & x].sum(1, dtype=np.int64)
    chance = na * nb / BITS
    most = np.minimum(na, nb)
    # chance overlaps vary; a margin of 30% of the room above the mean keeps them at 0
    floor = chance + 0.3 * (most - chance)
    score = np.clip((both - floor) / np.maximum(most - floor, 1e-9), 0.0, 1.0)
    return float(score.max(1).mean())


def text_form(f: np.ndarray) -> str:
    """Filters by ":", each in base64."""
    return ":".join(base64.b64encode(x.tobytes()).decode() for x in f)


def _bucket(cuts: list[int]):
    """How many of the ascending ``cuts`` are at most doc_id, by a two-step search."""
    if not cuts:
        return F.lit(0)
    step = math.isqrt(len(cuts)) + 1
    groups = [cuts[k:k + step] for k in range(0, len(cuts), step)]
    inner = ", ".join("array(" + ", ".join(f"{c}L" for c in g) + ")" for g in groups)
    heads = "array(" + ", ".join(f"{g[0]}L" for g in groups) + ")"
    return F.expr(f"""CASE WHEN doc_id IS NULL THEN 0 ELSE coalesce(transform(
        array(size(filter({heads}, b -> b <= doc_id))),
        g -> (g - 1) * {step} + size(filter(try_element_at(array({inner}), nullif(g, 0)), b -> b <= doc_id)))[0], 0) END""")


def _dealt(docs: DataFrame) -> DataFrame:
    """(bucket, look, doc_id, text): the rows in buckets of doc_id ranges; the first
    rows of a bucket stand, as look-ahead (look = 1), at the end of the one before.
    The driver sees one bound and one least doc_id a bucket."""
    spark = docs.sparkSession
    n = 2 * shuffle_width(spark)
    cuts = docs.select("doc_id").approxQuantile("doc_id", [k / n for k in range(1, n)], 0.2 / n)
    named = docs.select(_bucket(sorted({int(c) for c in cuts})).alias("bucket"), "doc_id", "text")
    least = named.groupBy("bucket").agg(
        F.count_if(F.col("doc_id").isNull()).alias("nulls"), F.min("doc_id").alias("low")).orderBy("bucket").collect()
    before = dict(zip([r["bucket"] for r in least], [r["bucket"] for r in least[-1:] + least[:-1]]))
    ahead = F.lit(None).cast("int")
    for r in least[:1]:
        if r["nulls"]:  # null ids come first
            ahead = F.when(F.col("doc_id").isNull(), before[r["bucket"]])
    heads = spark.createDataFrame([(r["low"], before[r["bucket"]]) for r in least if not r["nulls"]],
                                  "doc_id bigint, ahead int")
    found = named.join(F.broadcast(heads), "doc_id", "left").withColumn("ahead", F.coalesce("ahead", ahead))
    own = F.struct("bucket", F.lit(0).alias("look"))
    copies = F.when(F.col("ahead").isNull(), F.array(own)).otherwise(
        F.array(own, F.struct(F.col("ahead").alias("bucket"), F.lit(1).alias("look"))))
    return found.select(F.explode(copies).alias("c"), "doc_id", "text").select("c.bucket", "c.look", "doc_id", "text")


def _edited(own: str, following: str) -> str:
    half = len(own) // 2
    return own[:len(own) - half] + following[:half]


def _rows(batches):
    """Streams sorted rows; each waits for its successor."""
    held: list[tuple] = []  # rows of one bucket not yet told, the last without its successor

    def tell(following: str | None):
        """Rows that have a successor; the last one's is ``following``."""
        if following is None:
            ready = list(zip(held[:-1], [r[2] for r in held[1:]]))
            del held[:-1]
        else:
            ready = list(zip(held, [*[r[2] for r in held[1:]], following]))
            held.clear()
        for k in range(0, len(ready), 512):
            some = ready[k:k + 512]
            edited = [_edited(r[2], nxt) for r, nxt in some]
            own = [r[2].encode() for r, _ in some]
            changed = [x.encode() for x in edited]
            after = some[-1][1].encode()
            prints = fingerprints([*own, after, *changed])
            mine, second = prints[:len(some) + 1], prints[len(some) + 1:]
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array([r[1] for r, _ in some], pa.int64()),
                "n_chars": pa.array([len(r[2]) for r, _ in some], pa.int64()),
                "edited": pa.array(edited, pa.string()),
                "fingerprint": pa.array([text_form(x) for x in mine[:-1]], pa.string()),
                "edited_fingerprint": pa.array([text_form(x) for x in second], pa.string()),
                "near_edited": pa.array([likeness(a, b) for a, b in zip(mine, second)], pa.float64()),
                "near_next": pa.array([likeness(a, b) for a, b in zip(mine, mine[1:])], pa.float64())})

    bucket, told = None, False
    for b in batches:
        for k in range(0, b.num_rows, 512):
            part = b.slice(k, 512).to_pydict()
            for at, look, doc, text in zip(part["bucket"], part["look"], part["doc_id"], part["text"]):
                text = text or ""
                if at != bucket:
                    if held:
                        raise RuntimeError("a bucket ended without its look-ahead row")
                    bucket, told = at, False
                if look:
                    if not told:
                        yield from tell(text)
                        told = True
                else:
                    held.append((at, doc, text))
            if len(held) > 1:
                yield from tell(None)


def fingerprint_chain(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: (doc_id, n_chars, edited, fingerprint,
    edited_fingerprint, near_edited, near_next), where ``edited`` has the last
    half of the text replaced by the beginning of the next document's."""
    width = shuffle_width(docs.sparkSession)
    dealt = _dealt(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"))
    rows = dealt.repartition(width, "bucket").sortWithinPartitions(
        "bucket", "look", F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first())
    return rows.select("bucket", "look", "doc_id", "text").mapInArrow(
        _rows, "doc_id bigint, n_chars bigint, edited string, fingerprint string, "
               "edited_fingerprint string, near_edited double, near_next double")
