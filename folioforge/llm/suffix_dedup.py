"""Suffix-array dedup: bytes covered by a 400-byte string that stands elsewhere too.

A suffix array of the whole corpus does not fit a task, so equal strings are
first brought together, exactly:

1. Each 400-byte string has an anchor, its 64-byte window of the least hash
   (the leftmost of equals). Equal strings have equal anchors at equal places in
   them. Neighbouring strings share anchors, so a text falls into runs: strings
   of one anchor, about one run for every 170 bytes. Strings of an anchor whose
   hash is nowhere else are not repeated.
2. Runs with the same anchor, the same bytes and the same place of the anchor
   are repeated throughout; nothing but hashes moves for them.
3. Of what is left, each distinct run sends its bytes once to the shard of its
   anchor. The shard builds a suffix array by induced sorting and the permuted
   common prefixes; a string is repeated where its prefix in common with a
   neighbour reaches 400 bytes. Every string of the corpus lies in one run
   only, so a match is always a second occurrence.
4. An anchor with more than ``HOT`` distinct runs does not go to one shard: its
   strings are hashed (128 bits) one by one and counted, which spreads and
   pre-aggregates like any count.

Rows are identified by (doc_id, xxhash64(text)). Defined cases: null texts are
empty; texts under 400 bytes lose nothing; rows that are equal in doc_id and
text are two occurrences of their strings (both lose them); null doc_ids take
part like others; extra columns are ignored; texts of any length are read whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.llm.common import materialize, shuffle_width, text_id
from folioforge.llm.suffix_array import permuted_prefixes, suffix_array
from folioforge.llm.words import U64, chunks, mix, powers, text_bytes

LENGTH = 400
ANCHOR = 64
HOT = 4096
SHARD = 1 << 20
PIECE = 1 << 24
_SPAN = LENGTH - ANCHOR + 1
_SIDE = (LENGTH - ANCHOR) // 2
_KEY_BITS = 25
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def _prefix_sums(data: np.ndarray, base: int):
    power = powers(len(data) + 1, base)
    sums = np.zeros(len(data) + 1, U64)
    np.cumsum((data.astype(U64) + U64(1)) * power[:-1], dtype=U64, out=sums[1:])
    return sums, powers(len(data) + 1, pow(base, -1, 1 << 64))


def _range_hash(sums, back, start, end):
    """A hash of the bytes start..end-1 that does not depend on where they stand."""
    return mix((sums[end] - sums[start]) * back[start])


def runs(data: np.ndarray, offsets: np.ndarray):
    """The runs of texts data[offsets[i]:offsets[i+1]]: (text, start, count, anchor
    place, anchor hash, hash of the run's bytes), as arrays."""
    n = len(data) - LENGTH + 1
    if n <= 0:
        return tuple(np.empty(0, np.int64) for _ in range(4)) + (np.empty(0, U64),) * 2
    sums, back = _prefix_sums(data, _BASES[0])
    at = np.arange(len(data) - ANCHOR + 1)
    hashes = _range_hash(sums, back, at, at + ANCHOR)
    low = (hashes >> U64(_KEY_BITS) << U64(_KEY_BITS)) | at.astype(U64)
    span = 1
    while span * 2 <= _SPAN:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    low = np.minimum(low[:n], low[_SPAN - span:_SPAN - span + n])
    anchor = (low & U64((1 << _KEY_BITS) - 1)).astype(np.int64)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    inside = text[:n] == text[LENGTH - 1:]
    new = np.ones(n, bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | ~inside[:-1]
    start = np.flatnonzero(new & inside)
    stop = np.append(np.flatnonzero(new), n)
    stop = stop[np.searchsorted(stop, start, "right")]
    outside = np.append(np.flatnonzero(~inside), n)
    stop = np.minimum(stop, outside[np.searchsorted(outside, start)])
    place = anchor[start]
    own = _range_hash(sums, back, start, stop - 1 + LENGTH)
    own = mix(own + (place - start).astype(U64) * U64(0xD6E8FEB86659FD93) + (stop - start).astype(U64))
    return text[start], start, stop - start, place - start, hashes[place], own


def _pieces(data: np.ndarray, offsets: np.ndarray):
    """Chunks as (first text, bytes, offsets, place of the first byte in its text);
    texts over PIECE bytes in pieces that overlap by LENGTH - 1."""
    for i, j in chunks(offsets, 1 << 21):
        part = offsets[i:j + 1]
        if part[-1] - part[0] <= PIECE:
            yield i, data[part[0]:part[-1]], part - part[0], 0
            continue
        for p in range(0, int(part[1] - part[0]), PIECE):
            own = data[part[0] + p:min(part[1], part[0] + p + PIECE + LENGTH - 1)]
            yield i, own, np.array([0, len(own)]), p


def _run_rows(batches):
    for b in batches:
        data, offsets = text_bytes(b.column("text"))
        for first, part, ends, p in _pieces(data, offsets):
            text, start, count, place, f, c = runs(part, ends)
            rows = pa.array(first + text)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(rows), b.column("tid").take(rows), pa.array(f.view(np.int64)),
                 pa.array(c.view(np.int64)), pa.array(start - ends[text] + p), pa.array(count.astype(np.int32)),
                 pa.array(place.astype(np.int32))], names=["doc_id", "tid", "f", "c", "start", "count", "place"])


_RUN = "doc_id bigint, tid bigint, f bigint, c bigint, start bigint, count int, place int"


def _context_rows(batches):
    """Each wanted run of a text with its bytes."""
    for b in batches:
        for k in range(0, b.num_rows, 256):
            part = b.slice(k, 256).to_pydict()
            out = []
            for doc, tid, text, want in zip(part["doc_id"], part["tid"], part["text"], part["want"]):
                data = (text or "").encode()
                out += [(doc, tid, w["f"], w["start"], w["place"], w["hot"], data[w["start"]:w["start"] + w["count"] - 1 + LENGTH])
                        for w in want]
            cols = list(zip(*out)) if out else [()] * 7
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                             names=["doc_id", "tid", "f", "start", "place", "hot", "bytes"])


def _may_match(group: list[tuple]) -> list[tuple]:
    """Runs of one anchor without those that share neither the 168 bytes before
    nor the 168 bytes behind it with another: 400 bytes in common hold one of them."""
    sides: dict = {}
    keys = []
    for row in group:
        place, data = row[3], row[4]
        left = ("l", data[place - _SIDE:place]) if place >= _SIDE else None
        end = place + ANCHOR + _SIDE
        right = ("r", data[end - _SIDE:end]) if end <= len(data) else None
        keys.append((left, right))
        for k in (left, right):
            if k:
                sides[k] = sides.get(k, 0) + 1
    return [row for row, own in zip(group, keys) if any(k and sides[k] > 1 for k in own)]


def repeated(texts: list[bytes]) -> list[np.ndarray]:
    """For each text, the places whose 400 bytes stand at another place too, of
    this text or another; by a suffix array of all of them."""
    sizes = np.array([len(x) + 1 for x in texts])
    data = np.frombuffer(b"".join(x + b"\xff" for x in texts), np.uint8)
    ends = np.cumsum(sizes)
    room = np.repeat(ends - 1, sizes) - np.arange(len(data))
    order = suffix_array(np.append(data.astype(np.int64) + 1, 0), 257)[1:]
    common = permuted_prefixes(data, order, room)
    after = np.zeros(len(data), np.int64)  # with the neighbour behind
    after[order[:-1]] = common[order[1:]]
    hit = np.flatnonzero((np.maximum(common, after) >= LENGTH) & (room >= LENGTH))
    cuts = np.searchsorted(hit, ends)
    return [x - (e - n) for x, e, n in zip(np.split(hit, cuts[:-1]), ends, sizes)]


_SPANS = pa.schema([("doc_id", pa.int64()), ("tid", pa.int64()), ("start", pa.int64()), ("stop", pa.int64())])


def _spans(rows: list[tuple]) -> pa.RecordBatch:
    """Repeated spans of the runs (doc_id, tid, start, place, bytes)."""
    out = []
    for (doc, tid, start, _, _), at in zip(rows, repeated([r[4] for r in rows])):
        if len(at):
            cut = np.flatnonzero(np.diff(at) > LENGTH)
            lo, hi = at[np.append(0, cut + 1)], at[np.append(cut, len(at) - 1)] + LENGTH
            out += [(doc, tid, int(a) + start, int(z) + start) for a, z in zip(lo, hi)]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 4, _SPANS.types)], schema=_SPANS)


def _shard_rows(batches):
    """Streams runs sorted by anchor; whole anchors make shards of about SHARD bytes."""
    shard, held, anchor, group = [], 0, None, []
    for b in batches:
        for k in range(0, b.num_rows, 4096):
            part = b.slice(k, 4096).to_pydict()
            for f, *row in zip(part["f"], part["doc_id"], part["tid"], part["start"], part["place"], part["bytes"]):
                if f != anchor:
                    some = _may_match(group)
                    shard += some
                    held += sum(len(r[4]) for r in some)
                    anchor, group = f, []
                    if held >= SHARD:
                        yield _spans(shard)
                        shard, held = [], 0
                group.append(tuple(row))
    shard += _may_match(group)
    if shard:
        yield _spans(shard)


def _string_rows(batches):
    """Two hashes of each 400-byte string of hot anchors' runs."""
    for b in batches:
        part = b.to_pydict()
        for doc, tid, start, data in zip(part["doc_id"], part["tid"], part["start"], part["bytes"]):
            own = np.frombuffer(data, np.uint8)
            at = np.arange(len(own) - LENGTH + 1)
            pair = [_range_hash(*_prefix_sums(own, base), at, at + LENGTH).view(np.int64) for base in _BASES]
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array([doc] * len(at), pa.int64()), "tid": pa.array([tid] * len(at), pa.int64()),
                "start": pa.array(start + at, pa.int64()), "h1": pa.array(pair[0]), "h2": pa.array(pair[1])})


def _same_row(a: DataFrame, b: DataFrame):
    return (a["tid"] == b["tid"]) & a["doc_id"].eqNullSafe(b["doc_id"])


def repeated_spans(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """(doc_id, tid, spans): byte spans [start, stop) of each row that holds repeated
    strings, ascending; they may overlap."""
    spark = docs.sparkSession
    width = shuffle_width(spark)
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").withColumn("tid", text_id(F.col("text")))
    found = materialize(docs.where(F.octet_length("text") >= LENGTH).mapInArrow(_run_rows, _RUN), "runs")
    # a table of its own, so that the join has two plain shuffles and AQE can split a hot anchor
    again = materialize(found.groupBy("f").agg(
        F.count(F.lit(1)).alias("n"), F.min("c").alias("lo"), F.max("c").alias("hi")).where("n > 1").select(
        "f", (F.col("lo") < F.col("hi")).alias("mixed")), "anchors")
    hits = materialize(found.join(again, "f"), "hits")
    # distinct runs of each mixed anchor, each by its first occurrence
    kinds = materialize(hits.where("mixed").groupBy("f", "c").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "tid", "start", "count", "place")).alias("r")), "kinds")
    twice = materialize(kinds.where("n > 1").select("f", "c"), "twice")
    whole = hits.where("NOT mixed").unionByName(hits.where("mixed").join(twice, ["f", "c"], "left_semi")).select(
        "doc_id", "tid", "start", (F.col("start") + F.col("count") - 1 + LENGTH).alias("stop"))
    crowd = materialize(kinds.groupBy("f").agg(F.count(F.lit(1)).alias("kinds")), "crowd")  # as above
    wanted = kinds.join(crowd, "f").select("f", "r.*", (F.col("kinds") > hot).alias("hot")).groupBy("doc_id", "tid").agg(
        F.collect_list(F.struct("f", "start", "count", "place", "hot")).alias("want"))
    pairs = docs.join(wanted, _same_row(docs, wanted)).select(docs["doc_id"], docs["tid"], "text", "want")
    context = materialize(pairs.mapInArrow(
        _context_rows, "doc_id bigint, tid bigint, f bigint, start bigint, place int, hot boolean, bytes binary"), "contexts")
    sharded = context.where("NOT hot").repartition(width, "f").sortWithinPartitions("f").mapInArrow(
        _shard_rows, "doc_id bigint, tid bigint, start bigint, stop bigint")
    strings = context.where("hot").mapInArrow(
        _string_rows, "doc_id bigint, tid bigint, start bigint, h1 bigint, h2 bigint")
    often = strings.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h1", "h2")
    single = strings.join(often, ["h1", "h2"], "left_semi").select(
        "doc_id", "tid", "start", (F.col("start") + LENGTH).alias("stop"))
    spans = whole.unionByName(sharded).unionByName(single)
    return spans.groupBy("doc_id", "tid").agg(F.array_sort(F.collect_set(F.struct("start", "stop"))).alias("spans"))


def cut(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) of every row; kept is what is
    left of the text's UTF-8 bytes."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").withColumn("tid", text_id(F.col("text")))
    joined = docs.join(spans, _same_row(docs, spans), "left").select(docs["doc_id"], "text", "spans")

    def run(batches):
        for b in batches:
            for k in range(0, b.num_rows, 256):
                part = b.slice(k, 256).to_pydict()
                rows = []
                for doc, text, own in zip(part["doc_id"], part["text"], part["spans"]):
                    data, merged = (text or "").encode(), []
                    for s in sorted((s["start"], s["stop"]) for s in own or ()):
                        if merged and s[0] <= merged[-1][1]:
                            merged[-1][1] = max(merged[-1][1], s[1])
                        else:
                            merged.append([*s])
                    kept, at = [], 0
                    for a, z in merged:
                        kept.append(data[at:a])
                        at = z
                    kept = b"".join([*kept, data[at:]])
                    rows.append((doc, len(data), len(data) - len(kept), len(merged), kept))
                types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                                 names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])
    return joined.mapInArrow(run, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")


def suffix_dedup(docs: DataFrame, hot: int = HOT) -> DataFrame:
    return cut(docs, repeated_spans(docs, hot))
