"""Hard negatives from blocks along a Hilbert curve, chosen by zone maps.

Method. The candidates are written in order of (label, place on a Hilbert curve
through all dimensions, widest first) as Parquet blocks of ``BLOCK`` rows, each
with the least and greatest component per dimension and label (its zone map).
Interval arithmetic on a zone gives bounds for the inner products of an anchor
with all rows of the block: the anchor's positive components meet the zone's upper
edges and its negative ones the lower edges, or the other way round. Anchors go
in bands of ``BAND`` neighbours on the curve. For each band, the zones alone say
which blocks may hold a positive, or a negative inside one of its anchors'
windows; only these are read, in tiles of one band and some ``TILE`` blocks. A
first read of the ``PROBE`` most promising blocks gives thresholds (an anchor's
fifth best positive, a window's third best negative), and the second read takes
the blocks whose upper bound still reaches them. Bounds only leave out blocks
that cannot matter, so the result is that of comparing everything.

Components are floor(256 * x). Inner products are exact integers: in floating
point where they stay below 2^53, in 64 bits below 2^62, in Python's integers
beyond; a score that passes 64 bits is told as the nearest 64-bit number.

Every anchor is a stated query against all rows; a band and a tile are bounded in
rows, so no group grows with the data. The driver sees the dimensions' ranges
and counts. Where vectors have nothing in common (random directions), zones
leave out little and the work is anchors times rows.

Defined cases: rows with a null label or vector, or a null or non-finite
component take no part; shorter vectors count as filled up with zeros; a null
vec_id is never an anchor, but may be a positive or negative (told as null, last
among ties); rows that repeat a vec_id are rows of their own; no anchors, or an
empty table, give no rows; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioforge.llm.common import materialize, shuffle_width
from folioforge.llm.hilbert import curve_bits, curve_keys

BLOCK, BAND, TILE, PROBE, ZONES = 256, 512, 16, 8, 256
POSITIVES, NEGATIVES = 5, 3
_LAST = np.iinfo(np.int64).max


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """The quantised vectors as float64 rows of ``dims`` components, zeros behind short ones."""
    if not len(column):
        return np.zeros((0, dims))
    flat = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * 256)
    size = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    if (size == dims).all():
        return flat.reshape(-1, dims)
    out = np.zeros((len(column), dims))
    start = np.cumsum(size) - size
    out[np.repeat(np.arange(len(column)), size), np.arange(len(flat)) - np.repeat(start, size)] = flat
    return out


class Shape:
    """What all tasks know of the vectors: dimensions, their ranges and order, and
    the number type that holds a component."""

    def __init__(self, low: np.ndarray, high: np.ndarray, spread: np.ndarray):
        self.dims, self.low, self.high = len(low), low, high
        self.order = np.argsort(-spread, kind="stable")
        most = float(max(np.abs(low).max(initial=0), np.abs(high).max(initial=0)))
        self.dtype = np.int16 if most < 1 << 15 else np.int32 if most < 1 << 31 else np.float64
        reach = most * most * max(self.dims, 1)
        self.numbers = np.float64 if reach < 1 << 53 else np.int64 if reach < 1 << 62 else object

    def keys(self, rows: np.ndarray) -> np.ndarray:
        bits = curve_bits(self.dims)
        wide = np.maximum(self.high - self.low, 1e-300)
        cells = np.clip((rows - self.low) / wide * (1 << bits), 0, (1 << bits) - 1).astype(np.uint32)
        return curve_keys(cells[:, self.order], bits)

    def unpack(self, blob) -> np.ndarray:
        return np.frombuffer(blob, self.dtype).reshape(-1, self.dims) if self.dims else np.zeros((0, 0), self.dtype)

    def exact(self, rows: np.ndarray) -> np.ndarray:
        if self.numbers is object:
            return np.array([[int(v) for v in r] for r in rows.astype(object)], object).reshape(len(rows), self.dims)
        return rows.astype(self.numbers)


def usable(vectors: DataFrame, turned: int = 7, labels: int = 10) -> DataFrame:
    """(vec_id, label, embedding) of the rows that take part; where vec_id is
    divisible by ``turned``, label is the next of ``labels`` labels."""
    good = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select("vec_id", F.col("label").cast("bigint").alias("label"), "embedding").where(
        F.col("label").isNotNull() & F.col("embedding").isNotNull() & good)
    next_label = F.when(F.col("vec_id") % turned == 0, (F.col("label") + 1) % labels).otherwise(F.col("label"))
    return rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), next_label.alias("label"), "embedding")


def shape_of(rows: DataFrame) -> Shape:
    def ranges(batches):
        for b in batches:
            if not b.num_rows:
                continue
            dims = pc.max(pc.list_value_length(b.column("embedding"))).as_py()
            m = matrix(b.column("embedding"), dims)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(dims, dtype=np.int32)), pa.array(m.min(0, initial=np.inf)), pa.array(m.max(0, initial=-np.inf)),
                 pa.array(m.sum(0)), pa.array((m * m).sum(0)), pa.array(np.full(dims, len(m), np.int64))],
                names=["dim", "lo", "hi", "s", "ss", "n"])
    found = rows.select("embedding").mapInArrow(ranges, "dim int, lo double, hi double, s double, ss double, n bigint").groupBy(
        "dim").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("s").alias("s"), F.sum("ss").alias("ss"),
                   F.sum("n").alias("n")).orderBy("dim").collect()  # a row for each dimension
    with np.errstate(all="ignore"):
        col = lambda k: np.array([r[k] for r in found], float)
        spread = np.nan_to_num(col("ss") / col("n") - (col("s") / col("n")) ** 2)
    return Shape(np.minimum(col("lo"), 0), np.maximum(col("hi"), 0), spread)  # zeros fill up short vectors


def curve_order(rows: DataFrame, shape: Shape) -> DataFrame:
    """(vec_id, label, place, vec)."""
    def place(batches):
        for b in batches:
            m = matrix(b.column("embedding"), shape.dims)
            keys, vecs = shape.keys(m), m.astype(shape.dtype)
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), b.column("label"), pa.array([k.tobytes() for k in keys], pa.binary()),
                 pa.array([v.tobytes() for v in vecs], pa.binary())], names=["vec_id", "label", "place", "vec"])
    return rows.mapInArrow(place, "vec_id bigint, label bigint, place binary, vec binary")


_BLOCK = ("block bigint, n int, label_lo bigint, label_hi bigint, zone binary, ids array<bigint>, "
          "labels array<bigint>, vecs binary")


def _rows_in_lots(batches, size: int):
    held: list[pa.Table] = []
    count = 0
    for b in batches:
        held.append(pa.Table.from_batches([b]))
        count += b.num_rows
        while count >= size:
            table = pa.concat_tables(held)
            yield table.slice(0, size)
            held, count = [table.slice(size)], count - size
    if count:
        yield pa.concat_tables(held)


def blocks(rows: DataFrame, shape: Shape) -> DataFrame:
    """The candidates as blocks in order of (label, place), with their zone maps."""
    def cut(batches):
        part = TaskContext.get().partitionId() << 24
        for k, t in enumerate(_rows_in_lots(batches, BLOCK)):
            vecs = b"".join(t["vec"].to_pylist())
            m = shape.unpack(vecs)
            labels = t["label"].to_numpy()
            zone = np.stack([m.min(0), m.max(0)]).tobytes() if shape.dims else b""
            yield pa.RecordBatch.from_pylist([{
                "block": part | k, "n": t.num_rows, "label_lo": int(labels.min()), "label_hi": int(labels.max()), "zone": zone,
                "ids": t["vec_id"].to_pylist(), "labels": labels.tolist(), "vecs": vecs}], pa.schema(
                    [("block", pa.int64()), ("n", pa.int32()), ("label_lo", pa.int64()), ("label_hi", pa.int64()), ("zone", pa.binary()),
                     ("ids", pa.list_(pa.int64())), ("labels", pa.list_(pa.int64())), ("vecs", pa.binary())]))
    spark = rows.sparkSession
    written = materialize(curve_order(rows, shape), "curve")  # range sampling would compute the places twice
    width = max(1, min(shuffle_width(spark), -(-written.count() // BLOCK)))
    dealt = written.repartitionByRange(width, "label", "place", F.xxhash64("vec_id")).sortWithinPartitions(
        "label", "place", "vec_id")
    return materialize(dealt.select("vec_id", "label", "vec").mapInArrow(cut, _BLOCK), "blocks")


def bands(table: DataFrame, shape: Shape, every: int) -> DataFrame:
    """(band, rows, ids, labels, vecs): the anchors, ``BAND`` neighbours in a row; a
    row number is its block times 2^12 and its place there."""
    width = max(shape.dims * np.dtype(shape.dtype).itemsize, 1)

    def pick(batches):
        for b in batches:
            for r in b.to_pylist():
                for i, (v, label) in enumerate(zip(r["ids"], r["labels"])):
                    if v is not None and v % every == 0:
                        yield pa.RecordBatch.from_pylist([{"row": r["block"] << 12 | i, "id": v, "label": label,
                                                           "vec": r["vecs"][i * width:(i + 1) * width] if shape.dims else b""}], one)
    one = pa.schema([("row", pa.int64()), ("id", pa.int64()), ("label", pa.int64()), ("vec", pa.binary())])

    def pack(batches):
        part = TaskContext.get().partitionId() << 24
        for k, t in enumerate(_rows_in_lots(batches, BAND)):
            yield pa.RecordBatch.from_pylist([{
                "band": part | k, "rows": t["row"].to_pylist(), "ids": t["id"].to_pylist(), "labels": t["label"].to_pylist(),
                "vecs": b"".join(t["vec"].to_pylist())}], pa.schema(
                    [("band", pa.int64()), ("rows", pa.list_(pa.int64())), ("ids", pa.list_(pa.int64())),
                     ("labels", pa.list_(pa.int64())), ("vecs", pa.binary())]))
    anchors = materialize(table.select("block", "ids", "labels", "vecs").mapInArrow(
        pick, "row bigint, id bigint, label bigint, vec binary"), "anchors")
    lots = -(-anchors.count() // BAND)
    if lots:
        anchors = anchors.repartitionByRange(min(lots, shuffle_width(table.sparkSession)), "row").sortWithinPartitions("row")
    return materialize(anchors.mapInArrow(
        pack, "band bigint, rows array<bigint>, ids array<bigint>, labels array<bigint>, vecs binary"), "bands")


def _bounds(vecs: np.ndarray, zones: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of each vector with anything in each zone
    (blocks, 2, dims), widened by what floating point may lose."""
    up, down = np.maximum(vecs, 0.0), np.minimum(vecs, 0.0)
    low, high = zones[:, 0].T, zones[:, 1].T
    slack = 1e-9 * (np.abs(vecs) @ np.abs(zones).max(1).T)
    return up @ low + down @ high - slack, up @ high + down @ low + slack


class Band:
    """One band's anchors, their demands, and what a block must offer to matter.
    A demand is (least, most, side): the scores wanted, of the same label or of another."""

    def __init__(self, row: dict, shape: Shape):
        self.number, self.rows = row["band"], np.array(row["rows"], np.int64)
        self.labels = np.array(row["labels"], np.int64)
        self.vecs = shape.unpack(row["vecs"]) if shape.dims else np.zeros((len(self.rows), 0))
        place = {v: i for i, v in enumerate(self.rows.tolist())}
        state = [d for d in row["state"] or [] if d["row"] in place]
        self.owner = np.array([place[d["row"]] for d in state], np.int64)
        self.window = np.array([d["window"] for d in state], np.int64)
        self.least = np.array([d["least"] for d in state], np.int64)
        self.most = np.array([d["most"] for d in state], np.int64)


def _wanted(band: Band, zones: np.ndarray, label_lo: np.ndarray, label_hi: np.ndarray, same: bool):
    """(demands x blocks: may matter, demands x blocks: upper bound)."""
    low, high = _bounds(band.vecs.astype(np.float64), zones)
    mine = band.labels[:, None]
    fits = (label_lo <= mine) & (mine <= label_hi) if same else ~((label_lo == mine) & (label_hi == mine))
    high, low, fits = high[band.owner], low[band.owner], fits[band.owner]
    return fits & (high >= band.least[:, None]) & (low <= band.most[:, None]), high


def choose(table: DataFrame, states: DataFrame, shape: Shape, same: bool) -> DataFrame:
    """(band, block, votes, reach): the blocks that zones cannot rule out for a band,
    how many demands they serve, and the sum of their upper bounds."""
    spark = table.sparkSession
    zones = table.select("block", "label_lo", "label_hi", "zone")
    count = table.count()
    lots = max(1, -(-count // ZONES))
    part = F.pmod(F.xxhash64("block"), F.lit(lots)).cast("int")

    def look(key, left, right):
        out = []
        z = np.stack([np.frombuffer(v, shape.dtype).reshape(2, shape.dims) for v in right["zone"].to_pylist()]).astype(np.float64) \
            if right.num_rows else np.zeros((0, 2, shape.dims))
        ids, lo, hi = (right[c].to_numpy() for c in ("block", "label_lo", "label_hi"))
        for row in left.to_pylist() if len(ids) else []:
            band = Band(row, shape)
            want, high = _wanted(band, z, lo, hi, same)
            votes = want.sum(0)
            reach = np.where(want, high, 0.0).sum(0)
            at = np.flatnonzero(votes)
            out.append(pa.table({"band": pa.array(np.full(len(at), band.number)), "block": pa.array(ids[at]),
                                 "votes": pa.array(votes[at].astype(np.int64)), "reach": pa.array(reach[at])}))
        schema = pa.schema([("band", pa.int64()), ("block", pa.int64()), ("votes", pa.int64()), ("reach", pa.float64())])
        return pa.concat_tables(out) if out else schema.empty_table()
    # every band meets every lot of zones: (band, lot) keys bring them together in pieces of bounded size
    tiles = states.select("band", "rows", "ids", "labels", "vecs", "state",
                          F.explode(F.sequence(F.lit(0), F.lit(lots - 1))).alias("lot"))
    pairs = states.select("band", F.explode(F.sequence(F.lit(0), F.lit(lots - 1))).alias("lot"))
    there = zones.withColumn("lot", part).join(pairs, "lot").select("band", "lot", *zones.columns)
    there = there.toDF(*there.columns)  # both sides come from one table: columns of its own
    width = max(1, min(4 * shuffle_width(spark), lots * states.count()))  # no more tasks than tiles
    return tiles.repartition(width, "band", "lot").groupBy("band", "lot").cogroup(
        there.repartition(width, "band", "lot").groupBy("band", "lot")).applyInArrow(
            look, "band bigint, block bigint, votes bigint, reach double")


def _best(owner: np.ndarray, score: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """Places of the first ``most`` entries of each owner by score descending, then order."""
    turn = np.lexsort((order, -score, owner)) if score.dtype != object else np.array(
        sorted(range(len(score)), key=lambda i: (owner[i], -score[i], order[i])), np.int64)
    sorted_owner = owner[turn]
    nth = np.arange(len(turn)) - np.searchsorted(sorted_owner, sorted_owner)
    return turn[nth < most]


def read(table: DataFrame, states: DataFrame, demand: DataFrame, shape: Shape, same: bool, most: int) -> DataFrame:
    """(row, window, id, other, score): for each demand of the bands the first
    ``most`` rows of the demanded (band, block) pairs, tile by tile."""
    spark = table.sparkSession
    lots = max(1, -(-table.count() // TILE))
    demand = demand.select("band", "block").withColumn("lot", F.pmod(F.xxhash64("block", F.lit(1)), F.lit(lots)).cast("int"))
    schema = pa.schema([("row", pa.int64()), ("window", pa.int64()), ("id", pa.int64()), ("other", pa.int64()), ("score", pa.int64())])

    def meet(key, left, right):
        out = []
        if right.num_rows:
            vecs = shape.exact(np.concatenate([shape.unpack(v) for v in right["vecs"].to_pylist()]))
            ids = pa.concat_arrays([x.values for x in right["ids"]]).cast(pa.int64())
            labels = np.array([v for x in right["labels"].to_pylist() for v in x], np.int64)
            n = right["n"].to_numpy()
            place = np.arange(len(labels)) - np.repeat(np.cumsum(n) - n, n)
            rows = np.repeat(right["block"].to_numpy(), n) << 12 | place
            order = np.zeros(len(labels), np.int64)
            order[np.lexsort((rows, ids.fill_null(_LAST).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False)))] = np.arange(len(labels))
            if not shape.dims:
                vecs = np.zeros((len(labels), 0), shape.numbers)
        for row in left.to_pylist() if right.num_rows else []:
            band = Band(row, shape)
            scores = shape.exact(band.vecs) @ vecs.T
            fits = (labels[None, :] == band.labels[:, None]) & (rows[None, :] != band.rows[:, None]) if same \
                else labels[None, :] != band.labels[:, None]
            low = np.full(len(band.rows), np.iinfo(np.int64).max)
            high = np.full(len(band.rows), np.iinfo(np.int64).min)
            np.minimum.at(low, band.owner, band.least)
            np.maximum.at(high, band.owner, band.most)
            if scores.dtype == object:
                fits &= np.array(scores >= low[:, None].astype(object), bool) & np.array(scores <= high[:, None].astype(object), bool)
            else:
                fits &= (scores >= low[:, None]) & (scores <= high[:, None])
            who, what = np.nonzero(fits)
            found = scores[who, what]
            if found.dtype != object:
                found = found.astype(np.int64)
            for window in np.unique(band.window):
                of = band.window == window
                least, upto = np.full(len(band.rows), 1, np.int64), np.zeros(len(band.rows), np.int64)  # no such window: nothing
                least[band.owner[of]], upto[band.owner[of]] = band.least[of], band.most[of]
                inside = np.flatnonzero(np.array((found >= least[who]) & (found <= upto[who]), bool))
                best = inside[_best(who[inside], found[inside], order[what[inside]], most)]
                told = np.array([min(max(int(v), -_LAST - 1), _LAST) for v in found[best]], np.int64)
                out.append(pa.table([pa.array(band.rows[who[best]]), pa.array(np.full(len(best), window)),
                                     ids.take(pa.array(what[best])), pa.array(rows[what[best]]), pa.array(told)], schema=schema))
        return pa.concat_tables(out) if out else schema.empty_table()
    tiles = demand.select("band", "lot").distinct().join(states, "band")
    there = demand.join(table.select("block", "n", "ids", "labels", "vecs"), "block").select(
        "band", "lot", "block", "n", "ids", "labels", "vecs")
    there = there.toDF(*there.columns)
    width = max(1, min(4 * shuffle_width(spark), lots * states.count()))
    return tiles.repartition(width, "band", "lot").groupBy("band", "lot").cogroup(
        there.repartition(width, "band", "lot").groupBy("band", "lot")).applyInArrow(
            meet, "row bigint, window bigint, id bigint, other bigint, score bigint")


def first(found: DataFrame, most: int) -> DataFrame:
    """``found`` with its rank per (row, window), the first ``most`` only."""
    order = Window.partitionBy("row", "window").orderBy(F.desc("score"), F.col("id").asc_nulls_last(), "other")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def _with_state(band_table: DataFrame, owners: DataFrame, demands: DataFrame) -> DataFrame:
    """Each band with its demands (row, window, least, most); bounded by the band."""
    state = owners.join(demands, "row").groupBy("band").agg(
        F.collect_list(F.struct("row", "window", "least", "most")).alias("state"))
    return materialize(band_table.join(state, "band"), "states")


def search(table: DataFrame, band_table: DataFrame, demands: DataFrame, shape: Shape, same: bool, most: int) -> DataFrame:
    """The first ``most`` rows for each demand (row, window, least, most)."""
    owners = band_table.select("band", F.explode("rows").alias("row"))
    states = _with_state(band_table, owners, demands)
    order = Window.partitionBy("band").orderBy(F.desc("votes"), F.desc("reach"), "block")
    hopeful = materialize(choose(table, states, shape, same).withColumn("nth", F.row_number().over(order)).where(
        F.col("nth") <= PROBE).select("band", "block"), "hopeful")
    probed = materialize(read(table, states, hopeful, shape, same, most), "probed")
    best = first(probed, most)
    reached = best.where(F.col("rank") == most).select("row", "window", F.col("score").alias("reached"))
    tighter = demands.join(reached, ["row", "window"], "left").select(
        "row", "window", F.greatest("least", F.coalesce("reached", "least")).alias("least"), "most")
    states = _with_state(band_table, owners, tighter)
    rest = choose(table, states, shape, same).join(hopeful, ["band", "block"], "left_anti")
    return materialize(first(probed.unionByName(read(table, states, rest, shape, same, most)), most), "found")


def hard_negatives(vectors: DataFrame, every: int = 50, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   low_percent: int = 50, high_percent: int = 95) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)."""
    rows = usable(vectors)
    shape = shape_of(rows)
    table = blocks(rows, shape)
    band_table = bands(table, shape, every)
    anchors = band_table.select(F.explode(F.arrays_zip("rows", "ids")).alias("x")).select(
        F.col("x.rows").alias("row"), F.col("x.ids").alias("anchor_id"))
    all_scores = anchors.select("row", F.lit(0).cast("bigint").alias("window"), F.lit(-_LAST - 1).alias("least"), F.lit(_LAST).alias("most"))
    near = search(table, band_table, all_scores, shape, True, positives).select(
        "row", F.col("rank").cast("bigint").alias("window"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    p = F.col("positive_score").cast("decimal(30,0)")
    windows = near.withColumns({"least": F.ceil(p * low_percent / 100).cast("bigint"),
                                "most": F.floor(p * high_percent / 100).cast("bigint")}).where("least <= most")
    hard = search(table, band_table, windows.select("row", "window", "least", "most"), shape, False, negatives)
    return hard.select("row", "window", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score")).join(
        near, ["row", "window"]).join(anchors, "row").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
