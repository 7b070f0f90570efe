"""Order-dependent packing: K1 next-fit by page mass, K2 burst-safe lots, K3 fixed batches.

K1 and K2 are sequential folds ("close the lot before this file when ...").
A lane (or the whole input) may hold a third of all rows, so neither is run
as one window over a lane. Instead, a two-pass scan:

1. ``repartitionByRange`` on (lane, order), sort inside partitions, and
   checkpoint (reliable, into ``spark.checkpoint.dir``) so both passes see
   identical partitions.
2. Pass 1 (``mapInPandas``): each partition reports, for the lane run it
   starts with, a transfer table *entry state -> (exit state, lots closed)*
   over every possible entry state (states merge after a few lots, then one
   path is followed), and for the lane run it ends with, the exit state from
   an empty lot. Output: a few hundred rows per partition.
3. These small tables are composed in partition order as an associative scan of
   tables: up, blocks of ``FAN`` neighbours become one transfer table each, until
   one block is left; down, each block's entry state gives its members' (``compose``).
   The driver sees the number of partitions only.
4. Pass 2 (``mapInPandas``): each partition replays its rows from its known
   entry state and lot offset and emits a lot number per row.

Both folds close a lot *before* a row, so their state is small: K1 is
{empty, 0..max pages, over max}; K2 is the count so far capped at max,
plus the gap to the previous row (for the first row of a partition, the gap
is taken from the previous partition's last row).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize, ship_package

LANE = "_lane"
GAP = "_gap_us"
FEAT = "_feat"
LOT = "lot_no"
ENTRY, OPEN, OFFSET = "_entry", "_open_gap", "_offset"
NO_TIME = -(1 << 62)


@dataclass(frozen=True)
class NextFit:
    """K1: close when the lot is non-empty and cur + n > max (max pages)."""

    max_pages: int

    @property
    def n_states(self) -> int:
        return self.max_pages + 3   # 0 empty, 1 + cur for cur in 0..max, max + 2 over

    def step(self, s: int, n: int, gap_ok: bool) -> tuple[int, bool]:
        m = self.max_pages
        if s == 0:
            cur, close = n, False
        else:
            cur = s - 1 if s <= m + 1 else m + 1  # "over" behaves as cur > max
            close = cur + n > m
            cur = n if close else cur + n
        return (cur + 1 if cur <= m else m + 2), close


@dataclass(frozen=True)
class BurstLots:
    """K2: close when the lot holds >= max files and the gap to this file >= threshold."""

    max_files: int

    @property
    def n_states(self) -> int:
        return self.max_files + 1   # files in the lot, capped at max

    def step(self, s: int, n: int, gap_ok: bool) -> tuple[int, bool]:
        close = s >= self.max_files and gap_ok
        s = 1 if close else min(s + 1, self.max_files)
        return s, close


PASS1_SCHEMA = T.StructType([
    T.StructField("pid", T.IntegerType()), T.StructField("run", T.StringType()),
    T.StructField("lane", T.StringType()), T.StructField("first_gap", T.LongType()),
    T.StructField("last_gap", T.LongType()), T.StructField("g0", T.BooleanType()),
    T.StructField("entry", T.IntegerType()), T.StructField("exit", T.IntegerType()),
    T.StructField("closed", T.LongType()),
])


def _runs(pdf: pd.DataFrame):
    """(start, end) index ranges of consecutive equal lanes."""
    lanes = pdf[LANE].to_numpy()
    if len(lanes) == 0:
        return []
    cut = np.flatnonzero(lanes[1:] != lanes[:-1]) + 1
    starts = np.concatenate([[0], cut])
    ends = np.concatenate([cut, [len(lanes)]])
    return list(zip(starts.tolist(), ends.tolist()))


def _wide(before, after, thr: int):
    """Whether the time from one file to the next is a gap; a missing time counts as one."""
    return (before == NO_TIME) | (after == NO_TIME) | (after - before >= thr)


def _gap_flags(gaps: np.ndarray, thr: int) -> np.ndarray:
    ok = np.zeros(len(gaps), dtype=bool)
    ok[1:] = _wide(gaps[:-1], gaps[1:], thr)
    return ok


def _fold(auto, feats, gap_ok, start_state: int, first_gap_ok: bool) -> tuple[int, int, list[int]]:
    s, closed, lots = start_state, 0, []
    for i in range(len(feats)):
        g = first_gap_ok if i == 0 else bool(gap_ok[i])
        s, c = auto.step(s, int(feats[i]), g)
        closed += c
        lots.append(closed)
    return s, closed, lots


def _transfer(auto, feats, gap_ok) -> dict[tuple[int, bool], tuple[int, int]]:
    """entry (state, first gap flag) -> (exit state, lots closed).

    Only *distinct* current states are stepped: entries whose paths met share
    one group (state, lots closed so far) and keep a fixed offset against it,
    so the cost per row is the number of distinct states, which falls to one
    after a few lots.
    """
    entries = [(s, g) for s in range(auto.n_states) for g in (True, False)]
    if len(feats) == 0:
        return {e: (e[0], 0) for e in entries}
    # first row: the gap flag of the entry applies
    groups: dict[int, list] = {}   # state -> [closed, [(entry, offset), ...]]
    for e in entries:
        s2, c = auto.step(e[0], int(feats[0]), e[1])
        _join(groups, s2, int(c), [(e, 0)])
    for i in range(1, len(feats)):
        if len(groups) == 1:
            break
        n, g = int(feats[i]), bool(gap_ok[i])
        nxt: dict[int, list] = {}
        for s, (closed, members) in groups.items():
            s2, c = auto.step(s, n, g)
            _join(nxt, s2, closed + int(c), members)
        groups = nxt
    else:
        i = len(feats)
    if i < len(feats):   # one path left: follow it
        (s0, (closed, members)), = groups.items()
        s_end, extra, _ = _fold(auto, feats[i:], gap_ok[i:], s0, bool(gap_ok[i]))
        groups = {s_end: [closed + extra, members]}
    return {e: (s, closed + off) for s, (closed, members) in groups.items() for e, off in members}


def _join(groups: dict, state: int, closed: int, members: list) -> None:
    """Add members (with offsets relative to ``closed``) to the group of ``state``."""
    if state not in groups:
        groups[state] = [closed, list(members)]
        return
    base = groups[state]
    shift = closed - base[0]
    base[1].extend((e, off + shift) for e, off in members)


def _pass1(auto, thr):
    from pyspark import TaskContext

    def run(batches):
        pid = TaskContext.get().partitionId()
        pdf = pd.concat(list(batches), ignore_index=True)   # lane, feature and time of the partition's files
        rows = []
        runs = _runs(pdf)
        for k, (a, b) in enumerate(runs):
            if 0 < k < len(runs) - 1:
                continue  # interior lane runs start and end here: nothing to compose
            part = pdf.iloc[a:b]
            feats = part[FEAT].to_numpy()
            gaps = part[GAP].to_numpy()
            gap_ok = _gap_flags(gaps, thr)
            lane = part[LANE].iloc[0]
            first_gap, last_gap = int(gaps[0]), int(gaps[-1])
            if k == 0:
                for (e, g), (x, c) in _transfer(auto, feats, gap_ok).items():
                    rows.append((pid, "first", lane, first_gap, last_gap, g, e, x, c))
            if k == len(runs) - 1 and (k > 0):
                x, c, _ = _fold(auto, feats, gap_ok, 0, False)
                rows.append((pid, "last", lane, first_gap, last_gap, False, 0, x, c))
        yield pd.DataFrame(rows, columns=PASS1_SCHEMA.fieldNames())
    return run


#: neighbours that one step of the scan composes
FAN = 64
_LINK = "pid long, entry int, exit int, closed long"
_ENTRY = "pid long, entry int, offset long"


def transfers(table: DataFrame, thr: int) -> DataFrame:
    """(pid, ..., entry, exit, closed): each partition as a function of the state in which
    the partition before it ends. The gap across the cut and whether the lane goes on
    are known from the neighbour's last row (one row a partition). A partition that
    does not go on with its neighbour's lane, or holds more lanes, ends in one state
    whatever the entry (and its lots are counted from its last lane's own start)."""
    ends = table.groupBy("pid").agg(
        F.max(F.when(F.col("run") == "first", F.col("lane"))).alias("first_lane"),
        F.max(F.when(F.col("run") == "last", F.struct("lane", "exit", "closed", "last_gap"))).alias("last"),
        F.max(F.when(F.col("run") == "first", F.col("first_gap"))).alias("first_gap"),
        F.max(F.when(F.col("run") == "first", F.col("last_gap"))).alias("own_last_gap"))
    ends = ends.withColumn("end_lane", F.coalesce("last.lane", "first_lane")).withColumn(
        "end_gap", F.coalesce("last.last_gap", "own_last_gap"))
    order = Window.orderBy("pid")  # one row a partition
    before_lane, before_gap = F.lag("end_lane").over(order), F.lag("end_gap").over(order)
    none = F.lit(NO_TIME)
    wide = (before_gap == none) | (F.col("first_gap") == none) | (F.col("first_gap") - before_gap >= thr)
    goes_on = F.coalesce(before_lane == F.col("first_lane"), F.lit(False))
    ends = ends.select("pid", "first_lane", "last", goes_on.alias("goes_on"), (goes_on & wide).alias("g0"))
    ends = ends.select("pid", "first_lane", "last", "goes_on", "g0", (~F.col("goes_on") | F.col("last").isNotNull()).alias("resets"))
    rows = table.where("run = 'first'").select("pid", "g0", "entry", "exit", "closed").join(ends, ["pid", "g0"])
    return rows.where("NOT resets OR entry = 0").select(
        F.col("pid").cast("long").alias("pid"), "first_lane", "goes_on", "g0", "resets", "entry",
        F.coalesce("last.exit", "exit").alias("exit"), F.coalesce("last.closed", "closed").alias("closed"))


def _fold_links(rows: pd.DataFrame) -> pd.DataFrame:
    """Links of neighbours (pid, entry, exit, closed, resets), composed in order."""
    state, closed, resets, entries = None, None, False, None
    for _, link in rows.groupby("pid", sort=True):
        step = {int(e): (int(x), int(c)) for e, x, c in zip(link["entry"], link["exit"], link["closed"])}
        reset = bool(link["resets"].iloc[0])
        if state is None:
            entries = sorted(step)
            state, closed, resets = {e: step[e][0] for e in entries}, {e: step[e][1] for e in entries}, reset
            continue
        for e in entries:
            x, c = step[state[e]] if not reset else next(iter(step.values()))
            state[e], closed[e] = x, (c if reset else closed[e] + c)
        resets = resets or reset
    return pd.DataFrame({"entry": entries, "exit": [state[e] for e in entries], "closed": [closed[e] for e in entries],
                         "resets": resets})


def compose(links: DataFrame, n: int) -> DataFrame:
    """(pid, entry, offset) of each of the ``n`` partitions from their links (pid,
    entry, exit, closed, resets): the state and the lots of the partitions before it. A
    link that ``resets`` has the same exit for any entry, and counts lots anew."""
    links = links.select("pid", "entry", "exit", "closed", "resets")
    if n <= FAN:
        return links.withColumn("_one", F.lit(0)).groupBy("_one").applyInPandas(
            lambda pdf: _entries(pdf.drop(columns="_one"), 0, 0), _ENTRY)

    def up(key, pdf):
        return _fold_links(pdf).assign(pid=key[0])[["pid", "entry", "exit", "closed", "resets"]]
    block = F.expr(f"pid div {FAN}")
    blocks = materialize(links.withColumn("block", block).groupBy("block").applyInPandas(up, f"{_LINK}, resets boolean"), "links")
    starts = compose(blocks, -(-n // FAN)).toDF("block", "start", "offset")

    def down(pdf):
        return _entries(pdf, int(pdf["start"].iloc[0]), int(pdf["offset"].iloc[0]))
    return links.withColumn("block", block).join(starts, "block").groupBy("block").applyInPandas(down, _ENTRY)


def _entries(rows: pd.DataFrame, state: int, closed: int) -> pd.DataFrame:
    """The entry state and offset of each of some neighbours, from those of the first."""
    out = []
    for pid, link in rows.groupby("pid", sort=True):
        reset = bool(link["resets"].iloc[0])
        out.append((int(pid), state, closed))
        hit = link.iloc[0] if reset else link[link["entry"] == state].iloc[0]
        state, closed = int(hit["exit"]), int(hit["closed"]) + (0 if reset else closed)
    return pd.DataFrame(out, columns=["pid", "entry", "offset"])


def _pass2(auto, thr):
    def run(batches):
        """Batch by batch; lane, state, lots closed and last time carry over. The first
        lane run begins with the state that the rows carry."""
        lane, state, closed, last, first_run = None, 0, 0, 0, True
        for pdf in batches:
            lots = np.zeros(len(pdf), dtype=np.int64)
            for a, b in _runs(pdf):
                part = pdf.iloc[a:b]
                gaps = part[GAP].to_numpy()
                if not first_run and part[LANE].iloc[0] == lane:
                    open_gap = bool(_wide(last, gaps[0], thr))
                else:
                    state, open_gap, closed = (int(part[ENTRY].iloc[0]), bool(part[OPEN].iloc[0]), int(part[OFFSET].iloc[0])) \
                        if first_run else (0, False, 0)
                    lane, first_run = part[LANE].iloc[0], False
                state, more, numbers = _fold(auto, part[FEAT].to_numpy(), _gap_flags(gaps, thr), state, open_gap)
                lots[a:b] = closed + np.asarray(numbers, dtype=np.int64)
                closed, last = closed + more, gaps[-1]
            yield pdf.assign(**{LOT: lots})
    return run


def ordered_fold(df: DataFrame, auto, lane_col: str | None, order_cols: list[str],
                 feat_col: str | None = None, gap_col: str | None = None, gap_threshold_us: int = 0,
                 num_partitions: int | None = None) -> DataFrame:
    """Run a close-before-row fold per lane, in order, across range partitions.

    Adds ``lot_no`` (0-based, per lane). ``feat_col`` feeds the fold (K1 page
    count; it must not be null); ``gap_col`` is an integer time in microseconds
    (K2; null: no time, a gap on both sides).
    """
    spark = df.sparkSession
    ship_package(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    lane = F.col(lane_col).cast("string") if lane_col else F.lit("")
    prepared = df.select("*", lane.alias(LANE),
                         (F.col(feat_col).cast("long") if feat_col else F.lit(0).cast("long")).alias(FEAT),
                         (F.coalesce(F.col(gap_col).cast("long"), F.lit(NO_TIME)) if gap_col
                          else F.lit(0).cast("long")).alias(GAP))
    keyed = (prepared.repartitionByRange(n, LANE, *order_cols)
             .sortWithinPartitions(LANE, *order_cols))
    keyed = keyed.checkpoint(eager=True)
    table = materialize(keyed.select(LANE, FEAT, GAP).mapInPandas(_pass1(auto, gap_threshold_us), PASS1_SCHEMA), "transfers")
    links = transfers(table, gap_threshold_us)
    if n > FAN:
        links = materialize(links, "links")
    entries = compose(links, n).join(links.select("pid", "goes_on", "g0").distinct(), "pid")
    fresh = ~F.col("goes_on")
    plan = entries.select(F.col("pid").alias("_pid"), F.when(fresh, 0).otherwise(F.col("entry")).alias(ENTRY), F.col("g0").alias(OPEN),
                          F.when(fresh, F.lit(0).cast("long")).otherwise(F.col("offset")).alias(OFFSET))
    # one row a partition is broadcast; the checkpointed partitions are the same in both passes
    placed = keyed.withColumn("_pid", F.spark_partition_id().cast("long")).join(F.broadcast(plan), "_pid").drop("_pid")
    out_schema = T.StructType(placed.schema.fields + [T.StructField(LOT, T.LongType())])
    return placed.mapInPandas(_pass2(auto, gap_threshold_us), out_schema).drop(LANE, FEAT, GAP, ENTRY, OPEN, OFFSET)


def pack_next_fit(files: DataFrame, max_pages: int, lane_col: str | None = None,
                  order_cols=("file_name",), pages_col: str = "n_pages") -> DataFrame:
    """K1: lots of files by page mass, in name order (per lane when given). A file
    whose page count is null is unreadable and left out (see ``unreadable_files``)."""
    return ordered_fold(files.filter(F.col(pages_col).isNotNull()), NextFit(max_pages), lane_col, list(order_cols), feat_col=pages_col)


def unreadable_files(files: DataFrame, pages_col: str = "n_pages", name_col: str = "file_name") -> DataFrame:
    """A reject row for each file that K1 leaves out."""
    return files.filter(F.col(pages_col).isNull()).select(
        F.lit("packing").alias("stage"), F.col(name_col).alias("key"), F.lit("unreadable_file").alias("reason"),
        F.lit("no page count").alias("detail"))


def pack_bursts(images: DataFrame, max_files: int, gap_seconds: float, lane_col: str | None = None,
                time_col: str = "mtime", name_col: str = "file_name") -> DataFrame:
    """K2: lots of >= max images closed only at a time gap >= gap_seconds, in (mtime, name)
    order; images without a time come first, by name, with a gap between any two."""
    df = images.withColumn("_t_us", F.unix_micros(F.col(time_col).cast("timestamp")))
    out = ordered_fold(df, BurstLots(max_files), lane_col, ["_t_us", name_col], gap_col="_t_us",
                       gap_threshold_us=int(round(gap_seconds * 1_000_000)))
    return out.drop("_t_us")


def pack_fixed(rows: DataFrame, lot_cols: list[str], order_cols: list[str], size: int) -> DataFrame:
    """K3: consecutive batches of ``size`` inside each lot (a lot is bounded)."""
    w = Window.partitionBy(*lot_cols).orderBy(*order_cols)
    return (rows.withColumn("pos", F.row_number().over(w))
            .withColumn("batch_no", F.floor((F.col("pos") - 1) / size).cast("int")))
