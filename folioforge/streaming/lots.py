"""T1 with K1 and K2: lots of a file stream, carried over its triggers.

A lane's open lot is keyed state: its number, its pages or files so far, the time
of its last file, and the files themselves. A file closes the open lot by the same
rules as the batch folds (``operators/packing.py``); what leaves a trigger are
whole lots only, so the commit of a trigger ends at a lot, and any cut of the
listing into triggers gives the lots of the whole listing.

Files must arrive in the order of the rule (by name for pages, by time and name
for bursts), which a file source by modification time gives; inside a trigger they
are put in order here. The last lot stays open until a file closes it. It is
closed by a row without ``file_name`` (the listing's end), or after
``idle_seconds`` without a new file.

State per lane is one lot (a burst, for images); a listing row is a few bytes. A
lane is one key, so a very hot lane's triggers are bounded by ``maxFilesPerTrigger``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from .versions_state import use_keyed_state

LOT_SCHEMA = T.StructType([
    T.StructField("lane", T.StringType()), T.StructField("lot_no", T.LongType()), T.StructField("place", T.LongType()),
    T.StructField("file_name", T.StringType()), T.StructField("n_pages", T.LongType()), T.StructField("t_us", T.LongType()),
])
NO_TIME = -(1 << 62)


class OpenLots(StatefulProcessor):
    """The open lot of one lane; ``by_pages``: K1 with ``limit`` pages, else K2 with
    ``limit`` files and gaps of ``gap_us``."""

    def __init__(self, by_pages: bool, limit: int, gap_us: int, idle_seconds: float | None):
        self.by_pages, self.limit, self.gap_us, self.idle_seconds = by_pages, limit, gap_us, idle_seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.lot = handle.getValueState("lot", "number long, size long, last_us long")
        self.files = handle.getListState("files", "file_name string, n_pages long, t_us long")

    def _closes(self, size: int, last: int, pages: int, t: int) -> bool:
        if self.by_pages:
            return size + pages > self.limit
        return size >= self.limit and (last == NO_TIME or t == NO_TIME or t - last >= self.gap_us)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows), ignore_index=True)
        order = [] if self.by_pages else ["t_us"]
        new = new.assign(ends=new["file_name"].isna()).sort_values(["ends", *order, "file_name"], kind="stable")
        number, size, last = self.lot.get() if self.lot.exists() else (0, 0, NO_TIME)
        held = [tuple(f) for f in self.files.get()] if self.files.exists() else []
        done = []
        for name, pages, t, ends in zip(new["file_name"], new["n_pages"], new["t_us"], new["ends"]):
            pages, t = (0 if pd.isna(pages) else int(pages)), (NO_TIME if pd.isna(t) else int(t))
            if held and (ends or self._closes(size, last, pages, t)):
                done.append((number, held))
                number, size, held = number + 1, 0, []
            if not ends:
                held.append((name, pages, t))
                size += pages if self.by_pages else 1
                last = t
        self.lot.update((number, size, last))
        if held:
            self.files.put(held)
        else:
            self.files.clear()
        if self.idle_seconds:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer if isinstance(timer, int) else timer[0])
            if held:
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + int(self.idle_seconds * 1000))
        yield self._rows(key, done)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        number, _, last = self.lot.get()
        held = [tuple(f) for f in self.files.get()] if self.files.exists() else []
        self.files.clear()
        self.lot.update((number + bool(held), 0, last))
        yield self._rows(key, [(number, held)] if held else [])

    def _rows(self, key, lots) -> pd.DataFrame:
        return pd.DataFrame([(key[0], number, place, name, pages, None if t == NO_TIME else t)
                             for number, files in lots for place, (name, pages, t) in enumerate(files)],
                            columns=LOT_SCHEMA.fieldNames()).astype({"n_pages": "Int64", "t_us": "Int64"})

    def close(self) -> None:
        pass


def _stream(files: DataFrame, lane: str | None, time_col: str | None, how: OpenLots) -> DataFrame:
    use_keyed_state(files.sparkSession)
    pages = F.col("n_pages").cast("long") if how.by_pages else F.lit(1).cast("long")
    rows = files.select((F.coalesce(F.col(lane).cast("string"), F.lit("")) if lane else F.lit("")).alias("lane"), "file_name",
                        pages.alias("n_pages"),
                        (F.unix_micros(F.col(time_col).cast("timestamp")) if time_col else F.lit(None).cast("long")).alias("t_us"))
    if how.by_pages:  # unreadable files are left out, as in the batch fold; the end row has no pages
        rows = rows.where(F.col("n_pages").isNotNull() | F.col("file_name").isNull())
    return rows.groupBy("lane").transformWithStateInPandas(
        statefulProcessor=how, outputStructType=LOT_SCHEMA, outputMode="Append",
        timeMode="ProcessingTime" if how.idle_seconds else "None")


def stream_page_lots(files: DataFrame, max_pages: int, lane: str | None = None, idle_seconds: float | None = None) -> DataFrame:
    """K1 over a stream of (file_name, n_pages[, lane]): rows of closed lots."""
    return _stream(files, lane, None, OpenLots(True, max_pages, 0, idle_seconds))


def stream_burst_lots(images: DataFrame, max_files: int, gap_seconds: float, lane: str | None = None, time_col: str = "mtime",
                      idle_seconds: float | None = None) -> DataFrame:
    """K2 over a stream of (file_name, mtime[, lane]): rows of closed lots. Images
    without a time come first in their trigger, with a gap between any two."""
    return _stream(images, lane, time_col, OpenLots(False, max_files, int(round(gap_seconds * 1_000_000)), idle_seconds))
