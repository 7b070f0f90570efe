"""Version resolution as keyed streaming state.

The stream of multiplexed events is grouped by (folio key, category) and run by
``transformWithState``. The state of a key is the original's version cache in
pieces: a map from origin to (version, best score), and the greatest version. An
event reads and writes the one entry of its origin, so a key with a million
origins (every unreadable PDF) costs no more per event than a new one. The
registry enters once, as the stream's initial state, grouped by the same key;
later triggers read state alone.

Inside a micro-batch a key's events are put in order in memory, which the
micro-batch bounds (``maxFilesPerTrigger``); the batch form in
``operators/versions.py`` is the skew-safe plan for whole tables.

The state store must know keyed maps: ``stream_versions`` sets the RocksDB
provider for the session (part of Spark).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from .. import config as C
from ..session import ship_package

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

OUT_SCHEMA = T.StructType([
    T.StructField("folio_key", T.StringType()), T.StructField("cat", T.StringType()),
    T.StructField("origen", T.StringType()), T.StructField("lot_id", T.IntegerType()),
    T.StructField("seq", T.LongType()), T.StructField("cat_idx", T.IntegerType()),
    T.StructField("confianza", T.IntegerType()), T.StructField("version", T.IntegerType()),
    T.StructField("accion", T.StringType()),
])


def use_keyed_state(spark: SparkSession) -> None:
    """The state store that ``transformWithState`` needs, and the package for its workers."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    ship_package(spark)


class VersionCache(StatefulProcessor):
    """The version cache of one (folio key, category)."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.origins = handle.getMapState("origins", "origen string", "version int, best int")
        self.top = handle.getValueState("top", "version int")

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        lowest: dict[str, tuple[int, int]] = {}
        for origin, version, score in zip(initialState["origen"], initialState["version"], initialState["score"]):
            entry = (int(version), 0 if pd.isna(score) else int(score))
            if origin not in lowest or entry < lowest[origin]:  # two versions of an origin: the lowest counts
                lowest[origin] = entry
        for origin, entry in lowest.items():
            self.origins.updateValue((origin,), entry)
        self.top.update((int(initialState["version"].max()),))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        events = pd.concat(list(rows), ignore_index=True).sort_values(["lot_id", "seq", "cat_idx"])
        top = self.top.get()[0] if self.top.exists() else 0
        was, known, changed = top, {}, set()
        versions, actions = [], []
        for origin, conf in zip(events["origen"], events["confianza"]):
            conf = int(conf)
            if origin not in known:
                known[origin] = tuple(self.origins.getValue((origin,))) if self.origins.containsKey((origin,)) else None
            if known[origin] is None:
                top += 1
                known[origin] = (top, conf)
                changed.add(origin)
                actions.append(C.ACTION_NEW if top == 1 else C.ACTION_VERSION)
            elif conf >= known[origin][1]:
                known[origin] = (known[origin][0], conf)
                changed.add(origin)
                actions.append(C.ACTION_OVERWRITE)
            else:
                actions.append(C.ACTION_DISCARD)
            versions.append(known[origin][0])
        for origin in changed:
            self.origins.updateValue((origin,), known[origin])
        if top != was:
            self.top.update((top,))
        out = events[["folio_key", "cat", "origen", "lot_id", "seq", "cat_idx", "confianza"]].copy()
        out["version"], out["accion"] = versions, actions
        yield out

    def close(self) -> None:
        pass


def stream_versions(events: DataFrame, registry: DataFrame | None = None) -> DataFrame:
    """Streaming V1 over an events stream (folio_key, cat, origen, lot_id, seq, cat_idx,
    confianza); ``registry`` (folio_key, cat, origen, version, score) seeds the state
    when the stream first starts, and is not read again from a checkpoint."""
    use_keyed_state(events.sparkSession)
    seed = None
    if registry is not None:
        seed = registry.select("folio_key", "cat", "origen", F.col("version").cast("int").alias("version"),
                               F.col("score").cast("int").alias("score")).groupBy("folio_key", "cat")
    return events.groupBy("folio_key", "cat").transformWithStateInPandas(
        statefulProcessor=VersionCache(), outputStructType=OUT_SCHEMA, outputMode="Append", timeMode="None", initialState=seed)
