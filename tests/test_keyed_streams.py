"""Keyed streaming state: versions (T3) over restarts, lots (T1, K1, K2) over random cuts."""

import datetime as dt
import os
import random

import pytest

from folioforge.operators.packing import pack_bursts, pack_next_fit
from folioforge.operators.versions import resolve_versions
from folioforge.streaming import lots as L
from folioforge.streaming.versions_state import stream_versions

EVENT = "folio_key string, cat string, origen string, lot_id int, seq long, cat_idx int, confianza int"


def feed(spark, rows, schema, folder, first=0):
    """One file for each list of rows, read one to a trigger, in order."""
    os.makedirs(folder, exist_ok=True)
    for k, some in enumerate(rows, first):
        aside = f"{folder}-aside/{k}"
        spark.createDataFrame(some, schema).coalesce(1).write.parquet(aside)
        part = next(f for f in os.listdir(aside) if f.endswith(".parquet"))
        to = f"{folder}/{k:04d}.parquet"
        os.link(f"{aside}/{part}", to)
        os.utime(to, (1_700_000_000 + k, 1_700_000_000 + k))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def drain(df, out, checkpoint):
    q = df.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination(300)
    return df.sparkSession.read.schema(df.schema).parquet(out)


def test_versions_over_a_restart_equal_the_batch(spark, tmpdir_):
    rng = random.Random(4)
    rows, seq = [], 0
    for lot in range(6):
        for _ in range(30):
            seq += 1
            key = rng.choice(["A1", "ERR", "ERR", "B"])
            rows.append((key, "Factura", f"o{rng.randrange(60 if key == 'ERR' else 4)}", lot, seq, 0, rng.randint(0, 100)))
    registry = spark.createDataFrame(
        [("A1", "Factura", "o2", 1, 60), ("A1", "Factura", "o4", 2, None), ("A1", "Factura", "o1", 5, 70), ("A1", "Factura", "o1", 3, 20),
         ("unseen", "Factura", "o1", 9, 9)], "folio_key string, cat string, origen string, version int, score int")
    lots = [[r for r in rows if r[3] == k] for k in range(6)]
    src = feed(spark, lots[:3], EVENT, f"{tmpdir_}/ev")
    drain(stream_versions(src, registry), f"{tmpdir_}/out", f"{tmpdir_}/ckpt")
    feed(spark, lots[3:], EVENT, f"{tmpdir_}/ev", 3)
    # a new query on the same checkpoint: state, not the registry, tells what is known
    got = drain(stream_versions(src, registry), f"{tmpdir_}/out", f"{tmpdir_}/ckpt")
    want = resolve_versions(spark.createDataFrame(rows, EVENT), registry, materialize_events=False)
    key = lambda df: sorted((r.seq, r.version, r.accion) for r in df.collect())
    assert key(got) == key(want)


def test_an_event_touches_its_own_entry_only():
    import pandas as pd

    from folioforge.streaming.versions_state import VersionCache

    class Map(dict):
        reads = 0

        def containsKey(self, k):
            Map.reads += 1
            return k in self

        def getValue(self, k):
            return self[k]

        def updateValue(self, k, v):
            self[k] = v

    class Value:
        v = None

        def exists(self):
            return self.v is not None

        def get(self):
            return self.v

        def update(self, v):
            self.v = v

    cache = VersionCache()
    cache.origins, cache.top = Map({(f"o{i}",): (i + 1, 50) for i in range(100_000)}), Value()
    cache.top.update((100_000,))
    events = pd.DataFrame([("k", "c", o, 0, i, 0, 60) for i, o in enumerate(["o7", "new", "o7"])],
                          columns=["folio_key", "cat", "origen", "lot_id", "seq", "cat_idx", "confianza"])
    out = next(cache.handleInputRows(("k", "c"), iter([events]), None))
    assert list(out["version"]) == [8, 100_001, 8] and Map.reads == 2 and cache.top.get() == (100_001,)


def cut(rng, rows):
    at = sorted(rng.sample(range(len(rows) + 1), 4))
    return [rows[a:b] for a, b in zip([0, *at], [*at, len(rows)])]


def lots_by_file(rows):
    return {(r.lane, r.file_name): r.lot_no for r in rows}


@pytest.mark.parametrize("seed", [1, 2])
def test_page_lots_over_random_cuts(spark, tmpdir_, seed):
    rng = random.Random(seed)
    schema = "lane string, file_name string, n_pages int"
    rows = [(rng.choice("xy"), f"f{i:04d}", rng.choice([0, 0, 1, 3, 9, 10, 11, 25, None])) for i in range(150)]
    end = [[("x", None, None), ("y", None, None)]]
    stream = L.stream_page_lots(feed(spark, [c for c in cut(rng, rows) if c] + end, schema, f"{tmpdir_}/f"), 10, "lane")
    got = drain(stream, f"{tmpdir_}/out", f"{tmpdir_}/c").collect()
    want = pack_next_fit(spark.createDataFrame(rows, schema), 10, "lane").collect()
    assert lots_by_file(got) == lots_by_file(want) and len(got) == len(want)


def test_burst_lots_over_random_cuts_and_no_half_lot_leaves(spark, tmpdir_):
    rng = random.Random(3)
    schema = "lane string, file_name string, mtime timestamp"
    t, rows = dt.datetime(2026, 1, 1), []
    for i in range(160):
        t += dt.timedelta(microseconds=rng.choice([0, 1_000_000, 2_999_999, 3_000_000, 9_000_000]))
        rows.append((rng.choice("xy"), f"f{i:04d}", t))
    parts = [c for c in cut(rng, rows) if c]
    src = feed(spark, parts, schema, f"{tmpdir_}/f")
    stream = L.stream_burst_lots(src, 4, 3.0, "lane")
    some = drain(stream, f"{tmpdir_}/out", f"{tmpdir_}/c").collect()
    want = lots_by_file(pack_bursts(spark.createDataFrame(rows, schema), 4, 3.0, "lane").collect())
    last = {lane: max(n for (of, _), n in want.items() if of == lane) for lane in "xy"}
    assert lots_by_file(some) == {k: n for k, n in want.items() if n < last[k[0]]}  # the last lots are open still
    feed(spark, [[("x", None, None), ("y", None, None)]], schema, f"{tmpdir_}/f", len(parts))
    assert lots_by_file(drain(stream, f"{tmpdir_}/out", f"{tmpdir_}/c").collect()) == want


def test_files_to_stored_results_by_lots(spark, tmpdir_):
    from folioforge.config import AuditOptions
    from folioforge.operators import registry as R
    from folioforge.plans.batch_run import AuditPaths
    from folioforge.streaming.stream import lots_stream, run_file_stream
    schema = "file_name string, mtime timestamp, kind string, n_pages long"
    when = dt.datetime(2026, 1, 1)
    pdfs = [(f"{c}.pdf", when, "pdf", 3) for c in "abcd"]
    images = [(f"i{k}.jpg", when + dt.timedelta(seconds=10 * k), "image", None) for k in range(3)]
    end = [(None, None, "pdf", None), (None, None, "image", None)]
    src = feed(spark, [pdfs[:2], pdfs[2:] + images, end], schema, f"{tmpdir_}/f")
    options = AuditOptions(pdf_chunk_max_pages=10, physical_chunk_size=2)
    pages = [(f, p, f"FACTURA Folio: {f[0].upper()}{p} Cliente: Z total") for f, _, _, n in pdfs for p in range(1, n + 1)]
    pages += [(f, 1, f"FACTURA Folio: IM{f[1]} total") for f, *_ in images]
    texts = spark.createDataFrame(pages, "file_name string, page_no int, text string")
    paths = AuditPaths(f"{tmpdir_}/out")
    q = run_file_stream(spark, lots_stream(src, options), lambda names: texts.join(names, "file_name"), paths, f"{tmpdir_}/ck",
                        options=options, batch_ts_fn=lambda b: "2026-01-01 00:00:00")
    q.awaitTermination(400)
    done = sorted((r.file_name, r.batch) for r in spark.read.parquet(paths.processed).collect())
    assert sorted(f for f, _ in done) == sorted([f for f, *_ in pdfs] + [f for f, *_ in images])  # each once
    lots = [{f for f, b in done if b == n} for n in sorted({b for _, b in done})]
    assert lots == [{"a.pdf", "b.pdf", "c.pdf", "i0.jpg", "i1.jpg"}, {"d.pdf", "i2.jpg"}]
    assert R.current(spark, paths.registry) is not None
