import math
import random

import numpy as np
import pytest

from folioforge.llm import hard_negatives as hn
from folioforge.llm.hilbert import curve_keys

SCHEMA = "vec_id bigint, embedding array<double>, label int, rank string, block int"


def brute(rows):
    used = []
    for v, e, label, *_ in rows:
        if label is None or e is None or any(x is None or not math.isfinite(x) for x in e):
            continue
        if v is not None and v % 7 == 0:
            label = int(math.fmod(label + 1, 10))
        used.append((v, [math.floor(256 * x) for x in e], label))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    order = lambda t: (-t[0], t[1] is None, t[1] or 0)
    out = []
    for i, (a, e, label) in enumerate(used):
        if a is None or a % 50:
            continue
        score = [(dot(e, f), v, m) for j, (v, f, m) in enumerate(used) if j != i]
        for p, v, _ in sorted((t for t in score if t[2] == label), key=order)[:5]:
            hard = sorted((t for t in score if t[2] != label and 50 * p <= 100 * t[0] <= 95 * p), key=order)[:3]
            out += [(a, v, k, w, p, s) for k, (s, w, _) in enumerate(hard, 1)]
    return sorted(out, key=str)


def check(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    got = sorted(map(tuple, hn.hard_negatives(df).collect()), key=str)
    assert got == brute(rows)
    return got


def vector(rng, dims, at=None):
    return [rng.gauss(0, 0.2) + (at[k] if at else 0) for k in range(dims)]


@pytest.fixture()
def small(monkeypatch):
    for name, value in {"BLOCK": 8, "BAND": 3, "TILE": 2, "PROBE": 2, "ZONES": 3}.items():
        monkeypatch.setattr(hn, name, value)


def test_clusters_ties_and_odd_rows(spark, small):
    rng = random.Random(5)
    centres = [vector(rng, 6, [rng.uniform(-1, 1)] * 6) for _ in range(5)]
    rows = [(i, vector(rng, 6, rng.choice(centres)), rng.randrange(4)) for i in range(240)]
    same = vector(rng, 6, centres[0])
    rows += [(1000 + i, same, i % 3) for i in range(40)]  # equal vectors: ties by vec_id
    rows += [(50, vector(rng, 6), 1), (50, same, 1), (None, same, 0), (None, same, 1), (2000, None, 1), (2050, same, None)]
    rows += [(2100, [float("nan")] * 6, 1), (2150, [float("inf")] + [0.0] * 5, 1), (2200, [None] + [0.1] * 5, 1)]
    rows += [(2250, [0.5, 0.5], 2), (2300, [], 2), (-50, same, 3), (2350, [0.3] * 6, -3)]
    assert len(check(spark, rows)) > 50


def test_components_beyond_floating_point(spark, small):
    rng = random.Random(6)
    rows = [(i, [rng.uniform(0, 1e6), rng.uniform(0, 1e6), rng.uniform(-1e3, 1e3)], i % 2) for i in range(60)]
    check(spark, rows)
    wide = [(i, [rng.uniform(0, 5e6) for _ in range(3)], i % 2) for i in range(60)]
    check(spark, wide)  # products above 2^53
    far = hn.Shape(np.zeros(2), np.full(2, 2.0 ** 40), np.ones(2))
    assert far.numbers is object and (far.exact(np.array([[2.0 ** 40, 1.0]])) @ np.array([2 ** 40, 1], object))[0] == 2 ** 80 + 1


def test_no_anchor_and_no_rows(spark, small):
    df = spark.createDataFrame([(1, [1.0], 1, "", 1), (2, [1.0], 2, "", 1)], SCHEMA)
    assert hn.hard_negatives(df).collect() == []
    assert hn.hard_negatives(df.limit(0)).collect() == []


def test_zones_leave_out_far_blocks(spark, small):
    rng = random.Random(8)
    rows = []
    for i in range(400):
        c = i % 8
        rows.append((i, [rng.gauss(1 if k == c else 0, 0.02) for k in range(8)], rng.randrange(2), "", 0))
    used = hn.usable(spark.createDataFrame(rows, SCHEMA))
    shape = hn.shape_of(used)
    table = hn.blocks(used, shape)
    bands = hn.bands(table, shape, 50)
    anchors = bands.selectExpr("explode(rows) AS row").selectExpr("row", "0L AS window", "40000L AS least", "9000000L AS most")
    states = hn._with_state(bands, bands.selectExpr("band", "explode(rows) AS row"), anchors)
    chosen = hn.choose(table, states, shape, True).count()
    assert 0 < chosen < 0.5 * table.count() * bands.count()


def test_curve_visits_neighbours():
    for dims, bits in ((2, 4), (3, 3), (5, 2)):
        cells = np.array(np.meshgrid(*[range(1 << bits)] * dims, indexing="ij")).reshape(dims, -1).T
        keys = [bytes(k) for k in curve_keys(cells, bits)]
        assert len(set(keys)) == len(cells)
        walk = cells[sorted(range(len(cells)), key=lambda i: keys[i])]
        assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()
