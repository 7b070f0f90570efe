import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from folioforge.llm import mixing, toxicity
from folioforge.llm.queries import QUERIES

D = "/root/testdata/sf0.01"


def check_mix(rows, got, counts=lambda t: len((t or "").encode().split())):
    size, by = defaultdict(int), defaultdict(list)
    for d, t, s in rows:
        size[s] += counts(t)
    names = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + [None] * (None in size)
    weight = {s: (3.0, 1.0, 2.0)[k % 3] for k, s in enumerate(names)}
    target, free, left = {}, dict(weight), 1.5 * sum(size.values())
    while free:
        over = [s for s in free if left * free[s] / sum(free.values()) > 2 * size[s]]
        if not over:
            break
        for s in over:
            target[s] = 2.0 * size[s]
            del free[s]
        left = 1.5 * sum(size.values()) - sum(target.values())
    target |= {s: left * free[s] / sum(free.values()) for s in free}
    taken = Counter()
    assert len(got) == len(rows)
    for r, s in got:
        assert r.source_size == size[s] and r.target == pytest.approx(target[s], abs=1e-6)
        assert 0 <= r.taken <= 2 * r.size
        taken[s] += r.taken
    for s in size:
        assert abs(taken[s] - target[s]) <= 0.5 + 1e-6
    return taken


@pytest.mark.parametrize("block", [1, 7, 1024])
def test_small_mixes(spark, monkeypatch, block):
    monkeypatch.setattr(mixing, "BLOCK", block)
    rng = random.Random(block)
    rows = [(i, " ".join("w" * rng.randint(0, 50)), rng.choice(["a", "b", "é", "c", None, "hot", "hot", "hot"])) for i in range(80)]
    rows += [(None, "x y", "a"), (90, None, "empty"), (91, "", "empty"), (92, "one", "tiny"), (93, "p q r", "b"), (93, "p q r", "b")]
    docs = spark.createDataFrame([(d, t, s, "clash") for d, t, s in rows], "doc_id bigint, text string, source string, size string")
    got = mixing.mix(docs).collect()
    source = {}
    for d, t, s in rows:
        source[d] = s
    check_mix(rows, [(r, source[r.doc_id]) for r in got])
    again = mixing.mix(docs.repartition(5)).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))


def test_schedule_is_well_spread(spark):
    """A source's share of the first slots is near its share of all of them."""
    rows = [(i, "w " * 500, f"s{i % 5}") for i in range(200)]
    sizes = mixing.sized(spark.createDataFrame(rows, "doc_id bigint, text string, source string"))
    slots = [(r.slot, r.src) for r in mixing.schedule(mixing.targets(sizes)).collect()]
    assert len(slots) == len({s for s, _ in slots})
    slots.sort()
    share = Counter(src for _, src in slots)
    for n in (20, 50, 100):
        part = Counter(src for _, src in slots[:n])
        assert all(abs(part[s] / n - share[s] / len(slots)) < 0.1 for s in share)


def test_mix_comes_in_slot_order(spark):
    """Beginnings of the written mix hold each source near its share; first slots agree with its order."""
    rows = [(1000 * k + i, "w " * 900 + f"d{1000 * k + i}", f"s{k}") for k in range(3) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(6)
    path = mixing.materialize(mixing.take_text(docs), "mix-order")
    order = [(r.doc_id, r.source) for r in mixing.take_text(docs).collect()]
    share = Counter(s for _, s in order)
    for n in (30, 60, 120, 240):
        part = Counter(s for _, s in order[:n])
        assert all(abs(part[s] / n - share[s] / len(order)) < 0.1 for s in share), (n, part)
    assert Counter((r.doc_id, r.source) for r in path.collect()) == Counter(order)
    slots = {r.doc_id: (r.slot_0, r.slot_1) for r in mixing.mix(docs).collect()}
    assert sum(x is not None for v in slots.values() for x in v) == len(order)
    seen, last = Counter(), -1
    for d, _ in order:
        slot = slots[d][seen[d]]
        assert slot >= last
        last, seen[d] = slot, seen[d] + 1


def test_empty_mix(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string, source string")
    assert mixing.mix(docs).collect() == [] and mixing.take_text(docs).collect() == []
    docs = spark.createDataFrame([(1, None, None), (2, "", "a")], "doc_id bigint, text string, source string")
    assert [r.taken for r in mixing.mix(docs).collect()] == [0, 0]


def test_mix_query_whole_table(spark):
    rows = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(D + "/documents.parquet").collect()]
    source = {d: s for d, _, s in rows}
    check_mix(rows, [(r, source[r.doc_id]) for r in QUERIES["op6_mixing"](spark, D).collect()])


def test_features_against_brute_force():
    texts = ["You IDIOT, you!", "", "a b", "é-É x.y\nz z"]
    from folioforge.llm.words import text_bytes
    import pyarrow as pa
    data, offsets = text_bytes(pa.array(texts))
    places, owner = toxicity.features(data, offsets)
    alone = [toxicity.features(*text_bytes(pa.array([t])))[0] for t in texts]
    for i, t in enumerate(texts):
        assert sorted(places[owner == i]) == sorted(alone[i])
    n = [4 - 1, 0, 2, 6]
    assert [len(x) for x in alone] == [k + max(k - 1, 0) + max(k - 2, 0) for k in n]


def test_beginnings_of_words_against_brute_force():
    import pyarrow as pa
    from folioforge.llm.words import PUNCT_BYTES, text_bytes, word_hashes
    texts = ["Ordinary ordinarily ORDIN", "", "x", "é" * 9 + " abcdefgh.abcdefghi", "a" * 3000]
    told = lambda t, cut=None: word_hashes(*text_bytes(pa.array([t])), PUNCT_BYTES, cut)[0].tolist()
    for cut in (1, 6, 8):
        data, offsets = text_bytes(pa.array(texts))
        got, first = word_hashes(data, offsets, PUNCT_BYTES, cut)
        for i, t in enumerate(texts):
            words = t.lower().replace(".", " ").encode().split()
            alone = [word_hashes(np.frombuffer(w[:cut], np.uint8), np.array([0, len(w[:cut])]), PUNCT_BYTES)[0][0] for w in words]
            assert got[first[i]:first[i + 1]].tolist() == alone
    assert told("ordinarily", 6) == told("ORDINAry", 6) == told("ordina") != told("ordinarily")
    data, offsets = text_bytes(pa.array(texts))
    places, owner = toxicity.all_features(data, offsets)
    for i, t in enumerate(texts):
        alone, _ = toxicity.all_features(*text_bytes(pa.array([t])))
        assert sorted(places[owner == i]) == sorted(alone)


def test_ftrl_against_a_loop_over_coordinates():
    """The published per-coordinate update, written out with dictionaries."""
    from math import exp, sqrt
    rng = random.Random(4)
    examples = [sorted({rng.randrange(40) for _ in range(rng.randint(0, 12))}) for _ in range(200)]
    labels = [float(rng.random() < (0.9 if 7 in x else 0.1)) for x in examples]
    docs = Counter(f for x in examples for f in x)
    z, n = defaultdict(float), defaultdict(float)

    def weight(f):
        if f == "bias":
            return -z[f] / ((toxicity.BETA + sqrt(n[f])) / toxicity.ALPHA)
        if abs(z[f]) <= toxicity.L1:
            return 0.0
        sign = 1 if z[f] > 0 else -1
        return (sign * toxicity.L1 - z[f]) / ((toxicity.BETA + sqrt(n[f])) / toxicity.ALPHA + toxicity.L2)

    for _ in range(4):
        for x, y in zip(examples, labels):
            on = [f for f in x if docs[f] >= toxicity.MIN_DOCS] + ["bias"]
            w = {f: weight(f) for f in on}
            g = 1 / (1 + exp(-sum(w.values()))) - y
            for f in on:
                rate = (sqrt(n[f] + g * g) - sqrt(n[f])) / toxicity.ALPHA
                z[f] += g - rate * w[f]
                n[f] += g * g
    got, bias = toxicity.ftrl([np.array(x, np.int32) for x in examples], np.array(labels), 4)
    assert got[:40] == pytest.approx([weight(f) for f in range(40)], abs=1e-9) and bias == pytest.approx(weight("bias"), abs=1e-9)
    assert got[7] != 0 and not got[40:].any()


def test_ftrl_learns_a_word_and_is_sparse():
    rng = np.random.default_rng(1)
    examples, labels = [], []
    for k in range(600):
        x = set(rng.integers(0, 3000, 40).tolist())
        y = float(rng.random() < 0.2)
        examples.append(np.array(sorted(x | ({77777} if y else set())), np.int32))
        labels.append(y)
    weights, bias = toxicity.ftrl(examples, np.array(labels))
    assert weights[77777] > 2 and bias < 0 and (weights != 0).sum() < 300


def test_scores_of_held_out_documents(spark):
    d = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(d + "/labels.parquet").collect()}
    rows = QUERIES["op9_toxicity"](spark, d).collect()
    assert len(rows) == 10000
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert all(r.held_out for r in held) and sum(r.held_out for r in rows) == len(held)
    told = [(r.predicted, labels[r.doc_id]) for r in held if r.doc_id in labels]
    assert sum(p == y for p, y in told) >= 0.95 * len(told)
    assert sum(p for p, y in told if y) >= 0.9 * sum(y for _, y in told)
    assert sum(p for p, y in told if not y) <= 0.01 * len(told)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)


def test_repeated_documents_train_once(spark):
    rng = random.Random(8)
    word = lambda: f"w{rng.randrange(60)}"
    rows = [(i, " ".join([word() for _ in range(20)] + ["vile"] * (i % 5 == 0))) for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(400)], "doc_id bigint, toxic int")
    first = next(i for i in range(400) if i % 5 == 0 and zlib.crc32(str(i).encode()) % 4 != 2)
    other = [(first, f"vile {word()} {word()} other {k}") for k in range(300)]
    frame = lambda x: spark.createDataFrame(x, "doc_id bigint, text string")
    plain = toxicity.train(frame(rows), labels)
    assert (plain != 0).sum() > 5
    assert np.array_equal(plain, toxicity.train(frame(rows + [rows[first]] * 300), labels))
    one = [r for r in rows + other if r[0] != first]
    from pyspark.sql import functions as F
    least = frame([rows[first]] + other).orderBy(F.xxhash64("text")).first()
    assert np.array_equal(toxicity.train(frame(rows + other), labels), toxicity.train(frame(one + [tuple(least)]), labels))


def test_toxicity_edges(spark):
    rows = [(1, None, 5.0), (1, None, 5.0), (None, "you idiot", 1.0), (2, "", None), (3, "x " * 50000, 0.0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, score double")
    labels = spark.createDataFrame([(1, 0, 1), (1, None, 1), (None, 1, 1), (2, 1, 0)], "doc_id bigint, toxic int, quality int")
    for own in (labels, labels.limit(0)):
        got = toxicity.toxicity(docs, own).collect()
        assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
    assert max(r.score for r in got) < 1e-9 and not any(r.predicted for r in got)
    assert toxicity.toxicity(docs.limit(0), labels).collect() == []
