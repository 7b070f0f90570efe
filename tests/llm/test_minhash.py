import random

import pytest

from folioforge.llm import minhash


def brute(rows):
    """doc_id -> (set size, component) over rows (doc_id, text)."""
    sets = {}
    for d, t in rows:
        w = [x for x in (t or "").encode().lower().split()]
        s = {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
        if d is not None:
            sets.setdefault(d, []).append(s)
    ids = sorted(sets)
    root = {d: d for d in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if any(x and y and 100 * len(x & y) >= 75 * len(x | y) for x in sets[a] for y in sets[b]):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {d: (max(map(len, sets[d])), find(d)) for d in ids}


def compare(spark, rows):
    docs = spark.createDataFrame([(d, t, "clash") for d, t in rows], "doc_id bigint, text string, label string")
    got = minhash.near_duplicates(docs).collect()
    want = brute(rows)
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (*want[r.doc_id], want[r.doc_id][1] == r.doc_id), r


def test_edge_cases(spark):
    words = " ".join(f"w{i}" for i in range(60))
    compare(spark, [(5, words), (3, words.upper()), (9, words + " tail"), (1, None), (2, ""), (4, " \n\t "), (6, "a b"),
                    (7, "A  b"), (8, "a b c"), (None, words), (None, None), (10, words), (10, words), (11, "é É"), (12, "É é")])


def test_empty_table(spark):
    assert minhash.near_duplicates(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []


@pytest.mark.parametrize("seed, short", [(1, 16), (2, 1)])
def test_groups_against_brute_force(spark, monkeypatch, seed, short):
    monkeypatch.setattr(minhash, "SHORT", short)
    monkeypatch.setattr(minhash, "ASKED", 7)
    monkeypatch.setattr(minhash, "BASE", 11)
    rng = random.Random(seed)
    vocab = [f"v{i}" for i in range(3000)]
    passage = [rng.choice(vocab) for _ in range(40)]
    rows, d = [], 0
    for group in range(12):
        base = [rng.choice(vocab) for _ in range(rng.choice([8, 30, 80, 300]))]
        for _ in range(rng.choice([1, 3, 25])):
            w = list(base)
            for _ in range(rng.randrange(0, max(2, len(w) // 25))):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            if rng.random() < 0.4:
                w += passage
            rows.append((d * 7 % 1009, " ".join(w)))
            d += 1
    compare(spark, rows)


def test_sketches_of_short_sets_rule_out_no_partner(spark):
    """Beginnings of 50 to 100 shingles at similarity 0.75 to 0.8, where sketches hold values of 2^63 and more."""
    rng = random.Random(5)
    rows = []
    for k in range(6000):
        whole, part = [(80, 60), (88, 66), (76, 57), (83, 63), (100, 75), (64, 50)][k % 6]
        words = [f"{rng.getrandbits(40):x}" for _ in range(whole + 4)]
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(words[:part + 4]))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    classes = minhash.sketches(docs).withColumnRenamed("doc_id", "node")
    pairs = spark.createDataFrame([(2 * k, 2 * k + 1) for k in range(6000)], "a bigint, b bigint")
    assert minhash.promising(pairs, classes).count() == 6000


def test_query_whole_table(spark):
    from folioforge.llm.queries import QUERIES
    d = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(d + "/documents.parquet").collect()]
    want = brute(rows)
    got = QUERIES["op3_minhash"](spark, d).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want and len(got) == len(rows)
