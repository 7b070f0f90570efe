import hashlib
import random
from collections import Counter

import pytest

from folioforge.llm import suffix_dedup as sd


def brute(texts):
    """(n_bytes, n_removed, n_spans, kept) of each text."""
    seen = Counter(t[i:i + 400] for t in texts for i in range(len(t) - 399))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - 399):
            if seen[t[i:i + 400]] > 1:
                gone[i:i + 400] = b"\x01" * 400
        kept = bytes(x for x, g in zip(t, gone) if not g)
        out.append((len(t), len(t) - len(kept), sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone)), kept))
    return out


def sample(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    shared = [text(n) for n in (60, 90, 150, 400)]
    texts = [None, "", "x", "a" * 399, "b" * 400, "c" * 401, "c" * 1200, "ab" * 900, "ab" * 300]
    exact = (text(55) * 20).encode()[:400].decode("utf-8", "ignore")
    texts += [text(5) + exact + text(9), text(50) + exact, exact + "z"]
    for _ in range(25):
        parts = [text(rng.randint(0, 120))]
        for _ in range(rng.randint(0, 3)):
            s = rng.choice(shared)
            a = rng.randint(0, len(s) // 3)
            parts += [s[a:] if rng.random() < 0.6 else s, text(rng.randint(0, 60))]
        texts.append("".join(parts))
    near = shared[3].split(" ")
    for _ in range(6):
        w = list(near)
        w[rng.randrange(len(w))] = "zz"
        texts.append(" ".join(w))
    return texts + texts[12:16]


def check(spark, texts, ids=None, hot=sd.HOT):
    ids = ids or list(range(len(texts)))
    docs = spark.createDataFrame([(d, t, 7) for d, t in zip(ids, texts)], "doc_id bigint, text string, start int")
    got = [(r.doc_id if r.doc_id is not None else -1, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept))
           for r in sd.suffix_dedup(docs, hot).collect()]
    want = [(d if d is not None else -1, *w) for d, w in zip(ids, brute([(t or "").encode() for t in texts]))]
    assert sorted(got) == sorted(want)


@pytest.mark.parametrize("hot", [sd.HOT, 1])
def test_against_brute_force(spark, hot, monkeypatch):
    monkeypatch.setattr(sd, "SHARD", 4000)
    texts = sample(hot)
    ids = list(range(len(texts)))
    ids[15] = ids[20] = None
    ids[30] = 31
    check(spark, texts, ids, hot)


def test_repeated_rows_and_empty_table(spark):
    long = sample(9)[14] * 3
    check(spark, [long, long, None], [4, 4, None])
    check(spark, [long[:900], "x" + long[:900]], [1, 2])
    assert sd.suffix_dedup(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []


def test_pieces_of_a_long_text(monkeypatch):
    import numpy as np
    data = np.frombuffer(("".join(random.Random(4).choice("abcd ") for _ in range(9000)) * 2).encode(), np.uint8)
    offsets = np.array([0, len(data)])

    def strings():
        return {(int(s - e[t] + p + k), int(f)) for _, part, e, p in sd._pieces(data, offsets)
                for t, s, n, _, f, _ in zip(*sd.runs(part, e)) for k in range(n)}
    whole = strings()
    monkeypatch.setattr(sd, "PIECE", 5000)
    assert strings() == whole and len(whole) == len(data) - 399


def test_query_whole_table(spark):
    from folioforge.llm.queries import QUERIES
    d = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(d + "/documents.parquet").collect()]
    want = {i: (n, gone, k, hashlib.sha256(kept).hexdigest())
            for (i, _), (n, gone, k, kept) in zip(rows, brute([t.encode() for _, t in rows]))}
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in QUERIES["op5_suffix_array"](spark, d).collect()}
    assert got == want
