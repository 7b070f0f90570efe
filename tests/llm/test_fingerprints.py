import hashlib
import math

import numpy as np
import pytest

from folioforge.llm import fingerprints as fp


def brute_ranks(data):
    out = []
    for i in range(len(data) - fp.WIDTH + 1):
        w = data[i:i + fp.WIDTH]
        e = -sum(w.count(b) / 64 * math.log2(w.count(b) / 64) for b in set(w))
        out.append(None if e < fp.LEAST - 1e-6 else e)
    return out


def test_entropies_against_brute_force():
    rng = np.random.default_rng(1)
    data = bytes(rng.integers(97, 110, 300, np.uint8)) + b"a" * 100 + bytes(rng.integers(0, 255, 300, dtype=np.uint8))
    got = fp._ranks(np.frombuffer(data, np.uint8))
    for g, e in zip(got, brute_ranks(data)):
        if e is None:
            assert g == fp._LAST
        else:
            assert abs(float(g) / 100000 - (8 - abs(e - fp.USUAL))) < 1e-4


def test_same_alone_or_in_a_batch():
    rng = np.random.default_rng(2)
    texts = [bytes(rng.integers(97, 123, n, np.uint8)) for n in (0, 5, 63, 64, 65, 126, 127, 128, 700, 40000)]
    together = fp.fingerprints(texts)
    for t, f in zip(texts, together):
        assert np.array_equal(fp.fingerprints([t])[0], f)
    assert len(together[0]) == 0 and len(together[-1]) > 1
    assert fp.likeness(together[-1], together[-1]) == 1.0 and fp.likeness(together[-1], together[-2]) < 0.1
    assert fp.likeness(together[0], together[0]) == 1.0 and fp.likeness(together[0], together[-1]) == 0.0


def test_every_text_has_a_feature():
    rng = np.random.default_rng(3)
    texts = [bytes(rng.choice(list(b"etaoin shrdlu"), n).astype(np.uint8)) for n in range(120, 260)]
    texts += [b"0123456789abcdef" * 60, b"fedcba98765432" * 60, b"a" * 500, b"b" * 500, b"c" * 300 + b"d" * 300,
              bytes(rng.choice(list(b"ab"), 5000).astype(np.uint8)), b"xy" * 5000, "日本".encode() * 50]
    prints = fp.fingerprints(texts)
    for t, f in zip(texts, prints):
        assert len(f) and f.any() and np.array_equal(fp.fingerprints([t])[0], f)
    for a, b in zip(prints, prints[1:]):
        assert fp.likeness(a, b) < 1
    assert len(prints[-3]) == 1 and np.unpackbits(prints[-3]).sum() > 300  # two letters: features all along the text


def test_short_neighbours_are_unlike(spark):
    rng = np.random.default_rng(4)
    rows = [(k, bytes(rng.choice(list(b"etaoin shrdlu"), 127 + k).astype(np.uint8)).decode()) for k in range(70)]
    got = fp.fingerprint_chain(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert len(got) == 70 and all(r.fingerprint and r.near_next < 1 for r in got)
    assert all(r.near_edited < 1 for r in got if r.n_chars < 142)


@pytest.mark.parametrize("ids", [[5, 3, 9, 1, 7], [None, 2, None, 2, 1], [4], []])
def test_chain_against_brute_force(spark, ids):
    texts = ["alpha beta " * 30, None, "", "x", "émile zola\n" * 40]
    rows = [(d, t, "clash") for d, t in zip(ids, texts)] * (2 if len(ids) > 1 else 1)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, fingerprint string")
    got = sorted(((-1 if r.doc_id is None else r.doc_id), r.n_chars, r.edited) for r in fp.fingerprint_chain(docs).collect())
    order = sorted(rows, key=lambda r: (-1 if r[0] is None else r[0], r[1] is not None, r[1] or ""))
    want = []
    for k, (d, t, _) in enumerate(order):
        own, after = t or "", order[(k + 1) % len(order)][1] or ""
        half = len(own) // 2
        want.append((-1 if d is None else d, len(own), own[:len(own) - half] + after[:half]))
    assert got == sorted(want)


def test_query_whole_table(spark):
    from folioforge.llm.queries import QUERIES
    d = "/root/testdata/sf0.001"
    rows = {r.doc_id: r for r in QUERIES["op2_fingerprints"](spark, d).collect()}
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(d + "/documents.parquet").collect()}
    order = sorted(texts)
    assert sorted(rows) == order
    for k, i in enumerate(order):
        own, after = texts[i], texts[order[(k + 1) % len(order)]]
        half = len(own) // 2
        edited = own[:len(own) - half] + after[:half]
        a, e, n = fp.fingerprints([own.encode(), edited.encode(), after.encode()])
        assert rows[i].n_chars == len(own) and rows[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert rows[i].fingerprint == fp.text_form(a) and rows[i].edited_fingerprint == fp.text_form(e)
        assert rows[i].near_edited == fp.likeness(a, e) and rows[i].near_next == fp.likeness(a, n)
    near = [rows[i].near_edited for i in order if len(texts[i]) > 3000]
    assert sum(near) / len(near) > 0.25
    assert sum(r.near_next for r in rows.values()) / len(rows) < 0.15
