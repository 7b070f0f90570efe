import random
import zlib

import numpy as np

from folioforge.llm import pu_quality as q
from folioforge.llm.common import read_table, ready

SF = "/root/testdata/sf0.1"


def grad_check(pos, unl, prior, w):
    risk = lambda v: prior * np.logaddexp(0, -(pos @ v)).mean() + max(
        0.0, np.logaddexp(0, unl @ v).mean() - prior * np.logaddexp(0, pos @ v).mean())
    return risk(w)


def test_risk_falls_and_classes_part():
    rng = np.random.default_rng(1)
    good = rng.normal(1, 1, (400, 5)).astype(np.float32)
    bad = rng.normal(-1, 1, (300, 5)).astype(np.float32)
    web = np.vstack([rng.normal(1, 1, (700, 5)), bad]).astype(np.float32)
    w = q.nn_pu(good, web, 0.7)
    one = lambda x: np.hstack([x, np.ones((len(x), 1))])
    assert grad_check(one(good), one(web), 0.7, w) < 0.6 * grad_check(one(good), one(web), 0.7, np.zeros(6))
    assert (one(good) @ w > 0).mean() > 0.95 and (one(bad) @ w > 0).mean() < 0.05
    assert abs(q.estimated_prior(good, web) - 0.7) < 0.15
    assert np.isfinite(q.nn_pu(good, good, 0.99)).all()  # no bad text at all: the risk is held at 0, not below


def test_features_do_not_depend_on_neighbours():
    rng = random.Random(4)
    texts = ["", "a", "\n", "Ab c.\nAb c.\n", "é日 x1 " * 40] + ["".join(rng.choices("aB c.\n!|", k=rng.randint(1, 80))) for _ in range(30)]
    blobs = [t.encode() for t in texts]
    offsets = np.append(0, np.cumsum([len(b) for b in blobs]))
    every = q.features(np.frombuffer(b"".join(blobs), np.uint8), offsets)
    for i, b in enumerate(blobs):
        alone = q.features(np.frombuffer(b, np.uint8), np.array([0, len(b)]))[0]
        assert np.allclose(alone, every[i], atol=1e-6)
    assert not every[0].any()


def test_held_out_accuracy_and_labels_unseen(spark):
    ready(spark)
    docs, labels = read_table(spark, SF, "documents"), read_table(spark, SF, "labels")
    out = {r["doc_id"]: r for r in q.quality(docs, labels).collect()}
    assert len(out) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 3 == 1) and 0 <= r["score"] <= 1
               and r["predicted"] == int(r["score"] >= 0.5) for d, r in out.items())
    known = [(r["quality"], out[r["doc_id"]]["predicted"]) for r in labels.where("quality IS NOT NULL").collect()
             if r["doc_id"] in out and out[r["doc_id"]]["held_out"]]
    bad = [p for y, p in known if y == 0]
    good = [p for y, p in known if y == 1]
    assert len(bad) > 100 and sum(good) > 0.99 * len(good) and sum(bad) < 0.07 * len(bad)
    flipped = labels.withColumn("quality", q.F.when(q.held_out(q.F.col("doc_id")), 1 - q.F.col("quality")).otherwise(q.F.col("quality")))
    prior, w = q.train(docs, labels)
    again, v = q.train(docs, flipped)
    assert prior == again and (w == v).all() and 0.75 < prior < 0.95


def test_edge_rows(spark):
    ready(spark)
    good, junk = "Some plain words in a line of text, and more. " * 4, "BUY!! NOW!! $$$ " * 9
    rows = [(i, good if i % 3 else junk, 1, 1) for i in range(60)] + [(1, good, 1, 1), (None, None, 1, 1), (None, "", 1, 1), (77, None, 1, 1),
                                                                     (78, junk * 20_000, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, trusted int, web int")
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(50)] + [(1, 0, 0), (2, None, 0), (None, 1, 0)], "doc_id bigint, quality int, web int")
    out = q.quality(docs, labels).collect()
    assert len(out) == len(rows) and all(0 <= r["score"] <= 1 for r in out)
    assert len({r["score"] for r in out if r["doc_id"] in (None, 77)}) == 1  # empty texts score the bias
    scored = q.score(docs, q.train(docs, labels)[1])
    assert scored.columns == [*docs.columns, "score"]
    none = q.quality(docs, labels.limit(0)).collect()
    assert {r["score"] for r in none} == {0.5}
    assert q.quality(docs.limit(0), labels).collect() == []
