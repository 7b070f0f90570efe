"""Each stage of the pipeline against a brute-force version, on the whole small table."""
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as cp
from folioforge.llm import toxicity
from test_minhash import brute as near_brute

D = "/root/testdata/sf0.001"
EDGE = [(1, None, "en", "s", None, 5), (1, None, "en", "s", None, 5), (2, "", None, None, 0, 1), (None, "a line of its own\nb", "x", "s", 19, 1),
        (3, "One line of text here.\nshort\nOne line of text here.", "en", "s", 51, 1), (4, " one LINE of text here. ", "en", None, 24, 2),
        (5, "word " * 3000, "en", "t", 15000, 2), (5, "word " * 3000, "en", "t", 15000, 2)]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept int"


def rows_of(df):
    return [r.asDict() for r in df.collect()]


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(D + "/documents.parquet")
    out = [rows_of(docs)]
    for _, stage in cp.STAGES:
        docs = cp.materialize(stage(spark, docs, D), "test-stage")
        out.append(rows_of(docs))
    return out


def line_brute(rows):
    key = lambda x: x.strip(" \t\n\v\f\r").translate({c: c + 32 for c in range(65, 91)})
    first = {}
    for r in rows:
        for line in (r["text"] or "").split("\n"):
            if r["doc_id"] is not None and len(key(line)) >= 10:
                first[key(line)] = min(first.get(key(line), r["doc_id"]), r["doc_id"])
    out = []
    for r in rows:
        lines = (r["text"] or "").split("\n")
        left = [x for x in lines if r["doc_id"] is None or first.get(key(x), r["doc_id"]) == r["doc_id"]]
        out.append(r if len(left) == len(lines) else r | {"text": "\n".join(left), "n_chars": len("\n".join(left))})
    return out


def same(a, b):
    order = lambda rows: sorted((sorted(r.items()) for r in rows), key=repr)
    assert order(a) == order(b)


def test_toxicity_stage(spark, stages):
    docs = spark.read.parquet(D + "/documents.parquet")
    told = toxicity.toxicity(docs, spark.read.parquet(D + "/labels.parquet")).collect()
    gone = {r.doc_id for r in told if r.score >= 0.3}
    same(stages[1], [r for r in stages[0] if r["doc_id"] not in gone or not r["text"]])
    assert len(stages[1]) >= 0.8 * len(stages[0])


def test_line_stage(stages):
    same(stages[2], line_brute(stages[1]))


def test_near_stage(stages):
    component = near_brute([(r["doc_id"], r["text"]) for r in stages[2]])
    same(stages[3], [r for r in stages[2] if component[r["doc_id"]][1] == r["doc_id"]])


def test_mixing_stage(stages):
    n = lambda t: len((t or "").encode().split())
    size, whole = defaultdict(int), {r["doc_id"]: r for r in stages[3]}
    for r in stages[3]:
        size[r["source"]] += n(r["text"])
    weights = dict(zip(sorted(size), (3.0, 1.0, 2.0) * len(size)))
    free, left, target = dict(weights), 1.5 * sum(size.values()), {}
    while True:
        over = [s for s in free if left * free[s] / sum(free.values()) > 2 * size[s]]
        if not over:
            break
        share = left / sum(free.values())
        for s in over:
            assert share * free[s] > 2 * size[s]
            target[s] = 2.0 * size[s]
            left -= target[s]
            del free[s]
    target |= {s: left * free[s] / sum(free.values()) for s in free}
    taken, times = Counter(), Counter()
    for r in stages[4]:
        taken[r["source"]] += n(r["text"])
        times[r["doc_id"]] += n(r["text"])
        own = whole[r["doc_id"]]["text"]
        assert own.startswith(r["text"])  # cut behind a word, its white space as it was
        assert r["n_chars"] == len(r["text"])
    for s in size:
        assert abs(taken[s] - target[s]) <= 1
    assert all(times[d] <= 2 * n(whole[d]["text"]) for d in times)


def test_token_stage(stages):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for r in stages[4]:
        ids = library.encode(r["text"], add_special_tokens=False).ids
        want[r["doc_id"], len(ids), b"".join(x.to_bytes(4, "little") for x in ids), r["text"]] += 1
    assert want == Counter((r["doc_id"], r["n_tokens"], bytes(r["ids"]), r["text"]) for r in stages[5])


@pytest.mark.parametrize("rows", [EDGE, []])
def test_edge_rows(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    given = rows_of(docs)
    same(rows_of(cp.drop_repeated_lines(spark, docs, D)), line_brute(given))
    near = rows_of(cp.drop_near_duplicates(spark, docs, D))
    assert Counter(r["doc_id"] for r in near) == Counter(dict.fromkeys({r["doc_id"] for r in given}, 1))
    for _, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, D)
        assert out.columns == docs.columns
        rows_of(out)
    assert len(rows_of(cp.encode_tokens(spark, docs, D))) == len(rows)


HELPERS = ["row", "rid", "tid", "_tid", "_rid", "kept_id", "nth", "score", "_toxicity", "_n_dropped", "_kept_text", "_n_lines", "_drops",
           "_d", "_t", "words", "_words", "size", "_size", "slot", "_slot", "at", "_at", "h1", "drops", "node", "label", "cuts", "positions", "N.x"]


def test_columns_of_any_name_come_through(spark):
    line = "a line that is long enough to count"
    rows = [(i, f"{line}\nown words of document {i} here {i * i} and {i * 7} there", "en", f"s{i % 2}", 7) for i in range(12)]
    rows += [(20, rows[3][1], "en", "s1", 7), (None, line, None, None, 1), (21, None, "en", "s0", 0)]
    rows = [(*r, *[f"{name}-{k}" for name in HELPERS]) for k, r in enumerate(rows)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, "
                                 + ", ".join(f"`{n}` string" for n in HELPERS))
    given = {r[HELPERS[0]]: r.asDict() for r in docs.collect()}
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, D)
        assert out.columns == docs.columns, name
        found = rows_of(out)
        assert found, name
        for r in found:
            own = given[r["row"]]
            assert all(r[c] == own[c] for c in docs.columns if c not in ("text", "n_chars")), name
    assert len(rows_of(cp.encode_tokens(spark, docs, D))) == len(rows)
