import random
import re
from collections import Counter

import numpy as np
import pytest

from folioforge.llm import phrases


def brute(rows, min_count, top, inside=50):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(lower)):
            words = [w for w in re.split("[ \t]+", piece) if w]
            n[lang] += len(words)
            for i in range(len(words)):
                for k in (1, 2, 3):
                    if i + k <= len(words):
                        f[lang, tuple(words[i:i + k])] += 1
    cand = {k: v for k, v in f.items() if len(k[1]) > 1 and v >= min_count}
    out = []
    for lang in n:
        told = []
        for (of, p), a in cand.items():
            if of != lang or any(o == lang and len(q) > len(p) and 100 * b >= inside * a and p in (q[:2], q[1:])
                                 for (o, q), b in cand.items()):
                continue
            s, k = min((1000000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
            told.append((-s, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
        out += [(lang, i, p.decode(), -a, le, r, n[lang], -s) for i, (s, a, p, le, r) in enumerate(sorted(told)[:top], 1)]
    return sorted(out)


def check(spark, rows, **more):
    df = spark.createDataFrame([(t, lang, 1, "x") for lang, t in rows], "text string, lang string, n int, key string")
    got = sorted(map(tuple, phrases.collocations(df, **more).collect()))
    assert got == brute(rows, more.get("min_count", 10), more.get("top", 2000))
    return got


ODD = [(None, "a b a b a b, a b"), ("und", "a b"), ("", "a b " * 20), ("x\ny", "a b " * 15), (None, None), ("en", None), ("en", ""),
       ("en", " \t .,;:!?\n\r\x0b\x0c"), ("en", "\x01 \x00b c a b É é " * 12), ("en", "日本 の 日本 " * 11)]


@pytest.mark.parametrize("budget", [1 << 19, 60, 7])
def test_against_brute_force(spark, budget):
    rng = random.Random(3)
    words = ["the", "of", "A", "b", "new", "YORK", "city", "é", "x-y", "#"] + [f"w{i}" for i in range(30)]
    weight = [40, 30, 20, 15, 10, 10, 9, 8, 5, 5] + [2] * 30
    rows = [(rng.choice(["en", "de", None]), "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "! "])
             for w in rng.choices(words, weight, k=rng.randint(0, 120)))) for _ in range(80)]
    rows += [("en", "New York City hall " * 5)] * 9 + ODD
    assert len(check(spark, rows, budget=budget)) > 40
    check(spark, rows, budget=budget, min_count=25, top=7)


def test_a_long_text_and_no_text(spark):
    check(spark, [("en", "one two three four " * 30_000), ("en", "one two")])
    check(spark, [("en", "a b c")])
    df = spark.createDataFrame([], "text string, lang string")
    assert phrases.collocations(df).collect() == []


def test_hot_prefixes_are_split(spark):
    rng = random.Random(9)
    rows = [(" ".join(["of", "the", f"w{rng.randrange(40)}"] * 30), "en") for _ in range(40)]
    docs = spark.createDataFrame(rows, "text string, lang string")
    hot = phrases._hashes(phrases.word_counts(docs, 10).where("word IS NOT NULL AND f > 500"))
    assert len(hot) == 2
    assert len(phrases.hot_pairs(docs, hot, 500, 3600)) == 1  # "of the", not "the w.."


def test_groups_keep_to_the_budget():
    loads = np.array([3, 3, 3, 50, 1, 1, 9, 0, 0, 2])
    groups = phrases.pack(loads, 10)
    sums = np.bincount(groups, loads)
    assert (np.diff(groups) >= 0).all() and all(s <= 10 or (groups == g).sum() == 1 for g, s in enumerate(sums))
