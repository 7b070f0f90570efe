import random
import re

from folioforge.llm import substring_dedup as sub


def brute(rows, min_chars=sub.MIN_CHARS):
    first, out = {}, []
    seen = set()
    for d, t in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        at = 0
        for k, u in enumerate(re.findall(r"[^\n]*?[.!?][ \t]|[^\n]*\n|[^\n]+", t or "")):
            key = tuple(u.encode().lower().split())
            if key and len(b" ".join(key).decode()) >= min_chars:
                keeper = first.setdefault(key, (d, k))
                if keeper != (d, k):
                    out.append((d, k, at, at + len(u), *keeper))
            at += len(u)
    return sorted(out)


def check(spark, rows, min_chars=sub.MIN_CHARS):
    docs = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id bigint, text string, unit int, cuts string")
    want = brute(rows, min_chars)
    removed = sub.removed_units(docs, min_chars)
    assert sorted(map(tuple, removed.collect())) == want
    gone = {}
    for d, _, start, end, *_ in want:
        gone.setdefault(d, set()).add((start, end))
    left = []
    for d, t in rows:
        if t is not None:
            for start, end in sorted(gone.get(d, ()), reverse=True):
                t = t[:start] + t[end:]
        left.append((d, t, 1, "x"))
    assert sorted(map(tuple, sub.without(docs, removed).collect()), key=repr) == sorted(left, key=repr)
    return want


def test_against_brute_force(spark):
    rng = random.Random(2)
    word = lambda: rng.choice(["a", "Bé", "c,", "d.", "e", "日本", "f!", "G?"])
    lines = [" ".join(word() for _ in range(rng.randint(0, 25))) for _ in range(40)]
    rows = [(rng.randrange(10**6), rng.choice(["\n", "\n\n", " \t"]).join(rng.choices(lines, k=rng.randint(0, 12)))) for _ in range(60)]
    rows += [(None, lines[0]), (None, None), (7, None), (8, ""), (9, "\n\n"), (10, ". . . !\t\n. ")]
    for min_chars in (1, 12, 40):
        check(spark, rows, min_chars)


def test_short_hot_lines_and_lines_without_blanks(spark):
    hot = "exactly seven words stand in this sentence."
    chinese = "这是一个没有空格的很长的句子用来检查单位的长度按字符而不是按单词来计算因此也能被找到并且删除掉吧"
    short = "Short. Short. Short. "
    rows = [(i, f"own words of document {i} that stand here alone\n{hot}\n{chinese}\n{short}") for i in range(60)]
    want = check(spark, rows)
    assert len(want) == 2 * 59  # the short sentences are under the floor
    check(spark, rows, 1)
    check(spark, [(1, hot * 20_000), (2, (hot + "\n") * 3000), (3, "x" * 500_000 + "\n" + hot)])


def test_edge_cases(spark):
    line = "One two three four five six seven eight."
    check(spark, [(2, line + "\n" + line.upper()), (1, "  one TWO three four five\tsix seven  eight. ")])
    again = [(3, line), (3, line)]
    docs = spark.createDataFrame(again, "doc_id bigint, text string")
    assert sub.removed_units(docs).collect() == []
    assert sub.removed_units(docs.limit(0)).collect() == []
