import random

import pytest

from folioforge.llm.components import components


def brute(edges):
    label = {}
    near = {}
    for a, b in edges:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    for start in sorted(near):
        todo = [start] if start not in label else []
        while todo:
            x = todo.pop()
            if x not in label:
                label[x] = start
                todo += near[x]
    return label


def path(order):
    return list(zip(order, order[1:]))


def shuffled(n, seed):
    order = list(range(n))
    random.Random(seed).shuffle(order)
    return order


GRAPHS = {
    "ascending": (path(range(1000)), 15),
    "descending": (path(range(999, -1, -1)), 15),
    "shuffled": (path(shuffled(1000, 1)), 40),
    "mixed": ([(5, 5000 + i) for i in range(300)] + [(9000, i) for i in range(100, 300)] + path([*range(400, 440), 400])
              + [(random.Random(i).randrange(6000, 6400), random.Random(-i).randrange(6000, 6400)) for i in range(1, 300)], 25),
}


@pytest.mark.parametrize("name", GRAPHS)
def test_labels_and_rounds(spark, name):
    edges, most = GRAPHS[name]
    steps = []
    df = spark.createDataFrame(edges + [edges[0], (7, 7)], "a bigint, b bigint")
    got = {r.node: r.label for r in components(df, steps).collect()}
    assert got == brute(e for e in edges if e[0] != e[1])
    assert len(steps) <= most


def test_no_edges(spark):
    assert components(spark.createDataFrame([(1, 1)], "a bigint, b bigint")).collect() == []
