import random

import pytest

from martflow.llm.components import components


def brute(pairs):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        if a != b:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    return {x: find(x) for x in parent}


@pytest.mark.parametrize(
    "pairs",
    [
        [(i, i + 1) for i in range(60)],
        [(0, i) for i in range(1, 300)] + [(500, i) for i in range(501, 520)],
        [(3, 3), (1, 2), (2, 1), (1, 2)],
        [(random.Random(4).randint(0, 10**12), i) for i in range(5)]
        + [(random.Random(i).randint(0, 90), random.Random(-i).randint(0, 90)) for i in range(70)],
    ],
)
def test_components(spark, pairs):
    links = spark.createDataFrame(pairs, "a long, b long")
    got = components(links).collect()
    assert len(got) == len({r.node for r in got})
    assert {r.node: r.component for r in got} == brute(pairs)


def test_no_links(spark):
    links = spark.createDataFrame([(None, 1), (4, 4)], "a long, b long")
    assert components(links).collect() == []
