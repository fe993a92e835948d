import hashlib
import math

import pytest
from compare import connect, spark_rows, sql_rows

pytest.importorskip("martflow.llm.centroids")
from martflow.llm import centroids  # noqa: E402

VECTORS = "vec_id long, embedding array<float>, cluster string, parts string, distance int"


def brute(rows, count, rounds, dimension):
    kept = [
        (i, [max(-(1 << 27), min(1 << 27, math.floor(x * 1024))) for x in v])
        for i, v in rows
        if v is not None
        and len(v) == dimension
        and all(x is not None and math.isfinite(x) for x in v)
    ]
    told = [(hashlib.sha256(f"3:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept]
    centers = [v for _, v in sorted(told)[:count]]

    def near(v):
        return min((sum((x - y) ** 2 for x, y in zip(v, c, strict=True)), n) for n, c in enumerate(centers))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        centers = [
            [sum(x) // len(groups[n]) for x in zip(*groups[n], strict=True)] if n in groups else c
            for n, c in enumerate(centers)
        ]
    found = [(i, *near(v)) for i, v in kept]
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]
    inertia = sum(d for _, d, _ in found)
    return [
        (i, n, d, sum(e for _, e, m in found if m == n), inertia, digests[n]) for i, d, n in found
    ]


def clusters(spark, rows, count=3, rounds=4, dimension=2):
    frame = spark.createDataFrame([(*r, "c", "p", 1) for r in rows], VECTORS)
    vectors = centroids.integer_vectors(frame, dimension)
    found = centroids.clustered(vectors, centroids.fit(vectors, count, rounds))
    return found, [tuple(r) for r in found.collect()]


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[2]))


ODD = [
    (1, None),
    (2, []),
    (3, [1.0]),
    (4, [1.0, 2.0, 3.0]),
    (5, [1.0, None]),
    (6, [float("nan"), 1.0]),
    (7, [float("inf"), 1.0]),
    (8, [float("-inf"), 1.0]),
    (None, [0.25, -0.3]),
    (9, [0.0, 0.0]),
    (9, [0.0, 0.0]),
    (10, [-0.7, 0.1]),
    (10, [0.7, 0.1]),
    (11, [1.0, -1.0]),
    (12, [-1.0, -1.0]),
    (13, [0.0004, -0.0004]),
]


def test_rows(spark):
    for count, rounds in [(3, 4), (8, 0), (1, 2), (20, 3)]:
        found, got = clusters(spark, ODD, count, rounds)
        assert order(got) == order(brute(ODD, count, rounds, 2))
    assert [t for _, t in found.dtypes] == ["bigint", "int"] + ["bigint"] * 3 + ["string"]


def test_ties_go_to_the_smaller_number_and_empty_centroids_stay(spark):
    rows = [(i, [1.0, 1.0]) for i in range(30)]
    _, got = clusters(spark, rows)
    assert {r[1] for r in got} == {0}
    assert order(got) == order(brute(rows, 3, 4, 2))


def test_large_components(spark):
    rows = [(1, [1e38, -1e38]), (2, [3e5, 0.0]), (3, [1.0, 2.0])]
    _, got = clusters(spark, rows, 2, 2)
    assert order(got) == order(brute(rows, 2, 2, 2))


def test_empty_tables(spark):
    for rows in ([], [(1, None)]):
        found, got = clusters(spark, rows)
        assert got == []
        assert [t for _, t in found.dtypes] == ["bigint", "int"] + ["bigint"] * 3 + ["string"]


def test_no_python_and_one_shuffle_a_round(spark):
    frame = spark.createDataFrame([(*r, "c", "p", 1) for r in ODD], VECTORS)
    vectors = centroids.integer_vectors(frame, 2)
    near = vectors.select(centroids.nearest([[1, 2], [3, 4]]).alias("near"))
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, sf):
    path = f"/root/testdata/{sf}"
    got = spark_rows(centroids.op12_centroid_clusters(spark, path))
    assert got == sql_rows(connect(path), centroids.OP12_SQL)
    assert sum(got[1].values()) > 0
