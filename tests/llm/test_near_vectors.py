import random

import numpy as np
import pytest

from martflow.llm import near_vectors as near

SCHEMA = "vec_id long, embedding array<float>, label int, unit string, key string"


def unit(vector):
    if vector is None or not len(vector) or any(x is None for x in vector):
        return None
    own = np.array(vector, np.float64)
    size = np.sqrt((own / max(np.abs(own).max(), 1e-300)) @ (own / max(np.abs(own).max(), 1e-300)))
    if not np.isfinite(own).all() or not own.any():
        return None
    return own / np.abs(own).max() / size


def brute(rows):
    units = [unit(v) for _, v in rows]
    n = len(rows)
    root, links = list(range(n)), [0] * n
    for i in range(n):
        for j in range(i):
            a, b = units[i], units[j]
            if a is not None and b is not None and len(a) == len(b) and a @ b >= 0.9:
                links[i] += 1
                links[j] += 1
                old, new = max(root[i], root[j]), min(root[i], root[j])
                root = [new if r == old else r for r in root]
    out = []
    for i, (vec, _) in enumerate(rows):
        known = [rows[j][0] for j in range(n) if root[j] == root[i] and rows[j][0] is not None]
        component = min(known) if known else None
        out.append((vec, links[i], component, vec == component))
    return out


def corpus(seed=3):
    draw = np.random.default_rng(seed)
    rows = []
    for size in (1, 1, 1, 2, 2, 3, 5, 8, 40):
        for _ in range(4):
            base = draw.standard_normal(24)
            for _ in range(size):
                noise = draw.standard_normal(24) * draw.choice([0.05, 0.2, 0.3])
                rows.append((base + noise) * draw.choice([0.1, 1, 50]))
    rows = [r.astype(np.float32).tolist() for r in rows]
    rows += [rows[5]] * 3 + [rows[9][:8], rows[9][:8]]
    rows += [None, [], [0.0] * 24, [None, *rows[3][1:]], [float("nan")] * 24, [float("inf"), 1.0]]
    rows += [[3e38] * 24, [1e-38] * 24]
    random.Random(seed).shuffle(rows)
    rows = list(enumerate(rows, start=100))
    rows += [(None, rows[7][1]), (None, None), (101, rows[1][1])]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "u", "k") for r in rows], SCHEMA)


@pytest.mark.parametrize("small", [False, True])
def test_against_brute_force(spark, monkeypatch, small):
    if small:  # several partitions, seams and blocks
        monkeypatch.setattr(near, "_PART_ROWS", 150)
        monkeypatch.setattr(near, "_BLOCK", 7)
    rows = corpus()
    got = near.near_vectors(frame(spark, rows), window=8, passes=20).collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute(rows), key=str)


def test_seams_join_what_windows_would(spark, monkeypatch):
    monkeypatch.setattr(near, "_PART_ROWS", 40)
    draw = np.random.default_rng(1)
    base = draw.standard_normal(16)
    rows = [(i, (base + 0.02 * draw.standard_normal(16)).tolist()) for i in range(200)]
    got = near.near_vectors(frame(spark, rows), window=2, passes=1).collect()
    assert {(r.n_links, r.component_id) for r in got} == {(199, 0)}


def test_empty_table(spark):
    assert near.near_vectors(frame(spark, [])).count() == 0
    assert near.near_vectors(frame(spark, [(1, None)])).collect() == [(1, 0, 1, True)]


def test_recall_on_the_whole_table(spark):
    import duckdb

    got = near.op2_sorted_projections(spark, "/root/testdata/sf0.01").collect()
    path = "/root/testdata/sf0.01/embeddings.parquet"
    rows = duckdb.sql(f"select vec_id, embedding from '{path}' order by vec_id").fetchall()
    want = {r[0]: r for r in brute(rows)}
    assert len(got) == len(want)
    assert all(r.n_links <= want[r.vec_id][1] for r in got)
    assert sum(r.n_links for r in got) >= 0.97 * sum(r[1] for r in want.values())
    assert np.mean([tuple(r) == want[r.vec_id] for r in got]) >= 0.99


def planted(count, hot, pairs=200, size=64, seed=11):
    """Vectors with lone pairs at cosine 0.90 to 0.92; ``hot``: a third near one direction."""
    draw = np.random.default_rng(seed)

    def scaled(x):
        return x / np.linalg.norm(x, axis=1, keepdims=True)

    base = scaled(draw.standard_normal((count, size)))
    some = slice(0, count // 3 if hot else 0)
    pole = np.eye(size)[0]
    side = base[some] - np.outer(base[some] @ pole, pole)
    base[some] = 0.8 * pole + 0.6 * scaled(side)
    own = base[:pairs]
    noise = draw.standard_normal(own.shape)
    noise = scaled(noise - (noise * own).sum(1, keepdims=True) * own)
    cosine = draw.uniform(0.901, 0.92, (pairs, 1))
    base[-pairs:] = cosine * own + np.sqrt(1 - cosine**2) * noise
    return base.astype(np.float32)


def brute_links(vectors):
    units = vectors.astype(np.float64)
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    links = np.zeros(len(units), np.int64)
    for at in range(0, len(units), 1000):
        links[at : at + 1000] = (units[at : at + 1000] @ units.T >= 0.9).sum(1) - 1
    return links


@pytest.mark.parametrize("hot", [False, True])
def test_no_lone_link_is_lost(spark, tmp_path, hot):
    import pyarrow as pa
    import pyarrow.parquet as pq

    vectors = planted(100_000, hot)
    rows = {"vec_id": np.arange(len(vectors)), "embedding": list(vectors)}
    pq.write_table(pa.table(rows), tmp_path / "embeddings.parquet")
    got = near.op2_sorted_projections(spark, str(tmp_path)).toPandas().sort_values("vec_id")
    want = brute_links(vectors)
    assert want[-200:].min() >= 1
    assert (got.n_links.to_numpy() == want).all()
    assert (got.component_id.to_numpy()[-200:] == np.arange(200)).sum() >= 199


@pytest.mark.parametrize("rows", [3, 8, 50])
def test_exact_without_windows(spark, monkeypatch, rows):
    monkeypatch.setattr(near, "_FILE_ROWS", rows)
    given = corpus(5)
    got = near.near_vectors(frame(spark, given), window=1, passes=1, hashes=1).collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute(given), key=str)


def at_the_limit(pairs=150, size=48, seed=23):
    """Lone pairs at cosine 0.9 within rounding, about half to either side."""
    draw = np.random.default_rng(seed)
    base = draw.standard_normal((pairs, size))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    side = draw.standard_normal(base.shape)
    side -= (side * base).sum(1, keepdims=True) * base
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    return np.concatenate([base, 0.9 * base + np.sqrt(1 - 0.81) * side])


@pytest.mark.parametrize("window", [1, 32])
def test_ties_at_the_threshold_are_decided_alike(spark, window):
    vectors = at_the_limit()
    schema = "vec_id long, embedding array<double>, component long, n_links string, id int"
    rows = [(i, v.tolist(), 7, "clash", 0) for i, v in enumerate(vectors)]
    got = near.near_vectors(spark.createDataFrame(rows, schema), window=window).collect()
    held = {}
    for row in got:
        held.setdefault(row.component_id, []).append(row)
    assert {len(own) for own in held.values()} == {1, 2}
    assert all((row.n_links == 0) == (len(held[row.component_id]) == 1) for row in got)
    units = np.stack([unit(v) for v in vectors])
    links = near.cosines(units[:150], units[150:]) >= 0.9
    linked = {row.vec_id for row in got if row.n_links}
    assert linked == {i for i in range(300) if links[i % 150]}


def test_products_and_cosines_settle_alike():
    vectors = at_the_limit(60)
    a, b = vectors[:60], vectors[60:]
    crossed = near.settled(a @ b.T, a, b, 0.9)
    assert (crossed.T == near.settled(b @ a.T, b, a, 0.9)).all()
    alike = near.settled(np.einsum("ij,ij->i", a, b), a, b, 0.9)
    assert (np.diagonal(crossed) == alike).all()
    alone = [near.cosines(a[i : i + 1], b[i : i + 1])[0] >= 0.9 for i in range(60)]
    assert alike.tolist() == alone


def test_files_are_ruled_out_by_their_bounds():
    draw = np.random.default_rng(4)

    def near_axis(axis, count=200):
        rows = 0.1 * draw.standard_normal((count, 16)) + np.eye(16)[axis]
        return rows / np.linalg.norm(rows, axis=1, keepdims=True)

    pivots = near_axis(0, 3)
    one, far, same = near_axis(0), near_axis(5), near_axis(0)
    bounds = [near.angle_bounds(x, pivots) for x in (one, far, same)]
    assert not near.may_link(bounds[0], bounds[1], 0.9)
    assert near.may_link(bounds[0], bounds[2], 0.9)
    assert (one @ far.T).max() < 0.9 <= (one @ same.T).max()
    for _ in range(200):  # whatever links is let in
        a, b = (draw.standard_normal((2, 3)) for _ in range(2))
        a, b = (x / np.linalg.norm(x, axis=1, keepdims=True) for x in (a, b))
        pivot = np.eye(3)
        if (a @ b.T).max() >= 0.9:
            assert near.may_link(near.angle_bounds(a, pivot), near.angle_bounds(b, pivot), 0.9)


def test_clusters_apart_and_other_lengths(spark, monkeypatch):
    monkeypatch.setattr(near, "_FILE_ROWS", 20)
    draw = np.random.default_rng(9)
    rows = [np.eye(12)[i % 6] + 0.08 * draw.standard_normal(12) for i in range(90)]
    rows += [draw.standard_normal(5) for _ in range(4)]
    given = [(i, v.tolist()) for i, v in enumerate(rows)]
    got = near.near_vectors(frame(spark, given), window=1, passes=1, hashes=1).collect()
    given = [(i, np.float32(v).tolist()) for i, v in given]
    assert sorted(map(tuple, got)) == sorted(brute(given))
