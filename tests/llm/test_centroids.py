import hashlib
import random

import numpy as np
import pytest

from weftline.llm.centroids import cluster, clusters_with_inertia, nearest, segment_norms


def plain(rows, k, rounds, dimensions, scale=256):
    """Exact k-means over Python integers."""
    kept = [(i, [int(np.floor(float(x) * scale)) for x in v]) for i, v in rows if v is not None and len(v) == dimensions and all(x is not None and np.isfinite(x) for x in v)]
    start = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)[:k]
    centroids = [v for _, v in start]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centroids))
    for _ in range(rounds):
        own = [near(v)[1] for _, v in kept]
        for j in range(len(centroids)):
            mine = [v for (_, v), o in zip(kept, own, strict=True) if o == j]
            if mine:
                centroids[j] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    return sorted((i is None, i or 0, near(v)[1], near(v)[0]) for i, v in kept), centroids


def made(seed, n=300, dimensions=16):
    pick = random.Random(seed)
    centres = [[pick.uniform(-1, 1) for _ in range(dimensions)] for _ in range(5)]
    rows = [(i, [float(np.float32(x + pick.gauss(0, 0.2))) for x in pick.choice(centres)]) for i in range(n)]
    rows += rows[:30] + [(7, rows[9][1]), (None, rows[3][1]), (900, None), (901, []), (902, [1.0] * (dimensions - 1)), (903, [None] + [0.5] * (dimensions - 1)), (904, [float("nan")] * dimensions), (905, [float("inf")] * dimensions), (906, [0.0] * dimensions), (907, [0.0] * dimensions)]
    return rows


@pytest.mark.parametrize(("seed", "k", "rounds"), [(1, 8, 3), (2, 40, 5), (3, 1, 1), (4, 1000, 2)])
def test_against_plain_python(spark, seed, k, rounds):
    rows = made(seed)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, q string, norms int").repartition(3)
    found, centroids = cluster(df, k=k, rounds=rounds, dimensions=16)
    want, exact = plain(rows, k, rounds, 16)
    assert centroids.tolist() == exact
    assert sorted((r.vec_id is None, r.vec_id or 0, r.cluster, r.distance) for r in found.collect()) == want


def test_inertia_and_hashes(spark):
    rows = made(5)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = clusters_with_inertia(df, k=6, rounds=2, dimensions=16).collect()
    want, centroids = plain(rows, 6, 2, 16)
    assert {r.inertia for r in got} == {sum(w[3] for w in want)}
    for r in got:
        assert r.cluster_inertia == sum(w[3] for w in want if w[2] == r.cluster)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, centroids[r.cluster])).encode()).hexdigest()
    assert clusters_with_inertia(df.limit(0), k=6, dimensions=16).collect() == []
    # too large to be squared exactly: left out
    big = spark.createDataFrame([(1, [1e30] * 16), (2, [4000.0] * 16), (3, [-4095.0] * 16)], "vec_id long, embedding array<float>")
    assert sorted(r.vec_id for r in clusters_with_inertia(big, k=2, dimensions=16).collect()) == [2, 3]


def test_screening_spares_exact_distances_and_keeps_ties():
    rng = np.random.default_rng(1)
    centres = rng.integers(-300, 300, (40, 64))
    x = centres[rng.integers(0, 40, 5000)] + rng.integers(-30, 30, (5000, 64))
    where, best, taken = nearest(x, segment_norms(x), centres)
    d = ((x[:, None, :] - centres[None]) ** 2).sum(2)
    assert (where == d.argmin(1)).all() and (best == d.min(1)).all()
    assert taken < 0.2 * d.size
    twice = np.concatenate([centres[::-1], centres])
    where, best, _ = nearest(x, segment_norms(x), twice)
    d = ((x[:, None, :] - twice[None]) ** 2).sum(2)
    assert (where == d.argmin(1)).all() and (best == d.min(1)).all()
