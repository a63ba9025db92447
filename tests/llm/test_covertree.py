import numpy as np
import pytest
from pyspark.sql import functions as F

from weftline.llm.covertree import CoverTree, cut, top_k


def brute(rows, k, is_query):
    found = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v):
            found[(i, tuple(int(np.floor(256 * float(x))) for x in v))] = True
    out = []
    for q, a in found:
        if is_query(q):
            scores = [(-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in found if i != q and len(a) == len(b)]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def run(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    return sorted(map(tuple, top_k(df, F.col("vec_id") % 3 == 0, k=5, **options).collect()))


@pytest.mark.parametrize("kind", ["spread", "clustered", "ties"])
def test_equals_brute_force(spark, kind):
    rng = np.random.default_rng(1)
    n = 260
    if kind == "spread":
        x = rng.normal(size=(n, 7))
    elif kind == "clustered":
        x = rng.normal(size=(8, 7))[rng.integers(0, 8, n)] + rng.normal(size=(n, 7)) / 50
    else:
        x = np.round(rng.normal(size=(n, 3)))
        x[:90] = x[0]  # a third of the rows is one vector
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    want = brute(rows, 5, lambda i: i % 3 == 0)
    assert run(spark, rows, data_rows=50, query_rows=20, pivots=6, part_rows=90) == want


def test_pairs_of_blocks_stay_flat(spark):
    """Ten times the rows, in blocks of the same size: a query block meets about as many data blocks."""
    rng = np.random.default_rng(6)
    met = []
    for n in (2000, 20000):
        centres = rng.normal(size=(n // 1000 * 2, 12))
        x = centres[rng.integers(0, len(centres), n)] + rng.normal(size=(n, 12)) / 40
        x /= np.sqrt((x**2).sum(1, keepdims=True))
        df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
        told = {}
        out = top_k(df, F.col("vec_id") % 50 == 0, k=5, data_rows=200, query_rows=20, part_rows=4000, report=told).collect()
        assert len(out) == 5 * (n // 50)
        print(n, told)
        met.append(told["pairs"] / told["query_blocks"])
        assert told["data_blocks"] >= n // 200
    assert met[1] <= 2 * met[0]


def test_blocks_cut_along_the_tree():
    x = np.random.default_rng(3).integers(-9, 9, (1000, 2))
    for points in (x, np.zeros((500, 2), int), x[:7], x[:0]):
        parts = cut(points, 64)
        assert sorted(np.concatenate([np.zeros(0, int), *parts]).tolist()) == list(range(len(points)))
        assert all(0 < len(p) <= 64 for p in parts)


def test_extra_columns(spark):
    rows = [(i, [float(i % 5), 1.0], "x", "y") for i in range(12)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, id string, cell string").withColumn("query", F.lit("q")).withColumn("v", F.lit(1))
    assert sorted(map(tuple, top_k(df, F.col("vec_id") % 3 == 0, k=5).collect())) == brute([r[:2] for r in rows], 5, lambda i: i % 3 == 0)


def test_odd_rows(spark):
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, None), (2, []), (3, [float("nan"), 1.0]), (4, [None, 1.0]), (5, [1.0, -1.0]), (6, [float("inf"), 0.0]), (None, [1.0, 1.0]), (9, [1.0, 2.0, 3.0]), (12, [0.0, 0.0]), (15, [1e12, 1.0])]
    assert run(spark, rows) == brute(rows, 5, lambda i: i % 3 == 0)
    assert run(spark, rows[:1]) == [] and run(spark, []) == []


def test_tree_covers():
    x = np.random.default_rng(2).normal(size=(500, 4))
    t = CoverTree(x, leaf=10)
    for c, r, a, b in zip(t.centre, t.radius, t.begin, t.end, strict=True):
        assert np.sqrt(((x[t.order[a:b]] - x[c]) ** 2).sum(1)).max() <= r + 1e-9
    assert sorted(t.order) == list(range(500))
