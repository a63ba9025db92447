import math
import random
import re

import pytest
from pyspark.sql import functions as F

from weftline.llm.mixing import mix_sources, sums_before, take_copies


def targets(sizes, weights=(1, 2, 3), most=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, out, left = sum(sizes.values()), {}, set(names)
    while left:
        rest, weight = total - sum(out.values()), sum(w[s] for s in left)
        over = [s for s in left if rest * w[s] / weight > most * sizes[s]]
        if not over:
            return out | {s: rest * w[s] / weight for s in left}
        out |= {s: most * sizes[s] for s in over}
        left -= set(over)
    return out


def test_targets_and_rates(spark):
    rows = [(i, "w " * (1 + i * 7 % 90), ["b", "a", "ä", None, "Z", "b"][i % 6] if i < 900 else "tiny") for i in range(903)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mix_sources(df).collect()
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(t.split())
    want, took = targets(sizes), dict.fromkeys(sizes, 0)
    for r in out:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source], rel=1e-9)
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.copies * r.size
        took[r.source] += r.taken
    for s in sizes:
        assert abs(took[s] - want[s]) <= max(0.01 * want[s], 90)
    again = mix_sources(df.repartition(7)).collect()
    assert sorted(map(tuple, again), key=str) == sorted(map(tuple, out), key=str)


def dual(rows, most=3.0, ridge=0.01):
    """Rate of each (source, class) by a plain solver: the shared multiplier by
    bisection, each source's own by bisection inside."""
    cells, want = {}, targets({s: sum(n for n, x in rows if x == s) for s in {x for _, x in rows}})
    for n, s in rows:
        c = (s, math.floor(8 * math.log2(n + 1)))
        cells[c] = (cells.get(c, (0, 0))[0] + 1, cells.get(c, (0, 0))[1] + n)
    raw = {c: math.log2(w / k + 1) for c, (k, w) in cells.items()}
    tokens = sum(w for _, w in cells.values())
    mean = sum(w * raw[c] for c, (_, w) in cells.items()) / tokens
    spread = math.sqrt(sum(w * (raw[c] - mean) ** 2 for c, (_, w) in cells.items()) / tokens)
    g = {c: (raw[c] - mean) / spread for c in cells}
    size = {s: sum(w for c, (_, w) in cells.items() if c[0] == s) for s in want}

    def rates(mu):
        out = {}
        for s, t in want.items():
            own = [c for c in cells if c[0] == s]
            low, high = -40.0, 40.0
            for _ in range(200):
                lam = (low + high) / 2
                got = sum(cells[c][1] * min(most, math.exp(lam + mu * g[c])) for c in own)
                low, high = (lam, high) if got < t else (low, lam)
            out |= {c: most if t >= most * size[s] else min(most, math.exp(lam + mu * g[c])) for c in own}
        return out

    low, high = -20.0, 20.0
    for _ in range(80):
        mu = (low + high) / 2
        off = sum(cells[c][1] * r * g[c] for c, r in rates(mu).items()) + ridge * tokens * mu
        low, high = (mu, high) if off < 0 else (low, mu)
    return rates(mu), want


def test_rates_solve_the_dual(spark):
    rng = random.Random(5)
    pairs = [(1 + int(rng.lognormvariate({"a": 2, "b": 3, "c": 4}[s], 0.7)), s) for s in ("a", "b", "c") for _ in range(150)]
    pairs += [(5, "d")] * 3
    rates, want = dual(pairs)
    df = spark.createDataFrame([(i, "w " * n, s) for i, (n, s) in enumerate(pairs)], "doc_id long, text string, source string")
    out = mix_sources(df).collect()
    for r in out:
        assert r.rate == pytest.approx(rates[r.source, math.floor(8 * math.log2(r.size + 1))], abs=1e-5)
    assert len({round(r.rate, 6) for r in out if r.source == "b"}) > 3  # documents of a source differ
    for s in want:
        assert abs(sum(r.taken for r in out if r.source == s) - want[s]) <= max(0.01 * want[s], 30)


def test_rows_that_differ_in_other_columns(spark):
    rows = [(1, "a b c", s, x) for s in ("a", "b") for x in range(4)] * 2 + [(2, "d e f g", "c", 0)] * 5
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, __mark int")
    out = mix_sources(df)
    taken = take_copies(df, out)
    assert taken.columns == df.columns
    by = lambda x, n: sorted((r.source, r[1]) for r in x.groupBy("source").agg(n).collect())
    assert by(taken, F.count("*")) == by(out.where("copies > 0"), F.sum("copies"))


def test_sums_before(spark):
    rows = spark.range(1000).selectExpr("id", "id * 7 % 1000 as x").repartition(9)
    out = sums_before(rows, [F.col("x").desc()], {"n": F.lit(1), "t": F.col("x")}).collect()
    assert all(r.n == 999 - r.x and r.t == sum(range(r.x + 1, 1000)) for r in out) and len(out) == 1000


def test_odd_rows(spark, odd, empty):
    out = mix_sources(odd).collect()
    assert len(out) == odd.count()
    sizes = sorted(len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in odd.collect())
    assert sorted(r.size for r in out) == sizes
    assert mix_sources(empty).count() == 0
    taken = take_copies(odd, mix_sources(odd))
    assert taken.columns == odd.columns and taken.count() == sum(r.copies for r in out)
    none = spark.createDataFrame([(1, None, "a"), (2, "", "a")], "doc_id long, text string, source string")
    assert {(r.target, r.taken) for r in mix_sources(none).collect()} == {(0.0, 0)}


def test_one_giant_document_leaves_no_gradient(spark):
    rows = [(i, "w " * (3 + i % 11), f"s{i % 7}") for i in range(600)] + [(600, "w " * 200_000, "s6"), (601, "w " * 200_000, "giant")]
    out = mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    cells = out.withColumn("class", F.floor(8 * F.log2(F.col("size") + 1))).groupBy("source", "class").agg(F.count("*").alias("n"), F.sum("size").alias("words"), F.first("rate").alias("rate"), F.first("target").alias("target"), F.first("source_size").alias("size")).collect()
    raw = [math.log2(c.words / c.n + 1) for c in cells]
    tokens = sum(c.words for c in cells)
    mean = sum(c.words * x for c, x in zip(cells, raw, strict=True)) / tokens
    spread = math.sqrt(sum(c.words * (x - mean) ** 2 for c, x in zip(cells, raw, strict=True)) / tokens)
    g = [(x - mean) / spread for x in raw]
    # tilted rates of one source give the multiplier; the gradient at it is zero
    pairs = [(a, b) for a in range(len(cells)) for b in range(len(cells)) if cells[a].source == cells[b].source and g[b] - g[a] > 0.2 and 1e-300 < cells[a].rate < 3 - 1e-9 and 1e-300 < cells[b].rate < 3 - 1e-9]
    mus = [(math.log(cells[b].rate) - math.log(cells[a].rate)) / (g[b] - g[a]) for a, b in pairs]
    assert mus and max(mus) - min(mus) < 1e-6 * max(1, abs(mus[0]))
    shared = sum(c.words * c.rate * x for c, x in zip(cells, g, strict=True))
    assert abs(shared + 0.01 * tokens * mus[0]) < 1e-5 * tokens
    for s in {c.source for c in cells}:
        own = [c for c in cells if c.source == s]
        assert sum(c.words * c.rate for c in own) == pytest.approx(own[0].target, rel=1e-6)
