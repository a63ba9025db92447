import hashlib
import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from weftline.llm.suffixes import kasai, remove_repeats, repeated_windows, suffix_array


def plain(rows, size):
    seen, out = set(), {}
    for i, _, text in sorted({(i, hashlib.sha256((t or "").encode()).hexdigest(), (t or "").encode()) for i, t in rows if i is not None}):
        cover = np.zeros(len(text) + 1, int)
        for p in range(len(text) - size + 1):
            w = text[p : p + size]
            if w in seen:
                cover[p] += 1
                cover[p + size] -= 1
            seen.add(w)
        gone = np.cumsum(cover)[: len(text)] > 0
        kept = bytes(np.frombuffer(text, np.uint8)[~gone])
        out[i, text] = (len(text), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum()), hashlib.sha256(kept).hexdigest())
    return out


def run(spark, rows, size=100):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = remove_repeats(df.withColumn("gone", F.lit("x")), size=size).collect()
    assert len(found) == len(rows)
    digest = lambda x: hashlib.sha256(x).hexdigest()
    assert all(digest(bytes(r.kept)) == r.kept_sha256 and len(r.spans) == r.n_spans for r in found)
    return sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found)


def corpus(seed):
    rng = random.Random(seed)
    piece = lambda n: "".join(rng.choice("abé \n") for _ in range(n))
    pool = [piece(rng.randrange(60, 400)) for _ in range(12)]
    rows = [(i, "".join(rng.choice(pool)[rng.randrange(40) :] if rng.random() < 0.6 else piece(rng.randrange(150)) for _ in range(rng.randrange(7)))) for i in range(120)]
    rows += [(500 + i, rows[i][1]) for i in range(20)]
    return rows + [(900, "a" * 700), (901, "ab" * 300), (902, "a" * 150), (903, None), (904, ""), (905, "x" * 99), (906, "x" * 100), (907, "x" * 100)]


def test_equals_brute_force(spark):
    for seed, size in ((1, 100), (2, 60)):
        rows = corpus(seed)
        assert run(spark, rows, size) == wanted(rows, size)


def wanted(rows, size=100):
    of = plain(rows, size)
    return sorted((i, *of[i, (t or "").encode()]) for i, t in rows)


def test_rows_that_share_an_id(spark):
    rng = random.Random(3)
    piece = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    a, b = piece(500), piece(568)
    rows = [(1, a), (5, a), (5, b), (5, b), (5, a[:200] + b[:150]), (6, b[100:] + a[:120]), (6, b), (7, piece(90) + b)]
    assert run(spark, rows) == wanted(rows)


def test_long_texts(spark):
    """Texts above the size of a working chunk, with repeats inside and across."""
    rng = random.Random(9)
    long = "".join(rng.choice("abcdefgh \n") for _ in range(600_000))
    rows = [(1, long), (2, "x" + long[300_000:] + long[:100_000]), (3, long[5:] + long[7:20_000])]
    got = {r[0]: r[1:4] for r in run(spark, rows)}
    assert got[1] == (600_000, 0, 0) and got[2] == (400_001, 400_000, 1) and got[3] == (len(rows[2][1]), len(rows[2][1]), 1)


@settings(max_examples=80, deadline=None)
@given(st.binary(max_size=200) | st.text(alphabet="ab", max_size=200).map(str.encode))
def test_suffix_array_and_prefixes(data):
    text = np.frombuffer(data, np.uint8)
    order = suffix_array(text)
    # a suffix that ends early and one that goes on with zero bytes sort by length
    assert order.tolist() == sorted(range(len(data)), key=lambda i: data[i:]) or 0 in data
    if len(data) and 0 not in data:
        lanes = np.arange(0, len(data), 13)
        common = kasai(text, order, lanes, np.diff(np.append(lanes, len(data))), 20)
        for a, b in zip(order[:-1].tolist(), order[1:].tolist(), strict=True):
            n = 0
            while n < 20 and max(a, b) + n < len(data) and data[a + n] == data[b + n]:
                n += 1
            assert common[b] == n


def test_several_arrays_merge_to_the_same():
    rng = random.Random(7)
    pool = ["".join(rng.choice("ab") for _ in range(300)) for _ in range(4)]
    bodies = [(rng.choice(pool)[o:] * 2)[: 99 + c].encode() for o, c in [(rng.randrange(50), rng.randrange(1, 77)) for _ in range(200)]]
    count = np.array([len(b) - 99 for b in bodies])
    rank = np.random.default_rng(0).permutation(len(bodies))
    whole = repeated_windows(bodies, rank, count, 100)
    assert (repeated_windows(bodies, rank, count, 100, limit=700) == whole).all()
    keys = np.zeros(len(bodies), np.uint64)
    assert (repeated_windows(bodies, rank, count, 100, limit=700, key=keys) == whole).all()


def test_odd_rows(spark, odd, empty):
    out = remove_repeats(odd)
    rows = [(r.doc_id, r.text) for r in odd.collect() if r.doc_id is not None]
    want = wanted(rows)
    got = out.collect()
    assert len(got) == odd.count()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got if r.doc_id is not None) == want
    assert all(hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256 and len(r.spans) == r.n_spans for r in got)
    assert remove_repeats(empty).count() == 0
