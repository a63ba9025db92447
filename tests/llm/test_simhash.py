import random
import re

import numpy as np
import pyarrow as pa
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from weftline.llm.common import byte_chunks
from weftline.llm.components import connected_components
from weftline.llm.simhash import fingerprints, near_duplicates, simhash_components, xxh64


def plain(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=120), min_size=1, max_size=6))
def test_xxh64(parts):
    data = np.frombuffer(b"".join(parts), np.uint8)
    ends = np.cumsum([len(p) for p in parts])
    got = xxh64(data, ends - [len(p) for p in parts], np.array([len(p) for p in parts]))
    assert got.tolist() == [xxhash.xxh64(p, seed=42).intdigest() for p in parts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aB é\n\t\x0b\x85\xa0z", max_size=90), max_size=8), st.integers(1, 200))
def test_fingerprints(texts, size):
    got = []
    for _, _, data, offsets in byte_chunks(pa.array(texts, pa.large_string()), size):
        got += fingerprints(data, offsets).tolist()
    assert got == [plain(t) for t in texts]


def smallest(prints):
    label = dict(prints)
    while True:
        before = dict(label)
        for a, pa_ in prints:
            for b, pb in prints:
                if bin((pa_ ^ pb) & (2**64 - 1)).count("1") <= 3:
                    label[a] = min(label.get(a, a), label.get(b, b))
        if before == label:
            return label


def test_components_equal_brute_force(spark):
    rng = random.Random(4)
    base = [rng.getrandbits(64) for _ in range(12)]
    prints = []
    for i in range(260):
        f = rng.choice(base)
        for _ in range(rng.choice([0, 1, 2, 3, 4, 6])):
            f ^= 1 << rng.randrange(64)
        prints.append((i, f))
    prints += [(1000 + i, base[0] ^ (1 << i)) for i in range(40)]  # one large group in few lists
    label = {i: i for i, _ in prints}
    while True:
        before = dict(label)
        for a, x in prints:
            label[a] = min(label[b] for b, y in prints if bin(x ^ y).count("1") <= 3)
        if label == before:
            break
    signed = [(i, f - 2**64 if f >= 2**63 else f) for i, f in prints]
    df = spark.createDataFrame(signed, "doc_id long, fp long")
    found = {r.fp: r.component for r in simhash_components(df).collect()}
    assert {i: found[f] for i, f in signed} == label
    split = {r.fp: r.component for r in simhash_components(df, most=3).collect()}
    assert split == found


def test_odd_rows(spark, odd, empty):
    out = near_duplicates(odd).collect()
    assert len(out) == odd.count()
    zero = [r for r in out if r.fingerprint == "0" * 16]
    assert {r.component_id for r in zero} == {0} and len(zero) == 4
    texts = {r.doc_id: r.text for r in odd.collect()}
    assert all(r.fingerprint == f"{plain(texts[r.doc_id]):016x}" for r in out)
    assert near_duplicates(empty).count() == 0


def test_connected_components(spark):
    edges = [(1, 2), (2, 3), (10, 9), (9, 8), (None, 1), (4, 4), (20, 21), (21, 22), (22, 3)] + [(100 + i, 101 + i) for i in range(30)]
    got = {r.id: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 20: 1, 21: 1, 22: 1, 8: 8, 9: 8, 10: 8} | {100 + i: 100 for i in range(31)}
