"""Links by shingles: no false ones, and their recall by brute force."""

from collections import defaultdict
from itertools import combinations
from pathlib import Path

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from weftline.llm.shingles import shingle_links


def shingles(text, words=5):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = low.replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ")
    w = [x for x in w if x]
    return frozenset(" ".join(w[i : i + words]) for i in range(max(len(w) - words + 1, 1))) if w else frozenset()


def near_pairs(texts, least):
    """Pairs of different sets of so much similarity, all of them: two that are so
    near share one of the first 1 - least of either set, in any one order."""
    sets, holders = {i: s for i, t in texts.items() if (s := shingles(t))}, defaultdict(list)
    for i, s in sets.items():
        order = sorted(s)
        for x in order[: len(s) - int(least * len(s) - 1e-9)]:
            holders[x].append(i)
    found = set()
    for own in holders.values():
        found |= {(a, b) for a, b in combinations(sorted(own), 2) if (a, b) not in found and len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b]) - 1e-9}
    return found


def groups(links, ids):
    label = {i: i for i in ids}

    def top(i):
        while label[i] != i:
            label[i] = label[label[i]]
            i = label[i]
        return i

    for a, b in links:
        label[max(top(a), top(b))] = min(top(a), top(b))
    return {i: top(i) for i in ids}


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_recall_on_documents(spark, size):
    if not Path(f"/root/testdata/{size}").exists():
        pytest.skip("no test tables")
    docs = spark.read.parquet(f"/root/testdata/{size}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    want = near_pairs(texts, 0.8)
    got = {(min(r), max(r)) for r in map(tuple, shingle_links(docs.select(F.col("doc_id").alias("node"), "text")).collect())}
    assert got <= want  # every link is verified
    assert groups(got, texts) == groups(want, texts)
    # and the stage keeps one of each group
    kept = {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect()}
    for a, b in want:
        assert not (a in kept and b in kept)


def test_mixed_buckets_and_odd_texts(spark, odd):
    """Texts that share most of a passage, in families of near copies; recall counts."""
    passage = " ".join(f"p{i}" for i in range(60))
    texts = {}
    for family in range(60):
        own = [f"f{family}x{i}" for i in range(30)]
        for k in range(4):
            words = [*own]
            words[k * 7] = "changed"
            texts[family * 10 + k] = f"{passage} {' '.join(words)}"
    want = near_pairs(texts, 0.8)
    df = spark.createDataFrame(list(texts.items()), "node long, text string")
    got = {(min(r), max(r)) for r in map(tuple, shingle_links(df).collect())}
    linked, real = groups(got, texts), groups(want, texts)
    assert got <= want and sum(linked[a] == linked[b] for a, b in want) >= 0.9 * len(want) and len(set(real.values())) <= len(texts)
    rows = odd.where("doc_id is not null").select(F.col("doc_id").alias("node"), "text")
    assert {tuple(r) for r in shingle_links(rows).collect()} == {(11, 10)}
    assert shingle_links(rows.limit(0)).count() == 0


def test_no_link_is_left_out_where_lists_are_crowded(spark, monkeypatch):
    """Texts that are all almost near enough, so that heads of lists are unlike most
    members; small lists force further heads."""
    from weftline.llm import shingles as S

    monkeypatch.setattr(S, "LIST", 8)
    passage = " ".join(f"p{i}" for i in range(100))
    texts = {}
    for family in range(150):
        for k in range(2):
            own = [f"f{family}x{i}" for i in range(24)]
            own[k * 11] = "changed"
            texts[family * 10 + k] = f"{passage} {' '.join(own)}"
    want = near_pairs(texts, 0.8)
    assert len(want) == 150
    df = spark.createDataFrame(list(texts.items()), "node long, text string").repartition(4)
    got = {(min(r), max(r)) for r in map(tuple, shingle_links(df).collect())}
    assert got == want


def test_unlike_texts_form_no_sets(spark, monkeypatch):
    """Texts that share a rare passage by chance meet on a list, but their sketches part
    them: sets, which are larger than the texts, are formed of near copies only."""
    from weftline.llm import shingles as S

    texts = {i: " ".join([f"t{i}x{k}" for k in range(60)] + [f"p{i % 60}x{k}" for k in range(20)]) for i in range(120)}
    formed, sets_of = [], S.sets_of

    def counted(*args):
        out = sets_of(*args)
        formed.append(out.count())
        return out

    monkeypatch.setattr(S, "sets_of", counted)
    links = lambda: {tuple(sorted(r)) for r in map(tuple, shingle_links(spark.createDataFrame(list(texts.items()), "node long, text string")).collect())}
    assert links() == set() and sum(formed) == 0
    texts[200] = texts[7] + " one"
    assert links() == {(7, 200)} and sum(formed) == 2


@pytest.mark.parametrize("least", [0.8, 0.55])
def test_sketches_lose_no_link(spark, least):
    """Sizes on both sides of powers of two, so that one sketch is folded; sets of all grades
    of likeness, and those that are just alike enough."""
    import random

    import numpy as np

    from weftline.llm import shingles as S

    rng, rows = random.Random(5), []
    for n in (1, 5, 63, 64, 65, 120, 128, 140, 300, 1025):
        for _ in range(12):
            x = rng.sample(range(1 << 62), n)
            shared = rng.randrange(n + 1) if rng.random() < 0.5 else int(np.ceil(least * n))
            y = x[:shared] + rng.sample(range(1 << 62), rng.randrange(n // 3 + 1))
            h, sizes = np.array(sorted(x) + sorted(y), np.uint64), np.array([len(x), len(y)])
            (a, b), alike = S.set_sketches(h, sizes).to_pylist(), len({*x} & {*y}) >= least * len({*x} | {*y}) - 1e-9
            rows.append((len(x), a, len(y), b, alike))
    df = spark.createDataFrame(rows, "nx int, bx array<long>, ny int, by array<long>, alike boolean")
    got = df.select("alike", S._sketches_near(least).alias("near")).collect()
    fold = lambda b: F.expr(f"transform(sequence(0, {S.FEW - 1}), i -> aggregate(filter({b}, (x, k) -> k % {S.FEW} = i), 0L, (a, x) -> a ^ x))")
    short = df.select("alike", F.struct(fold("bx").alias("few"), F.col("nx").alias("n")).alias("a"), F.struct(fold("by").alias("few"), F.col("ny").alias("n")).alias("b"))
    assert short.where(F.col("alike") & ~S._few_near(F.col("a"), F.col("b"), least)).count() == 0
    assert all(r.near for r in got if r.alike) and any(r.alike for r in got) and not all(r.near for r in got)


def test_who_may_meet_stays_on_the_list(spark):
    import random

    from weftline.llm import shingles as S

    rng, rows = random.Random(8), []
    for key in range(150):
        for c in rng.sample(range(1000), rng.randrange(1, 7)):
            n = rng.choice([1, 4, 20, 22, 25, 30, 100])
            rows.append((key, c, n, rng.randrange(n - -(-8 * n // 10) + 1)))
    df = spark.createDataFrame(rows + rows[:40], "key long, class long, n int, pos int")
    a, b = (df.select("key", F.struct("class", "n", "pos").alias(c)) for c in "ab")
    meet = a.join(b, "key").where((F.col("a")["class"] != F.col("b")["class"]) & S._may_meet(F.col("a"), F.col("b"), 0.8))
    want = {(r.key, r.a["class"]) for r in meet.select("key", "a").collect()}
    got = S._with_partners(df, 0.8).collect()
    assert want and want <= {(r.key, r["class"]) for r in got} and len(got) == len({(r.key, r["class"]) for r in got}) < len(rows)
    heads = {k: min(r["class"] for r in got if r.key == k) for k in {r.key for r in got}}
    assert all(r.head["class"] == heads[r.key] for r in got)
