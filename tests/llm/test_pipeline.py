"""The pipeline against plain versions of its stages on a small corpus."""

import random

import corpus_pipeline
import pytest

from .test_lines import plain as plain_lines
from .test_packing import check
from .test_shingles import shingles
from .test_simhash import plain as print_of


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("corpus")
    rng = random.Random(9)
    words = ["river", "stone", "walked", "slowly", "under", "bright", "morning", "light", "the", "a", "of", "house"]
    line = lambda n: " ".join(rng.choice(words) for _ in range(n))
    rows = []
    for i in range(160):
        text = "\n".join(line(rng.randrange(4, 12)) for _ in range(rng.randrange(1, 8)))
        if i % 5 == 0:
            text = " ".join(w.upper() + "!!" for w in text.split())
        rows.append([i, text, "en", f"s{i % 4}", 0])
    for i in range(160, 180):  # copies, and near copies by one line
        rows.append([i, rows[i - 159][1] + ("\n" + line(6) if i % 2 else ""), "en", "s0", 0])
    rows.append([300, "", "en", "s1", 0])
    rows.append([301, None, None, None, None])
    for r in rows:
        r[4] = len(r[1] or "")
    docs = spark.createDataFrame([tuple(r) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, int(i % 5 != 0), 0) for i in range(160)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return str(d)


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    by = lambda df: {r.doc_id: r for r in df.collect()}
    kept = corpus_pipeline.quality(spark, docs, folder)
    assert kept.columns == columns
    good = by(kept)
    assert all(i in good for i in range(160) if i % 5) and not any(i in good for i in range(0, 160, 5))

    lines = corpus_pipeline.line_dedup(spark, kept, folder)
    assert lines.columns == columns
    gone, after = {(i, n) for i, _, n in plain_lines([(r.doc_id, r.text) for r in good.values()], 20)}, by(lines)
    assert set(after) == set(good)
    for i, r in good.items():
        want = None if r.text is None else "\n".join(x for n, x in enumerate(r.text.split("\n")) if (i, n) not in gone)
        assert after[i].text == want and after[i].n_chars == (None if want is None else len(want))

    unique = corpus_pipeline.near_dedup(spark, lines, folder)
    prints = {i: print_of(r.text) for i, r in after.items()}
    label = {i: i for i in prints}
    sets = {i: shingles(r.text) for i, r in after.items()}
    alike = lambda a, b: bin(prints[a] ^ prints[b]).count("1") <= corpus_pipeline.NEAR_BITS or len(sets[a] & sets[b]) >= max(1, corpus_pipeline.NEAR_SIMILARITY * len(sets[a] | sets[b]) - 1e-9)
    while True:
        new = {a: min(label[b] for b in prints if alike(a, b)) for a in prints}
        if new == label:
            break
        label = new
    assert unique.columns == columns and set(by(unique)) == {i for i in label if label[i] == i}

    mixed = corpus_pipeline.mixing(spark, unique, folder)
    assert mixed.columns == columns
    size = lambda t: len((t or "").split())
    assert abs(sum(size(r.text) for r in mixed.collect()) / sum(size(r.text) for r in unique.collect()) - 1) < 0.1

    packed = corpus_pipeline.packing(spark, mixed, folder)
    check(packed.collect(), [(r.doc_id, r.text) for r in mixed.collect()])


def test_near_dedup_of_repeated_ids(spark):
    rows = [(1, "one text of some words"), (1, "one text of some words"), (1, "quite another text with its own words"), (2, "one text of some words"), (3, "quite another text with its own words"), (None, "one text of some words"), (None, None), (4, None), (5, "")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, __mark string")
    got = sorted(map(tuple, corpus_pipeline.near_dedup(spark, docs, "").collect()), key=str)
    assert got == sorted([(1, rows[0][1], "x"), (1, rows[2][1], "x"), (4, None, "x"), (None, rows[5][1], "x"), (None, None, "x")], key=str)


def test_stages_take_odd_rows(spark, odd, folder):
    docs = odd
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        if name != "packing":
            assert docs.columns == odd.columns
    assert docs.count() > 0


def test_run_is_the_stages(spark, folder):
    got = corpus_pipeline.run(spark, folder)
    assert 4 <= len(corpus_pipeline.STAGES) <= 5 and got.count() > 0
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_dedup", "mixing", "packing"]
