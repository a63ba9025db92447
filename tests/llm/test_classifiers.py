import random

from weftline.llm.language import codewords, fit_language, predict_language
from weftline.llm.quality import fit_quality, score_quality


def texts(n, seed):
    rng = random.Random(seed)
    good = ["river", "stone", "walked", "slowly", "under", "bright", "morning", "light", "the", "a"]
    out = []
    for i in range(n):
        w = [rng.choice(good) for _ in range(rng.randrange(8, 60))]
        if i % 4 == 0:
            w = [x.upper() + "!!" for x in w] if i % 8 else [w[0]] * 30
        out.append((i, " ".join(w), int(i % 4 != 0)))
    return out


def test_quality_learns(spark):
    rows = spark.createDataFrame(texts(240, 1), "doc_id long, text string, label int")
    model = fit_quality(rows, rows, max_train=150)
    held = spark.createDataFrame(texts(120, 2), "doc_id long, text string, label int")
    scored = score_quality(held, model).collect()
    right = sum((r.score >= 0.3) == bool(r.label) for r in scored)
    assert right >= 115 and all(0 <= r.score <= 1 for r in scored)
    assert sorted(map(tuple, score_quality(held, model).collect())) == sorted(map(tuple, scored))


def test_quality_odd_rows(spark, odd, empty):
    rows = spark.createDataFrame(texts(60, 1), "doc_id long, text string, label int")
    model = fit_quality(rows, rows.selectExpr("doc_id", "if(doc_id = 5, null, label) as label"))
    out = score_quality(odd, model, score="quality").collect()
    assert len(out) == odd.count() and all(0 <= r.quality <= 1 for r in out)
    by_text = {}
    for r in out:
        assert by_text.setdefault(r.text, r.quality) == r.quality
    assert by_text[None] == by_text[""]
    assert score_quality(empty, model, score="quality").count() == 0
    assert fit_quality(rows, rows.limit(0)) is None
    assert {r.quality for r in score_quality(odd, None, score="quality").collect()} == {0.5}


def test_codewords_differ():
    for k in (2, 3, 4, 7, 12, 30):
        code = codewords(k)
        assert len({tuple(r) for r in code.tolist()}) == k
        assert all(len(set(c)) == 2 for c in code.T.tolist())


def test_language(spark, odd, empty):
    words = {"aa": "the of and river stone", "bb": "der und nicht schön über", "cc": "que para niño según los"}
    rng = random.Random(3)
    make = lambda n: [(i, " ".join(rng.choice(words[k].split()) for _ in range(rng.randrange(3, 40))), k) for i in range(n) for k in words]
    model = fit_language(spark.createDataFrame(make(60), "doc_id long, text string, lang string"))
    out = predict_language(spark.createDataFrame(make(40), "doc_id long, text string, truth string"), model).collect()
    assert sum(r.truth == r.lang_pred for r in out) >= 116 and all(0 <= r.score <= 1 for r in out)
    got = predict_language(odd, model).collect()
    assert len(got) == odd.count()
    for r in got:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred in words) == letters and (letters or (r.lang_pred, r.score) == ("und", 0.0))
    assert predict_language(empty, model).count() == 0
    assert fit_language(empty) is None
    assert {r.lang_pred for r in predict_language(odd, None).collect()} == {"und"}
    one = fit_language(spark.createDataFrame([(1, "hallo", "de")], "doc_id long, text string, lang string"))
    assert predict_language(odd, one).where("lang_pred not in ('de', 'und')").count() == 0
