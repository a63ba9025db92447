import json

import pytest
from pyspark.sql import functions as F

from weftline.operators import extraction as E
from weftline.operators import posts, semantic, spelling, topics

C = "array<struct<comment_id:string,body:string,score:bigint>>"
SCHEMA = f"pos long, post_id string, title string, category string, url string, selftext string, comments {C}"


def threads(spark):
    return spark.createDataFrame([(0, "p0", "Belts", "c", "u", "You should match them. Fine", [("1", "Never mind", 3)]), (1, "p1", "fail", "c", None, None, []), (2, None, "plain", "d", "u", "x" * 600, [("9", "[deleted]", 8), ("8", "b " * 400, 2)])], SCHEMA)


def test_prompts(spark):
    p = [r.x for r in threads(spark).select(E.forum_prompt(F.col("title"), F.col("selftext"), F.col("comments")).alias("x")).collect()]
    assert "Title: Belts\n\nPost Content: You should match them. Fine\n\nTop Comment: Never mind\n\nReturn" in p[0]
    assert p[1].endswith("Title: fail\n\nReturn only valid JSON. [/INST]") and "x" * 500 + "..." in p[2]
    d = [r.x for r in threads(spark).select(E.digest_prompt(F.col("post_id"), F.col("title"), F.col("selftext"), F.col("comments")).alias("x")).collect()]
    assert "- (3↑) [1] Never mind For each" in d[0] and "\n" not in d[0] and "deleted" not in d[2] and len(d[2]) <= 9000
    assert threads(spark).select(E.web_prompt(F.col("title")).alias("x")).first().x.startswith("<s>[INST] ")


def flaky(prompts):
    if any("Title: fail" in p for p in prompts):
        if len(prompts) > 1:
            raise RuntimeError("batch")
        raise RuntimeError("no answer")
    return ['{"has_fashion_rule": true, "rules": ["a",],}' if "Belts" in p else "garbage" * 60 for p in prompts]


def test_extraction_keeps_every_post(spark):
    rows = {r.title: r for r in E.extract_posts(threads(spark), flaky).collect()}
    good, failed, bad = rows["Belts"], rows["fail"], rows["plain"]
    assert good.success and tuple(good.extraction) == (True, ["a"], "none", "low") and good.error is None
    assert not failed.success and failed.error == "no answer" and failed.raw_response is None and failed.url == ""
    assert not bad.success and bad.error.startswith("Failed to parse JSON") and len(bad.raw_response) == 300 and bad.post_id == ""
    stub = {r.title: r for r in E.extract_posts(threads(spark)).collect()}
    assert stub["Belts"].extraction.has_fashion_rule and not stub["plain"].extraction.has_fashion_rule


def test_statistics(spark):
    df = spark.createDataFrame([(i, i % 3 > 0, i % 2 == 0, None if i == 4 else "c") for i in range(250)], "pos long, success boolean, has_rule boolean, category string")
    s = E.extraction_stats(df).first()
    assert s.successful_extractions + s.failed_extractions == 250 and s.posts_with_rules + s.posts_without_rules == s.successful_extractions
    assert {r.value for r in E.distribution(df, "category").collect()} == {"c", "unknown"}
    assert [r.seen for r in E.running_stats(df).orderBy("seen").collect()] == [100, 200]
    fine = [tuple(r) for r in E.running_stats(df, every=10, wide=3).orderBy("seen").collect()]
    assert fine == [tuple(r) for r in E.running_stats(df, every=10).orderBy("seen").collect()] and len(fine) > 6


def test_ids_and_novelty(spark):
    df = spark.createDataFrame([(0, " A "), (0, "a"), (1, "A"), (1, "new"), (2, "known")], "post_pos long, t string").withColumn("rule_id", E.rule_id("t", F.lit("p")))
    known = df.where("t = 'known'").select("rule_id")
    assert sorted((r.post_pos, r.t) for r in E.novel(df, known).collect()) == [(0, " A "), (0, "a"), (1, "new")]
    own = spark.createDataFrame([("auto",), ("",), (None,), ("x",)], "i string").select(E.filled_id("i", F.lit("t"), F.lit("p")).alias("x")).collect()
    assert len({r.x for r in own[:3]}) == 1 and own[3].x == "x"


def digest_model(prompts):
    rule = {"rule_id": "auto", "text": "Match", "rule_type": "guideline", "categories": ["fit"], "context_tags": [], "confidence": 0.5, "citations": [{"source_post_id": "x", "snippet": "s"}]}
    return [json.dumps({"rules": [rule]}) if "STRICT" in p or "Belts" in p else "{}" for p in prompts]


def test_digests_retry_and_drop_known(spark):
    none = spark.createDataFrame([], "rule_id string")
    one = E.digests(threads(spark), digest_model, none, retries=0, now=F.to_timestamp(F.lit("2024-01-02 03:04:05")))
    assert [(r.source_post_id, r.extracted_at) for r in one.collect()] == [("p0", "2024-01-02T03:04:05+00:00")]
    two = E.digests(threads(spark).where("post_id is not null"), digest_model, none)
    assert sorted(r.source_post_id for r in two.collect()) == ["p0", "p1"]
    assert E.digests(threads(spark), digest_model, one.select("rule_id"), retries=0).count() == 0


def test_digest_errors(spark):
    bad = spark.range(1).select(E.digest_errors(F.lit("no"), F.array(F.lit("hat")), F.lit(1.5), F.lit(0), F.lit("x")).alias("e")).first().e
    assert bad == ["rule_type", "categories", "confidence", "citations", "safety"]
    fine = spark.range(1).select(E.digest_errors(F.lit("trend"), F.array(F.lit("fit")), F.lit(1.0), F.lit(1), F.lit(None).cast("string")).alias("e")).first().e
    assert fine == []


def test_prototypes_and_encoder(spark):
    encode = semantic.encoder_udf(semantic.hash_encode)
    df = spark.createDataFrame([(0, "red shoes"), (1, "blue hat"), (2, None)], "vec_id long, t string").withColumn("embedding", encode("t"))
    best = {r.vec_id: r.similarity for r in semantic.best_prototype(df, df.where("vec_id = 0").select(F.col("embedding").alias("prototype"))).collect()}
    assert best[0] == pytest.approx(1.0) and best[2] == 0.0
    flags = spark.createDataFrame([(0.6, 0.5), (0.6, 0.7), (0.5, 0.1)], "r double, p double").select(semantic.is_rule(F.col("r"), F.col("p")).alias("x")).collect()
    assert [f.x for f in flags] == [True, False, False]


def test_silhouette(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    x, c = rng.normal(size=(60, 3)), np.append(rng.integers(0, 3, 59), 9)
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    s = []
    for i in range(60):
        same = (c == c[i]).sum() - 1
        if not same:
            s.append(0.0)
            continue
        a = d[i, c == c[i]].sum() / same
        b = min(d[i, c == k].mean() for k in set(c) - {c[i]})
        s.append((b - a) / max(a, b))
    df = spark.createDataFrame([(i, int(k), v.tolist()) for i, (k, v) in enumerate(zip(c, x, strict=True))], "vec_id long, label int, embedding array<double>")
    assert semantic.silhouette(df, block=7).first().silhouette == pytest.approx(np.mean(s))


def test_clusters(spark):
    rows = [(0, i, f"p{i}", cat, "t" * 400) for i, cat in enumerate(["b", "a", "a", "b", "c", "", None])]
    df = spark.createDataFrame(rows, "cluster int, pos int, post_id string, category string, clean_text string").repartition(3)
    got = semantic.cluster_categories(df, top=2).orderBy("rank").collect()
    assert [(r.category, r["count"]) for r in got] == [("b", 2), ("a", 2)]
    summary = semantic.cluster_summary(df, top=3).first()
    assert [e.post_id for e in summary.examples] == ["p0", "p1", "p2"] and len(summary.examples[0].excerpt) == 320
    scores = spark.createDataFrame([(6, 0.2), (7, 0.5), (8, 0.5)], "k int, silhouette double")
    doc = json.loads(semantic.serialized_scores(scores, semantic.cluster_summary(df), "m").first().document)
    assert doc["best_k"] == 7 and doc["cluster_summaries"][0]["cluster"] == 0
    points = spark.createDataFrame([(i, [float(i % 2), 1.0 - i % 2]) for i in range(20)], "vec_id long, embedding array<double>")
    assert semantic.kmeans_scan(points, range(2, 4))[0][0] == 2


def test_spelling(spark):
    docs = spark.createDataFrame([(1, "TEH cat, hte Cat; uniqlo zzzzzz ab 3"), (2, "")], "id int, text string")
    words = spark.createDataFrame([("the", 10), ("tea", 3), ("cat", 5)], "word string, freq long")
    got = {r.id: r.corrected for r in spelling.correct(docs, words, "id").collect()}
    assert got == {1: "THE cat, the Cat; uniqlo zzzzzz ab 3"}


def test_topics_and_zero_shot(spark):
    df = spark.createDataFrame([("red shoes red shoes", [("1", "blue hat blue hat", 1)])] * 8 + [(None, [("2", "", 1)])], f"title string, comments {C}")
    texts = topics.topic_texts(df)
    assert texts.count() == 16
    sizes, terms = topics.topic_terms(texts, k=2, top=3, min_docs=1)
    assert sum(r["size"] for r in sizes.collect()) == 16 and terms.count() == 6
    score = lambda t, labels: [[0.1, 0.7, 0.2] for _ in t]
    got = E.zero_shot(texts, score, n=4).collect()
    assert len(got) == 4 and {r.label for r in got} == {"advice"}
    assert posts.DELETED == "[deleted]"


def upper():
    return str.upper


def test_similarity_rules_and_tools(spark):
    from weftline.plans.pipelines import rules_by_similarity
    from weftline.session import need

    docs = spark.createDataFrame([(1, "You should wear a belt with the suit. The weather was fine for the whole day."), (2, "short")], "id int, text string")
    got = rules_by_similarity(docs, semantic.hash_encode, ["you should wear a belt with a suit"]).collect()
    assert [(r.id, r.pos, r.rule_type, r.word_count) for r in got] == [(1, 0, "general", 8)] and got[0].quality_score == int(got[0].similarity * 10)
    assert rules_by_similarity(docs, semantic.hash_encode, ["nothing alike"]).count() == 0
    df = spark.createDataFrame([("a",), (None,)], "t string")
    assert [r.x for r in df.select(spelling.mended("t", upper).alias("x")).collect()] == ["A", None]
    assert [r.x for r in df.select(spelling.mended("t").alias("x")).collect()] == ["a", None]
    need("json")
    with pytest.raises(RuntimeError):
        need("no_such_module_here", "install it")


def test_silhouette_bounds(spark):
    import time

    import numpy as np

    def points(n, seed):
        rng = np.random.default_rng(seed)
        middles = rng.normal(size=(5, 4)) * 3
        c = rng.integers(0, 5, n)
        return spark.createDataFrame([(i, int(k), (middles[k] + rng.normal(size=4)).tolist()) for i, k in enumerate(c)], "vec_id long, label int, embedding array<double>")

    df = points(800, 1)
    df = df.union(df.limit(5)).union(spark.createDataFrame([(9000, 7, [0.0] * 4), (9001, None, [0.0] * 4), (9002, 1, None)], df.schema))
    exact = semantic.silhouette(df.where("vec_id < 800 or label = 7").dropDuplicates(["vec_id"]), block=64).first().silhouette
    wide = semantic.silhouette_bounds(df.dropDuplicates(["vec_id"]), cells=16, sample=5000).first()
    assert wide.low <= exact <= wide.high and wide.n == 801 and wide.k == 6
    assert wide.sampled == pytest.approx(exact)  # the sample is everything here
    narrow = semantic.silhouette_bounds(df.dropDuplicates(["vec_id"]), cells=400).first()
    assert narrow.low <= exact <= narrow.high and narrow.high - narrow.low < 0.6 * (wide.high - wide.low)
    point = semantic.silhouette_bounds(df.dropDuplicates(["vec_id"]), cells=5000).first()
    assert point.silhouette == pytest.approx(exact, abs=1e-6) and point.high - point.low < 1e-4  # what is left allows for rounding
    none = semantic.silhouette_bounds(df.limit(0)).first()
    assert none.n == 0 and none.silhouette is None
    one = semantic.silhouette_bounds(df.where("label = 7")).first()
    assert (one.silhouette, one.sampled, one.n) == (0.0, 0.0, 1)
    took = []
    for n in (2000, 20_000):
        rows = points(n, 2)
        rows.count()
        began = time.time()
        semantic.silhouette_bounds(rows, cells=32, sample=100).collect()
        took.append(time.time() - began)
    assert took[1] < 20 * took[0]  # ten times the rows, where all pairs take a hundred times


def test_rules_of_pages(spark):
    def model(prompts):
        if any("down" in p for p in prompts):
            raise OSError("model down")
        return ['{"has_fashion_rule": true, "rules": [{"rule_text": "Wear it well", "word_count": 9}, {"rule_text": null}, {"rule_text": "A b"}]}' if "belt" in p else '{"has_fashion_rule": true, "rules": null}' for p in prompts]

    pages = spark.createDataFrame([(1, "belt"), (2, None), (3, "down"), (4, "")], "url long, text string")
    got = sorted(map(tuple, E.extract_pages(pages, model).select("url", "pos", "rule_text", "word_count", "error").collect()))
    assert got == [(1, 0, "Wear it well", 9, None), (1, 1, None, 0, None), (1, 2, "A b", 2, None), (3, 0, None, None, "model down")]
    assert E.extract_pages(pages.limit(0), model).count() == 0


def test_totals_of_filtered_rules(spark):
    from weftline.operators import rules

    found = spark.createDataFrame([("Always match your belt to your shoes.", 1), ("no", 2), (None, 3)], "rule_text string, id long")
    kept, totals = rules.filtered(found)
    assert [r.id for r in kept.collect()] == [1] and tuple(totals.first()) == (1, 2)
    assert tuple(rules.filtered(found.limit(0))[1].first()) == (0, 0)


def test_silhouette_in_ranges(spark):
    import numpy as np

    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(90, 4)), 1)
    x[20:40] = x[0]  # copies
    c = np.append(rng.integers(0, 2, 89), 3)
    rows = [(i, int(c[i]), x[i].tolist()) for i in range(90)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    s = []
    for i in range(89):
        a, b = d[i, c == c[i]].sum() / ((c == c[i]).sum() - 1), min(d[i, c == k].mean() for k in set(c) - {c[i]})
        s.append((b - a) / max(a, b))
    for block in (1000, 20, 3):  # one range; clusters over several ranges; many
        got = semantic.silhouette(df, block=block).first()
        assert got.k == 3 and got.silhouette == pytest.approx(sum(s) / 90, abs=1e-12)
    assert semantic.silhouette(df.limit(0)).first().silhouette is None


def test_pieces_of_wide_rows_are_bounded():
    import pandas as pd

    frames = [pd.DataFrame({"x": range(700)}), pd.DataFrame({"x": []})]
    for wide in (1, 4096, 1 << 16, 1 << 22):  # numbers of a row
        sizes = [len(f) for f in semantic._pieces(frames, wide)]
        assert sum(sizes) == 700 and max(sizes) * wide <= max(1 << 20, wide)
