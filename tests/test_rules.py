import pytest
from pyspark.sql import functions as F

from weftline.functions import lexicons as L
from weftline.operators import rules as R


def judge(spark, text, expr):
    return spark.createDataFrame([(text,)], "t string").select(expr.alias("x")).first().x


@pytest.mark.parametrize(
    ("text", "a", "b"),
    [("Your outfit is casual", "fit", "fit"), ("A color story", "color", "color"), ("formal shoes", "formality", "accessories"), ("a watch", "accessories", "accessories"), ("trend", "style", "style"), ("nothing", "general", "general"), ("", "general", "general")],
)
def test_types(spark, text, a, b):
    assert judge(spark, text, R.first_type("t")) == a
    assert judge(spark, text, R.first_type("t", L.TYPES_B)) == b


@pytest.mark.parametrize(
    ("text", "quality", "want"),
    [
        ("You should match your belt to your shoes", 8, []),
        ("Show about half an inch of cuff, you should", 8, ["Contains navigational content", "No fashion-related keywords found"]),
        ("buy it", 3, ["Too short: 2 words", "Low quality score: 3", "Contains promotional content", "No fashion-related keywords found", "No advice indicators found"]),
        ("", None, ["Too short: 0 words", "Low quality score: 0", "No fashion-related keywords found", "No advice indicators found"]),
        ("wear " * 51 + "never", 7, ["Too long: 52 words"]),
    ],
)
def test_cleaner_gives_all_reasons(spark, text, quality, want):
    assert judge(spark, text, R.rejection_reasons("t", F.lit(quality).cast("int"))) == want


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("Always match your belt to your shoes.", None),
        ("Always match your belt to your shoes", "No punctuation"),
        ("", "No capital start"),
        ("always match.", "No capital start"),
        ("What? Always.", "Contains question"),
        ("Always wear.", "Too short (2 words)"),
        ("Always wear " + "a " * 30 + "tie.", "Too long (33 words)"),
        ("Always click here to wear a tie.", "Prohibited content"),
        ("The tie is on the table now.", "No advice indicator"),
        ("Always put it on the table.", "No fashion terms"),
        ("Always Wear A Tie With Suits now.", "Too many capitals (article title)"),
    ],
)
def test_validator_gives_the_first_error(spark, text, want):
    assert judge(spark, text, R.first_error("t")) == want


def test_quality(spark):
    got = spark.range(1).select(R.quality_b(F.lit(3)).alias("a"), R.quality_b(F.lit(8), F.lit(0.5)).alias("b"), R.quality_b(F.lit(9), F.lit(0.84)).alias("c"), R.quality_b(F.lit(1), F.lit(-3.0)).alias("d"), R.quality_a(F.lit(0.79)).alias("e")).first()
    assert tuple(got) == (5, 9, 10, 1, 7)


def test_sentences(spark):
    docs = spark.createDataFrame([(1, "Short. This is a sentence that is long enough! And this one is as well?"), (2, "tiny"), (3, None), (4, "   " + "x" * 19 + "   ")], "id int, text string")
    assert [(r.id, r.pos) for r in R.sentence_rows(docs).collect()] == [(1, 1), (1, 2)]


def rules(spark):
    rows = [(0, "A b!", "fit", 7, 2, [("u", "d1")]), (1, "a B", "fit", 5, 2, [("v", "d2"), ("w", "d1")]), (2, "c", "color", None, None, None)]
    return spark.createDataFrame(rows, "pos long, rule_text string, rule_type string, quality_score int, word_count int, sources array<struct<url:string,domain:string>>")


def test_merge_and_statistics(spark):
    merged = R.merge_sources(rules(spark).repartition(3))
    got = {r.pos: r for r in merged.collect()}
    assert got[0].rule_text == "A b!" and [s.url for s in got[0].sources] == ["u", "v", "w"] and got[0].source_count == 3
    assert got[2].source_count == 0
    s = R.statistics(merged).first()
    assert (s.total_rules, s.multi_source_rules, s.multi_source_percentage, s.avg_quality_score, s.avg_word_count) == (2, 1, 50.0, 3.5, 1.0)
    d = R.domain_list(merged).first()
    assert (d.unique_domains, d.domains) == (2, ["d1", "d2"])
    none = R.statistics(merged.limit(0)).first()
    assert (none.total_rules, none.multi_source_percentage, none.avg_quality_score) == (0, 0.0, 0.0)
    assert {(r.rule_type, r.rules) for r in R.type_counts(merged).collect()} == {("fit", 1), ("color", 1)}
    held = ["rule_type", "quality_score", "word_count"]
    counted = R.merged_counts(rules(spark).repartition(3), *held)
    assert sorted(map(str, counted.collect())) == sorted(map(str, merged.select(*held, "source_count").collect()))
    assert R.merged_counts(rules(spark).limit(0), *held).count() == 0


def test_clean_splits(spark):
    valid, rejected = R.clean(rules(spark), min_quality=0, min_words=1, required=["b"], advice=["a"])
    assert [r.pos for r in valid.collect()] == [0, 1] and [r.pos for r in rejected.collect()] == [2]
    judged = rules(spark).withColumn("reasons", R.rejection_reasons("rule_text", F.col("quality_score")))
    assert tuple(R.clean_stats(judged).first()) == (3, 0, 3, 0.0) and tuple(R.clean_stats(judged.limit(0)).first()) == (0, 0, 0, 0.0)


def test_report(spark):
    rows = [(i, f"rule {i}", None if i % 4 == 0 else "bad") for i in range(20)]
    df = spark.createDataFrame(rows, "pos int, rule_text string, error string")
    r = R.validation_report(df.repartition(4)).first()
    assert (r.total, r.valid, r.invalid, r.pass_rate) == (20, 5, 15, "25.0%")
    assert [i.text for i in r.sample_issues] == [f"rule {i}" for i in range(20) if i % 4][:10]
    empty = R.validation_report(df.limit(0)).first()
    assert (empty.total, empty.pass_rate, empty.sample_issues) == (0, "0%", [])


def test_counts_and_filters(spark):
    df = R.with_word_count(rules(spark))
    assert [r.word_count for r in df.orderBy("pos").collect()] == [2, 2, 1]
    assert R.keep_valid(df, min_words=1, advice=["b"], fashion=["a"], capitals=1.0).count() == 1
    per = spark.createDataFrame([(2,), (0,), (None,)], "n_rules int")
    assert tuple(R.scrape_stats(per).first()) == (1, 2, 2)
