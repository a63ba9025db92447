from pyspark.sql import functions as F

from weftline.operators import posts as P

C = "array<struct<comment_id:string,body:string,score:bigint>>"


def one(spark, comments, expr):
    return spark.createDataFrame([(comments,)], f"comments {C}").select(expr.alias("x")).first().x


def test_marks(spark):
    own = [("1", "[deleted]", 1), ("2", " [deleted] ", 2), ("3", None, 3), ("4", "x", None)]
    assert [c.comment_id for c in one(spark, own, P.drop_marked("comments"))] == ["2", "3", "4"]
    assert [c.comment_id for c in one(spark, own, P.drop_marked("comments", stripped=True))] == ["3", "4"]
    df = spark.createDataFrame([(own,), ([],), (None,)], f"comments {C}")
    assert P.marked_total(df).first().deleted_total == 1
    assert [r.comment.comment_id for r in P.present_comments(df.limit(1)).collect()] == ["2", "4"]


def test_top_comment_is_the_earliest_best(spark):
    own = [("a", "three", 3), ("b", " five ", 5), ("c", "also five", 5), ("d", "none", None)]
    assert one(spark, own, P.top_comment("comments")).comment_id == "b"
    assert one(spark, own, P.top_comment_text("comments")) == "five"
    assert one(spark, [], P.top_comment_text("comments")) == ""
    assert one(spark, None, P.top_comment_text("comments")) == ""
    assert one(spark, [("a", "x", None), ("b", "y", -1)], P.top_comment("comments")).comment_id == "a"
    assert [c.comment_id for c in one(spark, own, P.top_comments("comments", 2))] == ["b", "c"]


def test_unique_comments(spark):
    own = [("1", "x", 1), ("1", " x ", 2), ("2", "x", 3), (None, None, 4), (None, None, 5), ("3", "[deleted]", 6)]
    assert [c.score for c in one(spark, own, P.unique_bodies("comments"))] == [1, 2, 4, 6]
    assert [c.score for c in one(spark, own, P.unique_comments("comments"))] == [1, 3, 4]
    assert [c.score for c in one(spark, own, P.unique_comments("comments", False))] == [1, 3, 4, 6]


def test_unique_posts_keep_the_first(spark):
    rows = [(i, c, t, p) for i, (c, t, p) in enumerate([("a", "x", "1"), ("a", "x", "2"), ("b", "x", "1"), ("a", None, ""), ("a", None, None), ("a", "y", "1")])]
    df = spark.createDataFrame(rows, "pos int, category string, title string, post_id string").repartition(3)
    assert sorted(r.pos for r in P.unique_titles(df).collect()) == [0, 2, 3, 5]
    assert sorted(r.pos for r in P.unique_posts(df).collect()) == [0, 1, 2, 3]
    again = P.unique_titles(P.unique_titles(df))
    assert again.count() == 4
    counts = P.dedupe_counts(df, P.unique_titles(df)).first()
    assert (counts.total_posts, counts.duplicate_posts, counts.remaining_posts) == (6, 2, 4)


def test_texts(spark):
    df = spark.createDataFrame([("p", " t ", "", [("1", " top ", 9)], "c", 20), ("q", None, None, [], "c", 1)], f"post_id string, title string, selftext string, comments {C}, category string, score long")
    rows = {r.post_id: r for r in P.flatten(df).collect()}
    assert rows["p"].text == "t\n\ntop" and rows["p"].label == rows["p"].subreddit == "c" and rows["q"].text == ""
    corpus = P.prepare_corpus(df).collect()
    assert [(r.post_id, r.title, r.clean_text) for r in corpus] == [("p", "t", "T top.")]
    assert [r.post_id for r in P.by_score(df, 15, 10).collect()] == ["p"]
    assert {(r.category, r.posts) for r in P.category_totals(df).collect()} == {("c", 2), (None, 2)}


def test_keys(spark):
    df = spark.createDataFrame([(None, 3), ("x", 4)], "post_id string, pos int")
    assert [r.k for r in df.select(P.post_key("post_id", "pos").alias("k")).collect()] == ["post_3", "x"]
    assert df.select(P.post_url(F.lit("/r/x")).alias("u")).first().u == "https://reddit.com/r/x"
    known = spark.createDataFrame([("c", "1"), ("c", "1")], "category string, post_id string")
    new = spark.createDataFrame([("c", "1"), ("c", "2"), ("d", "1")], "category string, post_id string")
    assert sorted(map(tuple, P.unseen(new, known).collect())) == [("c", "2"), ("d", "1")]
