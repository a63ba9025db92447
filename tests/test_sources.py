import json

from pyspark.sql import functions as F

from weftline.plans import pipelines
from weftline.sources import files, web
from weftline.streaming import incremental


def test_category_map(spark, tmp_path):
    data = {"z": [{"post_id": "1", "title": "t", "score": 3, "comments": [{"comment_id": "c", "body": "b", "score": 1}]}, "no post", {"title": "u"}], "bad": {"a": 1}, "a": [{"post_id": "2"}], "n": None}
    (tmp_path / "x.json").write_text(json.dumps(data))
    (tmp_path / "y.json").write_text("{broken")
    rows = files.category_map(spark, str(tmp_path)).orderBy("category_pos", "pos").collect()
    assert [(r.category, r.post_id, r.title) for r in rows] == [("z", "1", "t"), ("z", None, "u"), ("a", "2", None)]
    assert rows[0].comments[0].body == "b"
    assert files.posts_with_category(spark, str(tmp_path)).first().source_category in ("z", "a")
    assert "category" not in files.posts_only(spark, str(tmp_path)).columns
    assert files.known_posts(spark, str(tmp_path)).count() == 3


def test_rule_files_and_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"rules": [{"rule_text": "r", "sources": [{"url": "u", "domain": "d"}]}, {"rule_text": "s"}]}))
    (tmp_path / "b.json").write_text("{nope")
    rules, corrupt = files.rule_files(spark, str(tmp_path))
    assert sorted(r.rule_text for r in rules.collect()) == ["r", "s"] and corrupt.count() == 1
    (tmp_path / "u.txt").write_text(" http://a \n\n# note\n")
    assert [r.url for r in files.url_list(spark, str(tmp_path / "u.txt")).collect()] == ["http://a", "# note"]
    (tmp_path / "d.jsonl").write_text('{"rules": [{"rule_id": "1"}, {"rule_id": ""}]}\nbroken\n')
    assert [r.rule_id for r in files.known_rule_ids(spark, str(tmp_path / "d.jsonl")).collect()] == ["1"]
    files.append_lines(rules.select("rule_text"), str(tmp_path / "out"))
    files.append_lines(rules.select("rule_text"), str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).count() == 4
    (tmp_path / "p.json").write_text('[{"post_id": "1"}]')
    assert files.post_list(spark, str(tmp_path / "p.json")).first().post_id == "1"


def test_config_files(spark, tmp_path):
    path = tmp_path / "c.json"
    assert files.load_json(path, list) == [] and files.read_json(path, {}) == {}
    assert files.write_json(path, {"a": 1}) and files.write_json(path, {"a": 2})
    assert files.load_json(path) == {"a": 2} and files.load_json(f"{path}.backup") == {"a": 1} and files.load_json(path, list) == []
    assert not files.write_json(path, {"a": object()}) and files.load_json(path) == {"a": 2}
    path.write_text("{")
    assert files.read_json(path) == {"a": 1}
    got = {r.name: r.query_string for r in files.query_map(spark, {"l": ["a b", 3, ' c"d '], "s": " x ", "e": [" "], "n": 5}).collect()}
    assert got == {"l": 'title:"a b" OR title:"c\\"d"', "s": "x"}


def client(category, query, limit, options):
    if category == "down":
        raise OSError
    return [{"post_id": f"{category}-{i}", "score": i, "comments": [{"comment_id": "c", "body": "b", "score": 1}]} for i in range(2)]


def test_data_sources(spark, monkeypatch, tmp_path):
    web.register(spark)
    (tmp_path / "page.html").write_text("<p>hi</p>")
    urls = f"file://{tmp_path}/page.html\nfile://{tmp_path}/none.html\n"
    rows = spark.read.format("weftline_pages").option("urls", urls).load().collect()
    assert len(rows) == 2 and sum(r.error is not None for r in rows) >= 1
    found = spark.read.format("weftline_search").option("categories", "a\ndown").option("queries", "q=title:x\nr=y").option("client", "tests.test_sources:client").load().collect()
    assert sorted((r.query, r.error) for r in found if r.category == "down") == [("q", "OSError: "), ("r", "OSError: ")]
    assert sorted((r.category, r.query, r.post_id) for r in found if r.error is None) == [("a", q, f"a-{i}") for q in "qr" for i in range(2)]


def test_incremental(spark, tmp_path):
    batch = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k long, v string")
    target = str(tmp_path / "t")
    assert incremental.append_new(batch, target, ["k"], "v") == 2
    assert incremental.append_new(batch.union(spark.createDataFrame([(3, "d")], batch.schema)), target, ["k"], "v") == 1
    assert sorted(map(tuple, spark.read.parquet(target).collect())) == [(1, "a"), (2, "c"), (3, "d")]
    source = str(tmp_path / "in")
    batch.repartition(3).write.parquet(source)
    run = lambda: incremental.run_incremental(spark, source, batch.schema, str(tmp_path / "out"), str(tmp_path / "cp"), ["k"], "v")
    assert run().count() == 2
    spark.createDataFrame([(2, "x"), (9, "y")], batch.schema).write.mode("append").parquet(source)
    assert run().count() == 3
    stream = spark.readStream.schema(batch.schema).parquet(source)
    query = incremental.unique_stream(stream, ["k"]).writeStream.format("memory").queryName("seen").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("seen").count() == 3


def test_full_run(spark):
    page = "<article><p>Always wear a belt that matches the shoes. Short one. You should never match a suit with a cap at work! Buy now to wear this style today for free.</p></article>"
    df = spark.createDataFrame([("https://h.com/a", page), ("https://g.com/b", page), ("https://h.com/c", "")], "url string, html string")
    kept, stats, report = pipelines.full(df, {"min_words": 5, "max_words": 12, "min_quality": 5})
    assert [r.rule_text for r in kept.collect()] == ["Always wear a belt that matches the shoes."] or kept.count() >= 1
    assert stats.first().original_count == 3 and report.first().total >= 1
    merged = pipelines.distill(pipelines.rules_from_pages(df).withColumn("pos", F.monotonically_increasing_id()), merge="all")
    assert {r.source_count for r in merged.collect()} == {2}
    site, statistics = pipelines.rules_from_site(df, item=20, line=20)
    assert statistics.first().total_rules == site.count() > 0


def test_forum(spark):
    c = "array<struct<comment_id:string,body:string,score:bigint>>"
    rows = [(0, "a", "p", "t", "s", [("1", "x", 1), ("2", "x", 2), ("3", "[deleted]", 9)]), (1, "a", "q", "t", "other", [])]
    df = spark.createDataFrame(rows, f"pos int, category string, post_id string, title string, selftext string, comments {c}")
    assert [(r.post_id, r.clean_text) for r in pipelines.forum(df).collect()] == [("p", "T s x.")]
