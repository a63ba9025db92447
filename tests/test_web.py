from weftline.operators import web as W

PAGE = """<html><body><nav><p>navigation text that is very long and would count as a line</p></nav>
<div class="article wide"><h1>A heading that is long enough to be kept here</h1>
<p>First <b>paragraph</b> with enough text to be a line of its own.</p><div class="shadow"><p>This block is dropped as its class holds an ad, says the rule.</p></div>
<ul><li>An item that should be long enough to be a candidate of the page, always</li><li>short</li></ul>
<p>1. Wear a belt that matches your shoes always, 2. Never button the bottom button of it</p></div></body></html>"""


def test_page_text():
    text = W.page_text(PAGE)
    assert text.startswith("A heading") and "First paragraph with enough" in text and "dropped" not in text and "navigation" not in text
    assert W.page_text(None) == "" and W.page_text("<p>x") == "" and W.page_text("</p></b><<") == ""


def test_page_candidates():
    got = W.page_candidates(PAGE)
    assert got[0].startswith("An item that should") and got.count(got[0]) == 1
    assert "Wear a belt that matches your shoes always," in got and "Never button the bottom button of it" in got


def test_native_forms_agree_on_plain_pages(spark):
    page = "<html><body><article><p>A line of text that is surely long enough.</p><ul><li>x</li></ul></article><footer><p>the footer's line is dropped, as it should be</p></footer></body></html>"
    df = spark.createDataFrame([("https://h.com/a", page), ("https://h.com/b", None), ("https://h.com/c", "")], "url string, html string")
    rows = {r.url: r for r in df.select("url", W.native_text("html").alias("n"), W.html_text("html").alias("p")).collect()}
    assert rows["https://h.com/a"].n == rows["https://h.com/a"].p == "A line of text that is surely long enough."
    assert rows["https://h.com/c"].n == rows["https://h.com/c"].p == ""


def test_links_and_reach(spark):
    df = spark.createDataFrame([("https://h.com/a/b", '<a href="/guide">x</a> <a class="y" href="c?d">z</a> <a href="http://other/style">o</a>')], "url string, html string")
    found = W.resolved(W.links(df))
    assert [r.target for r in found.orderBy("pos").collect()] == ["https://h.com/guide", "https://h.com/c?d", "http://other/style"]
    assert [r.target for r in W.resolved(W.links(df), True).orderBy("pos").collect()][1] == "https://h.com/a/c?d"
    assert [r.target for r in W.candidate_urls(found).collect()] == ["https://h.com/guide"]
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (3, 4), (9, 8), (None, 1)], "src long, dst long")
    seeds = spark.createDataFrame([(1,)], "node long")
    assert {(r.node, r.depth) for r in W.reach(edges, seeds).collect()} == {(1, 0), (2, 1), (3, 2), (4, 3)}
    assert {r.node for r in W.reach(edges, seeds, rounds=1).collect()} == {1, 2}


def test_numbered(spark):
    df = spark.createDataFrame([(1, "1. " + "a" * 40 + " 2) " + "b" * 31 + " 1.5 cm"), (2, "no number " + "x" * 40), (3, "1. short")], "id int, line string")
    assert [(r.id, r.part[0]) for r in W.numbered_parts(df).collect()] == [(1, "a"), (1, "b")]


def test_links_of_pages_that_share_a_url(spark, tmp_path):
    from weftline.plans.queries import QUERIES

    pages = [(1, "https://h.com/a", '<a href="/x">x</a>'), (2, "https://h.com/a", '<a href="y">y</a>'), (3, None, '<a href="https://h.com/z">z</a>')]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = sorted((r.page_id, r.pos, r.href, r.target) for r in QUERIES["html_links"](spark, str(tmp_path)).collect())
    assert got == [(1, 0, "/x", "https://h.com/x"), (2, 0, "y", "https://h.com/y"), (3, 0, "https://h.com/z", "https://h.com/z")]


def test_trees_go_with_their_pages():
    import gc

    gc.collect()
    gc.disable()
    try:
        for _ in range(20):
            W.page_text(PAGE)
            W.page_candidates(PAGE)
        left = sum(isinstance(x, W.Node) for x in gc.get_objects())
    finally:
        gc.enable()
    assert left == 0
