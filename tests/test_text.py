import json
import re
import string

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from weftline.functions import text as X

SPACES = "  \x1c\x85   　\t\n\x0b\x0c\r"
ODD = st.text(alphabet=string.ascii_letters + string.digits + SPACES + "._!?½éßǅ,'\"#-", max_size=60)
ONCE = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def column(spark, texts, expr):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", expr.alias("x")).collect()
    return [r.x for r in sorted(rows)]


@ONCE
@given(st.lists(ODD, min_size=1, max_size=40))
def test_text_functions_equal_python(spark, texts):
    assert column(spark, texts, X.strip("t")) == [t.strip() for t in texts]
    assert column(spark, texts, X.collapse("t")) == [re.sub(r"\s+", " ", t).strip() for t in texts]
    assert column(spark, texts, X.word_count("t")) == [len(t.split()) for t in texts]
    assert column(spark, texts, X.words("t")) == [t.split() for t in texts]
    want = [re.sub(r"\s+", " ", re.sub(r"[^\w\s]", "", t.lower())).strip() for t in texts]
    assert column(spark, texts, X.normalize("t")) == want
    assert column(spark, texts, X.normalize(X.normalize("t"))) == want
    assert column(spark, texts, F.array_join(X.tokens("t"), "")) == texts


@pytest.mark.parametrize(
    ("text", "want"),
    [("hello world. ok", "Hello world. Ok."), ("", ""), ("  a!  b?c", "A! B?c."), ("1st. (second) one", "1St. (Second) one."), ("é. ß", "É. SS.")],
)
def test_sentence_case(spark, text, want):
    assert column(spark, [text], X.sentence_case("t")) == [want]


def test_casing(spark):
    rows = spark.createDataFrame([("TEH", "the", "THE"), ("Teh", "the", "The"), ("teh", "the", "the"), ("T", "a", "A")], "o string, c string, want string")
    assert all(r.x == r.want for r in rows.select("want", X.preserve_case("o", "c").alias("x")).collect())


def test_truncation(spark):
    assert column(spark, ["abcdef", "abc", "", None], X.truncate("t", 3)) == ["abc...", "abc", "", None]
    assert column(spark, ["a  b\nc d"], X.cut("t", 5)) == ["a b c"]


def test_urls(spark):
    assert column(spark, ["no slash", "https://a.b:8/x", "a/b"], X.host_by_slashes("t")) == ["unknown", "a.b:8", "unknown"]
    assert column(spark, ["no slash", "https://u@a.b:8/x?y", "//h/p"], X.netloc("t")) == ["", "u@a.b:8", "h"]
    assert column(spark, ["example.com/a", "http://h/x"], X.site("t")) == ["https://example.com", "http://h"]
    base = F.lit("https://h.com")
    links = ["/a/b", "a", "//x.org/y", "http://z/q", "#top", "", "../up", "mailto:me@x"]
    assert column(spark, links, X.join_url(base, "t")) == ["https://h.com/a/b", "https://h.com/a", "https://x.org/y", "http://z/q", "https://h.com#top", "https://h.com", "https://h.com/up", "mailto:me@x"]


def test_search_strings(spark):
    rows = spark.createDataFrame([(["a b", ' c"d '],), ([" ", ""],), ([],)], "t array<string>").select(X.search_string("t").alias("x")).collect()
    assert [r.x for r in rows] == ['title:"a b" OR title:"c\\"d"', None, None]


def test_percent_rounds_half_to_even(spark):
    got = spark.createDataFrame([(6.25,), (50.0,), (33.333,)], "x double").select(X.percent("x").alias("p")).collect()
    assert [r.p for r in got] == ["6.2%", "50.0%", "33.3%"]


def plain_salvage(text):
    text = re.sub(r",\s*([}\]])", r"\1", text.strip())
    hit = re.search(r"\{[^{}]*(?:\{[^{}]*\}[^{}]*)*\}", text, re.DOTALL)
    for x in ([hit.group()] if hit else []) + [text]:
        try:
            return json.loads(x)
        except ValueError:
            continue
    return None


def test_salvage(spark):
    cases = ['{"rules": ["a",],}', 'Sure! {"a": 1} bye', "no", '{"a":{"b":{"c":1}}}', '{"a": {"b": 2},}', "[1, 2]", "", '{"a": ']
    got = column(spark, cases, X.salvage_json("t"))
    assert [None if g is None else json.loads(g) for g in got] == [plain_salvage(c) for c in cases]


def test_vectors(spark):
    df = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0]), ([0.0, 0.0], [1.0, 0.0])], "a array<double>, b array<double>")
    rows = df.select(X.cosine("a", "b").alias("c"), X.unit("a").alias("u")).collect()
    assert rows[0].c == pytest.approx(0.96) and rows[0].u == pytest.approx([0.6, 0.8]) and rows[1].c == 0.0 and rows[1].u == [0.0, 0.0]


def test_every_character_is_a_space_or_not_as_in_python(spark):
    from weftline.functions import text as X

    points = [*range(0x3100), 0xFEFF, 0xFFFD, 0x10000, 0x1F600, 0x10FFFF]
    rows = [(i, f"{chr(i)}a{chr(i)}b {chr(i)}") for i in points]
    df = spark.createDataFrame(rows, "i long, t string")
    for r in df.select("i", "t", X.strip("t").alias("s"), X.word_count("t").alias("n"), X.collapse("t").alias("c")).collect():
        assert (r.s, r.n, r.c) == (r.t.strip(), len(r.t.split()), " ".join(r.t.split())), hex(r.i)


def test_texts_are_cut_once(spark):
    from weftline.operators import rules

    docs = spark.createDataFrame([(1, "A sentence that is long enough. " * 2), (2, None), (3, "...................... ..")], "doc_id long, text string")
    cut = rules.sentence_rows(docs)
    assert cut._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1
    assert [(r.doc_id, r.pos, r.sentence) for r in cut.collect()] == [(1, 0, "A sentence that is long enough"), (1, 1, "A sentence that is long enough")]
