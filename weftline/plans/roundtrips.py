"""Registered queries over files written from the test tables and read back, over
models' answers with a deterministic stand-in, and over single fields."""

from __future__ import annotations

import json
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import lexicons as L
from ..functions import text as X
from ..functions.jsonschema import schema_errors
from ..functions.schemas import digest_schema
from ..operators import extraction, posts, rules, spelling, web
from ..sources import files
from ..tables import spread, work_dir
from . import pipelines
from .queries import CHECKED, KEYS, NAV, NEED, PROMO, SAYS, SENTENCES, THREADS, TOKENS, TYPES, WS, any_sql, checked, collapse_sql, count_sql, query, reasons_sql, sentences_of, strip_sql, table, threads, truncate_sql, type_sql, word_counts


def place(spark: SparkSession, name: str) -> str:
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"


def documents_of(rows: DataFrame, path: str) -> str:
    """One JSON document (column ``value``) to a file."""
    rows.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return path


def listed_posts(spark, sf_dir) -> DataFrame:
    """(category, list of posts in order)."""
    post = F.struct("pos", F.struct("post_id", "title", "score", "url", "selftext", "comments").alias("post"))
    grouped = threads(spark, sf_dir).groupBy("category").agg(F.array_sort(F.collect_list(post)).alias("l"))
    return grouped.select("category", F.transform("l", lambda x: x["post"]).alias("posts"))


POSTS = THREADS + "select 'r/' || cast(conv_id % 7 as varchar) as category, cast(row_number() over (partition by conv_id % 7 order by conv_id) - 1 as integer) as pos, cast(conv_id as varchar) as post_id, left(first, 60) as title, cast(n as bigint) as score, cast(n as bigint) as comments"


@query(POSTS + ", 'r/' || cast(conv_id % 7 as varchar) as source_category from firsts")
def category_files(spark, sf_dir):
    """Posts of {category: [post]} files, with their category."""
    docs = listed_posts(spark, sf_dir).select(F.to_json(F.create_map("category", "posts")).alias("value"))
    found = files.posts_with_category(spark, documents_of(docs, place(spark, "categories")))
    return found.select("category", "source_category", F.col("pos").cast("int").alias("pos"), "post_id", "title", "score", F.size("comments").cast("long").alias("comments"))


@query(THREADS + "select cast(conv_id as varchar) as post_id, left(first, 60) as title, cast(n as bigint) as score from firsts")
def category_files_flat(spark, sf_dir):
    """The same posts without their category."""
    docs = listed_posts(spark, sf_dir).select(F.to_json(F.create_map("category", "posts")).alias("value"))
    return files.posts_only(spark, documents_of(docs, place(spark, "flat"))).select("post_id", "title", "score")


@query("select distinct 'r/' || cast(conv_id % 7 as varchar) as category, cast(conv_id as varchar) as post_id from conversations")
def category_files_known(spark, sf_dir):
    """Keys of the posts that earlier output has."""
    docs = listed_posts(spark, sf_dir).select(F.to_json(F.create_map("category", "posts")).alias("value"))
    return files.known_posts(spark, documents_of(docs, place(spark, "known")))


@query(THREADS + "select cast(conv_id as varchar) as post_id, left(first, 60) as title, second as selftext, cast(n as bigint) as comments from firsts")
def post_list_files(spark, sf_dir):
    """Posts of JSON lists."""
    docs = listed_posts(spark, sf_dir).select(F.to_json("posts").alias("value"))
    return files.post_list(spark, documents_of(docs, place(spark, "posts"))).select("post_id", "title", "selftext", F.size("comments").cast("long").alias("comments"))


@query("select text as rule_text, role as rule_type, count(*) as n from conversations group by all union all select '<corrupt>', null, 1")
def rule_file_union(spark, sf_dir):
    """Rules of all files; a file that is no JSON is told apart."""
    turns = table(spark, sf_dir, "conversations")
    rule = F.struct(F.col("text").alias("rule_text"), F.col("role").alias("rule_type"))
    docs = turns.groupBy((F.col("conv_id") % 7).alias("k")).agg(F.to_json(F.struct(F.collect_list(rule).alias("rules"))).alias("value")).select("value")
    found, corrupt = files.rule_files(spark, documents_of(docs.union(spark.createDataFrame([('{"rules": [',)], "value string")), place(spark, "rules")))
    rows = found.groupBy("rule_text", "rule_type").agg(F.count("*").alias("n"))
    return rows.unionByName(corrupt.select(F.lit("<corrupt>").alias("rule_text"), F.lit(None).cast("string").alias("rule_type")).groupBy("rule_text", "rule_type").agg(F.count("*").alias("n")))


@query(f"select url, count(*) as n from (select {strip_sql('url')} as url from pages union all select '# ' || cast(page_id as varchar) from pages) where url <> '' group by 1")
def url_lines(spark, sf_dir):
    """URLs of a text file with blank lines and remarks."""
    path = place(spark, "urls")
    table(spark, sf_dir, "pages").select(F.explode(F.array(F.concat(F.lit("  "), "url"), F.lit(" "), F.concat(F.lit("# "), F.col("page_id").cast("string")), F.lit(""))).alias("value")).write.text(path)
    return files.url_list(spark, path).groupBy("url").agg(F.count("*").alias("n"))


@query("select distinct sha1(p_name) as rule_id from part")
def jsonl_rule_ids(spark, sf_dir):
    """Ids of the rules in lines that were appended in two goes."""
    path, part = place(spark, "digests"), table(spark, sf_dir, "part")
    digest = part.select("p_partkey", F.array(F.struct(F.sha1("p_name").alias("rule_id"), F.col("p_name").alias("text"))).alias("rules"))
    for half in (0, 1):
        files.append_lines(digest.where(F.col("p_partkey") % 2 == half).select("rules"), path)
    return files.known_rule_ids(spark, path)


@query("select r_name as name, cast(r_regionkey + 1 as bigint) as now, cast(r_regionkey as bigint) as before, cast(0 as bigint) as typed from region")
def json_files(spark, sf_dir):
    """A file written twice; then broken, so that the backup is read."""
    path = f"{tempfile.mkdtemp()}/regions.json"  # the driver's own file
    rows = {r.r_name: r.r_regionkey for r in table(spark, sf_dir, "region").select("r_name", "r_regionkey").collect()}
    files.write_json(path, rows)
    files.write_json(path, {k: v + 1 for k, v in rows.items()})
    now = files.read_json(path)
    with open(path, "w", encoding="utf-8") as file:
        file.write("{")
    before, typed = files.read_json(path), files.load_json(path, list)
    return spark.createDataFrame([(k, now[k], before[k], len(typed)) for k in rows], "name string, now long, before long, typed long")


# Models' answers


def answers(prompts: list[str]) -> list[str]:
    """By the prompt's length: an object with a stray comma, no JSON, an error."""
    out = []
    for p in prompts:
        if len(p) % 3 == 0:
            raise ValueError("no answer")
        out.append("There is nothing to report." if len(p) % 3 == 1 else 'Here: {"has_fashion_rule": true, "rules": ["one", "two"], "category": "fit",}')
    return out


FORUM = (
    THREADS
    + f""", p as (select f.conv_id, {strip_sql('left(first, 60)')} as title, {strip_sql('second')} as body, {strip_sql('top.text')} as best from firsts f join top on f.conv_id = top.conv_id and r = 1),
q as (select conv_id, length('<s>[INST] ' || chr(10) || chr(10) || 'Analyze this Reddit fashion post and extract any fashion rules or advice:' || chr(10) || chr(10) ||
concat_ws(chr(10) || chr(10), 'Title: ' || title, case when body <> '' then 'Post Content: ' || {truncate_sql('body', 500)} end, case when best <> '' then 'Top Comment: ' || {truncate_sql('best', 300)} end) ||
chr(10) || chr(10) || 'Return only valid JSON. [/INST]') % 3 as k from p)
"""
)


@query(FORUM + f"select cast(conv_id as varchar) as post_id, k = 2 as success, case k when 0 then 'no answer' when 1 then '{L.ERROR_JSON}There is nothing to report.' end as error, case when k = 1 then 'There is nothing to report.' end as raw_response, case when k = 2 then 'fit' end as category, case when k = 2 then 'low' end as confidence, case when k = 2 then 2 end as n from q")
def forum_answers(spark, sf_dir):
    """Every post has a row, whatever the model did; missing fields get defaults."""
    rows = extraction.extract_posts(threads(spark, sf_dir), answers)
    return rows.select("post_id", "success", "error", "raw_response", "extraction.category", "extraction.confidence", F.when(F.col("success"), F.size("extraction.rules")).alias("n"))


def digest_answers(prompts: list[str]) -> list[str]:
    """A digest for a post; for every third only when it is asked again, for
    every seventh never."""
    out = []
    for p in prompts:
        post = int(re.search(r"- id: (\d+)", p).group(1))
        rule = {"rule_id": "auto", "text": f" Keep {post} ", "rule_type": L.RULE_TYPES[0], "categories": [L.CATEGORIES[0]], "confidence": 0.5, "citations": [{"source_post_id": str(post)}]}
        valid = post % 7 != 0 and (post % 3 != 0 or p.endswith(L.STRICT))
        out.append(json.dumps({"rules": [rule]} if valid else {"rules": []}))
    return out


@query("select cast(conv_id as varchar) as source_post_id, sha1('keep ' || conv_id || '::' || conv_id) as rule_id, '2024-01-02T03:04:05+00:00' as extracted_at from (select distinct conv_id from conversations) where conv_id % 7 <> 0 and conv_id % 5 <> 0")
def digest_retry(spark, sf_dir):
    """Digests, asked for a second time where the first was none; rules with a
    known id are left out."""
    rows = threads(spark, sf_dir)
    known = rows.where("pos % 5 = 0").select(F.sha1(F.concat(F.lit("keep "), "post_id", F.lit("::"), "post_id")).alias("rule_id"))
    found = extraction.digests(rows, digest_answers, known, now=F.lit("2024-01-02 03:04:05").cast("timestamp"))
    return found.select("source_post_id", "rule_id", "extracted_at")


@query("""with t as (select conv_id, turn, role, text, row_number() over (partition by conv_id order by turn) - 1 as i from conversations),
e as (select conv_id, '$.rules[' || i || '].rule_type' as path, 'not one of absolute, guideline, trend, contrarian' as error from t where turn % 2 = 1
union all select conv_id, '$.rules[' || i || '].confidence', 'maximum 1' from t where turn > 4 union all select conv_id, '$.rules[' || i || '].confidence', 'not of type number' from t where turn = 0
union all select conv_id, '$.rules[' || i || '].citations', 'minItems 1' from t where turn % 3 = 0 union all select conv_id, '$.rules[' || i || '].citations[0].snippet', 'missing' from t where turn % 3 = 1
union all select conv_id, '$.rules[' || i || '].categories[1]', 'not one of fit, color, formality, fabric, footwear, accessories, season, pattern, proportion, grooming, occasion, general' from t where length(text) % 5 = 0
union all select distinct conv_id, '$.source_title', 'missing' from t where conv_id % 4 = 0)
select conv_id, path, error from e""")
def digest_schema_errors(spark, sf_dir):
    """Where digests of whole conversations, a rule for each turn, break the schema."""
    turn = F.col("turn")
    citation = F.struct(F.col("conv_id").cast("string").alias("source_post_id"), F.when(turn % 3 == 2, F.col("text")).alias("snippet"), F.lit(3).alias("upvotes"))
    rule = F.struct(
        turn,
        F.concat("conv_id", F.lit("-"), "turn").alias("rule_id"),
        "text",
        F.when(turn % 2 == 1, F.col("role")).otherwise("trend").alias("rule_type"),
        F.array(F.lit("fit"), F.when(F.length("text") % 5 == 0, "hats").otherwise("season")).alias("categories"),
        F.array().cast("array<string>").alias("context_tags"),
        F.when(turn > 4, "1.5").when(turn == 0, '"high"').otherwise("0.25").alias("confidence"),
        F.when(turn % 3 == 0, F.array().cast("array<struct<source_post_id:string,snippet:string,upvotes:int>>")).otherwise(F.array(citation)).alias("citations"),
    )
    rows = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(rule)).alias("rules"))
    # a confidence of another type is put in as text
    texts = F.transform("rules", lambda r: F.replace(F.to_json(r.dropFields("turn", "confidence")), F.lit('{"rule_id"'), F.concat(F.lit('{"confidence":'), r["confidence"], F.lit(',"rule_id"'))))
    title = F.when(F.col("conv_id") % 4 == 0, "").otherwise('"source_title":"t",')
    whole = F.concat(F.lit("{"), title, F.lit('"extracted_at":"now","source_post_id":"p","rules":['), F.array_join(texts, ","), F.lit("]}"))
    errors = schema_errors(whole, digest_schema())
    return rows.select("conv_id", F.explode(errors).alias("e")).select("conv_id", "e.*")


# Rules and fields


@query(SENTENCES + f", judged as (select {count_sql('sentence')} as w, {reasons_sql('sentence')} as reasons from (select *, 5 + case when {count_sql('sentence')} >= 8 then 2 else 0 end as q from long)) select reasons = '' as valid, reasons, count(*) as n, cast(sum(w) as bigint) as words from judged group by all")
def clean_split(spark, sf_dir):
    """Valid rules and rejected ones with their reasons; word counts where missing."""
    rows = sentences_of(spark, sf_dir).select(F.col("sentence").alias("rule_text"), F.when(F.col("pos") % 2 == 0, X.word_count("sentence")).alias("word_count"))
    rows = rules.with_word_count(rows).withColumn("quality_score", rules.quality_b(F.col("word_count")))
    valid, rejected = rules.clean(rows, promotional=PROMO, navigational=NAV, required=NEED, advice=SAYS)
    both = valid.withColumn("reasons", F.array().cast("array<string>")).unionByName(rejected)
    return both.groupBy((F.size("reasons") == 0).alias("valid"), F.array_join("reasons", "; ").alias("reasons")).agg(F.count("*").alias("n"), F.sum("word_count").cast("long").alias("words"))


HEAD, TAIL = (x.replace("'", "''") for x in L.WEB_PROMPT.replace("{system}", "").split("{content}"))


@query(f"""select doc_id, case when doc_id % 3 = 0 then 'post_' || doc_id else 'x' || doc_id end as post_key, 'https://reddit.com/r/' || doc_id as url, left({collapse_sql('text')}, 240) as snippet,
'{HEAD}' || left(text, 30) || '{TAIL}' as prompt from documents""")
def post_fields(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    key = F.when(F.col("doc_id") % 3 != 0, F.concat(F.lit("x"), F.col("doc_id").cast("string")))
    url = posts.post_url(F.concat(F.lit("/r/"), F.col("doc_id").cast("string")))
    return docs.select("doc_id", posts.post_key(key, "doc_id").alias("post_key"), url.alias("url"), extraction.snippet("text").alias("snippet"), extraction.web_prompt(F.substring("text", 1, 30)).alias("prompt"))


@query("select event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00') as stamp from events")
def event_stamps(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", X.utc_seconds(F.col("ts").cast("timestamp")).alias("stamp"))


@query("""with v as (select vec_id, cast(embedding as double[]) as e from embeddings), n as (select vec_id, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) as n from v)
select vec_id, round(e[1] / n, 6) as first, round(list_sum(list_transform(e, lambda x: x / n)), 6) as total from n""")
def unit_vectors(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select("vec_id", X.unit("embedding").alias("u"))
    return rows.select("vec_id", F.round(F.get("u", F.lit(0)), 6).alias("first"), F.round(F.aggregate("u", F.lit(0.0), lambda s, x: s + x), 6).alias("total"))


#: Tokens in order, with the correction of rare words in their casing.
@query(TOKENS + """, known as (select word, n as freq from w where n >= 40), rare as (select word from w where n < 40),
e as (select r.word, k.word as correction, k.freq from rare r join known k on left(r.word, 1) = left(k.word, 1) and abs(length(r.word) - length(k.word)) <= 1
  union select r.word, k.word, k.freq from rare r join known k on right(r.word, 1) = right(k.word, 1) and abs(length(r.word) - length(k.word)) <= 1),
p as (select *, damerau_levenshtein(word, correction) as edits from e where damerau_levenshtein(word, correction) <= 1),
b as (select word, correction from (select *, row_number() over (partition by word order by edits, freq desc, correction) as r from p) where r = 1),
o as (select doc_id, ts, unnest(generate_series(1, len(ts))) as i from l), k as (select doc_id, i, ts[i] as token from o),
m as (select k.doc_id, k.i, case when b.word is null then k.token when k.token = upper(k.token) and k.token <> lower(k.token) then upper(b.correction)
  when regexp_matches(k.token, '^[A-Z]') then upper(left(b.correction, 1)) || lower(substring(b.correction, 2)) else b.correction end as token
  from k left join b on b.word = lower(k.token) and regexp_full_match(k.token, '[A-Za-z]+'))
select doc_id, string_agg(token, '' order by i) as corrected from m group by doc_id""")
def spelling_corrected(spark, sf_dir):
    """Whole texts with rare words corrected by one edit, casing kept."""
    known = word_counts(spark, sf_dir).where("n >= 40").select("word", F.col("n").alias("freq"))
    return spelling.correct(spread(table(spark, sf_dir, "documents").select("doc_id", "text")), known, "doc_id", skip=[], edits=1)



# Pages built of documents, so that SQL can tell what a parser must find


def built_pages(spark, sf_dir) -> DataFrame:
    """(url, html): a menu, then every line as a paragraph, a list item or a
    numbered line, by its place."""
    text = F.replace(F.replace(F.coalesce("text", F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))

    def block(line, i):
        return (
            F.when(i % 3 == 0, F.concat(F.lit('<p class="x">'), line, F.lit("</p>")))
            .when(i % 3 == 1, F.concat(F.lit("<ul><li><b>"), line, F.lit("</b></li></ul>")))
            .otherwise(F.concat(F.lit("<p>1. "), line, F.lit(" 2) "), line, F.lit("</p>")))
        )

    body = F.array_join(F.transform(F.split(text, "\n"), block), "\n")
    page = F.concat(F.lit("<html><head><script>var a = '<p>no text</p>';</script></head><body><nav><ul><li>a menu that is long enough to be a line of text</li></ul></nav><article>"), body, F.lit("</article></body></html>"))
    return table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("url"), page.alias("html"))


BUILT = f"""with l as (select doc_id, string_split(coalesce(text, ''), chr(10)) as parts from documents),
n as (select doc_id, i - 1 as i, {collapse_sql('parts[i]')} as line from (select doc_id, parts, unnest(generate_series(1, len(parts))) as i from l)),
"""


@query(BUILT + f"t as (select doc_id, i, case when i % 3 = 2 then {collapse_sql("'1. ' || line || ' 2) ' || line")} else line end as line from n) select cast(doc_id as varchar) as url, coalesce(string_agg(line, ' ' order by i) filter (where length(line) > 30), '') as text from t group by doc_id")
def html_text_built(spark, sf_dir):
    return built_pages(spark, sf_dir).select("url", web.html_text("html").alias("text"))


@query(BUILT + rf"""li as (select doc_id, 0 as k, i, 0 as j, line as text from n where i % 3 = 1 and length(line) > 20),
num as (select doc_id, 1 as k, i, string_split_regex({collapse_sql("'1. ' || line || ' 2) ' || line")}, '\d+\.|\d+\)') as s from n where i % 3 = 2 and length({collapse_sql("'1. ' || line || ' 2) ' || line")}) > 30),
nums as (select doc_id, k, i, j, {strip_sql('s[j]')} as text from (select *, unnest(generate_series(1, len(s))) as j from num)),
longs as (select doc_id, 1 as k, i, 0 as j, line as text from n where i % 3 < 2 and length(line) > 60 and not regexp_matches(line, '^(\d+\.|\d+\))[{WS}]+') and ({' or '.join(f"contains(lower(line), '{w}')" for w in SAYS)})),
own as (select doc_id, 1 as k, i, string_split_regex(line, '\d+\.|\d+\)') as s from n where i % 3 < 2 and length(line) > 30 and regexp_matches(line, '^(\d+\.|\d+\))[{WS}]+')),
owns as (select doc_id, k, i, j, {strip_sql('s[j]')} as text from (select *, unnest(generate_series(1, len(s))) as j from own)),
a as (select * from li union all select * from nums where length(text) > 30 union all select * from owns where length(text) > 30 union all select * from longs),
f as (select doc_id, text, row_number() over (partition by doc_id, text order by k, i, j) as r from a)
select cast(doc_id as varchar) as source, text from f where r = 1""")
def html_candidates_built(spark, sf_dir):
    return web.html_candidates(built_pages(spark, sf_dir), advice=SAYS).select("source", "text")


# Models and sources at arm's length


def measure(texts: list[str]) -> list[list[float]]:
    """An encoder that sees only lengths."""
    return [[len(t) % 7 + 1.0, len(t) % 5 + 0.5] for t in texts]


TEMPLATES = ["a template of some words", "another"]


@query(
    rf"""with parts as (select doc_id, string_split_regex(case when length(text) > 2000 then left(text, 2000) || '...' else text end, '[.!?]+') as s from documents where length({strip_sql("text")}) >= 20),
sent as (select doc_id, i - 1 as pos, {strip_sql("s[i]")} as sentence from (select doc_id, s, unnest(generate_series(1, len(s))) as i from parts)),
e as (select doc_id, pos, sentence, length(sentence) % 7 + 1.0::double as x, length(sentence) % 5 + 0.5::double as y from sent where length(sentence) > 20 and {any_sql("lower(sentence)", KEYS)}),
c as (select *, greatest({", ".join(f"(x * {len(t) % 7 + 1.0}::double + y * {len(t) % 5 + 0.5}::double) / (sqrt(x * x + y * y) * sqrt({(len(t) % 7 + 1.0) ** 2 + (len(t) % 5 + 0.5) ** 2}::double))" for t in TEMPLATES)}) as similarity from e)
select doc_id, cast(pos as integer) as pos, {type_sql("sentence", TYPES)} as rule_type, {count_sql("sentence")} as word_count, round(similarity, 6) as similarity, quality from (select *, cast(floor(round(similarity, 9) * 10) as integer) as quality from c) where similarity > 0.9 and similarity < 0.9999999"""
)
def similarity_rules(spark, sf_dir):
    """Sentences near a template, by an encoder that is a plain function."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    rows = pipelines.rules_by_similarity(docs, measure, templates=TEMPLATES, keywords=KEYS, types=TYPES, threshold=0.9).where("similarity < 0.9999999")
    return rows.select("doc_id", "pos", "rule_type", F.col("word_count").cast("long").alias("word_count"), F.round("similarity", 6).alias("similarity"), F.col("quality_score").alias("quality"))


def found_posts(category: str, text: str, limit: int, options: dict) -> list[dict]:
    """A search client: as many posts as the category has letters; one category is down."""
    if category == "down":
        raise OSError("down")
    return [{"post_id": f"{category}-{i}", "title": text, "score": i * 7 % 5, "comments": [{"comment_id": "c", "body": options["user"], "score": i}]} for i in range(len(category))][:limit]


@query("""with c(category) as (values ('ab'), ('abcdef'), ('down')), q(query, title) as (values ('fit', 'title:"fit"'), ('hat', 'hats'))
select category, query, category || '-' || i as post_id, title, cast(i * 7 % 5 as bigint) as score, 'me' as body, null as error from c, q, generate_series(0, 3) g(i) where category <> 'down' and i < length(category)
union all select category, query, null, null, null, null, 'OSError: down' from c, q where category = 'down'""")
def search_posts(spark, sf_dir):
    """Every category with every query; a search that fails is a row."""
    from ..sources import web as sources

    sources.register(spark)
    read = spark.read.format("weftline_search").option("categories", "ab\nabcdef\ndown").option("queries", 'fit=title:"fit"\nhat=hats').option("limit", "4").option("user", "me")
    rows = read.option("client", "weftline.plans.roundtrips:found_posts").load()
    return rows.select("category", "query", "post_id", "title", "score", F.get("comments", F.lit(0))["body"].alias("body"), "error")


@query("select cast(conv_id as varchar) as post_id, 'r/' || cast(conv_id % 7 as varchar) as subreddit, count(*) as comments from conversations group by conv_id")
def cli_records(spark, sf_dir):
    """The command line's records of category files: posts by id, labelled."""
    from ..__main__ import main

    docs = listed_posts(spark, sf_dir).select(F.to_json(F.create_map("category", "posts")).alias("value"))
    source, target = documents_of(docs, place(spark, "cli")), place(spark, "records")
    main(["records", source, target])
    rows = spark.read.schema("post_id string, subreddit string, comments array<struct<comment_id:string>>").json(target)
    return rows.select("post_id", "subreddit", F.size("comments").cast("long").alias("comments"))


#: Places of a block of a forum's posts.
BLOCK = 1000


class ConversationForum:
    """A forum whose posts of a category are the lines of files in a folder, in
    order of their place; a query is a number that divides a post's id. Posts lie in
    blocks of places, so that a page costs what it holds and not what the category does."""

    @staticmethod
    def _lines(folder: str) -> list[dict]:
        from pyarrow import fs

        store, path = fs.FileSystem.from_uri(folder)
        found = []
        for info in store.get_file_info(fs.FileSelector(path, allow_not_found=True)):
            if info.path.endswith(".json"):
                with store.open_input_stream(info.path) as file:
                    found += [json.loads(x) for x in file.read().decode().splitlines()]
        return found

    @classmethod
    def _all(cls, category: str, query: str, options: dict, block: str = "") -> list[dict]:
        found = cls._lines(f"{options['folder']}/category={category}{block}")
        until = int(options.get("until", 1 << 62))
        return [p for p in sorted(found, key=lambda p: p["place"]) if p["place"] % int(query) == 0 and p["place"] < until]

    @classmethod
    def _blocks(cls, category: str, query: str, options: dict) -> list[tuple[int, int]]:
        """(block, posts of it) in order; only the block that ``until`` cuts is read for that."""
        until, found = int(options.get("until", 1 << 62)), []
        for x in sorted(cls._lines(f"{options['folder']}/index/category={category}"), key=lambda x: x["block"]):
            if (x["block"] + 1) * BLOCK <= until:
                found.append((x["block"], x["counts"][query]))
            elif x["block"] * BLOCK < until:
                found.append((x["block"], len(cls._all(category, query, options, f"/block={x['block']}"))))
        return found

    @classmethod
    def latest(cls, category: str, query: str, options: dict) -> int:
        return sum(n for _, n in cls._blocks(category, query, options))

    @classmethod
    def posts(cls, category: str, query: str, start: int, end: int, options: dict) -> list[dict]:
        found, at = [], 0
        for block, n in cls._blocks(category, query, options):
            if at < end and at + n > start:
                found += cls._all(category, query, options, f"/block={block}")[max(start - at, 0) : end - at]
            at += n
        return found


def write_forum(rows: DataFrame, folder: str, queries: list[str]) -> None:
    """Posts (category, place, ...) as the files of a ConversationForum, with how many
    posts of a block each query finds."""
    rows = rows.withColumn("block", F.floor(F.col("place") / BLOCK))
    rows.repartition("category", "block").write.partitionBy("category", "block").json(folder)
    counts = F.struct(*[F.count_if(F.col("place") % int(q) == 0).alias(q) for q in queries])
    index = rows.groupBy("category", "block").agg(counts.alias("counts"))
    index.repartition("category").write.partitionBy("category").json(f"{folder}/index")


@query(THREADS + "select 'c' || cast(conv_id % 7 as varchar) as category, cast(conv_id as varchar) as post_id, left(first, 60) as title, cast(n as bigint) as comments, 'all' as query from firsts")
def forum_stream(spark, sf_dir):
    """A forum read in three runs on one checkpoint while it grows: every post
    once, though two queries find half of them and a part was there before."""
    from ..sources import web as sources
    from ..streaming import incremental

    sources.register(spark)
    folder, target, checkpoint = place(spark, "forum"), place(spark, "posts"), place(spark, "offsets")
    rows = threads(spark, sf_dir).select(F.concat(F.lit("c"), (F.col("post_id").cast("long") % 7).cast("string")).alias("category"), F.col("post_id").cast("long").alias("place"), "post_id", "title", "score", "comments")
    write_forum(rows, folder, ["1", "2"])
    most = (rows.agg(F.max("place")).first()[0] or 0) + 1
    for until in (most // 3, most // 2, most):
        read = spark.readStream.format("weftline_forum").option("categories", "\n".join(f"c{k}" for k in range(7))).option("queries", "all=1\neven=2").option("page", "20")
        stream = read.option("client", "weftline.plans.roundtrips:ConversationForum").option("folder", folder).option("until", str(until)).load()
        posts_ = incremental.append_stream(stream, target, checkpoint, ["category", "post_id"], ["query", "place"])
    return posts_.select("category", "post_id", "title", F.size("comments").cast("long").alias("comments"), "query")


@query(THREADS + "select 'r/' || cast(conv_id % 7 as varchar) as category, cast(row_number() over (partition by conv_id % 7 order by conv_id) - 1 as bigint) as pos, cast(conv_id as varchar) as post_id, left(first, 60) as title, cast(n as bigint) as comments, cast(n + 1 as bigint) as now, cast(n as bigint) as before from firsts")
def document_sink(spark, sf_dir):
    """Posts written as one document of categories, by several tasks, twice; read
    back by byte ranges beside the backup of the first writing."""
    from ..sources import sinks

    path = place(spark, "document") + ".json"
    rows = threads(spark, sf_dir).select("category", F.col("post_id").cast("long").alias("id"), "post_id", "title", "score", "comments")
    sinks.write_document(rows, path, "category", ["id"])
    sinks.write_document(rows.withColumn("score", F.col("score") + 1), path, "category", ["id"])
    kept = lambda p: files.category_map(spark, p).select("category", "pos", "post_id", "title", F.size("comments").cast("long").alias("comments"), "score")
    before = kept(f"{path}.backup").select("category", "post_id", F.col("score").alias("before"))
    return kept(path).withColumnRenamed("score", "now").join(before, ["category", "post_id"])


def page_answers(prompts: list[str]) -> list[str]:
    """By the prompt's length: two rules, one with its count; no rule; no JSON; an error."""
    out = []
    for p in prompts:
        k = len(p) % 4
        if k == 3:
            raise ValueError("no answer")
        rule = [{"rule_text": " Wear it  well ", "rule_type": "fit", "quality_score": 8}, {"rule_text": "two", "word_count": 9}]
        out.append("Nothing." if k == 2 else json.dumps({"has_fashion_rule": k == 0, "rules": rule}))
    return out


@query(f"""with k as (select doc_id, length('{HEAD}' || text || '{TAIL}') % 4 as k from documents)
select doc_id, 0 as pos, ' Wear it  well ' as rule_text, 'fit' as rule_type, 8 as quality_score, 3 as word_count, null as error from k where k = 0
union all select doc_id, 1, 'two', null, null, 9, null from k where k = 0
union all select doc_id, 0, null, null, null, null, case when k = 3 then 'no answer' else '{L.ERROR_JSON}Nothing.' end from k where k > 1""")
def web_answers(spark, sf_dir):
    """Rules that a model finds in whole texts; failures are rows."""
    return extraction.extract_pages(table(spark, sf_dir, "documents").select("doc_id", "text"), page_answers)


@query(CHECKED + "select count(*) filter (where error is null) as total_rules, count(*) filter (where error is not null) as filtered from e")
def filter_totals(spark, sf_dir):
    """The totals of a rule file whose invalid rules went."""
    kept, totals = rules.filtered(checked(spark, sf_dir).drop("error"), prohibited=PROMO, advice=SAYS, fashion=NEED)
    return totals


@query("select doc_id, replace(text, ' the ', ' THE ') as mended from documents")
def grammar_hook(spark, sf_dir):
    """A grammar tool, loaded once per worker, over whole texts."""
    return table(spark, sf_dir, "documents").select("doc_id", spelling.mended("text", lambda: lambda t: t.replace(" the ", " THE ")).alias("mended"))


@query(POSTS + " from firsts")
def category_files_strict(spark, sf_dir):
    """As category_files, where a malformed document would be an error."""
    docs = listed_posts(spark, sf_dir).select(F.to_json(F.create_map("category", "posts")).alias("value"))
    found = files.category_map(spark, documents_of(docs, place(spark, "strict")), strict=True)
    return found.select("category", F.col("pos").cast("int").alias("pos"), "post_id", "title", "score", F.size("comments").cast("long").alias("comments"))


def top_of_forum(category: str, text: str, limit: int, options: dict) -> list[dict]:
    """A search client over the same folders: the best posts of a category."""
    if category == "c6":
        raise OSError("down")
    found = ConversationForum._all(category, text, options)
    return sorted(found, key=lambda p: (-p["score"], p["place"]))[:limit]


@query(THREADS + """, p as (select 'c' || cast(conv_id % 7 as varchar) as category, q.query, conv_id, cast(n as bigint) as score, left(first, 60) as title from firsts, (values ('all', 1), ('even', 2)) q(query, k) where conv_id % k = 0 and conv_id % 7 <> 6),
r as (select *, row_number() over (partition by category, query order by score desc, conv_id) as rank from p)
select category, query, cast(conv_id as varchar) as post_id, title, score, null as error from r where rank <= 4
union all select 'c6', query, null, null, null, 'OSError: down' from (values ('all'), ('even')) q(query)""")
def search_threads(spark, sf_dir):
    """Every category with every query: the best four posts of each; a search that
    fails is a row."""
    from ..sources import web as sources

    sources.register(spark)
    folder = place(spark, "searched")
    rows = threads(spark, sf_dir).select(F.concat(F.lit("c"), (F.col("post_id").cast("long") % 7).cast("string")).alias("category"), F.col("post_id").cast("long").alias("place"), "post_id", "title", "score")
    rows.write.partitionBy("category").json(folder)
    read = spark.read.format("weftline_search").option("categories", "\n".join(f"c{k}" for k in range(7))).option("queries", "all=1\neven=2").option("limit", "4")
    found = read.option("client", "weftline.plans.roundtrips:top_of_forum").option("folder", folder).load()
    return found.select("category", "query", "post_id", "title", "score", "error")


@query("""with c as (select label as cluster, vec_id from embeddings), s as (select label as k, avg(vec_id) / 1000 as silhouette from embeddings group by 1),
r as (select *, row_number() over (order by silhouette desc, k) as r from s)
select r.k, r.silhouette, (select k from r where r = 1) as best_k, (select silhouette from r where r = 1) as best_silhouette, 'stub' as model_name, (select count(distinct cluster) from c) as summaries, cast(r.r - 1 as integer) as place from r""")
def scores_document(spark, sf_dir):
    """Scores and cluster summaries as one document, read back."""
    from ..operators import semantic

    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("pos"), F.col("label").alias("cluster"), F.lit("x").alias("category"), F.col("vec_id").cast("string").alias("post_id"), F.lit("text").alias("clean_text"))
    scores = rows.groupBy(F.col("cluster").alias("k")).agg((F.avg("pos") / 1000).alias("silhouette"))
    whole = semantic.serialized_scores(scores, semantic.cluster_summary(rows), "stub")
    kind = "model_name string, cluster_scores array<struct<k:int,silhouette:double>>, best_k int, best_silhouette double, cluster_summaries array<struct<cluster:int>>"
    found = whole.select(F.from_json("document", kind).alias("d")).select("d.*")
    return found.select(F.posexplode("cluster_scores").alias("place", "s"), "best_k", "best_silhouette", "model_name", F.size("cluster_summaries").cast("long").alias("summaries")).select("s.k", "s.silhouette", "best_k", "best_silhouette", "model_name", "summaries", "place")


@query(TOKENS + """, known as (select word, n as freq from w where n >= 40), own(word) as (values ('thn'), ('thanedbla')), dict as (select word, sum(freq) as freq from (select * from known union all select word, 1 from own) group by word)
, rare as (select word from w where n < 40 and word not in (select word from own)),
e as (select r.word, k.word as correction, k.freq from rare r join dict k on left(r.word, 1) = left(k.word, 1) and abs(length(r.word) - length(k.word)) <= 1
  union select r.word, k.word, k.freq from rare r join dict k on right(r.word, 1) = right(k.word, 1) and abs(length(r.word) - length(k.word)) <= 1),
p as (select *, damerau_levenshtein(word, correction) as edits from e where damerau_levenshtein(word, correction) <= 1),
b as (select *, row_number() over (partition by word order by edits, freq desc, correction) as r from p) select word, correction from b where r = 1""")
def spelling_domain(spark, sf_dir):
    """Corrections by a dictionary with words of the field."""
    from .queries import word_counts

    counts = word_counts(spark, sf_dir)
    known = spelling.with_domain_words(counts.where("n >= 40").select("word", F.col("n").alias("freq")), ["thn", "Thanedbla"])
    rare = counts.where("n < 40").select("word").join(known.select("word"), "word", "left_anti")
    return spelling.corrections(rare, known, edits=1)


@query("""with v as (select vec_id, label, cast(embedding as double[]) as e from embeddings),
d as (select a.vec_id, a.label as own, b.label as other, sum(list_distance(a.e, b.e)) as total, count(*) as n from v a, v b group by all),
s as (select vec_id, own, max(total / nullif(n - 1, 0)) filter (where own = other) as a, min(total / n) filter (where own <> other) as b from d group by vec_id, own),
x as (select count(distinct own) as k, avg(case when a is null or b is null then 0 else (b - a) / greatest(a, b) end) as silhouette, count(*) as n from s)
select k, n, g as silhouette_tenths, true as bounded from (select k, n, cast(round(silhouette, 1) * 10 as integer) as g from x)""")
def silhouette_bounded(spark, sf_dir):
    """The silhouette by balls: its estimate in tenths, and that it lies within its bounds."""
    from ..operators import semantic

    found = semantic.silhouette_bounds(table(spark, sf_dir, "embeddings"), cells=4096, sample=300)
    return found.select("k", "n", F.round(F.round("silhouette", 1) * 10).cast("int").alias("silhouette_tenths"), F.expr("low - 1e-9 <= silhouette and silhouette <= high + 1e-9").alias("bounded"))
