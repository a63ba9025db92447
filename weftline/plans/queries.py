"""Registered queries over the test tables, each with the DuckDB SQL it must
agree with. The texts are invented, so word lists that the operators take as
parameters are words of these texts here."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import dedupe, extraction, posts, rules, semantic, spelling, web
from ..session import bound_workers
from ..tables import settle, spread, work_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query, and its SQL if there is one."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return bound_workers(spark).read.parquet(f"{sf_dir}/{name}.parquet")


# Words of the test texts that stand in for the lexicons
KEYS = ["the ", "hat", "with", "ment"]
TYPES = [("fit", ["fit", "tion"]), ("color", ["hat", "lich"]), ("formality", ["for", "mente"]), ("accessories", ["tie", "elle"]), ("style", ["with", "pour", "und "])]
PROMO = ["free", "therea", "ment de"]
NAV = ["home", "worthless", "keit "]
NEED = ["the", "der", "que", "las"]
SAYS = ["and", "nicht", "pour", "est"]
GARMENT = ["hat", "tie", "sch", "ou"]

WS = r"\t-\r\x1c-\x20\x85\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
def strip_sql(x: str) -> str:
    return rf"regexp_replace({x}, '^[{WS}]+|[{WS}]+$', '', 'g')"


def collapse_sql(x: str) -> str:
    return rf"trim(regexp_replace({x}, '[{WS}]+', ' ', 'g'), ' ')"


def normal_sql(x: str) -> str:
    return collapse_sql(rf"regexp_replace(lower({x}), '[^\p{{L}}\p{{N}}_{WS}]', '', 'g')")


def count_sql(x: str) -> str:
    return rf"len(regexp_extract_all({x}, '[^{WS}]+'))"


def any_sql(x: str, keywords: list[str]) -> str:
    return "(" + " or ".join(f"contains({x}, '{k}')" for k in keywords) + ")"


def type_sql(x: str, lists) -> str:
    return "case " + " ".join(f"when {any_sql(f'lower({x})', ks)} then '{name}'" for name, ks in lists) + " else 'general' end"


#: Sentences of more than 20 characters of every whole document.
SENTENCES = rf"""
with parts as (select doc_id, source, string_split_regex(text, '[.!?]+') as s from documents where length({strip_sql("text")}) >= 20),
sent as (select doc_id, source, i - 1 as pos, {strip_sql("s[i]")} as sentence from (select doc_id, source, s, unnest(generate_series(1, len(s))) as i from parts)),
long as (select * from sent where length(sentence) > 20)
"""


def sentences_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.sentence_rows(spread(table(spark, sf_dir, "documents").select("doc_id", "source", "text")), max_text=None)


@query(
    SENTENCES
    + f"""select {type_sql("sentence", TYPES)} as rule_type, count(*) as rules, cast(sum({count_sql("sentence")}) as bigint) as words, count(distinct doc_id) as docs
from long where {any_sql("lower(sentence)", KEYS)} group by 1"""
)
def sentence_rule_types(spark, sf_dir):
    kept = sentences_of(spark, sf_dir).where(X.contains_any("sentence", KEYS))
    typed = kept.select("doc_id", rules.first_type("sentence", TYPES).alias("rule_type"), X.word_count("sentence").alias("n"))
    return typed.groupBy("rule_type").agg(F.count("*").alias("rules"), F.sum("n").cast("long").alias("words"), F.countDistinct("doc_id").alias("docs"))


# Conversations as posts: the first turn is the title, later turns are comments, scored by length


def threads(spark, sf_dir) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    comment = F.struct("turn", F.concat(F.lit("c"), F.col("turn").cast("string")).alias("comment_id"), F.col("text").alias("body"), (F.length("text") % 97).cast("long").alias("score"), "role")
    grouped = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(comment)).alias("c"))
    return grouped.select(
        F.col("conv_id").cast("string").alias("post_id"),
        F.col("conv_id").alias("pos"),
        F.concat(F.lit("r/"), (F.col("conv_id") % 7).cast("string")).alias("category"),
        F.substring(F.get("c", F.lit(0))["body"], 1, 60).alias("title"),
        F.coalesce(F.get("c", F.lit(1))["body"], F.lit("")).alias("selftext"),
        F.concat(F.lit("https://forum.example/"), F.col("conv_id").cast("string")).alias("url"),
        F.size("c").cast("long").alias("score"),
        F.transform("c", lambda c: F.struct(c["comment_id"].alias("comment_id"), c["body"].alias("body"), c["score"].alias("score"))).alias("comments"),
    )


THREADS = """
with turns as (select conv_id, turn, role, text, cast(length(text) % 97 as bigint) as score from conversations),
firsts as (select conv_id, count(*) as n, coalesce(max(text) filter (where k = 1), '') as first, coalesce(max(text) filter (where k = 2), '') as second
           from (select *, row_number() over (partition by conv_id order by turn) as k from turns) group by conv_id),
top as (select conv_id, turn, text, score, row_number() over (partition by conv_id order by score desc, turn) as r from turns)
"""


def post_sql(*parts: str) -> list[str]:
    return [f"nullif({strip_sql(p)}, '')" for p in parts]


@query(THREADS + f"select cast(f.conv_id as varchar) as post_id, concat_ws(chr(10) || chr(10), {', '.join(post_sql('left(first, 60)', 'second', 'top.text'))}) as text from firsts f join top on f.conv_id = top.conv_id and r = 1")
def flatten_text(spark, sf_dir):
    return posts.flatten(threads(spark, sf_dir), False).select("post_id", "text")


def sentence_case_sql(x: str) -> str:
    # no lookbehind in RE2: mark the ends of sentences, then split at the marks
    split = rf"string_split(regexp_replace({strip_sql(x)}, '([.!?])[{WS}]+', '\1' || chr(1), 'g'), chr(1))"
    ended = "case when regexp_matches(s, '[.!?]$') then s else s || '.' end"
    return rf"""array_to_string([regexp_extract(t, '^(\P{{L}}*)(\p{{L}}?)', 1) || upper(regexp_extract(t, '^(\P{{L}}*)(\p{{L}}?)', 2)) || substring(t, length(regexp_extract(t, '^(\P{{L}}*\p{{L}}?)', 1)) + 1)
      for t in [{ended} for s in [{strip_sql('p')} for p in {split}] if s <> '']], ' ')"""


@query(
    THREADS
    + f""", c as (select f.conv_id, {collapse_sql(f"concat_ws(' ', {', '.join(post_sql('left(first, 60)', 'second', 'top.text'))})")} as combined, {strip_sql('left(first, 60)')} as title
        from firsts f join top on f.conv_id = top.conv_id and r = 1)
select cast(conv_id as varchar) as post_id, title, 'r/' || cast(conv_id % 7 as varchar) as category, {sentence_case_sql('combined')} as clean_text from c where combined <> ''"""
)
def corpus_prepare(spark, sf_dir):
    return posts.prepare_corpus(threads(spark, sf_dir))


@query(THREADS + f"select cast(conv_id as varchar) as post_id, 'c' || cast(turn as varchar) as comment_id, score, {strip_sql('text')} as body from top where r = 1")
def top_comment(spark, sf_dir):
    best = threads(spark, sf_dir).select("post_id", posts.top_comment("comments").alias("c"))
    return best.select("post_id", "c.comment_id", "c.score", X.strip("c.body").alias("body"))


@query(THREADS + "select cast(conv_id as varchar) as post_id, cast(r - 1 as integer) as rank, 'c' || cast(turn as varchar) as comment_id, score from (select *, row_number() over (partition by conv_id order by score desc, turn) as r2 from turns where text <> '') t join (select conv_id as ci, turn as tu, r from top) x on t.conv_id = ci and t.turn = tu where r2 <= 3")
def top_k_comments(spark, sf_dir):
    best = threads(spark, sf_dir).select("post_id", F.posexplode(posts.top_comments("comments", 3)).alias("rank", "c"))
    return best.select("post_id", "rank", "c.comment_id", "c.score")


@query(THREADS + "select cast(f.conv_id as varchar) as post_id, cast(n as bigint) as score, count(*) filter (where t.score >= 40) as comments from firsts f join turns t on f.conv_id = t.conv_id where n >= 5 group by f.conv_id, n")
def post_score_filter(spark, sf_dir):
    return posts.by_score(threads(spark, sf_dir), 5, 40).select("post_id", "score", F.size("comments").cast("long").alias("comments"))


MARK = "marked"


def marked_threads(spark, sf_dir) -> DataFrame:
    """Comments of a length divisible by 5 bear the mark."""
    body = lambda c: F.when(F.length(c["body"]) % 5 == 0, F.lit(MARK)).otherwise(c["body"])
    return threads(spark, sf_dir).withColumn("comments", F.transform("comments", lambda c: F.struct(c["comment_id"].alias("comment_id"), body(c).alias("body"), c["score"].alias("score"))))


@query("select count(*) filter (where length(text) % 5 = 0) as deleted_total from conversations")
def deleted_count(spark, sf_dir):
    return posts.marked_total(marked_threads(spark, sf_dir), MARK)


@query("select cast(conv_id as varchar) as post_id, count(*) filter (where length(text) % 5 <> 0) as kept, count(*) filter (where length(text) % 5 <> 0) as kept_stripped from conversations group by conv_id")
def drop_deleted(spark, sf_dir):
    n = lambda c: F.size(c).cast("long")
    return marked_threads(spark, sf_dir).select("post_id", n(posts.drop_marked("comments", MARK)).alias("kept"), n(posts.drop_marked("comments", MARK, True)).alias("kept_stripped"))


@query("select cast(conv_id as varchar) as post_id, 'c' || cast(turn as varchar) as comment_id from conversations where length(text) % 5 <> 0")
def present_comments(spark, sf_dir):
    return posts.present_comments(marked_threads(spark, sf_dir), (MARK, "removed")).select("post_id", "comment.comment_id")


def doc_posts(spark, sf_dir) -> DataFrame:
    """Documents as posts: the title is the first 12 characters, two of three have an id."""
    docs = table(spark, sf_dir, "documents")
    return docs.select(F.col("doc_id").alias("pos"), F.col("source").alias("category"), F.substring("text", 1, 12).alias("title"), F.when(F.col("doc_id") % 3 == 0, "").otherwise((F.col("doc_id") % 50).cast("string")).alias("post_id"), "n_chars")


DOC_POSTS = "with p as (select doc_id as pos, source as category, left(text, 12) as title, case when doc_id % 3 = 0 then '' else cast(doc_id % 50 as varchar) end as post_id from documents)"


@query(DOC_POSTS + "select pos, category, title from (select *, row_number() over (partition by category, title order by pos) as r from p) where r = 1")
def dedupe_posts_title(spark, sf_dir):
    return posts.unique_titles(doc_posts(spark, sf_dir)).select("pos", "category", "title")


@query(DOC_POSTS + f"select pos, category, post_id from (select *, row_number() over (partition by category, coalesce(nullif(post_id, ''), {strip_sql('title')}) order by pos) as r from p) where r = 1")
def dedupe_posts_id(spark, sf_dir):
    return posts.unique_posts(doc_posts(spark, sf_dir)).select("pos", "category", "post_id")


def twice_threads(spark, sf_dir) -> DataFrame:
    """Threads whose comments all stand twice."""
    return threads(spark, sf_dir).withColumn("comments", F.concat("comments", "comments"))


@query(THREADS + """, k as (select conv_id, row_number() over (partition by conv_id % 7, left(first, 12) order by conv_id) as r from firsts),
a as (select count(distinct t.text) as n from k join turns t on t.conv_id = k.conv_id where r = 1 group by k.conv_id)
select count(*) as total_posts, count(*) filter (where r > 1) as duplicate_posts, count(*) filter (where r = 1) as remaining_posts,
(select 2 * count(*) from turns) - (select cast(sum(n) as bigint) from a) as duplicate_comments from k""")
def dedupe_counts(spark, sf_dir):
    rows = twice_threads(spark, sf_dir).withColumn("title", F.substring("title", 1, 12))
    return posts.dedupe_counts(rows, posts.unique_titles(rows).withColumn("comments", posts.unique_bodies("comments")), "comments")


@query("select cast(conv_id as varchar) as post_id, count(distinct text) as bodies, count(*) as pairs, 2 * count(*) - count(distinct text) as dropped from conversations group by conv_id")
def dedupe_comments(spark, sf_dir):
    n = lambda c: F.size(c).cast("long")
    rows = twice_threads(spark, sf_dir)
    return rows.select("post_id", n(posts.unique_bodies("comments")).alias("bodies"), n(posts.unique_comments("comments", False)).alias("pairs"), (n("comments") - n(posts.unique_bodies("comments"))).alias("dropped"))


@query("select source as category, count(*) as posts, cast(grouping(source) as integer) as is_total from documents group by rollup (source)")
def category_totals(spark, sf_dir):
    return posts.category_totals(table(spark, sf_dir, "documents").select(F.col("source").alias("category")))


@query(SENTENCES + f"select doc_id, cast(pos as integer) as pos, {normal_sql('sentence')} as norm from long")
def normalize_text(spark, sf_dir):
    return sentences_of(spark, sf_dir).select("doc_id", "pos", X.normalize("sentence").alias("norm"))


def rule_rows(spark, sf_dir) -> DataFrame:
    """Every long sentence as a rule; its source stands for the page."""
    rows = sentences_of(spark, sf_dir).select((F.col("doc_id") * 1_000_000 + F.col("pos")).alias("pos"), F.col("sentence").alias("rule_text"), "source")
    rows = rows.withColumns({"rule_type": rules.first_type("rule_text", TYPES), "word_count": X.word_count("rule_text")})
    rows = rows.withColumn("quality_score", rules.quality_b(F.col("word_count")))
    return rules.with_source(rows, F.concat(F.lit("https://"), F.col("source"), F.lit("/x")), F.col("source")).drop("source")


RULES = (
    SENTENCES
    + f""", rule as (select doc_id * 1000000 + pos as pos, sentence as rule_text, source, {type_sql("sentence", TYPES)} as rule_type, {count_sql("sentence")} as word_count,
  5 + case when {count_sql("sentence")} >= 8 then 2 else 0 end as quality_score from long),
merged as (select min(pos) as pos, count(*) as source_count, arg_min(rule_type, pos) as rule_type, arg_min(word_count, pos) as word_count, arg_min(quality_score, pos) as quality_score, arg_min(rule_text, pos) as rule_text,
  string_agg(source, ',' order by pos) as domains from rule group by {normal_sql("rule_text")})
"""
)


@query(RULES + "select pos, rule_text, rule_type, cast(source_count as integer) as source_count, domains from merged")
def merge_sources(spark, sf_dir):
    merged = rules.merge_sources(rule_rows(spark, sf_dir))
    return merged.select("pos", "rule_text", "rule_type", "source_count", F.array_join(F.transform("sources", lambda s: s["domain"]), ",").alias("domains"))


@query(RULES + """select count(*) as total_rules, count(*) filter (where source_count > 1) as multi_source_rules, round(count(*) filter (where source_count > 1) / count(*) * 100, 6) as multi_source_percentage,
round(avg(quality_score), 6) as avg_quality_score, round(avg(word_count), 6) as avg_word_count, cast(100.0 as double) as completeness_rate from merged""")
def rule_statistics(spark, sf_dir):
    s = rules.statistics(rules.merged_counts(rule_rows(spark, sf_dir), "quality_score", "word_count"))
    return s.select("total_rules", "multi_source_rules", *[F.round(c, 6).alias(c) for c in ("multi_source_percentage", "avg_quality_score", "avg_word_count")], "completeness_rate")


@query(RULES + "select rule_type, count(*) as rules from merged group by 1")
def rule_type_counts(spark, sf_dir):
    return rules.type_counts(rules.merged_counts(rule_rows(spark, sf_dir), "rule_type"))


@query("select count(distinct source) as unique_domains, (select string_agg(source, ',' order by source) from (select distinct source from documents)) as domains from documents")
def rule_domains(spark, sf_dir):
    d = rules.domain_list(rule_rows(spark, sf_dir))
    return d.select("unique_domains", F.array_join("domains", ",").alias("domains"))


def reasons_sql(x: str) -> str:
    low, n = f"lower({x})", count_sql(f"lower({x})")
    checks = [
        (f"{n} < 5", f"'Too short: ' || {n} || ' words'"),
        (f"{n} > 50", f"'Too long: ' || {n} || ' words'"),
        ("q < 7", "'Low quality score: ' || q"),
        (f"regexp_matches({low}, '{'|'.join(PROMO)}', 'i')", "'Contains promotional content'"),
        (f"regexp_matches({low}, '{'|'.join(NAV)}', 'i')", "'Contains navigational content'"),
        (f"not {any_sql(low, NEED)}", "'No fashion-related keywords found'"),
        (f"not {any_sql(low, SAYS)}", "'No advice indicators found'"),
    ]
    return "concat_ws('; ', " + ", ".join(f"case when {c} then {m} end" for c, m in checks) + ")"


JUDGED = SENTENCES + f", judged as (select doc_id, pos, {reasons_sql('sentence')} as reasons from (select *, 5 + case when {count_sql('sentence')} >= 8 then 2 else 0 end as q from long))"


def judged(spark, sf_dir) -> DataFrame:
    rows = sentences_of(spark, sf_dir).withColumn("n", X.word_count("sentence"))
    quality = rules.quality_b(F.col("n"))
    return rows.select("doc_id", "pos", rules.rejection_reasons("sentence", quality, promotional=PROMO, navigational=NAV, required=NEED, advice=SAYS).alias("reasons"))


@query(JUDGED + "select reasons, count(*) as n from judged group by 1")
def clean_reasons(spark, sf_dir):
    return judged(spark, sf_dir).groupBy(F.array_join("reasons", "; ").alias("reasons")).agg(F.count("*").alias("n"))


@query(JUDGED + "select count(*) as original_count, count(*) filter (where reasons = '') as valid_count, count(*) filter (where reasons <> '') as rejected_count, round_even(count(*) filter (where reasons = '') / count(*) * 100, 2) as validation_rate from judged")
def clean_stats(spark, sf_dir):
    return rules.clean_stats(judged(spark, sf_dir))


def error_sql(x: str) -> str:
    n = count_sql(x)
    upper = rf"len(regexp_extract_all(' ' || {x}, '[{WS}]\p{{Lu}}'))"
    return rf"""case when not regexp_matches({x}, '^\p{{Lu}}') then 'No capital start'
 when not regexp_matches({x}, '[.!]$') then 'No punctuation' when contains({x}, '?') then 'Contains question'
 when {n} < 5 then 'Too short (' || {n} || ' words)' when {n} > 30 then 'Too long (' || {n} || ' words)'
 when regexp_matches({x}, '{'|'.join(PROMO)}', 'i') then 'Prohibited content'
 when not {any_sql(f'lower({x})', SAYS)} then 'No advice indicator' when not {any_sql(f'lower({x})', NEED)} then 'No fashion terms'
 when {upper} > {n} * 0.4 then 'Too many capitals (article title)' end"""


#: Every second sentence keeps a full stop.
CHECKED = SENTENCES + f", s as (select doc_id * 1000000 + pos as pos, sentence || case when pos % 2 = 0 then '.' else '' end as t from long), e as (select pos, t, {error_sql('t')} as error from s)"


def checked(spark, sf_dir) -> DataFrame:
    rows = sentences_of(spark, sf_dir)
    rows = rows.select((F.col("doc_id") * 1_000_000 + F.col("pos")).alias("pos"), F.concat("sentence", F.when(F.col("pos") % 2 == 0, ".").otherwise("")).alias("rule_text"))
    return rows.withColumn("error", rules.first_error("rule_text", prohibited=PROMO, advice=SAYS, fashion=NEED))


@query(CHECKED + "select coalesce(error, 'valid') as error, count(*) as n from e group by 1")
def validate_first_error(spark, sf_dir):
    return checked(spark, sf_dir).groupBy(F.coalesce("error", F.lit("valid")).alias("error")).agg(F.count("*").alias("n"))


@query(CHECKED + """, i as (select left(t, 60) || ' <- ' || error as x, pos from e where error is not null order by pos limit 10)
select count(*) as total, count(*) filter (where error is null) as valid, count(*) filter (where error is not null) as invalid,
printf('%.1f%%', round_even(count(*) filter (where error is null) / count(*) * 100, 1)) as pass_rate, (select string_agg(x, '|' order by pos) from i) as sample_issues from e""")
def validate_report(spark, sf_dir):
    r = rules.validation_report(checked(spark, sf_dir))
    return r.withColumn("sample_issues", F.array_join(F.transform("sample_issues", lambda i: F.concat(i["text"], F.lit(" <- "), i["error"])), "|"))


@query(CHECKED + "select pos, t as rule_text from e where error is null")
def filter_invalid(spark, sf_dir):
    rows = checked(spark, sf_dir).drop("error")
    return rules.keep_valid(rows, prohibited=PROMO, advice=SAYS, fashion=NEED)


@query(SENTENCES + f"select count(*) as sentences, count(*) filter (where {any_sql('lower(sentence)', SAYS)} and {any_sql('lower(sentence)', GARMENT)}) as accepted from long")
def classify_fallback(spark, sf_dir):
    return sentences_of(spark, sf_dir).agg(F.count("*").alias("sentences"), F.count_if(rules.is_advice("sentence", SAYS, GARMENT)).alias("accepted"))


@query(SENTENCES + f"""select {type_sql("sentence", list(reversed(TYPES)))} as rule_type, greatest(1, least(10, 5 + case when {count_sql("sentence")} >= 8 then 2 else 0 end + cast(round_even((length(sentence) % 101) / 100.0::double * 3, 0) as integer))) as quality,
cast(floor((length(sentence) % 101) / 100.0::double * 10) as integer) as quality_a, count(*) as n from long group by all""")
def rule_type_and_quality(spark, sf_dir):
    similarity = (F.length("sentence") % 101) / F.lit(100.0)
    rows = sentences_of(spark, sf_dir).select(rules.first_type("sentence", list(reversed(TYPES))).alias("rule_type"), rules.quality_b(X.word_count("sentence"), similarity).alias("quality"), rules.quality_a(similarity).alias("quality_a"))
    return rows.groupBy("rule_type", "quality", "quality_a").agg(F.count("*").alias("n"))


@query(rf"""with l as (select doc_id, i, '1. ' || replace(parts[i], ', ', ' 2) ') as line from (select doc_id, string_split(text, chr(10)) as parts, unnest(generate_series(1, len(string_split(text, chr(10))))) as i from documents)),
p as (select doc_id, i - 1 as line_pos, string_split_regex(line, '\d+\.|\d+\)') as s from l where regexp_matches(line, '^(\d+\.|\d+\))[\s\x{{a0}}]+') and length(line) > 30),
q as (select doc_id, line_pos, j - 1 as part_pos, {strip_sql('s[j]')} as part from (select *, unnest(generate_series(1, len(s))) as j from p))
select doc_id, cast(line_pos as integer) as line_pos, cast(part_pos as integer) as part_pos, part from q where length(part) > 30""")
def numbered_split(spark, sf_dir):
    lines = spread(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_pos", "raw"))
    lines = lines.select("doc_id", "line_pos", F.concat(F.lit("1. "), F.replace("raw", F.lit(", "), F.lit(" 2) "))).alias("line"))
    return web.numbered_parts(lines)


# Pages


@query(r"select page_id, coalesce(nullif(string_split(url, '/')[3], null), 'unknown') as domain, regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1) as netloc, regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) as site from pages")
def url_domains(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", X.host_by_slashes("url").alias("domain"), X.netloc("url").alias("netloc"), X.site("url").alias("site"))


LINKS = r"""with h as (select page_id, url, regexp_extract_all(html, '(?i)<a\s(?:[^>]*\s)?href\s*=\s*["'']([^"'']*)["'']', 1) as hs from pages),
l as (select page_id, url, unnest(generate_series(1, len(hs))) as i, hs from h),
r as (select page_id, url, i - 1 as pos, hs[i] as href, regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) as base from l),
t as (select *, case when regexp_matches(trim(href), '^[A-Za-z][A-Za-z0-9+.-]*:') then trim(href) when starts_with(trim(href), '//') then regexp_extract(base, '^([A-Za-z][A-Za-z0-9+.-]*):', 1) || ':' || trim(href)
  when starts_with(trim(href), '/') then base || trim(href) when trim(href) = '' then base when starts_with(trim(href), '#') or starts_with(trim(href), '?') then base || trim(href)
  else base || '/' || regexp_replace(trim(href), '^(?:\.{1,2}/)+', '') end as target from r)
"""


@query(LINKS + "select page_id, cast(pos as integer) as pos, href, target from t")
def html_links(spark, sf_dir):
    # page_id goes along: several pages may have one URL
    found = web.resolved(web.links(table(spark, sf_dir, "pages"), keys=("page_id",)))
    return found.select("page_id", "pos", "href", "target")


LINK_KEYS = ["an", "er"]


@query(LINKS + rf"""select distinct regexp_extract(target, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1) as host, target from t
where regexp_extract(target, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1) = regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1)
and ({any_sql("lower(regexp_extract(target, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)', 1))", LINK_KEYS)} or {any_sql("regexp_extract(target, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1)", LINK_KEYS)})""")
def url_keyword(spark, sf_dir):
    return web.candidate_urls(web.resolved(web.links(table(spark, sf_dir, "pages"))), LINK_KEYS)


LINES_OF = rf"""with k as (select page_id, url, regexp_replace(html, '{web.BLOCK}', ' ', 'g') as html from pages),
x as (select page_id, url, regexp_extract_all(html, '{web.LINE}', 1) as raw from k),
n as (select page_id, url, [{collapse_sql("regexp_replace(r, '<[^>]*>', ' ', 'g')")} for r in raw] as lines from x)
"""


@query(LINES_OF + "select page_id, array_to_string([l for l in lines if length(l) > 30], ' ') as text from n")
def html_text_regex(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", web.native_text("html").alias("text"))


@query(LINES_OF + f""", e as (select page_id, unnest(generate_series(1, len(lines))) as i, lines from n), c as (select page_id, i - 1 as pos, lines[i] as text from e),
f as (select *, row_number() over (partition by page_id, text order by pos) as r from c where length(text) > 60 and {any_sql("lower(text)", SAYS)})
select page_id, cast(pos as integer) as pos, text from f where r = 1""")
def html_candidates_regex(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").cast("string").alias("key"), "html")
    return web.native_candidates(pages, SAYS, url="key").select(F.col("source").cast("long").alias("page_id"), "pos", "text")


@query()
def html_text_parser(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", web.html_text("html").alias("text"))


@query()
def html_candidates_parser(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").cast("string").alias("url"), "html")
    return web.html_candidates(pages, advice=SAYS, item=8)


@query(LINES_OF + """, c as (select page_id, len([l for l in lines if length(l) > 30]) as n from n)
select count(*) filter (where n > 0) as success, count(*) filter (where n <= 0) as fail, cast(sum(n) as bigint) as total_rules from c""")
def page_scrape_stats(spark, sf_dir):
    per = table(spark, sf_dir, "pages").select(F.size(F.filter(web.native_lines("html"), lambda x: F.length(x) > 30)).cast("long").alias("n_rules"))
    return rules.scrape_stats(per)


@query("""with recursive e as (select distinct p_partkey % 997 as src, (p_partkey % 997 * 7 + p_size) % 997 as dst from part),
r(node, depth) as (select 1, 0 union select dst, depth + 1 from r join e on src = node where depth < 4)
select node, cast(min(depth) as integer) as depth from r group by node""")
def crawl_reach(spark, sf_dir):
    # page links never lead to another page of the table: parts make the graph
    part = table(spark, sf_dir, "part")
    src = F.col("p_partkey") % 997
    edges = part.select(src.alias("src"), ((src * 7 + F.col("p_size")) % 997).alias("dst"))
    return web.reach(edges, spark.createDataFrame([(1,)], "node long"), rounds=4)


# Ids and increments


@query(SENTENCES + f"select doc_id, cast(pos as integer) as pos, sha1(lower({strip_sql('sentence')}) || '::' || cast(doc_id as varchar)) as rule_id, case when pos % 3 = 0 then sha1(lower({strip_sql('sentence')}) || '::' || cast(doc_id as varchar)) else 'own' end as filled from long")
def rule_ids(spark, sf_dir):
    rows = sentences_of(spark, sf_dir).withColumn("own", F.when(F.col("pos") % 3 == 0, F.when(F.col("pos") % 2 == 0, "auto").otherwise("")).otherwise("own"))
    return rows.select("doc_id", "pos", extraction.rule_id("sentence", "doc_id").alias("rule_id"), extraction.filled_id("own", "sentence", "doc_id").alias("filled"))


@query(SENTENCES + """, i as (select doc_id, pos, sha1(sentence) as rule_id from long), k as (select distinct rule_id from i where doc_id % 10 = 0),
f as (select rule_id, min(doc_id) as first from i where rule_id not in (select rule_id from k) group by rule_id)
select i.rule_id, i.doc_id, cast(i.pos as integer) as pos from i join f on i.rule_id = f.rule_id and i.doc_id = f.first""")
def novel_rules(spark, sf_dir):
    rows = sentences_of(spark, sf_dir).select("doc_id", "pos", F.sha1("sentence").alias("rule_id"))
    return extraction.novel(rows, rows.where("doc_id % 10 = 0"), post="doc_id").select("rule_id", "doc_id", "pos")


@query("select o_custkey as category, o_orderkey as post_id from orders o where not exists (select 1 from (select distinct o_custkey as c, o_orderkey as k from orders where o_orderstatus = 'F') f where f.c = o.o_custkey and f.k = o.o_orderkey)")
def known_posts(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    rows = orders.select(F.col("o_custkey").alias("category"), F.col("o_orderkey").alias("post_id"), "o_orderstatus")
    return posts.unseen(rows, rows.where("o_orderstatus = 'F'")).select("category", "post_id")


# Prompts and answers


def truncate_sql(x: str, n: int) -> str:
    return f"(case when length({x}) > {n} then left({x}, {n}) || '...' else {x} end)"


@query(
    THREADS
    + f""", p as (select f.conv_id, {strip_sql('left(first, 60)')} as title, {strip_sql('second')} as body, {strip_sql('top.text')} as best from firsts f join top on f.conv_id = top.conv_id and r = 1)
select cast(conv_id as varchar) as post_id, '<s>[INST] ' || chr(10) || chr(10) || 'Analyze this Reddit fashion post and extract any fashion rules or advice:' || chr(10) || chr(10) ||
concat_ws(chr(10) || chr(10), 'Title: ' || title, case when body <> '' then 'Post Content: ' || {truncate_sql('body', 500)} end, case when best <> '' then 'Top Comment: ' || {truncate_sql('best', 300)} end) ||
chr(10) || chr(10) || 'Return only valid JSON. [/INST]' as prompt from p"""
)
def prompt_extraction(spark, sf_dir):
    rows = threads(spark, sf_dir)
    return rows.select("post_id", extraction.forum_prompt(F.col("title"), F.col("selftext"), F.col("comments")).alias("prompt"))


@query(
    THREADS
    + f""", ranked as (select conv_id, turn, score, left({collapse_sql('text')}, 600) as body, row_number() over (partition by conv_id order by score desc, turn) as r from turns where text <> ''),
l as (select conv_id, string_agg('- (' || score || '↑) [c' || turn || '] ' || body, chr(10) order by r) as listed from ranked where r <= 16 and body <> '' and lower(body) <> '[deleted]' group by conv_id)
select cast(f.conv_id as varchar) as post_id, left({collapse_sql('''('You are an expert menswear editor. Extract concrete, atomic style rules from this discussion. Focus on durable rules (fit, proportion, color, formality), not product shilling. Post: - id: ' || f.conv_id || ' - title: ' || left(first, 60) || ' - selftext: ' || left(''' + collapse_sql('second') + ''', 1200) || ' Top comments: ' || coalesce(listed, '') || ' For each rule, include at least one citation snippet (<=240 chars) with the comment_id or post_id. ')''')}, 9000) as prompt
from firsts f left join l on f.conv_id = l.conv_id"""
)
def prompt_standard(spark, sf_dir):
    return threads(spark, sf_dir).select("post_id", extraction.digest_prompt(F.col("post_id"), F.col("title"), F.col("selftext"), F.col("comments")).alias("prompt"))


@query(rf"""with d as (select event_id, 'Sure: ' || case when event_id % 4 = 0 then replace(props, '}}', ', }}') when event_id % 4 = 1 then props || ' done' when event_id % 4 = 2 then left(props, length(props) - 1) else props end as answer from events),
c as (select event_id, regexp_replace({strip_sql('answer')}, ',[{WS}]*([}}\]])', '\1', 'g') as t from d),
s as (select event_id, nullif(regexp_extract(t, '\{{[^{{}}]*(?:\{{[^{{}}]*\}}[^{{}}]*)*\}}', 0), '') as j from c)
select event_id, case when j is not null and json_valid(j) then j end as salvaged, case when j is not null and json_valid(j) then coalesce(json_extract_string(j, '$.category'), 'none') end as category from s""")
def json_salvage(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    damaged = F.expr("case when event_id % 4 = 0 then replace(props, '}', ', }') when event_id % 4 = 1 then props || ' done' when event_id % 4 = 2 then left(props, length(props) - 1) else props end")
    answer = F.concat(F.lit("Sure: "), damaged)
    return e.select("event_id", X.salvage_json(answer).alias("salvaged"), extraction.parsed_extraction(answer)["category"].alias("category"))


RESULTS = "with r as (select d.doc_id, l.quality is not null as success, l.quality = 1 as has_rule, d.lang as category, l.toxic from documents d left join labels l using (doc_id))"


def results(spark, sf_dir) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    rows = docs.select("doc_id", F.col("lang").alias("category")).join(labels, "doc_id", "left")
    return rows.select(F.col("doc_id").alias("pos"), F.col("quality").isNotNull().alias("success"), (F.col("quality") == 1).alias("has_rule"), "category", "toxic")


@query(RESULTS + "select count(*) as total_posts, count(*) filter (where success) as successful_extractions, count(*) filter (where not success) as failed_extractions, count(*) filter (where success and has_rule) as posts_with_rules, count(*) filter (where success and not has_rule) as posts_without_rules from r")
def extraction_stats(spark, sf_dir):
    return extraction.extraction_stats(results(spark, sf_dir))


@query(RESULTS + "select category as value, count(*) as n from r where success and has_rule group by 1")
def extraction_distribution(spark, sf_dir):
    return extraction.distribution(results(spark, sf_dir), "category")


@query(RESULTS + ", s as (select doc_id // 100 as b, count(*) as n, count(*) filter (where success) as s, count(*) filter (where success and has_rule) as w from r group by 1) select cast(seen as bigint) as seen, cast(successful as bigint) as successful, cast(with_rules as bigint) as with_rules from (select sum(n) over (order by b) as seen, sum(s) over (order by b) as successful, sum(w) over (order by b) as with_rules, n from s) where n = 100")
def extraction_running(spark, sf_dir):
    return extraction.running_stats(results(spark, sf_dir))


@query("""select vec_id, concat_ws(',', case when label > 3 then 'rule_type' end, case when label = 0 then 'categories empty' end, case when label = 9 then 'categories' end,
case when not (embedding[1] + 0.9 between 0 and 1) then 'confidence' end, case when label % 5 < 1 then 'citations' end, case when label % 4 = 3 then 'safety' end) as errors from embeddings""")
def digest_validation(spark, sf_dir):
    from ..functions import lexicons as L

    kinds = F.array(*[F.lit(x) for x in L.RULE_TYPES])
    label = F.col("label")
    cats = F.when(label == 0, F.array().cast("array<string>")).when(label == 9, F.array(F.lit("hats"))).otherwise(F.array(F.lit("fit")))
    safety = F.when(label % 4 == 3, "extreme").when(label % 4 == 2, "low")
    errors = extraction.digest_errors(F.coalesce(F.get(kinds, label), F.lit("rumour")), cats, F.get("embedding", F.lit(0)) + F.lit(0.9).cast("float"), label % 5, safety)
    return table(spark, sf_dir, "embeddings").select("vec_id", F.array_join(errors, ",").alias("errors"))


@query(f"""with t as (select p_brand, list_distinct([p_type, ' ' || p_name || '"x" ', '']) as terms, p_partkey from part),
c as (select p_partkey, [x for x in [{strip_sql('y')} for y in [p_type, ' ' || p_name || '"x" ', '']] if x <> ''] as kept from part)
select p_partkey, array_to_string(['title:"' || replace(x, '"', '\\"') || '"' for x in kept], ' OR ') as query_string from c""".replace("\\\\", "\\"))
def search_query_build(spark, sf_dir):
    terms = F.array("p_type", F.concat(F.lit(" "), F.col("p_name"), F.lit('"x" ')), F.lit(""))
    return table(spark, sf_dir, "part").select("p_partkey", X.search_string(terms).alias("query_string"))


# Fuzzy de-duplication


def part_rules(spark, sf_dir) -> DataFrame:
    """Every part's type and brand as a rule; many are alike."""
    part = table(spark, sf_dir, "part")
    return part.select(F.col("p_partkey").alias("pos"), F.concat_ws(" ", "p_type", "p_brand").alias("rule_text"))


@query()
def fuzzy_dedupe_seq(spark, sf_dir):
    return dedupe.fuzzy_dedupe(rule_rows(spark, sf_dir).select("pos", "rule_text"))


LEV = f"""with recursive u as (select min(p_partkey) as pos, norm, row_number() over (order by min(p_partkey)) as k
  from (select p_partkey, {normal_sql("concat_ws(' ', p_type, p_brand)")} as norm from part) group by norm),
walk(k, kept) as (select cast(0 as bigint), cast([] as varchar[]) union all
  select u.k, case when len([x for x in kept if abs(length(x) - length(u.norm)) <= 0.15 * greatest(length(x), length(u.norm)) + 1e-9 and
    (case when greatest(length(x), length(u.norm)) = 0 then 1.0 else 1 - levenshtein(u.norm, x) / greatest(length(x), length(u.norm)) end) >= 0.85]) > 0 then kept else list_append(kept, u.norm) end
  from walk join u on u.k = walk.k + 1),
last as (select kept from walk order by k desc limit 1)
select u.pos, u.norm from u, last where list_contains(kept, u.norm)"""


@query(LEV)
def fuzzy_dedupe_lev(spark, sf_dir):
    kept = dedupe.fuzzy_dedupe(part_rules(spark, sf_dir), ratio="levenshtein")
    return kept.select("pos", X.normalize("rule_text").alias("norm"))


# Embeddings


@query("""with p as (select cast(embedding as double[]) as p from embeddings where vec_id < 3), v as (select vec_id, cast(embedding as double[]) as e from embeddings)
select vec_id, round(max(list_cosine_similarity(e, p)), 6) as similarity, max(list_cosine_similarity(e, p)) > 0.5 as close from v, p group by vec_id""")
def cosine_prototypes(spark, sf_dir):
    v = table(spark, sf_dir, "embeddings")
    best = semantic.best_prototype(v, v.where("vec_id < 3").select(F.col("embedding").alias("prototype")))
    return best.select("vec_id", F.round("similarity", 6).alias("similarity"), (F.col("similarity") > 0.5).alias("close"))


@query("""with p as (select cast((select embedding from embeddings where vec_id = 0) as double[]) as a, cast((select embedding from embeddings where vec_id = 1) as double[]) as b)
select vec_id, list_cosine_similarity(cast(embedding as double[]), a) > 0.1 and list_cosine_similarity(cast(embedding as double[]), a) > list_cosine_similarity(cast(embedding as double[]), b) as is_rule from embeddings, p""")
def threshold_classify(spark, sf_dir):
    v = table(spark, sf_dir, "embeddings")
    one = lambda i, name: v.where(F.col("vec_id") == i).select(F.col("embedding").alias(name))
    rows = v.crossJoin(F.broadcast(one(0, "a"))).crossJoin(F.broadcast(one(1, "b")))
    return rows.select("vec_id", semantic.is_rule(X.cosine("embedding", "a"), X.cosine("embedding", "b"), 0.1).alias("is_rule"))


@query("""with v as (select vec_id, label, cast(embedding as double[]) as e from embeddings),
d as (select a.vec_id, a.label as own, b.label as other, sum(list_distance(a.e, b.e)) as total, count(*) as n from v a, v b group by all),
s as (select vec_id, own, max(total / nullif(n - 1, 0)) filter (where own = other) as a, min(total / n) filter (where own <> other) as b from d group by vec_id, own)
select count(distinct own) as k, round(avg(case when a is null or b is null then 0 else (b - a) / greatest(a, b) end), 6) as silhouette from s""")
def silhouette_exact(spark, sf_dir):
    return semantic.silhouette(table(spark, sf_dir, "embeddings")).select("k", F.round("silhouette", 6).alias("silhouette"))


@query()
def kmeans_scan(spark, sf_dir):
    best = semantic.kmeans_scan(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), range(6, 19), iterations=10)
    return spark.createDataFrame([(k, s) for k, _, s in best], "k int, silhouette double")


def clustered(spark, sf_dir) -> DataFrame:
    v, d = table(spark, sf_dir, "embeddings"), table(spark, sf_dir, "documents")
    rows = v.join(d, F.col("vec_id") == F.col("doc_id"))
    return rows.select(F.col("label").alias("cluster"), F.col("vec_id").alias("pos"), F.col("vec_id").cast("string").alias("post_id"), F.col("source").alias("category"), F.col("text").alias("clean_text"))


CLUSTERED = "with j as (select label as cluster, vec_id as pos, source as category, text from embeddings join documents on vec_id = doc_id)"


@query(CLUSTERED + ", c as (select cluster, category, count(*) as n, min(pos) as f from j group by all) select cluster, category, n as count, cast(rank as integer) as rank from (select *, row_number() over (partition by cluster order by n desc, f) as rank from c) where rank <= 5")
def cluster_categories(spark, sf_dir):
    return semantic.cluster_categories(clustered(spark, sf_dir))


@query(CLUSTERED + ", e as (select cluster, cast(pos as varchar) as post_id, left(text, 320) as excerpt, row_number() over (partition by cluster order by pos) as rank from j) select cluster, post_id, excerpt, cast(rank as integer) as rank from e where rank <= 5")
def cluster_examples(spark, sf_dir):
    return semantic.cluster_examples(clustered(spark, sf_dir))


@query(CLUSTERED + """, c as (select cluster, category, count(*) as n, min(pos) as f from j where coalesce(category, '') <> '' group by all),
a as (select cluster, string_agg(category || ':' || n, ',' order by rank) as top_categories from (select *, row_number() over (partition by cluster order by n desc, f) as rank from c) where rank <= 5 group by 1),
e as (select cluster, string_agg(pos || ':' || length(left(text, 320)), ',' order by pos) as examples from (select *, row_number() over (partition by cluster order by pos) as rank from j) where rank <= 5 group by 1)
select e.cluster, top_categories, examples from e left join a on a.cluster = e.cluster""")
def cluster_summary(spark, sf_dir):
    s = semantic.cluster_summary(clustered(spark, sf_dir))
    cats = F.array_join(F.transform("top_categories", lambda c: F.concat_ws(":", c["category"], c["count"].cast("string"))), ",")
    examples = F.array_join(F.transform("examples", lambda e: F.concat_ws(":", e["post_id"], F.length(e["excerpt"]).cast("string"))), ",")
    return s.select("cluster", cats.alias("top_categories"), examples.alias("examples"))


# Spelling


TOKENS = """with l as (select doc_id, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]+') as ts from documents), t as (select doc_id, unnest(ts) as token from l),
w as (select lower(token) as word, count(*) as n from t where regexp_full_match(token, '[A-Za-z]+') and length(token) > 2 group by 1)
"""


def word_counts(spark, sf_dir) -> DataFrame:
    found = spelling.token_rows(spread(table(spark, sf_dir, "documents").select("doc_id", "text")), "doc_id")
    return found.where(F.col("token").rlike("^[A-Za-z]{3,}$")).groupBy(F.lower("token").alias("word")).agg(F.count("*").alias("n"))


@query(TOKENS + """, known as (select word, n as freq from w where n >= 40), rare as (select word from w where n < 40),
e as (select r.word, k.word as correction, k.freq from rare r join known k on left(r.word, 1) = left(k.word, 1) and abs(length(r.word) - length(k.word)) <= 1
  union select r.word, k.word, k.freq from rare r join known k on right(r.word, 1) = right(k.word, 1) and abs(length(r.word) - length(k.word)) <= 1),
p as (select *, damerau_levenshtein(word, correction) as edits from e where damerau_levenshtein(word, correction) <= 1),
b as (select *, row_number() over (partition by word order by edits, freq desc, correction) as r from p) select word, correction from b where r = 1""")
def token_spelling(spark, sf_dir):
    counts = word_counts(spark, sf_dir)
    known = counts.where("n >= 40").select("word", F.col("n").alias("freq"))
    rare = counts.where("n < 40").select("word")
    return spelling.corrections(rare, known, edits=1)


@query()
def token_spelling_two(spark, sf_dir):
    """As token_spelling, within the operator's own two edits. Blocks by the
    first or last letter would lose pairs here, so there is no SQL."""
    counts = settle(word_counts(spark, sf_dir))
    known = counts.where("n >= 40").select("word", F.col("n").alias("freq"))
    return spelling.corrections(counts.where("n < 40").select("word"), known)


@query()
def topic_terms(spark, sf_dir):
    from ..operators.topics import topic_terms as terms

    return terms(table(spark, sf_dir, "conversations"), k=4, min_docs=2)[1]


@query()
def zero_shot(spark, sf_dir):
    score = lambda texts, labels: [[(len(t) + len(x)) % 10 / 10 for x in labels] for t in texts]
    rows = extraction.zero_shot(table(spark, sf_dir, "conversations").select("text"), score)
    return rows.select("text", "label", "score")


@query("select doc_id, source, n_chars from documents")
def incremental_append(spark, sf_dir):
    """Documents in two streamed batches of files into one target, each id once."""
    import uuid

    from ..streaming.incremental import run_incremental

    work = f"{work_dir(spark)}/incremental-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    docs.union(docs).repartition(4).write.parquet(f"{work}/in")
    return run_incremental(spark, f"{work}/in", docs.schema, f"{work}/out", f"{work}/checkpoint", ["doc_id"], files_per_batch=2)


@query("select time_bucket(interval 1 hour, ts) as window_start, event_type, count(*) as n, round(sum(value), 4) as total from events group by all")
def event_windows(spark, sf_dir):
    from ..streaming.incremental import tumbling_counts

    rows = tumbling_counts(table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp")))
    return rows.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n", F.round("total", 4).alias("total"))


__all__ = ["QUERIES", "SQL", "Window", "query"]
