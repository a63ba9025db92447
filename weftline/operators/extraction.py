"""Language models at arm's length: prompts, answers, digests and their ids.

A model is any function from a list of prompts to a list of answers. It runs
over batches, once per worker; what surrounds it is expressions. The stub gives
deterministic answers where there is no model."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import lexicons as L
from ..functions.jsonschema import ERRORS, schema_errors, without_required
from ..functions.schemas import DIGEST, EXTRACTION, FILLED, digest_schema
from ..functions.text import cut, salvage_json, strip, truncate, utc_seconds, word_count
from ..tables import settle
from .posts import DELETED, top_comment_text, top_comments

Model = Callable[[list[str]], list[str]]


def filled(template: str, **values: Column) -> Column:
    """A text with each {name} replaced by a column."""
    parts = re.split(r"\{(\w+)\}", template)
    return F.concat(*[values[x] if i % 2 else F.lit(x) for i, x in enumerate(parts) if x])


def forum_prompt(title: Column, selftext: Column, comments: Column, system: str = "", text_cut: int = 500, comment_cut: int = 300) -> Column:
    """Title, post and top comment, each cut with dots, as an instruction."""
    body, top = strip(F.coalesce(selftext, F.lit(""))), top_comment_text(comments)
    parts = [
        F.concat(F.lit(L.FORUM_TITLE), strip(F.coalesce(title, F.lit("")))),
        F.when(body != "", F.concat(F.lit(L.FORUM_POST), truncate(body, text_cut))),
        F.when(top != "", F.concat(F.lit(L.FORUM_COMMENT), truncate(top, comment_cut))),
    ]
    return filled(L.FORUM_PROMPT, system=F.lit(system), content=F.concat_ws("\n\n", *parts))


def web_prompt(text: Column, system: str = "") -> Column:
    return filled(L.WEB_PROMPT, system=F.lit(system), content=text)


def digest_prompt(post_id: Column, title: Column, selftext: Column, comments: Column, k: int = 16, whole: int = 9000) -> Column:
    """The post and its best comments as one line of at most ``whole``
    characters. Emptied and deleted comments are left out, not replaced."""
    body = lambda c: cut(c["body"], 600)
    kept = F.filter(top_comments(comments, k), lambda c: (body(c) != "") & (F.lower(body(c)) != DELETED))
    listed = F.transform(kept, lambda c: F.concat(F.lit("- ("), c["score"].cast("string"), F.lit("↑) ["), F.coalesce(c["comment_id"], F.lit("")), F.lit("] "), body(c)))
    text = lambda c, n: cut(F.coalesce(c, F.lit("")), n)
    return cut(filled(L.DIGEST_PROMPT, post_id=F.coalesce(post_id, F.lit("")), title=text(title, 300), selftext=text(selftext, 1200), comments=F.array_join(listed, "\n")), whole)


def model_udf(model: Model):
    """(answer, error) per prompt: an exception of the model is that row's error."""

    @F.pandas_udf("struct<answer:string,error:string>")
    def answered(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in parts:
            prompts = part.fillna("").tolist()
            try:
                rows = [(a, None) for a in model(prompts)]
            except Exception:  # then one by one, to know which
                rows = []
                for p in prompts:
                    try:
                        rows.append((model([p])[0], None))
                    except Exception as e:
                        rows.append((None, str(e)))
            yield pd.DataFrame(rows, columns=["answer", "error"])

    return answered


def stub_model(prompts: list[str]) -> list[str]:
    """Reports each sentence of the prompt's content that has "should" or "never"."""
    import json

    out = []
    for p in prompts:
        body = p.split(":\n\n", 1)[-1].split("\n\nReturn only", 1)[0]
        rules = [s.strip() for s in re.split(r"[.!?]+", body) if re.search("should|never", s)]
        out.append(json.dumps({"has_fashion_rule": bool(rules), "rules": rules, "category": "general" if rules else "none", "confidence": "medium"}))
    return out


def parsed_extraction(answer: Column) -> Column:
    """The answer's object with defaults for what is missing; null if no JSON."""
    found = F.from_json(salvage_json(answer), EXTRACTION)
    return F.when(
        salvage_json(answer).isNotNull(),
        F.struct(
            F.coalesce(found["has_fashion_rule"], F.lit(False)).alias("has_fashion_rule"),
            F.coalesce(found["rules"], F.array().cast("array<string>")).alias("rules"),
            F.coalesce(found["category"], F.lit("none")).alias("category"),
            F.coalesce(found["confidence"], F.lit("low")).alias("confidence"),
        ),
    )


def extract_posts(posts: DataFrame, model: Model = stub_model, system: str = "") -> DataFrame:
    """post_id, title, source_category, url, extraction, success, error,
    raw_response: a row for every post, also where the model failed."""
    asked = posts.withColumn("__r", model_udf(model)(forum_prompt(F.col("title"), F.col("selftext"), F.col("comments"), system)))
    rows = asked.withColumn("extraction", parsed_extraction(F.col("__r.answer"))).withColumn("success", F.col("extraction").isNotNull())
    failed = F.col("__r.error").isNull() & ~F.col("success")
    error = F.when(failed, F.concat(F.lit(L.ERROR_JSON), F.substring("__r.answer", 1, 200))).otherwise(F.col("__r.error"))
    text = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c if c != "category" else "source_category")
    return rows.select(text("post_id"), text("title"), text("category"), text("url"), "extraction", "success", error.alias("error"), F.when(failed, F.substring("__r.answer", 1, 300)).alias("raw_response"))


WEB_RULES = "has_fashion_rule boolean, rules array<struct<rule_text:string,rule_type:string,quality_score:int,word_count:int>>"


def extract_pages(pages: DataFrame, model: Model, text: str = "text", system: str = "") -> DataFrame:
    """The columns of pages, and (pos, rule_text, rule_type, quality_score,
    word_count, error): a row for each rule that a model finds in a page's text. Word
    counts are filled in where the answer has none. A page without a rule has none, and one
    whose model fails, or whose answer is no JSON, a row with the error."""
    asked_ = pages.withColumn("__r", model_udf(model)(web_prompt(F.coalesce(F.col(text), F.lit("")), system)))
    found = F.from_json(salvage_json(F.col("__r.answer")), WEB_RULES)
    failed = F.when(F.col("__r.error").isNotNull(), F.col("__r.error")).when(salvage_json(F.col("__r.answer")).isNull(), F.concat(F.lit(L.ERROR_JSON), F.substring("__r.answer", 1, 200)))
    rules = F.when(found["has_fashion_rule"], found["rules"])
    rows = asked_.select(*[F.col(f"`{c}`") for c in pages.columns if c != text], failed.alias("error"), rules.alias("rules"))
    listed = F.when(F.col("error").isNotNull(), F.array(F.lit(None).cast("struct<rule_text:string,rule_type:string,quality_score:int,word_count:int>"))).otherwise(F.col("rules"))
    rows = rows.select(*[c for c in rows.columns if c != "rules"], F.posexplode(listed).alias("pos", "rule"))
    words = F.when(F.col("rule").isNotNull(), F.coalesce("rule.word_count", word_count(F.coalesce("rule.rule_text", F.lit(""))).cast("int")))
    return rows.select(*[c for c in rows.columns if c not in ("error", "rule")], "rule.rule_text", "rule.rule_type", "rule.quality_score", words.alias("word_count"), "error")


def extraction_stats(results: DataFrame) -> DataFrame:
    """total, successful, failed, with and without rules."""
    n, ok = F.count("*"), F.count_if(F.col("success"))
    ruled = F.count_if(F.col("success") & F.coalesce(F.col("has_rule"), F.lit(False)))
    return results.agg(n.alias("total_posts"), ok.alias("successful_extractions"), (n - ok).alias("failed_extractions"), ruled.alias("posts_with_rules"), (ok - ruled).alias("posts_without_rules"))


def distribution(results: DataFrame, column: str) -> DataFrame:
    """How often each value occurs among successes with a rule, commonest first."""
    return results.where(F.col("success") & F.col("has_rule")).groupBy(F.coalesce(F.col(column), F.lit("unknown")).alias("value")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value")


def running_stats(results: DataFrame, order: str = "pos", every: int = 100, wide: int = 10_000) -> DataFrame:
    """Successes and rules so far, at every hundredth result (``order`` counts
    from 0 without gaps): sums per hundred, running sums inside stretches of so
    many hundreds, and before each stretch the sum of the stretches so far."""
    blocks = results.groupBy(F.floor(F.col(order) / every).alias("block")).agg(F.count("*").alias("n"), F.count_if("success").alias("s"), F.count_if(F.col("success") & F.col("has_rule")).alias("r"))
    blocks = blocks.withColumn("stretch", F.floor(F.col("block") / wide))
    before = Window.orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    stretches = blocks.groupBy("stretch").agg(*[F.sum(c).alias(c) for c in "nsr"])
    bases = stretches.select("stretch", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}0") for c in "nsr"])
    so_far = Window.partitionBy("stretch").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    inside = blocks.select("stretch", F.col("n").alias("full"), *[F.sum(c).over(so_far).alias(c) for c in "nsr"])
    sums = inside.join(bases, "stretch").where(F.col("full") == every)
    return sums.select((F.col("n0") + F.col("n")).alias("seen"), (F.col("s0") + F.col("s")).alias("successful"), (F.col("r0") + F.col("r")).alias("with_rules"))


def rule_id(text: Column | str, post_id: Column | str) -> Column:
    t = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    return F.sha1(F.concat(F.lower(strip(t)), F.lit("::"), F.col(post_id).cast("string") if isinstance(post_id, str) else post_id))


def filled_id(own: Column | str, text: Column | str, post_id: Column | str) -> Column:
    """The id, or one made of text and post where it is blank or "auto"."""
    c = F.col(own) if isinstance(own, str) else own
    return F.when(c.isNull() | c.isin("", "auto"), rule_id(text, post_id)).otherwise(c)


def novel(rules: DataFrame, known: DataFrame, key: str = "rule_id", post: str = "post_pos") -> DataFrame:
    """Rules whose id isn't known and doesn't occur in an earlier post; equal
    ids within one post stay."""
    fresh = rules.join(known.select(key).distinct(), key, "left_anti")
    first = fresh.groupBy(key).agg(F.min(post).alias("__first"))
    return fresh.join(first, key).where(F.col(post) == F.col("__first")).drop("__first")


def stamped(digests: DataFrame, now: Column | None = None) -> DataFrame:
    """extracted_at in UTC."""
    return digests.withColumn("extracted_at", utc_seconds(F.current_timestamp() if now is None else now))


def snippet(text: Column | str) -> Column:
    return cut(text, 240)


def digest_errors(rule_type: Column, categories: Column, confidence: Column, citations: Column, safety: Column) -> Column:
    """What of a rule breaks the schema; empty for a valid one."""
    checks = [
        (~F.coalesce(rule_type.isin(L.RULE_TYPES), F.lit(False)), "rule_type"),
        (F.coalesce(F.size(categories), F.lit(0)) < 1, "categories empty"),
        (F.size(F.filter(categories, lambda c: ~c.isin(L.CATEGORIES))) > 0, "categories"),
        (~F.coalesce(confidence.between(0, 1), F.lit(False)), "confidence"),
        (F.coalesce(citations, F.lit(0)) < 1, "citations"),
        (safety.isNotNull() & ~safety.isin(L.SEVERITIES), "safety"),
    ]
    return F.filter(F.array(*[F.when(c, F.lit(m)) for c, m in checks]), lambda x: x.isNotNull())


def asked(model: Model):
    """The model's answers to prompts; null to null, which it isn't asked."""

    @F.pandas_udf("string")
    def answers(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            out, wanted = pd.Series([None] * len(part), dtype=object), part.notna().to_numpy()
            if wanted.any():
                out[wanted] = list(model(part[wanted].tolist()))
            yield out

    return answers.asNondeterministic()  # so that no plan asks twice


def ask_again(posts: DataFrame, prompt: Column, model: Model, schema: dict, retries: int = 1, answer: str = "answer", errors: str = "errors") -> DataFrame:
    """posts with the model's answer and what of it breaks the schema. Where that is
    something, the model is asked again with an added demand, up to so many times;
    the last answer stays with its errors. Each round asks only those of the one
    before that failed, and is written before the next, so nobody is asked twice."""
    rows = posts.withColumns({"__prompt": F.coalesce(prompt, F.lit("")), answer: F.lit(None).cast("string"), errors: F.lit(None).cast(ERRORS)})
    for _ in range(1 + retries):
        open_ = F.col(errors).isNull() | (F.size(errors) > 0)
        rows = rows.withColumn("__new", asked(model)(F.when(open_, F.col("__prompt"))))
        given = F.when(open_, F.col("__new")).otherwise(F.col(answer))
        demand = F.when(open_, F.concat("__prompt", F.lit(L.STRICT))).otherwise(F.col("__prompt"))
        rows = rows.withColumns({answer: given, "__prompt": demand}).drop("__new")
        # an answer of null is none
        rows = settle(rows.withColumn(errors, schema_errors(F.coalesce(F.col(answer), F.lit("")), schema)))
        if rows.where(F.size(errors) > 0).isEmpty():
            break
    return rows.drop("__prompt")


def digests(posts: DataFrame, model: Model, known: DataFrame, retries: int = 1, now: Column | None = None, schema: dict | None = None) -> DataFrame:
    """A row per novel rule of each post: prompt, answer, schema, ids, novelty.
    posts: (pos, post_id, title, url, selftext, comments). ``schema`` is that of
    digests without what is filled in here, unless another is given."""
    schema = without_required(digest_schema(), FILLED) if schema is None else schema
    answered = ask_again(posts, digest_prompt(F.col("post_id"), F.col("title"), F.col("selftext"), F.col("comments")), model, schema, retries, "__answer", "__errors")
    found = answered.where(F.size("__errors") == 0).withColumn("__d", F.from_json("__answer", DIGEST))
    rows = found.select(F.col("pos").alias("post_pos"), F.col("post_id").alias("source_post_id"), F.col("title").alias("source_title"), F.col("url").alias("source_url"), F.posexplode("__d.rules").alias("rule_pos", "rule"))
    rows = rows.withColumn("rule_id", filled_id(F.col("rule.rule_id"), F.col("rule.text"), F.col("source_post_id")))
    return stamped(novel(rows, known), now)


def zero_shot(texts: DataFrame, score: Callable[[list[str], list[str]], list[list[float]]], labels: list[str] | None = None, text: str = "text", n: int = 10, seed: int = 0, text_cut: int = 512) -> DataFrame:
    """n sampled texts with their best label and its score. The sample is the
    first by a seeded hash of the text: the same in every run."""
    labels = L.LABELS if labels is None else labels

    @F.pandas_udf("struct<label:string,score:double>")
    def judged(part: pd.Series) -> pd.DataFrame:
        rows = [max(zip(s, labels, strict=True), key=lambda x: x[0]) for s in score(part.fillna("").tolist(), labels)]
        return pd.DataFrame([(b, a) for a, b in rows], columns=["label", "score"])

    sample = texts.orderBy(F.xxhash64(F.lit(seed), text), text).limit(n)
    return sample.withColumn("__j", judged(F.substring(text, 1, text_cut))).select("*", "__j.*").drop("__j")
