"""Whole runs: pages to a rule table, and forum posts to clusters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import host_by_slashes, netloc, word_count
from ..operators import crawl, dedupe, posts, rules, web
from ..tables import settle

#: Of the full run: stricter on length, milder on quality than the cleaner alone.
FULL = {"min_words": 5, "max_words": 7, "min_quality": 6}


def rules_from_pages(pages: DataFrame, threshold: float | None = None, keep_terminator: bool = False, **lists) -> DataFrame:
    """(pos, rule_text, rule_type, quality_score, word_count, sources,
    source_count) from (url, html): article text, sentences with a keyword.
    ``keep_terminator`` ends sentences with a stop, which the validator wants."""
    from ..functions import lexicons as L

    texts = pages.select("url", web.html_text("html").alias("text"))
    found = rules.sentence_rows(texts).where(rules.contains_any("sentence", lists.get("keywords", L.KEYWORDS)))
    sentence = F.concat("sentence", F.lit(".")) if keep_terminator else F.col("sentence")
    found = found.select("url", "pos", sentence.alias("rule_text"))
    found = found.withColumns({"rule_type": rules.first_type("rule_text", lists.get("types", L.TYPES_A)), "word_count": word_count("rule_text")})
    found = found.withColumn("quality_score", rules.quality_b(F.col("word_count")))
    return rules.with_source(found, F.col("url"), host_by_slashes("url")).drop("url")


def rules_by_similarity(docs: DataFrame, encode, templates: list[str] | None = None, keywords: list[str] | None = None, types=None, threshold: float = 0.5, text: str = "text") -> DataFrame:
    """Sentences with a keyword whose embedding is nearer than ``threshold`` to a
    template; type by words, quality by similarity. ``encode`` is a model (list
    of texts -> list of vectors); keywords are tested before it is asked."""
    from ..functions import lexicons as L
    from ..operators import semantic

    keys = [c for c in docs.columns if c != text]
    found = rules.sentence_rows(docs, text).where(rules.contains_any("sentence", keywords or L.KEYWORDS))
    model = semantic.encoder_udf(encode)
    rows = docs.sparkSession.createDataFrame([(t,) for t in templates or L.TEMPLATES], "t string").select(model("t").alias("prototype"))
    found = found.withColumn("embedding", model("sentence"))
    near = semantic.best_prototype(found, rows, keys=(*keys, "pos", "sentence")).where(F.col("similarity") > threshold)
    return near.select(*keys, "pos", F.col("sentence").alias("rule_text"), rules.first_type("sentence", types or L.TYPES_A).alias("rule_type"), rules.quality_a(F.col("similarity")).alias("quality_score"), word_count("sentence").alias("word_count"), "similarity")


def rules_from_site(pages: DataFrame, advice=None, garments=None, types=None, **lengths) -> tuple[DataFrame, DataFrame]:
    """(rules, statistics) by candidates, the classifier without a model, types
    and scores of the discovery run."""
    from ..functions import lexicons as L

    found = web.html_candidates(pages, **lengths)
    kept = found.where(rules.is_advice("text", advice or L.FALLBACK_ADVICE, garments or L.FALLBACK_GARMENTS))
    kept = kept.select("source", "pos", F.col("text").alias("rule_text"), rules.first_type("text", types or L.TYPES_B).alias("rule_type"), word_count("text").alias("word_count"))
    kept = kept.withColumn("quality_score", rules.quality_b(F.col("word_count")))
    out = rules.with_source(kept, F.col("source"), netloc("source")).drop("source")
    return out, rules.statistics(out).join(rules.domain_list(out))


def distill(found: DataFrame, threshold: float = 0.85, ratio: str = "sequence", order: str = "pos", merge: str = "kept") -> DataFrame:
    """Rules without near-duplicates, sources merged. ``merge``: "kept" merges
    what is left (sources of dropped near-duplicates go); "all" merges equal
    texts first."""
    if merge == "all":
        first = rules.merge_sources(found, order=order)
        return dedupe.fuzzy_dedupe(first, order=order, threshold=threshold, ratio=ratio)
    return rules.merge_sources(dedupe.fuzzy_dedupe(found, order=order, threshold=threshold, ratio=ratio), order=order)


def scraped(urls: DataFrame, pages: crawl.Fetcher) -> DataFrame:
    """(url, html) of a list of URLs, fetched where they are dealt to: all of one
    host by one task. Pages that fail have no text."""
    asked = urls.select(F.coalesce(netloc("url"), F.lit("")).alias("site"), "url", F.lit(0).alias("depth"), F.monotonically_increasing_id().alias("rank"))
    return pages(asked).select("url", "html")


def discover(seeds: DataFrame, pages: crawl.Fetcher, keywords=None, max_pages: int = 80, folder: str | None = None, **options) -> tuple[DataFrame, DataFrame]:
    """(rules, statistics) of the sites of some seeds: a crawl, the pages that its
    links promise, and the rules of these."""
    from ..functions import lexicons as L

    visited = crawl.crawl(seeds, pages, max_pages, folder=folder)
    found = settle(crawl.candidate_pages(visited, pages, keywords or L.URL_KEYWORDS, max_pages))
    return rules_from_site(found, **options)


def full(pages: DataFrame, options: dict | None = None, checks: dict | None = None, ratio: str = "sequence") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rules, cleaning statistics, validation report) from (url, html)."""
    return finished(rules_from_pages(pages, keep_terminator=True).withColumn("pos", F.monotonically_increasing_id()), options, checks, ratio)


def finished(found: DataFrame, options: dict | None = None, checks: dict | None = None, ratio: str = "sequence") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rules, cleaning statistics, validation report) from rules in order of
    ``pos``: distilled, cleaned, filtered and validated."""
    merged = settle(distill(settle(found), ratio=ratio))
    judged = merged.withColumn("reasons", rules.rejection_reasons("rule_text", F.col("quality_score"), **(FULL if options is None else options)))
    kept = judged.where(F.size("reasons") == 0).drop("reasons")
    kept = kept.withColumn("error", rules.first_error("rule_text", F.col("word_count"), **(checks or {})))
    return kept.where("error is null").drop("error"), rules.clean_stats(judged), rules.validation_report(kept)


def forum(raw: DataFrame) -> DataFrame:
    """Deleted comments and repeated posts and comments out, then texts."""
    rows = raw.withColumn("comments", posts.drop_marked("comments"))
    rows = posts.unique_titles(rows).withColumn("comments", posts.unique_bodies("comments"))
    return posts.prepare_corpus(rows)
