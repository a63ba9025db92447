"""Rule sentences: extraction, typing, scoring, cleaning, validation, merging and
statistics. Everything is an expression on one row, but for the aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import lexicons as L
from ..functions.text import bind, contains_any, matches_any, normalize, percent, sentences, strip, word_count, words
from ..tables import settle


def sentence_rows(docs: DataFrame, text: str = "text", longer_than: int = 20, min_text: int = 20, max_text: int | None = 2000) -> DataFrame:
    """A row (columns of docs but the text, pos, sentence) for each sentence of
    more than so many characters. Texts under ``min_text`` are passed over, and
    ones over ``max_text`` are cut there (None: not cut)."""
    whole = F.col(text) if max_text is None else F.when(F.length(text) > max_text, F.concat(F.substring(text, 1, max_text), F.lit("..."))).otherwise(F.col(text))
    rows = docs.where(F.length(strip(text)) >= min_text)
    rows = rows.select(*[c for c in docs.columns if c != text], F.posexplode_outer(sentences(whole)).alias("pos", "sentence"))
    # outer: a plain one would get a filter in front that cuts every text once more
    return rows.where(F.length("sentence") > longer_than)


def first_type(text: Column | str, lists: Sequence[tuple[str, Sequence[str]]] = tuple(L.TYPES_A)) -> Column:
    """The first type one of whose words occurs; ``general`` without any."""
    if not lists:
        return F.lit("general")

    def chosen(row: Column) -> Column:
        out = F
        for name, keywords in lists:
            out = out.when(contains_any(row["low"], keywords, False), name)
        return out.otherwise("general")

    return bind(chosen, low=F.lower(F.col(text) if isinstance(text, str) else text))


def quality_b(count: Column, similarity: Column | None = None) -> Column:
    """5, 2 more from 8 words on, and the rounded triple similarity; 1 to 10."""
    score = F.lit(5) + F.when(count >= 8, 2).otherwise(0)
    if similarity is not None:
        score = score + F.bround(similarity * 3, 0).cast("int")
    return F.greatest(F.lit(1), F.least(F.lit(10), score)).cast("int")


def quality_a(similarity: Column) -> Column:
    return (similarity * 10).cast("int")


def is_advice(text: Column | str, advice: Sequence[str] = tuple(L.FALLBACK_ADVICE), garments: Sequence[str] = tuple(L.FALLBACK_GARMENTS)) -> Column:
    """A word of advice and a garment: the classifier without a model."""
    return contains_any(text, advice) & contains_any(text, garments)


def rejection_reasons(text: Column | str, quality: Column, min_words: int = 5, max_words: int = 50, min_quality: int = 7, promotional: Sequence[str] = tuple(L.PROMOTIONAL), navigational: Sequence[str] = tuple(L.NAVIGATIONAL), required: Sequence[str] = tuple(L.REQUIRED), advice: Sequence[str] = tuple(L.CLEANER_ADVICE)) -> Column:
    """All reasons against a rule, in order; empty for a valid one."""
    whole = F.lower(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))

    def judged(row: Column) -> Column:
        low, n, q = row["low"], row["n"], row["q"]
        checks = [
            (n < min_words, F.format_string(L.TOO_SHORT, n)),
            (n > max_words, F.format_string(L.TOO_LONG, n)),
            (q < min_quality, F.format_string(L.LOW_QUALITY, q)),
            (matches_any(low, promotional), F.lit(L.IS_PROMOTIONAL)),
            (matches_any(low, navigational), F.lit(L.IS_NAVIGATIONAL)),
            (~contains_any(low, required, False), F.lit(L.NO_KEYWORDS)),
            (~contains_any(low, advice, False), F.lit(L.NO_ADVICE)),
        ]
        return F.filter(F.array(*[F.when(c, m) for c, m in checks]), lambda r: r.isNotNull())

    return bind(judged, low=whole, n=word_count(whole), q=F.coalesce(quality, F.lit(0)))


def first_error(text: Column | str, count: Column | None = None, min_words: int = 5, max_words: int = 30, prohibited: Sequence[str] = tuple(L.PROHIBITED), advice: Sequence[str] = tuple(L.ADVICE), fashion: Sequence[str] = tuple(L.FASHION), capitals: float = 0.4) -> Column:
    """The first of nine checks that a rule fails, or null."""
    whole = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))

    def judged(row: Column) -> Column:
        t, n = row["t"], row["n"]
        upper = F.size(F.filter(words(t), lambda w: w.rlike(r"^\p{IsUppercase}")))
        return (
            F.when(~t.rlike(r"^\p{IsUppercase}"), L.ERROR_CAPITAL)
            .when(~t.rlike(r"[.!]\z"), L.ERROR_PUNCTUATION)
            .when(t.contains("?"), L.ERROR_QUESTION)
            .when(n < min_words, F.format_string(L.ERROR_SHORT, n))
            .when(n > max_words, F.format_string(L.ERROR_LONG, n))
            .when(matches_any(t, prohibited), L.ERROR_PROHIBITED)
            .when(~contains_any(t, advice), L.ERROR_ADVICE)
            .when(~contains_any(t, fashion), L.ERROR_FASHION)
            .when(upper > n * capitals, L.ERROR_CAPITALS)
        )

    return bind(judged, t=whole, n=word_count(whole) if count is None else F.coalesce(count, word_count(whole)))


def clean(rules: DataFrame, **options) -> tuple[DataFrame, DataFrame]:
    """(valid rules, rejected rules with reasons): two filters of one table, so that
    the reasons are found once."""
    judged = settle(rules.withColumn("reasons", rejection_reasons("rule_text", F.col("quality_score"), **options)))
    return judged.where(F.size("reasons") == 0).drop("reasons"), judged.where(F.size("reasons") > 0)


def clean_stats(reasons: DataFrame, column: str = "reasons") -> DataFrame:
    n, ok = F.count("*"), F.count_if(F.size(column) == 0)
    return reasons.agg(n.alias("original_count"), ok.alias("valid_count"), (n - ok).alias("rejected_count"), F.coalesce(F.bround(F.try_divide(ok, n) * 100, 2), F.lit(0.0)).alias("validation_rate"))


def validation_report(errors: DataFrame, text: str = "rule_text", error: str = "error", order: str = "pos", samples: int = 10) -> DataFrame:
    """total, valid, invalid, pass_rate as text, and the first invalid rules. The
    errors are computed once, into a table of a short row for each rule."""
    shown = F.when(F.col(error).isNotNull(), F.substring(text, 1, 60))
    judged = settle(errors.select(F.col(order).alias("o"), shown.alias("text"), F.col(error).alias("error")))
    n, ok = F.count("*"), F.count_if(F.col("error").isNull())
    rate = F.when(n == 0, F.lit("0%")).otherwise(percent(F.try_divide(ok, n) * 100))
    counts = judged.agg(n.alias("total"), ok.alias("valid"), (n - ok).alias("invalid"), rate.alias("pass_rate"))
    first = judged.where("error is not null").orderBy("o").limit(samples)
    issues = first.agg(F.transform(F.array_sort(F.collect_list(F.struct("o", "text", "error"))), lambda x: F.struct(x["text"].alias("text"), x["error"].alias("error"))).alias("sample_issues"))
    return counts.join(issues)


def keep_valid(rules: DataFrame, **options) -> DataFrame:
    return rules.where(first_error("rule_text", F.col("word_count") if "word_count" in rules.columns else None, **options).isNull())


def filtered(rules: DataFrame, **options) -> tuple[DataFrame, DataFrame]:
    """(valid rules, one row of total_rules and filtered): what stays, and the totals
    of a rule file that follow from it. The checks run once."""
    error = first_error("rule_text", F.col("word_count") if "word_count" in rules.columns else None, **options)
    judged = settle(rules.withColumn("__error", error))
    ok = F.count_if(F.col("__error").isNull())
    return judged.where("__error is null").drop("__error"), judged.agg(ok.alias("total_rules"), (F.count("*") - ok).alias("filtered"))


def with_word_count(rules: DataFrame, text: str = "rule_text", column: str = "word_count") -> DataFrame:
    """word_count where it is missing."""
    own = word_count(text)
    return rules.withColumn(column, F.coalesce(F.col(column), own) if column in rules.columns else own)


def with_source(rules: DataFrame, url: Column, domain: Column) -> DataFrame:
    return rules.withColumn("sources", F.array(F.struct(url.alias("url"), domain.alias("domain")))).withColumn("source_count", F.lit(1))


def merge_sources(rules: DataFrame, text: str = "rule_text", order: str = "pos") -> DataFrame:
    """One rule for each normalized text: the first, with the sources of all in
    order. Rules and source lists are combined before they shuffle."""
    held = F.struct(*[c for c in rules.columns if c != "sources"])
    grouped = rules.groupBy(normalize(text).alias("__key")).agg(F.min_by(held, order).alias("rule"), F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), "sources"))).alias("lists"))
    merged = F.flatten(F.transform("lists", lambda x: F.coalesce(x["sources"], F.array())))
    return grouped.select("rule.*", merged.alias("sources")).withColumn("source_count", F.size("sources"))


def merged_counts(rules: DataFrame, *columns: str, text: str = "rule_text", order: str = "pos") -> DataFrame:
    """What statistics need of merge_sources(): the first rule's ``columns`` and
    source_count for each normalized text, counted without lists of sources."""
    counted = F.sum(F.coalesce(F.array_size("sources"), F.lit(0))).cast("int")
    grouped = rules.groupBy(normalize(text).alias("__key")).agg(F.min_by(F.struct(*columns), order).alias("rule"), counted.alias("source_count"))
    return grouped.select("rule.*", "source_count")


def type_counts(rules: DataFrame, column: str = "rule_type") -> DataFrame:
    return rules.groupBy(column).agg(F.count("*").alias("rules"))


def domain_list(rules: DataFrame) -> DataFrame:
    """Distinct domains of the sources, sorted, in one row."""
    found = rules.select(F.explode("sources").alias("s")).select(F.coalesce("s.domain", F.lit("unknown")).alias("domain")).distinct()
    return found.agg(F.count("*").alias("unique_domains"), F.array_sort(F.collect_list("domain")).alias("domains"))


def statistics(rules: DataFrame) -> DataFrame:
    """One row: totals, multi-source share, averages, completeness."""
    n, multi = F.count("*"), F.count_if(F.col("source_count") > 1)
    return rules.agg(
        n.alias("total_rules"),
        multi.alias("multi_source_rules"),
        F.coalesce(F.try_divide(multi, n) * 100, F.lit(0.0)).alias("multi_source_percentage"),
        F.coalesce(F.avg(F.coalesce("quality_score", F.lit(0))), F.lit(0.0)).alias("avg_quality_score"),
        F.coalesce(F.avg(F.coalesce("word_count", F.lit(0))), F.lit(0.0)).alias("avg_word_count"),
        F.lit(100.0).alias("completeness_rate"),
    )


def scrape_stats(per_url: DataFrame, rules: str = "n_rules") -> DataFrame:
    """success (at least one rule), fail and total over one row per URL."""
    return per_url.agg(F.count_if(F.col(rules) > 0).alias("success"), F.count_if(F.coalesce(F.col(rules), F.lit(0)) <= 0).alias("fail"), F.coalesce(F.sum(rules), F.lit(0)).alias("total_rules"))
