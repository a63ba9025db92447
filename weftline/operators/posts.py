"""Forum posts with nested comments: cleaning, de-duplication, ranking, text.

Comments stay nested and are worked on inside their row; only what compares
posts with each other shuffles. First-wins rules take the order from an explicit
position column, never from the order of arrival."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import collapse, none_if_empty, sentence_case, strip

DELETED = "[deleted]"


def drop_marked(comments: Column | str, marker: str = DELETED, stripped: bool = False) -> Column:
    """Comments whose body isn't the marker; a null body stays."""
    body = (lambda c: strip(c["body"])) if stripped else (lambda c: c["body"])
    return F.filter(comments, lambda c: F.coalesce(body(c) != marker, F.lit(True)))


def marked_total(posts: DataFrame, marker: str = DELETED, comments: str = "comments") -> DataFrame:
    """How many comments are the marker, over all posts."""
    own = F.size(F.filter(comments, lambda c: c["body"] == marker))
    return posts.agg(F.coalesce(F.sum(F.greatest(own, F.lit(0))), F.lit(0)).alias("deleted_total"))


def present_comments(posts: DataFrame, gone: tuple[str, ...] = (DELETED, "removed"), comments: str = "comments") -> DataFrame:
    """A row for each comment with a body that isn't a mark of deletion."""
    rows = posts.select(*[c for c in posts.columns if c != comments], F.posexplode(comments).alias("comment_pos", "comment"))
    return rows.where(F.col("comment.body").isNotNull() & (F.col("comment.body") != "") & ~F.col("comment.body").isin(*gone))


def usable(comments: Column | str) -> Column:
    """Comments with a body and a score."""
    return F.filter(comments, lambda c: c.isNotNull() & (F.coalesce(c["body"], F.lit("")) != "") & c["score"].isNotNull())


def by_score(posts: DataFrame, min_post: int = 15, min_comment: int = 10) -> DataFrame:
    return posts.where(F.col("score") >= min_post).withColumn("comments", F.filter("comments", lambda c: c["score"] >= min_comment))


def top_comment(comments: Column | str) -> Column:
    """The comment of the highest score, the earliest of several; a missing
    score counts 0. Null for no comment."""
    ranked = F.transform(comments, lambda c, i: F.struct(F.coalesce(c["score"], F.lit(0)).alias("score"), (-i).alias("age"), c.alias("comment")))
    return F.array_max(F.transform(ranked, lambda r: F.struct(r["score"], r["age"], r["comment"])))["comment"]


def top_comment_text(comments: Column | str, empty: Column | None = None) -> Column:
    """Its body, stripped; ``empty`` (default '') where there is none."""
    return F.coalesce(strip(top_comment(comments)["body"]), F.lit("") if empty is None else empty)


def top_comments(comments: Column | str, k: int = 16) -> Column:
    """The k usable comments of the highest scores, earlier first at ties."""
    ranked = F.transform(usable(comments), lambda c, i: F.struct((-c["score"]).alias("order"), i.alias("i"), c.alias("c")))
    return F.transform(F.slice(F.array_sort(ranked), 1, k), lambda r: r["c"])


def _firsts(comments: Column | str, key) -> Column:
    keys = F.transform(comments, key)
    return F.filter(comments, lambda c, i: F.array_position(keys, key(c)) == i + 1)


def unique_bodies(comments: Column | str) -> Column:
    """The first comment of each body, unstripped; missing bodies are one."""
    return _firsts(comments, lambda c: F.coalesce(F.concat(F.lit("="), c["body"]), F.lit("none")))


def unique_comments(comments: Column | str, skip_deleted: bool = True) -> Column:
    """The first comment of each stripped (id, body); null comments go."""
    kept = F.filter(comments, lambda c: c.isNotNull())
    if skip_deleted:
        kept = F.filter(kept, lambda c: strip(F.coalesce(c["body"], F.lit(""))) != DELETED)
    text = lambda x: strip(F.coalesce(x, F.lit("")))
    return _firsts(kept, lambda c: F.concat_ws("\u0001", text(c["comment_id"]), text(c["body"])))


def _first_rows(posts: DataFrame, keys: list[Column], order: Column) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    return posts.withColumn("__rank", rank).where("__rank = 1").drop("__rank")


def unique_titles(posts: DataFrame, category: str = "category", title: str = "title", order: str = "pos") -> DataFrame:
    """The first post of each title in a category; missing titles are one."""
    return _first_rows(posts, [F.col(category), F.col(title)], F.col(order))


def unique_posts(posts: DataFrame, category: str = "category", post_id: str = "post_id", title: str = "title", order: str = "pos") -> DataFrame:
    """The first post of each id (title where the id is blank) in a category."""
    text = lambda c: strip(F.coalesce(F.col(c).cast("string"), F.lit("")))
    return _first_rows(posts, [F.col(category), F.coalesce(none_if_empty(text(post_id)), text(title))], F.col(order))


def dedupe_counts(before: DataFrame, after: DataFrame, comments: str | None = None) -> DataFrame:
    """total_posts, duplicate_posts, remaining_posts, duplicate_comments."""
    held = F.coalesce(F.sum(F.greatest(F.size(comments), F.lit(0))), F.lit(0)) if comments else F.lit(0).cast("long")
    b = before.agg(F.count("*").alias("total_posts"), held.alias("cb"))
    a = after.agg(F.count("*").alias("remaining_posts"), held.alias("ca"))
    return b.join(a).select("total_posts", (F.col("total_posts") - F.col("remaining_posts")).alias("duplicate_posts"), "remaining_posts", (F.col("cb") - F.col("ca")).alias("duplicate_comments"))


def text_field(*parts: Column) -> Column:
    """Non-empty stripped parts with an empty line between."""
    return F.concat_ws("\n\n", *[none_if_empty(strip(p)) for p in parts])


def combined_text(*parts: Column) -> Column:
    """Non-empty stripped parts on one line."""
    return collapse(F.concat_ws(" ", *[none_if_empty(strip(p)) for p in parts]))


def flatten(posts: DataFrame, skip_deleted: bool = True) -> DataFrame:
    """Posts as records: cleaned comments, subreddit, label and text added."""
    rows = posts.withColumn("comments", unique_comments("comments", skip_deleted))
    text = text_field(F.col("title"), F.col("selftext"), top_comment_text("comments", F.lit(None).cast("string")))
    return rows.withColumns({"subreddit": F.col("category"), "label": F.col("category"), "text": text})


def prepare_corpus(posts: DataFrame, title: str = "title", selftext: str = "selftext", comments: str = "comments") -> DataFrame:
    """(post_id, title, category, clean_text): one-line texts in sentence case;
    posts without any text go."""
    rows = posts.select("post_id", strip(F.coalesce(F.col(title), F.lit(""))).alias("title"), "category", combined_text(F.col(title), F.col(selftext), top_comment_text(comments)).alias("combined"))
    return rows.where("combined <> ''").select("post_id", "title", "category", sentence_case("combined").alias("clean_text"))


def category_totals(posts: DataFrame, category: str = "category") -> DataFrame:
    """Posts per category and, with a null category, altogether."""
    return posts.rollup(category).agg(F.count("*").alias("posts"), F.grouping(category).cast("int").alias("is_total"))


def post_key(post_id: Column | str, pos: Column | str) -> Column:
    """The id, or post_<position> where it is missing."""
    return F.coalesce(F.col(post_id) if isinstance(post_id, str) else post_id, F.concat(F.lit("post_"), (F.col(pos) if isinstance(pos, str) else pos).cast("string")))


def post_url(permalink: Column | str, site: str = "https://reddit.com") -> Column:
    return F.concat(F.lit(site), F.col(permalink) if isinstance(permalink, str) else permalink)


def unseen(posts: DataFrame, known: DataFrame, keys: tuple[str, ...] = ("category", "post_id")) -> DataFrame:
    """Posts whose keys aren't known yet."""
    return posts.join(known.select(*keys).distinct(), list(keys), "left_anti")
