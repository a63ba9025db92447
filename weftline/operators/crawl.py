"""Discovery crawls: from the roots of sites over their own links, page by page.

A site's pages are visited in the order in which a queue would give them: links in
order of the page that has them and of their place there, each URL once, at most
``max_pages`` of a site. What a queue does one by one goes here in rounds: all
pages of one depth, of all sites, are one job, since none of them waits for another. A
round's pages are written before the next round starts; a crawl that stops is taken
up after the last complete round, and no page is fetched twice.

How pages are fetched is a function from (site, url, depth, rank) to these columns
and (status, html, error): over HTTP, with one task at a time for a site and a pause
before each request, or from a table of pages. Nothing of a page passes through the
driver, which sees the number of new pages per round."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import lexicons as L
from ..functions.text import contains_any, join_url, netloc, site, url_path
from ..sources.web import fetch
from ..tables import exists, settle, work_dir
from .web import HREF

Fetcher = Callable[[DataFrame], DataFrame]
ASKED = "site string, url string, depth int, rank long"
VISITED = ASKED + ", status int, html string, error string"


def http_fetcher(delay: float = 0.5, timeout: float = 10, agent: str = "Mozilla/5.0", order: str = "rank") -> Fetcher:
    """Pages over HTTP. A site's URLs go to one task, which pauses ``delay``
    seconds before each; a failure is a row with a status or an error."""

    def fetched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):  # a page at a time: what is held is one page
                one = batch.slice(row, 1)
                status, html, error = fetch(one.column("url")[0].as_py(), delay, timeout, agent)
                more = [pa.array([status], pa.int32()), pa.array([html], pa.string()), pa.array([error], pa.string())]
                yield pa.RecordBatch.from_arrays([*one.columns, *more], names=[*one.schema.names, "status", "html", "error"])

    def pages(asked: DataFrame) -> DataFrame:
        kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in asked.schema)
        return asked.repartition("site").sortWithinPartitions("site", order).mapInArrow(fetched, f"{kinds}, status int, html string, error string")

    return pages


def table_fetcher(pages: DataFrame) -> Fetcher:
    """Pages of a table (url, html); other URLs have status 404."""
    known = pages.select("url", F.col("html").alias("html")).dropDuplicates(["url"])
    found = known.select("url", F.lit(200).alias("status"), "html")
    return lambda asked: asked.join(found, "url", "left").select(*asked.columns, F.coalesce("status", F.lit(404)).cast("int").alias("status"), F.coalesce("html", F.lit("")).alias("html"), F.lit(None).cast("string").alias("error"))


def page_links(visited: DataFrame) -> DataFrame:
    """(site, target, first): what pages of a site link to there, with the rank
    and place of the first link."""
    found = visited.where("status = 200").select("site", "rank", F.posexplode(F.regexp_extract_all("html", F.lit(HREF), F.lit(1))).alias("pos", "href"))
    found = found.withColumn("target", join_url(F.col("site"), "href")).where(netloc("target") == netloc("site"))
    return found.groupBy("site", "target").agg(F.min(F.struct("rank", "pos")).alias("first"))


def crawl(seeds: DataFrame, pages: Fetcher, max_pages: int = 80, seed: str = "seed", folder: str | None = None) -> DataFrame:
    """(site, url, depth, rank, status, html, error) of the pages visited from the
    sites of the seeds (domains or URLs; null and blank ones are none). ``rank`` is
    the order inside a site, from 0. ``folder`` keeps the rounds; one that a crawl
    of the same seeds has left is gone on with."""
    spark = seeds.sparkSession
    folder = folder or f"{work_dir(spark)}/crawl-{uuid.uuid4().hex}"
    roots = seeds.select(site(F.trim(F.col(seed))).alias("site")).where(netloc("site") != "").distinct()
    front = roots.select("site", F.col("site").alias("url"), F.lit(0).alias("depth"), F.lit(0).cast("long").alias("rank"))
    depth, seen = 0, None
    while True:
        path = f"{folder}/round={depth:04d}"
        if not exists(spark, f"{path}/_SUCCESS"):
            pages(front).write.mode("overwrite").parquet(path)
        visited = spark.read.schema(VISITED).parquet(path)
        urls = visited.select("site", "url")
        seen = urls if seen is None else seen.unionByName(urls)
        fresh = page_links(visited).select("site", F.col("target").alias("url"), "first").join(seen, ["site", "url"], "left_anti")
        before = seen.groupBy("site").agg(F.count("*").alias("before"))
        # a site's pages of one round are at most max_pages, and so are the links that count
        place = F.row_number().over(Window.partitionBy("site").orderBy("first", "url"))
        ranked = fresh.withColumn("place", place).where(F.col("place") <= max_pages).join(before, "site")
        front = ranked.select("site", "url", F.lit(depth + 1).alias("depth"), (F.col("before") + F.col("place") - 1).cast("long").alias("rank")).where(F.col("rank") < max_pages)
        depth += 1
        if not exists(spark, f"{folder}/round={depth:04d}/_SUCCESS"):
            front = settle(front)
            if front.isEmpty():
                return all_rounds(spark, folder)


def all_rounds(spark: SparkSession, folder: str) -> DataFrame:
    """The pages of all rounds of a crawl."""
    return spark.read.schema(VISITED).option("recursiveFileLookup", "true").parquet(folder)


def candidates(visited: DataFrame, keywords: Sequence[str] = tuple(L.URL_KEYWORDS), max_pages: int = 80) -> DataFrame:
    """(site, url, rank): of each site the first ``max_pages`` links, in order, with
    a keyword in path or host; the site's root where there is none."""
    wanted = contains_any(url_path("url"), keywords) | contains_any(netloc("url"), keywords, False)
    found = page_links(visited).select("site", F.col("target").alias("url"), "first").where(wanted)
    place: Column = F.row_number().over(Window.partitionBy("site").orderBy("first", "url"))
    ranked = found.withColumn("rank", (place - 1).cast("long")).where(F.col("rank") < max_pages).select("site", "url", "rank")
    alone = visited.select("site").distinct().join(ranked.select("site").distinct(), "site", "left_anti")
    return ranked.unionByName(alone.select("site", F.col("site").alias("url"), F.lit(0).cast("long").alias("rank")))


def candidate_pages(visited: DataFrame, pages: Fetcher, keywords: Sequence[str] = tuple(L.URL_KEYWORDS), max_pages: int = 80) -> DataFrame:
    """(url, html) of the candidates that can be had. What the crawl has fetched
    is taken from there; only the rest is fetched."""
    wanted = candidates(visited, keywords, max_pages)
    have = visited.select("site", "url", "status", "html")
    held = wanted.join(have, ["site", "url"]).select("url", "status", "html")
    rest = wanted.join(have, ["site", "url"], "left_anti").select("site", "url", F.lit(-1).alias("depth"), "rank")
    return held.unionByName(pages(rest).select("url", "status", "html")).where("status = 200 and html <> ''").select("url", "html")
