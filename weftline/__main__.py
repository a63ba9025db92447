"""python -m weftline VERB IN OUT [options]: thin wrappers around the plans. IN is a
file or folder; for discover, and where it is none for full, a domain."""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from .operators import crawl, posts, rules
from .plans import pipelines
from .session import session
from .sources import files
from .tables import exists


def main(args: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="weftline")
    p.add_argument("verb", choices=["scrape", "distill", "clean", "validate", "filter", "full", "discover", "records"])
    p.add_argument("input")
    p.add_argument("output", nargs="?")
    p.add_argument("--min-words", type=int, default=5)
    p.add_argument("--max-words", type=int, default=50)
    p.add_argument("--min-quality", type=int, default=7)
    p.add_argument("--max-pages", type=int, default=80)
    p.add_argument("--delay", type=float, default=0.5)
    p.add_argument("--timeout", type=float, default=10)
    p.add_argument("--keep-deleted", action="store_true")
    o = p.parse_args(args)
    spark = session()
    http = crawl.http_fetcher(o.delay, o.timeout)

    def pages():
        return pipelines.scraped(files.url_list(spark, o.input), http)

    def save(df):
        df.write.mode("overwrite").json(o.output) if o.output else df.show(truncate=False)

    limits = {"min_words": o.min_words, "max_words": o.max_words, "min_quality": o.min_quality}
    if o.verb == "scrape":
        save(pipelines.rules_from_pages(pages()))
    elif o.verb == "discover":
        found, stats = pipelines.discover(spark.createDataFrame([(o.input,)], "seed string"), http, max_pages=o.max_pages)
        save(found)
        stats.show(truncate=False)
    elif o.verb == "full":
        if not o.input.startswith(("http://", "https://")) and exists(spark, o.input):
            kept, _, report = pipelines.full(pages())
        else:  # a domain
            found, _ = pipelines.discover(spark.createDataFrame([(o.input,)], "seed string"), http, max_pages=o.max_pages)
            kept, _, report = pipelines.finished(found.withColumn("pos", F.monotonically_increasing_id()))
        save(kept)
        report.show(truncate=False)
    elif o.verb == "records":
        rows = posts.unique_posts(files.category_map(spark, o.input))
        save(posts.flatten(rows, not o.keep_deleted))
    else:
        found, _ = files.rule_files(spark, o.input)
        found = found.withColumn("pos", F.monotonically_increasing_id())
        if o.verb == "distill":
            save(pipelines.distill(found))
        elif o.verb == "clean":
            save(rules.clean(found, **limits)[0])
        elif o.verb == "filter":
            save(rules.keep_valid(found))
        else:
            rules.validation_report(found.withColumn("error", rules.first_error("rule_text", F.col("word_count")))).show(truncate=False)


if __name__ == "__main__":
    main()
