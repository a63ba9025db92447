"""Registered queries of the discovery crawl. The sites are those of the pages
table: a link of a host is answered by one of the host's pages, which one, and
whether at all, a hash of the URL says."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import netloc
from ..operators import crawl
from .queries import LINK_KEYS, any_sql, query, table

MOST = 80
#: Rounds that the SQL spells out; no site here has pages farther from its root.
ROUNDS = 14


def _mark(url):
    letter = lambda i: F.ascii(F.substring(F.md5(url), i, 1))
    return letter(1) * 1009 + letter(2) * 31 + letter(3)


def served(spark, sf_dir) -> crawl.Fetcher:
    """A fetcher that answers from the pages table."""
    pages = table(spark, sf_dir, "pages").select(F.concat(F.lit("https://"), netloc("url")).alias("site"), "page_id", "html")
    counts = pages.groupBy("site").agg(F.count("*").alias("n"))
    # the place of a page among those of its host: ids are spread over hosts, so no host is sorted at once
    listed = pages.groupBy("site").agg(F.array_sort(F.collect_list("page_id")).alias("ids")).select("site", F.posexplode("ids").alias("place", "page_id"))
    placed = listed.join(pages, ["site", "page_id"]).join(counts, "site")

    def pages_of(asked: DataFrame) -> DataFrame:
        marked = asked.withColumn("mark", _mark(F.col("url"))).join(counts, "site", "left").withColumn("place", F.when((F.col("mark") % 10 != 9) | (F.col("url") == F.col("site")), F.pmod("mark", "n")))
        found = marked.join(placed.select("site", "place", "html"), ["site", "place"], "left")
        return found.select(*asked.columns, F.when(F.col("html").isNull(), 404).otherwise(200).alias("status"), F.coalesce("html", F.lit("")).alias("html"), F.lit(None).cast("string").alias("error"))

    return pages_of


def seeds(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "pages").select(netloc("url").alias("seed")).distinct()


def _crawl_sql() -> str:
    """Rounds of a breadth-first search in queue order, spelled out."""
    mark = "(ascii(substr(md5(url), 1, 1)) * 1009 + ascii(substr(md5(url), 2, 1)) * 31 + ascii(substr(md5(url), 3, 1)))"
    href = r"""'(?i)<a\s(?:[^>]*\s)?href\s*=\s*["'']([^"'']*)["'']'"""
    host = lambda u: rf"regexp_extract({u}, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1)"
    out = f"""with p as (select 'https://' || {host('url')} as site, page_id, regexp_extract_all(html, {href}, 1) as hs from pages),
n as (select site, count(*) as n from p group by site),
pl as (select site, row_number() over (partition by site order by page_id) - 1 as place, hs from p),
v0 as (select site, site as url, 0 as depth, cast(0 as bigint) as rank from n)"""
    for k in range(ROUNDS):
        seen = " union all ".join(f"select site, url from v{i}" for i in range(k + 1))
        out += rf""",
f{k} as materialized (select v.*, hs from (select v.*, case when {mark.replace('url', 'v.url')} % 10 <> 9 or v.url = v.site then ({mark.replace('url', 'v.url')}) % n.n end as place from v{k} v join n using (site)) v left join pl using (site, place)),
l{k} as (select site, rank, i - 1 as pos, trim(hs[i]) as h from (select site, rank, hs, unnest(generate_series(1, len(hs))) as i from f{k} where hs is not null)),
t{k} as (select site, rank, pos, case when regexp_matches(h, '^[A-Za-z][A-Za-z0-9+.-]*:') then h when starts_with(h, '//') then 'https:' || h when starts_with(h, '/') then site || h when h = '' then site
  when starts_with(h, '#') or starts_with(h, '?') then site || h else site || '/' || regexp_replace(h, '^(?:\.{{1,2}}/)+', '') end as url from l{k}),
u{k} as (select site, url, min(struct_pack(rank := rank, pos := pos)) as first from t{k} where {host('url')} = {host('site')} group by site, url),
s{k} as materialized ({seen}),
v{k + 1} as materialized (select site, url, {k + 1} as depth, b.before + place - 1 as rank from (select u.*, row_number() over (partition by site order by first, url) as place from u{k} u anti join s{k} using (site, url)) join (select site, count(*) as before from s{k} group by site) b using (site) where b.before + place - 1 < {MOST})"""
    return out


VISITS = " union all ".join(f"select site, url, depth, rank, hs from f{k}" for k in range(ROUNDS))


@query(_crawl_sql() + f" select site, url, cast(depth as integer) as depth, cast(rank as bigint) as rank, case when hs is null then 404 else 200 end as status from ({VISITS})")
def discovery_crawl(spark, sf_dir):
    """The pages of every host that a crawl from its root visits, in order."""
    return crawl.crawl(seeds(spark, sf_dir), served(spark, sf_dir), MOST).select("site", "url", "depth", "rank", "status")


@query(_crawl_sql() + ", t as (" + " union all ".join(f"select * from t{k}" for k in range(ROUNDS)) + f"""), c as (select site, url, min(struct_pack(rank := rank, pos := pos)) as first from t
where regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1) = regexp_extract(site, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1)
and ({any_sql("lower(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)', 1))", LINK_KEYS)} or {any_sql("regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1)", LINK_KEYS)}) group by site, url),
r as (select site, url, row_number() over (partition by site order by first, url) - 1 as rank from c)
select site, url, cast(rank as bigint) as rank from r where rank < {MOST} union all select site, site, 0 from n where site not in (select site from r)""")
def discovery_candidates(spark, sf_dir):
    """Of every host the links that promise a guide, in order."""
    visited = crawl.crawl(seeds(spark, sf_dir), served(spark, sf_dir), MOST)
    return crawl.candidates(visited, LINK_KEYS, MOST)
