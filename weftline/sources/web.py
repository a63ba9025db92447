"""Pages and forum posts as Python data sources: fetched, or replayed from files."""

from __future__ import annotations

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition


class _Part(InputPartition):
    def __init__(self, items):
        self.items = items


def fetch(url: str, delay: float = 0, timeout: float = 10, agent: str = "Mozilla/5.0") -> tuple[int | None, str, str | None]:
    """(status, html, error) of a page, after a pause; html only with status 200."""
    import time
    import urllib.error
    import urllib.request

    time.sleep(delay)
    try:
        ask = urllib.request.Request(url, headers={"User-Agent": agent, "Accept": "text/html,application/xhtml+xml,*/*;q=0.8"})
        with urllib.request.urlopen(ask, timeout=timeout) as answer:
            body = answer.read().decode(answer.headers.get_content_charset() or "utf-8", "replace")
            return answer.status, body if answer.status == 200 else "", None
    except urllib.error.HTTPError as e:
        return e.code, "", None
    except Exception as e:  # a URL or an answer of any kind must not end the crawl
        return None, "", f"{type(e).__name__}: {e}"


class PageSource(DataSource):
    """format("weftline_pages"): (url, status, html, error) of the URLs in option
    ``urls`` (one a line), in ``parts`` partitions. A failure is a row with an
    error, never a lost one."""

    @classmethod
    def name(cls):
        return "weftline_pages"

    def schema(self):
        return "url string, status int, html string, error string"

    def reader(self, schema):
        return _Pages(self.options)


class _Pages(DataSourceReader):
    def __init__(self, options):
        self.urls = [u.strip() for u in options.get("urls", "").splitlines() if u.strip()]
        self.parts = max(1, int(options.get("parts", "8")))
        self.timeout = float(options.get("timeout", "10"))
        self.delay = float(options.get("delay", "0"))
        self.agent = options.get("agent", "Mozilla/5.0")

    def partitions(self):
        return [_Part(self.urls[i :: self.parts]) for i in range(min(self.parts, max(1, len(self.urls))))]

    def read(self, partition):
        for url in partition.items:
            yield url, *fetch(url, self.delay, self.timeout, self.agent)


class SearchSource(DataSource):
    """format("weftline_search"): posts for every pair of a category and a query
    (options ``categories`` and ``queries``, one a line as name=string), best
    first, at most ``limit`` each. Option ``client`` names a callable as
    module:function (category, query, limit, options) -> iterable of rows; the
    options hold whatever credentials it needs. A search that fails is a row with
    an error."""

    @classmethod
    def name(cls):
        return "weftline_search"

    def schema(self):
        return "category string, query string, post_id string, title string, score long, url string, flair string, selftext string, comments array<struct<comment_id:string,body:string,score:bigint>>, error string"

    def reader(self, schema):
        return _Search(self.options)


class _Search(DataSourceReader):
    def __init__(self, options):
        self.options = dict(options)
        lines = lambda k: [x.strip() for x in options.get(k, "").splitlines() if x.strip()]
        self.pairs = [(c, *q.partition("=")[::2]) for c in lines("categories") for q in lines("queries")]

    def partitions(self):
        return [_Part([p]) for p in self.pairs] or [_Part([])]

    def read(self, partition):
        import importlib

        module, _, name = self.options["client"].partition(":")
        client = getattr(importlib.import_module(module), name)
        for category, query, text in partition.items:
            try:
                found = list(client(category, text, int(self.options.get("limit", "0")), self.options))
            except Exception as e:  # an unreachable category or a failed search
                yield category, query, None, None, None, None, None, None, None, f"{type(e).__name__}: {e}"
                continue
            for r in sorted(found, key=lambda r: -(r.get("score") or 0)):
                comments = [(c.get("comment_id"), c.get("body"), c.get("score")) for c in r.get("comments", [])]
                yield category, query, r.get("post_id"), r.get("title"), r.get("score"), r.get("url"), r.get("flair"), r.get("selftext"), comments, None


class ForumSource(DataSource):
    """format("weftline_forum"), as a stream: posts of every category and query,
    from where the last run stopped. The offset is how far each pair has been read;
    it lies in the query's checkpoint, so a run that stops goes on there. Options:
    ``categories``, ``queries`` (as for weftline_search), ``page`` (posts of a
    partition, 100), ``client`` (module:object), which has

    - latest(category, query, options): how many posts there are by now;
    - posts(category, query, start, end, options): those of them, oldest first.

    A pair whose ``latest`` fails isn't read in that batch (a run that has yet to
    learn its place stops instead). A page that fails ends the batch, and the next
    start repeats it. A post that several queries find comes
    once for each: see streaming.incremental for one that comes once."""

    @classmethod
    def name(cls):
        return "weftline_forum"

    def schema(self):
        return "category string, query string, place long, post_id string, title string, score long, url string, flair string, selftext string, comments array<struct<comment_id:string,body:string,score:bigint>>"

    def streamReader(self, schema):
        return _Forum(self.options)


class _Forum(DataSourceStreamReader):
    def __init__(self, options):
        self.options = dict(options)
        lines = lambda k: [x.strip() for x in options.get(k, "").splitlines() if x.strip()]
        self.queries = dict(x.partition("=")[::2] for x in lines("queries"))
        self.categories, self.page = lines("categories"), int(options.get("page", "100"))
        self.known: dict[tuple[str, str], int] = {}

    def client(self):
        import importlib

        module, _, name = self.options["client"].partition(":")
        return getattr(importlib.import_module(module), name)

    def pairs(self):
        return [(c, q) for c in self.categories for q in self.queries]

    def initialOffset(self):
        return {c: {q: 0 for q in self.queries} for c in self.categories}

    def latestOffset(self):
        found = self.initialOffset()
        for c, q in self.pairs():
            try:
                self.known[c, q] = int(self.client().latest(c, self.queries[q], self.options))
            except Exception:  # not to be reached: nothing new of it in this batch
                if (c, q) not in self.known:
                    raise
            found[c][q] = self.known[c, q]
        return found

    def partitions(self, start, end):
        parts = []
        for c, q in self.pairs():
            low, high = start.get(c, {}).get(q, 0), end.get(c, {}).get(q, 0)
            parts += [_Part([(c, q, at, min(at + self.page, high))]) for at in range(low, high, self.page)]
        return parts

    def read(self, partition):
        for c, q, start, end in partition.items:
            for place, r in enumerate(self.client().posts(c, self.queries[q], start, end, self.options), start):
                comments = [(x.get("comment_id"), x.get("body"), x.get("score")) for x in r.get("comments") or []]
                yield c, q, place, r.get("post_id"), r.get("title"), r.get("score"), r.get("url"), r.get("flair"), r.get("selftext"), comments

    def commit(self, end):
        pass


def register(spark) -> None:
    spark.dataSource.register(PageSource)
    spark.dataSource.register(SearchSource)
    spark.dataSource.register(ForumSource)
