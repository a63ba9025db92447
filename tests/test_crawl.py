"""Discovery crawls against a plain queue, over a table and over HTTP."""

import random
import threading
from collections import Counter
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest

from weftline.operators import crawl
from weftline.plans import pipelines
from weftline.sources import web as sources

WORDS = ["guide", "about", "how-to", "tips", "shop", "x", "fit"]


def made(seed, hosts=6, pages=40):
    """{url: html} of sites that link within and across, some links twice, some to nowhere."""
    pick, out = random.Random(seed), {}
    for h in range(hosts):
        site = f"https://h{h}.example"
        own = [site] + [f"{site}/{pick.choice(WORDS)}/{i}" for i in range(pages)]
        for url in own:
            to = [pick.choice([u, u.removeprefix(site), f"../{u.rsplit('/', 1)[-1]}", "https://other.example/guide", "#top", ""]) for u in pick.sample(own, 5)]
            out[url] = "<html>" + "".join(f"<p><a class='c' href='{t}'>x</a>" for t in to) + "</html>"
    return out


def resolve(site, href):
    return href if href.startswith("http") else site + href if href == "" or href[0] in "/#?" else f"{site}/{href.removeprefix('../')}"


def plain(pages, site, most, keywords=("guide", "tips")):
    """Pages visited with a queue, in order, and candidate links, in order."""
    queue, seen, found = [site], [], []
    while queue and len(seen) < most:
        url = queue.pop(0)
        seen.append(url)
        for href in [x.split("'")[0] for x in pages.get(url, "").split("href='")[1:]]:
            to = resolve(site, href)
            if to.split("/")[2].split("#")[0] != site.split("/")[2]:
                continue
            if any(k in to.removeprefix(site) for k in keywords) and to not in found:
                found.append(to)
            if to not in seen and to not in queue and len(seen) + len(queue) < most:
                queue.append(to)
    return seen, found


@pytest.mark.parametrize("most", [1, 7, 80])
def test_equals_a_queue(spark, tmp_path, most):
    pages = made(most)
    table = crawl.table_fetcher(spark.createDataFrame(list(pages.items()), "url string, html string"))
    names = [f"h{h}.example" for h in range(6)] + ["https://h0.example/some/page", "nowhere.example", "", None]
    seeds = spark.createDataFrame([(n,) for n in names], "seed string")
    visited = crawl.crawl(seeds, table, most, folder=f"file://{tmp_path}/rounds")
    got = {}
    for r in visited.collect():
        got.setdefault(r.site, {})[r.rank] = r.url
        assert r.status == (200 if r.url in pages else 404) and r.html == pages.get(r.url, "")
    assert set(got) == {f"https://h{h}.example" for h in range(6)} | {"https://nowhere.example"}
    promising = {}
    for r in crawl.candidates(visited, ["guide", "tips"], most).collect():
        promising.setdefault(r.site, {})[r.rank] = r.url
    for site, own in got.items():
        seen, found = plain(pages, site, most)
        assert [own[i] for i in range(len(own))] == seen
        assert [promising[site][i] for i in range(len(promising[site]))] == (found[:most] or [site])


def test_goes_on_after_the_last_complete_round(spark, tmp_path):
    pages, asked = made(3, hosts=2), []
    table = crawl.table_fetcher(spark.createDataFrame(list(pages.items()), "url string, html string"))

    def fails_at(round_):
        def fetch(front):
            rows = front.collect()
            asked.extend(r.url for r in rows)
            if rows[0].depth == round_:
                raise ConnectionError("stopped")
            return table(front)

        return fetch

    seeds = spark.createDataFrame([("h0.example",), ("h1.example",)], "seed string")
    with pytest.raises(ConnectionError):
        crawl.crawl(seeds, fails_at(2), 30, folder=f"file://{tmp_path}/r")
    asked.clear()
    got = crawl.crawl(seeds, fails_at(None), 30, folder=f"file://{tmp_path}/r")
    assert sorted(r.url for r in got.collect()) == sorted(u for h in (0, 1) for u in plain(pages, f"https://h{h}.example", 30)[0])
    assert "https://h0.example" not in asked and max(Counter(asked).values()) == 1
    again = crawl.crawl(seeds, fails_at(-1), 30, folder=f"file://{tmp_path}/r")
    assert again.count() == got.count()


RULE = "You should always match the colour of your belt to the colour of your leather shoes when you wear a suit."


@pytest.fixture
def server():
    hits = Counter()
    html = {"/": "<a href='/guide/1'>a</a><a href='/style'>b</a><a href='/broken'>c</a>", "/guide/1": f"<article><p>{RULE}</p><a href='/tips'>d</a></article>", "/style": "<p>nothing</p>", "/tips": "<article><ul><li>Never pair brown shoes with black pants, as they fight.</li></ul></article>"}

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):  # noqa: N802
            hits[self.path] += 1
            body = html.get(self.path if self.path else "/")
            self.send_response(200 if body is not None else 500)
            self.send_header("Content-Type", "text/html; charset=utf-8")
            self.end_headers()
            self.wfile.write((body or "").encode())

        def log_message(self, *_):
            pass

    with ThreadingHTTPServer(("127.0.0.1", 0), Handler) as own:
        threading.Thread(target=own.serve_forever, daemon=True).start()
        yield f"http://127.0.0.1:{own.server_address[1]}", hits
        own.shutdown()


def test_over_http(spark, server):
    base, hits = server
    seeds = spark.createDataFrame([(base,), ("http://127.0.0.1:9",)], "seed string")
    found, stats = pipelines.discover(seeds, crawl.http_fetcher(delay=0, timeout=5), max_pages=10)
    rows = {r.rule_text: r for r in found.collect()}
    assert set(rows) == {RULE, "Never pair brown shoes with black pants, as they fight."}
    assert rows[RULE].sources[0].url == f"{base}/guide/1" and stats.first().total_rules == 2
    assert hits["/"] == 1 and hits["/guide/1"] == 1  # nothing is fetched twice
    pages = pipelines.scraped(spark.createDataFrame([(f"{base}/style",), (f"{base}/gone",), ("no url",)], "url string"), crawl.http_fetcher(delay=0))
    assert {r.url: r.html for r in pages.collect()} == {f"{base}/style": "<p>nothing</p>", f"{base}/gone": "", "no url": ""}


def test_full_run_of_a_domain_on_the_command_line(spark, server, tmp_path):
    from weftline.__main__ import main

    base, _ = server
    main(["discover", base, f"{tmp_path}/found", "--delay", "0"])
    assert spark.read.json(f"{tmp_path}/found").count() == 2
    main(["full", base, f"{tmp_path}/kept", "--delay", "0", "--max-pages", "5"])
    assert (tmp_path / "kept" / "_SUCCESS").exists()


def test_failures_are_rows():
    assert sources.fetch("http://127.0.0.1:9/x", timeout=1)[0] is None and sources.fetch("nonsense")[2]
