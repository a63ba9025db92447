"""Pages: text and candidate extraction, links, and reach over a site.

Full HTML needs a tree, which no built-in has: a stdlib parser runs over Arrow
batches, one call per batch. Regular pages have a native form as well, of
regular expressions only, which stays in generated code."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import lexicons as L
from ..functions.text import collapse, contains_any, join_url, netloc, site, strip, url_path
from ..tables import settle

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
STRIP = "".join(map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


class Node:
    __slots__ = ("attrs", "children", "parent", "tag")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None):
        self.tag, self.attrs, self.parent, self.children = tag, attrs, parent, []

    def walk(self) -> Iterator[Node]:
        """Elements below, in document order."""
        stack = [c for c in reversed(self.children) if isinstance(c, Node)]
        while stack:
            node = stack.pop()
            yield node
            stack += [c for c in reversed(node.children) if isinstance(c, Node)]

    def text(self) -> str:
        """Stripped pieces of text below, joined by spaces."""
        out, stack = [], list(reversed(self.children))
        while stack:
            x = stack.pop()
            if isinstance(x, Node):
                stack += reversed(x.children)
            elif piece := x.strip(STRIP):
                out.append(piece)
        return " ".join(out)

    def drop(self) -> None:
        self.parent.children.remove(self)

    def clear(self) -> None:
        """Take the tree apart: its nodes refer to each other and would otherwise stay
        until the collector of cycles comes."""
        stack = [self]
        while stack:
            node = stack.pop()
            stack += [c for c in node.children if isinstance(c, Node)]
            node.children, node.parent = [], None

    def has(self, selector: str) -> bool:
        """tag, .class, or tag[class*="part"]."""
        names = self.attrs.get("class", "")
        if selector.startswith("."):
            return selector[1:] in names.split()
        tag, _, part = selector.partition("[class*=")
        return self.tag == tag and part.rstrip("]").strip('"') in names

    def first(self, selectors: Sequence[str]) -> Node | None:
        return next((n for s in selectors for n in self.walk() if n.has(s)), None)


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {}, None)

    def handle_starttag(self, tag, attrs):
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_endtag(self, tag):
        node = self.at
        while node.parent is not None and node.tag != tag:
            node = node.parent
        if node.parent is not None:
            self.at = node.parent

    def handle_data(self, data):
        self.at.children.append(data)


def parse(html: str) -> Node:
    builder = _Builder()
    builder.feed(html)
    builder.close()
    root = builder.root
    builder.root = builder.at = None
    for node in list(root.walk()):
        if node.tag in L.DROPPED_TAGS and node.parent is not None:
            node.drop()
            node.clear()
    return root


def page_text(html: str | None, longer_than: int = 30) -> str:
    """The main article's lines (paragraphs, headings, list items) of more than
    so many characters, without promotional blocks, joined by spaces."""
    root = parse(html or "")
    main = root.first(L.MAIN_SELECTORS_A) or root
    for node in list(main.walk()):
        if node.parent is not None and any(c in node.attrs.get("class", "") for c in L.PROMO_CLASSES):
            node.drop()
            node.clear()
    lines = (n.text() for n in main.walk() if n.tag in L.LINE_TAGS)
    text = " ".join(x for x in lines if len(x) > longer_than)
    root.clear()
    return text


def page_candidates(html: str | None, advice: Sequence[str] = tuple(L.LINE_ADVICE), item: int = 20, part: int = 30, line: int = 60) -> list[str]:
    """Texts that may hold a rule, in order and once each: list items, parts of
    numbered lines, and long lines with a word of advice."""
    import re

    root = parse(html or "")
    main = root.first(L.MAIN_SELECTORS_B) or next((n for n in root.walk() if n.tag == "body"), root)
    found = []
    for node in main.walk():
        up = node.parent
        while node.tag == "li" and up is not None and up.tag not in ("ol", "ul"):
            up = up.parent
        if node.tag == "li" and up is not None and len(text := node.text()) > item:
            found.append(text)
    for node in main.walk():
        if node.tag not in ("p", "li"):
            continue
        text = node.text()
        if re.match(r"(\d+\.|\d+\))\s+", text) and len(text) > part:
            found += [t for x in re.split(r"\d+\.|\d+\)", text) if len(t := x.strip(STRIP)) > part]
        elif len(text) > line and any(w in text.lower() for w in advice):
            found.append(text)
    root.clear()
    return list(dict.fromkeys(t.strip(STRIP) for t in found))


@F.arrow_udf(T.StringType())
def html_text(pages: pa.Array) -> pa.Array:
    return pa.array((page_text(x.as_py()) for x in pages), pa.string())


def html_candidates(pages: DataFrame, html: str = "html", url: str = "url", **options) -> DataFrame:
    """(url, pos, text): a row for each candidate of a page."""

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def found(batch: pa.Array) -> pa.Array:
        return pa.array((page_candidates(x.as_py(), **options) for x in batch), pa.list_(pa.string()))

    return pages.select(F.col(url).alias("source"), F.posexplode(found(F.col(html))).alias("pos", "text"))


# Native forms, for pages whose blocks of these tags don't nest
BLOCK = r"(?is)<(?:script|style|nav|footer|aside|header|form|iframe)(?:\s[^>]*)?>.*?</(?:script|style|nav|footer|aside|header|form|iframe)>"
LINE = r"(?is)<(?:p|h[1-6]|li)(?:\s[^>]*)?>(.*?)</(?:p|h[1-6]|li)>"
HREF = r"""(?i)<a\s(?:[^>]*\s)?href\s*=\s*["']([^"']*)["']"""


def native_lines(html: Column | str) -> Column:
    """Texts of paragraphs, headings and list items outside dropped blocks."""
    kept = F.regexp_replace(html, BLOCK, " ")
    return F.transform(F.regexp_extract_all(kept, F.lit(LINE), F.lit(1)), lambda x: collapse(F.regexp_replace(x, "<[^>]*>", " ")))


def native_text(html: Column | str, longer_than: int = 30) -> Column:
    return F.array_join(F.filter(native_lines(html), lambda x: F.length(x) > longer_than), " ")


def native_candidates(pages: DataFrame, advice: Sequence[str] = tuple(L.LINE_ADVICE), item: int = 60, html: str = "html", url: str = "url") -> DataFrame:
    """(source, pos, text): first occurrence on a page of each line that is long
    enough and has a word of advice."""
    rows = pages.select(F.col(url).alias("source"), F.posexplode(native_lines(html)).alias("pos", "text")).where((F.length("text") > item) & contains_any("text", advice))
    first = F.row_number().over(Window.partitionBy("source", "text").orderBy("pos"))
    return rows.withColumn("__n", first).where("__n = 1").drop("__n")


def links(pages: DataFrame, html: str = "html", url: str = "url", keys: Sequence[str] = ()) -> DataFrame:
    """(keys, url, pos, href): every link of a page, in order. ``keys`` are columns
    that tell pages apart where URLs don't."""
    return pages.select(*keys, F.col(url).alias("url"), F.posexplode(F.regexp_extract_all(html, F.lit(HREF), F.lit(1))).alias("pos", "href"))


def resolved(found: DataFrame, against_page: bool = False) -> DataFrame:
    """href resolved as ``target``: against the site's root, or the page's folder."""
    base = F.regexp_replace(F.col("url"), r"[^/]*$", "") if against_page else site("url")
    return found.withColumn("target", join_url(F.regexp_replace(base, "/$", "") if against_page else base, "href"))


def candidate_urls(found: DataFrame, keywords: Sequence[str] = tuple(L.URL_KEYWORDS)) -> DataFrame:
    """Targets on the page's own host with a keyword in path or host; each once."""
    own = netloc("target") == netloc("url")
    wanted = contains_any(url_path("target"), keywords) | contains_any(netloc("target"), keywords, False)
    return found.where(own & wanted).select(netloc("target").alias("host"), "target").distinct()


def reach(edges: DataFrame, seeds: DataFrame, rounds: int = 80) -> DataFrame:
    """(node, depth): what links lead to from the seeds, and in how many steps.
    edges: (src, dst); seeds: (node). Each round joins only the new frontier and
    leaves out what was seen; rounds bound the depth."""
    edges = settle(edges.select("src", "dst").where("src is not null and dst is not null").distinct())
    seen = settle(seeds.select("node").distinct().withColumn("depth", F.lit(0)))
    front = seen
    for depth in range(1, rounds + 1):
        step = front.join(edges, front.node == edges.src).select(F.col("dst").alias("node")).distinct()
        front = settle(step.join(seen, "node", "left_anti").withColumn("depth", F.lit(depth)))
        if front.isEmpty():
            break
        seen = settle(seen.unionByName(front))
    return seen


def numbered_parts(lines: DataFrame, text: str = "line", part: int = 30) -> DataFrame:
    """Parts of lines that start with a number and a dot or bracket."""
    rows = lines.where(F.col(text).rlike(r"^(\d+\.|\d+\))[\s\x{a0}]+") & (F.length(text) > part))
    rows = rows.select(*[c for c in lines.columns if c != text], F.posexplode(F.split(text, r"\d+\.|\d+\)")).alias("part_pos", "part"))
    return rows.withColumn("part", strip("part")).where(F.length("part") > part)
