"""Text functions as Column expressions, with Python's notions of white space,
words and case (which differ from Java's)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: the characters that str.strip, str.split and \s take for white space.
SPACE = r"\t-\r\x1c-\x20\x85\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
#: The same characters as text, and all others as ranges. What is common comes first: a
#: class is tried range by range, and a letter is none of the ranges above.
SPACES = "".join(map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
OTHERS = r"!-\x{84}\x{86}-\x{9f}\x{a1}-\x{167f}\x{1681}-\x{1fff}\x{200b}-\x{2027}\x{202a}-\x{202e}\x{2030}-\x{205e}\x{2060}-\x{2fff}\x{3001}-\x{10ffff}\x{0}-\x{8}\x{e}-\x{1b}"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bind(use, **values: Column) -> Column:
    """use(row) with each value computed once, as a field of row. (An expression
    that occurs in several branches is otherwise computed in each.)"""
    return F.transform(F.array(F.struct(*[v.alias(k) for k, v in values.items()])), use)[0]


def strip(c: Column | str) -> Column:
    """Without white space at both ends."""
    return F.btrim(_col(c), F.lit(SPACES))


def collapse(c: Column | str) -> Column:
    """White space runs as one space, none at the ends."""
    return F.trim(F.regexp_replace(_col(c), f"[^{OTHERS}]+", " "))


def cut(c: Column | str, n: int) -> Column:
    """Collapsed, then at most n characters."""
    return F.substring(collapse(c), 1, n)


def truncate(c: Column | str, n: int) -> Column:
    """At most n characters, with "..." behind a text that was longer."""
    c = _col(c)
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit("..."))).otherwise(c)


def words(c: Column | str) -> Column:
    return F.filter(F.split(_col(c), f"[{SPACE}]+"), lambda w: w != "")


def word_count(c: Column | str) -> Column:
    """As many words as len(text.split())."""
    return F.regexp_count(_col(c), F.lit(f"[{OTHERS}]+"))


def normalize(c: Column | str) -> Column:
    r"""Lower case, only letters, digits, underscore and white space, collapsed."""
    return collapse(F.regexp_replace(F.lower(_col(c)), rf"[^a-z\p{{L}}\p{{N}}_{SPACE}]", ""))


def contains_any(c: Column | str, keywords: Iterable[str], fold: bool = True) -> Column:
    """Whether a keyword occurs as a substring."""
    c = F.lower(_col(c)) if fold else _col(c)
    found = F.lit(False)
    for k in keywords:
        found = found | c.contains(k)
    return found


def matches_any(c: Column | str, patterns: Iterable[str]) -> Column:
    """Whether one of the patterns is found, ignoring case: one regex for all."""
    joined = "|".join(f"(?:{p})" for p in patterns)
    return _col(c).rlike(f"(?i){joined}") if joined else F.lit(False)


def sentences(c: Column | str) -> Column:
    """Pieces between runs of . ! ?, stripped."""
    return F.transform(F.split(_col(c), "[.!?]+"), strip)


def sentence_case(c: Column | str) -> Column:
    """Sentences with a capital first letter and an end mark, one space between."""

    def formed(s: Column) -> Column:
        ended = F.when(s.rlike("[.!?]$"), s).otherwise(F.concat(s, F.lit(".")))
        head = F.regexp_extract(ended, r"^(\P{L}*)(\p{L}?)([\s\S]*)$", 1)
        letter = F.regexp_extract(ended, r"^(\P{L}*)(\p{L}?)([\s\S]*)$", 2)
        rest = F.regexp_extract(ended, r"^(\P{L}*)(\p{L}?)([\s\S]*)$", 3)
        return F.concat(head, F.upper(letter), rest)

    parts = F.filter(F.transform(F.split(strip(c), f"(?<=[.!?])[{SPACE}]+"), strip), lambda s: s != "")
    return F.array_join(F.transform(parts, formed), " ")


def tokens(c: Column | str) -> Column:
    """Runs of ASCII letters and runs of everything else, in order."""
    return F.regexp_extract_all(_col(c), F.lit("[A-Za-z]+|[^A-Za-z]+"), F.lit(0))


def preserve_case(original: Column | str, correction: Column | str) -> Column:
    """The correction in the casing of the original word."""
    o, c = _col(original), _col(correction)
    capital = F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1 << 30)))
    return F.when((o == F.upper(o)) & (o != F.lower(o)), F.upper(c)).when(F.substring(o, 1, 1).rlike(r"^\p{IsUppercase}"), capital).otherwise(c)


def percent(c: Column | str, digits: int = 1) -> Column:
    """A percentage as text, rounded half to even."""
    return F.format_string(f"%.{digits}f%%", F.bround(_col(c), digits))


def utc_seconds(c: Column | str) -> Column:
    """ISO 8601 in UTC to the second (the session's time zone is UTC)."""
    return F.date_format(_col(c), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def none_if_empty(c: Column | str) -> Column:
    return F.nullif(_col(c), F.lit(""))


def search_string(terms: Column | str) -> Column:
    """title:"term" for each term, joined by OR; blank terms are skipped, and
    without a term the result is null."""
    kept = F.filter(F.transform(_col(terms), strip), lambda t: t != "")
    quoted = F.transform(kept, lambda t: F.concat(F.lit('title:"'), F.replace(t, F.lit('"'), F.lit('\\"')), F.lit('"')))
    return F.when(F.size(kept) > 0, F.array_join(quoted, " OR "))


def host_by_slashes(url: Column | str) -> Column:
    """What stands between the second and third slash, or "unknown"."""
    return F.coalesce(F.get(F.split(_col(url), "/"), F.lit(2)), F.lit("unknown"))


def netloc(url: Column | str) -> Column:
    """The authority of a URL, with port and user; empty without one."""
    return F.regexp_extract(_col(url), r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)", 1)


def url_path(url: Column | str) -> Column:
    return F.regexp_extract(_col(url), r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)", 1)


def site(url: Column | str) -> Column:
    """scheme://authority; https where no scheme is given."""
    whole = F.when(_col(url).startswith("http"), _col(url)).otherwise(F.concat(F.lit("https://"), _col(url)))
    return F.regexp_extract(whole, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)


def join_url(base: Column | str, link: Column | str) -> Column:
    """A link resolved against a site's root: absolute, scheme-relative, rooted
    or relative; dot segments at the front are dropped."""
    b, h = _col(base), F.trim(_col(link))
    scheme = F.regexp_extract(b, r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1)
    plain = F.regexp_replace(h, r"^(?:\.{1,2}/)+", "")
    return (
        F.when(h.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), h)
        .when(h.startswith("//"), F.concat(scheme, F.lit(":"), h))
        .when(h.startswith("/"), F.concat(b, h))
        .when(h == "", b)
        .when(h.startswith("#") | h.startswith("?"), F.concat(b, h))
        .otherwise(F.concat(b, F.lit("/"), plain))
    )


def dot(a: Column | str, b: Column | str) -> Column:
    return F.aggregate(F.zip_with(_col(a), _col(b), lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column | str) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column | str, b: Column | str) -> Column:
    """Cosine similarity of two vectors; 0 if one has no length."""
    return F.coalesce(F.try_divide(dot(a, b), norm(a) * norm(b)), F.lit(0.0))


def unit(a: Column | str) -> Column:
    """A vector scaled to length 1; a zero vector stays."""
    n = norm(a)
    return F.transform(_col(a), lambda x: F.when(n > 0, x.cast("double") / n).otherwise(x.cast("double")))


JSON_SPAN = r"\{[^{}]*(?:\{[^{}]*\}[^{}]*)*\}"


def salvage_json(c: Column | str) -> Column:
    """The JSON object in a model's answer, or null: commas before a closing
    bracket go, then the first span of braces with one level inside is tried,
    then the whole text. (The span rule finds an inner object of deeper ones.)"""
    text = F.regexp_replace(strip(c), rf",[{SPACE}]*([}}\]])", "$1")
    span = none_if_empty(F.regexp_extract(text, JSON_SPAN, 0))
    valid = lambda x: F.when(F.try_parse_json(x).isNotNull(), x)
    return F.coalesce(valid(span), valid(text))
