"""Quality rules by the frequency of lines across documents.

Lines are normalised (A-Z in lower case, digits as 0, runs of white space as one
space, none at the ends) and hashed. For every host the different texts that hold a
line are counted; lines in more than ``max_texts`` texts and more than ``max_share``
of the host's texts are its boilerplate and go; a document that loses more than
``most_lost`` of its words is depleted and rejected. Exact copies of a text count
once, so that a document isn't boilerplate because it was copied.

Before that come rules of the text alone: too few words, or too many words in
windows of three that the text repeats. Their counts are exact: words and lines are
coded by value, not by hash, batch by batch in numpy.

What is shuffled is 16 bytes or so a line. Counts are pre-aggregated; a host or a
line with a third of all rows is split like any skewed join: counts hold one row
for a line, and documents meet only lines that go.

Defined results: a null text is an empty one; a null host is a host; rows are judged
by host and text, so repeated rows and rows that share an id each get a row, equal ones
the same; a line without a word is never counted and stays; an empty table gives an
empty result; other columns pass through, whatever their names."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import byte_chunks, filled, fresh, is_space, materialize

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_is_symbol = np.isin(np.arange(256), np.frombuffer(SYMBOLS.encode(), np.uint8))


def _codes(data: np.ndarray, keep: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Equal numbers for equal slices of the kept bytes; slices lie one after
    another and cover all of these."""
    place = np.concatenate([[0], np.cumsum(keep)])
    offsets = np.concatenate([place[starts], place[ends[-1:]]]).astype(np.int64)
    values = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data[keep].tobytes())])
    return np.asarray(values.dictionary_encode().indices).astype(np.int64)


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _repeated_windows(code: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Whether each word lies in a window of three that its text has twice."""
    covered = np.zeros(len(code), bool)
    if len(code) < 3:
        return covered
    at = np.flatnonzero(text[2:] == text[:-2])
    many = int(code.max()) + 1
    key = np.unique(code[at] * many + code[at + 1], return_inverse=True)[1]
    key = np.unique(key * many + code[at + 2], return_inverse=True)[1]
    _, key, times = np.unique(key * (int(text[-1]) + 1) + text[at], return_inverse=True, return_counts=True)
    at = at[times[key] > 1]
    for k in range(3):
        covered[at + k] = True
    return covered


def text_counts(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """COUNTS of each of the texts that lie one after another."""
    texts, n, space = len(offsets) - 1, len(data), is_space(data)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(~space & (np.concatenate([[True], space[:-1]]) | edge[:n]))
    ends = np.flatnonzero(~space & (np.concatenate([space[1:], [True]]) | edge[1:])) + 1
    text = np.searchsorted(offsets[1:], starts, "right")
    out = {"n_words": np.bincount(text, minlength=texts), "word_chars": _per_text(~space & ((data & 0xC0) != 0x80), offsets), "n_symbols": _per_text(_is_symbol[data], offsets)}
    covered = _repeated_windows(_codes(data, ~space, starts, ends), text) if len(starts) else np.zeros(0, bool)
    out["n_repeat_words"] = np.bincount(text[covered], minlength=texts)
    # lines: from a text's start or behind a line feed, up to the next or the text's end
    feeds = np.flatnonzero(data == 10)
    own = np.searchsorted(offsets[1:], feeds, "right")
    inside = feeds + 1 < offsets[own + 1]
    begin = np.sort(np.concatenate([offsets[:-1][np.diff(offsets) > 0], feeds[inside] + 1]))
    text = np.searchsorted(offsets[1:], begin, "right")
    if not len(begin):
        return out | {"n_dup_lines": np.zeros(texts, np.int64)}
    end = np.minimum(np.append(feeds, n)[np.searchsorted(feeds, begin)], offsets[text + 1])
    code = _codes(data, data != 10, begin, end)
    filled_ = np.concatenate([[0], np.cumsum(~space)])
    some = filled_[end] > filled_[begin]
    code, text = code[some], text[some]
    different = np.unique(text * (int(code.max(initial=0)) + 1) + code)
    out["n_dup_lines"] = np.bincount(text, minlength=texts) - np.bincount(different // (int(code.max(initial=0)) + 1), minlength=texts)
    return out


@F.arrow_udf(T.StructType([T.StructField(c, T.LongType()) for c in COUNTS]))
def counts_of(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """COUNTS of a text, as a struct."""
    for part in parts:
        out = {c: np.zeros(len(part), np.int64) for c in COUNTS}
        for first, last, data, offsets in byte_chunks(filled(part)):
            for c, values in text_counts(data, offsets).items():
                out[c][first:last] = values
        yield pa.StructArray.from_arrays([pa.array(out[c]) for c in COUNTS], names=list(COUNTS))


def normalised(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.translate(line, "ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789", "abcdefghijklmnopqrstuvwxyz000000000"), SPACE, " "))


def _line_marks(text: Column) -> Column:
    """A text's lines with a word: where, a hash of 96 bits, and words."""
    lines = F.transform(F.split(text, "\n"), lambda s, i: F.struct(i.alias("at"), normalised(s).alias("s")))
    marks = lambda x: F.struct(x["at"].alias("at"), F.xxhash64(x["s"]).alias("h"), F.hash(x["s"]).alias("g"), (F.length(x["s"]) - F.length(F.replace(x["s"], F.lit(" "))) + 1).alias("words"))
    return F.transform(F.filter(lines, lambda x: x["s"] != ""), marks)


def judge_lines(docs: DataFrame, text: str = "text", host: str = "source", max_texts: int = 10, max_share: float = 0.01, most_lost: float = 0.5, min_words: int = 50, most_repeated: float = 0.5) -> DataFrame:
    """docs with COUNTS, base_failed, removed_lines (numbers from 0 of the lines
    that go), removed_words, kept, and clean_text, the text without these lines."""
    taken = {c: fresh(docs, c) for c in ("__host", "__text", "__counts")}
    where, mark, counts = taken.values()
    source, body = F.col(f"`{host}`").cast("string"), F.coalesce(F.col(f"`{text}`"), F.lit(""))
    named = F.when(source.isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), source))
    rows = docs.withColumns({where: named, mark: F.unhex(F.md5(body))})
    texts = rows.select(F.col(where).alias("host"), F.col(mark).alias("key"), _line_marks(body).alias("lines")).groupBy("host", "key").agg(F.first("lines").alias("lines"))
    texts = materialize(texts)
    held = texts.select("host", F.explode(F.array_distinct(F.transform("lines", lambda x: F.struct(x["h"].alias("h"), x["g"].alias("g"))))).alias("line"))
    often = held.groupBy("host", "line.h", "line.g").agg(F.count("*").alias("texts")).where(F.col("texts") > max_texts)
    size = texts.groupBy("host").agg(F.count("*").alias("of"))
    often = materialize(often.join(size, "host").where(F.col("texts") > F.lit(max_share) * F.col("of")).select("host", "h", "g", "texts"))
    lines = texts.select("host", "key", F.explode("lines").alias("line")).select("host", "key", "line.*")
    lost = lines.join(often, ["host", "h", "g"]).groupBy("host", "key").agg(F.array_sort(F.collect_list("at")).alias("gone"), F.sum("words").alias("words"))
    lost = lost.select(F.col("host").alias(where), F.col("key").alias(mark), "gone", "words")
    # columns of ours are joined under names that docs doesn't have
    gone, words = fresh(docs, "__gone"), fresh(docs, "__words")
    both = rows.withColumn(counts, counts_of(F.col(f"`{text}`"))).join(lost.withColumnsRenamed({"gone": gone, "words": words}), [where, mark], "left")
    n = F.col(f"{counts}.n_words")
    failed = (n < min_words) | (F.col(f"{counts}.n_repeat_words") > F.lit(most_repeated) * n)
    depleted = F.coalesce(F.col(words), F.lit(0)) > F.lit(most_lost) * n
    stays = F.filter(F.split(body, "\n"), lambda s, i: ~F.array_contains(F.col(gone), i))
    result = {c: F.col(f"{counts}.{c}") for c in COUNTS} | {
        "base_failed": failed,
        "removed_lines": F.coalesce(F.col(gone), F.array().cast("array<int>")),
        "removed_words": F.coalesce(F.col(words), F.lit(0)).cast("long"),
        "kept": ~failed & ~depleted,
        "clean_text": F.when(F.col(gone).isNull(), F.col(f"`{text}`")).otherwise(F.array_join(stays, "\n")),
    }
    passing = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in result]
    return both.select(*passing, *[v.alias(c) for c, v in result.items()])
