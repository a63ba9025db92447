"""Spelling: unknown words get the likeliest known word within two edits.

Distinct words are corrected once for the whole corpus. A word meets candidates
through deletion variants, not by comparing it with the whole dictionary. Words of
over ``LONG`` letters have too many of those; they meet through segments: each edit
touches two neighbouring segments at most, so with 2 * edits + 1 of them one is
left whole, at its place give or take the edits."""

from __future__ import annotations

import itertools
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.lexicons import SKIP_WORDS
from ..functions.text import tokens
from ..tables import settle


def token_rows(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    return docs.select(F.col(key), F.posexplode(tokens(text)).alias("pos", "token"))


def unknown_words(found: DataFrame, dictionary: DataFrame, skip: list[str] | None = None, longer_than: int = 2) -> DataFrame:
    """Distinct lower-case words of ASCII letters that no list has. dictionary: (word, freq)."""
    words = found.where(F.col("token").rlike("^[A-Za-z]+$")).select(F.lower("token").alias("word")).distinct()
    words = words.where((F.length("word") > longer_than) & ~F.col("word").isin([w.lower() for w in (SKIP_WORDS if skip is None else skip)]))
    return words.join(dictionary.select("word"), "word", "left_anti")


def with_domain_words(dictionary: DataFrame, words: list[str] | None = None) -> DataFrame:
    """The dictionary (word, freq) with words of a field, each seen once more: they
    are known, and what is misspelt may be corrected to them."""
    own = [(w.lower(), 1) for w in (SKIP_WORDS if words is None else words)]
    more = dictionary.sparkSession.createDataFrame(own, "word string, freq long")
    return dictionary.select("word", F.col("freq").cast("long").alias("freq")).unionByName(more).groupBy("word").agg(F.sum("freq").alias("freq"))


#: Letters of a word that is found by its deletion variants.
LONG = 32
#: Slots of 64 bits of the filter of marks: a fixed size, so with more marks it only lets more pass.
SLOTS = 1 << 19


def mark_filter(dictionary: DataFrame, edits: int) -> Broadcast:
    """A bit for each mark of the dictionary, by the mark's highest 25 bits."""
    marks = dictionary.select(F.explode(deletion_marks(edits)("word")).alias("mark"))
    bit = F.expr("shiftleft(cast(1 as bigint), cast(shiftrightunsigned(mark, 39) & 63 as int))")
    found = marks.groupBy(F.shiftrightunsigned("mark", 45).cast("int").alias("slot")).agg(F.bit_or(bit).alias("bits")).toArrow()
    bits = np.zeros(SLOTS, np.uint64)
    bits[found["slot"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return dictionary.sparkSession.sparkContext.broadcast(bits)


def deletion_marks(edits: int = 2, among: Broadcast | None = None):
    """Of each word, 64-bit marks of the word and of all its variants with up to
    ``edits`` characters less. Equal variants have equal marks; pairs that meet
    on a mark are compared, so unequal variants with one mark do no harm. Marks
    that a filter rules out are left away."""

    @F.arrow_udf(T.ArrayType(T.LongType()))
    def marks(words: pa.Array) -> pa.Array:
        found = words.to_pylist()
        out: list[np.ndarray] = [np.empty(0, np.int64)] * len(found)
        by_length: dict[int, list[int]] = {}
        for i, w in enumerate(found):
            by_length.setdefault(len(w or ""), []).append(i)
        for n, at in by_length.items():
            codes = np.frombuffer("".join(found[i] or "" for i in at).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(at), n).astype(np.uint64)
            codes = (codes + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
            codes ^= codes >> np.uint64(29)
            powers = np.cumprod(np.full(n + 1, 0xD6E8FEB86659FD93, np.uint64))
            keep = [k for d in range(min(edits, n) + 1) for k in itertools.combinations(range(n), n - d)]
            sums = np.empty((len(at), len(keep)), np.uint64)
            for k, columns in enumerate(keep):
                sums[:, k] = (codes[:, list(columns)] * powers[: len(columns)]).sum(1, dtype=np.uint64)
            sums.sort(1)
            first = np.ones(sums.shape, bool)
            first[:, 1:] = sums[:, 1:] != sums[:, :-1]
            if among is not None:
                first &= (among.value[sums >> np.uint64(45)] >> ((sums >> np.uint64(39)) & np.uint64(63))) & np.uint64(1) == 1
            for i, row, own in zip(at, sums.view(np.int64), first, strict=True):
                out[i] = row[own]
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in out])]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(out) if out else np.empty(0, np.int64), pa.int64()))

    return marks


def edit_count(word: Column, other: Column) -> Column:
    """Edits between two words that are at most two apart; exchanging two
    neighbours is one edit. More than two is 3."""
    places = lambda x: F.sequence(F.lit(1), F.greatest(F.length(x) - 1, F.lit(1)))
    swap = lambda x, i: F.concat(F.substring(x, F.lit(1), i - 1), F.substring(x, i + 1, F.lit(1)), F.substring(x, i, F.lit(1)), F.substring(x, i + 2, F.length(x)))
    # an exchange counts two in the plain distance, so only 2, 3 and 4 can hold one
    plain = F.levenshtein(word, other, 4)
    once = lambda x: F.transform(places(x), lambda i: swap(x, i))
    same = F.exists(once(word), lambda s: s == other)
    # beside another edit the exchange may come first or, seen from the other word, last
    near = F.exists(once(word), lambda s: F.levenshtein(s, other) == 1) | F.exists(once(other), lambda s: F.levenshtein(word, s) == 1)
    twice = F.exists(once(word), lambda s: F.exists(places(s), lambda j: swap(s, j) == other))
    found = F.when((plain >= 0) & (plain <= 1), plain).when(plain == 2, F.when(same, 1).otherwise(2))
    # an exchange leaves the letters as they are: a cheap test before the places are tried
    letters = lambda x: F.array_join(F.sort_array(F.split(x, "")), "")
    alike = F.levenshtein(letters(word), letters(other)) + F.abs(F.length(word) - F.length(other)) <= 2
    return found.when((plain == 3) & alike & near, 2).when((plain == 4) & (letters(word) == letters(other)) & twice, 2).otherwise(3)


def long_pairs(unknown: DataFrame, dictionary: DataFrame, edits: int, longer_than: int = LONG) -> DataFrame:
    """(word, correction, freq) of pairs that share a whole segment and of which one
    has more than so many letters: all that are within ``edits``, and a few more."""
    parts = 2 * edits + 1
    at = lambda i: F.floor(i * F.col("size") / parts).cast("int")
    mark = lambda text, start, length: F.xxhash64("size", "i", F.substring(text, start + 1, length))
    near = lambda rows, c: rows.where(F.length(c) > longer_than - edits)
    right = near(dictionary.select(F.col("word").alias("correction"), "freq"), "correction").withColumn("size", F.length("correction"))
    right = right.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    right = right.select("correction", "freq", mark(F.col("correction"), at(F.col("i")), at(F.col("i") + 1) - at(F.col("i"))).alias("mark"))
    sizes = F.sequence(F.greatest(F.length("word") - edits, F.lit(1)), F.length("word") + edits)
    left = near(unknown.select("word"), "word").withColumn("size", F.explode(sizes)).withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    left = left.withColumn("shift", F.explode(F.sequence(F.lit(-edits), F.lit(edits))))
    start, length = at(F.col("i")) + F.col("shift"), at(F.col("i") + 1) - at(F.col("i"))
    left = left.where((start >= 0) & (start + length <= F.length("word"))).select("word", mark(F.col("word"), start, length).alias("mark")).distinct()
    pairs = left.join(right, "mark").where((F.length("word") > longer_than) | (F.length("correction") > longer_than))
    return pairs.select("word", "correction", "freq").distinct()


def few_edits(a: str, b: str, most: int) -> int:
    """Edits between two texts of any length, ``most`` + 1 where there are more: what
    differs first is mended in every way, and the rest compared again. An edit on
    one text may come before one that a neighbour's exchange needs, so both are tried."""
    at = _agree(a, b)
    if at == len(a) == len(b):
        return 0
    if most == 0 or abs(len(a) - len(b)) > most:
        return most + 1
    x, y = a[at:], b[at:]
    ways = [(x[1:], y), (x, y[1:]), (x[1:], y[1:])]
    swap = lambda t: t[1] + t[0] + t[2:]
    ways += [(swap(x), y)] if len(x) > 1 else []
    ways += [(x, swap(y))] if len(y) > 1 else []
    if at:  # an exchange that takes in the last letter that agrees
        x, y = a[at - 1 :], b[at - 1 :]
        ways += [(swap(x), y)] if len(x) > 1 else []
        ways += [(x, swap(y))] if len(y) > 1 else []
    return min(1 + few_edits(p, q, most - 1) for p, q in ways)


def _agree(a: str, b: str) -> int:
    """Letters that two texts begin with alike, by doubling steps."""
    n, low = min(len(a), len(b)), 0
    step = 64
    while low < n:
        if a[low : low + step] == b[low : low + step]:
            low += step
            step *= 2
            continue
        if step == 64:
            return next((i for i in range(low, min(low + 64, n)) if a[i] != b[i]), min(low + 64, n))
        step = max(64, step // 4)
    return n


@F.arrow_udf(T.IntegerType())
def long_edit_count(words: pa.Array, others: pa.Array) -> pa.Array:
    """Edits between two words, 3 for more than two."""
    return pa.array([few_edits(a, b, 2) for a, b in zip(words.to_pylist(), others.to_pylist(), strict=True)], pa.int32())


def corrections(unknown: DataFrame, dictionary: DataFrame, edits: int = 2) -> DataFrame:
    """(word, correction): least edits, then highest freq, then first by letter."""
    dictionary = settle(dictionary.select("word", "freq"))
    short = lambda rows: rows.where(F.length("word") <= LONG)
    marks, near = deletion_marks(edits), deletion_marks(edits, mark_filter(short(dictionary), edits))
    left = short(unknown).select("word", F.explode(near("word")).alias("variant"))
    right = short(dictionary).select(F.col("word").alias("correction"), "freq", F.explode(marks("word")).alias("variant"))
    pairs = left.join(right.hint("shuffle_hash"), "variant").select("word", "correction", "freq").distinct()
    pairs = pairs.withColumn("edits", edit_count(F.col("word"), F.col("correction")))
    far = long_pairs(unknown, dictionary, edits).withColumn("edits", long_edit_count("word", "correction"))
    pairs = pairs.unionByName(far).where(F.col("edits") <= edits)
    rank = F.row_number().over(Window.partitionBy("word").orderBy("edits", F.desc("freq"), "correction"))
    return pairs.withColumn("rank", rank).where("rank = 1").select("word", "correction")


def cased(original: str, correction: str) -> str:
    """The correction in the casing of the original word of ASCII letters."""
    if original.isupper():
        return correction.upper()
    return correction[:1].upper() + correction[1:].lower() if original[:1].isupper() else correction


@F.arrow_udf(T.StringType())
def with_corrections(texts: pa.Array, found: pa.Array, instead: pa.Array) -> pa.Array:
    """Texts (a list of them: their tokens by place) with some words replaced."""
    out = []
    for own, words, others in zip(texts.to_pylist(), found.to_pylist(), instead.to_pylist(), strict=True):
        to = dict(zip(words or (), others or (), strict=True))
        mend = lambda w: cased(w, to[w.lower()]) if w.lower() in to else w  # noqa: B023, E731
        if len(own) == 1:
            out.append(re.sub("[A-Za-z]+", lambda m: mend(m[0]), own[0]) if to else own[0])  # noqa: B023
        else:
            tokens_ = [(i, mend(t)) for text in own for i, t in enumerate(re.findall("[A-Za-z]+|[^A-Za-z]+", text))]
            out.append("".join(t for _, t in sorted(tokens_)))
    return pa.array(out, pa.string())


def correct(docs: DataFrame, dictionary: DataFrame, key: str, text: str = "text", skip: list[str] | None = None, edits: int = 2) -> DataFrame:
    """(key, corrected): the text with its unknown words replaced, casing kept.

    Tokens stay inside their text: only words that have a correction leave it, once for
    each text, and come back as its list of corrections."""
    docs = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).where("text <> ''")
    tokens_ = docs.select("key", F.explode(F.array_distinct(F.split("text", "[^A-Za-z]+"))).alias("token"))
    known = settle(corrections(settle(unknown_words(tokens_, dictionary, skip)), dictionary, edits))
    mends = tokens_.select("key", F.lower("token").alias("word")).join(known, "word").groupBy("key").agg(F.collect_set(F.struct("word", "correction")).alias("mends"))
    rows = docs.groupBy("key").agg(F.collect_list("text").alias("texts"))
    rows = rows.join(mends.withColumnRenamed("key", "__key"), F.col("key").eqNullSafe(F.col("__key")), "left")
    return rows.select(F.col("key").alias(key), with_corrections("texts", "mends.word", "mends.correction").alias("corrected"))


def mended(text: Column | str, load: Callable[[], Callable[[str], str]] | None = None) -> Column:
    """A text through a grammar tool, loaded once per worker; without one (the
    default) the text as it is."""
    c = F.col(text) if isinstance(text, str) else text
    if load is None:
        return c

    @F.pandas_udf("string")
    def applied(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tool = load()
        for part in parts:
            yield part.map(tool, na_action="ignore")

    return applied(c)
