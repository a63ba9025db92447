"""Near-duplicate links by shared word shingles, exact.

A text's set of five-word shingles is hashed (XXH64, exact to 64 bits); equal sets are
one class before anything is compared, so copies cost nothing. Two sets of n and m
shingles with a similarity of ``least`` share one of the first n - ceil(least * n) + 1
of either in any order that is the same for both: only those are listed. The order puts
shingles last that many texts of a sample have, so that lists stay short; which order it
is changes no result, so the sample is bounded. A pair also has to have enough shingles
left behind the place where it meets, and who can meet nobody leaves its list.

Lists of near copies aren't expanded into all pairs. First every member meets the
list's head, and what turns out alike is one group; then only pairs of a list that are in
different groups are compared, all of them. Large lists that are in several groups get
more heads before. Every link is verified by the exact similarity of the two
sets, so none is false, and what the links connect is all that brute force connects.

Texts that share a shingle by chance become more with the square of the table. So pairs
meet as sketches first, a bit or two for each shingle: parities of the shingles of a slot,
of which two sets differ in no more than in shingles, so no link is lost. Sets are formed
anew, from one text of a class, for the pairs that are left, as they are larger than the
texts: stored are the listed ends of sets, sketches, and for a while those sets."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import byte_chunks, drop_table, filled, materialize, mix, release
from .components import connected_components
from .simhash import shingle_slices, xxh64

U = np.uint64
#: Bytes of text that are hashed at a time.
PIECE = 1 << 16
#: Different texts whose shingles are counted for the order: all of so many, then a
#: share until it is one of so many, and so many at most; and texts that make one common.
SAMPLE, SHARE, MOST, COMMON = 20_000, 12, 1 << 18, 3
#: Members of a list that is paired without further heads, and rounds of those.
LIST, HEADS = 256, 4
#: Slots of 64 bits of the filter of texts to form sets of: a fixed size, more texts only let more pass.
SLOTS = 1 << 19
#: Pairs that meet as sketches at a time, for each class: more than that go in rounds.
PAIRS = 4
#: Longs of the shortest sketch, to which the others are folded on lists.
FEW = 4


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted sets of the shingle hashes of texts, one after another, and their sizes."""
    packed, starts, lengths, shingles = shingle_slices(data, offsets, words)
    h = xxh64(packed, starts, lengths)
    text = np.repeat(np.arange(len(shingles)), shingles)
    order = np.lexsort((h, text))
    h, text = h[order], text[order]
    first = np.concatenate([[True], (h[1:] != h[:-1]) | (text[1:] != text[:-1])]) if len(h) else np.zeros(0, bool)
    return h[first], np.bincount(text[first], minlength=len(shingles))


def set_marks(h: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """64 bits for each set, zero for an empty one; equal sets have equal marks."""
    out, some = np.zeros(len(sizes), U), sizes > 0
    if len(h):
        begin = (np.cumsum(sizes) - sizes)[some]
        out[some] = mix(np.add.reduceat(mix(mix(h) + U(1)), begin) + sizes[some].astype(U))
    return out


def set_sketches(h: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """For each set, as longs, as many bits as it has shingles or up to twice as many (a power
    of two, 64 * FEW at least): whether an odd number of shingles falls on each."""
    words = FEW << np.ceil(np.log2(np.maximum(sizes, 64 * FEW) / (64 * FEW))).astype(np.int64)
    ends = np.cumsum(words)
    slot = (mix(mix(h) + U(2)) & np.repeat(64 * words - 1, sizes).astype(U)).astype(np.int64) + np.repeat(64 * (ends - words), sizes)
    odd = (np.bincount(slot, minlength=64 * int(words.sum())) & 1).astype(np.uint8)
    bits = np.packbits(odd, bitorder="little").view(np.int64)
    return pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(bits))


def text_sets(texts: pa.Array, words: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(hashes, sizes, marks) of the sets of some texts after the other."""
    for _, _, data, offsets in byte_chunks(filled(texts), PIECE):
        h, sizes = shingle_hashes(data, offsets, words)
        yield h, sizes, set_marks(h, sizes)


#: What class_columns() adds to a row.
CLASS = "class long, n long, bits array<long>"


def class_columns(texts: pa.Array, words: int) -> dict[str, pa.Array]:
    """``class``, ``n`` and ``bits`` of each text: its set's mark, size and sketch."""
    found = [(m, n, set_sketches(h, n)) for h, n, m in text_sets(texts, words)]
    marks = np.concatenate([np.zeros(0, U), *[m for m, _, _ in found]])
    sizes = np.concatenate([np.zeros(0, np.int64), *[n for _, n, _ in found]])
    none = pa.array([], pa.list_(pa.int64()))
    return {"class": pa.array(marks.view(np.int64)), "n": pa.array(sizes), "bits": pa.concat_arrays([none, *[b for _, _, b in found]])}


def shingle_classes(texts: DataFrame, words: int = 5, node: str = "node", text: str = "text") -> DataFrame:
    """(node, mark, class, n, bits) of every text that has a word."""

    def classed(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"node": batch.column("node"), "mark": batch.column("mark")} | class_columns(batch.column("text"), words))

    rows = texts.select(F.col(node).cast("long").alias("node"), F.xxhash64(text).alias("mark"), F.col(text).alias("text"))
    return materialize(rows.mapInArrow(classed, f"node long, mark long, {CLASS}").where("n > 0"))


def common_shingles(texts: DataFrame, words: int) -> Broadcast:
    """(hashes in order, counts) of the shingles that many texts of a sample have."""

    def listed(batches):
        for batch in batches:
            for h, _, _ in text_sets(batch.column("text"), words):
                yield pa.RecordBatch.from_pydict({"key": pa.array(h.view(np.int64))})

    n = texts.count()
    share = max(1, n // MOST, min(n // SAMPLE, SHARE))
    sample = texts.where(F.pmod(F.xxhash64("text"), F.lit(share)) == 0).withColumn("mark", F.xxhash64("text", F.length("text"))).dropDuplicates(["mark"]).select("text")
    counts = sample.mapInArrow(listed, "key long").groupBy("key").agg(F.count("*").alias("times")).where(F.col("times") >= COMMON).toArrow()
    h, times = counts["key"].to_numpy().view(U), counts["times"].to_numpy().astype(np.int32)
    order = np.argsort(h)
    release(texts.sparkSession, now=True)  # the sample's shuffles
    return texts.sparkSession.sparkContext.broadcast((h[order], times[order]))


def listed_shingles(texts: DataFrame, least: float, words: int, common: Broadcast) -> DataFrame:
    """(key, class, n, pos): of each set so many shingles, rare ones first, that two
    sets of so much similarity have one of them in common."""

    def listed(batches):
        known, times = common.value
        seen: set[int] = set()
        for batch in batches:
            out = [[np.zeros(0, U)], [np.zeros(0, U)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]]
            for h, n, marks in text_sets(batch.column("text"), words):
                keep = np.zeros(len(n), np.int64)
                for i, m in enumerate(marks.tolist()):  # copies in a task are listed once
                    if n[i] and m not in seen:
                        seen.add(m)
                        keep[i] = n[i] - int(np.ceil(least * n[i] - 1e-9)) + 1
                text = np.repeat(np.arange(len(n)), n)
                on = keep[text] > 0
                h, text = h[on], text[on]
                often = np.zeros(len(h), np.int32)
                if len(known):
                    at = np.minimum(np.searchsorted(known, h), len(known) - 1)
                    often = np.where(known[at] == h, times[at], 0)
                order = np.lexsort((h, often, text))
                h = h[order]
                own = np.where(keep > 0, n, 0)
                pos = np.arange(len(h)) - np.repeat(np.cumsum(own) - own, own)
                on = pos < keep[text]
                for column, values in zip(out, (h[on], marks[text[on]], n[text[on]], pos[on]), strict=True):
                    column.append(values)
            key, mark, n, pos = (np.concatenate(x) for x in out)
            yield pa.RecordBatch.from_pydict({"key": pa.array(key.view(np.int64)), "class": pa.array(mark.view(np.int64)), "n": pa.array(n.astype(np.int32)), "pos": pa.array(pos.astype(np.int32))})

    return texts.mapInArrow(listed, "key long, class long, n int, pos int")


def mark_filter(marks: DataFrame) -> Broadcast:
    """A bit for each mark, by its highest 25 bits."""
    bit = F.expr("shiftleft(cast(1 as bigint), cast(shiftrightunsigned(mark, 39) & 63 as int))")
    found = marks.groupBy(F.shiftrightunsigned("mark", 45).cast("int").alias("slot")).agg(F.bit_or(bit).alias("bits")).toArrow()
    bits = np.zeros(SLOTS, U)
    bits[found["slot"].to_numpy()] = found["bits"].to_numpy().view(U)
    return marks.sparkSession.sparkContext.broadcast(bits)


def sets_of(texts: DataFrame, words: int, among: Broadcast) -> DataFrame:
    """(class, set) once for each class of the texts that the filter lets pass."""

    def formed(batches):
        seen: set[int] = set()
        for batch in batches:
            values, sizes, kept = [np.zeros(0, U)], [np.zeros(0, np.int64)], [np.zeros(0, U)]
            marks = batch.column("mark").to_numpy().view(U)
            asked = (among.value[marks >> U(45)] >> ((marks >> U(39)) & U(63))) & U(1) == 1
            for h, n, classes in text_sets(batch.column("text").filter(pa.array(asked)), words):
                on = n > 0
                for i in np.flatnonzero(on):
                    on[i] = int(classes[i]) not in seen
                    seen.add(int(classes[i]))
                values.append(h[np.repeat(on, n)])
                sizes.append(n[on])
                kept.append(classes[on])
            ends = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(values).view(np.int64)))
            yield pa.RecordBatch.from_pydict({"class": pa.array(np.concatenate(kept).view(np.int64)), "set": lists})

    rows = texts.select(F.xxhash64("text").alias("mark"), "text")
    return materialize(rows.mapInArrow(formed, "class long, set array<long>").groupBy("class").agg(F.first("set").alias("set")))


def _may_meet(a: Column, b: Column, least: float) -> Column:
    """Whether two members of a list (n, pos) have enough shingles from there on;
    those that are alike have, in the first list that both are on."""
    left = F.least(a["n"] - a["pos"], b["n"] - b["pos"])
    return left >= F.lit(least / (1 + least)) * (a["n"] + b["n"]) - 1e-9


def _with_partners(rows: DataFrame, least: float) -> DataFrame:
    """Lists (key, class, n, pos) without members that may meet none of their list, with
    the list's ``head``: of two that may, the larger set is within the reach of the
    smaller, and the smaller within that of the larger."""
    of_list, member = Window.partitionBy("key"), F.struct("class", "n", "pos")
    by_size = of_list.orderBy("n", "class")
    before = by_size.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.repartition("key").dropDuplicates(["key", "class"])  # tasks list copies each on its own
    rows = rows.withColumn("reach", (F.col("n") - F.col("pos")) * F.lit((1 + least) / least) - F.col("n") + 1e-6)
    rows = rows.withColumns({"far": F.max("reach").over(before), "next": F.lead("n").over(by_size)})
    rows = rows.where((F.col("far") >= F.col("n")) | (F.col("next") <= F.col("reach")))
    rows = rows.withColumns({"head": F.min(member).over(of_list), "most": F.max("class").over(of_list)})
    return rows.where(F.col("head")["class"] < F.col("most")).select("key", "class", "n", "pos", "head")


def _few_near(a: Column, b: Column, least: float) -> Column:
    """_sketches_near() of sketches (few) folded to FEW longs: for members of a list."""
    apart = reduce(add, [F.bit_count(a["few"][i].bitwiseXOR(b["few"][i])) for i in range(FEW)])
    return apart <= F.lit((1 - least) / (1 + least)) * (a["n"] + b["n"]) + 1e-9


def _sketches_near(least: float) -> Column:
    """Whether two sets (nx, bx and ny, by) may have so much similarity: they differ in as
    many shingles as their sketches differ in bits, or more."""
    size = F.least(F.size("bx"), F.size("by"))

    def folded(b: str) -> Column:
        halves = F.zip_with(F.slice(b, F.lit(1), size), F.slice(b, size + 1, size), lambda p, q: p.bitwiseXOR(q))
        return F.when(F.size(b) == size, F.col(b)).otherwise(halves)

    apart = F.aggregate(F.zip_with(folded("bx"), folded("by"), lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda a, x: a + x)
    few = apart <= F.lit((1 - least) / (1 + least)) * (F.col("nx") + F.col("ny")) + 1e-9
    return F.when(F.greatest(F.size("bx"), F.size("by")) > 2 * size, F.lit(True)).otherwise(few)


def shingle_links(texts: DataFrame, least: float = 0.8, words: int = 5, node: str = "node", text: str = "text", own: DataFrame | None = None) -> DataFrame:
    """(a, b): links between nodes (longs, several texts may share one) of which a
    text each has shingle sets of so much similarity, enough of them to connect all
    that have; equal sets are linked to the smallest node among them. A null or empty
    text links to nothing. ``own``: shingle_classes(), where they are known."""
    own = shingle_classes(texts, words, node, text) if own is None else own
    texts = texts.select(F.col(text).alias("text"))
    heads = materialize(own.groupBy("class").agg(F.min("node").alias("head")))
    same = own.select("node", "class").distinct().join(heads, "class").where("node <> head").select(F.col("node").alias("a"), F.col("head").alias("b"))
    sketches = materialize(own.groupBy("class").agg(F.min("mark").alias("mark"), F.first("n").alias("n"), F.first("bits").alias("bits")))
    at_once = PAIRS * max(sketches.count(), 1024)
    of_list, member = Window.partitionBy("key"), F.struct("class", "n", "pos")
    lists = materialize(_with_partners(listed_shingles(texts, least, words, common_shingles(texts, words)), least))
    shared = F.size(F.array_intersect("sx", "sy"))
    asked = good = None

    def near(pairs: DataFrame) -> DataFrame:
        """Those of the pairs whose sketches are near, a bounded number at a time."""
        pairs = materialize(pairs.distinct())
        side = lambda c: sketches.select(F.col("class").alias(c), F.col("n").alias(f"n{c}"), F.col("bits").alias(f"b{c}"))
        rounds, found = -(-pairs.count() // at_once), pairs.limit(0)
        for k in range(rounds):
            some = pairs.where(F.pmod(F.xxhash64("x", "y"), F.lit(rounds)) == k)
            both = some.join(side("x"), "x").join(side("y"), "y")
            found = found.unionByName(materialize(both.where(_sketches_near(least)).select("x", "y")))
        found = materialize(found)
        drop_table(pairs)
        return found

    def verified(pairs: DataFrame) -> bool:
        """Whether a link is among the pairs; ``good`` has all that were found."""
        nonlocal asked, good
        pairs = near(pairs)
        if asked is not None:
            pairs = materialize(pairs.join(asked, ["x", "y"], "left_anti"))
        if good is not None and pairs.isEmpty():
            return False
        wanted = pairs.select(F.explode(F.array("x", "y")).alias("class")).distinct()
        sets = sets_of(texts, words, mark_filter(sketches.join(wanted, "class").select("mark")))
        side = lambda c: sets.select(F.col("class").alias(c), F.size("set").alias(f"n{c}"), F.col("set").alias(f"s{c}"))
        both = pairs.join(side("x"), "x").join(side("y"), "y")
        found = materialize(both.where(shared >= F.lit(least) * (F.col("nx") + F.col("ny") - shared) - 1e-9).select("x", "y"))
        drop_table(sets)
        asked = pairs if asked is None else asked.unionByName(pairs)
        good = found if good is None else good.unionByName(found)
        return not found.isEmpty()

    def grouped(members: DataFrame) -> DataFrame:
        """Members of lists that are in several groups; groups only grow, so other lists
        don't come back."""
        label = connected_components(good, "x", "y").withColumnRenamed("id", "class")
        found = members.select("key", "class", "n", "pos").join(label, "class", "left").withColumn("group", F.coalesce("component", "class"))
        found = found.withColumns({"low": F.min("group").over(of_list), "high": F.max("group").over(of_list), "size": F.count("*").over(of_list)})
        out = materialize(found.where("low < high").select("key", "class", "n", "pos", "group", "size"))
        drop_table(members)
        return out

    def pair(a: Column, b: Column) -> list[Column]:
        return [F.least(a["class"], b["class"]).alias("x"), F.greatest(a["class"], b["class"]).alias("y")]

    verified(lists.where(F.col("head")["class"] < F.col("class")).where(_may_meet(F.col("head"), member, least)).select(*pair(F.col("head"), member)))
    open_ = grouped(lists)
    for k in range(HEADS):
        large = open_.where(F.col("size") > LIST)
        if not large.limit(1).count():
            break
        head = F.min(F.struct(F.xxhash64("class", F.lit(k)).alias("order"), "class", "n", "pos", "group")).over(of_list)
        large = large.withColumn("head", head).where((F.col("head")["group"] != F.col("group")) & _may_meet(F.col("head"), member, least))
        if verified(large.select(*pair(F.col("head"), member))):
            open_ = grouped(open_)
    few = F.expr(f"transform(sequence(0, {FEW - 1}), i -> aggregate(filter(bits, (x, k) -> k % {FEW} = i), 0L, (a, x) -> a ^ x))")
    members = open_.join(sketches.select("class", few.alias("few")), "class")
    left, right = (members.select("key", F.col("group").alias(f"g{c}"), F.struct("class", "n", "pos", "few").alias(c)) for c in ("l", "r"))
    l, r = F.col("l"), F.col("r")
    rest = left.join(right, "key").where((l["class"] < r["class"]) & (F.col("gl") != F.col("gr")) & _may_meet(l, r, least) & _few_near(l, r, least))
    verified(rest.select(*pair(l, r)))
    found = good.join(heads.select(F.col("class").alias("x"), F.col("head").alias("a")), "x").join(heads.select(F.col("class").alias("y"), F.col("head").alias("b")), "y")
    out = materialize(found.select("a", "b").where("a <> b").unionByName(same).distinct())
    for table in (sketches, open_):  # the largest ones: nothing reads them any more
        drop_table(table)
    return out
