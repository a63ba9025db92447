"""Exact removal of repeated byte passages with suffix arrays.

A window is a string of ``size`` bytes inside one text. A byte goes if a window
that covers it also starts earlier (smaller id, or same text and earlier start).

Shards. A suffix array of one shard of documents finds the repeats inside it,
but comparing every shard's array with every other's costs the square of the
number of shards. So shards are cut by content instead: every window holds at
least one anchor, its least hashed 24-gram, and equal windows have equal
anchors at equal places. A first pass lists the anchors of all texts (one for
some 39 bytes); windows whose anchor occurs once in the corpus can't repeat and
end there. Runs of windows of one anchor that are equal byte for byte (by BLAKE2b)
are merged there too: the earliest goes on, the windows of the others are gone.
What is left, with the bytes it covers, goes to the shard of the 62 bytes that
its anchor fixes, where every equal window goes too. The number of shards follows
the bytes of the input.

In a shard. Segments are laid end to end and their suffixes sorted by
Larsson-Sadakane refinement in numpy: first by 8 bytes, then, only inside groups
that are still tied, by the rank of the suffix 8, 16, 32 ... bytes on. Kasai's common prefixes of neighbours in the array, walked for all
segments at once, say which windows are equal; each group's earliest is kept.
A shard that is too large for one array is cut into several, whose sorted
distinct windows are merged by binary search of each in those before it.

Equal texts are settled before (a later copy repeats an earlier text in full),
and equal runs of a batch of texts are listed once, so that a text or passage
with very many copies is a row a batch where it meets.

Defined results: null and empty texts have no windows; a row with a null id
loses nothing and removes nothing; equal rows count as one text; rows that share
an id and differ in text are documents of their own, in the order of their
texts' SHA-256.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Rolling, byte_chunks, drop_table, encoded, materialize, mix, release, text_mark

U = np.uint64
GRAM = 24
#: Windows of one suffix array, about.
ARRAY = 1 << 17
#: Bytes of segments that are held before they are sent.
HELD = 1 << 24
#: Bytes of the input to a shard, about; more where there would be over MOST shards.
PART = 1 << 22
MOST = 1 << 18


def anchors(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
    """Runs of windows that share an anchor: (hash of the anchor, its position,
    the first window's distance before it, windows of the run, 32-bit hashes of
    the anchor with what lies before and with what lies behind it, 96 bits of
    BLAKE2b of the run). A window reaches so far beyond its anchor on one side at
    least; a hash is 0 where no window of the run reaches as far on that side."""
    width, n = size - GRAM + 1, len(data)
    none = np.zeros(0, np.int64)
    if n < size:
        return none.view(U), none, none, none, none, none, none.view(U), none
    ends = np.repeat(offsets[1:], np.diff(offsets))
    valid = np.flatnonzero(np.arange(n) + size <= ends)
    if not len(valid):
        return none.view(U), none, none, none, none, none, none.view(U), none
    r, reach = Rolling(data), (size - GRAM) // 2
    grams = r.windows(GRAM)
    least = np.empty(n - size + 1, np.int64)
    block = 1 << 22  # places of a block fit the low 24 bits
    for at in range(0, len(least), block):
        own = grams[at : at + block + width - 1]
        packed = (own >> U(24) << U(24)) | np.arange(len(own), dtype=U)
        pad = -len(packed) % width
        rows = np.concatenate([packed, np.full(pad, U(2**64 - 1))]).reshape(-1, width)
        ahead = np.minimum.accumulate(rows, axis=1).ravel()
        behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        count = len(own) - width + 1
        best = np.minimum(behind[:count], ahead[width - 1 : width - 1 + count])
        least[at : at + count] = (best & U(0xFFFFFF)).astype(np.int64) + at
    anchor = least[valid]
    cut = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (valid[1:] != valid[:-1] + 1)]))
    first, place = valid[cut], anchor[cut]
    count = np.diff(np.append(cut, len(valid)))
    sides = []
    for at, some in ((place - reach, first <= place - reach), (place, first + count > place - reach + 1)):
        at = np.where(some, at, 0)
        sides.append(np.where(some, mix(r.raw(at, at + GRAM + reach)) >> U(32) | U(1), U(0)))
    view = memoryview(np.ascontiguousarray(data))
    told = b"".join(hashlib.blake2b(view[a:b], digest_size=12).digest() for a, b in zip(first.tolist(), (first + count + size - 1).tolist(), strict=True))
    body = np.frombuffer(told, np.dtype([("a", "<u8"), ("b", "<u4")]))
    return grams[place], place, place - first, count, *sides, body["a"], body["b"]


class Blob:
    """Columns of equal length as bytes."""

    def __init__(self, *kinds: str):
        self.kinds = [np.dtype(k) for k in kinds]
        self.width = sum(k.itemsize for k in self.kinds)

    def pack(self, *columns: np.ndarray) -> bytes:
        return b"".join(np.ascontiguousarray(c).astype(k).tobytes() for c, k in zip(columns, self.kinds, strict=True))

    def unpack(self, data: bytes) -> list[np.ndarray]:
        n, out, at = len(data) // self.width, [], 0
        for k in self.kinds:
            out.append(np.frombuffer(data, k, n, at))
            at += n * k.itemsize
        return out

    def all(self, blobs: list[bytes]) -> list[np.ndarray]:
        parts = [self.unpack(b) for b in blobs]
        return [np.concatenate(x) for x in zip(*parts, strict=True)] if parts else [np.zeros(0, k) for k in self.kinds]


#: hash, id, mark, place, windows before, windows, both sides, body
ANCHORS = Blob("u8", "i8", "i8", "u4", "u1", "u1", "u4", "u4", "u8", "u4")
RUNS = Blob("u4", "u1", "u1", "u1")  # place, windows before, windows, sides that repeat
GONE = Blob("u4", "u1")  # first window, windows
SEGMENTS = Blob("u8", "i8", "i8", "u4", "u1")  # key, id, mark, first window, windows
#: kind: 0 runs or segments, 1 windows that are gone
ROWS = {"kind": pa.int64(), "part": pa.int64(), "id": pa.int64(), "mark": pa.int64(), "payload": pa.binary(), "bytes": pa.binary()}
SHAPE = "kind long, part long, id long, mark long, payload binary, bytes binary"


def _batch(rows: list[tuple], *names: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], ROWS[n]) for j, n in enumerate(names)], names=list(names))


def _by(values: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Rows of each value."""
    if not len(values):
        return
    order = np.argsort(values, kind="stable")
    cut = np.flatnonzero(np.concatenate([[True], values[order][1:] != values[order][:-1]]))
    for a, b in zip(cut, [*cut[1:], len(values)], strict=True):
        yield int(values[order[a]]), order[a:b]


def _by_text(ids: np.ndarray, marks: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """Rows of each text."""
    for i, rows in _by(ids):
        for m, own in _by(marks[rows]):
            yield i, m, rows[own]


def _merged(columns: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """ANCHORS columns of the earliest of each set of equal runs, and of the others."""
    h, ids, marks, place, before, count, _, _, body, more = columns
    order = np.lexsort((place, marks, ids, count, before, more, body, h))
    same = np.ones(max(0, len(h) - 1), bool)
    for c in (h, body, more, before, count):
        same &= c[order][1:] == c[order][:-1]
    repeat = same.copy()  # the same run of the same text: a repeated row
    for c in (ids, marks, place):
        repeat &= c[order][1:] == c[order][:-1]
    start = np.ones(min(1, len(h)), bool)
    first, once = np.concatenate([start, ~same]), np.concatenate([start, ~repeat])
    return [c[order[first]] for c in columns], [c[order[~first & once]] for c in columns]


def _listed(size: int, parts: int):
    """Anchors of all texts, by part; equal runs of a batch are one."""

    def flush(held):
        own, gone = _merged([np.concatenate(x) for x in zip(*held, strict=True)])
        rows = [(0, p, None, None, ANCHORS.pack(*[c[at] for c in own])) for p, at in _by((own[0] % U(parts)).astype(np.int64))]
        rows += [(1, (i ^ m) % parts, i, m, GONE.pack(gone[3][at] - gone[4][at], gone[5][at])) for i, m, at in _by_text(gone[1], gone[2])]
        return _batch(rows, "kind", "part", "id", "mark", "payload")

    def made(batches):
        held, n = [], 0
        for batch in batches:
            ids, marks = np.asarray(batch.column("id")), np.asarray(batch.column("mark"))
            for first, _, data, offsets in byte_chunks(encoded(batch)):
                h, place, before, count, left, right, body, more = anchors(data, offsets, size)
                text = np.searchsorted(offsets, place, "right") - 1
                held.append((h, ids[first + text], marks[first + text], place - offsets[text], before, count, left, right, body, more))
                n += len(h)
                if n > 1 << 18:
                    yield flush(held)
                    held, n = [], 0
        if held:
            yield flush(held)

    return made


def _again(h: np.ndarray, side: np.ndarray) -> np.ndarray:
    """Whether another row has the same anchor and the same side."""
    order = np.lexsort((side, h))
    same = (h[order][1:] == h[order][:-1]) & (side[order][1:] == side[order][:-1])
    out = np.zeros(len(h), bool)
    if len(h):
        out[order] = np.concatenate([same, [False]]) | np.concatenate([[False], same])
    return out & (side != 0)


def _repeated(table: pa.Table) -> pa.Table:
    """Of one part: the runs whose anchor occurs more than once with the same
    bytes on a side, and the windows of later equal runs, by text."""
    kind = np.asarray(table.column("kind"))
    own, gone = _merged(ANCHORS.all(table.column("payload").take(np.flatnonzero(kind == 0)).to_pylist()))
    h, ids, marks, place, before, count, left, right, _, _ = own
    sides = _again(h, left) + 2 * _again(h, right)
    twice = np.flatnonzero(sides)
    rows = [(0, i, m, RUNS.pack(place[twice[at]], before[twice[at]], count[twice[at]], sides[twice[at]])) for i, m, at in _by_text(ids[twice], marks[twice])]
    rows += [(1, i, m, GONE.pack(gone[3][at] - gone[4][at], gone[5][at])) for i, m, at in _by_text(gone[1], gone[2])]
    names = ["kind", "id", "mark", "payload"]
    told = table.take(np.flatnonzero(kind == 1)).select(names)
    return pa.concat_tables([pa.Table.from_batches([_batch(rows, *names)]), told.cast(pa.schema([(n, ROWS[n]) for n in names]))])


def _segmented(size: int, parts: int):
    """Windows of repeated anchors with their bytes, by shard. Equal segments of
    a batch are one: the earliest goes on, the others' windows are gone."""
    reach = (size - GRAM) // 2  # a window reaches so far beyond its anchor on one side at least

    def flush(held):
        key, body, owner, mark, start, count = (np.concatenate([h[j] for h in held]) for j in range(6))
        bodies = [x for h in held for x in h[6]]
        order = np.lexsort((start, mark, owner, body, key))
        again = np.concatenate([[False], (key[order][1:] == key[order][:-1]) & (body[order][1:] == body[order][:-1])]) if len(key) else np.zeros(0, bool)
        for i in np.flatnonzero(again):  # equal hashes choose, equal bytes decide
            again[i] = bodies[order[i]] == bodies[order[i - 1]]
        keep, drop = order[~again], order[again]
        rows = []
        for p, x in _by((key[keep] % U(parts)).astype(np.int64)):
            own = keep[x]
            rows.append((0, p, None, None, SEGMENTS.pack(key[own], owner[own], mark[own], start[own], count[own]), zstandard.compress(b"".join(bodies[i] for i in own), 1)))
        rows += [(1, None, i, m, GONE.pack(start[drop[own]], count[drop[own]]), None) for i, m, own in _by_text(owner[drop], mark[drop])]
        return _batch(rows, *ROWS)

    def made(batches):
        held, n = [], 0
        for batch in batches:
            ids, marks, runs = np.asarray(batch.column("id")), np.asarray(batch.column("mark")), batch.column("runs")
            for first, last, data, offsets in byte_chunks(encoded(batch)):
                place, before, count, sides, text = [], [], [], [], []
                for i, blobs in zip(range(first, last), runs.slice(first, last - first).to_pylist(), strict=True):
                    p, b, c, which = RUNS.all(blobs)
                    place.append(p.astype(np.int64) + offsets[i - first])
                    before.append(b.astype(np.int64))
                    count.append(c.astype(np.int64))
                    sides.append(which)
                    text.append(np.full(len(p), i - first))
                place, before, count, sides, text = (np.concatenate(x) for x in (place, before, count, sides, text))
                start, r = place - before, Rolling(data)
                stop = start + count
                middle = np.clip(place - reach + 1, start, stop)
                for bit, a, b, key_at in ((1, start, middle, place - reach), (2, middle, stop, place)):
                    on = np.flatnonzero((b > a) & (sides & bit != 0))
                    k = key_at[on]
                    key = mix(r.raw(k, k + GRAM + reach))
                    body = mix(r.raw(a[on], b[on] + size - 1) + mix((b - a)[on].astype(U)))
                    held.append((key, body, ids[first + text[on]], marks[first + text[on]], a[on] - offsets[text[on]], (b - a)[on], [data[x : y + size - 1].tobytes() for x, y in zip(a[on].tolist(), b[on].tolist(), strict=True)]))
                    n += int((b - a)[on].sum()) + len(on) * size
                if n > HELD:
                    yield flush(held)
                    held, n = [], 0
        if held:
            yield flush(held)

    return made


def suffix_array(text: np.ndarray) -> np.ndarray:
    """The suffix array by Larsson-Sadakane refinement: rank is the first place
    of a suffix's group; each pass doubles the depth to which groups agree and
    sorts only groups of more than one."""
    n = len(text)
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    eight = np.ndarray((n,), ">u8", padded, strides=(1,)).astype(U)
    order = np.argsort(eight, kind="stable")
    new = np.concatenate([[True], eight[order][1:] != eight[order][:-1]]) if n else np.zeros(0, bool)
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1  # the empty suffix
    rank[order] = np.flatnonzero(new)[np.cumsum(new) - 1] if n else 0
    known = 8
    while True:
        tied = ~(new & np.concatenate([new[1:], [True]]))
        at = np.flatnonzero(tied)
        if not len(at):
            break
        own = order[at]
        key = (rank[own] << 32) | (rank[np.minimum(own + known, n)] + 1)
        by = np.argsort(key, kind="stable")
        order[at], key = own[by], key[by]
        fresh = np.concatenate([[True], key[1:] != key[:-1]])
        new[at] = fresh
        rank[order[at]] = at[np.flatnonzero(fresh)[np.cumsum(fresh) - 1]]
        known *= 2
    return order


def kasai(text: np.ndarray, order: np.ndarray, lanes: np.ndarray, lengths: np.ndarray, depth: int) -> np.ndarray:
    """common[i]: the common prefix, up to ``depth``, of suffix i and the one
    before it in the array. Kasai: one place on in the text it is shorter by at
    most one. All lanes (stretches of the text) are walked side by side."""
    n = len(text)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    before = np.where(place > 0, order[np.maximum(place - 1, 0)], -1)
    # eight bytes at a time; past the end two suffixes differ, whatever is there
    padded = np.concatenate([text, np.zeros(depth + 16, np.uint8)])
    eight = np.ndarray((n + depth + 8,), "<u8", padded, strides=(1,))
    common, have = np.zeros(n, np.int64), np.zeros(len(lanes), np.int64)
    for step in range(int(lengths.max(initial=0))):
        on = np.flatnonzero(lengths > step)
        here = lanes[on] + step
        other = before[here]
        h = np.where(other >= 0, np.maximum(have[on] - 1, 0), 0)
        live = np.flatnonzero(other >= 0)
        while len(live):
            x = eight[here[live] + h[live]] ^ eight[other[live] + h[live]]
            h[live] += np.bitwise_count((x & (~x + U(1))) - U(1)).astype(np.int64) // 8  # equal bytes of eight
            live = live[(x == 0) & (h[live] < depth)]
        h = np.minimum(h, np.minimum(depth, n - np.maximum(here, other)))
        common[here], have[on] = h, h
    return common


def repeated_windows(bodies: list[bytes], rank: np.ndarray, count: np.ndarray, size: int, limit: int = ARRAY, key: np.ndarray | None = None) -> np.ndarray:
    """Windows of segments that also stand earlier: a flag for each window, in
    the order of segments. rank: the segments' order of age. key, ascending:
    equal windows have equal keys, so that arrays are cut between keys and only
    the arrays of one key are merged (without keys, all are)."""
    total = int(count.sum())
    ahead = np.concatenate([[0], np.cumsum(count)])
    gone = np.zeros(total, bool)
    merged: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # of the arrays so far: sorted distinct windows, age and number of the earliest
    at = 0
    while at < len(bodies):
        end = max(at + 1, int(np.searchsorted(ahead, ahead[at] + limit, "right")) - 1)
        more = end < len(bodies)
        if key is not None:
            if at and key[at] != key[at - 1]:
                merged = []
            if more and key[end] != key[at]:
                end = max(at + 1, int(np.searchsorted(key, key[end])))  # back to where a key begins
            more = end < len(bodies) and key[end] == key[end - 1]
        text = np.frombuffer(b"".join(bodies[at:end]), np.uint8)
        length = count[at:end] + size - 1
        lanes = np.concatenate([[0], np.cumsum(length)])[:-1]
        order = suffix_array(text)
        common = kasai(text, order, lanes, length, size)
        # windows only: a suffix that starts later in its segment runs into the next
        seg = np.repeat(np.arange(len(length)), length)
        inside = np.arange(len(text)) - lanes[seg]
        is_window = inside < count[at:end][seg]
        group = np.cumsum(common[order] < size)
        rows = np.flatnonzero(is_window[order])
        suffix, group = order[rows], group[rows]
        age = (rank[at:end][seg[suffix]].astype(np.int64) << 8) | inside[suffix]
        number = ahead[at] + (np.concatenate([[0], np.cumsum(count[at:end])])[seg[suffix]] + inside[suffix])
        by = np.lexsort((age, group))
        group, suffix, age, number = group[by], suffix[by], age[by], number[by]
        first = np.concatenate([[True], group[1:] != group[:-1]]) if len(group) else np.zeros(0, bool)
        gone[number[~first]] = True
        if more or merged:
            suffix, age, number = suffix[first], age[first], number[first]
            windows = np.ascontiguousarray(text[suffix[:, None] + np.arange(size)]).view(f"S{size}").ravel() if len(suffix) else np.zeros(0, f"S{size}")
            keep = np.ones(len(windows), bool)
            for others, ages, numbers in merged:
                found = np.minimum(np.searchsorted(others, windows), max(0, len(others) - 1))
                hit = np.flatnonzero(others[found] == windows) if len(others) else np.zeros(0, np.int64)
                later = ages[found[hit]] < age[hit]
                gone[number[hit[later]]] = True
                gone[numbers[found[hit[~later]]]] = True
                earlier = hit[~later]
                numbers[found[earlier]] = number[earlier]
                ages[found[earlier]] = age[earlier]
                keep[hit] = False
            merged.append((windows[keep], age[keep], number[keep]))
        at = end
    return gone


def _sharded(size: int):
    def made(table: pa.Table) -> pa.Table:
        blobs = table.column("payload").to_pylist()
        key, owner, mark, start, count = SEGMENTS.all(blobs)
        count, start = count.astype(np.int64), start.astype(np.int64)
        bodies = []
        for blob, data in zip(blobs, table.column("bytes").to_pylist(), strict=True):
            data = zstandard.decompress(data)
            ends = np.cumsum(SEGMENTS.unpack(blob)[4].astype(np.int64) + size - 1).tolist()
            bodies += [data[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]
        rank = np.empty(len(key), np.int64)
        rank[np.lexsort((start, mark, owner))] = np.arange(len(key))
        by = np.argsort(key, kind="stable")  # equal windows have equal keys: keep them together
        gone = repeated_windows([bodies[i] for i in by], rank[by], count[by], size, key=key[by])
        seg = np.repeat(by, count[by])
        inside = np.arange(len(seg)) - np.repeat(np.cumsum(count[by]) - count[by], count[by])
        on = np.flatnonzero(gone)
        rows = [(i, m, GONE.pack(start[seg[on[x]]] + inside[on[x]], np.ones(len(x)))) for i, m, x in _by_text(owner[seg[on]], mark[seg[on]])]
        return pa.Table.from_batches([_batch(rows, "id", "mark", "payload")])

    return made


def removed_windows(docs: DataFrame, id_col: str = "doc_id", text: str = "text", size: int = 100, part: int = PART) -> DataFrame:
    """(id, mark, gone, copy): for each text that loses bytes, blobs of runs of
    windows that stand earlier too; ``copy`` says that the whole text is a later
    copy. ``mark`` tells texts apart that share an id, and is 0 in a table where
    none do. ``part`` is the bytes of input to a shard."""
    if not GRAM + 2 <= size <= GRAM + 230:
        raise ValueError(f"size: {GRAM + 2} to {GRAM + 230}")
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text")).where("id is not null and text is not null")
    marks = materialize(source.select("id", F.sha2("text", 256).alias("print"), F.octet_length("text").cast("long").alias("n")))
    total = marks.agg(F.sum("n")).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(MOST, -(-total // part)))
    shared = marks.groupBy("id").agg(F.min("print").alias("a"), F.max("print").alias("b")).where("a <> b").limit(1).count()
    own, key = ["id", "mark"], text_mark(F.col("text")) if shared else F.lit(0).cast("long")
    source = source.withColumn("mark", key)
    texts = marks.select("id", "print", (F.conv(F.substring("print", 1, 15), 16, 10).cast("long") if shared else F.lit(0).cast("long")).alias("mark"))
    firsts = texts.groupBy("print").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1").select("print", "first")
    copies = materialize(texts.join(materialize(firsts), "print").where("id <> first").select(*own).distinct())
    listed = source.mapInArrow(_listed(size, parts), "kind long, part long, id long, mark long, payload binary")
    found = materialize(listed.repartition(parts, "part").groupBy("part").applyInArrow(_repeated, "kind long, id long, mark long, payload binary"))
    del listed, firsts, texts
    release(spark, now=True)
    runs = found.where("kind = 0").select(*own, "payload").join(copies, own, "left_anti").groupBy(*own).agg(F.collect_list("payload").alias("runs"))
    # of equal rows, one is enough
    rows = source.join(runs, own).dropDuplicates(own)
    cut = materialize(rows.mapInArrow(_segmented(size, parts), SHAPE))
    del rows, runs
    release(spark, now=True)
    gone = cut.where("kind = 0").select("part", "payload", "bytes").repartition(parts, "part").groupBy("part").applyInArrow(_sharded(size), "id long, mark long, payload binary")
    gone = gone.unionByName(cut.where("kind = 1").select(*own, "payload")).unionByName(found.where("kind = 1").select(*own, "payload").join(copies, own, "left_anti"))
    gone = gone.groupBy(*own).agg(F.collect_list("payload").alias("gone"))
    copied = copies.select(*own, F.lit(None).cast("array<binary>").alias("gone"), F.lit(True).alias("copy"))
    result = materialize(gone.withColumn("copy", F.lit(False)).unionByName(copied))
    for table in (marks, found, cut):
        drop_table(table)
    del gone, cut, found, marks
    release(spark, now=True)
    return result


def spans(n: int, blobs: list[bytes] | None, copy: bool | None, size: int) -> np.ndarray:
    """[start, end) of the maximal removed runs of a text of n bytes."""
    if copy:
        return np.array([[0, n]] if n >= size else [], np.int64).reshape(-1, 2)
    if not blobs:
        return np.zeros((0, 2), np.int64)
    start, count = GONE.all(blobs)
    order = np.argsort(start, kind="stable")
    start = start[order].astype(np.int64)
    end = np.maximum.accumulate(start + count[order] - 1 + size)
    new = np.concatenate([[True], start[1:] > end[:-1]])
    return np.stack([start[new], end[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(start) - 1]])]], 1)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text: str = "text", size: int = 100) -> DataFrame:
    """(id_col, n_bytes, n_removed, n_spans, kept_sha256, kept, spans) per row;
    ``kept`` is the remaining bytes, ``spans`` the removed runs."""
    gone = removed_windows(docs, id_col, text, size).select(F.col("id").alias("gone_id"), "mark", "gone", "copy")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text"))
    shared = gone.where("mark <> 0").limit(1).count()  # else no texts share an id, and marks are 0
    same = (F.col("id") == F.col("gone_id")) & (F.col("mark") == (text_mark(F.col("text")) if shared else F.lit(0)))
    rows = rows.join(gone, same, "left").select("id", "text", "gone", "copy")
    shape = f"`{id_col}` long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary, spans array<struct<start:long,end:long>>"

    def applied(batches):
        for batch in batches:
            out = []
            for key, content, blobs, copy in zip(*[batch.column(c).to_pylist() for c in ("id", "text", "gone", "copy")], strict=True):
                data = (content or "").encode()
                runs = spans(len(data), blobs, copy, size)
                at, kept = 0, []
                for a, b in runs.tolist():
                    kept.append(data[at:a])
                    at = b
                kept = b"".join([*kept, data[at:]])
                out.append((key, len(data), len(data) - len(kept), len(runs), hashlib.sha256(kept).hexdigest(), kept, [{"start": a, "end": b} for a, b in runs.tolist()]))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
            columns = list(zip(*out, strict=True)) or [()] * 7
            names = [id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "spans"]
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names=names)

    return rows.mapInArrow(applied, shape)
