"""SimHash near-duplicates through a byte-position inverted index.

A fingerprint is 8 bytes. Two that differ in at most ``max_bits`` bits differ in
at most as many bytes, so at least 8 - max_bits byte positions agree: the
guaranteed minimum. A posting list of one position and one byte would hold 1/256
of all fingerprints and pair them all, so lists are kept for combinations of
positions: with m = 8 - max_bits - 1 of the first 7, of which every linked pair
shares one. Within a list, shared positional bytes are tallied over all 8
positions, pairs with the guaranteed minimum are kept, and their bits counted.

Equal fingerprints are merged before anything is listed, so a list holds
different fingerprints only. A list of over ``LIST`` of them is split: linked
pairs of a list share one more position, so its members are listed anew under
each of the positions that the list leaves open. A list is swept inside one task
in blocks and emits one edge per fingerprint that has a partner in it (to its
group in that list), never all pairs. Groups over all lists are then connected
components.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import byte_chunks, filled, fresh, is_space, materialize, mix, row_mark
from .components import connected_components

#: Fixed values of XXH64.
P1, P2, P3, P4, P5 = (np.uint64(x) for x in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))
U = np.uint64
#: Fingerprints of a list that is not split.
LIST = 4096
ONES = U(0x0101010101010101)


def _left(x: np.ndarray, r: int) -> np.ndarray:
    return (x << U(r)) | (x >> U(64 - r))


def xxh64(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, seed: int = 42) -> np.ndarray:
    """XXH64 of many slices of one byte array at once."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
    four = np.ndarray((len(padded) - 3,), "<u4", padded, strides=(1,))
    with np.errstate(over="ignore"):
        s = U(seed)
        acc = np.full(len(starts), s + P5, U)
        stripes = lengths // 32
        long = np.flatnonzero(stripes)
        if len(long):
            lanes = [np.full(len(long), x, U) for x in (s + P1 + P2, s + P2, s, s - P1)]
            for k in range(int(stripes.max())):
                on = np.flatnonzero(stripes[long] > k)
                at = starts[long[on]] + 32 * k
                for j in range(4):
                    lanes[j][on] = _left(lanes[j][on] + eight[at + 8 * j] * P2, 31) * P1
            merged = _left(lanes[0], 1) + _left(lanes[1], 7) + _left(lanes[2], 12) + _left(lanes[3], 18)
            for lane in lanes:
                merged = (merged ^ (_left(lane * P2, 31) * P1)) * P1 + P4
            acc[long] = merged
        acc += lengths.astype(U)
        at, rest = starts + 32 * stripes, lengths % 32
        for j in range(3):
            on = np.flatnonzero(rest >= 8 * (j + 1))
            acc[on] = _left(acc[on] ^ (_left(eight[at[on] + 8 * j] * P2, 31) * P1), 27) * P1 + P4
        at, rest = at + rest // 8 * 8, rest % 8
        on = np.flatnonzero(rest >= 4)
        acc[on] = _left(acc[on] ^ (four[at[on]].astype(U) * P1), 23) * P2 + P3
        at, rest = at + rest // 4 * 4, rest % 4
        for j in range(3):
            on = np.flatnonzero(rest > j)
            acc[on] = _left(acc[on] ^ (padded[at[on] + j].astype(U) * P5), 11) * P1
        acc ^= acc >> U(33)
        acc *= P2
        acc ^= acc >> U(29)
        acc *= P3
        return acc ^ (acc >> U(32))


def shingle_slices(data: np.ndarray, offsets: np.ndarray, words: int = 3) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The texts with A-Z lowered and white space as one space; slices of their
    word shingles (a text of fewer words is one shingle); shingles per text."""
    low = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    space, n = is_space(low), len(low)
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    before = np.concatenate([[True], space[:-1]]) | first[:n]
    after = np.concatenate([space[1:], [True]]) | first[1:]
    starts, ends = np.flatnonzero(~space & before), np.flatnonzero(~space & after) + 1
    keep = ~space | ~before  # a space stays right after a word
    place = np.concatenate([[0], np.cumsum(keep)])
    packed = low[keep]
    packed[is_space(packed)] = 32
    starts, ends = place[starts], place[ends]
    text = np.searchsorted(place[offsets[1:]], starts, "right") if len(starts) else np.zeros(0, np.int64)
    count = np.bincount(text, minlength=len(offsets) - 1)
    shingles = np.where(count, np.maximum(count - words + 1, 1), 0)
    begin = np.concatenate([[0], np.cumsum(count)])[:-1]
    head = np.repeat(begin - np.concatenate([[0], np.cumsum(shingles)])[:-1], shingles) + np.arange(shingles.sum())
    tail = np.minimum(head + words - 1, np.repeat(begin + count - 1, shingles))
    return packed, starts[head], ends[tail] - starts[head], shingles


def fingerprints(data: np.ndarray, offsets: np.ndarray, words: int = 3, seed: int = 42) -> np.ndarray:
    """A bit is 1 if set in over half the shingle hashes of a text."""
    packed, starts, lengths, shingles = shingle_slices(data, offsets, words)
    h = xxh64(packed, starts, lengths, seed)
    out, some = np.zeros(len(shingles), U), np.flatnonzero(shingles)
    if not len(some):
        return out
    own = shingles[some]
    begin = np.concatenate([[0], np.cumsum(own)])[:-1]
    blocks = -(-own // 255)  # sums of 255 bits fit a byte
    ahead = np.concatenate([[0], np.cumsum(blocks)])[:-1]
    cut = np.repeat(begin, blocks) + 255 * (np.arange(blocks.sum()) - np.repeat(ahead, blocks))
    for j in range(8):
        sums = np.add.reduceat((h >> U(j)) & ONES, cut).view(np.uint8).reshape(-1, 8).astype(np.int64)
        ones = np.add.reduceat(sums, ahead)
        for b in range(8):
            out[some] |= (ones[:, b] * 2 > own).astype(U) << U(8 * b + j)
    return out


@F.arrow_udf(T.LongType())
def fingerprint(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The 64-bit fingerprint of a text, as a signed long."""
    for part in parts:
        out = np.zeros(len(part), U)
        for first, last, data, offsets in byte_chunks(filled(part)):
            out[first:last] = fingerprints(data, offsets)
        yield pa.array(out.view(np.int64))


def near(a: np.ndarray, b: np.ndarray, max_bits: int) -> np.ndarray:
    """Tally equal bytes, keep pairs with the guaranteed minimum, count bits."""
    x = a ^ b
    t = x | (x >> U(4))
    t |= t >> U(2)
    t |= t >> U(1)
    shared = 8 - np.bitwise_count(t & ONES)
    kept = shared >= 8 - max_bits
    kept[kept] = np.bitwise_count(x[kept]) <= max_bits
    return kept


def _joined(f: np.ndarray, max_bits: int, block: int = 512) -> np.ndarray:
    """Group of each of the fingerprints of one list: the index of its first member."""
    label = np.arange(len(f))
    while True:
        new = label.copy()
        for i in range(0, len(f), block):
            for j in range(0, len(f), 8 * block):
                own, other = label[i : i + block], label[j : j + 8 * block]
                if other.min() >= own.max():  # nothing here could lower a label
                    continue
                hit = near(f[i : i + block, None], f[None, j : j + 8 * block], max_bits)
                new[i : i + block] = np.minimum(new[i : i + block], np.where(hit, label[None, j : j + 8 * block], len(f)).min(1))
        new = new[new]
        if (new == label).all():
            return label
        label = new


def list_edges(f: np.ndarray, ids: np.ndarray, sizes: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (id, id of its group's first) of posting lists that lie one after another."""
    begin, left, right = np.concatenate([[0], np.cumsum(sizes)])[:-1], [], []
    for size in np.unique(sizes[sizes > 1]):
        at = begin[sizes == size]
        if size <= 16:
            own = f[at[:, None] + np.arange(size)]
            hit = near(own[:, :, None], own[:, None, :], max_bits)
            label = np.broadcast_to(np.arange(size), own.shape)
            while True:
                new = np.where(hit, label[:, None, :], size).min(2)
                if (new == label).all():
                    break
                label = new
            row, col = np.nonzero(label != np.arange(size))
            left.append(ids[at[row] + col])
            right.append(ids[at[row] + label[row, col]])
        else:
            for x in at:
                label = _joined(f[x : x + size], max_bits)
                moved = np.flatnonzero(label != np.arange(size))
                left.append(ids[x + moved])
                right.append(ids[x + label[moved]])
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def simhash_components(prints: DataFrame, max_bits: int = 3, id_col: str = "doc_id", print_col: str = "fp", most: int = LIST) -> DataFrame:
    """(print_col, component): for each distinct fingerprint, the smallest id
    reachable over links of at most ``max_bits`` bits. Lists of over ``most``
    fingerprints are split.

    Null fingerprints and ids take no part; repeated rows merge with the rest of
    their fingerprint; an empty input gives an empty result."""
    if not 0 <= max_bits <= 6:
        raise ValueError("max_bits: 0 to 6")
    groups = materialize(prints.where(F.col(print_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(print_col).alias("fp")).agg(F.min(id_col).cast("long").alias("rep")))
    take = max(1, 7 - max_bits)  # linked pairs share 8 - max_bits of 8 positions, so 7 - max_bits of any 7
    spots = list(combinations(range(7), take))

    def listed(batches):
        for batch in batches:
            f, rep = np.asarray(batch.column("fp")).view(U), np.asarray(batch.column("rep"))
            for k, spot in enumerate(spots):
                mask = U(sum(0xFF << (8 * p) for p in spot))
                yield pa.RecordBatch.from_pydict({"key": pa.array(mix((f & mask) + mix(np.array([k + 1], U))).view(np.int64)), "spot": pa.array(np.full(len(f), k)), "fp": pa.array(f.view(np.int64)), "rep": pa.array(rep)})

    def split(batches):
        is_open = np.array([[p not in spot for spot in spots] for p in range(8)])
        for batch in batches:
            key, spot, f, rep = (np.asarray(batch.column(c)) for c in ("key", "spot", "fp", "rep"))
            for p in range(8):
                on = np.flatnonzero(is_open[p][spot])
                byte = (f[on].view(U) >> U(8 * p)) & U(0xFF)
                yield pa.RecordBatch.from_pydict({"key": pa.array(mix(mix(key[on].view(U)) + mix(byte + U(256 * (p + 1)))).view(np.int64)), "fp": pa.array(f[on]), "rep": pa.array(rep[on])})

    def swept(batches):
        rest = None
        for batch in batches:
            columns = [np.asarray(batch.column(c)) for c in ("key", "fp", "rep")]
            if rest is not None:
                columns = [np.concatenate(x) for x in zip(rest, columns, strict=True)]
            key = columns[0]
            if not len(key):
                continue
            last = int(np.flatnonzero(key != key[-1])[-1]) + 1 if key[0] != key[-1] else 0
            rest = [x[last:] for x in columns]
            yield edges(*[x[:last] for x in columns])
        if rest is not None:
            yield edges(*rest)

    def edges(key, f, rep):
        cut = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        a, b = list_edges(f.view(U), rep, np.diff(np.append(cut, len(key))), max_bits)
        pairs = np.unique(np.stack([a, b], 1), axis=0)
        return pa.RecordBatch.from_pydict({"a": pa.array(pairs[:, 0].copy()), "b": pa.array(pairs[:, 1].copy())})

    # a fingerprint becomes a row for each combination: small tasks, so that none counts millions of keys
    parts = max(int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-groups.count() // 8192))
    lists = groups.repartition(parts).mapInArrow(listed, "key long, spot long, fp long, rep long")
    large = materialize(lists.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > most).select("key"))
    if large.limit(1).count():
        parts = lists.join(large, "key").mapInArrow(split, "key long, fp long, rep long")
        lists = lists.join(large, "key", "left_anti").select("key", "fp", "rep").unionByName(parts)
    lists = lists.select("key", "fp", "rep")
    found = lists.repartition("key").sortWithinPartitions("key").mapInArrow(swept, "a long, b long").distinct()
    labels = connected_components(found)
    out = groups.join(labels, groups.rep == labels.id, "left").select(F.col("fp").alias(print_col), F.coalesce("component", "rep").alias("component"))
    return materialize(out)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", max_bits: int = 3) -> DataFrame:
    """(id_col, fingerprint as 16 hex digits, component_id) for every row.

    A null or empty text has fingerprint zero, linked like any other; a row
    with a null id gets the component of its fingerprint but is never its
    representative; repeated rows are repeated in the result; other columns are
    left out."""
    prints = materialize(docs.select(F.col(id_col).alias("__id"), fingerprint(F.col(text)).alias("__fp")))
    parts = simhash_components(prints, max_bits, "__id", "__fp")
    return prints.join(parts, "__fp", "left").select(F.col("__id").alias(id_col), F.lpad(F.lower(F.hex("__fp")), 16, "0").alias("fingerprint"), F.col("component").alias("component_id"))


def _with_classes(marked: DataFrame, words: int) -> DataFrame:
    """(__id, __row, mark, __fp, class, n, bits): fingerprints and classes of equal shingle
    sets, by one Python worker a task."""
    from .shingles import CLASS, class_columns

    def found(batches):
        for batch in batches:
            prints = np.zeros(batch.num_rows, U)
            for first, last, data, offsets in byte_chunks(filled(batch.column("__text"))):
                prints[first:last] = fingerprints(data, offsets)
            yield pa.RecordBatch.from_pydict({"__id": batch.column("__id"), "__row": batch.column("__row"), "mark": batch.column("mark"), "__fp": pa.array(prints.view(np.int64))} | class_columns(batch.column("__text"), words))

    id_type = marked.schema["__id"].dataType.simpleString()
    rows = marked.select("__id", "__row", F.xxhash64("__text").alias("mark"), "__text")
    return rows.mapInArrow(found, f"__id {id_type}, __row long, mark long, __fp long, {CLASS}")


def first_of_groups(docs: DataFrame, id_col: str = "doc_id", text: str = "text", max_bits: int = 3, least: float | None = None, words: int = 5) -> DataFrame:
    """docs with one row of each near-duplicate group: the smallest id, of several
    rows of that id the one of the smallest hash. Rows with a null id stay, and
    an equal row of any number stays once.

    Texts link at so many bits of their fingerprints, and with ``least`` also at so
    much similarity of their word shingles, which fingerprints alone often miss."""
    mark, one, row, id_ = fresh(docs, "__mark"), fresh(docs, "__first"), fresh(docs, "__row"), F.col(f"`{id_col}`")
    body = F.col(f"`{text}`")
    known = docs.where(id_.isNotNull())
    marked = known.select(id_.alias("__id"), row_mark(docs).alias("__row"), body.alias("__text"))
    if least is None:
        prints = materialize(marked.select("__id", "__row", fingerprint("__text").alias("__fp")))
    else:
        prints = materialize(_with_classes(marked, words))
    # groups by their smallest fingerprint: rows of one id may be in several
    parts = simhash_components(prints.select("__fp", F.col("__fp").alias("__as_id")), max_bits, "__as_id", "__fp")
    if least is not None:
        from .shingles import shingle_links

        own = prints.where("n > 0").select(F.col("__fp").alias("node"), "mark", "class", "n", "bits")
        links = shingle_links(known.select(body.alias("text")), least, words, own=own)
        joined = connected_components(parts.select(F.col("__fp").alias("a"), F.col("component").alias("b")).unionByName(links))
        parts = materialize(parts.join(joined, F.col("__fp") == F.col("id"), "left").select("__fp", F.coalesce(joined["component"], parts["component"]).alias("component")))
    firsts = prints.join(parts, "__fp").groupBy("component").agg(F.min(F.struct("__id", "__row")).alias("first"))
    firsts = materialize(firsts.select(F.col("first.__id").alias(one), F.col("first.__row").alias(row)))
    rows = docs.withColumn(mark, row_mark(docs))
    kept = rows.join(firsts, (id_ == F.col(one)) & (F.col(mark) == F.col(row)), "left_semi").dropDuplicates([id_col, mark]).drop(mark)
    return kept.unionByName(docs.where(id_.isNull()))
