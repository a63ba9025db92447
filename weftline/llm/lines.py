"""Line dedup by a deletion-neighbourhood join.

A line goes if an earlier one (smaller document id, then smaller line number)
is equal to it or within one edit: a substituted, inserted or deleted character.
Two lines within one edit have an equal variant: both without the character at
the same place, or one whole and the other without a character. Variants are
hashed keys, and equal keys meet in one group.

Emitting every variant of every line would write the corpus once per character,
so variants go from coarse to fine, and only lines whose coarse variant meets
another line's go on: lines without one half, then without one of 32 blocks,
then without one character of that block. Each step is lossless, as an edit
touches one block. Groups are never paired up: a group yields its earliest
line, every later member is checked against that one by edit distance. (Lines
that lack the same place are all within one edit of each other, and a whole
line is within one edit of every line whose variant it is, so the earliest
member of the right kind is all that matters.)

Equal lines are those of equal BLAKE2b (128 bits); halves and blocks only choose
candidates; variants are told apart by 124 bits of residues, and what they find
is verified by edit distance.

Lines are compared without white space at their ends; lines of fewer than
``min_chars`` characters then are never removed and remove nothing.

Defined results: a null text stays null, an empty one empty; a row with a null
id keeps its lines and removes none; equal rows count as one document and are
treated alike; rows that share an id and differ in text are documents of their
own, in the order of their texts' SHA-256; a document may end up empty but stays;
a line is compared whole at any length; other columns pass through, but for one
named ``removed_lines``, which is replaced.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Residues, Rolling, code_point_chunks, encoded, filled, fresh, is_space, materialize, mix, packed_residues, text_mark

BLOCKS = 32
U = np.uint64


def _salted(h: np.ndarray, *numbers) -> np.ndarray:
    for x in numbers:
        h = mix(h + mix(np.atleast_1d(np.asarray(x)).astype(U) + U(1)))
    return h


def trimmed_lines(units: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, line number, start, end) of every line without white space at its ends."""
    n = len(units)
    breaks = np.flatnonzero(units == 10)
    starts = np.concatenate([offsets[:-1], breaks + 1])
    text = np.concatenate([np.arange(len(offsets) - 1), np.searchsorted(offsets, breaks, "right") - 1])
    order = np.lexsort((starts, text))
    starts, text = starts[order], text[order]
    following = np.append(starts[1:], n)
    ends = np.where(np.append(text[1:] == text[:-1], False), following - 1, offsets[text + 1])
    first_of = np.searchsorted(text, text, "left")
    solid = np.append(np.flatnonzero(~is_space(units)), n)
    lead = solid[np.searchsorted(solid, starts)]
    last = np.searchsorted(solid, ends) - 1
    tail = np.where(last >= 0, solid[np.maximum(last, 0)] + 1, 0)
    blank = lead >= ends
    return text, np.arange(len(text)) - first_of, np.where(blank, starts, lead), np.where(blank, starts, tail)


def _half_keys(r: Rolling, start: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
    out = []
    for less in (0, 1):
        length = end - start - less
        half = length // 2
        out += [_salted(r.raw(start, start + half), length * 4), _salted(r.raw(end - half, end), length * 4 + 1)]
    return out


def _digests(units: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of BLAKE2b of each slice."""
    data = memoryview(units.astype("<u4").tobytes())
    made = b"".join(hashlib.blake2b(data[4 * a : 4 * b], digest_size=16).digest() for a, b in zip(start.tolist(), end.tolist(), strict=True))
    both = np.frombuffer(made, np.int64).reshape(-1, 2)
    return both[:, 0].copy(), both[:, 1].copy()


def _rows(**columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({k: pa.array(np.asarray(v).astype(np.uint64).view(np.int64) if np.asarray(v).dtype == np.uint64 else np.asarray(v, np.int64)) for k, v in columns.items()})


def _line_rows(min_chars: int):
    def made(batches):
        for batch in batches:
            ids, marks = np.asarray(batch.column("id")), np.asarray(batch.column("mark"))
            for first, _, units, offsets in code_point_chunks(encoded(batch)):
                text, line, start, end = trimmed_lines(units, offsets)
                ok = end - start >= min_chars
                text, line, start, end = text[ok], line[ok], start[ok], end[ok]
                h1, h2 = _digests(units, start, end)
                halves = _half_keys(Rolling(units), start, end)
                yield _rows(id=ids[first + text], mark=marks[first + text], line=line, h1=h1, h2=h2, **{f"k{i}": k for i, k in enumerate(halves)})

    return made


def _picked(batches):
    """The named lines of each text."""
    for batch in batches:
        ids, marks, wanted = (batch.column(c).to_pylist() for c in ("id", "mark", "wanted"))
        out: dict[str, list] = {"id": [], "mark": [], "line": [], "text": []}
        for i, mark, text, lines in zip(ids, marks, encoded(batch).to_pylist(), wanted, strict=True):
            parts = text.split("\n")
            for x in sorted(set(lines)):
                out["id"].append(i)
                out["mark"].append(mark)
                out["line"].append(x)
                out["text"].append(parts[x].strip(" \t\n\x0b\x0c\r"))
        kinds = {"id": pa.int64(), "mark": pa.int64(), "line": pa.int64(), "text": pa.string()}
        yield pa.RecordBatch.from_pydict({k: pa.array(out[k], kind) for k, kind in kinds.items()})


def _bounds(length: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return j * length // BLOCKS, (j + 1) * length // BLOCKS


def _block_rows(batches):
    """Every line without one block, seen as the shorter or the longer of a pair."""
    for batch in batches:
        ids, marks, lines = (np.asarray(batch.column(c)) for c in ("id", "mark", "line"))
        for first, last, units, offsets in code_point_chunks(encoded(batch), 1 << 18):
            r, n = Rolling(units), np.diff(offsets)
            at = np.repeat(np.arange(last - first), 2 * BLOCKS)
            less = np.tile(np.repeat([0, 1], BLOCKS), last - first)
            j = np.tile(np.arange(BLOCKS), 2 * (last - first))
            length = n[at] - less
            a, b = _bounds(length, j)
            start, end = offsets[:-1][at], offsets[1:][at]
            key = _salted(r.raw(start, start + a) + mix(r.raw(end - (length - b), end) + U(3)), length, j)
            keep = (b > a) | (j == BLOCKS - 1)
            own = first + at[keep]
            yield _rows(key=key[keep], id=ids[own], mark=marks[own], line=lines[own], less=less[keep], block=j[keep])


def _variant_rows(batches):
    """Whole lines, and lines without one character of a named block. kind: 0
    without a character, by its place; 1 without a character; 2 whole."""
    for batch in batches:
        ids, marks, lines = (np.asarray(batch.column(c)) for c in ("id", "mark", "line"))
        spots = batch.column("spots").to_pylist()
        for first, last, units, offsets in code_point_chunks(encoded(batch), 1 << 18):
            r = Residues(units)
            for i in range(first, last):
                start, end = int(offsets[i - first]), int(offsets[i - first + 1])
                n, rows = end - start, []
                for less in (0, 1):
                    places = set()
                    for spot in spots[i]:
                        if spot["less"] == less:
                            a, b = _bounds(n - less, spot["block"])
                            places.update(range(a, min(b + less, n - 1) + less if less else b))
                    p = np.array(sorted(x for x in places if x < n), np.int64) + start
                    if len(p):
                        s, e = np.full(len(p), start), np.full(len(p), end)
                        k1, k2 = packed_residues(r.joined(s, p, p + 1, e))
                        rows.append((k1, k2, np.where(less, -1, p - s), np.full(len(p), less)))
                k1, k2 = packed_residues(r.raw(np.array([start]), np.array([end])))
                rows.append((k1, k2, np.array([-1]), np.array([2])))
                k1, k2, place, kind = (np.concatenate(x) for x in zip(*rows, strict=True))
                own = np.full(len(k1), i)
                yield _rows(k1=k1, k2=k2, place=place, kind=kind, id=ids[own], mark=marks[own], line=lines[own])


def within_one(a: str, b: str) -> bool:
    """Whether one edit at most turns a into b, in time linear in their length."""
    if abs(len(a) - len(b)) > 1:
        return False
    same, end = 0, min(len(a), len(b))
    while same < end:  # bisect the common prefix
        half = (same + end + 1) // 2
        if a[same:half] == b[same:half]:
            same = half
        else:
            end = half - 1
    return a[same + (len(a) >= len(b)) :] == b[same + (len(b) >= len(a)) :]


@F.arrow_udf(T.BooleanType())
def _verified(mine: pa.Array, theirs: pa.Array) -> pa.Array:
    return pa.array([within_one(a, b) for a, b in zip(mine.to_pylist(), theirs.to_pylist(), strict=True)], pa.bool_())


def removed_lines(docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_chars: int = 20, max_edits: int = 1) -> DataFrame:
    """(id, mark, line): the numbers, from 0, of the lines to remove; mark is
    text_mark(), which tells rows apart that share an id."""
    if max_edits not in (0, 1):
        raise ValueError("max_edits: 0 or 1")
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text")).where("id is not null and text is not null")
    source = source.withColumn("mark", text_mark(F.col("text")))
    lines = materialize(source.mapInArrow(_line_rows(min_chars), "id long, mark long, line long, h1 long, h2 long, k0 long, k1 long, k2 long, k3 long"))
    own, place = ["id", "mark", "line"], F.struct("id", "mark", "line")
    firsts = lines.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.max(place).alias("last"), *[F.min(k).alias(k) for k in ("k0", "k1", "k2", "k3")])
    firsts = materialize(firsts)
    twice = materialize(firsts.where("first <> last").select("h1", "h2", "first"))
    again = lines.select("h1", "h2", *own).join(twice, ["h1", "h2"]).where(place != F.col("first")).select(*own)
    again = materialize(again.distinct())
    if not max_edits:
        return again
    halves = firsts.select("first.id", "first.mark", "first.line", F.explode(F.array("k0", "k1", "k2", "k3")).alias("key"))
    shared = _shared(halves)
    chosen = materialize(halves.join(shared, "key", "left_semi").groupBy("id", "mark").agg(F.collect_set("line").alias("wanted")))
    kept = materialize(source.join(chosen, ["id", "mark"]).mapInArrow(_picked, "id long, mark long, line long, text string").dropDuplicates(own))
    blocks = materialize(kept.mapInArrow(_block_rows, "key long, id long, mark long, line long, less long, block long"))
    spots = blocks.join(_shared(blocks), "key", "left_semi").groupBy(*own).agg(F.collect_set(F.struct("less", "block")).alias("spots"))
    key = ["k1", "k2"]
    variants = materialize(kept.join(spots, own).mapInArrow(_variant_rows, "k1 long, k2 long, place long, kind long, id long, mark long, line long"))
    # substitutions meet at the same place, whole lines meet lines without a character
    subs = variants.where("kind = 0").groupBy(*key, "place").agg(F.min(place).alias("other"), F.max(place).alias("last")).where("other <> last").drop("last")
    swaps = variants.where("kind > 0").groupBy(*key).agg(*[F.min(F.when(F.col("kind") == k, place)).alias(f"first{k}") for k in (1, 2)]).where("first1 is not null and first2 is not null")
    met = variants.where("kind = 0").join(subs, [*key, "place"]).select(*own, "other")
    met = met.unionByName(variants.where("kind > 0").join(swaps, key).select(*own, F.expr("if(kind = 1, first2, first1)").alias("other")))
    met = met.where(F.col("other") < place).distinct()
    mine, other = kept.withColumnRenamed("text", "mine"), kept.select(place.alias("other"), F.col("text").alias("theirs"))
    near = met.join(mine, own).join(other, "other").where(_verified("mine", "theirs")).select(*own)
    return materialize(again.union(near).distinct())


def _shared(rows: DataFrame) -> DataFrame:
    """Keys that more than one line has."""
    place = F.struct("id", "mark", "line")
    return materialize(rows.groupBy("key").agg(F.min(place).alias("a"), F.max(place).alias("b")).where("a <> b").select("key"))


@F.arrow_udf(T.StringType())
def _without(texts: pa.Array, gone: pa.Array) -> pa.Array:
    out = []
    for text, lines in zip(texts.to_pylist(), gone.to_pylist(), strict=True):
        if lines:
            drop = set(lines)
            text = "\n".join(x for i, x in enumerate(text.split("\n")) if i not in drop)
        out.append(text)
    return pa.array(out, pa.string())


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_chars: int = 20, max_edits: int = 1) -> DataFrame:
    """docs with the removed lines gone from ``text``, and a column
    ``removed_lines`` (array of line numbers, empty where none went; it replaces
    one of that name)."""
    gone = removed_lines(docs, id_col, text, min_chars, max_edits).groupBy("id", "mark").agg(F.array_sort(F.collect_set("line")).alias("gone"))
    rows = docs.drop("removed_lines")
    name, mark, key = fresh(rows, "__lines"), fresh(rows, "__line_mark"), fresh(rows, "__line_id")
    gone = gone.select(F.col("id").alias(key), F.col("mark").alias(mark), F.col("gone").alias(name))
    joined = rows.join(gone, (F.col(f"`{id_col}`").cast("long") == F.col(key)) & (text_mark(F.col(f"`{text}`")) == F.col(mark)), "left").drop(key, mark)
    joined = joined.withColumn(text, _without(F.col(f"`{text}`"), F.col(name)))
    return joined.withColumn("removed_lines", F.coalesce(name, F.array().cast("array<long>"))).drop(name)
