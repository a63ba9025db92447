"""Elements of large JSON documents, read by many tasks from one file.

A document of a hundred gigabytes is one value, which no task can hold. It is read
here as text that ends at every closing brace, so that Spark cuts the file into
byte ranges like any text; a range begins behind such a brace. What a range means
depends on where it begins: inside a string or not, and how deep. So it is scanned
twice. The first scan counts quotes and brackets under both assumptions, a row for each
range, and from these rows in order every range learns how it begins. The second
cuts the elements out. An element that runs over ranges leaves a piece in each, and
these pieces alone are shuffled and put together.

Scans are in numpy over all bytes of a batch: quotes that no odd run of backslashes
escapes switch strings on and off, and brackets outside of strings add up to depths."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..tables import exists, settle

_DEPTH = np.zeros(256, np.int8)
_DEPTH[[ord("{"), ord("[")]] = 1
_DEPTH[[ord("}"), ord("]")]] = -1
#: Bytes of a key; of longer ones the end is kept.
LONGEST_KEY = 1 << 20
KEY = re.compile(rb'"((?:[^"\\]|\\.)*)"\s*:\s*$', re.DOTALL)


def switches(data: np.ndarray) -> np.ndarray:
    """Where a string begins or ends: quotes that aren't escaped."""
    quote, back = data == 34, data == 92
    if not back.any():
        return quote
    # the length of the run of backslashes right before each byte
    at = np.arange(len(data))
    last = np.maximum.accumulate(np.where(back, -1, at))  # the last byte that is none
    run = np.concatenate([[0], (at - last)[:-1]])
    return quote & (run % 2 == 0)


def depths(data: np.ndarray, inside: bool) -> tuple[np.ndarray, np.ndarray]:
    """Whether each byte is inside a string (its closing quote is), and how the
    depth changes at it, if the first byte is inside a string or not."""
    toggles = switches(data)
    within = (np.cumsum(toggles) + int(inside)) % 2 == 1
    return within, np.where(within | toggles, 0, _DEPTH[data])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], bytes]]:
    """Pieces of each range in order, with the braces that ended them."""
    for batch in batches:
        file, start = batch.column("file").to_pylist(), batch.column("start").to_pylist()
        values = batch.column("value").to_pylist()
        at = 0
        while at < len(values):
            end = at
            while end < len(values) and (file[end], start[end]) == (file[at], start[at]):
                end += 1
            yield (file[at], start[at]), "".join(f"{v}}}" for v in values[at:end]).encode()
            at = end


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each range, or part of one: bytes, whether it switches, depths either way."""
    for (file, start), text in _runs(batches):
        data = np.frombuffer(text, np.uint8)
        flips = int(switches(data).sum()) % 2
        sums = [int(depths(data, inside)[1].sum()) for inside in (False, True)]
        yield pa.RecordBatch.from_pydict({"file": [file], "start": [start], "flips": [flips], "out": [sums[0]], "in": [sums[1]]})


def _begin(parts: pd.DataFrame) -> pd.DataFrame:
    """How each range of a file begins, from those before it, and whether the file
    ends outside of everything (a last brace is one too many where it ends in none)."""
    rows, inside, depth = [], False, 0
    ranges = parts.sort_values(["start", "part"])
    for start, own in ranges.groupby("start", sort=True):
        rows.append((start, inside, depth))
        for r in own.itertuples():
            depth += r.inside if inside else r.outside
            inside ^= bool(r.flips)
    whole = not inside and depth in (0, -1)
    return pd.DataFrame([(parts["file"].iloc[0], s, i, d, whole) for s, i, d in rows], columns=["file", "start", "inside", "depth", "whole"])


class _Range:
    """Cuts the elements out of one range: objects right inside the document's
    array, or (nested) inside the arrays that are its object's values."""

    def __init__(self, file: str, start: int, inside: bool, depth: int, nested: bool):
        self.file, self.start, self.inside, self.depth = file, start, inside, depth
        self.level = 2 if nested else 1
        self.open = depth > self.level  # an element began in an earlier range
        self.head = self.open
        self.text: list[bytes] = []
        self.seq = self.keys = self.items = 0
        self.key: str | None = None
        self.kind = "" if nested else "["  # of the container; unknown at first
        self.since = b""  # what stands outside of elements since the last bracket or comma
        self.began = inside and depth == 1  # in a key, or a string that is a value
        self.had = self.open  # whether there has been one
        self.cut: bytes | None = None  # the end of a key that an earlier range began
        self.opened = depth > 0 and not self.began  # whether the value is a container
        self.rows: list[tuple] = []

    def add(self, kind: str, text: str | None) -> None:
        self.rows.append((self.file, self.start, self.seq, kind, self.keys, self.key, self.kind, self.items, text))
        self.seq += 1

    def between(self, text: bytes, within: np.ndarray, change: np.ndarray, depth: np.ndarray) -> None:
        """Keys, containers and commas between elements."""
        events = np.flatnonzero(~within & ((change != 0) | ((np.frombuffer(text, np.uint8) == 44) & (depth <= self.level))))
        last = 0
        for at in events.tolist():
            mark, now = text[at : at + 1], int(depth[at])
            if change[at] > 0 and now == 2 and self.level == 2:  # a value of the document opens
                found = KEY.search(self.since + text[last:at])
                if self.began and not self.had:  # the key, then, began in an earlier range
                    found, self.cut = None, self.since + text[last:at]
                self.key, self.kind, self.keys, self.items, self.opened = _plain(found[1]) if found else None, mark.decode(), self.keys + 1, 0, True
            elif mark == b"," and now == self.level:
                self.items += 1
            elif mark == b"," and now == 1:
                self.keys += not self.opened  # a value that is no container
                self.opened = False
            self.since, self.had, last = b"", True, at + 1
        self.since = (self.since + text[last:])[-LONGEST_KEY:]

    def feed(self, text: bytes) -> None:
        data = np.frombuffer(text, np.uint8)
        within, change = depths(data, self.inside)
        depth = self.depth + np.cumsum(change)
        begins = np.flatnonzero((change > 0) & (depth == self.level + 1))
        ends = np.flatnonzero((change < 0) & (depth == self.level))
        at = 0
        if self.open:
            end = int(ends[0]) + 1 if len(ends) else len(text)
            self.text.append(text[:end])
            if len(ends):
                self.close()
                ends = ends[1:]
            at = end
        for i, b in enumerate(begins.tolist()):
            self.between(text[at:b], within[at:b], change[at:b], depth[at:b])
            self.had = True
            end = int(ends[i]) + 1 if i < len(ends) else len(text)
            self.text, self.open = [text[b:end]], True
            if i < len(ends):
                self.close()
            at = end
        if not self.open:
            self.between(text[at:], within[at:], change[at:], depth[at:])
        if len(data):
            self.inside, self.depth = bool(self.inside ^ (int(switches(data).sum()) % 2)), int(depth[-1])

    def close(self) -> None:
        self.add("head" if self.head else "whole", b"".join(self.text).decode("utf-8", "replace"))
        self.text, self.open, self.head, self.since = [], False, False, b""

    def finish(self) -> None:
        if self.open:
            self.add("middle" if self.head else "tail", b"".join(self.text).decode("utf-8", "replace"))
        if self.cut is not None:
            self.add("cut", self.cut.decode("utf-8", "replace"))
        self.add("end" if self.had else "on", self.since.decode("utf-8", "replace"))


def _plain(key: bytes) -> str:
    import json

    return json.loads(b'"' + key + b'"', strict=False)


COLUMNS = "file string, start long, seq long, kind string, keys long, key string, container string, items long, text string"


def _cut(nested: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: _Range | None = None

        def rows(r: _Range) -> pa.RecordBatch:
            columns = list(zip(*r.rows, strict=True))
            r.rows = []
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
            names = [c.split()[0] for c in COLUMNS.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns or [()] * len(kinds), kinds, strict=True)], names=names)

        for batch in batches:
            begin = {(f, s): (i, d) for f, s, i, d in zip(*(batch.column(c).to_pylist() for c in ("file", "start", "inside", "depth")), strict=True)}
            for (file, start), text in _runs(iter([batch])):
                if own is None or (own.file, own.start) != (file, start):
                    if own is not None:
                        own.finish()
                        yield rows(own)
                    own = _Range(file, start, *begin[file, start], nested)
                own.feed(text)
                yield rows(own)
        if own is not None:
            own.finish()
            yield rows(own)

    return cut


def _ranges(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """The pieces of text of each range of bytes, and how each range begins."""
    raw = spark.read.option("lineSep", "}").text(path)
    pieces = raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")
    measured = pieces.mapInArrow(_measured, "file string, start long, flips long, out long, `in` long")
    measured = measured.select("file", "start", "flips", F.col("out").alias("outside"), F.col("in").alias("inside"), F.monotonically_increasing_id().alias("part"))
    # a row for each range (or batch of one): a file's rows are some thousandth of a percent of it
    return pieces, settle(measured.groupBy("file").applyInPandas(_begin, "file string, start long, inside boolean, depth long, whole boolean"))


def is_document(spark: SparkSession, path: str) -> bool:
    """Whether there is a file and all its brackets and strings close."""
    return exists(spark, path) and bool(_ranges(spark, path)[1].agg(F.bool_and("whole")).first()[0])


def json_elements(spark: SparkSession, path: str | list[str], nested: bool = True, strict: bool = False) -> DataFrame:
    """(file, key, key_pos, pos, value): the objects in a document's arrays, as
    JSON. ``nested``: the document is an object whose values are arrays, of which
    ``key`` and ``key_pos`` tell; else it is an array itself and both are null.
    ``pos`` counts whatever stands in an array. Values of a document that are no
    arrays, and what isn't an object in one, are left out; a file whose brackets or
    strings don't close has no elements (``strict``: fails)."""
    pieces, begin = _ranges(spark, path)
    if strict:
        begin = begin.withColumn("whole", F.when(F.col("whole"), True).otherwise(F.raise_error(F.concat(F.lit("no JSON document: "), "file")).cast("boolean")))
    known = pieces.join(F.broadcast(begin.where("whole")), ["file", "start"])  # keeps the order of pieces in a range
    found = settle(known.select("file", "start", "value", "inside", "depth").mapInArrow(_cut(nested), COLUMNS))
    return _placed(found, nested)


def _placed(found: DataFrame, nested: bool) -> DataFrame:
    order = Window.partitionBy("file").orderBy("start")
    ends = found.where("kind in ('end', 'on')").withColumn("stretch", F.sum((F.col("kind") == "end").cast("long")).over(order))
    # a key that is cut by ranges: what was left open before, and its end
    left = ends.groupBy("file", (F.col("stretch") + 1).alias("stretch")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "text"))), lambda x: x["text"]), "").alias("left"))
    cuts = found.where("kind = 'cut'").select("file", "start", F.col("text").alias("cut"))
    whole_key = F.regexp_extract(F.concat("left", "cut"), r'(?s)"((?:[^"\\]|\\.)*)"\s*:\s*$', 1)
    ends = ends.join(cuts, ["file", "start"], "left").join(left, ["file", "stretch"], "left")
    ends = ends.withColumn("cut_key", F.when(F.col("cut").isNotNull(), F.from_json(F.concat(F.lit('{"k":"'), whole_key, F.lit('"}')), "k string")["k"]))
    ends = ends.withColumn("key", F.coalesce("key", F.when(F.col("container") != "", F.col("cut_key"))))
    # what the ranges before say, a row for each range: keys so far, the last key with its container, and its items
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.withColumn("base", F.coalesce(F.sum("keys").over(before), F.lit(0)))
    last = F.last(F.when(F.col("container") != "", F.struct("key", "container", (F.col("base") + F.col("keys")).alias("number"))), True).over(before)
    # items of the open array: those of the range that opened it and of all since
    whole = F.coalesce(F.sum("items").over(before), F.lit(0))
    opened = F.last(F.when(F.col("container") != "", F.col("sum_before")), True).over(before)
    ends = ends.withColumn("sum_before", whole)
    carried = ends.select("file", "start", "base", "cut_key", last.alias("last"), (whole - (F.coalesce(opened, F.lit(0)) if nested else F.lit(0))).alias("items_before"))
    parts = found.where("kind in ('whole', 'head', 'middle', 'tail')").join(F.broadcast(carried), ["file", "start"])
    own = (F.col("container") != "") if nested else F.lit(False)
    key, kind = F.when(own, F.coalesce("key", "cut_key")).otherwise(F.col("last.key")), F.when(own, F.col("container")).otherwise(F.coalesce("last.container", "container"))
    number = F.when(own, F.col("base") + F.col("keys")).otherwise(F.col("last.number")) - 1 if nested else F.lit(None).cast("long")
    items = F.col("items") + F.when(own, 0).otherwise(F.col("items_before"))
    placed = parts.select("file", "start", "seq", "kind", key.alias("key"), number.alias("key_pos"), items.alias("pos"), kind.alias("container"), F.col("text").alias("value"))
    result = ["file", "key", "key_pos", "pos", "value"]
    complete = placed.where("kind = 'whole' and container = '['").select(*result)
    # pieces of an element that runs over ranges belong to the last one that began before
    pieces = placed.where("kind <> 'whole'")
    began = F.last(F.when(F.col("kind") == "tail", F.col("start")), True).over(Window.partitionBy("file").orderBy("start", "seq"))
    joined = pieces.withColumn("began", began).groupBy("file", "began").agg(F.min(F.struct("start", "seq", "key", "key_pos", "pos", "container")).alias("f"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "seq", "value"))), lambda x: x["value"]), "").alias("value"))
    joined = joined.where("f.container = '['").select("file", "f.key", "f.key_pos", "f.pos", "value")
    return complete.unionByName(joined).where(F.col("value").startswith("{"))
