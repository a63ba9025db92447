"""Packing along a space-filling curve.

Every document becomes a hashed word vector, projected to a few dimensions (a
word's hash gives its coordinates, a document is the mean of its words). The
Hilbert key of that point orders documents so that neighbours on the curve are
alike; documents are range-sorted by it and laid end to end, and sequences are
cut from that line, so that a sequence holds neighbours and no padding.

A range partition is packed by its own task. What is left at its end, less than
a full sequence, is cut into sequences of powers of two, which need no padding.
Ranges are by (key, id, hash of the text): equal documents share a key and are
still split among tasks.

Defined results: a null text is an empty one; an empty text is its end token; an
added token's string in a text is that token; a text longer than a sequence runs over several; rows that share an id are packed
each on its own; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Rolling, byte_chunks, encoded, filled, is_space, mix, per_text

DIMENSIONS = 4
KEY_BITS = 10
SCHEMA = "{id} {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
#: Fixed value: how byte-level BPE splits a text into pieces.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Runs of white space (the property's characters) that the pattern isn't asked to
#: step back over: its stack ends at some half a million.
LONG_SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{1000,}")


def hilbert_keys(points: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert indices of n points of d coordinates of so many bits: each
    coordinate is brought to the transposed index by undoing the exchanges and
    inversions of the curve's cells, level by level, then Gray-decoded."""
    x = points.astype(np.uint64).T.copy()
    d, one = len(x), np.uint64(1)
    for level in range(bits - 1, 0, -1):
        q = one << np.uint64(level)
        low = q - one
        for i in range(d):
            flip = (x[i] & q) != 0
            swap = np.where(flip, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] = np.where(flip, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
    for i in range(1, d):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        q = one << np.uint64(level)
        turn = np.where((x[d - 1] & q) != 0, turn ^ (q - one), turn)
    x ^= turn
    key = np.zeros_like(turn)
    for level in range(bits - 1, -1, -1):
        for i in range(d):
            key = (key << one) | ((x[i] >> np.uint64(level)) & one)
    return key


def word_points(data: np.ndarray, offsets: np.ndarray, dimensions: int = DIMENSIONS, bits: int = KEY_BITS) -> np.ndarray:
    """The mean of the hashed coordinates of each text's words, on a grid."""
    n, space = len(data), is_space(data)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(~space & (np.concatenate([[True], space[:-1]]) | edge[:n]))
    ends = np.flatnonzero(~space & (np.concatenate([space[1:], [True]]) | edge[1:])) + 1
    h = mix(Rolling(data).raw(starts, ends))
    where = np.searchsorted(starts, offsets)
    count = np.maximum(np.diff(where), 1)
    out = np.zeros((len(offsets) - 1, dimensions), np.uint64)
    for j in range(dimensions):
        x = mix(h + np.array([j + 1], np.uint64)).astype(np.float64) / 2.0**64 - 0.5
        mean = per_text(x, where[:-1], where[1:]) / count
        spread = 0.5 + mean / (np.abs(mean) + 0.05) / 2  # fine near 0, where the means lie
        out[:, j] = np.clip(spread * (1 << bits), 0, (1 << bits) - 1).astype(np.uint64)
    return out


@F.arrow_udf(T.LongType())
def curve_key(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The Hilbert key of a text's word vector."""
    for part in parts:
        out = np.zeros(len(part), np.int64)
        for first, last, data, offsets in byte_chunks(filled(part)):
            out[first:last] = hilbert_keys(word_points(data, offsets), KEY_BITS).astype(np.int64)
        yield pa.array(out)


@functools.lru_cache(maxsize=2)
def encoder(path: str | None = None):
    """The byte-level BPE of a `tokenizers` file, run by tiktoken, which gives
    the same ids (tested) in a quarter of the time: a function from text to ids.
    Strings of the file's added tokens get their own ids, as there."""
    import tiktoken

    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as file:
        model = json.load(file)
    # byte-level files write bytes as printable characters: those that print as themselves, the rest from U+0100 on
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
    added = model.get("added_tokens", [])
    if any(x[flag] for x in added for flag in ("single_word", "lstrip", "rstrip")):
        raise ValueError("added tokens that take in neighbouring space are not supported")
    special = {x["content"]: x["id"] for x in added}
    ranks = {bytes(byte_of[c] for c in piece): i for piece, i in model["model"]["vocab"].items() if piece not in special}
    own = tiktoken.Encoding("weftline", pat_str=PIECES, mergeable_ranks=ranks, special_tokens=special)
    encode, single, strings = functools.partial(own.encode, allowed_special="all", disallowed_special=()), own._core_bpe.encode_single_piece, tuple(special)

    def ids(content: str) -> list[int]:
        out, at = [], 0
        for run in LONG_SPACE.finditer(content):
            start, end = run.span()
            # the last character of a run goes with what follows, unless that is an added token or the end
            stop = end if end == len(content) or content.startswith(strings, end) else end - 1
            out += encode(content[at:start]) + single(content[start:stop].encode())
            at = stop
        return out + encode(content[at:]) if out else encode(content)

    return ids


class Line:
    """Documents end to end, cut into sequences; call rows() for what is done."""

    def __init__(self, size: int, prefix: int):
        self.size, self.sequence, self.used = size, prefix, 0
        self.open: list[tuple] = []  # pieces of the sequence that isn't full: id, start, ids, doc_tokens
        self.done: list[tuple] = []

    def _close(self, pieces: list[tuple]) -> None:
        offset = 0
        for key, start, ids, total in pieces:
            self.done.append((key, start, len(ids), zlib.crc32(ids.tobytes()), total, self.sequence, offset))
            offset += len(ids)
        self.sequence += 1

    def add(self, key, ids: np.ndarray) -> None:
        at = 0
        while at < len(ids):
            take = min(len(ids) - at, self.size - self.used)
            self.open.append((key, at, ids[at : at + take], len(ids)))
            at, self.used = at + take, self.used + take
            if self.used == self.size:
                self._close(self.open)
                self.open, self.used = [], 0

    def finish(self) -> None:
        """Cut what is left into powers of two."""
        rest = self.open
        for bit in reversed(range(self.used.bit_length())):
            room, pieces = self.used & (1 << bit), []
            while room:
                key, start, ids, total = rest[0]
                pieces.append((key, start, ids[:room], total))
                rest = [(key, start + room, ids[room:], total), *rest[1:]] if len(ids) > room else rest[1:]
                room -= min(room, len(ids))
            if pieces:
                self._close(pieces)
        self.open, self.used = [], 0

    def rows(self, kind: pa.DataType, names: list[str]) -> pa.RecordBatch:
        columns = list(zip(*self.done, strict=True)) or [()] * 7
        self.done = []
        return pa.RecordBatch.from_arrays([pa.array(columns[0], kind), *[pa.array(x, pa.int64()) for x in columns[1:]]], names=names)


def pack(docs: DataFrame, id_col: str = "doc_id", text: str = "text", size: int = 1024, end_id: int = 0, tokenizer: str | None = None) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    kind = docs.schema[id_col].dataType
    if isinstance(kind, T.IntegerType | T.ShortType | T.ByteType):
        kind = T.LongType()
    arrow = pa.int64() if isinstance(kind, T.LongType) else pa.string()
    schema = SCHEMA.format(id="`__id`", kind="long" if arrow == pa.int64() else "string")
    names = ["__id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def packed(batches):
        from pyspark import TaskContext

        own, line = encoder(tokenizer), Line(size, TaskContext.get().partitionId() << 36)
        for batch in batches:
            ids = batch.column("id").to_pylist()
            for key, content in zip(ids, encoded(batch).to_pylist(), strict=True):
                line.add(key, np.array([*own(content), end_id], "<u4"))
            yield line.rows(arrow, names)
        line.finish()
        yield line.rows(arrow, names)

    rows = docs.select(F.col(id_col).cast("long" if arrow == pa.int64() else "string").alias("id"), F.col(text).alias("text"))
    rows = rows.withColumn("key", curve_key(F.col("text"))).withColumn("mark", F.xxhash64("text"))
    order = ["key", "id", "mark"]
    # ranges have equally many documents, and long ones lie close together on
    # the curve: several ranges to a usual partition even that out
    parts = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    line = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("id", "text")
    return line.mapInArrow(packed, schema).withColumnRenamed("__id", id_col)
