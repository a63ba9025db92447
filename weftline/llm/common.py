"""Plumbing shared by the training-data operators: tables cut from lineage in
the shared checkpoint folder, and text columns seen as flat numpy arrays."""

from __future__ import annotations

import atexit
import gc
import tempfile
import time
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Odd multiplier of the polynomial hashes, and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
BASE_INV = pow(BASE, -1, 1 << 64)
#: Text is worked on in pieces of about so many code units, to bound memory.
CHUNK = 1 << 17


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a
    folder of our own where that is unset, in local sessions only: on a cluster
    executors would each write to their own disk."""
    found = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getCheckpointDir()
    if not found and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    return (found or f"file://{tempfile.gettempdir()}/weftline-checkpoints").rstrip("/")


_made: list[tuple[SparkSession, str]] = []
#: Seconds between two sweeps of finished shuffles, and when the last was.
PAUSE = 3.0
_released = [0.0]


def _remove(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def _remove_made() -> None:
    for spark, path in _made:
        try:
            _remove(spark, path)
        except Exception:  # the session may have ended before the interpreter
            return


atexit.register(_remove_made)


def materialize(df: DataFrame) -> DataFrame:
    """Write df to the shared folder and read it again: lineage ends there, a
    lost executor costs no recomputation, and shuffle files of finished steps
    can go."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/weftline-{uuid.uuid4().hex}"
    began = time.monotonic()
    df.write.option("compression", "zstd").parquet(path)
    _made.append((spark, path))
    out = spark.read.schema(df.schema).parquet(path)
    del df
    release(spark, now=time.monotonic() - began > 1)
    return out


def drop_table(df: DataFrame) -> None:
    """Remove a table that materialize() wrote and that no plan reads any more."""
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        for spark, own in list(_made):
            if path.rstrip("/").endswith(own.rsplit("/", 1)[-1]):
                _made.remove((spark, own))
                _remove(spark, own)


def release(spark: SparkSession, now: bool = False) -> None:
    """Let Spark delete the shuffle files of plans that nothing refers to any
    more; short steps that follow each other leave few behind and wait for the
    next (not so with ``now``)."""
    if not now and time.monotonic() - _released[0] < PAUSE:
        return
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    _released[0] = time.monotonic()


def first_by_hash(rows: DataFrame, n: int, *ties: str, mark: str = "mark") -> DataFrame:
    """The n rows of the smallest hash (a column of longs, read as unsigned; then
    by ``ties``), in order. So that tasks don't each send n rows to the one that
    sorts, rows of a large hash are passed over first where n rows have a small one."""
    small = F.shiftrightunsigned(F.col(mark), 1)
    total = rows.count()
    if total > 8 * n:
        few = rows.where(small < int((1 << 63) * (4 * n + 100) / total))
        if few.limit(n).count() == n:  # not so where a few hashes have most rows
            rows = few
    return rows.orderBy(small, *ties).limit(n)


def filled(texts: pa.Array) -> pa.Array:
    """Texts with nulls as empty ones, in the layout that the chunks below read."""
    return pc.fill_null(texts.cast(pa.large_string()), "")


def encoded(batch: pa.RecordBatch, name: str = "text") -> pa.Array:
    return filled(batch.column(name))


def byte_chunks(texts: pa.Array, size: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of about ``size`` bytes: (first, last + 1, their
    UTF-8 bytes, the n + 1 offsets into those). A longer text is a run alone."""
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        yield at, end, data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


def code_point_chunks(texts: pa.Array, size: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """As byte_chunks, in code points."""
    lengths = np.asarray(pc.utf8_length(texts)).astype(np.int64)
    for first, last, data, _ in byte_chunks(texts, size):
        points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        yield first, last, points, np.concatenate([[0], np.cumsum(lengths[first:last])])


_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 16), base, np.uint64)
        steps[0] = 1
        have = _powers[base] = np.cumprod(steps, dtype=np.uint64)
        if n > 8 * CHUNK:  # an unusually long text: don't keep its table
            _powers.pop(base)
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class Rolling:
    """Hashes of any substrings of a chunk, each the same wherever it stands:
    the prefix sums of c[i] * BASE**i give a substring's hash after division
    by BASE**start."""

    def __init__(self, units: np.ndarray, salt: int = 1):
        n = len(units)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((units.astype(np.uint64) + np.uint64(salt)) * powers(BASE, n), out=self.sums[1:])
        self.inverse = powers(BASE_INV, n + 1)

    def raw(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.inverse[start]

    def windows(self, k: int) -> np.ndarray:
        """Hashes of all substrings of length k."""
        if len(self.sums) <= k:
            return np.zeros(0, np.uint64)
        return mix((self.sums[k:] - self.sums[:-k]) * self.inverse[: len(self.sums) - k])


#: Modulus of the residue hashes.
PRIME = (1 << 31) - 1
#: Four bases modulo PRIME; together the hashes have 124 bits.
BASES = (1103515245, 1812433253, 69069 * 29, 747796405)

_residues: dict[int, np.ndarray] = {}


def residue_powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo PRIME."""
    have = _residues.get(base)
    if have is None or len(have) < n:
        have = np.ones(1, np.uint64)
        while len(have) < max(n, 1 << 16):
            have = np.concatenate([have, have * np.uint64(pow(base, len(have), PRIME)) % np.uint64(PRIME)])
        if n <= 8 * CHUNK:
            _residues[base] = have
    return have[:n]


class Residues:
    """Polynomial hashes modulo a prime by four bases, for keys that decide what
    is compared: unlike Rolling's, which are modulo a power of two, they have no
    strings of a simple rule that collide. Each gives an array per base."""

    def __init__(self, units: np.ndarray):
        n, prime = len(units), np.uint64(PRIME)
        self.sums, self.inverse = [], [residue_powers(pow(b, -1, PRIME), n + 1) for b in BASES]
        for b in BASES:
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum((units.astype(np.uint64) + np.uint64(1)) * residue_powers(b, n) % prime, out=sums[1:])
            self.sums.append(sums % prime)

    def raw(self, start: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
        prime = np.uint64(PRIME)
        return [(s[end] + prime - s[start]) % prime * i[start] % prime for s, i in zip(self.sums, self.inverse, strict=True)]

    def joined(self, start: np.ndarray, cut: np.ndarray, go_on: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
        """Hashes of [start, cut) with [go_on, end) right behind it."""
        prime, shift = np.uint64(PRIME), cut - start
        step = [residue_powers(b, int(shift.max(initial=0)) + 1)[shift] for b in BASES]
        return [(a + b * s % prime) % prime for a, b, s in zip(self.raw(start, cut), self.raw(go_on, end), step, strict=True)]


def packed_residues(h: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Four residues as two longs."""
    return h[0] << np.uint64(32) | h[1], h[2] << np.uint64(32) | h[3]


def text_mark(text: Column) -> Column:
    """60 bits of a text's SHA-256: what tells rows apart that share an id."""
    return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long")


def row_mark(docs: DataFrame) -> Column:
    """What tells rows apart: a hash of all columns."""
    return F.xxhash64(*[F.col(f"`{f.name}`") for f in docs.schema if not isinstance(f.dataType, T.MapType | T.VariantType)])


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def per_text(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of values over [start, end) of each text."""
    sums = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0, dtype=np.float64)])
    return sums[ends] - sums[starts]


def is_space(units: np.ndarray) -> np.ndarray:
    """ASCII white space: U+0020 and U+0009 to U+000D."""
    return (units == 32) | ((units >= 9) & (units <= 13))


def bound(value: Column, use) -> Column:
    """use(value) with value computed once: inside, it is a lambda's argument.
    use gives an array."""
    return F.flatten(F.transform(F.array(F.struct(value.alias("x"))), lambda row: use(row["x"])))
