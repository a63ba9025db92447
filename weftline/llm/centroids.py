"""Centroid clustering with block-norm screening.

A vector of integers is cut into segments of 8 components; beside it lie the norms
of its segments, an eighth of its size. By Cauchy and Schwarz the squared distance of
a vector x to a centroid c is at least the sum over segments of (|x_s| - |c_s|)^2,
which needs the compressed vectors alone. A vector's distance to the centroid of
the smallest bound is computed exactly, centroids whose bound lies above it are
out, and only the others get an exact integer distance. Bounds are lowered by more
than their rounding, so no centroid that ties is lost.

Every round is one job: tasks hold the centroids (k times d integers), assign their
vectors and send k sums of components, which Spark adds up; the driver gets k rows.
The quantised vectors are written once, so a round costs no recomputation.

Defined results: vectors that are null, of another length, or hold a component that
is null, not finite or of a magnitude of 2^20 or more (2^12 before it is multiplied)
take no part; a null id can be assigned but starts no centroid; of rows that share
an id the smaller vector comes first in the choice of starts, and each row is a
vector of its own; with fewer vectors than k there are as many centroids; ties go
to the smaller number; an empty table gives an empty result."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

#: Components of a segment.
SEGMENT = 8
#: Magnitude that quantised components stay under, so that all sums are exact.
LARGEST = 1 << 20
#: Vectors that a task compares at a time.
ROWS = 4096


def quantised(rows: DataFrame, vec_col: str, dimensions: int, scale: int) -> DataFrame:
    """rows whose vector has exactly so many usable components, which become
    integers, q, with the norms of their segments, norms."""
    v = F.col(f"`{vec_col}`")
    small = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < LARGEST / scale)
    kept = rows.where(v.isNotNull() & (F.size(v) == dimensions)).where(F.forall(v, small))
    kept = kept.withColumn("q", F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("int")))
    segments = F.sequence(F.lit(1), F.lit(dimensions), F.lit(SEGMENT))
    square = lambda part: F.aggregate(part, F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    return kept.withColumn("norms", F.transform(segments, lambda at: F.sqrt(square(F.slice("q", at, F.lit(SEGMENT))))))


def segment_norms(x: np.ndarray) -> np.ndarray:
    """Norms of the segments of each row."""
    cuts = np.arange(0, x.shape[1], SEGMENT)
    return np.sqrt(np.add.reduceat(x.astype(np.float64) ** 2, cuts, axis=1))


def nearest(x: np.ndarray, norms: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Number of the nearest centroid and the squared distance of each row of
    integers, and how many exact distances that took."""
    own = segment_norms(centroids)
    lower = (norms**2).sum(1)[:, None] + (own**2).sum(1)[None, :] - 2 * norms @ own.T
    # more than the rounding of norms and products can be
    lower -= 1e-9 * ((norms**2).sum(1)[:, None] + (own**2).sum(1)[None, :]) + 1e-6
    first = lower.argmin(1)
    best = ((x - centroids[first]) ** 2).sum(1)
    row, number = np.nonzero((lower <= best[:, None]) & (np.arange(len(centroids)) != first[:, None]))
    where, taken = first.astype(np.int64), len(x) + len(row)
    for at in range(0, len(row), 1 << 15):
        r, c = row[at : at + (1 << 15)], number[at : at + (1 << 15)]
        d = ((x[r] - centroids[c]) ** 2).sum(1)
        order = np.lexsort((c, d, r))
        head = np.concatenate([[True], r[order][1:] != r[order][:-1]])
        r, c, d = r[order][head], c[order][head], d[order][head]
        better = (d < best[r]) | ((d == best[r]) & (c < where[r]))
        best[r[better]], where[r[better]] = d[better], c[better]
    return where, best, taken


def _blocks(batch: pa.RecordBatch, dimensions: int):
    """(first row, integers, norms) of so many rows at a time."""
    q, norms = batch.column("q"), batch.column("norms")
    for at in range(0, batch.num_rows, ROWS):
        n = min(ROWS, batch.num_rows - at)
        x = np.asarray(q.slice(at, n).flatten()).reshape(n, dimensions).astype(np.int64)
        yield at, x, np.asarray(norms.slice(at, n).flatten()).reshape(n, -1)


def new_centroids(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The componentwise floor of the mean of each centroid's vectors; a centroid
    without any stays."""
    k, dimensions = centroids.shape

    def summed(batches):
        sums, count = np.zeros((k, dimensions), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            for _, x, norms in _blocks(batch, dimensions):
                where, _, _ = nearest(x, norms, centroids)
                for c in np.unique(where):
                    own = x[where == c]
                    sums[c] += own.sum(0)
                    count[c] += len(own)
        has = np.flatnonzero(count)
        values = np.concatenate([count[has, None], sums[has]], axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(has, dimensions + 1)), pa.array(np.tile(np.arange(dimensions + 1), len(has))), pa.array(values.ravel())], names=["cluster", "at", "value"])

    parts = vectors.select("q", "norms").mapInArrow(summed, "cluster long, at long, value long")
    total = np.zeros((k, dimensions + 1), np.int64)
    for cluster, at, value in parts.groupBy("cluster", "at").agg(F.sum("value")).collect():  # k * (dimensions + 1) rows at most
        total[cluster, at] = value
    n, sums = total[:, :1], total[:, 1:]
    return np.where(n > 0, sums // np.maximum(n, 1), centroids)


def first_centroids(vectors: DataFrame, id_col: str, k: int, salt: str) -> np.ndarray:
    """The k vectors of the smallest SHA-256 of salt and id, in that order."""
    mark = F.sha2(F.concat(F.lit(salt), F.col(f"`{id_col}`").cast("string")), 256)
    rows = vectors.select(mark.alias("mark"), "q").where("mark is not null").orderBy("mark", "q").limit(k).collect()
    return np.array([r["q"] for r in rows], np.int64)


def cluster(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 40, rounds: int = 5, dimensions: int = 64, scale: int = 256, salt: str = "2:") -> tuple[DataFrame, np.ndarray]:
    """(id_col, cluster, distance) of every vector that takes part, and the
    centroids that it is assigned to, after so many rounds."""
    vectors = materialize(quantised(rows.select(id_col, vec_col), vec_col, dimensions, scale).select(F.col(f"`{id_col}`").alias("__id"), "q", "norms"))
    centroids = first_centroids(vectors, "__id", k, salt)
    kind = vectors.schema["__id"].dataType.simpleString()
    if not len(centroids):
        return vectors.select(F.col("__id").alias(id_col), F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")).where("false"), np.zeros((0, dimensions), np.int64)
    for _ in range(rounds):
        centroids = new_centroids(vectors, centroids)
    last = centroids

    def assigned(batches):
        for batch in batches:
            found = [nearest(x, norms, last)[:2] for _, x, norms in _blocks(batch, dimensions)]
            where, best = (np.concatenate([np.zeros(0, np.int64), *x]) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 2
            yield pa.RecordBatch.from_arrays([batch.column("__id"), pa.array(where.astype(np.int32)), pa.array(best)], names=["__id", "cluster", "distance"])

    out = vectors.mapInArrow(assigned, f"__id {kind}, cluster int, distance long")
    return out.withColumnRenamed("__id", id_col), centroids


def clusters_with_inertia(rows: DataFrame, **options) -> DataFrame:
    """cluster() with the distances summed over each cluster and over all, and a
    hash of the centroid."""
    found, centroids = cluster(rows, **options)
    if not len(centroids):
        return found.select("*", *[F.lit(0).cast("long").alias(c) for c in ("cluster_inertia", "inertia")], F.lit("").alias("centroid_sha256"))
    found = materialize(found)
    sums = {r["cluster"]: int(r["d"]) for r in found.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}  # k rows at most
    marks = [hashlib.sha256(",".join(str(int(x)) for x in c).encode()).hexdigest() for c in centroids]
    table = [(c, sums.get(c, 0), sum(sums.values()), mark) for c, mark in enumerate(marks)]
    small = rows.sparkSession.createDataFrame(table, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(small), "cluster").select(*found.columns, "cluster_inertia", "inertia", "centroid_sha256")
