"""Quality classifier by supervised subword embeddings.

Every word and every character n-gram inside a word is hashed to a learned
vector; a document is the average of its vectors, and a softmax layer gives the
label. Vectors and layer are trained together by stochastic gradient descent in
numpy, in one task, on a bounded sample of labelled rows (``max_train``, taken
by hash of the id). As the layer is linear, a bucket's vector enters a score
only by its product with the layer, so scoring looks up one number per n-gram.

Defined results: a null or empty text scores the bias alone; null labels don't
train; repeated rows are scored each on its own; with no labelled row at all
every score is the prior 0.5. Whole texts are used everywhere.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Rolling, code_point_chunks, encoded, filled, first_by_hash, is_space, mix

BITS = 16
GRAMS = (2, 3, 4)
#: So many learned vectors stand for "the same word again".
REPEAT = 4
#: Averages are shrunk as if so many n-grams of no weight were there: a short
#: text stays near the prior.
SHRINK = 12


def features(units: np.ndarray, offsets: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words and in-word n-grams of a chunk of texts, and where
    each text's begin (n + 1 offsets into the buckets)."""
    space = is_space(units)
    inner = np.concatenate([[0], np.cumsum(space)])
    owner_end = np.repeat(offsets[1:], np.diff(offsets))
    rolling = Rolling(units)
    n = len(units)
    found, owners = [], []
    text_of = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    for k in GRAMS:
        if n < k:
            continue
        at = np.arange(n - k + 1)
        at = at[(at + k <= owner_end[at]) & (inner[at + k] == inner[at])]
        found.append(mix(rolling.raw(at, at + k) + np.uint64(k)))
        owners.append(text_of[at])
    first = np.zeros(n, bool)
    first[offsets[:-1][offsets[:-1] < n]] = True
    starts = np.flatnonzero(~space & (first | np.concatenate([[True], space[:-1]]))) if n else np.zeros(0, np.int64)
    if len(starts):
        stops = np.flatnonzero(space)
        after = np.searchsorted(stops, starts)
        ends = np.minimum(np.where(after < len(stops), stops[np.minimum(after, len(stops) - 1)] if len(stops) else n, n), owner_end[starts])
        words = mix(rolling.raw(starts, ends) + np.uint64(99))
        found.append(words)
        owners.append(text_of[starts])
        # a word that repeats the one before it: one n-gram, whichever the word
        again = starts[1:][(words[1:] == words[:-1]) & (text_of[starts[1:]] == text_of[starts[:-1]])]
        for part in range(REPEAT):
            found.append(mix(np.full(len(again), 1 + part, np.uint64)))
            owners.append(text_of[again])
    if not found:
        return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    buckets = (np.concatenate(found) >> np.uint64(64 - bits)).astype(np.int64)[order]
    return buckets, np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(offsets) - 1))])


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], bits: int = BITS, width: int = 8, epochs: int = 6, rate: float = 0.5, seed: int = 7) -> tuple[np.ndarray, float]:
    """SGD over (buckets, weights summing to less than 1, label 0 or 1) in numpy; returns
    the number of each bucket that enters the logit, and the bias."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / width, 1 / width, (1 << bits, width)).astype(np.float32)
    layer = rng.normal(0, 0.1, (width, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    for epoch in range(epochs):
        for i in rng.permutation(len(rows)):
            buckets, weights, label = rows[i]
            step = rate * (1 - epoch / epochs)
            hidden = weights @ vectors[buckets] * 8 if len(buckets) else np.zeros(width, np.float32)
            logits = hidden @ layer + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[label] -= 1
            back = layer @ p * 8
            layer -= step * 0.2 * np.outer(hidden, p)
            bias -= step * 0.2 * p
            if len(buckets):
                # weights are small: scaled up so that a document moves its own vectors
                vectors[buckets] -= step * np.outer(weights * min(len(buckets), 300), back).clip(-0.5, 0.5)
    gap = layer[:, 1] - layer[:, 0]
    return (vectors @ gap * 8).astype(np.float32), float(bias[1] - bias[0])


def _fit(batches):
    rows = []
    for batch in batches:
        texts, labels = encoded(batch), batch.column("label").to_pylist()
        for first, last, units, offsets in code_point_chunks(texts):
            buckets, ends = features(units, offsets)
            for i in range(first, last):
                own, counts = np.unique(buckets[ends[i - first] : ends[i - first + 1]], return_counts=True)
                rows.append((own.astype(np.int32), (counts / (SHRINK + counts.sum())).astype(np.float32), int(labels[i])))
    if not rows:
        return
    table, bias = train(rows)
    out = io.BytesIO()
    np.savez(out, table=table, bias=bias)
    yield pa.RecordBatch.from_pydict({"model": pa.array([out.getvalue()], pa.binary())})


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "label", max_train: int = 4000) -> bytes | None:
    """Train on at most ``max_train`` labelled rows, the first by a hash of the
    id; the model has a fixed size. labels: (id_col, label of 0 or 1)."""
    chosen = labels.where(F.col(label).isin(0, 1)).select(F.col(id_col).alias("__id"), F.col(label).cast("int").alias("label"))
    chosen = first_by_hash(chosen.withColumn("mark", F.xxhash64(F.lit("quality"), "__id")), max_train, "__id", "label")
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text).alias("text")).join(F.broadcast(chosen), "__id")  # so few rows may be broadcast
    sample = rows.orderBy("mark", "__id", "text").limit(max_train).select("text", "label")
    found = sample.coalesce(1).mapInArrow(_fit, "model binary").collect()
    return bytes(found[0].model) if found else None


def score_quality(docs: DataFrame, model: bytes | None, text: str = "text", score: str = "score") -> DataFrame:
    """docs with a column ``score``: the probability of label 1. It replaces a
    column of that name; name another to keep both."""
    blob = model

    @F.arrow_udf("double")
    def scored(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        held = np.load(io.BytesIO(blob)) if blob is not None else {"table": np.zeros(1 << BITS, np.float32), "bias": 0.0}
        table, bias = held["table"], float(held["bias"])
        for part in parts:
            out = np.zeros(len(part))
            for first, last, units, offsets in code_point_chunks(filled(part)):
                buckets, ends = features(units, offsets)
                sums = np.concatenate([[0.0], np.cumsum(table[buckets], dtype=np.float64)])
                out[first:last] = (sums[ends[1:]] - sums[ends[:-1]]) / (np.diff(ends) + SHRINK)
            yield pa.array(1 / (1 + np.exp(-(out + bias))))

    return docs.withColumn(score, scored(F.col(text)))
