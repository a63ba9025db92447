"""Language identification by error-correcting output codes.

Each language gets a binary codeword; for each bit a logistic classifier over
hashed character n-grams (1 to 4) predicts it. Decoding is loss-weighted: the
language whose codeword has the least sum of logistic losses, each bit weighted
by how well its classifier did in training. With up to 7 languages the code is
exhaustive (2**(k-1) - 1 bits); with more, 4 * ceil(log2 k) + 8 random columns.

Training sees at most ``max_train`` documents (by hash), each as a whole and in
fragments, so that short texts are served too. Defined results: a null text or
one without a letter is ``und`` with score 0; repeated rows are predicted each
on its own; with no training row every text is ``und``; with one language that
language is always predicted. ``ambiguous`` says that the two nearest codewords
are closer than ``margin``.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import code_point_chunks, encoded, filled, first_by_hash, fresh, mix, Rolling

BITS = 15
GRAMS = (1, 2, 3, 4)


def codewords(k: int, seed: int = 11) -> np.ndarray:
    """k rows of +1 and -1; no column is constant or the opposite of another."""
    if k <= 1:
        return np.ones((k, 1), np.int8)
    if k <= 7:
        columns = np.arange(1, 1 << (k - 1))
        bits = (columns[None, :] >> np.arange(k - 1)[:, None]) & 1
        return np.vstack([np.zeros(len(columns), np.int64), bits]).astype(np.int8) * -2 + 1
    rng, want = np.random.default_rng(seed), 4 * int(np.ceil(np.log2(k))) + 8
    seen, columns = set(), []
    while len(columns) < want:
        column = rng.permutation(np.arange(k) % 2)
        key = tuple(column ^ column[0])
        if key not in seen:
            seen.add(key)
            columns.append(column * 2 - 1)
    return np.array(columns, np.int8).T


def folded(texts: pa.Array) -> pa.Array:
    return pc.utf8_lower(texts)


def gram_buckets(units: np.ndarray) -> list[np.ndarray]:
    """For each n: the bucket of the n-gram that starts at each place."""
    rolling, n = Rolling(units), len(units)
    out = []
    for k in GRAMS:
        at = np.arange(max(0, n - k + 1))
        out.append((mix(rolling.raw(at, at + k) + np.uint64(k)) >> np.uint64(64 - BITS)).astype(np.int64))
    return out


def gram_counts(buckets: list[np.ndarray], start: int, end: int) -> np.ndarray:
    """How often each bucket occurs among the n-grams inside [start, end)."""
    own = [b[start : max(start, end - k + 1)] for k, b in zip(GRAMS, buckets, strict=True)]
    return np.bincount(np.concatenate(own), minlength=1 << BITS)


def _sparse(units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    counts = gram_counts(gram_buckets(units), 0, len(units))
    own = np.flatnonzero(counts)
    return own, (counts[own] / counts.sum()).astype(np.float32)


def _fit(batches):
    rng, rows = np.random.default_rng(3), []
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for first, last, units, offsets in code_point_chunks(folded(encoded(batch))):
            for i in range(first, last):
                own = units[offsets[i - first] : offsets[i - first + 1]]
                if len(own):
                    rows.append((*_sparse(own), langs[i]))
                for size in (12, 40, 120):  # fragments stand for short texts
                    if len(own) > 2 * size:
                        at = int(rng.integers(0, len(own) - size))
                        rows.append((*_sparse(own[at : at + size]), langs[i]))
    names = sorted({r[2] for r in rows})
    if not names:
        return
    code = codewords(len(names))
    of = {x: i for i, x in enumerate(names)}
    table, seen = np.zeros((1 << BITS, code.shape[1]), np.float32), np.full((1 << BITS, 1), 1e-6, np.float32)
    bias = np.zeros(code.shape[1], np.float32)
    wrong, told = np.zeros(code.shape[1]), 0
    for epoch in range(2):
        for i in rng.permutation(len(rows)):
            own, weights, lang = rows[i]
            target = code[of[lang]]
            margin = weights @ table[own] + bias
            if epoch:
                wrong += margin * target <= 0
                told += 1
            back = -target / (1 + np.exp(np.clip(margin * target, -30, 30)))
            seen[own, 0] += weights**2
            table[own] -= 8 * (weights[:, None] / np.sqrt(seen[own])) * back
            bias -= 0.02 * back
    good = 1 - (wrong + 1) / (told + 2)
    weight = np.maximum(0.05, np.log(good / (1 - good)))
    out = io.BytesIO()
    np.savez(out, table=table, bias=bias, code=code, weight=weight / weight.sum(), names=np.array(names))
    yield pa.RecordBatch.from_pydict({"model": pa.array([out.getvalue()], pa.binary())})


def fit_language(docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang", max_train: int = 3000) -> bytes | None:
    """Train on at most ``max_train`` rows of non-null id and lang, the first by
    a hash of the id."""
    known = docs.where(F.col(lang).isNotNull() & F.col(id_col).isNotNull())
    chosen = first_by_hash(known.select(F.col(id_col).alias("__id"), F.xxhash64(F.lit("language"), id_col).alias("mark")), max_train, "__id")
    rows = known.select(F.col(id_col).alias("__id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    rows = rows.join(F.broadcast(chosen.distinct()), "__id")  # so few rows may be broadcast
    sample = rows.orderBy("mark", "__id", "text", "lang").limit(max_train).select("text", "lang")
    found = sample.coalesce(1).mapInArrow(_fit, "model binary").collect()
    return bytes(found[0].model) if found else None


def predict_language(docs: DataFrame, model: bytes | None, text: str = "text", margin: float = 0.05) -> DataFrame:
    """docs with lang_pred, score (0 to 1) and ambiguous, which replace columns of
    these names."""
    blob = model

    @F.arrow_udf("struct<lang_pred:string,score:double,ambiguous:boolean>")
    def predicted(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        held = dict(np.load(io.BytesIO(blob))) if blob is not None else None
        for part in parts:
            texts = filled(part)
            letter = np.asarray(pc.match_substring_regex(texts, r"\p{L}"))
            pred, score, close = np.zeros(len(part), np.int64), np.zeros(len(part)), np.zeros(len(part), bool)
            if held is None:
                letter[:] = False
            else:
                for first, last, units, offsets in code_point_chunks(folded(texts), 1 << 19):
                    buckets, bits = gram_buckets(units), np.zeros((last - first, len(held["bias"])))
                    for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
                        if b > a:
                            counts = gram_counts(buckets, a, b).astype(np.float32)
                            bits[i] = counts @ held["table"] / counts.sum()
                    bits += held["bias"]
                    loss = np.stack([(np.logaddexp(0, -bits * row) * held["weight"]).sum(1) for row in held["code"]], 1)
                    near = np.exp(-8 * (loss - loss.min(1, keepdims=True)))
                    near /= near.sum(1, keepdims=True)
                    pred[first:last], score[first:last] = near.argmax(1), near.max(1)
                    if near.shape[1] > 1:
                        two = np.sort(near, 1)[:, -2:]
                        close[first:last] = two[:, 1] - two[:, 0] < margin
            names = held["names"][pred] if held is not None else np.full(len(part), "und")
            yield pa.StructArray.from_arrays([pa.array(np.where(letter, names, "und").tolist(), pa.string()), pa.array(np.where(letter, score, 0.0)), pa.array(close & letter)], ["lang_pred", "score", "ambiguous"])

    name, made = fresh(docs, "__lang"), ("lang_pred", "score", "ambiguous")
    rows = docs.withColumn(name, predicted(F.col(f"`{text}`")))
    others = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in made]
    return rows.select(*others, *[F.col(name)[c].alias(c) for c in made])
