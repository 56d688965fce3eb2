"""Quality classifier from positive and unlabelled texts: the non-negative unbiased risk, minimised over all rows.

A text becomes a fixed number of features: a few shares (distinct words and lines, letters, capitals, digits, breaks, other signs, each
also as a root), sizes on a log scale, and the frequencies of shape trigrams, hashed into buckets. A shape is the kind of a character; a
run of letters, digits or spaces is one. No word is a feature, and neither are id, language, source or labels.

The score function is linear in the features, and the loss is the squared one, so every part of the risk is a quadratic form in second
moments: one pass sums the moments of the trusted positives and of the unlabelled texts, over all rows, into two matrices of fixed size.
With the class prior p the risk is p*E+[l(z)] + max(0, E[l(-z)] - p*E+[l(-z)]). It is the largest over t in [0, 1] of a convex quadratic
with t times the second part, so its least value is found exactly: by bisection on t, with one linear solve a step.

The prior is estimated without negatives: a first fit tells positives from unlabelled rows; the prior is the least ratio, over cuts of
its score, of the share of unlabelled rows above the cut to that of positives, with the usual bound for the shares' errors added. The
score is (z + 1) / 2, which the squared loss makes an estimate of the probability, cut to 0 to 1.

Null text counts as empty. A null id is never a trusted one. Repeated rows count and are returned as often as they occur. Without trusted
positives or unlabelled rows there is nothing to learn: every score is 0.5. An empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.scratch import stage
from shelfmark.llm.words import in_chunks

BUCKETS, DENSE = 256, 18
SIZE = DENSE + BUCKETS
_LOWER, _UPPER, _DIGIT, _BREAK, _SPACE, _OTHER = 1, 2, 3, 4, 5, 6
_PIECE, _ROWS_PER_BLOCK, _BINS, _WIDEST = 1 << 22, 32, 1024, 1.5


def _kinds() -> np.ndarray:
    """Kind of every byte; those of letters beyond ASCII count as lower-case letters."""
    out = np.zeros(256, np.uint8)
    for i in range(256):
        c = chr(i)
        out[i] = _LOWER if i >= 128 or "a" <= c <= "z" else _UPPER if "A" <= c <= "Z" else _DIGIT if c.isdigit() else _BREAK if c == "\n" else _SPACE if c in " \t\r\x0b\x0c" else _OTHER + i % 58
    return out


_KIND = _kinds()


def _shapes(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Counts of hashed shape trigrams and of byte kinds, of the whole text in pieces."""
    trigrams, kinds, tail = np.zeros(BUCKETS, np.int64), np.zeros(64, np.int64), np.zeros(0, np.uint8)
    for start in range(0, len(text), _PIECE):
        kind = _KIND[np.frombuffer(text, np.uint8, min(_PIECE, len(text) - start), start)]
        kinds += np.bincount(kind, minlength=64)
        before = np.concatenate([tail[-1:], kind[:-1]]) if len(tail) else np.concatenate([[0], kind[:-1]])
        shape = np.concatenate([tail, kind[(kind != before) | (kind >= _OTHER)]]).astype(np.uint64)
        code = shape[:-2] * np.uint64(4096) + shape[1:-1] * np.uint64(64) + shape[2:] if len(shape) > 2 else np.zeros(0, np.uint64)
        trigrams += np.bincount(((code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) % BUCKETS, minlength=BUCKETS)
        tail = shape[-2:].astype(np.uint8)
    return trigrams, kinds


def features(text: bytes) -> np.ndarray:
    """The features of one text; the first is 1."""
    trigrams, kinds = _shapes(text)
    words = text.split()
    lines = [x for x in text.split(b"\n") if not x.isspace() and x]
    share = lambda part, whole: part / whole if whole else 0.0
    size = max(len(text), 1)
    parts = [kinds[_LOWER] / size, kinds[_UPPER] / size, kinds[_DIGIT] / size, kinds[_BREAK] / size, kinds[_SPACE] / size, kinds[_OTHER:].sum() / size]
    dense = [1.0, np.log1p(len(words)) / 10, share(len(set(words)), len(words)), share(len(set(lines)), len(lines)),
             min(20.0, share(sum(map(len, words)), len(words))) / 20, np.log1p(share(len(words), len(lines))) / 6, *parts, *np.sqrt(parts)]
    return np.concatenate([dense, np.sqrt(trigrams / max(1, trigrams.sum()))])


def featurise(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``features`` (two bytes each) of every row."""
    own = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))

    def run(batches):
        for part, texts in in_chunks(batches):
            packed = [features(x).astype("<f2").tobytes() for x in texts]
            yield pa.RecordBatch.from_arrays([part.column("key"), pa.array(packed, pa.binary())], ["key", "features"])

    return own.mapInArrow(run, f"key {own.schema['key'].dataType.simpleString()}, features binary")


@dataclass(frozen=True)
class Model:
    """Weights of the features, and the estimated share of positives."""

    weights: np.ndarray
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.round(np.clip((x @ self.weights + 1) / 2, 0, 1), 6)


def _vectors(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<f2").reshape(-1, SIZE).astype(np.float64)


def _moments(examples: DataFrame) -> np.ndarray:
    """Sums of outer products of the features of trusted and of all rows; the driver gets these two matrices alone."""

    def sums(batches):
        total = np.zeros((2, SIZE, SIZE))
        for batch in batches:
            x, trusted = _vectors(batch.column("features")), batch.column("trusted").to_numpy(zero_copy_only=False).astype(bool)
            total += x[trusted].T @ x[trusted], x.T @ x
        rows = [(k, b, total[k, b : b + _ROWS_PER_BLOCK].tobytes()) for k in (0, 1) for b in range(0, SIZE, _ROWS_PER_BLOCK)]
        yield pa.RecordBatch.from_pylist([{"kind": k, "block": b, "part": x} for k, b, x in rows], pa.schema([("kind", pa.int32()), ("block", pa.int32()), ("part", pa.binary())]))

    def added(batches):
        held: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for r in batch.to_pylist():
                at = (r["kind"], r["block"])
                held[at] = held.get(at, 0) + np.frombuffer(r["part"])
        schema = pa.schema([("kind", pa.int32()), ("block", pa.int32()), ("part", pa.binary())])
        yield pa.RecordBatch.from_pylist([{"kind": k, "block": b, "part": x.tobytes()} for (k, b), x in held.items()], schema)

    out, types = np.zeros((2, SIZE, SIZE)), "kind int, block int, part binary"
    summed = examples.select("features", "trusted").mapInArrow(sums, types).repartition(2 * -(-SIZE // _ROWS_PER_BLOCK), "kind", "block").mapInArrow(added, types)
    for r in summed.collect():
        part = np.frombuffer(r["part"]).reshape(-1, SIZE)
        out[r["kind"], r["block"] : r["block"] + len(part)] = part
    return out


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray, doubt: float = 0.1) -> float:
    """Class prior from counts per score bin (rising) of trusted and of unlabelled rows: least ratio of the shares above a cut."""
    n_p, n_u = positive.sum(), unlabelled.sum()
    above_p, above_u = (np.cumsum(c[::-1])[::-1] / n for c, n in ((positive, n_p), (unlabelled, n_u)))
    error = np.sqrt(np.log(2 / doubt) / 2) * (1 / np.sqrt(n_p) + 1 / np.sqrt(n_u))
    seen = above_p > 0
    return float(np.clip(((above_u[seen] + error) / above_p[seen]).min(), 1e-3, 1 - 1e-3))


def minimise(positive: np.ndarray, unlabelled: np.ndarray, prior: float, ridge: float = 1e-4) -> np.ndarray:
    """Weights of least non-negative risk, from the mean outer products of both kinds (their first feature is 1)."""
    mean_p, mean_u, eye = positive[0], unlabelled[0], ridge * np.eye(len(positive))
    loss = lambda m, mean, w, sign: (1 - 2 * sign * mean @ w + w @ m @ w) / 4
    negative = lambda w: loss(unlabelled, mean_u, w, -1) - prior * loss(positive, mean_p, w, -1)
    at = lambda t: np.linalg.solve(prior * (1 - t) * positive + t * unlabelled + eye, prior * (1 + t) * mean_p - t * mean_u)
    if negative(at(1.0)) >= 0:
        return at(1.0)
    low, high = 0.0, 1.0  # the second part falls as its weight grows, and is below 0 at 1
    for _ in range(50):
        middle = (low + high) / 2
        low, high = (middle, high) if negative(at(middle)) > 0 else (low, middle)
    return at(high)


def fit(examples: DataFrame, ridge: float = 1e-4) -> Model:
    """A model from ``examples`` (features, trusted): trusted positives, and all rows as the unlabelled ones."""
    sums = _moments(examples)
    if not sums[0, 0, 0]:
        return Model(np.zeros(SIZE), 0.5)
    positive, unlabelled = sums[0] / sums[0, 0, 0], sums[1] / sums[1, 0, 0]
    apart = np.linalg.solve(positive + unlabelled + ridge * np.eye(SIZE), positive[0] - unlabelled[0])

    def bins(batches):
        for batch in batches:
            z = np.clip(_vectors(batch.column("features")) @ apart, -_WIDEST, _WIDEST)
            at = np.minimum(((z + _WIDEST) * (_BINS / (2 * _WIDEST))).astype(np.int64), _BINS - 1)
            trusted = batch.column("trusted").to_numpy(zero_copy_only=False).astype(bool)
            counts = [np.bincount(at[trusted], minlength=_BINS), np.bincount(at, minlength=_BINS)]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(_BINS)), *map(pa.array, counts)], ["bin", "positive", "unlabelled"])

    counts = np.zeros((2, _BINS))
    counted = examples.select("features", "trusted").mapInArrow(bins, "bin long, positive long, unlabelled long")
    for r in counted.groupBy("bin").agg(F.sum("positive").alias("positive"), F.sum("unlabelled").alias("unlabelled")).collect():
        counts[:, r["bin"]] = r["positive"], r["unlabelled"]
    prior = estimate_prior(*counts)
    return Model(minimise(positive, unlabelled, prior, ridge), prior)


def score(rows: DataFrame, model: Model) -> DataFrame:
    """``rows`` (key, held_out, features) with score and predicted instead of the features."""

    def run(batches):
        for batch in batches:
            s = model.score(_vectors(batch.column("features"))) if len(batch) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("held_out"), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], ["key", "held_out", "score", "predicted"])

    return rows.select("key", "held_out", "features").mapInArrow(run, f"key {rows.schema['key'].dataType.simpleString()}, held_out boolean, score double, predicted int")


def learn_and_score(docs: DataFrame, trusted: DataFrame, held_out: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, held_out, score and predicted of every document. ``trusted``: the ids of good documents, in a column ``key``.

    ``held_out`` is over ``key``; held-out documents are scored, but nothing is learned from them."""
    ids = trusted.select("key").filter("key IS NOT NULL").distinct().withColumn("trusted", F.lit(True))
    rows = featurise(docs, key, text).join(ids, "key", "left").withColumn("held_out", F.coalesce(held_out, F.lit(False)))
    rows = stage(rows.select("key", "held_out", "features", F.coalesce("trusted", F.lit(False)).alias("trusted")), "quality-features")
    return score(rows, fit(rows.filter("NOT held_out")))
