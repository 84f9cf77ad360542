"""Toxicity: character n-grams scaled by naive Bayes log-count ratios, a linear
classifier on top.

Features are the distinct hashed character n-grams of the whole lower-cased
text.  Each is scaled by the log ratio of its smoothed document frequencies in
the two classes, so an n-gram that training never saw, or that both classes
share (a log ratio under ``LEAST_RATIO``), says nothing; a logistic regression
then weighs the scaled features.

Fitting uses a bounded sample of labelled documents (``max_rows``, a
parameter; the sample is the rows of least id hash, so it is the same on every
run).  Scoring reads every text once, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierkit.llm.words import mix, ranges, utf8
from tierkit.operators._names import q

ORDERS = (3, 4, 5)
BITS = 20
MAX_ROWS = 8000
L2 = 0.1
LEAST_RATIO = 1.0
STEPS = 60
THRESHOLD = 0.7
#: Training rows worked on at a time, and rows of a record batch handed back.
FIT_ROWS, ROWS_OUT = 256, 512
_U = np.uint64
_STEP = _U(0xD1342543DE82EF95)


class Model(NamedTuple):
    """Weight per n-gram bucket (log-count ratio included) and bias."""

    weights: np.ndarray
    bias: float


def features(column: pa.Array, orders: tuple[int, ...] = ORDERS, bits: int = BITS) -> Iterator[np.ndarray]:
    """Distinct buckets of the n-grams of each whole text; a blank at either
    end marks the text's ends, so empty and null texts have no n-gram."""
    stamp = np.zeros(1 << bits, np.int64)
    for lo, hi in ranges(utf8(column)[1]):
        texts = [f" {(t or '').lower()} " for t in column.slice(lo, hi - lo).to_pylist()]
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        value = mix(points.astype(_U) + _U(1))
        hashes, acc = {}, value
        for n in range(2, max(orders) + 1):
            acc = acc[:-1] * _STEP + value[n - 1 :]
            if n in orders:
                hashes[n] = (mix(acc) >> _U(64 - bits)).astype(np.int64)
        at = 0
        for t in texts:
            end = at + len(t)
            found = np.concatenate([hashes[n][at : max(at, end - n + 1)] for n in orders])
            order = np.arange(len(found))
            stamp[found] = order
            yield found[stamp[found] == order]
            at = end


def _minimise(loss, x: np.ndarray, steps: int, memory: int = 8) -> np.ndarray:
    """L-BFGS with backtracking."""
    value, grad = loss(x)
    past: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(steps):
        d, alphas = -grad, []
        for s, y, r in reversed(past):
            a = r * (s @ d)
            alphas.append(a)
            d = d - a * y
        if past:
            s, y, r = past[-1]
            d = d / (r * (y @ y))
        for (s, y, r), a in zip(past, reversed(alphas)):
            d = d + (a - r * (y @ d)) * s
        slope, step = grad @ d, 1.0 if past else 1.0 / max(1.0, float(np.abs(grad).sum()))
        for _ in range(30):
            new_value, new_grad = loss(x + step * d)
            if new_value <= value + 1e-4 * step * slope:
                break
            step /= 2
        else:
            break
        s, y = step * d, new_grad - grad
        if s @ y > 1e-12:
            past = [*past[1 - memory :], (s, y, 1.0 / (s @ y))]
        done = abs(value - new_value) < 1e-7 * max(1.0, abs(value))
        x, value, grad = x + s, new_value, new_grad
        if done:
            break
    return x


def fit(rows: list[np.ndarray], labels: np.ndarray, bits: int = BITS, l2: float = L2, steps: int = STEPS) -> Model:
    """Weights from the buckets and 0/1 label of each training row."""
    size = 1 << bits
    y = labels.astype(np.float64)
    if not len(rows) or y.min() == y.max():
        share = (y.sum() + 0.5) / (len(y) + 1)
        return Model(np.zeros(size, np.float32), float(np.log(share / (1 - share))))
    toxic, clean = (sum(np.bincount(rows[i], minlength=size) for i in np.flatnonzero(y == is_toxic)) for is_toxic in (1, 0))
    ratio = np.log((toxic + 1) / (y.sum() + 2)) - np.log((clean + 1) / (len(y) - y.sum() + 2))
    ratio[(toxic + clean < 2) | (np.abs(ratio) < LEAST_RATIO)] = 0
    seen = np.flatnonzero(ratio)
    scale = ratio[seen]
    number = np.cumsum(ratio != 0, dtype=np.int32) - 1
    # Some rows at a time: (first row, row of each bucket there, buckets).
    parts = []
    for lo in range(0, len(rows), FIT_ROWS):
        used = [number[r[ratio[r] != 0]] for r in rows[lo : lo + FIT_ROWS]]
        parts.append((lo, np.repeat(np.arange(len(used), dtype=np.int32), [len(r) for r in used]), np.concatenate(used)))
    sign = 2 * y - 1

    def loss(w: np.ndarray) -> tuple[float, np.ndarray]:
        scaled = w[:-1] * scale
        z = np.full(len(y), w[-1])
        for lo, owner, index in parts:
            found = np.bincount(owner, scaled[index])
            z[lo : lo + len(found)] += found
        m = sign * z
        value = np.logaddexp(0, -m).sum() + 0.5 * l2 * (w[:-1] @ w[:-1])
        pull = -sign / (1 + np.exp(np.clip(m, -500, 500)))
        grad = sum(np.bincount(index, pull[lo + owner], minlength=len(seen)) for lo, owner, index in parts)
        grad = grad * scale + l2 * w[:-1]
        return float(value), np.append(grad, pull.sum())

    w = _minimise(loss, np.zeros(len(seen) + 1), steps)
    weights = np.zeros(size, np.float32)
    weights[seen] = w[:-1] * scale
    return Model(weights, float(w[-1]))


def _featuriser(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, ROWS_OUT):
            part = batch.slice(lo, ROWS_OUT)
            found = [f.astype("<i4").tobytes() for f in features(part.column(1))]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.binary())], names=["label", "features"])


def _fitter(l2: float, steps: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, labels = [], []
        for batch in batches:
            labels += batch.column(0).to_pylist()
            rows += [np.frombuffer(x.as_buffer(), "<i4") for x in batch.column(1)]
        model = fit(rows, np.array(labels), l2=l2, steps=steps)
        yield pa.RecordBatch.from_arrays(
            [pa.array([model.weights.astype("<f4").tobytes()], pa.binary()), pa.array([model.bias])], names=["weights", "bias"]
        )

    return run


def train(labelled: DataFrame, max_rows: int = MAX_ROWS, l2: float = L2, steps: int = STEPS) -> Model:
    """Without labelled rows of both classes the model is the classes' share
    (a half without any); otherwise fit on ``labelled`` (columns id, text, label 0/1), at most ``max_rows``
    rows.  One task fits the model from the rows' buckets, which bounds its
    memory by ``max_rows`` times the number of buckets whatever the texts."""
    order = F.xxhash64("id")
    picked = labelled.where("label in (0, 1)").orderBy(order, "id", "label", "text").limit(max_rows)
    found = picked.select(F.col("label").cast("int"), "text").mapInArrow(_featuriser, "label int, features binary")
    one = found.repartition(1).sortWithinPartitions("label", F.xxhash64("features"))
    row = one.mapInArrow(_fitter(l2, steps), "weights binary, bias double").first()
    if row is None:  # no labelled row at all
        return fit([], np.empty(0))
    return Model(np.frombuffer(bytes(row["weights"]), "<f4"), float(row["bias"]))


def _scorer(model: Model, place: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = model.weights.astype(np.float64)
        for batch in batches:
            text = batch.column(0).field(place).cast(pa.string())
            z = np.array([weights[f].sum() for f in features(text)]) + model.bias
            scores = 1 / (1 + np.exp(-np.clip(z, -700, 700)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["row", "score"])

    return run


def score(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """All rows and columns of ``docs`` with a score from 0 to 1.

    Null, empty and featureless texts get the bias alone.  Values of other
    columns play no part, whatever their names; a column named like the score
    is replaced.  Repeated rows and equal texts get equal scores.
    """
    columns = [c for c in docs.columns if c.lower() != score_col.lower()]
    rows = docs.select(F.struct(*[q(c) for c in columns]).alias("row"))
    kind = T.StructType([rows.schema["row"], T.StructField("score", T.DoubleType())])  # names need no quoting here
    scored = rows.mapInArrow(_scorer(model, columns.index(text_col)), kind)
    return scored.select(*[F.col("row").getField(c).alias(c) for c in columns], F.col("score").alias(score_col))


def held_out(doc_id: Column) -> Column:
    """The fold that training leaves out: CRC-32 of the id's text, modulo 3, is 1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def labelled_rows(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """Training rows (id, text, label) outside the held-out fold.

    The bounded sample is drawn from the labels first, so that it can be
    broadcast and the texts are scanned once without a shuffle.  A label
    without a document, and a document without a label, give no row."""
    open_labels = labels.select(F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("label"))
    open_labels = open_labels.where(~held_out(F.col("id")) & F.col("id").isNotNull() & F.col("label").isin(0, 1))
    picked = open_labels.orderBy(F.xxhash64("id"), "id", "label").limit(max_rows)
    texts = docs.select(F.col("doc_id").alias("id"), F.col("text").cast("string").alias("text"))
    return texts.join(F.broadcast(picked), "id")
