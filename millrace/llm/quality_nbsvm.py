"""Quality classifier: Naive Bayes support vectors over n-gram indicators.

The indicators of byte n-grams (1 to 3 bytes, hashed) and of words are scaled by the log ratio of their rates in the
two classes, and a linear hinge-loss model is fitted on them by dual coordinate descent. Margins become scores through
a logistic curve fitted on the same rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from millrace.llm.common import chosen_ids, chosen_texts, fitted, raw_texts, small_batches

BITS = 18
PARTS = (0.05, 0.2, 0.4)  # shares of word pairs that repeat one word; the numbers of these marks are their places


@dataclass(frozen=True)
class Model:
    """``weight`` holds ratio times coefficient per indicator; ``slope`` and ``shift`` turn a margin into a score."""

    weight: np.ndarray
    bias: float
    slope: float
    shift: float


def indicators(text: bytes | None) -> np.ndarray:
    """Sorted distinct indicator numbers of one whole text. Null and empty texts have none."""
    if not text:
        return np.empty(0, np.int32)
    words = text.split()
    runs = sum(map(eq, words, words[1:]))  # pairs of one word twice: one abstract word 2-gram, marked by how common it is
    marks = [] if not words else [k for k, part in enumerate(PARTS) if runs >= part * len(words) and runs]
    b = np.frombuffer(text, np.uint8).astype(np.uint32)
    two = b[:-1] << np.uint32(8) | b[1:]
    three = (two[:-1] << np.uint32(8) | b[2:]) * np.uint32(2654435761) + np.uint32(0x9E3779B9)
    two = two * np.uint32(2246822519) + np.uint32(0x85EBCA6B)
    one = b * np.uint32(3266489917) + np.uint32(0xC2B2AE35)
    shift = np.uint32(32 - BITS)
    if len(b) < 1 << (BITS - 2):
        return np.unique(np.concatenate([one >> shift, two >> shift, three >> shift, np.array(marks, np.uint32)])).astype(np.int32)
    seen = np.zeros(1 << BITS, bool)  # a long text: marking beats sorting
    for codes in (one, two, three):
        seen[codes >> shift] = True
    seen[marks] = True
    return np.flatnonzero(seen).astype(np.int32)


def fit(texts: list[bytes | None], labels: list[int], cost: float = 0.1, passes: int = 12, smooth: float = 1.0,
        seed: int = 7, rate: float | None = None) -> Model:
    """Fit on rows in memory. ``rate``: the share of class 1 among all rows, where the sample has another. With one class only, or no rows, every margin is 0 and the score is the class rate."""
    size = 1 << BITS
    y = np.where(np.asarray(labels) > 0, 1.0, -1.0)
    rows = [indicators(t) for t in texts]
    if not len(y) or abs(y.sum()) == len(y):
        rate = 0.5 if not len(y) else float((y > 0).mean())
        return Model(np.zeros(size, np.float32), 0.0, 0.0, float(np.log((rate + 0.01) / (1.01 - rate))))
    counts = {1.0: np.full(size, smooth), -1.0: np.full(size, smooth)}
    for r, label in zip(rows, y):
        counts[label][r] += 1
    ratio = np.log(counts[1.0] / ((y > 0).sum() + 2 * smooth)) - np.log(counts[-1.0] / ((y < 0).sum() + 2 * smooth))
    # rows get unit length, so that long texts don't set the scale
    values = [ratio[r] / max(np.sqrt((ratio[r] ** 2).sum()), 1e-9) for r in rows]
    w, bias, alpha = np.zeros(size), 0.0, np.zeros(len(y))
    limit = np.where(y > 0, cost * 10 * (y < 0).mean() * 2, cost * 10 * (y > 0).mean() * 2)  # classes weigh the same
    square = np.array([(v * v).sum() + 1.0 for v in values])
    rng = np.random.default_rng(seed)
    for _ in range(passes):
        for i in rng.permutation(len(y)):
            gradient = y[i] * (w[rows[i]] @ values[i] + bias) - 1.0
            new = min(max(alpha[i] - gradient / square[i], 0.0), limit[i])
            step = (new - alpha[i]) * y[i]
            if step:
                w[rows[i]] += step * values[i]
                bias += step
                alpha[i] = new
    margin = np.array([w[r] @ v + bias for r, v in zip(rows, values)])
    slope, shift = _logistic(margin, y > 0)
    if rate is not None and 0 < rate < 1:
        shift += np.log(rate / (1 - rate)) - np.log((y > 0).mean() / (y < 0).mean())
    return Model(np.stack([ratio, w]).astype(np.float32), float(bias), slope, shift)


def _logistic(margin: np.ndarray, positive: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Newton steps for the two parameters of a logistic curve, slightly regularised."""
    x, t, p = np.stack([margin, np.ones_like(margin)], 1), positive.astype(float), np.array([1.0, 0.0])
    for _ in range(steps):
        q = 1 / (1 + np.exp(-np.clip(x @ p, -30, 30)))
        gradient = x.T @ (q - t) + 1e-2 * p
        p = p - np.linalg.solve((x * (q * (1 - q))[:, None]).T @ x + 1e-2 * np.eye(2), gradient)
        p[0] = min(max(p[0], 0.0), 50.0)
    return float(p[0]), float(p[1])


def margins(model: Model, texts: list[bytes | None]) -> np.ndarray:
    out = np.zeros(len(texts))
    if model.weight.ndim == 1:
        return out
    ratio, w = model.weight
    both = ratio * w
    for i, text in enumerate(texts):
        r = indicators(text)
        length = float(np.sqrt(np.square(ratio[r]).sum()))
        out[i] = both[r].sum() / max(length, 1e-9) + model.bias
    return out


def score(docs: DataFrame, model: Model, text: str = "text", to: str = "score") -> DataFrame:
    """Add ``to``, 0 to 1, to every row. Null and empty texts get the score of the bias alone. Equal texts get equal
    scores. A column that is already called ``to`` is replaced. An empty table gives an empty table."""
    spark = docs.sparkSession
    docs = docs.drop(to)
    shared = spark.sparkContext.broadcast(vars(model))  # 2 x 2^18 floats, whatever the data
    schema = StructType([*docs.schema.fields, StructField(to, DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(**shared.value)
        for batch in small_batches(batches):
            z = np.clip(margins(m, raw_texts(batch, text)) * m.slope + m.shift, -30, 30)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(1 / (1 + np.exp(-z)))],
                                             [*batch.schema.names, to])

    return docs.mapInArrow(run, schema)


def sample(docs: DataFrame, labels: DataFrame, label: str, allowed, most: tuple[int, int]) -> list:
    """Up to so many labelled texts of class 0 and 1 that may be learnt from, the same ones each time.

    ``allowed`` is a condition on doc_id. Rows without an id, label or text are not used; an id that is labelled as both
    may be used as both."""
    marks = labels.where(allowed & F.col(label).isin(0, 1))
    picked = []
    for y, n in enumerate(most):
        ids = chosen_ids(marks.where(F.col(label) == y), n)
        picked += chosen_texts(docs, ids.withColumn("_y", F.lit(y)), n)
    return picked


def train(docs: DataFrame, labels: DataFrame, allowed, label: str = "quality", most: tuple[int, int] = (1500, 1500)) -> Model:
    """Fit on a bounded sample: at most ``most`` labelled rows of class 0 and 1."""
    picked = sample(docs, labels, label, allowed, most)
    rate = labels.where(allowed & F.col(label).isin(0, 1)).agg(F.avg(label).alias("r")).first()["r"]
    return fitted(fit, Model, docs.sparkSession, [r.text.encode() for r in picked], [r._y for r in picked], rate=rate)
