"""Language identification by string kernels.

The kernel of two texts is the number of byte n-grams (1 to 4 bytes, hashed) present in both, over the root of the
product of their numbers: a blended spectrum of presence. A long text is cut into even windows that together hold all of
its n-grams and are too short to fill the table of hashes; it stands for the mean of its windows. Landmark texts span the Nyström map; one kernel ridge
regression per language, against the rest, is solved on it. Texts are scored in batches: a presence matrix times the
landmarks' presence matrix, times the ridge coefficients.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from millrace.llm.common import FOLD, fitted, raw_texts, small_batches

BITS = 13
PIECE = 2048  # bytes of a window at most, which leave most of the table empty
LETTER = regex.compile(r"\p{L}")
NONE = "und"


@dataclass(frozen=True)
class Model:
    landmarks: np.ndarray  # 2^BITS x landmarks, as ``presence`` gives them
    coefficients: np.ndarray  # landmarks x languages
    langs: list[str]


def presence(text: bytes) -> np.ndarray:
    """Marks of the hashed n-grams of one whole text, at length one in each window, as the mean of all windows; runs of
    blanks and other signs as they are, letters folded. An n-gram belongs to the window it begins in."""
    b = np.frombuffer(text.translate(FOLD), np.uint8).astype(np.uint32)
    many = max(1, -(-len(b) // PIECE))
    bounds = np.arange(many + 1) * len(b) // many
    total = np.zeros(1 << BITS, np.float32)
    for at in range(0, many, 64):
        first, last = bounds[at], bounds[min(at + 64, many)]
        total += _marks(b[first : last + 3], bounds[at : at + 65] - first).sum(0)
    return total / np.float32(many)


def _marks(b: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Windows in rows. ``b`` goes on up to three bytes beyond the last bound."""
    marks = np.zeros((len(bounds) - 1, 1 << BITS), np.float32)
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    codes = b + np.uint32(1)
    for n in range(1, 5):
        if n > 1:
            codes = codes[: max(len(b) - n + 1, 0)] * np.uint32(257) + b[n - 1 :] + np.uint32(1)
        mine = codes[: len(row)]
        if len(mine):
            mixed = (mine * np.uint32(2654435761)) ^ (mine >> np.uint32(15)) * np.uint32(2246822519) ^ np.uint32(n * 0x1E3779B9)
            marks[row[: len(mine)], (mixed * np.uint32(3266489917)) >> np.uint32(32 - BITS)] = 1
    return marks / np.sqrt(np.maximum(marks.sum(1, keepdims=True), 1))


def fit(texts: list[bytes], langs: list[str], landmarks: int = 128, ridge: float = 1e-2, seed: int = 5) -> Model:
    """Fit on rows in memory. No rows: a model without languages, whose answer is always ``und``."""
    names = sorted(set(langs))
    if not names:
        return Model(np.zeros((1 << BITS, 0), np.float32), np.zeros((0, 0)), [])
    x = np.stack([presence(t) for t in texts])
    rng = np.random.default_rng(seed)
    of = np.array([names.index(y) for y in langs])
    each = max(1, landmarks // len(names))
    chosen = np.concatenate([rng.permutation(np.flatnonzero(of == k))[:each] for k in range(len(names))])
    points = np.ascontiguousarray(x[chosen].T)
    among = (x[chosen] @ points).astype(float)
    values, vectors = np.linalg.eigh((among + among.T) / 2)
    good = values > 1e-6
    root = vectors[:, good] / np.sqrt(values[good])  # kernel to Nyström features
    z = (x @ points) @ root
    z = np.hstack([z, np.ones((len(z), 1))])
    target = np.where(of[:, None] == np.arange(len(names)), 1.0, -1.0)
    weight = len(of) / (len(names) * np.bincount(of, minlength=len(names))[of])  # languages weigh the same
    solved = np.linalg.solve((z * weight[:, None]).T @ z + ridge * np.eye(z.shape[1]), (z * weight[:, None]).T @ target)
    return Model(points, np.vstack([root @ solved[:-1], solved[-1:]]), names)


def predict(model: Model, texts: list[bytes | None]) -> tuple[list[str], np.ndarray]:
    langs, scores = [NONE] * len(texts), np.zeros(len(texts))
    rows = [i for i, t in enumerate(texts) if t and model.langs and LETTER.search(t.decode("utf-8", "replace"))]
    for at in range(0, len(rows), 256):
        part = rows[at : at + 256]
        k = np.stack([presence(texts[i]) for i in part]) @ model.landmarks
        f = np.hstack([k, np.ones((len(k), 1))]) @ model.coefficients
        odds = np.exp(4 * (f - f.max(1, keepdims=True)))
        odds /= odds.sum(1, keepdims=True)
        for i, row in zip(part, odds):
            best = int(row.argmax())
            langs[i], scores[i] = model.langs[best], float(row[best])
    return langs, scores


def train(docs: DataFrame, allowed, rows: int = 2000) -> Model:
    """Fit on a sample: at most ``rows`` texts, and as many of each language as of any other, but one at least of every
    lang value. ``allowed`` is the condition for texts that may be learnt from. Null texts and langs are not used."""
    known = docs.where(allowed & F.col("lang").isNotNull() & (F.length("text") > 0)).select(
        "doc_id", "lang", "text", F.xxhash64("text").alias("mark"))
    each = max(1, rows // max(known.select("lang").distinct().count(), 1))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", "mark")
    chosen = known.select("doc_id", "lang", "mark").distinct().withColumn("nth", F.row_number().over(order)).where(
        F.col("nth") <= each).select(F.col("doc_id").alias("_id"), F.col("lang").alias("_lang"), F.col("mark").alias("_mark"))
    picked = known.join(F.broadcast(chosen), known["doc_id"].eqNullSafe(chosen["_id"]) & (F.col("lang") == F.col("_lang")) & (
        F.col("mark") == F.col("_mark"))).groupBy("lang", "doc_id", "mark").agg(F.first("text").alias("text")).orderBy(
        "lang", "doc_id", "mark").collect()
    return fitted(fit, Model, docs.sparkSession, [r.text.encode() for r in picked], [r.lang for r in picked])


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add lang_pred and score (0 to 1) to every row; columns of these names are replaced. Null texts and texts without
    a letter get ``und`` and 0. Equal texts get equal answers; an empty table gives an empty one."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))  # 2^13 x 128 floats, or x languages if they are more
    docs = docs.drop("lang_pred", "score")
    schema = StructType([*docs.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(**shared.value)
        for batch in small_batches(batches):
            langs, scores = predict(model, raw_texts(batch, text))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(langs, pa.string()), pa.array(scores)],
                                             [*batch.schema.names, "lang_pred", "score"])

    return docs.mapInArrow(run, schema)
