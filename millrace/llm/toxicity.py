"""Toxicity: a bidirectional gated recurrent network with attention pooling, trained in numpy.

A word enters as the mean vector of its character n-grams (3, 5 and 7 bytes of ``^word$``, hashed), a vector of its own and
the log odds of both among the training texts. All overlapping windows of a text are scored; the text's logit is that of
its worst window, turned into a score by a logistic curve.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from millrace.llm.common import FOLD, fitted, raw_texts, small_batches
from millrace.llm.quality_nbsvm import _logistic, sample

CHAR_BITS, WORD_BITS = 16, 15
CHARS, WORDS = 6, 4  # sizes of the two vectors
INPUT = CHARS + WORDS + 2
HIDDEN = 8
SPAN, STRIDE = 32, 24  # words of a window, and between the starts of two
MARKS = bytes.maketrans(b".,;:!?\"()[]#$%&*|<>", b" " * 19)


@dataclass
class Model:
    p: dict[str, np.ndarray]
    slope: float = 1.0
    shift: float = 0.0


def grams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed character n-grams of all words in a row, the start of each word's share, and each word's own hash."""
    text = b"".join([b"^" + w + b"$ABCDEF" for w in words])
    b = np.frombuffer(text, np.uint8).astype(np.uint64)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 2  # with both ends
    start = np.concatenate([[0], np.cumsum(size + 6)[:-1]])
    # positions with a 3-gram inside ^word$ carry one gram of each length; past the end, longer ones take the 3-gram's place
    count = np.maximum(size - 2, 1)
    first = np.concatenate([[0], np.cumsum(count)[:-1]])
    at = np.arange(int(count.sum())) - np.repeat(first - start, count)
    left = np.repeat(start + size, count) - at
    three = b[at] << np.uint64(16) | b[at + 1] << np.uint64(8) | b[at + 2]
    five = three << np.uint64(16) | b[at + 3] << np.uint64(8) | b[at + 4]
    seven = five << np.uint64(16) | b[at + 5] << np.uint64(8) | b[at + 6]
    five, seven = np.where(left >= 5, five, three), np.where(left >= 7, seven, three)
    codes = np.stack([three, five, seven], 1)
    codes = (codes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - CHAR_BITS)
    sums = np.zeros(len(b) + 1, np.uint64)
    powers = np.cumprod(np.full(len(b), 0x5851F42D4C957F2D, np.uint64))
    np.cumsum((b + np.uint64(1)) * powers, out=sums[1:])
    inverse = np.cumprod(np.full(len(b), pow(0x5851F42D4C957F2D, -1, 1 << 64), np.uint64))
    own = (sums[start + size] - sums[start]) * inverse[start]
    own = ((own ^ (own >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)) >> np.uint64(64 - WORD_BITS)
    return codes.astype(np.int64).ravel(), first * 3, own.astype(np.int64)


def split(text: bytes | None) -> list[bytes]:
    return text.translate(FOLD).translate(MARKS).split() if text else []


class Texts:
    """Texts as numbers of distinct words, cut to windows."""

    def __init__(self, texts: list[bytes | None]):
        known: dict[bytes, int] = {b"": 0}
        numbers, self.of = [], []
        for i, text in enumerate(texts):
            ids = [known.setdefault(w, len(known)) for w in split(text)]
            n = max(1, 1 + -(-(len(ids) - SPAN) // STRIDE)) if ids else 0
            if n:
                row = np.zeros((n - 1) * STRIDE + SPAN, np.int64)
                row[: len(ids)] = ids
                numbers.append(np.lib.stride_tricks.sliding_window_view(row, SPAN)[::STRIDE])
                self.of += [i] * n
        self.windows = np.concatenate(numbers) if numbers else np.zeros((0, SPAN), np.int64)
        self.of = np.array(self.of, np.int64)
        self.codes, self.first, self.own = grams(list(known))


def word_inputs(p: dict, t: Texts) -> np.ndarray:
    """One input row for each distinct word; the row of padding is 0."""
    n = np.diff(np.append(t.first, len(t.codes)))[:, None]
    out = np.concatenate([
        np.add.reduceat(p["chars"][t.codes], t.first, 0) / n, p["words"][t.own],
        np.maximum.reduceat(p["char_odds"][t.codes], t.first)[:, None], p["word_odds"][t.own][:, None]], 1)
    out[0] = 0
    return out.astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _gru(p: dict, side: str, gates: np.ndarray, ids: np.ndarray, mask: np.ndarray, keep: list | None = None) -> np.ndarray:
    """Hidden states (windows, SPAN, HIDDEN) in one direction; ``gates`` has each distinct word's share of the gates."""
    n, order = len(ids), range(SPAN) if side == "f" else range(SPAN - 1, -1, -1)
    h = np.zeros((n, HIDDEN), np.float32)
    out = np.empty((SPAN, n, HIDDEN), np.float32)
    wh = p["h" + side]
    for s in order:
        x, a = gates[ids[:, s]], h @ wh
        zr = _sigmoid(x[:, : 2 * HIDDEN] + a[:, : 2 * HIDDEN])
        z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
        c = np.tanh(x[:, 2 * HIDDEN :] + r * a[:, 2 * HIDDEN :])
        new = (c + z * (h - c)) * mask[:, s, None]
        if keep is not None:
            keep.append((s, h, a, z, r, c))
        out[s] = h = new
    return out.transpose(1, 0, 2)


def logits(p: dict, inputs: np.ndarray, windows: np.ndarray, part: int = 2048) -> np.ndarray:
    """One logit for each window."""
    gates = {side: inputs @ p["x" + side] + p["b" + side] for side in "fb"}
    out = np.empty(len(windows), np.float32)
    for at in range(0, len(windows), part):
        ids = windows[at : at + part]
        mask = (ids > 0).astype(np.float32)
        h = np.concatenate([_gru(p, side, gates[side], ids, mask) for side in "fb"], 2)
        out[at : at + part] = _pool(p, h, mask)[0]
    return out


def _pool(p: dict, h: np.ndarray, mask: np.ndarray):
    e = np.where(mask > 0, h @ p["attend"], -30)
    e = np.exp(e - e.max(1, keepdims=True)) * mask
    e /= np.maximum(e.sum(1, keepdims=True), 1e-9)
    pooled = (e[:, None] @ h)[:, 0]
    return pooled @ p["out"] + p["bias"][0], e, pooled


def _gradients(p: dict, t: Texts, rows: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
    """Loss and gradients of one batch of windows, back through time; tables get (rows, values)."""
    ids = t.windows[rows]
    mask = (ids > 0).astype(np.float32)
    seen, at = np.unique(ids, return_inverse=True)
    at = at.reshape(ids.shape)
    inputs = word_inputs(p, t)[seen] if t.cached is None else t.cached[seen]
    kept: dict[str, list] = {"f": [], "b": []}
    gates = {s: inputs @ p["x" + s] + p["b" + s] for s in "fb"}
    h = np.concatenate([_gru(p, s, gates[s], at, mask, kept[s]) for s in "fb"], 2)
    z, e, pooled = _pool(p, h, mask)
    q = _sigmoid(z)
    loss = float(-(y * np.log(q + 1e-9) + (1 - y) * np.log(1 - q + 1e-9)).mean())
    dz = ((q - y) / len(y)).astype(np.float32)
    g = {"out": pooled.T @ dz, "bias": np.array([dz.sum()])}
    dpool = dz[:, None] * p["out"]
    de = (h @ dpool[:, :, None])[:, :, 0]
    ds = e * (de - (e * de).sum(1, keepdims=True))
    g["attend"] = (h * ds[:, :, None]).sum((0, 1))
    dh = e[:, :, None] * dpool[:, None] + ds[:, :, None] * p["attend"]
    dinputs = np.zeros_like(inputs)
    for k, s in enumerate("fb"):
        part = dh[:, :, k * HIDDEN : (k + 1) * HIDDEN]
        carry = np.zeros((len(rows), HIDDEN), np.float32)
        dgates, dwh = np.zeros_like(gates[s]), np.zeros_like(p["h" + s])
        for step, before, a, zt, r, c in reversed(kept[s]):
            d = (part[:, step] + carry) * mask[:, step, None]
            dc = d * (1 - zt) * (1 - c * c)
            dzt = d * (before - c) * zt * (1 - zt)
            dr = dc * a[:, 2 * HIDDEN :] * r * (1 - r)
            local = np.concatenate([dzt, dr, dc], 1)
            through = np.concatenate([dzt, dr, dc * r], 1)
            dwh += before.T @ through
            carry = through @ p["h" + s].T + d * zt
            np.add.at(dgates, at[:, step], local)
        g["h" + s], g["b" + s] = dwh, dgates.sum(0)
        g["x" + s] = inputs.T @ dgates
        dinputs += dgates @ p["x" + s].T
    dinputs[seen == 0] = 0
    g["inputs"] = (seen, dinputs)
    return loss, g


def _odds(t: Texts, texts: int, y: np.ndarray, size: int, of_word) -> np.ndarray:
    """Log odds of a feature among toxic and other texts, by presence, less their standard error; 0 for what is not surely
    more frequent in toxic ones."""
    counts = np.zeros((2, size))
    for i in range(texts):
        words = np.unique(t.windows[t.of == i])
        counts[int(y[i])][of_word(words[words > 0])] += 1
    n = np.bincount(y.astype(int), minlength=2)
    odds = np.log((counts[1] + 0.5) / (n[1] + 1)) - np.log((counts[0] + 0.5) / (n[0] + 1))
    doubt = np.sqrt(1 / (counts[1] + 0.5) + 1 / (counts[0] + 0.5))
    return (np.clip(odds - 1.5 * doubt, 0, 6) / 3).astype(np.float32)


def fit(texts: list[bytes | None], labels: list[int], rate: float | None = None, steps: int = 240, seed: int = 11) -> Model:
    """Fit on rows in memory. ``rate``: the share of toxic rows among all. With one class only, or no rows, every text
    gets the class rate."""
    rng = np.random.default_rng(seed)
    y = np.asarray(labels, np.float32)
    small = lambda *shape: rng.normal(0, 0.3, shape).astype(np.float32)
    p = {"chars": small(1 << CHAR_BITS, CHARS) * 0.3, "words": small(1 << WORD_BITS, WORDS) * 0.3,
         "char_odds": np.zeros(1 << CHAR_BITS, np.float32), "word_odds": np.zeros(1 << WORD_BITS, np.float32),
         "attend": small(2 * HIDDEN), "out": small(2 * HIDDEN), "bias": np.zeros(1, np.float32)}
    for s in "fb":
        p |= {"x" + s: small(INPUT, 3 * HIDDEN), "h" + s: small(HIDDEN, 3 * HIDDEN), "b" + s: np.zeros(3 * HIDDEN, np.float32)}
    if not len(y) or y.min() == y.max():
        r = 0.5 if not len(y) else float(y[0])
        return Model(p, 0.0, float(np.log((r + 0.01) / (1.01 - r))))
    t = Texts(texts)
    ends = np.append(t.first, len(t.codes))
    p["char_odds"] = _odds(t, len(texts), y, 1 << CHAR_BITS, lambda w: np.unique(np.concatenate(
        [t.codes[ends[k] : ends[k + 1]] for k in w] or [np.empty(0, np.int64)])))
    p["word_odds"] = _odds(t, len(texts), y, 1 << WORD_BITS, lambda w: np.unique(t.own[w]))
    # a toxic text need not be so everywhere: its windows of the highest odds stand for it; other texts give their
    # highest and some at random
    t.cached = word_inputs(p, t)
    peak = (t.cached[:, -1] + t.cached[:, -2])[t.windows].max(1)
    use = []
    for i in np.unique(t.of):
        rows = np.flatnonzero(t.of == i)
        rows = rows[np.argsort(-peak[rows], kind="stable")]
        use += rows[:2].tolist() if y[i] else [*rows[:3].tolist(), *rng.choice(rows, min(3, len(rows)), replace=False).tolist()]
    use = np.array(use)
    bad, clean, every = use[y[t.of[use]] == 1], use[y[t.of[use]] == 0], np.flatnonzero(y[t.of] == 0)
    if not len(bad) or not len(clean):
        return fit([], [], None) if rate is None else Model(p, 0.0, float(np.log((rate + 0.01) / (1.01 - rate))))
    moment = {k: np.zeros_like(v) for k, v in p.items()}
    square = {k: np.zeros_like(v) for k, v in p.items()}
    for step in range(1, steps + 1):
        if step % (steps // 6 + 1) == 0:
            t.cached = word_inputs(p, t)
            if step > steps // 3:  # windows of clean texts that still look toxic
                z = logits(p, t.cached, t.windows[every])
                hard = every[np.argsort(-z, kind="stable")[: len(clean) // 5]]
                clean = np.concatenate([clean, hard[_sigmoid(np.sort(z)[::-1][: len(hard)]) > 0.02]])
        rows = np.concatenate([rng.choice(bad, 64), rng.choice(clean, 192)])
        _, g = _gradients(p, t, rows, y[t.of[rows]])
        seen, d = g.pop("inputs")
        for k, v in g.items():
            moment[k] = 0.9 * moment[k] + 0.1 * v
            square[k] = 0.99 * square[k] + 0.01 * v * v
            p[k] = (p[k] - 0.02 * (moment[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
        # the tables, for the words of this batch
        np.add.at(p["words"], t.own[seen], -0.5 * d[:, CHARS : CHARS + WORDS])
        many = np.diff(ends)[seen]  # grams of each word
        which = np.repeat(np.arange(len(seen)), many)
        place = np.concatenate([np.arange(ends[k], ends[k + 1]) for k in seen])
        np.add.at(p["chars"], t.codes[place], -0.5 * (d[:, :CHARS] / many[:, None])[which])
    t.cached = word_inputs(p, t)
    worst = text_logits(p, t, len(texts))
    slope, shift = _logistic(worst, y > 0)
    if rate is not None and 0 < rate < 1:
        shift += float(np.log(rate / (1 - rate)) - np.log(y.mean() / (1 - y.mean())))
    return Model(p, slope, shift)


def text_logits(p: dict, t: Texts, texts: int) -> np.ndarray:
    """The logit of each text's worst window; a text without words gets that of an empty window."""
    out = np.full(texts, float(p["bias"][0]) - 5.0)
    if len(t.windows):
        z = logits(p, t.cached if t.cached is not None else word_inputs(p, t), t.windows)
        starts = np.flatnonzero(np.diff(t.of, prepend=-1))
        out[t.of[starts]] = np.maximum.reduceat(z, starts)
    return out


Texts.cached = None


def train(docs: DataFrame, labels: DataFrame, allowed, most: tuple[int, int] = (2000, 800)) -> Model:
    """Fit on a bounded sample: at most ``most`` labelled rows of class 0 and 1."""
    picked = sample(docs, labels, "toxic", allowed, most)
    rate = labels.where(allowed & F.col("toxic").isin(0, 1)).agg(F.avg("toxic").alias("r")).first()["r"]
    return fitted(fit, Model, docs.sparkSession, [r.text.encode() for r in picked], [r._y for r in picked], rate)


def score(docs: DataFrame, model: Model, text: str = "text", to: str = "score") -> DataFrame:
    """Add ``to``, 0 to 1, to every row. Null and empty texts get one low score. Equal texts get equal scores. A column
    that is already called ``to`` is replaced; an empty table gives an empty one."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))  # some MB, whatever the data
    docs = docs.drop(to)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(**shared.value)
        for batch in small_batches(batches, rows=500, size=2 << 20):
            z = text_logits(m.p, Texts(raw_texts(batch, text)), batch.num_rows) * m.slope + m.shift
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(_sigmoid(np.clip(z, -30, 30)).astype(float))],
                                             [*batch.schema.names, to])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(to, DoubleType())]))
