"""Language-model scoring: causal self-attention over subword ids, trained in numpy.

Words are encoded by a public byte-pair vocabulary. One attention layer predicts the class of the next subword from
those before it in a window; a subword's share of its class comes from counts over the whole training corpus. Windows
overlap: each subword is scored once, in the window that shows it the most context.

The weights start from a fit on a bounded sample and are then trained over every row: rows are dealt to rounds by their
hash, and each round sums the gradients of all its windows over the tasks. Topics come from all rows, too.

Beside it stands the plain base: add-one word frequencies. The most frequent words are told to every task; the others
are counted through a join, so no task holds the vocabulary.
"""

from __future__ import annotations

import base64
from array import array
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from math import log10

import numpy as np
import pyarrow as pa
import tiktoken
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import FOLD, chosen_ids, chosen_texts, fitted, small_batches, stored, worded

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# Fixed value: how the vocabulary's words are split
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
END, START, IDS = 50256, 50257, 50258
WIDTH = 16  # of the model's vectors
SPAN, STRIDE = 32, 24  # subwords of a window, and between the starts of two
SINGLE, TOPICS, BINS = 55, 8, 8  # classes: the most frequent subwords alone, the others by topic and frequency
GROUPS = (SINGLE + 1) // BINS + TOPICS  # of BINS classes each: a group is told first, then the class within it
HEAD = 400_000  # frequent words that every task holds
ROUNDS = 8  # steps of the training over all rows; each row belongs to one of them
COMMON = 512  # subwords whose counts place a text among the topics
LN10 = float(np.log(10))


def load_vocabulary(path: str = VOCABULARY) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class Encoder(dict):
    """Numbers of words, with their subword ids and a value for each, remembered while there is room. 0 is a text's end."""

    def __init__(self, ranks: dict[bytes, int], values: dict[bytes, float] | None = None, most: int = 600_000):
        super().__init__()
        self.bpe = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.most, self.of = most, values or {}
        self.leads = np.zeros(IDS, bool)  # subwords that begin with a blank
        self.leads[[k for b, k in ranks.items() if b.startswith(b" ")]] = True
        self.reset()

    def reset(self) -> None:
        self.clear()
        self.ids, self.start, self.value = array("i", [END]), array("q", [0, 1]), array("d", [0.0])

    def numbers(self, words: list[bytes]) -> np.ndarray:
        new = [w for w in dict.fromkeys(words) if w not in self]
        if new:
            texts = [" " + w.decode("utf-8", "replace") for w in new]
            joined = "".join(texts)
            if len(joined.split()) == len(new):  # only a word's first subword begins with a blank
                ids = np.array(self.bpe.encode_ordinary(joined), np.int32)
                ends = np.append(np.flatnonzero(self.leads[ids])[1:], len(ids))
            else:  # a word holds a blank beyond ASCII
                each = list(map(self.bpe.encode_ordinary, texts))
                ids, ends = np.array([k for x in each for k in x], np.int32), np.cumsum([len(x) for x in each])
            self.start.frombytes((len(self.ids) + ends).astype(np.int64).tobytes())
            self.ids.frombytes(ids.tobytes())
            self.value.extend(self.of.get(w, 0.0) for w in new)
            self.update(zip(new, range(len(self) + 1, len(self) + len(new) + 1)))
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))

    def full(self) -> bool:
        return len(self) > self.most

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        return np.array(self.ids, np.int32), np.array(self.start, np.int64)


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(FOLD).split() if text else []


def _ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, … for each run, in a row."""
    ends = np.cumsum(lengths)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - ends + lengths, lengths)


def sequences(numbers: list[np.ndarray], ids: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Subword ids of all texts in a row, each with its end, and the length of each text's share."""
    sizes = np.array([len(k) for k in numbers], np.int64)
    words, first = with_ends(np.concatenate([*numbers, np.empty(0, np.int64)]).astype(np.int64), sizes)
    n = start[words + 1] - start[words]
    return ids[_ragged(start[words], n)], np.add.reduceat(n, first) if len(first) else sizes


def with_ends(words: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the words of texts of these sizes with each text's end, 0, behind it; and where each text begins."""
    out = np.zeros(len(words) + len(sizes), np.int64)
    out[np.arange(len(words)) + np.repeat(np.arange(len(sizes)), sizes)] = words
    return out, np.cumsum(sizes + 1) - sizes - 1


def windows(tokens: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(inputs, targets, text) by window; a target that is not to be scored here is -1."""
    count = 1 + np.maximum(0, -(-(lengths - SPAN) // STRIDE))
    text = np.repeat(np.arange(len(lengths)), count)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    room = lengths + 1 + SPAN
    first = np.cumsum(room) - room
    laid = np.full(int(room.sum()), -1, np.int32)
    laid[first] = START
    laid[_ragged(first + 1, lengths)] = tokens
    cut = laid[(first[text] + nth * STRIDE)[:, None] + np.arange(SPAN + 1)]
    inputs, targets = cut[:, :SPAN].copy(), cut[:, 1:].copy()
    inputs[inputs < 0] = END
    targets[nth > 0, : SPAN - STRIDE] = -1
    return inputs, targets, text


@dataclass
class Model:
    p: dict[str, np.ndarray]
    of: np.ndarray  # class of each id
    share: np.ndarray  # natural log of each id's share of its class


SEEN = np.tril(np.ones((SPAN, SPAN), np.float32))


def _forward(p: dict, x: np.ndarray, first: int = 0):
    """States of the positions from ``first`` on; those before it are only looked at. ``a`` are attention weights, whose
    sums ``m`` was divided by: ``part`` is one over these."""
    whole = np.take(p["embed"], x, axis=0)
    whole += p["place"]
    kv = (whole.reshape(-1, WIDTH) @ np.hstack([p["k"], p["v"]])).reshape(*x.shape, 2 * WIDTH)
    k, v = kv[..., :WIDTH], kv[..., WIDTH:]
    e = np.ascontiguousarray(whole[:, first:])
    q = (e.reshape(-1, WIDTH) @ p["q"]).reshape(e.shape)
    a = q @ k.transpose(0, 2, 1)
    np.clip(a, -60, 60, out=a)  # so that no row of exponentials is all 0 or infinite
    np.exp(a, out=a)
    a *= SEEN[first:]
    part = 1 / (a.reshape(-1, SPAN) @ np.ones(SPAN, np.float32)).reshape(*a.shape[:2], 1)
    m = a @ v
    m *= part
    h = (m.reshape(-1, WIDTH) @ p["o"]).reshape(e.shape)
    h += e
    return whole, e, q, k, v, a, part, m, h


def _odds(p: dict, of: np.ndarray, h: np.ndarray, ids: np.ndarray):
    """For states and the ids that follow them, in order of these ids' groups: that order, the bounds of the groups, and
    for groups and for classes within them (number of the right one, exponentials, their sums)."""
    group = (of[ids] // BINS).astype(np.uint8)
    order = np.argsort(group, kind="stable")
    group, h = group[order].astype(np.int64), np.take(h, order, axis=0)
    bounds = np.searchsorted(group, np.arange(GROUPS + 1))
    top = h @ p["top"]
    top += p["top_bias"]
    low = np.empty((len(h), BINS), np.float32)
    for g, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
        if a < b:
            np.matmul(h[a:b], p["out"][:, g * BINS : (g + 1) * BINS], out=low[a:b])
            low[a:b] += p["bias"][g * BINS : (g + 1) * BINS]
    out = []
    for z, right in ((top, group), (low, of[ids[order]] % BINS)):
        np.clip(z, -60, 60, out=z)
        np.exp(z, out=z)
        out.append((right, z, z @ np.ones(z.shape[1], np.float32)))
    return order, bounds, h, out


def log_probabilities(model: Model, inputs: np.ndarray, targets: np.ndarray, part: int = 160) -> np.ndarray:
    """Natural log probability of each window's scored targets, summed; in parts that fit a core's cache."""
    out = np.zeros(len(inputs))
    inner = (targets[:, : SPAN - STRIDE] < 0).all(1)  # all but a text's first window
    for first, rows in ((0, np.flatnonzero(~inner)), (SPAN - STRIDE, np.flatnonzero(inner))):
        for at in range(0, len(rows), part):
            take = rows[at : at + part]
            out[take] = _scored(model, inputs[take], targets[take, first:], first)
    return out


def _scored(model: Model, x: np.ndarray, y: np.ndarray, first: int) -> np.ndarray:
    h = _forward(model.p, x, first)[-1].reshape(-1, WIDTH)
    at = np.flatnonzero(y.ravel() >= 0)
    ids = y.ravel()[at]
    order, _, _, both = _odds(model.p, model.of, np.take(h, at, axis=0), ids)
    got = model.share[ids[order]].astype(np.float64)
    for right, z, total in both:
        got += np.log(z[np.arange(len(z)), right] / total)
    return np.bincount(at[order] // y.shape[1], got, minlength=len(x))


def _placed(tokens: np.ndarray, lengths: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Texts by the common subwords they hold: logarithms of counts, at length one."""
    text = np.repeat(np.arange(len(lengths)), lengths)
    place = np.full(IDS, -1)
    place[common] = np.arange(len(common))
    ok = place[tokens] >= 0
    table = np.bincount(text[ok] * COMMON + place[tokens[ok]], minlength=len(lengths) * COMMON).reshape(-1, COMMON)
    table = np.log1p(table)
    return table / np.maximum(np.sqrt((table**2).sum(1, keepdims=True)), 1e-9)


def _clustered(mean: np.ndarray, seen: np.ndarray, rng) -> np.ndarray:
    """A topic for every id, by means; ids that no text holds go to topic 0."""
    points = mean[seen > 0]
    centres = points[rng.choice(len(points), min(TOPICS, len(points)), replace=False)]
    for _ in range(15):
        near = ((points[:, None] - centres[None]) ** 2).sum(2).argmin(1)
        centres = np.stack([points[near == k].mean(0) if (near == k).any() else centres[k] for k in range(len(centres))])
    out = np.zeros(IDS, np.int64)
    out[seen > 0] = near
    return out


def _topics(tokens: np.ndarray, lengths: np.ndarray, rng) -> np.ndarray:
    """A topic for every id, by the texts in memory that hold it: their main directions, then means."""
    common = np.argsort(-np.bincount(tokens, minlength=IDS), kind="stable")[:COMMON]
    table = _placed(tokens, lengths, common)
    u, s, _ = np.linalg.svd(table - table.mean(0), full_matrices=False)
    directions = u[:, :6] * s[:6]
    mean = np.zeros((IDS, directions.shape[1]))
    np.add.at(mean, tokens, directions[np.repeat(np.arange(len(lengths)), lengths)])
    seen = np.bincount(tokens, minlength=IDS)
    return _clustered(mean / np.maximum(seen, 1)[:, None], seen, rng)


def classes(counts: np.ndarray, topics: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(class, log share of the class) of every id. counts: of all training subwords. Every id has a share."""
    rank = np.argsort(-counts, kind="stable")
    rank = rank[rank != END]
    of = np.empty(IDS, np.int64)
    of[rank[:SINGLE]] = np.arange(SINGLE)
    of[END] = SINGLE  # the end is a class of its own
    rest = rank[SINGLE:]
    weight = counts[rest] + 0.1
    for t in range(TOPICS):
        mine = rest[topics[rest] == t]
        w = weight[topics[rest] == t]
        part = np.minimum((np.cumsum(w) / max(w.sum(), 1e-9) * BINS).astype(int), BINS - 1)
        of[mine] = SINGLE + 1 + t * BINS + part
    mass = counts + 0.1
    share = np.log(mass) - np.log(np.maximum(np.bincount(of, mass, minlength=GROUPS * BINS), 1e-9))[of]
    return of, share.astype(np.float32)


def _gradients(p: dict, of: np.ndarray, x: np.ndarray, y: np.ndarray, first: int = 0):
    """Summed over the scored positions from ``first`` on: gradients by name, those of all inputs' embeddings, and how many
    positions are scored. ``y`` begins at ``first``."""
    whole, e, q, k, v, a, part, m, h = _forward(p, x, first)
    at = np.flatnonzero(y.ravel() >= 0)
    order, bounds, near, both = _odds(p, of, np.take(h.reshape(-1, WIDTH), at, axis=0), y.ravel()[at])
    for right, z, total in both:
        z /= total[:, None]
        z[np.arange(len(z)), right] -= 1
    top, low = both[0][1], both[1][1]
    one = np.ones(len(near), np.float32)
    g = {"top": near.T @ top, "top_bias": one @ top, "out": np.zeros_like(p["out"]), "bias": np.zeros_like(p["bias"])}
    back = top @ p["top"].T
    for c, (lo, hi) in enumerate(zip(bounds[:-1], bounds[1:])):
        if lo < hi:
            mine = slice(c * BINS, (c + 1) * BINS)
            g["out"][:, mine], g["bias"][mine] = near[lo:hi].T @ low[lo:hi], one[lo:hi] @ low[lo:hi]
            back[lo:hi] += low[lo:hi] @ p["out"][:, mine].T
    dh = np.zeros((h.size // WIDTH, WIDTH), np.float32)
    dh[at[order]] = back
    g["o"] = m.reshape(-1, WIDTH).T @ dh
    dm = (dh @ p["o"].T).reshape(m.shape)
    dm *= part
    dkv = np.empty((*x.shape, 2 * WIDTH), np.float32)
    ds = dm @ v.transpose(0, 2, 1)
    ds -= np.einsum("nsw,nsw->ns", dm, m)[:, :, None]
    ds *= a
    np.matmul(ds.transpose(0, 2, 1), q, out=dkv[..., :WIDTH])
    np.matmul(a.transpose(0, 2, 1), dm, out=dkv[..., WIDTH:])
    dq = (ds @ k).reshape(-1, WIDTH)
    flat = dkv.reshape(-1, 2 * WIDTH)
    de = (flat @ np.hstack([p["k"], p["v"]]).T).reshape(whole.shape)
    dh += dq @ p["q"].T
    de[:, first:] += dh.reshape(e.shape)
    g["q"] = e.reshape(-1, WIDTH).T @ dq
    kv = whole.reshape(-1, WIDTH).T @ flat
    g["k"], g["v"] = kv[:, :WIDTH], kv[:, WIDTH:]
    g["place"] = de.sum(0)
    return g, de.reshape(-1, WIDTH), len(at)


def _by_id(ids: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ids and the sum of each one's rows."""
    ids = ids.astype(np.uint16)  # a stable sort of two bytes goes by digits
    order = np.argsort(ids, kind="stable")
    ids = ids[order]
    starts = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
    return ids[starts], np.add.reduceat(np.take(values, order, axis=0), starts)


def _added_by_id(total: np.ndarray, ids: np.ndarray, columns: np.ndarray) -> None:
    """Add values to the rows of their ids; ``columns`` has a row for each column of ``total``. Nothing is sorted or moved."""
    ids = ids.astype(np.intp)
    for c, values in enumerate(columns):
        total[:, c] += np.bincount(ids, values, minlength=len(total))


def fit(tokens: np.ndarray, lengths: np.ndarray, counts: np.ndarray, steps: int = 600, batch: int = 192, seed: int = 3,
        topics: np.ndarray | None = None) -> Model:
    """Train on a sample's sequences; ``counts`` are those of the whole corpus, and ``topics``, if given. Without texts
    the model stays at its start: every class as likely as any other."""
    rng = np.random.default_rng(seed)
    many = GROUPS * BINS
    small = lambda *shape: rng.normal(0, 0.15, shape).astype(np.float32)
    p = {"embed": small(IDS, WIDTH), "place": small(SPAN, WIDTH), "q": small(WIDTH, WIDTH), "k": small(WIDTH, WIDTH),
         "v": small(WIDTH, WIDTH), "o": small(WIDTH, WIDTH), "out": small(WIDTH, many), "bias": np.zeros(many, np.float32),
         "top": small(WIDTH, GROUPS), "top_bias": np.zeros(GROUPS, np.float32)}
    if not len(tokens):
        return Model(p, *classes(counts, np.zeros(IDS, np.int64) if topics is None else topics))
    of, share = classes(counts, _topics(tokens, lengths, rng) if topics is None else topics)
    mass = np.bincount(of, counts + 0.1, minlength=many) + 1
    p["bias"] = np.log(mass / np.repeat(mass.reshape(-1, BINS).max(1), BINS)).astype(np.float32)
    p["top_bias"] = np.log(mass.reshape(-1, BINS).sum(1) / mass.sum()).astype(np.float32)
    x_all, y_all, _ = windows(tokens, lengths)
    moment = {k: np.zeros_like(v) for k, v in p.items() if k != "embed"}
    square = {k: np.zeros_like(v) for k, v in p.items()}
    for step in range(1, steps + 1):
        rows = rng.integers(0, len(x_all), batch)
        g, each, n = _gradients(p, of, x_all[rows], y_all[rows])
        seen, rows_d = _by_id(x_all[rows].ravel(), each)
        n = max(n, 1)
        rate = 0.02 * min(1, 3 * (1 - step / (steps + 1)))
        for name, d in g.items():
            d = d / n
            moment[name] = 0.9 * moment[name] + 0.1 * d
            square[name] = 0.99 * square[name] + 0.01 * d * d
            p[name] = (p[name] - rate * (moment[name] / (1 - 0.9**step)) / (np.sqrt(square[name] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
        rows_d = rows_d / n
        square["embed"][seen] += rows_d**2
        p["embed"][seen] -= 3 * rate * rows_d / (np.sqrt(square["embed"][seen]) + 1e-7)
    p["q"] = p["q"].astype(np.float32)
    return Model(p, of, share)


def encoded(docs: DataFrame, learn: Column, ranks, head, rest: bool) -> DataFrame:
    """Every row of docs, stored by the round it teaches in (ROUNDS: none): doc_id, learnt, key, n_tokens, the number and
    sum of its words in ``head``, with ``rest`` the other words' hashes and how often it has each, and tokens: its subword
    ids and end, in two bytes each. Texts are split and encoded here alone."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(ranks.value, head.value)
        for batch in small_batches(batches, size=4 << 20):
            words, at, sizes = worded(batch)
            numbers = encoder.numbers(words)
            ids, start = encoder.tables()
            own, first = with_ends(numbers[at], sizes)
            value = np.array(encoder.value)[own]
            n = start[own + 1] - start[own]
            tokens = ids[_ragged(start[own], n)].astype(np.uint16)
            ends = np.append(0, np.cumsum(np.add.reduceat(n, first)))
            hashes, times, lists = np.empty(0, np.int64), np.empty(0, np.int32), np.zeros(len(sizes) + 1, np.int64)
            if rest:
                others = np.flatnonzero(np.array(encoder.value)[numbers] == 0)  # a word in ``head`` has a value above 0
                h = np.fromiter((xxhash.xxh3_64_intdigest(words[k]) for k in others.tolist()), np.uint64, len(others)).view(np.int64)
                nth = np.full(len(words), -1)
                nth[others] = np.arange(len(others))
                nth = nth[at]
                far = np.flatnonzero(nth >= 0)
                whose = np.repeat(np.arange(len(sizes)), sizes)[far]
                pair, times = np.unique(whose * max(len(others), 1) + nth[far], return_counts=True)
                hashes, times = h[pair % max(len(others), 1)], times.astype(np.int32)
                lists[1:] = np.cumsum(np.bincount(pair // max(len(others), 1), minlength=len(sizes)))
            lists = pa.array(lists.astype(np.int32))
            yield pa.RecordBatch.from_arrays([
                *[batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "learnt", "key", "round")], pa.array(sizes + 1),
                pa.array(np.add.reduceat((value != 0).astype(np.int64), first)), pa.array(np.add.reduceat(value, first)),
                pa.ListArray.from_arrays(lists, pa.array(hashes)), pa.ListArray.from_arrays(lists, pa.array(times)),
                pa.array([tokens[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])], pa.binary())],
                ["doc_id", "learnt", "key", "round", "n_tokens", "n_head", "s_head", "rest", "times", "tokens"])
            if encoder.full():
                encoder.reset()

    key = F.xxhash64("doc_id", "text")
    dealt = F.when(learn, F.pmod(key, F.lit(ROUNDS))).otherwise(ROUNDS).cast("int").alias("round")
    return stored(docs.select("doc_id", "text", learn.alias("learnt"), key.alias("key"), dealt).mapInArrow(
        run, f"doc_id {kind}, learnt boolean, key long, round int, n_tokens long, n_head long, s_head double, rest array<long>, "
             "times array<int>, tokens binary"), "tokens", "round")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Batches of rows of ``encoded``, with all their tokens and how many each has."""
    for batch in small_batches(batches, rows=500, size=1 << 20):
        parts = [np.frombuffer(t, np.uint16) for t in batch.column(batch.schema.get_field_index("tokens")).to_pylist()]
        yield batch, np.concatenate(parts).astype(np.int64), np.array([len(x) for x in parts], np.int64)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for _, tokens, lengths in _rows(batches):
        yield tokens, lengths


def added(rows: DataFrame, work, shape: tuple[int, int], piece: int = 2048) -> np.ndarray:
    """The sum of what ``work(batches)``, an array of this fixed shape, gives in every task. Rows of zeros don't travel;
    pieces are added in two steps, in order of the tasks."""
    columns = ["task", "piece", "at", "data"]
    schema = "task int, piece int, at binary, data binary"

    def cut(task: int, k: int, block: np.ndarray) -> list:
        at = np.flatnonzero(block.any(1)).astype(np.int32)
        return [task, k, at.tobytes(), block[at].tobytes()]

    def rows_of(out: list) -> pa.Table:
        kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary())
        return pa.table([pa.array([r[c] for r in out], kinds[c]) for c in range(4)], names=columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, task = work(batches), TaskContext.get().partitionId()
        out = [cut(task, k, total[first : first + piece]) for k, first in enumerate(range(0, shape[0], piece))]
        yield from rows_of([r for r in out if r[2]]).to_batches()

    def add(table: pa.Table) -> pa.Table:
        found = sorted(table.select(columns).to_pylist(), key=lambda r: r["task"])
        block = np.zeros((piece, shape[1]))
        for r in found:
            block[np.frombuffer(r["at"], np.int32)] += np.frombuffer(r["data"], np.float64).reshape(-1, shape[1])
        return rows_of([cut(found[0]["task"], found[0]["piece"], block)])

    near = rows.mapInArrow(run, schema).withColumn("group", F.floor(F.col("task") / 32)).groupBy("piece", "group").applyInArrow(add, schema)
    out = np.zeros(shape)
    for r in near.groupBy("piece").applyInArrow(add, schema).collect():  # at most one row for each piece
        out[r.piece * piece + np.frombuffer(r["at"], np.int32)] = np.frombuffer(r.data, np.float64).reshape(-1, shape[1])
    return out


def corpus_topics(texts: DataFrame, counts: np.ndarray, seed: int = 3) -> np.ndarray:
    """A topic for every id, by all the texts of ``encoded`` that hold it."""
    common = np.argsort(-counts, kind="stable")[:COMMON]

    def spread(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros((COMMON + 2, COMMON))  # products, then sums, then the number of texts
        for tokens, lengths in _texts(batches):
            table = _placed(tokens, lengths, common)
            total[:COMMON] += table.T @ table
            total[COMMON] += table.sum(0)
            total[COMMON + 1, 0] += len(lengths)
        return total

    total = added(texts, spread, (COMMON + 2, COMMON))
    n = total[COMMON + 1, 0]
    if not n:
        return np.zeros(IDS, np.int64)
    middle = total[COMMON] / n
    main = np.linalg.eigh(total[:COMMON] / n - np.outer(middle, middle))[1][:, :-7:-1]

    def means(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        out = np.zeros((IDS, 7))
        for tokens, lengths in _texts(batches):
            directions = (_placed(tokens, lengths, common) - middle) @ main
            text = np.repeat(np.arange(len(lengths)), lengths)
            for c in range(6):
                out[:, c] += np.bincount(tokens, np.take(directions[:, c], text), minlength=IDS)
            out[:, 6] += np.bincount(tokens, minlength=IDS)
        return out

    sums = added(texts, means, (IDS, 7))
    seen = sums[:, 6]
    return _clustered(sums[:, :6] / np.maximum(seen, 1)[:, None], seen, np.random.default_rng(seed))


def refined(model: Model, texts: DataFrame, rate: float = 0.01, part: int = 320) -> Model:
    """Train over all texts of ``encoded``, each once: a step for each round, along the gradient of all its windows."""
    spark = texts.sparkSession
    names = [k for k in model.p if k != "embed"]
    sizes = [-(-model.p[k].size // WIDTH) for k in names]
    height = IDS + sum(sizes) + 1
    p = {k: v.astype(np.float32) for k, v in model.p.items()}
    moment = {k: np.zeros(p[k].shape) for k in names}
    square = {k: np.zeros(v.shape) for k, v in p.items()}
    step = 0
    for r in range(ROUNDS):
        told = spark.sparkContext.broadcast((p, model.of))

        def work(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
            now, of = told.value
            total, sums = np.zeros((height, WIDTH)), {k: np.zeros(now[k].shape) for k in names}
            for tokens, lengths in _texts(batches):
                x_all, y_all, _ = windows(tokens, lengths)
                inner = (y_all[:, : SPAN - STRIDE] < 0).all(1)  # all but a text's first window
                each, ids = np.empty((WIDTH, x_all.size), np.float32), []
                done = 0
                for first, rows in ((0, np.flatnonzero(~inner)), (SPAN - STRIDE, np.flatnonzero(inner))):
                    for at in range(0, len(rows), part):
                        take = rows[at : at + part]
                        ids.append(x_all[take].ravel())
                        g, d, n = _gradients(now, of, x_all[take], y_all[take, first:], first)
                        each[:, done : done + len(d)] = d.T
                        done += len(d)
                        total[-1, 0] += n
                        for k in names:
                            sums[k] += g[k]
                _added_by_id(total[:IDS], np.concatenate(ids), each)
            at = IDS
            for k, size in zip(names, sizes):
                total[at : at + size].ravel()[: sums[k].size] = sums[k].ravel()
                at += size
            return total

        total = added(texts.where(F.col("round") == r), work, (height, WIDTH))
        told.unpersist()
        if not total[-1, 0]:
            continue
        step += 1
        now = rate * (1 - r / (ROUNDS + 1))
        p, at = dict(p), IDS
        for k, size in zip(names, sizes):
            d = total[at : at + size].ravel()[: p[k].size].reshape(p[k].shape) / total[-1, 0]
            at += size
            moment[k] = 0.9 * moment[k] + 0.1 * d
            square[k] = 0.99 * square[k] + 0.01 * d * d
            p[k] = (p[k] - now * (moment[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
        d = total[:IDS]  # sums, so that ids of few texts move as well
        square["embed"] += d * d
        p["embed"] = (p["embed"] - now * d / (np.sqrt(square["embed"]) + 1e-7)).astype(np.float32)
    return Model(p, model.of, model.share)


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) over all texts; batches are added up before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: defaultdict[bytes, int] = defaultdict(int)

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held.keys()), pa.binary()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

        for batch in small_batches(batches):
            words, at, _ = worded(batch)
            for word, n in zip(words, np.bincount(at, minlength=len(words)).tolist()):
                held[word] += n
            if len(held) > 300_000:
                yield out()
                held.clear()
        yield out()

    return docs.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def subword_counts(texts: DataFrame) -> np.ndarray:
    """Count of every subword id and the end in rows of ``encoded``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(IDS, np.int64)
        for tokens, _ in _texts(batches):
            total += np.bincount(tokens, minlength=IDS)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int64)), pa.array(total[used])], ["id", "n"])

    out = np.zeros(IDS)
    for row in texts.select("tokens").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():
        out[row.id] = row.n  # at most one row for each id of the vocabulary
    return out


def scores(docs: DataFrame, learn: Column, rows: int = 1500, vocabulary: str = VOCABULARY) -> DataFrame:
    """Per row of docs: doc_id, learnt (the condition ``learn``), n_tokens, n_known, train_tokens, base_score, score.

    Word and subword counts, topics and the training of the attention weights take in all rows that meet ``learn``; the
    weights start from a fit on at most ``rows`` of them. Null and empty texts consist of their end alone. Equal texts get equal scores; rows that are
    equal in id and text, too. Without a row to learn from, no token is known. An empty table gives an empty one."""
    spark = docs.sparkSession
    ranks = spark.sparkContext.broadcast(load_vocabulary(vocabulary))
    train = docs.where(learn).select("doc_id", "text")
    counts = stored(word_counts(train), "words")
    totals = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    ends = train.count()
    n, v = totals.n + ends, totals.v + (1 if ends else 0)
    top = counts.orderBy(F.desc("n"), "word").limit(HEAD).toPandas()
    bound = (int(top["n"].iloc[-1]), bytes(top["word"].iloc[-1])) if len(top) == HEAD else None
    head = spark.sparkContext.broadcast({bytes(w): log10(c + 1) for w, c in zip(top["word"], top["n"])})
    rest = None if bound is None else counts.where(
        (F.col("n") < bound[0]) | ((F.col("n") == bound[0]) & (F.col("word") > F.lit(bound[1]))))
    texts = encoded(docs, learn, ranks, head, rest is not None)
    learnt = texts.where(F.col("round") < ROUNDS)
    id_counts = subword_counts(learnt)
    picked = chosen_texts(train, chosen_ids(train.where(F.length("text") > 0), rows), rows)
    encoder = Encoder(ranks.value)
    numbers = [encoder.numbers(words_of(r.text.encode())) for r in picked]
    start = fitted(fit, Model, spark, *sequences(numbers, *encoder.tables()), id_counts, topics=corpus_topics(learnt, id_counts))
    shared = spark.sparkContext.broadcast(vars(refined(start, learnt)))
    each = log10(n + v + 1)

    def model(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lm, kept = Model(**shared.value), ["doc_id", "learnt", "key", "n_tokens", "n_head", "s_head"]
        for batch, tokens, lengths in _rows(batches):
            x, y, of = windows(tokens, lengths)
            score = np.bincount(of, log_probabilities(lm, x, y), minlength=len(lengths)) / LN10
            yield pa.RecordBatch.from_arrays([*[batch.column(batch.schema.get_field_index(c)) for c in kept], pa.array(score)], [*kept, "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    whole = texts.drop("rest", "times", "round").mapInArrow(
        model, f"doc_id {kind}, learnt boolean, key long, n_tokens long, n_head long, s_head double, score double")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = np.array([xxhash.xxh3_64_intdigest(w) for w in batch.column("word").to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(h), batch.column("n")], ["h", "n"])

    if rest is None:
        whole = whole.withColumns({"n_tail": F.lit(0), "s_tail": F.lit(0.0)})
    else:
        asked = texts.select("key", F.explode(F.arrays_zip("rest", "times")).alias("w")).select(
            "key", F.col("w.rest").alias("h"), F.col("w.times").alias("k"))
        tail = asked.join(rest.mapInArrow(hashed, "h long, n long"), "h").groupBy("key").agg(
            F.sum("k").alias("n_tail"), F.sum(F.col("k") * F.log10(F.col("n") + 1)).alias("s_tail"))
        same = texts.groupBy("key").agg(F.count(F.lit(1)).alias("rows"))  # equal rows were each asked for
        whole = whole.join(same.join(tail, "key").select("key", F.col("n_tail") / F.col("rows"), F.col("s_tail") / F.col("rows")).toDF(
            "key", "n_tail", "s_tail"), "key", "left")
    end = log10(ends + 1)
    return whole.select(
        "doc_id", "learnt", "n_tokens",
        (F.col("n_head") + F.coalesce("n_tail", F.lit(0)) + (1 if ends else 0)).cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("s_head") + F.coalesce("s_tail", F.lit(0.0)) + end - F.col("n_tokens") * each).alias("base_score"), "score")
