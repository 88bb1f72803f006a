"""Suffix-array deduplication: bytes covered by a string of ``LENGTH`` bytes that an earlier document also holds.

Every window of LENGTH bytes is dealt out by the least hash among its GRAM-byte grams, so equal windows meet wherever
they come from, and neighbours mostly stay together: a run of windows with one least gram is a slice. Slices of equal
content are settled by the smallest document id among them. Where one gram has several contents, one slice of each is
fetched, and a shard of such slices is put in suffix order by external induced sorting: sorted seeds, then queues by
first symbol that carry (suffix, common prefix) from each suffix to the one a symbol longer, first upwards, then
downwards, in memory or on disk. Neighbours in that order that share LENGTH bytes are equal windows.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import bounded, mix64, partitions, raw_texts, small_batches, stored

LENGTH, GRAM = 50, 20
GRAMS = LENGTH - GRAM + 1
CLASS = 11  # windows are told apart by how many bytes they hold before their gram: so many of these numbers are a class
CLASSES, BITS, PLACED = -(-GRAMS // CLASS), 19, 5  # bits of a class's hash, and of a gram's place in a slice
BLOCK = 1 << 18  # suffixes that are handed on together
PIECE = 1 << 20  # bytes of a text that are hashed at once
PLACE = 21  # bits that hold a place in a piece
HELD = 400_000  # slices packed into one set of shuffle rows
COPIES = 2_000_000  # groups of equal texts that each executor may hold; beyond it both sides are shuffled
SHARD = 20_000  # slices of one gram that go to one shard
SORTED = 50_000  # slices that are sorted together, about: a sort takes many steps, however few slices it has
P = 0x5851F42D4C957F2D
CODES = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


class Powers:
    """Powers of P and of its inverse modulo 2^64, as far as asked for."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up = np.cumprod(np.full(n, P, np.uint64))
            self.down = np.cumprod(np.full(n, pow(P, -1, 1 << 64), np.uint64))
        return self.up[:n], self.down[:n]


def slices(text: bytes, powers: Powers) -> tuple[np.ndarray, ...]:
    """(gram, content, first, count, sides) of each slice of one text: its least gram, a hash of its bytes, its first
    window and their number, and its sides: a number of BITS bits for each class of windows, and the bytes that the
    first window holds before the gram.

    All windows of a class hold the same bytes around their gram, the core. So slices share a window of a class only if
    they share the core's hash; that of a class without a window in the slice is 0. Where the gram occurs twice in a slice,
    all is 0, which tells nothing."""
    out = [], [], [], [], []
    for at in range(0, max(len(text) - LENGTH + 1, 0), PIECE):
        b = np.frombuffer(text, np.uint8, min(PIECE + LENGTH - 1, len(text) - at), at)
        up, down = powers.upto(len(b) + 1)
        sums = np.zeros(len(b) + 1, np.uint64)
        np.cumsum(CODES[b] * up[: len(b)], out=sums[1:])
        grams = mix64((sums[GRAM:] - sums[:-GRAM]) * down[: len(b) - GRAM + 1])
        # least of GRAMS grams from each place on, by doubling; of equal ones the first
        least, width = grams >> np.uint64(PLACE) << np.uint64(PLACE) | np.arange(len(grams), dtype=np.uint64), 1
        while 2 * width <= GRAMS:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        rest = GRAMS - width
        if rest:
            least = np.minimum(least[: len(least) - rest], least[rest:])
        place = (least & np.uint64((1 << PLACE) - 1)).astype(np.int64)
        moved = np.flatnonzero(place[1:] != place[:-1]) + 1
        first = np.concatenate([[0], moved[grams[place[moved]] != grams[place[moved - 1]]]])
        end = np.append(first[1:], len(least))
        content = mix64((sums[end + LENGTH - 1] - sums[first]) * down[first] + (end - first).astype(np.uint64))
        p, once = place[first], place[first] == place[end - 1]
        sides = np.zeros(len(p), np.uint64)
        for c in range(CLASSES):
            low, high = c * CLASS, min(c * CLASS + CLASS, GRAMS) - 1
            rows = np.flatnonzero(once & (p - first >= low) & (p - end + 1 <= high))
            start, stop = p[rows] - low, p[rows] - high + LENGTH
            core = mix64((sums[stop] - sums[start]) * down[start]) >> np.uint64(64 - BITS)
            sides[rows] |= np.maximum(core, np.uint64(1)) << np.uint64(PLACED + c * BITS)
        sides = np.where(once, sides | (p - first).astype(np.uint64), np.uint64(0)).view(np.int64)
        for column, values in zip(out, (grams[p], content, first + at, end - first, sides)):
            column.append(values)
    if not out[0]:
        return tuple(np.empty(0, k) for k in (np.uint64, np.uint64, np.int64, np.int64, np.int64))
    return tuple(np.concatenate(x) for x in out)


class Queue:
    """Suffixes with the prefix each shares with the one before, first in first out; beyond ``budget`` bytes on disk."""

    def __init__(self, budget: int):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.budget, self.size, self.file, self.filed = budget, 0, None, 0

    def push(self, at: np.ndarray, lcp: np.ndarray) -> None:
        if not len(at):
            return
        self.parts.append((at, lcp))
        self.size += 9 * len(at)
        if self.size > self.budget:
            self.file = self.file or tempfile.TemporaryFile()  # noqa: SIM115  this task's own; gone when it is closed
            for a, b in self.parts:
                self.file.write(len(a).to_bytes(8, "little") + a.astype(np.int64).tobytes() + b.tobytes())
            self.parts, self.size, self.filed = [], 0, self.filed + 1

    def drain(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """What is held, in order, in blocks of about BLOCK suffixes: each block takes many steps, however short it is. The
        queue is empty afterwards."""
        held, many = [], 0
        for part in self._pushed():
            held.append(part)
            many += len(part[0])
            if many >= BLOCK:
                yield np.concatenate([a for a, _ in held]), np.concatenate([b for _, b in held])
                held, many = [], 0
        if held:
            yield np.concatenate([a for a, _ in held]), np.concatenate([b for _, b in held])

    def _pushed(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if self.file is not None:
            self.file.seek(0)
            while head := self.file.read(8):
                n = int.from_bytes(head, "little")
                yield np.frombuffer(self.file.read(8 * n), np.int64), np.frombuffer(self.file.read(n), np.uint8)
            self.file.close()
            self.file = None
        parts, self.parts, self.size = self.parts, [], 0
        yield from parts


class Least:
    """Least value of any range of a block, from the least of all ranges of a power of two."""

    def __init__(self, values: np.ndarray):
        rows = [values]
        while len(rows[-1]) > 1 << (len(rows) - 1):
            last, step = rows[-1], 1 << (len(rows) - 1)
            rows.append(np.minimum(last[:-step], last[step:]))
        self.rows, size = np.concatenate(rows), np.array([len(r) for r in rows])
        self.start = np.cumsum(size) - size

    def of(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Both ends included; 255 where the range is empty."""
        some = high >= low
        level = np.frexp(np.maximum(high - low + 1, 1).astype(float))[1] - 1
        at = self.start[level]
        out = np.minimum(self.rows[at + np.where(some, low, 0)], self.rows[at + np.where(some, high - (1 << level) + 1, 0)])
        out[~some] = 255
        return out


class Sorter:
    """Suffix order of ``symbols`` (0 marks an end and stands last), as far as ``limit`` symbols decide it."""

    def __init__(self, symbols: np.ndarray, limit: int = LENGTH, budget: int = 8 << 20):
        self.t, self.limit, self.budget = symbols, min(limit, 200), budget
        n, t = len(symbols), symbols.astype(np.int32)
        step = np.append(np.sign(t[1:] - t[:-1]), 1)  # rising: the suffix is smaller than the next
        places = np.where(step != 0, np.arange(n), n)
        decides = np.minimum.accumulate(places[::-1])[::-1]
        self.small = step[np.minimum(decides, n - 1)] > 0
        self.run = np.minimum(decides - np.arange(n) + 1, self.limit).astype(np.uint8)
        self.seeds = np.flatnonzero(self.small & np.concatenate([[False], ~self.small[:-1]]))
        self.names = np.unique(symbols)

    def _sorted_seeds(self) -> np.ndarray:
        """Seeds in order of their first ``limit`` symbols, nine bits each, seven to a key; keys are looked at only where
        all before them are equal."""
        t = np.concatenate([self.t, np.zeros(self.limit + 8, self.t.dtype)]).astype(np.uint64)

        def key(at: np.ndarray, k: int) -> np.ndarray:
            out = np.zeros(len(at), np.uint64)
            for j in range(7):
                out = out << np.uint64(9) | t[np.minimum(at + 7 * k + j, len(t) - 1)]
            return out

        order = self.seeds[np.argsort(key(self.seeds, 0), kind="stable")]
        same = np.concatenate([[False], (lambda v: v[1:] == v[:-1])(key(order, 0))])
        for k in range(1, -(-self.limit // 7)):
            tied = same.copy()
            tied[:-1] |= same[1:]
            rows = np.flatnonzero(tied)
            if not len(rows):
                break
            group = np.cumsum(~same[rows])
            v = key(order[rows], k)
            by = np.lexsort((v, group))
            order[rows], v = order[rows][by], v[by]
            still = same[rows]
            still[1:] &= v[1:] == v[:-1]
            same[rows] = still
        return order

    def _shared(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common prefix of pairs of suffixes, up to the limit."""
        out, left = np.zeros(len(a), np.uint8), np.arange(len(a))
        for d in range(self.limit):
            x, y = a[left] + d, b[left] + d
            ok = (x < len(self.t)) & (y < len(self.t))
            left = left[ok][self.t[x[ok]] == self.t[y[ok]]]
            if not len(left):
                break
            out[left] = d + 1
        return out

    def _hand_on(self, at: np.ndarray, lcp: np.ndarray, wanted: np.ndarray, queues: dict, since: np.ndarray) -> None:
        """From each suffix of a block to that one symbol longer, if it is of the ``wanted`` kind, into its queue, with
        the prefix it shares with the queue's last: one more than the least on the way since."""
        k = np.flatnonzero(at > 0)
        k = k[wanted[at[k] - 1]]
        target = self.t[at[k] - 1]
        by = np.argsort(target, kind="stable")
        k, target = k[by], target[by]
        least = Least(lcp)
        fresh = np.concatenate([[True], target[1:] != target[:-1]]) if len(k) else np.zeros(0, bool)
        low = np.where(fresh, 0, np.concatenate([[0], k[:-1] + 1]) if len(k) else 0)
        shared = least.of(low, k).astype(np.int64)
        whole = int(lcp.min())
        np.minimum(since, whole, out=since, where=since >= 0)
        starts = np.flatnonzero(fresh)
        ends = np.append(starts[1:], len(k))
        tails = least.of(k[ends - 1] + 1, np.full(len(starts), len(at) - 1)) if len(starts) else []
        before = self._before
        for a, b, tail in zip(starts, ends, tails):
            name = int(target[a])
            last = int(before[name])
            values = shared[a:b].copy()
            values[0] = min(values[0], last) if last >= 0 else -1
            queues[name].push(at[k[a:b]] - 1, np.minimum(values + 1, self.limit).astype(np.uint8))
            since[name] = int(tail)
        self._before = since.copy()

    def order(self) -> tuple[np.ndarray, np.ndarray]:
        """Suffixes in order, and what each shares with the one before it (up to the limit)."""
        names = [int(x) for x in self.names]
        seeds = self._sorted_seeds()
        seed_lcp = np.concatenate([[0], self._shared(seeds[:-1], seeds[1:])]).astype(np.uint8) if len(seeds) else np.empty(0, np.uint8)
        first = self.t[seeds]
        bounds = dict(zip(names, zip(np.searchsorted(first, self.names), np.searchsorted(first, self.names, "right"))))
        large = {x: Queue(self.budget) for x in names}  # upwards: suffixes greater than the next
        done = {x: Queue(self.budget) for x in names}
        tail = {}
        since = np.full(max(names, default=0) + 1, -1)  # by symbol: the least prefix since its queue's last; none yet
        self._before = since.copy()
        for x in names:
            last = None
            more = True
            while more:
                more = False
                for at, lcp in list(large[x].drain()):
                    more = True
                    last = int(at[-1])
                    done[x].push(at, lcp)
                    self._hand_on(at, lcp, ~self.small, large, since)
            tail[x] = last
            a, b = bounds[x]
            if b > a:
                lcp = seed_lcp[a:b].copy()
                lcp[0] = 0 if last is None else min(self.run[last], self.run[seeds[a]])
                self._hand_on(seeds[a:b], lcp, ~self.small, large, since)
        small = {x: Queue(self.budget) for x in names}  # downwards: suffixes smaller than the next
        since = np.full(len(since), -1)
        self._before = since.copy()
        sorted_parts: list[tuple[np.ndarray, np.ndarray]] = []
        for x in reversed(names):
            down: list[tuple[np.ndarray, np.ndarray]] = []
            more = True
            while more:
                more = False
                for at, lcp in list(small[x].drain()):
                    more = True
                    down.append((at, lcp))
                    self._hand_on(at, lcp, self.small, small, since)
            up = list(done[x].drain())
            last = int(down[-1][0][-1]) if down else None
            if up:
                at, lcp = np.concatenate([u[0] for u in up]), np.concatenate([u[1] for u in up])
                lcp[0] = 0
                turned = np.concatenate([[0], lcp[:0:-1]]).astype(np.uint8)
                turned[0] = 0 if last is None else min(self.run[last], self.run[at[-1]])
                self._hand_on(at[::-1], turned, self.small, small, since)
            if down:
                a, v = np.concatenate([d[0] for d in down])[::-1], np.concatenate([d[1] for d in down])
                v = np.concatenate([[0], v[:0:-1]]).astype(np.uint8)
                v[0] = min(self.run[tail[x]], self.run[a[0]]) if tail[x] is not None else 0
                sorted_parts.append((a, v))
            if up:
                sorted_parts.append((at, lcp))
        sorted_parts.reverse()
        if not sorted_parts:
            return np.empty(0, np.int64), np.empty(0, np.uint8)
        return np.concatenate([s[0] for s in sorted_parts]), np.concatenate([s[1] for s in sorted_parts])


def repeated_windows(parts: list[bytes], docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(part, first, count): runs of windows of LENGTH bytes that also occur in a part of a smaller document."""
    size = np.array([len(x) for x in parts], np.int64)
    symbols = np.zeros(int(size.sum()) + len(parts), np.uint16)
    start = np.cumsum(size + 1) - size - 1
    raw = np.frombuffer(b"\0".join([*parts, b""]), np.uint8)
    inside = np.ones(len(symbols), bool)
    inside[start + size] = False
    symbols[inside] = raw[inside].astype(np.uint16) + 1
    order, lcp = Sorter(symbols).order()
    part = np.searchsorted(start, order, "right") - 1
    window = order - start[part] <= size[part] - LENGTH
    group = np.cumsum(lcp < LENGTH)
    order, part, group = order[window], part[window], group[window]
    if not len(order):
        return tuple(np.empty(0, np.int64) for _ in range(3))
    fresh = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    least = np.repeat(np.minimum.reduceat(docs[part], fresh), np.diff(np.append(fresh, len(group))))
    again = np.sort(order[docs[part] > least])
    if not len(again):
        return tuple(np.empty(0, np.int64) for _ in range(3))
    part = np.searchsorted(start, again, "right") - 1
    begin = np.flatnonzero(np.concatenate([[True], (again[1:] != again[:-1] + 1) | (part[1:] != part[:-1])]))
    return part[begin], again[begin] - start[part[begin]], np.diff(np.append(begin, len(again)))


def _flat(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).combine_chunks().flatten().to_numpy()


def _later(gram: np.ndarray, content: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order by gram, content and document, and in it: which slices an earlier document has too, and the first
    document of each slice's content."""
    order = np.lexsort((doc, content, gram))
    new = np.ones(len(order), bool)
    new[1:] = (gram[order][1:] != gram[order][:-1]) | (content[order][1:] != content[order][:-1])
    least = doc[order][new][np.cumsum(new) - 1]
    return order, doc[order] > least, least


def _sliced(first: DataFrame, buckets: int) -> DataFrame:
    """(kind, bucket, gram, content, doc, at, n, sides): slices of all texts, packed by bucket before the shuffle. What an earlier
    document of the same pack holds too is settled there (``kind`` 0), so a content that many documents share is sent
    once for each pack."""
    def packed(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        gram, content, doc, at, n, sides = (np.concatenate(x) for x in zip(*held))
        order, later, _ = _later(gram, content, doc)
        for kind, rows in ((0, order[later]), (1, order[~later])):
            bucket = (mix64(gram[rows]) % np.uint64(buckets)).astype(np.int64)
            rows, bucket = rows[(by := np.argsort(bucket, kind="stable"))], bucket[by]
            change = np.flatnonzero(np.concatenate([[True], np.diff(bucket) != 0])[: len(rows)])
            offsets = pa.array(np.append(change, len(rows)).astype(np.int32))
            columns = [c[rows].astype(k) for c, k in zip((gram, content, doc, at, n), (np.int64, np.int64, np.int64, np.int32, np.int32))]
            lists = [pa.ListArray.from_arrays(offsets, pa.array(c)) for c in columns]
            lists.append(pa.ListArray.from_arrays(offsets, pa.array(sides[rows])) if kind else pa.nulls(len(change), pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(change), kind, np.int32)), pa.array(bucket[change].astype(np.int32)), *lists],
                ["kind", "bucket", "gram", "content", "doc", "at", "n", "sides"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, held, many = Powers(), [], 0
        for batch in small_batches(batches):
            for doc, text in zip(batch.column("doc_id").to_pylist(), raw_texts(batch)):
                gram, content, at, n, sides = slices(text, powers)
                held.append((gram, content, np.full(len(gram), doc, np.int64), at, n, sides))
                many += len(gram)
                if many > HELD:
                    yield from packed(held)
                    held, many = [], 0
        if many:
            yield from packed(held)

    return first.select("doc_id", "text").mapInArrow(
        run, "kind int, bucket int, gram array<long>, content array<long>, doc array<long>, at array<int>, n array<int>, sides array<long>")


def _several(group: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Rows whose group, a number, has contents of different first documents."""
    by = np.argsort(group, kind="stable")
    fresh = np.ones(len(by), bool)
    fresh[1:] = group[by][1:] != group[by][:-1]
    starts, out = np.flatnonzero(fresh), np.zeros(len(by), bool)
    if len(starts):
        apart = np.maximum.reduceat(least[by], starts) != np.minimum.reduceat(least[by], starts)
        out[by] = apart[np.cumsum(fresh) - 1]
    return out


def _settle(table: pa.Table) -> pa.Table:
    """Slices of one bucket: those whose content an earlier document has (``kind`` 0), and where a gram has several
    contents that may share a window, the earliest slices of each (``kind`` 1)."""
    before = table.filter(pa.array(table.column("kind").to_numpy() == 0))
    table = table.filter(pa.array(table.column("kind").to_numpy() == 1))
    gram, content, doc, at, n, sides = (_flat(table, c) for c in ("gram", "content", "doc", "at", "n", "sides"))
    order, later, least = _later(gram, content, doc)
    gram, doc, at, n, sides = (x[order] for x in (gram, doc, at, n, sides))
    # of each gram: the smallest and largest of its contents' first documents
    new_gram = np.ones(len(gram), bool)
    new_gram[1:] = gram[1:] != gram[:-1]
    starts = np.flatnonzero(new_gram)
    several = (np.maximum.reduceat(least, starts) != np.minimum.reduceat(least, starts))[np.cumsum(new_gram) - 1] if len(starts) else later
    ask = ~later & several
    # of these, the windows from the first to the last class whose core another slice has too, and all windows of a gram
    # that one of its slices holds twice
    rows = np.flatnonzero(ask)
    g, own = np.cumsum(new_gram)[rows].astype(np.uint64), sides[rows].view(np.uint64)
    front, twice = (own & np.uint64((1 << PLACED) - 1)).astype(np.int64), np.isin(g, g[own == 0])
    low, high = np.full(len(rows), GRAMS), np.full(len(rows), -1)  # bytes before the gram, of the windows to compare
    for c in range(CLASSES):
        core = own >> np.uint64(PLACED + c * BITS) & np.uint64((1 << BITS) - 1)
        some = np.flatnonzero(core)
        alike = some[_several(g[some] << np.uint64(BITS) | core[some], least[rows[some]])]
        low[alike] = np.minimum(low[alike], c * CLASS)
        high[alike] = c * CLASS + CLASS - 1
    ask[rows[~twice & (high < 0)]] = False
    trim = np.flatnonzero(~twice & (high >= 0))
    begin = np.maximum(front[trim] - high[trim], 0)
    end = np.minimum(front[trim] - low[trim] + 1, n[rows[trim]])
    at, n = at.astype(np.int64), n.astype(np.int64)
    at[rows[trim]] += begin
    n[rows[trim]] = end - begin
    keep = later | ask
    zero = _flat(before, "doc")
    return pa.table({
        "kind": np.concatenate([np.zeros(len(zero), np.int32), ask[keep].astype(np.int32)]),
        **{name: np.concatenate([_flat(before, name).astype(np.int64), values[keep].astype(np.int64)])
           for name, values in (("doc", doc), ("at", at), ("n", n), ("gram", gram))}})


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, rows=200):
        doc, at, n, gram, part = [], [], [], [], []
        for d, text, asked in zip(batch.column("doc_id").to_pylist(), raw_texts(batch), batch.column("asked").to_pylist()):
            for x in asked:
                doc.append(d), at.append(x["at"]), n.append(x["n"]), gram.append(x["gram"])
                part.append(text[x["at"] : x["at"] + x["n"] + LENGTH - 1])
        yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(at, pa.int64()), pa.array(gram, pa.int64()),
                                          pa.array(part, pa.binary())], ["doc", "at", "gram", "part"])


def _sort_shard(table: pa.Table) -> pa.Table:
    doc, at = table.column("doc").to_numpy(), table.column("at").to_numpy()
    part, first, count = repeated_windows(table.column("part").to_pylist(), doc)
    return pa.table({"doc": doc[part], "at": at[part] + first, "n": count})


def _with_texts(first: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    """Texts joined with a stored table (doc, …) of lists, which grow with the texts: no hint, at any size."""
    return first.join(lists, F.col("doc_id") == F.col("doc"), how)


def _windows_one_by_one(cut: DataFrame) -> DataFrame:
    """(doc, at, n): windows that a smaller document holds, by grouping the windows themselves."""
    windows = cut.select("doc", "at", "part", F.explode(F.sequence(F.lit(0), F.length("part") - LENGTH)).alias("i")).select(
        "doc", (F.col("at") + F.col("i")).alias("at"), F.substring("part", F.col("i") + 1, F.lit(LENGTH)).alias("window"))
    first = windows.groupBy("window").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).where("first < last")
    return windows.join(first, "window").where("doc > first").select("doc", "at", F.lit(1).cast("long").alias("n"))


def removed_ranges(docs: DataFrame) -> DataFrame:
    """(doc, ranges): for documents of distinct texts, the windows to remove, as first window and number."""
    buckets = 4 * partitions(docs.sparkSession)
    settled = stored(_sliced(docs, buckets).groupBy("bucket").applyInArrow(
        _settle, "kind int, doc long, at long, n long, gram long"), "settled")
    asked = stored(settled.where("kind = 1").groupBy("doc").agg(F.collect_list(F.struct("at", "n", "gram")).alias("asked")), "asked")
    cut = _with_texts(docs, asked, "inner").select("doc_id", "text", "asked").mapInArrow(
        _cut, "doc long, at long, gram long, part binary")
    # a gram with very many contents would fill a shard: its windows are counted one by one instead, which splits it
    hot = stored(settled.where("kind = 1").groupBy("gram").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") > SHARD).select("gram"), "hot")
    apart = None
    if not hot.isEmpty():
        slices_of_hot = stored(cut.join(hot, "gram", "left_semi"), "hot-slices")
        cut = cut.join(hot, "gram", "left_anti")
        apart = _windows_one_by_one(slices_of_hot)
    shards = max(partitions(docs.sparkSession), -(-settled.where("kind = 1").count() // SORTED))
    found = cut.withColumn("shard", F.pmod(F.xxhash64("gram"), F.lit(shards))).groupBy("shard").applyInArrow(
        _sort_shard, "doc long, at long, n long")
    found = found if apart is None else found.union(apart)
    return settled.where("kind = 0").select("doc", "at", "n").union(found).groupBy("doc").agg(
        F.array_sort(F.collect_list(F.struct("at", "n"))).alias("ranges"))


def _merged(ranges: list[dict] | None, size: int, whole: bool) -> list[tuple[int, int]]:
    """Maximal removed runs of bytes."""
    if whole:
        return [(0, size)]
    out: list[tuple[int, int]] = []
    for r in ranges or ():
        low, high = r["at"], r["at"] + r["n"] + LENGTH - 1
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], high))
        else:
            out.append((low, high))
    return out


def deduplicated(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """Per row of docs: doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256; with ``with_text`` also
    kept (the remaining bytes).

    A null text is empty. Texts under 50 bytes lose nothing. Rows that share an id are one document: neither removes
    from the other. Rows without an id neither lose bytes nor make others lose them. Only doc_id and text are looked at;
    an empty table gives an empty one."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    long = rows.where(F.col("doc_id").isNotNull() & (F.octet_length("text") >= LENGTH))
    # of equal texts, the earliest stands for all; the others go as a whole
    classes = long.groupBy(F.md5("text").alias("sum")).agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    copies = stored(classes.where("first < last"), "copies")
    few = F.broadcast(copies) if bounded(copies, COPIES) else copies
    marked = rows.withColumn("sum", F.when(F.col("doc_id").isNotNull() & (F.octet_length("text") >= LENGTH), F.md5("text")))
    marked = marked.join(few, "sum", "left").withColumn("whole", F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)))
    firsts = marked.where(F.col("sum").isNotNull() & ~F.col("whole")).select("doc_id", "text")
    ranges = stored(removed_ranges(firsts), "ranges")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            out = []
            for text, r, whole in zip(raw_texts(batch), batch.column("ranges").to_pylist(), batch.column("whole").to_pylist()):
                text = text or b""
                cut = _merged(r, len(text), whole)
                edges = [0, *[x for pair in cut for x in pair], len(text)]
                kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
                out.append((len(text), len(text) - len(kept), len(cut), hashlib.sha256(kept).hexdigest(), kept))
            n, gone, spans, digest, kept = zip(*out) if out else [()] * 5
            columns = [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, pa.int64()),
                       pa.array(digest, pa.string())]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if with_text:
                columns, names = [*columns, pa.array(kept, pa.binary())], [*names, "kept"]
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text
    return _with_texts(marked.select("doc_id", "text", "whole"), ranges, "left").select(
        "doc_id", "text", "whole", "ranges").mapInArrow(run, schema)
