"""N-gram Jaccard join by signature trees.

A document's set is its distinct five-word shingles. The nodes of a signature tree hold the OR of their documents' token
bitmaps and the range of their sizes; two trees (or a tree and itself) are walked together, and a pair of nodes is left
as soon as the largest overlap its documents could have is too small for the similarity asked.

No tree holds the corpus. Sets are put in one global order, shingles found often last, so two similar documents share a
shingle among the first quarter of theirs. The first rounds build trees over the documents that share their first shingle
of that quarter, in three orders, and compare sets; the last builds them over what shares any shingle of it and is not
yet linked, and has the surviving pairs compared: first only as many as could join everything, then what is still apart. Equal sets count as one document throughout, and so do linked ones from
one round to the next.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import bounded, dropped, mix64, partitions, small_batches, stored, worded

WORDS = 5
BLOCK = 2048  # documents that one tree holds; larger groups become several, compared block by block
FREQUENT = 1 << 21  # counters that tell frequent shingles from rare ones; this orders shingles and drops none
PART = 1 << 15  # counters that travel together
TOLD = 32 << 20  # bytes of a table that each executor may hold; beyond it both sides are shuffled
ROW = 32  # bytes that a number of such a table takes there
DEALT = 50_000  # rows of a bucket, about
EVERY = 0.5  # share of pairs found similar up to which all pairs that are left are compared at once
LEAF, FAN = 16, 8
WIDE = 256  # documents of one shingle up to which each is compared by size and place before its bitmap travels
FINE = 8  # bits a member of the bitmaps that pairs are compared by before their whole sets
ROUNDS = 3  # orders in which the first rounds look for a shared first shingle
STEPS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63],
                 np.uint64)


def shingle_sets(batch: pa.RecordBatch, column: str = "text") -> list[np.ndarray]:
    """For each text of a batch its sorted distinct 63-bit shingle hashes; fewer than five words are one shingle; no words,
    none. Each distinct word of the batch is hashed once."""
    words, at, sizes = worded(batch, column)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))[at]
    n = max(len(h) - WORDS + 1, 0)
    s = h[:n] * STEPS[0]
    for k in range(1, WORDS):
        s += h[k : k + n] * STEPS[k]
    s = mix64(s) >> np.uint64(1)
    out, first = [], 0
    for size in sizes.tolist():
        if size >= WORDS:
            keys = np.sort(s[first : first + size - WORDS + 1])
            fresh = np.empty(len(keys), bool)
            fresh[0] = True
            np.not_equal(keys[1:], keys[:-1], out=fresh[1:])
            out.append(keys[fresh])
        elif size:
            joined = (h[first : first + size] * STEPS[:size]).sum(dtype=np.uint64) + np.uint64(size)
            out.append(mix64(np.array([joined], np.uint64)) >> np.uint64(1))
        else:
            out.append(np.empty(0, np.uint64))
        first += size
    return out


def rarest_first(keys: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """The same set in the global order: by the class of its counter, then by hash."""
    return keys[np.argsort(classes[(keys % np.uint64(len(classes))).astype(np.int64)], kind="stable")]


def needed(a, b, percent: int):
    """The least overlap of two sets of these sizes at this similarity: 100 o >= percent (a + b - o)."""
    return -(-(percent * (a + b)) // (100 + percent))


def bitmap(keys: np.ndarray, each: int = 2) -> np.ndarray:
    """Token bitmap of at least ``each`` times as many bits as the set has members, a power of two, as bytes."""
    bits = max(64, 1 << int(each * max(len(keys), 1) - 1).bit_length())
    marks = np.zeros(bits, np.uint8)
    marks[(keys & np.uint64(bits - 1)).astype(np.int64)] = 1
    return np.packbits(marks, bitorder="little")


def folded(bits: np.ndarray, width: int) -> np.ndarray:
    """A bitmap (or rows of them) of fewer bytes that marks the same members."""
    while bits.shape[-1] > width:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] | bits[..., half:]
    return bits


class Node:
    """Documents of a tree below one point: their size range, and by width in bytes the OR of their bitmaps with the
    most members that any of them has beyond its marked bits."""

    __slots__ = ("least", "most", "parts", "rows", "at")

    def __init__(self, rows: np.ndarray, sizes: np.ndarray, parts: tuple[Node, ...] = ()):
        self.rows, self.parts, self.at = rows, parts, {}
        self.least, self.most = int(sizes[rows].min()), int(sizes[rows].max())


class Tree:
    """Signature tree over documents in order of size. ``sizes`` and ``bitmaps`` by row."""

    def __init__(self, sizes: np.ndarray, bitmaps: list[np.ndarray], percent: int):
        self.sizes, self.bitmaps, self.percent = sizes, bitmaps, percent
        order = np.argsort(sizes, kind="stable")
        level = [Node(order[i : i + LEAF], sizes) for i in range(0, len(order), LEAF)]
        while len(level) > 1:
            groups = [tuple(level[i : i + FAN]) for i in range(0, len(level), FAN)]
            level = [Node(np.concatenate([p.rows for p in g]), sizes, g) for g in groups]
        self.root = level[0] if level else None

    def _marks(self, node: Node, width: int) -> tuple[np.ndarray, int]:
        if width not in node.at:
            if node.parts:
                below = [self._marks(p, width) for p in node.parts]
                node.at[width] = np.bitwise_or.reduce([x[0] for x in below]), max(x[1] for x in below)
            else:
                bits = np.stack([folded(self.bitmaps[r], width) for r in node.rows])
                node.at[width] = (np.bitwise_or.reduce(bits),
                                  int((self.sizes[node.rows] - np.bitwise_count(bits).sum(1, dtype=np.int64)).max()))
        return node.at[width]

    def _may(self, a: Node, b: Node) -> bool:
        """Could any two documents below these nodes be similar enough?"""
        small, large = (a, b) if a.least <= b.least else (b, a)
        if 100 * small.most < self.percent * large.least:
            return False
        width = min(len(self.bitmaps[a.rows[0]]), len(self.bitmaps[b.rows[0]]))  # rows go by size, so the first is narrowest
        (x, over_x), (y, over_y) = self._marks(a, width), self._marks(b, width)
        most = min(a.most, b.most, int(np.bitwise_count(x & y).sum()) + min(over_x, over_y))
        return most >= needed(a.least, b.least, self.percent)

    def pairs(self, skip=None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows (i, j) of documents whose largest overlap is enough; ``skip(rows, rows)`` drops settled leaf pairs."""
        if self.root is None:
            return
        stack = [(self.root, self.root)]
        while stack:
            a, b = stack.pop()
            if a is not b and not self._may(a, b):
                continue
            if not a.parts and not b.parts:
                if skip is None or not skip(a.rows, b.rows):
                    yield from self._leaves(a, b)
            elif a is b:
                parts = a.parts
                stack += [(parts[i], parts[j]) for i in range(len(parts)) for j in range(i, len(parts))]
            elif len(a.parts) >= len(b.parts):
                stack += [(p, b) for p in a.parts]
            else:
                stack += [(a, p) for p in b.parts]

    def _leaves(self, a: Node, b: Node) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        width = min(len(self.bitmaps[a.rows[0]]), len(self.bitmaps[b.rows[0]]))
        x = np.stack([folded(self.bitmaps[r], width) for r in a.rows])
        y = x if a is b else np.stack([folded(self.bitmaps[r], width) for r in b.rows])
        n, m = self.sizes[a.rows], self.sizes[b.rows]
        both = np.bitwise_count(x[:, None] & y[None]).sum(2, dtype=np.int64)
        over_n = n - np.bitwise_count(x).sum(1, dtype=np.int64)
        over_m = m - np.bitwise_count(y).sum(1, dtype=np.int64)
        most = np.minimum(both + np.minimum(over_n[:, None], over_m[None]), np.minimum(n[:, None], m[None]))
        ok = most >= needed(n[:, None], m[None], self.percent)
        if a is b:
            ok = np.triu(ok, 1)
        i, j = np.nonzero(ok)
        if len(i):
            likely = np.argsort(-(most / (n[:, None] + m[None] - most))[i, j], kind="stable")
            yield a.rows[i[likely]], b.rows[j[likely]]


def linked_groups(ids: np.ndarray, sets: list[np.ndarray], percent: int) -> np.ndarray:
    """The smallest id reachable by links among these documents, exactly, for each of them."""
    sizes = np.array([len(s) for s in sets], np.int64)
    tree = Tree(sizes, [bitmap(s) for s in sets], percent)
    root = np.arange(len(ids))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    def settled(a: np.ndarray, b: np.ndarray) -> bool:
        first = find(a[0])
        return all(find(i) == first for i in a) and all(find(i) == first for i in b)

    for left, right in tree.pairs(settled):
        for i, j in zip(left.tolist(), right.tolist()):
            x, y = find(i), find(j)
            if x == y:
                continue
            shared = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if shared >= needed(int(sizes[i]), int(sizes[j]), percent):
                if ids[x] > ids[y]:
                    x, y = y, x
                root[y] = x
    return np.array([ids[find(i)] for i in range(len(ids))], np.int64)


def frequencies(docs: DataFrame, text: str = "text") -> np.ndarray:
    """How often shingles are held, over all documents: by counter (hash modulo FREQUENT) the binary logarithm of the sum.
    Each task counts its own documents; the counters travel in parts and are added up as they stream by. Shingles that
    share a counter are taken for as frequent as all of them together, which costs time and no result."""
    cells = FREQUENT

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(cells, np.uint32)
        for batch in small_batches(batches, rows=1000, size=4 << 20):
            for keys in shingle_sets(batch, text):
                np.add.at(counts, (keys % np.uint64(cells)).astype(np.int64), np.uint32(1))
        short = np.minimum(counts, 65535).astype(np.uint16)  # this order needs no exact sums above
        for part, at in enumerate(range(0, cells if counts.any() else 0, PART)):
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([short[at : at + PART].tobytes()], pa.binary())],
                                             ["part", "n"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                n = np.frombuffer(n, np.uint16).astype(np.int64)
                sums[part] = sums[part] + n if part in sums else n
        for part, n in sums.items():
            classes = np.frexp(n.astype(np.float64))[1].astype(np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([classes.tobytes()], pa.binary())], ["part", "n"])

    parts = -(-cells // PART)
    counted = docs.select(text).mapInArrow(count, "part int, n binary").repartition(min(parts, partitions(docs.sparkSession)), "part")
    classes = np.zeros(cells, np.uint8)
    for r in counted.mapInArrow(add, "part int, n binary").collect():
        classes[r["part"] * PART : (r["part"] + 1) * PART] = np.frombuffer(r["n"], np.uint8)
    return classes


def _reduced(how: np.ufunc, values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``how`` over each of the runs of these sizes; 0 for an empty one."""
    out, some = np.zeros(len(sizes), values.dtype), sizes > 0
    if some.any():
        out[some] = how.reduceat(values, (np.cumsum(sizes) - sizes)[some])
    return out


def sketches(docs: DataFrame, told, percent: int) -> DataFrame:
    """(doc_id, n, set_a, set_b, firsts, prefix, bits): what stands for a set in the shuffles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = told.value
        for batch in small_batches(batches, rows=1000, size=4 << 20):
            sets = shingle_sets(batch)
            n = np.array([len(keys) for keys in sets], np.int64)
            mixed = mix64(np.concatenate(sets) + np.uint64(1))
            prefix = [rarest_first(keys, classes)[: len(keys) - -(-percent * len(keys) // 100) + 1 if len(keys) else 0] for keys in sets]
            short = np.array([len(keys) for keys in prefix], np.int64)
            flat = np.concatenate(prefix)
            firsts = np.stack([_reduced(np.minimum, mix64(flat + np.uint64(r)), short).astype(np.int64) for r in range(ROUNDS)], 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("doc_id")), pa.array(n),
                 pa.array(_reduced(np.add, mixed, n).astype(np.int64)), pa.array(_reduced(np.add, mix64(mixed) ^ mixed, n).astype(np.int64)),
                 pa.array([row if k else None for row, k in zip(firsts, short)], pa.list_(pa.int64())),
                 pa.array([keys.view(np.int64) for keys in prefix], pa.list_(pa.int64())),
                 pa.array([bitmap(keys).tobytes() if len(keys) else None for keys in sets], pa.binary())],
                ["doc_id", "n", "set_a", "set_b", "firsts", "prefix", "bits"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n long, set_a long, set_b long, firsts array<long>, prefix array<long>, bits binary")


def told_if_small(table: DataFrame, rows: DataFrame) -> DataFrame:
    """``rows``, made of a stored table of numbers, to be broadcast while the bytes counted for it are few."""
    return F.broadcast(rows) if bounded(table, TOLD // (ROW * len(table.columns))) else rows


def buckets_for(table: DataFrame) -> int:
    """Buckets that a stored table's rows are dealt to, so that each holds about as many at any size."""
    return max(4 * partitions(table.sparkSession), -(-table.count() // DEALT))


def _picked(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Whole texts of the documents named in a stored table (doc_id, …); its other columns come along."""
    named = ids.select(F.col("doc_id").alias("_id"), *[c for c in ids.columns if c != "doc_id"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(
        told_if_small(ids, named), F.col("doc_id") == F.col("_id")).drop("_id")


def _with_sets(rows: DataFrame) -> DataFrame:
    """Replace text by the whole set, as a list of long."""
    others = [f for f in rows.schema.fields if f.name != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.name for f in others]
        for batch in small_batches(batches, rows=500, size=2 << 20):
            sets = [keys.view(np.int64) for keys in shingle_sets(batch)]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(batch.schema.get_field_index(c)) for c in names], pa.array(sets, pa.list_(pa.int64()))],
                [*names, "keys"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in others) + ", keys array<long>"
    return rows.mapInArrow(run, schema)


def _arrays(column: pa.ChunkedArray | pa.Array) -> list[np.ndarray]:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets = column.offsets.to_numpy()
    flat = column.values.to_numpy()
    return [flat[a:b] for a, b in zip(offsets[:-1], offsets[1:])]


def _numbers(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy().astype(np.int64)


def _runs(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order that brings equal rows of these columns together, and the bounds of their runs."""
    order = np.lexsort(columns[::-1])
    change = np.zeros(len(order), bool)
    change[:1] = True
    for c in columns:
        change[1:] |= c[order][1:] != c[order][:-1]
    return order, np.append(np.flatnonzero(change), len(order))


def first_rounds(docs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """(rep, root) for every document of reps (doc_id, firsts): documents that share a first shingle in one of the
    orders, linked by trees over whole sets. Each round takes the roots of those before. A group too large for one tree
    is dealt to several, and their roots go through the round again."""
    links = reps.select(F.col("doc_id").alias("rep"), F.col("doc_id").alias("root"))
    groups = reps
    for r in range(ROUNDS):
        while True:
            keyed = groups.select("doc_id", F.col("firsts")[r].alias("first"))
            sizes = keyed.groupBy("first").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
            parts = F.ceil(F.col("m") / BLOCK)
            members = stored(keyed.join(sizes, "first").select(
                "doc_id", "first", parts.alias("parts"), F.pmod(F.xxhash64("doc_id"), parts).alias("part")), "first-groups")
            if members.isEmpty():
                break
            rows = _with_sets(_picked(docs, members))
            dealt = F.pmod(F.xxhash64("first", "part"), F.lit(buckets_for(members)))
            found = stored(rows.withColumn("bucket", dealt).groupBy("bucket")
                           .applyInArrow(_linker(percent), "rep long, root long").where("rep <> root").distinct(), "first-links")
            links = stored(links.alias("l").join(found.alias("f"), F.col("l.root") == F.col("f.rep"), "left").select(
                "l.rep", F.coalesce("f.root", "l.root").alias("root")), "roots")
            split = members.where("parts > 1").limit(1).count() > 0
            moved = found.limit(1).count() > 0
            groups = stored(groups.join(found.select(F.col("rep").alias("doc_id")), "doc_id", "left_anti"), "groups")
            if not (split and moved):
                break
    return links


def _linker(percent: int):
    def run(table: pa.Table) -> pa.Table:
        ids, first, part = (_numbers(table, c) for c in ("doc_id", "first", "part"))
        sets = _arrays(table.column("keys"))
        out, roots = [], []
        order, bounds = _runs(first, part)
        for a, b in zip(bounds[:-1], bounds[1:]):
            rows = order[a:b]
            out.append(ids[rows])
            roots.append(linked_groups(ids[rows], [sets[r].view(np.uint64) for r in rows], percent))
        return pa.table({"rep": np.concatenate(out), "root": np.concatenate(roots)})

    return run


def _postings(reps: DataFrame, contested: DataFrame) -> DataFrame:
    """(h, parts, doc_id, comp, n, pos) of the shingles in a stored table (h, parts), which goes to the documents as two
    columns of numbers while these are few."""
    if not bounded(contested, TOLD // 16):
        return reps.select("doc_id", "comp", "n", F.posexplode("prefix").alias("pos", "h")).join(contested, "h").select(
            "h", "parts", "doc_id", "comp", "n", "pos")
    table = contested.toArrow()
    h, parts = _numbers(table, "h"), _numbers(table, "parts")
    order = np.argsort(h)
    told = reps.sparkSession.sparkContext.broadcast((h[order], parts[order].astype(np.int32)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, parts = told.value
        for batch in small_batches(batches) if len(keys) else ():
            lists = _arrays(batch.column(batch.schema.get_field_index("prefix")))
            size = np.array([len(x) for x in lists], np.int64)
            flat = np.concatenate(lists)
            at = np.minimum(np.searchsorted(keys, flat), len(keys) - 1)
            found = np.flatnonzero(keys[at] == flat)
            row = np.repeat(np.arange(len(size)), size)[found]
            own = [batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False)[row] for c in ("doc_id", "comp", "n")]
            pos = found - (np.cumsum(size) - size)[row]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (flat[found], parts[at[found]].astype(np.int64), *own, pos.astype(np.int32))],
                                             ["h", "parts", "doc_id", "comp", "n", "pos"])

    return reps.select("doc_id", "comp", "n", "prefix").mapInArrow(run, "h long, parts long, doc_id long, comp long, n long, pos int")


def first_shared(n: np.ndarray, rest: np.ndarray, s: np.ndarray, t: np.ndarray, percent: int) -> np.ndarray:
    """May a shingle be the first that two similar sets share? By posting: the set's size, and how many of its members
    there are from the shingle on."""
    return np.minimum(rest[s], rest[t]) >= needed(n[s], n[t], percent)


def _with_partner(percent: int):
    """Those postings of a group (h, i, j) that may be the first one shared with another of it. Groups beyond WIDE stay."""
    def run(table: pa.Table) -> pa.Table:
        names = ["h", "i", "j", "n", "pos", "comp", "own"]
        cols = {c: _numbers(table, c) for c in names}
        order = np.lexsort((cols["n"], cols["j"], cols["i"], cols["h"]))
        h, i, j, n, pos, comp, own = (cols[c][order] for c in names)
        rest = n - pos
        fresh = np.ones(len(h), bool)
        fresh[1:] = (h[1:] != h[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
        size = np.diff(np.append(np.flatnonzero(fresh), len(h)))
        last = np.repeat(np.cumsum(size), size) - 1
        keep = np.repeat(size > WIDE, size)
        left, step = np.flatnonzero(~keep), 0
        while len(left):
            step += 1
            left = left[left + step <= last[left]]
            left = left[100 * n[left] >= percent * n[left + step]]  # in order of size: what follows is larger still
            t = left + step
            ok = first_shared(n, rest, left, t, percent) & (comp[left] != comp[t]) & ((i[left] == j[left]) | (own[left] != own[t]))
            keep[left[ok]] = keep[t[ok]] = True
        return table.select(["h", "doc_id", "pos", "own", "i", "j"]).take(pa.array(order[keep]))

    return run


def meetings(reps: DataFrame, percent: int) -> DataFrame:
    """(h, doc_id, pos, own, i, j): where documents of several components share a shingle of their first quarter, and may
    be similar by their sizes and its places. A shingle of many documents makes blocks of them, which meet two by two.
    reps: (doc_id, n, comp, prefix, bits)."""
    contested = stored(reps.select("comp", F.explode("prefix").alias("h")).groupBy("h").agg(
        F.min("comp").alias("low"), F.max("comp").alias("high"), F.count(F.lit(1)).alias("m")).where("low <> high").select(
        "h", F.ceil(F.col("m") / BLOCK).alias("parts")), "contested")
    block = F.pmod(F.xxhash64("doc_id"), F.col("parts"))
    met = _postings(reps, contested).withColumn("own", block).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).select(
        "h", "doc_id", "pos", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "n", "comp")
    dealt = F.pmod(F.xxhash64("h", "i", "j"), F.lit(buckets_for(contested)))
    return stored(met.withColumn("bucket", dealt).groupBy("bucket").applyInArrow(
        _with_partner(percent), "h long, doc_id long, pos int, own long, i long, j long"), "met")


def proposals(met: DataFrame, reps: DataFrame, percent: int, every: bool) -> DataFrame:
    """(a, b, comp_a, comp_b): documents that meet, lie in different components and may be similar, as their trees and
    positions tell. Unless ``every`` is set, only so many of them as would join all these components, the likeliest
    first: no more than documents, however large a group of copies is. A document's bitmap goes to each bucket once."""
    # each bucket more brings bitmaps along once more, so there are no more of them than tasks or rows call for
    buckets = max(partitions(met.sparkSession), -(-met.count() // DEALT))
    dealt = met.withColumn("bucket", F.pmod(F.xxhash64("h", "i", "j"), F.lit(buckets))).repartition("doc_id").groupBy(
        "doc_id", "bucket").agg(F.collect_list(F.struct("h", "pos", "own", "i", "j")).alias("at"))
    rows = dealt.join(reps.select("doc_id", "comp", "n", "bits"), "doc_id")

    def run(table: pa.Table) -> pa.Table:
        ids, comp, n = (_numbers(table, c) for c in ("doc_id", "comp", "n"))
        raw = [np.frombuffer(b, np.uint8) for b in table.column("bits").to_pylist()]
        lists = table.column("at").combine_chunks()
        whose = np.repeat(np.arange(len(ids)), np.diff(lists.offsets.to_numpy()))
        pos, h, i, j, own = (pa.compute.struct_field(lists.flatten(), c).to_numpy(zero_copy_only=False).astype(np.int64)
                             for c in ("pos", "h", "i", "j", "own"))
        group = np.unique(comp, return_inverse=True)[1]
        root = np.arange(len(ids))  # of components, by their number

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        out = [np.empty((0, 2), np.int64)]
        order, bounds = _runs(h, i, j)
        start, many = bounds[:-1], np.diff(bounds)

        def meet(s: np.ndarray, t: np.ndarray) -> np.ndarray:
            """May these postings, of one shingle, be the first that two similar documents share?"""
            apart = (group[whose[s]] != group[whose[t]]) & ((i[s] == j[s]) | (own[s] != own[t]))
            return apart & first_shared(n[whose], n[whose] - pos, s, t, percent)

        # most shingles bring two documents together, and often the same two: each such pair is looked at once
        first = start[many == 2]
        s, t = order[first], order[first + 1]
        likely = meet(s, t)
        met_once = np.stack([s[likely], t[likely]], 1)
        two = whose[met_once]
        met_once = met_once[np.unique(np.sort(two, 1), axis=0, return_index=True)[1]]
        for at in [*met_once, *[order[a : a + m] for a, m in zip(start[many > 2], many[many > 2])]]:
            here = whose[at]
            if (group[here] == group[here[0]]).all():
                continue
            if 2 < len(at) <= LEAF and not meet(*np.broadcast_arrays(at[:, None], at[None])).any():
                continue

            def settled(x: np.ndarray, y: np.ndarray) -> bool:
                both = np.unique(group[here[np.concatenate([x, y])]])
                return len(both) == 1 or not every and len({find(g) for g in both.tolist()}) == 1

            tree = Tree(n[here], [raw[r] for r in here], percent)
            for x, y in tree.pairs(settled):
                ok = meet(at[x], at[y])
                p, q = here[x[ok]], here[y[ok]]
                if not every:
                    keep = []
                    for k, (g, f) in enumerate(zip(group[p].tolist(), group[q].tolist())):
                        g, f = find(g), find(f)
                        if g != f:
                            root[g] = f
                            keep.append(k)
                    p, q = p[keep], q[keep]
                out.append(np.stack([np.where(ids[p] < ids[q], p, q), np.where(ids[p] < ids[q], q, p)], 1))
        pairs = np.unique(np.concatenate(out), axis=0)
        a, b = pairs[:, 0], pairs[:, 1]
        return pa.table({"a": ids[a], "b": ids[b], "comp_a": comp[a], "comp_b": comp[b]})

    return rows.groupBy("bucket").applyInArrow(run, "a long, b long, comp_a long, comp_b long").distinct()


def _told_apart(rows: DataFrame, columns: str, values) -> DataFrame:
    """(doc_id, n, sum, …) for texts with ids: the set's size and sum, which tell the texts of an id apart, and what
    ``values(set)`` gives. Equal rows are one."""
    name, kind = columns.split()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, rows=500, size=2 << 20):
            sets = shingle_sets(batch)
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("doc_id")), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([int(s.sum(dtype=np.uint64).astype(np.int64)) for s in sets], pa.int64()),
                 pa.array([values(s) for s in sets], pa.binary() if kind == "binary" else pa.list_(pa.int64()))],
                ["doc_id", "n", "sum", name])

    return rows.select("doc_id", "text").mapInArrow(run, f"doc_id long, n long, sum long, {columns}").dropDuplicates(["doc_id", "n", "sum"])


def _those(docs: DataFrame, pairs: DataFrame, columns: str, values, similar) -> DataFrame:
    """Those of the pairs (a, b, …; a stored table) of which ``similar(a, b)``, given size and value of both, is true for
    texts of theirs; stored."""
    wanted = stored(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct(), "pair-ids")
    sides = stored(_told_apart(_picked(docs, wanted), columns, values), "pair-sides")
    name = columns.split()[0]
    both = pairs.join(sides.select(F.col("doc_id").alias("a"), F.col("n").alias("n_x"), F.col(name).alias("x")), "a").join(
        sides.select(F.col("doc_id").alias("b"), F.col("n").alias("n_y"), F.col(name).alias("y")), "b")
    names = pairs.columns

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, rows=200):
            sizes = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("n_x", "n_y")]
            sets = [batch.column(batch.schema.get_field_index(c)) for c in ("x", "y")]
            sets = [_arrays(c) if pa.types.is_list(c.type) else [np.frombuffer(v, np.uint8) for v in c.to_pylist()] for c in sets]
            yield batch.select(names).filter(pa.array([similar(*row) for row in zip(*sizes, *sets)], pa.bool_()))

    kept = stored(both.select(*names, "n_x", "n_y", "x", "y").mapInArrow(compare, pairs.schema).dropDuplicates(["a", "b"]), "alike")
    dropped(sides)
    return kept


def verified(docs: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b, …; a stored table) whose whole sets are similar, stored. Sets travel for the pairs whose
    fine bitmaps leave room for enough in common."""
    def may(n: int, m: int, x: np.ndarray, y: np.ndarray) -> bool:
        width = min(len(x), len(y))
        x, y = folded(x, width), folded(y, width)
        over = min(n - int(np.bitwise_count(x).sum()), m - int(np.bitwise_count(y).sum()))
        return int(np.bitwise_count(x & y).sum()) + over >= needed(n, m, percent)

    def are(n: int, m: int, x: np.ndarray, y: np.ndarray) -> bool:
        return len(np.intersect1d(x, y, assume_unique=True)) >= needed(n, m, percent)

    likely = _those(docs, pairs, "marks binary", lambda s: bitmap(s, FINE).tobytes(), may)
    return _those(docs, likely, "keys array<long>", lambda s: s.astype(np.int64), are)


def last_round(docs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """(a, b): links between components that share a shingle of their first quarter. As long as most of them turn out
    similar, as few pairs as could join them all are compared; then all that are left between different components."""
    met, tested, links, every = meetings(reps, percent), None, [], False
    while True:
        pairs = proposals(met, reps, percent, every)
        pairs = stored(pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti"), "pairs")
        found = verified(docs, pairs, percent)
        links.append(found.select("a", "b"))
        if every:
            return reduce(DataFrame.union, links)
        tested = pairs.select("a", "b") if tested is None else tested.union(pairs.select("a", "b"))
        every = found.count() <= EVERY * pairs.count()
        labels = components(found.select(F.col("comp_a").alias("a"), F.col("comp_b").alias("b")))
        moved = reps.join(told_if_small(labels, labels), F.col("comp") == F.col("node"), "left")
        reps = moved.withColumn("comp", F.coalesce("label", "comp")).drop("node", "label")
        comps = reps.select("doc_id", "comp").distinct()
        open_ = met.join(comps, "doc_id").groupBy("h").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where(
            "low <> high").select("h")
        met = stored(met.join(open_, "h", "left_semi"), "met")


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable over a stored table of edges (a, b). Each step hands labels to
    neighbours and then replaces a label by its own label, so chains halve."""
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = stored(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("label")).withColumnRenamed("a", "node"), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near"))
        step = labels.join(near, labels["node"] == near["a"], "left").select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        up = labels.select(F.col("node").alias("up"), F.col("label").alias("above"))
        new = stored(step.join(up, F.col("label") == F.col("up"), "left").select(
            "node", "old", F.least("label", "above").alias("label")), "labels")
        labels, moved = new.select("node", "label"), new.where("old <> label").limit(1).count()
        if not moved:
            return labels


def similar(docs: DataFrame, percent: int = 75) -> DataFrame:
    """Per row of docs: doc_id, n_shingles, component_id (the smallest id reachable over links).

    Null and empty texts, and texts of blanks, have no shingles and are linked with nothing. A row without an id is
    linked with nothing and has no component. Rows that share an id are one document of the graph, whatever their
    texts. Only doc_id and text are looked at; an empty table gives an empty one."""
    spark = docs.sparkSession
    told = spark.sparkContext.broadcast(frequencies(docs))
    every = stored(sketches(docs, told, percent), "sketches")
    told.unpersist()
    filled = every.where("n > 0 and doc_id is not null")
    classes = filled.groupBy("set_a", "set_b", "n").agg(F.min("doc_id").alias("rep"))
    members = stored(filled.select("doc_id", "set_a", "set_b", "n").join(classes, ["set_a", "set_b", "n"]).select(
        "doc_id", "n", "rep").distinct(), "members")
    # of equal sets, one carries the shingles on; ids and roots travel to the sketches while they are few
    own = filled.join(classes.withColumnRenamed("rep", "doc_id"), ["doc_id", "set_a", "set_b", "n"], "left_semi").select(
        "doc_id", "set_a", "firsts").dropDuplicates(["doc_id", "set_a"])
    linked = first_rounds(docs, stored(own.select("doc_id", "firsts"), "own"), percent)
    roots = stored(linked.distinct(), "linked")
    known = filled.join(told_if_small(roots, roots), filled["doc_id"] == roots["rep"]).select(
        "doc_id", "n", F.col("root").alias("comp"), "prefix", "bits")
    pairs = last_round(docs, known, percent)

    joined = roots.where("rep <> root").select(F.col("rep").alias("a"), F.col("root").alias("b"))
    several = members.groupBy("doc_id").agg(F.min("rep").alias("low"), F.max("rep").alias("high"), F.count(F.lit(1)).alias("k"))
    twice = members.join(several.where("k > 1").select("doc_id"), "doc_id", "left_semi").select(
        F.col("doc_id").alias("a"), F.col("rep").alias("b")).where("a <> b")
    edges = stored(pairs.union(joined).union(twice), "links")
    labels = components(edges)
    placed = members.groupBy("doc_id").agg(F.min("rep").alias("rep")).join(
        labels, F.col("rep") == F.col("node"), "left").select(
        F.col("doc_id").alias("_id"), F.least("label", "rep").alias("component"))
    return every.select("doc_id", F.col("n").alias("n_shingles")).join(
        placed, F.col("doc_id") == F.col("_id"), "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, percent: int = 75) -> DataFrame:
    """One row of each component of texts, that with the smallest id (of one id, the smallest text hash), with all
    columns. Rows that share an id go only where their texts link. Rows without id or shingles stay."""
    named = docs.where("doc_id is not null")
    hashed = F.xxhash64("doc_id", "text")
    several = named.groupBy("doc_id").agg(F.min(hashed).alias("low"), F.max(hashed).alias("high")).where("low <> high")
    # an id with several texts does not name a text; then a hash of both does
    mark = F.when(F.col("doc_id").isNotNull(), hashed if several.limit(1).count() else F.col("doc_id").cast("long"))
    found = stored(similar(named.select(mark.alias("doc_id"), "text"), percent).groupBy("doc_id", "n_shingles", "component_id").agg(
        F.count(F.lit(1)).alias("k")), "found")
    ids = named.select(mark.alias("doc_id"), F.col("doc_id").alias("_id")).distinct()
    members = stored(found.where("n_shingles > 0").join(ids, "doc_id").select(
        F.col("doc_id").alias("_mark"), "component_id", F.struct("_id", "doc_id").alias("place")), "members")
    best = members.groupBy("component_id").agg(F.min("place").alias("best"))
    losers = stored(members.join(best, "component_id").where("place <> best").select("_mark").distinct(), "losers")
    marked = docs.withColumn("_own", mark)
    kept = marked.join(told_if_small(losers, losers), F.col("_own") == F.col("_mark"), "left_anti")
    twice = stored(found.where("k > 1 and n_shingles > 0").select(F.col("doc_id").alias("_mark")), "twice")
    if twice.limit(1).count():
        again = told_if_small(twice, twice)
        same = F.col("_own") == F.col("_mark")
        order = Window.partitionBy("_own").orderBy(F.to_json(F.struct(*docs.columns)))
        one = kept.join(again, same, "left_semi").withColumn("_nth", F.row_number().over(order)).where("_nth = 1").drop("_nth")
        kept = kept.join(again, same, "left_anti").unionByName(one)
    return kept.select(*docs.columns)
