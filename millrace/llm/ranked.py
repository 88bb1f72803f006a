"""Ranked lexical search: posting lists cut into blocks of similar documents, skipped by exact bounds.

Documents are held in segments of bounded size. In a segment each term has its list of documents, and a list is cut into
blocks by the documents' likeness. A block's summary holds, for every term, the greatest part any of its documents scores
for it; the sum over an item's terms is never less than the score of a document in the block. An item walks the lists of
its terms, highest possible part first, and looks into the documents of a block only where the summary does not rule them
out; it stops where the lists still ahead can't add up to the score it has already found ten times.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import FOLD, raw_texts, small_batches, stored

SEGMENT = 1 << 18  # (document, term) pairs of a segment
BLOCK = 32  # documents a block has on average
SKETCH = 16  # numbers that stand for a document where likeness is compared
CELLS = 1 << 20  # cells of the table that summaries are made in
TOGETHER = 1 << 17  # terms of the items that one pass over the documents serves

KEPT_BYTES = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256)).translate(FOLD)


def terms_of(text: bytes | None) -> list[bytes]:
    """Runs of letters and digits, A to Z lower-cased, and of whatever is not ASCII."""
    return text.translate(KEPT_BYTES).split() if text else []


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def postings(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Per document with a term: doc_id, n (its terms), term and tf (numbers and counts of those in the vocabulary)."""
    told = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = told.value
        wanted = number.keys()
        for batch in small_batches(batches):
            rows, n, at, term, tf = [], [], [0], [], []
            for row, text in enumerate(raw_texts(batch)):
                words = terms_of(text)
                if not words:
                    continue
                counts = Counter(words)
                held = counts.keys() & wanted
                rows.append(row)
                n.append(len(words))
                term += map(number.__getitem__, held)
                tf += map(counts.__getitem__, held)
                at.append(len(term))
            ends = pa.array(at, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("doc_id")).take(pa.array(rows, pa.int64())), pa.array(n, pa.int64()),
                 pa.ListArray.from_arrays(ends, pa.array(term, pa.int32())), pa.ListArray.from_arrays(ends, pa.array(tf, pa.int32()))],
                ["doc_id", "n", "term", "tf"])

    schema = T.StructType([docs.schema["doc_id"], *T.StructType.fromDDL("n long, term array<int>, tf array<int>").fields])
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, … of each run, in a row."""
    ends = np.cumsum(lengths)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - ends + lengths, lengths)


class Segment:
    """Some documents by their terms, and each term's list of them in blocks."""

    def __init__(self, ids: list, sizes: np.ndarray, terms: np.ndarray, parts: np.ndarray, weights: np.ndarray):
        self.ids, self.sizes, self.terms, self.parts, self.width = ids, sizes, terms, parts, len(weights)
        self.start = np.cumsum(sizes) - sizes
        doc = np.repeat(np.arange(len(sizes)), sizes)
        order = np.argsort(terms, kind="stable")
        self.list_docs = doc[order]
        self.list_start = np.searchsorted(terms[order], np.arange(self.width + 1))
        held = np.flatnonzero(np.diff(self.list_start))
        self.most = np.zeros(self.width, np.int64)
        if len(order):
            self.most[held] = np.maximum.reduceat(parts[order], self.list_start[held])
        signs = np.random.default_rng(7).choice(np.array([-1.0, 1.0]), (SKETCH, self.width))
        share = (weights[terms] * parts).astype(float)
        self.sketch = np.stack([np.add.reduceat(s[terms] * share, self.start) for s in signs], axis=1)
        self.sketch /= np.maximum(np.linalg.norm(self.sketch, axis=1, keepdims=True), 1e-9)
        self.lists: dict[int, tuple] = {}
        self.looked_at = 0

    def blocks(self, term: int) -> tuple:
        """(documents of the list by block, block starts, and the summaries by term: term, block, greatest part)."""
        if term not in self.lists:
            docs = self.list_docs[self.list_start[term]:self.list_start[term + 1]]
            count = max(1, len(docs) // BLOCK)
            if count > 1:
                middles = self.sketch[docs[np.arange(count) * len(docs) // count]].T
                near = np.concatenate([(self.sketch[docs[i:i + 4096]] @ middles).argmax(axis=1) for i in range(0, len(docs), 4096)])
                order = np.argsort(near, kind="stable")
                docs, near = docs[order], near[order]
                starts = np.flatnonzero(np.diff(near, prepend=-1))
            else:
                starts = np.zeros(1, np.int64)
            self.lists[term] = (docs, np.append(starts, len(docs)), *self._summaries(docs, starts))
        return self.lists[term]

    def _summaries(self, docs: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ends = np.append(starts[1:], len(docs))
        step = max(1, CELLS // self.width)
        terms, blocks, parts = [], [], []
        for at in range(0, len(starts), step):
            some = docs[starts[at]:ends[min(at + step, len(starts)) - 1]]
            block = np.repeat(np.arange(len(starts[at:at + step])), (ends - starts)[at:at + step])
            n = self.sizes[some]
            where = ragged(self.start[some], n)
            table = np.zeros(len(starts[at:at + step]) * self.width, np.int64)
            np.maximum.at(table, np.repeat(block, n) * self.width + self.terms[where], self.parts[where])
            cells = np.flatnonzero(table)
            terms.append(cells % self.width)
            blocks.append(cells // self.width + at)
            parts.append(table[cells])
        term = np.concatenate(terms)
        order = np.argsort(term, kind="stable")
        return term[order], np.concatenate(blocks)[order], np.concatenate(parts)[order]

    def search(self, terms: np.ndarray, weights: np.ndarray, best: list[tuple], k: int) -> list[tuple]:
        """The ``k`` best (-score, id is null, id) of this segment and of ``best``. ``weights`` is zero but for the item."""
        terms = terms[self.most[terms] * weights[terms] > 0]
        ahead = self.most[terms] * weights[terms]
        order = np.argsort(-ahead, kind="stable")
        terms, ahead = terms[order], ahead[order]
        left = np.cumsum(ahead[::-1])[::-1]  # the most that a document of this and of no earlier list can score
        mine = np.sort(terms)
        seen = np.zeros(len(self.ids), bool)
        for term, possible in zip(terms, left):
            least = -best[-1][0] if len(best) == k else 1
            if possible < least:
                break
            docs, starts, term_of, block_of, part_of = self.blocks(int(term))
            low, high = np.searchsorted(term_of, mine), np.searchsorted(term_of, mine, "right")
            where = ragged(low, high - low)
            bound = np.zeros(len(starts) - 1, np.int64)
            np.add.at(bound, block_of[where], part_of[where] * weights[term_of[where]])
            for block in np.argsort(-bound, kind="stable"):
                least = -best[-1][0] if len(best) == k else 1
                if bound[block] < least:
                    break
                some = docs[starts[block]:starts[block + 1]]
                some = some[~seen[some]]
                if not len(some):
                    continue
                seen[some] = True
                self.looked_at += len(some)
                n = self.sizes[some]
                entry = ragged(self.start[some], n)
                score = np.add.reduceat(weights[self.terms[entry]] * self.parts[entry], np.cumsum(n) - n)
                good = np.flatnonzero(score >= least)
                if len(good):
                    found = [(-int(score[i]), self.ids[some[i]] is None, self.ids[some[i]]) for i in good]
                    best = sorted(best + found, key=_place)[:k]
        return best


def _place(hit: tuple) -> tuple:
    """Highest score first, then the smallest id, rows without an id last."""
    return hit[:2] if hit[1] else hit


def _block(docs: DataFrame, items: list[tuple], k: int, item_kind: T.DataType) -> DataFrame:
    """The best documents of some items, whose terms every task may hold."""
    spark = docs.sparkSession
    vocabulary: dict[bytes, int] = {}
    for _, terms in items:
        for term in terms:
            vocabulary.setdefault(term, len(vocabulary))
    forward = stored(postings(docs, vocabulary), "postings")
    n, total = forward.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    weights = np.zeros(len(vocabulary), np.int64)
    for term, df in forward.select(F.explode("term").alias("term")).groupBy("term").count().collect():
        weights[term] = weight(n, df)
    told = spark.sparkContext.broadcast((weights, [np.array([vocabulary[t] for t in terms], np.int64) for _, terms in items]))
    names = [item for item, _ in items]
    kind = docs.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, queries = told.value
        best: list[list[tuple]] = [[] for _ in queries]
        ids, sizes, terms, parts, held = [], [], [], [], 0
        mine = np.zeros(len(weights), np.int64)
        doc_kind = None

        def settle() -> None:
            nonlocal held
            segment = Segment(ids, np.concatenate(sizes), np.concatenate(terms), np.concatenate(parts), weights)
            for q, query in enumerate(queries):
                mine[query] = weights[query]
                best[q] = segment.search(query, mine, best[q], k)
                mine[query] = 0
            for held_list in (ids, sizes, terms, parts):
                held_list.clear()
            held = 0

        for batch in batches:
            doc_kind = batch.schema.field("doc_id").type
            lists = batch.column(batch.schema.get_field_index("term"))
            size = np.diff(lists.offsets.to_numpy())
            some = np.flatnonzero(size)
            if not len(some):
                continue
            m = np.array([10 + 90 * x * n // total for x in batch.column(batch.schema.get_field_index("n")).to_pylist()], np.int64)
            tf = batch.column(batch.schema.get_field_index("tf")).flatten().to_numpy().astype(np.int64)
            ids += batch.column(batch.schema.get_field_index("doc_id")).take(pa.array(some)).to_pylist()
            sizes.append(size[some].astype(np.int64))
            terms.append(lists.flatten().to_numpy().astype(np.int64))
            parts.append((1_000_000_000 * tf) // (1000 * tf + 8 * np.repeat(m, size)))
            held += len(tf)
            if held >= SEGMENT:
                settle()
        if held:
            settle()
        rows = [(q, hit[2], -hit[0]) for q, hits in enumerate(best) for hit in hits]
        if rows:
            q, doc, score = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), pa.array(doc, doc_kind), pa.array(score, pa.int64())], ["q", "doc_id", "score"])

    schema = T.StructType([T.StructField("q", T.IntegerType()), T.StructField("doc_id", kind), T.StructField("score", T.LongType())])
    order = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = forward.mapInArrow(run, schema).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    named = spark.createDataFrame(list(enumerate(names)), T.StructType([T.StructField("q", T.IntegerType()), T.StructField("item_id", item_kind)]))
    return ranked.join(F.broadcast(named), "q").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = 10, together: int = TOGETHER) -> DataFrame:
    """The ``k`` best documents of every item with a score above 0: item_id, rank (from 1), doc_id, score.

    Each item's terms count once. Null texts have no terms; a document without any is not counted, and an item without any
    finds nothing. Every row of items is an item of its own, and every row of docs a document, also where ids repeat or are
    null; equal scores go by doc_id, null last. Empty tables give no rows. Only doc_id, item_id and text are looked at.
    Items are served in blocks of about ``together`` terms, each of which reads the documents once."""
    spark = docs.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            terms = [sorted(set(terms_of(text))) for text in raw_texts(batch)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("item_id")), pa.array(terms, pa.list_(pa.binary()))], ["item_id", "terms"])

    name = items.schema["item_id"]
    asked = items.select("item_id", "text").mapInArrow(run, T.StructType([name, T.StructField("terms", T.ArrayType(T.BinaryType()))]))
    asked = stored(asked.where(F.size("terms") > 0), "items")
    parts, block, held = [], [], 0
    for row in asked.toLocalIterator():
        if block and held + len(row["terms"]) > together:
            parts.append(stored(_block(docs, block, k, name.dataType), "found"))
            block, held = [], 0
        block.append((row["item_id"], [bytes(t) for t in row["terms"]]))
        held += len(row["terms"])
    if block:
        parts.append(_block(docs, block, k, name.dataType))
    if not parts:
        return spark.createDataFrame([], T.StructType([name, *T.StructType.fromDDL("rank int").fields, docs.schema["doc_id"],
                                                       *T.StructType.fromDDL("score long").fields]))
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out
