"""Packing documents into token windows: bounded-space online best fit.

Each task keeps a fixed number of open windows. What a document has beyond whole windows goes into the open window that
it fits most closely. Where it fits none, the fullest window takes the head of it and leaves full, and the tail goes on.
At its end a task merges its open windows into one another; the one that may remain is merged with those of other tasks,
some hundreds at a time, until one remains of them all, which is cut into lengths that are powers of two.
"""

from __future__ import annotations

import re
import string
import sys
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from types import ModuleType

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import raw_texts, small_batches, stored

END = 2
ROUNDS, TASKS, COUNT = 6, 24, 33  # bits of a sequence number: merging round, task or group, number there
DIGEST = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, part long, ids binary, open boolean"


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Numbers(dict):
    """Numbers things as they come; ``new`` lists those not seen before."""

    def __init__(self):
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, key: bytes) -> int:
        k = self[key] = len(self)
        self.new.append(key)
        return k

    def of(self, keys: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, keys), np.int64, len(keys))


class Known:
    """The ids of numbered things."""

    def __init__(self):
        self.ids, self.used = np.empty(1 << 16, "<u4"), 0
        self.begin, self.end = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)

    def put(self, k: np.ndarray, ids: np.ndarray, ends: np.ndarray) -> None:
        """Ids of the things k in a row, and where those of each end."""
        if not len(k):
            return
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        while k.max() >= len(self.end):
            self.begin, self.end = (np.concatenate([x, np.zeros_like(x)]) for x in (self.begin, self.end))
        self.ids[self.used:self.used + len(ids)] = ids
        self.begin[k[0]], self.begin[k[1:]] = self.used, self.used + ends[:-1]
        self.end[k] = self.used + ends
        self.used += len(ids)

    def take(self, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        begin = self.begin[k]
        n = self.end[k] - begin
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        return self.ids[np.arange(total) + np.repeat(begin - ends + n, n)], ends


def pieces(run: bytes) -> list[bytes]:
    """A run between blanks, cut where a subword surely ends: between letters and the ASCII marks beside them, unless an
    apostrophe stands before letters. ASCII letters are lower-cased, as the tokenizer does with all."""
    if run.isalpha():
        return [run.lower()]
    if b"<|" in run:  # it may hold a special token
        return [run]
    text = run.decode("utf-8", "replace")
    word = text.strip(MARKS)
    if not word.isalpha():
        return [p.lower() if p.isalpha() else p for p in RUNS.findall(run)]
    head = text[:text.index(word)]
    if head.endswith("'"):
        return [run]
    return [p.encode() for p in (head, word.lower() if word.isascii() else word, text[len(head) + len(word):]) if p]


class Subwords:
    """Subword ids of texts. No subword and no step of the normaliser reaches over a blank, so a text's ids are those of its
    runs between blanks; a run's pieces are each encoded once while they are remembered."""

    def __init__(self, vocabulary: str, most: int = 600_000):
        from tokenizers import Tokenizer

        self.of, self.most = Tokenizer.from_file(vocabulary), most
        known = self.of.get_vocab()
        self.ends = np.zeros(max(known.values()) + 1, bool)  # subwords that end a word
        self.ends[[i for word, i in known.items() if word.endswith("</w>")]] = True
        self.runs, self.run_ids, self.parts, self.part_ids = Numbers(), Known(), Numbers(), Known()

    def _one_by_one(self, k: np.ndarray, parts: list[bytes]) -> None:
        ids = [self.of.encode(p.decode("utf-8", "replace"), add_special_tokens=False).ids for p in parts]
        self.part_ids.put(k, np.array([i for x in ids for i in x], "<u4"), np.cumsum([len(x) for x in ids], dtype=np.int64))

    def _encode(self, parts: list[bytes], first: int) -> None:
        """Parts of letters are encoded together, which is right where as many words end as there are parts."""
        whole = np.array([p.decode("utf-8", "replace").isalpha() for p in parts], bool)
        letters, others = np.flatnonzero(whole), np.flatnonzero(~whole)
        for at in range(0, len(letters), 4096):
            some = letters[at:at + 4096]
            ids = np.array(self.of.encode_batch_fast([b" ".join([parts[i] for i in some]).decode()], add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) == len(some):
                self.part_ids.put(first + some, ids, ends)
            else:
                self._one_by_one(first + some, [parts[i] for i in some])
        self._one_by_one(first + others, [parts[i] for i in others])

    def _learn(self) -> None:
        """The ids of the runs that are new."""
        new, self.runs.new = self.runs.new, []
        if not new:
            return
        cut = [pieces(run) for run in new]
        k = self.parts.of([p for c in cut for p in c])
        some, self.parts.new = self.parts.new, []
        self._encode(some, len(self.parts) - len(some))
        ids, ends = self.part_ids.take(k)
        self.run_ids.put(np.arange(len(self.runs) - len(new), len(self.runs)), ids, ends[np.cumsum([len(c) for c in cut]) - 1])

    def encode(self, texts: list[bytes | None]) -> list[np.ndarray]:
        """The ids of each text and the end; null is an empty text."""
        if len(self.runs) > self.most:
            self.runs, self.run_ids = Numbers(), Known()
        if len(self.parts) > self.most:
            self.parts, self.part_ids = Numbers(), Known()
        numbers = [self.runs.of(text.split() if text else []) for text in texts]
        self._learn()
        return [np.append(self.run_ids.take(k)[0], np.array([END], "<u4")) for k in numbers]


MARKS = string.punctuation
RUNS = re.compile(rb"[A-Za-z]++(?![0-9\x80-\xff])|\S+")


def subwords(vocabulary: str) -> Subwords:
    """One for each vocabulary and Python worker process, so that a worker's next task need not learn the runs again."""
    home = vars(sys.modules.setdefault("millrace_worker", ModuleType("millrace_worker")))
    if vocabulary not in home:
        home[vocabulary] = Subwords(vocabulary)
    return home[vocabulary]


class Packer:
    """Windows of one task. ``closed`` gathers (window number, its pieces); a piece is [doc, start, ids, doc_tokens]."""

    def __init__(self, size: int, most: int):
        self.size, self.most = size, most
        self.open: list[tuple[int, int]] = []  # (room, number), least room first
        self.held: dict[int, list] = {}
        self.closed: list[tuple[int, list]] = []
        self.opened = 0

    def _number(self) -> int:
        self.opened += 1
        return self.opened - 1

    def add(self, doc, ids: np.ndarray) -> None:
        whole = len(ids) // self.size * self.size
        for at in range(0, whole, self.size):
            self.closed.append((self._number(), [[doc, at, ids[at:at + self.size], len(ids)]]))
        if whole < len(ids):
            self.place([doc, whole, ids[whole:].copy() if whole else ids, len(ids)], self.most)

    def place(self, piece: list, most: int) -> None:
        """Best fit among the open windows, of which there may be ``most``."""
        while True:
            n = len(piece[2])
            at = bisect_left(self.open, (n, -1))
            if at < len(self.open):
                room, number = self.open.pop(at)
                self.held[number].append(piece)
                if room > n:
                    insort(self.open, (room - n, number))
                else:
                    self.closed.append((number, self.held.pop(number)))
                return
            if len(self.open) < most:
                number = self._number()
                self.held[number] = [piece]
                insort(self.open, (self.size - n, number))
                return
            room, number = self.open.pop(0)  # none fits: the fullest takes the head and leaves
            doc, start, ids, tokens = piece
            self.closed.append((number, [*self.held.pop(number), [doc, start, ids[:room], tokens]]))
            piece = [doc, start + room, ids[room:], tokens]

    def merge(self) -> None:
        """Hand the pieces of the emptiest window on to the others until one window is open at most."""
        while len(self.open) > 1:
            _, number = self.open.pop()
            for piece in self.held.pop(number):
                self.place(piece, max(1, len(self.open)))

    def in_powers(self) -> None:
        """Close the last window as windows whose lengths are powers of two, largest first."""
        for room, number in self.open:
            rest, fill = self.held.pop(number), self.size - room
            for length in (1 << b for b in reversed(range(fill.bit_length())) if fill >> b & 1):
                taken, space = [], length
                while space:
                    doc, start, ids, tokens = rest.pop(0)
                    taken.append([doc, start, ids[:space], tokens])
                    if len(ids) > space:
                        rest.insert(0, [doc, start + space, ids[space:], tokens])
                    space -= len(taken[-1][2])
                self.closed.append((self._number(), taken))
        self.open = []

    def left(self) -> list[tuple[int, list]]:
        return [(number, self.held[number]) for _, number in self.open]


def _rows(windows: list[tuple[int, list]], first: int, kind: pa.DataType, ids: bool, open: bool) -> pa.RecordBatch:
    """One row per piece; ``first`` is the task's share of the sequence numbers. Pieces of open windows carry their ids."""
    flat, places = [], []
    for number, pieces in windows:
        offset = 0
        for piece in pieces:
            flat.append(piece)
            places.append((first + number, offset))
            offset += len(piece[2])
    raw = [p[2].tobytes() for p in flat]
    n = len(flat)
    numbers = {"start": [p[1] for p in flat], "length": [len(p[2]) for p in flat], "ids_crc32": [zlib.crc32(b) for b in raw],
               "doc_tokens": [p[3] for p in flat], "sequence_id": [s for s, _ in places], "offset": [o for _, o in places],
               "part": [(first >> COUNT) & ((1 << TASKS) - 1)] * n}
    return pa.RecordBatch.from_arrays(
        [pa.array([p[0] for p in flat], kind), *(pa.array(v, pa.int64()) for v in numbers.values()),
         pa.array(raw if ids or open else [None] * n, pa.binary()), pa.array([open] * n, pa.bool_())],
        ["doc_id", *numbers, "ids", "open"])


def _piece_schema(docs: DataFrame) -> T.StructType:
    return T.StructType([docs.schema["doc_id"], *T.StructType.fromDDL(DIGEST).fields])


def _merged(left: DataFrame, level: int, together: int, size: int, most: int, last: bool, ids: bool) -> DataFrame:
    """Merge the open windows of ``together`` tasks or groups."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("sequence_id", "ascending"), ("offset", "ascending")])
        first = (level << TASKS | int(table.column("grp")[0].as_py())) << COUNT
        packer, kind = Packer(size, most), table.schema.field("doc_id").type
        for doc, start, raw, tokens in zip(*(table.column(c).to_pylist() for c in ("doc_id", "start", "ids", "doc_tokens"))):
            packer.place([doc, start, np.frombuffer(raw, "<u4"), tokens], most)
        packer.merge()
        if last:
            packer.in_powers()
        return pa.Table.from_batches([_rows(packer.closed, first, kind, ids, False), _rows(packer.left(), first, kind, ids, True)])

    return left.withColumn("grp", F.floor(F.col("part") / together)).groupBy("grp").applyInArrow(run, _piece_schema(left))


def pack(docs: DataFrame, size: int = 4096, most: int = 64, together: int = 256, ids: bool = False,
         vocabulary: str | None = None) -> DataFrame:
    """Pieces of documents and their places in sequences of at most ``size`` tokens: doc_id, start (ids of its document before
    it), length, ids_crc32, doc_tokens, sequence_id, offset, and with ``ids`` the ids themselves (32-bit little-endian).

    Every sequence is full, but for those that the very last window is cut into: their lengths are powers of two. Null and
    empty texts are one token, the end. Rows without an id and rows that repeat are documents of their own. An empty table
    gives no pieces. Only doc_id and text are looked at. Task numbers take part in sequence numbers, up to 2^24 tasks."""
    vocabulary = vocabulary or default_vocabulary()
    rows = docs.select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << COUNT
        known, packer, kind = subwords(vocabulary), Packer(size, most), None
        for batch in small_batches(batches, 1000, 4 << 20):
            kind = batch.schema.field("doc_id").type
            for doc, tokens in zip(batch.column("doc_id").to_pylist(), known.encode(raw_texts(batch))):
                packer.add(doc, tokens)
            yield _rows(packer.closed, first, kind, ids, False)
            packer.closed = []
        if kind is not None:
            packer.merge()
            yield _rows(packer.closed, first, kind, ids, False)
            yield _rows(packer.left(), first, kind, ids, True)

    made = [stored(rows.mapInArrow(run, _piece_schema(rows)), "pieces")]
    tasks, level = (made[0].agg(F.max("part").alias("n")).first()["n"] or 0) + 1, 1
    while True:
        last = tasks <= together
        made.append(stored(_merged(made[-1].where("open"), level, together, size, most, last, ids), f"merged-{level}"))
        if last:
            break
        tasks, level = -(-tasks // together), level + 1
    out = made[0].where("not open")
    for more in made[1:]:
        out = out.unionByName(more.where("not open"))
    return out.drop("part", "open", *([] if ids else ["ids"]))


def sequences(pieces: DataFrame, size: int = 4096) -> DataFrame:
    """(sequence_id, tokens binary, doc_ids) from ``pack(..., ids=True)``: the ids of each sequence in a row."""
    placed = F.sort_array(F.collect_list(F.struct("offset", "ids", "doc_id")))
    return pieces.groupBy("sequence_id").agg(placed.alias("p")).select(
        "sequence_id", F.aggregate("p", F.lit(b""), lambda all, x: F.concat(all, x["ids"])).alias("tokens"),
        F.transform("p", lambda x: x["doc_id"]).alias("doc_ids"))
