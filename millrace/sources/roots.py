"""JSON documents back to back in files of any size, cut into rows in parallel.

A file is read in byte ranges, as records that end with a closing brace. Whether a range starts inside a string, how deep
in brackets and in which kind of document depends on all text before it, so each range first tells what it does to either
start: a prefix scan over these summaries gives every range its start. Then the ranges cut their own rows, whose text is
kept as written, and the rows that reach over the end of a range are put together from their parts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.session import shared_folder

QUOTE, BACKSLASH, COMMA, OPEN_LIST = b'"\\,['
BLANKS = b" \t\r\n,"
MARK = "﻿".encode()  # some writers put it first in a file


def scan(text: bytes, inside: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, bool]:
    """(places of brackets, +1 or -1 for each, places of commas, whether the text ends in a string), all outside strings;
    ``inside`` says whether it starts in one."""
    codes = np.frombuffer(text, np.uint8)
    quotes = np.flatnonzero(codes == QUOTE)
    if len(quotes):
        behind = np.flatnonzero((codes[np.maximum(quotes - 1, 0)] == BACKSLASH) & (quotes > 0))
        quotes = np.delete(quotes, _escaped(codes, quotes, behind)) if len(behind) else quotes
    opening, closing = (codes == 0x5B) | (codes == 0x7B), (codes == 0x5D) | (codes == 0x7D)
    places = np.flatnonzero(opening | closing | (codes == COMMA))
    places = places[(np.searchsorted(quotes, places) + inside) % 2 == 0]
    kind = codes[places]
    brackets = places[kind != COMMA]
    return brackets, np.where(opening[brackets], 1, -1), places[kind == COMMA], bool((len(quotes) + inside) % 2)


def _escaped(codes: np.ndarray, quotes: np.ndarray, behind: np.ndarray) -> np.ndarray:
    """Which quotes follow an odd run of backslashes."""
    plain = np.flatnonzero(codes != BACKSLASH)
    at = quotes[behind]
    before = np.searchsorted(plain, at) - 1  # the last other byte before the quote
    run = at - 1 - np.where(before >= 0, plain[np.maximum(before, 0)], -1)
    return behind[run % 2 == 1]


class Effect:
    """What a text does to a start: ends in a string or not, depth gained, least depth on the way, and the bracket that
    was opened there last (None where none was)."""

    def __init__(self, inside: bool, gain: int = 0, least: int = 0, root: int | None = None):
        self.inside, self.gain, self.least, self.root = inside, gain, least, root

    def feed(self, text: bytes) -> None:
        places, step, _, self.inside = scan(text, self.inside)
        if not len(step):
            return
        depth = self.gain + np.cumsum(step)
        low = int(depth.min())
        if low <= self.least:
            after = int(np.flatnonzero(depth == low)[-1]) + 1
            self.least, self.root = low, text[places[after]] if after < len(places) else None
        elif self.gain == self.least:
            self.root = text[places[0]]
        self.gain = int(depth[-1])

    def row(self) -> list:
        return [self.inside, self.gain, self.least, self.root]


def _ranges(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    files = spark.read.option("lineSep", "}").text(path if isinstance(path, str) else list(path))
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"),
                        F.col("_metadata.file_size").alias("size"), F.col("value").cast("binary").alias("part"))


def _grouped(ranges: DataFrame) -> DataFrame:
    """The same ranges, several to a task, one after another: as many tasks as keep the cores busy, more for much text."""
    spark = ranges.sparkSession
    size = int(str(ranges._jdf.queryExecution().optimizedPlan().collectLeaves().head().stats().sizeInBytes()))
    return ranges.coalesce(max(TASKS_A_CORE * spark.sparkContext.defaultParallelism, -(-size // TASK_BYTES)))


TASKS_A_CORE, TASK_BYTES = 4, 32 << 20


def _stretches(paths: list, starts: list) -> Iterator[tuple[str, int, int, int]]:
    """(path, start, first row, row after the last) of each range's stretch in a batch."""
    at = 0
    for i in range(1, len(paths) + 1):
        if i == len(paths) or (paths[i], starts[i]) != (paths[at], starts[at]):
            yield paths[at], starts[at], at, i
            at = i


def _summaries(ranges: DataFrame) -> DataFrame:
    """Per range its effect on both starts, in bytes its length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[list] = []
        now, effects = None, []
        for batch in batches:
            paths, starts, sizes, parts = (batch.column(i).to_pylist() for i in range(4))
            for path, start, at, end in _stretches(paths, starts):
                if now != (path, start):
                    now, effects = (path, start), [Effect(False), Effect(True)]
                    done.append([path, start, sizes[at], 0, effects])
                text = b"}".join([*parts[at:end], b""])
                done[-1][3] += len(text)
                for effect in effects:
                    effect.feed(text)
        if done:
            rows = [[p, s, z, n, *e[0].row(), *e[1].row()] for p, s, z, n, e in done]
            yield pa.RecordBatch.from_pylist([dict(zip(SUMMARY, r)) for r in rows], pa.schema(list(zip(SUMMARY, KINDS))))

    return ranges.mapInArrow(run, ", ".join(f"{n} {'string' if k == pa.string() else 'boolean' if k == pa.bool_() else 'long'}" for n, k in zip(SUMMARY, KINDS)))


SUMMARY = ["path", "start", "size", "bytes", "in0", "gain0", "least0", "root0", "in1", "gain1", "least1", "root1"]
KINDS = [pa.string(), *[pa.int64()] * 3, *[pa.bool_(), *[pa.int64()] * 3] * 2]


def _starts(summaries: DataFrame) -> DataFrame:
    """Where each range starts: inside a string, depth, whether in a list document; and whether the file's last record is
    without its brace. The ranges of one file are one small group."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.sort_by("start").to_pylist()
        over = sum(r["bytes"] for r in rows) - rows[0]["size"]
        short = over in (1, 1 - len(MARK))  # the reader may leave the mark out
        inside, depth, in_list, out = False, 0, False, []
        for i, r in enumerate(rows):
            out.append({"path": r["path"], "start": r["start"], "inside": inside, "depth": depth, "in_list": in_list,
                        "short": short and i == len(rows) - 1})
            k = int(inside)
            if depth + r[f"least{k}"] <= 0:  # it comes back to where documents start
                in_list = r[f"root{k}"] == OPEN_LIST
            inside, depth = r[f"in{k}"], max(0, depth + r[f"gain{k}"] - min(0, depth + r[f"least{k}"]))
        return pa.Table.from_pylist(out, pa.schema([("path", pa.string()), ("start", pa.int64()), ("inside", pa.bool_()),
                                                    ("depth", pa.int64()), ("in_list", pa.bool_()), ("short", pa.bool_())]))

    return summaries.groupBy("path").applyInArrow(run, "path string, start long, inside boolean, depth long, in_list boolean, short boolean")


class Cutter:
    """Cuts the rows out of a range's text: documents, or the items of list documents. A row is (text, whether it begins
    in the range, whether it ends there)."""

    def __init__(self, inside: bool, depth: int, in_list: bool):
        self.inside, self.depth, self.in_list = inside, depth, in_list
        self.began = depth == 0
        self.held: list[bytes] = []
        self.rows: list[tuple[bytes, bool, bool]] = []

    def _end(self, text: bytes, between: bool = False) -> None:
        """A row ends here; ``between`` documents there may be bare values, one after another."""
        whole = b"".join([*self.held, text])
        self.held = []
        if not self.began:
            self.rows.append((whole, False, True))
        elif between:
            self.rows += [(bare, True, True) for bare in BARE.findall(whole) if bare != b"null"]
        elif (bare := whole.strip(BLANKS)) and bare != b"null":
            self.rows.append((bare, True, True))
        self.began = True

    def feed(self, text: bytes) -> None:
        places, steps, commas, self.inside = scan(text, self.inside)
        depths = self.depth + np.cumsum(steps)
        under = np.minimum.accumulate(np.minimum(depths, 0)) if len(depths) else depths
        depths = depths - under  # a bracket too many closes nothing
        before = np.concatenate([[self.depth], depths])
        at_comma = before[np.searchsorted(places, commas)]
        near = depths <= 1
        events = sorted([*zip(places[near].tolist(), steps[near].tolist(), depths[near].tolist(), before[:-1][near].tolist()),
                         *((place, 0, depth, depth) for place, depth in zip(commas[at_comma <= 1].tolist(), at_comma[at_comma <= 1].tolist()))])
        done = 0
        for place, step, after, depth in events:
            if step == 0:
                if depth == 1 and self.in_list:
                    self._end(text[done:place])
                    done = place + 1
            elif step > 0 and after == 1:  # a document opens
                self._end(text[done:place], between=True)
                self.in_list = text[place] == OPEN_LIST
                done = place + self.in_list
            elif step < 0 and after == 0:  # it closes; a bracket that closes nothing is a row of its own
                self._end(text[done:place + (depth == 0 or not self.in_list)])
                done, self.in_list = place + 1, False
        self.depth = int(before[-1])
        self.held.append(text[done:])

    def finish(self) -> None:
        rest = b"".join(self.held)
        if self.depth == 0:
            self._end(b"", between=True)
        else:
            self.rows.append((rest, self.began, False))
        self.held = []


BARE = re.compile(rb'"(?:[^"\\]|\\.)*"|[^\s,]+')


def _cut(ranges: DataFrame) -> DataFrame:
    """(path, start, no, text, begins, ends) of every row or part of one; ranges come with their starts, records in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, cutter, no = None, None, 0

        def told() -> pa.RecordBatch:
            nonlocal no
            rows, cutter.rows = cutter.rows, []
            texts, begins, ends = zip(*rows) if rows else ((), (), ())
            n, no = no, no + len(rows)
            return pa.RecordBatch.from_arrays(
                [pa.array([now[0]] * len(rows), pa.string()), pa.array([now[1]] * len(rows), pa.int64()), pa.array(range(n, no), pa.int64()),
                 pa.array(texts, pa.binary()), pa.array(begins, pa.bool_()), pa.array(ends, pa.bool_())], ["path", "start", "no", "text", "begins", "ends"])

        def finished() -> pa.RecordBatch:
            if not now[2]:
                cutter.feed(b"}")  # of its last record
            cutter.finish()
            return told()

        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
            for path, start, at, end in _stretches(columns[0], columns[1]):
                first = now is None or now[:2] != (path, start)
                if first:
                    if cutter is not None:
                        yield finished()
                    inside, depth, in_list, short = (columns[k][at] for k in (3, 4, 5, 6))
                    now, cutter, no = (path, start, short), Cutter(inside, depth, in_list), 0
                text = b"}".join(columns[2][at:end])
                cutter.feed(text.removeprefix(MARK) if first and start == 0 else text if first else b"}" + text)
            if cutter is not None:
                yield told()
        if cutter is not None:
            yield finished()

    return ranges.select("path", "start", "part", "inside", "depth", "in_list", "short").mapInArrow(
        run, "path string, start long, no long, text binary, begins boolean, ends boolean")


def split_roots(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(path, text) of every row in files of JSON documents back to back: a document that is an object is a row, one that is
    a list gives its items, ``null`` gives none. The text is as it was written. Brackets that don't match spoil the rows they
    stand in: text that is no JSON is a row like any other, for the parser to tell. A file may have any size and need no line
    breaks, as long as its objects are small beside a task's memory; one without any closing brace is one range."""
    ranges = _grouped(_ranges(spark, path))
    starts = stored(_starts(_summaries(ranges)), "starts")
    if starts.count() * START_BYTES <= MOST_BYTES:  # a broadcast join keeps the records' order
        known = ranges.join(F.broadcast(starts), ["path", "start"])
    else:
        known = ranges.withColumn("nth", F.monotonically_increasing_id()).join(starts, ["path", "start"]).repartition(
            "path", "start").sortWithinPartitions("path", "start", "nth")
    parts = stored(_cut(known), "parts")
    whole = parts.where("begins and ends").select("path", "text")
    row = F.sum(F.col("begins").cast("int")).over(Window.partitionBy("path").orderBy("start", "no"))
    pieces = F.sort_array(F.collect_list(F.struct("start", "no", "text")))
    joined = parts.where("not (begins and ends)").withColumn("row", row).groupBy("path", "row").agg(pieces.alias("p")).select(
        "path", F.aggregate("p", F.lit(b""), lambda all, x: F.concat(all, x["text"])).alias("text"))
    rows = whole.unionByName(joined).select("path", F.btrim(F.col("text").cast("string"), F.lit(BLANKS.decode())).alias("text"))
    return rows.where(~F.col("text").isin("", "null"))


START_BYTES, MOST_BYTES = 200, 64 << 20  # of a range's start in memory, and of all that may be broadcast


def stored(df: DataFrame, name: str) -> DataFrame:
    """A table in the shared folder, so that what follows doesn't depend on the executors that made it."""
    path = f"{shared_folder(df.sparkSession)}/roots-{uuid4().hex}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
