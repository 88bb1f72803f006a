"""Quality rules: exact counts per text, and robust outliers among them.

Each (lang, source) gets a minimum-covariance-determinant estimate of its transformed counts: starting from medians and
median deviations, concentration steps keep the ``part`` of the rows that lie closest and take mean and covariance anew,
from all rows of the group, as sums that Spark adds up. Rows beyond a chi-square quantile of the Mahalanobis distance
are rejected.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import bounded, mix64, raw_texts, small_batches, stored

SYMBOLS = b"#*$%&|<>"
WINDOW = 8
FEATURES = ("f0", "f1", "f2", "f3", "f4")
STEPS = 3
LEAST = 50  # rows that a group needs for an estimate of its own; smaller ones use the estimate over all rows
CUT = 25.744821  # chi-square quantile 0.9999 for five values
BINS = 32  # bins for each doubling of the squared distance
GROUPS = 100_000
ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63,
                0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], np.uint64)


class Ids(dict):
    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(self) < 300_000:
            self[word] = h
        return h


def repeated_words(words: list[bytes], ids: Ids) -> int:
    """Words inside an 8-word window that occurs at least twice in the text."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    h = np.fromiter(map(ids.__getitem__, words), np.uint64, len(words))
    s = h[:n] * ODD[0]
    for k in range(1, WINDOW):
        s += h[k : k + n] * ODD[k]
    _, inverse, counts = np.unique(mix64(s), return_inverse=True, return_counts=True)
    at = np.flatnonzero(counts[inverse] > 1)
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + WINDOW, -1)
    return int((np.cumsum(cover)[:-1] > 0).sum())


def duplicate_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x.split()] if b"\n" in text else []
    return len(lines) - len(set(lines))


def counts(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, lang, source and n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of the whole text;
    a null text has none of any."""
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = Ids()
        for batch in small_batches(batches):
            rows = []
            for t in raw_texts(batch):
                t = t or b""
                words = t.split()
                inner = b"".join(words)
                continued = len(inner.translate(None, CONTINUED))
                rows.append((len(words), continued, len(t) - len(t.translate(None, SYMBOLS)),
                             duplicate_lines(t), repeated_words(words, ids)))
            columns = np.array(rows, np.int64).reshape(-1, 5)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(3)], *[pa.array(columns[:, i]) for i in range(5)]],
                ["doc_id", "lang", "source", *names])

    schema = docs.select("doc_id", "lang", "source").schema
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
    return docs.select("doc_id", "lang", "source", "text").mapInArrow(run, f"{kinds}, " + ", ".join(f"{x} long" for x in names))


CONTINUED = bytes(range(0x80, 0xC0))  # UTF-8 bytes that continue a code point


def features(rows: DataFrame) -> DataFrame:
    n = F.greatest("n_words", F.lit(1))
    return rows.withColumns({
        "f0": F.log1p(F.col("n_words").cast("double")), "f1": F.log1p(F.col("word_chars") / n),
        "f2": F.sqrt(F.col("n_symbols") / n), "f3": F.sqrt(F.col("n_dup_lines") / n),
        "f4": F.sqrt(F.col("n_repeat_words") / n)})


def _joined(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """Rows with their group's estimate; groups are few beside rows, and go to every executor while they are."""
    return rows.join(F.broadcast(estimates) if bounded(estimates, GROUPS) else estimates, "g")


def _distance() -> Column:
    """Squared Mahalanobis distance from centre and inverse covariance ``c`` (5 + 25 numbers, rows first)."""
    d = [F.col(f) - F.col("c")[i] for i, f in enumerate(FEATURES)]
    total = F.lit(0.0)
    for i in range(5):
        for j in range(i, 5):
            total = total + d[i] * d[j] * F.col("c")[5 + 5 * i + j] * (1.0 if i == j else 2.0)
    return F.greatest(total, F.lit(0.0))


def _consistency(part: float) -> float:
    """What makes the covariance of the closest ``part`` of five normal values that of all of them."""
    def below(q: float) -> float:
        return math.erf(math.sqrt(q / 2)) - math.sqrt(2 * q / math.pi) * math.exp(-q / 2) * (1 + q / 3)

    low, high = 0.0, 100.0
    for _ in range(60):
        q = (low + high) / 2
        low, high = (q, high) if below(q) < part else (low, q)
    return part / (part - q**2.5 * math.exp(-q / 2) / (2**2.5 * math.gamma(3.5)))


def _estimates(sums: DataFrame, part: float) -> DataFrame:
    """(g, c) from (g, n, s): sums of values and of their products, one row per group."""
    pairs = [(i, j) for i in range(5) for j in range(i, 5)]
    factor = _consistency(part)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for n, s in zip(batch.column("n").to_pylist(), batch.column("s").to_pylist()):
                mean = np.array(s[:5]) / n
                cov = np.zeros((5, 5))
                for k, (i, j) in enumerate(pairs):
                    cov[i, j] = cov[j, i] = s[5 + k] / n - mean[i] * mean[j]
                out.append([*mean, *_inverse(cov * factor).ravel()])
            yield pa.RecordBatch.from_arrays([batch.column("g"), pa.array(out, pa.list_(pa.float64()))], ["g", "c"])

    return sums.select("g", "n", "s").mapInArrow(run, "g string, c array<double>")


FLOOR = np.array([0.2, 0.05, 0.05, 0.05, 0.05])  # least standard deviation: constant values don't make outliers of all else


def _inverse(cov: np.ndarray) -> np.ndarray:
    return np.linalg.inv(cov + np.diag(FLOOR**2)).round(9)


def _sums(rows: DataFrame) -> DataFrame:
    values = [F.sum(f) for f in FEATURES] + [F.sum(F.col(FEATURES[i]) * F.col(FEATURES[j])) for i in range(5) for j in range(i, 5)]
    return rows.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.array(*values).alias("s"))


def _bin(value: Column) -> Column:
    return F.floor(F.log2(value + 1e-9) * BINS)


def _closest(rows: DataFrame, part: float) -> DataFrame:
    """The rows of each group up to the bin of distance that holds its ``part`` quantile."""
    binned = rows.withColumn("bin", _bin(_distance()))
    bins = binned.groupBy("g", "bin").agg(F.count(F.lit(1)).alias("k"))
    order = Window.partitionBy("g").orderBy("bin")
    limit = stored(bins.withColumn("upto", F.sum("k").over(order)).withColumn(
        "all", F.sum("k").over(Window.partitionBy("g"))).where(F.col("upto") >= F.col("all") * part).groupBy("g").agg(
        F.min("bin").alias("limit")), "limits")
    return _joined(binned, limit).where(F.col("bin") <= F.col("limit"))


def _start(rows: DataFrame) -> DataFrame:
    """(g, c) from medians and median deviations, by whole-group histograms of a thousandth."""
    long = rows.select("g", F.posexplode(F.array(*FEATURES)).alias("i", "v")).withColumn("v", F.round("v", 3))

    def median(values: DataFrame, name: str) -> DataFrame:
        bins = values.groupBy("g", "i", "v").agg(F.count(F.lit(1)).alias("k"))
        key = Window.partitionBy("g", "i")
        return bins.withColumn("upto", F.sum("k").over(key.orderBy("v"))).withColumn("all", F.sum("k").over(key)).where(
            F.col("upto") * 2 >= F.col("all")).groupBy("g", "i").agg(F.min("v").alias(name))

    middle = stored(median(long, "m"), "medians")
    few = F.broadcast(middle) if bounded(middle, 5 * GROUPS) else middle
    spread = median(long.join(few, ["g", "i"]).withColumn("v", F.abs(F.col("v") - F.col("m"))), "d")
    both = middle.join(spread, ["g", "i"]).groupBy("g").agg(F.array_sort(F.collect_list(F.struct("i", "m", "d"))).alias("x"))
    width = [F.greatest(F.col("x")[i]["d"] * 1.4826, F.lit(float(FLOOR[i]))) for i in range(5)]
    return both.select("g", F.array(*[F.col("x")[i]["m"] for i in range(5)], *[
        (1 / (width[i] * width[i])) if i == j else F.lit(0.0) for i in range(5) for j in range(5)]).alias("c"))


def verdicts(docs: DataFrame, part: float = 0.75, cut: float = CUT) -> DataFrame:
    """Per row of docs: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, distance, kept.

    A text fails the base rules with under 20 words or with over 30 of 100 words in repeated windows; null and empty
    texts do. Only rows that pass are used for the estimates. A null lang or source is a value of its own; groups of
    fewer than 50 such rows are measured by the estimate over all rows. Equal rows get equal verdicts; an empty table
    gives an empty one."""
    base = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    name = F.concat_ws("\u0001", *[F.when(F.col(c).isNull(), "n").otherwise(F.concat(F.lit("v"), F.col(c))) for c in ("lang", "source")])
    rows = stored(features(counts(docs)).withColumn("base_failed", base).withColumn("own", name), "counts")
    passed = rows.where(~F.col("base_failed"))
    sizes = stored(passed.groupBy(F.col("own").alias("o")).agg(F.count(F.lit(1)).alias("k")).where(F.col("k") >= LEAST), "groups")
    sizes = F.broadcast(sizes) if bounded(sizes, GROUPS) else sizes
    named = rows.join(sizes, F.col("own") == F.col("o"), "left").withColumn("g", F.coalesce("o", F.lit(""))).drop("own", "o", "k")
    # every passing row also counts for the estimate over all, under the empty name
    fit = named.where(~F.col("base_failed")).select(F.explode(F.array_distinct(F.array("g", F.lit("")))).alias("g"), *FEATURES)
    estimates = stored(_start(fit), "start")
    for step in range(STEPS):
        estimates = stored(_estimates(_sums(_closest(_joined(fit, estimates), part)), part), f"step-{step}")
    measured = named.join(F.broadcast(estimates) if bounded(estimates, GROUPS) else estimates, "g", "left")
    return measured.withColumn("distance", F.when(F.col("c").isNotNull(), _distance())).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "distance",
        (~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= cut)).alias("kept"))
