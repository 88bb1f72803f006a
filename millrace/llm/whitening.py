"""Embedding whitening: the leading eigenvectors of the covariance by spectrum slicing.

Spark sums the exact covariance of integer entries; its size is the square of a vector's width. Of a shifted covariance
LDL' = V - sI the signs of D tell how many eigenvalues are above s. Such counts halve an interval until it holds one
eigenvalue, Rayleigh quotient iteration converges in it, and two more counts beside the value certify its number.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import fitted, stored

SCALE, SHIFT = 1024, 100_000
EXACT = 1 << 26  # centred entries below this are multiplied exactly
ALPHA = (1 + 17 ** 0.5) / 8  # of the pivot rule


def factor(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """P, LD and pivot widths of P A P' = L D L', with pivots of one or two rows chosen so that L stays bounded.

    Below its pivots the matrix returned holds L, on them D."""
    a = np.array(a, float)
    n, k = len(a), 0
    order, widths = np.arange(n), []

    def swap(i: int, j: int) -> None:
        if i != j:
            a[[i, j]] = a[[j, i]]
            a[:, [i, j]] = a[:, [j, i]]
            order[[i, j]] = order[[j, i]]

    while k < n:
        width, at = 1, k
        column = np.abs(a[k + 1:, k])
        if len(column) and column.max() > 0:
            r = k + 1 + int(column.argmax())
            most = column[r - k - 1]
            if abs(a[k, k]) < ALPHA * most:
                row = np.abs(a[r, k:])
                row[r - k] = 0
                other = row.max()
                if abs(a[k, k]) * other < ALPHA * most * most:
                    width, at = (1, r) if abs(a[r, r]) >= ALPHA * other else (2, r)
        swap(k + width - 1, at)
        rest = slice(k + width, n)
        pivot = a[k:k + width, k:k + width]
        if width == 1:
            if pivot[0, 0] != 0:
                low = a[rest, k] / pivot[0, 0]
                a[rest, rest] -= np.outer(low, a[rest, k])
                a[rest, k] = low
        else:
            low = np.linalg.solve(pivot, a[rest, k:k + 2].T).T
            a[rest, rest] -= low @ a[rest, k:k + 2].T
            a[rest, k:k + 2] = low
        widths.append(width)
        k += width
    return order, a, widths


def above(a: np.ndarray, s: float) -> int:
    """How many eigenvalues of ``a`` are greater than ``s``: the positive signs of D. A pivot of two rows has one of each."""
    _, ld, widths = factor(a - s * np.eye(len(a)))
    count = k = 0
    for width in widths:
        count += 1 if width == 2 else int(ld[k, k] > 0)
        k += width
    return count


def solve(factors: tuple[np.ndarray, np.ndarray, list[int]], b: np.ndarray, tiny: float) -> np.ndarray:
    """x of A x = b from the factors of A; a pivot that is zero counts as ``tiny``."""
    order, ld, widths = factors
    x, k = b[order].copy(), 0
    for width in widths:
        x[k + width:] -= ld[k + width:, k:k + width] @ x[k:k + width]
        pivot = ld[k:k + width, k:k + width]
        x[k:k + width] = x[k:k + width] / (pivot[0, 0] if abs(pivot[0, 0]) > tiny else tiny) if width == 1 \
            else np.linalg.solve(pivot, x[k:k + width])
        k += width
    for width in reversed(widths):
        k -= width
        x[k:k + width] -= ld[k + width:, k:k + width].T @ x[k + width:]
    out = np.empty_like(x)
    out[order] = x
    return out


def _against(v: np.ndarray, found: list[np.ndarray]) -> np.ndarray:
    """The unit part of v that is orthogonal to what was found."""
    for _ in range(2):
        for u in found:
            v = v - (u @ v) * u
        v = v / np.linalg.norm(v)
    return v


def _converge(a: np.ndarray, low: float, high: float, found: list[np.ndarray], seed: int, eps: float) -> tuple[float, np.ndarray]:
    """Rayleigh quotient iteration from the middle of an interval. Where a step leads out of the interval, the shift
    goes back to its middle, which makes a step of inverse iteration."""
    v = _against(np.random.default_rng(seed).standard_normal(len(a)), found)
    s, middle = (low + high) / 2, (low + high) / 2
    for _ in range(40):
        v = _against(solve(factor(a - s * np.eye(len(a))), v, eps), found)
        s = float(v @ a @ v)
        if np.linalg.norm(a @ v - s * v) <= 4 * eps:
            break
        if not low <= s <= high:
            s = middle
    return float(v @ a @ v), v


@dataclass
class Components:
    values: list[float]  # falling
    vectors: np.ndarray  # one in a row
    certified: list[bool]  # counts on both sides of a value agree with its number


def leading(a: np.ndarray, most: int) -> Components:
    """The eigenpairs of the ``most`` greatest eigenvalues above the rounding level. Values that agree within rounding are
    one cluster, of which any orthonormal basis is given."""
    n = len(a)
    size = float(np.abs(a).sum(axis=1).max()) if n else 0.0
    if size == 0:
        return Components([], np.zeros((0, n)), [])
    a = a / size
    eps = np.finfo(float).eps * max(n, 8)
    want = min(most, above(a, 4 * eps))
    values, vectors, certified = [], [], []
    slices = [(4 * eps, 1.0 + eps, above(a, 4 * eps), 0)]  # low, high, eigenvalues above low, above high
    while slices and len(values) < want:
        low, high, more, fewer = slices.pop()
        if more == fewer:
            continue
        if more - fewer > 1 and high - low > 8 * eps:
            middle = (low + high) / 2
            count = above(a, middle)
            slices += [(low, middle, more, count), (middle, high, count, fewer)]
            continue
        while more - fewer == 1:
            value, v = _converge(a, low, high, vectors, fewer, eps)
            if low - 4 * eps <= value <= high + 4 * eps or high - low <= 8 * eps:
                break
            middle = (low + high) / 2  # it went to a neighbour: a smaller interval
            low, high = (middle, high) if above(a, middle) == more else (low, middle)
        first = len(values)
        for _ in range(min(more - fewer, want - first)):
            if more - fewer > 1:
                value, v = _converge(a, low, high, vectors, len(values), eps)
            values.append(value)
            vectors.append(v)
        near = 16 * eps
        certified += [above(a, x - near) >= more and above(a, x + near) <= fewer for x in values[first:]]
    order = np.argsort(values)[::-1]
    return Components([values[i] * size for i in order], np.array([vectors[i] for i in order]), [certified[i] for i in order])


def entries(batch: pa.RecordBatch, width: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(which rows are kept, their integer entries as a matrix). Vectors shorter than ``width`` are filled up with zeros."""
    column = batch.column(batch.schema.get_field_index("embedding"))
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten()
    holes = column.is_null().to_numpy(zero_copy_only=False)
    sizes = np.where(holes, 0, sizes)
    numbers = flat.to_numpy(zero_copy_only=False).astype(float)
    row = np.repeat(np.arange(len(sizes)), sizes)
    keep = ~holes
    keep[row[~np.isfinite(numbers)]] = False
    width = int(sizes[keep].max(initial=0)) if width is None else width
    matrix = np.zeros((len(sizes), width))
    nth = np.arange(len(numbers)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    inside = keep[row]
    matrix[row[inside], nth[inside]] = numbers[inside]
    scaled = np.clip(np.floor(matrix[keep] * SCALE), -(2.0 ** 61), 2.0 ** 61)
    return keep, scaled.astype(np.int64) + SHIFT


def _totals(vectors: DataFrame) -> tuple[int, list[int], int]:
    """(vectors kept, sum of each dimension, the widest spread of a dimension). Sums are exact."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, x = entries(batch)
            if not keep.any():
                continue
            high, low = np.divmod(x, 1 << 31)  # in two parts, so that no sum runs over
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(-1, x.shape[1]), pa.int32()),
                 pa.array(np.concatenate([[len(x)], low.sum(axis=0)]), pa.int64()),
                 pa.array(np.concatenate([[0], high.sum(axis=0)]), pa.int64()),
                 pa.array(np.concatenate([[0], x.min(axis=0)]), pa.int64()),
                 pa.array(np.concatenate([[0], x.max(axis=0)]), pa.int64())], ["d", "low", "high", "least", "most"])

    total = vectors.mapInArrow(run, "d int, low long, high long, least long, most long").groupBy("d").agg(
        F.sum(F.col("low").cast("decimal(38,0)")).alias("low"), F.sum(F.col("high").cast("decimal(38,0)")).alias("high"),
        F.min("least").alias("least"), F.max("most").alias("most")).orderBy("d").collect()
    if not total:
        return 0, [], 0
    sums = [int(r["low"]) + (int(r["high"]) << 31) for r in total]
    return sums[0], sums[1:], max((r["most"] - r["least"] for r in total[1:]), default=0)


def _covariance(vectors: DataFrame, n: int, sums: list[int], spread: int) -> np.ndarray:
    """The covariance of the entries, divisor n. Entries are centred by the nearest integer to their mean before they are
    multiplied, so the sums of products are exact; what the centre lacks is taken off in exact fractions."""
    width, centre = len(sums), [round(Fraction(s, n)) for s in sums]
    exact = spread < EXACT
    told = np.array(centre, np.int64)
    upper = np.triu_indices(width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros((width, width)), 0
        limit = max(1, (1 << 53) // max(1, spread * spread)) if exact else 1 << 62  # rows whose sums a double holds

        def told_sums() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(upper[0], pa.int32()), pa.array(upper[1], pa.int32()), pa.array(total[upper], pa.float64())], ["i", "j", "v"])

        for batch in batches:
            _, x = entries(batch, width)
            y = (x - told).astype(float)
            at = 0
            while at < len(y):
                part = y[at:at + limit - rows]
                total += part.T @ part
                rows, at = rows + len(part), at + len(part)
                if rows >= limit:
                    yield told_sums()
                    total[:], rows = 0, 0
        if rows:
            yield told_sums()

    kind = "decimal(38,0)" if exact else "double"
    found = vectors.mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum(F.col("v").cast(kind)).alias("v")).collect()
    out = np.zeros((width, width))
    off = [s - n * c for s, c in zip(sums, centre)]
    for r in found:
        i, j = r["i"], r["j"]
        value = Fraction(int(r["v"]) * n - off[i] * off[j], n * n) if exact else r["v"] / n - (off[i] / n) * (off[j] / n)
        out[i, j] = out[j, i] = float(value)
    return out


def whiten(vectors: DataFrame, most: int = 8) -> DataFrame:
    """Per vector and component: vec_id, component (from 1), n (vectors of the fit list), deviation (sum of (n x - S)^2 over
    the dimensions, exact), whitened, explained, identity_error, certified (the counts agree with the component's number).

    Vectors that are null or hold null or non-finite entries are dropped. Repeated rows and rows without an id are vectors
    like any other. A vector shorter than the longest is filled up with zeros; entries beyond 2^61 / 1024 stop there. An
    eigenvalue that is zero within rounding has no component, so fewer than ``most`` may come: none at all from an empty
    table, from one vector or from equal vectors. A deviation over 2^63 - 1 is null. Only vec_id and embedding are looked at."""
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    only = rows.select("embedding")
    n, sums, spread = _totals(only)
    shape = rows.schema["vec_id"].dataType.simpleString()
    ending = "component int, n long, deviation long, whitened double, explained double, identity_error double, certified boolean"
    if n == 0:
        return rows.sparkSession.createDataFrame([], f"vec_id {shape}, {ending}")
    covariance = _covariance(only, n, sums, spread)
    found = fitted(leading, Components, rows.sparkSession, covariance, most)
    trace = float(np.trace(covariance))
    width, k = len(sums), len(found.values)
    centre = np.array([round(Fraction(s, n)) for s in sums], np.int64)
    off = [s - n * int(c) for s, c in zip(sums, centre)]
    lack = np.array([float(Fraction(o, n)) for o in off])
    if k == 0:
        return rows.sparkSession.createDataFrame([], f"vec_id {shape}, {ending}")
    axes = (found.vectors / np.sqrt(found.values)[:, None]).T
    squares = sum(o * o for o in off)
    safe = spread < EXACT and max(map(abs, off)) * spread * width < 1 << 62

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        towards = np.array(off, np.int64) if safe else np.array(off, object)
        for batch in batches:
            keep, x = entries(batch, width)
            y = x - centre
            white = (y - lack) @ axes
            y = y if safe else y.astype(object)
            deviation = [n * n * a - 2 * n * b + squares for a, b in zip((y * y).sum(axis=1).tolist(), (y @ towards).tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("vec_id")).filter(pa.array(keep)),
                 pa.array([d if d < 1 << 63 else None for d in deviation], pa.int64()),
                 pa.FixedSizeListArray.from_arrays(pa.array(white.ravel()), k).cast(pa.list_(pa.float64()))], ["vec_id", "deviation", "white"])

    white = stored(rows.mapInArrow(project, f"vec_id {shape}, deviation long, white array<double>"), "whitened")
    at = [F.col("white")[i] for i in range(k)]
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    got = white.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(at)], *[F.avg(at[i] * at[j]).alias(f"p{i}_{j}") for i, j in pairs]).first()
    error = max(abs(got[f"p{i}_{j}"] - got[f"m{i}"] * got[f"m{j}"] - (i == j)) for i, j in pairs)
    facts = F.array(*[F.struct(F.lit(e / trace).alias("explained"), F.lit(c).alias("certified")) for e, c in zip(found.values, found.certified)])
    return white.select("vec_id", "deviation", F.posexplode(F.arrays_zip("white", facts.alias("facts"))).alias("at", "x")).select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation",
        F.col("x.white").alias("whitened"), F.col("x.facts.explained").alias("explained"),
        F.lit(float(error)).alias("identity_error"), F.col("x.facts.certified").alias("certified"))
