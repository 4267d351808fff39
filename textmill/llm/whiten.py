"""Embedding whitening by bit-sliced scatter.

Entries become integers. Of the distinct integer vectors, taken in blocks of rows, each
dimension is shifted to begin at zero and cut into bit planes; a plane is packed over the rows
of the block, 64 to a word. The bits that two planes share, counted by AND and popcount and
weighted by both planes' places, add up to the exact cross-product of two dimensions. Sums of
blocks are added by Spark as decimals, centred as integers on the driver (one number for each
pair of dimensions, whatever the number of rows) and only then divided for ``eigh``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.llm import base

#: Bytes of integers in a block of rows; its planes take at most as many again.
BLOCK_BYTES = 16 << 20
#: Whole numbers beyond this cannot be shifted and summed as 64-bit integers.
LARGEST = 1 << 60
SUMS, PAIRS = "j int, k int, total decimal(38,0)", "j int, k int, total double"


def usable(vector: Column) -> Column:
    """Not null, not empty, and without null, NaN or infinite entries."""
    fine = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    return F.coalesce((F.size(vector) > 0) & F.forall(vector, lambda c: F.coalesce(fine(c.cast("double")), F.lit(False))), F.lit(False))


def integers(vector: Column, scale: int = 64, shift: int = 1_000_000) -> Column:
    """floor(scale * c) + shift of every entry, as long."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * float(scale)) + F.lit(shift).cast("long"))


def planes(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bit planes of the columns of ``x`` (rows x dimensions, int64), each column shifted
    by its least entry: (words: a row for each plane, plane's dimension, plane's place, shifts)."""
    low = x.min(axis=0)
    y = np.ascontiguousarray((x - low).T).view(np.uint64)
    dims, places = [], []
    packed = []
    for j, bits in enumerate(int(v).bit_length() for v in y.max(axis=1)):
        for b in range(bits):
            bit = ((y[j] >> np.uint64(b)) & np.uint64(1)).astype(np.uint8)
            packed.append(np.packbits(np.pad(bit, (0, -len(bit) % 64))).view(np.uint64))
            dims.append(j)
            places.append(b)
    words = np.array(packed) if packed else np.zeros((0, (len(x) + 63) // 64), np.uint64)
    return words, np.array(dims, np.int64), np.array(places, np.int64), low


def scatter(x: np.ndarray) -> tuple[int, list[int], list[list[int]]]:
    """Rows, sums and (for j <= k) cross-products of the columns of ``x``, exactly."""
    words, dim, place, low = planes(x)
    n, d = x.shape
    weight = np.array([1 << int(b) for b in place], object)
    low = [int(v) for v in low]
    sums = [0] * d  # of the shifted columns
    for p, c in enumerate(np.bitwise_count(words).sum(axis=1, dtype=np.int64).tolist()):
        sums[dim[p]] += c * weight[p]
    shared = [[0] * d for _ in range(d)]
    first = np.searchsorted(dim, np.arange(d))  # of each dimension's planes
    for p in range(len(dim)):
        j = int(dim[p])
        others = words[first[j] :]
        counts = np.bitwise_count(others & words[p]).sum(axis=1, dtype=np.int64).astype(object) * weight[first[j] :] * weight[p]
        held, begin = np.unique(dim[first[j] :], return_index=True)
        for k, total in zip(held.tolist(), np.add.reduceat(counts, begin)):
            shared[j][k] += total
    cross = [[shared[j][k] + low[j] * sums[k] + low[k] * sums[j] + n * low[j] * low[k] if j <= k else 0 for k in range(d)] for j in range(d)]
    return n, [s + n * m for s, m in zip(sums, low)], cross


def blocks(batches: Iterator[pa.RecordBatch], at: int = 0) -> Iterator[np.ndarray]:
    """The vectors of a column of lists as matrices of about ``BLOCK_BYTES``."""
    held, rows = [], 0
    for b in batches:
        if b.num_rows:
            lists = b.column(at)
            x = lists.flatten().to_numpy().reshape(len(lists), -1)
            step = max(64, BLOCK_BYTES // (8 * x.shape[1]))
            for lo in range(0, len(x), step):
                held.append(x[lo : lo + step])
                rows += len(held[-1])
                if rows >= step:
                    yield np.concatenate(held)
                    held, rows = [], 0
    if held:
        yield np.concatenate(held)


@dataclass
class Whitening:
    """Moments of the fit list (n, integer sums) and unit eigenvectors (columns of ``axes``)."""

    n: int
    sums: list[int]
    axes: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float | None = None

    @property
    def matrix(self) -> np.ndarray:
        return self.axes / np.sqrt(self.values)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, as 64-bit integers where they fit."""
        sums = np.array(self.sums, object)
        most = self.n * max(int(np.abs(x).max(initial=0)), 1) + max(map(abs, self.sums))
        return x * np.int64(self.n) - sums.astype(np.int64) if most < 1 << 62 else x.astype(object) * self.n - sums

    def apply(self, x: np.ndarray) -> np.ndarray:
        """x - S / n on every component, over the root of its eigenvalue."""
        return (self.centred(x) / self.n).astype(float) @ self.matrix


def vectors(rows: DataFrame, vector: str) -> DataFrame:
    """The usable vectors of ``rows`` as integers, each distinct one once: the fit list. All
    must be of one length."""
    x = rows.where(usable(F.col(vector))).select(integers(F.col(vector)).alias("x"))
    return x.distinct()  # combined in each map task first, so copies of one vector do not meet in one task


def fit(rows: DataFrame, vector: str = "embedding", components: int = 16) -> Whitening:
    """Exact moments of all distinct vectors, and up to ``components`` eigenpairs of their
    covariance by falling eigenvalue. Directions without variance (under 1e-11 of the largest)
    cannot be whitened and are left out; a table without usable vectors gives none at all.
    The sign of a component makes its largest entry positive."""
    distinct = base.stage(vectors(rows, vector), "whiten-fit")
    sizes = [r[0] for r in distinct.select(F.size("x")).distinct().limit(3).collect()]
    if len(sizes) > 1:
        raise ValueError(f"vectors of several lengths: {sorted(sizes)}")
    if not sizes:
        return Whitening(0, [], np.zeros((0, 0)), np.zeros(0), 0.0)
    d = sizes[0]
    if not distinct.where(F.exists("x", lambda v: F.abs(v) > LARGEST)).isEmpty():
        raise ValueError(f"entries beyond {LARGEST} cannot be summed exactly")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in blocks(batches):
            n, sums, cross = scatter(x)
            j, k, total = [-1, *[-1] * d], [-1, *range(d)], [n, *sums]  # j = -1: sums, and the number of rows
            for a in range(d):
                j += [a] * (d - a)
                k += range(a, d)
                total += cross[a][a:]
            yield pa.RecordBatch.from_arrays([pa.array(j, pa.int32()), pa.array(k, pa.int32()), pa.array(map(Decimal, total), pa.decimal128(38, 0))], ["j", "k", "total"])

    parts = distinct.mapInArrow(base.tidy(run), SUMS).groupBy("j", "k").agg(F.sum("total").alias("total"))
    total = {(r["j"], r["k"]): int(r["total"]) for r in parts.collect()}
    n, sums = total[-1, -1], [total[-1, k] for k in range(d)]
    # n * n * covariance, in integers
    cov = np.array([[(n * total[min(j, k), max(j, k)] - sums[j] * sums[k]) / (n * n) for k in range(d)] for j in range(d)], float)
    values, axes = np.linalg.eigh(cov)
    keep = [i for i in range(d - 1, -1, -1) if values[i] > 1e-11 * max(values[-1], 0.0)][:components]
    axes = axes[:, keep]
    axes = axes * np.where(axes[np.abs(axes).argmax(axis=0), np.arange(len(keep))] < 0, -1.0, 1.0)
    model = Whitening(n, sums, axes, values[keep], float(np.trace(cov)))
    model.identity_error = identity_error(distinct, model)
    return model


def identity_error(distinct: DataFrame, model: Whitening) -> float | None:
    """The largest absolute entry of the covariance of the whitened fit list minus the
    identity, from the whitened vectors themselves."""
    m = len(model.values)
    if not m:
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in blocks(batches):
            w = model.apply(x)
            products, sums = w.T @ w, w.sum(axis=0)
            j, k = np.triu_indices(m)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.full(m, -1), j]), pa.int32()), pa.array(np.concatenate([np.arange(m), k]), pa.int32()), pa.array(np.concatenate([sums, products[j, k]]))], ["j", "k", "total"])

    parts = distinct.mapInArrow(base.tidy(run), PAIRS).groupBy("j", "k").agg(F.sum("total").alias("total")).collect()
    total = {(r["j"], r["k"]): r["total"] / model.n for r in parts}
    return max(abs(total[j, k] - total[-1, j] * total[-1, k] - (j == k)) for j in range(m) for k in range(j, m))


def transform(rows: DataFrame, model: Whitening, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error): a row for each
    usable vector and component. deviation, the sum over dimensions of (n * x - S) squared, is
    exact, as decimal(38,0). Rows whose vector is null, empty or holds null or non-finite
    entries go; repeated rows and null keys stay as they are, one by one; an empty table, or
    one without variance, gives no rows."""
    x = rows.select(F.col(key).alias("key"), integers(F.when(usable(F.col(vector)), F.col(vector))).alias("x")).where("x IS NOT NULL")
    kind = dict(x.dtypes)["key"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = len(model.values)
        for b in batches:
            if not b.num_rows or not m:
                continue
            values = b.column(1).flatten().to_numpy().reshape(b.num_rows, -1)
            off = model.centred(values)
            most = max(abs(int(off.max())), abs(int(off.min())))
            if off.dtype == object or most * most * off.shape[1] >= 1 << 63:
                squares = pa.array([Decimal(int(v)) for v in (off.astype(object) ** 2).sum(axis=1)], pa.decimal128(38, 0))
            else:
                squares = pa.array((off * off).sum(axis=1)).cast(pa.decimal128(38, 0))
            white = pa.ListArray.from_arrays(pa.array(np.arange(0, m * b.num_rows + 1, m), pa.int32()), pa.array(model.apply(values).ravel()))
            yield pa.RecordBatch.from_arrays([b.column(0), squares, white], ["key", "deviation", "white"])

    share = [float(v / model.trace) for v in model.values]
    out = x.mapInArrow(base.tidy(run), f"key {kind}, deviation decimal(38,0), white array<double>")
    out = out.select("key", "deviation", F.posexplode("white").alias("at", "whitened"))
    explained = F.element_at(F.array(*map(F.lit, share)), F.col("at") + 1) if share else F.lit(None).cast("double")
    return out.select(
        F.col("key").alias(key), (F.col("at") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        explained.alias("explained"), F.lit(model.identity_error).cast("double").alias("identity_error"),
    )
