"""Embedding whitening: an exact covariance from bit planes, its eigenvectors, whitened rows.

Every entry becomes an integer. Each dimension is shifted to its own minimum, and its bits are
packed across rows into words, one plane for each bit. The number of ones that two planes share,
weighted by both bits, sums to the cross-product of two dimensions without any rounding. A plane
of ones for each row gives the sums and the count in the same way. The sums are centred as
integers, so the covariance is rounded once, just before ``eigh``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE, SHIFT = 1024, 100_000  # an entry c becomes floor(SCALE * c) + SHIFT
# Scaled entries beyond this are held at it, so that they fit 64 bits.
LARGEST = float(1 << 61)
COMPONENTS = 8
# A component counts as one without variance at this share of the trace.
NO_VARIANCE = 1e-12
LIMB = 20  # bits of a partial sum that travel in one row, so that sums of rows never overflow

WHITENED = (
    "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, "
    "identity_error double"
)


def usable(vector: Column) -> Column:
    """Whether a vector is not null and all its entries are finite numbers."""
    odd = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(odd, F.lit(False))


def vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id and the double entries of the rows that take part."""
    vector = rows[vector_col].cast("array<double>")
    return rows.select(rows[id_col].cast("long").alias("vec_id"), vector.alias("v")).filter(usable(F.col("v")))


def integers(column: pa.Array, dims: int) -> np.ndarray:
    """The integer of every entry, one row for each vector; missing last entries count as 0.0."""
    lengths = np.diff(column.offsets.to_numpy())
    entries = column.flatten().to_numpy(zero_copy_only=False)
    whole = np.clip(np.floor(SCALE * entries), -LARGEST, LARGEST).astype(np.int64) + SHIFT
    if len(lengths) and (lengths == dims).all():
        return whole.reshape(len(lengths), dims)
    out = np.full((len(lengths), dims), SHIFT, dtype=np.int64)
    out[np.arange(dims) < lengths[:, None]] = whole
    return out


def _columns(batch: pa.RecordBatch) -> tuple[pa.Array, pa.Array]:
    return batch.column("vec_id"), batch.column("v")


@dataclass
class Ranges:
    """How many vectors there are, and the smallest and largest integer of each dimension."""

    n: int
    low: np.ndarray
    high: np.ndarray


def ranges(rows: DataFrame) -> Ranges:
    """One scan; the driver gets a row for each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, low, high, seen = 0, np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
        for batch in batches:
            _, column = _columns(batch)
            if not len(column):
                continue
            lengths = np.diff(column.offsets.to_numpy())
            dims = int(lengths.max())
            x = integers(column, dims)
            has = (lengths[:, None] > np.arange(dims)).sum(axis=0)
            if dims > len(low):
                more = dims - len(low)
                low, high = np.pad(low, (0, more), constant_values=SHIFT), np.pad(high, (0, more), constant_values=SHIFT)
                low[-more:], high[-more:] = x[:, -more:].min(axis=0), x[:, -more:].max(axis=0)
                seen = np.pad(seen, (0, more))
            n += len(x)
            low[:dims] = np.minimum(low[:dims], x.min(axis=0))
            high[:dims] = np.maximum(high[:dims], x.max(axis=0))
            seen[:dims] += has
        dim = np.arange(-1, len(low))
        columns = [dim, np.r_[0, low], np.r_[0, high], np.r_[n, seen]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["dim", "low", "high", "n"])

    parts = rows.select("vec_id", "v").mapInArrow(run, "dim long, low long, high long, n long")
    found = parts.groupBy("dim").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n")).collect()
    by_dim = {r.dim: r for r in found}
    n = by_dim[-1].n if -1 in by_dim else 0
    low, high = [], []
    for i in range(len(by_dim) - 1):
        r = by_dim[i]
        whole = r.n == n  # else a shorter vector has 0.0 there
        low.append(r.low if whole else min(r.low, SHIFT))
        high.append(r.high if whole else max(r.high, SHIFT))
    return Ranges(n, np.array(low, dtype=np.int64), np.array(high, dtype=np.int64))


def bit_planes(y: np.ndarray, bits: list[int]) -> np.ndarray:
    """Planes of the bits of each column of unsigned ``y``, packed across rows into 64-bit words.

    Bit p of column i is plane ``sum(bits[:i]) + p``.
    """
    words = -(-len(y) // 64)
    out = np.zeros((sum(bits), words * 8), dtype=np.uint8)
    first = np.r_[0, np.cumsum(bits)]
    for p in range(max(bits, default=0)):
        wide = np.array([i for i, b in enumerate(bits) if b > p])
        packed = np.packbits(((y[:, wide] >> np.uint64(p)) & np.uint64(1)).astype(np.uint8).T, axis=1)
        out[first[wide] + p, : packed.shape[1]] = packed
    return out.view(np.uint64)


def cross_products(planes: np.ndarray, bits: list[int]) -> np.ndarray:
    """sum over rows of y_i * y_j for i <= j, from shared ones of planes; exact integers.

    ``int64`` where that holds them, Python's integers otherwise.
    """
    small = 2 * max(bits) + (planes.shape[1] * 64).bit_length() < 62
    kind = np.int64 if small else object
    dims, first = len(bits), np.r_[0, np.cumsum(bits)]
    weight = np.array([1 << p for b in bits for p in range(b)], dtype=np.int64 if small else object)
    out = np.zeros((dims, dims), dtype=kind)
    for i in range(dims):
        start = first[i]
        for p in range(bits[i]):
            ones = np.bitwise_count(planes[start:] & planes[start + p]).sum(axis=1, dtype=np.int64).astype(kind)
            sums = np.add.reduceat(ones * weight[start:], first[i:-1] - start)
            out[i, i:] += sums * (1 << p)
    return out


@dataclass
class Whitening:
    """What a row needs to be whitened. Sums and count are exact integers."""

    n: int
    low: np.ndarray  # of each dimension, what its integers are shifted by
    sums: list[int]  # of the shifted integers
    axes: np.ndarray  # a column for each component
    values: np.ndarray  # eigenvalues, falling
    trace: float

    def apply(self, x: np.ndarray) -> np.ndarray:
        mean = np.array([s / self.n for s in self.sums])
        return ((x - self.low) - mean) @ (self.axes / np.sqrt(self.values))

    def deviations(self, x: np.ndarray) -> list[int]:
        """sum over dimensions of (n*x - S)^2 for each row, exact."""
        y = x - self.low
        top = max((int(c) for c in y.max(axis=0)), default=0) if len(y) else 0
        if self.n * top * max([*self.sums, 1]) * max(1, len(self.sums)) >= 1 << 62 or top * top * max(1, len(self.sums)) >= 1 << 62:
            y = y.astype(object)
        squares = (y * y).sum(axis=1).tolist()
        mixed = (y * np.array(self.sums, dtype=y.dtype)).sum(axis=1).tolist()
        n, fixed = self.n, sum(s * s for s in self.sums)
        return [n * n * int(a) - 2 * n * int(b) + fixed for a, b in zip(squares, mixed)]


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of all rows; None without rows or dimensions.

    ``rows`` as ``vectors`` returns them. The driver gets one partial sum for each pair of
    dimensions and limb, however many rows there are.
    """
    found = ranges(rows)
    dims = len(found.low)
    if not found.n or not dims:
        return None
    low = found.low
    # The last plane has a one for every row: its products are the sums and the count.
    bits = [max(1, int(h - a).bit_length()) for a, h in zip(low.tolist(), found.high.tolist())] + [1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        limbs: dict[int, np.ndarray] = {}
        for batch in batches:
            _, column = _columns(batch)
            if not len(column):
                continue
            y = (integers(column, dims) - low).astype(np.uint64)
            part = cross_products(bit_planes(np.c_[y, np.ones(len(y), np.uint64)], bits), bits)
            at = 0
            while part.any():
                held = limbs.setdefault(at, np.zeros((dims + 1, dims + 1), dtype=np.int64))
                held += (part & ((1 << LIMB) - 1)).astype(np.int64)
                part, at = part >> LIMB, at + 1
        i, j = np.triu_indices(dims + 1)
        for at, held in sorted(limbs.items()):
            columns = [pa.array(i), pa.array(j), pa.array(np.full(len(i), at)), pa.array(held[i, j])]
            yield pa.RecordBatch.from_arrays(columns, ["i", "j", "limb", "part"])

    parts = rows.select("vec_id", "v").mapInArrow(run, "i long, j long, limb long, part long")
    total = [[0] * (dims + 1) for _ in range(dims + 1)]
    for r in parts.groupBy("i", "j", "limb").agg(F.sum("part").alias("part")).collect():
        total[r.i][r.j] += r.part << (LIMB * r.limb)
    n, sums = total[dims][dims], [total[i][dims] for i in range(dims)]
    cov = np.zeros((dims, dims))
    for i in range(dims):
        for j in range(i, dims):
            cov[i, j] = cov[j, i] = (n * total[i][j] - sums[i] * sums[j]) / (n * n)
    trace = sum(n * total[i][i] - sums[i] * sums[i] for i in range(dims)) / (n * n)
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    kept = values > NO_VARIANCE * max(trace, 0.0)
    values, axes = values[kept], axes[:, kept]
    if len(values):  # the entry of largest size is positive, so that a second fit has the same signs
        top = axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])]
        axes = axes * np.sign(top)
    return Whitening(n, low, sums, axes, values, trace)


def identity_error(rows: DataFrame, fitted: Whitening) -> float:
    """The largest entry of the whitened rows' covariance minus the identity, measured on all rows."""
    k, dims = len(fitted.values), len(fitted.low)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k + 1))
        for batch in batches:
            w = fitted.apply(integers(_columns(batch)[1], dims))
            w = np.c_[w, np.ones(len(w))]
            total += w.T @ w
        i, j = np.triu_indices(k + 1)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total[i, j])], ["i", "j", "part"])

    parts = rows.select("vec_id", "v").mapInArrow(run, "i long, j long, part double")
    sums = np.zeros((k + 1, k + 1))
    for r in parts.groupBy("i", "j").agg(F.sum("part").alias("part")).collect():
        sums[r.i, r.j] = sums[r.j, r.i] = r.part
    mean = sums[:k, k] / fitted.n
    return float(np.abs(sums[:k, :k] / fitted.n - np.outer(mean, mean) - np.eye(k)).max(initial=0.0))


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Each vector on the leading components, scaled to variance 1: a row for each vector and component.

    Columns: vec_id, component (from 1, by falling variance), n (vectors fitted), deviation (the sum
    over dimensions of (n*x-S)^2, exact; null beyond 38 digits), whitened, explained (share of the
    variance), identity_error.

    Vectors that are null or hold null or non-finite entries are left out; null and repeated ids are
    rows like others. Of vectors of different lengths the shorter ones count as 0.0 at their missing
    end. Components without variance are not returned, so equal vectors, a single vector, empty
    vectors or an empty table give no rows. Entries of 2^51 or more in size are held there.
    """
    taken = vectors(rows, id_col, vector_col)
    fitted = fit(taken, components)
    if fitted is None or not len(fitted.values):
        return rows.sparkSession.createDataFrame([], WHITENED)
    error = identity_error(taken, fitted)
    k, dims = len(fitted.values), len(fitted.low)
    explained = fitted.values / fitted.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, column = _columns(batch)
            if not len(column):
                continue
            x = integers(column, dims)
            at = pa.array(np.repeat(np.arange(len(x)), k))
            deviation = [Decimal(d) if d < 10**38 else None for d in fitted.deviations(x)]
            columns = [
                ids.take(at),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                pa.array(np.full(len(x) * k, fitted.n)),
                pa.array(deviation, pa.decimal128(38, 0)).take(at),
                pa.array(fitted.apply(x).ravel()),
                pa.array(np.tile(explained, len(x))),
                pa.array(np.full(len(x) * k, error)),
            ]
            names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return taken.mapInArrow(run, WHITENED)
