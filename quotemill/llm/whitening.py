"""Whitening of embeddings by a covariance from squares alone.

Every vector becomes integers x = floor(scale * c) + offset. The polarisation identity
cov(i, j) = (var(x_i + x_j) - var(x_i) - var(x_j)) / 2 needs squares only: a pass over the rows sums
the squares of every centred dimension and of every centred sum of two dimensions; the
differences of these variances are the cross-covariances, and the matrix goes to ``eigh``.

Exactness. Rows are centred by the whole part m of the mean before they are squared. With d = x - m and the
remainder r = sum(d), the sum of (n * x - S)^2 is n^2 * sum(d^2) - n * r^2 exactly, for a dimension and for a sum
of two alike. Tasks add up whole numbers, in runs of rows whose sums fit 64 bits (Python's integers where even
one row's square does not), and hand them on in parts of 40 bits, which Spark adds without loss. The
driver gets one total for each dimension and pair, whatever the rows, puts the parts together and rounds
each covariance to a double once, at the division.

The table is read three times (sums, squares, projection) and only the result is written.

Defined cases. Vectors that are null, or hold null or non-finite entries, take no part, nor do vectors whose
length is not the most frequent one (of ties the longer). An x beyond a long is the nearest end of
long. Rows that repeat an id, and null ids, are rows of their own. Without a vector the result is empty. A
component without variance (an eigenvalue of at most trace * dimensions * 1e-14, such as all of a single row's) has
null whitened values and takes no part in the identity error; without any variance explained is null. A deviation of more than
38 digits is null.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import kept

SCALE, OFFSET, COMPONENTS = 1024, 100_000, 8
LIMB = 40
LIMBS = 5
_LIMBS = ", ".join(f"l{i} long" for i in range(LIMBS))
ROWS = 1024  # rows that are squared at once
WIDE = 1 << 62
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def _largest(x: np.ndarray) -> int:
    return max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))


def integers(vectors: np.ndarray, scale: int, offset: int) -> np.ndarray:
    """floor(scale * c) + offset: int64, or Python's integers where 64 bits might not do on the way."""
    with np.errstate(over="ignore"):
        whole = np.floor(vectors * float(scale))
    if np.abs(whole).max(initial=0.0) < WIDE:
        return whole.astype(np.int64) + offset
    made = np.empty(whole.shape, object)
    for at, value in np.ndenumerate(whole):
        exact = int(value) if math.isfinite(value) else (MOST if value > 0 else LEAST) * 2
        made[at] = max(LEAST, min(MOST, exact + offset))
    return made


def matrices(batch: pa.RecordBatch, length: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows of the batch, their vectors) for each length of vector, or the given one, of those that take part."""
    column = batch.column("v")
    sizes = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # null entries become NaN
    present = np.maximum(sizes, 0)
    starts = np.cumsum(present) - present
    for n in np.unique(sizes).tolist():
        if n < 0 or (length is not None and n != length):
            continue
        rows = np.flatnonzero(sizes == n)
        for begin in range(0, len(rows), ROWS):
            some = rows[begin:begin + ROWS]
            found = values[starts[some][:, None] + np.arange(n)]
            fine = np.isfinite(found).all(1)
            if fine.any():
                yield some[fine], found[fine]


def _limbs(value: int) -> list[int]:
    """Parts of 40 bits, the last with the sign; sums of parts are parts of the sum."""
    return [(value >> (LIMB * i)) & ((1 << LIMB) - 1) for i in range(LIMBS - 1)] + [value >> (LIMB * (LIMBS - 1))]


def _whole(row) -> int:
    return sum(int(row[f"l{i}"]) << (LIMB * i) for i in range(LIMBS))


def _totals(rows: DataFrame, work, length: int | None = None) -> DataFrame:
    """(length, at, parts): exact sums over all rows of what ``work`` makes of a matrix, a list of Python integers."""

    def run(batches):
        totals: dict[int, list[int]] = {}
        for batch in batches:
            for _, vectors in matrices(batch, length):
                made, n = work(vectors), vectors.shape[1]
                totals[n] = [a + b for a, b in zip(totals[n], made)] if n in totals else made
        for n, total in totals.items():
            parts = zip(*map(_limbs, total))
            yield pa.RecordBatch.from_arrays(
                [pa.array([n] * len(total), pa.int32()), pa.array(range(len(total)), pa.int32()), *[pa.array(p, pa.int64()) for p in parts]],
                names=["length", "at", *[f"l{i}" for i in range(LIMBS)]])

    parts = rows.select("v").mapInArrow(run, f"length int, at int, {_LIMBS}")
    return parts.groupBy("length", "at").agg(*[F.sum(f"l{i}").alias(f"l{i}") for i in range(LIMBS)])


def _sums(x: np.ndarray) -> list[int]:
    """The rows, and the sum of every dimension."""
    wide = _largest(x) >= WIDE // ROWS
    return [len(x), *map(int, (x.astype(object) if wide else x.astype(np.int64)).sum(0))]


def squares(d: np.ndarray) -> list[int]:
    """Sums of squares of every dimension, then of every sum of two dimensions i < j."""
    k, most = d.shape[1], 2 * _largest(d)
    if most * most * len(d) >= WIDE:
        if len(d) > 1:
            half = len(d) // 2
            return [a + b for a, b in zip(squares(d[:half]), squares(d[half:]))]
        one = [int(v) for v in d[0]]
        return [v * v for v in one] + [(one[i] + one[j]) ** 2 for i in range(k) for j in range(i + 1, k)]
    d = d.astype(np.int64)
    total = (d * d).sum(0).tolist()
    for i in range(k):
        pair = d[:, i + 1:] + d[:, i:i + 1]
        total += np.einsum("nj,nj->j", pair, pair).tolist()
    return total


def centred(x: np.ndarray, middle: list[int]) -> np.ndarray:
    """x - m; as Python's integers where 64 bits might not do."""
    if max(map(abs, middle), default=0) < WIDE and _largest(x) < WIDE:
        return x.astype(np.int64) - np.array(middle, np.int64)
    return x.astype(object) - np.array(middle, object)


@dataclass
class Whitening:
    """What the fit list says: numbers of a fixed size, whatever the rows."""

    n: int
    sums: list[int]
    values: np.ndarray  # eigenvalues, falling
    vectors: np.ndarray  # a column a component
    covariance: np.ndarray
    scale: int
    offset: int

    @property
    def middle(self) -> list[int]:
        return [s // self.n for s in self.sums]

    @property
    def rest(self) -> list[int]:
        return [s % self.n for s in self.sums]

    @property
    def trace(self) -> float:
        return float(np.trace(self.covariance))

    def varies(self, component: int) -> bool:
        return bool(self.values[component] > self.trace * len(self.sums) * 1e-14)

    def explained(self, component: int) -> float | None:
        return float(self.values[component] / self.trace) if self.trace > 0 else None


def covariances(n: int, rest: list[int], squared: list[int]) -> np.ndarray:
    """By polarisation, from the sums of squares of centred dimensions and pair sums."""
    k = len(rest)
    single = [n * squared[i] - rest[i] ** 2 for i in range(k)]  # n^2 times the variance
    matrix, at = np.empty((k, k)), k
    for i in range(k):
        matrix[i, i] = float(Fraction(single[i], n * n))
        for j in range(i + 1, k):
            both = n * squared[at] - (rest[i] + rest[j]) ** 2
            matrix[i, j] = matrix[j, i] = float(Fraction(both - single[i] - single[j], 2 * n * n))
            at += 1
    return matrix


def fit(rows: DataFrame, scale: int = SCALE, offset: int = OFFSET) -> Whitening | None:
    """From (v): exact totals and the components; None without a vector that has a component."""
    summed = kept(_totals(rows, lambda v: _sums(integers(v, scale, offset))), "whitening-sums")
    usual = summed.where(F.col("at") == 0).orderBy(F.desc("l2"), F.desc("l1"), F.desc("l0"), F.desc("length")).first()
    k = usual["length"] if usual else 0
    if not k:
        return None
    totals = {r["at"]: _whole(r) for r in summed.where(F.col("length") == k).collect()}  # a row a dimension
    n, sums = totals[0], [totals[i + 1] for i in range(k)]
    found = Whitening(n, sums, np.empty(0), np.empty((k, 0)), np.empty((k, k)), scale, offset)
    middle = found.middle
    squared = _totals(rows, lambda v: squares(centred(integers(v, scale, offset), middle)), k)
    totals = {r["at"]: _whole(r) for r in squared.collect()}  # a row a dimension or pair
    found.covariance = covariances(n, found.rest, [totals[i] for i in range(k * (k + 1) // 2)])
    values, vectors = np.linalg.eigh(found.covariance)
    found.values, found.vectors = values[::-1].copy(), vectors[:, ::-1].copy()
    return found


def deviations(d: np.ndarray, n: int, rest: list[int]) -> pa.Array:
    """sum over dimensions of (n * d - r)^2 of each row."""
    most = n * (_largest(d) + 1)
    if most * most * max(d.shape[1], 1) < WIDE:
        off = d.astype(np.int64) * n - np.array(rest, np.int64)
        return pa.array((off * off).sum(1)).cast(pa.decimal128(38, 0))
    exact = [sum((n * int(v) - r) ** 2 for v, r in zip(row, rest)) for row in d]
    return pa.array([Decimal(e) if e < 10**38 else None for e in exact], pa.decimal128(38, 0))


def project(rows: DataFrame, found: Whitening, components: int = COMPONENTS) -> DataFrame:
    """vec_id, deviation decimal(38,0) and whitened array<double>, of each of (vec_id, v)."""
    k = len(found.sums)
    count = min(components, k)
    middle, rest = found.middle, found.rest
    mean_rest = np.array([r / found.n for r in rest])
    live = [c for c in range(count) if found.varies(c)]
    onto = found.vectors[:, live] / np.sqrt(found.values[live])

    def run(batches):
        for batch in batches:
            for at, vectors in matrices(batch, k):
                d = centred(integers(vectors, found.scale, found.offset), middle)
                values = np.full((len(d), count), np.nan)
                values[:, live] = (d.astype(np.float64) - mean_rest) @ onto
                flat = pa.array(values.ravel(), pa.float64(), from_pandas=True)
                yield pa.RecordBatch.from_arrays([
                    batch.column("vec_id").take(pa.array(at)), deviations(d, found.n, rest),
                    pa.ListArray.from_arrays(pa.array(np.arange(len(d) + 1) * count, pa.int32()), flat),
                ], names=["vec_id", "deviation", "whitened"])

    kind = rows.schema["vec_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"vec_id {kind}, deviation decimal(38,0), whitened array<double>")


def identity_error(whitened: DataFrame, live: list[int]) -> float | None:
    """The largest absolute entry of the covariance of the whitened rows, as they are, minus the identity."""
    if not live:
        return None
    value = {c: F.col("whitened")[c] for c in live}
    # Population covariances; Spark centres them before it multiplies.
    pairs = [(i, j) for i in live for j in live if i <= j]
    found = whitened.agg(*[F.covar_pop(value[i], value[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(found[f"c{i}_{j}"] - (i == j)) for i, j in pairs)


def whitened(
    df: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS,
    scale: int = SCALE, offset: int = OFFSET,
) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error: a row a vector and component."""
    rows = df.select(df[vec_id].alias("vec_id"), df[vector].cast("array<double>").alias("v"))
    found = fit(rows, scale, offset)
    if found is None:
        kind = rows.schema["vec_id"].dataType.simpleString()
        return df.sparkSession.createDataFrame(
            [], f"vec_id {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double")
    values = kept(project(rows, found, components), "whitened")
    count = min(components, len(found.sums))
    error = identity_error(values, [c for c in range(count) if found.varies(c)])
    explained = F.array(*[F.lit(found.explained(c)).cast("double") for c in range(count)])
    each = values.select("vec_id", "deviation", F.posexplode("whitened").alias("_at", "whitened"))
    return each.select(
        "vec_id", (F.col("_at") + 1).alias("component"), F.lit(found.n).cast("long").alias("n"), "deviation", "whitened",
        explained[F.col("_at")].alias("explained"), F.lit(error).cast("double").alias("identity_error"))
