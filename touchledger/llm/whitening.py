"""Whitening of embeddings with covariances by polarisation.

Entries become whole numbers x on a fixed grid. A first pass sums each dimension; a second one adds up, for every
dimension and for every sum of two dimensions, the squares of the values centred at the whole mean. By
``2 cov(a, b) = var(a + b) - var(a) - var(b)`` these give the covariance matrix in whole numbers, without any rounding;
it is rounded once, for the eigenvectors. A third pass measures the covariance of the whitened rows. Tasks work on
matrices of a batch and hand over one set of sums, cut into 32-bit limbs so that Spark's sums of longs are exact at any
size.

Defined results: a row whose vector is null, empty, or holds a null, NaN or infinite entry is left out, as is one of
another length than most vectors have (of two equally frequent lengths the longer counts), with which no covariance
exists. An entry beyond 64 bits on the grid takes the nearest long. A deviation beyond 64 bits is null. Components whose
eigenvalue does not exceed the rounding of the largest one (equal vectors, too few rows) do not exist, so fewer than asked
for may come. Equal rows, equal and null ids each get their rows; an empty table gives none. Columns of the input other
than id and vector are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The grid: x = floor(SCALE * c) + SHIFT; components of the result.
SCALE, SHIFT, COMPONENTS = 1024, 100_000, 8
_LONG = 1 << 63
#: Whole numbers that doubles and products of two can still hold with room to spare.
_SMALL = 1 << 52
_LIMB = 32


def usable(vector: Column) -> Column:
    """The vector as doubles, or null if an entry is null or not finite."""
    wide = vector.cast("array<double>")
    return F.when((F.size(wide) > 0) & F.forall(wide, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))),
                  wide)


def on_grid(values: np.ndarray) -> np.ndarray:
    """Whole numbers of the entries: longs, or Python's integers where an entry is large."""
    with np.errstate(over="ignore"):
        x = np.floor(values * SCALE)
    if not x.size or np.abs(x).max() < _SMALL:
        return x.astype(np.int64) + SHIFT
    # a product beyond the doubles is infinite; the nearest long is meant
    return np.array([[min(max(int(c) + SHIFT, -_LONG), _LONG - 1) if np.isfinite(c) else (_LONG - 1 if c > 0 else -_LONG)
                      for c in row] for row in x.tolist()], object).reshape(x.shape)


def _fits(values: np.ndarray, terms: int) -> bool:
    """Whether a sum of so many squares of the values stays within longs."""
    if values.dtype == object or not values.size:
        return values.dtype != object
    most = int(max(abs(int(values.max())), abs(int(values.min()))))
    return most * most * terms < _LONG


def _exact(values: np.ndarray, terms: int) -> np.ndarray:
    return values if _fits(values, terms) else values.astype(object)


def matrix(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def pair_squares(centred: np.ndarray) -> np.ndarray:
    """For each dimension and each sum of it with a later one: the sum over rows of squares, row by row of the triangle."""
    d = centred.shape[1]
    values = _exact(centred, 4 * len(centred))
    out = []
    for i in range(d):
        own = values[:, i:i + 1]
        pairs = values[:, i + 1:] + own
        out.append((own * own).sum(0))
        out.append((pairs * pairs).sum(0))
    return np.concatenate(out).astype(object)


def limbs(totals: np.ndarray, names: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows (place, limb, value) of whole numbers; the sign goes with each limb."""
    level, rest, sign = 0, [abs(int(t)) for t in totals], [-1 if t < 0 else 1 for t in totals]
    while any(rest):
        own = [(k, level, s * (r & (1 << _LIMB) - 1)) for k, (r, s) in enumerate(zip(rest, sign)) if r & (1 << _LIMB) - 1]
        for at in range(0, len(own), 1 << 14):
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*own[at:at + (1 << 14)]), (pa.int32(), pa.int32(), pa.int64()))], names)
        rest, level = [r >> _LIMB for r in rest], level + 1


def exact_sums(vectors: DataFrame, size: int, of_batch) -> list[int]:
    """Sums over all rows of a batch function's whole numbers, to any size. The driver gets ``size`` numbers."""
    names = ["place", "limb", "value"]

    def run(batches):
        totals = np.zeros(size, object)
        for batch in batches:
            if batch.num_rows:
                totals += of_batch(on_grid(matrix(batch.column(0))))
        yield from limbs(totals, names)

    out = [0] * size
    added = vectors.select("v").mapInArrow(run, "place int, limb int, value bigint").groupBy("place", "limb")
    for r in added.agg(F.sum("value").alias("value")).collect():
        out[r["place"]] += r["value"] << _LIMB * r["limb"]
    return out


def covariances(squares: list[int], rests: list[int], n: int) -> list[list[int]]:
    """n² times the covariances, as whole numbers, from the sums of squares around the whole means.

    ``rests`` is what the whole means leave of each dimension's sum.
    """
    d, places = len(rests), iter(squares)
    variances, pairs = [0] * d, {}
    for i in range(d):
        variances[i] = n * next(places) - rests[i] ** 2
        for j in range(i + 1, d):
            pairs[i, j] = n * next(places) - (rests[i] + rests[j]) ** 2
    out = [[0] * d for _ in range(d)]
    for i in range(d):
        out[i][i] = variances[i]
        for j in range(i + 1, d):
            out[i][j] = out[j][i] = (pairs[i, j] - variances[i] - variances[j]) // 2
    return out


class Whitening:
    """What whitens a vector: rows, sums by dimension, eigenvalues in falling order, and directions by component."""

    def __init__(self, n: int, sums: list[int], covariance: list[list[int]], components: int):
        self.n, self.sums = n, sums
        exact = np.array([[c / (n * n) for c in row] for row in covariance], np.float64)
        values, vectors = np.linalg.eigh(exact)
        order = np.argsort(-values, kind="stable")
        values, vectors = values[order], vectors[:, order]
        real = values > len(sums) * np.finfo(float).eps * max(values[0], 0)
        self.trace = sum(covariance[i][i] for i in range(len(sums))) / (n * n)
        self.values = values[:components][real[:components]]
        self.vectors = vectors[:, :len(self.values)]

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n times x, less the sums: whole numbers."""
        n, sums = self.n, np.array(self.sums, object)
        if x.dtype != object:
            low, high = int(x.min()), int(x.max())
            if n * max(-low, high, 1) < _LONG // 2 and max(map(abs, self.sums)) < _LONG // 2:
                return x * n - sums.astype(np.int64)
        return x.astype(object) * n - sums

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        apart = np.array(centred / self.n, np.float64) if centred.dtype == object else centred / float(self.n)
        return apart @ self.vectors / np.sqrt(self.values)


def deviations(centred: np.ndarray) -> pa.Array:
    """Sums of squares over the dimensions; null beyond 64 bits."""
    values = _exact(centred, centred.shape[1])
    sums = (values * values).sum(1)
    return pa.array([int(s) if s < _LONG else None for s in sums.tolist()], pa.int64())


def remaining(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """Ids and usable vectors of the length that most of them have."""
    rows = vectors.select(F.col(vec_id).alias("vec_id"), usable(F.col(vector)).alias("v")).where("v IS NOT NULL")
    lengths = rows.groupBy(F.size("v").alias("d")).count()
    most = lengths.orderBy(F.desc("count"), F.desc("d")).first()
    return rows.where(F.size("v") == F.lit(most["d"] if most else 0))


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of all rows (column v); none if there is no row."""
    first = rows.select(F.size("v").alias("d")).first()
    if first is None:
        return None
    d = first["d"]

    def sums(x):
        return np.r_[np.array([len(x)], object), _exact(x, len(x)).sum(0).astype(object)]

    n, *totals = exact_sums(rows, d + 1, sums)
    means = [t // n for t in totals]

    def squares(x):
        shift = np.array(means, object)
        small = x.dtype != object and max(map(abs, means)) < _LONG // 4
        return pair_squares(x - shift.astype(np.int64) if small else x.astype(object) - shift)

    found = exact_sums(rows, d * (d + 1) // 2, squares)
    return Whitening(n, totals, covariances(found, [t - n * m for t, m in zip(totals, means)], n), components)


def identity_error(rows: DataFrame, model: Whitening) -> float:
    """The largest entry of the whitened rows' covariance minus the identity, measured over all rows."""
    k = len(model.values)
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        own, products, sums = shared.value, np.zeros((k, k)), np.zeros(k)
        for batch in batches:
            if batch.num_rows:
                w = own.whitened(own.centred(on_grid(matrix(batch.column(0)))))
                products += w.T @ w
                sums += w.sum(0)
        values = np.r_[products.ravel(), sums]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(values)), pa.int32()), pa.array(values)], ["place", "value"])

    parts = rows.select("v").mapInArrow(run, "place int, value double").groupBy("place").agg(F.sum("value").alias("value"))
    got = np.zeros(k * k + k)
    for r in parts.collect():
        got[r["place"]] = r["value"]
    mean = got[k * k:] / model.n
    return float(np.abs(got[:k * k].reshape(k, k) / model.n - np.outer(mean, mean) - np.eye(k)).max())


def whiten(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding",
           components: int = COMPONENTS) -> DataFrame:
    """A row per usable vector and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    spark, rows = vectors.sparkSession, remaining(vectors, vec_id, vector)
    kind = rows.schema["vec_id"].dataType.simpleString()
    schema = (f"vec_id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, "
              "identity_error double")
    model = fit(rows, components)
    if model is None or not len(model.values):
        return spark.createDataFrame([], schema)
    k, error = len(model.values), identity_error(rows, model)
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        own = shared.value
        share = own.values / own.trace
        for batch in batches:
            if not batch.num_rows:
                continue
            centred = own.centred(on_grid(matrix(batch.column(1))))
            m, repeat = len(centred), pa.array(np.repeat(np.arange(len(centred)), k))
            yield pa.RecordBatch.from_arrays(
                [pc.take(batch.column(0), repeat), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                 pa.array(np.full(m * k, own.n, np.int64)), pc.take(deviations(centred), repeat),
                 pa.array(own.whitened(centred).ravel()), pa.array(np.tile(share, m)), pa.array(np.full(m * k, error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, schema)
