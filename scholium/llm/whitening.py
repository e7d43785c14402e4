"""Whitening of embeddings: principal components over distinct vectors, scaled to unit variance.

An entry c counts as the whole number floor(64 c) + 1000000, so sums are exact and equal vectors are told by equality.
The fit is over each distinct vector once, which keeps a vector that is copied a million times from bending the axes.
It takes two passes over the distinct vectors, which are stored in between: exact sums give the mean, then each task
sums outer products of centred vectors by matrix products, and treeAggregate merges the tasks' sums, so the driver gets
a few matrices of dimension x dimension, however many rows there are. LAPACK's symmetric solver gives the components,
which are broadcast (dimension x components numbers). A third pass over the distinct vectors measures how far the
covariance of the whitened values is from the identity; means are merged with it, so it too is centred before multiplying.

Vectors that are null, or that hold null or non-finite entries, give no rows. Vectors of different lengths are different
spaces, each fitted for itself; an empty vector has no components. Entries whose floor(64 c) is beyond 2^52 count as
2^52. A component without variance (fewer distinct vectors than components, or constant entries) has null for its
whitened value and zero explained; with no variance at all `explained` is null too. Equal eigenvalues have no order of
their own. Each row gets its result, repeated rows and null ids too; a table without usable vectors gives no rows.
Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000
#: Bound of floor(64 c): whole numbers up to here are exact as doubles.
FARTHEST = 2.0**52
#: Entries in a matrix that a task works on at a time.
ENTRIES = 1 << 21


def lattice(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, floor(64 c) as a matrix of longs) of a column's usable vectors, by length, in slices of bounded size."""
    lengths = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    entries = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # a null entry is a NaN here
    starts = np.cumsum(np.maximum(lengths, 0)) - np.maximum(lengths, 0)
    for length in np.unique(lengths[lengths > 0]).tolist():
        rows = np.flatnonzero(lengths == length)
        for k in range(0, len(rows), max(1, ENTRIES // length)):
            some = rows[k : k + max(1, ENTRIES // length)]
            values = entries[starts[some][:, None] + np.arange(length)]
            usable = np.isfinite(values).all(axis=1)
            with np.errstate(over="ignore"):
                whole = np.clip(np.floor(SCALE * values[usable]), -FARTHEST, FARTHEST)
            yield some[usable], whole.astype(np.int64)


def packed(x: np.ndarray) -> pa.Array:
    """A vector a cell, in the fewest bytes an entry that hold it: equal vectors have equal cells."""
    most = np.abs(x).max(axis=1)
    width = np.where(most < 1 << 15, 2, np.where(most < 1 << 31, 4, 8))
    cells: list[bytes] = [b""] * len(x)
    for w in (2, 4, 8):
        rows = np.flatnonzero(width == w)
        raw, size = x[rows].astype(f"<i{w}").tobytes(), w * x.shape[1]
        for k, row in enumerate(rows.tolist()):
            cells[row] = raw[k * size : (k + 1) * size]
    return pa.array(cells, pa.binary())


def unpacked(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    """The matrices of a batch of (length, cell), each of one length, in slices of bounded size."""
    lengths, cells = batch.column("length").to_numpy(), batch.column("cell").to_pylist()
    widths = np.array([len(c) for c in cells], dtype=np.int64) // np.maximum(lengths, 1)
    for length, w in {(int(a), int(b)) for a, b in zip(lengths, widths)}:
        rows = np.flatnonzero((lengths == length) & (widths == w))
        for k in range(0, len(rows), max(1, ENTRIES // length)):
            some = rows[k : k + max(1, ENTRIES // length)].tolist()
            yield np.frombuffer(b"".join([cells[i] for i in some]), f"<i{w}").reshape(-1, length).astype(np.int64)


def distinct_vectors(df: DataFrame, vector: str) -> DataFrame:
    """(length, cell): each distinct vector once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, x in lattice(batch.column("vector")):
                if len(x):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), x.shape[1], np.int32)), packed(x)], names=["length", "cell"])

    return df.select(F.col(vector).alias("vector")).mapInArrow(run, "length int, cell binary").distinct()


def spread(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S, exact: longs where they are sure to hold it, else Python's numbers."""
    most = max(int(np.abs(x).max(initial=0)) * n + max(map(abs, sums)), 1)
    kind = np.int64 if most < 1 << 62 else object
    return x.astype(kind) * n - np.array(sums, dtype=kind)


def deviation(apart: np.ndarray) -> list[int]:
    """The exact sum of squares of each row."""
    most = max(int(apart.max(initial=0)), -int(apart.min(initial=0)))
    kind = np.int64 if most * most * apart.shape[1] < 1 << 62 else object
    return [int(v) for v in (apart.astype(kind) ** 2).sum(axis=1)]


@dataclass
class Space:
    """What was fitted for vectors of one length. sums are those of floor(64 c), without the shift, which centring takes out."""

    n: int
    sums: list[int]
    axes: np.ndarray  # length x components: unit eigenvectors
    variances: np.ndarray
    trace: float
    identity_error: float | None = None

    def projection(self) -> np.ndarray:
        """Axes over standard deviations; NaN for a component without variance."""
        return self.axes / np.sqrt(np.where(self.variances > 0, self.variances, np.nan))


Whitening = dict[int, Space]


def _summed(fit: DataFrame, task: Callable[[Iterator[np.ndarray]], Iterator[tuple]], schema: str, add: Callable[[tuple, tuple], tuple], read: Callable[[tuple], tuple]) -> dict[int, tuple]:
    """By length: what tasks make of their vectors, merged by treeAggregate."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, tuple] = {}
        for batch in batches:
            for x in unpacked(batch):
                part, length = task(x), x.shape[1]
                found[length] = add(found[length], part) if length in found else part
        for length, part in found.items():
            fields = [pa.array([length], pa.int32())] + [pa.array([v.tobytes() if isinstance(v, np.ndarray) else v]) for v in part]
            yield pa.RecordBatch.from_arrays([fields[0], *(f.cast(t) for f, t in zip(fields[1:], types))], names=["length", *names])

    names = [f.split()[0] for f in schema.split(", ")]
    types = [{"long": pa.int64(), "binary": pa.binary(), "array<decimal(38,0)>": pa.list_(pa.decimal128(38, 0))}[f.split()[1]] for f in schema.split(", ")]

    def merged(a: dict[int, tuple], b: dict[int, tuple]) -> dict[int, tuple]:
        return {k: add(a[k], b[k]) if k in a and k in b else a.get(k, b.get(k)) for k in a.keys() | b.keys()}

    return fit.mapInArrow(run, f"length int, {schema}").rdd.treeAggregate({}, lambda so_far, row: merged(so_far, {row[0]: read(tuple(row)[1:])}), merged)


def _totals(x: np.ndarray) -> tuple:
    upper, lower = (x >> 26).sum(axis=0), (x & ((1 << 26) - 1)).sum(axis=0)  # neither overflows
    return len(x), [Decimal((int(u) << 26) + int(v)) for u, v in zip(upper, lower)]


def _spread_of(values: np.ndarray) -> tuple:
    """Rows, mean, and outer products about the mean."""
    mean = values.mean(axis=0)
    apart = values - mean
    return len(values), mean, apart.T @ apart


def _joined(a: tuple, b: tuple) -> tuple:
    (n, mean, products), (m, other, more) = a, b
    gap = other - mean
    return n + m, mean + gap * (m / (n + m)), products + more + np.outer(gap, gap) * (n * m / (n + m))


def fit(df: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> Whitening:
    """The components of each length of vectors; `components` of them at most."""
    vectors = stored(distinct_vectors(df, vector), "whitening-vectors")
    totals = _summed(vectors, _totals, "n long, sums array<decimal(38,0)>", lambda a, b: (a[0] + b[0], [v + w for v, w in zip(a[1], b[1])]), lambda row: row)
    totals = {length: (n, [int(v) for v in sums]) for length, (n, sums) in totals.items()}

    def products(x: np.ndarray) -> tuple:
        n, sums = totals[x.shape[1]]
        centred = (spread(x, n, sums) / n).astype(np.float64)
        return len(x), centred.T @ centred

    def matrix(row: tuple) -> tuple:
        n, raw = row
        flat = np.frombuffer(raw)
        return n, flat.reshape(int(len(flat) ** 0.5), -1)

    spaces: Whitening = {}
    for length, (n, outer) in _summed(vectors, products, "n long, products binary", lambda a, b: (a[0] + b[0], a[1] + b[1]), matrix).items():
        covariance = outer / n
        values, axes = np.linalg.eigh((covariance + covariance.T) / 2)
        k = min(components, length)
        values, axes = values[::-1][:k], axes[:, ::-1][:, :k]
        values = np.where(values > max(values[0], 0) * length * np.finfo(float).eps, values, 0.0)
        axes = axes * np.where(axes[np.abs(axes).argmax(axis=0), np.arange(k)] < 0, -1.0, 1.0)
        spaces[length] = Space(n, totals[length][1], axes, values, float(np.trace(covariance)))

    def whitened(x: np.ndarray) -> tuple:
        space = spaces[x.shape[1]]
        return _spread_of(np.nan_to_num(project(space, spread(x, space.n, space.sums))))

    def moments(row: tuple) -> tuple:
        n, mean, raw = row
        mean = np.frombuffer(mean)
        return n, mean, np.frombuffer(raw).reshape(len(mean), -1)

    for length, (n, _, outer) in _summed(vectors, whitened, "n long, mean binary, products binary", _joined, moments).items():
        live = spaces[length].variances > 0
        if live.any():
            spaces[length].identity_error = float(np.abs(outer / n - np.eye(len(live)))[np.ix_(live, live)].max())
    return spaces


def project(space: Space, apart: np.ndarray) -> np.ndarray:
    """Whitened values of rows of n x - S."""
    return (apart / space.n).astype(np.float64) @ space.projection()


def transform(df: DataFrame, whitening: Whitening, vector: str = "embedding", id: str = "vec_id") -> DataFrame:
    """(vec_id, n, deviation, whitened, explained, identity_error) of each usable row.

    whitened and explained are arrays by component; n is the number of distinct vectors, deviation the exact square of
    the distance from the mean, times n squared (null if it needs over 38 digits).
    """
    known = df.sparkSession.sparkContext.broadcast(whitening)
    digits = 10**38

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in lattice(batch.column("vector")):
                space = known.value.get(x.shape[1])
                if space is None or not len(rows):
                    continue
                apart = spread(x, space.n, space.sums)
                values = project(space, apart)
                m, k = values.shape
                exact = deviation(apart)
                shares = space.variances / space.trace if space.trace > 0 else np.full(k, np.nan)
                offsets = pa.array(np.arange(m + 1, dtype=np.int32) * k)
                whitened = pa.ListArray.from_arrays(offsets, pa.array(values.reshape(-1), pa.float64(), from_pandas=True))
                explained = pa.ListArray.from_arrays(offsets, pa.array(np.tile(shares, m), pa.float64(), from_pandas=True))
                far = pa.array([Decimal(v) if v < digits else None for v in exact], pa.decimal128(38, 0))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(pa.array(rows)), pa.array(np.full(m, space.n)), far, whitened, explained, pa.array([space.identity_error] * m, pa.float64())],
                    names=["vec_id", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    schema = "vec_id long, n long, deviation decimal(38,0), whitened array<double>, explained array<double>, identity_error double"
    return df.select(F.col(id).cast("long").alias("id"), F.col(vector).alias("vector")).mapInArrow(run, schema)


def components(whitened: DataFrame) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): a row for each component of transform()'s rows.

    deviation is a long; null if it does not fit.
    """
    by = whitened.select("vec_id", "n", F.expr("try_cast(deviation as long)").alias("deviation"), "identity_error", F.posexplode(F.arrays_zip("whitened", "explained")).alias("place", "value"))
    return by.select("vec_id", (F.col("place") + 1).alias("component"), "n", "deviation", F.col("value.whitened").alias("whitened"), F.col("value.explained").alias("explained"), "identity_error")
