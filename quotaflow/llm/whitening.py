"""Embeddings whitened by their leading principal components.

Entries become whole numbers, ``floor(64 * entry) + 1000000``, and every sum over rows is exact:
tasks centre the numbers by the rounded mean before they multiply and add them up (as
floats where all sums stay below 2**53, else as Python integers), Spark adds the tasks' sums, and what the rounded mean left over is
taken off the totals, exactly.  So the covariance does not depend on how rows were dealt, and is rounded
once.  It goes to the driver, dimension squared numbers, where ``feast`` finds its components; rows never do.

A vector is one row of a task's matrix, whoever else has the same; nothing is grouped by it.

Defined cases: a vector that is null, or holds a null or an entry that is not finite (or too
large for a whole number of 52 bits), is left out; so is one whose length is not that of most of the
rest (of the smallest such length, if several).  Empty vectors and empty tables give no rows.  Equal rows and null
ids stay.  A component whose eigenvalue is zero within rounding has no whitened values and is left out,
so constant vectors give no rows.  Other columns are not looked at.  A deviation beyond 64 bits is
an error.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import feast

SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 32
_EXACT = 1 << 52
_WHOLE = pa.decimal128(38, 0)


@dataclass
class Whitening:
    """What the fit list says: its size, sums and components, one a row."""

    n: int
    sums: list[int]
    values: np.ndarray
    components: np.ndarray
    trace: float
    identity_error: float = 0.0

    def __post_init__(self) -> None:
        # The rounded mean, and what is left of the sums.
        self.middle = [(2 * s + self.n) // (2 * self.n) for s in self.sums] if self.n else []
        self.left = [s - self.n * m for s, m in zip(self.sums, self.middle, strict=True)]

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``x - S / n`` as doubles."""
        return (x - np.array(self.middle, np.int64)) - np.array(self.left, float) / max(self.n, 1)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.components.T / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """Sum over the dimensions of ``(n * x - S) ** 2``."""
        y = x - np.array(self.middle, np.int64)
        far = (self.n * int(np.abs(y).max(initial=0)) + max(map(abs, self.left), default=0)) ** 2 * x.shape[1]
        kind = np.int64 if far < 1 << 63 else object
        total = ((self.n * y.astype(kind) - np.array(self.left, kind)) ** 2).sum(axis=1)
        if kind is object and max(total) >= 1 << 63:
            raise OverflowError(f"a deviation of {max(total)} is no 64-bit number")
        return total.astype(np.int64)


def usable(vectors: DataFrame, column: str = "embedding") -> Column:
    """True for a vector whose entries all become whole numbers."""
    whole = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) * SCALE < float(_EXACT))
    return F.coalesce(F.forall(F.col(column), whole), F.lit(False))


def _length(vectors: DataFrame) -> int:
    """The length most vectors have."""
    by_length = vectors.groupBy(F.size("_v").alias("length")).count()
    most = by_length.orderBy(F.desc("count"), "length").first()
    return most["length"] if most else 0


def _whole(column: pa.Array, width: int) -> np.ndarray:
    """The vectors of a batch as a matrix of whole numbers."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return (np.floor(SCALE * flat.astype(float)).astype(np.int64) + SHIFT).reshape(len(column), width)


def _totals(vectors: DataFrame, width: int, schema: str, start: Callable, add: Callable, rows: Callable) -> DataFrame:
    """``add`` folds the batches of a task into what ``start`` gives; ``rows`` makes that a batch of partial sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = start()
        for batch in batches:
            if batch.num_rows:
                add(state, _whole(batch.column("_v"), width))
        yield rows(state)

    return vectors.select("_v").mapInArrow(run, schema)


def _sums(vectors: DataFrame, width: int) -> tuple[int, list[int]]:
    """Number of rows and sum of each dimension."""

    def add(state: list, x: np.ndarray) -> None:
        state[0] += len(x)
        # In two halves, so that no sum leaves 64 bits.
        high, low = x >> 26, x & ((1 << 26) - 1)
        state[1] = state[1] + high.sum(axis=0).astype(object) * (1 << 26) + low.sum(axis=0).astype(object)

    def rows(state: list) -> pa.RecordBatch:
        values = [Decimal(int(v)) for v in (state[0], *state[1])]
        return pa.record_batch({"i": pa.array(range(-1, width), pa.int32()), "v": pa.array(values, _WHOLE)})

    start = lambda: [0, np.zeros(width, object)]
    partial = _totals(vectors, width, "i int, v decimal(38,0)", start, add, rows)
    found = {r["i"]: int(r["v"]) for r in partial.groupBy("i").agg(F.sum("v").alias("v")).collect()}
    return found.get(-1, 0), [found.get(i, 0) for i in range(width)]


def products(y: np.ndarray) -> np.ndarray:
    """``y.T @ y``, exact."""
    size = np.abs(y).max(axis=1, initial=0)
    small = size.astype(float) ** 2 * len(y) < 1 << 52
    out = np.zeros((y.shape[1], y.shape[1]), object)
    if small.any():
        near = y[small].astype(float)
        out = out + (near.T @ near).astype(np.int64).astype(object)
    if not small.all():
        far = y[~small].astype(object)
        out = out + far.T @ far
    return out


def _covariance(vectors: DataFrame, fit: Whitening) -> np.ndarray:
    """Covariance with divisor n, each entry rounded once."""
    width, middle = len(fit.sums), np.array(fit.middle, np.int64)
    upper = np.triu_indices(width)

    def add(state: list, x: np.ndarray) -> None:
        state[0] = state[0] + products(x - middle)

    def rows(state: list) -> pa.RecordBatch:
        values = [Decimal(int(v)) for v in state[0][upper]]
        return pa.record_batch({"i": pa.array(upper[0], pa.int32()), "j": pa.array(upper[1], pa.int32()), "v": pa.array(values, _WHOLE)})

    start = lambda: [np.zeros((width, width), object)]
    partial = _totals(vectors, width, "i int, j int, v decimal(38,0)", start, add, rows)
    out, n, left = np.zeros((width, width)), fit.n, fit.left
    for r in partial.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        i, j = r["i"], r["j"]
        out[i, j] = out[j, i] = float(Fraction(n * int(r["v"]) - left[i] * left[j], n * n))
    return out


def _identity_error(vectors: DataFrame, fit: Whitening) -> float:
    """Largest entry of the whitened values' covariance minus the identity, measured on all rows."""
    k = len(fit.values)

    def add(state: list, x: np.ndarray) -> None:
        w = fit.whitened(x)
        state[0] += w.T @ w
        state[1] += w.sum(axis=0)

    def rows(state: list) -> pa.RecordBatch:
        i, j = np.indices((k, k)).reshape(2, -1)
        i, j = np.append(i, np.full(k, -1)), np.append(j, np.arange(k))
        return pa.record_batch({"i": pa.array(i, pa.int32()), "j": pa.array(j, pa.int32()), "v": np.append(state[0].ravel(), state[1])})

    start = lambda: [np.zeros((k, k)), np.zeros(k)]
    partial = _totals(vectors, len(fit.sums), "i int, j int, v double", start, add, rows)
    found, mean = np.zeros((k, k)), np.zeros(k)
    for r in partial.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        if r["i"] < 0:
            mean[r["j"]] = r["v"] / fit.n
        else:
            found[r["i"], r["j"]] = r["v"] / fit.n
    return float(np.abs(found - np.outer(mean, mean) - np.eye(k)).max(initial=0.0))


def _rows(vectors: DataFrame, column: str, key: str) -> DataFrame:
    return vectors.where(usable(vectors, column)).select(F.col(key).alias("_k"), F.col(column).cast("array<double>").alias("_v"))


def fit(vectors: DataFrame, components: int = COMPONENTS, column: str = "embedding") -> Whitening:
    """Components of all usable vectors; a few passes over their column."""
    rows = _rows(vectors, column, column)
    width = _length(rows)
    rows = rows.where(F.size("_v") == width)
    n, sums = _sums(rows, width) if width else (0, [])
    found = Whitening(n, sums, np.zeros(0), np.zeros((0, width)), 0.0)
    if n:
        covariance = _covariance(rows, found)
        values, axes = feast.leading(covariance, components)
        found = Whitening(n, sums, values, axes, float(np.trace(covariance)))
        found.identity_error = _identity_error(rows, found) if len(values) else 0.0
    return found


def whiten(vectors: DataFrame, found: Whitening, column: str = "embedding", key: str = "vec_id") -> DataFrame:
    """A row for each usable vector and component, by falling eigenvalue from 1 on."""
    width, k = len(found.sums), len(found.values)
    kind = vectors.schema[key].dataType.simpleString()
    rows = _rows(vectors, column, key).where(F.size("_v") == width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows or not k:
                continue
            x = _whole(batch.column("_v"), width)
            n = len(x)
            yield pa.record_batch({
                "vec_id": batch.column("_k").take(pa.array(np.repeat(np.arange(n), k))),
                "component": pa.array(np.tile(np.arange(1, k + 1), n), pa.int32()),
                "n": pa.array(np.full(n * k, found.n)),
                "deviation": pa.array(np.repeat(found.deviations(x), k)),
                "whitened": pa.array(found.whitened(x).ravel()),
                "explained": pa.array(np.tile(found.values / found.trace, n)),
                "identity_error": pa.array(np.full(n * k, found.identity_error)),
            })

    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    return rows.mapInArrow(run, schema)
