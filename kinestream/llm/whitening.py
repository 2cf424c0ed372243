"""Embedding whitening: leading components of the covariance by Jacobi-Davidson on distributed centred products."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinestream.llm import jacobi
from kinestream.llm.common import free_name, written

SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8
#: Entries of x are held to this, which doubles still hold exactly.
LARGEST = 1 << 52
#: Partial sums of so many tasks go to the driver; those of more are added by their square root of tasks first.
FAN = 64
#: An eigenvalue of this share of the largest one, or less, is zero.
ZERO = 1e-11
_LONG = (1 << 63) - 1


def integers(vector: Column) -> Column:
    """The x-vector: floor(1024 * c) + 100000 of each entry as long. Null if it is null or empty or an entry is null or not finite.

    Entries whose x would be beyond 2**52 are held to that.
    """
    scaled = F.transform(vector, lambda c: F.least(F.greatest(SCALE * c.cast("double"), F.lit(-float(LARGEST))), F.lit(float(LARGEST))))
    real = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    return F.when(real & (F.size(vector) > 0), F.transform(scaled, lambda c: F.floor(c) + F.lit(OFFSET)))


def _matrix(column: pa.ListArray, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


@dataclass(frozen=True)
class Whitening:
    """What a table's fit is: rows and exact sums of its x-vectors, trace of the covariance, eigenvalues and unit eigenvectors as columns."""

    n: int
    sums: list[int]
    trace: float
    values: np.ndarray
    vectors: np.ndarray
    identity_error: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n in doubles, the whole part of the mean taken off before rounding."""
        whole = np.array([s // self.n for s in self.sums])
        return (x - whole).astype(np.float64) - np.array([s % self.n / self.n for s in self.sums])

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum of (n * x - S)**2 over each row, exact; null beyond a long."""
        if self.n * max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) + max(map(abs, self.sums)) <= _LONG:
            apart = self.n * x - np.array(self.sums)
            if max(abs(int(apart.max(initial=0))), abs(int(apart.min(initial=0)))) ** 2 * len(self.sums) <= _LONG:
                return (apart**2).sum(1).tolist()
        exact = ((self.n * x.astype(object) - np.array(self.sums, dtype=object)) ** 2).sum(1)
        return [v if v <= _LONG else None for v in exact.tolist()]


def _size(x: DataFrame, col: str) -> int:
    """The most frequent length, the shorter of equals; 0 without rows."""
    found = x.groupBy(F.size(col).alias("size")).count().orderBy(F.desc("count"), "size").head()
    return found["size"] if found else 0


def _sums(x: DataFrame, col: str, size: int) -> tuple[int, list[int]]:
    """Rows and the exact sum of each entry."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * size
        for b in batches:
            m = _matrix(b.column(0), size)
            n += len(m)
            high, low = (m >> 26).sum(0).tolist(), (m & ((1 << 26) - 1)).sum(0).tolist()  # no batch overflows in either half
            total = [t + (h << 26) + v for t, h, v in zip(total, high, low, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, size), pa.int32()), pa.array(map(str, [n, *total]))], names=["at", "total"])

    found = x.select(col).mapInArrow(partial, "at int, total string").groupBy("at").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    by = {r["at"]: int(r["total"]) for r in found}
    return by.get(-1, 0), [by.get(i, 0) for i in range(size)]


def _added(blocks: DataFrame, tasks: int, width: int, part) -> np.ndarray:
    """Sum over all blocks of what ``part`` makes of one, a flat array of ``width`` doubles."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for b in batches:
            for raw in b.column(0):
                total += part(np.frombuffer(raw.as_buffer(), np.float64)).ravel()
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["block"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for b in batches:
            for raw in b.column(0):
                total += np.frombuffer(raw.as_buffer(), np.float64)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["block"])

    sums = blocks.mapInArrow(partial, "block binary")
    if tasks > FAN:
        sums = sums.repartition(math.isqrt(tasks)).mapInArrow(add, "block binary")
    return np.sum([np.frombuffer(r["block"], np.float64) for r in sums.collect()] or [np.zeros(width)], axis=0)


def fit(df: DataFrame, vec_col: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """Fit on all rows of ``df`` whose vector has an x-vector of the most frequent length. None without such a row.

    Two passes give the exact sums and a table of centred blocks in the shared folder. Every step of the solver is one pass over the blocks that brings back
    partial products of ``size`` x some 12 numbers; the covariance is never formed. Eigenvalues of zero are left out.
    """
    name = free_name(df, "x")
    x = df.select(integers(F.col(vec_col)).alias(name)).where(F.col(name).isNotNull())
    size = _size(x, name)
    if not size:
        return None
    x = x.where(F.size(name) == size)
    n, sums = _sums(x, name, size)
    bare = Whitening(n, sums, 0.0, np.zeros(0), np.zeros((size, 0)), 0.0)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([bare.centred(_matrix(b.column(0), size)).tobytes()], pa.binary())], names=["block"])

    blocks = written(x.mapInArrow(packed, "block binary"), "centred-vectors")
    tasks = blocks.rdd.getNumPartitions()

    def product(w: np.ndarray) -> np.ndarray:
        def part(raw):
            m = raw.reshape(-1, size)
            return m.T @ (m @ w)

        return _added(blocks, tasks, w.size, part).reshape(w.shape) / n

    trace = float(_added(blocks, tasks, 1, lambda raw: np.array([raw @ raw]))[0]) / n
    values, vectors = jacobi.leading(product, size, components)
    some = values > ZERO * values[0] if trace > 0 else np.zeros(len(values), bool)
    values, vectors = values[some], vectors[:, some]
    k = len(values)
    to_white = vectors / np.sqrt(values)

    def moments(raw):
        w = raw.reshape(-1, size) @ to_white
        return np.vstack([w.T @ w, w.sum(0)])

    got = _added(blocks, tasks, (k + 1) * k, moments).reshape(k + 1, k) / n if k else np.zeros((1, 0))
    mean = got[k]
    error = float(np.abs(got[:k] - np.outer(mean, mean) - np.eye(k)).max(initial=0.0))
    return Whitening(n, sums, trace, values, vectors, error)


def whitened(df: DataFrame, model: Whitening | None, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """A row for each row of ``df`` with a usable vector and each component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Rows whose vector is null, empty, of another length than the fit's, or holds a null or an entry that is not finite are dropped. Ids may be null and may repeat;
    repeated rows count each. Of equal eigenvalues any unit vectors at right angles are the components. If the vectors have fewer dimensions or vary in fewer directions than
    components are wanted, there are as many components as directions; a table of equal vectors, or without any, gives no row. A deviation beyond a long is null. Other columns are not read.
    """
    kind = df.select(F.col(id_col).alias("vec_id")).schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None or not len(model.values):
        return df.sparkSession.createDataFrame([], schema)
    size, k = len(model.sums), len(model.values)
    explained = model.values / model.trace
    to_white = model.vectors / np.sqrt(model.values)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b.column(1), size)
            rows = len(x)
            white = model.centred(x) @ to_white
            each = np.repeat(np.arange(rows), k)
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0).take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * k, model.n, np.int64)),
                    pa.array(model.deviations(x), pa.int64()).take(pa.array(each)),
                    pa.array(white.ravel()),
                    pa.array(np.tile(explained, rows)),
                    pa.array(np.full(rows * k, model.identity_error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    x = df.select(F.col(id_col).alias("vec_id"), integers(F.col(vec_col)).alias("x")).where(F.col("x").isNotNull() & (F.size("x") == size))
    return x.mapInArrow(scored, schema)
