"""Embedding whitening: components of the covariance by FEAST contour integration.

Entries become whole numbers, so sums and products over all vectors are exact
and do not depend on the order of tasks:

1. number of vectors and per-dimension sums (one row per task, added up);
2. products of the vectors centred at the rounded means, each row of the matrix
   added up by two levels of groups, and the covariance from them exactly, with
   one rounding per entry;
3. eigenpairs of this matrix (``feast``), on the driver: its order is the number
   of dimensions, whatever the input;
4. projection, and the covariance of the result against the identity.

Steps 1, 2 and 4 each read the vectors again and keep one batch and one matrix in
memory.

Null vectors, and vectors with null, NaN or infinite entries, or entries beyond
2^52, take no part.  All vectors must be of one length: where lengths differ, the
most frequent one (of ties the longest) is fitted and the others take no part;
empty vectors never do.  A component needs variance: of a covariance of lower rank
there are fewer components, of equal vectors or a single one none (no rows).
Repeated rows count as often as they occur; null ids are rows.  ``deviation`` is
null where it exceeds a long.  Other columns are not read.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurewright.llm.common import freeing
from featurewright.llm.feast import largest

SCALE, OFFSET, COMPONENTS, FAN = 1024, 100_000, 8, 256
_ROWS = 4096


def _vectors(frame: DataFrame, id_col: str, vec_col: str, scale: int) -> tuple[DataFrame, int]:
    """vec_id, v (array<double>) of the rows that take part, and their length (0: there are none)."""
    v = F.col(vec_col).cast("array<double>")
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < 2.0**52 / scale))
    rows = frame.select(F.col(id_col).alias("vec_id"), F.when(good & (F.size(v) > 0), v).alias("v")).where("v IS NOT NULL")
    lengths = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    d = lengths[0]["d"] if lengths else 0
    return rows.where(F.size("v") == d), d


def _blocks(batches, d: int, scale: int, offset: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """(ids, whole-number vectors) of at most ``_ROWS`` rows each."""
    for b in batches:
        for lo in range(0, b.num_rows, _ROWS):
            part = b.slice(lo, _ROWS)
            x = part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            yield part.column(0), np.floor(x * scale).astype(np.int64) + offset


def _products(y: np.ndarray) -> np.ndarray:
    """y^T y in whole numbers: by doubles where every sum is below 2^53, else by Python's numbers."""
    high = int(np.abs(y).max(initial=0))
    if high * high * len(y) < 2**53:
        f = y.astype(np.float64)
        return (f.T @ f).astype(np.int64).astype(object)
    o = y.astype(object)
    return o.T @ o


def _per_task(rows: DataFrame, d: int, scale: int, offset: int, block: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """Sum of ``block`` over each task's vectors, as (part, i, total): one row per row of the matrix."""
    def run(batches):
        total = None
        for _, x in _blocks(batches, d, scale, offset):
            one = block(x)
            total = one if total is None else total + one
        if total is not None:
            n = len(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()] * n, pa.int32()), pa.array(range(n), pa.int32()), pa.array([pickle.dumps(r) for r in total], pa.binary())],
                ["part", "i", "total"])

    return rows.select("vec_id", "v").mapInArrow(freeing(run), "part int, i int, total binary")


def _sum_rows(t: pa.Table) -> pa.Table:
    if not t.num_rows:
        return pa.table({"i": pa.array([], pa.int32()), "total": pa.array([], pa.binary())})
    total = sum(pickle.loads(b) for b in t.column("total").to_pylist())
    return pa.table({"i": pa.array([t.column("i")[0].as_py()], pa.int32()), "total": pa.array([pickle.dumps(total)], pa.binary())})


def _matrix(parts: DataFrame) -> np.ndarray:
    """The sum over all tasks: by (row, part mod FAN), then by row; as many rows as the matrix has are collected."""
    some = parts.groupBy("i", F.pmod("part", F.lit(FAN)).alias("f")).applyInArrow(_sum_rows, "i int, total binary")
    rows = some.groupBy("i").applyInArrow(_sum_rows, "i int, total binary").collect()
    return np.array([pickle.loads(r["total"]) for r in sorted(rows, key=lambda r: r["i"])])


class Whitener:
    """Fitted state: n, the sums S, the covariance, and its components; all of the size of the dimensions."""

    def __init__(self, n: int, sums: list[int], products: np.ndarray, k: int):
        self.n, self.sums = n, sums
        self.center = [(2 * s + n) // (2 * n) for s in sums]
        self.rest = [s - n * c for s, c in zip(sums, self.center)]  # of each dimension, n * (mean - center)
        d = len(sums)
        self.covariance = np.array([[(n * int(products[i, j]) - self.rest[i] * self.rest[j]) / n**2 for j in range(d)] for i in range(d)])
        self.values, self.vectors = largest(self.covariance, k)
        trace = sum((n * int(products[i, i]) - self.rest[i] ** 2) for i in range(d)) / n**2
        self.explained = self.values / trace if trace else self.values
        self.weights = self.vectors / np.sqrt(self.values)

    def whiten(self, x: np.ndarray) -> np.ndarray:
        y = x - np.array(self.center, np.int64)
        return (y - np.array(self.rest, np.float64) / self.n) @ self.weights

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n * x - S)^2."""
        y = x - np.array(self.center, np.int64)
        high = (int(np.abs(y).max(initial=0)) + 1) * self.n
        if high * high * x.shape[1] < 2**63:
            return ((y * self.n - np.array(self.rest, np.int64)) ** 2).sum(axis=1).tolist()
        exact = ((y.astype(object) * self.n - np.array(self.rest, object)) ** 2).sum(axis=1)
        return [int(v) if v < 2**63 else None for v in exact]


def fit(rows: DataFrame, d: int, k: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET) -> Whitener:
    """``rows``: vec_id, v of length d, at least one."""
    counted = _matrix(_per_task(rows, d, scale, offset, lambda x: np.array([[len(x), *(int(s) for s in x.astype(object).sum(axis=0))]], dtype=object)
                                if int(np.abs(x).max(initial=0)) * len(x) >= 2**62 else np.array([[len(x), *x.sum(axis=0).tolist()]], dtype=object)))[0]
    n, sums = int(counted[0]), [int(s) for s in counted[1:]]
    center = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)
    return Whitener(n, sums, _matrix(_per_task(rows, d, scale, offset, lambda x: _products(x - center))), k)


def identity_error(rows: DataFrame, d: int, w: Whitener, scale: int = SCALE, offset: int = OFFSET) -> float:
    """Largest absolute entry of the whitened vectors' covariance minus the identity, measured on the vectors."""
    def block(x: np.ndarray) -> np.ndarray:
        z = w.whiten(x)
        return np.concatenate([z.sum(axis=0)[None], z.T @ z])

    total = _matrix(_per_task(rows, d, scale, offset, block)) / w.n
    return float(np.abs(total[1:] - np.outer(total[0], total[0]) - np.eye(len(total[0]))).max(initial=0))


def whiten(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """Per vector and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    rows, d = _vectors(vectors, id_col, vec_col, scale)
    id_type = rows.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {id_type}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    if not d:
        return vectors.sparkSession.createDataFrame([], schema)
    w = fit(rows, d, k, scale, offset)
    c = len(w.values)
    if not c:
        return vectors.sparkSession.createDataFrame([], schema)
    error = identity_error(rows, d, w, scale, offset)

    def run(batches):
        for ids, x in _blocks(batches, d, scale, offset):
            m = len(ids)
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(np.repeat(np.arange(m), c))), pa.array(np.tile(np.arange(1, c + 1, dtype=np.int32), m)), pa.array(np.full(m * c, w.n, np.int64)),
                 pa.array(w.deviation(x), pa.int64()).take(pa.array(np.repeat(np.arange(m), c))), pa.array(w.whiten(x).ravel()),
                 pa.array(np.tile(w.explained, m)), pa.array(np.full(m * c, error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(freeing(run), schema)


def op13_feast_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
