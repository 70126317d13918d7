"""Embedding whitening: pivoted Cholesky of the centred scatter, then one-sided Jacobi on the triangular factor.

Entries are quantised to integers, so sums, means and the scatter matrix are exact whatever the order of rows. Spark adds up the
scatter task by task; a matrix of dimension x dimension, however many rows there are, is factored on the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, quoted

#: Entries become floor(SCALE * c) + SHIFT; beyond LIMIT, scaled entries are held at it, so that integers stay exact.
SCALE, SHIFT, LIMIT = 64, 1_000_000, 1 << 40
COMPONENTS = 16
_ROWS = 2_048


@dataclass
class Whitening:
    """n distinct vectors with sums by dimension; components as columns, with their eigenvalues, falling; trace of the covariance."""

    n: int
    sums: list[int]
    values: np.ndarray
    components: np.ndarray
    trace: float

    @property
    def size(self) -> int:
        return len(self.sums)


def pivoted_cholesky(a: np.ndarray) -> np.ndarray:
    """G of shape (d, rank) with G G' = a for a positive semidefinite matrix: lower triangular but for the rows' order. Each step takes the
    largest diagonal entry that is left; it ends where each is at the rounding level of the entry that was there first."""
    d = len(a)
    left, out = np.array(a, np.longdouble), np.zeros((d, d), np.longdouble)
    floor = 16 * d * np.finfo(np.longdouble).eps * np.diag(left)
    for r in range(d):
        diagonal = np.where(np.diag(left) > floor, np.diag(left), 0)
        p = int(np.argmax(diagonal))
        if not diagonal[p] > 0:
            return out[:, :r]
        out[:, r] = left[:, p] / np.sqrt(diagonal[p])
        left -= np.outer(out[:, r], out[:, r])
        left[p, :] = left[:, p] = 0
    return out


def one_sided_jacobi(g: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """(values, components) of G G', falling: columns of G are rotated in pairs until all are orthogonal; squared norms are the eigenvalues
    and normalised columns the components. Raises if so many sweeps don't get there."""
    g = np.array(g, np.longdouble)
    for _ in range(sweeps):
        turned = False
        for p in range(g.shape[1] - 1):
            for q in range(p + 1, g.shape[1]):
                a, b, c = g[:, p] @ g[:, p], g[:, q] @ g[:, q], g[:, p] @ g[:, q]
                if abs(c) <= 1e-17 * np.sqrt(a * b):
                    continue
                turned = True
                zeta = (b - a) / (2 * c)
                t = (1 if zeta >= 0 else -1) / (abs(zeta) + np.sqrt(1 + zeta * zeta))
                cos = 1 / np.sqrt(1 + t * t)
                g[:, p], g[:, q] = cos * (g[:, p] - t * g[:, q]), cos * (g[:, q] + t * g[:, p])
        if not turned:
            norms = (g * g).sum(0)
            order = np.argsort(-norms, kind="stable")
            return norms[order], g[:, order] / np.sqrt(norms[order])
    raise RuntimeError(f"one_sided_jacobi: columns aren't orthogonal after {sweeps} sweeps")


def quantised(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, x) of rows whose vector is there and holds neither nulls nor non-finite entries; x: array of integers."""
    v = F.col(quoted(vector_col)).cast("array<double>")
    rows = vectors.select(F.col(quoted(id_col)).alias("id"), v.alias("v"))
    fine = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    scaled = F.transform("v", lambda c: F.floor(F.greatest(F.least(c * SCALE, F.lit(float(LIMIT))), F.lit(-float(LIMIT)))).cast("bigint") + SHIFT)
    return rows.filter(F.col("v").isNotNull() & F.coalesce(fine, F.lit(False))).select("id", scaled.alias("x"))


def _matrix(column: pa.ListArray, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _product(x: np.ndarray) -> list[list[int]] | np.ndarray:
    """X'X exactly: by floats where every sum stays under 2^53, else by integers of any size."""
    top = int(np.abs(x).max(initial=0))
    if top * top * len(x) < 1 << 53:
        y = x.astype(np.float64)
        return (y.T @ y).astype(np.int64).astype(object)
    y = x.astype(object)
    return y.T @ y


def _summed(df: DataFrame, value: str) -> dict[tuple[int, int], object]:
    """Adds up (i, j, value) rows; d x d of them reach the driver."""
    return {(r[0], r[1]): r[2] for r in df.groupBy("i", "j").agg(F.sum(value)).collect()}


def _cells(total: np.ndarray, kind: pa.DataType) -> pa.RecordBatch:
    d0, d1 = total.shape
    i, j = np.divmod(np.arange(d0 * d1), d1)
    return pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total.ravel().tolist(), kind)], names=["i", "j", "value"])


_EXACT = pa.decimal128(38, 0)


def fit(distinct: DataFrame, size: int) -> Whitening:
    """The whitening of distinct integer vectors (x) of one size; two passes: sums, then the scatter around the mean."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((1, size + 1), object)
        for batch in batches:
            x = _matrix(batch.column(0), size)
            total[0, :size] += x.sum(0).astype(object)  # 2^22 rows of a batch would fit
            total[0, size] += len(x)
        yield _cells(total, _EXACT)

    found = _summed(distinct.select("x").mapInArrow(sums, "i int, j int, value decimal(38,0)"), "value")
    total = [int(found.get((0, j), 0)) for j in range(size + 1)]
    n, sums_ = total[size], total[:size]
    if not n:
        return Whitening(0, [0] * size, np.zeros(0), np.zeros((size, 0)), 0.0)
    middle = np.array([(2 * s + n) // (2 * n) for s in sums_], np.int64)  # the mean, to the next integer

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = np.zeros((size, size), object)
        for batch in batches:
            x = _matrix(batch.column(0), size) - middle
            for lo in range(0, len(x), _ROWS):
                whole += _product(x[lo : lo + _ROWS])
        yield _cells(whole, _EXACT)

    found = _summed(distinct.select("x").mapInArrow(products, "i int, j int, value decimal(38,0)"), "value")
    rest = [s - n * int(m) for s, m in zip(sums_, middle, strict=True)]
    scatter = [[n * int(found[i, j]) - rest[i] * rest[j] for j in range(size)] for i in range(size)]  # n^2 times the covariance
    covariance = np.array([[np.longdouble(v // (n * n)) + np.longdouble((v % (n * n)) / (n * n)) for v in row] for row in scatter], np.longdouble)
    values, components = one_sided_jacobi(pivoted_cholesky(covariance))
    return Whitening(n, sums_, values.astype(float), components.astype(float), sum(scatter[i][i] for i in range(size)) / (n * n))


def project(x: np.ndarray, model: Whitening, k: int) -> np.ndarray:
    """Whitened coordinates of integer vectors on the first k components."""
    middle = np.array([(2 * s + model.n) // (2 * model.n) for s in model.sums], np.int64)
    rest = np.array([(s - model.n * int(m)) / model.n for s, m in zip(model.sums, middle, strict=True)])
    return ((x - middle) - rest) @ (model.components[:, :k] / np.sqrt(model.values[:k]))


def identity_error(distinct: DataFrame, model: Whitening, k: int) -> float:
    """Largest absolute entry of the covariance of whitened fit vectors, minus the identity."""
    size = model.size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = np.zeros((k + 1, k))
        for batch in batches:
            w = project(_matrix(batch.column(0), size), model, k)
            whole[:k] += w.T @ w
            whole[k] += w.sum(0)
        yield _cells(whole, pa.float64())

    found = _summed(distinct.select("x").mapInArrow(run, "i int, j int, value double"), "value")
    whole = np.array([[found[i, j] for j in range(k)] for i in range(k + 1)]) / model.n
    return float(np.abs(whole[:k] - np.outer(whole[k], whole[k]) - np.eye(k)).max())


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = COMPONENTS) -> DataFrame:
    """(id, n, deviation, whitened, explained, identity_error), one row for each row that stays: deviation is decimal, the squared
    distance from the mean times n^2 (null from 10^38 on), whitened and explained are arrays of up to k components.

    The fit list has each distinct quantised vector once. Vectors that are null, or hold nulls or non-finite entries, are
    dropped; so are empty ones, and those of another size than most distinct vectors (ties: the greater size). Repeated
    rows and null ids stay. There are as many components as the covariance has rank; with none (fewer than two distinct
    vectors) the arrays are empty and identity_error is null. Other columns are ignored; an empty table gives an empty one.
    """
    rows = quantised(vectors, id_col, vector_col)
    kind = rows.schema["id"].dataType.simpleString()
    distinct = cut(rows.select("x").distinct())
    most = distinct.groupBy(F.size("x").alias("size")).agg(F.count(F.lit(1)).alias("n")).filter("size > 0").orderBy(F.desc("n"), F.desc("size")).first()
    size = most["size"] if most else 0
    distinct = distinct.filter(F.size("x") == size)
    model = fit(distinct, size) if size else Whitening(0, [], np.zeros(0), np.zeros((0, 0)), 0.0)
    m = min(k, len(model.values))
    error = identity_error(distinct, model, m) if m else None
    explained = [float(v) for v in model.values[:m] / model.trace] if m else []
    middle = np.array([(2 * s + model.n) // (2 * model.n) for s in model.sums], np.int64) if model.n else np.zeros(size, np.int64)
    rest = [s - model.n * int(c) for s, c in zip(model.sums, middle, strict=True)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, len(batch), _ROWS):
                part = batch.slice(lo, _ROWS)
                x = _matrix(part.column(1), size)
                y = x - middle
                top = model.n * int(np.abs(y).max(initial=0)) + max(map(abs, rest))
                if top * top * size < 1 << 62:
                    z = y * model.n - np.array(rest, np.int64)
                    away = (z * z).sum(1).tolist()
                else:
                    z = y.astype(object) * model.n - np.array(rest, object)
                    away = [v if v < 10**38 else None for v in (z * z).sum(1)]
                w = project(x, model, m)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * m, pa.int32()), pa.array(w.ravel(), pa.float64()))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(away, _EXACT), lists], names=["id", "deviation", "whitened"])

    found = rows.filter((F.size("x") == size) & F.lit(size > 0)).mapInArrow(run, f"id {kind}, deviation decimal(38,0), whitened array<double>")
    return found.select("id", F.lit(model.n).cast("bigint").alias("n"), "deviation", "whitened", F.array(*map(F.lit, explained)).cast("array<double>").alias("explained"), F.lit(error).cast("double").alias("identity_error"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    long = found.select(F.col("id").alias("vec_id"), "n", F.col("deviation").try_cast("bigint").alias("deviation"), "explained", "identity_error", F.posexplode("whitened").alias("i", "whitened"))
    return long.select("vec_id", (F.col("i") + 1).cast("int").alias("component"), "n", "deviation", "whitened", F.get("explained", F.col("i")).alias("explained"), "identity_error")
