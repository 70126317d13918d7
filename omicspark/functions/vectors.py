"""Vectors as array<double> columns."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x))


def unit(v: Column) -> Column:
    """Vector of length 1; a zero vector stays."""
    return F.when(norm(v) > 0, F.transform(v, lambda x: x / norm(v))).otherwise(v)


def distance(a: Column, b: Column) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))


def chosen(v: Column, dims: Sequence[int]) -> Column:
    """Dimensions by place, from 1."""
    return F.array(*[F.element_at(v, d) for d in dims])


def to_columns(df: DataFrame, vector: str, n: int, prefix: str) -> DataFrame:
    return df.select(*[c for c in df.columns if c != vector], *[F.element_at(vector, i).alias(f"{prefix}{i}") for i in range(1, n + 1)])


def mean_of_neighbours(edges: DataFrame, vectors: DataFrame, src: str, dst: str, key: str, vector: str) -> DataFrame:
    """(src, mean vector) over each row's neighbours."""
    long = edges.join(vectors.select(F.col(key).alias(dst), vector), dst).select(src, F.posexplode(vector).alias("i", "x"))
    per = long.groupBy(src, "i").agg(F.avg("x").alias("x"))
    return per.groupBy(src).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda e: e["x"]).alias(vector))


def jump_hash(n: int):  # noqa: ANN201
    """Consistent bucket 0..n-1 of a 64-bit key: growing n moves only the keys of the new buckets."""

    @F.pandas_udf("int")
    def bucket(keys: pd.Series) -> pd.Series:
        key = keys.to_numpy().astype(np.uint64)
        b, j = np.full(len(key), -1, np.int64), np.zeros(len(key), np.int64)
        while (live := j < n).any():
            b = np.where(live, j, b)
            key = np.where(live, key * np.uint64(2862933555777941757) + np.uint64(1), key)
            step = (b + 1) * (float(1 << 31) / ((key >> np.uint64(33)).astype(np.float64) + 1))
            j = np.where(live, np.minimum(step, 2**62).astype(np.int64), j)
        return pd.Series(b.astype(np.int32))

    return bucket
