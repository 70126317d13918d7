"""Ranks, multiple testing and scaling as window expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def correlation(x: str, y: str) -> Column:
    """Pearson correlation over rows that have both; null where one of them doesn't vary (there F.corr divides by zero)."""
    return F.try_divide(F.regr_sxy(y, x), F.sqrt(F.regr_sxx(y, x)) * F.sqrt(F.regr_syy(y, x)))


def average_rank(value: str, by: Sequence[str] = ()) -> Column:
    """Rank from 1 in which ties share their mean rank; nulls get null."""
    w = Window.partitionBy(*by)
    rank = F.rank().over(w.orderBy(F.col(value).asc_nulls_last()))
    ties = F.count(value).over(Window.partitionBy(*by, value))
    return F.when(F.col(value).isNotNull(), rank + (ties - 1) / 2)


def add_bh(df: DataFrame, p: str, out: str = "q", by: Sequence[str] = (), count_nulls: bool = False) -> DataFrame:
    """Benjamini-Hochberg q values within each family; null p stay null and count in the family only if count_nulls."""
    every = Window.partitionBy(*by)
    n = F.count(F.lit(1)).over(every) if count_nulls else F.count(p).over(every)
    rank = F.row_number().over(every.orderBy(F.col(p).asc_nulls_last()))
    raw = df.withColumn("_bh", F.when(F.col(p).isNotNull(), F.col(p) * n / rank))
    down = every.orderBy(F.col(p).desc_nulls_first()).rangeBetween(Window.unboundedPreceding, Window.currentRow)  # ties together
    return raw.withColumn(out, F.when(F.col(p).isNotNull(), F.least(F.lit(1.0), F.min("_bh").over(down)))).drop("_bh")


def top_n(df: DataFrame, n: int, order: Sequence[Column], by: Sequence[str] = (), ties: bool = False, out: str | None = None) -> DataFrame:
    """First n rows of each group in the given order; ties: rows equal to the last one stay too."""
    w = Window.partitionBy(*by).orderBy(*order)
    name = out or "_top"
    kept = df.withColumn(name, (F.rank() if ties else F.row_number()).over(w).cast("bigint")).filter(F.col(name) <= n)
    return kept if out else kept.drop(name)


def natural_key(label: Column, width: int = 12) -> Column:
    """Sort key in which digit runs compare as numbers: `2` before `10`."""
    padded = F.regexp_replace(label, r"(\d+)", "0" * width + "$1")
    return F.regexp_replace(padded, rf"0*(\d{{{width}}})(?!\d)", "$1")


def zscore(x: str, by: Sequence[str] = ()) -> Column:
    """Standardised value; 0 where the group doesn't vary."""
    w = Window.partitionBy(*by)
    sd = F.stddev_samp(x).over(w)
    return F.when(sd > 0, (F.col(x) - F.avg(x).over(w)) / sd).otherwise(F.lit(0.0))


def min_max(x: str, by: Sequence[str] = ()) -> Column:
    w = Window.partitionBy(*by)
    low, high = F.min(x).over(w), F.max(x).over(w)
    return F.when(high > low, (F.col(x) - low) / (high - low)).otherwise(F.lit(0.0))


def share(x: str, by: Sequence[str]) -> Column:
    """Value over the sum of its group; 0 where that is 0."""
    total = F.sum(x).over(Window.partitionBy(*by))
    return F.when(total != 0, F.col(x) / total).otherwise(F.lit(0.0))


def spearman(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """(by..., rho, n): rank correlation with average ties over rows that have both values."""
    both = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    ranked = both.withColumn("_x", average_rank(x, by)).withColumn("_y", average_rank(y, by))
    return ranked.groupBy(*by).agg(correlation("_x", "_y").alias("rho"), F.count(F.lit(1)).alias("n"))
