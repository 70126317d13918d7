"""Models fitted per feature: regressions in closed form, moderated statistics, user designs, set tests, jackknife."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..functions.ranks import add_bh
from ..functions.tails import digamma, inverse_trigamma, t_two_sided, trigamma
from .loops import tiled


@F.pandas_udf(DoubleType())
def t_tail(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([t_two_sided(a, b) for a, b in zip(t, df, strict=True)], dtype=float)


def simple_regression(df: DataFrame, by: Sequence[str], y: str, x: str) -> DataFrame:
    """Slope of y on x per group with its standard error, residual variance, degrees of freedom and t; null if x doesn't vary."""
    both = df.filter(F.col(y).isNotNull() & F.col(x).isNotNull())
    per = both.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.regr_sxx(y, x).alias("sxx"), F.regr_sxy(y, x).alias("sxy"), F.regr_syy(y, x).alias("syy"))
    slope = F.when(F.col("sxx") > 0, F.col("sxy") / F.col("sxx"))
    rows = per.withColumns({"slope": slope, "df": F.col("n") - 2})
    rows = rows.withColumn("s2", F.when(F.col("df") > 0, (F.col("syy") - F.col("slope") * F.col("sxy")) / F.col("df")))
    rows = rows.withColumn("se", F.sqrt(F.col("s2") / F.col("sxx")))
    return rows.select(*by, "n", "slope", "s2", "se", "df", (F.col("slope") / F.col("se")).alias("t"))


def moderate(fits: DataFrame) -> DataFrame:
    """fits with the t of a shrunken variance, its p and BH q. The prior variance and its degrees of freedom fit the mean and
    spread of the log variances, with digamma and trigamma terms; where they spread no more than chance, the prior alone counts.

    The prior is a row over all features; total degrees of freedom are no more than those of all features together.
    """
    logs = fits.filter("s2 > 0 and df > 0").withColumn("h", F.col("df") / 2.0)
    e = F.log("s2") - digamma(F.col("h")) + F.log("h")
    prior = logs.agg(F.avg(e).alias("m"), (F.coalesce(F.var_samp(e), F.lit(0.0)) - F.avg(trigamma(F.col("h")))).alias("v"), F.sum("df").alias("pooled"))
    prior = prior.withColumn("d0", F.when(F.col("v") > 0, 2 * inverse_trigamma(F.when(F.col("v") > 0, F.col("v")).otherwise(F.lit(1.0)))).otherwise(F.lit(float("inf"))))
    finite = F.col("d0") < float("inf")
    half = F.when(finite, F.col("d0") / 2).otherwise(F.lit(1.0))
    prior = prior.select("d0", "pooled", F.exp(F.col("m") + F.when(finite, digamma(half) - F.log(half)).otherwise(F.lit(0.0))).alias("s0"))
    rows = fits.join(F.broadcast(prior))
    s2 = F.when(F.col("d0") < float("inf"), (F.col("d0") * F.col("s0") + F.col("df") * F.col("s2")) / (F.col("d0") + F.col("df"))).otherwise(F.col("s0"))
    rows = rows.withColumn("moderated_t", F.col("slope") / (F.col("se") * F.sqrt(s2 / F.col("s2")))).withColumn("total_df", F.least(F.col("d0") + F.col("df"), F.col("pooled").cast("double")))
    return add_bh(rows.withColumn("p", t_tail("moderated_t", "total_df")), "p", "q").drop("s0", "d0", "pooled")


def fit_features(df: DataFrame, feature: str, y: str, design: Callable[[pd.DataFrame], np.ndarray], contrast: Sequence[float], weights: str | None = None) -> DataFrame:
    """(feature, estimate, se, df, p): weighted least squares per feature with a user's design and contrast.

    A feature's rows are its samples, which a study bounds; features are dealt over the tasks.
    """
    c = np.asarray(contrast, float)

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        x, v = np.asarray(design(rows), float), rows[y].to_numpy(float)
        w = np.sqrt(rows[weights].to_numpy(float)) if weights else np.ones(len(v))
        beta, _, rank, _ = np.linalg.lstsq(x * w[:, None], v * w, rcond=None)
        free = len(v) - rank
        if free <= 0 or rank < x.shape[1]:
            return pd.DataFrame({"feature": [rows[feature].iloc[0]], "estimate": [np.nan], "se": [np.nan], "df": [int(max(free, 0))], "p": [np.nan]})
        s2 = (((v - x @ beta) * w) ** 2).sum() / free
        se = float(np.sqrt(s2 * c @ np.linalg.inv((x * w[:, None]).T @ (x * w[:, None])) @ c))
        return pd.DataFrame({"feature": [rows[feature].iloc[0]], "estimate": [c @ beta], "se": [se], "df": [int(free)], "p": [t_two_sided(c @ beta / se, free) if se > 0 else np.nan]})

    kind = df.schema[feature].dataType.simpleString()
    return df.groupBy(feature).applyInPandas(fit, f"feature {kind}, estimate double, se double, df int, p double")


def set_test(stats: DataFrame, sets: DataFrame, correlation: float = 0.01) -> DataFrame:
    """(set, n, difference, t): mean statistic of a set's features against the rest, its variance inflated by a correlation."""
    whole = stats.agg(F.count("t").alias("m"), F.sum("t").alias("s"), F.sum(F.col("t") * F.col("t")).alias("ss"))
    own = stats.join(sets, "feature").groupBy("set").agg(F.count("t").alias("n"), F.sum("t").alias("s1"))
    rows = own.join(F.broadcast(whole)).filter("n > 1 and m > n")
    n, m = F.col("n"), F.col("m")
    difference = F.col("s1") / n - (F.col("s") - F.col("s1")) / (m - n)
    variance = (F.col("ss") - F.col("s") * F.col("s") / m) / (m - 1)
    se = F.sqrt(variance * ((1 + (n - 1) * correlation) / n + 1 / (m - n)))
    return rows.select("set", "n", difference.alias("difference"), (difference / se).alias("t"))


def block_crossproducts(df: DataFrame, order: Sequence[str], y: str, x: Sequence[str], n_blocks: int) -> DataFrame:
    """(block, i, j, value): cross-products of the predictors (with intercept, numbered from 0) and of them with y (j = -1)."""
    rows = tiled(df, order, n_blocks, "block")
    terms = [F.lit(1.0), *map(F.col, x)]
    wide = [F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), (a * (F.col(y) if j < 0 else terms[j])).cast("double").alias("value")) for i, a in enumerate(terms) for j in (-1, *range(len(terms)))]
    return rows.select("block", F.inline(F.array(*wide))).groupBy("block", "i", "j").agg(F.sum("value").alias("value"))


def jackknife(blocks: DataFrame, n_terms: int) -> DataFrame:
    """(term, estimate, se) of the regression and its delete-one-block jackknife; blocks are few and of fixed size."""

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        names = {b: k for k, b in enumerate(sorted(rows["block"].unique()))}
        xtx, xty = np.zeros((len(names), n_terms, n_terms)), np.zeros((len(names), n_terms))
        for b, i, j, v in rows[["block", "i", "j", "value"]].itertuples(index=False):
            if j < 0:
                xty[names[b], i] = v
            else:
                xtx[names[b], i, j] = v
        whole = np.linalg.solve(xtx.sum(0), xty.sum(0))
        each = np.stack([np.linalg.solve(xtx.sum(0) - a, xty.sum(0) - c) for a, c in zip(xtx, xty, strict=True)])
        k = len(names)
        return pd.DataFrame({"term": range(n_terms), "estimate": whole, "se": np.sqrt((k - 1) / k * ((each - each.mean(0)) ** 2).sum(0))})

    return blocks.groupBy(F.lit(1).alias("one")).applyInPandas(solve, "term int, estimate double, se double")
