"""Counts per feature by negative binomial models: dispersions shrunken to a trend, quasi-likelihood tests, and the choice between
this and the other fits of `differential` by what the data are.

counts: (feature, sample, count, size) with zeros filled in, as `differential.expressed` gives them; size is a sample's (effective)
total. A feature's rows are bounded by the samples of a study, so features are dealt over tasks; what passes between the steps is a
likelihood curve a feature (`GRID` numbers) and one trend row of at most `bins` such curves.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ranks import add_bh
from .differential import _wide, consensus_correlation, differential_table, expressed, fit_contrasts, mean_variance_weights
from .loops import cut
from .models import moderate

GRID = np.arange(-14.0, 4.5, 0.5)  # log2 of the dispersions at which a feature's likelihood is known
_lgamma = np.vectorize(math.lgamma, otypes=[float])


def deviance(y: np.ndarray, mu: np.ndarray, phi: np.ndarray) -> np.ndarray:
    """Negative binomial deviance over the last axis; phi (> 0) has one entry a row of mu."""
    p = phi[:, None]
    ratio = np.where(y > 0, y * np.log(np.where(y > 0, y, 1.0) / mu), 0.0)
    return 2 * (ratio - (y + 1 / p) * np.log1p(p * (y - mu) / (1 + p * mu))).sum(-1)


def fit_counts(y: np.ndarray, offset: np.ndarray, x: np.ndarray, phi: np.ndarray, rounds: int = 200, tolerance: float = 1e-11) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Coefficients, means, deviance and whether it settled, of a log-linear fit at each dispersion: scoring steps, halved where they
    would raise the deviance. Groups of zeros only have no finite coefficient; their means go towards 0 until the deviance settles."""
    if not x.shape[1]:
        mu = np.broadcast_to(np.exp(offset), (len(phi), len(y)))
        return np.zeros((len(phi), 0)), mu, deviance(y, mu, phi), np.ones(len(phi), bool)
    means = lambda b: np.exp(np.clip(b @ x.T + offset, -50.0, 50.0))
    beta = np.repeat(np.linalg.lstsq(x, np.log(y + 0.5) - offset, rcond=None)[0][None], len(phi), 0)
    mu = means(beta)
    dev = deviance(y, mu, phi)
    settled = np.zeros(len(phi), bool)
    for _ in range(rounds):
        damp = 1 + phi[:, None] * mu
        score = ((y - mu) / damp) @ x
        info = np.einsum("gn,nk,nl->gkl", mu / damp, x, x)
        ridge = 1e-12 * np.maximum(np.einsum("gkk->gk", info).max(1), 1e-290)
        step = np.linalg.solve(info + ridge[:, None, None] * np.eye(x.shape[1]), score[:, :, None])[:, :, 0]
        size = np.where(settled, 0.0, 1.0)
        for _ in range(40):
            trial = beta + size[:, None] * step
            new_mu = means(trial)
            new = deviance(y, new_mu, phi)
            worse = ~(new <= dev + 1e-13 * (np.abs(dev) + 1))
            if not worse.any():
                break
            size = np.where(worse, size / 2, size)
        better = ~worse & ~settled
        gain = np.where(better, dev - new, 0.0)
        beta, mu, dev = np.where(better[:, None], trial, beta), np.where(better[:, None], new_mu, mu), np.where(better, new, dev)
        settled |= gain <= tolerance * (np.abs(dev) + 0.1)
        if settled.all():
            break
    return beta, mu, dev, settled


def adjusted_likelihoods(y: np.ndarray, offset: np.ndarray, x: np.ndarray, grid: np.ndarray = GRID) -> np.ndarray:
    """Log likelihood at each dispersion 2^grid at its own best coefficients, less half the log determinant of their information
    (Cox and Reid), so that fitted coefficients don't pull the dispersion down."""
    phi = 2.0**grid
    _, mu, _, _ = fit_counts(y, offset, x, phi)
    p, r = phi[:, None], 1 / phi[:, None]
    known, at = np.unique(y, return_inverse=True)
    gammas = (_lgamma(known + r) - _lgamma(r) - _lgamma(known + 1))[:, at]
    log = gammas + y * np.log(p * mu) - (y + r) * np.log1p(p * mu)
    info = np.einsum("gn,nk,nl->gkl", mu / (1 + p * mu), x, x)
    return log.sum(-1) - 0.5 * np.log(np.maximum(np.linalg.eigvalsh(info), 1e-10)).sum(-1)


def best_dispersion(curve: np.ndarray, grid: np.ndarray = GRID) -> float:
    """2^place of a curve's maximum, by the parabola through its highest entry and its neighbours; an end of the grid stays."""
    i = int(np.argmax(curve))
    place = grid[i]
    if 0 < i < len(grid) - 1:
        a, b, c = curve[i - 1 : i + 2]
        if a - 2 * b + c < 0:
            place += 0.5 * (a - c) / (a - 2 * b + c) * (grid[1] - grid[0])
    return float(2.0**place)


def _read(rows: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    r = [e for e in rows if e["weight"] is not None and e["weight"] > 0 and e["value"] is not None]
    return np.array([e["value"] for e in r], float), np.log(np.array([e["weight"] for e in r], float)), np.array([e["_x"] for e in r], float)


def dispersion_curves(counts: DataFrame, samples: DataFrame, names: Sequence[str]) -> DataFrame:
    """(feature, rows, mean, curve): each feature's samples as one array, the log2 of its counts per million, and its adjusted
    likelihoods; curve is null for features without counts or with no more samples than columns. Samples of size 0 are left out."""

    @F.pandas_udf("struct<mean:double,curve:array<double>>")
    def curves(rows: pd.Series) -> pd.DataFrame:
        out = []
        for r in rows:
            y, offset, x = _read(list(r))
            usable = len(y) > 0 and y.sum() > 0 and len(y) > x.shape[1] and np.linalg.matrix_rank(x) == x.shape[1]
            mean = float(np.log2((y.sum() + 0.5) / np.exp(offset).sum() * 1e6)) if len(y) else None
            out.append((mean, adjusted_likelihoods(y, offset, x) if usable else None))
        return pd.DataFrame(out, columns=["mean", "curve"])

    own = counts.select("feature", "sample", F.col("count").alias("value"), F.col("size").cast("double").alias("weight"))
    return _wide(own, samples, names, None).withColumn("c", curves("rows")).select("feature", "rows", "c.mean", "c.curve")


def dispersion_trend(curves: DataFrame, bins: int = 20, least: int = 50) -> DataFrame:
    """One row, trend: array of (mean, curve), the average curve of features in bins of like abundance, at least about `least` a bin."""
    own = curves.filter("curve IS NOT NULL")
    n = max(1, min(bins, own.count() // least))
    edges = own.agg(F.percentile_approx("mean", [i / n for i in range(1, n)], 10_000).alias("edges")) if n > 1 else own.agg(F.array().cast("array<double>").alias("edges"))
    binned = own.join(F.broadcast(edges)).select(F.size(F.filter("edges", lambda e: e < F.col("mean"))).alias("bin"), "mean", F.posexplode("curve"))
    per = binned.groupBy("bin", "pos").agg(F.avg("mean").alias("mean"), F.avg("col").alias("value"))
    each = per.groupBy("bin").agg(F.first("mean").alias("mean"), F.transform(F.array_sort(F.collect_list(F.struct("pos", "value"))), lambda e: e["value"]).alias("curve"))
    return each.agg(F.array_sort(F.collect_list(F.struct("mean", "curve"))).alias("trend"))


def _trend_at(mean: float, trend: list) -> np.ndarray:
    x, curves = np.array([e["mean"] for e in trend]), np.array([list(e["curve"]) for e in trend])
    return np.array([np.interp(mean, x, c) for c in curves.T])


def quasi_fits(counts: DataFrame, samples: DataFrame, names: Sequence[str], contrasts: dict[str, Sequence[float]], prior_df: float = 10.0, bins: int = 20) -> DataFrame:
    """(feature, contrast, estimate, lr, s2, df, trended, dispersion), one row a feature and contrast.

    trended: the dispersion at the maximum of the trend's likelihood at the feature's abundance; dispersion: at the maximum of its own
    likelihood plus prior_df / df times the trend's. s2 is the deviance at the trended dispersion over the residual degrees of freedom
    (samples that are 0 and fitted as 0 have none); lr what the deviance rises by if the contrast is held at 0; estimate in log2. A
    feature without counts, without degrees of freedom or whose fit doesn't settle keeps its rows, with nulls.
    """
    if len(names) < 2:
        raise ValueError("a quasi-likelihood test needs two columns of the design or more")
    wanted = {n: np.asarray(c, float) for n, c in contrasts.items()}
    null_spaces = {n: np.linalg.svd(c[None])[2][1:].T for n, c in wanted.items()}
    nothing = {"estimate": None, "lr": None, "s2": None, "df": 0, "trended": None, "dispersion": None}
    kind = "array<struct<contrast:string,estimate:double,lr:double,s2:double,df:int,trended:double,dispersion:double>>"

    @F.pandas_udf(kind)
    def fit(rows: pd.Series, mean: pd.Series, curve: pd.Series, trend: pd.Series) -> pd.Series:
        out = []
        for r, m, c, t in zip(rows, mean, curve, trend, strict=True):
            empty = [{"contrast": n, **nothing} for n in wanted]
            if c is None:
                out.append(empty)
                continue
            y, offset, x = _read(list(r))
            free = len(y) - x.shape[1]
            general = _trend_at(m, list(t))
            trended, shrunken = best_dispersion(general), best_dispersion(np.asarray(c) + prior_df / free * general)
            phi = np.array([trended])
            beta, mu, dev, settled = fit_counts(y, offset, x, phi)
            counted = (y > 0) | (mu[0] > 1e-4)
            df = int(counted.sum() - np.linalg.matrix_rank(x[counted]))
            if not settled[0] or df <= 0:
                out.append(empty)
                continue
            found = []
            for n, w in wanted.items():
                _, _, less, ok = fit_counts(y, offset, x @ null_spaces[n], phi)
                lr = float(max(less[0] - dev[0], 0.0)) if ok[0] else None
                found.append({"contrast": n, "estimate": float(w @ beta[0] / math.log(2)), "lr": lr, "s2": float(dev[0] / df) if dev[0] > 0 else None, "df": df, "trended": trended, "dispersion": shrunken})
            out.append(found)
        return pd.Series(out)

    curves = cut(dispersion_curves(counts, samples, names))
    return curves.join(F.broadcast(dispersion_trend(curves, bins))).select("feature", F.inline(fit("rows", "mean", "curve", "trend")))


def quasi_table(fits: DataFrame, contrasts: Sequence[str]) -> DataFrame:
    """quasi_fits with f, total_df, p and BH q within each contrast: lr over a quasi-dispersion that is shrunken to the prior of all
    features of the contrast (one prior, not one by abundance, and no allowance for outlying features)."""
    out = None
    for c in contrasts:
        own = fits.filter(F.col("contrast") == c).withColumns({"slope": F.signum("estimate") * F.sqrt("lr"), "se": F.sqrt("s2")})
        rows = moderate(own).withColumn("f", F.col("moderated_t") * F.col("moderated_t"))
        out = rows if out is None else out.unionByName(rows)
    return add_bh(out.drop("q", "slope", "se", "moderated_t"), "p", "q", ["contrast"])


def are_counts(values: DataFrame, value: str = "value") -> bool:
    """Whether every value is a whole number of 0 or more; a null is none."""
    v = F.col(value)
    return values.filter(v.isNull() | (v < 0) | (v != F.floor(v))).isEmpty()


def fit_by_kind(values: DataFrame, samples: DataFrame, names: Sequence[str], contrasts: dict[str, Sequence[float]], block: str | None = None, least: float = 1.0, n: int = 2) -> DataFrame:
    """(feature, contrast, estimate, df, p, q, method): the fit that the data ask for.

    values: (feature, sample, value). With a block: `blocked`, the samples of a block correlate by the consensus, and counts get
    precision weights; other values than counts: `linear`; counts with two columns of the design or more: `quasi`; counts with an
    intercept alone: `weighted`. Counts are kept by `least` per million in n samples. Raises if none are.
    """
    counted = are_counts(values)
    rows = values.select("feature", "sample", "value")
    if counted:
        rows = cut(expressed(values.select("feature", "sample", F.col("value").cast("bigint").alias("count")).filter("count > 0"), samples, least, n))
        if rows.isEmpty():
            raise ValueError("no feature is left: check depth, least and n")
    if counted and not block and len(names) > 1:
        found, method = quasi_table(quasi_fits(rows, samples, names, contrasts), list(contrasts)), "quasi"
    else:
        method = "blocked" if block else "weighted" if counted else "linear"
        weighted = cut(mean_variance_weights(rows, samples, names)) if counted else rows
        rho = consensus_correlation(weighted, samples, names, block) if block else 0.0
        found = differential_table(fit_contrasts(weighted, samples, names, contrasts, block, rho))
    return found.select("feature", "contrast", "estimate", "df", "p", "q", F.lit(method).alias("method"))
