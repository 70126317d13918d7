"""Donor-slope models of gene-peak pairs: y = design b + x s + x d[donor] + e, by restricted likelihood, tested as Kenward and Roger do.

Rows of a group's model are its aggregates (donors x states, as many as a study has), so a feature is one array and a fit a few small
matrices; Spark deals the pairs. Restricted likelihood: with lambda the ratio of slope to residual variance, the covariance is
sigma2 (I + lambda Z Z'); a donor's rows are those of one column of Z, so all powers of its inverse are I + Z diag(.) Z', and every
quantity below needs moments by donor alone. For one tested coefficient the approximation of Kenward and Roger has
2 / A degrees of freedom and no scaling (A: the variance of the estimate's information, relative).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..functions.tails import t_two_sided

#: Donors with variation of the peak that a fit needs.
MIN_DONORS = 8
#: Background pairs of a gene, beside the row itself, that its z needs.
MIN_BACKGROUND = 10
#: log1p of the greatest ratio of variances that is looked at; below SINGULAR (its root), there is no slope variance to speak of.
MOST_LOG_RATIO, SINGULAR = 32.0, 1e-4
#: Numbers of all groups' designs together, which go to every task.
MAX_DESIGN = 1 << 24

OK, FEW, FAILED = "estimable", "insufficient_donor_information", "numerical_failure"


@dataclass
class SlopeFit:
    coefficient: float = math.nan
    slope_variance: float = math.nan
    residual_variance: float = math.nan
    ratio: float = math.nan
    df: float = math.nan
    p: float = math.nan
    diagnostic: str = ""


class SlopeKernel:
    """Fits many responses on one design and one covariate x; x holds 0 sum within donors or not, as the caller likes."""

    def __init__(self, design: np.ndarray, donor: np.ndarray, x: np.ndarray):
        self.x, self.donor, self.donors = np.column_stack([design, x]), donor, int(donor.max()) + 1
        self.n, self.p = self.x.shape
        self.z = x
        self.s = np.bincount(donor, x * x, self.donors)
        self.b = self._by_donor(self.x)
        self.xx = self.x.T @ self.x
        self.full_rank = np.linalg.matrix_rank(self.x / np.maximum(np.sqrt(np.diag(self.xx)), 1e-300)) == self.p
        if self.full_rank:
            self.inverse = np.linalg.inv(self.xx)
            values, axes = np.linalg.eigh(np.diag(self.s) - self.b @ self.inverse @ self.b.T)
            kept = values > np.finfo(float).eps * self.n * max(1.0, values.max())
            self.values, self.axes = values[kept], axes[:, kept]

    def _by_donor(self, m: np.ndarray) -> np.ndarray:
        out = np.zeros((self.donors, m.shape[1]))
        np.add.at(out, self.donor, m * self.z[:, None])
        return out

    def fit(self, responses: np.ndarray) -> list[SlopeFit]:
        """responses: one a row."""
        if not self.full_rank:
            return [SlopeFit(diagnostic="the design lacks rank")] * len(responses)
        zy, xy = self._by_donor(responses.T), self.x.T @ responses.T
        beta = self.inverse @ xy
        along = (self.axes.T @ (zy - self.b @ beta)) ** 2 / self.values[:, None]  # squares along the eigenvectors
        rest = ((responses.T - self.x @ beta) ** 2).sum(0) - along.sum(0)
        return [self._one(zy[:, j], xy[:, j], along[:, j], max(rest[j], 0.0), float(responses[j] @ responses[j])) for j in range(len(responses))]

    def _criterion(self, t: np.ndarray, along: np.ndarray, rest: float) -> tuple[np.ndarray, np.ndarray]:
        """-2 log restricted likelihood at log1p(lambda) = t, up to a constant, and its derivative by t."""
        lam = np.expm1(t)[:, None]
        v = 1 + lam * self.values
        rss, free = rest + (along / v).sum(1), self.n - self.p
        slope = -free * (along * self.values / v**2).sum(1) / rss + (self.values / v).sum(1)
        return free * np.log(rss / free) + np.log(v).sum(1), slope * np.exp(t)

    def _one(self, zy: np.ndarray, xy: np.ndarray, along: np.ndarray, rest: float, size: float) -> SlopeFit:
        if rest + along.sum() <= 1e-24 * max(1.0, size) or self.n <= self.p:
            return SlopeFit(diagnostic="the response doesn't vary beyond the design")
        grid = np.linspace(0, MOST_LOG_RATIO, 257)
        f, slope = self._criterion(grid, along, rest)
        found = [0.0]
        for lo, hi in zip(grid[:-1][(slope[:-1] < 0) & (slope[1:] >= 0)], grid[1:][(slope[:-1] < 0) & (slope[1:] >= 0)], strict=True):
            for _ in range(200):
                middle = (lo + hi) / 2
                if middle in (lo, hi):
                    break
                lo, hi = (middle, hi) if self._criterion(np.array([middle]), along, rest)[1][0] < 0 else (lo, middle)
            found.append(hi)
        at = self._criterion(np.array(found), along, rest)[0]
        if f[-1] < at.min():
            return SlopeFit(diagnostic="the ratio of variances is beyond the range searched")
        lam = float(np.expm1(found[int(np.argmin(at))]))
        sigma2 = (rest + (along / (1 + lam * self.values)).sum()) / (self.n - self.p)
        return self._tested(lam, sigma2, zy, xy)

    def _power(self, m: int, shrink: np.ndarray, sigma2: float) -> np.ndarray:
        """X' V^-m X."""
        inner = np.divide(shrink**m - 1, self.s, out=np.zeros_like(self.s), where=self.s > 0)
        return (self.xx + (self.b * inner[:, None]).T @ self.b) / sigma2**m

    def _tested(self, lam: float, sigma2: float, zy: np.ndarray, xy: np.ndarray) -> SlopeFit:
        s, b, shrink = self.s, self.b, 1 / (1 + lam * self.s)
        k = shrink / sigma2  # V^-1 Z = Z diag(k)
        phi = np.linalg.inv(self._power(1, shrink, sigma2))
        coefficient = float((phi @ (xy - b.T @ (lam * shrink * zy)))[-1] / sigma2)
        out = SlopeFit(coefficient, lam * sigma2, sigma2, lam)
        # derivatives of V: Z Z' (slope variance) and I (residual variance)
        first = [(b * (k**2)[:, None]).T @ b, self._power(2, shrink, sigma2)]  # minus the derivatives of X' V^-1 X
        middle = (b * (k**3)[:, None]).T @ b
        second = [[(b * (s * k**3)[:, None]).T @ b, middle], [middle, self._power(3, shrink, sigma2)]]
        plain = [[(s * k) @ (s * k), s @ k**2], [s @ k**2, (self.n + (shrink**2 - 1).sum()) / sigma2**2]]
        both = [phi @ m for m in first]
        info = np.array([[plain[i][j] - 2 * np.trace(phi @ second[i][j]) + np.trace(both[i] @ both[j]) for j in range(2)] for i in range(2)])
        if not np.isfinite(info).all():
            out.diagnostic = "the information of the variances isn't finite"
            return out
        singular = np.abs(np.linalg.eigvalsh(info)).min() <= 1e-10
        w = 2 * (np.linalg.pinv(info, rcond=math.sqrt(np.finfo(float).eps)) if singular else np.linalg.inv(info))
        bias = sum(w[i, j] * (phi @ (second[i][j] - first[i] @ phi @ first[j]) @ phi)[-1, -1] for i in range(2) for j in range(2))
        variance = phi[-1, -1] + 2 * bias
        change = np.array([(phi @ m @ phi)[-1, -1] for m in first]) / phi[-1, -1]
        a = float(change @ w @ change)
        if not (variance > 0 and a > 0 and math.isfinite(variance)):
            out.diagnostic = "the adjusted variance isn't positive"
            return out
        out.df = 2 / a
        out.p = t_two_sided(coefficient / math.sqrt(variance), out.df)
        return out


def _arrays(values: DataFrame, name: str, out: str) -> DataFrame:
    """A feature's values in order of the aggregates' names."""
    listed = F.array_sort(F.collect_list(F.struct("aggregate", F.col("value").cast("double").alias("value"))))
    return values.groupBy("cell_group", F.col("feature").alias(name)).agg(F.transform(listed, lambda e: e["value"]).alias(out))


def donor_slopes(pairs: DataFrame, genes: DataFrame, peaks: DataFrame, design: DataFrame, aggregates: DataFrame, min_donors: int = MIN_DONORS) -> DataFrame:
    """pairs (cell_group, gene, peak, ...) with n_aggregates, n_donors, correlation (partial, given the design), coefficient, slope_sd, df,
    raw_p, p (where estimable), singular, status and diagnostic.

    genes, peaks: (cell_group, feature, aggregate, value) with a value for every aggregate of the group; design: (cell_group,
    aggregate, x); aggregates: (cell_group, aggregate, donor). The peak is centred within donors. Status: insufficient_donor_information
    where fewer than `min_donors` donors have variation of the peak, none is left beside the design, or there is less than one degree of
    freedom; numerical_failure where a fit has no p. Pairs without values of both features are left out. Designs are as large as a
    study's aggregates; they go to every task, and more than MAX_DESIGN numbers raise.
    """
    size = design.agg(F.sum(F.size("x"))).first()[0] or 0
    if size > MAX_DESIGN:
        raise ValueError(f"designs of {size} numbers are too large to send to every task")
    frames = {}
    for r in design.join(aggregates.select("cell_group", "aggregate", "donor"), ["cell_group", "aggregate"]).orderBy("cell_group", "aggregate").collect():
        frames.setdefault(r.cell_group, ([], []))
        frames[r.cell_group][0].append(list(r.x))
        frames[r.cell_group][1].append(r.donor)
    groups = {g: (np.array(x, float), np.unique(d, return_inverse=True)[1]) for g, (x, d) in frames.items()}
    pairs = pairs.withColumn("_pair", F.struct(*pairs.columns))
    rows = pairs.select("cell_group", "gene", "peak", "_pair").join(_arrays(genes, "gene", "y"), ["cell_group", "gene"]).join(_arrays(peaks, "peak", "v"), ["cell_group", "peak"])
    rows = rows.sortWithinPartitions("cell_group", "peak").select("_pair", "cell_group", "peak", "y", "v")
    results = pa.schema([("n_aggregates", pa.int32()), ("n_donors", pa.int32()), *[(c, pa.float64()) for c in ("correlation", "coefficient", "slope_sd", "df", "raw_p", "p")], ("singular", pa.bool_()), ("status", pa.string()), ("diagnostic", pa.string())])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pair, group, peak, y, v = batch.columns
            names = list(zip(group.to_pylist(), peak.to_pylist(), strict=True))
            out, lo = [], 0
            while lo < len(names):
                hi = lo
                while hi < len(names) and names[hi] == names[lo]:
                    hi += 1
                out += _scores(*groups[names[lo][0]], np.array(v[lo].as_py(), float), np.array(y.slice(lo, hi - lo).to_pylist(), float), min_donors)
                lo = hi
            columns = [pa.array([r[i] for r in out], f.type) for i, f in enumerate(results)]
            yield pa.RecordBatch.from_arrays([pair, *columns], names=["_pair", *results.names])

    kinds = f"_pair {pairs.schema['_pair'].dataType.simpleString()}, n_aggregates int, n_donors int, correlation double, coefficient double, slope_sd double, df double, raw_p double, p double, singular boolean, status string, diagnostic string"
    return rows.mapInArrow(fit, kinds).select("_pair.*", *results.names)


def _scores(design: np.ndarray, donor: np.ndarray, x: np.ndarray, responses: np.ndarray, min_donors: int) -> list[tuple]:
    """One row a response, as donor_slopes gives them."""
    counts = np.bincount(donor)
    n, n_donors = len(donor), len(counts)
    x = x - (np.bincount(donor, x) / counts)[donor]
    basis = np.linalg.svd(design, full_matrices=False)
    basis = basis[0][:, basis[1] > 1e-10 * basis[1][0]]
    rest, x_rest = responses - (responses @ basis) @ basis.T, x - basis @ (basis.T @ x)
    y_ss, x_ss, own = (rest**2).sum(1), float(x_rest @ x_rest), max(float(x @ x), 1.0)
    with np.errstate(all="ignore"):
        correlation = np.clip(rest @ x_rest / np.sqrt(x_ss * y_ss), -1, 1)
    known = (y_ss > 1e-12) & (x_ss > 1e-12) & np.isfinite(correlation)
    r = [float(c) if k else None for c, k in zip(correlation, known, strict=True)]
    reason = None
    if n_donors < min_donors or (np.bincount(donor, x * x) > 1e-12 * own).sum() < min_donors:
        reason = f"the peak varies within fewer than {min_donors} donors"
    elif x_ss <= 1e-12 * own:
        reason = "the peak doesn't vary beside the design"
    if reason:
        return [(n, n_donors, c, None, None, None, None, None, None, FEW, reason) for c in r]
    out = []
    for c, f in zip(r, SlopeKernel(design, donor, x).fit(responses), strict=True):
        status = FAILED if f.diagnostic or not 0 <= f.p <= 1 else FEW if not f.df >= 1 else OK
        plain = lambda v: float(v) if math.isfinite(v) else None
        there = math.isfinite(f.ratio)
        out.append((n, n_donors, c, plain(f.coefficient), plain(math.sqrt(f.slope_variance)) if there else None, plain(f.df), plain(f.p), plain(f.p) if status == OK else None, math.sqrt(f.ratio) < SINGULAR if there else None, status, f.diagnostic))
    return out


@F.pandas_udf(DoubleType())
def _normal_size(p: pd.Series) -> pd.Series:
    from statistics import NormalDist

    return p.map(lambda x: -NormalDist().inv_cdf(max(x, 2.2250738585072014e-308) / 2), na_action="ignore")


def gene_standardised(fits: DataFrame, background: str, least: int = MIN_BACKGROUND) -> DataFrame:
    """fits with gene_z: the signed normal quantile of p against mean and deviation of the gene's background rows (boolean column), without
    the row itself; null with fewer than `least` of them. The sums of a gene are a join, so no task holds a gene's rows."""
    z = F.when(F.col("coefficient").isNotNull(), F.signum("coefficient") * _normal_size("p"))
    rows = fits.withColumn("_z", z).withColumn("_null", F.col(background) & F.col("_z").isNotNull())
    used = F.when(F.col("_null"), F.col("_z")).otherwise(0.0)
    sums = rows.groupBy("cell_group", "gene").agg(F.count_if("_null").alias("_n"), F.sum(used).alias("_s"), F.sum(used * used).alias("_ss"))
    n = F.col("_n") - F.col("_null").cast("int")
    mean = F.try_divide(F.col("_s") - used, n)
    sd = F.sqrt(F.try_divide(F.greatest(F.col("_ss") - used * used - n * mean * mean, F.lit(0.0)), n - 1))
    scored = rows.join(sums, ["cell_group", "gene"]).withColumn("gene_z", F.when(n >= least, F.try_divide(F.col("_z") - mean, sd)))
    return scored.drop("_z", "_null", "_n", "_s", "_ss")


def background_share(fits: DataFrame, background: str) -> DataFrame:
    """(cell_group, n, below): how many background rows have a p, and which share of them is at most 0.05: about that, if calibrated."""
    return fits.filter(F.col(background) & F.col("p").isNotNull()).groupBy("cell_group").agg(F.count(F.lit(1)).alias("n"), F.avg((F.col("p") <= 0.05).cast("double")).alias("below"))
