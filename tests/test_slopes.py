"""Donor slopes against full matrices: restricted likelihood by its dense derivative, Kenward and Roger's general formulas."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from omicspark.functions.tails import incomplete_beta
from omicspark.operators import slopes


def dense_fit(design, donor, x, y):
    """(coefficient, slope variance, residual variance, df, p) with n x n matrices throughout."""
    big = np.column_stack([design, x])
    z = np.zeros((len(y), donor.max() + 1))
    z[np.arange(len(y)), donor] = x
    zz, n, p = z @ z.T, *big.shape

    def parts(lam):
        h = np.linalg.inv(np.eye(n) + lam * zz)
        xhx = np.linalg.inv(big.T @ h @ big)
        proj = h - h @ big @ xhx @ big.T @ h
        s2 = y @ proj @ y / (n - p)
        return h, xhx, proj, s2

    def loss(lam):
        h, xhx, _, s2 = parts(lam)
        return (n - p) * math.log(s2) - np.linalg.slogdet(h)[1] - np.linalg.slogdet(xhx)[1]

    def slope(lam):
        _, _, proj, s2 = parts(lam)
        return np.trace(proj @ zz) - y @ proj @ zz @ proj @ y / s2

    grid = np.expm1(np.linspace(0, 12, 60))
    best = [0.0]
    for a, b in zip(grid[:-1], grid[1:], strict=True):
        if slope(a) < 0 <= slope(b):
            for _ in range(100):
                m = (a + b) / 2
                a, b = (m, b) if slope(m) < 0 else (a, m)
            best.append(a)
    lam = min(best, key=loss)
    h, xhx, _, s2 = parts(lam)
    vi, phi = h / s2, xhx * s2
    beta = phi @ big.T @ vi @ y
    gs = [zz, np.eye(n)]
    ps = [-big.T @ vi @ g @ vi @ big for g in gs]
    qs = [[big.T @ vi @ a @ vi @ b @ vi @ big for b in gs] for a in gs]
    info = np.array([[np.trace(vi @ gs[i] @ vi @ gs[j]) - 2 * np.trace(phi @ qs[i][j]) + np.trace(phi @ ps[i] @ phi @ ps[j]) for j in range(2)] for i in range(2)])
    w = 2 * np.linalg.inv(info)
    adjusted = phi + 2 * phi @ sum(w[i, j] * (qs[i][j] - ps[i] @ phi @ ps[j]) for i in range(2) for j in range(2)) @ phi
    c = np.zeros(p)
    c[-1] = 1
    theta = np.outer(c, c) / (c @ phi @ c)
    tr = [np.trace(theta @ phi @ q @ phi) for q in ps]
    a1 = sum(w[i, j] * tr[i] * tr[j] for i in range(2) for j in range(2))
    a2 = sum(w[i, j] * np.trace(theta @ phi @ ps[i] @ phi @ theta @ phi @ ps[j] @ phi) for i in range(2) for j in range(2))
    bk, g = (a1 + 6 * a2) / 2, (2 * a1 - 5 * a2) / (3 * a2)
    c1, c2, c3 = g / (3 + 2 * (1 - g)), (1 - g) / (3 + 2 * (1 - g)), (3 - g) / (3 + 2 * (1 - g))
    rho = ((1 - a2) / (1 - c2 * bk)) ** 2 * (1 + c1 * bk) / (1 - c3 * bk)
    df = 4 + 3 / (rho - 1)
    f = df * (1 - a2) / (df - 2) * beta[-1] ** 2 / adjusted[-1, -1]
    return beta[-1], lam * s2, s2, df, incomplete_beta(df / 2, 0.5, df / (df + f))


def case(seed=3, donors=9, states=6):
    rng = np.random.default_rng(seed)
    donor = np.repeat(np.arange(donors), states)
    n = len(donor)
    design = np.column_stack([np.ones(n), *[(donor == d).astype(float) for d in range(1, donors)], rng.normal(size=n)])
    peaks = {"common": rng.normal(size=n), "second": rng.normal(size=n), "one_donor": np.where(donor == 0, rng.normal(size=n), 0.0)}
    kinds = {"null": np.zeros(donors), "shared": np.full(donors, 0.5), "mixed": np.linspace(-0.5, 1.5, donors), "strong": np.linspace(0.8, 1.2, donors), "wild": np.linspace(-6, 9, donors)}
    genes = {k: rng.normal(size=donors)[donor] + s[donor] * peaks["common"] + rng.normal(0, 0.5, n) for k, s in kinds.items()}
    return donor, design, peaks, genes


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_kernel_equals_full_matrices(seed):
    donor, design, peaks, genes = case(seed)
    seen = set()
    for x in (peaks["common"], peaks["second"]):
        x = x - np.array([x[donor == d].mean() for d in donor])
        for f, y in zip(slopes.SlopeKernel(design, donor, x).fit(np.array(list(genes.values()))), genes.values(), strict=True):
            want = dense_fit(design, donor, x, y)
            assert not f.diagnostic
            assert (f.coefficient, f.slope_variance, f.residual_variance, f.df, f.p) == pytest.approx(want, rel=1e-6, abs=1e-9)
            seen.add(f.ratio == 0)
    assert seen == {True, False}


def test_donor_slopes_of_pairs(spark):
    donor, design, peaks, genes = case()
    n = len(donor)
    values = lambda d: spark.createDataFrame([("g", k, i, float(v[i])) for k, v in d.items() for i in range(n)], "cell_group string, feature string, aggregate int, value double")
    x = spark.createDataFrame([("g", i, design[i].tolist()) for i in range(n)], "cell_group string, aggregate int, x array<double>")
    a = spark.createDataFrame([("g", i, f"d{donor[i]}") for i in range(n)], "cell_group string, aggregate int, donor string")
    constant = {"flat": np.ones(n)}
    pairs = spark.createDataFrame([("g", k, p, i % 2 == 0) for i, (k, p) in enumerate((k, p) for k in [*genes, "flat"] for p in peaks)], "cell_group string, gene string, peak string, marked boolean")
    got = {(r.gene, r.peak): r for r in slopes.donor_slopes(pairs, values(genes | constant), values(peaks), x, a).collect()}
    assert len(got) == 18
    for (k, p), r in got.items():
        v = peaks[p] - np.array([peaks[p][donor == d].mean() for d in donor])
        assert (r.n_aggregates, r.n_donors) == (n, 9)
        if p == "one_donor":
            assert (r.status, r.coefficient, r.p) == (slopes.FEW, None, None)
        elif k == "flat":
            assert (r.status, r.correlation, r.p) == (slopes.FAILED, None, None) and r.diagnostic
        else:
            c, t2, s2, df, pv = dense_fit(design, donor, v, genes[k])
            assert r.status == slopes.OK and r.diagnostic == ""
            assert (r.coefficient, r.slope_sd, r.df, r.raw_p, r.p) == pytest.approx((c, math.sqrt(t2), df, pv, pv), rel=1e-6, abs=1e-9)
            assert r.singular == (math.sqrt(t2 / s2) < 1e-4)
            rest = lambda y: y - design @ np.linalg.lstsq(design, y, rcond=None)[0]
            assert r.correlation == pytest.approx(np.corrcoef(rest(genes[k]), rest(v))[0, 1], abs=1e-9)
    few = slopes.donor_slopes(pairs, values(genes), values(peaks), x, a, min_donors=10)
    assert {r.status for r in few.collect()} == {slopes.FEW}
    assert slopes.donor_slopes(pairs.limit(0), values(genes), values(peaks), x, a).collect() == []


def test_gene_z_leaves_its_own_row_out(spark):
    rng = np.random.default_rng(1)
    rows = [("g", "a" if i < 16 else "b", i, bool(i % 4), float(rng.normal()), float(rng.uniform(0.001, 1)) if i != 5 else None) for i in range(24)]
    got = slopes.gene_standardised(spark.createDataFrame(rows, "cell_group string, gene string, peak int, bg boolean, coefficient double, p double"), "bg").collect()
    from statistics import NormalDist

    z = {r[2]: math.copysign(-NormalDist().inv_cdf(r[5] / 2), r[4]) for r in rows if r[5]}
    for r in got:
        others = [z[i] for _, g, i, bg, _, p in rows if g == r.gene and bg and p and i != r.peak]
        if r.gene == "b" or r.p is None:
            assert r.gene_z is None
        else:
            assert r.gene_z == pytest.approx((z[r.peak] - np.mean(others)) / np.std(others, ddof=1), abs=1e-9)


def test_background_of_unrelated_pairs_is_calibrated(spark):
    rng = np.random.default_rng(7)
    donor, design, _, _ = case()
    p = []
    for _ in range(300):
        x = rng.normal(size=len(donor))
        x -= np.array([x[donor == d].mean() for d in donor])
        p.append(slopes.SlopeKernel(design, donor, x).fit(rng.normal(size=(1, len(donor))) + x * rng.normal(0, 0.7, 9)[donor])[0].p)
    df = spark.createDataFrame([("g", True, float(v)) for v in p], "cell_group string, bg boolean, p double").withColumn("x", F.lit(1))
    row = slopes.background_share(df, "bg").first()
    assert row.n == 300 and 0.02 < row.below < 0.09
