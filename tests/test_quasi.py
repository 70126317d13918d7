"""Negative binomial quasi-likelihood against closed forms, a plain search and planted effects."""

import math

import numpy as np
import pytest

from omicspark.operators import differential as df_
from omicspark.operators import quasi as qs


def planted(rng, n_features, phi, changed, fold=3.0, n=6, empty=False):
    size = rng.integers(80_000, 120_000, 2 * n)
    rows = []
    for f in range(n_features):
        base = rng.uniform(20, 200)
        for s in range(2 * n):
            mu = base * size[s] / 1e5 * (fold if f < changed and s >= n else 1.0)
            rows.append((f, f"s{s:02d}", int(rng.poisson(mu * rng.gamma(1 / phi, phi))), int(size[s])))
    if empty:
        rows += [(n_features, f"s{s:02d}", 0, int(size[s])) for s in range(2 * n)]
    return rows, [(f"s{s:02d}", 1.0, float(s >= n), s // 2) for s in range(2 * n)]


def tables(spark, rows, samples):
    return spark.createDataFrame(rows, "feature int, sample string, count long, size long"), spark.createDataFrame(samples, "sample string, intercept double, grp double, donor int")


def test_group_means_are_the_fit_at_any_dispersion():
    y, x = np.array([3.0, 7, 5, 40, 22, 0]), np.c_[np.ones(6), [0, 0, 0, 1, 1, 1]]
    phi = np.array([1e-4, 0.1, 2.0])
    beta, mu, dev, settled = qs.fit_counts(y, np.zeros(6), x, phi)
    assert settled.all() and np.allclose(np.exp(beta[:, 0]), 5) and np.allclose(np.exp(beta.sum(1)), 62 / 3)
    for p, m, d in zip(phi, mu, dev, strict=True):
        assert d == pytest.approx(2 * sum((a * math.log(a / b) if a else 0) - (a + 1 / p) * math.log((1 + p * a) / (1 + p * b)) for a, b in zip(y, m, strict=True)))


def test_a_group_of_zeros_settles():
    y, x = np.array([0.0, 0, 0, 9, 12, 10]), np.c_[np.ones(6), [0, 0, 0, 1, 1, 1]]
    _, mu, dev, settled = qs.fit_counts(y, np.zeros(6), x, np.array([0.1]))
    assert settled[0] and mu[0, :3].max() < 1e-6 and mu[0, 3:] == pytest.approx([31 / 3] * 3)
    assert np.isfinite(qs.adjusted_likelihoods(y, np.zeros(6), x)).all()


def test_adjusted_likelihood_matches_a_plain_one():
    y, x = np.array([3.0, 7, 5, 40, 22, 30]), np.c_[np.ones(6), [0, 0, 0, 1, 1, 1]]
    got = qs.adjusted_likelihoods(y, np.zeros(6), x)
    mu = np.repeat([5.0, 92 / 3], 3)
    for g, v in zip(qs.GRID, got, strict=True):
        p = 2.0**g
        log = sum(math.lgamma(a + 1 / p) - math.lgamma(1 / p) - math.lgamma(a + 1) + a * math.log(p * m) - (a + 1 / p) * math.log(1 + p * m) for a, m in zip(y, mu, strict=True))
        w = mu / (1 + p * mu)
        assert v == pytest.approx(log - 0.5 * math.log(np.linalg.det((x * w[:, None]).T @ x)), abs=1e-5)


def test_dispersions_and_tests_of_planted_counts(spark):
    rows, samples = planted(np.random.default_rng(1), 400, 0.1, 30, empty=True)
    counts, own = tables(spark, rows, samples)
    got = qs.quasi_table(qs.quasi_fits(counts, own, ["intercept", "grp"], {"grp": [0, 1]}), ["grp"]).collect()
    assert len(got) == 401
    by = {r.feature: r for r in got}
    assert by[400].p is None and by[400].estimate is None  # no counts
    rest = [by[f] for f in range(400)]
    assert np.median([r.trended for r in rest]) == pytest.approx(0.1, rel=0.15)
    own_curves = {r.feature: qs.best_dispersion(np.array(r.curve)) for r in qs.dispersion_curves(counts, own, ["intercept", "grp"]).collect() if r.curve}
    spread = lambda v: np.std(np.log2(v))
    assert spread([r.dispersion for r in rest]) < 0.7 * spread([own_curves[f] for f in range(400)])
    assert np.median([r.s2 for r in rest]) == pytest.approx(1.0, abs=0.25)
    null = np.array([by[f].p for f in range(30, 400)])
    assert 0.02 < (null < 0.05).mean() < 0.09 and 0.4 < null.mean() < 0.6
    assert sum(by[f].q < 0.05 for f in range(30)) >= 27 and np.median([by[f].estimate for f in range(30)]) == pytest.approx(math.log2(3), abs=0.25)
    assert sum(by[f].q < 0.05 for f in range(30, 400)) <= 6


def test_contrast_is_held_at_zero_whatever_the_coding(spark):
    rows, _ = planted(np.random.default_rng(2), 60, 0.2, 10)
    one = [(f"s{s:02d}", 1.0, float(s >= 6), 0) for s in range(12)]
    two = [(f"s{s:02d}", float(s < 6), float(s >= 6), 0) for s in range(12)]
    a, b = ({r.feature: r for r in qs.quasi_fits(*tables(spark, rows, s), ["intercept", "grp"], {"c": c}).collect()} for s, c in ((one, [0, 1]), (two, [-1, 1])))
    for f in a:
        assert a[f].lr == pytest.approx(b[f].lr, abs=1e-6) and a[f].estimate == pytest.approx(b[f].estimate, abs=1e-5)


def test_the_data_choose_the_fit(spark):
    rows, samples = planted(np.random.default_rng(3), 120, 0.1, 10)
    counts, own = tables(spark, rows, samples)
    values = counts.withColumnRenamed("count", "value")
    logs = values.selectExpr("feature", "sample", "log2((value + 0.5) / size * 1e6) AS value")
    run = lambda v, names, c, block=None: qs.fit_by_kind(v, own, names, {"c": c}, block)
    for found, method in (
        (run(values, ["intercept", "grp"], [0, 1]), "quasi"),
        (run(values, ["intercept"], [1]), "weighted"),
        (run(logs, ["intercept", "grp"], [0, 1]), "linear"),
        (run(values, ["intercept", "grp"], [0, 1], "donor"), "blocked"),
        (run(logs, ["intercept", "grp"], [0, 1], "donor"), "blocked"),
    ):
        got = found.collect()
        assert len(got) == 120 and {r.method for r in got} == {method}
        if method != "weighted":
            assert sum(r.q < 0.05 for r in got if r.feature < 10) >= 8 and sum(r.q < 0.05 for r in got if r.feature >= 10) <= 6
    with pytest.raises(ValueError, match="no feature"):
        qs.fit_by_kind(values.filter("value < 0"), own, ["intercept", "grp"], {"c": [0, 1]})
    with pytest.raises(ValueError, match="two columns"):
        qs.quasi_fits(counts, own, ["intercept"], {"c": [1]})
    assert df_.expressed(values.selectExpr("feature", "sample", "value AS count"), own, 1, 2).count() == 120 * 12
