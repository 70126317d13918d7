"""Blocked fits, weights, factors and contrasts against plain matrices."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from omicspark.operators import differential as df_


def plain(y, w, x, block, rho):
    s = np.where(block[:, None] == block[None, :], rho, 0.0)
    np.fill_diagonal(s, 1.0)
    r = np.diag(1 / np.sqrt(w))
    inverse = np.linalg.inv(r @ s @ r)
    cov = np.linalg.inv(x.T @ inverse @ x)
    beta = cov @ x.T @ inverse @ y
    e = y - x @ beta
    return beta, cov, e @ inverse @ e / (len(y) - x.shape[1])


def planted(rng, n=24):
    block = np.repeat(np.arange(n // 3), 3)
    x = np.column_stack([np.ones(n), rng.normal(size=n), np.tile([0, 1, 0], n // 3)])
    y = x @ [1, 0.5, -2] + rng.normal(size=n // 3)[block] + rng.normal(size=n) * 0.5
    return y, rng.uniform(0.5, 2, n), x, block


def test_blocked_fit():
    rng = np.random.default_rng(1)
    for rho in (0.0, 0.4, -0.2):
        y, w, x, block = planted(rng)
        beta, cov, s2, free = df_.blocked_fit(y, w, x, block, rho)
        b, c, s = plain(y, w, x, block, rho)
        assert np.allclose(beta, b) and np.allclose(cov, c) and s2 == pytest.approx(s) and free == len(y) - 3
    assert df_.blocked_fit(y, w, np.column_stack([x, x[:, 0]]), block, 0.1) is None


def test_correlation_is_found():
    rng = np.random.default_rng(2)
    found = [df_.intra_block_correlation(*planted(rng, 90)[:1], np.ones(90), *planted(np.random.default_rng(5), 90)[2:]) for _ in range(1)]
    assert np.isfinite(found[0])
    block = np.repeat(np.arange(60), 3)
    x = np.ones((180, 1))
    each = []
    for _ in range(20):
        y = rng.normal(size=60)[block] + rng.normal(size=180)  # rho 0.5
        each.append(df_.intra_block_correlation(y, np.ones(180), x, block))
    assert np.mean(each) == pytest.approx(0.5, abs=0.06)


@pytest.fixture(scope="module")
def tables(spark):
    rng = np.random.default_rng(3)
    donors = [(f"s{i}", f"d{i // 3}", "abc"[i % 3], float(i % 5)) for i in range(36)]
    effect = rng.normal(size=50) * (np.arange(50) < 10)
    hidden = rng.normal(size=36)
    load = rng.normal(size=50)
    rows = [(f, f"s{i}", float(effect[f] * (i % 3 == 1) + rng.normal() * 0.3 + 2 * load[f] * hidden[i] + (i // 3 % 4) * 0.1), float(rng.uniform(0.5, 2))) for f in range(50) for i in range(36)]
    return spark.createDataFrame(rows, "feature int, sample string, value double, weight double"), spark.createDataFrame(donors, "sample string, donor string, kind string, age double"), rows, donors, hidden


def test_contrasts_against_matrices(tables):
    values, samples, rows, donors, _ = tables
    own, names = df_.design_columns(samples, ["kind"], ["age"])
    assert names == ["intercept", "kind_b", "kind_c", "age_value"]
    got = {(r.feature, r.contrast): r for r in df_.fit_contrasts(values, own, names, {"b": [0, 1, 0, 0], "b_minus_c": [0, 1, -1, 0]}, "donor", 0.3).collect()}
    x = np.array([[1, d[2] == "b", d[2] == "c", d[3]] for d in donors], float)
    block = np.array([int(d[1][1:]) for d in donors])
    for f in (0, 7, 49):
        own_rows = {r[1]: r for r in rows if r[0] == f}
        y, w = (np.array([own_rows[d[0]][j] for d in donors]) for j in (2, 3))
        b, c, s2 = plain(y, w, x, block, 0.3)
        for name, v in (("b", [0, 1, 0, 0]), ("b_minus_c", [0, 1, -1, 0])):
            r = got[f, name]
            assert r.estimate == pytest.approx(np.dot(v, b)) and r.unscaled == pytest.approx(np.sqrt(np.array(v) @ c @ v)) and r.s2 == pytest.approx(s2) and r.df == 32
    table = df_.differential_table(df_.fit_contrasts(values, own, names, {"b": [0, 1, 0, 0]})).collect()
    assert len(table) == 50 and all(0 <= r.p <= r.q <= 1 for r in table)


def test_factors_find_what_is_hidden(tables):
    values, samples, _, _, hidden = tables
    own, names = df_.design_columns(samples, ["kind"])
    got = {r.sample: r.value for r in df_.unwanted_factors(values, own, names, ["kind_b"], 1).collect()}
    x = np.array([[1, i % 3 == 2] for i in range(36)], float)  # what isn't tested is free
    rest = lambda v: v - x @ np.linalg.lstsq(x, v, rcond=None)[0]
    assert abs(np.corrcoef(rest(np.array([got[f"s{i}"] for i in range(36)])), rest(hidden))[0, 1]) > 0.95


def test_designs_are_checked(spark, tables):
    _, samples, *_ = tables
    df_.check_blocked(samples, "kind", "donor", None)
    with pytest.raises(ValueError):
        df_.check_blocked(samples.withColumn("all", F.lit(1)), "all", "donor", None)
    assert -1 < df_.consensus_correlation(tables[0], *df_.design_columns(samples, ["kind"]), "donor") < 1


def test_weights_follow_the_trend(spark):
    rng = np.random.default_rng(6)
    rows = [(f, f"s{i}", int(rng.poisson(2.0 ** (1 + f / 12)))) for f in range(120) for i in range(20)]
    counts = spark.createDataFrame([r for r in rows if r[2]], "feature int, sample string, count long")
    samples = spark.createDataFrame([(f"s{i}",) for i in range(20)], "sample string")
    own, names = df_.design_columns(samples)
    w = {r.feature: r.w for r in df_.mean_variance_weights(df_.expressed(counts, samples, 1, 2), own, names).groupBy("feature").agg(F.avg("weight").alias("w")).collect()}
    assert np.mean([w[f] for f in range(100, 120)]) > 5 * np.mean([w[f] for f in range(20, 40)])
