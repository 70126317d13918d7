"""Attribution weights against plain numpy EM; a planted prior is found."""

import numpy as np
import pytest

from omicspark.operators import attribution as at


def em(v, mass, prior):
    w = np.full(v.shape[1], 1 / v.shape[1])
    for _ in range(200_000):
        new = (w * (v.T @ (mass / (v @ w))) + prior / v.shape[1]) / (mass.sum() + prior)
        if np.abs(new - w).max() < 1e-13:
            return new
        w = new
    return w


def tables(spark, weights, n_loci, seed, n_features=400):
    rng = np.random.default_rng(seed)
    k = len(weights)
    like = rng.gamma(0.6, 1, (n_features, k)) + 0.02
    like /= like.sum(0)
    picked = [rng.choice(n_features, p=like[:, rng.choice(k, p=weights)]) for _ in range(n_loci)]
    pairs = [(i, int(f), f"chr{i % 7}", float(rng.uniform(0.3, 1))) for i, f in enumerate(picked)]
    df = spark.createDataFrame(pairs, "locus long, feature long, chr string, mass double")
    lk = spark.createDataFrame([(i, f"g{j}", float(like[i, j])) for i in range(n_features) for j in range(k)], "feature long, group string, likelihood double")
    bins = spark.createDataFrame([(i, i % 6) for i in range(n_features)], "feature long, bin int")
    return pairs, like, df, lk, bins


def test_weights_prior_and_nulls_equal_numpy(spark):
    pairs, like, df, lk, bins = tables(spark, [0.7, 0.2, 0.05, 0.05], 60, 2)
    found = at.attributed(df, lk, bins, priors=(0.1, 10.0, 100.0), folds=3, draws=2, tolerance=1e-9)
    v, mass = like[[p[1] for p in pairs]], np.array([p[3] for p in pairs])
    names = sorted({p[2] for p in pairs})
    fold = np.array([(names.index(p[2]) + 1) % 3 for p in pairs])
    for g in (0.1, 10.0, 100.0):
        held = sum((mass[fold == f] * np.log(v[fold == f] @ em(v[fold != f], mass[fold != f], g))).sum() for f in range(3))
        assert found.held_out[g] == pytest.approx(held, abs=1e-4)
    assert found.prior == max(found.held_out, key=found.held_out.get)
    assert found.even == pytest.approx((mass * np.log(v.mean(1))).sum(), abs=1e-8)
    assert np.allclose(found.weights, em(v, mass, found.prior), atol=1e-5)
    nulls = {(r.locus, r.draw): r.null for r in at.null_features(df, bins, 2).collect()}
    assert len(nulls) == 120 and all(n % 6 == pairs[i][1] % 6 for (i, _), n in nulls.items())
    for d in (1, 2):
        assert np.allclose(found.null[d - 1], em(like[[nulls[p[0], d] for p in pairs]], mass, found.prior), atol=1e-5)


def test_a_planted_prior_is_found(spark):
    _, _, df, lk, bins = tables(spark, [0.94, 0.02, 0.02, 0.02], 150, 5)
    strong = at.attributed(df, lk, bins, folds=5, draws=1)
    assert strong.prior <= 1.0 and strong.estimable and strong.weights[0] > 0.8
    _, _, df, lk, bins = tables(spark, [0.25] * 4, 40, 6)
    flat = at.attributed(df, lk, bins, folds=5, draws=1)
    assert flat.prior >= 10.0 and not flat.estimable
    assert {r.weight for r in at.weight_table(flat, df).collect()} == {None}
    assert at.attributed(df.limit(0), lk, bins) is None
