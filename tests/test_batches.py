"""Soft-cluster batch correction: planted batches get mixed, planted groups stay apart, one cluster is ridge regression."""

import numpy as np
import pytest

from omicspark.operators import batches


def planted(seed=3):
    rng = np.random.default_rng(seed)
    centres = np.array([[6, 0, 0, 1], [0, 6, 0, 1], [0, 0, 6, 1.0]])
    group, batch = np.repeat([0, 1, 2], 60), np.tile([0, 1], 90)
    x = centres[group] + rng.normal(0, 0.4, (180, 4)) + np.where(batch[:, None] == 1, [1.5, 1.0, -0.8, 2.0], 0)
    return x, group, batch


def mixing(x, batch):
    """Share of a row's 10 nearest that are of the other batch."""
    d = ((x[:, None] - x[None]) ** 2).sum(2)
    np.fill_diagonal(d, np.inf)
    near = d.argsort(1)[:, :10]
    return float((batch[near] != batch[:, None]).mean())


def test_planted_batches_are_mixed_and_groups_kept(spark):
    x, group, batch = planted()
    df = spark.createDataFrame([(i, v.tolist(), f"b{b}") for i, (v, b) in enumerate(zip(x, batch, strict=True))] + [(999, None, "b0"), (998, [0.0] * 4, None)], "id long, vector array<double>, batch string")
    got = {r.id: r.vector for r in batches.soft_cluster_correction(df, 3).collect()}
    y = np.array([got[i] for i in range(180)])
    assert len(got) == 180 and mixing(x, batch) < 0.1 and mixing(y, batch) > 0.4
    gap = lambda z, g: np.linalg.norm(z[(group == g) & (batch == 0)].mean(0) - z[(group == g) & (batch == 1)].mean(0))
    assert all(gap(y, g) < 0.15 * gap(x, g) for g in range(3))
    d = ((y[:, None] - y[None]) ** 2).sum(2)
    np.fill_diagonal(d, np.inf)
    assert (group[d.argsort(1)[:, :10]] == group[:, None]).mean() > 0.99


def test_one_cluster_is_ridge_regression(spark):
    x, _, batch = planted(4)
    df = spark.createDataFrame([(i, v.tolist(), int(b)) for i, (v, b) in enumerate(zip(x, batch, strict=True))], "id long, vector array<double>, batch int")
    got = {r.id: r.vector for r in batches.soft_cluster_correction(df, 1, ridge=5.0).collect()}
    design = np.column_stack([np.ones(len(x)), batch == 0, batch == 1]).astype(float)
    beta = np.linalg.solve(design.T @ design + np.diag([0, 5.0, 5.0]), design.T @ x)
    assert np.allclose([got[i] for i in range(len(x))], x - design[:, 1:] @ beta[1:], atol=1e-9)


def test_one_batch_stays_and_rounds_raise(spark):
    x, _, batch = planted(5)
    df = spark.createDataFrame([(i, v.tolist(), int(b)) for i, (v, b) in enumerate(zip(x, batch, strict=True))], "id long, vector array<double>, batch int")
    one = {r.id: r.vector for r in batches.soft_cluster_correction(df.filter("batch = 0")).collect()}
    assert all(one[i] == x[i].tolist() for i in one) and len(one) == 90
    assert batches.soft_cluster_correction(df.limit(0)).collect() == []
    with pytest.raises(RuntimeError, match="1 rounds"):
        batches.soft_cluster_correction(df, 3, rounds=1)
