"""Operators without SQL that had no comparison: correlations, halves, paired contrasts, joint reselection."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from omicspark.operators import joint as jt
from omicspark.operators import links as lk
from omicspark.operators import tables as tb
from omicspark.queries import QUERIES, differential_queries, joint_queries

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def t(spark):
    return lambda name: spark.read.parquet(f"{DATA}/{name}.parquet")


def test_link_correlations_equal_numpy(spark):
    rng = np.random.default_rng(1)
    x = {(g, p): rng.normal(size=(12, 2)) for g in ("a", "b") for p in (1, 2)}
    x["a", 1][:, 1] += x["a", 1][:, 0]
    rows = [("g", g, p, f"s{i}", float(v[0]), float(v[1])) for (g, p), m in x.items() for i, v in enumerate(m)]
    rows += [("g", "flat", 1, f"s{i}", 1.0, float(i)) for i in range(4)]
    got = {(r.gene, r.peak): r for r in lk.link_correlations(spark.createDataFrame(rows, "cell_group string, gene string, peak int, aggregate string, gene_value double, peak_value double")).collect()}
    for k, m in x.items():
        assert got[k].n == 12 and got[k].r == pytest.approx(np.corrcoef(m.T)[0, 1], abs=1e-12)
    assert got["flat", 1].r is None or np.isnan(got["flat", 1].r)


def test_halves_are_the_rows_of_least_hash_dealt_in_turn(spark):
    rows = [(f"g{i % 3}", i, 10 if i % 3 else 1) for i in range(70)]
    df = spark.createDataFrame(rows, "g string, id long, depth int").withColumns({"h": F.xxhash64("id", F.lit(1)), "h2": F.xxhash64("id", F.lit(2))})
    got = {r.id: r.replicate for r in tb.hashed_halves(df.select("g", "id", "depth"), "id", ["g"], "depth", 100, 20).collect()}
    want = {}
    for g in ("g0", "g1", "g2"):
        kept = sorted((r for r in df.collect() if r.g == g), key=lambda r: (r.h, r.id))[:20]
        for i, r in enumerate(sorted(kept, key=lambda r: (r.h2, r.id)), 1):
            want[r.id] = "pooled" if sum(x.depth for x in kept) < 100 else f"half{i % 2 + 1}"
    assert got == want and set(want.values()) == {"pooled", "half1", "half2"}


def test_paired_contrasts_equal_least_squares(spark, t):
    got = {(r.feature, r.contrast): r for r in QUERIES["differential_paired"](spark, DATA).collect()}
    v = differential_queries.values(t).join(differential_queries.samples(t), "sample").select("type", "feature", "donor", "value").collect()
    by = {}
    for r in v:
        by.setdefault((r.feature, r.donor), {})[r.type] = r.value
    for feature in {f for f, _ in got}:
        pairs = [(d, x["A"] - x["R"]) for (f, d), x in by.items() if f == feature and {"A", "R"} <= set(x)]
        y, x = np.array([p[1] for p in pairs]), np.array([[1.0, p[0] % 2] for p in pairs])
        beta, rss = np.linalg.lstsq(x, y, rcond=None)[:2]
        s2 = rss[0] / (len(y) - 2)
        for name, i in (("A_minus_R", 0), ("A_minus_R_odd", 1)):
            r = got[feature, name]
            assert (r.estimate, r.s2) == pytest.approx((beta[i], s2 / 2), rel=1e-8)  # both types weigh 1, their difference a half
            assert r.se == pytest.approx(np.sqrt(s2 * np.linalg.inv(x.T @ x)[i, i]), rel=1e-8)


def test_reselected_neighbours_are_the_best_of_the_kept(spark, t):
    k = joint_queries.K
    first, second = joint_queries.modality(t, 1), joint_queries.modality(t, 33)
    weights = jt.modality_weights(first, second, k)
    kept = first[1].filter("id % 3 = 0").select("id")
    queries = kept.filter("id % 9 = 0")
    got = {}
    for r in jt.reselected(first, second, weights, kept, queries, k, k).collect():
        got.setdefault(r.src, []).append((r["rank"], r.dst, r.score))
    w = {r.src: (r.w1, r.w2) for r in weights.collect()}
    parts = []
    for edges, vectors, widths in (first, second):
        parts.append(({r.id: np.array(r.vector) for r in vectors.collect()}, {r.src: r.nearest for r in jt.second_distance(edges).collect()}, {r.src: r.width for r in widths.collect()}))
    ids = sorted(r.id for r in kept.collect())
    assert set(got) == {i for i in ids if i % 9 == 0}
    for q in got:
        pool = set()
        for v, _, _ in parts:
            pool |= set(sorted((i for i in ids if i != q), key=lambda i: (round(float(np.linalg.norm(v[q] - v[i])), 9), i))[:k])
        score = lambda i: sum(w[q][j] * np.exp(-max(np.linalg.norm(v[q] - v[i]) - near[q], 0) / width[q]) for j, (v, near, width) in enumerate(parts))  # noqa: B023, E731
        want = sorted(pool, key=lambda i: (-round(float(score(i)), 9), i))[:k]
        assert [i for _, i, _ in sorted(got[q])] == want
        assert [s for _, _, s in sorted(got[q])] == pytest.approx([score(i) for i in want], abs=1e-9)
