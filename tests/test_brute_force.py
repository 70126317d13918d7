"""Operators that SQL cannot express against plain numpy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from omicspark.operators import background as bg
from omicspark.operators import enrichment as en
from omicspark.operators import heritability as hr
from omicspark.operators import links as lk
from omicspark.operators import matrix as mx
from omicspark.operators import models as md
from omicspark.operators import profiles as pf


def test_markers_have_normal_tails_and_bh(spark):
    rng = np.random.default_rng(1)
    rows = [(f, c, int(rng.poisson(3 + 4 * (f == 0 and c < 20)))) for f in range(12) for c in range(60)]
    counts = spark.createDataFrame([r for r in rows if r[2]], "feature int, cell int, count long")
    groups = spark.createDataFrame([(c, int(c < 20)) for c in range(60)], "cell int, group int")
    got = mx.marker_table(counts, groups).collect()
    for r in got:
        assert r.p == pytest.approx(math.erfc(abs(r.z) / math.sqrt(2)), abs=1e-12)
    for g in (0, 1):
        own = sorted((r for r in got if r.group == g), key=lambda r: r.p)
        q = np.minimum.accumulate([r.p * len(own) / (i + 1) for i, r in reversed(list(enumerate(own)))])[::-1]
        assert [r.q for r in own] == pytest.approx(np.minimum(q, 1))
    assert min(got, key=lambda r: r.p).feature == 0


def test_mixture_weights(spark):
    rng = np.random.default_rng(2)
    v = rng.uniform(0.01, 1, (40, 3))
    w = np.full(3, 1 / 3)
    for _ in range(2000):
        r = v * w
        w = ((r / r.sum(1, keepdims=True)).sum(0) + 1) / (40 + 3)
    df = spark.createDataFrame([(i, j, float(v[i, j])) for i in range(40) for j in range(3)], "l int, g int, v double")
    got = {r.g: r.weight for r in en.mixture_weights(df, "l", "g", "v").collect()}
    assert [got[j] for j in range(3)] == pytest.approx(w, abs=1e-4)


def test_matched_controls_are_near(spark):
    rng = np.random.default_rng(3)
    ref = [(i, float(rng.normal()), float(rng.uniform())) for i in range(300)]
    sets = [("a", 1), ("a", 2), ("b", 2)]
    got = bg.matched_controls(spark.createDataFrame(ref, "feature int, abundance double, detection double"), spark.createDataFrame(sets, "label string, feature int"), 50, 10).collect()
    assert len(got) == 150
    x = np.array([r[1:] for r in ref])
    x = x / x.std(0, ddof=1)
    for m in (1, 2):
        d = ((x - x[m]) ** 2).sum(1)
        d[[1, 2]] = np.inf
        assert {r.feature for r in got if r.marker == m} <= set(np.argsort(d)[:10].tolist())
        assert len({r.feature for r in got if r.marker == m}) > 5


@pytest.mark.parametrize("kind", ["spread", "tied", "few", "flat"])
def test_nearest_features_are_exact(spark, kind):
    rng = np.random.default_rng(6)
    n, k = (12, 20) if kind == "few" else (400, 20)
    x = np.c_[rng.exponential(1, n) ** 3, rng.uniform(0, 1, n)]
    if kind == "tied":
        x[:250] = 0.0
        x[250:] = np.round(x[250:], 1)
    if kind == "flat":
        x[:, 1] = 0.5
    rows = [(i, *map(float, r)) for i, r in enumerate(x)] + [(n, None, 0.5), (n + 1, 0.5, None)]
    markers = [0, 5, n - 1, n]
    got = {}
    for r in bg.nearest_features(spark.createDataFrame(rows, "feature int, abundance double, detection double"), spark.createDataFrame([(m,) for m in markers * 2], "feature int"), k).collect():
        got.setdefault(r.feature, {})[r.place] = r.control
    scaled = x / np.where(x.std(0, ddof=1) > 0, x.std(0, ddof=1), 1)
    pool = [i for i in range(n) if i not in markers]
    assert set(got) == set(markers[:3])
    for m in markers[:3]:
        want = sorted(pool, key=lambda i: (round(float(((scaled[i] - scaled[m]) ** 2).sum()), 12), i))[:k]
        assert [got[m][i] for i in range(len(want))] == want and len(got[m]) == len(want)


def test_shift_offsets_are_allowed_and_even(spark):
    blocks, bad = [(1, "c", 500, 510), (2, "c", 5, 9), (3, "d", 50, 60)], [("c", 560, 600), ("c", 400, 420), ("d", 0, 1000)]
    df = lambda rows, s: spark.createDataFrame(rows, s)
    got = bg.shift_offsets(df(blocks, "block int, chr string, start long, end long"), df(bad, "chr string, start long, end long"), df([("c", 1000), ("d", 1000)], "chr string, size long"), 2000, (20, 120)).collect()
    assert {r.block for r in got} == {1, 2}
    for b, _, s, e in blocks[:2]:
        ok = {k for k in range(-120, 121) if abs(k) >= 20 and s + k >= 0 and e + k <= 1000 and all(e + k <= x or s + k >= y for c, x, y in bad if c == "c")}
        seen = [r["shift"] for r in got if r.block == b]
        assert len(seen) == 2000 and set(seen) <= ok and len(set(seen)) > 0.9 * len(ok)


def test_variability_tail(spark):
    rng = np.random.default_rng(4)
    rows = [(a, c, float(rng.normal() * (1 + (a == "wide")))) for a in ("even", "wide") for c in range(400)]
    got = {r.annotation: r for r in bg.variability(spark.createDataFrame(rows, "annotation string, cell int, z double")).collect()}
    assert got["wide"].p < 1e-20 and 0.001 < got["even"].p < 0.999
    z = np.array([r[2] for r in rows if r[0] == "even"])
    k = 399 / 2  # chi-square tail by the normal limit of its cube root
    x = 399 * z.std(ddof=1) ** 2
    u = ((x / 399) ** (1 / 3) - (1 - 2 / (9 * 399))) / math.sqrt(2 / (9 * 399))
    assert got["even"].p == pytest.approx(0.5 * math.erfc(u / math.sqrt(2)), abs=2e-3) and k > 0


@pytest.fixture(scope="module")
def group(spark):
    rng = np.random.default_rng(5)
    agg = [("g", f"a{i:02d}", f"d{i % 4}", int(rng.integers(100, 900)), int(rng.integers(100, 900))) for i in range(40)]
    hidden = rng.normal(size=40)
    values = [("g", f, f"a{i:02d}", float(rng.normal() * 0.3 + hidden[i] * (1 + f % 3) + (i % 4))) for f in range(30) for i in range(40)]
    return spark.createDataFrame(agg, "cell_group string, aggregate string, donor string, gene_depth long, peak_depth long"), spark.createDataFrame(values, "cell_group string, feature int, aggregate string, value double"), agg, values, hidden


def test_residuals_and_latent_factors(group):
    a, v, agg, values, hidden = group
    design = lk.nuisance_design(a)
    x = np.array([r.x for r in sorted(design.collect(), key=lambda r: r.aggregate)])
    assert x.shape == (40, 6) and np.linalg.matrix_rank(x) == 6
    rest = {(r.feature, r.aggregate): r.residual for r in lk.residuals(v, design).collect()}
    y = np.array([[r[3] for r in values if r[1] == f] for f in range(30)]).T
    e = y - x @ np.linalg.lstsq(x, y, rcond=None)[0]
    assert np.allclose([[rest[f, f"a{i:02d}"] for f in range(30)] for i in range(40)], e)
    factors = lk.latent_factors(lk.residual_gram(lk.residuals(v, design)), design, 10).collect()
    assert {r.factor for r in factors} == {1, 2, 3}
    first = np.array([r.value for r in sorted((r for r in factors if r.factor == 1), key=lambda r: r.sample)])
    inner = hidden - x @ np.linalg.lstsq(x, hidden, rcond=None)[0]
    assert abs(np.corrcoef(first, inner)[0, 1]) > 0.98 and (first**2).mean() == pytest.approx(1)


def test_lloyd_reaches_a_fixed_point(spark):
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(size=(30, 2)) * 0.2 + c for c in ((0, 0), (5, 5), (0, 6))])
    df = spark.createDataFrame([("g", i, [float(a) for a in r]) for i, r in enumerate(x)], "cell_group string, id int, vector array<double>")
    got = {r.id: r.state for r in lk.lloyd(df, spark.createDataFrame([("g", 3)], "cell_group string, k int"), 30).collect()}
    labels = np.array([got[i] for i in range(90)])
    centres = np.array([x[labels == s].mean(0) for s in sorted(set(labels))])
    assert (((x[:, None] - centres) ** 2).sum(2).argmin(1) == np.searchsorted(sorted(set(labels)), labels)).all()


def test_components_match_svd(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(80, 6)) * [5, 3, 1, 1, 1, 1] + 2
    df = spark.createDataFrame([(i, [float(a) for a in r]) for i, r in enumerate(x)], "id int, vector array<double>").repartition(3)
    axes, scores = pf.principal_components(df, 2)
    u, s, vt = np.linalg.svd(x - x.mean(0), full_matrices=False)
    for r in axes.collect():
        assert r.singular == pytest.approx(s[r.component - 1]) and abs(r.loading) == pytest.approx(abs(vt[r.component - 1, r.place]), abs=1e-9)
    for r in scores.collect():
        assert abs(r.value) == pytest.approx(abs(u[r.id, r.component - 1] * s[r.component - 1]), abs=1e-8)


def test_doublets_lie_among_made_ones(spark):
    rng = np.random.default_rng(8)
    a, b = rng.normal(size=(60, 4)) * 0.3, rng.normal(size=(60, 4)) * 0.3 + 6
    x = np.concatenate([a, b, (a[:8] + b[:8]) / 2])
    got = {r.id: r.score for r in pf.doublet_scores(spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id long, vector array<double>"), 10).collect()}
    assert len(got) == 128 and np.mean([got[i] for i in range(120, 128)]) > 0.6 > 0.5 > np.mean([got[i] for i in range(120)])


def test_consensus_peaks(spark):
    rows = [("g", 0, "c", 0, 10, 5.0, "a"), ("g", 0, "c", 5, 15, 9.0, "b"), ("g", 1, "c", 8, 18, 7.0, "c"), ("g", 0, "c", 100, 110, 3.0, "d"), ("g", 1, "c", 200, 210, 4.0, "e"), ("g", 0, "c", 300, 310, 2.0, "f"), ("g", 1, "c", 305, 315, 1.0, "h")]
    df = spark.createDataFrame(rows, "group string, replicate int, chr string, start long, end long, score double, name string")
    got = pf.consensus_peaks(df, "replicate", "score", "name", spark.createDataFrame([("g", 1)], "group string, n_cells int"), 10, 100, 50).collect()
    assert {(r.name, r.quantile) for r in got} == {("b", 1.0), ("f", 0.5)}


def test_models_share_cross_products(spark):
    rng = np.random.default_rng(9)
    x = np.column_stack([np.ones(400), rng.normal(size=(400, 2))])
    y = x @ [1, 2, -1] + rng.normal(size=400)
    df = spark.createDataFrame([(i, *map(float, x[i, 1:]), float(y[i])) for i in range(400)], "k int, a double, b double, y double")
    blocks = md.block_crossproducts(df, ["k"], "y", ["a", "b"], 10)
    got = {(r.model, r.term): r for r in hr.fit_models(blocks, {"both": [0, 1, 2], "b": [0, 2]}, 3).collect()}
    for name, t in (("both", [0, 1, 2]), ("b", [0, 2])):
        whole = np.linalg.lstsq(x[:, t], y, rcond=None)[0]
        keep = [np.r_[0 : 40 * k, 40 * k + 40 : 400] for k in range(10)]
        each = np.array([np.linalg.lstsq(x[i][:, t], y[i], rcond=None)[0] for i in keep])
        se = np.sqrt(0.9 * ((each - each.mean(0)) ** 2).sum(0))
        for j, term in enumerate(t):
            assert got[name, term].estimate == pytest.approx(whole[j]) and got[name, term].se == pytest.approx(se[j])
    shares = hr.share_jackknife(blocks, {"one": [5, 2, 1]}, [10, 4, 3], 3).first()
    ratio = lambda b: (b @ [5, 2, 1]) / (b @ [10, 4, 3])
    each = np.array([ratio(np.linalg.lstsq(x[i], y[i], rcond=None)[0]) for i in keep])
    assert shares.share == pytest.approx(ratio(np.linalg.lstsq(x, y, rcond=None)[0])) and shares.se == pytest.approx(np.sqrt(0.9 * ((each - each.mean()) ** 2).sum()))


def test_multinomial_weights_sum_to_the_clusters(spark):
    got = hr.multinomial_weights(spark.range(50).withColumnRenamed("id", "c"), "c", 40).groupBy("draw").agg(F.sum("times").alias("n"), F.count("c").alias("k")).collect()
    assert len(got) == 40 and all(r.n == 50 for r in got) and 28 < np.mean([r.k for r in got]) < 35
