"""Tails, moderated variances and drawn backgrounds against closed forms and planted values."""

import math
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from omicspark.functions import tails
from omicspark.operators import models, reports


def upper(k, mean):
    """P(X > k) summed from the largest term outward."""
    terms = [-mean + i * math.log(mean) - math.lgamma(i + 1) for i in range(k + 1, k + 4000)]
    top = max(terms)
    return math.exp(top) * sum(math.exp(t - top) for t in terms)


@pytest.mark.parametrize(("k", "mean"), [(2, 1.0), (60, 5.0), (900, 800.0), (1100, 1000.0), (1010, 1000.0), (0, 0.5), (100_500, 100_000.0), (20, 1e-3)])
def test_poisson_tail(spark, k, mean):
    got = spark.range(1).select(tails.poisson_above(F.lit(k), F.lit(mean))).first()[0]
    assert got == pytest.approx(upper(k, mean), rel=1e-7)


def test_poisson_tail_edges(spark):
    rows = [(-1, 3.0, 1.0), (0, 0.0, 0.0), (2000, 1000.0, upper(2000, 1000.0)), (10, 1000.0, 1.0)]
    for r in spark.createDataFrame(rows, "k int, mean double, p double").withColumn("got", tails.poisson_above(F.col("k"), F.col("mean"))).collect():
        assert r.got == pytest.approx(r.p, rel=1e-7, abs=1e-300)


def test_digamma_and_trigamma(spark):
    gamma = 0.5772156649015329
    known = [(1.0, -gamma, math.pi**2 / 6), (0.5, -gamma - 2 * math.log(2), math.pi**2 / 2), (2.5, -gamma - 2 * math.log(2) + 2 + 2 / 3, math.pi**2 / 2 - 4 - 4 / 9)]
    for x, first, second in known:
        d, t, back = spark.range(1).select(tails.digamma(F.lit(x)), tails.trigamma(F.lit(x)), tails.inverse_trigamma(tails.trigamma(F.lit(x)))).first()
        assert d == pytest.approx(first, abs=1e-9) and t == pytest.approx(second, rel=1e-9) and back == pytest.approx(x, rel=1e-6)


def fits(spark, s2, df):
    rows = [(i, 1.0, float(v), math.sqrt(v / 10), df) for i, v in enumerate(s2)]
    return spark.createDataFrame(rows, "feature int, slope double, s2 double, se double, df int")


def test_moderation_finds_the_planted_prior(spark):
    rng = np.random.default_rng(3)
    equal = models.moderate(fits(spark, 2.0 * rng.chisquare(4, 3000) / 4, 4)).first()
    assert equal.total_df > 100
    true = 2.0 * 8 / rng.chisquare(8, 6000)  # scaled inverse chi-square with 8 degrees of freedom
    spread = models.moderate(fits(spark, true * rng.chisquare(4, 6000) / 4, 4))
    assert spread.first().total_df - 4 == pytest.approx(8, rel=0.2)
    one = spread.filter("feature = 7").first()
    s0 = 2.0
    assert one.moderated_t == pytest.approx(1 / math.sqrt((8 * s0 + 4 * one.s2) / 12 / 10), rel=0.1)


@pytest.mark.parametrize("n_peaks", [60, 3000])
def test_background_pairs(spark, n_peaks):
    genes = spark.createDataFrame([(f"g{i}", "AB"[i % 2], 1000 * i, 1000 * i + 50) for i in range(12)], "gene string, chr string, start long, end long")
    peaks = spark.createDataFrame([(i, "AB"[i % 2], 13 * i % 15_000, 13 * i % 15_000 + 8) for i in range(n_peaks)], "peak int, chr string, start long, end long")
    g, p = ({r[0]: r for r in x.collect()} for x in (genes, peaks))
    got = reports.background_pairs(genes, peaks, 20, away=2000).collect()
    assert len(got) == len(set(got)) == 240
    for r in got:
        a, b = g[r.gene], p[r.peak]
        assert a.chr != b.chr or b.start - a.end > 2000 or a.start - b.end > 2000
    assert len({r.peak for r in got}) > min(n_peaks, 200) * 0.8


def test_background_pairs_are_all_there_when_few_peaks_fit(spark):
    genes = spark.createDataFrame([("a", "A", 1_000_000, 1_000_100), ("b", "B", 5, 10), ("c", "C", 0, 1), ("d", "A", 100, 300)], "gene string, chr string, start long, end long")
    # 200 peaks fit gene a: some far on its own chromosome, some on another; those of chromosome C and next to it are many
    rows = [("A", 1_000_000 + 13 * i) for i in range(4000)] + [("A", 2_000_000 + 7 * i) for i in range(150)] + [("B", 20 * i) for i in range(50)]
    peaks = spark.createDataFrame([(i, c, s, s + 5) for i, (c, s) in enumerate(rows)], "peak int, chr string, start long, end long")
    g, p = ({r[0]: r for r in x.collect()} for x in (genes, peaks))
    far = lambda a, b: a.chr != b.chr or b.start - a.end > 100_000 or a.start - b.end > 100_000
    fitting = {k: sum(far(a, b) for b in p.values()) for k, a in g.items()}
    for n in (50, 150, 1000, 5000):
        got = reports.background_pairs(genes, peaks, n, away=100_000).collect()
        assert len(got) == len(set(got)) and all(far(g[r.gene], p[r.peak]) for r in got)
        assert {k: sum(r.gene == k for r in got) for k in g} == {k: min(n, f) for k, f in fitting.items()}


def test_contrast_statistic_keeps_strong_features_apart(spark):
    from pyspark.sql import functions as F

    from omicspark.operators.differential import contrast_statistic

    rows = [(2.5, 0.5, 1.0), (None, 0.05, -2.0), (None, 1e-16, 1.0), (None, 1e-40, 1.0), (float("nan"), 1e-200, -1.0), (None, 1.0, 3.0)]
    df = spark.createDataFrame(rows, "t double, p double, estimate double")
    at = contrast_statistic(F.col("t"), F.col("p"), F.col("estimate")).alias("s")
    assert [r.s for r in df.select(at).collect()] == pytest.approx([2.5, -1.959964, 8.305202, 13.361700, -30.229594, 0.0], abs=2e-3)
    for bad in [(None, 0.0, 1.0), (None, None, 1.0), (None, 0.5, None), (None, 1.5, 1.0)]:
        with pytest.raises(Exception, match="no statistic"):
            spark.createDataFrame([bad], "t double, p double, estimate double").select(at).collect()


def test_differential_statistics_have_the_sign_and_size_of_p(spark):
    from omicspark.queries import differential_queries as q
    from omicspark.queries.base import QUERIES

    d = "/root/testdata/sf0.001"
    table = {(r.feature, r.contrast): r for r in q.df_.differential_table(q.fits(lambda n: spark.read.parquet(f"{d}/{n}.parquet"))).collect()}
    for r in QUERIES["differential_statistics"](spark, d).collect():
        one = table[r.feature, r.contrast]
        want = one.moderated_t if r.feature % 2 == 0 else -statistics.NormalDist().inv_cdf(one.p / 2) * (one.estimate > 0 or -1)
        assert r.statistic == pytest.approx(want, abs=1e-9)
