"""Operators on many copies of few places or values: right rows, and work that doesn't grow with the square of the copies."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from omicspark.operators import heritability as hr
from omicspark.operators import intervals as iv
from omicspark.operators import reports as rp
from omicspark.operators import studies as st


@pytest.fixture
def pairs(monkeypatch):
    """Number of pairs of each overlap join that studies or heritability make."""
    made = []

    def counted(*args, **kwargs):
        df = iv.overlap_join(*args, **kwargs)
        made.append(df.count())
        return df

    for module in (st, hr):
        monkeypatch.setattr(module, "overlap_join", counted)
    return made


def test_overlap_measures(spark, pairs):
    fragments = spark.createDataFrame([("A", 0, 9, i) for i in range(40)], "chr string, start bigint, end bigint, cell int")
    peaks = spark.createDataFrame([("A", 5, 12, i) for i in range(30)] + [("A", 20, 25, 30)], "chr string, start bigint, end bigint, peak int")
    found = st.overlap_measures(fragments, peaks, 8, F.col("r_peak") % 2, 700).collect()
    assert sorted((r.trait, r.measure, r.value, r.enough) for r in found) == [(0, "n_overlaps", 600, False), (0, "n_peaks", 15, False), (1, "n_overlaps", 600, False), (1, "n_peaks", 15, False)]
    assert sum(pairs) == 1


def test_mass_inside(spark, pairs):
    variants = spark.createDataFrame([(i, i % 2, "A", i % 10, i % 10 + 1, 0.5) for i in range(20)], "variant int, locus int, chr string, start bigint, end bigint, pip double")
    ranges = spark.createDataFrame([("A", i % 3, i % 3 + 3, "x") for i in range(30)] + [("A", 8, 20, "y")], "chr string, start bigint, end bigint, annotation string")
    found = sorted(map(tuple, hr.mass_inside(variants, ranges, 4).collect()))
    assert found == [("x", 0, 3.0, 5.0), ("x", 1, 2.0, 5.0), ("y", 0, 1.0, 5.0), ("y", 1, 1.0, 5.0)]
    assert sum(pairs) == 14


def test_cut_sites(spark):
    fragments = spark.createDataFrame([("A", i % 5, i % 5 + 6, i % 3) for i in range(30)], "chr string, start bigint, end bigint, cell int")
    rows = [("A", 2, 4, i) for i in range(4)] + [("A", 2, 4, 9), ("A", 7, 9, 9), ("A", 30, 31, 10)]
    regions = spark.createDataFrame(rows, "chr string, start bigint, end bigint, peak int")
    expected = {}
    for f in fragments.collect():
        for _, a, b, peak in rows:
            if a <= f.start < b or a <= f.end - 1 < b:
                expected[peak, f.cell] = expected.get((peak, f.cell), 0) + 1
    assert {(r.peak, r.cell): r.n for r in iv.cut_sites_per_region(fragments, regions, "cell", "peak", 4).collect()} == expected
    single = iv.cut_sites_per_region(fragments, regions.filter("peak < 9"), "cell", "peak", 4)
    assert {(r.peak, r.cell): r.n for r in single.collect()} == {k: v for k, v in expected.items() if k[0] < 9}
    assert "Exchange hashpartitioning(r_peak#" not in single._jdf.queryExecution().executedPlan().toString()


def test_drawn_medians(spark):
    rng = np.random.default_rng(1)
    rows = [("ab"[i % 2], int(c), float(v)) for i, (c, v) in enumerate(zip(rng.integers(0, 12, 400), rng.integers(-9, 30, 400) / 4, strict=True))]
    df = spark.createDataFrame(rows + [("a", 3, None)], "g string, c int, v double").repartition(5)
    found = {(r.g, r.draw): r.m for r in rp.drawn_medians(df, ["g"], "c", "v", 4, 1).collect()}
    times = {(r.c, r.draw): r.times for r in hr.multinomial_weights(df, "c", 4, 1).collect()}
    for (g, draw), m in found.items():
        taken = [v for a, c, v in rows if a == g for _ in range(times.get((c, draw), 0) if draw else 1)]
        assert m == np.median(taken)
    assert len(found) == 10
    both = {r.g: r for r in rp.bootstrap_medians(df, ["g"], "c", "v", 4, 1).collect()}
    ratios = {r.g: r for r in rp.bootstrap_ratios(df, "a", "g", "c", "v", 4, 1).collect()}
    for g in "ab":
        assert both[g].median == found[g, 0] and both[g].low == pytest.approx(np.quantile([found[g, d] for d in range(1, 5)], 0.025))
        assert ratios[g].ratio == found[g, 0] / found["a", 0] and ratios[g].high == pytest.approx(np.quantile([found[g, d] / found["a", d] for d in range(1, 5)], 0.975))
