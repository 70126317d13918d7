"""Windows of whole chunks and linkage scores by annotation against plain numpy over chunk borders."""

import numpy as np
import pytest

from omicspark.operators import linkage as lg

SCHEMA = "chr string, pos long, snp string, cm double, dosage array<double>, annotations array<double>, scored boolean"


def plain(cm, g, ann, scored, window, chunk):
    """Left and right limits of each variant in places, as one window of whole chunks."""
    n, m = g.shape
    left = np.array([(cm < c - window).sum() for c in cm])
    far = np.flatnonzero(left > 0)
    block = -(-(far[0] + 1) // chunk) * chunk if len(far) else n
    limit = np.array([0 if i < block else left[i // chunk * chunk] // chunk * chunk for i in range(n)])
    z = (g - g.mean(1, keepdims=True)) / g.std(1, keepdims=True)
    out = {}
    for i in range(n):
        if scored[i]:
            right = np.flatnonzero(limit <= i)[-1]
            r2 = (z[limit[i] : right + 1] @ z[i] / m) ** 2
            out[i] = (r2 - (1 - r2) / (m - 2)) @ np.array([ann[j] if ann[j] is not None else np.zeros(2) for j in range(limit[i], right + 1)])
    return out


@pytest.mark.parametrize(("chunk", "tile", "spread"), [(5, 2, 0.05), (7, 1, 0.2), (4, 3, 0.0), (50, 20, 0.03)])
def test_scores_match_numpy_over_chunk_borders(spark, chunk, tile, spread):
    rng = np.random.default_rng(5)
    n, m = 83, 30
    g = rng.integers(0, 3, (n, m)).astype(float)
    cm = np.cumsum(rng.exponential(spread or 1e-9, n)) if spread else np.zeros(n)
    ann = [None if i % 4 == 3 else [1.0, float(i % 5)] for i in range(n)]
    scored = [i % 2 == 0 for i in range(n)]
    rows = [("c1", 10 * i, f"r{i}", float(cm[i]), g[i].tolist(), ann[i], scored[i]) for i in range(n)]
    rows += [("c1", 405, "same", float(cm[40]), [0.0] * m, [9.0, 9.0], True)]  # one allele only
    rows += [("c2", 3, "q", 0.0, g[0].tolist(), None, True), (None, 3, "x", 0.0, g[0].tolist(), [1.0, 1.0], True)]
    got = {(r.chr, r.snp): r.scores for r in lg.annotation_scores(spark.createDataFrame(rows, SCHEMA).repartition(3), m, 2, 1.0, chunk, tile).collect()}
    want = plain(cm, g, ann, scored, 1.0, chunk)
    assert got.pop(("c2", "q")) == [0.0, 0.0]
    assert set(got) == {("c1", f"r{i}") for i in want}
    for i, s in want.items():
        assert got["c1", f"r{i}"] == pytest.approx(s, abs=1e-9)


def test_missing_dosages_count_as_the_mean_and_common_sums(spark):
    g = [[0.0, 1, 2, None, 1], [2.0, 1, 0, 1, None], [0.0, 0, 0, 0, 0.2], [1.0, 1, 1, 1, 1], [None] * 5]
    rows = [("c", i, f"r{i}", 0.1 * i, [None if d is None else float(d) for d in v], [1.0, 2.0 + i], True) for i, v in enumerate(g)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.snp: r.scores[0] for r in lg.annotation_scores(df, 5, 2).collect()}
    z = np.array([[0, 1, 2, 1, 1], [2, 1, 0, 1, 1], [0, 0, 0, 0, 0.2]], float)
    r2 = np.corrcoef(z) ** 2
    assert set(got) == {"r0", "r1", "r2"}  # r3 doesn't vary, r4 is unknown
    assert [got[f"r{i}"] for i in range(3)] == pytest.approx((r2 - (1 - r2) / 3).sum(1))
    assert {r.annotation: (r.total, r.total_squares) for r in lg.common_annotation_sums(df).collect()} == {1: (3.0, 3.0), 2: (10.0, 38.0)}
    assert lg.annotation_scores(df.limit(0), 5, 2).collect() == []
