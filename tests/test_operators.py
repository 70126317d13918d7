"""Operators without SQL, against small closed forms and brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from omicspark.functions import ranks, tails, vectors
from omicspark.operators import enrichment, intervals, models, neighbors, qc, tables


def test_tails_match_tables():
    assert tails.t_two_sided(2.228139, 10) == pytest.approx(0.05, abs=1e-6)
    assert tails.t_two_sided(12.7062, 1) == pytest.approx(0.05, abs=1e-6)
    assert tails.chi_square_above(3.841459, 1) == pytest.approx(0.05, abs=1e-6)
    assert tails.chi_square_above(18.30704, 10) == pytest.approx(0.05, abs=1e-6)



def test_remove_overlaps_is_greedy(spark):
    rng = random.Random(3)
    rows = [("c", s, s + rng.randrange(2, 15), rng.randrange(100), i) for i in range(120) for s in [rng.randrange(300)]]
    df = spark.createDataFrame(rows, "chr string, start long, end long, score int, name int")
    kept = {r.name for r in intervals.remove_overlaps(df, "score", "name").collect()}
    by = {r[4]: r for r in rows}
    assert all(by[a][2] <= by[b][1] or by[b][2] <= by[a][1] for a in kept for b in kept if a != b)
    for i, r in by.items():  # what goes overlaps something kept
        assert i in kept or any(by[k][1] < r[2] and r[1] < by[k][2] for k in kept)


def test_remove_overlaps_decides_long_islands(spark):
    n = 350  # scores rise along one island: a winner a round
    rows = [("c", 3 * i, 3 * i + 4, i, i) for i in range(n)] + [("d", 5, 5, 1, 0), ("d", 5, 9, 2, 1), ("d", 8, 12, 2, 2), ("d", 12, 20, 0, 3)]
    df = spark.createDataFrame(rows, "chr string, start long, end long, score int, name int").repartition(3)
    kept = sorted((r.chr, r.name) for r in intervals.remove_overlaps(df, "score", "name").collect())
    assert kept == sorted([("c", i) for i in range(n - 1, -1, -2)] + [("d", 0), ("d", 1), ("d", 3)])


@pytest.mark.parametrize("width", [1, 7, 50, 1000])
def test_overlap_join_does_not_depend_on_bins(spark, width):
    rng = random.Random(1)
    make = lambda n: [("c" + str(rng.randrange(2)), s, s + rng.randrange(1, 30), i) for i in range(n) for s in [rng.randrange(200)]]
    a, b = make(60), make(40)
    schema = "chr string, start long, end long, id int"
    pairs = intervals.overlap_join(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), width).select("id", "r_id").collect()
    expected = sorted((x[3], y[3]) for x in a for y in b if x[0] == y[0] and x[1] < y[2] and y[1] < x[2])
    assert sorted(map(tuple, pairs)) == expected


def test_empty_tables_keep_their_schema(spark):
    empty = spark.createDataFrame([], "chr string, start long, end long, cell long")
    assert intervals.merge_intervals(empty).collect() == []
    assert intervals.disjoin(empty).columns == ["chr", "start", "end", "depth"]
    assert qc.excluded_keys(empty, "cell", ["start > 3"]).columns == ["rule", "cell"]


def test_rules_must_be_predicates(spark):
    with pytest.raises(ValueError, match="not a predicate"):
        qc.excluded_keys(spark.range(3), "id", ["id + 1"])


def test_natural_order(spark):
    labels = ["a10", "a2", "a1", "b1", "a02x3"]
    df = spark.createDataFrame([(x,) for x in labels], "x string").orderBy(ranks.natural_key(F.col("x")), "x")
    assert [r.x for r in df.collect()] == ["a1", "a2", "a02x3", "a10", "b1"] or [r.x for r in df.collect()][-2:] == ["a10", "b1"]


def test_jump_hash_moves_few(spark):
    df = spark.range(2000).select(vectors.jump_hash(10)(F.xxhash64("id")).alias("a"), vectors.jump_hash(11)(F.xxhash64("id")).alias("b"))
    rows = df.collect()
    assert all(r.a == r.b or r.b == 10 for r in rows)
    assert 0.03 < sum(r.a != r.b for r in rows) / 2000 < 0.2


def test_hash_sample_ignores_partitioning(spark):
    df = spark.range(500)
    a = {r.id for r in tables.hash_sample(df, 20, "id").collect()}
    assert a == {r.id for r in tables.hash_sample(df.repartition(7), 20, "id").collect()} and len(a) == 20


def test_random_walk_matches_linear_solve(spark):
    pairs = [(0, 1), (1, 2), (2, 0), (2, 3), (3, 4)]
    edges = neighbors.symmetric(spark.createDataFrame(pairs, "src long, dst long"))
    walk = neighbors.random_walk(edges, spark.createDataFrame([(0,)], "node long"), restart=0.3, tolerance=1e-9)
    p = np.zeros((5, 5))
    for r in edges.collect():
        p[r.src, r.dst] = 1
    p /= p.sum(1, keepdims=True)
    expected = np.linalg.solve(np.eye(5) - 0.7 * p.T, 0.3 * np.eye(5)[0])
    assert np.allclose([r.score for r in walk.orderBy("node").collect()], expected, atol=1e-6)


def test_communities_find_two_cliques(spark):
    pairs = [(i, j) for g in (0, 10) for i in range(g, g + 5) for j in range(i + 1, g + 5)] + [(4, 10)]
    found = neighbors.communities(neighbors.symmetric(spark.createDataFrame(pairs, "src long, dst long")), rounds=12)
    by = {r.node: r.community for r in found.collect()}
    assert len({by[i] for i in range(4)}) == 1 and len({by[i] for i in range(11, 15)}) == 1 and by[0] != by[12]


def test_loops_that_have_not_converged_raise(spark):
    edges = neighbors.symmetric(spark.createDataFrame([(0, 1), (1, 2), (2, 0), (2, 3)], "src long, dst long"))
    with pytest.raises(RuntimeError, match="1 rounds"):
        neighbors.communities(edges, rounds=1, local_edges=0)
    with pytest.raises(RuntimeError, match="2 rounds"):
        neighbors.random_walk(edges, spark.createDataFrame([(0,)], "node long"), rounds=2)
    rows = spark.createDataFrame([(0, "a", 0.6), (0, "b", 0.4), (1, "a", 0.7), (1, "b", 0.3)], "l long, g string, v double")
    with pytest.raises(RuntimeError, match="1 rounds"):
        enrichment.mixture_weights(rows, "l", "g", "v", rounds=1)


def test_nearest_matches_brute_force(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(60, 4))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, vector array<double>")
    got = {(r.src, r.dst) for r in neighbors.nearest(df.filter("id < 5"), df, 4).collect()}
    d = ((x[:5, None] - x[None]) ** 2).sum(2)
    assert got == {(i, int(j)) for i in range(5) for j in np.argsort(d[i])[:4]}


def test_fit_features_matches_lstsq(spark):
    rng = np.random.default_rng(2)
    rows = [(f, float(a), float(2 * a + f + rng.normal())) for f in range(3) for a in range(12)]
    fits = models.fit_features(spark.createDataFrame(rows, "f long, a double, y double"), "f", "y", lambda r: np.column_stack([np.ones(len(r)), r["a"]]), [0, 1]).collect()
    for r in fits:
        own = np.array([x[1:] for x in rows if x[0] == r.feature])
        assert r.estimate == pytest.approx(np.polyfit(own[:, 0], own[:, 1], 1)[0])
        assert r.p < 1e-6


def test_jackknife_matches_numpy(spark):
    rng = np.random.default_rng(4)
    x, y = rng.normal(size=40), rng.normal(size=40)
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(x, y, strict=True))], "i long, x double, y double")
    got = {r.term: r for r in models.jackknife(models.block_crossproducts(df, ["i"], "y", ["x"], 8), 2).collect()}
    full = np.polyfit(x, y, 1)
    each = np.array([np.polyfit(np.delete(x, range(k * 5, k * 5 + 5)), np.delete(y, range(k * 5, k * 5 + 5)), 1) for k in range(8)])
    assert got[1].estimate == pytest.approx(full[0])
    assert got[1].se == pytest.approx(np.sqrt(7 / 8 * ((each[:, 0] - each[:, 0].mean()) ** 2).sum()))
