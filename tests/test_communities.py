"""Communities against the best of all partitions of small graphs, and planted ones."""

import numpy as np
import pytest

from omicspark.operators import joint as jt
from omicspark.operators import neighbors as nb


def partitions(n):
    """All partitions of 0..n-1 as lists of labels."""
    if not n:
        yield []
        return
    for p in partitions(n - 1):
        for c in range(max(p, default=-1) + 2):
            yield [*p, c]


def quality(a, labels, resolution=1.0):
    labels, total = np.array(labels), a.sum()
    same = labels[:, None] == labels[None, :]
    d = a.sum(1)
    return float((a[same].sum() - resolution * np.outer(d, d)[same].sum() / total) / total)


def edges_of(a):
    i, j = np.nonzero(a)
    return [(int(x), int(y), float(a[x, y])) for x, y in zip(i, j, strict=True)]


def solved(a, resolution=1.0):
    e = edges_of(a)
    return nb.multilevel(*(np.array(x) for x in zip(*e, strict=True)), np.arange(len(a)), resolution)


def test_small_graphs_come_within_a_hundredth_of_the_best_partition():
    rng = np.random.default_rng(1)
    every = list(partitions(8))
    short = []
    for _ in range(25):
        a = np.triu(rng.random((8, 8)) < 0.45, 1) * rng.uniform(0.5, 2, (8, 8))
        a = a + a.T
        if (a.sum(1) == 0).any():
            continue
        for resolution in (0.5, 1.0, 2.0):
            best = max(quality(a, p, resolution) for p in every)
            short.append(best - quality(a, solved(a, resolution), resolution))
    assert max(short) <= 0.01 and np.mean(np.array(short) < 1e-9) > 0.9


def cliques(n, size, bridge=1.0):
    a = np.kron(np.eye(n), np.ones((size, size)) - np.eye(size))
    for i in range(n):
        u, v = i * size, (i + 1) % n * size + 1
        a[u, v] = a[v, u] = bridge
    return a


def test_a_ring_of_cliques_is_taken_apart_and_put_together():
    assert len(set(solved(cliques(8, 5)))) == 8
    # with many small cliques whole neighbouring ones belong together: single moves alone never merge them
    a = cliques(30, 3)
    labels = solved(a)
    assert len(set(labels)) < 30 and quality(a, labels) > quality(a, np.arange(90) // 3)


def test_levels_on_spark_do_as_well_as_one_task(spark):
    rng = np.random.default_rng(4)
    group = np.arange(48) // 12
    a = np.triu(rng.random((48, 48)) < np.where(group[:, None] == group[None, :], 0.7, 0.05), 1).astype(float)
    a = a + a.T
    df = spark.createDataFrame([(10 * s, 10 * d, w) for s, d, w in edges_of(a)], "src long, dst long, weight double")
    for found in (nb.communities(df), nb.communities(df, local_edges=0)):
        labels = {r.node: r.community for r in found.collect()}
        assert [labels[10 * i] for i in range(48)] == [120 * int(g) for g in group]  # named by the least node
        assert nb.modularity(df, found) == pytest.approx(quality(a, group), abs=1e-9)


def test_contracted_levels_keep_weights_and_names(spark):
    a = cliques(12, 3)
    df = spark.createDataFrame(edges_of(a), "src long, dst long, weight double")
    found = nb.communities(df, local_edges=0)
    labels = {r.node: r.community for r in found.collect()}
    assert len(labels) == 36 and all(labels[c] == c for c in labels.values())
    assert nb.modularity(df, found) >= quality(a, solved(a)) - 0.01


def test_communities_of_a_neighbour_graph_and_the_sweep(spark):
    rng = np.random.default_rng(9)
    at = np.repeat(np.eye(3) * 20, 15, axis=0) + rng.normal(size=(45, 3))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(at)], "id long, vector array<double>")
    edges = jt.own_first(nb.neighbour_graph(df, 8), 9)
    labels = {r.node: r.community for r in jt.graph_communities(edges, 9, 2).collect()}
    assert {frozenset(i for i in labels if labels[i] == c) for c in set(labels.values())} == {frozenset(range(15 * g, 15 * g + 15)) for g in range(3)}
    assert jt.graph_communities(edges, 9, 16).collect() == []
    sizes = jt.resolution_sweep(edges, 9, 1.0, (0.5, 1.0, 6.0)).collect()
    n = [sum(r.multiplier == m for r in sizes) for m in (0.5, 1.0, 6.0)]
    assert n[0] <= n[1] == 3 < n[2]
    assert all(sum(r.n for r in sizes if r.multiplier == m) == 45 for m in (0.5, 1.0, 6.0))
    assert all(a.n >= b.n for a in sizes for b in sizes if a.multiplier == b.multiplier and a["rank"] < b["rank"])
