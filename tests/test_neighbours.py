"""The neighbour graph against the exact search, hubs, and weights of hashed subsets."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from omicspark.operators import joint as jt
from omicspark.operators import neighbors as nb

DATA = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def vectors(spark):
    e = spark.read.parquet(f"{DATA}/embeddings.parquet")
    return e.select(F.col("vec_id").cast("bigint").alias("id"), F.col("embedding").cast("array<double>").alias("vector"))


def exact_others(vectors, k):
    found = nb.nearest(vectors.filter("id % 50 = 0"), vectors, k + 1).filter("src <> dst")
    return found.withColumn("rank", F.row_number().over(Window.partitionBy("src").orderBy("rank"))).filter(F.col("rank") <= k)


def test_recall_over_the_whole_table(vectors):
    k = 12
    exact = exact_others(vectors, k).cache()
    found = nb.neighbour_graph(vectors, k, leaf=128)
    assert found.groupBy("src").count().filter(F.col("count") != k).isEmpty() and found.filter("src = dst").isEmpty()
    share = nb.recall(found, exact)
    print(f"recall of neighbour_graph, {vectors.count()} vectors of 64 dimensions, k {k}, stretches of 128: {share:.3f}")
    assert share >= 0.9
    both = found.join(exact.select("src", "dst", F.col("dist").alias("true")), ["src", "dst"])
    assert both.agg(F.max(F.abs(F.col("dist") - F.col("true")))).first()[0] < 1e-9


def test_one_stretch_is_exact_and_copies_are_told_apart_by_id(spark):
    rng = np.random.default_rng(2)
    points = [rng.normal(size=5).tolist() for _ in range(120)] + [[1.0] * 5] * 60  # a third are copies
    df = spark.createDataFrame(list(enumerate(points)), "id long, vector array<double>")
    got = {}
    for r in nb.neighbour_graph(df, 6).collect():
        got.setdefault(r.src, []).append((r["rank"], r.dst))
    p = np.array(points)
    d = np.round(np.sqrt(((p[:, None] - p[None]) ** 2).sum(2)), 9)
    for i in range(len(p)):
        assert [j for _, j in sorted(got[i])] == [j for j in np.lexsort((np.arange(len(p)), d[i])) if j != i][:6]
    small = nb.neighbour_graph(df, 6, leaf=16).collect()  # many stretches of copies alone: still k each
    assert Counter(Counter(r.src for r in small).values()) == {6: 180}
    assert nb.neighbour_graph(df.limit(1), 6).collect() == [] and nb.neighbour_graph(df.limit(0), 6).collect() == []


def test_shared_counts_of_a_hub_in_parts(spark):
    lists = [(i, 0) for i in range(40)] + [(i, 1 + i % 3) for i in range(40)] + [(5, 50)]
    df = spark.createDataFrame(lists, "src long, dst long")
    own = {}
    for s, d in lists:
        own.setdefault(s, set()).add(d)
    want = {(a, b): len(own[a] & own[b]) for a in own for b in own if own[a] & own[b]}
    for hub in (500, 7):
        assert {(r.src, r.other): r.n for r in nb.shared_counts(df, hub).collect()} == want


def test_subset_weights_are_averages_over_partitions(vectors):
    some = vectors.filter("id < 120")
    a, b = (some.select("id", F.slice("vector", lo, 8).alias("vector")) for lo in (1, 9))
    k = 4

    def plain(x):
        return {r.src: r.w1 for r in x.collect()}

    def modality(v):
        pairs = v.select(F.col("id").alias("src"), F.col("vector").alias("v")).crossJoin(v.select(F.col("id").alias("dst"), F.col("vector").alias("o")))
        edges = jt.own_first(pairs.select("src", "dst", jt.distance(F.col("v"), F.col("o")).alias("dist")), k + 1)
        return edges, v, jt.kernel_widths(edges, v, k)

    whole = plain(jt.subset_weights(a, b, k, subset_rows=1000))
    assert whole == pytest.approx(plain(jt.modality_weights(modality(a), modality(b), k)), abs=1e-9)
    one, two, both = (plain(jt.subset_weights(a, b, k, 40, n, seed)) for n, seed in ((1, 5), (1, 6), (2, 5)))
    assert both == pytest.approx({i: (one[i] + two[i]) / 2 for i in one}, abs=1e-9) and one != two
