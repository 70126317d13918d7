"""Nearest neighbours and graphs as edge tables (src, dst, weight)."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .loops import cut

#: Rows of a block of vectors, about.
BLOCK_ROWS = 2_000
#: Of neighbour_graph: rows that are compared with each other at least, sorted orders, rows that its splits are fitted on at most.
LEAF_ROWS, TREES, SPLIT_SAMPLE = 512, 4, 4_096


def _blocks(df: DataFrame, name: str) -> DataFrame:
    """One row a block of about BLOCK_ROWS vectors, dealt by a hash of the id."""
    n = max(1, -(-df.count() // BLOCK_ROWS))
    return df.groupBy(F.pmod(F.xxhash64("id"), F.lit(n)).alias(f"{name}_block")).agg(F.collect_list("id").alias(f"{name}_ids"), F.flatten(F.collect_list("vector")).alias(f"{name}_flat"))


def nearest(queries: DataFrame, rows: DataFrame, k: int, metric: str = "euclidean") -> DataFrame:
    """(src, dst, rank, dist): the k nearest rows of each query, itself included if it is among the rows; ties by id.

    Both sides have id and vector. Every block of queries meets every block of rows, as matrices; only k candidates a query
    leave each meeting.
    """
    pairs = _blocks(queries, "q").join(_blocks(rows, "r"))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                q, r = (np.array(row[f"{s}_flat"], np.float64).reshape(len(row[f"{s}_ids"]), -1) for s in "qr")
                if metric == "cosine":
                    q, r = (x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300) for x in (q, r))
                ids = np.array(row["r_ids"])
                d = np.sqrt(np.maximum((q * q).sum(1)[:, None] + (r * r).sum(1)[None, :] - 2 * q @ r.T, 0))
                d[d < 1e-7] = 0
                m = min(k, len(ids))
                top = np.lexsort((np.broadcast_to(ids, d.shape), np.round(d, 9)), axis=1)[:, :m]
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(row["q_ids"], m)), pa.array(ids[top].ravel()), pa.array(np.take_along_axis(d, top, 1).ravel())], names=["src", "dst", "dist"])

    best = Window.partitionBy("src").orderBy(F.round("dist", 9), "dst")
    return pairs.mapInArrow(meet, "src bigint, dst bigint, dist double").withColumn("rank", F.row_number().over(best).cast("bigint")).filter(F.col("rank") <= k)


def _top(edges: DataFrame, k: int) -> DataFrame:
    """The k nearest of each source, each once; candidates beyond k leave before the shuffle."""
    best = Window.partitionBy("src").orderBy(F.round("dist", 9), "dst")
    return edges.withColumn("rank", F.dense_rank().over(best).cast("bigint")).filter(F.col("rank") <= k).dropDuplicates(["src", "dst"])


def _pairs(ids: np.ndarray, v: np.ndarray, k: int) -> pa.RecordBatch:
    """The k nearest others of each row of a block; distances of those are taken from the differences."""
    sq = (v * v).sum(1)
    d = np.maximum(sq[:, None] + sq[None, :] - 2 * v @ v.T, 0)
    np.fill_diagonal(d, np.inf)
    m = min(k, len(ids) - 1)
    some = min(m + 8, len(ids) - 1)  # a few more, for their order is settled on exact distances
    near = np.argpartition(d, some - 1, axis=1)[:, :some]
    last = np.take_along_axis(d, near, 1).max(1)
    tied = (d <= (last + 1e-9 * (1 + sq))[:, None]).sum(1) > some  # more than these are as near: ids decide
    if tied.any():
        near[tied] = np.lexsort((np.broadcast_to(ids, d[tied].shape), np.round(d[tied], 9)), axis=1)[:, :some]
    exact = np.sqrt(((v[:, None, :] - v[near]) ** 2).sum(2))
    order = np.lexsort((ids[near], np.round(exact, 9)), axis=1)[:, :m]
    top, dist = np.take_along_axis(near, order, 1), np.take_along_axis(exact, order, 1)
    return pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, m)), pa.array(ids[top].ravel()), pa.array(dist.ravel())], names=["src", "dst", "dist"])


def _in_sorted_blocks(rows: DataFrame, n: int, k: int, leaf: int, trees: int, seed: int) -> DataFrame:
    """Candidates (src, dst, dist): rows are put in several orders by random hyperplanes (each near the median of a sample), and meet the rows
    of their stretch of each order. Stretches hold leaf to 2 leaf rows, whatever the data: equal vectors are told apart by id."""
    sample = np.array([r[0] for r in rows.select("vector", F.xxhash64("id", F.lit(seed)).alias("h")).orderBy("h").limit(SPLIT_SAMPLE).collect()], np.float64)
    rng, bits = np.random.default_rng(seed), max(1, min(40, int(np.ceil(np.log2(max(2, n / leaf)))) + 2))
    planes = rng.normal(size=(trees, bits + 1, sample.shape[1]))
    middle = np.median(np.einsum("tbd,nd->tbn", planes, sample), axis=2)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)
            for t in range(trees):
                side = v @ planes[t].T - middle[t]
                code = (side[:, :bits] > 0) @ (1 << np.arange(bits - 1, -1, -1, dtype=np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(v), t, np.int32)), pa.array(code), pa.array(side[:, bits]), batch.column(0), batch.column(1)], names=["tree", "code", "side", "id", "vector"])

    placed = rows.select("id", "vector").mapInArrow(place, "tree int, code bigint, side double, id bigint, vector array<double>")
    order = ["tree", "code", "side", "id"]
    dealt = placed.repartitionByRange(max(1, n * trees // (16 * leaf)), *order).sortWithinPartitions(*order)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors, tree = np.zeros(0, np.int64), None, None

        def stretch(n_rows: int) -> pa.RecordBatch:
            nonlocal ids, vectors
            out = _pairs(ids[:n_rows], vectors[:n_rows], k)
            ids, vectors = ids[n_rows:], vectors[n_rows:]
            return out

        for batch in batches:
            trees_ = batch.column(0).to_numpy()
            v = batch.column(4).flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)
            own = batch.column(3).to_numpy()
            for t in np.unique(trees_):
                if t != tree and len(ids) > 1:
                    yield stretch(len(ids))
                here = trees_ == t
                ids = np.concatenate([ids, own[here]]) if t == tree else own[here]
                vectors = np.concatenate([vectors, v[here]]) if t == tree else v[here]
                tree = t
                while len(ids) >= 2 * leaf:
                    yield stretch(leaf)
        if len(ids) > 1:
            yield stretch(len(ids))

    return dealt.mapInArrow(meet, "src bigint, dst bigint, dist double")


def _among_neighbours(rows: DataFrame, graph: DataFrame, k: int) -> DataFrame:
    """Candidates (src, dst, dist) nearer than the k-th of src: a node's k neighbours, the k nearest of those that have it as a neighbour,
    and the node itself meet in one row of at most 2 k + 1 vectors."""
    back = graph.select(F.col("dst").alias("v"), F.col("src").alias("id"), F.row_number().over(Window.partitionBy("dst").orderBy("dist", "src")).alias("r")).filter(F.col("r") <= k).drop("r")
    own = rows.select(F.col("id").alias("v"), "id")
    members = graph.select(F.col("src").alias("v"), F.col("dst").alias("id")).unionByName(back).unionByName(own).distinct()
    bound = graph.groupBy(F.col("src").alias("id")).agg(F.when(F.count(F.lit(1)) >= k, F.max("dist")).otherwise(float("inf")).alias("kth"))
    nodes = rows.select("id", "vector").join(bound, "id", "left").withColumn("kth", F.coalesce("kth", F.lit(float("inf"))))
    gathered = members.join(nodes, "id").groupBy("v").agg(F.collect_list(F.struct("id", "kth")).alias("nodes"), F.flatten(F.collect_list("vector")).alias("flat"))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, flat = batch.column(0), batch.column(1)
            inner = nodes.flatten()
            ids, kth = inner.field("id").to_numpy(), inner.field("kth").to_numpy()
            ends, size = np.cumsum(nodes.value_lengths().to_numpy()), len(flat.flatten()) // max(1, len(ids))
            values = flat.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            found = []
            for lo, hi in zip(np.concatenate([[0], ends[:-1]]), ends, strict=True):
                v = values[lo:hi]
                d = np.sqrt(((v[:, None, :] - v[None, :, :]) ** 2).sum(2))
                np.fill_diagonal(d, np.inf)
                a, b = np.nonzero(d < kth[lo:hi, None])
                found.append((ids[lo + a], ids[lo + b], d[a, b]))
            src, dst, dist = (np.concatenate(x) for x in zip(*found, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(src), pa.array(dst), pa.array(dist)], names=["src", "dst", "dist"])

    return gathered.select("nodes", "flat").mapInArrow(meet, "src bigint, dst bigint, dist double")


def neighbour_graph(rows: DataFrame, k: int, leaf: int = LEAF_ROWS, trees: int = TREES, wide: int | None = None, tolerance: float = 3e-4, rounds: int = 30, seed: int = 1) -> DataFrame:
    """(src, dst, rank, dist): about the k nearest other rows of every row (id, vector), ties by id.

    Rows first meet those near them in several sorted orders of random hyperplanes; then neighbours of neighbours meet, round by
    round, until a round brings the sum of distances down by less than `tolerance` of it (raises if so many rounds don't). On the way
    a row has `wide` neighbours (three times k, 40 at least). Up to `leaf` rows are compared all with all, so the result is exact; beyond that it
    isn't: tests/test_neighbours.py holds its recall above 0.9. A round moves at most 2 wide + 1 vectors a row. The splits are fitted on a sample of SPLIT_SAMPLE rows; every row is searched.
    """
    rows = cut(rows.select("id", "vector"))
    n = rows.count()
    if n < 2:
        return rows.select(F.col("id").alias("src"), F.col("id").alias("dst"), F.lit(0.0).alias("dist"), F.lit(1).cast("bigint").alias("rank")).limit(0)
    if n <= leaf:
        return cut(_top(_in_sorted_blocks(rows, n, k, leaf, 1, seed), k))
    wide = wide or max(3 * k, 40)
    graph = cut(_top(_in_sorted_blocks(rows, n, wide, leaf, trees, seed), wide))
    total = graph.agg(F.sum("dist")).first()[0]
    for _ in range(rounds):
        graph = cut(_top(graph.select("src", "dst", "dist").unionByName(_among_neighbours(rows, graph, wide)), wide))
        now = graph.agg(F.sum("dist")).first()[0]
        if total - now <= tolerance * total:
            return graph.filter(F.col("rank") <= k)
        total = now
    raise RuntimeError(f"neighbour_graph: distances still fall after {rounds} rounds")


def recall(found: DataFrame, exact: DataFrame) -> float:
    """Share of the exact edges (src, dst) that were found; sources that were not searched exactly are left out."""
    hit = exact.select("src", "dst").join(found.select("src", "dst").distinct(), ["src", "dst"], "left_semi").count()
    return hit / max(1, exact.count())


#: Lists that hold a node, above which they meet in pairs of parts.
HUB = 500


def shared_counts(lists: DataFrame, hub: int = HUB) -> DataFrame:
    """(src, other, n): how many neighbours two sources share, for every two that share one, a source with itself included.

    Lists (src, dst) meet on the neighbour. Those of a neighbour in more than `hub` lists are dealt into parts, and every two parts
    meet by themselves, so no task gets all pairs of a hub; counts are added up before and after the shuffle.
    """
    degree = lists.groupBy("dst").agg(F.ceil(F.count(F.lit(1)) / hub).cast("int").alias("parts"))
    dealt = lists.join(degree, "dst").withColumn("own", F.pmod(F.xxhash64("src"), F.col("parts")).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    a = dealt.select("src", "dst", F.col("own").alias("x"), every.alias("y"))
    b = dealt.select(F.col("src").alias("other"), "dst", F.col("own").alias("y"), every.alias("x"))
    return a.join(b, ["dst", "x", "y"]).groupBy("src", "other").agg(F.count(F.lit(1)).alias("n"))


def shared_neighbours(edges: DataFrame, k: int, least: float = 1 / 15) -> DataFrame:
    """(src, dst, weight): Jaccard of the neighbour lists of every two sources that share one; weights under `least` are pruned."""
    n = shared_counts(edges.select("src", "dst")).filter("src <> other").withColumnRenamed("other", "dst")
    return n.select("src", "dst", (F.col("n") / (2 * k - F.col("n"))).alias("weight")).filter(F.col("weight") >= least)


def symmetric(edges: DataFrame) -> DataFrame:
    """Both directions of each edge, once, with weight 1, without loops."""
    both = edges.select("src", "dst").unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    return both.filter("src <> dst").distinct().withColumn("weight", F.lit(1.0))


def transitions(edges: DataFrame) -> DataFrame:
    """Weights over the sum of their source's."""
    return edges.withColumn("weight", F.col("weight") / F.sum("weight").over(Window.partitionBy("src")))


def random_walk(edges: DataFrame, seeds: DataFrame, restart: float = 0.05, tolerance: float = 1e-5, rounds: int = 10_000) -> DataFrame:
    """(node, score): stationary scores of a walk that restarts at the seeds; one shuffle of the edges by source a round.

    Ends when the scores change by less than the tolerance; raises if they don't in so many rounds."""
    step = cut(transitions(edges))
    nodes = edges.select(F.col("src").alias("node")).distinct()
    n = seeds.count()
    start = cut(nodes.join(seeds.withColumn("_s", F.lit(1.0 / max(n, 1))), "node", "left").select("node", F.coalesce("_s", F.lit(0.0)).alias("score")))
    now = start
    for _ in range(rounds):
        moved = step.join(now, step["src"] == now["node"]).groupBy(F.col("dst").alias("node")).agg(F.sum(F.col("weight") * F.col("score")).alias("m"))
        new = cut(start.withColumnRenamed("score", "s").join(moved, "node", "left").select("node", (restart * F.col("s") + (1 - restart) * F.coalesce("m", F.lit(0.0))).alias("score")))
        change = new.join(now.withColumnRenamed("score", "o"), "node").agg(F.sum(F.abs(F.col("score") - F.col("o")))).first()[0]
        now = new
        if change is None or change < tolerance:
            return now
    raise RuntimeError(f"random_walk: still changing by {change} after {rounds} rounds")


#: Edges (both directions) of a contracted graph that one task takes to the end.
LOCAL_EDGES = 1 << 18
#: Orders of the nodes that are tried there.
STARTS = 6


def modularity(edges: DataFrame, found: DataFrame, resolution: float = 1.0) -> float:
    """Of communities (node, community) of a symmetric graph: their share of weight, less what degrees alone would give."""
    c = found.select(F.col("node").alias("src"), F.col("community").alias("a"))
    rows = edges.join(c, "src").join(c.toDF("dst", "b"), "dst")
    per = rows.groupBy(F.col("a").alias("c")).agg(F.sum("weight").alias("k"), F.sum(F.when(F.col("a") == F.col("b"), F.col("weight")).otherwise(0.0)).alias("w"))
    total, inside, squares = per.agg(F.sum("k"), F.sum("w"), F.sum(F.col("k") * F.col("k"))).first()
    return inside / total - resolution * squares / total**2 if total else 0.0


def communities(edges: DataFrame, rounds: int = 1_000, resolution: float = 1.0, patience: int = 5, local_edges: int = LOCAL_EDGES) -> DataFrame:
    """(node, community) by modularity, level by level: nodes move between communities, each community is refined into parts that grew
    together from single nodes, and the parts become the nodes of the next level, which start in their community. Symmetric edges
    (src, dst, weight) are expected; a community is named by its least node.

    While a level has more than `local_edges` edges, its nodes move at once (see `_moved`); what is left then is of bounded size, and
    one task takes it to the end, node after node. Ends when no part merges; raises if moves don't end in so many rounds.
    """
    graph = cut(edges.groupBy("src", "dst").agg(F.sum("weight").alias("weight")))
    names = cut(graph.select(F.col("src").alias("node")).distinct().withColumn("part", F.col("node")))
    now = None
    while True:
        size = graph.count()
        if size <= local_edges:
            found = _finished(graph, now, resolution)
            break
        degree = cut(graph.groupBy(F.col("src").alias("node")).agg(F.sum("weight").alias("d")))
        total = degree.agg(F.sum("d")).first()[0] or 1.0
        moved = cut(_moved(graph, degree, total, now, rounds, resolution, patience))
        side = lambda end, out: moved.select(F.col("node").alias(end), F.col("community").alias(out))
        inner = cut(graph.join(side("src", "a"), "src").join(side("dst", "b"), "dst").filter("a = b").select("src", "dst", "weight"))
        parts = cut(_moved(inner, degree, total, None, rounds, resolution, patience).withColumnRenamed("community", "to"))
        merged = graph.join(parts.withColumnRenamed("node", "src").withColumnRenamed("to", "a"), "src").join(parts.withColumnRenamed("node", "dst").withColumnRenamed("to", "b"), "dst")
        less = cut(merged.groupBy(F.col("a").alias("src"), F.col("b").alias("dst")).agg(F.sum("weight").alias("weight")))
        names = cut(names.join(parts, names["part"] == parts["node"]).select(names["node"], F.col("to").alias("part")))
        started = cut(parts.join(moved, "node").groupBy(F.col("to").alias("node")).agg(F.first("community").alias("community")))
        if started.count() == degree.count():
            found = started
            break
        graph, now = less, started
    own = names.join(found.select(F.col("node").alias("part"), F.col("community").alias("c")), "part")
    least = own.groupBy("c").agg(F.min("node").alias("community"))
    return own.join(least, "c").select("node", "community")


def _moved(edges: DataFrame, degree: DataFrame, total: float, start: DataFrame | None, rounds: int, resolution: float, patience: int) -> DataFrame:
    """(node, community) by synchronous moves from a start (else: single nodes): a node joins the neighbouring community of greatest
    gain, ties to the least name; nodes take turns by a hash bit, so that two don't swap. Degrees may be those of a larger graph.

    Moves at once can undo each other, so the state of greatest modularity counts: it ends when no node would move, or when the
    modularity hasn't risen for `patience` turns; raises if neither is so in so many rounds."""
    loose = cut(edges.filter("src <> dst"))
    now = degree.withColumn("community", F.col("node")) if start is None else degree.join(start, "node")
    now = cut(now.select("node", "community", "d"))
    best, highest, still = now, None, 0
    for turn in range(rounds):
        size = now.groupBy("community").agg(F.sum("d").alias("k"))
        links = loose.join(now.select(F.col("node").alias("dst"), "community"), "dst").groupBy(F.col("src").alias("node"), "community").agg(F.sum("weight").alias("w"))
        own = F.col("community") == F.col("old")
        gain = F.col("w") - resolution * F.col("d") * (F.col("k") - F.when(own, F.col("d")).otherwise(0.0)) / total
        scored = links.join(size, "community").join(now.select("node", "d", F.col("community").alias("old")), "node").withColumn("gain", F.round(gain, 9))
        per = scored.groupBy("node").agg(F.max(F.struct("gain", (-F.col("community")).alias("c"))).alias("b"), F.max(F.when(own, F.col("gain"))).alias("stay"), F.coalesce(F.sum(F.when(own, F.col("w"))), F.lit(0.0)).alias("inside"))
        alone = -resolution * F.col("d") * (F.col("k") - F.col("d")) / total  # gain of staying where no neighbour is
        state = cut(now.join(size, "community").join(per, "node", "left").withColumn("wants", F.coalesce(F.col("b.gain") > F.coalesce("stay", F.round(alone, 9)), F.lit(False))).drop("k"))
        squares = state.groupBy("community").agg(F.sum("d").alias("k")).agg(F.sum(F.col("k") * F.col("k")).alias("kk"))
        inside, wanting, kk = state.agg(F.sum("inside").alias("i"), F.count_if("wants").alias("n")).join(squares).first()
        reached = (inside or 0.0) / total - resolution * (kk or 0.0) / total**2
        still = 0 if highest is None or reached > highest + 1e-7 else still + 1
        if not still:
            best, highest = state, reached
        if not wanting or still == patience:
            return best.select("node", "community")
        moves = F.col("wants") & (F.pmod(F.xxhash64("node", F.lit(turn)), F.lit(2)) == 0)
        now = state.select("node", F.when(moves, -F.col("b.c")).otherwise(F.col("community")).alias("community"), "d")
    raise RuntimeError(f"communities: nodes still move after {rounds} rounds")


def _finished(graph: DataFrame, start: DataFrame | None, resolution: float) -> DataFrame:
    """(node, community) of a graph of bounded size, in one task."""
    own = graph.select(F.col("src").alias("node")).distinct().withColumn("community", F.col("node")) if start is None else start
    rows = graph.join(own.select(F.col("node").alias("src"), "community"), "src").select("src", "dst", "weight", "community")

    def solve(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["src", "dst"])
        names, src = np.unique(part["src"].to_numpy(), return_inverse=True)
        first = np.searchsorted(src, np.arange(len(names)))
        group = np.unique(part["community"].to_numpy()[first], return_inverse=True)[1]
        found = multilevel(src, np.searchsorted(names, part["dst"].to_numpy()), part["weight"].to_numpy(float), group, resolution)
        return pd.DataFrame({"node": names, "community": names[first_of(found)][found]})

    def first_of(labels: np.ndarray) -> np.ndarray:
        return np.unique(labels, return_index=True)[1]

    return rows.groupBy(F.lit(1).alias("one")).applyInPandas(solve, "node bigint, community bigint")


def multilevel(src: np.ndarray, dst: np.ndarray, weight: np.ndarray, group: np.ndarray, resolution: float = 1.0, starts: int = STARTS, seed: int = 1) -> np.ndarray:
    """Community of each node 0..n-1, numbered from 0, of a symmetric graph, from a start; sequential, for what one task holds. The best of
    several orders of the nodes, each taken through all levels again and again until that no longer helps."""
    rng, best, highest = np.random.default_rng(seed), None, -np.inf
    total, degree = max(float(weight.sum()), 1e-300), np.bincount(src, weight, len(group))
    for turn in range(starts):
        found, reached = group, -np.inf
        while True:
            new = _through_levels(src, dst, weight, found, resolution, rng if turn else None)
            inside, sizes = weight[new[src] == new[dst]].sum(), np.bincount(new, degree)
            now = (inside - resolution * (sizes @ sizes) / total) / total
            if now <= reached + 1e-9:
                break
            found, reached = new, now
        if reached > highest + 1e-9:
            best, highest = found, reached
    return best


def _through_levels(src: np.ndarray, dst: np.ndarray, weight: np.ndarray, group: np.ndarray, resolution: float, rng: np.random.Generator | None) -> np.ndarray:
    owner, group = np.arange(len(group)), group.copy()
    while True:
        n = len(group)
        degree = np.bincount(src, weight, n)
        total = max(float(weight.sum()), 1e-300)
        order = np.argsort(src, kind="stable")
        loose = order[src[order] != dst[order]]
        ends = np.searchsorted(src[loose], np.arange(n + 1))
        to, w = dst[loose].tolist(), weight[loose].tolist()
        near = [list(zip(to[a:b], w[a:b], strict=True)) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
        turns = (rng.permutation(n) if rng else np.arange(n)).tolist()
        group = np.array(_greedy(near, degree.tolist(), total, group.tolist(), None, resolution, turns))
        part = np.array(_greedy(near, degree.tolist(), total, list(range(n)), group.tolist(), resolution, turns))
        _, first, part = np.unique(part, return_index=True, return_inverse=True)
        if len(first) == n:
            return np.unique(group, return_inverse=True)[1][owner]
        owner, group = part[owner], np.unique(group[first], return_inverse=True)[1]
        pairs, inverse = np.unique(part[src] * len(first) + part[dst], return_inverse=True)
        src, dst, weight = pairs // len(first), pairs % len(first), np.bincount(inverse, weight)


def _greedy(near: list[list[tuple[int, float]]], degree: list[float], total: float, group: list[int], within: list[int] | None, resolution: float, turns: list[int]) -> list[int]:
    """Moves each node to the community of greatest gain, and its neighbours again after it, until none gains. With `within`, nodes
    start alone, join neighbours in the same community only, and stay where others have joined them."""
    size: dict[int, float] = {}
    members: dict[int, int] = {}
    for v, c in enumerate(group):
        size[c] = size.get(c, 0.0) + degree[v]
        members[c] = members.get(c, 0) + 1
    spare = max(group, default=0) + 1
    waiting, there = deque(turns), [True] * len(group)
    while waiting:
        v = waiting.popleft()
        there[v] = False
        own = group[v]
        if within is not None and members[own] > 1:
            continue
        links: dict[int, float] = {}
        for u, w in near[v]:
            if within is None or within[u] == within[v]:
                links[group[u]] = links.get(group[u], 0.0) + w
        d = degree[v] * resolution / total
        best, gain = own, links.get(own, 0.0) - d * (size[own] - degree[v]) + 1e-12
        for c, w in links.items():
            if c != own and w - d * size[c] > gain:
                best, gain = c, w - d * size[c]
        if within is None and gain < -1e-12 and members[own] > 1:  # better alone than anywhere
            best, spare = spare, spare + 1
            size[best], members[best] = 0.0, 0
        if best != own:
            group[v] = best
            size[own] -= degree[v]
            size[best] += degree[v]
            members[own] -= 1
            members[best] += 1
            for u, _ in near[v] if within is None else ():
                if group[u] != best and not there[u]:
                    there[u] = True
                    waiting.append(u)
    return group


def drop_isolated(edges: DataFrame, kept: DataFrame) -> DataFrame:
    """Edges between kept nodes; nodes left without an edge in both roles go, again until none is left alone."""
    now = cut(edges.join(kept.select(F.col("node").alias("src")), "src", "left_semi").join(kept.select(F.col("node").alias("dst")), "dst", "left_semi"))
    n = now.count()
    while True:
        both = now.select(F.col("src").alias("node")).intersect(now.select(F.col("dst").alias("node")))
        now = cut(now.join(both.select(F.col("node").alias("src")), "src", "left_semi").join(both.select(F.col("node").alias("dst")), "dst", "left_semi"))
        m = now.count()
        if m == n:
            return now
        n = m
