"""Vectors and graphs on embeddings, and models on line items."""

from pyspark.sql import functions as F

from ..functions import vectors as vc
from ..operators import models as md
from ..operators import neighbors as nb
from .base import query, r6

_ID = "vec_id"
_VEC = "embedding"


def vectors(t):
    e = t("embeddings")
    return e.select(F.col(e.columns[0]).cast("bigint").alias("id"), F.col(_VEC).cast("array<double>").alias("vector"))


def edges(t, k=10):
    """The k nearest rows, by blocks, of every row whose id is divisible by 50."""
    v = vectors(t)
    return nb.nearest(v.filter("id % 50 = 0"), v, k)


@query("vector_norms", f"SELECT CAST({_ID} AS BIGINT) AS id, round(sqrt(list_sum([CAST(x AS DOUBLE) * x FOR x IN embedding])), 6) AS norm FROM embeddings")
def vector_norms(t):
    return vectors(t).select("id", F.round(vc.norm(F.col("vector")), 6).alias("norm"))


@query("vector_units", f"WITH e AS (SELECT CAST({_ID} AS BIGINT) AS id, [CAST(x AS DOUBLE) FOR x IN embedding] AS v FROM embeddings), n AS (SELECT id, v, sqrt(list_sum([x * x FOR x IN v])) AS n FROM e) SELECT id, round(v[1] / n, 6) AS u1, round(v[2] / n, 6) AS u2, round(v[3] / n, 6) AS u3 FROM n")
def vector_units(t):
    return vc.to_columns(vectors(t).select("id", vc.chosen(vc.unit(F.col("vector")), (1, 2, 3)).alias("u")), "u", 3, "u").withColumns(r6("u1", "u2", "u3"))


@query("vector_deviations", f"WITH l AS (SELECT unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings) SELECT CAST(i AS INTEGER) AS dim, round(stddev_samp(CAST(x AS DOUBLE)), 6) AS sd FROM l GROUP BY 1")
def vector_deviations(t):
    return vectors(t).select(F.posexplode("vector").alias("i", "x")).groupBy((F.col("i") + 1).alias("dim")).agg(F.round(F.stddev_samp("x"), 6).alias("sd"))


@query("graph_nearest", f"WITH e AS (SELECT CAST({_ID} AS BIGINT) AS id, [CAST(x AS DOUBLE) FOR x IN embedding] AS v FROM embeddings), d AS (SELECT q.id AS src, r.id AS dst, round(list_distance(q.v, r.v), 6) AS dist, row_number() OVER (PARTITION BY q.id ORDER BY round(list_distance(q.v, r.v), 9), r.id) AS rank FROM e q CROSS JOIN e r WHERE q.id % 50 = 0) SELECT * FROM d WHERE rank <= 10")
def graph_nearest(t):
    return edges(t).withColumns(r6("dist"))


_EDGES = f"(SELECT * FROM (SELECT q.id AS src, r.id AS dst, list_distance(q.v, r.v) AS dist, row_number() OVER (PARTITION BY q.id ORDER BY round(list_distance(q.v, r.v), 9), r.id) AS rank FROM (SELECT CAST({_ID} AS BIGINT) AS id, [CAST(x AS DOUBLE) FOR x IN embedding] AS v FROM embeddings) q CROSS JOIN (SELECT CAST({_ID} AS BIGINT) AS id, [CAST(x AS DOUBLE) FOR x IN embedding] AS v FROM embeddings) r WHERE q.id % 50 = 0) WHERE rank <= 10)"


@query("graph_neighbour_means", f"SELECT src, list(x ORDER BY i) AS vector FROM (SELECT src, i, round(avg(x), 6) AS x FROM (SELECT src, unnest([CAST(x AS DOUBLE) FOR x IN embedding]) AS x, generate_subscripts(embedding, 1) AS i FROM {_EDGES} JOIN embeddings ON {_ID} = dst) GROUP BY 1, 2) GROUP BY 1")
def graph_neighbour_means(t):
    return vc.mean_of_neighbours(edges(t), vectors(t), "src", "dst", "id", "vector").withColumn("vector", F.transform("vector", lambda x: F.round(x, 6)))


@query("graph_shared_neighbours", f"SELECT a.src, b.src AS dst, round(count(*) / (20 - count(*)), 6) AS weight FROM {_EDGES} a JOIN {_EDGES} b ON a.dst = b.dst AND a.src <> b.src GROUP BY 1, 2 HAVING count(*) / (20 - count(*)) >= 1 / 15")
def graph_shared_neighbours(t):
    return nb.shared_neighbours(edges(t), 10).withColumns(r6("weight"))


def order_graph(t):
    """Parts and suppliers as nodes, tied by line items; bounded weights."""
    pairs = t("lineitem").select(F.col("l_suppkey").alias("src"), (1_000_000_000 + F.col("l_partkey")).alias("dst"))
    return nb.symmetric(pairs)


@query("graph_transitions", "WITH p AS (SELECT l_suppkey AS a, 1000000000 + l_partkey AS b FROM lineitem), e AS (SELECT a AS src, b AS dst FROM p UNION SELECT b, a FROM p) SELECT src, dst, round(1 / count(*) OVER (PARTITION BY src), 6) AS weight FROM e")
def graph_transitions(t):
    return nb.transitions(order_graph(t)).withColumns(r6("weight"))


@query("graph_random_walk")
def graph_random_walk(t):
    seeds = t("supplier").filter("s_suppkey % 10 = 0").select(F.col("s_suppkey").alias("node"))
    return nb.random_walk(order_graph(t), seeds, restart=0.3)


@query("graph_communities")
def graph_communities(t):
    return nb.communities(order_graph(t))


@query("graph_jump_hash")
def graph_jump_hash(t):
    return t("customer").select("c_custkey", vc.jump_hash(16)(F.xxhash64("c_custkey")).alias("bucket"))


@query("model_regressions", "SELECT l_suppkey, count(*) AS n, round(regr_slope(l_extendedprice, l_quantity), 6) AS slope, round((regr_syy(l_extendedprice, l_quantity) - regr_slope(l_extendedprice, l_quantity) * regr_sxy(l_extendedprice, l_quantity)) / (count(*) - 2), 2) AS s2, count(*) - 2 AS df FROM lineitem GROUP BY 1")
def model_regressions(t):
    fits = md.simple_regression(t("lineitem"), ["l_suppkey"], "l_extendedprice", "l_quantity")
    return fits.select("l_suppkey", "n", F.round("slope", 6).alias("slope"), F.round("s2", 2).alias("s2"), "df")


@query("model_moderated")
def model_moderated(t):
    return md.moderate(md.simple_regression(t("lineitem"), ["l_suppkey"], "l_extendedprice", "l_quantity"))


@query("model_user_design")
def model_user_design(t):
    import numpy as np

    return md.fit_features(t("lineitem").select("l_suppkey", "l_extendedprice", "l_quantity", "l_discount"), "l_suppkey", "l_extendedprice", lambda x: np.column_stack([np.ones(len(x)), x["l_quantity"], x["l_discount"]]), [0, 1, 0])


@query("model_set_test", """WITH s AS (SELECT l_partkey AS feature, avg(l_extendedprice) / 1000 AS t FROM lineitem GROUP BY 1), w AS (SELECT count(*) AS m, sum(t) AS s, sum(t * t) AS ss FROM s), o AS (SELECT p_brand AS "set", count(*) AS n, sum(t) AS s1 FROM s JOIN part ON p_partkey = feature GROUP BY 1)
SELECT "set", n, round(s1 / n - (s - s1) / (m - n), 6) AS difference, round((s1 / n - (s - s1) / (m - n)) / sqrt((ss - s * s / m) / (m - 1) * ((1 + (n - 1) * 0.01) / n + 1 / (m - n))), 6) AS t FROM o, w WHERE n > 1""")
def model_set_test(t):
    stats = t("lineitem").groupBy(F.col("l_partkey").alias("feature")).agg((F.avg("l_extendedprice") / 1000).alias("t"))
    return md.set_test(stats, t("part").select(F.col("p_partkey").alias("feature"), F.col("p_brand").alias("set"))).withColumns(r6("difference", "t"))


@query("model_block_products", "WITH b AS (SELECT ntile(20) OVER (ORDER BY o_orderkey) AS block, o_custkey / 1000.0 AS x, o_totalprice / 1e5 AS y FROM orders) SELECT CAST(block AS INTEGER) AS block, count(*) AS n, round(sum(x), 4) AS sx, round(sum(x * x), 4) AS sxx, round(sum(x * y), 4) AS sxy FROM b GROUP BY 1")
def model_block_products(t):
    rows = t("orders").select("o_orderkey", (F.col("o_custkey") / 1000.0).alias("x"), (F.col("o_totalprice") / 1e5).alias("y"))
    at = lambda i, j: F.max(F.when((F.col("i") == i) & (F.col("j") == j), F.col("value")))
    return md.block_crossproducts(rows, ["o_orderkey"], "y", ["x"], 20).groupBy("block").agg(at(0, 0).cast("bigint").alias("n"), F.round(at(0, 1), 4).alias("sx"), F.round(at(1, 1), 4).alias("sxx"), F.round(at(1, -1), 4).alias("sxy"))


@query("model_jackknife", """WITH b AS (SELECT block, count(*) AS n, sum(x) AS sx, sum(x * x) AS sxx, sum(y) AS sy, sum(x * y) AS sxy FROM (SELECT ntile(20) OVER (ORDER BY o_orderkey) AS block, o_custkey / 1000.0 AS x, o_totalprice / 1e5 AS y FROM orders) GROUP BY 1), t AS (SELECT sum(n) AS n, sum(sx) AS sx, sum(sxx) AS sxx, sum(sy) AS sy, sum(sxy) AS sxy FROM b),
d AS (SELECT t.n - b.n AS n, t.sx - b.sx AS sx, t.sxx - b.sxx AS sxx, t.sy - b.sy AS sy, t.sxy - b.sxy AS sxy FROM b, t), e AS (SELECT (n * sxy - sx * sy) / (n * sxx - sx * sx) AS s, (sy * sxx - sx * sxy) / (n * sxx - sx * sx) AS i FROM d), w AS (SELECT (n * sxy - sx * sy) / (n * sxx - sx * sx) AS s, (sy * sxx - sx * sxy) / (n * sxx - sx * sx) AS i FROM t)
SELECT CAST(0 AS INTEGER) AS term, round(any_value(w.i), 6) AS estimate, round(sqrt(19.0 * var_pop(e.i)), 6) AS se FROM e, w UNION ALL SELECT 1, round(any_value(w.s), 6), round(sqrt(19.0 * var_pop(e.s)), 6) FROM e, w""")
def model_jackknife(t):
    rows = t("orders").select("o_orderkey", (F.col("o_custkey") / 1000.0).alias("x"), (F.col("o_totalprice") / 1e5).alias("y"))
    return md.jackknife(md.block_crossproducts(rows, ["o_orderkey"], "y", ["x"], 20), 2).withColumns(r6("estimate", "se"))
