"""Matrix operators on line items (part x supplier counts)."""

from pyspark.sql import functions as F

from ..functions import ranks
from ..operators import matrix as mx
from ..operators import studies as st
from .base import COUNTS, counts, query, r6


def groups(t):
    """(cell, group): suppliers by region of their nation."""
    return t("supplier").select(F.col("s_suppkey").alias("cell"), (F.col("s_nationkey") % 4).cast("bigint").alias("group"))


GROUPS = "(SELECT s_suppkey AS cell, CAST(s_nationkey % 4 AS BIGINT) AS \"group\" FROM supplier)"


def sets(t):
    return t("part").filter("p_size <= 3").select(F.col("p_type").alias("label"), F.col("p_partkey").alias("feature"))


@query("matrix_pseudobulk", "SELECT l_partkey AS feature, concat(replace(c_mktsegment, '_', '-'), '_', c_nationkey) AS sample, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS count FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2")
def matrix_pseudobulk(t):
    cells = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).select(F.col("o_orderkey").alias("cell"), F.concat(F.translate("c_mktsegment", "_", "-"), F.lit("_"), "c_nationkey").alias("sample"))
    rows = t("lineitem").select(F.col("l_orderkey").alias("cell"), F.col("l_partkey").alias("feature"), F.col("l_quantity").cast("bigint").alias("count"))
    return mx.group_sums(rows, cells, ["feature", "sample"])


@query("matrix_row_groups", f"SELECT p_brand AS \"group\", cell, CAST(sum(count) AS BIGINT) AS count FROM {COUNTS} JOIN part ON p_partkey = feature GROUP BY 1, 2")
def matrix_row_groups(t):
    return mx.group_sums(counts(t), t("part").select(F.col("p_partkey").alias("feature"), F.col("p_brand").alias("group")), ["group", "cell"], key="feature")


@query("matrix_depth", f"SELECT cell, CAST(sum(count) AS BIGINT) AS n_counts, count_if(count > 0) AS n_features, round(sum(count) / count_if(count > 0), 6) AS per_feature, round(log10(sum(count)), 6) AS log10_counts FROM {COUNTS} GROUP BY 1")
def matrix_depth(t):
    return mx.depth(counts(t), "cell").withColumns(r6("per_feature", "log10_counts"))


@query("matrix_group_sizes", "SELECT o_orderpriority, count(DISTINCT o_custkey) AS n FROM orders GROUP BY 1")
def matrix_group_sizes(t):
    return t("orders").groupBy("o_orderpriority").agg(F.countDistinct("o_custkey").alias("n"))


@query("matrix_sample_keys", "SELECT p_partkey, regexp_extract(concat(p_type, '_', replace(p_brand, '#', '_')), '^(.+)_([^_]+)$', 1) AS cluster, regexp_extract(concat(p_type, '_', replace(p_brand, '#', '_')), '^(.+)_([^_]+)$', 2) AS donor FROM part")
def matrix_sample_keys(t):
    cluster, donor = mx.split_sample_key(F.concat("p_type", F.lit("_"), F.translate("p_brand", "#", "_")))
    return t("part").select("p_partkey", cluster.alias("cluster"), donor.alias("donor"))


@query("matrix_cp10k", f"SELECT feature, cell, count, round(count * 1e4 / greatest(sum(count) OVER (PARTITION BY cell), 1), 6) AS norm FROM {COUNTS}")
def matrix_cp10k(t):
    return mx.per_ten_thousand(counts(t)).withColumns(r6("norm"))


@query("matrix_log_cpm", f"SELECT feature, cell, round(ln(1 + count * 1e6 / sum(count) OVER (PARTITION BY cell)), 6) AS value FROM {COUNTS}")
def matrix_log_cpm(t):
    rows = counts(t)
    totals = rows.groupBy("cell").agg(F.sum("count").alias("total"))
    return rows.join(totals, "cell").select("feature", "cell", F.round(mx.log_cpm(F.col("count"), F.col("total")), 6).alias("value"))


@query("matrix_specificity", f"""WITH g AS (SELECT feature, "group" AS cell, CAST(sum(count) AS BIGINT) AS count FROM {COUNTS} JOIN {GROUPS} USING (cell) GROUP BY 1, 2), o AS (SELECT *, CASE WHEN count >= 10 THEN count / sum(count) OVER (PARTITION BY cell) ELSE 0 END AS own FROM g), e AS (SELECT *, sum(own) OVER (PARTITION BY feature) AS total FROM o)
SELECT feature, cell, round(own / total, 6) AS share FROM e WHERE total > 0""")
def matrix_specificity(t):
    g = mx.group_sums(counts(t), groups(t), ["feature", "group"]).withColumnRenamed("group", "cell")
    return mx.specificity(g, 10).withColumns(r6("share"))


@query("matrix_tf_idf", f"""WITH c AS {COUNTS}, d AS (SELECT feature, count(DISTINCT cell) AS df FROM c GROUP BY 1) SELECT feature, cell, round(ln(1 + 1e4 * (count / sum(count) OVER (PARTITION BY cell)) * (SELECT count(DISTINCT cell) FROM c) / df), 6) AS value FROM c JOIN d USING (feature)""")
def matrix_tf_idf(t):
    return mx.tf_idf(counts(t)).withColumns(r6("value"))


_Z = "greatest(-sqrt(n), least(sqrt(n), (x - f * d / g) / sqrt(f * d / g + (f * d / g) * (f * d / g) / 100)))"


@query("matrix_residual_variance", f"""WITH c AS {COUNTS}, s AS (SELECT cell, sum(count) AS d FROM c GROUP BY 1), r AS (SELECT feature, sum(count) AS f FROM c GROUP BY 1), x AS (SELECT feature, cell, coalesce(count, 0) AS x, f, d, (SELECT sum(count) FROM c) AS g, (SELECT count(*) FROM s) AS n FROM r CROSS JOIN s LEFT JOIN c USING (feature, cell))
SELECT feature, round(var_samp({_Z}), 6) AS variance FROM x GROUP BY 1""")
def matrix_residual_variance(t):
    return mx.residual_variance(counts(t)).withColumns(r6("variance"))


@query("matrix_rank_sums", f"""WITH c AS (SELECT feature, cell, count * 1e4 / sum(count) OVER (PARTITION BY cell) AS v FROM {COUNTS}), x AS (SELECT f.feature, g.cell, g."group", coalesce(c.v, 0) AS v FROM (SELECT DISTINCT feature FROM c) f CROSS JOIN {GROUPS} g LEFT JOIN c ON c.feature = f.feature AND c.cell = g.cell),
k AS (SELECT *, rank() OVER (PARTITION BY feature ORDER BY v) + (count(*) OVER (PARTITION BY feature, v) - 1) / 2 AS r, count(*) OVER (PARTITION BY feature, v) AS ties FROM x),
e AS (SELECT feature, count(*) AS n, sum(CAST(ties AS DOUBLE) * ties - 1) AS t, sum(v) AS s_all FROM k GROUP BY 1), p AS (SELECT feature, "group", sum(r) AS r, count(*) AS n1, sum(v) AS s FROM k GROUP BY 1, 2)
SELECT feature, "group", round(r - n1 * (n1 + 1) / 2, 6) AS u, round((r - n1 * (n1 + 1) / 2 - n1 * (n - n1) / 2) / sqrt(n1 * (n - n1) / 12 * (n + 1 - t / (n * (n - 1)))), 6) AS z, round(s / n1 - (s_all - s) / (n - n1), 6) AS difference FROM p JOIN e USING (feature)""")
def matrix_rank_sums(t):
    return mx.rank_sum_test(mx.per_ten_thousand(counts(t)), groups(t)).withColumns(r6("u", "z", "difference"))


@query("matrix_markers")
def matrix_markers(t):
    return mx.marker_table(counts(t), groups(t))


@query("matrix_dot_summary", f"""WITH n AS (SELECT "group", count(*) AS n FROM {GROUPS} GROUP BY 1), s AS (SELECT feature, "group", sum(count) AS s, count(*) AS k FROM {COUNTS} JOIN {GROUPS} USING (cell) GROUP BY 1, 2)
SELECT p_partkey AS feature, "group", round(coalesce(s, 0) / n, 6) AS mean, round(100 * coalesce(k, 0) / n, 6) AS percent FROM (SELECT p_partkey FROM part WHERE p_size <= 3) CROSS JOIN n LEFT JOIN s ON s.feature = p_partkey AND s."group" = n."group" """.replace('SELECT p_partkey AS feature, "group"', 'SELECT p_partkey AS feature, n."group"'))
def matrix_dot_summary(t):
    return mx.dot_summary(counts(t), groups(t), sets(t).select("feature")).withColumns(r6("mean", "percent"))


@query("matrix_set_scores", f"""WITH c AS {COUNTS}, b AS (SELECT feature, ntile(24) OVER (ORDER BY sum(count), feature) AS bin FROM c GROUP BY feature), s AS (SELECT p_type AS label, p_partkey AS feature FROM part WHERE p_size <= 3), o AS (SELECT label, feature, bin FROM s JOIN b USING (feature)),
k AS (SELECT DISTINCT o.label, b.feature FROM o JOIN b USING (bin) WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.label = o.label AND s.feature = b.feature)), w AS (SELECT label, feature, 1 / count(*) OVER (PARTITION BY label) AS w FROM o UNION ALL SELECT label, feature, -1 / count(*) OVER (PARTITION BY label) FROM k)
SELECT cell, label, round(sum(count * w), 6) AS score FROM c JOIN w USING (feature) GROUP BY 1, 2""")
def matrix_set_scores(t):
    return mx.set_scores(counts(t), sets(t)).withColumns(r6("score"))


@query("matrix_background_bins", f"""WITH e AS (SELECT feature, sum(count) / (SELECT count(DISTINCT l_suppkey) FROM lineitem) AS expected FROM {COUNTS} GROUP BY 1), f AS (SELECT feature, round(expected, 6) AS expected, p_retailprice AS gc FROM e JOIN part ON p_partkey = feature)
SELECT *, CAST((ntile(5) OVER (ORDER BY expected, feature) - 1) * 5 + ntile(5) OVER (ORDER BY gc, feature) - 1 AS BIGINT) AS bin FROM f""")
def matrix_background_bins(t):
    rows = counts(t)
    n = rows.select("cell").distinct().count()
    e = mx.expectation(rows, F.lit(n)).withColumns(r6("expected")).join(t("part").select(F.col("p_partkey").alias("feature"), F.col("p_retailprice").alias("gc")), "feature")
    return mx.background_bins(e, "expected", "gc")


@query("matrix_deviations", f"""WITH c AS {COUNTS}, e AS (SELECT feature, sum(count) / 100.0 AS expected FROM c GROUP BY 1), w AS (SELECT p_type AS annotation, p_partkey AS feature, p_size / 50.0 AS weight FROM part WHERE p_size <= 10), d AS (SELECT cell, sum(count) AS d FROM c GROUP BY 1),
a AS (SELECT annotation, sum(expected * weight) AS e FROM w JOIN e USING (feature) GROUP BY 1), o AS (SELECT cell, annotation, sum(count * weight) AS o FROM c JOIN w USING (feature) GROUP BY 1, 2)
SELECT cell, annotation, round(coalesce(o, 0) / (e * d / (SELECT sum(expected) FROM e)) - 1, 6) AS deviation FROM d CROSS JOIN a LEFT JOIN o USING (cell, annotation)""")
def matrix_deviations(t):
    rows = counts(t)
    weights = t("part").filter("p_size <= 10").select(F.col("p_type").alias("annotation"), F.col("p_partkey").alias("feature"), (F.col("p_size") / 50.0).alias("weight"))
    return mx.deviations(rows, weights, mx.expectation(rows, F.lit(100.0))).withColumns(r6("deviation"))


@query("matrix_large_features", f"SELECT feature, cell, count FROM {COUNTS} WHERE feature IN (SELECT feature FROM {COUNTS} GROUP BY 1 HAVING sum(count) > 800)")
def matrix_large_features(t):
    return st.large_features(counts(t), 800).select("feature", "cell", "count")


@query("rank_spearman", "WITH x AS (SELECT l_returnflag, l_quantity, l_extendedprice FROM lineitem), r AS (SELECT l_returnflag, rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_returnflag, l_quantity) - 1) / 2 AS a, rank() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice) + (count(*) OVER (PARTITION BY l_returnflag, l_extendedprice) - 1) / 2 AS b FROM x) SELECT l_returnflag, round(corr(a, b), 6) AS rho, count(*) AS n FROM r GROUP BY 1")
def rank_spearman(t):
    return ranks.spearman(t("lineitem"), "l_quantity", "l_extendedprice", ["l_returnflag"]).withColumns(r6("rho"))


@query("matrix_requested_cells", f"SELECT feature, cell, count FROM {COUNTS} WHERE cell % 3 = 0 AND feature IN (SELECT feature FROM {COUNTS} WHERE cell % 3 = 0 GROUP BY 1 HAVING sum(count) > 50)")
def matrix_requested_cells(t):
    cells = t("supplier").filter("s_suppkey % 3 = 0").select(F.col("s_suppkey").alias("cell"))
    return st.large_features(counts(t), 50, cells).select("feature", "cell", "count")
