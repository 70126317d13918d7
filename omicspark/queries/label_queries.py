"""Labels and evidence on the star tables."""

from pyspark.sql import functions as F

from ..operators import labels as lb
from .base import COUNTS, PEAKS, counts, peaks, query, r6
from .interval_queries import merged_sql
from .matrix_queries import sets
from .table_queries import _VARIANTS, variants


@query("label_recoded", "SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'works' WHEN 'MACHINERY' THEN 'works' ELSE c_mktsegment END AS c_mktsegment FROM customer")
def label_recoded(t):
    return lb.recode(t("customer"), "c_mktsegment", {"BUILDING": "works", "MACHINERY": "works"}).select("c_custkey", "c_mktsegment")


@query("label_mapped", "SELECT c_custkey, c_nationkey, n_name FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_nationkey < 20) ON n_nationkey = c_nationkey")
def label_mapped(t):
    return lb.map_keys(t("customer"), "c_nationkey", t("nation").filter("n_nationkey < 20"), "n_nationkey", "n_name").select("c_custkey", "c_nationkey", "n_name")


@query("label_fallback", "SELECT c_custkey, coalesce(n_name, concat('Unassigned_', c_nationkey)) AS n_name FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_nationkey < 20) ON n_nationkey = c_nationkey")
def label_fallback(t):
    named = t("nation").filter("n_nationkey < 20").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return lb.with_fallback(t("customer"), named, "c_nationkey", "n_name", "Unassigned_").select("c_custkey", "n_name")


@query("label_rank_scores", f"""WITH c AS {COUNTS}, f AS (SELECT count(DISTINCT feature) AS m FROM c), s AS (SELECT DISTINCT p_type AS label, p_partkey AS feature FROM part WHERE p_size <= 3 AND p_partkey IN (SELECT feature FROM c)), x AS (SELECT a.cell, b.feature, coalesce(c.count, 0) AS v FROM (SELECT DISTINCT cell FROM c) a CROSS JOIN (SELECT DISTINCT feature FROM c) b LEFT JOIN c USING (cell, feature)),
r AS (SELECT cell, feature, rank() OVER (PARTITION BY cell ORDER BY v DESC) + (count(*) OVER (PARTITION BY cell, v) - 1) / 2 AS r FROM x) SELECT cell, label, round(avg(1 - least(r, 300) / 300) / (1 - (count(*) + 1) / 600), 6) AS score FROM r JOIN s USING (feature) GROUP BY 1, 2""")
def label_rank_scores(t):
    c = counts(t)
    n = c.select("feature").distinct().count()
    own = sets(t).join(c.select("feature").distinct(), "feature", "left_semi")
    return lb.rank_scores(c, own, n, 300).withColumns(r6("score"))


@query("label_control_evidence", "WITH o AS (SELECT l_returnflag, avg(l_discount) * 1.5 AS score FROM lineitem GROUP BY 1) SELECT l_returnflag, round(score, 6) AS score, round(avg(l_discount), 6) AS mean, round(quantile_cont(l_discount, 0.95), 6) AS q95, round(avg(CASE WHEN l_discount >= score THEN 1.0 ELSE 0 END), 6) AS tail, round(score - quantile_cont(l_discount, 0.95), 6) AS excess FROM lineitem JOIN o USING (l_returnflag) GROUP BY l_returnflag, score")
def label_control_evidence(t):
    rows = t("lineitem")
    observed = rows.groupBy("l_returnflag").agg((F.avg("l_discount") * 1.5).alias("score"))
    return lb.control_evidence(observed, rows.select("l_returnflag", F.col("l_discount").alias("control")), ["l_returnflag"]).withColumns(r6("score", "mean", "q95", "tail", "excess"))


@query("label_nested_groups", "SELECT c_nationkey, count(DISTINCT c_custkey) AS n, array_to_string(list_sort(list(DISTINCT c_custkey)), ',') AS keys FROM customer GROUP BY 1 HAVING count(DISTINCT c_custkey) >= 55")
def label_nested_groups(t):
    return lb.nested_groups(t("customer"), "c_nationkey", "c_custkey", 55).withColumn("keys", F.array_join(F.transform("keys", lambda k: k.cast("string")), ","))


@query("label_group_diagnostics", "SELECT c_nationkey, count(DISTINCT c_custkey) AS n, 'fewer than 55 cells' AS reason FROM customer GROUP BY 1 HAVING count(DISTINCT c_custkey) < 55")
def label_group_diagnostics(t):
    return lb.group_diagnostics(t("customer"), "c_nationkey", "c_custkey", 55)


@query("label_effect_route", f"WITH l AS (SELECT trait, locus % 10 AS k, bool_and(beta IS NOT NULL) AS a, bool_or(beta IS NOT NULL) AS o, count(*) AS n, count(beta) AS b FROM {_VARIANTS} GROUP BY 1, 2) SELECT trait, CASE WHEN bool_and(a) THEN 'variant' WHEN bool_and(o) THEN 'locus' ELSE 'skip' END AS route, CAST(sum(n) AS BIGINT) AS n_variants, CAST(sum(b) AS BIGINT) AS n_with_effect, count(*) AS n_loci FROM l GROUP BY 1")
def label_effect_route(t):
    return lb.effect_route(variants(t).withColumn("k", F.col("locus") % 10), "trait", "k", F.col("beta").isNotNull())


@query("label_background_shares", "WITH s AS (SELECT l_suppkey, l_returnflag, sum(l_quantity) AS q FROM lineitem GROUP BY 1, 2), p AS (SELECT l_suppkey, l_returnflag, q / sum(q) OVER (PARTITION BY l_suppkey) AS v FROM s), b AS (SELECT l_suppkey, v AS b FROM p WHERE l_returnflag = 'N') SELECT l_suppkey, l_returnflag, round(v / (1 - coalesce(b, 0)), 6) AS share, round(v / (1 - coalesce(b, 0)) * count(*) OVER (PARTITION BY l_suppkey), 6) AS fold FROM p LEFT JOIN b USING (l_suppkey) WHERE l_returnflag <> 'N'")
def label_background_shares(t):
    from ..functions.ranks import share

    s = t("lineitem").groupBy("l_suppkey", "l_returnflag").agg(F.sum("l_quantity").alias("q")).withColumn("v", share("q", ["l_suppkey"]))
    return lb.background_shares(s, "l_suppkey", "l_returnflag", "v", "N").withColumns(r6("share", "fold"))


@query("label_top_two", "WITH s AS (SELECT l_suppkey, l_returnflag, sum(l_quantity) AS v FROM lineitem GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY v DESC, l_returnflag) AS n FROM s) SELECT l_suppkey, max(l_returnflag) FILTER (n = 1) AS first, max(v) FILTER (n = 1) AS first_value, max(l_returnflag) FILTER (n = 2) AS second, max(v) FILTER (n = 2) AS second_value FROM r GROUP BY 1")
def label_top_two(t):
    s = t("lineitem").groupBy("l_suppkey", "l_returnflag").agg(F.sum("l_quantity").alias("v"))
    return lb.top_two(s, "l_suppkey", "l_returnflag", "v")


_LOCI = "(SELECT concat('c', l_partkey % 300) AS chr, CAST(date_diff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE)) AS BIGINT) AS \"start\", CAST(date_diff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE)) AS BIGINT) + 4 AS \"end\", l_suppkey AS cell FROM lineitem)"


@query("label_uncrowded", f"""WITH m AS (SELECT * FROM {merged_sql(_LOCI)}), e AS (SELECT *, avg(n) OVER () AS mean FROM m), k AS (SELECT chr, "start", "end" FROM e WHERE 1 - list_sum([exp(-mean + i * ln(mean) - lgamma(i + 1)) FOR i IN range(0, n + 1)]) < 0.01)
SELECT * FROM {_LOCI} l WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.chr = l.chr AND l."start" < k."end" AND k."start" < l."end")""")
def label_uncrowded(t):
    day = F.datediff("l_shipdate", F.lit("1992-01-01")).cast("bigint")
    loci = t("lineitem").select(F.concat(F.lit("c"), F.col("l_partkey") % 300).alias("chr"), day.alias("start"), (day + 4).alias("end"), F.col("l_suppkey").alias("cell"))
    return lb.drop_crowded(loci, 0.01, 64)


@query("label_is_count", f"SELECT bool_and(score % 1 = 0) AS integral, count(*) AS n FROM {PEAKS}")
def label_is_count(t):
    return peaks(t).agg(F.bool_and(F.col("score") % 1 == 0).alias("integral"), F.count(F.lit(1)).alias("n"))
