"""Cohorts, group rules, reports, nested scans and chains."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import intervals as iv
from ..operators import reports as rp
from ..plans import chains
from ..sources import scans
from .base import ORACLE_SQL, FRAGMENTS, GENES, counts, fragments, genes, peaks, query, r6
from .graph_queries import order_graph
from .matrix_queries import groups, sets


@query("report_losses", "SELECT o_orderkey, CASE WHEN o_totalprice > 400000 THEN 'called' ELSE 'remainder' END AS reason FROM orders WHERE NOT (o_totalprice <= 400000 AND o_custkey % 7 <> 0)")
def report_losses(t):
    o = t("orders")
    return rp.losses(o, o.filter("o_totalprice <= 400000 and o_custkey % 7 <> 0"), "o_orderkey", F.col("o_totalprice") > 400000)


@query("report_offsets", "WITH n AS (SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2) SELECT l_returnflag, l_linestatus, n, round(n / sum(n) OVER (PARTITION BY l_returnflag), 6) AS fraction, CAST(sum(n) OVER w - n AS BIGINT) AS begin, CAST(sum(n) OVER w AS BIGINT) AS \"end\" FROM n WINDOW w AS (PARTITION BY l_returnflag ORDER BY l_linestatus ROWS UNBOUNDED PRECEDING)")
def report_offsets(t):
    n = t("lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"))
    return rp.running_offsets(n, "l_returnflag", ["l_linestatus"], "n").withColumns(r6("fraction"))


@query("report_cohort", "SELECT c_custkey, CASE WHEN c_mktsegment = 'MACHINERY' THEN 'not selected' WHEN c_custkey NOT IN (SELECT o_custkey FROM orders) THEN 'no sample' WHEN c_acctbal < -500 THEN 'missing covariate' WHEN NOT c_nationkey < 20 THEN 'filter' END AS reason FROM customer")
def report_cohort(t):
    donors = t("customer").withColumn("covariate", F.when(F.col("c_acctbal") >= -500, F.col("c_acctbal")))
    return rp.cohort(donors, "c_custkey", F.col("c_mktsegment") != "MACHINERY", t("orders").select(F.col("o_custkey").alias("c_custkey")), ["covariate"], "c_nationkey < 20")


@query("report_composition_counts", """WITH n AS (SELECT c_nationkey, o_orderpriority, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_totalprice > 450000 GROUP BY 1, 2), f AS (SELECT a.c_nationkey, b.o_orderpriority, coalesce(n, 0) AS n FROM (SELECT DISTINCT c_nationkey FROM n) a CROSS JOIN (SELECT DISTINCT o_orderpriority FROM n) b LEFT JOIN n USING (c_nationkey, o_orderpriority)),
w AS (SELECT *, CAST(sum(n) OVER (PARTITION BY c_nationkey) AS BIGINT) AS total, avg(CASE WHEN n > 0 THEN 1.0 ELSE 0 END) OVER (PARTITION BY o_orderpriority) AS p FROM f) SELECT c_nationkey, o_orderpriority, n, total, round(n / total, 6) AS proportion FROM w WHERE p >= 0.5""")
def report_composition_counts(t):
    cells = t("orders").filter("o_totalprice > 450000").join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
    return rp.composition_counts(cells, "c_nationkey", "o_orderpriority").withColumns(r6("proportion"))


@query("report_significant", "WITH n AS (SELECT l_returnflag, l_linestatus, count_if(l_quantity > 45 AND l_discount > 0.05) AS up, count_if(l_quantity > 45 AND l_discount < 0.05) AS down FROM lineitem GROUP BY 1, 2) SELECT *, CASE WHEN direction = 'up' THEN n ELSE -n END AS signed FROM (SELECT * FROM n UNPIVOT (n FOR direction IN (up, down)))")
def report_significant(t):
    return rp.significant_counts(t("lineitem"), ["l_returnflag", "l_linestatus"], F.col("l_discount") - 0.05, F.col("l_quantity") > 45)


@query("report_filtered_clusters", """WITH f AS (SELECT c_nationkey, avg(CASE WHEN c_acctbal > 9000 THEN 1.0 ELSE 0 END) AS f, quantile_cont(c_acctbal, 0.5) FILTER (c_acctbal > 9000) AS c, quantile_cont(c_acctbal, 0.5) FILTER (NOT c_acctbal > 9000) AS o FROM customer GROUP BY 1)
SELECT c_custkey, c_nationkey FROM customer WHERE NOT c_acctbal > 9000 AND c_nationkey NOT IN (SELECT c_nationkey FROM f WHERE f > 0.1 AND coalesce(c / o, 'Infinity'::DOUBLE) >= 2)""")
def report_filtered_clusters(t):
    return rp.filter_clusters(t("customer"), "c_nationkey", F.col("c_acctbal") > 9000, "c_acctbal", 0.1, 2.0).select("c_custkey", "c_nationkey")


@query("report_sidak", "WITH p AS (SELECT l_partkey, (l_extendedprice % 997) / 997 AS p FROM lineitem) SELECT l_partkey, round(min(p), 6) AS p, count(p) AS n, round(1 - pow(1 - min(p), count(p)), 6) AS adjusted FROM p GROUP BY 1")
def report_sidak(t):
    p = t("lineitem").select("l_partkey", ((F.col("l_extendedprice") % 997) / 997).alias("p"))
    return rp.sidak_by(p, ["l_partkey"], "p").withColumns(r6("p", "adjusted"))


@query("report_strata", "SELECT p_partkey, CAST((ntile(4) OVER (ORDER BY p_size, p_partkey) - 1) * 4 + ntile(4) OVER (ORDER BY p_retailprice, p_partkey) - 1 AS BIGINT) AS stratum FROM part")
def report_strata(t):
    return rp.crossed_strata(t("part"), ["p_size", "p_retailprice"], 4, "p_partkey").select("p_partkey", "stratum")


@query("report_background_pairs")
def report_background_pairs(t):
    return rp.background_pairs(genes(t), peaks(t), 20, away=1000)


@query("report_gene_scores", f"""WITH s AS (SELECT cell, chr, unnest(["start", "end" - 1]) AS pos FROM {FRAGMENTS}), n AS (SELECT cell, chr, CAST(floor(pos / 50) AS BIGINT) AS tile, count(*) AS n FROM s GROUP BY ALL),
r AS (SELECT *, max("end") OVER (PARTITION BY chr ORDER BY "start", "end", gene ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b, lead("start") OVER (PARTITION BY chr ORDER BY "start", "end", gene) AS a FROM {GENES}),
g AS (SELECT chr, gene, "start", "end", unnest(generate_series(CAST(floor(("start" - greatest(30, least(100, coalesce("start" - b, 100)))) / 50) AS BIGINT), CAST(floor(("end" + greatest(30, least(100, coalesce(a - "end", 100))) - 1) / 50) AS BIGINT))) AS tile FROM r),
w AS (SELECT chr, gene, tile, exp(-greatest("start" - (tile * 50 + 25.0), tile * 50 + 25.0 - "end", 0.0) / 50) + exp(-1.0) AS w FROM g), p AS (SELECT cell, gene, sum(least(n, 4) * w) AS s FROM n JOIN w USING (chr, tile) GROUP BY 1, 2) SELECT cell, gene, round(s * 1e4 / sum(s) OVER (PARTITION BY cell), 6) AS score FROM p""")
def report_gene_scores(t):
    tiles = iv.binned_coverage(fragments(t), "cell", 50)
    return rp.gene_tile_scores(tiles, genes(t), 50, decay=50, least=30, most=100).withColumns(r6("score"))


@query("report_tile_peaks", f"""WITH s AS (SELECT cell % 4 AS g, chr, unnest(["start", "end" - 1]) AS pos FROM {FRAGMENTS}), x AS (SELECT g, chr, (CAST(floor(pos / 3) AS BIGINT) - k) * 3 AS "start" FROM s, unnest([0, 1, 2]) u(k)), n AS (SELECT g, chr, "start", "start" + 9 AS "end", count(*) AS n FROM x GROUP BY ALL),
m AS (SELECT n.*, e.mean FROM n JOIN (SELECT g, count(*) * 9 / 8000.0 AS mean FROM s GROUP BY 1) e USING (g)), p AS (SELECT *, 1 - list_sum([exp(-mean + i * ln(mean) - lgamma(i + 1)) FOR i IN range(0, n)]) AS p FROM m)
SELECT g AS "group", chr, "start", "end", n, round(mean, 6) AS mean, round(n / mean, 6) AS fold, round(greatest(p, 0), 6) AS p FROM p""")
def report_tile_peaks(t):
    sites = fragments(t).select((F.col("cell") % 4).alias("group"), "chr", F.explode(F.array("start", F.col("end") - 1)).alias("pos"))
    return rp.tile_peaks(sites, "group", 9, F.lit(8000.0)).drop("q").withColumns(r6("mean", "fold", "p"))


@query("report_most_specific", "WITH q AS (SELECT l_suppkey, l_partkey, sum(l_quantity) AS v FROM lineitem GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY v DESC, l_partkey) AS n, count(*) OVER (PARTITION BY l_suppkey) AS m FROM q) SELECT l_suppkey, l_partkey, v FROM r WHERE n <= ceil(m * 0.1) AND v > 0")
def report_most_specific(t):
    q = t("lineitem").groupBy("l_suppkey", "l_partkey").agg(F.sum("l_quantity").alias("v"))
    return rp.most_specific(q, "l_suppkey", "v", "l_partkey")


@query("report_bootstrap")
def report_bootstrap(t):
    return rp.bootstrap_medians(t("lineitem"), ["l_returnflag"], "l_suppkey", "l_extendedprice", 20)


@query("source_unique_names", "SELECT p_partkey, p_name, CASE WHEN n = 1 THEN p_name ELSE concat(p_name, '.', n - 1) END AS \"unique\" FROM (SELECT *, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) AS n FROM part)")
def source_unique_names(t):
    return rp.make_unique(t("part").select("p_partkey", "p_name"), "p_name", "p_partkey")


_ID = "concat(1 + l_linenumber, '_', l_partkey, '_', CASE WHEN l_tax > 0.04 THEN 'A' ELSE 'CT' END, '_G')"


@query("source_credible_sets", f"SELECT CAST(l_suppkey AS VARCHAR) AS \"studyId\", CAST(l_orderkey AS VARCHAR) AS \"studyLocusId\", {_ID} AS \"variantId\", l_discount AS pip, concat('chr', 1 + l_linenumber) AS chr, l_partkey AS pos, CASE WHEN l_tax > 0.04 THEN 'A' ELSE 'CT' END AS ref, 'G' AS alt FROM lineitem WHERE l_suppkey % 5 <> 0")
def source_credible_sets(t):
    named = t("lineitem").withColumn("v", F.struct(F.concat_ws("_", F.col("l_linenumber") + 1, "l_partkey", F.when(F.col("l_tax") > 0.04, "A").otherwise("CT"), F.lit("G")).alias("variantId"), F.col("l_discount").alias("pip")))
    nested = named.groupBy(F.col("l_suppkey").cast("string").alias("studyId"), F.col("l_orderkey").cast("string").alias("studyLocusId")).agg(F.collect_list("v").alias("locus"), F.when(F.first(F.col("l_suppkey")) % 5 == 0, F.array(F.lit("flagged"))).alias("qualityControls"))
    return scans.explode_credible_sets(nested, ["flagged"])


@query("source_regions", "SELECT p_partkey, CASE WHEN p_size > 10 THEN concat('chr', p_size, ':', p_partkey, '-', p_partkey + 5) ELSE 'none' END AS interval, CASE WHEN p_size > 10 THEN concat('chr', p_size) END AS seqnames, CASE WHEN p_size > 10 THEN p_partkey END AS \"start\", CASE WHEN p_size > 10 THEN p_partkey + 5 END AS \"end\" FROM part")
def source_regions(t):
    named = F.when(F.col("p_size") > 10, F.concat(F.lit("chr"), "p_size", F.lit(":"), "p_partkey", F.lit("-"), F.col("p_partkey") + 5)).otherwise("none")
    return scans.feature_regions(t("part").select("p_partkey", named.alias("interval")))


@query("plan_retained_summary", "SELECT o_orderpriority, count(*) AS n, round(quantile_cont(o_totalprice, 0.25), 6) AS o_totalprice_q1, round(quantile_cont(o_totalprice, 0.5), 6) AS o_totalprice_median, round(quantile_cont(o_totalprice, 0.75), 6) AS o_totalprice_q3 FROM orders WHERE NOT (o_totalprice < 60000) AND NOT (o_custkey % 10 = 3) GROUP BY 1")
def plan_retained_summary(t):
    df = chains.retained_summary(t("orders"), "o_orderkey", "o_orderpriority", ["o_totalprice < 60000", "o_custkey % 10 = 3"], ["o_totalprice"])
    return df.withColumns(r6(*df.columns[2:]))


@query("plan_label_groups", f"""WITH s AS ({ORACLE_SQL["matrix_set_scores"].replace("round(sum(count * w), 6)", "sum(count * w)")}), g AS (SELECT s_nationkey % 4 AS g, label, avg(score) AS score FROM s JOIN supplier ON s_suppkey = cell GROUP BY 1, 2), r AS (SELECT CAST(g AS BIGINT) AS "group", label AS best, score AS best_score, lead(label) OVER w AS second, score - lead(score) OVER w AS margin, row_number() OVER w AS n FROM g WINDOW w AS (PARTITION BY g ORDER BY score DESC, label))
SELECT "group", best, round(best_score, 6) AS best_score, second, round(margin, 6) AS margin, CASE WHEN best_score <= 0 THEN 'no_evidence' WHEN coalesce(margin, 0) < 0.01 THEN 'close' ELSE 'assigned' END AS status FROM r WHERE n = 1""")
def plan_label_groups(t):
    return chains.label_groups(counts(t), groups(t), sets(t), 0.01).withColumns(r6("best_score", "margin"))


@query("plan_propagated")
def plan_propagated(t):
    z = t("supplier").select(F.col("s_suppkey").alias("node"), (F.col("s_acctbal") / 3000).alias("z"))
    return chains.propagated_scores(order_graph(t), z, 0.2, 0.5)


@query("event_tiles", "SELECT date_trunc('hour', ts) AS \"start\", event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def event_tiles(t):
    from ..streaming.tiles import tile_counts

    return tile_counts(t("events")).withColumn("total", F.round("total", 4))


@query("event_sessions", """WITH g AS (SELECT user_id, ts, CASE WHEN ts >= lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 30 MINUTE OR lag(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL THEN 1 ELSE 0 END AS fresh FROM events), s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g)
SELECT user_id, min(ts) AS "start", max(ts) + INTERVAL 30 MINUTE AS "end", count(*) AS n FROM s GROUP BY user_id, k""")
def event_sessions(t):
    from ..streaming.tiles import sessions

    return sessions(t("events"))


@query("event_asof", """SELECT e.event_id, e.user_id, (SELECT max(p.ts) FROM events p WHERE p.user_id = e.user_id AND p.event_type = 'purchase' AND p.ts <= e.ts) AS last_purchase FROM events e WHERE e.event_type <> 'purchase'""")
def event_asof(t):
    w = Window.partitionBy("user_id").orderBy("ts").rangeBetween(Window.unboundedPreceding, 0)
    last = F.max(F.when(F.col("event_type") == "purchase", F.col("ts"))).over(w)
    return t("events").withColumn("last_purchase", last).filter("event_type <> 'purchase'").select("event_id", "user_id", "last_purchase")


@query("report_bootstrap_ratios")
def report_bootstrap_ratios(t):
    return rp.bootstrap_ratios(t("lineitem"), "N", "l_returnflag", "l_suppkey", "l_extendedprice", 20)
