"""Quality control on orders (cells) by priority (sample)."""

from pyspark.sql import functions as F

from ..functions.ranks import share
from ..operators import qc
from ..operators import studies as st
from .base import COUNTS, counts, query, r6

RULES = ["o_totalprice < 60000", "o_custkey % 10 = 3", "o_orderstatus = 'P' and o_totalprice > 300000"]
_STEP = "CASE WHEN o_totalprice < 60000 THEN 1 WHEN o_custkey % 10 = 3 THEN 2 WHEN o_orderstatus = 'P' and o_totalprice > 300000 THEN 3 END"


@query("qc_retention", f"""
WITH c AS (SELECT o_orderpriority, count(*) AS total, {", ".join(f"count(*) FILTER ({_STEP} = {i}) AS n{i}" for i in (1, 2, 3))} FROM orders GROUP BY 1),
s AS ({" UNION ALL ".join(f"SELECT o_orderpriority, CAST({i} AS INTEGER) AS step, '{r.replace(chr(39), chr(39) * 2)}' AS rule, n{i} AS n_out, total, {'+'.join(f'n{j}' for j in range(1, i + 1))} AS lost FROM c" for i, r in enumerate(RULES, 1))})
SELECT o_orderpriority, step, rule, total - lost + n_out AS n_in, n_out, total - lost AS n_left, round((total - lost) / total, 6) AS fraction_left FROM s""")
def qc_retention(t):
    return qc.retention(t("orders"), "o_orderpriority", RULES).withColumns(r6("fraction_left"))


@query("qc_excluded_keys", " UNION ALL ".join(f"SELECT '{r.replace(chr(39), chr(39) * 2)}' AS rule, o_orderkey FROM orders WHERE {r}" for r in RULES))
def qc_excluded_keys(t):
    return qc.excluded_keys(t("orders"), "o_orderkey", RULES)


_FLAGS = {"cheap": "o_totalprice < 60000", "third": "o_custkey % 10 = 3", "late": "o_orderdate >= timestamp '1998-01-01'"}


@query("qc_flag_combinations", f"SELECT {', '.join(f'({r}) AS {n}' for n, r in _FLAGS.items())}, count(*) AS n FROM orders GROUP BY ALL")
def qc_flag_combinations(t):
    return qc.flag_combinations(t("orders"), _FLAGS)


@query("qc_merged_combinations", "SELECT o_totalprice < 60000 AS cheap, o_orderstatus = 'P' AND o_custkey % 10 = 3 AS third, o_orderstatus <> 'P' AND o_orderdate >= timestamp '1998-01-01' AS late, count(*) AS n FROM orders GROUP BY ALL")
def qc_merged_combinations(t):
    o, f = t("orders"), _FLAGS
    a = qc.flag_combinations(o.filter("o_orderstatus = 'P'"), {k: f[k] for k in ("cheap", "third")})
    b = qc.flag_combinations(o.filter("o_orderstatus <> 'P'"), {k: f[k] for k in ("cheap", "late")})
    return qc.merge_combinations([a, b])


@query("qc_combination_masks", f"""
WITH c AS (SELECT {" + ".join(f"CAST({r} AS BIGINT) * {1 << i}" for i, r in enumerate(_FLAGS.values()))} AS mask, count(*) AS n FROM orders GROUP BY 1)
SELECT mask, n, round(100 * n / sum(n) OVER (), 6) AS percent, row_number() OVER (ORDER BY n DESC, mask) AS rank FROM c""")
def qc_combination_masks(t):
    return qc.combination_masks(qc.flag_combinations(t("orders"), _FLAGS), list(_FLAGS)).withColumns(r6("percent"))


@query("qc_rule_thresholds", """
WITH r AS (SELECT DISTINCT p_type, trim(x) AS rule FROM part, unnest(string_split(CASE p_type WHEN 'ECONOMY' THEN 'p_size < 5 ;; p_retailprice >= 950.5' WHEN 'PROMO' THEN 'p_size > 45;;;; contains(name)' ELSE ' p_size <= 2' END, ';;')) u(x))
SELECT p_type, rule, regexp_extract(rule, '(\\w+)\\s*(<=|>=|<|>)\\s*([0-9.]+)', 1) AS feature,
 CASE WHEN rule LIKE '%<%' THEN '-Infinity'::DOUBLE ELSE CAST(regexp_extract(rule, '([0-9.]+)$', 1) AS DOUBLE) END AS low,
 CASE WHEN rule LIKE '%<%' THEN CAST(regexp_extract(rule, '([0-9.]+)$', 1) AS DOUBLE) ELSE 'Infinity'::DOUBLE END AS high
FROM r WHERE rule LIKE '%<%' OR rule LIKE '%>%'""")
def qc_rule_thresholds(t):
    text = F.when(F.col("p_type") == "ECONOMY", "p_size < 5 ;; p_retailprice >= 950.5").when(F.col("p_type") == "PROMO", "p_size > 45;;;; contains(name)").otherwise(" p_size <= 2")
    return qc.rule_thresholds(t("part").select("p_type", F.explode(qc.split_rules(text)).alias("rule")).distinct())


@query("qc_sample_quartiles", "SELECT o_orderpriority, count(*) AS n, " + ", ".join(f"round(quantile_cont({v}, {p}), 6) AS {v}_{n}" for v in ("o_totalprice", "o_custkey") for p, n in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))) + " FROM orders GROUP BY 1")
def qc_sample_quartiles(t):
    df = qc.quartiles(t("orders"), ["o_orderpriority"], ["o_totalprice", "o_custkey"])
    return df.withColumns(r6(*df.columns[2:]))


@query("qc_mad_outliers", """
WITH m AS (SELECT c_mktsegment, c_nationkey, quantile_cont(c_acctbal, 0.5) AS value FROM customer GROUP BY 1, 2),
c AS (SELECT c_mktsegment, quantile_cont(value, 0.5) AS centre FROM m GROUP BY 1),
d AS (SELECT c_mktsegment, 1.4826 * quantile_cont(abs(value - centre), 0.5) AS mad FROM m JOIN c USING (c_mktsegment) GROUP BY 1)
SELECT c_mktsegment, c_nationkey, round(value, 6) AS value, round(centre, 6) AS centre, round(mad, 6) AS mad, centre - value > 3 * mad AS outlier FROM m JOIN c USING (c_mktsegment) JOIN d USING (c_mktsegment)""")
def qc_mad_outliers(t):
    medians = t("customer").groupBy("c_mktsegment", "c_nationkey").agg(F.percentile("c_acctbal", 0.5).alias("value"))
    return qc.mad_outliers(medians, "value", ["c_mktsegment"]).withColumns(r6("value", "centre", "mad"))


@query("qc_nearest_class", """
WITH x AS (SELECT p_partkey, p_type, ln(1 + p_size) AS a, ln(1 + p_retailprice) AS b FROM part),
c AS (SELECT p_type AS nearest, quantile_cont(a, 0.5) AS ca, quantile_cont(b, 0.5) AS cb FROM x GROUP BY 1),
r AS (SELECT p_partkey, p_type, nearest, row_number() OVER (PARTITION BY p_partkey ORDER BY round((a - ca) * (a - ca) + (b - cb) * (b - cb), 12), nearest) AS n FROM x, c)
SELECT p_partkey, p_type, nearest, nearest <> p_type AS differs FROM r WHERE n = 1""")
def qc_nearest_class(t):
    return qc.nearest_centroid(t("part"), "p_partkey", "p_type", ["p_size", "p_retailprice"])


@query("qc_cell_metrics", f"""
SELECT cell, CAST(sum(count) AS BIGINT) AS n_counts, count_if(count > 0) AS n_features, round(100 * sum(CASE WHEN feature % 17 = 0 THEN count ELSE 0 END) / sum(count), 6) AS marked_percent,
 round(log10(sum(count)), 6) AS log10_counts, round(log10(count_if(count > 0)) / log10(sum(count)), 6) AS novelty FROM {COUNTS} GROUP BY 1""")
def qc_cell_metrics(t):
    return qc.cell_metrics(counts(t), "cell", "feature", "count", F.col("feature") % 17 == 0).withColumns(r6("marked_percent", "log10_counts", "novelty"))


@query("qc_full_metadata", """
WITH a AS (SELECT o_custkey AS barcode, count(*) AS n_orders FROM orders GROUP BY 1), b AS (SELECT c_custkey AS barcode, c_acctbal AS balance FROM customer WHERE c_acctbal > 0),
e AS (SELECT user_id AS barcode, count(*) AS n_events FROM events GROUP BY 1)
SELECT barcode, coalesce(n_orders, 0) AS n_orders, balance IS NOT NULL AS called, coalesce(n_events, 0) AS n_events, round(coalesce(n_orders, 0) / (coalesce(n_orders, 0) + coalesce(n_events, 0) + 1), 6) AS ratio
FROM a FULL JOIN b USING (barcode) FULL JOIN e USING (barcode)""")
def qc_full_metadata(t):
    a = t("orders").groupBy(F.col("o_custkey").alias("barcode")).agg(F.count(F.lit(1)).alias("n_orders"))
    b = t("customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("barcode"), F.col("c_acctbal").alias("balance"))
    e = t("events").groupBy(F.col("user_id").alias("barcode")).agg(F.count(F.lit(1)).alias("n_events"))
    full = a.join(b, "barcode", "full").join(e, "barcode", "full").fillna(0, ["n_orders", "n_events"])
    return full.select("barcode", "n_orders", F.col("balance").isNotNull().alias("called"), "n_events", F.round(F.col("n_orders") / (F.col("n_orders") + F.col("n_events") + 1), 6).alias("ratio"))


@query("qc_kept_metadata", "SELECT c_custkey, c_nationkey, c_acctbal FROM customer c WHERE NOT coalesce(c_acctbal < 0, false) AND c_mktsegment IN ('BUILDING', 'MACHINERY') AND NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice < 5000)")
def qc_kept_metadata(t):
    excluded = t("orders").filter("o_totalprice < 5000").select(F.col("o_custkey").alias("c_custkey"))
    kept = t("customer").filter(~F.coalesce(F.col("c_acctbal") < 0, F.lit(False)) & F.col("c_mktsegment").isin("BUILDING", "MACHINERY"))
    return kept.join(excluded, "c_custkey", "left_anti").select("c_custkey", "c_nationkey", "c_acctbal")


@query("qc_key_violations", "WITH p AS (SELECT p_name, count(*) AS n FROM part GROUP BY 1) SELECT CAST(coalesce(sum(CASE WHEN p_name IS NULL THEN n END), 0) AS BIGINT) AS n_null, CAST(coalesce(sum(CASE WHEN p_name = '' THEN n END), 0) AS BIGINT) AS n_empty, count_if(p_name IS NOT NULL AND n > 1) AS n_repeated FROM p")
def qc_key_violations(t):
    return qc.violations(t("part"), "p_name")


@query("qc_first_rows", "SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS n FROM orders) WHERE n = 1")
def qc_first_rows(t):
    return qc.first_rows(t("orders"), ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey")]).select("o_custkey", "o_orderkey", "o_totalprice")


@query("qc_donors_in_kept", "SELECT o_custkey, bool_and(o_orderstatus <> 'F') AS \"only\", bool_or(o_orderstatus <> 'F') AND NOT bool_and(o_orderstatus <> 'F') AS \"both\" FROM orders GROUP BY 1 HAVING bool_or(o_orderstatus <> 'F')")
def qc_donors_in_kept(t):
    return qc.only_in_kept(t("orders"), "o_custkey", F.col("o_orderstatus") != "F")


@query("qc_class_by_exclusion", """
WITH x AS (SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders WHERE o_totalprice < 60000 GROUP BY 1, 2) SELECT o_orderpriority, o_orderstatus, n, round(100 * n / sum(n) OVER (PARTITION BY o_orderpriority), 6) AS percent FROM x""")
def qc_class_by_exclusion(t):
    return st.class_percentages(t("orders").filter("o_totalprice < 60000"), "o_orderpriority", "o_orderstatus").withColumn("percent", F.round("percent", 6))


_SETS = ("click", "view", "purchase")


@query("qc_marker_classes", f"""
WITH w AS (SELECT user_id, {", ".join(f"count_if(event_type = '{s}') AS {s}" for s in _SETS)}, count(*) AS total, max_by(event_type, value * 1000003 + event_id) AS label FROM events GROUP BY 1),
s AS (SELECT user_id, label, {", ".join(f"{s} / total AS {s}" for s in _SETS)} FROM w),
c AS (SELECT {", ".join(f"quantile_cont({s}, 0.9) FILTER (label <> '{s}') AS lo_{s}, quantile_cont({s}, 0.5) FILTER (label = '{s}') AS hi_{s}" for s in _SETS)} FROM s),
v AS (SELECT user_id, label, {", ".join(f"coalesce(({s} - lo_{s}) / nullif(hi_{s} - lo_{s}, 0), '-Infinity'::DOUBLE) AS {s}" for s in _SETS)} FROM s, c),
u AS (SELECT user_id, label, greatest({", ".join(_SETS)}) AS score, CASE WHEN click >= view AND click >= purchase THEN 'click' WHEN view >= purchase THEN 'view' ELSE 'purchase' END AS best FROM v)
SELECT user_id, label, CASE WHEN score >= 0.4 THEN best END AS best, round(score, 6) AS score FROM u""")
def qc_marker_classes(t):
    wide = t("events").groupBy("user_id").agg(*[F.count_if(F.col("event_type") == s).alias(s) for s in _SETS], F.count(F.lit(1)).alias("total"), F.max_by("event_type", F.col("value") * 1000003 + F.col("event_id")).alias("label"))
    return qc.classify_by_shares(wide, "user_id", _SETS, "total", "label").withColumns(r6("score"))
