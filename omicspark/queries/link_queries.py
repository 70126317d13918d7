"""Peak-gene links: groups = return flags, donors = nations, states = line statuses, genes = parts by 20, peaks = parts by 30."""

from pyspark.sql import functions as F

from ..operators import links as lk
from ..operators import slopes as sl
from .base import query, r6
from .differential_queries import _JOINED, joined

_AGG = "concat(c_nationkey, '_', l_linestatus)"
_G = f"(SELECT l_returnflag AS cell_group, {_AGG} AS aggregate, l_partkey % 20 AS feature, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS count FROM {_JOINED} GROUP BY 1, 2, 3)"
_P = f"(SELECT l_returnflag AS cell_group, {_AGG} AS aggregate, l_partkey % 30 AS feature, count(*) AS count FROM {_JOINED} WHERE l_partkey % 30 <> 7 OR l_quantity > 49 GROUP BY 1, 2, 3)"
_A = f"(SELECT l_returnflag AS cell_group, {_AGG} AS aggregate, any_value(c_nationkey) AS donor, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS gene_depth, count(*) AS peak_depth FROM {_JOINED} GROUP BY 1, 2)"
_PAIRS = "(SELECT DISTINCT l_returnflag AS cell_group, concat('c', l_partkey % 3) AS chr, l_partkey % 20 AS gene, l_partkey % 30 AS peak FROM lineitem)"


def rows(t):
    return joined(t).withColumns({"cell_group": F.col("l_returnflag"), "aggregate": F.concat_ws("_", "c_nationkey", "l_linestatus")})


def tables(t):
    """Members are line items, so counts of cells are their quantities."""
    r = rows(t)
    keys = ["cell_group", "aggregate"]
    g = r.groupBy(*keys, (F.col("l_partkey") % 20).alias("feature")).agg(F.sum(F.col("l_quantity").cast("bigint")).alias("count"))
    p = r.filter("l_partkey % 30 <> 7 or l_quantity > 49").groupBy(*keys, (F.col("l_partkey") % 30).alias("feature")).agg(F.count(F.lit(1)).alias("count"))
    a = r.groupBy(*keys).agg(F.first("c_nationkey").alias("donor"), F.sum(F.col("l_quantity").cast("bigint")).alias("gene_depth"), F.count(F.lit(1)).alias("peak_depth"))
    return g, p, a


def pairs(t):
    return t("lineitem").select(F.col("l_returnflag").alias("cell_group"), F.concat(F.lit("c"), F.col("l_partkey") % 3).alias("chr"), (F.col("l_partkey") % 20).alias("gene"), (F.col("l_partkey") % 30).alias("peak")).distinct()


@query("link_states")
def link_states(t):
    e = t("embeddings").select((F.col("label") % 3).alias("cell_group"), F.col("vec_id").alias("id"), (F.col("vec_id") % 5).alias("donor"), F.slice(F.col("embedding").cast("array<double>"), 1, 6).alias("vector"))
    return lk.lloyd(e.select("cell_group", "id", "vector"), lk.state_numbers(e, 8, 5))


@query("link_state_numbers", "WITH n AS (SELECT label % 3 AS cell_group, vec_id % 5 AS donor, count(*) AS n FROM embeddings GROUP BY 1, 2 HAVING count(*) >= 8) SELECT cell_group, CAST(greatest(1, least(5, floor(quantile_cont(n, 0.5) / 8))) AS INTEGER) AS k FROM n GROUP BY 1")
def link_state_numbers(t):
    return lk.state_numbers(t("embeddings").select((F.col("label") % 3).alias("cell_group"), (F.col("vec_id") % 5).alias("donor")), 8, 5)


_BINS = "(SELECT c_mktsegment AS cell_group, c_nationkey AS donor, CAST(c_custkey % 4 AS INTEGER) AS state, count(*) AS n FROM customer GROUP BY 1, 2, 3 HAVING count(*) >= 2)"
_PRUNE = "".join(f", b{i} AS (SELECT * FROM b{i - 1} x WHERE (SELECT count(DISTINCT donor) FROM b{i - 1} y WHERE y.cell_group = x.cell_group AND y.state = x.state) >= 4 AND (SELECT count(DISTINCT state) FROM b{i - 1} y WHERE y.cell_group = x.cell_group AND y.donor = x.donor) >= 2)" for i in range(1, 9))


@query("link_pruned_states", f"WITH b0 AS {_BINS}{_PRUNE} SELECT * FROM b8")
def link_pruned_states(t):
    return lk.pruned_states(states(t), 2, 4, 2)


def states(t):
    return t("customer").select(F.col("c_mktsegment").alias("cell_group"), F.col("c_nationkey").alias("donor"), (F.col("c_custkey") % 4).cast("int").alias("state"))


@query("link_group_diagnostics", f"WITH b0 AS {_BINS}{_PRUNE}, k AS (SELECT cell_group, count(DISTINCT state) AS s, count(*) AS a FROM b8 GROUP BY 1) SELECT c_mktsegment AS cell_group, count(*) AS n_cells, count(DISTINCT c_nationkey) AS n_donors, coalesce(any_value(s), 0) AS n_states, coalesce(any_value(a), 0) AS n_aggregates, CASE WHEN coalesce(any_value(a), 0) = 0 THEN 'no_aggregates' END AS skipped_reason FROM customer LEFT JOIN k ON cell_group = c_mktsegment GROUP BY 1")
def link_group_diagnostics(t):
    return lk.group_diagnostics(states(t), lk.pruned_states(states(t), 2, 4, 2))


@query("link_aggregate_counts", f"SELECT * FROM {_G}")
def link_aggregate_counts(t):
    members = rows(t).select(F.monotonically_increasing_id().alias("cell"), "cell_group", "aggregate", (F.col("l_partkey") % 20).alias("feature"), F.col("l_quantity").cast("bigint").alias("count"))
    from ..operators.loops import cut

    members = cut(members)
    return lk.aggregate_counts(members.select("cell", "feature", "count"), members.select("cell", "cell_group", "aggregate"))


@query("link_normalised", f"SELECT a.cell_group, f.feature, a.aggregate, round(ln(1 + coalesce(count, 0) * 1e6 / peak_depth), 6) AS value FROM {_A} a JOIN (SELECT DISTINCT cell_group, feature FROM {_P}) f USING (cell_group) LEFT JOIN {_P} p ON p.cell_group = a.cell_group AND p.aggregate = a.aggregate AND p.feature = f.feature")
def link_normalised(t):
    _, p, a = tables(t)
    return lk.normalised(p, a, "peak_depth").withColumns(r6("value"))


@query("link_detection", f"SELECT cell_group, feature, round(count(*) / any_value(n), 6) AS detection FROM {_P} JOIN (SELECT cell_group, count(*) AS n FROM {_A} GROUP BY 1) USING (cell_group) GROUP BY 1, 2")
def link_detection(t):
    _, p, a = tables(t)
    return lk.detection(p, a).withColumns(r6("detection"))


@query("link_branches", f"""WITH n AS (SELECT cell_group, count(*) AS n FROM {_A} GROUP BY 1), g AS (SELECT cell_group, feature AS gene FROM {_G} JOIN n USING (cell_group) GROUP BY 1, 2 HAVING count(*) / any_value(n) >= 0.05), p AS (SELECT cell_group, feature AS peak FROM {_P} JOIN n USING (cell_group) GROUP BY 1, 2 HAVING count(*) / any_value(n) >= 0.95),
x AS (SELECT q.cell_group, chr, count(*) AS n_pairs, count(DISTINCT g.gene) AS n_genes, count(DISTINCT p.peak) AS n_peaks, count(*) FILTER (g.gene IS NOT NULL AND p.peak IS NOT NULL) AS n_kept FROM {_PAIRS} q LEFT JOIN g ON g.cell_group = q.cell_group AND g.gene = q.gene LEFT JOIN p ON p.cell_group = q.cell_group AND p.peak = q.peak GROUP BY 1, 2)
SELECT x.*, n AS n_aggregates, CASE WHEN n < 10 THEN 'few_aggregates' WHEN n - 28 <= 0 THEN 'no_residual_df' WHEN n_genes = 0 THEN 'no_detected_genes' WHEN n_peaks = 0 THEN 'no_accessible_peaks' WHEN n_kept = 0 THEN 'no_pairs' END AS skipped_reason FROM x JOIN n USING (cell_group)""")
def link_branches(t):
    g, p, a = tables(t)
    return lk.branches(pairs(t), lk.detection(g, a), lk.detection(p, a), a, 27, 0.05, 0.95)


_PRESETS = [("lenient", 4.0, 2.0, 3, 0.2, 1, 2), ("strict", 40.0, 4.0, 5, 0.6, 2, 10)]
_SUPPORT = f"""(WITH s AS (SELECT * FROM (VALUES {", ".join(map(str, _PRESETS))}) v(preset, gene_count, peak_count, min_aggregates, fraction, per_donor, min_donors)), n AS (SELECT cell_group, count(*) AS n, quantile_cont(gene_depth, 0.5) AS gm, quantile_cont(peak_depth, 0.5) AS pm FROM {_A} GROUP BY 1),
gh AS (SELECT preset, a.cell_group, feature, donor, per_donor FROM {_G} c JOIN {_A} a USING (cell_group, aggregate) JOIN n USING (cell_group) CROSS JOIN s WHERE count >= greatest(2, gene_count * gene_depth / gm)), ph AS (SELECT preset, a.cell_group, feature, donor, per_donor FROM {_P} c JOIN {_A} a USING (cell_group, aggregate) JOIN n USING (cell_group) CROSS JOIN s WHERE count >= greatest(2, peak_count * peak_depth / pm)),
gn AS (SELECT preset, cell_group, feature, count(*) AS k FROM gh GROUP BY 1, 2, 3), pn AS (SELECT preset, cell_group, feature, count(*) AS k FROM ph GROUP BY 1, 2, 3), gd AS (SELECT preset, cell_group, feature, donor FROM gh GROUP BY 1, 2, 3, 4 HAVING count(*) >= any_value(per_donor)), pd AS (SELECT preset, cell_group, feature, donor FROM ph GROUP BY 1, 2, 3, 4 HAVING count(*) >= any_value(per_donor)),
cd AS (SELECT gd.preset, gd.cell_group, gd.feature AS gene, pd.feature AS peak, count(*) AS k FROM gd JOIN pd ON gd.preset = pd.preset AND gd.cell_group = pd.cell_group AND gd.donor = pd.donor GROUP BY 1, 2, 3, 4)
SELECT s.preset, q.cell_group, q.gene, q.peak, coalesce(gn.k, 0) < greatest(min_aggregates, ceil(fraction * n)) AS low_gene, coalesce(pn.k, 0) < greatest(min_aggregates, ceil(fraction * n)) AS low_peak, coalesce(cd.k, 0) < min_donors AS low_donor FROM {_PAIRS} q JOIN n USING (cell_group) CROSS JOIN s
LEFT JOIN gn ON gn.preset = s.preset AND gn.cell_group = q.cell_group AND gn.feature = q.gene LEFT JOIN pn ON pn.preset = s.preset AND pn.cell_group = q.cell_group AND pn.feature = q.peak LEFT JOIN cd ON cd.preset = s.preset AND cd.cell_group = q.cell_group AND cd.gene = q.gene AND cd.peak = q.peak)"""


def support(t):
    g, p, a = tables(t)
    presets = t("region").sparkSession.createDataFrame(_PRESETS, "preset string, gene_count double, peak_count double, min_aggregates int, fraction double, per_donor int, min_donors int")
    return lk.supported_pairs(pairs(t).select("cell_group", "gene", "peak"), g, p, a, presets)


@query("link_supported_pairs", f"SELECT * FROM {_SUPPORT}")
def link_supported_pairs(t):
    return support(t)


@query("link_retention", f"SELECT preset, cell_group, count(*) AS n, count(*) FILTER (NOT (low_gene OR low_peak OR low_donor)) AS n_retained, count(*) FILTER (low_gene) AS n_low_gene, count(*) FILTER (low_peak) AS n_low_peak, count(*) FILTER (low_donor) AS n_low_donor FROM {_SUPPORT} GROUP BY 1, 2")
def link_retention(t):
    return lk.retention(support(t))


@query("link_design")
def link_design(t):
    return lk.nuisance_design(tables(t)[2])


@query("link_residuals")
def link_residuals(t):
    _, p, a = tables(t)
    return lk.residuals(lk.normalised(p, a, "peak_depth"), lk.nuisance_design(a))


@query("link_latent_factors")
def link_latent_factors(t):
    _, p, a = tables(t)
    design = lk.nuisance_design(a)
    return lk.latent_factors(lk.residual_gram(lk.residuals(lk.normalised(p, a, "peak_depth"), design)), design)


@query("link_values", f"""WITH g AS (SELECT cell_group, feature AS gene, aggregate, ln(1 + count * 1e6 / gene_depth) AS gene_value FROM {_G} JOIN {_A} USING (cell_group, aggregate)), p AS (SELECT cell_group, feature AS peak, aggregate, ln(1 + count * 1e6 / peak_depth) AS peak_value FROM {_P} JOIN {_A} USING (cell_group, aggregate))
SELECT cell_group, q.gene, q.peak, a.aggregate, round(coalesce(gene_value, 0), 6) AS gene_value, round(coalesce(peak_value, 0), 6) AS peak_value FROM (SELECT DISTINCT cell_group, gene, peak FROM {_PAIRS}) q JOIN {_A} a USING (cell_group) LEFT JOIN g USING (cell_group, aggregate, gene) LEFT JOIN p USING (cell_group, aggregate, peak) WHERE (cell_group, peak) IN (SELECT cell_group, feature FROM {_P})""")
def link_values(t):
    g, p, a = tables(t)
    return lk.link_values(pairs(t), lk.normalised(g, a, "gene_depth"), lk.normalised(p, a, "peak_depth")).withColumns(r6("gene_value", "peak_value")).distinct()


@query("link_correlations")
def link_correlations(t):
    """Correlations of residuals."""
    g, p, a = tables(t)
    design = lk.nuisance_design(a)
    rest = lambda v: lk.residuals(v, design).withColumnRenamed("residual", "value")
    return lk.link_correlations(lk.link_values(pairs(t).select("cell_group", "gene", "peak").distinct(), rest(lk.normalised(g, a, "gene_depth")), rest(lk.normalised(p, a, "peak_depth"))))


def slope_fits(t):
    """Donor slopes of all pairs; those whose gene and peak have the same parity play the background."""
    g, p, a = tables(t)
    rows = pairs(t).select("cell_group", "gene", "peak").distinct().withColumn("background", F.pmod(F.xxhash64("gene", "peak"), F.lit(2)) == 0)
    return sl.gene_standardised(sl.donor_slopes(rows, lk.normalised(g, a, "gene_depth"), lk.normalised(p, a, "peak_depth"), lk.nuisance_design(a), a, 4), "background", 2)


@query("link_donor_slopes")
def link_donor_slopes(t):
    return slope_fits(t)


@query("link_background_calibration")
def link_background_calibration(t):
    return sl.background_share(slope_fits(t), "background")
