"""Contracts and verbs of keyed tables on the star tables: customers as cells, nations as clusters, suppliers as samples."""

from pyspark.sql import functions as F

from ..functions import ranks
from ..operators import keyed as kd
from ..operators import studies as st
from .base import COUNTS, FRAGMENTS, GENES, PEAKS, counts, fragments, genes, peaks, query, r6
from .table_queries import _VARIANTS, variants


def standard(t):
    return t("lineitem").select("l_returnflag").distinct().filter("l_returnflag <> 'N'")


@query("keyed_standard_chromosomes", f"SELECT * FROM {PEAKS} WHERE chr IN ('A', 'R')")
def keyed_standard_chromosomes(t):
    return kd.on_chromosomes(peaks(t), standard(t))


@query("keyed_chromosome_sizes", f"""SELECT chr, CAST(0 AS BIGINT) AS "start", max("end") AS "end" FROM {FRAGMENTS} WHERE chr IN ('A', 'R') GROUP BY 1""")
def keyed_chromosome_sizes(t):
    return kd.chromosome_sizes(fragments(t).groupBy("chr").agg(F.max("end").alias("size")), standard(t))


@query("keyed_prefixed_cells", "SELECT l_suppkey AS sample, concat(l_suppkey, '_', l_orderkey) AS cell, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS count FROM lineitem GROUP BY 1, 2")
def keyed_prefixed_cells(t):
    rows = kd.prefixed(t("lineitem"), "l_suppkey", "l_orderkey")
    return rows.groupBy(F.col("l_suppkey").alias("sample"), "cell").agg(F.sum(F.col("l_quantity").cast("bigint")).alias("count"))


@query("keyed_union_fragments", f"""SELECT * FROM {FRAGMENTS} WHERE chr IN ('A', 'R')""")
def keyed_union_fragments(t):
    rows = fragments(t)
    return kd.union_samples([rows.filter("cell % 2 = 0"), rows.filter("cell % 2 = 1")], standard(t))


@query("keyed_sample_fragments", f"""SELECT * FROM {FRAGMENTS} WHERE cell = 7 AND chr IN ('A', 'R')""")
def keyed_sample_fragments(t):
    return kd.on_chromosomes(fragments(t).filter("cell = 7"), standard(t))


@query("keyed_feature_digests", "SELECT p_brand AS sample, count(*) AS n, sha256(string_agg(CAST(p_size AS VARCHAR), ',' ORDER BY p_partkey, CAST(p_size AS VARCHAR))) AS digest FROM part GROUP BY 1")
def keyed_feature_digests(t):
    return kd.feature_digests(t("part"), "p_brand", "p_size", "p_partkey").withColumnRenamed("p_brand", "sample")


@query("keyed_bound_columns", f"SELECT * FROM {COUNTS}")
def keyed_bound_columns(t):
    rows = counts(t)
    kd.check_same_features(t("part").select("p_partkey").crossJoin(F.broadcast(t("region").select("r_regionkey"))).withColumn("at", F.col("p_partkey")), "r_regionkey", "p_partkey", "at")
    return kd.bind_columns([rows.filter("cell % 2 = 0"), rows.filter("cell % 2 = 1")], "feature", "cell", "count")


@query("keyed_aligned", "SELECT l_partkey AS feature, min(l_orderkey) AS place, p_brand, p_type FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY ALL")
def keyed_aligned(t):
    rows = t("lineitem").groupBy(F.col("l_partkey").alias("feature")).agg(F.min("l_orderkey").alias("place"))
    return kd.aligned(t("part").select(F.col("p_partkey").alias("feature"), "p_brand", "p_type"), rows, "feature")


@query("keyed_projected", "SELECT c_custkey, c_mktsegment, c_nationkey FROM customer")
def keyed_projected(t):
    return kd.project(t("customer"), "c_custkey", ["c_nationkey", "no_such", "c_mktsegment"], canonical=["c_mktsegment"])


@query("keyed_in_request_order", "SELECT CAST(place AS INTEGER) AS place, n_nationkey, n_name, n_regionkey FROM (VALUES (0, 7), (1, 3), (2, 19)) v(place, k) JOIN nation ON n_nationkey = k")
def keyed_in_request_order(t):
    return kd.in_request_order(t("nation"), "n_nationkey", [7, 3, 19])


@query("keyed_dropped_columns", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def keyed_dropped_columns(t):
    return t("customer").drop("c_nationkey", "c_mktsegment", "no_such")


@query("keyed_demultiplexed", """WITH d AS (SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN 'doublet' WHEN c_custkey % 10 = 1 THEN 'unassigned' ELSE concat('donor', c_nationkey) END AS label, concat('donor', c_nationkey) AS best FROM customer)
SELECT c_custkey, CASE WHEN label IN ('doublet', 'unassigned') THEN label ELSE 'singlet' END AS class, CASE WHEN label NOT IN ('doublet', 'unassigned') THEN label END AS donor, best AS best_donor FROM d""")
def keyed_demultiplexed(t):
    best = F.concat(F.lit("donor"), F.col("c_nationkey"))
    label = F.when(F.col("c_custkey") % 10 == 0, "doublet").when(F.col("c_custkey") % 10 == 1, "unassigned").otherwise(best)
    return kd.demultiplexed(t("customer").select("c_custkey", label.alias("label"), best.alias("best")), "label", "best").select("c_custkey", "class", "donor", "best_donor")


@query("keyed_resolved_markers", "SELECT DISTINCT CASE WHEN p_partkey % 2 = 0 THEN lower(p_type) ELSE concat(p_brand, ':', p_type) END AS marker, q AS qualified FROM part JOIN (SELECT DISTINCT p_type AS s, concat(p_brand, ':', p_type) AS q FROM part) ON CASE WHEN p_partkey % 2 = 0 THEN upper(p_type) = upper(s) ELSE upper(concat(p_brand, ':', p_type)) = upper(q) END")
def keyed_resolved_markers(t):
    full = F.concat_ws(":", "p_brand", "p_type")
    wanted = t("part").select(F.when(F.col("p_partkey") % 2 == 0, F.lower("p_type")).otherwise(full).alias("marker"))
    return kd.resolve_markers(wanted, t("part").select(F.col("p_type").alias("symbol"), full.alias("qualified")).distinct())


_PANEL = "(SELECT p_type AS label, concat(p_brand, CASE p_size % 3 WHEN 0 THEN '+' WHEN 1 THEN '-' ELSE '' END) AS marker FROM part)"


def panel(t):
    sign = F.when(F.col("p_size") % 3 == 0, "+").when(F.col("p_size") % 3 == 1, "-").otherwise("")
    return t("part").select(F.col("p_type").alias("label"), F.concat("p_brand", sign).alias("marker"))


@query("keyed_marker_panel", f"""SELECT DISTINCT label, regexp_replace(marker, '[+-]$', '') AS feature, suffix(marker, '-') AS negative, regexp_replace(marker, '[+-]$', '') IN (SELECT p_brand FROM part WHERE p_size > 40) AS there FROM {_PANEL}""")
def keyed_marker_panel(t):
    return kd.marker_panel(panel(t), t("part").filter("p_size > 40").select(F.col("p_brand").alias("feature")))


@query("keyed_missing_markers", "SELECT p_type AS label, p_partkey AS feature FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45)")
def keyed_missing_markers(t):
    return kd.missing_markers(t("part").select(F.col("p_type").alias("label"), F.col("p_partkey").alias("feature")), t("lineitem").filter("l_quantity > 45").select(F.col("l_partkey").alias("feature")))


@query("keyed_gene_sets", "SELECT p_type AS \"set\", list_sort(list(DISTINCT p_brand)) AS symbols FROM part GROUP BY 1")
def keyed_gene_sets(t):
    return st.gene_sets(t("part"), "p_type", "p_brand")


@query("keyed_left_cut_sites", f"""SELECT cell AS replicate, chr, "start", "start" + 1 AS "end" FROM {FRAGMENTS} WHERE cell % 2 = 1""")
def keyed_left_cut_sites(t):
    sites = fragments(t).select(F.col("cell").alias("replicate"), "chr", "start", (F.col("start") + 1).alias("end"))
    return sites.filter("replicate % 2 = 1")


@query("keyed_top_cells", "SELECT c_nationkey, c_custkey FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_mktsegment, c_acctbal DESC, c_custkey) AS n FROM customer) WHERE n <= 7")
def keyed_top_cells(t):
    return ranks.top_n(t("customer"), 7, [F.col("c_mktsegment"), F.col("c_acctbal").desc(), F.col("c_custkey")], ["c_nationkey"]).select("c_nationkey", "c_custkey")


@query("keyed_kept_fragments", f"SELECT * FROM {FRAGMENTS} WHERE cell IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 3000)")
def keyed_kept_fragments(t):
    return fragments(t).join(t("supplier").filter("s_acctbal > 3000").select(F.col("s_suppkey").alias("cell")), "cell", "left_semi")


@query("keyed_regulator_edges", "SELECT DISTINCT upper(trim(p_name)) AS regulator, upper(p_brand) AS target, CASE WHEN p_size % 2 = 0 THEN 1 ELSE -1 END AS mode FROM part")
def keyed_regulator_edges(t):
    return t("part").select(F.upper(F.trim("p_name")).alias("regulator"), F.upper("p_brand").alias("target"), F.when(F.col("p_size") % 2 == 0, 1).otherwise(-1).alias("mode")).distinct()


@query("keyed_study_metadata", """WITH n AS (SELECT o_custkey, sum(CASE WHEN o_orderstatus = 'F' THEN 2 ELSE 1 END) AS size, count(*) AS k FROM orders GROUP BY 1)
SELECT c_custkey AS study, CAST(coalesce(CASE WHEN c_custkey % 3 = 0 THEN c_nationkey END, size, 0) AS BIGINT) AS n, coalesce(k, 0) AS n_samples FROM customer LEFT JOIN n ON o_custkey = c_custkey""")
def keyed_study_metadata(t):
    sample = F.struct("o_orderkey", F.when(F.col("o_orderstatus") == "F", 2).otherwise(1).alias("size"))
    nested = t("orders").groupBy("o_custkey").agg(F.collect_list(sample).alias("samples"))  # discovery samples as studies nest them
    studies = t("customer").select("c_custkey", F.when(F.col("c_custkey") % 3 == 0, F.col("c_nationkey")).alias("stated")).join(nested, F.col("c_custkey") == F.col("o_custkey"), "left")
    return st.study_sizes(studies, "c_custkey", "stated", "samples", "size")


def local(df, prefix="local_"):
    return st.conform(df, studyId=F.concat(F.lit(prefix), "trait"), studyLocusId=F.col("locus"), chr=F.concat(F.lit("chr"), "chr"), pos=F.col("start"), posteriorProbability=F.col("pip"), beta=F.col("beta"))


def conformed(t):
    """Variants of a local file in the common shape."""
    return local(variants(t))


_CONFORMED = f"""(SELECT concat('local_', trait) AS studyId, CAST(locus AS VARCHAR) AS studyLocusId, concat('chr', chr) AS chr, "start" AS pos, CAST(pip AS DOUBLE) AS posteriorProbability, CAST(beta AS DOUBLE) AS beta FROM {_VARIANTS})"""


@query("keyed_conformed_variants", f"SELECT studyId, studyLocusId, chr, pos, round(posteriorProbability, 6) AS posteriorProbability, round(beta, 6) AS beta FROM {_CONFORMED}")
def keyed_conformed_variants(t):
    return conformed(t).withColumns(r6("posteriorProbability", "beta"))


@query("keyed_local_metadata", f"SELECT studyId, count(*) AS n_variants, count(DISTINCT studyLocusId) AS n_loci, bool_or(beta IS NOT NULL) AS has_beta FROM {_CONFORMED} GROUP BY 1")
def keyed_local_metadata(t):
    return st.variant_metadata(conformed(t))


@query("keyed_dispatched", f"SELECT studyId, studyLocusId, count(*) AS n, round(sum(posteriorProbability), 4) AS n_signals FROM (SELECT * FROM {_CONFORMED} UNION SELECT concat('own_', studyId), studyLocusId, chr, pos, posteriorProbability, beta FROM {_CONFORMED} WHERE beta > 0) GROUP BY 1, 2")
def keyed_dispatched(t):
    sources = [("local", variants(t)), ("own", variants(t).filter("beta > 0"))]
    rows, _ = st.dispatched(sources, {"local": local, "own": lambda df: local(df, "own_local_")})
    return rows.groupBy("studyId", "studyLocusId").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("posteriorProbability"), 4).alias("n_signals"))


@query("keyed_link_scores", "SELECT l_partkey AS snp, p_brand, round(sum(l_discount), 4) AS score, round(min(p_retailprice), 2) AS weight FROM lineitem JOIN part ON p_partkey = l_partkey AND p_size > 5 GROUP BY 1, 2")
def keyed_link_scores(t):
    """Scores of all chromosomes with the weights of their variants; unmatched ones go."""
    rows = t("lineitem")
    per = kd.union_samples([rows.filter(F.col("l_returnflag") == c).groupBy("l_partkey").agg(F.sum("l_discount").alias("s")) for c in "ANR"]).groupBy("l_partkey").agg(F.sum("s").alias("s"))
    weights = t("part").filter("p_size > 5")
    return per.join(weights, F.col("l_partkey") == F.col("p_partkey")).select(F.col("l_partkey").alias("snp"), "p_brand", F.round("s", 4).alias("score"), F.round("p_retailprice", 2).alias("weight"))


@query("keyed_dosages", """WITH g AS (SELECT p_partkey, md5(CAST(p_partkey AS VARCHAR)) AS h FROM part), s AS (SELECT p_partkey, CAST(i AS INTEGER) AS sample, (CAST(concat('0x', substr(h, 2 * CAST(i // 4 AS INTEGER) + 1, 2)) AS INTEGER) >> CAST(2 * (i % 4) AS INTEGER)) & 3 AS code FROM g, unnest(range(0, 50)) u(i))
SELECT p_partkey, sample, CASE code WHEN 0 THEN 2 WHEN 2 THEN 1 WHEN 3 THEN 0 END AS dosage FROM s""")
def keyed_dosages(t):
    return kd.dosages(t("part").select("p_partkey", F.unhex(F.md5(F.col("p_partkey").cast("string").cast("binary"))).alias("packed")), "p_partkey", "packed", 50)


@query("keyed_stars", "SELECT l_partkey, CASE WHEN round(avg(l_tax), 9) + 0.012 < 0.05 THEN '**' WHEN round(avg(l_discount), 9) < 0.05 THEN '*' ELSE '' END AS stars FROM lineitem GROUP BY 1")
def keyed_stars(t):
    rows = t("lineitem").groupBy("l_partkey").agg(F.round(F.avg("l_discount"), 9).alias("p"), F.round(F.avg("l_tax"), 9).alias("q"))
    return rows.select("l_partkey", kd.stars(F.col("p"), F.col("q") + 0.012).alias("stars"))


@query("keyed_presets", "SELECT preset, count(*) AS n FROM (VALUES ('loose', 5), ('medium', 20), ('strict', 40)) v(preset, least) JOIN part ON p_size >= least GROUP BY 1")
def keyed_presets(t):
    table = kd.presets(t("part").sparkSession, [("loose", 5), ("medium", 20), ("strict", 40)], "preset string, least int")
    return t("part").join(table, F.col("p_size") >= F.col("least")).groupBy("preset").agg(F.count(F.lit(1)).alias("n"))


def _half(t, odd):
    return t("embeddings").filter(f"vec_id % 3 <> {odd}").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vector"))


@query("keyed_common_cells", "SELECT vec_id AS id, [round(CAST(embedding[3] AS DOUBLE), 6), round(CAST(embedding[1] AS DOUBLE), 6)] AS first, [round(CAST(embedding[2] AS DOUBLE), 6)] AS second FROM embeddings WHERE vec_id % 3 = 2 AND label < 5")
def keyed_common_cells(t):
    both = kd.common_cells(_half(t, 0), _half(t, 1), t("embeddings").filter("label < 5").select(F.col("vec_id").alias("id")), "id", ((3, 1), (2,)))
    return both.select("id", F.transform("first", lambda x: F.round(x, 6)).alias("first"), F.transform("second", lambda x: F.round(x, 6)).alias("second"))


@query("keyed_refreshed", "SELECT c_custkey, c_name, c_acctbal, c_mktsegment, n_name AS c_nationkey FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey AND n_nationkey < 12 WHERE c_acctbal > 0")
def keyed_refreshed(t):
    fresh = t("customer").join(t("nation").filter("n_nationkey < 12"), F.col("n_nationkey") == F.col("c_nationkey")).select("c_custkey", F.col("n_name").alias("c_nationkey"))
    return kd.refreshed(t("customer"), t("customer").filter("c_acctbal > 0"), [fresh], "c_custkey")


@query("keyed_embedding_metadata", "SELECT vec_id AS id, label, round(CAST(embedding[2] AS DOUBLE), 6) AS d2 FROM embeddings JOIN customer ON c_custkey = vec_id")
def keyed_embedding_metadata(t):
    e = t("embeddings").select(F.col("vec_id").alias("id"), "label", F.round(F.element_at("embedding", 2).cast("double"), 6).alias("d2"))
    return e.join(t("customer").select(F.col("c_custkey").alias("id")), "id")


_FAMILIES = "(SELECT DISTINCT p_name AS symbol, p_type AS family FROM part WHERE p_partkey % 50 < 3)"
_EDGES = "(SELECT DISTINCT p_name AS regulator FROM part)"
_MEMBERS = "(SELECT DISTINCT a.p_name AS regulator, b.p_name AS member FROM part a JOIN part b ON b.p_partkey = a.p_partkey + 1)"


def family_tables(t):
    part = t("part")
    families = part.filter("p_partkey % 50 < 3").select(F.col("p_name").alias("symbol"), F.col("p_type").alias("family")).distinct()
    nxt = part.select((F.col("p_partkey") - 1).alias("p_partkey"), F.col("p_name").alias("member"))
    return part.select(F.col("p_name").alias("regulator")).distinct(), families, part.join(nxt, "p_partkey").select(F.col("p_name").alias("regulator"), "member").distinct()


_FAMILY_MAP = f"""(SELECT regulator, string_agg(DISTINCT family, ';' ORDER BY family) AS families, string_agg(DISTINCT via, ';' ORDER BY via) AS via FROM (
SELECT regulator, family, 'symbol' AS via FROM {_EDGES} JOIN {_FAMILIES} ON regulator = symbol UNION ALL SELECT regulator, family, 'complex' FROM {_MEMBERS} JOIN {_FAMILIES} ON member = symbol) GROUP BY 1)"""


@query("keyed_family_map", f"SELECT * FROM {_FAMILY_MAP}")
def keyed_family_map(t):
    return kd.family_map(*family_tables(t))


_FIRST = "(SELECT p_name AS regulator, round(avg(p_size) - 25.3, 6) AS effect_a, round(min(p_size) / 50.0, 6) AS q_a FROM part GROUP BY 1)"
_SECOND = "(SELECT p_type AS family, round(avg(p_retailprice) - 1000.3, 6) AS effect_b, round(min(p_size) / 30.0, 6) AS q_b FROM part GROUP BY 1)"
_COMPARED = f"""(SELECT regulator, family, effect_a, q_a, effect_b, q_b, CASE WHEN family IS NULL THEN 'no family' WHEN effect_b IS NULL THEN 'not tested' WHEN q_a < 0.05 AND q_b < 0.05 THEN 'both' WHEN q_a < 0.05 THEN 'first only' WHEN q_b < 0.05 THEN 'second only' ELSE 'neither' END AS status, sign(effect_a) = sign(effect_b) AS concordant
FROM {_FIRST} LEFT JOIN (SELECT regulator, unnest(string_split(families, ';')) AS family FROM {_FAMILY_MAP}) USING (regulator) LEFT JOIN {_SECOND} USING (family))"""


def comparison(t):
    first = t("part").groupBy(F.col("p_name").alias("regulator")).agg(F.round(F.avg("p_size") - 25.3, 6).alias("effect_a"), F.round(F.min("p_size") / 50.0, 6).alias("q_a"))
    second = t("part").groupBy(F.col("p_type").alias("family")).agg(F.round(F.avg("p_retailprice") - 1000.3, 6).alias("effect_b"), F.round(F.min("p_size") / 30.0, 6).alias("q_b"))
    return kd.compared(first, second, kd.family_map(*family_tables(t)))


@query("keyed_compared", f"SELECT * FROM {_COMPARED}")
def keyed_compared(t):
    return comparison(t)


@query("keyed_family_aggregates", f"SELECT family, round(quantile_cont(effect_a, 0.5), 6) AS median_effect, min(q_a) AS least_q, coalesce(bool_or(concordant), false) AS any_concordant, count(DISTINCT regulator) AS n_regulators, min(regulator) AS first FROM {_COMPARED} GROUP BY 1")
def keyed_family_aggregates(t):
    return kd.family_aggregates(comparison(t), ["family"]).withColumns(r6("median_effect"))


@query("keyed_paired_scores", "SELECT a.trait, a.g, round(x, 4) AS x, round(y, 4) AS y FROM (SELECT l_partkey % 7 AS trait, l_suppkey % 5 AS g, avg(l_discount) AS x FROM lineitem GROUP BY 1, 2) a JOIN (SELECT l_partkey % 7 AS trait, l_suppkey % 5 AS g, avg(l_tax) AS y FROM lineitem WHERE l_suppkey % 5 < 4 GROUP BY 1, 2) b USING (trait, g)")
def keyed_paired_scores(t):
    return kd.paired_scores(*scored(t), ["trait", "g"], "x", "y").select("trait", "g", F.round("x", 4).alias("x"), F.round("y", 4).alias("y"))


def scored(t):
    rows = t("lineitem").withColumns({"trait": F.col("l_partkey") % 7, "g": F.col("l_suppkey") % 5})
    return rows.groupBy("trait", "g").agg(F.avg("l_discount").alias("x")), rows.filter("g < 4").groupBy("trait", "g").agg(F.avg("l_tax").alias("y"))


@query("keyed_agreement", "SELECT g, count(*) FILTER (x >= 0.05 AND y >= 0.04) AS both, count(*) FILTER (x >= 0.05 AND NOT y >= 0.04) AS first_only, count(*) FILTER (NOT x >= 0.05 AND y >= 0.04) AS second_only, count(*) FILTER (NOT x >= 0.05 AND NOT y >= 0.04) AS neither, round(corr(x, y), 4) AS r FROM (SELECT l_partkey AS p, l_suppkey % 5 AS g, round(avg(l_discount), 6) AS x, round(avg(l_tax), 6) AS y FROM lineitem GROUP BY 1, 2) GROUP BY 1".replace(">= 0.04", "* 1.25 >= 0.05"))
def keyed_agreement(t):
    rows = t("lineitem").groupBy("l_partkey", (F.col("l_suppkey") % 5).alias("g")).agg(F.round(F.avg("l_discount"), 6).alias("x"), (F.round(F.avg("l_tax"), 6) * 1.25).alias("y"))
    return kd.agreement(rows, ["g"], "x", "y", 0.05).withColumn("r", F.round("r", 4))


@query("keyed_top_gene_context", "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_partkey IN (SELECT l_partkey FROM lineitem WHERE l_discount >= 0.1 AND l_quantity > 48)")
def keyed_top_gene_context(t):
    return st.in_context(t("lineitem"), "l_partkey", (F.col("l_discount") >= 0.1) & (F.col("l_quantity") > 48)).select("l_orderkey", "l_linenumber", "l_partkey")


@query("keyed_peak_enrichment", f"""WITH n AS (SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1), i AS (SELECT cell, CAST(sum(count) AS BIGINT) AS in_peaks FROM {COUNTS} WHERE feature IN (SELECT p_partkey FROM part WHERE p_size <= 5) GROUP BY 1)
SELECT l_suppkey AS cell, n, coalesce(in_peaks, 0) AS in_peaks, round(log10(greatest(coalesce(in_peaks, 0), 1)), 6) AS log10_in_peaks, round(coalesce(in_peaks, 0) / n / 0.02, 6) AS enrichment FROM n LEFT JOIN i ON cell = l_suppkey""")
def keyed_peak_enrichment(t):
    totals = t("lineitem").groupBy(F.col("l_suppkey").alias("cell")).agg(F.count(F.lit(1)).alias("n"))
    return kd.cut_site_enrichment(counts(t).join(t("part").filter("p_size <= 5").select(F.col("p_partkey").alias("feature")), "feature", "left_semi"), totals, "cell", 2, 100).withColumns(r6("log10_in_peaks", "enrichment"))


@query("keyed_cohort_support", """WITH r AS (SELECT c_nationkey, count(*) AS n, sum(o_orderkey % 90) AS cells, string_agg(DISTINCT o_orderstatus, ',' ORDER BY o_orderstatus) AS wells FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_totalprice > 400000 GROUP BY 1), f AS (SELECT c_nationkey, count(*) AS n FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_totalprice > 480000 GROUP BY 1)
SELECT n_nationkey AS donor, coalesce(r.n, 0) AS n_retained, CAST(coalesce(r.cells, 0) AS BIGINT) AS n_cells, coalesce(r.wells, '') AS wells, coalesce(f.n, 0) AS n_fitted FROM nation LEFT JOIN r ON r.c_nationkey = n_nationkey LEFT JOIN f ON f.c_nationkey = n_nationkey""")
def keyed_cohort_support(t):
    rows = t("orders").join(t("customer"), F.col("c_custkey") == F.col("o_custkey")).select(F.col("c_nationkey").alias("donor"), (F.col("o_orderkey") % 90).alias("cells"), F.col("o_orderstatus").alias("well"), "o_totalprice")
    return kd.cohort_support(t("nation").select(F.col("n_nationkey").alias("donor")), rows.filter("o_totalprice > 400000"), rows.filter("o_totalprice > 480000"), "donor", "cells", "well")


@query("keyed_called_bars", "SELECT c_nationkey, count(*) FILTER (c_acctbal > 8000) AS n_called, count(*) FILTER (NOT c_acctbal > 8000) AS n_other, round(quantile_cont(-log10((c_custkey % 97 + 1) / 100.0), 0.5), 6) AS median_log10p, round(count(*) FILTER (c_acctbal > 8000) / count(*), 6) AS fraction, count(*) FILTER (c_acctbal > 8000) / count(*) > 0.2 AS over FROM customer GROUP BY 1")
def keyed_called_bars(t):
    rows = t("customer").withColumn("p", (F.col("c_custkey") % 97 + 1) / 100.0)
    return kd.called_bars(rows, "c_nationkey", F.col("c_acctbal") > 8000, "p", 0.2).withColumns(r6("median_log10p", "fraction"))


@query("keyed_significant_shares", """WITH b AS (SELECT 'order' AS modality, o_orderpriority AS model, o_orderstatus AS contrast, o_totalprice / 5e5 AS q FROM orders UNION ALL SELECT 'line', l_linestatus, l_returnflag, l_discount FROM lineitem), n AS (SELECT modality, model, contrast, count(*) AS n FROM b WHERE q < 0.05 GROUP BY 1, 2, 3)
SELECT *, round(n / sum(n) OVER (PARTITION BY modality, model), 6) AS share FROM n""")
def keyed_significant_shares(t):
    parts = {"order": t("orders").select(F.col("o_orderpriority").alias("model"), F.col("o_orderstatus").alias("contrast"), (F.col("o_totalprice") / 5e5).alias("q")), "line": t("lineitem").select(F.col("l_linestatus").alias("model"), F.col("l_returnflag").alias("contrast"), F.col("l_discount").alias("q"))}
    return kd.significant_shares(parts, ["model", "contrast"], F.col("q") < 0.05).withColumns(r6("share"))


_COMPARTMENT = "CASE WHEN n_name LIKE '%\\_1%' ESCAPE '\\' THEN 'teens' WHEN n_name LIKE '%\\_2%' ESCAPE '\\' THEN 'twenties' ELSE 'Other' END"


@query("keyed_compartments", f"SELECT c_mktsegment AS locus, {_COMPARTMENT} AS compartment, CAST(sum(c_custkey % 100) AS BIGINT) AS share, CAST(min(c_nationkey) AS INTEGER) AS least FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY 1, 2".replace(", CAST(min(c_nationkey) AS INTEGER) AS least", ", any_value(r_name) AS trait").replace("GROUP BY 1, 2", "JOIN region ON r_regionkey = length(c_mktsegment) % 5 GROUP BY 1, 2"))
def keyed_compartments(t):
    rows = t("customer").join(t("nation"), F.col("n_nationkey") == F.col("c_nationkey")).select(F.col("c_mktsegment").alias("locus"), "n_name", (F.col("c_custkey") % 100).alias("share"))
    per = kd.compartments(rows, {"teens": "_1", "twenties": "_2"}, "n_name", "share", ["locus"])
    return per.join(t("region").select("r_regionkey", F.col("r_name").alias("trait")), F.length("locus") % 5 == F.col("r_regionkey"), "left").drop("r_regionkey")


_SCORES = "(SELECT c_nationkey AS cluster, c_mktsegment AS label, round(avg(c_acctbal) - 4400, 6) AS score FROM customer GROUP BY 1, 2)"


@query("keyed_marker_sets", f"""WITH w AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY score DESC, label) AS n FROM {_SCORES}), r AS (SELECT a.*, b.label AS rival, a.score - b.score AS advantage FROM w a JOIN w b ON a.cluster = b.cluster AND b.n = CASE WHEN a.n = 1 THEN 2 ELSE 1 END),
k AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY advantage DESC, cluster DESC) AS k FROM r), s AS (SELECT label, count(*) FILTER (score > 100) AS n_above, count(*) FILTER (n = 1) AS n_leading FROM w GROUP BY 1)
SELECT s.label, n_above, n_leading, cluster AS best_cluster, round(advantage, 6) AS advantage, rival AS competitor FROM s JOIN k ON k.label = s.label AND k = 1""")
def keyed_marker_sets(t):
    scores = t("customer").groupBy(F.col("c_nationkey").alias("cluster"), F.col("c_mktsegment").alias("label")).agg(F.round(F.avg("c_acctbal") - 4400, 6).alias("score"))
    return kd.marker_sets(scores, 100).withColumns(r6("advantage"))


@query("keyed_enriched_pairs", "SELECT l_partkey % 7 AS trait, l_suppkey AS g, bool_or(q < 0.02) AS enriched FROM (SELECT l_partkey, l_suppkey, l_linestatus, l_discount AS q FROM lineitem) GROUP BY 1, 2")
def keyed_enriched_pairs(t):
    rows = t("lineitem").select((F.col("l_partkey") % 7).alias("trait"), F.col("l_suppkey").alias("g"), "l_discount")
    return st.enriched_pairs(rows, ["trait", "g"], F.col("l_discount") < 0.02)


@query("keyed_nested_samples", "SELECT c_nationkey AS sample, count(*) AS n, list(concat(c_custkey, ':', c_mktsegment) ORDER BY c_custkey) AS cells FROM customer GROUP BY 1")
def keyed_nested_samples(t):
    nested = st.nested_cells(t("customer"), "c_nationkey", "c_custkey", "c_mktsegment")
    return nested.select("sample", "n", F.transform("cells", lambda x: F.concat_ws(":", x["c_custkey"], x["c_mktsegment"])).alias("cells"))


@query("keyed_continuous_inputs", f"""SELECT c_custkey AS cell, c_acctbal, CAST(coalesce(sum(count) FILTER (feature = 3), 0) AS BIGINT) AS f3, CAST(coalesce(sum(count) FILTER (feature = 5), 0) AS BIGINT) AS f5 FROM customer LEFT JOIN {COUNTS} ON cell = c_custkey GROUP BY 1, 2""")
def keyed_continuous_inputs(t):
    return st.continuous_inputs(t("customer").withColumnRenamed("c_custkey", "cell"), ["c_acctbal"], counts(t), {"f3": 3, "f5": 5})


@query("keyed_pooled_least", """WITH c AS (SELECT p_brand AS tf, l_returnflag AS ty, sum(CAST(l_quantity AS BIGINT)) AS n FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2) SELECT tf, round(min(n * 1e6 / d), 4) AS least_cpm FROM (SELECT *, sum(n) OVER (PARTITION BY ty) AS d FROM c) GROUP BY 1""")
def keyed_pooled_least(t):
    rows = t("lineitem").join(t("part"), F.col("p_partkey") == F.col("l_partkey")).select(F.col("p_brand").alias("tf"), "l_returnflag", F.col("l_quantity").cast("bigint").alias("n"))
    return st.least_pooled_cpm(rows, "tf", "l_returnflag", "n").withColumn("least_cpm", F.round("least_cpm", 4))


@query("keyed_detail_loci", """WITH x AS (SELECT c_nationkey, c_custkey, c_acctbal - 4500 AS v, c_custkey % 101 AS w FROM customer), p AS (SELECT *, (rank() OVER (PARTITION BY c_nationkey ORDER BY abs(v)) + (count(*) OVER (PARTITION BY c_nationkey, abs(v)) - 1) / 2) / count(*) OVER (PARTITION BY c_nationkey) AS pv, (rank() OVER (PARTITION BY c_nationkey ORDER BY abs(w)) + (count(*) OVER (PARTITION BY c_nationkey, abs(w)) - 1) / 2) / count(*) OVER (PARTITION BY c_nationkey) AS pw FROM x),
r AS (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY abs(v) DESC, c_custkey) <= 3 AS a, row_number() OVER (PARTITION BY c_nationkey ORDER BY least(pv, pw) DESC, c_custkey) <= 3 AS b FROM p)
SELECT c_nationkey, c_custkey, CASE WHEN a AND b THEN 'contribution, both' WHEN a THEN 'contribution' ELSE 'both' END AS reasons FROM r WHERE a OR b""")
def keyed_detail_loci(t):
    rows = t("customer").select("c_nationkey", "c_custkey", (F.col("c_acctbal") - 4500).alias("v"), (F.col("c_custkey") % 101).alias("w"))
    return kd.detail_loci(rows, "c_nationkey", "c_custkey", "v", "w", 3).select("c_nationkey", "c_custkey", "reasons")


@query("keyed_link_predicate", "SELECT l_returnflag, count(*) AS n, count(*) FILTER (coalesce(e > 0 AND l_quantity - 20 > 0 AND l_discount < 0.05 AND NOT l_tax > 0.06, false)) AS n_links FROM (SELECT *, CASE WHEN l_linenumber <> 2 THEN l_extendedprice - 20000 END AS e FROM lineitem) GROUP BY 1")
def keyed_link_predicate(t):
    e = F.when(F.col("l_linenumber") != 2, F.col("l_extendedprice") - 20000)
    flag = kd.link_predicate(e, F.col("l_quantity") - 20, F.col("l_discount"), F.col("l_tax") > 0.06)
    return t("lineitem").groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.count_if(flag).alias("n_links"))


@query("keyed_component_effects", """WITH e AS (SELECT l_partkey AS feature, l_returnflag AS contrast, round(avg(l_quantity), 6) AS effect FROM lineitem GROUP BY 1, 2), d AS (SELECT a.feature, 'A_minus_R' AS contrast, round(a.effect - r.effect, 6) AS effect FROM e a JOIN e r ON a.feature = r.feature AND a.contrast = 'A' AND r.contrast = 'R'), u AS (SELECT * FROM e UNION ALL SELECT * FROM d)
SELECT u.*, a.effect AS effect_a, r.effect AS effect_b FROM u LEFT JOIN e a ON u.contrast = 'A_minus_R' AND a.contrast = 'A' AND a.feature = u.feature LEFT JOIN e r ON u.contrast = 'A_minus_R' AND r.contrast = 'R' AND r.feature = u.feature""")
def keyed_component_effects(t):
    e = t("lineitem").groupBy(F.col("l_partkey").alias("feature"), F.col("l_returnflag").alias("contrast")).agg(F.round(F.avg("l_quantity"), 6).alias("effect"))
    a, r = (e.filter(F.col("contrast") == c).select("feature", F.col("effect").alias(c)) for c in "AR")
    d = a.join(r, "feature").select("feature", F.lit("A_minus_R").alias("contrast"), F.round(F.col("A") - F.col("R"), 6).alias("effect"))
    return kd.component_effects(e.unionByName(d), "feature", "contrast", "effect")


@query("keyed_p_histogram", "SELECT l_returnflag, CAST(least(floor(p * 20), 19) AS BIGINT) AS bin, count(*) AS n FROM (SELECT l_returnflag, (l_partkey % 41) / 40.0 AS p FROM lineitem) GROUP BY 1, 2")
def keyed_p_histogram(t):
    return kd.p_histogram(t("lineitem").withColumn("p", F.col("l_partkey") % 41 / 40.0), ["l_returnflag"], "p")


@query("keyed_score_matrix", "SELECT s_suppkey AS peak, g AS \"group\", coalesce(r, 0) AS rank FROM supplier CROSS JOIN (SELECT DISTINCT l_returnflag AS g FROM lineitem) LEFT JOIN (SELECT l_suppkey, l_returnflag, round(percent, 6) AS r FROM (SELECT *, (rank() OVER (PARTITION BY l_returnflag ORDER BY n) + (count(*) OVER (PARTITION BY l_returnflag, n) - 1) / 2) / count(*) OVER (PARTITION BY l_returnflag) AS percent FROM (SELECT l_suppkey, l_returnflag, count(*) AS n FROM lineitem WHERE l_quantity > 40 GROUP BY 1, 2))) ON l_suppkey = s_suppkey AND l_returnflag = g")
def keyed_score_matrix(t):
    n = t("lineitem").filter("l_quantity > 40").groupBy(F.col("l_suppkey").alias("peak"), F.col("l_returnflag").alias("group")).agg(F.count(F.lit(1)).alias("n"))
    return st.rank_matrix(n, t("supplier").select(F.col("s_suppkey").alias("peak")), "peak", "group", "n").withColumns(r6("rank"))


@query("keyed_zero_filled_scores", "SELECT a.trait, b.g AS \"group\", coalesce(s, 0) AS score, coalesce(n, 0) AS n, CASE WHEN b.g < 2 THEN 'low' ELSE 'high' END AS compartment FROM (SELECT DISTINCT l_partkey % 97 AS trait FROM lineitem) a CROSS JOIN (SELECT DISTINCT l_suppkey % 5 AS g FROM lineitem) b LEFT JOIN (SELECT l_partkey % 97 AS trait, l_suppkey % 5 AS g, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS s, count(*) AS n FROM lineitem WHERE l_discount > 0.09 GROUP BY 1, 2) USING (trait, g)")
def keyed_zero_filled_scores(t):
    rows = t("lineitem").withColumns({"trait": F.col("l_partkey") % 97, "group": F.col("l_suppkey") % 5})
    filled = st.zero_filled(rows, "trait", "group", F.col("l_quantity").cast("bigint"), F.col("l_discount") > 0.09)
    return filled.withColumn("compartment", F.when(F.col("group") < 2, "low").otherwise("high"))


@query("keyed_split_natural", "SELECT p_partkey, p_brand, dense_rank() OVER (ORDER BY CAST(substr(p_brand, 7) AS INTEGER)) AS part FROM part")
def keyed_split_natural(t):
    return kd.split_natural(t("part").select("p_partkey", "p_brand"), "p_brand")


@query("keyed_lead_labels", "SELECT o_custkey, CASE WHEN count(*) > 1 THEN concat(min(o_orderkey), ' (', count(*), ' signals)') ELSE CAST(min(o_orderkey) AS VARCHAR) END AS label FROM orders GROUP BY 1")
def keyed_lead_labels(t):
    return t("orders").groupBy("o_custkey").agg(F.min("o_orderkey").alias("lead"), F.count(F.lit(1)).alias("n")).select("o_custkey", kd.lead_label(F.col("lead"), F.col("n")).alias("label"))


@query("keyed_subset_labels", "SELECT n_regionkey, coalesce(string_agg(replace(n_name, '_', '-'), '+' ORDER BY n_name) FILTER (n_nationkey > 4), 'all') AS label FROM nation GROUP BY 1")
def keyed_subset_labels(t):
    return t("nation").groupBy("n_regionkey").agg(F.array_sort(F.collect_list(F.when(F.col("n_nationkey") > 4, F.col("n_name")))).alias("names")).select("n_regionkey", kd.subset_label(F.col("names")).alias("label"))


@query("keyed_filled_sizes", "SELECT o_orderkey, o_custkey, coalesce(CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey END, n) AS n FROM orders LEFT JOIN (SELECT c_custkey, c_nationkey * 10 AS n FROM customer WHERE c_custkey % 2 = 0) ON c_custkey = o_custkey WHERE coalesce(CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey END, n) > 0")
def keyed_filled_sizes(t):
    rows = t("orders").select("o_orderkey", "o_custkey", F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderkey")).alias("n"))
    totals = t("customer").filter("c_custkey % 2 = 0").select(F.col("c_custkey").alias("o_custkey"), (F.col("c_nationkey") * 10).alias("total"))
    return kd.filled_sizes(rows, "o_custkey", "n", totals, "total").select("o_orderkey", "o_custkey", "n")


@query("keyed_named_loci", f"""SELECT r_name AS chr, "start", "end", s_name AS cell FROM (SELECT *, CASE chr WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 9 END AS c FROM {FRAGMENTS}) LEFT JOIN region ON r_regionkey = c LEFT JOIN supplier ON s_suppkey = cell""")
def keyed_named_loci(t):
    rows = fragments(t).select(F.when(F.col("chr") == "A", 0).when(F.col("chr") == "N", 1).otherwise(9).alias("chr_i"), "start", "end", F.col("cell").alias("cell_i"))
    return kd.named_loci(rows, t("supplier").select(F.col("s_suppkey").alias("i"), F.col("s_name").alias("name")), F.broadcast(t("region").select(F.col("r_regionkey").alias("i"), F.col("r_name").alias("name"))))


@query("keyed_cluster_sizes", "SELECT n_nationkey, n_name, coalesce(n, 0) AS n FROM nation LEFT JOIN (SELECT c_nationkey, count(*) AS n FROM customer WHERE c_acctbal > 9000 GROUP BY 1) ON c_nationkey = n_nationkey")
def keyed_cluster_sizes(t):
    n = t("customer").filter("c_acctbal > 9000").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("n"))
    return t("nation").select("n_nationkey", "n_name").join(n, "n_nationkey", "left").fillna(0, ["n"])


@query("keyed_categories", "SELECT s_suppkey, s_nationkey, r_name AS category FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey LEFT JOIN region ON r_regionkey = n_regionkey AND r_regionkey < 4")
def keyed_categories(t):
    categories = t("nation").join(t("region").filter("r_regionkey < 4"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").alias("s_nationkey"), F.col("r_name").alias("category"))
    return t("supplier").select("s_suppkey", "s_nationkey").join(F.broadcast(categories), "s_nationkey", "left").select("s_suppkey", "s_nationkey", "category")


@query("keyed_preset_retention", "SELECT preset, p_type, round(count(*) FILTER (p_size >= least) / count(*), 6) AS kept FROM part CROSS JOIN (VALUES ('loose', 5), ('medium', 20), ('strict', 40)) v(preset, least) GROUP BY 1, 2")
def keyed_preset_retention(t):
    sizes = t("part").groupBy("p_type", "p_size").agg(F.count(F.lit(1)).alias("n"))
    rows = sizes.join(kd.presets(t("part").sparkSession, [("loose", 5), ("medium", 20), ("strict", 40)], "preset string, least int"))
    return rows.groupBy("preset", "p_type").agg(F.round(F.sum(F.when(F.col("p_size") >= F.col("least"), F.col("n")).otherwise(0)) / F.sum("n"), 6).alias("kept"))


@query("keyed_annotated_peaks", f"""SELECT f, round(effect, 6) AS effect, chr, "start", "end" FROM (SELECT l_suppkey AS f, avg(l_quantity) - 25 AS effect FROM lineitem GROUP BY 1) LEFT JOIN (SELECT * FROM {PEAKS} WHERE chr <> 'N') ON peak = f""")
def keyed_annotated_peaks(t):
    effects = t("lineitem").groupBy(F.col("l_suppkey").alias("f")).agg(F.round(F.avg("l_quantity") - 25, 6).alias("effect"))
    return effects.join(peaks(t).filter("chr <> 'N'").withColumnRenamed("peak", "f"), "f", "left").select("f", "effect", "chr", "start", "end")


@query("keyed_standardised_differences", """WITH x AS (SELECT p_type, (p_partkey % 100) / 100.0 AS score, p_size AS size, p_retailprice AS price FROM part), l AS (SELECT p_type, score, 'size' AS covariate, CAST(size AS DOUBLE) AS v FROM x UNION ALL SELECT p_type, score, 'price', price FROM x)
SELECT p_type, covariate, count(*) FILTER (score > 0.75) AS n_top, round((avg(v) FILTER (score > 0.75) - avg(v) FILTER (NOT score > 0.75)) / stddev_samp(v), 6) AS difference FROM l GROUP BY 1, 2""")
def keyed_standardised_differences(t):
    rows = t("part").select("p_type", (F.col("p_partkey") % 100 / 100.0).alias("score"), F.col("p_size").alias("size"), F.col("p_retailprice").alias("price"))
    return kd.standardised_differences(rows, ["p_type"], "score", ["size", "price"]).withColumns(r6("difference"))


@query("keyed_unpivoted_overlaps", f"""WITH n AS (SELECT p.peak % 7 AS trait, count(*) AS n_overlaps, count(DISTINCT p.peak) AS n_peaks FROM {PEAKS} p JOIN {FRAGMENTS} f ON f.chr = p.chr AND f."start" < p."end" AND p."start" < f."end" GROUP BY 1)
SELECT trait, 'n_overlaps' AS measure, n_overlaps AS value, n_overlaps >= 100 AS enough FROM n UNION ALL SELECT trait, 'n_peaks', n_peaks, n_overlaps >= 100 FROM n""")
def keyed_unpivoted_overlaps(t):
    return st.overlap_measures(fragments(t), peaks(t), 32, F.col("r_peak") % 7, 100)


@query("keyed_donor_counts", "SELECT c_nationkey AS donor, count(*) AS n FROM customer GROUP BY 1")
def keyed_donor_counts(t):
    return st.donor_counts(t("customer"), "c_nationkey")


@query("keyed_focal_coverage", f"""WITH s AS (SELECT cell % 4 AS focal, chr, unnest(["start", "end" - 1]) AS pos FROM {FRAGMENTS}), w AS (SELECT gene, chr, "start" - 50 AS lo, "end" + 50 AS hi, ascii(substr(gene, 8, 1)) % 4 AS focal FROM {GENES})
SELECT gene, CAST(floor((pos - lo) / 10) AS BIGINT) AS bin, count(*) AS n FROM w JOIN s ON s.chr = w.chr AND s.focal = w.focal AND pos >= lo AND pos < hi GROUP BY 1, 2""")
def keyed_focal_coverage(t):
    from ..operators.intervals import link_coverage

    windows = genes(t).select("gene", "chr", (F.col("start") - 50).alias("start"), (F.col("end") + 50).alias("end"), (F.ascii(F.substring("gene", 8, 1)) % 4).cast("bigint").alias("focal"))
    return link_coverage(fragments(t).withColumn("focal", F.col("cell") % 4), windows, "gene", "focal", 10)


@query("keyed_cohort_samples", "SELECT o_orderkey, o_custkey, o_orderpriority, o_totalprice FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000) AND o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_totalprice >= 100000")
def keyed_cohort_samples(t):
    cohort = t("customer").filter("c_acctbal > 5000").select(F.col("c_custkey").alias("o_custkey"))
    return st.cohort_samples(t("orders"), cohort, "o_custkey", "o_orderpriority", ["1-URGENT", "2-HIGH"], "o_totalprice", 100_000).select("o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice")
