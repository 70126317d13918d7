"""Profiles and partitioned heritability on line items, orders and embeddings."""

from pyspark.sql import functions as F

from ..operators import doublets as db
from ..operators import heritability as hr
from ..operators import matrix as mx
from ..operators import profiles as pf
from ..operators.models import block_crossproducts
from . import matrix_queries  # noqa: F401 - registers the SQL of residual variances
from .base import COUNTS, FRAGMENTS, GENES, ORACLE_SQL, PEAKS, counts, fragments, genes, peaks, query, r6
from .interval_queries import merged_sql, pieces_sql
from .table_queries import _VARIANTS, variants


def sites(t):
    return genes(t).select("chr", F.when(F.col("strand") == "-", F.col("end") - 1).otherwise(F.col("start")).alias("pos"))


@query("profile_start_sites", f"""WITH s AS (SELECT cell, chr, unnest(["start", "end" - 1]) AS p FROM {FRAGMENTS}), g AS (SELECT chr, CASE WHEN strand = '-' THEN "end" - 1 ELSE "start" END AS pos FROM {GENES}), n AS (SELECT cell, count(*) FILTER (abs(p - pos) <= 5) AS a, count(*) FILTER (abs(p - pos) > 40 AND abs(p - pos) <= 60) AS b FROM s JOIN g ON g.chr = s.chr AND abs(p - pos) <= 60 GROUP BY 1)
SELECT cell, coalesce(a, 0) AS n_centre, coalesce(b, 0) AS n_flank, round((coalesce(a, 0) / 11) / ((coalesce(b, 0) + 1) / 40), 6) AS enrichment FROM (SELECT DISTINCT cell FROM {FRAGMENTS}) LEFT JOIN n USING (cell)""")
def profile_start_sites(t):
    return pf.start_site_enrichment(fragments(t), sites(t), "cell", 5, (40, 60), 64).withColumns(r6("enrichment"))


@query("profile_nucleosomes", f"""SELECT cell, count(*) FILTER ("end" - "start" < 20) AS n_sub, count(*) FILTER ("end" - "start" >= 20 AND "end" - "start" < 40) AS n_mono, round(count(*) FILTER ("end" - "start" >= 20 AND "end" - "start" < 40) / nullif(count(*) FILTER ("end" - "start" < 20), 0), 6) AS ratio FROM {FRAGMENTS} GROUP BY 1""")
def profile_nucleosomes(t):
    return pf.nucleosome_ratio(fragments(t), "cell", 20).withColumns(r6("ratio"))


@query("profile_consensus_peaks")
def profile_consensus_peaks(t):
    day = F.datediff("l_shipdate", F.lit("1992-01-01")).cast("bigint")
    rows = t("lineitem").select(F.col("l_returnflag").alias("group"), (F.col("l_orderkey") % 2).alias("replicate"), F.concat(F.lit("c"), F.col("l_partkey") % 40).alias("chr"), day.alias("start"), (day + 6).alias("end"), F.col("l_extendedprice").alias("score"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("name"))
    sizes = t("lineitem").groupBy(F.col("l_returnflag").alias("group")).agg(F.countDistinct("l_suppkey").alias("n_cells"))
    return pf.consensus_peaks(rows.dropDuplicates(["name"]), "replicate", "score", "name", sizes, 5, 100_000, 500)


_CHOSEN = f"(SELECT feature, row_number() OVER (ORDER BY feature) - 1 AS place FROM (SELECT feature FROM ({ORACLE_SQL['matrix_residual_variance']}) ORDER BY variance DESC, feature LIMIT 40))"


def chosen(t):
    """The 40 features of greatest residual variance, in order."""
    from pyspark.sql import Window

    top = mx.residual_variance(counts(t)).orderBy(F.round("variance", 6).desc(), "feature").limit(40)
    return top.select("feature", (F.row_number().over(Window.orderBy("feature")) - 1).alias("place"))


@query("profile_residual_vectors", f"""WITH c AS {COUNTS}, d AS (SELECT cell, sum(count) AS d FROM c GROUP BY 1), f AS (SELECT feature, place, sum(count) AS f FROM c JOIN {_CHOSEN} USING (feature) GROUP BY 1, 2), x AS (SELECT d.cell, f.place, coalesce(count, 0) AS x, f * d / (SELECT sum(count) FROM c) AS mu, (SELECT count(*) FROM d) AS n FROM d CROSS JOIN f LEFT JOIN c ON c.cell = d.cell AND c.feature = f.feature)
SELECT cell AS id, CAST(place AS INTEGER) AS place, round(greatest(-sqrt(n), least(sqrt(n), (x - mu) / sqrt(mu + mu * mu / 100))), 6) AS z FROM x""")
def profile_residual_vectors(t):
    return pf.residual_vectors(counts(t), chosen(t)).select("id", F.posexplode("vector").alias("place", "z")).withColumns(r6("z"))


@query("profile_components")
def profile_components(t):
    return pf.principal_components(pf.residual_vectors(counts(t), chosen(t)), 5)[0]


@query("profile_embedding_components")
def profile_embedding_components(t):
    return pf.principal_components(pf.residual_vectors(counts(t), chosen(t)), 5)[1]


@query("profile_loading_groups")
def profile_loading_groups(t):
    """Features grouped by their loadings scaled by the singular values."""
    from ..operators.links import lloyd

    axes = pf.principal_components(pf.residual_vectors(counts(t), chosen(t)), 4)[0]
    vectors = axes.groupBy(F.col("place").alias("id")).agg(F.transform(F.array_sort(F.collect_list(F.struct("component", (F.col("loading") * F.col("singular")).alias("x")))), lambda e: e["x"]).alias("vector")).withColumn("cell_group", F.lit(0))
    return lloyd(vectors, vectors.select("cell_group").distinct().withColumn("k", F.lit(4))).select(F.col("id").alias("place"), "state")


@query("profile_doublets")
def profile_doublets(t):
    return pf.doublet_scores(t("embeddings").select(F.col("vec_id").cast("bigint").alias("id"), F.col("embedding").cast("array<double>").alias("vector")), 10)


@query("profile_classified_doublets")
def profile_classified_doublets(t):
    """Depth: the summed size of a vector's entries."""
    v = t("embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vector"))
    cells = v.withColumn("depth", F.aggregate("vector", F.lit(0.0), lambda a, x: a + F.abs(x)))
    return db.called_doublets(db.classified_doublets(cells, 10, 8, trees=10), 0.1)


@query("profile_lifted", f"""WITH b AS (SELECT chr, "start" AS s, "start" + 70 AS e, concat('x', chr) AS to_chr, "start" * 2 + 5 AS to_start FROM {GENES}) SELECT to_chr AS chr, greatest("start", s) + to_start - s AS "start", least("end", e) + to_start - s AS "end", peak FROM {PEAKS} p JOIN b ON b.chr = p.chr AND "start" < e AND s < "end" """)
def profile_lifted(t):
    blocks = genes(t).select("chr", "start", (F.col("start") + 70).alias("end"), F.concat(F.lit("x"), "chr").alias("to_chr"), (F.col("start") * 2 + 5).alias("to_start"))
    return pf.lifted(peaks(t).select("chr", "start", "end", "peak"), blocks, 64)


@query("profile_named_ids", "SELECT n_name, n_nationkey FROM nation WHERE n_regionkey < 3")
def profile_named_ids(t):
    return pf.named_ids(t("nation").filter("n_regionkey < 3").select("n_name"), t("nation"), "n_name", "n_nationkey")


_ASSOC = "(SELECT s AS stratum, c_acctbal AS v, c_custkey AS x, c_mktsegment AS label FROM customer, unnest(['all', CAST(c_nationkey AS VARCHAR)]) u(s))"


@query("profile_associations", f"""WITH r AS (SELECT stratum, rank() OVER (PARTITION BY stratum ORDER BY v) + (count(*) OVER (PARTITION BY stratum, v) - 1) / 2 AS a, rank() OVER (PARTITION BY stratum ORDER BY x) AS b FROM {_ASSOC}), s AS (SELECT stratum, 'c_custkey' AS variable, 'spearman' AS kind, count(*) AS n, corr(a, b) AS e FROM r GROUP BY 1),
g AS (SELECT stratum, label, count(*) AS k, avg(v) AS m, var_pop(v) AS w FROM {_ASSOC} GROUP BY 1, 2), t AS (SELECT stratum, sum(k) AS n, sum(k * m * m) - sum(k * m) * sum(k * m) / sum(k) AS b, sum(k * w) AS w FROM g GROUP BY 1), u AS (SELECT * FROM s UNION ALL SELECT stratum, 'c_mktsegment', 'eta2', CAST(n AS BIGINT), b / (b + w) FROM t)
SELECT stratum, variable, kind, n, CASE WHEN n >= 5 THEN round(e, 6) END AS estimate, CASE WHEN n < 5 THEN 'few_rows' ELSE 'ok' END AS status FROM u""")
def profile_associations(t):
    return pf.association_summary(t("customer"), "c_acctbal", ["c_custkey"], ["c_mktsegment"], "c_nationkey", 5).withColumns(r6("estimate"))


@query("profile_trend", "WITH p AS (SELECT p_type, p_size, p_retailprice, (rank() OVER (PARTITION BY p_type ORDER BY p_size) + (count(*) OVER (PARTITION BY p_type, p_size) - 1) / 2) / count(*) OVER (PARTITION BY p_type) AS pct FROM part) SELECT p_type, CAST(least(ceil(pct * 10) - 1, 9) AS BIGINT) AS bin, count(*) AS n, round(avg(p_size), 6) AS x, round(avg(p_retailprice), 4) AS y FROM p GROUP BY 1, 2")
def profile_trend(t):
    return pf.binned_trend(t("part"), "p_size", "p_retailprice", ["p_type"], 10).withColumns({"x": F.round("x", 6), "y": F.round("y", 4)})


@query("profile_locus_details", f"""WITH v AS (SELECT * FROM {_VARIANTS} WHERE locus % 10 = 3), s AS (SELECT locus, chr, min("start") - 25 AS lo, max("end") + 25 AS hi FROM v GROUP BY 1, 2) SELECT locus, 'variant' AS kind, CAST(variant AS VARCHAR) AS name, "start", "end" FROM v UNION ALL SELECT locus, 'peak', CAST(peak AS VARCHAR), "start", "end" FROM {PEAKS} p JOIN s ON s.chr = p.chr AND "start" < hi AND lo < "end" """)
def profile_locus_details(t):
    return pf.locus_details(variants(t), t("supplier").filter("s_suppkey % 10 = 3").select(F.col("s_suppkey").alias("locus")), peaks(t), 25, 512)


@query("heritability_pieces", f"""SELECT q.chr, q."start", q."end", max(p.score) AS score FROM {pieces_sql(PEAKS)} q JOIN {PEAKS} p ON p.chr = q.chr AND p."start" < q."end" AND q."start" < p."end" GROUP BY 1, 2, 3""")
def heritability_pieces(t):
    return hr.greatest_over_pieces(peaks(t), "score", 64)


@query("heritability_top_share", "SELECT p_type, p_partkey, p_size FROM (SELECT *, coalesce(sum(p_size) OVER (PARTITION BY p_type ORDER BY p_retailprice DESC, p_partkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b, sum(p_size) OVER (PARTITION BY p_type) AS t FROM part) WHERE b < 0.3 * t")
def heritability_top_share(t):
    return hr.top_share(t("part"), "p_type", "p_retailprice", "p_size", 0.3, "p_partkey").select("p_type", "p_partkey", "p_size")


@query("heritability_unfilled", "SELECT a.c_mktsegment, string_agg(CAST(n_nationkey AS VARCHAR), ',' ORDER BY CAST(n_nationkey AS VARCHAR)) AS missing FROM (SELECT DISTINCT c_mktsegment FROM customer) a CROSS JOIN nation WHERE (c_mktsegment, n_nationkey) NOT IN (SELECT (c_mktsegment, c_nationkey) FROM customer WHERE c_acctbal > 8000) GROUP BY 1")
def heritability_unfilled(t):
    wanted = t("customer").select("c_mktsegment").distinct().join(F.broadcast(t("nation").select(F.col("n_nationkey").alias("c_nationkey"))))
    return hr.unfilled(t("customer").filter("c_acctbal > 8000"), wanted, ["c_mktsegment", "c_nationkey"])


def blocks(t):
    rows = t("orders").select("o_orderkey", (F.col("o_custkey") / 1000.0).alias("x"), (F.col("o_orderkey") % 97 / 97.0).alias("w"), (F.col("o_totalprice") / 1e5).alias("y"))
    return block_crossproducts(rows, ["o_orderkey"], "y", ["x", "w"], 20)


_REG = "(SELECT o_custkey / 1000.0 AS x, (o_orderkey % 97) / 97.0 AS w, o_totalprice / 1e5 AS y FROM orders)"


@query("heritability_models", f"SELECT 'x' AS model, CAST(t AS INTEGER) AS term, round(CASE t WHEN 0 THEN regr_intercept(y, x) ELSE regr_slope(y, x) END, 6) AS estimate FROM {_REG}, unnest([0, 1]) u(t) GROUP BY t UNION ALL SELECT 'w', CAST(t AS INTEGER), round(CASE t WHEN 0 THEN regr_intercept(y, w) ELSE regr_slope(y, w) END, 6) FROM {_REG}, unnest([0, 2]) u(t) GROUP BY t")
def heritability_models(t):
    return hr.fit_models(blocks(t), {"x": [0, 1], "w": [0, 2]}, 3).select("model", "term", F.round("estimate", 6).alias("estimate"))


@query("heritability_joint_models")
def heritability_joint_models(t):
    fits = hr.fit_models(blocks(t), {"x": [0, 1], "w": [0, 2], "both": [0, 1, 2]}, 3, without=2)
    spreads = t("orders").agg(F.stddev_samp(F.col("o_custkey") / 1000.0).alias("a"), F.stddev_samp(F.col("o_orderkey") % 97 / 97.0).alias("b")).select(F.inline(F.array(F.struct(F.lit(1).alias("term"), F.col("a").alias("sd")), F.struct(F.lit(2).alias("term"), F.col("b").alias("sd")))))
    return hr.standardised_effects(fits.filter("term > 0"), spreads, 2.0)


@query("heritability_shares")
def heritability_shares(t):
    return hr.share_jackknife(blocks(t), {"first": [10, 5, 0], "second": [10, 2, 8]}, [100, 40, 50], 3)


_RANGES = f"(SELECT chr, \"start\", \"end\" + 20 AS \"end\", concat('a', peak % 3) AS annotation FROM {PEAKS})"
_INSIDE = f"""(WITH h AS (SELECT DISTINCT annotation, locus, variant, pip FROM {_VARIANTS} v JOIN {_RANGES} r ON r.chr = v.chr AND v."start" < r."end" AND r."start" < v."end"), i AS (SELECT annotation, locus, sum(pip) AS i FROM h GROUP BY 1, 2), t AS (SELECT locus, sum(pip) AS total FROM {_VARIANTS} GROUP BY 1)
SELECT a.annotation, t.locus, coalesce(i, 0) AS inside, total FROM t CROSS JOIN (SELECT DISTINCT annotation FROM {_RANGES}) a LEFT JOIN i ON i.annotation = a.annotation AND i.locus = t.locus)"""


def ranges(t):
    return peaks(t).select("chr", "start", (F.col("end") + 20).alias("end"), F.concat(F.lit("a"), F.col("peak") % 3).alias("annotation"))


@query("heritability_mass_inside", f"SELECT annotation, locus, round(inside, 4) AS inside, round(total, 4) AS total FROM {_INSIDE}")
def heritability_mass_inside(t):
    return hr.mass_inside(variants(t), ranges(t), 64).withColumns({"inside": F.round("inside", 4), "total": F.round("total", 4)})


@query("heritability_locus_contributions", f"SELECT annotation, locus, round(inside / sum_total, 6) AS contribution, lead FROM (SELECT *, sum(total) OVER (PARTITION BY annotation) AS sum_total FROM {_INSIDE}) JOIN (SELECT locus, first(variant ORDER BY pip DESC, variant) AS lead FROM {_VARIANTS} GROUP BY 1) USING (locus) WHERE inside > 0")
def heritability_locus_contributions(t):
    return hr.locus_contributions(hr.mass_inside(variants(t), ranges(t), 64), variants(t)).withColumns(r6("contribution"))


def loci(t):
    """Loci of suppliers by chromosome-like parts, so that they are apart from each other."""
    return variants(t).withColumn("chr", F.concat("chr", F.col("locus") % 11)).withColumn("locus", F.concat_ws(":", "locus", "chr", F.floor(F.col("start") / 200)))


@query("heritability_islands", f"""WITH v AS (SELECT concat(chr, locus % 11) AS chr, "start", "end", concat_ws(':', locus, concat(chr, locus % 11), CAST(floor("start" / 200) AS BIGINT)) AS locus FROM {_VARIANTS}), s AS (SELECT chr, locus, min("start") AS "start", max("end") AS "end" FROM v GROUP BY 1, 2), m AS (SELECT * FROM {merged_sql('s', gap=10)}) SELECT locus, concat_ws(':', m.chr, m."start") AS island FROM s JOIN m ON m.chr = s.chr AND s."start" < m."end" AND m."start" < s."end" """)
def heritability_islands(t):
    return hr.merged_loci(loci(t), "locus", 10)


@query("heritability_mass_shares")
def heritability_mass_shares(t):
    v = loci(t).withColumn("chr", F.substring("chr", 1, 1))
    sizes = ranges(t).groupBy("annotation").agg((F.count(F.lit(1)) / 300.0).alias("size"))
    return hr.enrichment(hr.mass_shares(hr.mass_inside(v, ranges(t), 64), hr.merged_loci(loci(t), "locus", 10), 50), sizes, ["annotation"])
