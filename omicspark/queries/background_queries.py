"""Backgrounds of deviations on line items: features = parts, cells = suppliers, annotations = part types."""

from pyspark.sql import functions as F

from ..operators import attribution as at
from ..operators import background as bg
from ..operators import enrichment as en
from ..operators import labels as lb
from .base import COUNTS, PEAKS, counts, peaks, query, r6
from .matrix_queries import sets

_BINS = f"(SELECT feature, CAST((ntile(3) OVER (ORDER BY s, feature) - 1) * 3 + ntile(3) OVER (ORDER BY p_retailprice, feature) - 1 AS BIGINT) AS bin, s / 1000.0 AS expected FROM (SELECT feature, sum(count) AS s FROM {COUNTS} GROUP BY 1) JOIN part ON p_partkey = feature)"
_WEIGHTS = "(SELECT p_type AS annotation, p_partkey AS feature, p_size / 10.0 AS weight FROM part WHERE p_size <= 10)"
_MOMENTS = f"(SELECT bin, cell, sum(count) / any_value(n) AS mean, sum(count * count) / any_value(n) - (sum(count) / any_value(n)) * (sum(count) / any_value(n)) AS var FROM {COUNTS} JOIN {_BINS} USING (feature) JOIN (SELECT bin, count(*) AS n FROM {_BINS} GROUP BY 1) USING (bin) GROUP BY 1, 2)"


def bins(t):
    from ..operators.matrix import background_bins

    rows = counts(t).groupBy("feature").agg(F.sum("count").alias("s")).join(t("part").select(F.col("p_partkey").alias("feature"), "p_retailprice"), "feature")
    return background_bins(rows, "s", "p_retailprice", 3).select("feature", "bin", (F.col("s") / 1000.0).alias("expected"))


def weights(t):
    return t("part").filter("p_size <= 10").select(F.col("p_type").alias("annotation"), F.col("p_partkey").alias("feature"), (F.col("p_size") / 10.0).alias("weight"))


@query("background_counted_features", f"SELECT feature, CAST(sum(count) AS BIGINT) AS total, round((length(any_value(p_name)) - length(translate(upper(any_value(p_name)), 'GC', ''))) / length(any_value(p_name)), 6) AS gc FROM {COUNTS} JOIN part ON p_partkey = feature GROUP BY 1 HAVING sum(count) > 0")
def background_counted_features(t):
    return bg.counted_features(counts(t), t("part").select(F.col("p_partkey").alias("feature"), F.col("p_name").alias("sequence"))).withColumns(r6("gc"))


@query("background_bin_moments", f"SELECT bin, cell, round(mean, 6) AS mean, round(var, 6) AS var FROM {_MOMENTS}")
def background_bin_moments(t):
    return bg.bin_moments(counts(t), bins(t)).withColumns(r6("mean", "var"))


_Z = f"""(WITH o AS (SELECT cell, annotation, sum(count * weight) AS o FROM {COUNTS} JOIN {_WEIGHTS} USING (feature) GROUP BY 1, 2), w AS (SELECT annotation, bin, sum(weight) AS w1, sum(weight * weight) AS w2 FROM {_WEIGHTS} JOIN {_BINS} USING (feature) GROUP BY 1, 2), b AS (SELECT cell, annotation, sum(w1 * mean) AS m, sum(w2 * var) AS v FROM {_MOMENTS} JOIN w USING (bin) GROUP BY 1, 2),
e AS (SELECT annotation, sum(weight * expected) AS e FROM {_WEIGHTS} JOIN {_BINS} USING (feature) GROUP BY 1), d AS (SELECT cell, sum(count) AS d FROM {COUNTS} GROUP BY 1)
SELECT cell, annotation, (coalesce(o, 0) - coalesce(m, 0)) / (e * d / (SELECT sum(expected) FROM {_BINS})) AS deviation, CASE WHEN v > 0 THEN (coalesce(o, 0) - m) / sqrt(v) END AS z FROM d CROSS JOIN e LEFT JOIN o USING (cell, annotation) LEFT JOIN b USING (cell, annotation))"""


@query("background_deviation_z", f"SELECT cell, annotation, round(deviation, 6) AS deviation, round(z, 6) AS z FROM {_Z}")
def background_deviation_z(t):
    return bg.deviation_z(counts(t), weights(t), bins(t)).withColumns(r6("deviation", "z"))


@query("background_variability", f"SELECT annotation, count(z) AS n, round(stddev_samp(z), 6) AS variability FROM {_Z} GROUP BY 1")
def background_variability(t):
    return bg.variability(bg.deviation_z(counts(t), weights(t), bins(t))).select("annotation", "n", F.round("variability", 6).alias("variability"))


@query("background_variability_tails")
def background_variability_tails(t):
    return bg.variability(bg.deviation_z(counts(t), weights(t), bins(t)))


@query("background_trait_z", f"""SELECT trait, cell, round(z, 6) AS z FROM (SELECT annotation AS trait, cell, z FROM {_Z.replace(_WEIGHTS, "(SELECT concat('t', l_partkey % 7) AS annotation, l_partkey AS feature, least(1, sum(l_discount)) AS weight FROM lineitem GROUP BY 1, 2)")})""")
def background_trait_z(t):
    traits = t("lineitem").groupBy(F.concat(F.lit("t"), F.col("l_partkey") % 7).alias("annotation"), F.col("l_partkey").alias("feature")).agg(F.least(F.lit(1.0), F.sum("l_discount")).alias("weight"))
    return bg.deviation_z(counts(t), traits, bins(t)).select(F.col("annotation").alias("trait"), "cell", F.round("z", 6).alias("z"))


@query("background_grouped_expectation", f"SELECT feature, round(sum(count / d) / (SELECT count(DISTINCT cell) FROM {COUNTS}), 9) AS expected FROM {COUNTS} JOIN (SELECT cell, sum(count) AS d FROM {COUNTS} GROUP BY 1) USING (cell) GROUP BY 1")
def background_grouped_expectation(t):
    return bg.grouped_expectation(counts(t), equal=True).withColumn("expected", F.round("expected", 9))


_GROUPED = "(SELECT l_partkey AS feature, l_returnflag AS cell, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS count FROM lineitem GROUP BY 1, 2)"


def grouped(t):
    return t("lineitem").groupBy(F.col("l_partkey").alias("feature"), F.col("l_returnflag").alias("cell")).agg(F.sum(F.col("l_quantity").cast("bigint")).alias("count"))


@query("background_peak_contributions", f"""WITH c AS {_GROUPED}, b AS {_BINS}, m AS {_MOMENTS.replace(COUNTS, _GROUPED)}, d AS (SELECT cell, sum(count) AS d FROM c GROUP BY 1), e AS (SELECT annotation, sum(weight * expected) AS e FROM {_WEIGHTS} JOIN b USING (feature) GROUP BY 1),
p AS (SELECT annotation, feature, d.cell, weight * (coalesce(count, 0) - coalesce(mean, 0)) / (e * d / (SELECT sum(expected) FROM b)) AS contribution FROM {_WEIGHTS} JOIN b USING (feature) JOIN e USING (annotation) CROSS JOIN d LEFT JOIN c ON c.feature = b.feature AND c.cell = d.cell LEFT JOIN m ON m.bin = b.bin AND m.cell = d.cell),
v AS (SELECT annotation, cell, sum(contribution) AS deviation FROM p GROUP BY 1, 2), s AS (SELECT annotation, stddev_samp(deviation) AS sd FROM v GROUP BY 1)
SELECT annotation, feature, cell, round(contribution, 6) AS contribution, round(deviation, 6) AS deviation, round((contribution - avg(contribution) OVER (PARTITION BY annotation, feature)) / sd, 6) AS relative FROM p JOIN v USING (annotation, cell) JOIN s USING (annotation)""".replace(_BINS.replace(COUNTS, _GROUPED), "b"))
def background_peak_contributions(t):
    return bg.peak_contributions(grouped(t), weights(t), bins(t)).withColumns(r6("contribution", "deviation", "relative"))


def cells(t):
    return t("supplier").select(F.col("s_suppkey").alias("cell"), (F.col("s_nationkey") % 5).alias("sample"))


@query("background_reference_features", f"""WITH n AS (SELECT count(*) AS n FROM supplier), d AS (SELECT cell, sum(count) AS d FROM {COUNTS} GROUP BY 1)
SELECT feature, round(ln(1 + sum(count * 1e4 / d) / (SELECT n FROM n)), 6) AS abundance, round(count(*) / (SELECT n FROM n), 6) AS detection FROM {COUNTS} JOIN d USING (cell) GROUP BY 1""")
def background_reference_features(t):
    return bg.reference_features(counts(t), cells(t), 1_000_000).withColumns(r6("abundance", "detection"))  # all cells, so that SQL gives the same


@query("background_control_neighbours", f"""WITH n AS (SELECT count(*) AS n FROM supplier), d AS (SELECT cell, sum(count) AS d FROM {COUNTS} GROUP BY 1),
r AS (SELECT feature, round(ln(1 + sum(count * 1e4 / d) / (SELECT n FROM n)), 3) AS a, round(count(*) / (SELECT n FROM n), 6) AS b FROM {COUNTS} JOIN d USING (cell) GROUP BY 1), s AS (SELECT stddev_samp(a) AS sa, stddev_samp(b) AS sb FROM r), m AS (SELECT p_partkey AS feature FROM part WHERE p_size <= 3)
SELECT feature, control, CAST(place AS INTEGER) AS place FROM (SELECT x.feature, y.feature AS control, row_number() OVER (PARTITION BY x.feature ORDER BY round(pow((x.a - y.a) / sa, 2) + pow((x.b - y.b) / sb, 2), 12), y.feature) - 1 AS place FROM r x JOIN m ON m.feature = x.feature CROSS JOIN s JOIN r y ON y.feature NOT IN (SELECT feature FROM m)) WHERE place < 20""")
def background_control_neighbours(t):
    """The features from which controls are drawn; abundances of all cells, rounded, so that SQL meets the same ties."""
    reference = bg.reference_features(counts(t), cells(t), 1_000_000).withColumns({"abundance": F.round("abundance", 3), "detection": F.round("detection", 6)})
    return bg.nearest_features(reference, sets(t), 20)


@query("background_matched_controls")
def background_matched_controls(t):
    return bg.matched_controls(bg.reference_features(counts(t), cells(t)), sets(t), 99, 20)


@query("background_control_evidence")
def background_control_evidence(t):
    """Scores of marker sets in groups of cells next to those of their drawn controls: the whole chain."""
    rows, groups = counts(t), t("supplier").select(F.col("s_suppkey").alias("cell"), (F.col("s_nationkey") % 4).alias("cluster"))
    sums = rows.join(groups, "cell").groupBy("cluster", "feature").agg(F.sum("count").alias("count")).withColumnRenamed("cluster", "cell")
    n = rows.select("feature").distinct().count()
    gaps = sums.withColumnRenamed("cell", "cluster")
    from pyspark.sql import Window

    w = Window.partitionBy("cluster").orderBy(F.col("count").desc())
    gaps = gaps.withColumn("r", F.rank().over(w)).select("cluster", "feature", (1 - F.least(F.col("r"), F.lit(300)) / 300).alias("gap"))
    controls = bg.control_scores(gaps, bg.matched_controls(bg.reference_features(rows, cells(t)), sets(t), 99, 20), 300)
    observed = lb.rank_scores(sums, sets(t), n, 300).withColumnRenamed("cell", "cluster")
    return lb.control_evidence(observed, controls.select("cluster", "label", "control"), ["cluster", "label"])


def blocks(t):
    return peaks(t).select(F.col("peak").alias("block"), "chr", "start", "end")


def forbidden(t):
    return peaks(t).filter("peak % 6 = 0").select("chr", (F.col("start") + 40).alias("start"), (F.col("start") + 60).alias("end"))


@query("background_allowed_offsets", f"""WITH b AS (SELECT peak AS block, chr, "start" AS s, "end" AS e FROM {PEAKS}), f AS (SELECT chr, "start" + 40 AS fs, "start" + 60 AS fe FROM {PEAKS} WHERE peak % 6 = 0), o AS (SELECT block, chr, s, e, k FROM b, unnest(range(-300, 301)) u(k) WHERE abs(k) >= 50 AND s + k >= 0 AND e + k <= 2600)
SELECT block, count(*) AS n, min(k) AS least, max(k) AS most, CAST(sum(k) AS BIGINT) AS total FROM o WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.chr = o.chr AND fs < e + k AND s + k < fe) GROUP BY 1""")
def background_allowed_offsets(t):
    sizes = peaks(t).select("chr").distinct().withColumn("size", F.lit(2600))
    pieces = bg.allowed_offsets(blocks(t), forbidden(t), sizes, (50, 300))
    return pieces.groupBy("block").agg(F.sum(F.col("hi") - F.col("lo")).alias("n"), F.min("lo").alias("least"), F.max(F.col("hi") - 1).alias("most"), F.sum((F.col("hi") - F.col("lo")) * (F.col("lo") + F.col("hi") - 1) / 2).cast("bigint").alias("total"))


@query("background_shift_offsets")
def background_shift_offsets(t):
    sizes = peaks(t).select("chr").distinct().withColumn("size", F.lit(2600))
    return bg.shift_offsets(blocks(t), forbidden(t), sizes, 25, (50, 300))


@query("background_shifted_z")
def background_shifted_z(t):
    """z of observed overlap scores against those of shifted loci."""
    sizes = peaks(t).select("chr").distinct().withColumn("size", F.lit(2600))
    offsets = bg.shift_offsets(blocks(t), forbidden(t), sizes, 25, (50, 300))
    variants = blocks(t).select("block", "chr", (F.col("start") + 2).alias("start"), F.lit(1.0).alias("weight"))
    values = t("lineitem").groupBy(F.col("l_suppkey").alias("peak"), F.col("l_returnflag").alias("group")).agg(F.avg("l_discount").alias("value"))
    still = offsets.select("block").distinct().withColumns({"draw": F.lit(0), "shift": F.lit(0).cast("bigint")})
    observed = bg.shifted_scores(variants, still, peaks(t), values, 64).select("group", F.col("draw_score").alias("observed"))
    draws = bg.shifted_scores(variants, offsets, peaks(t), values, 64).select("group", F.col("draw_score").alias("draw"))
    return en.empirical_null(draws, observed, ["group"])


_LIKELIHOOD = f"""(WITH c AS {_GROUPED}, r AS (SELECT cell, sum(count) AS reads FROM c GROUP BY 1), s AS (SELECT l_returnflag AS cell, count(DISTINCT l_suppkey) AS n FROM lineitem GROUP BY 1), w AS (SELECT sum(reads) AS a, 50 * sum(reads) / sum(n) AS prior FROM r JOIN s USING (cell)), f AS (SELECT feature, sum(count) AS f FROM c GROUP BY 1)
SELECT f.feature, r.cell AS "group", (coalesce(count, 0) + prior * f / a) / (reads + prior) AS likelihood FROM f CROSS JOIN r CROSS JOIN w LEFT JOIN c ON c.feature = f.feature AND c.cell = r.cell UNION ALL SELECT feature, 'background', 1.0 / 2000 FROM f)"""


def likelihood(t):
    support = t("lineitem").groupBy(F.col("l_returnflag").alias("group")).agg(F.countDistinct("l_suppkey").alias("n_cells"))
    return bg.attribution_likelihood(grouped(t), support, 2000)


@query("background_attribution_likelihood", f"""SELECT feature, "group", round(likelihood, 9) AS likelihood FROM {_LIKELIHOOD}""")
def background_attribution_likelihood(t):
    return likelihood(t).withColumn("likelihood", F.round("likelihood", 9))


_PAIRS = "(SELECT l_suppkey AS locus, l_partkey AS feature, sum(l_discount) AS mass FROM lineitem GROUP BY 1, 2)"


@query("background_locus_shares", f"""WITH p AS (SELECT locus, "group", sum(mass * likelihood / t) AS p FROM (SELECT *, sum(likelihood) OVER (PARTITION BY locus, feature) AS t FROM {_PAIRS} JOIN {_LIKELIHOOD} USING (feature)) GROUP BY 1, 2) SELECT locus, "group", round(p / sum(p) OVER (PARTITION BY locus), 6) AS share FROM p""")
def background_locus_shares(t):
    pairs = t("lineitem").groupBy(F.col("l_suppkey").alias("locus"), F.col("l_partkey").alias("feature")).agg(F.sum("l_discount").alias("mass"))
    return bg.locus_shares(pairs, likelihood(t)).withColumns(r6("share"))


@query("background_folds", f"SELECT peak, chr, CASE chr WHEN 'A' THEN 1 WHEN 'N' THEN 0 ELSE 1 END AS fold FROM {PEAKS}")
def background_folds(t):
    return bg.held_out_folds(peaks(t).select("peak", "chr"), "chr", 2).select("peak", "chr", F.col("fold").cast("int").alias("fold"))


def _sequence():
    return F.translate(F.md5(F.col("p_partkey").cast("string").cast("binary")), "0123456789abcdef", "ACGTACGTACGTACGT")


@query("background_motif_matches")
def background_motif_matches(t):
    import numpy as np

    from ..operators.learners import scan_motifs

    motifs = {"GATA": np.array([[1, 9, 1, 9], [1, 1, 1, 1], [9, 1, 1, 1], [1, 1, 9, 1]], float), "CACC": np.array([[1, 9, 1, 1], [9, 1, 9, 9], [1, 1, 1, 1], [1, 1, 1, 1]], float)}
    return scan_motifs(t("part").select("p_partkey", _sequence().alias("sequence")), motifs, "p_partkey", "sequence")


@query("background_attribution_weights")
def background_attribution_weights(t):
    """Weights of the groups behind line items with a discount, by a prior that held-out brands choose."""
    rows = t("lineitem").filter("l_discount > 0").join(t("part"), F.col("p_partkey") == F.col("l_partkey"))
    own = rows.groupBy(F.col("l_suppkey").alias("locus"), F.col("l_partkey").alias("feature"), F.col("p_brand").alias("chr")).agg(F.sum("l_discount").alias("mass"))
    bins = t("part").select(F.col("p_partkey").alias("feature"), (F.col("p_size") % 10).alias("bin"))
    return at.weight_table(at.attributed(own, likelihood(t), bins, draws=3), own)
