"""Sparse count matrices as (feature, cell, count) rows: group sums, normalisation, marker tests, deviations."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ranks import add_bh
from .loops import cut


def group_sums(counts: DataFrame, groups: DataFrame, by: Sequence[str], key: str = "cell", value: str = "count") -> DataFrame:
    """Counts summed per (by...) after joining cells or features to their groups; zero sums are dropped."""
    return counts.join(groups, key).groupBy(*by).agg(F.sum(value).alias(value)).filter(F.col(value) != 0)


def depth(counts: DataFrame, by: str, value: str = "count") -> DataFrame:
    """Total, detected features, their ratio and log10 total per sample."""
    rows = counts.groupBy(by).agg(F.sum(value).alias("n_counts"), F.count_if(F.col(value) > 0).alias("n_features"))
    return rows.withColumns({"per_feature": F.col("n_counts") / F.col("n_features"), "log10_counts": F.log10("n_counts")})


def split_sample_key(key: Column) -> tuple[Column, Column]:
    """Cluster and donor of `<cluster>_<donor>`, cut at the last underscore."""
    pattern = r"^(.+)_([^_]+)$"
    return F.regexp_extract(key, pattern, 1), F.regexp_extract(key, pattern, 2)


def per_ten_thousand(counts: DataFrame, scale: float = 1e4, cell: str = "cell", value: str = "count") -> DataFrame:
    """counts with `norm`: value per `scale` of its cell; cells without counts get 0."""
    return counts.withColumn("norm", F.col(value) * scale / F.greatest(F.sum(value).over(Window.partitionBy(cell)), F.lit(1)))


def log_cpm(value: Column, total: Column, scale: float = 1e6) -> Column:
    return F.log1p(value * scale / total)


def specificity(counts: DataFrame, least: int = 0, least_share: float = 0.0) -> DataFrame:
    """(feature, cell, share): depth-normalised value over its sum across groups; entries below the minimum count or share are 0."""
    total = F.sum("count").over(Window.partitionBy("cell"))
    own = F.when((F.col("count") >= least) & (F.col("count") / total >= least_share), F.col("count") / total).otherwise(F.lit(0.0))
    every = F.sum("own").over(Window.partitionBy("feature"))
    return counts.withColumn("own", own).withColumn("every", every).filter("every > 0").select("feature", "cell", (F.col("own") / F.col("every")).alias("share"))


def tf_idf(counts: DataFrame, scale: float = 1e4) -> DataFrame:
    """(feature, cell, value): log1p(scale x term frequency x cells / cells with the feature)."""
    n = counts.agg(F.countDistinct("cell").alias("n"))
    found = counts.groupBy("feature").agg(F.countDistinct("cell").alias("df"))
    rows = counts.withColumn("tf", F.col("count") / F.sum("count").over(Window.partitionBy("cell"))).join(found, "feature").join(F.broadcast(n))
    return rows.select("feature", "cell", F.log1p(scale * F.col("tf") * F.col("n") / F.col("df")).alias("value"))


#: Features, and distinct cell totals, that meet in one step.
BLOCK = 2_048
#: Bins of values, in which ranks are taken, for each doubling.
BINS_PER_DOUBLING = 16


def _as_zeros(feats: DataFrame, margins: DataFrame, grand: float, n: int, theta: float) -> DataFrame:
    """(feature, s, ss): sums of residuals and of their squares if all counts were zero. Blocks of features meet blocks of the distinct cell
    totals (total, m: how many cells) as matrices; what leaves a meeting is two numbers a feature."""
    nf, nm = (max(1, -(-df.count() // BLOCK)) for df in (feats, margins))
    f = feats.groupBy(F.pmod(F.xxhash64("feature"), F.lit(nf)).alias("fb")).agg(F.collect_list("feature").alias("features"), F.collect_list(F.col("f_total").cast("double")).alias("f"))
    m = margins.groupBy(F.pmod(F.xxhash64("total"), F.lit(nm)).cast("int").alias("mb")).agg(F.collect_list(F.col("total").cast("double")).alias("t"), F.collect_list(F.col("m").cast("double")).alias("m"))
    pairs = f.withColumn("mb", F.explode(F.sequence(F.lit(0), F.lit(nm - 1)))).join(m, "mb").select("features", "f", "t", "m")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                ids = batch.column(0).slice(i, 1).flatten()
                totals, t, weight = (batch.column(c).slice(i, 1).flatten().to_numpy() for c in (1, 2, 3))
                mu = np.outer(totals, t) / grand
                z = np.maximum(-mu / np.sqrt(mu + mu * mu / theta), -np.sqrt(n))
                yield pa.RecordBatch.from_arrays([ids, pa.array(z @ weight), pa.array((z * z) @ weight)], names=["feature", "s", "ss"])

    found = pairs.mapInArrow(meet, f"feature {feats.schema['feature'].dataType.simpleString()}, s double, ss double")
    return found.groupBy("feature").agg(F.sum("s").alias("s"), F.sum("ss").alias("ss"))


def residual_variance(counts: DataFrame, theta: float = 100.0) -> DataFrame:
    """(feature, variance) of analytic Pearson residuals over all cells, zeros included, clipped at sqrt(number of cells).

    A zero's residual depends on both margins, so zeros are summed over the distinct cell totals, which are few next to cells; counts
    then add what they have beyond a zero.
    """
    cells = cut(counts.groupBy("cell").agg(F.sum("count").alias("total")))
    feats = cut(counts.groupBy("feature").agg(F.sum("count").alias("f_total")))
    grand, n = cells.agg(F.sum("total"), F.count(F.lit(1))).first()
    if not n:
        return feats.select("feature", F.lit(0.0).alias("variance"))
    mu, clip = F.col("f_total") * F.col("total") / float(grand), float(n) ** 0.5
    z = lambda x: F.greatest(F.lit(-clip), F.least(F.lit(clip), (x - mu) / F.sqrt(mu + mu * mu / theta)))
    zeros = _as_zeros(feats, cells.groupBy("total").agg(F.count(F.lit(1)).alias("m")), float(grand), n, theta)
    seen = counts.join(cells, "cell").join(feats, "feature").withColumns({"z": z(F.col("count")), "z0": z(F.lit(0.0))})
    extra = seen.groupBy("feature").agg(F.sum(F.col("z") - F.col("z0")).alias("ds"), F.sum(F.col("z") * F.col("z") - F.col("z0") * F.col("z0")).alias("dss"))
    s, ss = F.col("s") + F.col("ds"), F.col("ss") + F.col("dss")
    return zeros.join(extra, "feature").select("feature", ((ss - s * s / n) / F.nullif(F.lit(n - 1), F.lit(0))).alias("variance"))


def rank_sum_test(values: DataFrame, groups: DataFrame, value: str = "norm") -> DataFrame:
    """One-vs-rest Wilcoxon rank-sum per feature and group on sparse non-negative values: u, z, mean difference.

    Zeros are one block of ties below all others: only nonzeros are ranked, and the block enters in closed form.
    values: (feature, cell, value) nonzeros; groups: (cell, group), all cells.
    """
    sizes = groups.groupBy("group").agg(F.count(F.lit(1)).alias("n1"))
    n = groups.agg(F.count(F.lit(1)).alias("n"))
    seen = values.filter(F.col(value) > 0).join(groups, "cell")
    # equal values count once; ranks are places in a bin of values behind the counts of the bins below, so no task holds a feature's cells
    counted = seen.groupBy("feature", F.col(value).alias("v"), "group").agg(F.count(F.lit(1)).alias("k")).withColumn("bin", F.floor(F.log2("v") * BINS_PER_DOUBLING))
    below = F.sum("in_bin").over(Window.partitionBy("feature").orderBy("bin")) - F.col("in_bin")
    bins = counted.groupBy("feature", "bin").agg(F.sum("k").alias("in_bin")).withColumn("below", below)
    upto = F.sum("k").over(Window.partitionBy("feature", "bin").orderBy("v").rangeBetween(Window.unboundedPreceding, Window.currentRow))
    placed = counted.withColumns({"upto": upto, "same": F.sum("k").over(Window.partitionBy("feature", "bin", "v"))}).join(bins, ["feature", "bin"])
    rank = F.col("below") + F.col("upto") - (F.col("same") - 1) / 2
    k = F.col("k")
    per = placed.groupBy("feature", "group").agg(F.sum(k * rank).alias("r"), F.sum("k").alias("k"), F.sum(k * F.col("v")).alias("s"), F.sum(k * (F.col("same") * F.col("same") - 1)).alias("t"))
    every = per.groupBy("feature").agg(F.sum("k").alias("nz"), F.sum("s").alias("s_all"), F.sum("t").alias("t_all"))
    grid = every.join(F.broadcast(sizes.join(F.broadcast(n)))).join(per, ["feature", "group"], "left").fillna(0, ["r", "k", "s"])
    n0, n1 = F.col("n") - F.col("nz"), F.col("n1")
    n2 = F.col("n") - n1
    ranks = F.col("r") + F.col("k") * n0 + (n1 - F.col("k")) * (n0 + 1) / 2
    u = ranks - n1 * (n1 + 1) / 2
    tied = F.col("t_all") + n0 * (n0 * n0 - 1)
    sd = F.sqrt(n1 * n2 / 12 * (F.col("n") + 1 - tied / (F.col("n") * (F.col("n") - 1))))
    return grid.select("feature", "group", u.alias("u"), F.when(sd > 0, (u - n1 * n2 / 2) / sd).otherwise(F.lit(0.0)).alias("z"), (F.col("s") / n1 - (F.col("s_all") - F.col("s")) / n2).alias("difference"))


def marker_table(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """rank_sum_test on counts per 10,000 with two-sided normal p and BH q within each group."""
    from ..functions.tails import two_sided_normal

    tested = rank_sum_test(per_ten_thousand(counts), groups)
    return add_bh(tested.withColumn("p", two_sided_normal("z")), "p", "q", ["group"])


def dot_summary(counts: DataFrame, groups: DataFrame, features: DataFrame) -> DataFrame:
    """Mean and percent detected of chosen features over all cells of each group, zeros included; completed with zeros."""
    sizes = groups.groupBy("group").agg(F.count(F.lit(1)).alias("n"))
    seen = counts.join(F.broadcast(features), "feature", "left_semi").join(groups, "cell").groupBy("feature", "group").agg(F.sum("count").alias("s"), F.count_if(F.col("count") > 0).alias("k"))
    grid = features.distinct().join(F.broadcast(sizes)).join(seen, ["feature", "group"], "left").fillna(0, ["s", "k"])
    return grid.select("feature", "group", (F.col("s") / F.col("n")).alias("mean"), (100 * F.col("k") / F.col("n")).alias("percent"))


def set_scores(counts: DataFrame, sets: DataFrame, n_bins: int = 24) -> DataFrame:
    """(cell, label, score): mean of a set's features minus mean of the other features of the same expression bins.

    Bins are ntiles of the features' totals; every unlisted feature of a set's bins is its control, so nothing is drawn.
    """
    totals = counts.groupBy("feature").agg(F.sum("count").alias("total"))
    bins = totals.withColumn("bin", F.ntile(n_bins).over(Window.orderBy("total", "feature"))).select("feature", "bin")
    own = sets.join(bins, "feature")
    control = own.select("label", "bin").distinct().join(bins, "bin").join(sets, ["label", "feature"], "left_anti")
    sized = lambda df, c: df.withColumn("w", 1 / F.count(F.lit(1)).over(Window.partitionBy("label")) * c).select("label", "feature", "w")
    weights = sized(own, 1).unionByName(sized(control, -1))
    return counts.join(weights, "feature").groupBy("cell", "label").agg(F.sum(F.col("count") * F.col("w")).alias("score"))


def expectation(counts: DataFrame, n_cells: Column) -> DataFrame:
    """Mean count per feature over all cells."""
    return counts.groupBy("feature").agg((F.sum("count") / n_cells).alias("expected"))


def background_bins(features: DataFrame, first: str, second: str, n: int = 5) -> DataFrame:
    """features with `bin`: crossed ntiles of two covariates, ties by feature."""
    a = F.ntile(n).over(Window.orderBy(first, "feature"))
    b = F.ntile(n).over(Window.orderBy(second, "feature"))
    return features.withColumn("bin", ((a - 1) * n + b - 1).cast("bigint"))


def deviations(counts: DataFrame, weights: DataFrame, expected: DataFrame) -> DataFrame:
    """(cell, annotation, deviation): weighted observed over expected counts minus 1; expected scale with the cell's depth."""
    depth_of = counts.join(expected, "feature").groupBy("cell").agg(F.sum("count").alias("d"))
    grand = expected.agg(F.sum("expected").alias("e_all"))
    observed = counts.join(weights, "feature").groupBy("cell", "annotation").agg(F.sum(F.col("count") * F.col("weight")).alias("o"))
    awaited = weights.join(expected, "feature").groupBy("annotation").agg(F.sum(F.col("expected") * F.col("weight")).alias("e"))
    rows = depth_of.join(F.broadcast(awaited.join(F.broadcast(grand)))).join(observed, ["cell", "annotation"], "left").fillna(0, ["o"])
    return rows.select("cell", "annotation", (F.col("o") / (F.col("e") * F.col("d") / F.col("e_all")) - 1).alias("deviation"))
