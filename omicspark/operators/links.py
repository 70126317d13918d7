"""Peak-gene links over donor x state aggregates: states, support filters, nuisance designs, residuals, latent factors, link values.

aggregates: (cell_group, aggregate, donor, gene_depth, peak_depth), as many rows as a study has donors x states; counts: (cell_group,
aggregate, feature, count) nonzeros.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ranks import correlation
from ..functions.vectors import distance
from .differential import leading_factors, products
from .loops import cut


def lloyd(vectors: DataFrame, sizes: DataFrame, rounds: int = 1_000, seed: int = 1) -> DataFrame:
    """(cell_group, id, state): k-means within each group, states numbered from 0. vectors: cell_group, id, vector; sizes:
    cell_group, k. Centres start at the k rows of least hash; they are k rows a group, so they are broadcast.
    Ends when no centre moves; raises if one still does after so many rounds."""
    first = Window.partitionBy("cell_group").orderBy(F.xxhash64("id", F.lit(seed)), "id")
    start = vectors.join(F.broadcast(sizes), "cell_group").withColumn("state", F.row_number().over(first) - 1).filter("state < k")
    centres = cut(start.select("cell_group", "state", F.col("vector").alias("centre")))
    for _ in range(rounds):
        near = vectors.join(F.broadcast(centres), "cell_group").groupBy("cell_group", "id").agg(F.min(F.struct(F.round(distance(F.col("vector"), F.col("centre")), 9).alias("d"), "state")).alias("b"))
        labelled = near.select("cell_group", "id", F.col("b.state").alias("state"))
        means = labelled.join(vectors, ["cell_group", "id"]).select("cell_group", "state", F.posexplode("vector").alias("i", "x")).groupBy("cell_group", "state", "i").agg(F.avg("x").alias("x"))
        new = cut(means.groupBy("cell_group", "state").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda e: e["x"]).alias("centre")))
        moved = new.join(centres.withColumnRenamed("centre", "old"), ["cell_group", "state"]).filter(distance(F.col("centre"), F.col("old")) > 1e-9)
        centres = new
        if moved.isEmpty():
            break
    else:
        raise RuntimeError(f"lloyd: centres still move after {rounds} rounds")
    near = vectors.join(F.broadcast(centres), "cell_group").groupBy("cell_group", "id").agg(F.min(F.struct(F.round(distance(F.col("vector"), F.col("centre")), 9).alias("d"), "state")).alias("b"))
    return near.select("cell_group", "id", F.col("b.state").alias("state"))


def state_numbers(cells: DataFrame, least: int = 20, most: int = 20) -> DataFrame:
    """(cell_group, k): as many states as the median donor has `least` cells, 1 to `most`. cells: cell_group, donor."""
    sizes = cells.groupBy("cell_group", "donor").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)
    return sizes.groupBy("cell_group").agg(F.greatest(F.lit(1), F.least(F.lit(most), F.floor(F.percentile("n", 0.5) / least))).cast("int").alias("k"))


def pruned_states(cells: DataFrame, least_cells: int = 20, least_donors: int = 1, least_states: int = 2) -> DataFrame:
    """(cell_group, donor, state, n): donor x state bins with enough cells, of states with enough donors and donors with enough
    states, pruned until all hold. cells: cell_group, donor, state. What loops is a table of bins."""
    bins = cut(cells.groupBy("cell_group", "donor", "state").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_cells))
    size = bins.count()
    while True:
        states = bins.groupBy("cell_group", "state").agg(F.countDistinct("donor").alias("k")).filter(F.col("k") >= least_donors)
        donors = bins.groupBy("cell_group", "donor").agg(F.countDistinct("state").alias("k")).filter(F.col("k") >= least_states)
        bins = cut(bins.join(states, ["cell_group", "state"], "left_semi").join(donors, ["cell_group", "donor"], "left_semi").select("cell_group", "donor", "state", "n"))
        left = bins.count()
        if left == size:
            return bins
        size = left


def group_diagnostics(cells: DataFrame, bins: DataFrame, least_donors: int = 1) -> DataFrame:
    """One row a group: cells, donors, states, aggregates kept, and the reason if the group is skipped."""
    every = cells.groupBy("cell_group").agg(F.count(F.lit(1)).alias("n_cells"), F.countDistinct("donor").alias("n_donors"))
    kept = bins.groupBy("cell_group").agg(F.countDistinct("state").alias("n_states"), F.count(F.lit(1)).alias("n_aggregates"), F.countDistinct("donor").alias("kept_donors"))
    rows = every.join(kept, "cell_group", "left").fillna(0, ["n_states", "n_aggregates", "kept_donors"])
    reason = F.when(F.col("n_aggregates") == 0, "no_aggregates").when(F.col("kept_donors") < least_donors, "few_donors")
    return rows.withColumn("skipped_reason", reason).drop("kept_donors")


def aggregate_counts(counts: DataFrame, members: DataFrame) -> DataFrame:
    """(cell_group, aggregate, feature, count): counts of cells summed by their aggregate. members: cell, cell_group, aggregate."""
    return counts.join(members, "cell").groupBy("cell_group", "aggregate", "feature").agg(F.sum("count").alias("count"))


def normalised(counts: DataFrame, aggregates: DataFrame, depth: str, scale: float = 1e6) -> DataFrame:
    """(cell_group, feature, aggregate, value): log1p counts per million, zeros filled in for the features that a group has."""
    features = counts.select("cell_group", "feature").distinct()
    grid = features.join(F.broadcast(aggregates.select("cell_group", "aggregate", depth)), "cell_group")
    rows = grid.join(counts, ["cell_group", "aggregate", "feature"], "left").fillna(0, ["count"])
    return rows.select("cell_group", "feature", "aggregate", F.log1p(F.col("count") * scale / F.col(depth)).alias("value"))


def detection(counts: DataFrame, aggregates: DataFrame) -> DataFrame:
    """(cell_group, feature, detection): share of a group's aggregates with any count."""
    n = aggregates.groupBy("cell_group").agg(F.count(F.lit(1)).alias("n"))
    k = counts.filter("count > 0").groupBy("cell_group", "feature").agg(F.count(F.lit(1)).alias("k"))
    return k.join(F.broadcast(n), "cell_group").select("cell_group", "feature", (F.col("k") / F.col("n")).alias("detection"))


def branches(pairs: DataFrame, genes: DataFrame, peaks: DataFrame, aggregates: DataFrame, width: int, least_gene: float = 0.05, least_peak: float = 0.05, least_aggregates: int = 10) -> DataFrame:
    """One row a (cell_group, chr): candidate pairs, detected genes, accessible peaks, pairs of both, and the reason if it is skipped.

    pairs: cell_group, chr, gene, peak; genes, peaks: what `detection` gives; width: columns of the nuisance design."""
    n = aggregates.groupBy("cell_group").agg(F.count(F.lit(1)).alias("n_aggregates"))
    g = genes.filter(F.col("detection") >= least_gene).select("cell_group", F.col("feature").alias("gene"), F.lit(True).alias("g"))
    p = peaks.filter(F.col("detection") >= least_peak).select("cell_group", F.col("feature").alias("peak"), F.lit(True).alias("p"))
    rows = pairs.join(g, ["cell_group", "gene"], "left").join(p, ["cell_group", "peak"], "left")
    per = rows.groupBy("cell_group", "chr").agg(F.count(F.lit(1)).alias("n_pairs"), F.countDistinct(F.when(F.col("g"), F.col("gene"))).alias("n_genes"), F.countDistinct(F.when(F.col("p"), F.col("peak"))).alias("n_peaks"), F.count_if(F.col("g") & F.col("p")).alias("n_kept"))
    per = per.join(F.broadcast(n), "cell_group", "left").fillna(0, ["n_aggregates"])
    reason = F.when(F.col("n_aggregates") < least_aggregates, "few_aggregates").when(F.col("n_aggregates") - width - 1 <= 0, "no_residual_df").when(F.col("n_genes") == 0, "no_detected_genes").when(F.col("n_peaks") == 0, "no_accessible_peaks").when(F.col("n_kept") == 0, "no_pairs")
    return per.withColumn("skipped_reason", reason)


def supported_pairs(pairs: DataFrame, genes: DataFrame, peaks: DataFrame, aggregates: DataFrame, presets: DataFrame) -> DataFrame:
    """(preset, cell_group, gene, peak, low_gene, low_peak, low_donor): which support each pair lacks under each preset.

    A feature is supported in an aggregate that has `count` of it at median depth (2 at least, scaled by depth); it needs the
    preset's aggregates or share of them, and both features `per_donor` aggregates in common donors. presets: preset, gene_count,
    peak_count, min_aggregates, fraction, per_donor, min_donors; they are few, and so are donors next to cells."""
    n = aggregates.groupBy("cell_group").agg(F.count(F.lit(1)).alias("n"), F.percentile("gene_depth", 0.5).alias("gene_median"), F.percentile("peak_depth", 0.5).alias("peak_median"))
    own = aggregates.join(n, "cell_group").join(F.broadcast(presets))

    def support(counts: DataFrame, kind: str) -> tuple[DataFrame, DataFrame]:
        need = F.greatest(F.lit(2.0), F.col(f"{kind}_count") * F.col(f"{kind}_depth") / F.col(f"{kind}_median"))
        hit = counts.join(F.broadcast(own), ["cell_group", "aggregate"]).filter(F.col("count") >= need)
        per = hit.groupBy("preset", "cell_group", F.col("feature").alias(kind)).agg(F.count(F.lit(1)).alias(f"{kind}_n"))
        donors = hit.groupBy("preset", "cell_group", F.col("feature").alias(kind), "donor").agg(F.count(F.lit(1)).alias("k"), F.first("per_donor").alias("per_donor")).filter("k >= per_donor")
        return per, donors.groupBy("preset", "cell_group", kind).agg(F.collect_set("donor").alias(f"{kind}_donors"))

    (g, gd), (p, pd_) = support(genes, "gene"), support(peaks, "peak")
    least = F.greatest(F.col("min_aggregates"), F.ceil(F.col("fraction") * F.col("n")))
    rows = pairs.join(F.broadcast(n.select("cell_group", "n")), "cell_group").join(F.broadcast(presets.select("preset", "min_aggregates", "fraction", "min_donors")))
    for table, on in ((g, "gene"), (gd, "gene"), (p, "peak"), (pd_, "peak")):
        rows = rows.join(table, ["preset", "cell_group", on], "left")
    none = F.array().cast(gd.schema["gene_donors"].dataType)
    common = F.size(F.array_intersect(F.coalesce("gene_donors", none), F.coalesce("peak_donors", none)))
    return rows.select("preset", "cell_group", "gene", "peak", (F.coalesce("gene_n", F.lit(0)) < least).alias("low_gene"), (F.coalesce("peak_n", F.lit(0)) < least).alias("low_peak"), (common < F.col("min_donors")).alias("low_donor"))


def retention(support: DataFrame) -> DataFrame:
    """(preset, cell_group, n, n_retained, n_low_gene, n_low_peak, n_low_donor)."""
    low = lambda c: F.count_if(F.col(f"low_{c}")).alias(f"n_low_{c}")
    return support.groupBy("preset", "cell_group").agg(F.count(F.lit(1)).alias("n"), F.count_if(~(F.col("low_gene") | F.col("low_peak") | F.col("low_donor"))).alias("n_retained"), low("gene"), low("peak"), low("donor"))


def nuisance_design(aggregates: DataFrame, factors: DataFrame | None = None) -> DataFrame:
    """(cell_group, aggregate, x): intercept, donors but the first, scaled log depths that vary, latent factors, without columns
    that the ones before already give. factors: cell_group, sample, factor, value. A group's aggregates fit one frame."""
    rows = aggregates if factors is None else aggregates.join(factors.groupBy("cell_group", F.col("sample").alias("aggregate")).agg(F.transform(F.array_sort(F.collect_list(F.struct("factor", "value"))), lambda e: e["value"]).alias("pcs")), ["cell_group", "aggregate"], "left")
    group, name = (rows.schema[c].dataType.simpleString() for c in ("cell_group", "aggregate"))

    def build(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("aggregate")
        donors = sorted(part["donor"].unique())
        columns = [np.ones(len(part)), *((part["donor"] == d).to_numpy(float) for d in donors[1:])]
        for depth in ("gene_depth", "peak_depth"):
            v = np.log1p(part[depth].to_numpy(float))
            if len(v) > 1 and v.std(ddof=1) > 0:
                columns.append((v - v.mean()) / v.std(ddof=1))
        if "pcs" in part and part["pcs"].notna().all():
            columns += list(np.stack(part["pcs"].to_list()).T)
        kept: list[np.ndarray] = []
        for c in columns:
            if np.linalg.matrix_rank(np.stack([*kept, c], 1)) > len(kept):
                kept.append(c)
        x = np.stack(kept, 1)
        return pd.DataFrame({"cell_group": part["cell_group"], "aggregate": part["aggregate"], "x": list(x)})

    return rows.groupBy("cell_group").applyInPandas(build, f"cell_group {group}, aggregate {name}, x array<double>")


def residuals(values: DataFrame, design: DataFrame) -> DataFrame:
    """(cell_group, feature, aggregate, residual) of least squares on the group's design; a feature's row is its aggregates."""
    entry = F.struct("aggregate", "value", "x")
    wide = values.join(F.broadcast(design), ["cell_group", "aggregate"]).groupBy("cell_group", "feature").agg(F.array_sort(F.collect_list(entry)).alias("rows"))

    @F.pandas_udf("array<double>")
    def solve(rows: pd.Series) -> pd.Series:
        out = []
        for r in rows:
            r = list(r)
            y, x = np.array([e["value"] for e in r], float), np.array([e["x"] for e in r], float)
            out.append(y - x @ np.linalg.lstsq(x, y, rcond=None)[0])
        return pd.Series(out)

    done = wide.select("cell_group", "feature", F.transform("rows", lambda e: e["aggregate"]).alias("names"), solve("rows").alias("r"))
    return done.select("cell_group", "feature", F.inline(F.arrays_zip(F.col("names").alias("aggregate"), F.col("r").alias("residual"))))


def residual_gram(rest: DataFrame) -> DataFrame:
    """(cell_group, a, b, value): products of residuals, each feature's scaled to length 1, summed over features. As large as
    aggregates x aggregates; partial sums of chromosomes may be added."""
    listed = rest.groupBy("cell_group", "feature").agg(F.array_sort(F.collect_list(F.struct("aggregate", "residual"))).alias("r"), F.sum(F.col("residual") * F.col("residual")).alias("l")).filter("l > 1e-12")
    scaled = listed.select("cell_group", F.transform("r", lambda e: e["aggregate"]).alias("names"), F.transform("r", lambda e: e["residual"] / F.sqrt("l")).alias("e"))
    return products(scaled).withColumnRenamed("g", "cell_group")


def latent_factors(grams: DataFrame, design: DataFrame, most: int = 10) -> DataFrame:
    """(cell_group, sample, factor, value): leading eigenvectors of each group, one for ten residual degrees of freedom at most,
    scaled to mean square 1. Groups are named by the study, so they are few."""
    widths = design.groupBy("cell_group").agg(F.count(F.lit(1)).alias("n"), F.first(F.size("x")).alias("k"))
    out = None
    for g, n, k in widths.collect():
        kept = max(0, min(most, (n - k - 1) // 10))
        if kept:
            own = leading_factors(grams.filter(F.col("cell_group") == g).select("a", "b", "value"), kept)
            rows = own.select(F.lit(g).alias("cell_group"), "sample", "factor", (F.col("value") * F.lit(float(n) ** 0.5)).alias("value"))
            out = rows if out is None else out.unionByName(rows)
    if out is not None:
        return out
    return grams.limit(0).select("cell_group", F.col("a").cast("string").alias("sample"), F.lit(1).alias("factor"), "value")


def link_values(pairs: DataFrame, genes: DataFrame, peaks: DataFrame, on: Sequence[str] = ("cell_group", "aggregate")) -> DataFrame:
    """(cell_group, gene, peak, aggregate, gene_value, peak_value) of chosen links; genes, peaks: (cell_group, feature, aggregate, value)."""
    g = genes.select(*on, F.col("feature").alias("gene"), F.col("value").alias("gene_value"))
    p = peaks.select(*on, F.col("feature").alias("peak"), F.col("value").alias("peak_value"))
    return pairs.select("cell_group", "gene", "peak").join(g, ["cell_group", "gene"]).join(p, [*on, "peak"]).select("cell_group", "gene", "peak", "aggregate", "gene_value", "peak_value")


def link_correlations(values: DataFrame) -> DataFrame:
    """(cell_group, gene, peak, n, r); r is null where a value doesn't vary."""
    return values.groupBy("cell_group", "gene", "peak").agg(F.count(F.lit(1)).alias("n"), correlation("gene_value", "peak_value").alias("r"))
