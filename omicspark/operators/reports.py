"""Cohorts, group rules, support counts and the data part of reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ranks import add_bh, share, top_n
from ..functions.tails import poisson_above
from .heritability import multinomial_weights
from .loops import cut, numbered, tiled
from .tables import complete


def losses(before: DataFrame, after: DataFrame, key: str, called: Column) -> DataFrame:
    """(key, reason): rows that are gone, as called ones and the remainder."""
    gone = before.join(after.select(key), key, "left_anti")
    return gone.select(key, F.when(F.coalesce(called, F.lit(False)), "called").otherwise("remainder").alias("reason"))


def running_offsets(df: DataFrame, by: str, order: Sequence[str], n: str) -> DataFrame:
    """Fraction of each part in its group, and where it begins and ends in order: bars of a stacked plot."""
    w = Window.partitionBy(by).orderBy(*order)
    end = F.sum(n).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return df.withColumns({"fraction": share(n, [by]), "begin": end - F.col(n), "end": end})


def cohort(donors: DataFrame, key: str, selected: Column, sampled: DataFrame, covariates: Sequence[str], rule: str) -> DataFrame:
    """(key, reason): the first reason why a donor is left out, null if none."""
    there = sampled.select(key).distinct().withColumn("_s", F.lit(True))
    missing = F.lit(False)
    for c in covariates:
        missing = missing | F.col(c).isNull()
    reason = F.when(~F.coalesce(selected, F.lit(False)), "not selected").when(F.col("_s").isNull(), "no sample").when(missing, "missing covariate").when(~F.coalesce(F.expr(rule), F.lit(False)), "filter")
    return donors.join(there, key, "left").select(key, reason.alias("reason"))


def composition_counts(df: DataFrame, donor: str, label: str, least_share: float = 0.5) -> DataFrame:
    """Zero-completed donor x label counts with the donor's total and proportion, for labels that enough donors have."""
    n = df.groupBy(donor, label).agg(F.count(F.lit(1)).alias("n"))
    full = complete(n, [donor], [label], {"n": 0}).withColumn("total", F.sum("n").over(Window.partitionBy(donor)))
    w = Window.partitionBy(label)
    kept = full.withColumn("_p", F.avg((F.col("n") > 0).cast("double")).over(w)).filter(F.col("_p") >= least_share)
    return kept.select(donor, label, "n", "total", (F.col("n") / F.col("total")).alias("proportion"))


def significant_counts(df: DataFrame, by: Sequence[str], effect: Column, significant: Column) -> DataFrame:
    """Counts of significant rows by direction, completed with zeros; `signed` is negative for down."""
    n = df.groupBy(*by).agg(F.count_if(significant & (effect > 0)).alias("up"), F.count_if(significant & (effect < 0)).alias("down"))
    long = n.unpivot(list(by), ["up", "down"], "direction", "n")
    return long.withColumn("signed", F.when(F.col("direction") == "up", F.col("n")).otherwise(-F.col("n")))


def filter_clusters(df: DataFrame, cluster: str, called: Column, depth: str, most: float, least_ratio: float) -> DataFrame:
    """Rows that aren't called, of clusters whose called fraction isn't over `most` with a median depth ratio (called to others)
    of `least_ratio` or more in support."""
    flag = F.coalesce(called, F.lit(False))
    per = df.groupBy(cluster).agg(F.avg(flag.cast("double")).alias("_f"), F.percentile(F.when(flag, F.col(depth)), 0.5).alias("_c"), F.percentile(F.when(~flag, F.col(depth)), 0.5).alias("_o"))
    bad = per.filter((F.col("_f") > most) & (F.coalesce(F.col("_c") / F.col("_o"), F.lit(float("inf"))) >= least_ratio))
    return df.filter(~flag).join(bad, cluster, "left_anti")


def sidak_by(df: DataFrame, by: Sequence[str], p: str) -> DataFrame:
    """Smallest p per group, adjusted for the number of tests: -expm1(n log1p(-p))."""
    per = df.groupBy(*by).agg(F.min(p).alias("p"), F.count(p).alias("n"))
    return per.withColumn("adjusted", F.when(F.col("p") >= 1, F.lit(1.0)).otherwise(-F.expm1(F.col("n") * F.log1p(-F.col("p")))))


def crossed_strata(df: DataFrame, values: Sequence[str], n: int, key: str) -> DataFrame:
    """df with `stratum`: the crossed ntiles of several values, ties by key."""
    rows = df.withColumn("stratum", F.lit(0).cast("bigint"))
    for v in values:
        rows = tiled(rows, [v, key], n, "_t").withColumn("stratum", F.col("stratum") * n + F.col("_t") - 1).drop("_t")
    return rows


def _crowding(genes: DataFrame, peaks: DataFrame, away: int) -> DataFrame:
    """(gene, near): at least as many peaks as lie on the gene's chromosome within `away`, from counts in bins: those that start up to
    the last bin in reach, without those that end before the first."""
    width = max(1, away)
    at = lambda c: F.floor(F.col(c) / width)
    starts = peaks.groupBy("chr", at("start").alias("bin")).agg(F.count(F.lit(1)).alias("s"))
    ends = peaks.groupBy("chr", at("end").alias("bin")).agg(F.count(F.lit(1)).alias("e"))
    span = peaks.groupBy("chr").agg(F.min(at("start")).alias("lo"), (F.max(at("end")) + 1).alias("hi"))
    grid = span.select("chr", F.explode(F.sequence("lo", "hi")).alias("bin")).join(starts, ["chr", "bin"], "left").join(ends, ["chr", "bin"], "left")
    w = Window.partitionBy("chr").orderBy("bin")
    grid = grid.select("chr", "bin", F.sum(F.coalesce("s", F.lit(0))).over(w).alias("begun"), (F.sum(F.coalesce("e", F.lit(0))).over(w) - F.coalesce("e", F.lit(0))).alias("ended"))
    reach = genes.join(span, genes["g_chr"] == span["chr"]).select("gene", "chr", F.least(F.floor((F.col("g_end") + away) / width), "hi").alias("last"), F.least(F.floor((F.col("g_start") - away) / width), "hi").alias("first"))
    last, first = grid.select("chr", F.col("bin").alias("last"), "begun"), grid.select("chr", F.col("bin").alias("first"), "ended")
    both = reach.join(last, ["chr", "last"], "left").join(first, ["chr", "first"], "left")
    return both.select("gene", (F.coalesce("begun", F.lit(0)) - F.coalesce("ended", F.lit(0))).alias("near"))


def background_pairs(genes: DataFrame, peaks: DataFrame, n: int, away: int = 10_000_000, seed: int = 1) -> DataFrame:
    """(gene, peak): n hash-drawn peaks per gene, on other chromosomes or more than `away` from it; all that fit, if they are fewer.

    Peaks are shuffled by a hash and numbered, and genes draw numbers, round by round twice as many, until each has n peaks that fit.
    Genes that fewer than 2 n peaks may fit (by counts in bins of the places) meet every peak instead. So work grows with genes x
    n, but for those.
    """
    g = genes.select("gene", F.col("chr").alias("g_chr"), F.col("start").alias("g_start"), F.col("end").alias("g_end"))
    p = cut(numbered(peaks.select("peak", "chr", "start", "end", F.xxhash64("peak", F.lit(seed)).alias("h")), ["h", "peak"]))
    total = p.count()
    far = (F.col("g_chr") != F.col("chr")) | (F.col("start") - F.col("g_end") > away) | (F.col("g_start") - F.col("end") > away)
    known = cut(g.join(_crowding(g, p, away), "gene", "left").withColumn("fit", total - F.coalesce("near", F.lit(0))).drop("near"))
    found = cut(known.filter(F.col("fit") < 2 * n).join(p, far).select("gene", "peak", F.xxhash64("gene", "peak", F.lit(seed)).alias("draw")))
    open_, lo, step = known.filter(F.col("fit") >= 2 * n), 0, 2 * n
    while not open_.isEmpty():
        draws = open_.withColumn("draw", F.explode(F.sequence(F.lit(lo), F.lit(lo + step - 1)))).withColumn("number", F.pmod(F.xxhash64("gene", "draw", F.lit(seed)), F.lit(total)))
        new = draws.join(p, "number").filter(far).select("gene", "peak", F.col("draw").cast("bigint").alias("draw"))
        found = cut(found.unionByName(new).groupBy("gene", "peak").agg(F.min("draw").alias("draw")))
        have = found.groupBy("gene").agg(F.count(F.lit(1)).alias("have")).filter(F.col("have") >= n)
        open_ = cut(open_.join(have, "gene", "left_anti"))
        lo, step = lo + step, 2 * step
    return top_n(found, n, [F.col("draw"), F.col("peak")], ["gene"]).select("gene", "peak")


def gene_windows(genes: DataFrame, least: int = 1_000, most: int = 100_000) -> DataFrame:
    """genes with `left` and `right`: how far their surroundings reach, up to the neighbouring genes, within least and most."""
    w = Window.partitionBy("chr").orderBy("start", "end", "gene")
    before, after = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lead("start").over(w)
    room = lambda gap: F.greatest(F.lit(least), F.least(F.lit(most), F.coalesce(gap, F.lit(most))))
    return genes.withColumns({"left": F.col("start") - room(F.col("start") - before), "right": F.col("end") + room(after - F.col("end"))})


def gene_tile_scores(tiles: DataFrame, genes: DataFrame, width: int = 500, decay: float = 5_000.0, least: int = 1_000, most: int = 100_000, cap: int = 4, scale: float = 1e4) -> DataFrame:
    """(cell, gene, score): capped tile counts weighted by exp(-distance / decay) + exp(-1) around each gene, up to its neighbours,
    scaled per cell."""
    spread = gene_windows(genes, least, most).select("chr", "gene", "start", "end", F.explode(F.sequence(F.floor(F.col("left") / width), F.floor((F.col("right") - 1) / width))).alias("tile"))
    middle = F.col("tile") * width + width / 2
    away = F.greatest(F.col("start") - middle, middle - F.col("end"), F.lit(0.0))
    weights = spread.select("chr", "gene", "tile", (F.exp(-away / decay) + F.exp(F.lit(-1.0))).alias("w"))
    per = tiles.join(weights, ["chr", "tile"]).groupBy("cell", "gene").agg(F.sum(F.least(F.col("n"), F.lit(cap)) * F.col("w")).alias("s"))
    return per.select("cell", "gene", (F.col("s") * scale / F.sum("s").over(Window.partitionBy("cell"))).alias("score"))


def tile_peaks(sites: DataFrame, group: str, width: int, effective: Column, shifts: int = 3) -> DataFrame:
    """Overlapping tiles (each base in `shifts` of them) with their Poisson upper tail under the group's mean per tile, fold change
    and BH q. sites: (group, chr, pos) cut sites; effective: how long the genome is."""
    step = width // shifts
    first = F.floor(F.col("pos") / step)
    n = sites.select(group, "chr", F.explode(F.sequence(first - (shifts - 1), first)).alias("tile")).groupBy(group, "chr", "tile").agg(F.count(F.lit(1)).alias("n"))
    totals = sites.groupBy(group).agg((F.count(F.lit(1)) * width / effective).alias("mean"))
    rows = n.join(F.broadcast(totals), group).select(group, "chr", (F.col("tile") * step).alias("start"), (F.col("tile") * step + width).alias("end"), "n", "mean")
    return add_bh(rows.withColumns({"fold": F.col("n") / F.col("mean"), "p": poisson_above(F.col("n") - 1, F.col("mean"))}), "p", "q", [group])


def most_specific(df: DataFrame, group: str, value: str, key: str, share_of: float = 0.1) -> DataFrame:
    """Top share of each group's keys by value, positive values only."""
    w = Window.partitionBy(group)
    ranked = df.withColumn("_n", F.row_number().over(w.orderBy(F.col(value).desc(), key))).withColumn("_m", F.count(F.lit(1)).over(w))
    return ranked.filter((F.col("_n") <= F.ceil(F.col("_m") * share_of)) & (F.col(value) > 0)).drop("_n", "_m")


def drawn_medians(df: DataFrame, by: Sequence[str], cluster: str, value: str, draws: int, seed: int) -> DataFrame:
    """(by..., draw, m): exact median of each group's values in each draw (rows as often as their cluster is taken; draw 0: each once).

    Equal values are added up first. The values are then put in order by range partitions, each counted behind those before it, so no
    task holds a group's values; `percentile` would keep every different value of a group and draw in one map.
    """
    taken = multinomial_weights(df, cluster, draws, seed)
    times = [F.coalesce(F.max(F.when(F.col("draw") == i, F.col("times"))), F.lit(0)) for i in range(1, draws + 1)]
    weights = cut(taken.groupBy(F.col(cluster).alias("_c")).agg(F.array(*times).alias("_times")))
    rows = df.filter(F.col(value).isNotNull()).select(*by, cluster, F.col(value).alias("_v")).join(weights, F.col(cluster) == F.col("_c"), "left")
    n = [f"_n{i}" for i in range(draws + 1)]
    added = [F.count(F.lit(1)).alias(n[0])] + [F.sum(F.coalesce(F.col("_times")[i - 1], F.lit(0))).alias(n[i]) for i in range(1, draws + 1)]
    per = rows.groupBy(*by, "_v").agg(*added)
    parts = cut(per.repartitionByRange(*by, "_v").withColumn("_part", F.spark_partition_id()))
    sums = parts.groupBy(*by, "_part").agg(*[F.sum(x).alias(x) for x in n])  # one row a group and partition
    group = Window.partitionBy(*by)
    before = group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    known = sums.select(*[F.col(c).alias(f"_by{i}") for i, c in enumerate(by)], F.col("_part").alias("_p"), F.array(*[F.coalesce(F.sum(x).over(before), F.lit(0)) for x in n]).alias("_before"), F.array(*[F.sum(x).over(group) for x in n]).alias("_all"))
    on = [F.col("_part") == F.col("_p"), *[F.col(c).eqNullSafe(F.col(f"_by{i}")) for i, c in enumerate(by)]]
    inside = Window.partitionBy("_part", *by).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    placed = parts.withColumns({x: F.struct(F.col(x).alias("k"), F.sum(x).over(inside).alias("upto")) for x in n}).join(F.broadcast(known), on)
    held = []
    for i, x in enumerate(n):
        end = F.col("_before")[i] + F.col(x)["upto"]
        total, start = F.col("_all")[i], end - F.col(x)["k"]
        has = lambda at: ((at >= start) & (at < end)).cast("int")  # noqa: B023, E731 - used in this round only
        held.append(F.struct(F.lit(i).alias("draw"), (has(F.floor((total - 1) / 2)) + has(F.ceil((total - 1) / 2))).alias("halves")))
    middle = placed.select(*by, "_v", F.explode(F.array(*held)).alias("x")).filter("x.halves > 0")
    return middle.groupBy(*by, F.col("x.draw").alias("draw")).agg((F.sum(F.col("_v") * F.col("x.halves")) / 2).alias("m"))


def bootstrap_medians(df: DataFrame, by: Sequence[str], cluster: str, value: str, draws: int = 50, seed: int = 1) -> DataFrame:
    """Median per group and its 95 % range over resamples of whole clusters: as many hash-drawn picks with replacement as there are
    clusters."""
    m, drawn = F.col("m"), F.col("draw") > 0
    medians = cut(drawn_medians(df, by, cluster, value, draws, seed))
    ranges = medians.groupBy(*by).agg(F.max(F.when(~drawn, m)).alias("median"), F.percentile(F.when(drawn, m), 0.025).alias("low"), F.percentile(F.when(drawn, m), 0.975).alias("high"), F.count_if(drawn).alias("_k"))
    return ranges.filter("_k > 0").drop("_k")


def bootstrap_ratios(df: DataFrame, reference: str, key: str, cluster: str, value: str, draws: int = 50, seed: int = 1) -> DataFrame:
    """(key, ratio, low, high): each key's median over that of the reference key, with its 95 % range over the same resamples."""
    medians = cut(drawn_medians(df, [key], cluster, value, draws, seed))
    base = medians.filter(F.col(key) == reference).select("draw", F.col("m").alias("r"))
    both = medians.join(F.broadcast(base), "draw").withColumn("q", F.col("m") / F.when(F.col("r") != 0, F.col("r")))
    drawn = both.filter("draw > 0 AND r <> 0").groupBy(key).agg(F.percentile("q", 0.025).alias("low"), F.percentile("q", 0.975).alias("high"))
    return both.filter("draw = 0").select(key, F.col("q").alias("ratio")).join(drawn, key)


def make_unique(df: DataFrame, name: str, order: str) -> DataFrame:
    """df with `unique`: repeats of a name, in order, get the suffixes .1, .2, ..."""
    n = F.row_number().over(Window.partitionBy(name).orderBy(order)) - 1
    return df.withColumn("unique", F.when(n == 0, F.col(name)).otherwise(F.concat(F.col(name), F.lit("."), n.cast("string"))))
