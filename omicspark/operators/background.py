"""Background of deviations: bin moments, z, variability, contributions, matched controls, shifted loci, attribution likelihoods.

counts: (feature, cell, count) nonzeros; bins: (feature, bin, expected) of every feature; weights: (annotation, feature, weight).
Zeros enter by the size of a bin, so nothing is densified.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ranks import add_bh
from ..functions.tails import chi_square_tail
from .intervals import overlap_join
from .tables import hash_sample

#: Bins x annotations of a product, which go to every task.
MAX_WEIGHTS = 1 << 22


def counted_features(counts: DataFrame, sequences: DataFrame, key: str = "feature", text: str = "sequence") -> DataFrame:
    """(feature, total, gc): features with counts and the share of G and C in their sequence, null for an empty one."""
    gc = (F.length(text) - F.length(F.translate(F.upper(text), "GC", ""))) / F.nullif(F.length(text), F.lit(0))
    return counts.groupBy(key).agg(F.sum("count").alias("total")).filter("total > 0").join(sequences.select(key, gc.alias("gc")), key)


def bin_moments(counts: DataFrame, bins: DataFrame) -> DataFrame:
    """(bin, cell, mean, var) of the counts of a bin's features, zeros included; rows where a bin has any count."""
    sizes = bins.groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    sums = counts.join(bins.select("feature", "bin"), "feature").groupBy("bin", "cell").agg(F.sum("count").alias("s"), F.sum(F.col("count") * F.col("count")).alias("ss"))
    mean = F.col("s") / F.col("n")
    return sums.join(F.broadcast(sizes), "bin").select("bin", "cell", mean.alias("mean"), (F.col("ss") / F.col("n") - mean * mean).alias("var"))


def _by_bins(moments: DataFrame, per_bin: DataFrame) -> DataFrame:
    """(cell, annotation, m, v): sums over bins of w1 x mean and w2 x var. Cells come with their bins as one row each, and a batch of cells
    is multiplied with the bins x annotations weights, so there is no row for a cell, bin and annotation. The weights go to every task;
    more than MAX_WEIGHTS of them raise."""
    found = per_bin.limit(MAX_WEIGHTS + 1).collect()
    if len(found) > MAX_WEIGHTS:
        raise ValueError(f"more than {MAX_WEIGHTS} weights of bins and annotations are too many to send to every task")
    at = {b: i for i, b in enumerate(sorted({r["bin"] for r in found}))}
    names = {a: i for i, a in enumerate(sorted({r["annotation"] for r in found}))}
    w1, w2 = np.zeros((len(at), len(names))), np.zeros((len(at), len(names)))
    for r in found:
        w1[at[r["bin"]], names[r["annotation"]]], w2[at[r["bin"]], names[r["annotation"]]] = r["w1"], r["w2"]
    cells = moments.groupBy("cell").agg(F.collect_list(F.struct("bin", "mean", "var")).alias("b"))
    cell, annotation = cells.schema["cell"].dataType.simpleString(), per_bin.schema["annotation"].dataType.simpleString()

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, len(batch), 1024):
                part = batch.slice(lo, 1024)
                inner, row = part.column(1).flatten(), np.repeat(np.arange(len(part)), part.column(1).value_lengths().to_numpy())
                place = np.array([at.get(b, -1) for b in inner.field("bin").to_pylist()], np.int64)
                mean, var = np.zeros((len(part), len(at))), np.zeros((len(part), len(at)))
                used = place >= 0
                mean[row[used], place[used]] = inner.field("mean").to_numpy()[used]
                var[row[used], place[used]] = inner.field("var").to_numpy()[used]
                m, v = mean @ w1, var @ w2
                r, c = np.nonzero((m != 0) | (v != 0))
                labels = pa.array(list(names)).take(pa.array(c))
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(r)), labels, pa.array(m[r, c]), pa.array(v[r, c])], names=["cell", "annotation", "m", "v"])

    return cells.mapInArrow(multiply, f"cell {cell}, annotation {annotation}, m double, v double")


def deviation_z(counts: DataFrame, weights: DataFrame, bins: DataFrame) -> DataFrame:
    """(cell, annotation, deviation, z): weighted counts over their expectation, less that of peaks drawn from the same bins, and
    over its standard deviation; a cell's expectation scales with its depth."""
    own = weights.join(bins, "feature")
    grand = bins.agg(F.sum("expected").alias("e_all"))
    awaited = own.groupBy("annotation").agg(F.sum(F.col("weight") * F.col("expected")).alias("e"))
    per_bin = own.groupBy("annotation", "bin").agg(F.sum("weight").alias("w1"), F.sum(F.col("weight") * F.col("weight")).alias("w2"))
    observed = counts.join(weights, "feature").groupBy("cell", "annotation").agg(F.sum(F.col("count") * F.col("weight")).alias("o"), F.lit(0.0).alias("m"), F.lit(0.0).alias("v"))
    drawn = _by_bins(bin_moments(counts, bins), per_bin).select("cell", "annotation", F.lit(0.0).alias("o"), "m", "v")
    both = observed.unionByName(drawn).groupBy("cell", "annotation").agg(F.sum("o").alias("o"), F.sum("m").alias("m"), F.sum("v").alias("v"))
    depth = counts.join(bins.select("feature"), "feature", "left_semi").groupBy("cell").agg(F.sum("count").alias("d"))
    grid = depth.join(F.broadcast(awaited.join(F.broadcast(grand)))).join(both, ["cell", "annotation"], "left").fillna(0, ["o", "m", "v"])
    e = F.col("e") * F.col("d") / F.col("e_all")
    return grid.select("cell", "annotation", ((F.col("o") - F.col("m")) / e).alias("deviation"), F.when(F.col("v") > 0, (F.col("o") - F.col("m")) / F.sqrt("v")).alias("z"))


def variability(scores: DataFrame) -> DataFrame:
    """(annotation, n, variability, p, q): deviation of z over cells, its chi-square tail, BH over annotations."""
    per = scores.groupBy("annotation").agg(F.count("z").alias("n"), F.stddev_samp("z").alias("variability"))
    df = (F.col("n") - 1).cast("double")
    return add_bh(per.withColumn("p", chi_square_tail(df * F.col("variability") * F.col("variability"), df)), "p")


def grouped_expectation(counts: DataFrame, equal: bool = False) -> DataFrame:
    """(feature, expected): share of each feature in all counts; equal: mean of its shares, so that every group weighs alike."""
    n = counts.agg(F.sum("count").alias("all"), F.countDistinct("cell").alias("cells"))
    depth = counts.groupBy("cell").agg(F.sum("count").alias("d"))
    share = F.sum(F.col("count") / F.col("d")) / F.first("cells") if equal else F.sum("count") / F.first("all")
    return counts.join(F.broadcast(depth), "cell").join(F.broadcast(n)).groupBy("feature").agg(share.alias("expected"))


def peak_contributions(counts: DataFrame, weights: DataFrame, bins: DataFrame) -> DataFrame:
    """(annotation, feature, cell, contribution, deviation, relative): what each peak adds to a group's deviation, that sum, and the
    contribution less its mean over groups, over the spread of the deviations. Cells are groups, so they are few."""
    cells = counts.groupBy("cell").agg(F.sum("count").alias("d"))
    grand = bins.agg(F.sum("expected").alias("e_all"))
    own = weights.join(bins, "feature")
    awaited = own.groupBy("annotation").agg(F.sum(F.col("weight") * F.col("expected")).alias("e"))
    grid = own.join(awaited, "annotation").join(F.broadcast(cells.join(F.broadcast(grand))))
    rows = grid.join(counts, ["feature", "cell"], "left").join(bin_moments(counts, bins).select("bin", "cell", "mean"), ["bin", "cell"], "left").fillna(0, ["count", "mean"])
    part = rows.select("annotation", "feature", "cell", (F.col("weight") * (F.col("count") - F.col("mean")) / (F.col("e") * F.col("d") / F.col("e_all"))).alias("contribution"))
    deviation = part.groupBy("annotation", "cell").agg(F.sum("contribution").alias("deviation"))
    spread = deviation.groupBy("annotation").agg(F.stddev_samp("deviation").alias("sd"))
    every = Window.partitionBy("annotation", "feature")
    relative = F.when(F.col("sd") > 0, (F.col("contribution") - F.avg("contribution").over(every)) / F.col("sd")).otherwise(F.lit(0.0))
    return part.join(deviation, ["annotation", "cell"]).join(F.broadcast(spread), "annotation").select("annotation", "feature", "cell", "contribution", "deviation", relative.alias("relative"))


def reference_features(counts: DataFrame, cells: DataFrame, most: int = 50, seed: int = 1) -> DataFrame:
    """(feature, abundance, detection) over up to `most` hash-drawn cells per sample: log of the mean count per ten thousand, and
    the share of cells that have it. cells: cell, sample."""
    drawn = hash_sample(cells, most, "cell", ["sample"], seed).select("cell")
    own = counts.join(drawn, "cell", "left_semi")
    n = drawn.agg(F.count(F.lit(1)).alias("n"))
    depth = own.groupBy("cell").agg(F.sum("count").alias("d"))
    rows = own.join(depth, "cell").groupBy("feature").agg(F.sum(F.col("count") * 1e4 / F.col("d")).alias("s"), F.count(F.lit(1)).alias("k"))
    return rows.join(F.broadcast(n)).select("feature", F.log1p(F.col("s") / F.col("n")).alias("abundance"), (F.col("k") / F.col("n")).alias("detection"))


def nearest_features(reference: DataFrame, markers: DataFrame, k: int, levels: int = 16) -> DataFrame:
    """(feature, control, place): the k features that are nearest to each marker by scaled abundance and detection, ties by name,
    places from 0; markers are no controls, and features without a number take no part. Exact, by grids that halve their width.

    A marker uses the finest grid on which its square and the eight around it hold k features: the k nearest are within 2.83 widths
    then, so in the squares up to three away, and only those features are compared. Of features that lie at one point k are enough.
    """
    known = reference.filter("abundance IS NOT NULL AND detection IS NOT NULL")
    one = lambda x: F.coalesce(F.nullif(x, F.lit(0.0)), F.lit(1.0))
    scale = known.agg(one(F.stddev_samp("abundance")).alias("sa"), one(F.stddev_samp("detection")).alias("sd"), *[f(c).alias(n + c[0]) for n, f in (("lo_", F.min), ("hi_", F.max)) for c in ("abundance", "detection")])
    extent = F.greatest((F.col("hi_a") - F.col("lo_a")) / F.col("sa"), (F.col("hi_d") - F.col("lo_d")) / F.col("sd"), F.lit(1e-9))
    rows = known.join(F.broadcast(scale)).withColumns({"u": (F.col("abundance") - F.col("lo_a")) / F.col("sa"), "v": (F.col("detection") - F.col("lo_d")) / F.col("sd"), "extent": extent})
    rows = rows.select("feature", "abundance", "detection", "sa", "sd", F.explode(F.transform(F.sequence(F.lit(0), F.lit(levels - 1)), lambda i: F.struct(i.alias("level"), F.floor(F.col("u") * F.pow(F.lit(2.0), i) / F.col("extent")).alias("x"), F.floor(F.col("v") * F.pow(F.lit(2.0), i) / F.col("extent")).alias("y")))).alias("g"))
    rows = rows.select("feature", "abundance", "detection", "sa", "sd", "g.*")
    names = markers.select("feature").distinct()
    same = Window.partitionBy("level", "abundance", "detection").orderBy("feature")
    pool = rows.join(names, "feature", "left_anti").withColumn("_same", F.row_number().over(same)).filter(F.col("_same") <= k)
    pool = pool.select(F.col("feature").alias("control"), F.col("abundance").alias("a"), F.col("detection").alias("b"), "level", "x", "y")
    own = rows.join(names, "feature", "left_semi")

    def around(df: DataFrame, reach: int) -> DataFrame:
        steps = F.sequence(F.lit(-reach), F.lit(reach))
        return df.withColumn("_dx", F.explode(steps)).withColumn("_dy", F.explode(steps)).withColumns({"x": F.col("x") + F.col("_dx"), "y": F.col("y") + F.col("_dy")}).drop("_dx", "_dy")

    held = pool.groupBy("level", "x", "y").agg(F.count(F.lit(1)).alias("n"))
    finest = around(own.select("feature", "level", "x", "y"), 1).join(held, ["level", "x", "y"]).groupBy("feature", "level").agg(F.sum("n").alias("n"))
    finest = finest.filter((F.col("n") >= k) | (F.col("level") == 0)).groupBy("feature").agg(F.max("level").alias("level"))
    away = F.pow((F.col("abundance") - F.col("a")) / F.col("sa"), 2) + F.pow((F.col("detection") - F.col("b")) / F.col("sd"), 2)
    w = Window.partitionBy("feature").orderBy(F.round("away", 12), "control")
    near = around(own.join(finest, ["feature", "level"]), 3).join(pool, ["level", "x", "y"]).withColumn("away", away)
    return near.withColumn("place", F.row_number().over(w) - 1).filter(F.col("place") < k).select("feature", "control", "place")


def matched_controls(reference: DataFrame, sets: DataFrame, replicates: int = 999, neighbours: int = 50, seed: int = 1) -> DataFrame:
    """(label, marker, replicate, feature): for each marker and replicate one of its nearest features by scaled abundance and
    detection, drawn by hash; markers of any set are no controls."""
    near = nearest_features(reference, sets, neighbours)
    found = near.groupBy("feature").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "control"))), lambda x: x["control"]).alias("controls"))
    draws = sets.select("label", "feature").distinct().join(found, "feature").withColumn("replicate", F.explode(F.sequence(F.lit(1), F.lit(replicates))))
    at = F.pmod(F.xxhash64("label", "feature", "replicate", F.lit(seed)), F.size("controls")).cast("int")
    return draws.select("label", F.col("feature").alias("marker"), "replicate", F.get("controls", at).alias("feature"))


def control_scores(gaps: DataFrame, draws: DataFrame, max_rank: int = 1500) -> DataFrame:
    """(cluster, label, replicate, control): score of each replicate's controls; gaps: (cluster, feature, gap) mean rank gaps, 0
    where a row is missing."""
    size = draws.groupBy("label", "replicate").agg(F.count(F.lit(1)).alias("n"))
    grid = size.join(F.broadcast(gaps.select("cluster").distinct()))
    sums = draws.join(gaps, "feature").groupBy("cluster", "label", "replicate").agg(F.sum("gap").alias("g"))
    rows = grid.join(sums, ["cluster", "label", "replicate"], "left").fillna(0, ["g"])
    return rows.select("cluster", "label", "replicate", (F.col("g") / F.col("n") / (1 - (F.col("n") + 1) / (2.0 * max_rank))).alias("control"))


def allowed_offsets(blocks: DataFrame, forbidden: DataFrame, sizes: DataFrame, reach: tuple[int, int]) -> DataFrame:
    """(block, lo, hi): offsets, low to high exclusive, by which a block can move and stay on its chromosome, clear of forbidden
    ranges, by at least reach[0] and at most reach[1]. blocks: block, chr, start, end; sizes: chr, size."""
    near, far = reach
    placed = blocks.join(F.broadcast(sizes), "chr")
    least, most = -F.col("start"), F.col("size") - F.col("end")
    sides = F.array(F.struct(F.greatest(least, F.lit(-far)).alias("a"), F.least(most, F.lit(-near)).alias("b")), F.struct(F.greatest(least, F.lit(near)).alias("a"), F.least(most, F.lit(far)).alias("b")))
    ranges = placed.select("block", F.explode(sides).alias("x")).select("block", F.col("x.a").cast("bigint").alias("lo"), (F.col("x.b") + 1).cast("bigint").alias("hi")).filter("hi > lo")
    around = blocks.select("block", "chr", F.greatest(F.col("start") - far, F.lit(0)).alias("start"), (F.col("end") + far).alias("end"), F.col("start").alias("s"), F.col("end").alias("e"))
    hit = overlap_join(around, forbidden.select("chr", "start", "end"), max(1000, far // 4))
    barred = hit.select("block", (F.col("r_start") - F.col("e") + 1).cast("bigint").alias("lo"), (F.col("r_end") - F.col("s")).cast("bigint").alias("hi"))
    step = lambda df, d: df.select("block", F.explode(F.array(F.struct(F.col("lo").alias("pos"), F.lit(d).alias("d")), F.struct(F.col("hi").alias("pos"), F.lit(-d).alias("d")))).alias("x")).select("block", "x.*")
    at = step(ranges, 1).unionByName(step(barred, -1_000_000)).groupBy("block", "pos").agg(F.sum("d").alias("d"))
    w = Window.partitionBy("block").orderBy("pos")
    pieces = at.select("block", F.col("pos").alias("lo"), F.lead("pos").over(w).alias("hi"), F.sum("d").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("depth"))
    return pieces.filter("depth = 1 and hi is not null").select("block", "lo", "hi")


def shift_offsets(blocks: DataFrame, forbidden: DataFrame, sizes: DataFrame, draws: int, reach: tuple[int, int] = (500_000, 2_000_000), seed: int = 1) -> DataFrame:
    """(block, draw, shift): hash-drawn allowed offsets, each as likely as any; blocks that can't move have none.

    A draw is a number below the summed widths of the block's pieces; the piece is found by a search over cumulated widths."""
    pieces = allowed_offsets(blocks, forbidden, sizes, reach)
    listed = pieces.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("lo", "hi"))).alias("p"), F.sum(F.col("hi") - F.col("lo")).alias("total"))
    places = F.transform(F.sequence(F.lit(1), F.lit(draws)), lambda d: F.pmod(F.xxhash64("block", d, F.lit(seed)), F.col("total")))
    rows = listed.select("block", F.transform("p", lambda e: e["lo"]).alias("lo"), F.transform("p", lambda e: e["hi"]).alias("hi"), places.alias("places"))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                lo, hi, at = (batch.column(c).slice(i, 1).flatten().to_numpy() for c in (1, 2, 3))
                ends = np.cumsum(hi - lo)
                piece = np.searchsorted(ends, at, side="right")
                shift = lo[piece] + at - (ends - (hi - lo))[piece]
                yield pa.RecordBatch.from_arrays([pa.array([batch.column(0)[i].as_py()] * len(at), batch.column(0).type), pa.array(np.arange(1, len(at) + 1, dtype=np.int32)), pa.array(shift)], names=["block", "draw", "shift"])

    return rows.mapInArrow(look_up, f"block {pieces.schema['block'].dataType.simpleString()}, draw int, shift bigint")


def shifted_scores(variants: DataFrame, offsets: DataFrame, peaks: DataFrame, values: DataFrame, width: int, weight: str = "weight") -> DataFrame:
    """(draw, group, draw_score): weight x value of the peaks that shifted variants fall in. variants: block, chr, start, weight;
    values: peak, group, value."""
    moved = variants.join(offsets, "block").select("chr", "draw", (F.col("start") + F.col("shift")).alias("start"), (F.col("start") + F.col("shift") + 1).alias("end"), weight)
    hit = overlap_join(moved, peaks.select("chr", "start", "end", "peak"), width).groupBy("draw", F.col("r_peak").alias("peak")).agg(F.sum(weight).alias("w"))
    return hit.join(values, "peak").groupBy("draw", "group").agg(F.sum(F.col("w") * F.col("value")).alias("draw_score"))


def attribution_likelihood(counts: DataFrame, support: DataFrame, n_features: Column | int, prior_cells: float = 50.0) -> DataFrame:
    """(feature, group, likelihood): a group's share of reads in each peak, shrunken to the pooled share by as many reads as
    `prior_cells` average cells have, and a uniform `background`. counts: (feature, cell = group, count); support: group, n_cells."""
    reads = counts.groupBy(F.col("cell").alias("group")).agg(F.sum("count").alias("reads"))
    whole = reads.join(support, "group").agg(F.sum("reads").alias("all"), (prior_cells * F.sum("reads") / F.sum("n_cells")).alias("prior"))
    pooled = counts.groupBy("feature").agg(F.sum("count").alias("f"))
    grid = pooled.join(F.broadcast(reads.join(F.broadcast(whole))))
    rows = grid.join(counts.withColumnRenamed("cell", "group"), ["feature", "group"], "left").fillna(0, ["count"])
    own = rows.select("feature", F.col("group").cast("string").alias("group"), ((F.col("count") + F.col("prior") * F.col("f") / F.col("all")) / (F.col("reads") + F.col("prior"))).alias("likelihood"))
    return own.unionByName(pooled.select("feature", F.lit("background").alias("group"), (F.lit(1.0) / n_features).alias("likelihood")))


def held_out_folds(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    """df with `fold`: keys (chromosomes) in order dealt over n folds."""
    order = Window.orderBy(key)
    return df.join(F.broadcast(df.select(key).distinct().withColumn("fold", (F.row_number().over(order) % n).cast("bigint"))), key)


def locus_shares(pairs: DataFrame, likelihood: DataFrame, by: Sequence[str] = ("locus",)) -> DataFrame:
    """(locus, group, share): mass of each locus by group in proportion to the likelihoods of its peaks. pairs: locus, feature, mass."""
    rows = pairs.join(likelihood, "feature")
    part = rows.withColumn("p", F.col("mass") * F.col("likelihood") / F.sum("likelihood").over(Window.partitionBy(*by, "feature")))
    sums = part.groupBy(*by, "group").agg(F.sum("p").alias("p"))
    return sums.select(*by, "group", (F.col("p") / F.sum("p").over(Window.partitionBy(*by))).alias("share"))
