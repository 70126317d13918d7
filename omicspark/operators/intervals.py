"""Intervals (chr, start, end), 0-based and half-open: merging, pieces, gaps, joins, coverage."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .loops import cut

CHR, START, END = "chr", "start", "end"


def _past(by: Sequence[str]) -> Window:
    return Window.partitionBy(*by).orderBy(START, END).rowsBetween(Window.unboundedPreceding, -1)


def merge_intervals(df: DataFrame, by: Sequence[str] = (CHR,), gap: int = 0, width: int | None = None) -> DataFrame:
    """Union of intervals per group; those at most `gap` apart are joined (-1: touching ones stay apart). `n` counts the parts.

    With a width, intervals are first merged within bins of their starts, in as many tasks as there are bins, so that the
    pass over whole groups sees islands only.
    """

    def islands(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy(START, END)
        reach = F.max(END).over(w.rowsBetween(Window.unboundedPreceding, -1))
        new = F.when(reach.isNull() | (F.col(START) > reach + gap), 1).otherwise(0)
        runs = rows.withColumn("_new", new).withColumn("_island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
        return runs.groupBy(*keys, "_island").agg(F.min(START).alias(START), F.max(END).alias(END), F.sum("n").alias("n")).drop("_island")

    rows = df.select(*by, START, END, F.lit(1).cast("bigint").alias("n"))
    if width:
        rows = islands(rows.withColumn("_bin", F.floor(F.col(START) / width)), (*by, "_bin")).drop("_bin")
    return islands(rows, by)


def disjoin(df: DataFrame, by: Sequence[str] = (CHR,)) -> DataFrame:
    """Disjoint pieces between all breakpoints that at least one interval covers, with that depth."""
    steps = df.select(*by, F.col(START).alias("pos"), F.lit(1).alias("d")).unionByName(df.select(*by, F.col(END).alias("pos"), F.lit(-1).alias("d")))
    at = steps.groupBy(*by, "pos").agg(F.sum("d").alias("d"))
    w = Window.partitionBy(*by).orderBy("pos")
    depth = F.sum("d").over(w.rowsBetween(Window.unboundedPreceding, 0))
    pieces = at.select(*by, F.col("pos").alias(START), F.lead("pos").over(w).alias(END), depth.alias("depth"))
    return pieces.filter((F.col("depth") > 0) & F.col(END).isNotNull())


def deep_regions(df: DataFrame, least: int, by: Sequence[str] = (CHR,)) -> DataFrame:
    """Maximal runs covered by `least` intervals or more; ends come before starts at equal places."""
    deep = disjoin(df, by).filter(F.col("depth") >= least)
    return merge_intervals(deep, by).select(*by, START, END)


def gaps(df: DataFrame, by: Sequence[str] = (CHR,)) -> DataFrame:
    """What lies between the merged intervals of each group."""
    merged = merge_intervals(df, by)
    before = F.lag(END).over(Window.partitionBy(*by).orderBy(START))
    return merged.select(*by, before.alias(START), F.col(START).alias(END)).filter(F.col(START).isNotNull() & (F.col(START) < F.col(END)))


def overlap_join(left: DataFrame, right: DataFrame, width: int, by: Sequence[str] = (CHR,), how: str = "inner", slack: int = 0) -> DataFrame:
    """Pairs of left and right intervals that overlap or lie at most `slack` apart; columns of the right get the prefix r_.

    Both sides are dealt into bins of `width`, so the join is an equi-join; each pair is kept in the bin where it begins.
    how: inner, left_semi or left_anti.
    """
    bins = lambda lo, hi: F.sequence(F.floor(lo / width), F.floor((hi - 1) / width))
    r = right.select(*[F.col(c).alias(f"r_{c}") for c in right.columns])
    r = r.withColumn("_bin", F.explode(bins(F.col("r_start") - slack, F.col("r_end") + slack)))
    if how != "inner":
        left = left.withColumn("_id", F.struct(*left.columns))
    a = left.withColumn("_bin", F.explode(bins(F.col(START), F.col(END))))
    on = [a[c] == r[f"r_{c}"] for c in by] + [a["_bin"] == r["_bin"], a[START] < r["r_end"] + slack, r["r_start"] - slack < a[END]]
    if how == "inner":
        first = F.floor(F.greatest(a[START], r["r_start"] - slack) / width)
        return a.join(r, on).filter(a["_bin"] == first).drop("_bin")
    hit = a.join(r, on, "left_semi").select("_id").distinct()
    return left.join(hit, "_id", how).drop("_id")


def places(df: DataFrame, by: Sequence[str] = (CHR,), **totals: Column) -> DataFrame:
    """(by..., start, end, totals...): each different interval once, so that copies of an interval meet others once; totals: aggregates
    by name."""
    return df.groupBy(*by, START, END).agg(*[c.alias(name) for name, c in totals.items()]) if totals else df.select(*by, START, END).distinct()


def asof_region(points: DataFrame, regions: DataFrame, pos: str, by: Sequence[str] = (CHR,), width: int = 10_000) -> DataFrame:
    """points with r_start and r_end of the disjoint region that holds them (null: none).

    Regions are dealt into bins, so this is an equi-join of a point with the regions of its bin; points stay one row each.
    """
    r = regions.select(*[F.col(c).alias(f"_{c}") for c in by], F.col(START).cast("bigint").alias("r_start"), F.col(END).cast("bigint").alias("r_end"))
    r = r.withColumn("_rbin", F.explode(F.sequence(F.floor(F.col("r_start") / width), F.floor((F.col("r_end") - 1) / width))))
    p = points.withColumn("_pbin", F.floor(F.col(pos) / width))
    on = [p[c] == r[f"_{c}"] for c in by] + [p["_pbin"] == r["_rbin"], p[pos] >= r["r_start"], p[pos] < r["r_end"]]
    return p.join(r, on, "left").select(*[p[c] for c in points.columns], "r_start", "r_end")


def fragments_in_regions(fragments: DataFrame, regions: DataFrame, cell: str, width: int = 10_000) -> DataFrame:
    """(cell, n_fragments, n_in, fraction): a fragment counts once if either of its ends lies in a merged region."""
    merged = merge_intervals(regions)
    first = asof_region(fragments, merged, START, width=width).withColumnRenamed("r_start", "_a").drop("r_end").withColumn("_last", F.col(END) - 1)
    second = asof_region(first, merged, "_last", width=width)
    hit = F.col("_a").isNotNull() | F.col("r_start").isNotNull()
    return second.groupBy(cell).agg(F.count(F.lit(1)).alias("n_fragments"), F.count_if(hit).alias("n_in")).withColumn("fraction", F.col("n_in") / F.col("n_fragments"))


def cut_sites_per_region(fragments: DataFrame, regions: DataFrame, cell: str, name: str, width: int) -> DataFrame:
    """(name, cell, n): fragments with a cut site (first or last base) in each region, once per region.

    Cells are counted by different places of regions, whose copies would repeat the work. A place's counts are then given to every region
    there; only names that have several places are added up again.
    """
    at = [CHR, START, END]
    spots = cut(places(regions).withColumn("place", F.monotonically_increasing_id()))
    several = regions.groupBy(F.col(name).alias("_name")).agg(F.count(F.lit(1)).alias("_k"))
    named = cut(regions.select(name, *at).join(spots, at).join(several, F.col(name).eqNullSafe(F.col("_name"))).select(name, "place", "_k"))
    inside = lambda p: (p >= F.col("r_start")) & (p < F.col("r_end"))
    own = fragments.select(cell, *at).repartition(cell)  # a cell's pairs are counted where it lies; the pairs aren't shuffled
    pairs = overlap_join(own, spots, width).filter(inside(F.col(START)) | inside(F.col(END) - 1))
    held = pairs.groupBy(cell, F.col("r_place").alias("place")).agg(F.count(F.lit(1)).alias("n")).join(named, "place")
    if named.filter("_k > 1").isEmpty():
        return held.select(name, cell, "n")
    again = held.filter("_k > 1").groupBy(name, cell).agg(F.sum("n").alias("n"))
    return held.filter("_k = 1").select(name, cell, "n").unionByName(again)


def tss(start: Column, end: Column, strand: Column) -> Column:
    return F.when(strand == "-", end - 1).otherwise(start)


def band_pairs(peaks: DataFrame, genes: DataFrame, reach: int = 250_000, upstream: int = 1_500, downstream: int = 500, near: int = 10_000) -> DataFrame:
    """Peaks whose centre lies within `reach` of a gene's TSS: distance (centre less TSS), promoter and body flags, class.

    A promoter peak overlaps the window from `upstream` before to `downstream` behind the TSS, along the strand; a body
    peak overlaps the gene; the rest is proximal up to `near`, then distal. peaks: chr, start, end, peak; genes: chr, start,
    end, strand, gene. One row a pair.
    """
    centre = F.floor((F.col(START) + F.col(END)) / 2)
    sites = genes.withColumn("tss", tss(F.col(START), F.col(END), F.col("strand")))
    minus = F.col("strand") == "-"
    sites = sites.select(CHR, F.col("tss").alias(START), (F.col("tss") + 1).alias(END), "tss", F.col(START).alias("g_start"), F.col(END).alias("g_end"), (F.col("tss") - F.when(minus, downstream).otherwise(upstream)).alias("p_start"), (F.col("tss") + F.when(minus, upstream).otherwise(downstream)).alias("p_last"), "gene")
    middles = peaks.select(CHR, centre.alias(START), (centre + 1).alias(END), centre.alias("centre"), F.col(START).alias("a"), F.col(END).alias("b"), "peak")
    pairs = overlap_join(middles, sites, reach + 1, slack=reach)
    body = (F.col("b") > F.col("r_g_start")) & (F.col("a") < F.col("r_g_end"))
    promoter = (F.col("b") > F.col("r_p_start")) & (F.col("a") <= F.col("r_p_last"))
    rows = pairs.select("chr", "peak", F.col("r_gene").alias("gene"), (F.col("centre") - F.col("r_tss")).alias("distance"), body.alias("in_body"), promoter.alias("promoter"))
    kind = F.when(F.col("promoter"), "self_promoter").when(F.col("in_body"), "target_gene_body").when(F.abs("distance") <= near, "proximal_nonpromoter").otherwise("distal")
    return rows.withColumn("link_class", kind).distinct()


def remove_overlaps(df: DataFrame, score: str, name: str, by: Sequence[str] = (CHR,), width: int = 1_000_000) -> DataFrame:
    """Greedy removal: of each cluster of overlapping intervals the best score stays (ties: name), what overlaps it goes, and
    again with the rest. One sweep an island from its best interval on; the state is what stays of the island."""
    island = asof_region(df, merge_intervals(df, by, -1, width), START, by, width)
    best = Window.partitionBy(*by, "r_start").orderBy(F.col(score).desc(), name)
    ranked = island.withColumn("_rank", F.row_number().over(best))
    rows = ranked.repartition(*by, "r_start").sortWithinPartitions(*by, "r_start", "_rank").select(*df.columns, F.col(START).alias("_s"), F.col(END).alias("_e"), "_rank")

    columns = df.columns

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts: list = []
        ends: list = []
        for batch in batches:
            stays = []
            for s, e, rank in zip(*(batch.column(batch.num_columns - j).to_pylist() for j in (3, 2, 1)), strict=True):
                if rank == 1:
                    starts, ends = [], []
                i = bisect_left(starts, e)  # what stays is disjoint, so the last that starts before e ends last
                stays.append(not i or ends[i - 1] <= s)
                if stays[-1]:
                    i = bisect_left(starts, s) if s == e else bisect_right(starts, s)
                    starts.insert(i, s)
                    ends.insert(i, e)
            yield pa.RecordBatch.from_arrays(batch.columns[:-3], names=columns).filter(pa.array(stays, pa.bool_()))

    return rows.mapInArrow(sweep, df.schema)


def binned_coverage(fragments: DataFrame, group: str, width: int) -> DataFrame:
    """Both cut sites of each fragment counted by fixed tile and group, per million of the group's sites."""
    sites = fragments.select(group, CHR, F.explode(F.array(F.col(START), F.col(END) - 1)).alias("pos"))
    tiles = sites.groupBy(group, CHR, F.floor(F.col("pos") / width).alias("tile")).agg(F.count(F.lit(1)).alias("n"))
    return tiles.withColumn("rpm", F.col("n") * 1e6 / F.sum("n").over(Window.partitionBy(group)))


def pairwise_overlap(df: DataFrame, owner: str, width: int = 10_000) -> DataFrame:
    """Shared bases, Jaccard and overlap coefficient of every two owners' merged intervals that share a piece (owners: few)."""
    own = merge_intervals(df, (owner, CHR)).select(owner, CHR, START, END)
    pieces = overlap_join(own, disjoin(own.drop(owner)).select(CHR, START, END), width)
    held = pieces.groupBy(CHR, "r_start", "r_end").agg(F.sort_array(F.collect_set(owner)).alias("owners"))
    pair = held.select((F.col("r_end") - F.col("r_start")).alias("w"), F.explode("owners").alias("a"), "owners").select("w", "a", F.explode("owners").alias("b")).filter("a < b")
    size = own.groupBy(owner).agg(F.sum(F.col(END) - F.col(START)).alias("size"))
    sizes = lambda x: F.broadcast(size.select(F.col(owner).alias(x), F.col("size").alias(f"size_{x}")))
    shared = pair.groupBy("a", "b").agg(F.sum("w").cast("bigint").alias("shared")).join(sizes("a"), "a").join(sizes("b"), "b")
    return shared.select("a", "b", "shared", (F.col("shared") / (F.col("size_a") + F.col("size_b") - F.col("shared"))).alias("jaccard"), (F.col("shared") / F.least("size_a", "size_b")).alias("coefficient"))


def link_coverage(fragments: DataFrame, windows: DataFrame, name: str, group: str, width: int) -> DataFrame:
    """(name, bin, n): cut sites of each window's own group, by bins of the window; all windows in one pass."""
    sites = fragments.select(group, CHR, F.explode(F.array(F.col(START), F.col(END) - 1)).alias(START)).withColumn(END, F.col(START) + 1)
    pairs = overlap_join(sites, windows, 64, by=(CHR, group))
    return pairs.groupBy(F.col(f"r_{name}").alias(name), F.floor((F.col(START) - F.col("r_start")) / width).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
