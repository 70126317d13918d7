"""Partitioned heritability: annotations over pieces, models that share block cross-products, shares with ratio jackknife, mass shares."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .intervals import disjoin, merge_intervals, overlap_join
from .loops import numbered


def greatest_over_pieces(df: DataFrame, value: str, width: int, by: Sequence[str] = ("chr",)) -> DataFrame:
    """Disjoint pieces of all ranges with the greatest value of those that cover each."""
    pieces = disjoin(df, by).select(*by, "start", "end")
    hits = overlap_join(pieces, df.select(*by, "start", "end", value), width, by)
    return hits.groupBy(*by, "start", "end").agg(F.max(f"r_{value}").alias(value))


def top_share(df: DataFrame, group: str, score: str, size: str, share: float, key: str) -> DataFrame:
    """Pieces of each group from the highest score on (ties: key) until their sizes reach a share of the group's: a piece stays if
    those before it are below it."""
    w = Window.partitionBy(group).orderBy(F.col(score).desc(), key)
    before = F.coalesce(F.sum(size).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = df.withColumns({"_b": before, "_t": F.sum(size).over(Window.partitionBy(group))})
    return rows.filter(F.col("_b") < share * F.col("_t")).drop("_b", "_t")


def unfilled(reached: DataFrame, wanted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(first key, missing): wanted combinations that aren't there, the second keys joined by commas."""
    left = wanted.join(reached.select(*keys), list(keys), "left_anti")
    return left.groupBy(keys[0]).agg(F.array_join(F.array_sort(F.collect_list(F.col(keys[1]).cast("string"))), ",").alias("missing"))


def _block_arrays(rows: pd.DataFrame, n: int) -> tuple[np.ndarray, np.ndarray]:
    at = {b: k for k, b in enumerate(sorted(rows["block"].unique()))}
    xtx, xty = np.zeros((len(at), n, n)), np.zeros((len(at), n))
    for b, i, j, v in rows[["block", "i", "j", "value"]].itertuples(index=False):
        if j < 0:
            xty[at[b], i] = v
        else:
            xtx[at[b], i, j] = v
    return xtx, xty


def fit_models(blocks: DataFrame, models: dict[str, Sequence[int]], n_terms: int, without: int = 0) -> DataFrame:
    """(model, term, estimate, se, z): regressions on subsets of the terms, all from one table of block cross-products, with delete-one-
    block jackknife; without: the blocks of greatest influence on the last term are left out first. Models without full rank have none.

    blocks: (block, i, j, value), as `block_crossproducts` gives them: of the size of blocks x terms x terms."""

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        xtx, xty = _block_arrays(rows, n_terms)
        out = []
        for name, terms in models.items():
            t = list(terms)
            a, b = xtx[:, t][:, :, t], xty[:, t]

            def run(keep: np.ndarray, a: np.ndarray = a, b: np.ndarray = b) -> tuple[np.ndarray, np.ndarray]:
                whole = np.linalg.solve(a[keep].sum(0), b[keep].sum(0))
                return whole, np.stack([np.linalg.solve(a[keep].sum(0) - a[k], b[keep].sum(0) - b[k]) for k in keep])

            keep = np.arange(len(a))
            if np.linalg.matrix_rank(a.sum(0)) < len(t):
                continue
            whole, each = run(keep)
            if without:
                keep = np.sort(np.argsort(-np.abs(each[:, -1] - whole[-1]), kind="stable")[without:])
                whole, each = run(keep)
            k = len(keep)
            se = np.sqrt((k - 1) / k * ((each - each.mean(0)) ** 2).sum(0))
            out += [(name, int(i), float(e), float(s), float(e / s) if s > 0 else None) for i, e, s in zip(t, whole, se, strict=True)]
        return pd.DataFrame(out, columns=["model", "term", "estimate", "se", "z"])

    return blocks.groupBy(F.lit(1).alias("one")).applyInPandas(solve, "model string, term int, estimate double, se double, z double")


def standardised_effects(fits: DataFrame, spreads: DataFrame, scale: float) -> DataFrame:
    """fits with `standardised`: the estimate times the annotation's standard deviation and a scale (variants over heritability).
    spreads: term, sd."""
    return fits.join(F.broadcast(spreads), "term").withColumn("standardised", F.col("estimate") * F.col("sd") * scale)


def share_jackknife(blocks: DataFrame, overlap: dict[str, Sequence[float]], total: Sequence[float], n_terms: int) -> DataFrame:
    """(annotation, share, se): the annotation's part of the fitted total, sum(overlap x estimate) / sum(total x estimate), with the
    jackknife of that ratio. Terms as in blocks; overlap and total: variants of each term in the annotation and in all."""

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        xtx, xty = _block_arrays(rows, n_terms)
        whole = np.linalg.solve(xtx.sum(0), xty.sum(0))
        each = np.stack([np.linalg.solve(xtx.sum(0) - a, xty.sum(0) - c) for a, c in zip(xtx, xty, strict=True)])
        k, all_ = len(each), np.asarray(total, float)
        out = []
        for name, o in overlap.items():
            r, ratios = (whole @ np.asarray(o, float)) / (whole @ all_), (each @ np.asarray(o, float)) / (each @ all_)
            out.append((name, float(r), float(np.sqrt((k - 1) / k * ((ratios - ratios.mean()) ** 2).sum()))))
        return pd.DataFrame(out, columns=["annotation", "share", "se"])

    return blocks.groupBy(F.lit(1).alias("one")).applyInPandas(solve, "annotation string, share double, se double")


def merged_loci(variants: DataFrame, locus: str, apart: int) -> DataFrame:
    """(locus, island): loci whose spans lie at most `apart` from each other share an island, numbered by its start."""
    spans = variants.groupBy("chr", locus).agg(F.min("start").alias("start"), F.max("end").alias("end"))
    islands = merge_intervals(spans, gap=apart).select("chr", "start", "end")
    hit = overlap_join(spans, islands, max(1, apart))
    return hit.select(locus, F.concat_ws(":", "chr", "r_start").alias("island")).distinct()


def multinomial_weights(clusters: DataFrame, cluster: str, draws: int, seed: int = 1) -> DataFrame:
    """(cluster, draw, times): how often each of n clusters is taken in n hash-drawn picks with replacement, draw by draw."""
    own = numbered(clusters.select(cluster).distinct(), [cluster], "_number")
    n = own.count()
    picks = own.select("_number", F.explode(F.sequence(F.lit(1), F.lit(draws))).alias("draw")).select("draw", F.pmod(F.xxhash64("_number", "draw", F.lit(seed)), F.lit(max(n, 1))).alias("_number"))
    return picks.groupBy("draw", "_number").agg(F.count(F.lit(1)).alias("times")).join(own, "_number").select(cluster, "draw", "times")


def mass_inside(variants: DataFrame, ranges: DataFrame, width: int, mass: str = "pip") -> DataFrame:
    """(annotation, locus, inside, total): mass of each locus inside each annotation's ranges; a variant counts once. ranges: chr,
    start, end, annotation. Ranges of an annotation that overlap are merged first, so a variant meets few of them."""
    merged = merge_intervals(ranges, ("annotation", "chr"), -1, width).drop("n")
    hit = overlap_join(variants, merged, width).select("locus", "variant", mass, F.col("r_annotation").alias("annotation")).distinct()
    inside = hit.groupBy("annotation", "locus").agg(F.sum(mass).alias("inside"))
    total = variants.groupBy("locus").agg(F.sum(mass).alias("total"))
    return total.join(F.broadcast(ranges.select("annotation").distinct())).join(inside, ["annotation", "locus"], "left").fillna(0.0, ["inside"]).select("annotation", "locus", "inside", "total")


def mass_shares(inside: DataFrame, islands: DataFrame, draws: int = 1_000, seed: int = 1) -> DataFrame:
    """(annotation, share, se, low, high): share of all mass, with its spread over resamples of islands of loci."""
    per = inside.join(islands, "locus").groupBy("annotation", "island").agg(F.sum("inside").alias("i"), F.sum("total").alias("t"))
    share = per.groupBy("annotation").agg((F.sum("i") / F.sum("t")).alias("share"))
    drawn = per.join(multinomial_weights(islands, "island", draws, seed), "island").groupBy("annotation", "draw").agg((F.sum(F.col("i") * F.col("times")) / F.sum(F.col("t") * F.col("times"))).alias("s"))
    return share.join(drawn.groupBy("annotation").agg(F.stddev_samp("s").alias("se"), F.percentile("s", 0.025).alias("low"), F.percentile("s", 0.975).alias("high")), "annotation")


def enrichment(shares: DataFrame, sizes: DataFrame, on: Sequence[str], share: str = "share", size: str = "size") -> DataFrame:
    """shares with `enrichment`: share of mass over share of variants; null for an empty annotation."""
    return shares.join(sizes.select(*on, size), list(on)).withColumn("enrichment", F.when(F.col(size) > 0, F.col(share) / F.col(size)))


def locus_contributions(inside: DataFrame, variants: DataFrame, mass: str = "pip") -> DataFrame:
    """(annotation, locus, contribution, lead): what each locus adds to the annotation's share of mass, and its best variant."""
    lead = variants.groupBy("locus").agg(F.max_by("variant", F.struct(F.col(mass), -F.col("variant"))).alias("lead"))
    every = F.sum("total").over(Window.partitionBy("annotation"))
    return inside.withColumn("contribution", F.col("inside") / every).filter("inside > 0").join(lead, "locus").select("annotation", "locus", "contribution", "lead")
