"""Labels and evidence: recoding, rank scores of marker sets, group membership, attribution shares."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.tails import poisson_above
from .intervals import merge_intervals, overlap_join


def recode(df: DataFrame, column: str, mapping: dict[str, str]) -> DataFrame:
    """Labels replaced by a dictionary; labels that it lacks pass through."""
    pairs = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv]) if mapping else None
    return df if pairs is None else df.withColumn(column, F.coalesce(F.element_at(pairs, F.col(column)), F.col(column)))


def map_keys(df: DataFrame, column: str, mapping: DataFrame, source: str, target: str, strict: bool = False) -> DataFrame:
    """df with `target` by a mapping table whose sources are unique; strict: raises if a key has no partner."""
    out = df.join(mapping.select(F.col(source).alias(column), target), column, "left")
    if strict and not out.filter(F.col(target).isNull() & F.col(column).isNotNull()).isEmpty():
        raise ValueError(f"{column} has keys without a partner")
    return out


def with_fallback(df: DataFrame, labels: DataFrame, key: str, label: str, prefix: str) -> DataFrame:
    """df with each group's label, or `<prefix><key>` where it has none."""
    return df.join(labels.select(key, label), key, "left").withColumn(label, F.coalesce(F.col(label), F.concat(F.lit(prefix), F.col(key).cast("string"))))


def rank_scores(counts: DataFrame, sets: DataFrame, n_features: int, max_rank: int = 1500) -> DataFrame:
    """(cell, label, score): mean rank gap of a set's features over its greatest possible value.

    Features are ranked in each cell by falling count with average ties; features without counts tie at the end, so only
    nonzeros are ranked and a feature that a cell lacks gets the closed-form rank. Ranks beyond max_rank count as max_rank.
    """
    w = Window.partitionBy("cell")
    ties = F.count(F.lit(1)).over(Window.partitionBy("cell", "count"))
    ranked = counts.filter("count > 0").withColumn("rank", F.rank().over(w.orderBy(F.col("count").desc())) + (ties - 1) / 2)
    gap = lambda r: 1 - F.least(r, F.lit(float(max_rank))) / max_rank
    cells = ranked.groupBy("cell").agg(F.count(F.lit(1)).alias("k"))
    sizes = sets.groupBy("label").agg(F.countDistinct("feature").alias("n"))
    seen = ranked.join(sets.distinct(), "feature").groupBy("cell", "label").agg(F.sum(gap(F.col("rank"))).alias("g"), F.count(F.lit(1)).alias("m"))
    grid = cells.join(F.broadcast(sizes)).join(seen, ["cell", "label"], "left").fillna(0, ["g", "m"])
    zero = gap(F.col("k") + (n_features - F.col("k") + 1) / 2.0)
    mean = (F.col("g") + (F.col("n") - F.col("m")) * zero) / F.col("n")
    return grid.select("cell", "label", (mean / (1 - (F.col("n") + 1) / (2.0 * max_rank))).alias("score"))


def control_evidence(observed: DataFrame, controls: DataFrame, by: Sequence[str]) -> DataFrame:
    """Observed score, mean and 95th percentile of its controls, excess over that, and the share of controls at least as great."""
    both = observed.join(controls, list(by))
    per = both.groupBy(*by, "score").agg(F.avg("control").alias("mean"), F.percentile("control", 0.95).alias("q95"), F.avg((F.col("control") >= F.col("score")).cast("double")).alias("tail"))
    return per.withColumn("excess", F.col("score") - F.col("q95"))


def nested_groups(df: DataFrame, group: str, key: str, least: int) -> DataFrame:
    """(group, n, keys): groups with at least `least` keys and those keys in order; a group's keys are taken to fit a row."""
    return df.groupBy(group).agg(F.countDistinct(key).alias("n"), F.array_sort(F.collect_set(key)).alias("keys")).filter(F.col("n") >= least)


def group_diagnostics(df: DataFrame, group: str, key: str, least: int) -> DataFrame:
    """Groups under the minimum, with the reason."""
    n = df.groupBy(group).agg(F.countDistinct(key).alias("n"))
    return n.filter(F.col("n") < least).withColumn("reason", F.concat(F.lit("fewer than "), F.lit(least), F.lit(" cells")))


def effect_route(df: DataFrame, trait: str, locus: str, has_effect: Column) -> DataFrame:
    """Which weights a trait allows: all variants have an effect, else every locus has one, else none; with the counts."""
    per = df.groupBy(trait, locus).agg(F.bool_and(has_effect).alias("all"), F.bool_or(has_effect).alias("any"), F.count(F.lit(1)).alias("n"), F.count_if(has_effect).alias("n_own"))
    route = F.when(F.bool_and("all"), "variant").when(F.bool_and("any"), "locus").otherwise("skip")
    return per.groupBy(trait).agg(route.alias("route"), F.sum("n").alias("n_variants"), F.sum("n_own").alias("n_with_effect"), F.count(F.lit(1)).alias("n_loci"))


def background_shares(df: DataFrame, locus: str, group: str, value: str, background: str) -> DataFrame:
    """Shares without the background group, and their fold over an even share."""
    w = Window.partitionBy(locus)
    base = F.max(F.when(F.col(group) == background, F.col(value))).over(w)
    rows = df.withColumn("_b", F.coalesce(base, F.lit(0.0))).withColumn("_n", F.count_if(F.col(group) != background).over(w)).filter(F.col(group) != background)
    share = F.when(F.col("_b") < 1, F.col(value) / (1 - F.col("_b"))).otherwise(F.lit(0.0))
    return rows.select(locus, group, share.alias("share"), (share * F.col("_n")).alias("fold"))


def top_two(df: DataFrame, by: str, label: str, value: str) -> DataFrame:
    """One row a group: first and second label and their values; ties by label."""
    w = Window.partitionBy(by).orderBy(F.col(value).desc(), label)
    ranked = df.withColumn("_n", F.row_number().over(w)).filter("_n <= 2")
    at = lambda c, n: F.max(F.when(F.col("_n") == n, F.col(c)))
    return ranked.groupBy(by).agg(at(label, 1).alias("first"), at(value, 1).alias("first_value"), at(label, 2).alias("second"), at(value, 2).alias("second_value"))


def drop_crowded(loci: DataFrame, least_p: float = 0.01, width: int = 10_000) -> DataFrame:
    """Loci outside merged regions that more loci share than chance has it: Poisson upper tail at the mean over all regions."""
    merged = merge_intervals(loci)
    mean = merged.agg(F.avg("n").alias("mean"))
    crowded = merged.join(F.broadcast(mean)).filter(poisson_above(F.col("n"), F.col("mean")) < least_p)
    return overlap_join(loci, crowded.select("chr", "start", "end"), width, how="left_anti")
