"""Verbs over keyed tables: completion, composition, cross-tabulation, waterfalls, numbering, sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ranks import average_rank, correlation, natural_key, share, top_n


def complete(df: DataFrame, first: Sequence[str], second: Sequence[str], fill: dict) -> DataFrame:
    """All combinations of the distinct keys on both sides; missing ones get the fill values. The second side is small (labels)."""
    grid = df.select(*first).distinct().join(F.broadcast(df.select(*second).distinct()))
    return grid.join(df, [*first, *second], "left").fillna(fill)


def number_by_size(df: DataFrame, label: str) -> DataFrame:
    """(label, n, number): groups numbered from 1 by size, largest first; ties by natural order of the label."""
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    order = Window.orderBy(F.col("n").desc(), natural_key(F.col(label).cast("string")), label)
    return sizes.withColumn("number", F.row_number().over(order).cast("bigint"))


def large_groups(df: DataFrame, label: str, least: int) -> DataFrame:
    """Rows of groups with at least `least` rows."""
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= least)
    return df.join(sizes, label, "left_semi")


def cross_table(df: DataFrame, row: str, column: str) -> DataFrame:
    """Counts of both labels, zero-completed, with the fraction of the row."""
    n = df.groupBy(row, column).agg(F.count(F.lit(1)).alias("n"))
    return complete(n, [row], [column], {"n": 0}).withColumn("fraction", share("n", [row]))


def composition(df: DataFrame, group: str, variables: Sequence[str], least: float = 0.05) -> DataFrame:
    """Per variable and group: top category, its share, and the categories above `least` as one text."""
    long = df.select(group, F.explode(F.array(*[F.struct(F.lit(v).alias("variable"), F.col(v).cast("string").alias("category")) for v in variables])).alias("x")).select(group, "x.*")
    n = long.groupBy("variable", group, "category").agg(F.count(F.lit(1)).alias("n")).withColumn("share", share("n", ["variable", group]))
    order = F.struct("n", F.struct((-F.col("n")).alias("a"), "category"))
    listed = F.array_sort(F.collect_list(F.when(F.col("share") > least, F.struct((-F.col("n")).alias("n"), "category"))))
    top = F.array_min(F.collect_list(F.struct((-F.col("n")).alias("n"), "category", "share")))
    del order
    return n.groupBy("variable", group).agg(top.alias("t"), listed.alias("l")).select("variable", group, F.col("t.category").alias("top"), F.col("t.share").alias("share"), F.array_join(F.transform("l", lambda x: x["category"]), ",").alias("above"))


def best_and_second(df: DataFrame, group: str, label: str, score: str, least: float) -> DataFrame:
    """Best and second label of each group by score (ties: label), the margin, and whether it reaches `least`."""
    w = Window.partitionBy(group).orderBy(F.col(score).desc(), label)
    ranked = df.select(group, F.col(label).alias("best"), F.col(score).alias("best_score"), F.lead(label).over(w).alias("second"), (F.col(score) - F.lead(score).over(w)).alias("margin"), F.row_number().over(w).alias("_n"))
    status = F.when(F.col("best_score") <= 0, "no_evidence").when(F.coalesce(F.col("margin"), F.lit(0.0)) < least, "close").otherwise("assigned")
    return ranked.filter("_n = 1").drop("_n").withColumn("status", status)


def waterfall(df: DataFrame, by: Sequence[str], value: str, label: str) -> DataFrame:
    """Running start and end of signed parts, largest absolute value first, with their place."""
    w = Window.partitionBy(*by).orderBy(F.abs(F.col(value)).desc(), label)
    end = F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return df.select(*by, label, value, F.row_number().over(w).cast("bigint").alias("place"), (end - F.col(value)).alias("begin"), end.alias("end"))


def collapse_rest(df: DataFrame, by: Sequence[str], label: str, value: str, n: int) -> DataFrame:
    """The n parts of greatest absolute sum (over all groups) by name; the rest as `other +` and `other -` of each group."""
    top = top_n(df.groupBy(label).agg(F.sum(F.abs(F.col(value))).alias("_s")), n, [F.col("_s").desc(), F.col(label)]).select(label, F.lit(True).alias("_top"))
    name = F.when(F.col("_top"), F.col(label).cast("string")).when(F.col(value) >= 0, "other +").otherwise("other -")
    return df.join(F.broadcast(top), label, "left").groupBy(*by, name.alias("part")).agg(F.sum(value).alias(value))


def percentile_rank(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """df with `pct`: average-tie rank over the number of values in the group."""
    return df.withColumn("pct", average_rank(value, by) / F.count(value).over(Window.partitionBy(*by)))


def hash_sample(df: DataFrame, n: int, key: str, by: Sequence[str] = (), seed: int = 1) -> DataFrame:
    """n rows per group without replacement, drawn by a hash of the key: the same rows however the table is partitioned."""
    return top_n(df.withColumn("_draw", F.xxhash64(key, F.lit(seed))), n, [F.col("_draw"), F.col(key)], by).drop("_draw")


def hashed_halves(df: DataFrame, key: str, by: Sequence[str], depth: str, least: int, cap: int, seed: int = 1) -> DataFrame:
    """Replicate of each row: groups are capped to `cap` rows drawn by hash and dealt into two halves, or one pool if shallow."""
    drawn = hash_sample(df, cap, key, by, seed)
    w = Window.partitionBy(*by)
    place = F.row_number().over(w.orderBy(F.xxhash64(key, F.lit(seed + 1)), key))
    half = F.when(F.sum(depth).over(w) < least, F.lit("pooled")).otherwise(F.concat(F.lit("half"), (place % 2 + 1).cast("string")))
    return drawn.withColumn("replicate", half)


def first_match(value: Column, patterns: dict[str, str], other: str = "Other") -> Column:
    """Name of the first regex that matches."""
    found = F.lit(other)
    for name, pattern in reversed(patterns.items()):
        found = F.when(value.rlike(pattern), name).otherwise(found)
    return found


def eta_squared(df: DataFrame, value: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Between-group over total sum of squares; null where the value doesn't vary."""
    both = df.filter(F.col(value).isNotNull() & F.col(label).isNotNull())
    per = both.groupBy(*by, label).agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("m"), F.var_pop(value).alias("v"))
    mean = F.sum(F.col("n") * F.col("m")) / F.sum("n")
    between = F.sum(F.col("n") * F.col("m") * F.col("m")) - F.sum("n") * mean * mean
    total = between + F.sum(F.col("n") * F.col("v"))
    return per.groupBy(*by).agg(F.when(total > 0, between / total).alias("eta2"), F.sum("n").alias("n"))


def r_squared(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Squared Pearson correlation; null where either doesn't vary."""
    both = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    varies = (F.stddev_samp(x) > 0) & (F.stddev_samp(y) > 0)
    return both.groupBy(*by).agg(F.when(varies, correlation(x, y) * correlation(x, y)).alias("r2"), F.count(F.lit(1)).alias("n"))


def merge_keyed(parts: Sequence[DataFrame], key: str) -> DataFrame:
    """Union of keyed tables by column name; the first non-null value of each column in the order of the tables."""
    both = None
    for i, part in enumerate(parts):
        part = part.withColumn("_i", F.lit(i))
        both = part if both is None else both.unionByName(part, allowMissingColumns=True)
    columns = [c for c in both.columns if c not in (key, "_i")]
    return both.groupBy(key).agg(*[F.min_by(c, F.when(F.col(c).isNotNull(), F.col("_i"))).alias(c) for c in columns])


def value_conflicts(parts: Sequence[DataFrame], key: str, columns: Sequence[str]) -> DataFrame:
    """(key, column, values): non-null values of a key that differ between tables."""
    both = parts[0].select(key, *columns)
    for part in parts[1:]:
        both = both.unionByName(part.select(key, *columns))
    long = both.select(key, F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])).alias("x")).select(key, "x.*")
    per = long.filter("value is not null").groupBy(key, "column").agg(F.array_sort(F.collect_set("value")).alias("v"))
    return per.filter(F.size("v") > 1).select(key, "column", F.array_join("v", ",").alias("values"))
