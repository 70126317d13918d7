"""Quality control: rules given as text, what they exclude, and what is retained."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RULE = r"^\s*(\w+)\s*(<=|>=|<|>)\s*(-?[0-9.]+(?:[eE][+-]?[0-9]+)?)\s*$"


def split_rules(text: Column) -> Column:
    """Trimmed non-empty rules of a list joined by double semicolons."""
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), ";;"), lambda r: F.trim(r)), lambda r: r != "")


def check_rules(df: DataFrame, rules: Sequence[str]) -> None:
    """Raises if a rule isn't a boolean expression on the columns of df."""
    for rule in rules:
        if df.limit(0).select(F.expr(rule).alias("r")).dtypes[0][1] != "boolean":
            raise ValueError(f"not a predicate: {rule}")


def excluded_keys(df: DataFrame, key: str, rules: Sequence[str]) -> DataFrame:
    """(rule, key) for every rule that a row meets; a null predicate excludes nothing."""
    check_rules(df, rules)
    met = F.array(*[F.when(F.expr(r), F.lit(r)) for r in rules])
    return df.select(F.explode(F.filter(met, lambda r: r.isNotNull())).alias("rule"), key)


def rule_thresholds(rules: DataFrame, rule: str = "rule") -> DataFrame:
    """Columns feature, low and high of rules `<feature> <op> <number>`: the interval that such a rule excludes; others are left out."""
    part = lambda i: F.regexp_extract(rule, _RULE, i)
    below, number = part(2).startswith("<"), part(3).cast("double")
    parsed = rules.filter(F.col(rule).rlike(_RULE))
    return parsed.withColumns({"feature": part(1), "low": F.when(below, F.lit(float("-inf"))).otherwise(number), "high": F.when(below, number).otherwise(F.lit(float("inf")))})


def flag_combinations(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """Number of rows for each exact combination of named flags."""
    flags = {name: F.coalesce(F.expr(rule), F.lit(False)) for name, rule in rules.items()}
    return df.withColumns(flags).groupBy(*flags).agg(F.count(F.lit(1)).alias("n"))


def merge_combinations(parts: Sequence[DataFrame], n: str = "n") -> DataFrame:
    """Sums of combination counts over parts whose flags differ; a flag that a part lacks is false."""
    both = parts[0]
    for part in parts[1:]:
        both = both.unionByName(part, allowMissingColumns=True)
    flags = [c for c in both.columns if c != n]
    return both.groupBy(*[F.coalesce(c, F.lit(False)).alias(c) for c in flags]).agg(F.sum(n).alias(n))


def combination_masks(combinations: DataFrame, flags: Sequence[str], n: str = "n") -> DataFrame:
    """Bit mask, percent of all and rank by size of each combination."""
    mask = sum((F.col(f).cast("bigint") * (1 << i) for i, f in enumerate(flags)), F.lit(0).cast("bigint"))
    share = 100 * F.col(n) / F.sum(n).over(Window.partitionBy())
    masked = combinations.select(mask.alias("mask"), n, share.alias("percent"))
    return masked.withColumn("rank", F.row_number().over(Window.orderBy(F.col(n).desc(), "mask")).cast("bigint"))


def first_failed_rule(df: DataFrame, rules: Sequence[str]) -> Column:
    """Place (from 1) of the first rule that a row meets; null: none."""
    found = F.lit(None).cast("int")
    for i, rule in reversed(list(enumerate(rules, 1))):
        found = F.when(F.expr(rule), F.lit(i)).otherwise(found)
    return found


def retention(df: DataFrame, sample: str, rules: Sequence[str]) -> DataFrame:
    """Funnel per sample: each row is charged to the first rule it meets; zero-completed over samples and rules.

    Columns: sample, step, rule, n_in, n_out, n_left, fraction_left (of the sample's rows).
    """
    charged = df.withColumn("step", first_failed_rule(df, rules)).groupBy(sample).agg(
        F.count(F.lit(1)).alias("total"), *[F.count_if(F.col("step") == i).alias(f"_{i}") for i in range(1, len(rules) + 1)]
    )
    steps = F.array(*[F.struct(F.lit(i).alias("step"), F.lit(r).alias("rule"), F.col(f"_{i}").alias("n_out")) for i, r in enumerate(rules, 1)])
    long = charged.select(sample, "total", F.inline(steps))
    lost = F.sum("n_out").over(Window.partitionBy(sample).orderBy("step").rowsBetween(Window.unboundedPreceding, 0))
    left = F.col("total") - lost
    return long.select(sample, "step", "rule", (left + F.col("n_out")).alias("n_in"), "n_out", left.alias("n_left"), (left / F.col("total")).alias("fraction_left"))


def quartiles(df: DataFrame, by: Sequence[str], values: Sequence[str]) -> DataFrame:
    """n and the quartiles (linear interpolation) of each value per group."""
    at = [(0.25, "q1"), (0.5, "median"), (0.75, "q3")]
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *[F.percentile(v, p).alias(f"{v}_{name}") for v in values for p, name in at])


def mad_outliers(df: DataFrame, value: str, by: Sequence[str], n_mad: float = 3.0, low: bool = True) -> DataFrame:
    """df with centre, mad and outlier: the value is over n_mad scaled median deviations on the bad side of its group's median."""
    centre = df.groupBy(*by).agg(F.percentile(value, 0.5).alias("centre"))
    near = df.join(centre, list(by))
    mad = near.groupBy(*by).agg((1.4826 * F.percentile(F.abs(F.col(value) - F.col("centre")), 0.5)).alias("mad"))
    away = (F.col("centre") - F.col(value)) if low else (F.col(value) - F.col("centre"))
    return near.join(mad, list(by)).withColumn("outlier", away > n_mad * F.col("mad"))


def nearest_centroid(df: DataFrame, key: str, recorded: str, values: Sequence[str]) -> DataFrame:
    """(key, recorded, nearest, differs): class whose median log1p values are nearest; classes are few and broadcast."""
    logs = df.select(key, recorded, *[F.log1p(v).alias(v) for v in values])
    centres = logs.groupBy(F.col(recorded).alias("nearest")).agg(*[F.percentile(v, 0.5).alias(f"_{v}") for v in values])
    listed = centres.agg(F.array_sort(F.collect_list(F.struct("nearest", *[f"_{v}" for v in values]))).alias("_c"))
    distance = lambda c: sum(((F.col(v) - c[f"_{v}"]) * (F.col(v) - c[f"_{v}"]) for v in values), F.lit(0.0))
    best = F.array_min(F.transform("_c", lambda c: F.struct(distance(c).alias("d"), c["nearest"].alias("nearest"))))["nearest"]
    scored = logs.join(F.broadcast(listed), how="inner").withColumn("nearest", best)
    return scored.select(key, recorded, "nearest", (F.col("nearest") != F.col(recorded)).alias("differs"))


def cell_metrics(counts: DataFrame, cell: str, feature: str, count: str, marked: Column) -> DataFrame:
    """Totals, detected features, their logs, percent of marked features and novelty per cell."""
    total, found = F.sum(count), F.count_if(F.col(count) > 0)
    rows = counts.groupBy(cell).agg(total.alias("n_counts"), found.alias("n_features"), (100 * F.sum(F.when(marked, F.col(count)).otherwise(0)) / total).alias("marked_percent"))
    return rows.withColumns({"log10_counts": F.log10("n_counts"), "novelty": F.log10("n_features") / F.log10("n_counts")})


def violations(df: DataFrame, key: str) -> DataFrame:
    """One row: null, empty and repeated keys; all must be 0."""
    per = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    text = F.col(key).cast("string")
    return per.agg(
        F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("n"))), F.lit(0)).cast("bigint").alias("n_null"),
        F.coalesce(F.sum(F.when(text == "", F.col("n"))), F.lit(0)).cast("bigint").alias("n_empty"),
        F.count_if(F.col(key).isNotNull() & (F.col("n") > 1)).alias("n_repeated"),
    )


def first_rows(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of each key in a stated order, as distinct() that keeps whole rows."""
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def only_in_kept(samples: DataFrame, donor: str, kept: Column) -> DataFrame:
    """Donors all of whose rows are kept; `both` tells donors that are on either side."""
    flags = samples.groupBy(donor).agg(F.bool_and(kept).alias("only"), (F.bool_or(kept) & ~F.bool_and(kept)).alias("both"))
    return flags.filter(F.col("only") | F.col("both"))


def classify_by_shares(df: DataFrame, key: str, sets: Sequence[str], total: str, label: str, least: float = 0.4) -> DataFrame:
    """(key, best, score): each set's share, scaled from the 90th percentile of other labels to its own label's median.

    The best scaled set is given if it reaches `least`, else null; ties go to the set named first.
    """
    shares = df.select(key, label, *[(F.col(s) / F.col(total)).alias(s) for s in sets])
    scales = shares.agg(*[F.percentile(F.when(F.col(label) != s, F.col(s)), 0.9).alias(f"_lo_{s}") for s in sets], *[F.percentile(F.when(F.col(label) == s, F.col(s)), 0.5).alias(f"_hi_{s}") for s in sets])
    scored = shares.join(F.broadcast(scales))
    value = lambda s: (F.col(s) - F.col(f"_lo_{s}")) / F.nullif(F.col(f"_hi_{s}") - F.col(f"_lo_{s}"), F.lit(0.0))
    best = F.array_max(F.array(*[F.struct(F.coalesce(value(s), F.lit(float("-inf"))).alias("score"), F.lit(-i).alias("i"), F.lit(s).alias("name")) for i, s in enumerate(sets)]))
    return scored.select(key, label, best.alias("b")).select(key, label, F.when(F.col("b.score") >= least, F.col("b.name")).alias("best"), F.col("b.score").alias("score"))
