"""Contracts and verbs of keyed tables: projection, alignment, conforming, marker panels, nested summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.ranks import average_rank, correlation, natural_key


def on_chromosomes(df: DataFrame, names: DataFrame, chrom: str = "chr") -> DataFrame:
    """Rows whose chromosome is in the one-column table of standard names."""
    return df.join(F.broadcast(names.select(F.col(names.columns[0]).alias(chrom)).distinct()), chrom, "left_semi").select(*df.columns)


def chromosome_sizes(df: DataFrame, names: DataFrame) -> DataFrame:
    """(chr, start, end) from (chr, size): start 0, standard chromosomes only."""
    return on_chromosomes(df, names).select("chr", F.lit(0).cast("bigint").alias("start"), F.col("size").cast("bigint").alias("end"))


def prefixed(df: DataFrame, sample: str, barcode: str, out: str = "cell") -> DataFrame:
    """df with `<sample>_<barcode>` as the cell, so that samples can be put into one table partitioned by sample."""
    return df.withColumn(out, F.concat_ws("_", F.col(sample).cast("string"), F.col(barcode).cast("string")))


def union_samples(parts: Sequence[DataFrame], names: DataFrame | None = None) -> DataFrame:
    """Rows of all samples by column name, on standard chromosomes if their names are given."""
    both = parts[0]
    for part in parts[1:]:
        both = both.unionByName(part)
    return both if names is None else on_chromosomes(both, names)


def feature_digests(df: DataFrame, sample: str, feature: str, place: str) -> DataFrame:
    """(sample, n, digest): the features of each sample in order; equal digests mean identical ordered features."""
    rows = df.groupBy(sample).agg(F.array_sort(F.collect_list(F.struct(F.col(place).alias("at"), F.col(feature).cast("string").alias("f")))).alias("fs"))
    return rows.select(sample, F.size("fs").cast("bigint").alias("n"), F.sha2(F.array_join(F.transform("fs", lambda x: x["f"]), ","), 256).alias("digest"))


def check_same_features(df: DataFrame, sample: str, feature: str, place: str) -> None:
    """Raises unless all samples have the same features in the same order."""
    if feature_digests(df, sample, feature, place).select("digest").distinct().limit(2).count() > 1:
        raise ValueError("samples differ in their features or the order of them")


def bind_columns(parts: Sequence[DataFrame], feature: str, cell: str, value: str) -> DataFrame:
    """Counts of all samples as one matrix; raises if a cell is in two samples."""
    both = union_samples([p.select(feature, cell, value, F.lit(i).alias("_part")) for i, p in enumerate(parts)])
    if not both.groupBy(cell).agg(F.countDistinct("_part").alias("n")).filter("n > 1").isEmpty():
        raise ValueError(f"{cell} is not unique over the samples")
    return both.drop("_part")


def aligned(annotation: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """Annotation of exactly the given rows (key, place), with their place; raises if a row has none."""
    out = rows.join(annotation, key, "left")
    if not rows.join(annotation, key, "left_anti").isEmpty():
        raise ValueError(f"{key} has rows without annotation")
    return out


def project(df: DataFrame, key: str, wanted: Sequence[str] | None = None, strict: bool = False, canonical: Sequence[str] = ()) -> DataFrame:
    """Key and wanted columns (None: all): in canonical order first, then as wanted; strict: raises if one is missing."""
    named = [c for c in (df.columns if wanted is None else wanted) if c != key]
    missing = [c for c in named if c not in df.columns]
    if strict and missing:
        raise ValueError(f"no column {', '.join(missing)}")
    there = [c for c in dict.fromkeys(named) if c in df.columns]
    return df.select(key, *[c for c in canonical if c in there], *[c for c in there if c not in canonical])


def in_request_order(df: DataFrame, key: str, keys: Sequence[object]) -> DataFrame:
    """Rows of the requested keys with `place` from 0; raises if a key is missing. The request is a short list."""
    asked = df.sparkSession.range(1).select(F.posexplode(F.array(*map(F.lit, keys))).alias("place", key))
    if not asked.join(df, key, "left_anti").isEmpty():
        raise ValueError(f"{key} lacks requested keys")
    return asked.join(df, key).select("place", *df.columns)


def demultiplexed(df: DataFrame, label: str, best: str, single: str | None = None) -> DataFrame:
    """df with `class` and `donor`: doublets and unassigned cells keep no donor but their best singlet as `best_donor`; with
    `single`, a well of one donor, every cell is that donor's."""
    if single is not None:
        return df.withColumns({"class": F.lit("singlet"), "donor": F.lit(single), "best_donor": F.lit(single)})
    kind = F.when(F.col(label).isin("doublet", "unassigned"), F.col(label)).otherwise("singlet")
    return df.withColumns({"class": kind, "donor": F.when(kind == "singlet", F.col(label)), "best_donor": F.col(best)})


def resolve_markers(wanted: DataFrame, members: DataFrame, name: str = "marker", symbol: str = "symbol", qualified: str = "qualified") -> DataFrame:
    """(marker, qualified): markers by symbol or by qualified name, in any case; raises if one is found under neither."""
    own = wanted.select(name).distinct().withColumn("_u", F.upper(name))
    either = members.select(F.upper(symbol).alias("_u"), qualified).unionByName(members.select(F.upper(qualified).alias("_u"), qualified)).distinct()
    if not own.join(either, "_u", "left_anti").isEmpty():
        raise ValueError("markers without a member")
    return own.join(either, "_u").select(name, qualified)


def marker_panel(sets: DataFrame, available: DataFrame, label: str = "label", marker: str = "marker", feature: str = "feature") -> DataFrame:
    """(label, feature, negative, there): markers once a set; a final + goes, a final - marks a negative one."""
    text = F.trim(marker)
    rows = sets.select(label, F.regexp_replace(text, r"[+-]$", "").alias(feature), text.endswith("-").alias("negative")).distinct()
    return rows.join(available.select(feature, F.lit(True).alias("there")).distinct(), feature, "left").select(label, feature, "negative", F.coalesce("there", F.lit(False)).alias("there"))


def missing_markers(sets: DataFrame, available: DataFrame, feature: str = "feature") -> DataFrame:
    return sets.join(available.select(feature), feature, "left_anti").select(*sets.columns)


def stars(p: Column, q: Column) -> Column:
    """`**` for q < 0.05, `*` for p < 0.05, else empty; nulls are empty."""
    return F.when(q < 0.05, "**").when(p < 0.05, "*").otherwise("")


def presets(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A small table of settings, to be broadcast."""
    return F.broadcast(spark.createDataFrame(list(rows), schema))


def chosen_dimensions(vector: str, dims: Sequence[int]) -> Column:
    """The dimensions of a vector by number from 1, in the given order."""
    return F.transform(F.array(*map(F.lit, dims)), lambda i: F.element_at(vector, i))


def common_cells(first: DataFrame, second: DataFrame, metadata: DataFrame, key: str, dims: tuple[Sequence[int], Sequence[int]]) -> DataFrame:
    """(key, first, second): chosen dimensions of cells that both embeddings and the metadata have."""
    both = first.select(key, chosen_dimensions("vector", dims[0]).alias("first")).join(second.select(key, chosen_dimensions("vector", dims[1]).alias("second")), key)
    return both.join(metadata.select(key), key, "left_semi")


def refreshed(metadata: DataFrame, kept: DataFrame, fresh: Sequence[DataFrame], key: str) -> DataFrame:
    """Metadata of the kept cells; columns that a fresh table has are dropped and joined anew."""
    out = metadata.join(kept.select(key), key, "left_semi")
    for table in fresh:
        out = out.drop(*[c for c in table.columns if c != key]).join(table, key, "left")
    return out


def family_map(edges: DataFrame, families: DataFrame, complexes: DataFrame) -> DataFrame:
    """(regulator, families, via): motif families of regulators by their own symbol or as a member of a complex.

    edges: regulator; families: symbol, family; complexes: regulator, member."""
    regulators = edges.select("regulator").distinct()
    own = regulators.join(families, regulators["regulator"] == families["symbol"]).select("regulator", "family", F.lit("symbol").alias("via"))
    part = regulators.join(complexes, "regulator").join(families, F.col("member") == F.col("symbol")).select("regulator", "family", F.lit("complex").alias("via"))
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ";")
    return own.unionByName(part).groupBy("regulator").agg(joined("family").alias("families"), joined("via").alias("via"))


def compared(first: DataFrame, second: DataFrame, mapping: DataFrame) -> DataFrame:
    """Rows of first with the rows of second of any of their families: status and concordance of direction.

    first: regulator, effect_a, q_a; mapping: regulator, families (;-separated); second: family, effect_b, q_b."""
    wide = first.join(mapping.select("regulator", F.explode(F.split("families", ";")).alias("family")), "regulator", "left").join(second, "family", "left")
    a, b = F.coalesce(F.col("q_a") < 0.05, F.lit(False)), F.coalesce(F.col("q_b") < 0.05, F.lit(False))
    status = F.when(F.col("family").isNull(), "no family").when(F.col("effect_b").isNull(), "not tested").when(a & b, "both").when(a, "first only").when(b, "second only").otherwise("neither")
    return wide.select("regulator", "family", "effect_a", "q_a", "effect_b", "q_b", status.alias("status"), (F.signum("effect_a") == F.signum("effect_b")).alias("concordant"))


def family_aggregates(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Median and extreme values of the comparisons of a family."""
    return df.groupBy(*by).agg(F.percentile("effect_a", 0.5).alias("median_effect"), F.min("q_a").alias("least_q"), F.coalesce(F.bool_or("concordant"), F.lit(False)).alias("any_concordant"), F.countDistinct("regulator").alias("n_regulators"), F.min("regulator").alias("first"))


def paired_scores(a: DataFrame, b: DataFrame, on: Sequence[str], x: str, y: str) -> DataFrame:
    """Rows that both tables have with finite scores."""
    finite = lambda c: F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(F.col(c)) != float("inf"))
    return a.select(*on, x).join(b.select(*on, y), list(on)).filter(finite(x) & finite(y))


def cut_site_enrichment(counts: DataFrame, totals: DataFrame, key: str, covered: int, genome: int) -> DataFrame:
    """(key, n, in_peaks, log10_in_peaks, enrichment): share of fragments in peaks over the share of the genome they cover."""
    n = counts.groupBy(key).agg(F.sum("count").alias("in_peaks"))
    rows = totals.join(n, key, "left").fillna(0, ["in_peaks"])
    share = F.when(F.col("n") > 0, F.col("in_peaks") / F.col("n")).otherwise(F.lit(0.0))
    return rows.select(key, "n", "in_peaks", F.log10(F.greatest("in_peaks", F.lit(1))).alias("log10_in_peaks"), (share / (covered / genome)).alias("enrichment"))


def cohort_support(cohort: DataFrame, retained: DataFrame, fitted: DataFrame, key: str, cells: str, well: str) -> DataFrame:
    """Cohort with retained and fitted samples, their cells and their wells (joined by commas); zero where there are none."""
    per = retained.groupBy(key).agg(F.count(F.lit(1)).alias("n_retained"), F.sum(cells).alias("n_cells"), F.array_join(F.array_sort(F.collect_set(F.col(well).cast("string"))), ",").alias("wells"))
    rows = cohort.join(per, key, "left").join(fitted.groupBy(key).agg(F.count(F.lit(1)).alias("n_fitted")), key, "left")
    return rows.fillna(0, ["n_retained", "n_cells", "n_fitted"]).fillna("", ["wells"])


def called_bars(df: DataFrame, cluster: str, called: Column, p: str, most: float) -> DataFrame:
    """Called and other cells of each cluster, the called fraction, whether it is over the limit, and the median -log10 p."""
    n = df.groupBy(cluster).agg(F.count_if(called).alias("n_called"), F.count_if(~called).alias("n_other"), F.percentile(-F.log10(F.greatest(F.col(p), F.lit(1e-300))), 0.5).alias("median_log10p"))
    fraction = F.col("n_called") / (F.col("n_called") + F.col("n_other"))
    return n.withColumns({"fraction": fraction, "over": fraction > most})


def significant_shares(parts: dict[str, DataFrame], by: Sequence[str], significant: Column) -> DataFrame:
    """(modality, by..., n, share): significant rows of each part over those of its modality and first key."""
    both = union_samples([p.withColumn("modality", F.lit(name)) for name, p in parts.items()])
    n = both.filter(significant).groupBy("modality", *by).agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("modality", by[0])))


def compartments(shares: DataFrame, patterns: dict[str, str], group: str, value: str, by: Sequence[str], other: str = "Other") -> DataFrame:
    """Sum of shares by compartment, the first pattern that a group's name matches."""
    name = F.lit(other)
    for label, pattern in reversed(patterns.items()):
        name = F.when(F.col(group).rlike(pattern), label).otherwise(name)
    return shares.groupBy(*by, name.alias("compartment")).agg(F.sum(value).alias(value))


def marker_sets(scores: DataFrame, least: float) -> DataFrame:
    """Per label: clusters above `least`, clusters that it leads, its best cluster with the advantage over the best other label
    there, and that competitor. scores: cluster, label, score."""
    w = Window.partitionBy("cluster").orderBy(F.col("score").desc(), "label")
    lead = F.row_number().over(w)
    first, first_label = F.first("score").over(w), F.first("label").over(w)
    second = F.max(F.when(F.col("_n") == 2, F.struct("score", "label"))).over(Window.partitionBy("cluster"))
    rows = scores.withColumns({"_n": lead, "_f": first, "_l": first_label}).withColumn("_s", second)
    rival = F.when(F.col("_n") == 1, F.col("_s")).otherwise(F.struct(F.col("_f").alias("score"), F.col("_l").alias("label")))
    rows = rows.withColumn("_r", rival).withColumn("advantage", F.col("score") - F.col("_r.score"))
    best = F.max(F.struct("advantage", F.col("cluster").alias("c"), F.col("_r.label").alias("r")))
    return rows.groupBy("label").agg(F.count_if(F.col("score") > least).alias("n_above"), F.count_if(F.col("_n") == 1).alias("n_leading"), best.alias("b")).select("label", "n_above", "n_leading", F.col("b.c").alias("best_cluster"), F.col("b.advantage").alias("advantage"), F.col("b.r").alias("competitor"))


def link_predicate(estimate: Column, z: Column, q: Column, promoter: Column) -> Column:
    """Whether a peak-gene link counts: estimable, positive, z over 0, q under 0.05 and no promoter; nulls don't."""
    return F.coalesce(estimate.isNotNull() & (estimate > 0) & (z > 0) & (q < 0.05) & ~promoter, F.lit(False))


def component_effects(df: DataFrame, feature: str, contrast: str, effect: str, sep: str = "_minus_") -> DataFrame:
    """df with `effect_a` and `effect_b` of the two contrasts that an `A_minus_B` contrast names; null for others."""
    part = F.split(F.col(contrast), sep)
    own = df.withColumns({"_a": F.when(F.col(contrast).contains(sep), part[0]), "_b": F.when(F.col(contrast).contains(sep), part[1])})
    side = lambda x: df.select(F.col(feature), F.col(contrast).alias(f"_{x}"), F.col(effect).alias(f"effect_{x}"))
    return own.join(side("a"), [feature, "_a"], "left").join(side("b"), [feature, "_b"], "left").select(*df.columns, "effect_a", "effect_b")


def p_histogram(df: DataFrame, by: Sequence[str], p: str, bins: int = 20) -> DataFrame:
    """Counts of p in equal bins from 0 to 1, numbered from 0; 1 is in the last."""
    return df.filter(F.col(p).isNotNull()).groupBy(*by, F.least(F.floor(F.col(p) * bins), F.lit(bins - 1)).cast("bigint").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def detail_loci(df: DataFrame, by: str, locus: str, value: str, second: str, n: int) -> DataFrame:
    """Loci among the n of greatest absolute value, or among the n of greatest smaller percentile of both measures, with the reasons."""
    magnitude = df.withColumns({"_v": F.abs(F.col(value)), "_w": F.abs(F.col(second))})
    every = Window.partitionBy(by)
    pct = magnitude.withColumns({"_pv": average_rank("_v", [by]) / F.count("_v").over(every), "_pw": average_rank("_w", [by]) / F.count("_w").over(every)})
    pct = pct.withColumn("_m", F.least("_pv", "_pw"))
    top = lambda c: F.row_number().over(every.orderBy(F.col(c).desc(), locus)) <= n
    rows = pct.withColumns({"_a": top("_v"), "_b": top("_m")}).filter("_a or _b")
    reasons = F.array_join(F.array_compact(F.array(F.when(F.col("_a"), "contribution"), F.when(F.col("_b"), "both"))), ", ")
    return rows.select(*df.columns, reasons.alias("reasons"))


def lead_label(lead: Column, n: Column) -> Column:
    """Name of the lead variant, with the number of signals if there are several."""
    return F.when(n > 1, F.concat(lead.cast("string"), F.lit(" ("), n.cast("string"), F.lit(" signals)"))).otherwise(lead.cast("string"))


def subset_label(values: Column) -> Column:
    """Values joined by +, underscores as dashes; `all` where there are none."""
    return F.coalesce(F.nullif(F.array_join(F.transform(values, lambda x: F.translate(x, "_", "-")), "+"), F.lit("")), F.lit("all"))


def filled_sizes(df: DataFrame, study: str, n: str, totals: DataFrame, total: str) -> DataFrame:
    """Rows with n, from the study's total where it is missing; rows of studies that have neither go."""
    return df.join(totals, study, "left").withColumn(n, F.coalesce(n, total)).drop(total).filter(F.col(n) > 0)


def named_loci(df: DataFrame, cells: DataFrame, chromosomes: DataFrame) -> DataFrame:
    """Loci given by numbers of cell and chromosome, with their names. cells, chromosomes: i, name."""
    return df.join(chromosomes.select(F.col("i").alias("chr_i"), F.col("name").alias("chr")), "chr_i", "left").join(cells.select(F.col("i").alias("cell_i"), F.col("name").alias("cell")), "cell_i", "left").select("chr", "start", "end", "cell")


def split_natural(df: DataFrame, by: str) -> DataFrame:
    """df with `part`: the number from 1 of its group in natural order (`2` before `10`), to be written partitioned by it."""
    groups = df.select(by).distinct()
    order = Window.orderBy(natural_key(F.col(by).cast("string")), by)
    return df.join(F.broadcast(groups.withColumn("part", F.row_number().over(order).cast("bigint"))), by)


def standardised_differences(df: DataFrame, by: Sequence[str], score: str, covariates: Sequence[str], top: float = 0.75) -> DataFrame:
    """(by..., covariate, n_top, difference): mean of a covariate in the top part by score less that of the rest, over its deviation."""
    values = F.explode(F.array(*[F.struct(F.lit(c).alias("covariate"), F.col(c).cast("double").alias("value")) for c in covariates]))
    rows = df.select(*by, score, values.alias("x")).select(*by, score, "x.*")
    up = F.col(score) > top
    mean = F.avg(F.when(up, F.col("value"))) - F.avg(F.when(~up, F.col("value")))
    sd = F.stddev_samp("value")
    return rows.groupBy(*by, "covariate").agg(F.count_if(up).alias("n_top"), F.when(sd > 0, mean / sd).alias("difference"))


def agreement(df: DataFrame, by: Sequence[str], x: str, y: str, least: float) -> DataFrame:
    """Correlation of two scores and counts of rows where both, one or none reach `least`."""
    a, b = F.col(x) >= least, F.col(y) >= least
    return df.groupBy(*by).agg(correlation(x, y).alias("r"), F.count_if(a & b).alias("both"), F.count_if(a & ~b).alias("first_only"), F.count_if(~a & b).alias("second_only"), F.count_if(~a & ~b).alias("neither"))


def dosages(df: DataFrame, key: str, packed: str, n: int) -> DataFrame:
    """(key, sample, dosage) of genotypes packed four to a byte, lowest bits first: codes 0, 1, 2, 3 are 2, null, 1 and 0 copies."""
    code = F.shiftright(F.conv(F.hex(F.expr(f"substring({packed}, cast(sample div 4 as int) + 1, 1)")), 16, 10).cast("int"), 0)
    rows = df.select(key, packed, F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("sample")).withColumn("_b", code)
    bits = F.expr("shiftright(_b, cast(2 * (sample % 4) as int))").bitwiseAND(3)
    return rows.select(key, "sample", F.when(bits == 0, 2).when(bits == 2, 1).when(bits == 3, 0).alias("dosage"))
