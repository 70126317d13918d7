"""Tables of studies, samples and links: metadata of sources, variants of any source in one shape, nested samples, filled grids."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .intervals import overlap_join, places
from .tables import complete, percentile_rank

#: Columns of a variant, whatever its source.
VARIANT = {"studyId": "string", "studyLocusId": "string", "chr": "string", "pos": "bigint", "posteriorProbability": "double", "beta": "double"}


def gene_sets(df: DataFrame, name: str, symbol: str) -> DataFrame:
    """(set, symbols): the distinct symbols of each set, sorted; null symbols are left out."""
    return df.groupBy(F.col(name).alias("set")).agg(F.array_sort(F.collect_set(symbol)).alias("symbols"))


def study_sizes(studies: DataFrame, study: str, stated: str, samples: str, size: str) -> DataFrame:
    """(study, n, n_samples): the stated sample size, else the sum over the study's nested samples, else 0. samples: array of structs
    with a field `size`; a study's rows are put together."""
    rows = studies.select(F.col(study).alias("study"), F.col(stated).alias("_stated"), F.explode_outer(samples).alias("_s"))
    return rows.groupBy("study").agg(F.coalesce(F.first("_stated", True), F.sum(f"_s.{size}"), F.lit(0)).cast("bigint").alias("n"), F.count("_s").alias("n_samples"))


def conform(df: DataFrame, **columns: Column) -> DataFrame:
    """Variants in the common shape, from an expression a column; a column without one is null. Unknown names raise."""
    unknown = set(columns) - set(VARIANT)
    if unknown:
        raise ValueError(f"no columns of a variant: {sorted(unknown)}")
    return df.select(*[columns.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in VARIANT.items()])


def variant_metadata(variants: DataFrame) -> DataFrame:
    """One row a study of conformed variants: (studyId, n_variants, n_loci, has_beta)."""
    return variants.groupBy("studyId").agg(F.count(F.lit(1)).alias("n_variants"), F.countDistinct("studyLocusId").alias("n_loci"), F.bool_or(F.col("beta").isNotNull()).alias("has_beta"))


def dispatched(sources: Sequence[tuple[str, DataFrame]], readers: Mapping[str, Callable[[DataFrame], DataFrame]]) -> tuple[DataFrame, DataFrame]:
    """(variants, metadata) of sources of several types, each conformed by the reader of its type, equal rows once. A type without a reader
    raises, and so does a reader whose columns aren't a variant's."""
    parts = []
    for kind, df in sources:
        if kind not in readers:
            raise ValueError(f"no reader for sources of type {kind!r}; there are {sorted(readers)}")
        part = readers[kind](df)
        if part.columns != list(VARIANT):
            raise ValueError(f"the reader for {kind!r} gives {part.columns}")
        parts.append(part)
    variants = parts[0]
    for part in parts[1:]:
        variants = variants.unionByName(part)
    variants = variants.dropDuplicates()
    return variants, variant_metadata(variants)


def in_context(links: DataFrame, gene: str, top: Column) -> DataFrame:
    """All rows of the genes that have a top link."""
    return links.join(links.filter(top).select(gene).distinct(), gene, "left_semi")


def class_percentages(df: DataFrame, group: str, label: str) -> DataFrame:
    """(group, label, n, percent): rows of each class as a percentage of its group."""
    n = df.groupBy(group, label).agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn("percent", 100 * F.col("n") / F.sum("n").over(Window.partitionBy(group)))


def cohort_samples(samples: DataFrame, cohort: DataFrame, donor: str, kind: str, kinds: Sequence[str], depth: str, least: float) -> DataFrame:
    """Samples of the cohort's donors, of the named types and with `least` depth or more; types that no sample has raise."""
    missing = set(kinds) - {r[0] for r in samples.select(kind).filter(F.col(kind).isin(*kinds)).distinct().collect()}
    if missing:
        raise ValueError(f"no samples of {sorted(missing)}")
    return samples.join(cohort.select(donor).distinct(), donor, "left_semi").filter(F.col(kind).isin(*kinds) & (F.col(depth) >= least))


def large_features(counts: DataFrame, more_than: float = 50, cells: DataFrame | None = None) -> DataFrame:
    """Counts of the requested cells (all without a table of them), of features with a total above `more_than` there."""
    kept = counts if cells is None else counts.join(cells.select("cell").distinct(), "cell", "left_semi")
    totals = kept.groupBy("feature").agg(F.sum("count").alias("_n")).filter(F.col("_n") > more_than)
    return kept.join(totals, "feature", "left_semi")


def enriched_pairs(df: DataFrame, by: Sequence[str], significant: Column) -> DataFrame:
    """(by..., enriched): whether any row of the pair is significant; a null counts as not."""
    return df.groupBy(*by).agg(F.bool_or(F.coalesce(significant, F.lit(False))).alias("enriched"))


def nested_cells(df: DataFrame, sample: str, barcode: str, label: str) -> DataFrame:
    """(sample, n, cells): barcodes and labels of each sample as an array of structs, by barcode."""
    return df.groupBy(F.col(sample).alias("sample")).agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list(F.struct(barcode, label))).alias("cells"))


def continuous_inputs(metadata: DataFrame, columns: Sequence[str], counts: DataFrame, features: Mapping[str, object], key: str = "cell") -> DataFrame:
    """Metadata columns and chosen features as columns (name -> feature), in one pass over the counts; a cell without a count has 0."""
    chosen = [F.sum(F.when(F.col("feature") == F.lit(f), F.col("count"))).alias(name) for name, f in features.items()]
    wide = counts.filter(F.col("feature").isin(*features.values())).groupBy(key).agg(*chosen)
    return metadata.select(key, *columns).join(wide, key, "left").fillna(0, list(features))


def least_pooled_cpm(counts: DataFrame, feature: str, kind: str, count: str, least: str = "least_cpm") -> DataFrame:
    """(feature, least): counts per million pooled by type, and their minimum over the types in which the feature is seen."""
    pooled = counts.groupBy(feature, kind).agg(F.sum(count).alias("_n"))
    depth = counts.groupBy(kind).agg(F.sum(count).alias("_d"))
    return pooled.join(depth, kind).groupBy(feature).agg(F.min(F.col("_n") * 1e6 / F.col("_d")).alias(least))


def rank_matrix(scores: DataFrame, rows: DataFrame, row: str, column: str, value: str) -> DataFrame:
    """(row, column, rank): percentile ranks within each column for every listed row and every column, zero where there is no score."""
    ranked = percentile_rank(scores, value, [column]).select(row, column, F.col("pct").alias("rank"))
    grid = rows.select(row).distinct().join(scores.select(column).distinct())
    return grid.join(ranked, [row, column], "left").fillna(0.0, ["rank"])


def zero_filled(df: DataFrame, row: str, column: str, value: Column, used: Column) -> DataFrame:
    """(row, column, score, n): sum of a value and number of the rows that count, for all rows x columns that occur, zero without any."""
    per = df.groupBy(row, column).agg(F.coalesce(F.sum(F.when(used, value)), F.lit(0)).alias("score"), F.count_if(used).alias("n"))
    return complete(per, [row], [column], {"score": 0, "n": 0})


def overlap_measures(df: DataFrame, peaks: DataFrame, width: int, by: Column, least: int) -> DataFrame:
    """(trait, enough, measure, value): overlaps, and peaks with one, by a column of the peaks (named r_... in it), against a threshold
    of overlaps. Different places of both sides meet once, with their numbers of rows."""
    named = peaks.select(*[F.col(c).alias(f"r_{c}") for c in peaks.columns])
    traits = named.select("r_chr", "r_start", "r_end", "r_peak", by.alias("trait"))
    met = overlap_join(places(df, n=F.count(F.lit(1))), places(peaks), width).groupBy("r_chr", "r_start", "r_end").agg(F.sum("n").alias("n"))
    hits = traits.join(met, ["r_chr", "r_start", "r_end"]).groupBy("trait").agg(F.sum("n").alias("n_overlaps"), F.countDistinct("r_peak").alias("n_peaks"))
    return hits.withColumn("enough", F.col("n_overlaps") >= least).unpivot(["trait", "enough"], ["n_overlaps", "n_peaks"], "measure", "value")


def donor_counts(df: DataFrame, donor: str) -> DataFrame:
    """(donor, n)."""
    return df.groupBy(F.col(donor).alias("donor")).agg(F.count(F.lit(1)).alias("n"))


def first_class(peaks: DataFrame, classes: Sequence[tuple[str, DataFrame]], width: int, slack: int = 0, key: str = "peak", other: str = "none") -> DataFrame:
    """(key, kind, name): the first class, in order, that has a region (chr, start, end, name) within `slack` of the peak, and the least name of
    its regions there. One overlap join for all classes."""
    regions = None
    for i, (_, df) in enumerate(classes):
        part = df.select("chr", "start", "end", F.col("name").cast("string").alias("name"), F.lit(i).alias("order"))
        regions = part if regions is None else regions.unionByName(part)
    hits = overlap_join(peaks, regions, width, slack=slack).groupBy(key).agg(F.min(F.struct(F.col("r_order").alias("order"), F.col("r_name").alias("name"))).alias("b"))
    kind = F.when(F.col("b").isNull(), other).otherwise(F.get(F.array(*[F.lit(name) for name, _ in classes]), F.col("b.order")))
    return peaks.select(key).join(hits, key, "left").select(key, kind.alias("kind"), F.col("b.name").alias("name"))


def consensus_windows(summits: DataFrame, names: DataFrame, excluded: DataFrame, width: int, bins: int) -> DataFrame:
    """Windows of `width` bases around summits (chr, summit, ...) on the listed chromosomes, clear of excluded regions and of the
    chromosome's beginning, with the name chr-start-end."""
    start = F.col("summit") - width // 2
    fixed = summits.join(F.broadcast(names.select("chr").limit(10_000).distinct()), "chr", "left_semi").withColumns({"start": start, "end": start + width}).filter("start >= 0")
    clear = overlap_join(fixed, excluded.select("chr", "start", "end"), bins, how="left_anti")
    return with_name(clear)


def with_name(df: DataFrame, name: str = "name") -> DataFrame:
    """df with the name chr-start-end where it has none."""
    made = F.concat_ws("-", "chr", "start", "end")
    return df.withColumn(name, F.coalesce(F.col(name), made) if name in df.columns else made)


def on_listed(df: DataFrame, names: Sequence[str], required: bool = False) -> DataFrame:
    """Ranges on the listed chromosomes; with `required`, raises where none is left."""
    kept = df.filter(F.col("chr").isin(*names))
    if required and kept.isEmpty():
        raise ValueError(f"no ranges on {list(names)}")
    return kept
