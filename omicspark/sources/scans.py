"""Typed scans and sinks of the file kinds that single-cell and genetic tables come in."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FRAGMENTS = "chr string, start long, end long, barcode string, n int"
BED = "chr string, start long, end long, width long, strand string, reason string"
NARROW_PEAK = "chr string, start long, end long, name string, score int, strand string, fold_change double, neg_log10p double, neg_log10q double, summit int"
VARIANT_MAP = "CHR string, SNP string, CM double, BP long, A1 string, A2 string"


def read_fragments(spark: SparkSession, path: str, sample: str) -> DataFrame:
    """Tab-separated fragments with # comments; the cell is `<sample>_<barcode>`."""
    rows = spark.read.csv(path, sep="\t", comment="#", schema=FRAGMENTS)
    return rows.select("chr", "start", "end", F.concat_ws("_", F.lit(sample), "barcode").alias("cell"), "n")


def read_regions(spark: SparkSession, path: str) -> DataFrame:
    """Regions with a reason; places stay 0-based and half-open."""
    return spark.read.csv(path, sep="\t", comment="#", schema=BED).select("chr", "start", "end", "strand", "reason")


def read_narrow_peaks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", schema=NARROW_PEAK)


def read_variant_map(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", schema=VARIANT_MAP)


def read_metrics(spark: SparkSession, path: str, schema: str, called: str = "is_cell") -> DataFrame:
    """Typed CSV with a header; rows that are called."""
    return spark.read.csv(path, header=True, schema=schema).filter(F.col(called) == 1)


def read_keyed(spark: SparkSession, path: str, key: str) -> DataFrame:
    """Tab-separated text columns with a header; raises if a key is missing or repeated."""
    rows = spark.read.csv(path, sep="\t", header=True)
    bad = rows.groupBy(key).count().filter(F.col(key).isNull() | (F.col("count") > 1)).limit(1).collect()
    if bad:
        raise ValueError(f"key {bad[0][0]!r} is missing or repeated in {path}")
    return rows


def resolve_columns(columns: Sequence[str], wanted: dict[str, Sequence[str]]) -> dict[str, str]:
    """For each wanted name the first of its candidates that is there, in any case; raises if none is."""
    there = {c.lower(): c for c in reversed(columns)}
    found = {name: next((there[c.lower()] for c in options if c.lower() in there), None) for name, options in wanted.items()}
    missing = [name for name, c in found.items() if c is None]
    if missing:
        raise ValueError(f"no column for {', '.join(missing)}")
    return found


def read_sumstats(spark: SparkSession, path: str, wanted: dict[str, Sequence[str]], kept: DataFrame | None = None, snp: str = "SNP") -> DataFrame:
    """Text columns chosen by candidate names; only the SNPs in `kept`, if given."""
    rows = spark.read.csv(path, sep="\t", header=True)
    rows = rows.select(*[F.col(c).alias(name) for name, c in resolve_columns(rows.columns, wanted).items()])
    return rows if kept is None else rows.join(kept.select(snp), snp, "left_semi")


def feature_regions(df: DataFrame, interval: str = "interval") -> DataFrame:
    """Columns seqnames, start, end of `chr:start-end` text; other text leaves them null."""
    part = lambda i: F.nullif(F.regexp_extract(interval, r"^([^:]+):(\d+)-(\d+)$", i), F.lit(""))
    return df.withColumns({"seqnames": part(1), "start": part(2).cast("long"), "end": part(3).cast("long")})


def explode_credible_sets(sets: DataFrame, flags: Sequence[str]) -> DataFrame:
    """One row a variant of nested credible sets without any of the flags; `chr_pos_ref_alt` ids are parsed."""
    bad = F.arrays_overlap(F.coalesce("qualityControls", F.array().cast("array<string>")), F.array(*map(F.lit, flags)))
    rows = sets.filter(~bad).select("studyId", "studyLocusId", F.explode("locus").alias("v")).select("studyId", "studyLocusId", "v.*")
    part = lambda i: F.regexp_extract("variantId", r"^(?:chr)?([0-9XYMT]+)_(\d+)_([ACGT]+)_([ACGT]+)$", i)
    return rows.withColumns({"chr": F.concat(F.lit("chr"), part(1)), "pos": part(2).cast("long"), "ref": part(3), "alt": part(4)})


def read_motifs(spark: SparkSession, path: str) -> DataFrame:
    """(id, place, A, C, G, T) of count blocks that end with //."""
    blocks = spark.read.text(path, lineSep="//\n").select(F.regexp_extract("value", r"(?m)^ID\s+(\S+)", 1).alias("id"), F.expr(r"regexp_extract_all(value, '(?m)^(\\d+\\s+[0-9.]+\\s+[0-9.]+\\s+[0-9.]+\\s+[0-9.]+)', 1)").alias("rows"))
    cells = F.split("row", r"\s+")
    return blocks.filter("id <> ''").select("id", F.explode("rows").alias("row")).select("id", cells[0].cast("int").alias("place"), *[cells[i + 1].cast("double").alias(b) for i, b in enumerate("ACGT")])


def trim_motifs(motifs: DataFrame, least: int = 8, share: float = 0.5) -> DataFrame:
    """Motifs (id, place, A, C, G, T) cut to their best-supported window, places numbered anew from 1: as wide as the stretch between the
    first and the last place with `share` of the greatest total, `least` places at least (all, if there are fewer), around that
    stretch, where the totals sum to most; ties to the first."""
    row = F.struct("place", *"ACGT")
    listed = motifs.groupBy("id").agg(F.array_sort(F.collect_list(row)).alias("rows"))
    listed = listed.withColumn("totals", F.transform("rows", lambda r: r["A"] + r["C"] + r["G"] + r["T"]))
    high = F.transform("totals", lambda x: x >= share * F.array_max("totals"))
    listed = listed.withColumns({"n": F.size("rows"), "lo": F.array_position(high, True).cast("int") - 1, "hi": F.size("rows") - F.array_position(F.reverse(high), True).cast("int")})
    listed = listed.withColumn("width", F.least(F.greatest(F.col("hi") - F.col("lo") + 1, F.lit(least)), F.col("n")))
    starts = F.sequence(F.greatest(F.lit(0), F.col("hi") - F.col("width") + 1), F.least("lo", F.col("n") - F.col("width")))
    support = lambda s: F.aggregate(F.slice("totals", s + 1, F.col("width")), F.lit(0.0), lambda a, x: a + x)
    best = F.array_max(F.transform(starts, lambda s: F.struct(F.round(support(s), 9).alias("sum"), (-s).alias("minus"))))
    kept = listed.withColumn("first", -best["minus"]).select("id", F.posexplode(F.slice("rows", F.col("first") + 1, F.col("width"))).alias("i", "r"))
    return kept.select("id", (F.col("i") + 1).alias("place"), *[F.col(f"r.{b}") for b in "ACGT"])


def read_mapping(spark: SparkSession, path: str | None, keys: Sequence[str], unique: Sequence[Sequence[str]], known: DataFrame, without: dict[str, str] | None = None) -> DataFrame:
    """An optional tab-separated mapping table of text columns; without a path an empty one. Raises, naming all that is wrong, where a key
    column or value is missing, a combination of `unique` columns repeats, a value holds what it may not (`without`: column ->
    pattern), or the first key isn't among `known`. One pass counts the violations."""
    if path is None:
        return spark.createDataFrame([], ", ".join(f"{k} string" for k in keys))
    rows = spark.read.csv(path, sep="\t", header=True)
    missing = [k for k in keys if k not in rows.columns]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    checks = {f"rows without {k}": F.count_if(F.col(k).isNull()) for k in keys}
    checks |= {f"repeated {' and '.join(u)}": F.count(F.lit(1)) - F.countDistinct(*[F.coalesce(F.col(c), F.lit("")) for c in u]) for u in unique}
    checks |= {f"{k} with {pattern!r}": F.count_if(F.col(k).rlike(pattern)) for k, pattern in (without or {}).items()}
    counts = rows.agg(*[c.alias(f"c{i}") for i, c in enumerate(checks.values())]).first()
    wrong = {name: n for name, n in zip(checks, counts, strict=True) if n}
    unknown = rows.select(keys[0]).dropna().join(known.select(F.col(known.columns[0]).cast("string").alias(keys[0])), keys[0], "left_anti").count()
    if unknown:
        wrong[f"{keys[0]} not known"] = unknown
    if wrong:
        raise ValueError(f"{path}: " + ", ".join(f"{n} {name}" for name, n in wrong.items()))
    return rows


def write_regions(df: DataFrame, path: str, by: str) -> None:
    """Tab-separated chr, start, end and what follows, one folder a group."""
    df.repartition(by).write.partitionBy(by).csv(path, sep="\t")


def write_table(df: DataFrame, path: str) -> None:
    df.write.csv(path, sep="\t", header=True)
