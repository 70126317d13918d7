"""Linkage scores by annotation: squared correlations of dosages, summed over windows of whole chunks on the genetic map.

variants: chr, pos, snp, cm, dosage array<double> (0 to 2; null: missing), annotations array<double> (null: none), scored boolean. chr
and snp name a variant, and cm doesn't fall along a chromosome; rows with a null in chr, pos, snp or cm have no place and are left out.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .loops import cut, numbered


def mean_dosage(dosage: str = "dosage") -> Column:
    """Mean of the known dosages, null if none is known."""
    known = F.filter(dosage, lambda x: x.isNotNull())
    return F.when(F.size(known) > 0, F.aggregate(known, F.lit(0.0), lambda a, x: a + x) / F.size(known))


def _varying(variants: DataFrame) -> DataFrame:
    return variants.withColumn("_mean", mean_dosage()).filter("_mean > 0 AND _mean < 2")


def chunk_reach(chunks: DataFrame, window: float) -> DataFrame:
    """(chr, chunk, reach): the first chunk that a chunk's variants are paired with: the one that holds the left end of the window of its
    first variant. Chunks up to the first with a variant more than `window` from the start of the chromosome reach back to chunk 0.
    chunks: chr, chunk, first_cm, last_cm, one row a chunk, so a chromosome's are few."""

    def search(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("chunk")
        first, last = rows["first_cm"].to_numpy(float), rows["last_cm"].to_numpy(float)
        reach = np.searchsorted(last, first - window, side="left")
        beyond = np.flatnonzero(last - window > first[0])
        reach[: beyond[0] + 1 if len(beyond) else len(reach)] = 0
        return pd.DataFrame({"chr": rows["chr"], "chunk": rows["chunk"], "reach": reach})

    return chunks.groupBy("chr").applyInPandas(search, f"chr {chunks.schema['chr'].dataType.simpleString()}, chunk bigint, reach bigint")


def annotation_scores(variants: DataFrame, n_samples: int, n_annotations: int, window: float = 1.0, chunk: int = 50, tile: int = 20) -> DataFrame:
    """(chr, pos, snp, scores) of the scored variants: for each annotation the sum over the window of (r2 - (1 - r2) / (n - 2)) times the
    other variant's value, itself included.

    Variants without both alleles are dropped first; the rest are dealt to chunks of `chunk` in order of place. Two variants are in
    one window if the later one's chunk reaches the earlier one's (`chunk_reach`). Missing dosages count as the mean. Dosages that don't
    vary (all heterozygous) keep their place in the chunks, and have no score and no part in others'.

    A task multiplies two tiles of `tile` chunks: its memory is 2 x tile x chunk x samples numbers however dense the map is, and each
    variant is sent once to every tile within its window. Only scored or annotated variants move.
    """
    own = _varying(variants.filter("chr IS NOT NULL AND pos IS NOT NULL AND snp IS NOT NULL AND cm IS NOT NULL"))
    placed = numbered(own.select("chr", "pos", "snp", "cm"), ["chr", "pos", "snp"], "_number")
    first = placed.groupBy("chr").agg(F.min("_number").alias("_first"))
    placed = placed.join(first, "chr").select("chr", "snp", "cm", (F.col("_number") - F.col("_first")).alias("n")).withColumn("chunk", F.floor(F.col("n") / chunk))
    ends = placed.groupBy("chr", "chunk").agg(F.min_by("cm", "n").alias("first_cm"), F.max_by("cm", "n").alias("last_cm"))
    reach = cut(chunk_reach(ends, window))

    centred = F.transform("dosage", lambda x: F.coalesce(x, F.col("_mean")) - F.col("_mean"))
    rows = own.filter("scored OR annotations IS NOT NULL").select("chr", "pos", "snp", "annotations", F.coalesce("scored", F.lit(False)).alias("scored"), centred.alias("_c"))
    rows = rows.withColumn("_norm", F.sqrt(F.aggregate("_c", F.lit(0.0), lambda a, x: a + x * x))).filter("_norm > 1e-12")
    rows = rows.withColumn("unit", F.transform("_c", lambda x: x / F.col("_norm"))).drop("_c", "_norm")
    rows = cut(rows.join(placed.select("chr", "snp", "n", "chunk"), ["chr", "snp"]).join(reach, ["chr", "chunk"]).withColumn("tile", F.floor(F.col("chunk") / tile)))

    tiles = reach.groupBy("chr", F.floor(F.col("chunk") / tile).alias("b")).agg(F.floor(F.min("reach") / tile).alias("low"))
    pairs = tiles.select("chr", "b", F.explode(F.sequence("low", "b")).alias("a"))
    member = pairs.select("chr", F.col("a").alias("tile"), "a", "b").unionByName(pairs.filter("a < b").select("chr", F.col("b").alias("tile"), "a", "b"))

    def multiply(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("n")
        a, b = rows[rows["tile"] == rows["a"].iloc[0]], rows[rows["tile"] == rows["b"].iloc[0]]
        out = []
        if len(a) and len(b):
            r2 = (np.stack(a["unit"]) @ np.stack(b["unit"]).T) ** 2
            i, j = a["chunk"].to_numpy()[:, None], b["chunk"].to_numpy()[None]
            later = np.where(i > j, a["reach"].to_numpy()[:, None], b["reach"].to_numpy()[None])
            r2 = (r2 - (1 - r2) / (n_samples - 2)) * (later <= np.minimum(i, j))
            for mine, other, m in ((a, b, r2), (b, a, r2.T)) if len(a) + len(b) == len(rows) else ((a, a, r2),):
                wanted, known = mine["scored"].to_numpy(bool), other["annotations"].notna().to_numpy()
                if wanted.any() and known.any():
                    parts = m[np.ix_(wanted, known)] @ np.stack(other["annotations"][known]).astype(float)
                    out.append(pd.DataFrame({"chr": mine["chr"][wanted], "snp": mine["snp"][wanted], "part": list(parts)}))
        return pd.concat(out) if out else pd.DataFrame({c: pd.Series(dtype=object) for c in ("chr", "snp", "part")})

    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("chr", "snp")}
    parts = rows.join(member, ["chr", "tile"]).groupBy("chr", "a", "b").applyInPandas(multiply, f"chr {kinds['chr']}, snp {kinds['snp']}, part array<double>")
    zeros = F.array_repeat(F.lit(0.0), n_annotations)
    sums = parts.groupBy("chr", "snp").agg(F.aggregate(F.collect_list("part"), zeros, lambda s, p: F.zip_with(s, p, lambda x, y: x + y)).alias("scores"))  # a part a tile of its window
    return rows.filter("scored").select("chr", "pos", "snp").join(sums, ["chr", "snp"], "left").select("chr", "pos", "snp", F.coalesce("scores", zeros).alias("scores"))


def common_annotation_sums(variants: DataFrame, least: float = 0.05) -> DataFrame:
    """(annotation, total, total_squares) over annotated variants whose rarer allele's share is above `least`; annotations from 1."""
    share = F.least(F.col("_mean"), 2 - F.col("_mean")) / 2
    rows = _varying(variants).filter("annotations IS NOT NULL").filter(share > least).select(F.posexplode("annotations").alias("_i", "x"))
    return rows.groupBy((F.col("_i") + 1).alias("annotation")).agg(F.sum("x").alias("total"), F.sum(F.col("x") * F.col("x")).alias("total_squares"))
