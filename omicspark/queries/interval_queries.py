"""Interval operators on shipments (fragments), suppliers (peaks), nations (genes) and events (points)."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.ranks import add_bh
from ..functions.tails import poisson_above
from ..operators import intervals as iv
from ..operators import studies as st
from .base import FRAGMENTS, GENES, PEAKS, fragments, genes, peaks, query, r6


def merged_sql(source: str, by: str = "chr", gap: int = 0) -> str:
    return f"""(SELECT {by}, min("start") AS "start", max("end") AS "end", count(*) AS n FROM (
 SELECT *, sum(fresh) OVER (PARTITION BY {by} ORDER BY "start", "end" ROWS UNBOUNDED PRECEDING) AS island FROM (
 SELECT *, CASE WHEN max("end") OVER w + {gap} >= "start" THEN 0 ELSE 1 END AS fresh FROM {source} WINDOW w AS (PARTITION BY {by} ORDER BY "start", "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))) GROUP BY {by}, island)"""


def pieces_sql(source: str, by: str = "chr") -> str:
    return f"""(SELECT * FROM (SELECT {by}, pos AS "start", lead(pos) OVER (PARTITION BY {by} ORDER BY pos) AS "end", CAST(sum(d) OVER (PARTITION BY {by} ORDER BY pos) AS BIGINT) AS depth FROM (
 SELECT {by}, pos, sum(d) AS d FROM (SELECT {by}, "start" AS pos, 1 AS d FROM {source} UNION ALL SELECT {by}, "end", -1 FROM {source}) GROUP BY ALL)) WHERE depth > 0 AND "end" IS NOT NULL)"""


@query("interval_merge", f"SELECT * FROM {merged_sql(PEAKS)}")
def interval_merge(t):
    return iv.merge_intervals(peaks(t), width=200)


@query("interval_merge_apart", f"SELECT * FROM {merged_sql(FRAGMENTS, 'cell, chr', -1)}")
def interval_merge_apart(t):
    return iv.merge_intervals(fragments(t), ("cell", "chr"), gap=-1)


@query("interval_disjoin", f"SELECT * FROM {pieces_sql(PEAKS)}")
def interval_disjoin(t):
    return iv.disjoin(peaks(t))


@query("interval_gaps", f"""SELECT * FROM (SELECT chr, lag("end") OVER (PARTITION BY chr ORDER BY "start") AS "start", "start" AS "end" FROM {merged_sql(PEAKS)}) WHERE "start" IS NOT NULL""")
def interval_gaps(t):
    return iv.gaps(peaks(t))


@query("interval_deep_regions", f"""SELECT cell, chr, "start", "end" FROM {merged_sql(f"(SELECT * FROM {pieces_sql(FRAGMENTS, 'cell, chr')} WHERE depth >= 3)", 'cell, chr')}""")
def interval_deep_regions(t):
    return iv.deep_regions(fragments(t), 3, ("cell", "chr"))


@query("interval_overlap_counts", f"""SELECT peak, count(*) AS n, CAST(sum(least(f."end", p."end") - greatest(f."start", p."start")) AS BIGINT) AS bases FROM {FRAGMENTS} f JOIN {PEAKS} p ON f.chr = p.chr AND f."start" < p."end" AND p."start" < f."end" GROUP BY 1""")
def interval_overlap_counts(t):
    pairs = iv.overlap_join(fragments(t), peaks(t), 32)
    return pairs.groupBy(F.col("r_peak").alias("peak")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.least("end", "r_end") - F.greatest("start", "r_start")).alias("bases"))


@query("interval_semi", f"""SELECT * FROM {PEAKS} p WHERE EXISTS (SELECT 1 FROM {GENES} g WHERE g.chr = p.chr AND g."start" < p."end" AND p."start" < g."end")""")
def interval_semi(t):
    return iv.overlap_join(peaks(t), genes(t), 64, how="left_semi")


@query("interval_anti", f"""SELECT * FROM {PEAKS} p WHERE NOT EXISTS (SELECT 1 FROM {GENES} g WHERE g.chr = p.chr AND g."start" < p."end" AND p."start" < g."end")""")
def interval_anti(t):
    return iv.overlap_join(peaks(t), genes(t), 64, how="left_anti")


@query("interval_fragments_in_regions", f"""WITH m AS (SELECT * FROM {merged_sql(PEAKS)}), f AS (SELECT *, EXISTS (SELECT 1 FROM m WHERE m.chr = f.chr AND ((f."start" >= m."start" AND f."start" < m."end") OR (f."end" - 1 >= m."start" AND f."end" - 1 < m."end"))) AS hit FROM {FRAGMENTS} f)
SELECT cell, count(*) AS n_fragments, count_if(hit) AS n_in, round(count_if(hit) / count(*), 6) AS fraction FROM f GROUP BY 1""")
def interval_fragments_in_regions(t):
    return iv.fragments_in_regions(fragments(t), peaks(t).select("chr", "start", "end"), "cell", 64).withColumns(r6("fraction"))


@query("interval_cut_sites", f"""SELECT peak, cell, count(*) AS n FROM {FRAGMENTS} f JOIN {PEAKS} p ON f.chr = p.chr AND ((f."start" >= p."start" AND f."start" < p."end") OR (f."end" - 1 >= p."start" AND f."end" - 1 < p."end")) GROUP BY 1, 2""")
def interval_cut_sites(t):
    return iv.cut_sites_per_region(fragments(t), peaks(t), "cell", "peak", 32)


@query("interval_band_pairs", f"""WITH g AS (SELECT *, CASE WHEN strand = '-' THEN "end" - 1 ELSE "start" END AS tss FROM {GENES}), x AS (SELECT *, CAST(floor(("start" + "end") / 2) AS BIGINT) AS c FROM {PEAKS}),
d AS (SELECT x.chr, peak, gene, c - tss AS distance, x."end" > g."start" AND x."start" < g."end" AS in_body, x."end" > tss - CASE WHEN strand = '-' THEN 5 ELSE 15 END AND x."start" <= tss + CASE WHEN strand = '-' THEN 15 ELSE 5 END AS promoter FROM x JOIN g ON x.chr = g.chr AND abs(c - tss) <= 150)
SELECT *, CASE WHEN promoter THEN 'self_promoter' WHEN in_body THEN 'target_gene_body' WHEN abs(distance) <= 80 THEN 'proximal_nonpromoter' ELSE 'distal' END AS link_class FROM d""")
def interval_band_pairs(t):
    return iv.band_pairs(peaks(t), genes(t), 150, upstream=15, downstream=5, near=80)


@query("interval_remove_overlaps")
def interval_remove_overlaps(t):
    return iv.remove_overlaps(peaks(t), "score", "peak", width=200)


@query("interval_coverage", f"""WITH s AS (SELECT cell, chr, unnest(["start", "end" - 1]) AS pos FROM {FRAGMENTS}), n AS (SELECT cell, chr, CAST(floor(pos / 50) AS BIGINT) AS tile, count(*) AS n FROM s GROUP BY ALL) SELECT *, round(n * 1e6 / sum(n) OVER (PARTITION BY cell), 6) AS rpm FROM n""")
def interval_coverage(t):
    return iv.binned_coverage(fragments(t), "cell", 50).withColumns(r6("rpm"))


@query("interval_owner_overlap", f"""WITH o AS (SELECT chr, "start", "end", peak % 4 AS owner FROM {PEAKS}), m AS (SELECT * FROM {merged_sql('o', 'owner, chr')}), z AS (SELECT owner, sum("end" - "start") AS size FROM m GROUP BY 1),
p AS (SELECT a.owner AS a, b.owner AS b, CAST(sum(least(a."end", b."end") - greatest(a."start", b."start")) AS BIGINT) AS shared FROM m a JOIN m b ON a.chr = b.chr AND a.owner < b.owner AND a."start" < b."end" AND b."start" < a."end" GROUP BY 1, 2)
SELECT a, b, shared, round(shared / (x.size + y.size - shared), 6) AS jaccard, round(shared / least(x.size, y.size), 6) AS coefficient FROM p JOIN z x ON x.owner = a JOIN z y ON y.owner = b""")
def interval_owner_overlap(t):
    return iv.pairwise_overlap(peaks(t).withColumn("owner", F.col("peak") % 4), "owner", 64).withColumns(r6("jaccard", "coefficient"))


@query("interval_fixed_width", f"""SELECT chr, greatest(mid - 10, 0) AS "start", mid + 10 AS "end", concat_ws('-', chr, greatest(mid - 10, 0), mid + 10) AS name, peak FROM (SELECT *, ("start" + "end") // 2 AS mid FROM {PEAKS})""")
def interval_fixed_width(t):
    mid = F.floor((F.col("start") + F.col("end")) / 2)
    fixed = peaks(t).select("chr", F.greatest(mid - 10, F.lit(0)).alias("start"), (mid + 10).alias("end"), "peak")
    return fixed.withColumn("name", F.concat_ws("-", "chr", "start", "end"))


@query("interval_parse_names", f"""SELECT peak, concat(chr, ':', "start", '-', "end") AS region, chr AS seqnames, CAST("start" AS DOUBLE) AS lo, CAST("end" AS DOUBLE) AS hi FROM {PEAKS}""")
def interval_parse_names(t):
    named = peaks(t).select("peak", F.concat("chr", F.lit(":"), "start", F.lit("-"), "end").alias("region"))
    part = lambda i: F.regexp_extract("region", r"^(\w+):(\d+)-(\d+)$", i)
    return named.select("peak", "region", part(1).alias("seqnames"), part(2).cast("double").alias("lo"), part(3).cast("double").alias("hi"))


@query("interval_promoters", f"""SELECT gene, chr, CASE WHEN strand = '-' THEN "end" - 1 ELSE "start" END AS tss, CASE WHEN strand = '-' THEN "start" ELSE greatest("start" - 2, 0) END AS body_start, CASE WHEN strand = '-' THEN "end" + 2 ELSE "end" END AS body_end FROM {GENES}""")
def interval_promoters(t):
    minus = F.col("strand") == "-"
    return genes(t).select("gene", "chr", iv.tss(F.col("start"), F.col("end"), F.col("strand")).alias("tss"), F.when(minus, F.col("start")).otherwise(F.greatest(F.col("start") - 2, F.lit(0))).alias("body_start"), F.when(minus, F.col("end") + 2).otherwise(F.col("end")).alias("body_end"))


@query("interval_first_class", f"""WITH c AS (SELECT p.peak, CASE WHEN strand = '+' THEN 1 ELSE 2 END AS k, min(gene) AS gene FROM {PEAKS} p JOIN {GENES} g ON g.chr = p.chr AND g."start" - 20 < p."end" AND p."start" < g."end" + 20 GROUP BY 1, 2), m AS (SELECT peak, min(k) AS k FROM c GROUP BY 1)
SELECT p.peak, CASE m.k WHEN 1 THEN 'forward' WHEN 2 THEN 'reverse' ELSE 'none' END AS kind, gene FROM {PEAKS} p LEFT JOIN m ON m.peak = p.peak LEFT JOIN c ON c.peak = m.peak AND c.k = m.k""")
def interval_first_class(t):
    g = genes(t).withColumnRenamed("gene", "name")
    return st.first_class(peaks(t), [("forward", g.filter("strand = '+'")), ("reverse", g.filter("strand = '-'"))], 64, 20).withColumnRenamed("name", "gene")


@query("interval_on_listed", f"SELECT * FROM {FRAGMENTS} WHERE chr IN ('A', 'R')")
def interval_on_listed(t):
    return st.on_listed(fragments(t), ["A", "R"], required=True)


@query("interval_consensus_windows", f"""WITH w AS (SELECT chr, peak, ("start" + "end") // 2 AS summit FROM {PEAKS} WHERE chr IN ('A', 'R')), f AS (SELECT *, summit - 25 AS "start", summit + 25 AS "end" FROM w)
SELECT chr, peak, summit, "start", "end", concat_ws('-', chr, "start", "end") AS name FROM f WHERE "start" >= 0 AND NOT EXISTS (SELECT 1 FROM {GENES} g WHERE g.chr = f.chr AND g."start" < f."end" AND f."start" < g."end")""")
def interval_consensus_windows(t):
    summits = peaks(t).select("chr", "peak", F.expr("(start + end) div 2").alias("summit"))
    names = genes(t).filter("chr in ('A', 'R')").select("chr").distinct()
    return st.consensus_windows(summits, names, genes(t), 50, 64)


@query("interval_doublet_metrics", f"""WITH l AS (SELECT cell, count(*) AS n FROM {merged_sql(f"(SELECT * FROM {pieces_sql(FRAGMENTS, 'cell, chr')} WHERE depth >= 3)", 'cell, chr')} GROUP BY 1), c AS (SELECT DISTINCT cell FROM {FRAGMENTS})
SELECT cell, coalesce(n, 0) AS n, round(avg(coalesce(n, 0)) OVER (), 6) AS mean FROM c LEFT JOIN l USING (cell)""")
def interval_doublet_metrics(t):
    loci = iv.deep_regions(fragments(t), 3, ("cell", "chr")).groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    cells = fragments(t).select("cell").distinct().join(loci, "cell", "left").fillna(0, ["n"])
    return cells.withColumn("mean", F.round(F.avg("n").over(Window.partitionBy()), 6))


@query("interval_doublet_tails", f"""WITH l AS (SELECT cell, count(*) AS n FROM {merged_sql(f"(SELECT * FROM {pieces_sql(FRAGMENTS, 'cell, chr')} WHERE depth >= 3)", 'cell, chr')} GROUP BY 1), m AS (SELECT cell, coalesce(n, 0) AS n, round(avg(coalesce(n, 0)) OVER (), 6) AS mean FROM (SELECT DISTINCT cell FROM {FRAGMENTS}) LEFT JOIN l USING (cell)),
p AS (SELECT *, 1 - list_sum([exp(-mean + i * ln(mean) - lgamma(i + 1)) FOR i IN range(0, n + 1)]) AS p FROM m), r AS (SELECT *, row_number() OVER (ORDER BY p DESC, cell) AS k, count(*) OVER () AS f FROM p)
SELECT cell, n, mean, round(p, 6) AS p, round(least(1, min(p * f / (f - k + 1)) OVER (ORDER BY k)), 6) AS q FROM r""")
def interval_doublet_tails(t):
    df = interval_doublet_metrics(t)
    return add_bh(df.withColumn("p", poisson_above(F.col("n"), F.col("mean"))), "p").withColumns(r6("p", "q"))
