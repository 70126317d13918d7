"""Differential models per feature: designs, block correlation, weighted fits under it, unwanted factors, contrasts.

values: (feature, sample, value, weight) long rows; samples: a small table (one row a sample, as many as a study has) with the
design's columns. A feature's rows are bounded by the samples, so features are dealt over tasks and solved there.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ranks import add_bh
from .models import moderate


def design_columns(samples: DataFrame, factors: Sequence[str] = (), numeric: Sequence[str] = (), interactions: Sequence[tuple[str, str]] = ()) -> tuple[DataFrame, list[str]]:
    """samples with a treatment-coded design: intercept, a 0/1 column a level but the first (in order), numbers, products of the
    columns of two terms. Names are sanitised; levels are few, so they pass through the driver."""
    clean = lambda x: re.sub(r"\W+", "_", str(x))
    columns: dict[str, list[str]] = {}
    out, names = samples.withColumn("intercept", F.lit(1.0)), ["intercept"]
    for f in factors:
        levels = sorted(r[0] for r in samples.select(f).distinct().collect() if r[0] is not None)
        columns[f] = [f"{clean(f)}_{clean(v)}" for v in levels[1:]]
        out = out.withColumns({n: (F.col(f) == v).cast("double") for n, v in zip(columns[f], levels[1:], strict=True)})
    for x in numeric:
        columns[x] = [f"{clean(x)}_value"]
        out = out.withColumn(columns[x][0], F.col(x).cast("double"))
    for c in columns.values():
        names += c
    for a, b in interactions:
        for m in columns[a]:
            for n in columns[b]:
                names.append(f"{m}_x_{n}")
                out = out.withColumn(names[-1], F.col(m) * F.col(n))
    return out, names


def check_blocked(samples: DataFrame, group: str, donor: str, block: str | None) -> None:
    """Raises if a donor has several samples in a group and no block is named."""
    if block is None and not samples.groupBy(group, donor).count().filter("count > 1").isEmpty():
        raise ValueError(f"{donor} has several samples in one {group}: name a block")


def expressed(values: DataFrame, samples: DataFrame, least: float, n: int) -> DataFrame:
    """log2 counts per million of features with at least `least` per million in n samples: (feature, sample, value, count, size).
    values: (feature, sample, count) nonzeros; zeros of kept features are filled in."""
    size = values.groupBy("sample").agg(F.sum("count").alias("size")).join(samples.select("sample"), "sample", "left_semi")
    rows = values.join(F.broadcast(size), "sample")
    kept = rows.filter(F.col("count") * 1e6 / F.col("size") >= least).groupBy("feature").agg(F.count(F.lit(1)).alias("k")).filter(F.col("k") >= n).select("feature")
    grid = kept.join(F.broadcast(size)).join(values, ["feature", "sample"], "left").fillna(0, ["count"])
    return grid.select("feature", "sample", F.log2((F.col("count") + 0.5) / (F.col("size") + 1) * 1e6).alias("value"), "count", "size")


def _wide(values: DataFrame, samples: DataFrame, names: Sequence[str], block: str | None) -> DataFrame:
    own = samples.select("sample", F.array(*names).alias("_x"), (F.col(block).cast("string") if block else F.col("sample").cast("string")).alias("_block"))
    rows = values if "weight" in values.columns else values.withColumn("weight", F.lit(1.0))
    entry = F.struct(F.col("sample").cast("string").alias("sample"), F.col("value").cast("double").alias("value"), F.col("weight").cast("double").alias("weight"), "_x", "_block")
    return rows.join(F.broadcast(own), "sample").groupBy("feature").agg(F.array_sort(F.collect_list(entry)).alias("rows"))


def _arrays(rows: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    y, w, x = (np.array([r[c] for r in rows], float) for c in ("value", "weight", "_x"))
    block = np.unique([r["_block"] for r in rows], return_inverse=True)[1]
    ok = np.isfinite(y) & (w >= 1e-15)
    return y[ok], w[ok], x[ok], block[ok]


def blocked_fit(y: np.ndarray, w: np.ndarray, x: np.ndarray, block: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray, float, int] | None:
    """Coefficients, their unscaled covariance, residual variance and degrees of freedom of a weighted fit whose samples of one block
    correlate by rho; None if the design isn't of full rank. Within a block of m the inverse is (I - c 11') / (1 - rho), with
    c = rho / (1 - rho + rho m), so only sums by block are needed."""
    n, k = x.shape
    root = np.sqrt(w)
    xs, ys = x * root[:, None], y * root
    m = np.bincount(block)
    c = rho / (1 - rho + rho * m)
    bx = np.stack([np.bincount(block, xs[:, j], len(m)) for j in range(k)], 1)
    by = np.bincount(block, ys, len(m))
    a = (xs.T @ xs - (bx * c[:, None]).T @ bx) / (1 - rho)
    b = (xs.T @ ys - (bx * c[:, None]).T @ by) / (1 - rho)
    q = (ys @ ys - (c * by * by).sum()) / (1 - rho)
    if n <= k or np.linalg.matrix_rank(a, tol=1e-8 * max(np.diag(a).max(), 1e-300)) < k:
        return None
    inverse = np.linalg.inv(a)
    beta = inverse @ b
    return beta, inverse, float(max(q - beta @ b, 0.0) / (n - k)), n - k


def intra_block_correlation(y: np.ndarray, w: np.ndarray, x: np.ndarray, block: np.ndarray) -> float:
    """rho of greatest restricted likelihood, by golden section within the bounds that keep the blocks' matrices positive."""
    most = np.bincount(block).max()
    if most < 2:
        return float("nan")

    def loss(rho: float) -> float:
        fit = blocked_fit(y, w, x, block, rho)
        if fit is None or fit[2] <= 0:
            return float("inf")
        m = np.bincount(block)
        logdet = ((m - 1) * np.log(1 - rho) + np.log(1 - rho + rho * m)).sum()
        return fit[3] * np.log(fit[2]) + logdet - np.linalg.slogdet(fit[1])[1]

    low, high = -1 / (most - 1) + 0.01, 0.99
    ratio = (5**0.5 - 1) / 2
    a, b = high - ratio * (high - low), low + ratio * (high - low)
    fa, fb = loss(a), loss(b)
    for _ in range(60):
        if fa < fb:
            high, b, fb = b, a, fa
            a = high - ratio * (high - low)
            fa = loss(a)
        else:
            low, a, fa = a, b, fb
            b = low + ratio * (high - low)
            fb = loss(b)
    return (low + high) / 2


def consensus_correlation(values: DataFrame, samples: DataFrame, names: Sequence[str], block: str, most: int = 50_000, trim: float = 0.15) -> float:
    """tanh of the trimmed mean of atanh of the intra-block correlations of at most about `most` features, chosen by hash. The
    features move one number each to a sort; the driver gets two."""
    n = max(1, values.select("feature").distinct().count() // most)
    some = values.filter(F.pmod(F.xxhash64("feature"), F.lit(n)) == 0)

    @F.pandas_udf("double")
    def z(rows: pd.Series) -> pd.Series:
        return rows.map(lambda r: float(np.arctanh(np.clip(intra_block_correlation(*_arrays(list(r))), -0.99, 0.99))))

    each = _wide(some, samples, names, block).select(z("rows").alias("z")).filter(~F.isnan("z"))
    cuts = each.agg(F.percentile("z", trim), F.percentile("z", 1 - trim)).first()
    if cuts[0] is None:
        return 0.0
    return float(np.tanh(each.filter(F.col("z").between(*cuts)).agg(F.avg("z")).first()[0]))


def fit_contrasts(values: DataFrame, samples: DataFrame, names: Sequence[str], contrasts: dict[str, Sequence[float]], block: str | None = None, rho: float = 0.0) -> DataFrame:
    """(feature, contrast, estimate, unscaled, s2, df): weighted fits under block correlation with the exact standard error of each
    contrast, unscaled x sqrt(s2). Features without full rank have none."""
    wanted = {n: np.asarray(c, float) for n, c in contrasts.items()}
    kind = "array<struct<contrast:string,estimate:double,unscaled:double,s2:double,df:int>>"

    @F.pandas_udf(kind)
    def fit(rows: pd.Series) -> pd.Series:
        out = []
        for r in rows:
            found = blocked_fit(*_arrays(list(r)), rho)
            out.append([] if found is None else [{"contrast": n, "estimate": float(c @ found[0]), "unscaled": float(np.sqrt(c @ found[1] @ c)), "s2": found[2], "df": found[3]} for n, c in wanted.items()])
        return pd.Series(out)

    return _wide(values, samples, names, block).select("feature", F.inline(fit("rows")))


def fit_by_type(values: DataFrame, samples: DataFrame, names: Sequence[str], contrasts: dict[str, Sequence[float]], block: str | None = None, rho: float = 0.0) -> DataFrame:
    """(type, feature, contrast, ...): fit_contrasts for every type at once; values: type, feature, sample, value, weight."""
    own = values.withColumn("feature", F.struct("type", "feature")).drop("type")
    return fit_contrasts(own, samples, names, contrasts, block, rho).select("feature.type", F.col("feature.feature").alias("feature"), "contrast", "estimate", "unscaled", "s2", "df")


def mean_variance_weights(values: DataFrame, samples: DataFrame, names: Sequence[str], bins: int = 30) -> DataFrame:
    """values with `weight`: the inverse fourth power of the square-root deviation that the trend of features has at a fitted count.

    values: as `expressed` gives them. The trend is the mean square-root deviation in equal bins of the mean log count, with
    linear interpolation: `bins` numbers that are joined as one row.
    """
    fits = fit_contrasts(values, samples, names, {n: [float(n == m) for m in names] for n in names})
    size = F.log2(F.col("size") + 1)
    means = values.groupBy("feature").agg((F.avg("value") + F.avg(size) - np.log2(1e6)).alias("mean"))
    points = fits.filter(F.col("contrast") == names[0]).join(means, "feature").select("mean", F.sqrt(F.sqrt("s2")).alias("root"))
    edges = points.agg(F.min("mean").alias("lo"), F.max("mean").alias("hi"))
    binned = points.join(F.broadcast(edges)).select(F.least(F.floor((F.col("mean") - F.col("lo")) / F.greatest(F.col("hi") - F.col("lo"), F.lit(1e-9)) * bins), F.lit(bins - 1)).alias("b"), "mean", "root")
    trend = binned.groupBy("b").agg(F.avg("mean").alias("x"), F.avg("root").alias("y")).agg(F.array_sort(F.collect_list(F.struct("x", "y"))).alias("trend"))
    coefficients = fits.groupBy("feature").agg(F.map_from_entries(F.collect_list(F.struct("contrast", "estimate"))).alias("_b"))
    own = samples.select("sample", *names)
    fitted = F.lit(0.0)
    for n in names:
        fitted = fitted + F.element_at("_b", n) * F.col(n)
    rows = values.join(coefficients, "feature").join(F.broadcast(own), "sample").withColumn("_f", fitted + size - np.log2(1e6)).join(F.broadcast(trend))
    rows = rows.withColumn("_lo", F.try_element_at(F.filter("trend", lambda p: p["x"] <= F.col("_f")), F.lit(-1))).withColumn("_hi", F.try_element_at(F.filter("trend", lambda p: p["x"] > F.col("_f")), F.lit(1)))
    between = F.col("_lo.y") + (F.col("_hi.y") - F.col("_lo.y")) * (F.col("_f") - F.col("_lo.x")) / (F.col("_hi.x") - F.col("_lo.x"))
    root = F.coalesce(between, F.col("_lo.y"), F.col("_hi.y"))
    return rows.select(*values.columns, (1 / F.pow(F.greatest(root, F.lit(1e-6)), 4)).alias("weight"))


def gram(values: DataFrame, samples: DataFrame, names: Sequence[str]) -> DataFrame:
    """(a, b, value): products of residuals summed over features, sample by sample; as large as samples are many."""

    @F.pandas_udf("array<double>")
    def residuals(rows: pd.Series) -> pd.Series:
        out = []
        for r in rows:
            r = list(r)
            y, x = np.array([e["value"] for e in r], float), np.array([e["_x"] for e in r], float)
            out.append(y - x @ np.linalg.lstsq(x, y, rcond=None)[0])
        return pd.Series(out)

    own = _wide(values, samples, names, None).select(F.lit(0).alias("g"), F.transform("rows", lambda e: e["sample"].cast("string")).alias("names"), residuals("rows").alias("e"))
    return products(own).drop("g")


def products(rows: DataFrame) -> DataFrame:
    """(g, a, b, value): products of a group's rows, added up. rows: group, names of the entries, entries, as arrays.

    A task adds up its own rows' products as one matrix a group, so what is shuffled is names x names a task, however many rows there are.
    """
    group, names, _ = rows.columns
    kinds = rows.schema[group].dataType.simpleString(), rows.schema[names].dataType.elementType.simpleString()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places: dict[object, dict[object, int]] = {}
        sums: dict[object, np.ndarray] = {}
        kind = None
        for batch in batches:
            kind = batch.schema.types
            same: dict[tuple, list[np.ndarray]] = {}
            for g, n, e in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                same.setdefault((g, tuple(n)), []).append(e.values.to_numpy(zero_copy_only=False))
            for (g, n), x in same.items():
                at = places.setdefault(g, {})
                i = np.array([at.setdefault(c, len(at)) for c in n], np.int64)
                total = sums.get(g, np.zeros((0, 0)))
                if len(at) > len(total):
                    total = np.pad(total, (0, len(at) - len(total)))
                m = np.array(x)
                total[np.ix_(i, i)] += m.T @ m
                sums[g] = total
        for g, total in sums.items():
            n = pa.array(list(places[g]), kind[1].value_type)
            a, b = np.indices(total.shape)
            yield pa.RecordBatch.from_arrays([pa.array([g] * total.size, kind[0]), n.take(pa.array(a.ravel())), n.take(pa.array(b.ravel())), pa.array(total.ravel())], names=["g", "a", "b", "value"])

    found = rows.mapInArrow(add, f"g {kinds[0]}, a {kinds[1]}, b {kinds[1]}, value double")
    return found.groupBy("g", "a", "b").agg(F.sum("value").alias("value"))


def leading_factors(grams: DataFrame, n: int) -> DataFrame:
    """(sample, factor, value): leading eigenvectors of a samples x samples table, factors numbered from 1, the largest entry of each
    positive. Samples are few, so the table is solved in one task."""

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        names = sorted(rows["a"].unique())
        at = {s: i for i, s in enumerate(names)}
        m = np.zeros((len(names), len(names)))
        m[rows["a"].map(at), rows["b"].map(at)] = rows["value"]
        vectors = np.linalg.eigh(m)[1][:, ::-1][:, :n]
        vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(0), np.arange(vectors.shape[1])])
        return pd.DataFrame({"sample": np.repeat(names, vectors.shape[1]), "factor": np.tile(np.arange(1, vectors.shape[1] + 1), len(names)), "value": vectors.ravel()})

    return grams.groupBy(F.lit(1).alias("one")).applyInPandas(solve, "sample string, factor int, value double")


def unwanted_factors(values: DataFrame, samples: DataFrame, names: Sequence[str], tested: Sequence[str], n: int, tolerance: float = 1e-8, rounds: int = 1_000) -> DataFrame:
    """(sample, factor, value): leading factors of the residuals, with the tested columns' part added as far as the features' effects go
    along with their loadings (robust regression, Huber), so that effects beyond those of the factors aren't taken out.

    What passes a round is a table of tested x factors sums. Ends when no slope changes by `tolerance` of the largest; raises if one
    still does after so many rounds.
    """
    factors = leading_factors(gram(values, samples, names), n)
    wide = factors.groupBy("sample").pivot("factor", list(range(1, n + 1))).agg(F.first("value"))
    columns = [f"_f{i}" for i in range(1, n + 1)]
    own = samples.join(wide.toDF("_name", *columns), F.col("sample").cast("string") == F.col("_name")).drop("_name")
    loads = _wide(values, own, [*names, *columns], None)
    k = len(names)
    at = [list(names).index(c) for c in tested]

    @F.pandas_udf("array<array<double>>")
    def parts(rows: pd.Series) -> pd.Series:
        out = []
        for r in rows:
            r = list(r)
            y, x = np.array([e["value"] for e in r], float), np.array([e["_x"] for e in r], float)
            beta = np.linalg.lstsq(x[:, :k], y, rcond=None)[0]
            e = y - x[:, :k] @ beta
            s = np.sqrt((e * e).sum() / max(len(y) - k, 1))
            out.append([] if s <= 0 else [list(x[:, k:].T @ e / s), [float(beta[i] / s) for i in at]])
        return pd.Series(out)

    from .loops import cut

    pairs = cut(loads.select(parts("rows").alias("p")).filter(F.size("p") == 2).select(F.col("p")[0].alias("load"), F.col("p")[1].alias("effect")))
    slopes = np.zeros((len(tested), n))
    x = [F.element_at("load", j + 1) for j in range(n)]
    for i in range(len(tested)):
        y = F.element_at("effect", i + 1)
        for _ in range(rounds):
            fitted = F.lit(0.0)
            for j in range(n):
                fitted = fitted + float(slopes[i, j]) * x[j]
            rows = pairs.withColumn("r", y - fitted)
            scale = (rows.agg(F.percentile(F.abs("r"), 0.5)).first()[0] or 0.0) / 0.6745
            w = F.least(F.lit(1.0), 1.345 * scale / F.greatest(F.abs("r"), F.lit(1e-12))) if scale > 0 else F.lit(1.0)
            sums = rows.agg(*[F.sum(w * a * b) for a in x for b in x], *[F.sum(w * a * y) for a in x]).first()
            new = np.linalg.lstsq(np.array(sums[: n * n], float).reshape(n, n), np.array(sums[n * n :], float), rcond=None)[0]
            done = np.abs(new - slopes[i]).max() <= tolerance * max(1.0, np.abs(new).max())
            slopes[i] = new
            if done:
                break
        else:
            raise RuntimeError(f"unwanted_factors: slopes still change after {rounds} rounds")
    moved = own
    for j in range(n):
        add = F.lit(0.0)
        for i, c in enumerate(tested):
            add = add + float(slopes[i, j]) * F.col(c)
        moved = moved.withColumn(columns[j], F.col(columns[j]) + add)
    return moved.select(F.col("sample").cast("string").alias("sample"), F.inline(F.array(*[F.struct(F.lit(j + 1).alias("factor"), F.col(c).alias("value")) for j, c in enumerate(columns)])))


def contrast_support(samples: DataFrame, names: Sequence[str], contrast: Sequence[float], donor: str) -> DataFrame:
    """One row: samples and donors on either side of a contrast (by the sign of the contrast on a sample's design), and donors on both."""
    side = F.lit(0.0)
    for n, c in zip(names, contrast, strict=True):
        side = side + float(c) * F.col(n)
    rows = samples.withColumn("_side", side)
    up, down = F.col("_side") > 0, F.col("_side") <= 0
    per = rows.groupBy(donor).agg(F.count_if(up).alias("u"), F.count_if(down).alias("d"))
    return per.agg(F.sum("u").alias("n_up"), F.sum("d").alias("n_down"), F.count_if(F.col("u") > 0).alias("donors_up"), F.count_if(F.col("d") > 0).alias("donors_down"), F.count_if((F.col("u") > 0) & (F.col("d") > 0)).alias("donors_paired"))


def type_support(samples: DataFrame, types: Sequence[str], donor: str = "donor", by: str = "type") -> DataFrame:
    """One row: donors and samples of each side of a contrast between types, and donors that have all of them."""
    rows = samples.filter(F.col(by).isin(*types))
    per = rows.groupBy(donor).agg(F.count(F.lit(1)).alias("n"), F.countDistinct(by).alias("k"))
    return per.agg(F.sum("n").alias("n_samples"), F.count(F.lit(1)).alias("n_donors"), F.count_if(F.col("k") == len(set(types))).alias("n_paired"))


def combined_response(values: DataFrame, scales: dict[str, float], by: str = "type") -> DataFrame:
    """(feature, donor, value, weight): the scaled sum over types of each donor's values, with the weight 1 / sum(scale^2 / w), for
    donors and features that all the types have. values: type, feature, donor, value, weight."""
    scale = F.create_map(*[F.lit(x) for kv in scales.items() for x in (kv[0], float(kv[1]))])
    rows = values.filter(F.col(by).isin(*scales)).withColumn("_s", F.element_at(scale, F.col(by)))
    per = rows.groupBy("feature", "donor").agg(F.sum(F.col("_s") * F.col("value")).alias("value"), (1 / F.sum(F.col("_s") * F.col("_s") / F.col("weight"))).alias("weight"), F.countDistinct(by).alias("_k"))
    return per.filter(F.col("_k") == len(scales)).drop("_k")


def differential_table(fits: DataFrame, by: Sequence[str] = ("contrast",)) -> DataFrame:
    """Moderated t, p and BH q within each contrast, from fit_contrasts. The prior is over all rows of a contrast."""
    out = None
    for c in [r[0] for r in fits.select(by[-1]).distinct().collect()]:  # contrasts are named by the caller, so they are few
        own = fits.filter(F.col(by[-1]) == c).select("feature", *by, F.col("estimate").alias("slope"), "s2", (F.col("unscaled") * F.sqrt("s2")).alias("se"), "df")
        rows = moderate(own)
        out = rows if out is None else out.unionByName(rows)
    return add_bh(out.drop("q"), "p", "q", list(by)).withColumnRenamed("slope", "estimate")


def contrast_statistic(t: Column, p: Column, estimate: Column) -> Column:
    """t where there is one, else the normal quantile of p with the sign of the estimate; raises where there is neither, or p isn't
    above 0 and at most 1. (The smallest positive p gives 38.5; a p of 0 has no quantile.)"""

    @F.pandas_udf("double")
    def quantile(p: pd.Series) -> pd.Series:
        from statistics import NormalDist

        return p.map(lambda x: -NormalDist().inv_cdf(x / 2), na_action="ignore")

    usable = (p > 0) & (p <= 1) & estimate.isNotNull() & ~F.isnan(estimate)
    bad = F.raise_error(F.concat(F.lit("no statistic: p = "), F.coalesce(p.cast("string"), F.lit("null")), F.lit(", estimate = "), F.coalesce(estimate.cast("string"), F.lit("null")))).cast("double")
    has_t = t.isNotNull() & ~F.isnan(t)
    return F.when(has_t, t).when(F.coalesce(usable, F.lit(False)), F.signum(estimate) * quantile(F.when(~F.coalesce(has_t, F.lit(False)) & usable, p))).otherwise(bad)
