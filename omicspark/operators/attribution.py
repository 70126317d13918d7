"""Weights of groups behind associated peaks, with a prior chosen on held-out chromosomes and peaks of the same bins as null.

pairs: (locus, feature, chr, mass); likelihood: (feature, group, likelihood) of every feature, groups being few; bins: (feature, bin).
All fits (prior x fold, then the null draws) go through the pairs together: a pass is one aggregate, and what reaches the driver is
one number a fit and group.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .background import held_out_folds
from .loops import cut

#: Candidates for the prior's weight, in loci; folds; null draws; nats by which weights must beat even ones on held-out pairs.
PRIORS, FOLDS, DRAWS, LEAST_GAIN = (0.1, 1.0, 10.0, 100.0), 5, 10, 1.0


@dataclass
class Attribution:
    """Groups in order; the chosen prior, held-out log likelihood a candidate and of even weights, weights, and null weights a draw."""

    groups: list[str]
    prior: float
    held_out: dict[float, float]
    even: float
    weights: np.ndarray
    null: np.ndarray

    @property
    def estimable(self) -> bool:
        return max(self.held_out.values()) - self.even >= LEAST_GAIN


def _wide(likelihood: DataFrame) -> tuple[list[str], DataFrame]:
    groups = sorted(r[0] for r in likelihood.select("group").distinct().collect())
    columns = [F.coalesce(F.max(F.when(F.col("group") == g, F.col("likelihood"))), F.lit(0.0)) for g in groups]
    return groups, likelihood.groupBy("feature").agg(F.array(*columns).alias("v"))


def null_features(pairs: DataFrame, bins: DataFrame, draws: int, seed: int = 1) -> DataFrame:
    """(locus, feature, draw, null): for each pair and draw a hash-drawn feature of the feature's bin, itself among them."""
    number = F.row_number().over(Window.partitionBy("bin").orderBy(F.xxhash64("feature", F.lit(seed)), "feature")) - 1
    numbered = cut(bins.select("feature", "bin").withColumn("number", number))
    sizes = numbered.groupBy("bin").agg(F.count(F.lit(1)).alias("size"))
    own = pairs.select("locus", "feature").join(bins.select("feature", "bin"), "feature").join(sizes, "bin").withColumn("draw", F.explode(F.sequence(F.lit(1), F.lit(draws))))
    at = own.withColumn("number", F.pmod(F.xxhash64("locus", "feature", "draw", F.lit(seed)), F.col("size")).cast("int"))
    return at.join(numbered.select("bin", "number", F.col("feature").alias("null")), ["bin", "number"]).select("locus", "feature", "draw", "null")


def _pass(rows: DataFrame, fits: Sequence[tuple[frozenset, np.ndarray]], log: bool) -> np.ndarray:
    """For each fit (parts that count, weights): the mass of each group by responsibility, or the log likelihood. rows: part, mass, v."""
    k = 1 if log else len(fits[0][1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(fits), k))
        for batch in batches:
            if not len(batch):
                continue
            part, mass = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            v = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)
            for i, (parts, w) in enumerate(fits):
                own = np.isin(part, list(parts))
                mixed = v[own] @ w
                total[i] += (mass[own] * np.log(mixed)).sum() if log else w * (v[own].T @ (mass[own] / mixed))
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array(x.ravel()) for x in (i, j, total)], names=["i", "j", "v"])

    out = np.zeros((len(fits), k))
    for i, j, v in rows.select("part", "mass", "v").mapInArrow(run, "i bigint, j bigint, v double").groupBy("i", "j").agg(F.sum("v")).collect():
        out[i, j] = v
    return out


def _fitted(rows: DataFrame, wanted: Sequence[tuple[frozenset, float]], k: int, tolerance: float, rounds: int) -> list[np.ndarray]:
    """Weights of each wanted fit (parts that count, prior), by EM steps with squared extrapolation every other step. A fit is done when
    a step changes no weight by `tolerance`; raises if one isn't after so many rounds."""
    masses = {r[0]: r[1] for r in rows.groupBy("part").agg(F.sum("mass")).collect()}
    now = [np.full(k, 1.0 / k) for _ in wanted]
    done = [not any(p in masses for p in parts) for parts, _ in wanted]

    def step(some: list[int], at: list[np.ndarray]) -> list[np.ndarray]:
        found = _pass(rows, [(wanted[i][0], w) for i, w in zip(some, at, strict=True)], log=False)
        return [(f + wanted[i][1] / k) / (sum(masses.get(p, 0.0) for p in wanted[i][0]) + wanted[i][1]) for i, f in zip(some, found, strict=True)]

    for _ in range(rounds):
        open_ = [i for i in range(len(wanted)) if not done[i]]
        if not open_:
            return now
        first = step(open_, [now[i] for i in open_])
        for i, w in zip(open_, first, strict=True):
            done[i] = np.abs(w - now[i]).max() < tolerance
        left = [i for i in open_ if not done[i]]
        once = dict(zip(open_, first, strict=True))
        twice = dict(zip(left, step(left, [once[i] for i in left]), strict=True)) if left else {}
        for i in open_:
            if done[i]:
                now[i] = once[i]
                continue
            r, v = once[i] - now[i], twice[i] - 2 * once[i] + now[i]
            stride = -np.sqrt((r @ r) / max(v @ v, 1e-300))
            ahead = now[i] - 2 * min(stride, -1.0) * r + min(stride, -1.0) ** 2 * v
            now[i] = ahead / ahead.sum() if (ahead > 0).all() else twice[i]
    raise RuntimeError(f"attribution: weights still change after {rounds} rounds")


def attributed(pairs: DataFrame, likelihood: DataFrame, bins: DataFrame, priors: Sequence[float] = PRIORS, folds: int = FOLDS, draws: int = DRAWS, tolerance: float = 1e-6, rounds: int = 1_000, seed: int = 1) -> Attribution | None:
    """Weights of the groups, with the prior whose fits on all folds but one predict the pairs of that fold best (ties: the first), and
    weights of null draws with it. A pair is there once for each locus and feature; features without a likelihood are left out, and
    without any pair the result is None."""
    groups, wide = _wide(likelihood)
    own = pairs.groupBy("locus", "feature", "chr").agg(F.sum("mass").alias("mass")).filter("mass > 0")
    rows = cut(held_out_folds(own, "chr", folds).join(wide, "feature").select("locus", "feature", F.col("fold").cast("int").alias("part"), F.col("mass").cast("double").alias("mass"), "v"))
    there = sorted(r[0] for r in rows.select("part").distinct().collect())
    if not there:
        return None
    k, every = len(groups), frozenset(there)
    keys = [(g, f) for g in priors for f in there]
    weights = _fitted(rows, [(every - {f}, g) for g, f in keys], k, tolerance, rounds)
    found = _pass(rows, [(frozenset({f}), w) for (_, f), w in zip(keys, weights, strict=True)], log=True)[:, 0]
    held_out = {g: float(sum(v for (h, _), v in zip(keys, found, strict=True) if h == g)) for g in priors}
    even = float(_pass(rows, [(every, np.full(k, 1.0 / k))], log=True)[0, 0])
    prior = max(priors, key=lambda g: held_out[g])
    drawn = null_features(rows, bins, draws, seed).join(rows.select("locus", "feature", "mass"), ["locus", "feature"]).join(wide.withColumnRenamed("feature", "null"), "null")
    parts = cut(rows.select(F.lit(0).alias("part"), "mass", "v").unionByName(drawn.select(F.col("draw").alias("part"), "mass", "v")))
    fits = _fitted(parts, [(frozenset({d}), prior) for d in range(draws + 1)], k, tolerance, rounds)
    return Attribution(groups, prior, held_out, even, fits[0], np.array(fits[1:]).reshape(draws, k))


def weight_table(found: Attribution, pairs: DataFrame) -> DataFrame:
    """(group, weight, matched_weight, estimable, prior): weights, and their mean over null draws; null where held-out pairs aren't predicted
    better than by even weights."""
    rows = [(g, float(w) if found.estimable else None, float(m) if found.estimable else None, found.estimable, float(found.prior)) for g, w, m in zip(found.groups, found.weights, found.null.mean(0), strict=True)]
    return pairs.sparkSession.createDataFrame(rows, "group string, weight double, matched_weight double, estimable boolean, prior double")
