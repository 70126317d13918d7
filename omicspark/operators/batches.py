"""Soft-cluster batch correction: rows are assigned softly to clusters, with a penalty on clusters in which batches aren't mixed, and each
cluster's batch shifts are taken out by ridge regression; both again until nothing changes.

Rows are (id, vector, batch). A row's assignment follows from its direction and the model (centres, and a factor a cluster and
batch), so it is computed where the row lies and never stored. A pass adds up clusters x batches x dimensions numbers a task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .loops import cut

#: Rows that the first centres are fitted on, at most, chosen by a hash of id.
SEED_ROWS = 10_000


@dataclass
class SoftClusters:
    """Unit centres (clusters x dimensions), log of the diversity factor (clusters x batches), and the batches' names."""

    centres: np.ndarray
    penalty: np.ndarray
    batches: list

    def assign(self, unit: np.ndarray, batch: np.ndarray, width: float) -> np.ndarray:
        """Shares of the clusters for each row."""
        score = -2 * (1 - unit @ self.centres.T) / width + self.penalty.T[batch]
        score = np.exp(score - score.max(1, keepdims=True))
        return score / score.sum(1, keepdims=True)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-300)


def _first_centres(sample: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k-means of a sample of unit rows, from rows that lie far from those chosen before."""
    chosen = [sample[0]]
    while len(chosen) < k:
        away = np.min([1 - sample @ c for c in chosen], axis=0).clip(0)
        chosen.append(sample[rng.choice(len(sample), p=away / away.sum())] if away.sum() > 1e-12 else sample[rng.integers(len(sample))])
    centres = np.array(chosen)
    last = None
    while True:
        near = (sample @ centres.T).argmax(1)
        if last is not None and (near == last).all():
            return centres
        last = near
        centres = _unit(np.array([sample[near == c].sum(0) if (near == c).any() else centres[c] for c in range(k)]))


def _passes(rows: DataFrame, columns: list[str], add: Callable[[list[np.ndarray], np.ndarray], np.ndarray], names: list) -> np.ndarray:
    """Adds up what `add` makes of the vectors in `columns` and the number of the batch, over all rows; arrays of one shape."""
    at = {b: i for i, b in enumerate(names)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if len(batch):
                number = np.array([at[b] for b in batch.column(len(columns)).to_pylist()])
                part = add([batch.column(i).flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1) for i in range(len(columns))], number)
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["i", "v"])

    found = rows.select(*columns, "batch").mapInArrow(run, "i bigint, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(len(found))
    for i, v in found:
        out[i] = v
    return out


def soft_cluster_correction(vectors: DataFrame, clusters: int | None = None, theta: float = 2.0, width: float = 0.1, ridge: float = 1.0, tolerance: float = 1e-4, cluster_tolerance: float = 1e-5, rounds: int = 200, seed: int = 1) -> DataFrame:
    """(id, vector): vectors (id, vector, batch) with the batches' shifts of each soft cluster taken out.

    Assignments weigh exp(-2 (1 - cosine) / width) by ((expected + 1) / (observed + 1))^theta, the share of a batch in a cluster by all
    and by its own rows; observed and expected are half of the last round's, so that rows that move together don't swing. A round
    ends when the objective (distance, entropy, diversity) changes by less than `cluster_tolerance` of it, all ends when it does so by
    less than `tolerance` from one correction to the next; raises after so many rounds. Without `clusters` there is one for 30 rows, 100 at
    most. Rows with a null batch or vector are left out; one batch alone is handed back as it is.
    """
    kept = vectors.select("id", F.col("vector").cast("array<double>").alias("vector"), "batch").filter("vector is not null and batch is not null")
    rows = cut(kept.withColumn("now", F.col("vector")))
    sizes = {r[0]: r[1] for r in rows.groupBy("batch").agg(F.count(F.lit(1))).orderBy("batch").collect()}
    names, n = list(sizes), sum(sizes.values())
    if len(names) < 2:
        return rows.select("id", "vector")
    share = np.array(list(sizes.values()), float) / n
    sample = _unit(np.array([r[0] for r in rows.select("vector", F.xxhash64("id", F.lit(seed)).alias("h"), "id").orderBy("h", "id").limit(SEED_ROWS).collect()], float))
    k, b, d = min(clusters or max(1, min(round(n / 30), 100)), len(sample)), len(names), sample.shape[1]
    model = SoftClusters(_first_centres(sample, k, np.random.default_rng(seed)), np.zeros((k, b)), names)
    last, observed = None, None
    kind = rows.schema["id"].dataType.simpleString()
    for _ in range(rounds):
        before = None
        for _ in range(rounds):

            def clustered(x: list[np.ndarray], number: np.ndarray, model: SoftClusters = model) -> np.ndarray:
                unit = _unit(x[0])
                r = model.assign(unit, number, width)
                by_batch = np.zeros((k, b))
                np.add.at(by_batch.T, number, r)
                loss = (r * 2 * (1 - unit @ model.centres.T)).sum() + width * (r * np.log(np.maximum(r, 1e-300))).sum()
                return np.concatenate([by_batch.ravel(), (r.T @ unit).ravel(), [loss]])

            sums = _passes(rows, ["now"], clustered, names)
            new, mean, loss = sums[: k * b].reshape(k, b), sums[k * b : -1].reshape(k, d), sums[-1]
            observed = new if observed is None else (observed + new) / 2
            expected = np.outer(observed.sum(1), share)
            objective = loss + width * theta * (new * np.log((new + 1) / (np.outer(new.sum(1), share) + 1))).sum()
            model = SoftClusters(_unit(mean), theta * np.log((expected + 1) / (observed + 1)), names)
            if before is not None and abs(before - objective) <= cluster_tolerance * max(abs(objective), 1e-12):
                break
            before = objective
        else:
            raise RuntimeError(f"soft_cluster_correction: assignments still change after {rounds} rounds")

        def moments(x: list[np.ndarray], number: np.ndarray, model: SoftClusters = model) -> np.ndarray:
            r = model.assign(_unit(x[0]), number, width)
            out = np.zeros((b, k, d + 1))
            for i in np.unique(number):
                own = number == i
                out[i, :, :d] = r[own].T @ x[1][own]
                out[i, :, d] = r[own].sum(0)
            return out

        shifts = _shifts(_passes(rows, ["now", "vector"], moments, names).reshape(b, k, d + 1), ridge)
        rows = cut(_corrected(rows, model, shifts, width, kind))
        if last is not None and abs(last - objective) <= tolerance * max(abs(objective), 1e-12):
            return rows.select("id", F.col("now").alias("vector"))
        last = objective
    raise RuntimeError(f"soft_cluster_correction: vectors still change after {rounds} rounds")


def _shifts(sums: np.ndarray, ridge: float) -> np.ndarray:
    """(batches, clusters, dimensions): each cluster's batch effects, by regression of its weighted rows on an intercept and the batches."""
    b, k, d = sums.shape[0], sums.shape[1], sums.shape[2] - 1
    out = np.zeros((b, k, d))
    for c in range(k):
        weight, total = sums[:, c, d], sums[:, c, :d]
        left = np.zeros((b + 1, b + 1))
        left[0, 0], left[0, 1:], left[1:, 0] = weight.sum(), weight, weight
        left[1:, 1:] = np.diag(weight + ridge)
        out[:, c] = np.linalg.lstsq(left, np.vstack([total.sum(0), total]), rcond=None)[0][1:]
    return out


def _corrected(rows: DataFrame, model: SoftClusters, shifts: np.ndarray, width: float, kind: str) -> DataFrame:
    at = {b: i for i, b in enumerate(model.batches)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            now, first = (batch.column(i).flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1) for i in (3, 1))
            number = np.array([at[b] for b in batch.column(2).to_pylist()], np.int64)
            r = model.assign(_unit(now), number, width)
            moved = first.copy()
            for i in np.unique(number):
                own = number == i
                moved[own] -= r[own] @ shifts[i]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(moved) + 1, dtype=np.int32) * moved.shape[1]), pa.array(moved.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], lists], names=["id", "vector", "batch", "now"])

    return rows.select("id", "vector", "batch", "now").mapInArrow(run, f"id {kind}, vector array<double>, batch {rows.schema['batch'].dataType.simpleString()}, now array<double>")
