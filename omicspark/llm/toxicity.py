"""Toxicity classifier with counterfactual regularisation.

A logistic model over the presence of words and stems. Its vocabulary is chosen by word counts, and its weights are fitted, on a
bounded sample of the labelled learning rows (MAX_FIT_ROWS). In each sampled sentence that holds identity terms, each term is swapped for
every other of its group, and the squared change of the score is penalised, so that naming a group isn't what makes a text toxic.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, keyed_texts, remainder

#: Labelled rows that the model is fitted on, at most; chosen by a hash of doc_id.
MAX_FIT_ROWS = 12_000
#: Words of the model, at most, and labelled rows that a word must occur in.
MAX_WORDS, MIN_ROWS = 1_000, 12
THRESHOLD = 0.7
#: Weight of the counterfactual penalty against the log loss.
FAIRNESS = 20.0
STEMS = (5, 6, 7)
# fixed values: identity terms that are exchanged with each other
IDENTITY_GROUPS = (
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("man", "woman"), ("men", "women"), ("boy", "girl"), ("he", "she"), ("male", "female"),
    ("gay", "straight", "lesbian", "bisexual", "transgender", "heterosexual"),
    ("german", "french", "spanish", "english", "american", "mexican", "chinese", "russian"),
    ("mann", "frau"), ("männer", "frauen"), ("homme", "femme"), ("hombre", "mujer"),
    ("musulman", "chrétien", "juif"), ("musulmán", "cristiano", "judío"), ("muslime", "christen", "juden"),
)
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> set[str]:
    """Words of a text in lower case, and the stems that they begin with (5 to 7 letters, marked by a dash)."""
    words = set(_WORD.findall((text or "").lower()))
    return words.union(*({f"{w[:k]}-" for w in words if len(w) >= k} for k in STEMS))


@dataclass
class ToxicityModel:
    """Words, their weights and the bias; of bounded size, so that it may go to every task."""

    weights: dict[str, float]
    bias: float

    def score(self, text: str | None) -> float:
        z = self.bias + sum(map(self.weights.__getitem__, words_of(text).intersection(self.weights)))
        return float(1 / (1 + np.exp(-np.clip(z, -50, 50))))


def fit_weights(x: np.ndarray, y: np.ndarray, swaps: list[tuple[int, int, int]], l2: float = 4e-5, fairness: float = FAIRNESS, rounds: int = 300) -> tuple[np.ndarray, float]:
    """Weights (0 or more) and bias by Adam on log loss + l2 + fairness x the mean squared change of score over swaps.

    x: rows by words, 0 or 1. swaps: (row, word that is there, word put in its place).
    """
    n, k = x.shape
    w, b = np.zeros(k, np.float32), float(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3))) if n else 0.0
    m, v, mb, vb = np.zeros(k), np.zeros(k), 0.0, 0.0
    rows, out, into = (np.array([s[i] for s in swaps], int) for i in range(3))
    there = x[rows, into] if len(swaps) else np.empty(0)
    for t in range(1, rounds + 1 if n else 1):
        z = x @ w + b
        p = 1 / (1 + np.exp(-z))
        gz = (p - y) / n
        gw = l2 * w
        if len(swaps):
            zs = z[rows] - w[out] + np.where(there > 0, 0, w[into])
            ps = 1 / (1 + np.exp(-zs))
            d = 2 * fairness * (p[rows] - ps) / len(swaps)
            a, c = d * p[rows] * (1 - p[rows]), d * ps * (1 - ps)
            np.add.at(gz, rows, a - c)
            np.add.at(gw, out, c)
            np.add.at(gw, into, np.where(there > 0, 0, -c))
        gw = gw + x.T @ gz.astype(np.float32)
        gb = float(gz.sum())
        m, v, mb, vb = 0.9 * m + 0.1 * gw, 0.999 * v + 0.001 * gw**2, 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb**2
        step, own = 0.1 / (1 - 0.9**t), 1 - 0.999**t
        w = np.maximum(w - step * m / (np.sqrt(v / own) + 1e-8), 0).astype(np.float32)  # so that a long text can't outweigh its worst words
        b -= step * mb / (np.sqrt(vb / own) + 1e-8)
    return w, b


def fit(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    """Learns from labels of rows whose crc32(doc_id as text) mod 3 is not 1.

    Null labels and ids are left out; of several labels of one id the greatest counts, of several texts the least. Without labelled rows the model is
    a bias of even odds. What reaches the driver: at most MAX_WORDS words and MAX_FIT_ROWS rows of their numbers.
    """
    own = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).filter("doc_id is not null and toxic is not null and toxic in (0, 1)")
    own = own.filter(remainder("doc_id", 3) != 1).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    some = own.withColumn("draw", F.xxhash64("doc_id", F.lit(17))).orderBy("draw", "doc_id").limit(MAX_FIT_ROWS).drop("draw")
    texts = keyed_texts(docs).join(F.broadcast(some), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).select("doc_id", "text", "toxic")

    def bag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([sorted(words_of(x.as_py())) for x in batch.column(1)], pa.list_(pa.string())), batch.column(2)], names=["doc_id", "words", "toxic"])

    bags = texts.mapInArrow(bag, f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, words array<string>, toxic int")
    counts = bags.select(F.explode("words").alias("word"), "toxic").groupBy("word").agg(F.sum("toxic").alias("a"), F.count(F.lit(1)).alias("n"))
    n, toxic = some.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not n:
        return ToxicityModel({}, 0.0)
    rate = (toxic + 0.5) / (n + 1)
    surprise = (F.col("a") - rate * F.col("n")) / F.sqrt(F.col("n") * rate * (1 - rate))
    terms = {t for group in IDENTITY_GROUPS for t in group}
    # nor the stems that they begin with, so that a swapped term leaves nothing of itself in the sentence
    barred = {x for t in terms for x in words_of(t)}
    chosen = [r.word for r in counts.filter((F.col("n") >= MIN_ROWS) & ~F.col("word").isin(*barred)).orderBy(surprise.desc(), "word").limit(MAX_WORDS).collect()]
    number = {w: i for i, w in enumerate([*chosen, *sorted(terms)])}

    def numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([sorted(map(number.__getitem__, words_of(x.as_py()).intersection(number))) for x in batch.column(1)], pa.list_(pa.int32())), batch.column(2)], names=["at", "toxic"])

    sampled = texts.mapInArrow(numbers, "at array<int>, toxic int").toArrow()
    x, y = np.zeros((len(sampled), len(number)), np.float32), np.array(sampled.column(1).to_pylist(), np.float32)
    order = np.lexsort([[hash(tuple(a)) for a in sampled.column(0).to_pylist()], y]) if len(sampled) else []
    rows = [sampled.column(0)[int(i)].as_py() for i in order]
    y = y[order] if len(sampled) else y
    groups = {number[t]: [number[o] for o in group if o != t] for group in IDENTITY_GROUPS for t in group}
    swaps = []
    for i, at in enumerate(rows):
        x[i, at] = 1
        swaps += [(i, t, o) for t in at if t in groups for o in groups[t]]
    w, b = fit_weights(x, y, swaps)
    return ToxicityModel({t: float(w[i]) for t, i in number.items()}, b)


def score_toxicity(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD, text_col: str = "text", score_col: str = "toxicity", verdict_col: str = "toxic_predicted") -> DataFrame:
    """docs with a score (0 to 1) and a verdict (1 from the threshold on); existing columns of those names are replaced.

    Null and empty texts get the score of no words. Rows are scored one by one, and an empty table stays empty.
    """

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array([model.score(x.as_py()) for x in texts], pa.float64())

    return docs.withColumn(score_col, score(text_col)).withColumn(verdict_col, (F.col(score_col) >= threshold).cast("int"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    scored = score_toxicity(docs.select("doc_id", "text"), fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return scored.select("doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), F.col("toxicity").alias("score"), F.col("toxic_predicted").alias("predicted"))
