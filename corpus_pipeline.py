"""Five stages from documents to encoded documents; each takes (spark, docs, sf_dir) and returns a DataFrame.

All but the last return the columns of documents; each works on all that the one before kept, and is written as Parquet and
read again between. In every stage null texts read as empty, rows are told apart by their content and not by doc_id alone
(which may be null or repeated), rows that are equal get equal treatment, texts are read whole, an empty table stays empty,
and further columns of any name are handed on as they are.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from omicspark.llm.common import shared_folder, spare
from omicspark.llm.decontaminate import MIN_BYTES, find_benchmark
from omicspark.llm.line_templates import drop_lines
from omicspark.llm.near_copies import keep_one
from omicspark.llm.sentencepieces import default_model, encode_pieces
from omicspark.llm.toxicity import fit, score_toxicity


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it learns from the labelled ones among docs.

    A null or empty text gets the score of no words; without labelled rows nothing is rejected.
    """
    verdict, score = spare(docs.columns, "rejected", "score")
    scored = score_toxicity(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")), score_col=score, verdict_col=verdict)
    return scored.filter(F.col(verdict) == 0).drop(score, verdict)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of recurring templates go, and whole long and short lines that recur, but for their first document's.

    All documents stay, even with no line left; null texts stay null. n_chars is counted anew. Long lines shared by near
    copies alone stay for the next stage, which drops the copies.
    """
    return drop_lines(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts linked by five-word shingles (Jaccard 0.8 or more) stays: the one with the smallest
    doc_id (nulls last). Null, empty and wordless texts are one group; equal rows are copies."""
    return keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item of MIN_BYTES or more go; null and empty texts hold none and stay."""
    (key,) = spare(docs.columns, "content")
    keyed = docs.withColumn(key, F.sha2(F.coalesce("text", F.lit("")), 256))
    hits = find_benchmark(keyed, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col=key, min_bytes=MIN_BYTES)
    return keyed.join(hits.select(F.col("doc_id").alias(key)).distinct(), key, "left_anti").drop(key)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their piece ids and the text decoded from them; null texts have no ids."""
    return encode_pieces(docs, default_model())


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("encode", encode),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents; what a stage returns is written to the shared folder and read again."""
    docs, folder = spark.read.parquet(f"{sf_dir}/documents.parquet"), f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
