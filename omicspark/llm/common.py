"""What the operators of this subpackage share: texts, words, checkpoints."""

from __future__ import annotations

import tempfile
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are maximal runs without these six characters; bytes.split() cuts at the same ones.
WORD = r"[^\x20\x09-\x0D]+"
BLANK = " \t\n\x0b\x0c\r"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def keyed_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) with null texts read as empty; other columns are dropped before any shuffle."""
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def remainder(id_col: Column | str, n: int) -> Column:
    """crc32 of the id as text, modulo n: the split into learning and held-out rows."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % n if isinstance(id_col, str) else F.crc32(id_col.cast("string").cast("binary")) % n


def cut(df: DataFrame) -> DataFrame:
    """Checkpoint to the folder that the cluster shares (spark.checkpoint.dir); a temporary one only where none is set, as in tests."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a temporary one only where none is set and Spark runs on one machine, as in tests."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        own = spark.conf.get("spark.checkpoint.dir", None)
        if not own and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(own or tempfile.mkdtemp(prefix="spark-checkpoint-"))
    return spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()


def spare(columns: Iterable[str], *names: str) -> list[str]:
    """The names, with underscores added until no column has them (letter case aside)."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def quoted(name: str) -> str:
    """A column name that may hold dots or spaces, as an expression."""
    return f"`{name.replace('`', '``')}`"
