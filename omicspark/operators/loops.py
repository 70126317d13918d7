"""Lineage cuts for iterative operators, and numbers over whole tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def cut(df: DataFrame) -> DataFrame:
    """df written as Parquet below the folder that the cluster shares (spark.checkpoint.dir), and read again; a temporary folder only where
    none is set and Spark runs on one machine.

    Not checkpoint(): a checkpoint keeps the size that was estimated for its plan, a join's estimate is the product of its sides, and in
    a loop that grows to numbers of so many digits that planning takes longer than the work. A table that is read has its own size.
    """
    spark = df.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-checkpoint-"))
        folder = spark.sparkContext.getCheckpointDir()
    path = f"{folder.rstrip('/')}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, order: Sequence[str], out: str = "number") -> DataFrame:
    """df with a number from 0 over the whole table in that order: range partitions, each numbered by itself behind the counts
    of those before it. The order is taken to be total."""
    parts = cut(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    first = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_k")).withColumn("_first", F.coalesce(F.sum("_k").over(before), F.lit(0)))
    inside = Window.partitionBy("_part").orderBy(*order)
    return parts.join(F.broadcast(first), "_part").withColumn(out, F.col("_first") + F.row_number().over(inside) - 1).drop("_part", "_k", "_first")


def tiled(df: DataFrame, order: Sequence[str], n: int, out: str = "tile") -> DataFrame:
    """df with its ntile from 1 over the whole table in that order: larger tiles first, sizes apart by one at most."""
    rows = numbered(df, order, "_number")
    total = rows.count()
    size, more = divmod(total, n)
    number = F.col("_number")
    tile = F.when(number < more * (size + 1), F.floor(number / (size + 1))).otherwise(more + F.floor((number - more * (size + 1)) / max(size, 1))) + 1
    return rows.withColumn(out, tile.cast("int")).drop("_number")
