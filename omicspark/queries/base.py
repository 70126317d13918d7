"""Registry of queries and the roles that the test tables play."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    """Registers fn(t), where t(name) reads a table, as a query of (spark, sf_dir); sql: DuckDB SQL of the same rows."""

    def add(fn: Callable) -> Callable:
        QUERIES[name] = lambda spark, sf_dir: fn(lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet"))
        if sql:  # a count is BIGINT in both engines
            ORACLE_SQL[name] = re.sub(r"count_if\(([^()]*(?:\([^()]*\)[^()]*)*)\)", r"count(*) FILTER (\1)", sql)
        return fn

    return add


def r6(*columns: str) -> dict:
    return {c: F.round(c, 6) for c in columns}


def signed_round(x: Column, digits: int = 6) -> Column:
    """Rounded, with the sign kept where that gives zero: -0.0 as in SQL, where F.round gives 0.0."""
    return F.round(F.abs(x), digits) * F.signum(x)


def counts(t: Callable) -> DataFrame:
    """Sparse counts: feature = part, cell = supplier, count = quantity."""
    return t("lineitem").groupBy(F.col("l_partkey").alias("feature"), F.col("l_suppkey").alias("cell")).agg(F.sum(F.col("l_quantity").cast("bigint")).alias("count"))


COUNTS = "(SELECT l_partkey AS feature, l_suppkey AS cell, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS count FROM lineitem GROUP BY 1, 2)"


def fragments(t: Callable) -> DataFrame:
    """Owned intervals: chr = return flag, start = days, length = quantity, cell = supplier."""
    day = F.datediff("l_shipdate", F.lit("1992-01-01"))
    return t("lineitem").select(F.col("l_returnflag").alias("chr"), day.cast("bigint").alias("start"), (day + F.col("l_quantity").cast("int")).cast("bigint").alias("end"), F.col("l_suppkey").alias("cell"))


FRAGMENTS = "(SELECT l_returnflag AS chr, CAST(date_diff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE)) AS BIGINT) AS \"start\", CAST(date_diff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE)) AS BIGINT) + CAST(l_quantity AS BIGINT) AS \"end\", l_suppkey AS cell FROM lineitem)"


def peaks(t: Callable) -> DataFrame:
    """Regions: one a supplier, chr by its nation, start by its balance, width 4 to 12."""
    k = F.col("s_nationkey") % 3
    start = (F.floor(F.abs("s_acctbal") * 7) % 2500).cast("bigint")
    return t("supplier").select(F.when(k == 0, "A").when(k == 1, "N").otherwise("R").alias("chr"), start.alias("start"), (start + 4 + F.col("s_suppkey") % 9).alias("end"), F.col("s_suppkey").alias("peak"), F.col("s_acctbal").alias("score"))


PEAKS = "(SELECT CASE s_nationkey % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'N' ELSE 'R' END AS chr, CAST(floor(abs(s_acctbal) * 7) AS BIGINT) % 2500 AS \"start\", CAST(floor(abs(s_acctbal) * 7) AS BIGINT) % 2500 + 4 + s_suppkey % 9 AS \"end\", s_suppkey AS peak, s_acctbal AS score FROM supplier)"


def genes(t: Callable) -> DataFrame:
    """Genes: one a nation, 40 wide, strand by parity."""
    k = F.col("n_nationkey")
    start = (k * 97).cast("bigint")
    return t("nation").select(F.when(k % 3 == 0, "A").when(k % 3 == 1, "N").otherwise("R").alias("chr"), start.alias("start"), (start + 40).alias("end"), F.when(k % 2 == 0, "+").otherwise("-").alias("strand"), F.col("n_name").alias("gene"))


GENES = "(SELECT CASE n_nationkey % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'N' ELSE 'R' END AS chr, CAST(n_nationkey * 97 AS BIGINT) AS \"start\", CAST(n_nationkey * 97 + 40 AS BIGINT) AS \"end\", CASE WHEN n_nationkey % 2 = 0 THEN '+' ELSE '-' END AS strand, n_name AS gene FROM nation)"
