"""Queries of the operators on the test tables: name -> callable(spark, sf_dir), with DuckDB SQL of the same rows."""

from . import background_queries, differential_queries, graph_queries, interval_queries, joint_queries, keyed_queries, label_queries, learner_queries, link_queries, matrix_queries, profile_queries, qc_queries, report_queries, table_queries  # noqa: F401
from .base import ORACLE_SQL, QUERIES

FLAGSHIP = "qc_retention"
__all__ = ["FLAGSHIP", "ORACLE_SQL", "QUERIES"]
