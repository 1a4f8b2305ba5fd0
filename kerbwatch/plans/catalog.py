"""All registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kerbwatch.plans import q_geometry, q_relations, q_reports, q_streams  # noqa: F401
from kerbwatch.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "flagship"]


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["flagship_crossings_by_hour"](spark, sf_dir)
