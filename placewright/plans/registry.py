"""Queries and oracle SQL of the engine's own operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from placewright.plans import families
from placewright.plans.queries import ORACLES, QUERIES

__all__ = ["families"]  # importing it registers its queries


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statuses of normalized addresses: the flagship query."""
    return QUERIES["address_normalize_status"](spark, sf_dir)


def queries() -> dict:
    return dict(QUERIES)


def oracles() -> dict[str, str]:
    return dict(ORACLES)
