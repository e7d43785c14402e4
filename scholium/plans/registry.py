"""Every query of the library's general operators, by name, with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import branches, figures, matching, people, raws, records, reports, shapes, upkeep  # noqa: F401  they register their queries
from .base import QUERIES, SQL, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New papers by title fingerprint, kept once, that speak of the subject, counted by language."""
    return matching.q_flagship(spark, sf_dir)
