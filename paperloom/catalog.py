"""The engine's queries by name, each with the SQL that gives the same rows where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .plans import contracts, formats, rules
from .plans import queries as relational


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.unit_coverage(spark, sf_dir)


def queries() -> dict:
    return {**relational.QUERIES, **rules.QUERIES, **contracts.QUERIES, **formats.QUERIES}


def oracle_sql() -> dict[str, str]:
    return {**relational.SQL, **rules.SQL, **contracts.SQL}
