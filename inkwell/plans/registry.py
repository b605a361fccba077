"""The engine's queries by name, each with the SQL that it must agree with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from inkwell.plans import catalog, jobs, library, models, papers, texts
from inkwell.plans.catalog import Query

MODULES = (jobs, library, models, papers, texts)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queries()["antibody_style_rules"](spark, sf_dir)


def queries() -> dict[str, Query]:
    return dict(catalog.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(catalog.ORACLES)
