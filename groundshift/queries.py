"""Registered queries of the library's own operators and the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from groundshift.plans import building, catalog, clusters, composite, epochs, evidence, features, fieldwork, focal, land, layers, more, parcelview, quarry, reporting, scoring, screening, sensors, shapes, stats, summary, sweep  # noqa: F401  they register their queries
from groundshift.plans.registry import QUERIES, SQL, Query


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["E04_parcel_priority"](spark, sf_dir)


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
