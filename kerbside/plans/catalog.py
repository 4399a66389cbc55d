"""All registered queries and the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

GROUPS = ["traffic", "ingest", "files", "fleet", "districts", "roads", "planning"]


def _groups():
    return [import_module(f"kerbside.plans.{g}") for g in GROUPS]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: fn for g in _groups() for name, fn in g.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for g in _groups() for name, sql in g.ORACLE.items()}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kerbside.plans.planning import best_initial_plan

    return best_initial_plan(spark, sf_dir)
