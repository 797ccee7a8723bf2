"""Queries of this package and the SQL that gives the same rows, where SQL can."""

from __future__ import annotations

import textwrap
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def wrap(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = build
        if sql:
            SQL[name] = textwrap.dedent(sql).strip()
        return build

    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
