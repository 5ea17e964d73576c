"""Query registry: QUERIES by name, and SQL with the equivalent statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function of a table reader under its name, with its SQL."""

    def add(build: Callable[..., DataFrame]):
        QUERIES[build.__name__] = lambda spark, sf_dir: build(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"), spark)
        if sql:
            SQL[build.__name__] = sql
        return build

    return add


from veilwork.plans import image_queries, relational_queries, text_queries  # noqa: E402, F401
