"""Name -> query and name -> SQL of this subpackage, like those of the library's own queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import tune

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is left out where SQL cannot express it or is too slow on whole tables."""

    def register(run: Query) -> Query:
        def tuned(spark: SparkSession, folder: str) -> DataFrame:
            return run(tune(spark), folder)

        _QUERIES[name] = tuned
        if sql is not None:
            _SQL[name] = sql
        return run

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def queries() -> dict[str, Query]:
    from . import queries as _  # noqa: F401

    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    from . import queries as _  # noqa: F401

    return dict(_SQL)
