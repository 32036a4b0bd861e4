"""Name -> query and name -> SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..session import tune

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is left out where SQL cannot express it."""

    def register(run: Query) -> Query:
        def tuned(spark: SparkSession, folder: str) -> DataFrame:
            return run(tune(spark), folder)

        _QUERIES[name] = tuned
        if sql is not None:
            _SQL[name] = sql
        return run

    return register


def with_ctes(*ctes: str, select: str) -> str:
    recursive = "RECURSIVE " if any("UNION ALL SELECT s." in c for c in ctes) else ""
    return f"WITH {recursive}" + ",\n".join(ctes) + "\n" + select


def plain(df: DataFrame, digits: int | None = None) -> DataFrame:
    """Dates as text and, with ``digits``, rounded doubles: the same bytes in both engines."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif digits is not None and isinstance(f.dataType, T.DoubleType):
            c = F.round(c, digits)
        out.append(c.alias(f.name))
    return df.select(out)


def queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)


def _load() -> None:
    from . import cleaning, files, inputs, joining, series, settling  # noqa: F401
