"""The operators run over the given tables, each with the SQL that must give the same rows."""

from .catalog import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
