"""Vendor files to cleaned Parquet tables, one per file type."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.clean import clean_statements
from ..session import tune
from ..sources.flatfile import field_names, parse_rows, stage_lines
from ..sources.sinks import append_registry, registry_rows, write_by_type


def ingest(spark: SparkSession, paths: str | Sequence[str], registry: str | None = None) -> dict[str, DataFrame]:
    """Read, type and clean the files; one lazy frame per file type.

    With ``registry``, the field list of every file is recorded there first.
    """
    tune(spark)
    staged = stage_lines(spark, paths)
    if registry is not None:
        fields = field_names(staged).select(F.col("file").alias("path"), F.col("names").alias("colnames"))
        append_registry(spark, registry_rows(fields), registry)
    frames = {}
    for kind in [r.file_type for r in staged.select("file_type").distinct().orderBy("file_type").collect()]:
        rows = parse_rows(staged.where(F.col("file_type") == kind)).drop("file", "region", "file_type")
        if not rows.isEmpty():
            frames[kind] = clean_statements(rows.withColumn("OPERATION_DATE", F.current_date()))
    return frames


def ingest_to(
    spark: SparkSession,
    paths: str | Sequence[str],
    folder: str,
    registry: str | None = None,
    today: datetime.date | None = None,
) -> dict[str, str]:
    """``ingest`` and one dated Parquet table per type; returns the table paths."""
    return write_by_type(ingest(spark, paths, registry), folder, today)
