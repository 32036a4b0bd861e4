"""Statement tables to one joined table."""

from __future__ import annotations

import datetime
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from .. import keys as K
from ..operators.clean import in_universe, period_between, universe
from ..operators.joins import join_and_select, join_statements
from ..session import small_side, tune
from ..sources.sinks import write_csv, write_parquet

def restrict(
    tables: Mapping[str, DataFrame],
    companies: DataFrame,
    low: str | datetime.date,
    high: str | datetime.date,
) -> dict[str, DataFrame]:
    """Each table inside the dates and the universe; both are key columns, so this runs at the scans."""
    return {name: df.transform(period_between, low, high).transform(in_universe, companies) for name, df in tables.items()}


def join_latest(
    tables: Mapping[str, DataFrame],
    info: DataFrame,
    sector: int,
    low: str | datetime.date,
    high: str | datetime.date,
    rank: str = "all",
) -> DataFrame:
    """Latest revisions of one sector's statements, joined on the record key, keys once."""
    return join_statements(restrict(tables, small_side(universe(info, sector)), low, high), rank)


def join_selected(
    tables: Mapping[str, DataFrame],
    info: DataFrame,
    sector: int,
    low: str | datetime.date,
    high: str | datetime.date,
) -> DataFrame:
    """All revisions of the statements with the sector code, reduced to the model columns."""
    companies = small_side(universe(info, sector))
    return join_and_select(restrict(tables, companies, low, high), companies)


def export_latest(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    info: DataFrame,
    path: str,
    sector: int,
    low: str | datetime.date,
    high: str | datetime.date,
    rank: str = "all",
    single_file: bool = False,
) -> bool:
    """``join_latest`` to headed CSV."""
    tune(spark)
    kept = restrict(tables, small_side(universe(info, sector)), low, high)
    return write_csv(join_statements(kept, rank), path, single_file, null_marker=None)


def export_selected(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    info: DataFrame,
    path: str,
    sector: int,
    low: str | datetime.date,
    high: str | datetime.date,
) -> bool:
    """``join_selected`` to Parquet, partitioned by sector."""
    tune(spark)
    companies = small_side(universe(info, sector))
    kept = restrict(tables, companies, low, high)
    return write_parquet(join_and_select(kept, companies), path, partition_by=[K.SECTOR])
