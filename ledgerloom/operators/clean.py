"""Filters, null handling and column clean-up."""

from __future__ import annotations

import datetime
import re
from collections import Counter
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .. import keys as K
from ..functions import scalar as S


def universe(
    info: DataFrame,
    sector: int = K.ALL_SECTORS,
    company: str = K.COMPANY,
    sector_column: str = K.SECTOR,
) -> DataFrame:
    """Distinct companies of one sector (or of all) with their sector code.

    A company listed under two sectors is an error, as it would multiply rows in later joins.
    """
    rows = info if sector == K.ALL_SECTORS else info.where(F.col(sector_column) == sector)
    low, high = F.min(sector_column), F.max(sector_column)
    return rows.groupBy(company).agg(
        F.when(low.eqNullSafe(high), low)
        .otherwise(F.raise_error(F.concat(F.lit("more than one sector for company "), F.col(company).cast("string"))))
        .alias(sector_column)
    )


def in_universe(df: DataFrame, companies: DataFrame, company: str = K.COMPANY) -> DataFrame:
    """Rows of the listed companies.  Pass the list through ``session.small_side`` to have its size
    checked once; beyond the bound this is a shuffle join that adaptive execution splits on skew."""
    return df.join(companies.select(company), company, "left_semi")


def period_between(
    df: DataFrame,
    low: str | datetime.date,
    high: str | datetime.date,
    column: str = K.PERIOD_END,
) -> DataFrame:
    """Rows strictly between two dates."""
    c = F.col(column)
    return df.where((c > F.lit(low).cast("date")) & (c < F.lit(high).cast("date")))


def annual_rows(df: DataFrame, period: str = K.FISCAL_PERIOD) -> DataFrame:
    """Annual filings with their ``Year``; the update date is parsed when it is text or a number."""
    return _parse_untyped_dates(df, [K.UPDATE_DT]).where(S.is_annual(period)).withColumn(K.YEAR, S.fiscal_year(period))


def quarterly_rows(df: DataFrame, period: str = K.FISCAL_PERIOD) -> DataFrame:
    """Quarterly filings with ``Year`` and ``Quarter``; dates are parsed when they are text or numbers."""
    return (
        _parse_untyped_dates(df, [K.PERIOD_END, K.ANNOUNCE_DT, K.UPDATE_DT])
        .where(S.is_quarterly(period))
        .withColumns({K.YEAR: S.fiscal_year(period), K.QUARTER: S.fiscal_quarter(period)})
    )


def parse_dates(df: DataFrame, columns: Iterable[str] = K.DATE_COLUMNS, fmt: str = "yyyyMMdd") -> DataFrame:
    """Parse the listed columns that exist."""
    found = {c: S.parse_date(c, fmt) for c in columns if c in df.columns}
    return df.withColumns(found) if found else df


def _parse_untyped_dates(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    kinds = (T.StringType, T.NumericType)
    return parse_dates(df, [c for c in columns if c in df.columns and isinstance(df.schema[c].dataType, kinds)])


def replace_empty(df: DataFrame, sentinels: Mapping[str, str] = K.EMPTY_SENTINELS) -> DataFrame:
    """Empty strings of the key columns become sentinels; NULL stays NULL."""
    return df.withColumns({c: S.replace_empty(c, s) for c, s in sentinels.items()})


def clean_statements(
    df: DataFrame,
    date_columns: Iterable[str] = K.DATE_COLUMNS,
    sentinels: Mapping[str, str] = K.EMPTY_SENTINELS,
) -> DataFrame:
    """Sentinels for empty keys, then typed dates, in one projection over the scan."""
    return df.transform(replace_empty, sentinels).transform(parse_dates, date_columns)


def common_filings(df: DataFrame, since: str = "2019-01-01") -> DataFrame:
    """Optional preset: latest consolidated US filings of regular quarters after a date."""
    return df.where(
        (F.col(K.FILING_STATUS) == "MR")
        & (F.col(K.CONSOLIDATED) == "Y")
        & (F.col(K.ACCOUNTING) == "US GAAP")
        & (F.col(K.PERIOD_END) > F.lit(since).cast("date"))
        & F.col(K.FISCAL_PERIOD).rlike(r"^\d{4} Q[1-4]$")
    )


def blank_to_null(df: DataFrame, token: str = "NULL") -> DataFrame:
    """Zero in numeric columns and ``token`` in text columns become NULL."""
    out = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.NumericType):
            c = F.nullif(c, F.lit(0).cast(field.dataType))
        elif isinstance(field.dataType, T.StringType):
            c = F.nullif(c, F.lit(token))
        out.append(c.alias(field.name))
    return df.select(out)


def year_from(df: DataFrame, year: int = 1990, column: str = K.YEAR) -> DataFrame:
    return df.where(F.col(column) >= year)


def drop_peak(df: DataFrame, column: str = K.CAPEX, also: Sequence[str] = (K.CAPEX + "_lead1",)) -> DataFrame:
    """Drop rows in which ``column``, or one of ``also``, equals the column's overall maximum.

    The maximum is a scalar subquery: one partial aggregate, one row.  NULL cells are kept.
    """
    peak = df.agg(F.max(column)).scalar()
    hit = peak.isin([F.col(c) for c in (column, *also)])
    return df.where(~F.coalesce(hit, F.lit(False)))


def missing_fractions(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: the share of NULLs of each column; NaN counts as NULL."""
    floats = (T.DoubleType, T.FloatType)

    def missing(c: str) -> Column:
        gone = F.col(f"`{c}`").isNull()
        return gone | F.isnan(f"`{c}`") if isinstance(df.schema[c].dataType, floats) else gone

    return df.agg(*[F.avg(missing(c).cast("double")).alias(c) for c in columns or df.columns])


def mark_sparse(
    df: DataFrame,
    threshold: float = 0.8,
    columns: Sequence[str] | None = None,
    fill: int | None = 0,
) -> DataFrame:
    """Overwrite every column whose NULL share is above ``threshold``.

    The shares are one aggregate row, read before the result is planned, so that the columns
    which turn into literals are no longer scanned.
    """
    shares = missing_fractions(df, columns).first().asDict()
    sparse = {c for c, share in shares.items() if share is not None and share > threshold}
    out = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if field.name in sparse:
            kept = isinstance(field.dataType, (T.NumericType, T.StringType)) or fill is None
            c = F.lit(fill).cast(field.dataType if kept else T.IntegerType())
        out.append(c.alias(field.name))
    return df.select(out)


def drop_suffixed(df: DataFrame) -> DataFrame:
    """Drop columns named like second copies (``A.1``)."""
    return df.select([F.col(f"`{c}`") for c in df.columns if not re.search(r"\.\d+$", c)])


def repeated_columns(df: DataFrame) -> dict[str, int]:
    """Names that occur more than once, with their counts."""
    return {name: n for name, n in Counter(df.columns).items() if n > 1}


def require_unique_columns(df: DataFrame) -> DataFrame:
    repeated = repeated_columns(df)
    if repeated:
        raise ValueError(f"repeated columns: {repeated}")
    return df


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; a column a frame lacks is NULL there."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def sort_for_output(
    df: DataFrame,
    first: str = K.ANNOUNCE_DT + "_lead1",
    ties: Sequence[str] = (K.SERIES_ID, K.YEAR, K.QUARTER),
) -> DataFrame:
    """Global output order: NULLs last, ties broken by the panel key."""
    return df.orderBy(F.asc_nulls_last(first), *ties)


def row_counts(df: DataFrame, by: str) -> DataFrame:
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("rows"))


def preview(df: DataFrame, n: int = 50) -> DataFrame:
    return df.limit(n)
