"""Joined statements to model input."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from .. import keys as K
from ..operators import clean, industry, panel, resolve
from ..session import materialize, small_side, tune


def quarterly_panel(
    statements: DataFrame,
    info: DataFrame,
    codes: DataFrame,
    industry_columns: Sequence[str] = K.INDUSTRY_COLUMNS,
) -> DataFrame:
    """Quarterly filings with industry labels, settled to one row per company and quarter.

    A company with one set of labels has them on all its filings, so settling cannot change them
    and they join the settled rows, of which there are far fewer.
    """
    rows = clean.quarterly_rows(clean.drop_suffixed(statements))
    codes = small_side(industry.industry_codes(codes))
    labels = small_side(industry.label_companies(info, codes, industry_columns))
    repeated = labels.groupBy(K.SERIES_ID).count().where("count > 1")
    if repeated.isEmpty():
        return industry.attach_labels(resolve.resolve_quarterly(rows), labels)
    return resolve.resolve_quarterly(industry.attach_labels(rows, labels))


def lead_features(
    df: DataFrame,
    targets: Sequence[str] = K.TARGET_COLUMNS,
    peak: str = K.CAPEX,
    first_year: int = 1990,
) -> DataFrame:
    """Next-period targets, blanks to NULL, recent years, without the peak outlier; unsorted."""
    rows = (
        df.transform(panel.lead_lag_targets, targets)
        .transform(clean.blank_to_null)
        .transform(clean.year_from, first_year)
    )
    return clean.drop_peak(rows, peak, (f"{peak}_lead1",))


def model_input(spark: SparkSession, statements: DataFrame, info: DataFrame, codes: DataFrame) -> DataFrame:
    """From joined statements to the sorted feature table.

    The settled panel is written once: the peak value and the result both read it.
    """
    tune(spark)
    settled = materialize(quarterly_panel(statements, info, codes))
    return clean.sort_for_output(lead_features(settled))


def write_model_input(spark: SparkSession, statements, info, codes, path: str) -> None:
    """The sorted feature table as headed CSV."""
    model_input(spark, statements, info, codes).write.mode("overwrite").option("header", True).csv(path)
