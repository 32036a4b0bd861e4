"""Industry labels of companies and statistics per industry and year."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from .. import keys as K
from ..functions.quantiles import DIRECT_ROWS, group_quantiles
from ..functions.scalar import null_nan
from ..session import broadcast_within, materialize


def industry_codes(rows: DataFrame) -> DataFrame:
    """(level, code, label) without repeats; one code with two labels is an error."""
    low, high = F.min("label"), F.max("label")
    label = F.when(low.eqNullSafe(high), low).otherwise(
        F.raise_error(F.concat(F.lit("more than one label for code "), F.col("code").cast("string")))
    )
    return rows.groupBy("level", "code").agg(label.alias("label"))


def label_companies(
    info: DataFrame,
    codes: DataFrame,
    industry_columns: Sequence[str] = K.INDUSTRY_COLUMNS,
    key: str = K.SERIES_ID,
) -> DataFrame:
    """``<c>_mapped`` label for each coded column, with the company id; unknown codes give NULL.

    The lookups run on the company list, before it meets the statements.
    """
    out = info
    for c in industry_columns:
        level = codes.where(F.col("level") == c).select(
            F.col("code").alias(f"__code_{c}"), F.col("label").alias(f"{c}_mapped")
        )
        out = out.join(level, out[c] == F.col(f"__code_{c}"), "left").drop(f"__code_{c}")
    return out.select(*[f"{c}_mapped" for c in industry_columns], key)


def attach_labels(df: DataFrame, labels: DataFrame, key: str = K.SERIES_ID) -> DataFrame:
    """Left join of the labels, best passed through ``session.small_side`` first."""
    return df.join(labels, key, "left").select(*df.columns, *[c for c in labels.columns if c != key])


def industry_stats(
    df: DataFrame,
    columns: Sequence[str],
    industry: str,
    year: int | None = None,
    year_column: str = K.YEAR,
    direct_rows: int = DIRECT_ROWS,
) -> DataFrame:
    """Every row with the mean, median, min, max, std, q1 and q3 of its industry and year.

    ``year`` restricts the input to one year; otherwise each year is treated on its own.  Columns
    that do not exist are skipped.  Rows without an industry are kept, with NULL statistics.  The
    statistics have one row per industry and year: they are written once, counted, and joined
    without moving the rows when they are within the broadcast bound.
    """
    columns = [c for c in columns if c in df.columns]
    rows = df if year is None else df.where(F.col(year_column) == year)
    if not columns:
        return rows
    group = [year_column, industry]
    floats = (T.DoubleType, T.FloatType)
    measures = [null_nan(c).alias(c) if isinstance(df.schema[c].dataType, floats) else F.col(c) for c in columns]
    known = rows.where(F.col(industry).isNotNull() & F.col(year_column).isNotNull()).select(*group, *measures)
    moments = materialize(
        known.groupBy(*group).agg(
            F.count(F.lit(1)).alias("rows"),
            *[
                f(c).alias(f"__{name}{i}")
                for i, c in enumerate(columns)
                for name, f in (("mean", F.avg), ("min", F.min), ("max", F.max), ("std", F.stddev_samp))
            ],
        )
    )
    largest = moments.agg(F.max("rows")).first()[0] or 0
    quartiles = group_quantiles(known, group, columns, (0.25, 0.5, 0.75), direct_rows, largest)
    stats = moments.join(quartiles, group).select(
        *group,
        *[
            expr.alias(f"{c}({industry}_{name})")
            for i, c in enumerate(columns)
            for name, expr in (
                ("mean", F.col(f"__mean{i}")),
                ("median", F.col(c)[1]),
                ("min", F.col(f"__min{i}")),
                ("max", F.col(f"__max{i}")),
                ("std", F.col(f"__std{i}")),
                ("q1", F.col(c)[0]),
                ("q3", F.col(c)[2]),
            )
        ],
    )
    stats = broadcast_within(materialize(stats))
    return rows.join(stats, group, "left").select(*rows.columns, *stats.columns[len(group) :])
