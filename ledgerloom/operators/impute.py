"""Gap filling of a company panel by position in the series.

Leading gaps repeat the first value, trailing gaps continue a straight line fitted to the last
unbroken block of values, gaps in between are interpolated.  All steps are window expressions of
one partitioning, so a plan has one exchange and one sort.  See ``panel`` for what bounds a series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .panel import COMPANY, PERIOD, series_rows, series_window

POS = "__pos"


class _Frames:
    def __init__(self, partition_by: Sequence[str], order_by: Sequence[str]):
        self.ordered = series_window(partition_by, order_by)
        self.whole = Window.partitionBy(*partition_by)
        self.before = self.ordered.rowsBetween(Window.unboundedPreceding, 0)
        self.after = self.ordered.rowsBetween(0, Window.unboundedFollowing)


def _numbered(df: DataFrame, partition_by: Sequence[str], f: _Frames) -> DataFrame:
    return series_rows(df, partition_by).withColumn(POS, F.row_number().over(f.ordered))


def _where_valid(c: str, value: Column) -> Column:
    return F.when(F.col(c).isNotNull(), value)


def _start(df: DataFrame, columns: Sequence[str], f: _Frames) -> DataFrame:
    pos = F.col(POS)
    return df.withColumns(
        {c: F.coalesce(F.col(c), _leading(c, pos, f)) for c in columns}
    )


def _leading(c: str, pos: Column, f: _Frames) -> Column:
    first = F.min(_where_valid(c, F.struct(pos, F.col(c).alias("v")))).over(f.whole)
    return F.when(pos < first[POS], first["v"])


def _end(df: DataFrame, columns: Sequence[str], f: _Frames) -> DataFrame:
    pos = F.col(POS)
    last = {f"__last_{c}": F.max(_where_valid(c, F.struct(pos, F.col(c).alias("v")))).over(f.whole) for c in columns}
    # Position of the last gap before the last value: the block to fit starts after it.
    gap = {
        f"__gap_{c}": F.coalesce(
            F.max(F.when(F.col(c).isNull() & (pos < F.col(f"__last_{c}")[POS]), pos)).over(f.whole), F.lit(0)
        )
        for c in columns
    }
    line, filled = {}, {}
    for c in columns:
        x = (pos - F.col(f"__gap_{c}") - 1).cast("double")
        y = F.when(pos > F.col(f"__gap_{c}"), F.col(c))
        line[f"__slope_{c}"] = F.regr_slope(y, x).over(f.whole)
        line[f"__level_{c}"] = F.regr_intercept(y, x).over(f.whole)
        single = F.col(f"__last_{c}")[POS] - F.col(f"__gap_{c}") == 1
        filled[c] = F.when(
            pos > F.col(f"__last_{c}")[POS],
            F.when(single, F.col(f"__last_{c}")["v"].cast("double")).otherwise(
                F.col(f"__level_{c}") + F.col(f"__slope_{c}") * x
            ),
        ).otherwise(F.col(c))
    return df.withColumns(last).withColumns(gap).withColumns(line).withColumns(filled).drop(*last, *gap, *line)


def _between(df: DataFrame, columns: Sequence[str], f: _Frames) -> DataFrame:
    pos = F.col(POS)
    around, filled = {}, {}
    for c in columns:
        known = _where_valid(c, F.struct(pos, F.col(c).alias("v")))
        around[f"__prev_{c}"] = F.last(known, ignorenulls=True).over(f.before)
        around[f"__next_{c}"] = F.first(known, ignorenulls=True).over(f.after)
        a, b = F.col(f"__prev_{c}"), F.col(f"__next_{c}")
        share = (pos - a[POS]) / (b[POS] - a[POS])
        filled[c] = F.when(F.col(c).isNotNull(), F.col(c)).when(
            b.isNotNull(), a["v"] + (b["v"] - a["v"]) * share
        ).otherwise(a["v"])
    return df.withColumns(around).withColumns(filled).drop(*around)


def _apply(df, columns, partition_by, order_by, *steps) -> DataFrame:
    f = _Frames(partition_by, order_by)
    out = _numbered(df, partition_by, f)
    for step in steps:
        out = step(out, columns, f)
    return out.drop(POS)


def fill_start(
    df: DataFrame, columns: Sequence[str], partition_by: Sequence[str] = COMPANY, order_by: Sequence[str] = PERIOD
) -> DataFrame:
    """Leading gaps take the first value of the series."""
    return _apply(df, columns, partition_by, order_by, _start)


def fill_end(
    df: DataFrame, columns: Sequence[str], partition_by: Sequence[str] = COMPANY, order_by: Sequence[str] = PERIOD
) -> DataFrame:
    """Trailing gaps continue the line through the last unbroken block; a block of one repeats."""
    return _apply(df, columns, partition_by, order_by, _end)


def fill_between(
    df: DataFrame, columns: Sequence[str], partition_by: Sequence[str] = COMPANY, order_by: Sequence[str] = PERIOD
) -> DataFrame:
    """Inner gaps are interpolated by position; a trailing gap repeats the last value."""
    return _apply(df, columns, partition_by, order_by, _between)


def fill_gaps(
    df: DataFrame, columns: Sequence[str], partition_by: Sequence[str] = COMPANY, order_by: Sequence[str] = PERIOD
) -> DataFrame:
    """Start, end, between, in that order: back-filled cells count as values for the line fit."""
    return _apply(df, columns, partition_by, order_by, _start, _end, _between)


def fill_gaps_except(
    df: DataFrame, excluded: Sequence[str], partition_by: Sequence[str] = COMPANY, order_by: Sequence[str] = PERIOD
) -> DataFrame:
    """``fill_gaps`` over every column that is neither excluded nor part of the panel key."""
    fixed = {*excluded, *partition_by, *order_by}
    return fill_gaps(df, [c for c in df.columns if c not in fixed], partition_by, order_by)
