"""Time-series features of a company panel.

A panel has one row per (company, Year, Quarter), which is what ``resolve`` produces.  ``Year`` is
a four-digit and ``Quarter`` a one-digit number, so the key itself bounds how long one company's
series can be, however many filings the company has.  All windows here partition by company and
share one specification: one exchange and one sort serve any number of features.  For series
without such a bound (events, ticks) use ``long_series``, which splits them into blocks.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from .. import keys as K

COMPANY = (K.SERIES_ID,)
PERIOD = (K.YEAR, K.QUARTER)


def series_rows(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows that belong to a series; an empty key list would put everything in one task."""
    if not partition_by:
        raise ValueError("partition_by must name at least one column")
    return df.where(reduce(and_, [F.col(c).isNotNull() for c in partition_by]))


def series_window(partition_by: Sequence[str], order_by: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*partition_by).orderBy(*order_by)


def lead_lag_targets(
    df: DataFrame,
    targets: Sequence[str] = K.TARGET_COLUMNS,
    carry: Sequence[str] = (K.ANNOUNCE_DT, K.PERIOD_END, K.YEAR, K.QUARTER),
    partition_by: Sequence[str] = COMPANY,
    order_by: Sequence[str] = PERIOD,
) -> DataFrame:
    """``<y>_lead1`` and ``<y>_last_year_same_quarter`` per target, ``<c>_lead1`` per carried column.

    Offsets count rows.  A company's last row has no target and is dropped.
    """
    w = series_window(partition_by, order_by)
    made: dict[str, Column] = {}
    for y in targets:
        made[f"{y}_lead1"] = F.lead(y, 1).over(w)
        made[f"{y}_last_year_same_quarter"] = F.lag(y, 4).over(w)
    for c in carry:
        made[f"{c}_lead1"] = F.lead(c, 1).over(w)
    made["__more"] = F.lead(F.lit(True), 1).over(w)
    return series_rows(df, partition_by).withColumns(made).where(F.col("__more")).drop("__more")


def rolling_avg(
    df: DataFrame,
    columns: Sequence[str],
    window_size: int = 3,
    partition_by: Sequence[str] = COMPANY,
    order_by: Sequence[str] = PERIOD,
) -> DataFrame:
    """``<c>(rolling_avg_n)``: mean of the present values among the last n rows."""
    w = series_window(partition_by, order_by).rowsBetween(1 - window_size, 0)
    return series_rows(df, partition_by).withColumns(
        {f"{c}(rolling_avg_{window_size})": F.avg(c).over(w) for c in columns}
    )


def first_diff(
    df: DataFrame,
    columns: Sequence[str],
    partition_by: Sequence[str] = COMPANY,
    order_by: Sequence[str] = PERIOD,
) -> DataFrame:
    """``<c>(q2q_diff)``: change against the previous row."""
    w = series_window(partition_by, order_by)
    return series_rows(df, partition_by).withColumns({f"{c}(q2q_diff)": F.col(c) - F.lag(c, 1).over(w) for c in columns})


def growth(
    df: DataFrame,
    columns: Sequence[str],
    partition_by: Sequence[str] = COMPANY,
    order_by: Sequence[str] = PERIOD,
) -> DataFrame:
    """``<c>(q2q_pct_change)`` in percent and ``<c>(q2q_cumulative_growth)``.

    A gap is padded with the last value first, so the change inside it is 0.  A change from 0 is
    NULL and the running product skips it.
    """
    w = series_window(partition_by, order_by)
    filled = {f"__filled_{c}": F.last(c, ignorenulls=True).over(w) for c in columns}
    change = {
        f"{c}(q2q_pct_change)": (
            F.try_divide(F.col(f"__filled_{c}"), F.lag(f"__filled_{c}", 1).over(w)) - 1
        )
        * 100
        for c in columns
    }
    product = {
        f"{c}(q2q_cumulative_growth)": F.when(
            F.col(f"{c}(q2q_pct_change)").isNotNull(),
            F.product(1 + F.col(f"{c}(q2q_pct_change)") / 100).over(w),
        )
        for c in columns
    }
    return (
        series_rows(df, partition_by)
        .withColumns(filled)
        .withColumns(change)
        .withColumns(product)
        .drop(*filled)
    )


# Values of a series that are folded into one piece.
FOLD = 128


def ema_step(alpha: float):
    """One step of the recursion: state (y, w), next value x -> next state.

    A NULL keeps y and lets the old weight decay; a value resets the weight to 1.
    """
    keep = 1.0 - alpha

    def step(y: Column, w: Column, x: Column) -> tuple[Column, Column]:
        blended = (w * keep * y + alpha * x) / (w * keep + alpha)
        value = F.when(x.isNull(), y).when(y.isNull(), x).otherwise(blended)
        weight = F.when(x.isNull(), w * keep).otherwise(F.lit(1.0))
        return value, weight

    return step


def ema(
    df: DataFrame,
    columns: Sequence[str],
    span: int = 3,
    partition_by: Sequence[str] = COMPANY,
    order_by: Sequence[str] = PERIOD,
) -> DataFrame:
    """``<c>(ema_n)``: exponential mean with alpha = 2 / (n + 1), recursive form.

    One fold over the ordered values of a company.  The gathered array is one panel series,
    which the panel key bounds (see the module text).  Appending copies what is there, so the fold appends to pieces
    of ``FOLD`` values, and pieces to the list of pieces.
    """
    step = ema_step(2.0 / (span + 1))
    rest = [c for c in df.columns if c not in partition_by and c not in order_by]
    grouped = (
        series_rows(df, partition_by)
        .groupBy(*partition_by)
        .agg(F.array_sort(F.collect_list(F.struct(*order_by, *rest))).alias("__rows"))
    )

    def state(ys: Column, y: Column, w: Column) -> Column:
        return F.struct(ys.alias("ys"), y.alias("y"), w.alias("w"))

    def fold(c: str) -> Column:
        def one(now: Column, row: Column) -> Column:
            y, w = step(now["y"], now["w"], row[c].cast("double"))
            return state(F.concat(now["ys"], F.array(y)), y, w)

        def piece(now: Column, at: Column) -> Column:
            inner = F.aggregate(
                F.slice("__rows", at, FOLD), state(F.array().cast("array<double>"), now["y"], now["w"]), one
            )
            # Bound to a name, so that the piece is folded once.
            return F.get(
                F.transform(F.array(inner), lambda p: state(F.concat(now["ys"], F.array(p["ys"])), p["y"], p["w"])), F.lit(0)
            )

        start = state(F.array().cast("array<array<double>>"), F.lit(None).cast("double"), F.lit(1.0))
        places = F.sequence(F.lit(1), F.size("__rows"), F.lit(FOLD))
        return F.aggregate(places, start, piece, lambda s: F.flatten(s["ys"]))

    folded = grouped.select(
        *partition_by,
        F.explode(F.arrays_zip("__rows", *[fold(c).alias(f"__ema{i}") for i, c in enumerate(columns)])).alias("__z"),
    )
    return folded.select(
        [F.col(c) if c in partition_by else F.col("__z")["__rows"][c].alias(c) for c in df.columns]
        + [F.col("__z")[f"__ema{i}"].alias(f"{c}(ema_{span})") for i, c in enumerate(columns)]
    )
