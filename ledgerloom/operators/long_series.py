"""The panel features for series without a bound on their length.

One series may hold a large share of all rows, so it must not be one window partition.  The caller
names a block: any expression that never decreases along the series, such as the day of a time
stamp.  Rows are exchanged by (series, block) only.  Each block is summarised in one row, a window
over those few rows gives what a block needs to know about the ones before and after it, and a
join on (series, block) brings that back to the rows, which are already partitioned that way.
Results equal those of ``panel`` and ``impute`` for every choice of block.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from .ordered import floats, in_order, pieces
from .panel import series_rows
from ..session import stored

BLOCK = "__block"
ROW = "__row"


@dataclass(frozen=True)
class Series:
    """Which columns identify a series, order it, and split it into blocks."""

    partition_by: tuple[str, ...]
    order_by: tuple[str, ...]
    block_by: Column

    @property
    def unit(self) -> list[str]:
        return [*self.partition_by, BLOCK]

    def inside(self):
        return Window.partitionBy(*self.unit).orderBy(*self.order_by)

    def across(self):
        return Window.partitionBy(*self.partition_by).orderBy(BLOCK)

    def earlier(self):
        return self.across().rowsBetween(Window.unboundedPreceding, -1)

    def later(self):
        return self.across().rowsBetween(1, Window.unboundedFollowing)

    def blocks(self, df: DataFrame) -> DataFrame:
        rows = series_rows(df, self.partition_by).withColumn(BLOCK, self.block_by)
        return rows.withColumn(ROW, F.row_number().over(self.inside()))

    def attach(self, rows: DataFrame, summary: DataFrame) -> DataFrame:
        # Rows without an order value are a block of their own.
        near = summary.select(*[F.col(c).alias(f"__of_{c}") if c in self.unit else F.col(c) for c in summary.columns])
        same = [rows[c] == near[f"__of_{c}"] for c in self.partition_by] + [rows[BLOCK].eqNullSafe(near[f"__of_{BLOCK}"])]
        return rows.join(near, same, "left").drop(*[f"__of_{c}" for c in self.unit])


# Block lengths to try, longest first: year, month, day, hour, minute, second.
_BLOCK_SECONDS = (31_536_000, 2_592_000, 86_400, 3_600, 60, 1)


def time_block(df: DataFrame, partition_by: Sequence[str], column: str, rows: int = 1_000_000) -> Column:
    """The longest span of ``column`` in which no series has more than ``rows`` rows.

    One aggregate per span tried; it counts rows per series and span before anything is shuffled.
    """
    kind, c = df.schema[column].dataType, F.col(column)
    if isinstance(kind, T.DateType):
        seconds = F.unix_date(c).cast("long") * 86_400
    elif isinstance(kind, T.TimestampNTZType):
        clock = F.hour(c) * 3_600 + F.minute(c) * 60 + F.second(c)
        seconds = F.unix_date(c.cast("date")).cast("long") * 86_400 + clock
    else:
        seconds = F.unix_seconds(c)
    for span in _BLOCK_SECONDS:
        block = F.floor(seconds / span)
        largest = (
            series_rows(df, partition_by)
            .groupBy(*partition_by, block.alias(BLOCK))
            .count()
            .agg(F.max("count").alias("largest"))
            .first()
            .largest
        )
        if largest is None or largest <= rows:
            return block
    raise ValueError(f"a series has {largest} rows within one second of {column}: name a finer block")


DEPTH = "__depth"


def even_blocks(
    df: DataFrame, partition_by: Sequence[str], order_by: Sequence[str], rows: int = 1_000_000
) -> tuple[DataFrame, Series]:
    """``df`` with a block number in ``__depth``, written once, and the series cut by it.

    Splitters are sampled over (series, order columns), so a block has about half of ``rows`` rows whatever the times are: a
    burst within one instant is cut by the next order column, and sparse series share a range.  Only rows equal in all of these
    columns stay together, and these have no order.  Rows without a series are left out, as everywhere here.
    """
    kept = series_rows(df, partition_by)
    ranges = max(-(-2 * kept.count() // rows), 1)
    cut = kept.repartitionByRange(ranges, *partition_by, *order_by).withColumn(DEPTH, F.spark_partition_id())
    return stored(cut, "blocks"), Series(tuple(partition_by), tuple(order_by), F.col(DEPTH))


def _tails(rows: DataFrame, s: Series, columns: Sequence[str], size: int) -> DataFrame:
    """Per block, ``__tail``: the last ``size`` rows of the series before the block, oldest first."""
    back = F.row_number().over(Window.partitionBy(*s.unit).orderBy(F.desc(ROW)))
    ends = (
        rows.select(*s.unit, ROW, *columns)
        .withColumn("__back", back)
        .where(F.col("__back") <= size)
        .groupBy(*s.unit)
        .agg(F.array_sort(F.collect_list(F.struct(ROW, *columns))).alias("__end"))
    )
    # Every block has at least one row, so ``size`` blocks back are enough.
    near = s.across().rowsBetween(-size, -1)
    gathered = F.flatten(F.collect_list("__end").over(near))
    newest = F.when(F.size(gathered) > size, F.slice(gathered, F.size(gathered) - size + 1, size)).otherwise(gathered)
    return ends.select(*s.unit, newest.alias("__tail"))


def _before(c: str, k: int, s: Series) -> Column:
    """Value ``k`` rows back, across the block start."""
    at = F.size("__tail") - k + F.col(ROW)
    outside = F.when(at >= 1, F.element_at("__tail", F.when(at >= 1, at).otherwise(1))[c])
    return F.when(F.col(ROW) > k, F.lag(c, k).over(s.inside())).otherwise(outside)


def lags(df: DataFrame, offsets: dict[str, tuple[str, int]], s: Series) -> DataFrame:
    """``{new column: (column, rows back)}``."""
    columns = sorted({c for c, _ in offsets.values()})
    rows = s.blocks(df)
    joined = s.attach(rows, _tails(rows, s, columns, max(k for _, k in offsets.values())))
    return joined.withColumns({n: _before(c, k, s) for n, (c, k) in offsets.items()}).drop(BLOCK, ROW, "__tail")


def leads(df: DataFrame, columns: dict[str, str], s: Series) -> DataFrame:
    """``{new column: column}``: the value of the next row."""
    rows = s.blocks(df)
    sources = sorted(set(columns.values()))
    first = rows.groupBy(*s.unit).agg(F.min(F.struct(ROW, *sources)).alias("__first"))
    following = first.select(*s.unit, F.lead("__first").over(s.across()).alias("__next"))
    last_row = F.lead(F.lit(True)).over(s.inside()).isNull()
    return (
        s.attach(rows, following)
        .withColumns({n: F.when(last_row, F.col("__next")[c]).otherwise(F.lead(c).over(s.inside())) for n, c in columns.items()})
        .drop(BLOCK, ROW, "__next")
    )


def first_diff(df: DataFrame, columns: Sequence[str], s: Series) -> DataFrame:
    """See ``panel.first_diff``."""
    previous = {f"__prev_{c}": (c, 1) for c in columns}
    return (
        lags(df, previous, s)
        .withColumns({f"{c}(q2q_diff)": F.col(c) - F.col(f"__prev_{c}") for c in columns})
        .drop(*previous)
    )


def rolling_avg(df: DataFrame, columns: Sequence[str], s: Series, window_size: int = 3) -> DataFrame:
    """See ``panel.rolling_avg``."""
    if window_size == 1:
        return series_rows(df, s.partition_by).withColumns(
            {f"{c}(rolling_avg_1)": F.col(c).cast("double") for c in columns}
        )
    rows = s.blocks(df)
    joined = s.attach(rows, _tails(rows, s, columns, window_size - 1))
    frame = s.inside().rowsBetween(1 - window_size, 0)
    # The part of the frame that lies before the block.
    missing = F.greatest(F.lit(window_size) - F.col(ROW), F.lit(0))
    missing = F.least(missing, F.size("__tail"))
    outside = F.when(missing > 0, F.slice("__tail", F.size("__tail") - missing + 1, missing)).otherwise(
        F.slice("__tail", 1, 0)
    )

    def mean(c: str) -> Column:
        known = F.filter(F.transform(outside, lambda r: r[c].cast("double")), lambda v: v.isNotNull())
        total = F.aggregate(known, F.coalesce(F.sum(c).over(frame), F.lit(0)).cast("double"), lambda a, v: a + v)
        count = F.size(known) + F.count(c).over(frame)
        return F.try_divide(total, count)

    return joined.withColumns({f"{c}(rolling_avg_{window_size})": mean(c) for c in columns}).drop(BLOCK, ROW, "__tail")


def growth(df: DataFrame, columns: Sequence[str], s: Series) -> DataFrame:
    """See ``panel.growth``."""
    rows = s.blocks(df)
    ends = rows.groupBy(*s.unit).agg(
        *[F.max(F.when(F.col(c).isNotNull(), F.struct(ROW, F.col(c).alias("v")))).alias(f"__end_{c}") for c in columns]
    )
    carried = ends.select(
        *s.unit, *[F.last(f"__end_{c}", ignorenulls=True).over(s.earlier())["v"].alias(f"__in_{c}") for c in columns]
    )
    padded = s.attach(rows, carried).withColumns(
        {f"__pad_{c}": F.coalesce(F.last(c, ignorenulls=True).over(s.inside()), F.col(f"__in_{c}")) for c in columns}
    )
    previous = {
        c: F.when(F.col(ROW) == 1, F.col(f"__in_{c}")).otherwise(F.lag(f"__pad_{c}").over(s.inside())) for c in columns
    }
    changed = padded.withColumns(
        {f"{c}(q2q_pct_change)": (F.try_divide(F.col(f"__pad_{c}"), previous[c]) - 1) * 100 for c in columns}
    ).drop(*[f"__pad_{c}" for c in columns], *[f"__in_{c}" for c in columns])
    factor = {c: 1 + F.col(f"{c}(q2q_pct_change)") / 100 for c in columns}
    products = changed.groupBy(*s.unit).agg(*[F.product(factor[c]).alias(f"__p_{c}") for c in columns])
    entering = products.select(
        *s.unit, *[F.coalesce(F.product(f"__p_{c}").over(s.earlier()), F.lit(1.0)).alias(f"__in_{c}") for c in columns]
    )
    return (
        s.attach(changed, entering)
        .withColumns(
            {
                f"{c}(q2q_cumulative_growth)": F.when(
                    F.col(f"{c}(q2q_pct_change)").isNotNull(), F.col(f"__in_{c}") * F.product(factor[c]).over(s.inside())
                )
                for c in columns
            }
        )
        .drop(BLOCK, ROW, *[f"__in_{c}" for c in columns])
    )


class _Mean:
    """Recursive mean at one place of a series: value, and rows since the last input value."""

    def __init__(self, alpha: float, y: float = np.nan, gap: float = 0.0):
        self.alpha, self.y, self.gap = alpha, y, gap

    def run(self, x: np.ndarray) -> np.ndarray:
        keep, alpha, y = 1.0 - self.alpha, self.alpha, self.y
        weight = keep**self.gap
        out = []
        for v in x.tolist():
            weight *= keep
            self.gap += 1
            if v == v:
                y = v if y != y else (weight * y + alpha * v) / (weight + alpha)
                weight, self.gap = 1.0, 0.0
            out.append(y)
        self.y = y
        return np.array(out)


class _Block:
    """What a block does to the mean that enters it, gathered piece by piece.

    After its first value the block is a linear map of the mean: slope and end value are enough.
    """

    def __init__(self, alpha: float):
        self.first, self.lead, self.slope = np.nan, 0.0, 1.0
        self.inside = _Mean(alpha)

    def add(self, x: np.ndarray) -> None:
        at = np.flatnonzero(~np.isnan(x))
        if self.first != self.first:
            if len(at) == 0:
                self.lead += len(x)
                return
            self.lead += float(at[0])
            self.first = float(x[at[0]])
            self.inside.run(x[at[0] : at[0] + 1])
            x, at = x[at[0] + 1 :], at[1:] - at[0] - 1
        gaps = np.diff(at, prepend=-1 - self.inside.gap)
        decay = (1.0 - self.inside.alpha) ** gaps
        self.slope *= float(np.prod(decay / (decay + self.inside.alpha)))
        self.inside.run(x)

    def summary(self) -> tuple[float, float, float, float, float]:
        shift = self.inside.y - self.slope * self.first
        return self.first, self.lead, self.slope, shift, self.inside.gap


def ema(df: DataFrame, columns: Sequence[str], s: Series, span: int = 3) -> DataFrame:
    """See ``panel.ema``.

    The recursion is linear in the mean it starts from, so a block is summarised by five numbers,
    and the mean that enters each block follows from the summaries alone.  Both passes stream the
    rows of a block in order and keep only those numbers.
    """
    alpha = 2.0 / (span + 1)
    columns, unit, series, order = list(columns), s.unit, list(s.partition_by), list(s.order_by)
    rows = series_rows(df, s.partition_by).withColumn(BLOCK, s.block_by)
    thin = rows.select(
        *unit, *[c for c in order if c not in unit], *[F.col(c).cast("double").alias(c) for c in columns]
    )
    unit_fields = [rows.schema[c] for c in unit]
    parts = ("first", "lead", "slope", "shift", "gap")

    def numbers(names: Sequence[str]) -> T.StructType:
        return T.StructType(
            unit_fields + [T.StructField(f"__{p}_{i}", T.DoubleType()) for i in range(len(columns)) for p in names]
        )

    def summarise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [f.name for f in numbers(parts).fields]
        current, blocks = None, []

        def row():
            return [*current, *[v for b in blocks for v in b.summary()]]

        for batch in batches:
            done, data = [], [floats(batch, c) for c in columns]
            for name, start, stop in pieces(batch, unit):
                if name != current:
                    if current is not None:
                        done.append(row())
                    current, blocks = name, [_Block(alpha) for _ in columns]
                for block, x in zip(blocks, data):
                    block.add(x[start:stop])
            if done:
                yield pd.DataFrame(done, columns=names)
        if current is not None:
            yield pd.DataFrame([row()], columns=names)

    def enter(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, means = None, []
        for batch in batches:
            out = batch[unit].copy()
            table = [batch[[f"__{p}_{i}" for p in parts]].to_numpy() for i in range(len(columns))]
            entry = np.empty((len(batch), 2 * len(columns)))
            for name, start, stop in pieces(batch, series):
                if name != current:
                    current, means = name, [_Mean(alpha) for _ in columns]
                for i, m in enumerate(means):
                    for r in range(start, stop):
                        first, lead, slope, shift, tail = table[i][r].tolist()
                        entry[r, 2 * i : 2 * i + 2] = m.y, m.gap
                        m.gap += lead
                        if first == first:
                            m.run(np.array([first]))
                            m.y, m.gap = slope * m.y + shift, tail
            for i in range(len(columns)):
                out[f"__y_{i}"], out[f"__gap_{i}"] = entry[:, 2 * i], entry[:, 2 * i + 1]
            yield out

    result = T.StructType(
        list(df.schema.fields) + [T.StructField(f"{c}(ema_{span})", T.DoubleType()) for c in columns]
    )

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [f.name for f in result.fields]
        current, means = None, []
        for batch in batches:
            data = [floats(batch, c) for c in columns]
            entries = [(floats(batch, f"__y_{i}"), floats(batch, f"__gap_{i}")) for i in range(len(columns))]
            for name, start, stop in pieces(batch, unit):
                if name != current:
                    current = name
                    means = [_Mean(alpha, float(y[start]), float(g[start])) for y, g in entries]
                for m, x in zip(means, data):
                    x[start:stop] = m.run(x[start:stop])
            yield batch.assign(**{f"{c}(ema_{span})": x for c, x in zip(columns, data)})[names]

    summaries = in_order(thin, unit, order).mapInPandas(summarise, numbers(parts))
    entries = in_order(summaries, s.partition_by, [BLOCK]).mapInPandas(enter, numbers(("y", "gap")))
    # Ordered after the join: an adaptive join may split a partition.
    return in_order(s.attach(rows, entries), unit, order).mapInPandas(finish, result)


def fill_gaps(df: DataFrame, columns: Sequence[str], s: Series) -> DataFrame:
    """See ``impute.fill_gaps``."""
    columns = list(columns)
    rows = s.blocks(df)
    ahead = s.inside().rowsBetween(0, Window.unboundedFollowing)
    marked = rows.withColumns({f"__more_{c}": F.first(c, ignorenulls=True).over(ahead).isNotNull() for c in columns})
    facts = [F.count(F.lit(1)).alias("__size")]
    for c in columns:
        known = F.col(c).isNotNull()
        at = F.struct(F.col(ROW).alias("at"), F.col(c).cast("double").alias("v"))
        facts += [
            F.min(F.when(known, at)).alias(f"__first_{c}"),
            F.max(F.when(known, at)).alias(f"__last_{c}"),
            F.max(F.when(~known, F.col(ROW))).alias(f"__hole_{c}"),
            F.max(F.when(~known & F.col(f"__more_{c}"), F.col(ROW))).alias(f"__inner_{c}"),
        ]
    blocks = marked.groupBy(*s.unit).agg(*facts)
    offset = F.coalesce(F.sum("__size").over(s.earlier()), F.lit(0))
    blocks = blocks.withColumn("__offset", offset)

    def shifted(c: str) -> Column:
        return F.when(
            F.col(c).isNotNull(), F.struct((F.col(c)["at"] + F.col("__offset")).alias("at"), F.col(c)["v"].alias("v"))
        )

    blocks = blocks.withColumns({f"__{e}_{c}": shifted(f"__{e}_{c}") for c in columns for e in ("first", "last")})
    whole = Window.partitionBy(*s.partition_by)
    near = {}
    for c in columns:
        near[f"__prev_{c}"] = F.last(f"__last_{c}", ignorenulls=True).over(s.earlier())
        near[f"__next_{c}"] = F.first(f"__first_{c}", ignorenulls=True).over(s.later())
        near[f"__fv_{c}"] = F.min(f"__first_{c}").over(whole)
        near[f"__lv_{c}"] = F.max(f"__last_{c}").over(whole)
    blocks = blocks.withColumns(near)
    gaps = {}
    for c in columns:
        # Last hole before the last value: any hole of an earlier block, an inner one of its own.
        own = F.col(f"__offset") + F.col("__size") >= F.col(f"__lv_{c}")["at"]
        hole = F.when(own, F.col(f"__inner_{c}")).otherwise(F.col(f"__hole_{c}")) + F.col("__offset")
        hole = F.when((hole < F.col(f"__lv_{c}")["at"]) & (hole > F.col(f"__fv_{c}")["at"]), hole)
        gaps[f"__gap_{c}"] = F.coalesce(F.max(hole).over(whole), F.lit(0))
    blocks = blocks.withColumns(gaps).select(
        *s.unit, "__offset", *[f"__{e}_{c}" for c in columns for e in ("prev", "next", "fv", "lv", "gap")]
    )
    placed = s.attach(rows, blocks).withColumn("__pos", F.col(ROW) + F.col("__offset"))
    started = {
        f"__x_{c}": F.when(F.col("__pos") < F.col(f"__fv_{c}")["at"], F.col(f"__fv_{c}")["v"]).otherwise(
            F.col(c).cast("double")
        )
        for c in columns
    }
    placed = placed.withColumns(started)
    lines = placed.groupBy(*s.partition_by).agg(
        *[
            expr
            for c in columns
            for expr in _line(c)
        ]
    )
    # Per series, not per row: the parameters reach the rows through the block summaries.
    fitted = blocks.select(*s.unit).join(lines, list(s.partition_by), "left")
    final = s.attach(placed, fitted)
    return final.withColumns({c: _filled(c, s) for c in columns}).select(*df.columns)


def _line(c: str) -> list[Column]:
    x = (F.col("__pos") - F.col(f"__gap_{c}") - 1).cast("double")
    inside = (F.col("__pos") > F.col(f"__gap_{c}")) & (F.col("__pos") <= F.col(f"__lv_{c}")["at"])
    y = F.when(inside, F.col(f"__x_{c}"))
    return [F.regr_slope(y, x).alias(f"__slope_{c}"), F.regr_intercept(y, x).alias(f"__level_{c}")]


def _filled(c: str, s: Series) -> Column:
    pos = F.col("__pos")
    known = F.when(F.col(f"__x_{c}").isNotNull(), F.struct(pos.alias("at"), F.col(f"__x_{c}").alias("v")))
    # Cells of the leading gap are known, so what lies before a block is a value or such a cell.
    before = F.coalesce(F.last(known, ignorenulls=True).over(s.inside()), F.col(f"__prev_{c}"))
    after = F.coalesce(
        F.first(known, ignorenulls=True).over(s.inside().rowsBetween(0, Window.unboundedFollowing)), F.col(f"__next_{c}")
    )
    last = F.col(f"__lv_{c}")
    single = last["at"] - F.col(f"__gap_{c}") == 1
    line = F.col(f"__level_{c}") + F.col(f"__slope_{c}") * (pos - F.col(f"__gap_{c}") - 1)
    share = (pos - before["at"]) / (after["at"] - before["at"])
    return (
        F.when(F.col(f"__x_{c}").isNotNull(), F.col(f"__x_{c}"))
        .when(pos > last["at"], F.when(single, last["v"]).otherwise(line))
        .otherwise(before["v"] + (after["v"] - before["v"]) * share)
    )
