"""Exact, linearly interpolated quantiles per group, by radix selection, for groups of any size.

A double becomes a 64-bit integer of the same order.  The first read counts values by group and leading bits of that
integer, which merges before the shuffle; running sums of these counts name the cell in which each wanted rank lies.  The second
read takes out the values of those cells only, each different value once with its count.  Cells that still hold too many
values for one task are counted again by further bits, on what was taken out, until a rank's value is known.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from .bits import with_bits
from .scalar import null_nan
from ..session import broadcast_within, stored

# Different values of a cell that one task may order.
DIRECT_ROWS = 1_000_000
# Bits cut off at each turn; the first leaves the sign, the exponent and ten bits of the fraction.
SHIFTS = (42, 32, 22, 12, 0)


def group_quantiles(
    df: DataFrame,
    group_by: Sequence[str],
    columns: Sequence[str],
    probs: Sequence[float],
    direct_rows: int = DIRECT_ROWS,
    largest: int | None = None,
) -> DataFrame:
    """One row per group; ``<c>`` holds the array of quantiles of column ``c``, NULL where all its values are missing.

    ``df`` is read twice at most.  NaN is a missing value.  ``largest`` may give the rows of the largest group when known:
    groups of at most ``direct_rows`` rows are ordered as they are, in one read.
    """
    group_by, columns = list(group_by), list(columns)
    floats = (T.DoubleType, T.FloatType)
    clean = [null_nan(c) if isinstance(df.schema[c].dataType, floats) else F.col(c) for c in columns]
    if largest is not None and largest <= direct_rows:
        return df.groupBy(*group_by).agg(*[F.percentile(v, list(probs)).alias(c) for c, v in zip(columns, clean)])
    cells = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), c.cast("double").alias("v")) for i, c in enumerate(clean)]))
    # A struct, so that NULL equals NULL in joins.
    rows = df.select(F.struct(*group_by).alias("g"), cells.alias("s")).select("g", "s.i", "s.v")
    spread = [F.min("v").alias("low"), F.max("v").alias("high")]
    coded = with_bits(rows, {"bits": "v"}).withColumn("cell", F.shiftright("bits", SHIFTS[0])).drop("bits")
    counts = stored(coded.groupBy("g", "i", "cell").agg(F.count("v").alias("n"), *spread), "cells")

    whole = Window.partitionBy("g", "i")
    placed = counts.where("cell is not null").withColumns({"total": F.sum("n").over(whole), "before": _before(whole, "cell")})
    at = [F.lit(float(p)) * (F.col("total") - 1) for p in probs]
    ends = [
        F.struct(F.lit(j).alias("j"), end.alias("k"), (a - F.floor(a)).alias("share"), F.lit(upper).alias("upper"))
        for j, a in enumerate(at)
        for upper, end in ((False, F.floor(a)), (True, F.ceil(a)))
    ]
    slots = placed.select("*", F.explode(F.array(*ends)).alias("s")).select("*", "s.*").where(_holds())
    slots = stored(_slots(slots), "slots")

    settled, taken = slots.where("low = high"), None
    for turn, shift in enumerate(SHIFTS[1:]):
        slots = slots.where("low < high")
        # Not above the number of different values, which may be fewer.
        widest = slots.agg(F.max("n")).first()[0]
        if widest is None:
            break
        cells = broadcast_within(slots.select("g", "i", "cell").distinct())
        if taken is None:
            taken = coded.where("v is not null").join(cells, ["g", "i", "cell"]).groupBy("g", "i", "cell", "v").agg(F.count(F.lit(1)).alias("n"))
        else:
            taken = with_bits(taken, {"bits": "v"}).withColumn("cell", F.shiftright("bits", SHIFTS[turn])).drop("bits").join(cells, ["g", "i", "cell"])
        wanted = slots.select("g", "i", "cell", "j", "k", "share", "upper")
        if widest <= direct_rows or not shift:
            # Few enough to order as they are.
            parts = taken.withColumns({"low": F.col("v"), "high": F.col("v"), "fine": F.lit(0).cast("long")})
            order = "v"
        else:
            taken = stored(taken, "taken")
            parts = with_bits(taken, {"bits": "v"}).withColumn("fine", F.shiftright("bits", shift)).groupBy("g", "i", "cell", "fine").agg(F.sum("n").alias("n"), *spread)
            order = "fine"
        parts = parts.withColumn("before", _before(Window.partitionBy("g", "i", "cell"), order))
        slots = parts.join(wanted, ["g", "i", "cell"]).where(_holds()).drop("cell").withColumnRenamed("fine", "cell")
        slots = stored(_slots(slots), "slots")
        settled = settled.unionByName(slots.where("low = high"))
        if order == "v":
            break

    low, high = (F.max(F.when(F.col("upper") == upper, F.col("low"))) for upper in (False, True))
    # Two infinities have no difference.
    between = F.when(low == high, low).otherwise(low + (high - low) * F.max("share"))
    values = settled.groupBy("g", "i", "j").agg(between.alias("q"))
    arrays = values.groupBy("g").agg(
        *[
            F.array(*[F.max(F.when((F.col("i") == i) & (F.col("j") == j), F.col("q"))) for j in range(len(probs))]).alias(f"q{i}")
            for i in range(len(columns))
        ]
    )
    every = counts.select("g").distinct().join(arrays, "g", "left")
    return every.select("g.*", *[F.when(F.col(f"q{i}")[0].isNotNull(), F.col(f"q{i}")).alias(c) for i, c in enumerate(columns)])


def _before(window, order: str) -> Column:
    """Values in earlier cells."""
    return F.coalesce(F.sum("n").over(window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def _holds() -> Column:
    return (F.col("before") <= F.col("k")) & (F.col("k") < F.col("before") + F.col("n"))


def _slots(found: DataFrame) -> DataFrame:
    """Wanted ranks by the cell that holds each, counted from the start of the cell."""
    return found.select("g", "i", "j", "upper", "share", "cell", (F.col("k") - F.col("before")).alias("k"), "n", "low", "high")
