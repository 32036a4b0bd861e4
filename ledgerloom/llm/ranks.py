"""Places of rows in a global order, without a window over a whole group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .shared import narrow_side, written


def ranged(df: DataFrame, order: Sequence[str], name: str = "ranged") -> DataFrame:
    """``df`` written in ranges of ``order``, with the number of the range in ``__range``.

    Ranges ascend with their number and equal values of ``order`` share one, so the columns should tell all rows
    apart where one value may hold many rows. ``df`` is read twice and should be a written table.
    """
    return written(df.repartitionByRange(*order).withColumn("__range", F.spark_partition_id()), name)


def placed(df: DataFrame, order: Sequence[str], size: Column | None = None, group: Sequence[str] = ()) -> DataFrame:
    """``df`` with ``__before``, the sum of ``size`` (rows, if left out) over all rows of the group that come earlier in
    ``order``, and ``__total``, the same over the whole group.

    Windows run inside one range only; between ranges there are sums, one row for each range and group in it.
    ``group`` columns must not be null.
    """
    group = list(group)
    size = F.lit(1).cast("long") if size is None else size.cast("long")
    rows = ranged(df.withColumn("__size", size), [*group, *(c for c in order if c not in group)])
    sums = rows.groupBy(*group, "__range").agg(F.sum("__size").alias("__sum"))
    whole = Window.partitionBy(*group)
    earlier = whole.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*group, "__range", F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__start"), F.sum("__sum").over(whole).alias("__total"))
    inside = Window.partitionBy(*group, "__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    here = rows.withColumn("__inside", F.coalesce(F.sum("__size").over(inside), F.lit(0)))
    both = here.join(narrow_side(written(sums, "sums"), 64), [*group, "__range"])
    return both.withColumn("__before", F.col("__start") + F.col("__inside")).select(*df.columns, "__before", "__total")
