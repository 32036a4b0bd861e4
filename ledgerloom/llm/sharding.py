"""Shards of near equal bytes by sampled splitters.

Every row has a key that no other row has: the caller's columns and, behind them, a row number that is written with the
table. A sample whose rows are drawn in proportion to their bytes gives quantiles of the key; the rows between
two of these splitters form a range. Ranges are measured, and those that came out too large are subdivided by
splitters from a denser sample of their own. With the exact sizes of all ranges known, a running sum inside each range gives
the place of a row among all bytes, and the shard that holds the middle of the row takes it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .shared import narrow_side, written

#: Bytes of text that a range should have; a range is what one task sorts.
RANGE_BYTES = 256 << 20
#: Samples for each range.
OVERSAMPLE = 16
#: A range of more than this many times its share is subdivided.
OVERFULL = 2.0
#: Ranges at least for each shard.
FINE = 4
#: Steps of the binary search: enough for 2 ** SEARCH splitters.
SEARCH = 24


def _range_of(key: Column, splitters: Column) -> Column:
    """How many splitters are at or below ``key``: binary search in a sorted array, null for no splitters."""
    state = F.struct(F.lit(0).alias("lo"), F.coalesce(F.size(splitters), F.lit(0)).alias("hi"))

    def step(s: Column, _: Column) -> Column:
        mid = ((s["lo"] + s["hi"]) / 2).cast("int")
        below = F.get(splitters, mid) <= key
        return F.when(s["lo"] >= s["hi"], s).when(below, F.struct((mid + 1).alias("lo"), s["hi"].alias("hi"))).otherwise(F.struct(s["lo"].alias("lo"), mid.alias("hi")))

    return F.aggregate(F.sequence(F.lit(1), F.lit(SEARCH)), state, step, lambda s: s["lo"])


def _drawn(rows: DataFrame, rate: Column) -> DataFrame:
    """Rows drawn with probability bytes times ``rate``, by a hash of the row number: the same rows in every run."""
    u = (F.pmod(F.xxhash64("__row", F.lit(7)), F.lit(1 << 30)) + 0.5) / float(1 << 30)
    return rows.where(u < F.col("__size") * rate)


def _splitters(sample: DataFrame, by: Sequence[str], pieces: Column) -> DataFrame:
    """(by, splitters): sorted keys at the sample's quantiles. A drawn row stands for one share, or for its own larger size."""
    keys = sample.groupBy(*by).agg(F.sort_array(F.collect_list("__key")).alias("keys"), F.max(pieces).cast("int").alias("pieces"))
    n = F.size("keys")
    at = F.transform(F.sequence(F.lit(1), F.greatest(F.col("pieces") - 1, F.lit(1))), lambda i: F.get(F.col("keys"), F.least(n - 1, F.floor(i * n / F.col("pieces")).cast("int"))))
    return keys.select(*by, F.array_distinct(at).alias("splitters"))


def shards(docs: DataFrame, count: int, keys: Sequence[str], size: Column, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``docs`` with size, shard (0 to ``count`` - 1) and slot (gapless from 0 in each shard).

    Shards are consecutive in ``keys`` order, nulls first; rows with equal keys may be parted. Sizes differ by the size of one row at
    the cut at most. Equal rows each get a slot. A table with fewer rows than shards leaves shards empty, and an
    empty one gives no rows. ``size`` must be positive. Other columns travel along, whatever their names; one named size, shard or slot
    gives way to the new one.
    """
    kept = [F.col("__docs")[c].alias(c) for c in docs.columns if c not in ("size", "shard", "slot")]
    narrow = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("__docs"), size.alias("__size"), F.struct(*keys).alias("__by"), F.monotonically_increasing_id().alias("__row"))
    # The row number is fixed by writing it: a task that runs again reads the same one.
    rows = written(narrow.select("__docs", "__size", "__row", F.struct("__by", "__row").alias("__key")), "rows")
    total, most = rows.agg(F.sum("__size"), F.count("*")).first()
    if not total:
        return rows.select(*kept, F.col("__size").alias("size"), F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    wanted = max(count * FINE, -(-int(total) // range_bytes))
    share = total / wanted
    first = _splitters(_drawn(rows, F.lit(OVERSAMPLE / share)).withColumn("__all", F.lit(0)), ["__all"], F.lit(wanted))
    # One value, ``wanted`` keys long, that every task gets.
    ranged = rows.withColumn("__splitters", first.select("splitters").scalar())
    ranged = written(ranged.withColumn("range", _range_of(F.col("__key"), F.col("__splitters"))).drop("__splitters"), "ranged")
    measured = written(ranged.groupBy("range").agg(F.sum("__size").alias("bytes")), "measured")
    overfull = measured.where(F.col("bytes") > OVERFULL * share).withColumn("pieces", F.ceil(F.col("bytes") / share))
    inner = ranged.join(narrow_side(overfull, 32), "range")
    # Written tables are broadcast by their size or, beyond the bound, shuffled: a range is not more than a task holds.
    second = written(_splitters(_drawn(inner, F.lit(4 * OVERSAMPLE / share)), ["range"], F.col("pieces")), "splitters")
    cut = ranged.join(second, "range", "left").withColumn("part", F.when(F.col("splitters").isNull(), 0).otherwise(_range_of(F.col("__key"), F.col("splitters")))).drop("splitters")
    sizes = cut.groupBy("range", "part").agg(F.sum("__size").alias("bytes"), F.count("*").alias("n"))
    order = Window.orderBy("range", "part").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each range: the only step in one task, about a millionth of the rows.
    offsets = written(sizes.select("range", "part", F.coalesce(F.sum("bytes").over(order), F.lit(0)).alias("before"), F.coalesce(F.sum("n").over(order), F.lit(0)).alias("above")), "offsets")
    inside = Window.partitionBy("range", "part").orderBy("__key").rowsBetween(Window.unboundedPreceding, -1)
    placed = cut.join(narrow_side(offsets, 48), ["range", "part"])
    start, index = F.col("before") + F.coalesce(F.sum("__size").over(inside), F.lit(0)), F.col("above") + F.count("*").over(inside)
    placed = placed.select("__docs", "__size", start.alias("start"), index.alias("index"))
    middle = F.col("start") * 2 + F.col("__size")
    placed = written(placed.withColumn("shard", F.least(F.lit(count - 1), F.floor(middle * count / F.lit(2 * total))).cast("int")), "placed")
    # One row for each shard, as many as the caller asked for.
    starts = placed.groupBy("shard").agg(F.min("index").alias("zero"))
    return placed.join(F.broadcast(starts), "shard").select(*kept, F.col("__size").alias("size"), "shard", (F.col("index") - F.col("zero")).alias("slot"))
