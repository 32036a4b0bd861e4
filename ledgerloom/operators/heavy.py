"""Keys with more rows than one task should hold: found without a miss, and joined in blocks.

Finding.  Rows are counted per bucket of a hash, first of a few key columns, which are cheap to read, then of the whole key
where a bucket is above the bound.  Every task merges its counts into at most ``BUCKETS`` numbers, and a key above the bound lies
in a bucket above it, so only the rows of such buckets are counted by key, in the same aggregate that finds their latest
revision.

Joining.  The rows of a heavy key are numbered and written, so that a repeated task deals them out alike.  Left rows go
to as many blocks as hold at most the bound, right rows likewise; each left block meets each right block in a task of its
own, for which the rows of one side are repeated once per block of the other.  That splits a key that is heavy on the left,
on the right or on both sides, whatever comes before the join.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import broadcast_within, stored

#: Hash buckets of the first count; no more rows than this come from any task or go to any.
BUCKETS = 1 << 17
# Blocks of one side of one key, so that a count taken from a product stays a number of tasks.
MAX_BLOCKS = 1_000_000


def selective_first(keys: Sequence[str], front: Sequence[str]) -> list[str]:
    """The same keys, those in ``front`` first: a sort then mostly decides on its first column."""
    return sorted(keys, key=lambda k: k not in front)


class HeavyKeys:
    """Heavy keys of some tables (``frame``: ``__k0`` ..., and per table rows, top revision and rows of that revision)."""

    def __init__(self, frame: DataFrame, keys: Sequence[str], names: Sequence[str], rows: int):
        self.frame, self.keys, self.names, self.rows = frame, list(keys), list(names), rows

    def _on(self) -> Column:
        # NULL equals NULL, as it does in a window partition.
        return reduce(and_, [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(self.keys)])

    def _key_columns(self) -> list[str]:
        return [f"__k{i}" for i in range(len(self.keys))]

    def light(self, df: DataFrame) -> DataFrame:
        """Rows of all other keys."""
        return df.join(broadcast_within(self.frame.select(self._key_columns())), self._on(), "left_anti")

    def heavy(self, df: DataFrame, *facts: Column) -> DataFrame:
        """Rows of heavy keys, with facts of their key; they are not moved."""
        known = self.frame.select(*self._key_columns(), *facts)
        return df.join(broadcast_within(known), self._on()).drop(*self._key_columns())

    def latest(self, df: DataFrame, name: str, revision: str) -> DataFrame:
        """Rows of heavy keys that have the top revision of their key."""
        i = self.names.index(name)
        rows = self.heavy(df, F.col(f"__top{i}").alias("__top"))
        return rows.where((F.col(revision) >= F.col("__top")) | F.col("__top").isNull()).drop("__top")

    def blocks(self, order: Sequence[str], ranked: Sequence[str]) -> list[Column]:
        """Per join of the chain ``order``: in how many blocks the rows so far and the next table's are dealt."""
        counts = [F.coalesce(F.col(f"__{'m' if n in ranked else 'n'}{self.names.index(n)}"), F.lit(0)) for n in order]
        out, left = [], F.lit(1.0)
        for t, count in enumerate(counts[1:], 1):
            left = left * F.greatest(counts[t - 1], F.lit(1))
            for side, size in (("l", left), ("r", count)):
                wanted = F.ceil(size / self.rows)
                out.append(F.least(F.greatest(wanted, F.lit(1)), F.lit(MAX_BLOCKS)).cast("int").alias(f"__b{side}{t}"))
        return out


def _bucket(columns: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(BUCKETS)).cast("int")


def _in_full_buckets(tables: Sequence[DataFrame], columns: Sequence[str], rows: int) -> list[DataFrame] | None:
    """The rows whose bucket of ``columns`` has more than ``rows`` rows in one of the tables, or ``None`` if there is no such bucket."""
    bucket = _bucket(columns).alias("__bucket")
    every = [t.select(F.lit(i).alias("__table"), bucket) for i, t in enumerate(tables)]
    counts = reduce(DataFrame.unionAll, every).groupBy("__table", "__bucket").agg(F.count(F.lit(1)).alias("__rows"))
    # At most BUCKETS numbers come to the driver and go to a task.
    full = [(r[0],) for r in counts.where(F.col("__rows") > rows).select("__bucket").distinct().collect()]
    if not full:
        return None
    full = F.broadcast(counts.sparkSession.createDataFrame(full, "__full int"))
    return [t.join(full, _bucket(columns) == F.col("__full"), "left_semi") for t in tables]


def heavy_keys(
    tables: Mapping[str, DataFrame], keys: Sequence[str], rows: int, revision: str | None = None, front: Sequence[str] = ()
) -> HeavyKeys | None:
    """Keys with more than ``rows`` rows in one of the tables, or ``None``.  NULL parts of a key count as equal.

    ``front``, columns of the key that differ in most keys, are counted alone first: where none of their buckets is above the
    bound, the other columns are not read.
    """
    keys, names, close = list(keys), list(tables), list(tables.values())
    front = [k for k in keys if k in front]
    for columns in ([front] if front and len(front) < len(keys) else []) + [keys]:
        close = _in_full_buckets(close, columns, rows)
        if close is None:
            return None
    facts = []
    for i, t in enumerate(close):
        top = F.col(revision) if revision else F.lit(None).cast("long")
        near = t.select(*[F.col(k).alias(f"__k{j}") for j, k in enumerate(keys)], top.alias("__top"))
        named = [f"__k{j}" for j in range(len(keys))]
        by_revision = near.groupBy(*named, "__top").agg(F.count(F.lit(1)).alias("__n"))
        per_key = by_revision.groupBy(*named).agg(F.sum("__n").alias("__n"), F.max(F.struct("__top", "__n")).alias("__latest"))
        facts.append(per_key.select(*named, F.lit(i).alias("__table"), "__n", F.col("__latest.__top").alias("__top"), F.col("__latest.__n").alias("__m")))
    columns = [
        F.max(F.when(F.col("__table") == i, F.col(f"__{c}"))).alias(f"__{c}{i}") for i in range(len(names)) for c in ("n", "top", "m")
    ]
    found = reduce(DataFrame.unionAll, facts).groupBy(*named).agg(*columns)
    # Enough to hold a key above the bound in any table.
    most = F.greatest(*[F.col(f"__n{i}") for i in range(len(names))], F.lit(0))
    frame = stored(found.where(most > rows), "heavy")
    return None if frame.isEmpty() else HeavyKeys(frame, keys, names, rows)


def numbered(df: DataFrame, name: str) -> DataFrame:
    """``df`` written with a number ``name`` for each row, which no later task can change."""
    return stored(df.withColumn(name, F.monotonically_increasing_id()), "numbered")


def dealt_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    step: int,
    how: str,
    combine: Callable[[DataFrame, DataFrame, list[str], str], DataFrame],
) -> DataFrame:
    """Join number ``step`` of a chain over heavy keys.

    Both sides carry ``HeavyKeys.blocks``; ``left`` has row numbers in ``__id``, ``right`` in ``__rid``.
    """
    own, other = F.col(f"__bl{step}"), F.col(f"__br{step}")
    each = lambda count: F.explode(F.sequence(F.lit(0), count - 1))
    lefts = left.withColumn("__i", F.pmod("__id", own).cast("int")).withColumn("__j", each(other))
    rights = right.withColumn("__j", F.pmod("__rid", other).cast("int")).withColumn("__i", each(own))
    rights = rights.drop(*[c for c in rights.columns if c.startswith(("__bl", "__br"))])
    out = combine(lefts, rights, [*keys, "__i", "__j"], how)
    matched = F.col("__rid").isNotNull()
    # Several right blocks mean that the key has right rows: a left row without one has met an empty block.
    kept = out.where(matched | (other == 1))
    number = F.when(matched, F.xxhash64("__id", "__rid")).otherwise(F.col("__id"))
    return kept.withColumn("__id", number).drop("__rid", "__i", "__j")


def ranked_window(df: DataFrame, keys: Sequence[str], revision: str) -> DataFrame:
    """Rows of the top rank of each key, by a window that is cut to the top before its one exchange."""
    w = Window.partitionBy(*keys).orderBy(F.col(revision).desc())
    return df.withColumn("__rank", F.rank().over(w)).where(F.col("__rank") == 1).drop("__rank")
