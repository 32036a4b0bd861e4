"""Conflicting filings to one row per company and fiscal period.

For one column, the filings that carry a value are narrowed step by step: latest update, then
consolidated, then filing status, then accounting standard.  The first step that leaves one
distinct value decides; if none does, the value is NULL.  Each step is a subset of the one
before, so the same result follows from the best filings under one combined rank: they agree on
a value, or the cell is NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .. import keys as K
from ..functions import scalar as S

# Codes outside the lists; a status has three bits of the rank, a standard two.
_UNKNOWN_STATUS, _UNKNOWN_STANDARD = 7, 3
# The last day of the year 9999, from which days count down.
_LAST_DAY = 2_932_896
_NO_DATE = 1 << 28
#: Ranks are below this, so that a rank and half of a value's bits are one long.
RANKS = 1 << 30
RANK = "__rank"


def filing_rank(
    update: str = K.UPDATE_DT,
    consolidated: str = K.CONSOLIDATED,
    filing: str = K.FILING_STATUS,
    accounting: str = K.ACCOUNTING,
) -> Column:
    """Combined rank of a filing as one long from 0 to 2^28; lower is better.

    A missing update date, and likewise an unknown status, leaves nothing for the later steps to
    compare, so those parts of the rank are fixed and the filings stay tied.
    """
    day = F.lit(_LAST_DAY) - F.least(F.unix_date(F.col(update).cast("date")), F.lit(_LAST_DAY)).cast("long")
    secondary = F.when(F.col(consolidated) == "Y", 0).otherwise(1)
    status = S.priority(filing, K.FILING_PRIORITY, _UNKNOWN_STATUS)
    standard = S.priority(accounting, K.ACCOUNTING_PRIORITY, _UNKNOWN_STANDARD)
    standard = F.when(status == _UNKNOWN_STATUS, 0).otherwise(standard)
    # least() skips NULL, so a missing date is looked at by itself.
    return F.when(F.col(update).cast("date").isNull(), F.lit(_NO_DATE).cast("long")).otherwise(((day * 2 + secondary) * 8 + status) * 4 + standard)


def resolve(df: DataFrame, group_by: Sequence[str], columns: Sequence[str], rank: Column | None = None) -> DataFrame:
    """One row per group with the decided value of each column.

    Per column, the smallest and the largest value among the filings of the best rank.  They are merged before the one
    exchange, so a company with a large share of all filings arrives as a handful of rows.  Numbers, dates and the like
    are merged by hashing: rank and bits of the value are put together in integers of fixed width.  Texts are merged by
    sorting, in an aggregate of their own.  ``rank`` is a long from 0 to ``RANKS`` - 1.
    """
    group_by, columns = list(group_by), list(columns)
    rows = df
    for g in group_by:
        rows = rows.where(F.col(g).isNotNull())
    rows = rows.select(*group_by, *columns, (filing_rank() if rank is None else rank).alias(RANK))
    sorted_ = [c for c in columns if not _hashable(rows.schema[c].dataType)]
    hashed = [c for c in columns if c not in sorted_]
    parts = [merge(rows, group_by, some) for merge, some in ((_by_hash, hashed), (_by_sort, sorted_)) if some]
    out = parts[0].join(parts[1], group_by) if len(parts) == 2 else (parts or [rows.select(*group_by).distinct()])[0]
    return out.select(*group_by, *columns)


def _hashable(kind: T.DataType) -> bool:
    """Whether a value is at most 64 bits wide, so that a running extreme of it can be kept in place."""
    if isinstance(kind, T.DecimalType):
        return kind.precision <= 18
    return isinstance(kind, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType))


def _by_hash(rows: DataFrame, group_by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    # For a single value of at most 64 bits every step of this hash can be undone, so different values have different numbers.
    coded = rows.withColumns({f"__bits{i}": F.xxhash64(c) for i, c in enumerate(columns)})
    half = F.lit(0xFFFFFFFF)
    aggregates = []
    for i, c in enumerate(columns):
        known = F.when(F.col(c).isNotNull(), F.col(RANK))
        base = known * (1 << 32)
        pieces = (F.shiftrightunsigned(f"__bits{i}", 32), F.col(f"__bits{i}").bitwiseAND(half))
        # The least of a piece and of what it lacks to its greatest: equal pieces add up to that.
        for j, piece in enumerate(pieces):
            aggregates += [F.min(base + piece).alias(f"__lo{i}_{j}"), F.min(base + (half - piece)).alias(f"__hi{i}_{j}")]
        aggregates.append(F.min_by(c, known).alias(f"__any{i}"))
    found = coded.groupBy(*group_by).agg(*aggregates)

    def one_value(i: int) -> Column:
        low, high = ([F.col(f"__{e}{i}_{j}").bitwiseAND(half) for j in (0, 1)] for e in ("lo", "hi"))
        return (low[0] + high[0] == half) & (low[1] + high[1] == half)

    return found.select(*group_by, *[F.when(one_value(i), F.col(f"__any{i}")).alias(c) for i, c in enumerate(columns)])


def _by_sort(rows: DataFrame, group_by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    ends = []
    for i, c in enumerate(columns):
        known = F.col(c).isNotNull()
        up = F.struct(F.col(RANK).alias("rank"), F.col(c).alias("value"))
        down = F.struct((-F.col(RANK)).alias("rank"), F.col(c).alias("value"))
        ends += [F.min(F.when(known, up)).alias(f"__lo{i}"), F.max(F.when(known, down)).alias(f"__hi{i}")]
    found = rows.groupBy(*group_by).agg(*ends)
    same = [F.col(f"__lo{i}.value") == F.col(f"__hi{i}.value") for i in range(len(columns))]
    return found.select(*group_by, *[F.when(s, F.col(f"__lo{i}.value")).alias(c) for i, (c, s) in enumerate(zip(columns, same))])


def resolve_annual(df: DataFrame, excluded: Sequence[str] = K.ANNUAL_UNRESOLVED) -> DataFrame:
    """One row per (Year, company), all other columns decided."""
    group = [K.YEAR, K.SERIES_ID]
    return resolve(df, group, [c for c in df.columns if c not in excluded and c not in group])


def resolve_quarterly(df: DataFrame, excluded: Sequence[str] = K.QUARTERLY_UNRESOLVED) -> DataFrame:
    """One row per (Year, company, Quarter), all other columns decided."""
    group = [K.YEAR, K.SERIES_ID, K.QUARTER]
    return resolve(df, group, [c for c in df.columns if c not in excluded and c not in group])
