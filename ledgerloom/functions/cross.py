"""Row-wise feature columns."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame, functions as F


def log_features(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``<c>(log)``: natural log, NULL where the value is not positive."""
    return df.withColumns({f"{c}(log)": F.when(F.col(c) > 0, F.ln(c)) for c in columns})


def interactions(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``a/b`` and ``a*b`` for every pair, in list order; a ratio over zero is NULL."""
    made = {}
    for a, b in combinations(columns, 2):
        made[f"{a}/{b}"] = F.try_divide(F.col(a), F.col(b))
        made[f"{a}*{b}"] = F.col(a) * F.col(b)
    return df.withColumns(made) if made else df
