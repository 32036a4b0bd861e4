"""Doubles as integers of the same order."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F


def with_bits(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """``df`` with a long ``<new>`` for each double ``names[new]``, which orders like it.

    It has the IEEE 754 bits, negated for negative values; minus zero is zero, NULL stays NULL, and NaN comes after all else.
    In steps, so that each is computed once.
    """
    at = {new: i for i, new in enumerate(names)}
    a, e, m = ({new: F.col(f"__{part}{i}") for new, i in at.items()} for part in "aem")
    steps = df.withColumns({f"__a{at[n]}": F.abs(F.col(f"`{c}`")) for n, c in names.items()})
    steps = steps.withColumns({f"__e{i}": F.least(F.floor(F.log2(a[n])), F.lit(1023)) for n, i in at.items()})
    # The logarithm may be off by one next to a power of two, which the fraction shows.
    steps = steps.withColumns({f"__m{i}": a[n] / F.pow(F.lit(2.0), e[n]) for n, i in at.items()})

    def size(n: str) -> Column:
        def normal(up: int, fraction: Column) -> Column:
            return (e[n] + (1023 + up)) * (1 << 52) + ((fraction - 1) * 2.0**52).cast("long")

        return (
            F.when(F.isnan(a[n]), F.lit((1 << 63) - 1))
            .when(a[n] == float("inf"), F.lit(2047 << 52))
            .when(a[n] < 2.0**-1022, (a[n] * 2.0**1022 * 2.0**52).cast("long"))
            .when(m[n] >= 2, normal(1, m[n] / 2))
            .when(m[n] < 1, normal(-1, m[n] * 2))
            .otherwise(normal(0, m[n]))
        )

    steps = steps.withColumns({f"__size{i}": size(n) for n, i in at.items()})
    signed = {n: F.when(F.col(f"`{names[n]}`") < 0, -F.col(f"__size{i}")).otherwise(F.col(f"__size{i}")) for n, i in at.items()}
    return steps.withColumns(signed).drop(*[f"__{part}{i}" for i in at.values() for part in ("a", "e", "m", "size")])
