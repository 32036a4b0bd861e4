"""Scalar column expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

# Characters that a vendor line may carry at either end.
LINE_PADDING = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0"

# File-name patterns of the vendor.
NUMBERED_FILE = r"fundamentals_([a-z0-9]+)_([a-z0-9]+)(?:_([a-z0-9]+))?\.out\.\d+"
PLAIN_FILE = r"(?i)fundamentals_([a-z0-9]+)_(?:sard_([a-z0-9]+)|([a-z0-9]+))(?:_history)?\.out(?:\.\d+)?$"
REGISTRY_FILE = r"fundamentals_\w+_\w+\.out"

# Fixed value: what the vendor writes for a date that does not exist.
NO_DATE = "99999999"

# Fixed value: the DNS namespace of RFC 4122.
DNS_NAMESPACE = "6ba7b8109dad11d180b400c04fd430c8"


def as_column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_nan(c: str | Column) -> Column:
    """NaN to NULL, the only missing value inside the engine."""
    return F.nullif(as_column(c), F.lit(float("nan")))


def null_token(c: str | Column, token: str = "N.A.") -> Column:
    return F.nullif(as_column(c), F.lit(token))


def replace_empty(c: str | Column, sentinel: str) -> Column:
    c = as_column(c)
    return F.when(c == "", F.lit(sentinel)).otherwise(c)


def parse_date(c: str | Column, fmt: str = "yyyyMMdd") -> Column:
    """Text or whole number to date, in ``fmt`` or as ISO.

    Blank text and ``99999999`` are the missing values of the vendor and give NULL; anything else that is no date is an error.
    """
    text = F.trim(as_column(c).cast("string"))
    day = F.coalesce(F.try_to_date(text, fmt), F.try_to_date(text, "yyyy-MM-dd"))
    missing = text.isNull() | text.isin("", NO_DATE)
    return F.when(~missing, F.coalesce(day, F.raise_error(F.concat(F.lit("not a date: "), text)).cast("date")))


def parse_number(c: str | Column, kind: str) -> Column:
    """Text to a number; ``10.0`` is the whole number 10, blank text is NULL, anything else that is no number is an error."""
    text = F.trim(as_column(c).cast("string"))
    wide = text.try_cast("decimal(38,10)")
    value = text.try_cast(kind)
    if kind in ("int", "long", "bigint", "short"):
        value = F.coalesce(value, F.when(wide == F.floor(wide), wide).try_cast(kind))
    return F.when(~(text.isNull() | (text == "")), F.coalesce(value, F.raise_error(F.concat(F.lit(f"not a {kind}: "), text)).cast(kind)))


def is_annual(period: str | Column) -> Column:
    return as_column(period).endswith(" A")


def is_quarterly(period: str | Column) -> Column:
    return as_column(period).contains(" Q")


def fiscal_year(period: str | Column) -> Column:
    return F.regexp_extract(as_column(period), r"(\d{4})", 1).try_cast("int")


def fiscal_quarter(period: str | Column) -> Column:
    return F.regexp_extract(as_column(period), r"Q(\d)", 1).try_cast("int")


def base_name(path: str | Column) -> Column:
    return F.regexp_extract(as_column(path), r"[^/\\]+$", 0)


def _identity_parts(path: str | Column) -> tuple[Column, Column, Column, Column]:
    name = base_name(path)
    numbered = name.rlike(NUMBERED_FILE)
    plain = name.rlike(PLAIN_FILE)
    return name, numbered, plain, F.regexp_extract(name, PLAIN_FILE, 2)


def file_region(path: str | Column) -> Column:
    name, numbered, plain, _ = _identity_parts(path)
    return (
        F.when(numbered, F.regexp_extract(name, NUMBERED_FILE, 1))
        .when(plain, F.regexp_extract(name, PLAIN_FILE, 1))
        .otherwise(F.lit("Unknown"))
    )


def file_type(path: str | Column) -> Column:
    name, numbered, plain, sard = _identity_parts(path)
    tail = F.regexp_extract(name, NUMBERED_FILE, 3)
    return (
        F.when(
            numbered,
            F.concat_ws("_", F.regexp_extract(name, NUMBERED_FILE, 2), F.nullif(tail, F.lit(""))),
        )
        .when(plain & (sard != ""), F.concat(F.lit("sard_"), sard))
        .when(plain, F.regexp_extract(name, PLAIN_FILE, 3))
        .otherwise(F.lit("Unknown"))
    )


def registry_name(path: str | Column) -> Column:
    """File name under which a field list is registered."""
    path = as_column(path)
    found = F.regexp_extract(path, REGISTRY_FILE, 0)
    return F.when(found != "", found).otherwise(base_name(path))


def name_uuid(name: str | Column, namespace_hex: str = DNS_NAMESPACE) -> Column:
    """Version 3 (MD5) UUID of a name, as lower-case text."""
    digest = F.md5(F.concat(F.unhex(F.lit(namespace_hex)), F.encode(as_column(name), "UTF-8")))
    # The variant nibble keeps its low two bits and gets 10 on top: 0-3 -> 8-b.
    nibble = F.conv(F.substring(digest, 17, 1), 16, 10).cast("int")
    variant = F.lower(F.hex(nibble % 4 + 8))
    return F.concat_ws(
        "-",
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.concat(F.lit("3"), F.substring(digest, 14, 3)),
        F.concat(variant, F.substring(digest, 18, 3)),
        F.substring(digest, 21, 12),
    )


def priority(c: str | Column, ranks: Mapping[str, int], unknown: int) -> Column:
    """Rank of a code in a short fixed list; anything else, NULL included, is ``unknown``."""
    c = as_column(c)
    expr = None
    for code, rank in ranks.items():
        expr = F.when(c == code, rank) if expr is None else expr.when(c == code, rank)
    return expr.otherwise(unknown)
