"""Scans of Parquet, CSV, JDBC and catalog tables."""

from __future__ import annotations

import csv
import datetime
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from .. import keys as K
from ..functions import scalar as S
from ..operators.clean import in_universe, period_between
from ..operators.joins import latest_revision
from ..session import broadcast_within, stored


def read_statements(
    spark: SparkSession,
    path: str,
    alias: str,
    companies: DataFrame,
    low: str | datetime.date,
    high: str | datetime.date,
) -> DataFrame:
    """Parquet statements of the listed companies inside an open date interval, under an alias."""
    return spark.read.parquet(path).transform(period_between, low, high).transform(in_universe, companies).alias(alias)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    column: str | None = None,
    lower: int = 100000,
    upper: int = 999999,
    partitions: int = 5,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """JDBC table.  Spark reads in parallel only with a ``column`` to split on."""
    options = {"fetchsize": "1000", **(properties or {})}
    if column is None:
        return spark.read.jdbc(url, table, properties=options)
    return spark.read.jdbc(
        url, table, column=column, lowerBound=lower, upperBound=upper, numPartitions=partitions, properties=options
    )


def read_latest_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    companies: DataFrame,
    low: str | datetime.date,
    high: str | datetime.date,
    **jdbc,
) -> DataFrame:
    """Latest revisions of the listed companies' rows of a JDBC table; the dates filter in the database."""
    rows = read_jdbc(spark, url, table, **jdbc)
    return rows.transform(period_between, low, high).transform(in_universe, companies).transform(latest_revision)


def staging_tables(
    spark: SparkSession,
    names: Mapping[str, str],
    companies: DataFrame,
) -> dict[str, DataFrame]:
    """Catalog tables (alias -> table name), each restricted to the listed companies."""
    return {alias: spark.table(name).transform(in_universe, companies) for alias, name in names.items()}


def csv_headers(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(file, line): the first line of each CSV file, found by two scans of the text that hold one number a file."""
    lines = spark.read.text([path] if isinstance(path, str) else list(path)).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        F.regexp_replace("value", "^\uFEFF", "").alias("value"),
    )
    # Within a block lines are numbered in order.  A minimum of numbers is merged by hashing; one that carries the line would sort
    # all lines.  Both scans are of one file list, so their splits and numbers are the same.
    first = stored(lines.where("block = 0").groupBy("file").agg(F.min("at").alias("at")), "first-lines")
    return lines.join(broadcast_within(first), ["file", "at"], "left_semi").select("file", F.col("value").alias("line"))


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    types: Mapping[str, str] | None = None,
    delimiter: str = ",",
) -> DataFrame:
    """CSV files with headers, by column name; only the first of equally named columns of a file is kept.

    Files may have their columns in different orders, and a column that a file lacks is NULL in its rows; columns come in the
    order in which the files, by name, first have them.  ``types`` gives column types (others stay text); without it
    types are inferred, which costs another pass over the files.
    """
    paths = [path] if isinstance(path, str) else list(path)
    reader = spark.read.option("header", True).option("sep", delimiter).option("enforceSchema", True)
    files = spark.read.text(paths).inputFiles()
    if len(files) < 2:
        first = spark.read.text(paths).first()
        lines = [first.value.removeprefix("\ufeff")] if first else []
    else:
        headers = stored(csv_headers(spark, paths), "headers")
        # Different headers are few: they are versions of a file, not files.
        found = headers.groupBy("line").agg(F.min("file").alias("file")).collect()
        lines = [r.line for r in sorted(found, key=lambda r: r.file)]
    layouts = [next(csv.reader([line], delimiter=delimiter), []) for line in lines]
    wanted = [n for n in dict.fromkeys(n for names in layouts for n in names) if not _is_copy(n)]
    if len(layouts) < 2:
        return _typed(_positional(reader, paths, layouts[0] if layouts else [], types is None), layouts, wanted, types)
    if types is None:
        parts = []
        for line, names in zip(lines, layouts):
            own = [r.file for r in headers.where(F.col("line") == line).select("file").collect()]
            mine = [n for n in dict.fromkeys(names) if not _is_copy(n)]
            parts.append(_typed(_positional(reader, own, names, True), [names], mine, None))
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts).select([F.col(f"`{n}`") for n in wanted])
    # Where each file has each column; -1 reads as NULL.
    places = [(line, [names.index(n) if n in names else -1 for n in wanted]) for line, names in zip(lines, layouts)]
    orders = spark.createDataFrame(places, "line string, places array<int>")
    orders = broadcast_within(stored(headers.join(orders, "line").select(F.col("file").alias("__file"), "places"), "orders"))
    width = max(len(names) for names in layouts)
    rows = _positional(reader, paths, [""] * width, False).select(F.col("_metadata.file_path").alias("__of"), F.array(*[f"c{i}" for i in range(width)]).alias("cells"))
    rows = rows.join(orders, F.col("__of") == F.col("__file"))
    rows = rows.select([F.get("cells", F.get("places", F.lit(i))).alias(f"c{i}") for i in range(len(wanted))])
    return _typed(rows, [wanted], wanted, types)


def _positional(reader, paths: Sequence[str], names: Sequence[str], infer: bool) -> DataFrame:
    """Rows without headers, columns ``c0``, ``c1`` and so on."""
    columns = [f"c{i}" for i in range(len(names))]
    if infer:
        return reader.option("inferSchema", True).csv(list(paths)).toDF(*columns)
    return reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns])).csv(list(paths))


def _typed(rows: DataFrame, layouts: Sequence[Sequence[str]], wanted: Sequence[str], types: Mapping[str, str] | None) -> DataFrame:
    typed = types or {}
    at = {n: f"c{list(layouts[0]).index(n)}" for n in wanted}
    return rows.select([(typed_value(at[n], typed[n]) if n in typed else F.col(at[n])).alias(n) for n in wanted])


def typed_value(column: str, kind: str) -> Column:
    """A text cell as ``kind``; blank cells are NULL, cells that do not parse are errors, and NaN is NULL."""
    if kind == "date":
        return S.parse_date(column)
    if kind in ("int", "long", "bigint", "short"):
        return S.parse_number(column, kind)
    if kind in ("double", "float"):
        return S.null_nan(S.parse_number(column, kind))
    return F.nullif(F.col(column), F.lit("")).cast(kind)


def _is_copy(name: str) -> bool:
    head, _, tail = name.rpartition(".")
    return bool(head or "." in name) and tail.isdigit()


def read_company_info(spark: SparkSession, path: str, delimiter: str = ",") -> tuple[DataFrame, list[str]]:
    """Company dimension and the names of its six coded industry columns."""
    types = {c: "long" for c in [*K.INDUSTRY_COLUMNS, K.SECTOR]}
    return read_csv(spark, path, types, delimiter), list(K.INDUSTRY_COLUMNS)


def read_industry_codes(spark: SparkSession, path: str, delimiter: str = ",") -> DataFrame:
    """(level, code, label) rows of the code list."""
    return read_csv(spark, path, {"code": "long"}, delimiter).select("level", "code", "label")
