"""Sinks.  Every write is distributed; one-file output is an explicit choice."""

from __future__ import annotations

import datetime
import uuid
import warnings
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T
from pyspark.errors import AnalysisException

from ..functions.scalar import name_uuid, registry_name
from ..operators.clean import require_unique_columns
from ..session import materialize

CSV_NULL = r"\N"

REGISTRY_SCHEMA = T.StructType(
    [
        T.StructField("_id", T.StringType()),
        T.StructField("filename", T.StringType()),
        T.StructField("colnames", T.ArrayType(T.StringType())),
    ]
)


def _overwrite(df: DataFrame, path: str, write: Callable[[DataFrame, str], None]) -> bool:
    """Run ``write`` once, beside ``path``; what it wrote takes the place of ``path`` if it has rows, otherwise it goes.

    The rows are counted while they are written, so nothing runs before to see whether there are any, and a write that
    fails or has no rows leaves ``path`` as it was.
    """
    require_unique_columns(df)
    jvm = df.sparkSession._jvm
    target = jvm.org.apache.hadoop.fs.Path(path.rstrip("/"))
    beside = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}.writing-{uuid.uuid4().hex}")
    files = target.getFileSystem(df.sparkSession._jsc.hadoopConfiguration())
    seen = Observation()
    try:
        write(df.observe(seen, F.count(F.lit(1)).alias("rows")), beside.toString())
        if not seen.get["rows"]:
            warnings.warn(f"nothing to write to {path}")
            return False
        if files.exists(target):
            files.delete(target, True)
        if not files.rename(beside, target):
            raise OSError(f"cannot put {beside.toString()} in the place of {path}")
        return True
    finally:
        if files.exists(beside):
            files.delete(beside, True)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> bool:
    """Overwrite ``path``; an empty frame is skipped with a warning.  Returns whether it wrote."""

    def write(rows: DataFrame, to: str) -> None:
        (rows.write.partitionBy(*partition_by) if partition_by else rows.write).parquet(to)

    return _overwrite(df, path, write)


def write_csv(df: DataFrame, path: str, single_file: bool = False, null_marker: str | None = CSV_NULL) -> bool:
    r"""Overwrite ``path`` with headed CSV; NULL and the empty string are both written as ``\N``.

    ``single_file`` puts all rows through one task: for small reports only.  An empty frame is skipped with a warning.
    """

    def write(rows: DataFrame, to: str) -> None:
        writer = (rows.coalesce(1) if single_file else rows).write.option("header", True)
        if null_marker is not None:
            writer = writer.option("nullValue", null_marker).option("emptyValue", null_marker)
        writer.csv(to)

    return _overwrite(df, path, write)


def write_by_type(frames: Mapping[str, DataFrame], folder: str, today: datetime.date | None = None) -> dict[str, str]:
    """One dated Parquet table per file type; returns the paths written."""
    stamp = (today or datetime.date.today()).strftime("%Y%m%d")
    paths = {kind: f"{folder.rstrip('/')}/fundamentals_{kind}_{stamp}.parquet" for kind in frames}
    return {kind: paths[kind] for kind, df in frames.items() if write_parquet(df, paths[kind])}


def write_csv_by_type(
    frames: Mapping[str, DataFrame], folder: str, now: datetime.datetime | None = None
) -> dict[str, str]:
    """One time-stamped CSV directory per file type; returns the paths written."""
    paths = {}
    for kind, df in frames.items():
        stamp = (now or datetime.datetime.now()).strftime("%Y%m%d_%H%M%S")
        path = f"{folder.rstrip('/')}/fundamentals_{kind}_{stamp}"
        if write_csv(df, path):
            paths[kind] = path
    return paths


def write_jdbc(
    df: DataFrame, url: str, table: str, mode: str = "append", properties: Mapping[str, str] | None = None
) -> None:
    df.write.jdbc(url, table, mode, dict(properties or {}))


def registry_rows(files: DataFrame, path_column: str = "path", names_column: str = "colnames") -> DataFrame:
    """(path, colnames) rows as registry entries; of equal ids the first path in order stays."""
    filename = registry_name(path_column)
    return (
        files.select(
            name_uuid(filename).alias("_id"),
            filename.alias("filename"),
            F.struct(F.col(path_column).alias("path"), F.col(names_column).alias("colnames")).alias("entry"),
        )
        .groupBy("_id", "filename")
        .agg(F.min("entry").alias("entry"))
        .select("_id", "filename", F.col("entry.colnames").alias("colnames"))
    )


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """The registered field lists, one per id; a registry that does not exist is empty.

    Two writers that add an id at once both leave a row of it, of which every reader sees the same one.
    """
    try:
        rows = spark.read.schema(REGISTRY_SCHEMA).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], REGISTRY_SCHEMA)
    entry = F.min(F.struct("filename", "colnames")).alias("entry")
    return rows.groupBy("_id").agg(entry).select("_id", "entry.filename", "entry.colnames")


def append_registry(spark: SparkSession, entries: DataFrame, path: str) -> DataFrame:
    """Append entries whose id is not registered yet; returns the ones added.  Read with ``read_registry``."""
    known = read_registry(spark, path).select("_id")
    added = materialize(entries.join(known, "_id", "left_anti").select("_id", "filename", "colnames"))
    added.write.mode("append").parquet(path)
    return added
