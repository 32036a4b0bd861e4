"""Session settings and the few eager helpers the operators share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, types as T

# Upper bounds for a side that is sent to every executor on purpose: rows, and rows times the width of a row.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Join chains reuse one partitioning of the record key.  Without this flag a hot key in
    # the chain is left in one task, because splitting it costs the next join a shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Hash instead of sort a join whose build side is known, at run time, to be small per task.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
}


# Wanted bytes per shuffle task, and the most tasks a shuffle is cut into.
SHUFFLE_TASK_BYTES = 128 << 20
MAX_SHUFFLE_TASKS = 1_000_000
_INITIAL_TASKS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def tune(spark: SparkSession, shuffle_bytes: int | None = None) -> SparkSession:
    """Switch on adaptive execution with skew splitting for this session.

    ``shuffle_bytes``, the size of the largest input of a shuffle, sets how finely shuffles are cut
    to begin with; adaptive execution merges what turns out small.
    """
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    if shuffle_bytes is not None:
        wanted = max(-(-shuffle_bytes // SHUFFLE_TASK_BYTES), shuffle_tasks(spark))
        spark.conf.set(_INITIAL_TASKS, str(min(wanted, MAX_SHUFFLE_TASKS)))
    return spark


def shuffle_tasks(spark: SparkSession) -> int:
    """How many tasks a shuffle starts with."""
    return int(spark.conf.get(_INITIAL_TASKS, None) or spark.conf.get("spark.sql.shuffle.partitions"))


def checkpoint_folder(spark: SparkSession) -> str:
    """Shared folder for durable intermediate results.

    Where none is configured a local master gets a folder of its own; on a cluster that is an error, because executors
    do not see each other's disks.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerloom-"))
        current = spark.sparkContext.getCheckpointDir()
    return current


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder once and go on from the written copy."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the checkpoint folder and go on from the copy, of which later steps read only the
    columns they need.  Column names must be unique."""
    path = f"{checkpoint_folder(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def at_most(df: DataFrame, rows: int) -> bool:
    """True when ``df`` has no more than ``rows`` rows; never counts past the bound."""
    return df.limit(rows + 1).count() <= rows


def small_side(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A dimension that several joins use: computed once, counted, broadcast within the bound."""
    return broadcast_within(materialize(df), rows)


def broadcast_within(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast when ``df`` is within the bound; otherwise leave the join to AQE.

    ``df`` should be cheap to count (a file scan or a materialized result).
    """
    return df.hint("broadcast") if at_most(df, min(rows, BROADCAST_BYTES // row_bytes(df))) else df


def row_bytes(df: DataFrame) -> int:
    """A generous width of a row: what numbers take, and more for text and nested values."""

    def width(kind: T.DataType) -> int:
        if isinstance(kind, T.StructType):
            return 16 + sum(width(f.dataType) for f in kind.fields)
        return 16 if isinstance(kind, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType)) else 64

    return width(df.schema)
