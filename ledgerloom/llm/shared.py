"""Tables in the shared folder of the cluster."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from ..session import checkpoint_folder


def folder(spark: SparkSession, name: str) -> str:
    """A new place below ``spark.checkpoint.dir``."""
    return f"{checkpoint_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, codec: str = "zstd", plain: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` as Parquet once and go on from the written copy: lost executors lose no part of it.

    ``plain`` columns differ in nearly every row, so no dictionary is tried for them.
    """
    path = folder(df.sparkSession, name)
    df.write.option("compression", codec).options(**{f"parquet.enable.dictionary#{c}": "false" for c in plain}).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def bucketed(df: DataFrame, key: str, name: str, codec: str = "zstd") -> Iterator[DataFrame]:
    """Write ``df`` once in buckets by ``key``, as many as a shuffle has tasks: joins by ``key`` leave its rows where they are.

    The catalog knows the table inside the block only; the files stay.
    """
    spark = df.sparkSession
    path = folder(spark, name)
    table = path.rsplit("/", 1)[1].replace("-", "_")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.repartition(n, key).write.option("compression", codec).option("path", path).bucketBy(n, key).format("parquet").saveAsTable(table)
    try:
        yield spark.table(table)
    finally:
        spark.sql(f"DROP TABLE {table}")


#: Bytes that a hinted broadcast may have, by rows times the width of a row.
BROADCAST_BYTES = 16 << 20


def narrow_side(df: DataFrame, row_bytes: int) -> DataFrame:
    """Hint a broadcast if ``df`` is within the byte bound; beyond it the join is shuffled, with the same rows.

    ``df`` must be cheap to count: a written table.
    """
    most = BROADCAST_BYTES // row_bytes
    return df.hint("broadcast") if df.limit(most + 1).count() <= most else df
