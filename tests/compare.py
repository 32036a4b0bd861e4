"""Run queries next to their SQL: ``python tests/compare.py <folder> [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        # Minus zero equals zero.
        return v + 0.0
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(cell(r[i]) for i in order) for r in rows), key=repr), [columns[i] for i in order]


def compare(spark, con, run, sql, folder) -> str:
    """Empty when both engines agree, otherwise what differs."""
    df = run(spark, folder)
    got, names = rows_of(df.columns, df.collect())
    cur = con.execute(sql)
    want, sql_names = rows_of([d[0] for d in cur.description], cur.fetchall())
    if names != sql_names:
        return f"columns {names} != {sql_names}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            bad = [(n, x, y) for n, x, y in zip(names, a, b) if x != y]
            count = sum(x != y for x, y in zip(got, want))
            return f"{count} of {len(got)} rows differ, first: {bad[:4]} in {a[:4]}"
        if [type(x) for x in a if x is not None] != [type(x) for x in b if x is not None] and None not in a + b:
            return f"types differ: {a} {b}"
    return ""


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    folder, wanted = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls = connect(folder), entry.oracle_sql()
    for name, run in entry.queries().items():
        if wanted and name not in wanted:
            continue
        t = time.time()
        try:
            if name in sqls:
                problem = compare(spark, con, run, sqls[name], folder)
            else:
                problem = "" if run(spark, folder).count() else "no rows"
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        print(f"{name:28s} {time.time() - t:6.2f}s {'ok' if not problem else 'DIFF ' + problem}", flush=True)
