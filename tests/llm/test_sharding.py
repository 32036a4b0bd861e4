from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import sharding


def sizes(df):
    return df.select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("bytes"))


@pytest.mark.parametrize("range_bytes", [500, 1 << 28])
def test_near_equal_bytes_with_a_hot_key(spark, range_bytes):
    rows = [(None, "x" * 5)] * 1500 + [(1, "y" * 30)] * 500 + [(2, None)] * 10 + [(i, "z" * (i % 90)) for i in range(3, 900)]
    df = sizes(spark.createDataFrame(rows, "doc_id long, text string"))
    got = sharding.shards(df, 7, ["doc_id"], F.col("bytes") + 16, range_bytes=range_bytes).collect()
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r)
    assert sorted((str(r.doc_id), r.text or "") for r in got) == sorted((str(a), b or "") for a, b in rows)
    assert all(sorted(r.slot for r in part) == list(range(len(part))) for part in by.values())
    total = [sum(r.size for r in by[k]) for k in range(7)]
    assert max(total) - min(total) <= 2 * max(r.size for r in got)
    # Ranges of the key: null first, then rising.
    edge = [(min(r.doc_id or 0 for r in by[k]), max(r.doc_id or 0 for r in by[k])) for k in range(7)]
    assert all(a[1] <= b[0] for a, b in zip(edge, edge[1:]))


def test_few_rows_and_none(spark):
    df = sizes(spark.createDataFrame([(4, "abc")], "doc_id long, text string"))
    assert [(r.doc_id, r.slot) for r in sharding.shards(df, 40, ["doc_id"], F.col("bytes") + 16).collect()] == [(4, 0)]
    assert sharding.shards(df.limit(0), 40, ["doc_id"], F.col("bytes") + 16).count() == 0


def test_columns_of_any_name_travel_along(spark):
    names = ["before", "above", "zero", "range", "part", "start", "index", "bytes", "n", "splitters", "pieces", "__row", "__key", "a.b"]
    rows = [(i, "x" * (i % 9), 5, 6, 7, *[f"{c}{i}" for c in names]) for i in range(60)]
    kind = "doc_id long, text string, size int, shard int, slot int, " + ", ".join(f"`{c}` string" for c in names)
    got = sharding.shards(spark.createDataFrame(rows, kind), 4, ["doc_id"], F.octet_length("text") + 16, range_bytes=100)
    assert got.columns == ["doc_id", "text", *names, "size", "shard", "slot"]
    found = got.collect()
    assert sorted((r.doc_id, r["size"]) for r in found) == [(i, i % 9 + 16) for i in range(60)]
    assert all(r[c] == f"{c}{r.doc_id}" for r in found for c in names)
    assert sorted({r.shard for r in found}) == [0, 1, 2, 3]
