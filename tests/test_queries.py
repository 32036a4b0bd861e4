"""Every query of the library against its SQL, on the smallest data."""

from __future__ import annotations

import pytest
from compare import compare, connect

import __spark_entry__ as entry
from ledgerloom import queries as catalog

FOLDER = "/root/testdata/sf0.001"
SQL = catalog.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, duck, name):
    run = catalog.queries()[name]
    if name in SQL:
        assert compare(spark, duck, run, SQL[name], FOLDER) == ""
    else:
        assert run(spark, FOLDER).count() > 0


def test_sql_has_queries():
    assert set(SQL) <= set(catalog.queries())


def test_all_are_registered():
    assert set(catalog.queries()) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_statement_tables_are_one_aggregate(spark, tmp_path):
    """The filings are read once for all tables; NULLs in keys, measures and conditions as in the SQL."""
    import duckdb

    from ledgerloom.queries import joining, standins

    day = [None, "1995-01-15", "1995-02-15", "1995-05-01"]
    data = [
        (i % 3 or None, i % 2 + 2, i % 5, None if i % 7 == 0 else i % 50 + 0.0, None if i % 4 == 0 else 9000.25 * (i % 9), 0.01 * (i % 3), 0.05 * (i % 3), "ARN"[i % 3], "FO"[i % 2], day[i % 4], i)
        for i in range(240)
    ]
    schema = (
        "l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate string, l_orderkey long"
    )
    rows = spark.createDataFrame(data, schema).selectExpr("* except (l_shipdate)", "cast(l_shipdate as timestamp_ntz) as l_shipdate")
    rows.write.parquet(f"{tmp_path}/lineitem.parquet")
    tables = standins.unique_statements(spark, str(tmp_path), joining.UNIQUE_ORDER)
    assert not any("lineitem" in f for t in tables.values() for f in t.inputFiles())
    con = duckdb.connect()
    con.execute(f"create view lineitem as select * from '{tmp_path}/lineitem.parquet/*.parquet'")
    assert compare(spark, con, catalog.queries()["statement_left_join"], SQL["statement_left_join"], str(tmp_path)) == ""
