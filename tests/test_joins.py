from __future__ import annotations

import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ledgerloom import keys as K
from ledgerloom.operators import clean, heavy, joins
from ledgerloom.plans import statements as flows
from ledgerloom.session import materialize


def keyed(spark, data, value):
    """Rows of (company, period, revision, value); the other key parts are constant."""
    out = [(d, c, c, "MR", "US GAAP", "Y", "USD", "2020 Q1", r, v) for c, d, r, v in data]
    schema = (
        "LATEST_PERIOD_END_DT_FULL_RECORD string, ID_BB_COMPANY string, ID_BB_UNIQUE string, FILING_STATUS string, "
        "ACCOUNTING_STANDARD string, EQY_CONSOLIDATED string, EQY_FUND_CRNCY string, FISCAL_YEAR_PERIOD string, "
        f"REVISION_ID long, {value} double"
    )
    df = spark.createDataFrame(out, schema)
    return df.withColumn(K.PERIOD_END, df[K.PERIOD_END].cast("date"))


DATA = [
    ("a", "2020-03-31", 1, 1.0),
    ("a", "2020-03-31", 3, 2.0),
    ("a", "2020-03-31", 3, 3.0),
    ("b", "2020-03-31", None, 4.0),
    ("b", "2020-03-31", None, 5.0),
    ("c", "2020-03-31", None, 6.0),
    ("c", "2020-03-31", 2, 7.0),
    ("d", None, 1, 8.0),
    ("d", None, 2, 9.0),
]


def test_latest_revision_keeps_ties_and_null_keys(spark):
    df = keyed(spark, DATA, "v")
    for hot_rows in (1, 2, 1000):
        kept = joins.latest_revision(df, hot_rows=hot_rows)
        assert sorted(r.v for r in kept.collect()) == [2.0, 3.0, 4.0, 5.0, 7.0, 9.0]
    assert joins.latest_revision(df).columns == df.columns
    ranked = joins.latest_revision(df, rank_column="revision_rank")
    assert {r.revision_rank for r in ranked.collect()} == {1}


def test_join_no_dup_left_wins(spark):
    left = spark.createDataFrame([(1, "l", 1), (2, "l", 2)], "k int, s string, a int")
    right = spark.createDataFrame([(1, "r", 5)], "k int, s string, b int")
    out = joins.join_no_dup(left, right, ["k"])
    assert out.columns == ["k", "s", "a", "b"]
    assert rows(out, "k") == [(1, "l", 1, 5), (2, "l", 2, None)]


def test_join_statements_variants(spark):
    tables = {
        "is": keyed(spark, DATA, "v_is"),
        "cr": keyed(spark, [("a", "2020-03-31", 1, 10.0), ("d", None, 1, 11.0)], "v_cr"),
        "cr2": keyed(spark, [("a", "2020-03-31", 1, 20.0), ("a", "2020-03-31", 2, 21.0)], "v_cr2"),
    }
    all_ranked = joins.join_statements(tables, "all")
    got = sorted((r.v_is, r.v_cr, r.v_cr2) for r in all_ranked.collect() if r.v_cr)
    assert got == [(2.0, 10.0, 21.0), (3.0, 10.0, 21.0)]
    assert all_ranked.count() == 6
    assert all_ranked.columns == [*K.RECORD_KEYS, "REVISION_ID", "v_is", "v_cr", "v_cr2"]
    one_ranked = joins.join_statements(tables, "cr2")
    assert sorted((r.v_is, r.v_cr2) for r in one_ranked.collect()) == [(1.0, 21.0), (2.0, 21.0), (3.0, 21.0)]
    assert joins.join_statements(tables, "none").count() == 3 * 2 + 6


def test_join_and_select(spark):
    tables = {"is": keyed(spark, DATA, "EBITDA"), "bs": keyed(spark, [("a", "2020-03-31", 7, 1.0)], "IS_EPS")}
    sectors = spark.createDataFrame([("a", 10), ("d", 20)], "ID_BB_COMPANY string, BICS_LEVEL_1 int")
    wanted = ["BICS_LEVEL_1", "ID_BB_COMPANY", "is.REVISION_ID", "EBITDA", "IS_EPS"]
    out = joins.join_and_select(tables, sectors, wanted)
    assert out.columns == ["BICS_LEVEL_1", "ID_BB_COMPANY", "REVISION_ID", "EBITDA", "IS_EPS"]
    got = sorted(rows(out), key=lambda r: r[3])
    assert got[0] == (10, "a", 1, 1.0, 1.0) and got[-1] == (20, "d", 2, 9.0, None) and len(got) == len(DATA)
    other = joins.join_and_select(tables, sectors, ["ID_BB_COMPANY", "bs.REVISION_ID"])
    assert sorted(r[1] for r in rows(other) if r[1]) == [7, 7, 7]


def test_universe_checks_sector(spark):
    info = spark.createDataFrame(
        [("a", 10), ("a", 10), ("b", 20), ("c", None)], "ID_BB_COMPANY string, BICS_LEVEL_1 int"
    )
    assert rows(clean.universe(info), "ID_BB_COMPANY") == [("a", 10), ("b", 20), ("c", None)]
    assert rows(clean.universe(info, 10)) == [("a", 10)]
    with pytest.raises(PySparkException, match="more than one sector"):
        clean.universe(info.union(spark.createDataFrame([("a", 30)], info.schema))).collect()


def test_period_bounds_are_open(spark):
    df = keyed(spark, [("a", "2020-01-01", 1, 1.0), ("a", "2020-01-02", 1, 2.0), ("a", "2020-01-03", 1, 3.0)], "v")
    assert [r.v for r in clean.period_between(df, "2020-01-01", "2020-01-03").collect()] == [2.0]


def test_flow(spark):
    info = spark.createDataFrame([("a", 10), ("b", 10), ("c", 20)], "ID_BB_COMPANY string, BICS_LEVEL_1 int")
    tables = {"is": keyed(spark, DATA, "v_is"), "cf": keyed(spark, [("a", "2020-03-31", 1, 1.5)], "v_cf")}
    out = flows.join_latest(tables, info, 10, "1995-01-01", "2025-01-01")
    assert sorted((r.v_is, r.v_cf) for r in out.collect() if r.v_cf) == [(2.0, 1.5), (3.0, 1.5)]
    assert {r.ID_BB_COMPANY for r in out.collect()} == {"a", "b"}


def test_a_rare_hot_key_is_found(spark):
    """60 of 5 million rows share a key; every bucket of the first count holds about 38."""
    keyed_rows = spark.range(0, 5_000_000, 1, 8).selectExpr("if(id < 60, -1, id) as k", "id as REVISION_ID")
    found = heavy.heavy_keys({"t": keyed_rows}, ["k"], 40, "REVISION_ID")
    assert [tuple(r) for r in found.frame.collect()] == [(-1, 60, 59, 1)]
    assert heavy.heavy_keys({"t": keyed_rows}, ["k"], 60) is None


def test_hot_rows_are_ranked_in_place(spark):
    """A third of the rows share one key, all tied on the latest revision; only light rows are exchanged."""
    n = 60000
    df = spark.range(0, n, 1, 8).selectExpr(
        f"if(id < {n // 3}, null, cast(id as string)) as ID_BB_COMPANY", "1L as REVISION_ID", "uuid() as payload"
    )
    df = materialize(df)
    out = joins.latest_revision(df, ["ID_BB_COMPANY"], hot_rows=n // 4)
    assert out.where("payload is not null").count() == n
    sizes = out.where("ID_BB_COMPANY is null").groupBy(F.spark_partition_id()).count()
    assert max(r["count"] for r in sizes.collect()) <= n // 8


def skewed(spark, hot, rest, value, start=0):
    """``hot`` rows of one key and one row for each of ``rest`` other keys."""
    keys = [F.when(F.col("id") < hot, "hot").otherwise(F.col("id").cast("string")).alias(k) for k in K.RECORD_KEYS[1:]]
    period = F.lit("2020-03-31").cast("date").alias(K.PERIOD_END)
    rows_ = spark.range(0, hot + rest, 1, 4).select(period, *keys, (F.col("id") % 3).alias("REVISION_ID"), (F.col("id") + start).alias(value))
    return materialize(rows_)


@pytest.mark.parametrize("rank", ["all", "none", "cf"])
@pytest.mark.parametrize(("left", "right"), [(600, 1), (1, 600), (90, 70), (600, 0)])
def test_hot_keys_on_each_side(spark, rank, left, right):
    tables = {"is": skewed(spark, left, 300, "a"), "cr": skewed(spark, right, 300, "b", 5), "cf": skewed(spark, 2, 200, "c", 9)}
    names = ["ID_BB_COMPANY", "a", "b", "c"]
    got = joins.join_statements(tables, rank, hot_rows=25).select(names)
    want = joins.join_statements(tables, rank).select(names)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_no_task_has_all_rows_of_a_hot_key(spark, conf):
    """A key with a third of the rows on the left, in a chain whose right sides are aggregates, and on the right."""
    conf("spark.sql.autoBroadcastJoinThreshold", -1)
    conf("spark.sql.shuffle.partitions", 64)
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    for left, right in ((6000, 1), (1, 6000)):
        tables = {"is": skewed(spark, left, 12000, "a"), "cr": skewed(spark, right, 12000, "b")}
        out = joins.join_statements(tables, "none", hot_rows=500)
        assert out.count() == 12000 + 6000
        sizes = out.groupBy(F.spark_partition_id()).count()
        assert max(r["count"] for r in sizes.collect()) <= 4 * 500


@pytest.mark.parametrize(("left", "right"), [(300, 1), (1, 300), (60, 50)])
def test_selected_columns_of_hot_keys(spark, left, right):
    tables = {"is": skewed(spark, left, 50, "EBITDA"), "bs": skewed(spark, right, 40, "IS_EPS", 7)}
    wanted = ["ID_BB_COMPANY", "is.REVISION_ID", "EBITDA", "IS_EPS"]
    got = joins.join_and_select(tables, None, wanted, hot_rows=20)
    assert got.columns == ["ID_BB_COMPANY", "REVISION_ID", "EBITDA", "IS_EPS"]
    assert sorted(map(str, got.collect())) == sorted(map(str, joins.join_and_select(tables, None, wanted).collect()))
    other = ["ID_BB_COMPANY", "bs.REVISION_ID", "EBITDA"]
    assert sorted(map(str, joins.join_and_select(tables, None, other, hot_rows=20).collect())) == sorted(
        map(str, joins.join_and_select(tables, None, other).collect())
    )


def test_chain_splits_hot_key_on_the_left(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", -1)
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "100KB")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "50KB")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", 2)
    n = 60000
    left = spark.range(0, n, 1, 8).selectExpr(
        f"if(id < {n // 3}, 'hot', cast(id as string)) as k", "uuid() as payload"
    )
    right = spark.range(0, n, 1, 8).selectExpr(f"if(id < 1, 'hot', cast(id as string)) as k", "id as b")
    again = right.withColumnRenamed("b", "c")
    out = joins.join_no_dup(joins.join_no_dup(left, right, ["k"]), again, ["k"]).groupBy().agg(
        {"payload": "max", "b": "count", "c": "count"}
    )
    got = out.collect()[0].asDict()
    assert got["count(b)"] == got["count(c)"] == n
    assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()


def test_count_for_heavy_keys_reads_the_company_alone_first(spark):
    df = keyed(spark, DATA, "v").withColumn(K.FISCAL_PERIOD, F.raise_error(F.lit("read")).cast("string"))
    joins.latest_revision(df)
    joins.join_statements({"is": df, "cr": df.withColumnRenamed("v", "w")})
    with pytest.raises(PySparkException, match="read"):
        joins.latest_revision(df, hot_rows=2)


def test_heavy_company_without_a_heavy_key(spark):
    df = spark.range(100).selectExpr("'c' as c", "id % 20 as k", "id as r")
    assert heavy.heavy_keys({"t": df}, ["c", "k"], 20, "r", ["c"]) is None
    df = df.unionByName(spark.range(30).selectExpr("'c' as c", "7L as k", "id as r"))
    found = heavy.heavy_keys({"t": df}, ["c", "k"], 20, "r", ["c"])
    assert [tuple(r) for r in found.frame.collect()] == [("c", 7, 35, 87, 1)]


def test_hash_of_the_key_leads_ranks_and_their_joins(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", -1)
    tables = {"is": keyed(spark, DATA, "a"), "cr": keyed(spark, DATA, "b")}
    for out in (joins.join_statements(tables), joins.latest_revision(tables["is"])):
        assert joins.HASH not in out.columns
        plan = out._jdf.queryExecution().sparkPlan().toString()
        ranks = [line for line in plan.splitlines() if "Window" in line or "SortMergeJoin" in line]
        assert ranks and all("[" + joins.HASH in line for line in ranks)


def test_equal_keys_of_different_types_still_match(spark):
    left = spark.createDataFrame([(1, 2, "l")], "k int, REVISION_ID int, a string")
    right = spark.createDataFrame([(1, 2, "r")], "k long, REVISION_ID int, b string")
    out = joins.join_statements({"is": left, "cr": right}, keys=["k"])
    assert rows(out) == [(1, 2, "l", "r")]


def test_selected_columns_count_the_company_first(spark, monkeypatch):
    fronts, find = [], joins.heavy_keys

    def recorded(*args, front=(), **named):
        fronts.append(tuple(front))
        return find(*args, front=front, **named)

    monkeypatch.setattr(joins, "heavy_keys", recorded)
    joins.join_and_select({"is": keyed(spark, DATA, "v"), "cr": keyed(spark, DATA, "w")}, None, ["is.REVISION_ID", "w"])
    assert fronts == [(K.COMPANY,)]


def test_only_the_base_carries_the_key_through_the_chain(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", -1)
    key = ["a", "b"]
    values = [("ab", "c"), ("a", "bc"), ("", "abc"), ("abc", ""), (None, "abc"), ("x", "y")]
    base = spark.createDataFrame([(*k, r, f"l{i}") for i, k in enumerate(values) for r in (1, 2)], "a string, b string, REVISION_ID int, v string")
    others = {n: spark.createDataFrame([(*k, r, f"{n}{i}{r}", "no") for i, k in enumerate(values[:5]) for r in (2, 3, 3)], f"a string, b string, REVISION_ID int, {n} string, v string") for n in ("cr", "bs")}
    for rank in ("all", "none", "cr"):
        out = joins.join_statements({"is": base, **others}, rank=rank, keys=key)
        assert out.columns == ["a", "b", "REVISION_ID", "v", "cr", "bs"]
        found = []
        nodes = [out._jdf.queryExecution().optimizedPlan()]
        while nodes:
            node = nodes.pop()
            nodes += [node.children().apply(i) for i in range(node.children().size())]
            if node.nodeName() == "Join":
                found.append(node.right().output().mkString(" ").split())
        assert len(found) == 2 and all({c.split("#")[0] for c in names} == {joins.HASH, joins.HASH2, n} for names, n in zip(found, ("bs", "cr")))
        matched = [r for r in out.collect() if r.cr]
        assert {(r.a, r.b, r.v[1:], r.cr[2], r.bs[2]) for r in matched} == {(*k, str(i), str(i), str(i)) for i, k in enumerate(values[:4])}
        # Revisions of the base, times the ties or rows of both others.
        assert len(matched) == 4 * {"all": 1 * 2 * 2, "none": 2 * 3 * 3, "cr": 2 * 2 * 3}[rank]
        assert sum(r.cr is None for r in out.collect()) == {"all": 2, "none": 4, "cr": 0}[rank]
