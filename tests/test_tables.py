from __future__ import annotations

import datetime
from types import SimpleNamespace

import pytest
from conftest import rows

from ledgerloom import keys as K
from ledgerloom.plans import features, statements as flows
from ledgerloom.sources import sinks, tables


def test_csv_keeps_first_of_repeated_names(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('A,B,A,"C,x",B.1,D.2.3\n1,b,2,c,3,4\n,,9,,8,7\n')
    df = tables.read_csv(spark, str(path), {"A": "int"})
    assert df.columns == ["A", "B", "C,x"]
    assert rows(df) == [(1, "b", "c"), (None, None, None)]
    inferred = tables.read_csv(spark, str(path))
    assert dict(inferred.dtypes)["A"] == "int" and inferred.count() == 2


def test_csv_headers_in_any_order(spark, tmp_path):
    """Columns are found by name in each file: swapped, missing, repeated, quoted, and behind a byte order mark."""
    (tmp_path / "a.csv").write_text('A,B,"C,x"\n1,b1,c1\n2,b2,c2\n')
    (tmp_path / "b.csv").write_text('"C,x",D,A,A\nc3,d3,3,9\n')
    (tmp_path / "c.csv").write_text("\ufeffB,A\nb4,4\nb5\n")
    (tmp_path / "d.csv").write_text('A,B,"C,x"\n6,b6,\n')
    df = tables.read_csv(spark, str(tmp_path / "[bcd].csv"), {"A": "int"})
    assert df.columns == ["C,x", "D", "A", "B"]
    assert rows(df, "A") == [(None, None, None, "b5"), ("c3", "d3", 3, None), (None, None, 4, "b4"), (None, None, 6, "b6")]
    names = ["a.csv", "b.csv"]
    inferred = tables.read_csv(spark, [str(tmp_path / n) for n in names])
    assert dict(inferred.dtypes)["A"] == "int" and inferred.columns == ["A", "B", "C,x", "D"]
    assert rows(inferred.where("A = 3")) == [(3, None, "c3", "d3")]
    same = tables.read_csv(spark, [str(tmp_path / n) for n in ("d.csv", "d.csv")], {})
    assert rows(same) == [("6", "b6", None)] * 2


def test_headers_are_found_without_sorting_lines(spark, tmp_path, monkeypatch):
    plans, write = [], tables.stored

    def stored(df, name):
        plans.append(df._jdf.queryExecution().sparkPlan().toString())
        return write(df, name)

    monkeypatch.setattr(tables, "stored", stored)
    for name, text in {"a.csv": "\ufeffB,A\n1,2\nB,A\n", "b.csv": "A\n" + "0\n" * 5000, "c.csv": "", "d.csv": "\nA\n"}.items():
        (tmp_path / name).write_text(text)
    headers = tables.csv_headers(spark, str(tmp_path))
    plans.append(headers._jdf.queryExecution().sparkPlan().toString())
    assert sorted((r.file[-5:], r.line) for r in headers.collect()) == [("a.csv", "B,A"), ("b.csv", "A"), ("d.csv", "")]
    assert not any("Sort" in plan for plan in plans)


def test_company_info_and_codes(spark, tmp_path):
    info = tmp_path / "info.csv"
    info.write_text("ID_BB_UNIQUE," + ",".join(K.INDUSTRY_COLUMNS) + "\nu,1,2.0,3,4,5,\n")
    df, columns = tables.read_company_info(spark, str(info))
    assert columns == K.INDUSTRY_COLUMNS and rows(df.select(*columns)) == [(1, 2, 3, 4, 5, None)]
    info.write_text("ID_BB_UNIQUE," + ",".join(K.INDUSTRY_COLUMNS) + "\nu,1,2,3,4,5,x\n")
    with pytest.raises(Exception, match="not a long"):
        tables.read_company_info(spark, str(info))[0].collect()
    codes = tmp_path / "codes.csv"
    codes.write_text("level,code,label\nA,1,one\n")
    assert rows(tables.read_industry_codes(spark, str(codes))) == [("A", 1, "one")]


def test_csv_null_and_empty(spark, tmp_path):
    df = spark.createDataFrame([("v", None), ("", "z")], "a string, b string")
    path = str(tmp_path / "out")
    assert sinks.write_csv(df, path, single_file=True)
    text = next((tmp_path / "out").glob("part-*.csv")).read_text().splitlines()
    assert text == ["a,b", r"v,\N", r"\N,z"]


def test_empty_frames_are_skipped(spark, tmp_path):
    df = spark.createDataFrame([], "a int")
    with pytest.warns(UserWarning, match="nothing to write"):
        assert not sinks.write_parquet(df, str(tmp_path / "p"))
    with pytest.warns(UserWarning):
        assert sinks.write_csv_by_type({"bs": df}, str(tmp_path)) == {}
    assert not (tmp_path / "p").exists()


def test_by_type_paths(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "a int")
    day = datetime.datetime(2025, 5, 20, 1, 2, 3)
    assert sinks.write_by_type({"bs": df}, str(tmp_path), day.date()) == {
        "bs": f"{tmp_path}/fundamentals_bs_20250520.parquet"
    }
    assert sinks.write_csv_by_type({"cf": df}, str(tmp_path), day) == {
        "cf": f"{tmp_path}/fundamentals_cf_20250520_010203"
    }


def test_sinks_run_their_input_once(spark, tmp_path):
    """No look for a first row before the write; an empty result leaves what was there."""
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    df = spark.range(100).mapInPandas(counted, "id long")
    many, few = df.groupBy("id").count(), df.where("id < 0").groupBy("id").count()
    writes = [
        lambda f: sinks.write_parquet(f, str(tmp_path / "p")),
        lambda f: sinks.write_parquet(f, str(tmp_path / "q"), partition_by=["count"]),
        lambda f: sinks.write_csv(f, str(tmp_path / "c")),
        lambda f: sinks.write_csv(f, str(tmp_path / "s"), single_file=True),
        lambda f: bool(sinks.write_by_type({"bs": f}, str(tmp_path / "t"))),
        lambda f: bool(sinks.write_csv_by_type({"bs": f}, str(tmp_path / "u"))),
    ]
    for write in writes:
        seen.value = 0
        assert write(many) and seen.value == 100
        with pytest.warns(UserWarning, match="nothing to write"):
            assert not write(few)
        assert seen.value == 200
    assert spark.read.parquet(str(tmp_path / "p")).count() == spark.read.parquet(str(tmp_path / "q")).count() == 100
    assert sorted(p.name for p in tmp_path.iterdir()) == ["c", "p", "q", "s", "t", "u"]
    assert sinks.write_parquet(many.where("id < 5"), str(tmp_path / "p")) and spark.read.parquet(str(tmp_path / "p")).count() == 5


def test_two_writers_of_one_registry(spark, tmp_path):
    """Both find an id missing and add it; readers see it once."""
    path = str(tmp_path / "registry")
    entries = sinks.registry_rows(spark.createDataFrame([("/in/fundamentals_n1_bs.out", ["A", "B"])], "path string, colnames array<string>"))
    assert sinks.append_registry(spark, entries, path).count() == 1
    assert sinks.append_registry(spark, entries, path).count() == 0
    entries.write.mode("append").parquet(path)
    got = sinks.read_registry(spark, path)
    assert spark.read.parquet(path).count() == 2 and [r.colnames for r in got.collect()] == [["A", "B"]]
    assert sinks.read_registry(spark, str(tmp_path / "none")).count() == 0


def test_repeated_columns_are_not_written(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(ValueError):
        sinks.write_parquet(df.select("a", "a"), str(tmp_path / "x"))


def test_statements_scan_is_pruned(spark, tmp_path):
    path = str(tmp_path / "is")
    df = spark.createDataFrame(
        [("a", datetime.date(2000, 1, 1), 1.0), ("b", datetime.date(2000, 1, 1), 2.0), ("a", datetime.date(1990, 1, 1), 3.0)],
        f"{K.COMPANY} string, {K.PERIOD_END} date, v double",
    )
    df.withColumn("unused", df.v).write.parquet(path)
    companies = spark.createDataFrame([("a",)], f"{K.COMPANY} string")
    out = tables.read_statements(spark, path, "is", companies, "1995-01-01", "2025-06-30").select("is.v")
    assert rows(out) == [(1.0,)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(LATEST_PERIOD_END_DT_FULL_RECORD" in plan and "unused" not in plan.split("ReadSchema")[1][:200]


class Recorder:
    """Stands in for a session: records what would be asked of the JDBC source."""

    def __init__(self):
        self.calls = []
        self.read = SimpleNamespace(jdbc=lambda *a, **k: self.calls.append((a, k)))


def test_jdbc_options():
    spark = Recorder()
    tables.read_jdbc(spark, "jdbc:x", "t", properties={"user": "u"})
    tables.read_jdbc(spark, "jdbc:x", "t", column="id")
    assert spark.calls[0] == (("jdbc:x", "t"), {"properties": {"fetchsize": "1000", "user": "u"}})
    assert spark.calls[1][1] == {
        "column": "id",
        "lowerBound": 100000,
        "upperBound": 999999,
        "numPartitions": 5,
        "properties": {"fetchsize": "1000"},
    }
    written = []
    frame = SimpleNamespace(write=SimpleNamespace(jdbc=lambda *a: written.append(a)))
    sinks.write_jdbc(frame, "jdbc:x", "t", properties={"user": "u"})
    assert written == [("jdbc:x", "t", "append", {"user": "u"})]


def test_staging_tables(spark):
    spark.createDataFrame([("a", 1), ("b", 2)], f"{K.COMPANY} string, v int").createOrReplaceTempView("stage_is")
    companies = spark.createDataFrame([("b",)], f"{K.COMPANY} string")
    got = tables.staging_tables(spark, {"is": "stage_is"}, companies)
    assert rows(got["is"]) == [("b", 2)]


def statement(spark, data, name, extra=""):
    cols = ", ".join(f"{k} {'date' if k == K.PERIOD_END else 'string'}" for k in K.RECORD_KEYS)
    return spark.createDataFrame(data, f"{cols}, {name} double{extra}")


def test_export_flows(spark, tmp_path):
    day = datetime.date(2020, 3, 31)
    key = tuple(day if k == K.PERIOD_END else {"FISCAL_YEAR_PERIOD": "2020 Q1"}.get(k, "c") for k in K.RECORD_KEYS)
    info = spark.createDataFrame([("c", 10)], "ID_BB_COMPANY string, BICS_LEVEL_1 int")
    meta = ", SECURITY_DESCRIPTION string"
    base = statement(spark, [(*key, 1.0, "sec")], "EBITDA", meta)
    names = [c.split(".")[1] for c in K.JOINED_COLUMNS if c.startswith("bs.")]
    bs = statement(spark, [(*key, 2.0)], "IS_EPS").selectExpr("*", *[f"cast('2020-05-01' as string) as {c}" for c in names])
    rest = statement(spark, [(*key, 3.0)], "ARD_TOTAL_REVENUES").selectExpr(
        "*", "4D as CF_CASH_FROM_OPER", "5D as ARD_CAPITAL_EXPENDITURES"
    )
    out = str(tmp_path / "joined")
    assert flows.export_selected(spark, {"is": base, "bs": bs, "cf": rest}, info, out, K.ALL_SECTORS, "1995-01-01", "2025-06-30")
    back = spark.read.parquet(out)
    assert set(back.columns) == {c.split(".")[-1] for c in K.JOINED_COLUMNS}
    assert back.first().IS_EPS == 2.0 and back.first().BICS_LEVEL_1 == 10

    tagged = base.selectExpr("*", "1L as REVISION_ID")
    assert flows.export_latest(spark, {"is": tagged}, info, str(tmp_path / "csv"), 10, "1995-01-01", "2025-01-01", single_file=True)
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 1


def test_model_input_file(spark, tmp_path):
    schema = (
        "ID_BB_UNIQUE string, FISCAL_YEAR_PERIOD string, ANNOUNCEMENT_DT string, LATEST_PERIOD_END_DT_FULL_RECORD string, "
        "FUNDAMENTAL_UPDATE_DT date, EQY_CONSOLIDATED string, FILING_STATUS string, ACCOUNTING_STANDARD string, "
        + ", ".join(f"{c} double" for c in K.TARGET_COLUMNS)
    )
    data = [
        ("u", f"2020 Q{q}", f"20200{q}01", f"20200{q}28", None, "Y", "MR", "US GAAP", 1.0 * q, 2.0, 0.0, 5.0 - q)
        for q in (1, 2, 3, 4)
    ]
    filings = spark.createDataFrame(data, schema)
    info = spark.createDataFrame([("u", *[1] * 6)], "ID_BB_UNIQUE string, " + ", ".join(f"{c} long" for c in K.INDUSTRY_COLUMNS))
    codes = spark.createDataFrame([(K.INDUSTRY_COLUMNS[0], 1, "Tech")], "level string, code long, label string")
    features.write_model_input(spark, filings, info, codes, str(tmp_path / "out"))
    got = spark.read.option("header", True).csv(str(tmp_path / "out")).collect()
    # Quarter 1 holds the peak, quarter 4 has no successor.
    assert [(r.Quarter, r.SALES_REV_TURN_lead1, r.ANNOUNCEMENT_DT_lead1) for r in got] == [
        ("2", "3.0", "2020-03-01"),
        ("3", "4.0", "2020-04-01"),
    ]
    assert got[0].INDUSTRY_SECTOR_NUM_mapped == "Tech" and got[0].EBITDA is None
