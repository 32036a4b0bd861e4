from __future__ import annotations

import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from ledgerloom import keys as K
from ledgerloom.functions import cross, scalar as S
from ledgerloom.operators import clean
from ledgerloom.plans import features


def test_sentinels_keep_null(spark):
    df = spark.createDataFrame([("", "x"), (None, ""), ("b", None)], "ID_BB_COMPANY string, FILING_STATUS string")
    out = clean.replace_empty(df, {c: K.EMPTY_SENTINELS[c] for c in df.columns})
    assert rows(out) == [("-1", "x"), (None, "Unknown"), ("b", None)]


def test_dates(spark):
    df = spark.createDataFrame([("20200131",), ("99999999",), ("",), (None,)], "ANNOUNCEMENT_DT string")
    assert [r[0] for r in rows(clean.parse_dates(df))] == [datetime.date(2020, 1, 31), None, None, None]
    assert clean.parse_dates(df, ["absent"]).columns == df.columns
    iso = spark.createDataFrame([("2020-01-31",), (" ",)], "ANNOUNCEMENT_DT string")
    assert [r[0] for r in rows(clean.parse_dates(iso))] == [datetime.date(2020, 1, 31), None]
    number = spark.createDataFrame([(20200131,), (99999999,), (None,)], "ANNOUNCEMENT_DT int")
    assert [r[0] for r in rows(clean.parse_dates(number))] == [datetime.date(2020, 1, 31), None, None]
    with pytest.raises(Exception, match="not a date"):
        clean.parse_dates(spark.createDataFrame([("soon",)], "ANNOUNCEMENT_DT string")).collect()


def test_numbers(spark):
    df = spark.createDataFrame([("10",), ("10.0",), (" ",), (None,)], "c string")
    assert [r[0] for r in rows(df.select(S.parse_number("c", "long")))] == [10, 10, None, None]
    for bad in ("10.5", "ten"):
        with pytest.raises(Exception, match="not a long"):
            spark.createDataFrame([(bad,)], "c string").select(S.parse_number("c", "long")).collect()


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (2.0,)], "v double")
    assert rows(clean.missing_fractions(df)) == [(0.5,)]


def test_periods(spark):
    df = spark.createDataFrame(
        [("2023 A",), ("2023 Q1",), ("FY 2021 Q4 x",), ("A",), ("99999999",), (None,)], "FISCAL_YEAR_PERIOD string"
    )
    assert rows(clean.annual_rows(df)) == [("2023 A", 2023)]
    assert rows(clean.quarterly_rows(df)) == [("2023 Q1", 2023, 1), ("FY 2021 Q4 x", 2021, 4)]
    assert [r[0] for r in rows(df.select(S.fiscal_year("FISCAL_YEAR_PERIOD")))] == [2023, 2023, 2021, None, 9999, None]


def test_nan_and_token(spark):
    df = spark.createDataFrame([(float("nan"), "N.A."), (1.0, "N.A.x"), (None, "")], "v double, s string")
    assert rows(df.select(S.null_nan("v"), S.null_token("s"))) == [(None, None), (1.0, "N.A.x"), (None, "")]


def test_blank_to_null(spark):
    df = spark.createDataFrame(
        [(0, 0.0, "0", "NULL", datetime.date(2020, 1, 1)), (1, 2.0, "", "x", None)],
        "i int, d double, s string, t string, day date",
    )
    assert rows(clean.blank_to_null(df), "d") == [
        (None, None, "0", None, datetime.date(2020, 1, 1)),
        (1, 2.0, "", "x", None),
    ]


def test_drop_peak(spark):
    df = spark.createDataFrame([(1, 5.0, 1.0), (2, 1.0, 5.0), (3, None, 1.0), (4, 2.0, None), (5, 6.0, 0.0)], "k int, a double, b double")
    assert [r[0] for r in rows(clean.drop_peak(df, "a", ["b"]), "k")] == [1, 2, 3, 4]
    nulls = spark.createDataFrame([(1, None, 1.0)], df.schema)
    assert clean.drop_peak(nulls, "a", ["b"]).count() == 1
    plan = clean.drop_peak(df, "a", ["b"])._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_mark_sparse(spark):
    df = spark.createDataFrame(
        [(i, 1.0 if i == 0 else None, 1.0 if i < 2 else None, "x" if i == 0 else None) for i in range(10)],
        "k int, rare double, edge double, t string",
    )
    out = clean.mark_sparse(df)
    assert out.schema == df.schema or [f.dataType for f in out.schema] == [f.dataType for f in df.schema]
    got = rows(out, "k")
    # Exactly 0.8 missing is not above the threshold.
    assert {r[1] for r in got} == {0.0} and {r[2] for r in got} == {1.0, None} and {r[3] for r in got} == {"0"}
    assert {r[1] for r in rows(clean.mark_sparse(df, fill=None))} == {None}
    share = clean.missing_fractions(df).first()
    assert share.rare == pytest.approx(0.9) and share.k == 0


def test_column_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`A` int, `A.1` int, `B.x` int")
    assert clean.drop_suffixed(df).columns == ["A", "B.x"]
    twice = df.select("A", "A")
    assert clean.repeated_columns(twice) == {"A": 2}
    with pytest.raises(ValueError):
        clean.require_unique_columns(twice)


def test_union_and_counts(spark):
    a = spark.createDataFrame([(1, "x")], "k int, s string")
    b = spark.createDataFrame([(2.0, 2), (2.0, 2)], "v double, k int")
    out = clean.union_all([a, b])
    assert sorted(rows(out), key=str) == [(1, "x", None), (2, None, 2.0), (2, None, 2.0)]
    assert rows(clean.row_counts(out, "k"), "k") == [(1, 1), (2, 2)]
    assert clean.preview(out, 2).count() == 2


def test_common_filings(spark):
    day = datetime.date
    base = ("MR", "Y", "US GAAP", day(2019, 6, 30), "2019 Q2")
    data = [base, ("OR", *base[1:]), (*base[:3], day(2019, 1, 1), "2019 Q1"), (*base[:4], "2019 Q5")]
    df = spark.createDataFrame(data, f"{K.FILING_STATUS} string, {K.CONSOLIDATED} string, {K.ACCOUNTING} string, {K.PERIOD_END} date, {K.FISCAL_PERIOD} string")
    assert rows(clean.common_filings(df)) == [base]


def test_sorted_output_puts_null_last(spark):
    df = spark.createDataFrame([("b", 2), ("a", None), ("c", 1)], "id string, d int")
    assert [r[0] for r in clean.sort_for_output(df, "d", ["id"]).collect()] == ["c", "b", "a"]


def test_cross_features(spark):
    df = spark.createDataFrame([(6.0, 2.0, 0.0), (-1.0, None, 4.0)], "a double, b double, c double")
    out = cross.interactions(df, ["a", "b", "c"])
    assert out.columns == ["a", "b", "c", "a/b", "a*b", "a/c", "a*c", "b/c", "b*c"]
    assert rows(out) == [
        (6.0, 2.0, 0.0, 3.0, 12.0, None, 0.0, None, 0.0),
        (-1.0, None, 4.0, None, None, -0.25, -4.0, None, None),
    ]
    logs = rows(cross.log_features(df, ["a", "c"]).select("a(log)", "c(log)"))
    assert logs[0][0] == pytest.approx(1.791759469) and logs[0][1] is None and logs[1][0] is None


def test_lead_features_order_of_steps(spark):
    """Blanks become NULL after shifting, the peak is taken after the year floor."""
    data = [
        ("a", 1980, 1, 99.0, None),
        ("a", 1991, 1, 5.0, None),
        ("a", 1991, 2, 0.0, None),
        ("a", 1991, 3, 7.0, None),
        ("a", 1991, 4, 1.0, None),
        ("b", 1995, 1, 3.0, None),
        ("b", 1995, 2, 7.0, None),
        ("b", 1995, 3, 4.0, None),
        ("b", 1995, 4, 50.0, None),
    ]
    df = spark.createDataFrame(data, "ID_BB_UNIQUE string, Year int, Quarter int, v double, ANNOUNCEMENT_DT date")
    df = df.withColumn(K.PERIOD_END, F.col("ANNOUNCEMENT_DT"))
    out = features.lead_features(df, ["v"], peak="v")
    got = rows(out.select("ID_BB_UNIQUE", "Year", "Quarter", "v", "v_lead1"), "ID_BB_UNIQUE", "Year", "Quarter")
    # The peak among rows with a successor from 1990 on is 7.
    assert got == [("a", 1991, 1, 5.0, None), ("b", 1995, 3, 4.0, 50.0)]
