from __future__ import annotations

import datetime
import random

import pandas as pd
from conftest import rows

from ledgerloom import keys as K
from ledgerloom.operators import resolve

FIELDS = ["FUNDAMENTAL_UPDATE_DT", "EQY_CONSOLIDATED", "FILING_STATUS", "ACCOUNTING_STANDARD"]
STATUS = {"MR": 1, "OR": 2, "PR": 3, "RS": 4, "ER": 5}
STANDARD = {"IAS/IFRS": 1, "US GAAP": 2}


def brute(filings):
    """Narrow the filings step by step; filings are (x, update, consolidated, status, standard)."""
    left = [f for f in filings if f[0] is not None]

    def decided(fs):
        return len({f[0] for f in fs}) == 1

    if not left:
        return None
    if decided(left):
        return left[0][0]
    dates = [f[1] for f in left if f[1] is not None]
    left = [f for f in left if dates and f[1] == max(dates)]
    if decided(left):
        return left[0][0]
    left = [f for f in left if f[2] == "Y"] or left
    if decided(left):
        return left[0][0]
    for at, table in ((3, STATUS), (4, STANDARD)):
        known = [table[f[at]] for f in left if f[at] in table]
        left = [f for f in left if known and table.get(f[at]) == min(known)]
        if decided(left):
            return left[0][0]
    return None


def test_random_groups(spark):
    rng = random.Random(7)
    days = [None, datetime.date(2020, 1, 1), datetime.date(2020, 2, 1)]
    data, want = [], {}
    for g in range(3000):
        group = [
            (
                rng.choice([None, 1.0, 2.0, 3.0]),
                rng.choice(days),
                rng.choice(["Y", "N", None]),
                rng.choice(["MR", "OR", "PR", "RS", "ER", "zz", None]),
                rng.choice(["IAS/IFRS", "US GAAP", "other", None]),
            )
            for _ in range(rng.randint(1, 5))
        ]
        want[f"c{g}"] = brute(group)
        data += [(f"c{g}", 2020, *f, str(f[0])) for f in group]
    schema = "ID_BB_UNIQUE string, Year int, x double, FUNDAMENTAL_UPDATE_DT date, EQY_CONSOLIDATED string, FILING_STATUS string, ACCOUNTING_STANDARD string, t string"
    df = spark.createDataFrame(data, schema)
    got = {r.ID_BB_UNIQUE: r.x for r in resolve.resolve(df, ["Year", "ID_BB_UNIQUE"], ["x"]).collect()}
    assert got == want
    assert sum(v is None for v in want.values()) > 100


def test_groups_without_key_are_left_out(spark):
    df = spark.createDataFrame(
        [("a", 2020, 1.0), (None, 2020, 2.0), ("b", None, 3.0)], "ID_BB_UNIQUE string, Year int, x double"
    )
    for c in FIELDS:
        df = df.selectExpr("*", f"cast(null as {'date' if c == FIELDS[0] else 'string'}) as {c}")
    out = resolve.resolve_annual(df)
    assert out.columns == ["Year", "ID_BB_UNIQUE", "x"]
    assert rows(out) == [(2020, "a", 1.0)]


def test_quarterly_columns(spark):
    names = ["ID_BB_UNIQUE", "Year", "Quarter", "TICKER", "x", "FUNDAMENTAL_ENTRY_DT", "ANNOUNCEMENT_DT", *FIELDS]
    df = spark.createDataFrame(
        [("a", 2020, 1, "T", 1.0, None, None, None, "Y", "MR", "US GAAP")],
        "ID_BB_UNIQUE string, Year int, Quarter int, TICKER string, x double, FUNDAMENTAL_ENTRY_DT date, "
        "ANNOUNCEMENT_DT date, FUNDAMENTAL_UPDATE_DT date, EQY_CONSOLIDATED string, FILING_STATUS string, "
        "ACCOUNTING_STANDARD string",
    )
    assert df.columns == names
    assert resolve.resolve_quarterly(df).columns == [
        "Year",
        "ID_BB_UNIQUE",
        "Quarter",
        "x",
        "FUNDAMENTAL_ENTRY_DT",
        "ANNOUNCEMENT_DT",
    ]


def test_one_exchange(spark):
    df = spark.range(10).selectExpr(
        "'a' as ID_BB_UNIQUE", "2020 as Year", "cast(id as double) x", "current_date() as FUNDAMENTAL_UPDATE_DT",
        "'Y' as EQY_CONSOLIDATED", "'MR' as FILING_STATUS", "'US GAAP' as ACCOUNTING_STANDARD",
    )
    plan = resolve.resolve_annual(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_min" in plan and "Python" not in plan


def test_numbers_and_dates_are_hashed(spark):
    """300 measures without a sort; a text is settled like the others."""
    base = spark.range(60).selectExpr(
        "cast(id % 4 as string) as ID_BB_UNIQUE", "2020 as Year", "id", "date_add(date'2020-01-01', cast(id % 3 as int)) as FUNDAMENTAL_UPDATE_DT",
        "'Y' as EQY_CONSOLIDATED", "'MR' as FILING_STATUS", "'US GAAP' as ACCOUNTING_STANDARD",
    )
    df = base.selectExpr("*", *[f"cast(id % {i % 7 + 1} as double) as m{i}" for i in range(300)]).drop("id")
    out = resolve.resolve_annual(df)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan
    got = {r.ID_BB_UNIQUE: r for r in out.collect()}
    for k in range(4):
        last = [i for i in range(60) if i % 4 == k and i % 3 == 2]
        for m in (0, 1, 2, 6, 299):
            values = {float(i % (m % 7 + 1)) for i in last}
            assert got[str(k)][f"m{m}"] == (values.pop() if len(values) == 1 else None)


def test_any_type_is_settled(spark):
    """Equal and different values of every kind, of the best rank and of others."""
    kinds = {
        "boolean": ("true", "false"), "int": ("-5", "7"), "long": (str(-(2**63)), str(2**63 - 1)), "float": ("1.5", "1.25"),
        "double": ("1e300", "1.0000000000000002e300"), "date": ("1000-01-01", "9999-12-31"), "string": ("a", "b"),
        "timestamp": ("2020-01-01 00:00:00.000001", "2020-01-01 00:00:00"), "timestamp_ntz": ("1969-12-31 23:59:59.999999", "1969-12-31 23:59:59"),
        "decimal(18,4)": ("1.0001", "1.0002"), "decimal(38,4)": ("1.0001", "1.0002"),
    }
    # Group 1 agrees on the best rank, group 2 does not, group 3 has one value, group 4 has none.
    data = [(1, 5, 0), (1, 5, 0), (1, 6, 1), (2, 5, 0), (2, 5, 1), (3, 9, 1), (3, 1, None), (4, 2, None)]
    values = [f"cast(case which when 0 then '{a}' when 1 then '{b}' end as {k}) as c{i}" for i, (k, (a, b)) in enumerate(kinds.items())]
    df = spark.createDataFrame(data, "g int, r long, which int").selectExpr("g", "r", *values)
    got = {r.g: r for r in resolve.resolve(df, ["g"], [c for c in df.columns if c[0] == "c"], df.r).collect()}
    want = df.where("g = 1 and r = 5").first(), df.where("g = 3 and r = 9").first()
    for i in range(len(kinds)):
        assert got[1][f"c{i}"] == want[0][f"c{i}"] is not None and got[3][f"c{i}"] == want[1][f"c{i}"] is not None
        assert got[2][f"c{i}"] is None and got[4][f"c{i}"] is None


def test_priorities_are_total():
    assert K.FILING_PRIORITY == STATUS and K.ACCOUNTING_PRIORITY == STANDARD
    assert pd.Series(K.QUARTERLY_UNRESOLVED).is_unique
