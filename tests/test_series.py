"""Series operators against pandas and plain loops, for the panel and the block-wise forms."""

from __future__ import annotations

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window, functions as F

from ledgerloom.operators import ar1, impute, long_series as L, panel as P

SPECIAL = [
    [None, 2.0, None, None, 4.0, 0.0, 3.0],
    [None, None, None],
    [None, 5.0, None],
    [5.0],
    [None],
    [1.0, 2.0, 4.0, None, None],
    [None, None, 3.0, 4.0, None, None],
    [1.0, None, 3.0, None, None, 9.0, None],
    [0.0, 1.0, 0.0, -2.0, None, 3.0],
    [7.0, 7.0, 7.0, 7.0, None, 7.0],
]


def random_series(count, seed, zero=True):
    rng = random.Random(seed)
    out = []
    for _ in range(count):
        low = 0 if zero else 1
        out.append([rng.choice([None, float(rng.randint(low, 9)), rng.uniform(-5, 5)]) for _ in range(rng.randint(1, 14))])
    return out


SERIES = SPECIAL + random_series(200, 1)


@pytest.fixture(scope="module")
def frame(spark):
    data = [(f"c{i}", 2000 + t // 4, t % 4 + 1, v) for i, s in enumerate(SERIES) for t, v in enumerate(s)]
    data.append((None, 2000, 1, 1.0))
    return spark.createDataFrame(data, "ID_BB_UNIQUE string, Year int, Quarter int, v double").repartition(5).cache()


def blocks(kind="year"):
    by = {"year": F.col("Year"), "one": F.col("Year") * 10 + F.col("Quarter"), "all": F.lit(1)}[kind]
    return L.Series(("ID_BB_UNIQUE",), ("Year", "Quarter"), by)


def collect(df, column):
    got = df.orderBy("ID_BB_UNIQUE", "Year", "Quarter").select("ID_BB_UNIQUE", column).toPandas()
    by_id = {k: g[column].to_list() for k, g in got.groupby("ID_BB_UNIQUE")}
    assert len(by_id) == len(SERIES) and got["ID_BB_UNIQUE"].notna().all()
    return [by_id[f"c{i}"] for i in range(len(SERIES))]


def same(got, want, tolerance=1e-9):
    for s, g, w in zip(SERIES, got, want):
        assert len(g) == len(w)
        for a, b in zip(g, w):
            a = math.nan if a is None else a
            b = math.nan if b is None else b
            assert (a != a and b != b) or math.isclose(a, b, rel_tol=tolerance, abs_tol=tolerance), (s, list(g), list(w))


def by_pandas(fn):
    return [fn(pd.Series(s, dtype="float64")).to_list() for s in SERIES]


FORMS = ["panel", "year", "one", "all"]


@pytest.mark.parametrize("form", FORMS)
def test_rolling(frame, form):
    for n in (1, 3, 5):
        df = P.rolling_avg(frame, ["v"], n) if form == "panel" else L.rolling_avg(frame, ["v"], blocks(form), n)
        same(collect(df, f"v(rolling_avg_{n})"), by_pandas(lambda s: s.rolling(n, min_periods=1).mean()))


@pytest.mark.parametrize("form", FORMS)
def test_diff(frame, form):
    df = P.first_diff(frame, ["v"]) if form == "panel" else L.first_diff(frame, ["v"], blocks(form))
    same(collect(df, "v(q2q_diff)"), by_pandas(lambda s: s.diff()))


@pytest.mark.parametrize("form", FORMS)
def test_ema(frame, form):
    for span in (3, 6):
        df = P.ema(frame, ["v"], span) if form == "panel" else L.ema(frame, ["v"], blocks(form), span)
        assert df.columns == [*frame.columns, f"v(ema_{span})"]
        same(collect(df, f"v(ema_{span})"), by_pandas(lambda s: s.ewm(span=span, adjust=False).mean()))


def test_ema_example(spark):
    data = [("a", 2000, i, v) for i, v in enumerate([None, 2.0, None, None, 4.0, 0.0, 3.0])]
    df = P.ema(spark.createDataFrame(data, "ID_BB_UNIQUE string, Year int, Quarter int, v double"), ["v"])
    got = [r[0] for r in df.orderBy("Quarter").select("v(ema_3)").collect()]
    assert got[0] is None and np.allclose(got[1:], [2, 2, 2, 3.6, 1.8, 2.4])


def growth_by_loop(s):
    """Percent change against the padded previous value; a change from 0 is missing and skipped."""
    change, level, before, running = [], [], None, 1.0
    for v in s:
        now = before if v is None else v
        step = None if before in (None, 0.0) or now is None else (now / before - 1) * 100
        if step is not None:
            running *= 1 + step / 100
        change.append(step)
        level.append(None if step is None else running)
        before = now
    return change, level


@pytest.mark.parametrize("form", FORMS)
def test_growth(frame, form):
    df = P.growth(frame, ["v"]) if form == "panel" else L.growth(frame, ["v"], blocks(form))
    want = [growth_by_loop(s) for s in SERIES]
    same(collect(df, "v(q2q_pct_change)"), [w[0] for w in want])
    same(collect(df, "v(q2q_cumulative_growth)"), [w[1] for w in want])
    assert not [c for c in df.columns if c.startswith("__")]


@pytest.mark.parametrize("form", ["year", "one", "all"])
def test_offsets(frame, form):
    df = L.lags(frame, {"b1": ("v", 1), "b4": ("v", 4)}, blocks(form))
    same(collect(df, "b1"), by_pandas(lambda s: s.shift(1)))
    same(collect(df, "b4"), by_pandas(lambda s: s.shift(4)))
    same(collect(L.leads(frame, {"n": "v"}, blocks(form)), "n"), by_pandas(lambda s: s.shift(-1)))


def test_lead_lag_targets(frame):
    out = P.lead_lag_targets(frame, ["v"], ["Year", "Quarter"])
    got = out.orderBy("ID_BB_UNIQUE", "Year", "Quarter").toPandas()
    for i, s in enumerate(SERIES):
        part = got[got.ID_BB_UNIQUE == f"c{i}"]
        plain = pd.Series(s, dtype="float64")
        assert len(part) == len(s) - 1
        pd.testing.assert_series_equal(part.v_lead1.reset_index(drop=True), plain.shift(-1)[:-1], check_names=False)
        pd.testing.assert_series_equal(
            part.v_last_year_same_quarter.reset_index(drop=True), plain.shift(4)[:-1], check_names=False
        )
    assert {"Year_lead1", "Quarter_lead1"} <= set(out.columns)


def start_by_loop(s):
    known = [v for v in s if v is not None]
    lead = next((i for i, v in enumerate(s) if v is not None), 0)
    return [known[0]] * lead + s[lead:] if known else list(s)


def end_by_loop(s):
    at = [i for i, v in enumerate(s) if v is not None]
    if not at or at[-1] == len(s) - 1:
        return list(s)
    last = at[-1]
    first = last
    while first > 0 and s[first - 1] is not None:
        first -= 1
    y = s[first : last + 1]
    if len(y) == 1:
        return s[: last + 1] + [y[0]] * (len(s) - 1 - last)
    slope, level = np.polyfit(np.arange(len(y)), y, 1)
    return s[: last + 1] + [level + slope * (i - first) for i in range(last + 1, len(s))]


def between_by_pandas(s):
    return [None if v != v else v for v in pd.Series(s, dtype="float64").interpolate(method="linear").to_list()]


def test_fill_start(frame):
    same(collect(impute.fill_start(frame, ["v"]), "v"), [start_by_loop(s) for s in SERIES])


def test_fill_end(frame):
    same(collect(impute.fill_end(frame, ["v"]), "v"), [end_by_loop(s) for s in SERIES], 1e-7)


def test_fill_between(frame):
    same(collect(impute.fill_between(frame, ["v"]), "v"), [between_by_pandas(s) for s in SERIES])


@pytest.mark.parametrize("form", FORMS)
def test_fill_gaps(frame, form):
    df = impute.fill_gaps(frame, ["v"]) if form == "panel" else L.fill_gaps(frame, ["v"], blocks(form))
    assert df.columns == frame.columns
    same(collect(df, "v"), [between_by_pandas(end_by_loop(start_by_loop(s))) for s in SERIES], 1e-7)


def test_fill_gaps_except(frame):
    df = frame.withColumn("keep", F.col("v"))
    out = impute.fill_gaps_except(df, ["keep"])
    same(collect(out, "keep"), SERIES)
    same(collect(out, "v"), [between_by_pandas(end_by_loop(start_by_loop(s))) for s in SERIES], 1e-7)


def test_series_need_a_key(frame):
    with pytest.raises(ValueError):
        impute.fill_gaps(frame, ["v"], partition_by=[])


def test_one_exchange_one_sort(frame):
    base = frame.sparkSession.range(10).selectExpr(
        "'a' ID_BB_UNIQUE", "2000 Year", "cast(id as int) Quarter", "cast(id as double) v"
    )
    for df in (impute.fill_gaps(base, ["v"]), P.growth(base, ["v"]), P.rolling_avg(base, ["v"])):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and plan.count("Sort ") == 1 and "Python" not in plan


# AR(1)


def dense_loglik(y, phi, c, s2):
    """Gaussian likelihood with the full covariance matrix."""
    n = len(y)
    cov = s2 / (1 - phi**2) * phi ** np.abs(np.subtract.outer(np.arange(n), np.arange(n)))
    r = np.asarray(y) - c
    return -0.5 * (n * math.log(2 * math.pi) + np.linalg.slogdet(cov)[1] + r @ np.linalg.solve(cov, r))


def test_ar1_fit_maximises_dense_likelihood():
    rng = np.random.default_rng(5)
    for phi in (-0.6, 0.2, 0.8):
        y = [3.0]
        for _ in range(40):
            y.append(2 + phi * (y[-1] - 2) + rng.normal())
        fit = ar1.RunningFit(y[0])
        fit.extend(np.array(y[1:15]))
        fit.extend(np.array(y[15:]))
        level, mean = fit._profile(np.linspace(-0.99, 0.99, 199))
        best = []
        for p, m in zip(np.linspace(-0.99, 0.99, 199), mean):
            c = m + fit.origin
            e = np.array(y[1:]) - c - p * (np.array(y[:-1]) - c)
            s2 = ((1 - p**2) * (y[0] - c) ** 2 + e @ e) / len(y)
            best.append(dense_loglik(y, p, c, s2))
            # The profiled mean is the best one for this phi.
            assert best[-1] >= max(dense_loglik(y, p, c + d, s2) for d in (-0.01, 0.01)) - 1e-9
        assert np.allclose(level - level[0], np.array(best) - best[0], atol=1e-6)
        p = np.linspace(-0.99, 0.99, 199)[int(np.argmax(best))]
        m = mean[int(np.argmax(best))] + fit.origin
        assert abs(fit.forecast() - (m + p * (y[-1] - m))) < 0.05


def ar1_by_loop(s):
    out = list(s)
    for i, v in enumerate(out):
        known = [x for x in out[:i] if x is not None]
        if v is None and known:
            fit = ar1.RunningFit(known[0])
            if len(known) > 1:
                fit.extend(np.array(known[1:]))
            out[i] = fit.forecast()
    return out


def test_ar1_fill(frame, conf):
    want = [ar1_by_loop(s) for s in SERIES]
    same(collect(ar1.ar1_fill(frame, ["v"]), "v"), want, 1e-6)
    conf("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    same(collect(ar1.ar1_fill(frame, ["v"]), "v"), want, 1e-6)


def test_long_ema_across_batches(frame, conf):
    conf("spark.sql.execution.arrow.maxRecordsPerBatch", 2)
    same(collect(L.ema(frame, ["v"], blocks("year")), "v(ema_3)"), by_pandas(lambda s: s.ewm(span=3, adjust=False).mean()))


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date"])
def test_time_block(spark, kind):
    step = "interval 1 day" if kind == "date" else "interval 7 minutes"
    df = spark.range(400).selectExpr(
        "if(id % 3 = 0, 'hot', cast(id as string)) as ID_BB_UNIQUE",
        f"cast(timestamp'2024-03-30 20:00:00' + {step} * id as {kind}) as ts",
        "if(id % 7 = 0, null, cast(id % 11 as double)) as v",
    )
    for rows in (1000, 40, 10, 2):
        if kind == "date" and rows == 1000:
            assert "31536000" in str(L.time_block(df, ["ID_BB_UNIQUE"], "ts", rows))
        block = L.time_block(df, ["ID_BB_UNIQUE"], "ts", rows)
        largest = df.groupBy("ID_BB_UNIQUE", block).count().agg(F.max("count")).first()[0]
        assert largest <= rows
    s = L.Series(("ID_BB_UNIQUE",), ("ts",), block)
    got = L.rolling_avg(df, ["v"], s, 4).where("ID_BB_UNIQUE = 'hot'").orderBy("ts").toPandas()
    want = got.v.rolling(4, min_periods=1).mean()
    np.testing.assert_allclose(got["v(rolling_avg_4)"].astype(float), want)
    with pytest.raises(ValueError, match="within one second"):
        L.time_block(df.selectExpr("'a' as k", f"cast('2024-01-01' as {kind}) as ts"), ["k"], "ts", 1)


def test_a_burst_is_cut_evenly(spark):
    """A series with nearly all rows in one instant, next to sparse ones."""
    n = 20_000
    df = spark.range(n).selectExpr(
        "if(id < 18000, 'burst', cast(id % 50 as string)) as ID_BB_UNIQUE",
        "if(id < 18000, timestamp'2024-01-01 00:00:00', timestamp'2024-01-01 00:00:00' + interval 1 hour * id) as ts",
        "id",
        "if(id % 7 = 0, null, cast(id % 11 as double)) as v",
    )
    rows_, s = L.even_blocks(df, ["ID_BB_UNIQUE"], ["ts", "id"], rows=2_000)
    sizes = rows_.groupBy("ID_BB_UNIQUE", L.DEPTH).count().agg(F.max("count")).first()[0]
    assert sizes <= 2_000 and rows_.count() == n
    # Blocks never decrease along a series.
    w = Window.partitionBy("ID_BB_UNIQUE").orderBy("ts", "id")
    assert rows_.withColumn("before", F.lag(L.DEPTH).over(w)).where(f"before > {L.DEPTH}").isEmpty()
    got = L.rolling_avg(rows_, ["v"], s, 4).where("ID_BB_UNIQUE = 'burst'").orderBy("id").toPandas()
    np.testing.assert_allclose(got["v(rolling_avg_4)"].astype(float), got.v.rolling(4, min_periods=1).mean())


def test_ema_of_a_long_company(spark):
    """40,000 rows of one company in pieces; the same recursion as in pandas."""
    df = spark.range(40_000).selectExpr("'u' as ID_BB_UNIQUE", "cast(id as int) as Year", "1 as Quarter", "if(id % 5 = 3, null, sin(id)) as v")
    got = P.ema(df, ["v"], 3).orderBy("Year").toPandas()
    np.testing.assert_allclose(got["v(ema_3)"].astype(float), got.v.ewm(span=3, adjust=False).mean())
