from __future__ import annotations

import random

import numpy as np
import pandas as pd
import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ledgerloom.functions.bits import with_bits
from ledgerloom.functions.quantiles import group_quantiles
from ledgerloom.operators import industry

NAMES = ["mean", "median", "min", "max", "std", "q1", "q3"]


def sample(spark, n=3000):
    rng = random.Random(11)
    data = []
    for i in range(n):
        # Industry "hot" has a third of all rows, many of them copies.
        ind = "hot" if i % 3 == 0 else rng.choice(["x", "y", None, "single"] if i < 4 else ["x", "y", None])
        a = 5.0 if ind == "hot" and rng.random() < 0.5 else rng.choice([None, rng.uniform(-1e6, 1e6), float(rng.randint(0, 3))])
        data.append((i, rng.choice([2000, 2001]), ind, a, None if ind == "y" else float(i)))
    return spark.createDataFrame(data, "id int, Year int, ind string, a double, b double")


def expected(pdf):
    parts = []
    for (_, ind), g in pdf.groupby(["Year", "ind"], dropna=False):
        g = g.copy()
        for c in ("a", "b"):
            v = g[c] if not pd.isna(ind) else pd.Series(dtype="float64")
            stats = [v.mean(), v.median(), v.min(), v.max(), v.std(), v.quantile(0.25), v.quantile(0.75)]
            for n, s in zip(NAMES, stats):
                g[f"{c}(ind_{n})"] = s
        parts.append(g)
    return pd.concat(parts).sort_values("id").reset_index(drop=True)


@pytest.mark.parametrize("direct_rows", [1_000_000, 300, 100, 0])
def test_industry_stats(spark, direct_rows):
    df = sample(spark).cache()
    out = industry.industry_stats(df, ["a", "b", "absent"], "ind", direct_rows=direct_rows)
    assert out.columns == ["id", "Year", "ind", "a", "b", *[f"{c}(ind_{n})" for c in ("a", "b") for n in NAMES]]
    got = out.toPandas().sort_values("id").reset_index(drop=True)
    want = expected(df.toPandas())
    for c in got.columns[5:]:
        np.testing.assert_allclose(got[c].astype(float), want[c].astype(float), rtol=1e-9, atol=1e-6)
    one = industry.industry_stats(df, ["a"], "ind", year=2000)
    assert {r.Year for r in one.select("Year").distinct().collect()} == {2000}
    assert one.count() == (want.Year == 2000).sum()


def test_quantiles_are_exact_for_any_depth(spark):
    """Down to single bits, with many copies, huge, tiny and negative values, infinities and all-missing groups."""
    rng = np.random.default_rng(2)
    data = {
        "uniform": rng.uniform(0, 1, 4001),
        "copies": np.repeat([1.0, 2.0], 2000),
        "heavy": np.exp(rng.normal(0, 8, 3000)),
        "signs": rng.normal(0, 1, 1000),
        "near": 1.0 + np.arange(3000) * 2.0**-52,
        "tiny": np.arange(-50, 50) * 5e-324,
        "huge": np.array([-np.inf, -1.7e308, -1.0, -0.0, 0.0, 1.0, 1.7e308, np.inf]),
        "two": np.array([1.0, 4.0]),
    }
    known = [(k, float(v)) for k, vs in data.items() for v in vs]
    df = spark.createDataFrame([*known, ("none", None), ("none", float("nan")), (None, 3.0), ("two", None)], "g string, v double")
    probs = (0.0, 0.1, 0.25, 0.5, 0.9, 1.0)
    for direct in (1, 60, 1_000_000):
        got = {r.g: r.v for r in group_quantiles(df, ["g"], ["v"], probs, direct).collect()}
        assert got.pop("none") is None and got.pop(None) == [3.0] * 6
        for k, vs in data.items():
            if k != "huge":
                np.testing.assert_allclose(got[k], np.quantile(vs, probs), rtol=1e-12, atol=0 if k != "tiny" else 5e-324)
        assert got["huge"][0] == -np.inf and got["huge"][3] == 0.0 and got["huge"][5] == np.inf


def test_bits_order_like_doubles(spark):
    rng = np.random.default_rng(3)
    bits = rng.integers(0, 2**63, 4000, dtype=np.int64).view(np.float64)
    edges = np.concatenate([2.0 ** np.arange(-1074.0, 1024.0), [0.0, np.inf, 5e-324, 1.7976931348623157e308]])
    near = np.concatenate([edges, np.nextafter(edges, 0), np.nextafter(edges[edges < 1e308], np.inf), bits])
    near = near[~np.isnan(near)]
    df = spark.createDataFrame(pd.DataFrame({"v": np.unique(np.concatenate([near, -near]))}))
    out = with_bits(df, {"bits": "v"}).toPandas().sort_values("v")
    exact = np.where(out.v < 0, -np.abs(out.v.to_numpy()).view(np.int64), np.abs(out.v.to_numpy()).view(np.int64))
    assert (out.bits.to_numpy() == exact).all()


def test_quantiles_read_their_input_twice(spark):
    n = 5000
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    df = spark.range(n).selectExpr("id % 3 as g", "sqrt(id) as a", "id * 0.5 as b").mapInPandas(counted, "g long, a double, b double")
    group_quantiles(df, ["g"], ["a", "b"], (0.25, 0.5, 0.75), direct_rows=1).collect()
    assert seen.value == 2 * n


def test_labels(spark):
    codes = spark.createDataFrame(
        [("A", 1, "one"), ("A", 1, "one"), ("B", 1, "uno"), ("A", 2, "two")], "level string, code long, label string"
    )
    info = spark.createDataFrame([("u", 1, 1), ("v", 9, None), ("w", 2, 5)], "ID_BB_UNIQUE string, A long, B long")
    labels = industry.label_companies(info, industry.industry_codes(codes), ["A", "B"])
    assert labels.columns == ["A_mapped", "B_mapped", "ID_BB_UNIQUE"]
    df = spark.createDataFrame([("u", 1), ("v", 2), ("w", 3), ("z", 4), (None, 5)], "ID_BB_UNIQUE string, x int")
    assert rows(industry.attach_labels(df, labels), "x") == [
        ("u", 1, "one", "uno"),
        ("v", 2, None, None),
        ("w", 3, "two", None),
        ("z", 4, None, None),
        (None, 5, None, None),
    ]
    bad = codes.union(spark.createDataFrame([("A", 1, "other")], codes.schema))
    with pytest.raises(PySparkException, match="more than one label"):
        industry.industry_codes(bad).collect()


def test_flow_labels_before_or_after(spark):
    """Labels join the settled rows, or the filings when a company is listed twice."""
    from ledgerloom.plans import features

    schema = (
        "ID_BB_UNIQUE string, FISCAL_YEAR_PERIOD string, x double, FUNDAMENTAL_UPDATE_DT date, EQY_CONSOLIDATED string, "
        "FILING_STATUS string, ACCOUNTING_STANDARD string"
    )
    filings = spark.createDataFrame(
        [("u", "2020 Q1", 1.0, None, "Y", "MR", "US GAAP"), ("v", "2020 Q1", 2.0, None, "Y", "MR", "US GAAP")], schema
    )
    codes = spark.createDataFrame([("A", 1, "one"), ("A", 2, "two")], "level string, code long, label string")
    once = spark.createDataFrame([("u", 1), ("v", 2)], "ID_BB_UNIQUE string, A long")
    twice = once.union(spark.createDataFrame([("u", 2)], once.schema))
    one = features.quarterly_panel(filings, once, codes, ["A"])
    two = features.quarterly_panel(filings, twice, codes, ["A"])
    assert one.columns == two.columns == ["Year", "ID_BB_UNIQUE", "Quarter", "x", "A_mapped"]
    assert rows(one, "ID_BB_UNIQUE") == [(2020, "u", 1, 1.0, "one"), (2020, "v", 1, 2.0, "two")]
    # Two labels and nothing to choose by: the conflict leaves no label.
    assert rows(two, "ID_BB_UNIQUE") == [(2020, "u", 1, 1.0, None), (2020, "v", 1, 2.0, "two")]
