"""Time-series features and gap filling on the company panel."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ar1, impute, long_series as L, panel as P
from ..plans import features
from . import standins as D
from .catalog import plain, query, with_ctes

KEY = ["ID_BB_UNIQUE", "Year", "Quarter"]
KEY_SQL = 'ID_BB_UNIQUE, "Year", "Quarter"'
W = 'PARTITION BY ID_BB_UNIQUE ORDER BY "Year", "Quarter"'
FEATURES = ["SALES_REV_TURN", "EBITDA", "ARD_CAPITAL_EXPENDITURES"]
TARGETS = ["SALES_REV_TURN", "CF_CASH_FROM_OPER", "EBITDA", "ARD_CAPITAL_EXPENDITURES"]


def _panel(spark, folder, columns=FEATURES):
    return D.panel(spark, folder).select(*KEY, *columns)


@query(
    "lead_lag_targets",
    with_ctes(
        D.PANEL_SQL,
        select=f"SELECT {KEY_SQL}, "
        + ", ".join(f"LEAD({c}) OVER w AS {c}_lead1, LAG({c}, 4) OVER w AS {c}_last_year_same_quarter" for c in TARGETS)
        + ", CAST(LEAD(ANNOUNCEMENT_DT) OVER w AS VARCHAR) AS ANNOUNCEMENT_DT_lead1"
        + ", CAST(LEAD(LATEST_PERIOD_END_DT_FULL_RECORD) OVER w AS VARCHAR) AS LATEST_PERIOD_END_DT_FULL_RECORD_lead1"
        + ', LEAD("Year") OVER w AS "Year_lead1", LEAD("Quarter") OVER w AS "Quarter_lead1"'
        + f" FROM panel WINDOW w AS ({W}) QUALIFY row_number() OVER w < COUNT(*) OVER (PARTITION BY ID_BB_UNIQUE)",
    ),
)
def lead_lag_targets(spark, folder):
    rows = D.panel(spark, folder).select(*KEY, "ANNOUNCEMENT_DT", "LATEST_PERIOD_END_DT_FULL_RECORD", *TARGETS)
    out = P.lead_lag_targets(rows)
    return plain(out.drop("ANNOUNCEMENT_DT", "LATEST_PERIOD_END_DT_FULL_RECORD", *TARGETS))


@query(
    "lead_features",
    with_ctes(
        D.PANEL_SQL,
        f"""led AS (SELECT {KEY_SQL}, NULLIF(NOTE, 'NULL') AS NOTE, NULLIF(ARD_CAPITAL_EXPENDITURES, 0) AS capex,
            NULLIF(LEAD(ARD_CAPITAL_EXPENDITURES) OVER w, 0) AS capex_lead, NULLIF(LEAD(EBITDA) OVER w, 0) AS ebitda_lead,
            LEAD(ANNOUNCEMENT_DT) OVER w AS next_day
            FROM panel WINDOW w AS ({W}) QUALIFY row_number() OVER w < COUNT(*) OVER (PARTITION BY ID_BB_UNIQUE))""",
        select=f"""SELECT {KEY_SQL}, NOTE, capex AS ARD_CAPITAL_EXPENDITURES, capex_lead AS ARD_CAPITAL_EXPENDITURES_lead1,
                   ebitda_lead AS EBITDA_lead1, CAST(next_day AS VARCHAR) AS ANNOUNCEMENT_DT_lead1 FROM led
                   WHERE "Year" >= 1997
                     AND capex IS DISTINCT FROM (SELECT MAX(capex) FROM led WHERE "Year" >= 1997)
                     AND capex_lead IS DISTINCT FROM (SELECT MAX(capex) FROM led WHERE "Year" >= 1997)""",
    ),
)
def lead_features(spark, folder):
    rows = D.panel(spark, folder).select(
        *KEY, "NOTE", "ANNOUNCEMENT_DT", "LATEST_PERIOD_END_DT_FULL_RECORD", *TARGETS
    )
    out = features.lead_features(rows, first_year=1997)
    kept = ["NOTE", "ARD_CAPITAL_EXPENDITURES", "ARD_CAPITAL_EXPENDITURES_lead1", "EBITDA_lead1"]
    return plain(out.select(*KEY, *kept, "ANNOUNCEMENT_DT_lead1"))


@query(
    "rolling_avg",
    with_ctes(
        D.PANEL_SQL,
        select=f"SELECT {KEY_SQL}, "
        + ", ".join(
            f'AVG({c}) OVER ({W} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS "{c}(rolling_avg_3)"'
            for c in FEATURES
        )
        + " FROM panel",
    ),
)
def rolling_avg(spark, folder):
    return P.rolling_avg(_panel(spark, folder), FEATURES).drop(*FEATURES)


@query(
    "first_diff",
    with_ctes(
        D.PANEL_SQL,
        select=f"SELECT {KEY_SQL}, "
        + ", ".join(f'{c} - LAG({c}) OVER ({W}) AS "{c}(q2q_diff)"' for c in FEATURES)
        + " FROM panel",
    ),
)
def first_diff(spark, folder):
    return P.first_diff(_panel(spark, folder), FEATURES).drop(*FEATURES)


GROWN = ["SALES_REV_TURN", "ARD_CAPITAL_EXPENDITURES"]


@query(
    "growth",
    with_ctes(
        D.PANEL_SQL,
        f"f AS (SELECT {KEY_SQL}, "
        + ", ".join(f"last_value({c} IGNORE NULLS) OVER ({W} ROWS UNBOUNDED PRECEDING) AS {c}" for c in GROWN)
        + " FROM panel)",
        f"g AS (SELECT {KEY_SQL}, "
        + ", ".join(f"({c} / NULLIF(LAG({c}) OVER ({W}), 0) - 1) * 100 AS {c}" for c in GROWN)
        + " FROM f)",
        select=f"SELECT {KEY_SQL}, "
        + ", ".join(
            f'ROUND({c}, 5) AS "{c}(q2q_pct_change)", CASE WHEN {c} IS NOT NULL THEN '
            f'ROUND(product(1 + {c} / 100) OVER ({W}), 5) END AS "{c}(q2q_cumulative_growth)"'
            for c in GROWN
        )
        + " FROM g",
    ),
)
def growth(spark, folder):
    return plain(P.growth(_panel(spark, folder, GROWN), GROWN).drop(*GROWN), 5)


@query(
    "ema",
    with_ctes(
        D.PANEL_SQL,
        f"n AS MATERIALIZED (SELECT {KEY_SQL}, ARD_CAPITAL_EXPENDITURES AS x, row_number() OVER ({W}) AS rn FROM panel)",
        """e AS (SELECT ID_BB_UNIQUE, "Year", "Quarter", rn, x AS y, CAST(1 AS DOUBLE) AS w FROM n WHERE rn = 1
           UNION ALL SELECT s.ID_BB_UNIQUE, s."Year", s."Quarter", s.rn,
             CASE WHEN s.x IS NULL THEN e.y WHEN e.y IS NULL THEN s.x
                  ELSE (e.w * 0.5 * e.y + 0.5 * s.x) / (e.w * 0.5 + 0.5) END,
             CASE WHEN s.x IS NULL THEN e.w * 0.5 ELSE 1 END
           FROM n s JOIN e ON s.ID_BB_UNIQUE = e.ID_BB_UNIQUE AND s.rn = e.rn + 1)""",
        select=f'SELECT {KEY_SQL}, y AS "ARD_CAPITAL_EXPENDITURES(ema_3)" FROM e',
    ),
)
def ema(spark, folder):
    rows = _panel(spark, folder, ["ARD_CAPITAL_EXPENDITURES"])
    return P.ema(rows, ["ARD_CAPITAL_EXPENDITURES"]).drop("ARD_CAPITAL_EXPENDITURES")


def impute_sql(
    column: str,
    start: bool,
    end: bool,
    between: bool,
    name: str,
    source: str = "panel",
    series: str = "ID_BB_UNIQUE",
    order: str = '"Year", "Quarter"',
) -> list[str]:
    """CTEs that end in ``name`` (key, v): the chosen steps over one column."""
    key = f"{series}, {order}"
    x1 = "CASE WHEN p < fp THEN fv ELSE x END" if start else "x"
    x2 = (
        "CASE WHEN p > lp THEN CASE WHEN cnt = 1 THEN lv ELSE ic + sl * (p - gp - 1) END ELSE x1 END" if end else "x1"
    )
    x3 = (
        "CASE WHEN x2 IS NOT NULL THEN x2 WHEN nx IS NOT NULL THEN px + (nx - px) * (CAST(p - pp AS DOUBLE) / CAST(np - pp AS DOUBLE)) ELSE px END"
        if between
        else "x2"
    )
    g = f"PARTITION BY {series}"
    full = "ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING"
    n = name
    return [
        f"{n}0 AS (SELECT {key}, {column} AS x, row_number() OVER (PARTITION BY {series} ORDER BY {order}) AS p FROM {source})",
        f"""{n}1 AS (SELECT *, MIN(CASE WHEN x IS NOT NULL THEN p END) OVER ({g}) AS fp,
              MAX(CASE WHEN x IS NOT NULL THEN p END) OVER ({g}) AS lp,
              first_value(x IGNORE NULLS) OVER ({g} ORDER BY p {full}) AS fv,
              last_value(x IGNORE NULLS) OVER ({g} ORDER BY p {full}) AS lv FROM {n}0)""",
        f"{n}2 AS (SELECT *, {x1} AS x1 FROM {n}1)",
        f"{n}3 AS (SELECT *, COALESCE(MAX(CASE WHEN x1 IS NULL AND p < lp THEN p END) OVER ({g}), 0) AS gp FROM {n}2)",
        f"""{n}4 AS (SELECT {series}, regr_slope(x1, p - gp - 1) AS sl, regr_intercept(x1, p - gp - 1) AS ic,
              COUNT(*) AS cnt FROM {n}3 WHERE p > gp AND p <= lp GROUP BY {series})""",
        f"{n}5 AS (SELECT {n}3.*, {x2} AS x2 FROM {n}3 LEFT JOIN {n}4 USING ({series}))",
        f"""{n}6 AS (SELECT *, last_value(x2 IGNORE NULLS) OVER ({g} ORDER BY p ROWS UNBOUNDED PRECEDING) AS px,
              MAX(CASE WHEN x2 IS NOT NULL THEN p END) OVER ({g} ORDER BY p ROWS UNBOUNDED PRECEDING) AS pp,
              first_value(x2 IGNORE NULLS) OVER ({g} ORDER BY p ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nx,
              MIN(CASE WHEN x2 IS NOT NULL THEN p END) OVER ({g} ORDER BY p ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS np
              FROM {n}5)""",
        f"{n} AS (SELECT {key}, {x3} AS v FROM {n}6)",
    ]


GAPPED = ["ARD_CAPITAL_EXPENDITURES", "CF_CASH_FROM_OPER"]


def _impute(name, step, start, end, between):
    ctes = [D.PANEL_SQL]
    for i, c in enumerate(GAPPED):
        ctes += impute_sql(c, start, end, between, f"z{i}_")
    select = (
        f"SELECT {KEY_SQL}, "
        + ", ".join(f"ROUND(z{i}_.v, 3) AS {c}" for i, c in enumerate(GAPPED))
        + f" FROM z0_ JOIN z1_ USING ({KEY_SQL})"
    )

    @query(name, with_ctes(*ctes, select=select))
    def run(spark, folder):
        return plain(step(_panel(spark, folder, GAPPED), GAPPED), 3)

    return run


_impute("impute_start", impute.fill_start, True, False, False)
_impute("impute_end", impute.fill_end, False, True, False)
_impute("impute_between", impute.fill_between, False, False, True)
_impute("impute_full", impute.fill_gaps, True, True, True)


def _ar1_sql(digits):
    """The same fit, one row of each series a step: a row carries the running sums, and a gap searches phi on a grid and then the zero of its slope."""
    drift, edge = "(total - p * (total - last))", "(1 - p * p)"
    mean = f"((1 - p) * {drift} / ({edge} + (n - 1) * (1 - p) * (1 - p)))"
    rest = f"""({edge} * {mean} * {mean} + sq - 2 * p * prod + p * p * (sq - last * last)
      - 2 * {mean} * (1 - p) * {drift} + (n - 1) * (1 - p) * {mean} * (1 - p) * {mean})"""
    level = f"-0.5 * n * CASE WHEN {rest} > 0 THEN ln({rest}) ELSE -1e300 END + 0.5 * ln({edge})"
    score = f"""CASE WHEN {rest} > 0 THEN -0.5 * n * (2 * p * (sq - last * last) - 2 * prod - 2 * p * {mean} * {mean}
      + 2 * {mean} * ({drift} + (1 - p) * (total - last)) - 2 * (n - 1) * (1 - p) * {mean} * {mean}) / {rest} - p / {edge} ELSE 0 END"""
    rows = """SELECT w.id, w.col, c.k, c.x, w.origin, w.n, w.last, w.total, w.sq, w.prod,
        w.n >= 3 AND w.sq - w.total * w.total / w.n > 1e-12 * greatest(w.sq, 1e-300) AS fits,
        list_transform(range(CASE WHEN c.x IS NULL AND fits THEN 201 ELSE 0 END), lambda i: -0.999 + i * (1.998 / 200)) AS g
      FROM walk w JOIN cells c ON c.id = w.id AND c.col = w.col AND c.k = w.k + 1"""
    found = f"""SELECT * EXCLUDE (g, top, levels), greatest(top - 1.998 / 200, -0.999999) AS low, least(top + 1.998 / 200, 0.999999) AS high
      FROM (SELECT *, g[list_position(levels, list_max(levels))] AS top
        FROM (SELECT *, list_transform(g, lambda p: {level}) AS levels FROM ({rows})))"""
    for _ in range(4):
        found = f"""SELECT * EXCLUDE (g, low, high, rising), g[greatest(rising, 1)] AS low, g[least(rising + 1, 41)] AS high
          FROM (SELECT *, coalesce(nullif(list_position(list_transform(g, lambda p: {score} > 0), false), 0) - 1, 41) AS rising
            FROM (SELECT *, list_transform(range(CASE WHEN low IS NULL THEN 0 ELSE 41 END), lambda i: low + i * ((high - low) / 40)) AS g FROM ({found})))"""
    found = f"""SELECT *, CASE WHEN ends[1] > ends[2] THEN low + (high - low) * ends[1] / (ends[1] - ends[2]) ELSE low END AS p
      FROM (SELECT *, list_transform([low, high], lambda p: {score}) AS ends FROM ({found}))"""
    cells = " UNION ALL ".join(f"SELECT ID_BB_UNIQUE AS id, '{c}' AS col, row_number() OVER ({W}) AS k, CAST({c} AS DOUBLE) AS x FROM panel" for c in GAPPED)
    return "WITH RECURSIVE " + with_ctes(
        D.PANEL_SQL,
        f"cells AS ({cells})",
        f"""walk AS (
      SELECT id, col, k, x AS v, x AS origin, CASE WHEN x IS NULL THEN 0 ELSE 1 END AS n, CAST(0 AS DOUBLE) AS last,
        CAST(0 AS DOUBLE) AS total, CAST(0 AS DOUBLE) AS sq, CAST(0 AS DOUBLE) AS prod FROM cells WHERE k = 1
      UNION ALL
      SELECT id, col, k, v, coalesce(origin, v), CASE WHEN v IS NULL THEN 0 ELSE n + 1 END, coalesce(d, 0), total + coalesce(d, 0),
        sq + coalesce(d * d, 0), prod + coalesce(d * last, 0)
      FROM (SELECT *, v - coalesce(origin, v) AS d
        FROM (SELECT *, CASE WHEN x IS NOT NULL OR origin IS NULL THEN x WHEN NOT fits THEN origin + last
            ELSE origin + {mean} + p * (last - {mean}) END AS v
          FROM ({found}))))""",
        f"numbered AS (SELECT {KEY_SQL}, row_number() OVER ({W}) AS k FROM panel)",
        select=f"SELECT {KEY_SQL}, "
        + ", ".join(f"ROUND(z{i}.v, {digits}) AS {c}" for i, c in enumerate(GAPPED))
        + " FROM numbered n "
        + " ".join(f"JOIN walk z{i} ON z{i}.id = n.ID_BB_UNIQUE AND z{i}.col = '{c}' AND z{i}.k = n.k" for i, c in enumerate(GAPPED)),
    ).removeprefix("WITH ")


@query("ar1_impute", _ar1_sql(3))
def ar1_impute(spark, folder):
    return plain(ar1.ar1_fill(_panel(spark, folder, GAPPED), GAPPED), 3)


# Events of a user: an irregular series of any length, cut into spans of bounded size.
BLOCK_ROWS = 200_000


def _ticks(spark, folder, by_day=True):
    rows = D.table(spark, folder, "events").select(
        "user_id",
        "ts",
        "event_id",
        F.when(F.col("event_type") != "error", F.round(F.col("value") * 100)).alias("value"),
    )
    block = F.col("ts").cast("date") if by_day else L.time_block(rows, ["user_id"], "ts", BLOCK_ROWS)
    return rows, L.Series(("user_id",), ("ts", "event_id"), block)


TICKS_SQL = """ticks AS (SELECT user_id, ts, event_id,
  CASE WHEN event_type <> 'error' THEN ROUND(value * 100) END AS value FROM events)"""
TW = "PARTITION BY user_id ORDER BY ts, event_id"


@query(
    "long_lags",
    with_ctes(
        TICKS_SQL,
        select=f"""SELECT event_id, value - LAG(value) OVER ({TW}) AS "value(q2q_diff)" FROM ticks""",
    ),
)
def long_lags(spark, folder):
    rows, s = _ticks(spark, folder)
    return L.first_diff(rows, ["value"], s).select("event_id", "value(q2q_diff)")


@query(
    "long_offsets",
    with_ctes(
        TICKS_SQL,
        select=f"""SELECT event_id, LAG(value, 4) OVER ({TW}) AS back4, LAG(value, 1) OVER ({TW}) AS back1 FROM ticks""",
    ),
)
def long_offsets(spark, folder):
    rows, s = _ticks(spark, folder)
    return L.lags(rows, {"back4": ("value", 4), "back1": ("value", 1)}, s).select("event_id", "back4", "back1")


@query(
    "long_leads",
    with_ctes(TICKS_SQL, select=f"SELECT event_id, LEAD(value) OVER ({TW}) AS value_lead1 FROM ticks"),
)
def long_leads(spark, folder):
    rows, s = _ticks(spark, folder)
    return L.leads(rows, {"value_lead1": "value"}, s).select("event_id", "value_lead1")


@query(
    "long_rolling_avg",
    with_ctes(
        TICKS_SQL,
        select=f"""SELECT event_id, AVG(value) OVER ({TW} ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)
                   AS "value(rolling_avg_5)" FROM ticks""",
    ),
)
def long_rolling_avg(spark, folder):
    rows, s = _ticks(spark, folder, by_day=False)
    return L.rolling_avg(rows, ["value"], s, 5).select("event_id", "value(rolling_avg_5)")


@query(
    "long_even_blocks",
    with_ctes(
        TICKS_SQL,
        select=f"""SELECT event_id, value - LAG(value) OVER ({TW}) AS "value(q2q_diff)",
                   AVG(value) OVER ({TW} ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS "value(rolling_avg_5)" FROM ticks""",
    ),
)
def long_even_blocks(spark, folder):
    """Cut by sampled splitters instead of spans of time."""
    ticks, _ = _ticks(spark, folder)
    rows, s = L.even_blocks(ticks, ["user_id"], ["ts", "event_id"], 5_000)
    diffs = L.first_diff(rows, ["value"], s)
    return L.rolling_avg(diffs, ["value"], s, 5).select("event_id", "value(q2q_diff)", "value(rolling_avg_5)")


@query(
    "long_growth",
    with_ctes(
        TICKS_SQL,
        f"f AS (SELECT user_id, ts, event_id, last_value(value IGNORE NULLS) OVER ({TW} ROWS UNBOUNDED PRECEDING) AS value FROM ticks)",
        f"g AS (SELECT user_id, ts, event_id, (value / NULLIF(LAG(value) OVER ({TW}), 0) - 1) * 100 AS c FROM f)",
        select=f"""SELECT event_id, c AS "value(q2q_pct_change)",
                   CASE WHEN c IS NOT NULL THEN ROUND(product(1 + c / 100) OVER ({TW}), 9) END AS "value(q2q_cumulative_growth)"
                   FROM g""",
    ),
)
def long_growth(spark, folder):
    rows, s = _ticks(spark, folder)
    out = L.growth(rows, ["value"], s)
    return out.select(
        "event_id",
        "value(q2q_pct_change)",
        F.round("value(q2q_cumulative_growth)", 9).alias("value(q2q_cumulative_growth)"),
    )


@query(
    "long_ema",
    with_ctes(
        TICKS_SQL,
        f"n AS MATERIALIZED (SELECT user_id, event_id, value AS x, row_number() OVER ({TW}) AS rn FROM ticks)",
        """e AS (SELECT user_id, event_id, rn, x AS y, CAST(1 AS DOUBLE) AS w FROM n WHERE rn = 1
           UNION ALL SELECT s.user_id, s.event_id, s.rn,
             CASE WHEN s.x IS NULL THEN e.y WHEN e.y IS NULL THEN s.x
                  ELSE (e.w * 0.6 * e.y + 0.4 * s.x) / (e.w * 0.6 + 0.4) END,
             CASE WHEN s.x IS NULL THEN e.w * 0.6 ELSE 1 END
           FROM n s JOIN e ON s.user_id = e.user_id AND s.rn = e.rn + 1)""",
        select='SELECT event_id, ROUND(y, 5) AS "value(ema_4)" FROM e',
    ),
)
def long_ema(spark, folder):
    rows, s = _ticks(spark, folder)
    return plain(L.ema(rows, ["value"], s, 4).select("event_id", "value(ema_4)"), 5)


@query(
    "long_fill_gaps",
    with_ctes(
        TICKS_SQL,
        *impute_sql("value", True, True, True, "z", "ticks", "user_id", "ts, event_id"),
        select="SELECT event_id, ROUND(v, 4) AS value FROM z",
    ),
)
def long_fill_gaps(spark, folder):
    rows, s = _ticks(spark, folder)
    return plain(L.fill_gaps(rows, ["value"], s).select("event_id", "value"), 4)
