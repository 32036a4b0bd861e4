"""Conflict resolution, industry statistics and the feature flow."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.quantiles import group_quantiles
from ..operators import clean, industry, resolve
from ..plans import features
from ..session import materialize, small_side
from ..sources import tables
from . import standins as D
from .catalog import plain, query, with_ctes
from .files import _new_folder


def cascade_sql(group: str, column: str, source: str, name: str) -> str:
    """The narrowing steps, one after the other, for one column."""
    g = f"PARTITION BY {group}"
    return f"""{name}_0 AS (
  SELECT {group}, {column} AS x, FUNDAMENTAL_UPDATE_DT AS u, EQY_CONSOLIDATED AS e,
         CASE FILING_STATUS WHEN 'MR' THEN 1 WHEN 'OR' THEN 2 WHEN 'PR' THEN 3 WHEN 'RS' THEN 4 WHEN 'ER' THEN 5 END AS f,
         CASE ACCOUNTING_STANDARD WHEN 'IAS/IFRS' THEN 1 WHEN 'US GAAP' THEN 2 END AS a
  FROM {source} WHERE {column} IS NOT NULL),
{name}_1 AS (SELECT *, COALESCE(u = MAX(u) OVER ({g}), FALSE) AS k1 FROM {name}_0),
{name}_2 AS (SELECT *, k1 AND (e = 'Y' OR NOT bool_or(k1 AND e = 'Y') OVER ({g})) AS k2 FROM {name}_1),
{name}_3 AS (SELECT *, COALESCE(k2 AND f = MIN(CASE WHEN k2 THEN f END) OVER ({g}), FALSE) AS k3 FROM {name}_2),
{name}_4 AS (SELECT *, COALESCE(k3 AND a = MIN(CASE WHEN k3 THEN a END) OVER ({g}), FALSE) AS k4 FROM {name}_3),
{name} AS (SELECT {group},
  CASE WHEN COUNT(DISTINCT x) = 1 THEN MIN(x)
       WHEN COUNT(DISTINCT x) FILTER (k1) = 1 THEN MIN(x) FILTER (k1)
       WHEN COUNT(DISTINCT x) FILTER (k2) = 1 THEN MIN(x) FILTER (k2)
       WHEN COUNT(DISTINCT x) FILTER (k3) = 1 THEN MIN(x) FILTER (k3)
       WHEN COUNT(DISTINCT x) FILTER (k4) = 1 THEN MIN(x) FILTER (k4) END AS v
  FROM {name}_4 GROUP BY {group})"""


def resolved_sql(group: str, columns: list[str], source: str) -> tuple[list[str], str, str]:
    """CTEs, select list and from clause of the resolved table."""
    ctes = [cascade_sql(group, c, source, f"r{i}") for i, c in enumerate(columns)]
    joined = f"(SELECT DISTINCT {group} FROM {source}) b"
    for i in range(len(columns)):
        joined += f" LEFT JOIN r{i} USING ({group})"
    return ctes, ", ".join(f"r{i}.v AS {c}" for i, c in enumerate(columns)), joined


MEASURES = ["SALES_REV_TURN", "CF_CASH_FROM_OPER", "EBITDA", "ARD_CAPITAL_EXPENDITURES"]

Q_SOURCE = """q AS (SELECT *, CAST(substr(FISCAL_YEAR_PERIOD, 1, 4) AS INTEGER) AS "Year",
  CAST(substr(FISCAL_YEAR_PERIOD, 7, 1) AS INTEGER) AS "Quarter" FROM filings)"""
A_SOURCE = 'q AS (SELECT *, CAST(substr(FISCAL_YEAR_PERIOD, 1, 4) AS INTEGER) AS "Year" FROM filings)'

_Q = resolved_sql('"Year", ID_BB_UNIQUE, "Quarter"', [*MEASURES, "EQY_FUND_CRNCY", "ANNOUNCEMENT_DT"], "q")
_A = resolved_sql('"Year", ID_BB_UNIQUE', MEASURES, "q")


RESOLVE_QUARTERLY_SQL = with_ctes(
    D.FILINGS_SQL,
    Q_SOURCE,
    *_Q[0],
    select='SELECT "Year", ID_BB_UNIQUE, "Quarter", ' + _Q[1].replace("r5.v AS", "CAST(r5.v AS VARCHAR) AS") + f" FROM {_Q[2]}",
)


def resolved_quarterly(spark, folder, form=None):
    """Settled filings; ``form`` turns each date column into the spelling in which it arrives."""
    rows = D.filings(spark, folder)
    if form is not None:
        dates = ["LATEST_PERIOD_END_DT_FULL_RECORD", "ANNOUNCEMENT_DT", "FUNDAMENTAL_UPDATE_DT"]
        rows = rows.withColumns({c: form(F.col(c)) for c in dates})
    rows = clean.quarterly_rows(rows).drop("LATEST_PERIOD_END_DT_FULL_RECORD", "REVISION_ID")
    return plain(resolve.resolve_quarterly(rows))


@query("resolve_quarterly", RESOLVE_QUARTERLY_SQL)
def resolve_quarterly(spark, folder):
    return resolved_quarterly(spark, folder)


@query(
    "resolve_annual",
    with_ctes(D.FILINGS_SQL, A_SOURCE, *_A[0], select=f'SELECT "Year", ID_BB_UNIQUE, {_A[1]} FROM {_A[2]}'),
)
def resolve_annual(spark, folder):
    rows = D.filings(spark, folder).withColumn(
        "FISCAL_YEAR_PERIOD", F.concat(F.substring("FISCAL_YEAR_PERIOD", 1, 4), F.lit(" A"))
    )
    kept = clean.annual_rows(rows).drop(
        "LATEST_PERIOD_END_DT_FULL_RECORD", "REVISION_ID", "EQY_FUND_CRNCY", "ANNOUNCEMENT_DT"
    )
    return plain(resolve.resolve_annual(kept))


_LEAD_COLUMNS = ", ".join(
    f"LEAD(NULLIF({c}, 0)) OVER w AS {c}_lead1, LAG(NULLIF({c}, 0), 4) OVER w AS {c}_last_year_same_quarter"
    for c in MEASURES
)
_M = resolved_sql('"Year", ID_BB_UNIQUE, "Quarter"', [*MEASURES, "ANNOUNCEMENT_DT", "sector"], "q")


MODEL_INPUT_SQL = with_ctes(
    D.FILINGS_SQL,
    D.INFO_SQL,
    'q AS (SELECT f.*, "INDUSTRY_SECTOR_NUM_mapped" AS sector, CAST(substr(FISCAL_YEAR_PERIOD, 1, 4) AS INTEGER) AS "Year", '
    'CAST(substr(FISCAL_YEAR_PERIOD, 7, 1) AS INTEGER) AS "Quarter" FROM filings f LEFT JOIN labels USING (ID_BB_UNIQUE))',
    *_M[0],
    f'settled AS (SELECT "Year", ID_BB_UNIQUE, "Quarter", {_M[1]} FROM {_M[2]})',
    f"""led AS (SELECT "Year", ID_BB_UNIQUE, "Quarter", sector, {", ".join(f"NULLIF({c}, 0) AS {c}" for c in MEASURES)},
          {_LEAD_COLUMNS}, LEAD(ANNOUNCEMENT_DT) OVER w AS ANNOUNCEMENT_DT_lead1, LEAD("Year") OVER w AS "Year_lead1"
        FROM settled WINDOW w AS (PARTITION BY ID_BB_UNIQUE ORDER BY "Year", "Quarter")
        QUALIFY row_number() OVER w < COUNT(*) OVER (PARTITION BY ID_BB_UNIQUE))""",
    select="""SELECT * REPLACE (CAST(ANNOUNCEMENT_DT_lead1 AS VARCHAR) AS ANNOUNCEMENT_DT_lead1) FROM led
              WHERE "Year" >= 1990
              AND ARD_CAPITAL_EXPENDITURES IS DISTINCT FROM (SELECT MAX(ARD_CAPITAL_EXPENDITURES) FROM led)
              AND ARD_CAPITAL_EXPENDITURES_lead1 IS DISTINCT FROM (SELECT MAX(ARD_CAPITAL_EXPENDITURES) FROM led)""",
)


@query("model_input", MODEL_INPUT_SQL)
def model_input(spark, folder):
    out = features.model_input(
        spark, D.filings(spark, folder), D.company_info(spark, folder), D.code_rows(spark, folder)
    )
    return plain(
        out.select(
            "Year",
            "ID_BB_UNIQUE",
            "Quarter",
            F.col("INDUSTRY_SECTOR_NUM_mapped").alias("sector"),
            *MEASURES,
            *[f"{c}_{s}" for c in MEASURES for s in ("lead1", "last_year_same_quarter")],
            "ANNOUNCEMENT_DT_lead1",
            "Year_lead1",
        )
    )


@query("final_csv", MODEL_INPUT_SQL)
def final_csv(spark, folder):
    """The feature table by way of its CSV file."""
    path = _new_folder(spark, "model-input")
    features.write_model_input(
        spark, D.filings(spark, folder), D.company_info(spark, folder), D.code_rows(spark, folder), path
    )
    later = [f"{c}_{x}" for c in MEASURES for x in ("lead1", "last_year_same_quarter")]
    numbers = dict.fromkeys([*MEASURES, *later], "double") | dict.fromkeys(["Year", "Quarter", "Year_lead1"], "int")
    out = tables.read_csv(spark, path, {**numbers, "ANNOUNCEMENT_DT_lead1": "date"})
    sector = F.col("INDUSTRY_SECTOR_NUM_mapped").alias("sector")
    return plain(out.select("Year", "ID_BB_UNIQUE", "Quarter", sector, *MEASURES, *later, "ANNOUNCEMENT_DT_lead1", "Year_lead1"))


STATS = ["SALES_REV_TURN", "ARD_CAPITAL_EXPENDITURES"]
_STAT_SQL = {
    "mean": "AVG({c})",
    "median": "quantile_cont({c}, 0.5)",
    "min": "MIN({c})",
    "max": "MAX({c})",
    "std": "stddev_samp({c})",
    "q1": "quantile_cont({c}, 0.25)",
    "q3": "quantile_cont({c}, 0.75)",
}


@query(
    "industry_stats",
    with_ctes(
        D.PANEL_SQL,
        D.INFO_SQL,
        'x AS (SELECT p.*, "Industry_level_5_num_mapped" AS industry FROM panel p LEFT JOIN labels USING (ID_BB_UNIQUE))',
        'st AS (SELECT "Year", industry, '
        + ", ".join(f'{f.format(c=c)} AS "{c}_{n}"' for c in STATS for n, f in _STAT_SQL.items())
        + ' FROM x WHERE industry IS NOT NULL GROUP BY "Year", industry)',
        select='SELECT x.ID_BB_UNIQUE, x."Year", x."Quarter", x.industry, '
        + ", ".join(f'ROUND(st."{c}_{n}", 2) AS "{c}(industry_{n})"' for c in STATS for n in _STAT_SQL)
        + ' FROM x LEFT JOIN st ON x."Year" = st."Year" AND x.industry = st.industry',
    ),
)
def industry_stats(spark, folder):
    codes = small_side(industry.industry_codes(D.code_rows(spark, folder)))
    labels = small_side(industry.label_companies(D.company_info(spark, folder), codes, ["Industry_level_5_num"]))
    rows = D.panel(spark, folder).select("ID_BB_UNIQUE", "Year", "Quarter", *STATS)
    # The panel feeds three steps, so it is written once.
    labelled = materialize(
        industry.attach_labels(rows, labels).withColumnRenamed("Industry_level_5_num_mapped", "industry")
    )
    return plain(industry.industry_stats(labelled, STATS, "industry").drop(*STATS), 2)


@query(
    "large_group_quantiles",
    """SELECT l_returnflag,
              ROUND(quantile_cont(l_extendedprice, 0.25), 4) AS price_q1, ROUND(quantile_cont(l_extendedprice, 0.5), 4) AS price_median,
              ROUND(quantile_cont(l_extendedprice, 0.75), 4) AS price_q3,
              quantile_cont(l_quantity, 0.25) AS quantity_q1, quantile_cont(l_quantity, 0.5) AS quantity_median,
              quantile_cont(l_quantity, 0.75) AS quantity_q3
       FROM lineitem GROUP BY l_returnflag""",
)
def large_group_quantiles(spark, folder):
    columns = ["l_extendedprice", "l_quantity"]
    rows = D.table(spark, folder, "lineitem").select("l_returnflag", *columns)
    q = group_quantiles(rows, ["l_returnflag"], columns, (0.25, 0.5, 0.75), direct_rows=1000)
    names = ("q1", "median", "q3")
    return plain(
        q.select(
            "l_returnflag",
            *[F.col("l_extendedprice")[j].alias(f"price_{n}") for j, n in enumerate(names)],
            *[F.col("l_quantity")[j].alias(f"quantity_{n}") for j, n in enumerate(names)],
        ),
        4,
    )
