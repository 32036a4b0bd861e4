"""Predicates, null handling, scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import cross, scalar as S
from ..operators import clean
from . import standins as D
from .catalog import plain, query, with_ctes

PERIOD_SQL = """p AS (
  SELECT o_orderkey, o_totalprice,
         CASE WHEN o_orderstatus = 'F' THEN CAST(year(o_orderdate) AS VARCHAR) || ' A'
              WHEN o_orderstatus = 'O' THEN CAST(year(o_orderdate) AS VARCHAR) || ' Q' || CAST(quarter(o_orderdate) AS VARCHAR)
              ELSE '' END AS FISCAL_YEAR_PERIOD,
         CASE WHEN o_orderpriority = '5-LOW' THEN '' WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '99999999'
              ELSE strftime(o_orderdate, '%Y%m%d') END AS day_text
  FROM orders)"""


def _periods(spark, folder):
    day = F.col("o_orderdate").cast("date")
    year = F.year(day).cast("string")
    return D.table(spark, folder, "orders").select(
        "o_orderkey",
        "o_totalprice",
        F.when(F.col("o_orderstatus") == "F", F.concat(year, F.lit(" A")))
        .when(F.col("o_orderstatus") == "O", F.concat(year, F.lit(" Q"), F.quarter(day).cast("string")))
        .otherwise("")
        .alias("FISCAL_YEAR_PERIOD"),
        F.when(F.col("o_orderpriority") == "5-LOW", "")
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "99999999")
        .otherwise(F.date_format(day, "yyyyMMdd"))
        .alias("day_text"),
    )


@query(
    "period_parse",
    with_ctes(
        PERIOD_SQL,
        select="""SELECT o_orderkey, FISCAL_YEAR_PERIOD,
                  CAST(NULLIF(regexp_extract(FISCAL_YEAR_PERIOD, '(\\d{4})', 1), '') AS VARCHAR) AS year_text,
                  CAST(NULLIF(regexp_extract(FISCAL_YEAR_PERIOD, 'Q(\\d)', 1), '') AS VARCHAR) AS quarter_text,
                  CAST(CAST(try_strptime(day_text, '%Y%m%d') AS DATE) AS VARCHAR) AS day FROM p""",
    ),
)
def period_parse(spark, folder):
    rows = _periods(spark, folder)
    return plain(
        rows.select(
            "o_orderkey",
            "FISCAL_YEAR_PERIOD",
            S.fiscal_year("FISCAL_YEAR_PERIOD").cast("string").alias("year_text"),
            S.fiscal_quarter("FISCAL_YEAR_PERIOD").cast("string").alias("quarter_text"),
            S.parse_date("day_text").alias("day"),
        )
    )


@query(
    "annual_filter",
    with_ctes(
        PERIOD_SQL,
        select="""SELECT o_orderkey, o_totalprice, FISCAL_YEAR_PERIOD,
                  CAST(CAST(try_strptime(day_text, '%Y%m%d') AS DATE) AS VARCHAR) AS FUNDAMENTAL_UPDATE_DT,
                  CAST(substr(FISCAL_YEAR_PERIOD, 1, 4) AS INTEGER) AS "Year"
                  FROM p WHERE FISCAL_YEAR_PERIOD LIKE '% A'""",
    ),
)
def annual_filter(spark, folder):
    rows = _periods(spark, folder).withColumnRenamed("day_text", "FUNDAMENTAL_UPDATE_DT")
    return plain(clean.annual_rows(rows))


@query(
    "quarterly_filter",
    with_ctes(
        PERIOD_SQL,
        select="""SELECT o_orderkey, o_totalprice, FISCAL_YEAR_PERIOD,
                  CAST(CAST(try_strptime(day_text, '%Y%m%d') AS DATE) AS VARCHAR) AS ANNOUNCEMENT_DT,
                  CAST(substr(FISCAL_YEAR_PERIOD, 1, 4) AS INTEGER) AS "Year",
                  CAST(substr(FISCAL_YEAR_PERIOD, 7, 1) AS INTEGER) AS "Quarter"
                  FROM p WHERE FISCAL_YEAR_PERIOD LIKE '% Q%'""",
    ),
)
def quarterly_filter(spark, folder):
    rows = _periods(spark, folder).withColumnRenamed("day_text", "ANNOUNCEMENT_DT")
    return plain(clean.quarterly_rows(rows))


@query(
    "sentinels_and_dates",
    """SELECT o_orderkey,
              CASE WHEN o_orderstatus = 'P' THEN '-1' ELSE CAST(o_custkey AS VARCHAR) END AS ID_BB_COMPANY,
              CASE WHEN o_orderstatus = 'O' THEN '99999999' ELSE CAST(year(o_orderdate) AS VARCHAR) || ' A' END
                AS FISCAL_YEAR_PERIOD,
              CASE WHEN o_orderpriority = '5-LOW' THEN 'Unknown' WHEN o_orderpriority = '1-URGENT' THEN NULL
                   ELSE o_orderpriority END AS FILING_STATUS,
              CASE WHEN o_orderstatus = 'F' THEN 'Unknown' ELSE 'Y' END AS EQY_CONSOLIDATED,
              CASE WHEN o_orderpriority = '2-HIGH' THEN 'Unknown' ELSE 'US GAAP' END AS ACCOUNTING_STANDARD,
              CASE WHEN o_orderpriority <> '3-MEDIUM' THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END
                AS LATEST_PERIOD_END_DT_FULL_RECORD
       FROM orders""",
)
def sentinels_and_dates(spark, folder):
    o = D.table(spark, folder, "orders")
    day = F.col("o_orderdate").cast("date")
    status, level = F.col("o_orderstatus"), F.col("o_orderpriority")
    raw = o.select(
        "o_orderkey",
        F.when(status == "P", "").otherwise(F.col("o_custkey").cast("string")).alias("ID_BB_COMPANY"),
        F.when(status == "O", "").otherwise(F.concat(F.year(day).cast("string"), F.lit(" A"))).alias(
            "FISCAL_YEAR_PERIOD"
        ),
        F.when(level == "5-LOW", "").when(level != "1-URGENT", level).alias("FILING_STATUS"),
        F.when(status == "F", "").otherwise("Y").alias("EQY_CONSOLIDATED"),
        F.when(level == "2-HIGH", "").otherwise("US GAAP").alias("ACCOUNTING_STANDARD"),
        F.when(level == "3-MEDIUM", "").otherwise(F.date_format(day, "yyyyMMdd")).alias(
            "LATEST_PERIOD_END_DT_FULL_RECORD"
        ),
    )
    return plain(clean.clean_statements(raw))


@query(
    "token_nulls",
    """SELECT event_id, NULLIF(event_type, 'view') AS event_type, NULLIF(value, 0) AS value FROM events""",
)
def token_nulls(spark, folder):
    rows = D.table(spark, folder, "events")
    return rows.select("event_id", S.null_token("event_type", "view").alias("event_type"), F.nullif("value", F.lit(0.0)).alias("value"))


@query(
    "blank_to_null",
    with_ctes(
        D.PANEL_SQL,
        select="""SELECT ID_BB_UNIQUE, "Year", "Quarter", NULLIF(NOTE, 'NULL') AS NOTE,
                  NULLIF(BIG_COUNT, 0) AS BIG_COUNT, NULLIF(EBITDA, 0) AS EBITDA FROM panel""",
    ),
)
def blank_to_null(spark, folder):
    rows = D.panel(spark, folder).select("ID_BB_UNIQUE", "Year", "Quarter", "NOTE", "BIG_COUNT", "EBITDA")
    return clean.blank_to_null(rows)


@query(
    "year_floor",
    with_ctes(D.PANEL_SQL, select='SELECT ID_BB_UNIQUE, "Year", "Quarter", EBITDA FROM panel WHERE "Year" >= 1998'),
)
def year_floor(spark, folder):
    return clean.year_from(D.panel(spark, folder), 1998).select("ID_BB_UNIQUE", "Year", "Quarter", "EBITDA")


@query(
    "outlier_removal",
    with_ctes(
        D.PANEL_SQL,
        select="""SELECT ID_BB_UNIQUE, "Year", "Quarter", ARD_CAPITAL_EXPENDITURES, CF_CASH_FROM_OPER FROM panel
                  WHERE ARD_CAPITAL_EXPENDITURES IS DISTINCT FROM (SELECT MAX(ARD_CAPITAL_EXPENDITURES) FROM panel)
                    AND CF_CASH_FROM_OPER IS DISTINCT FROM (SELECT MAX(ARD_CAPITAL_EXPENDITURES) FROM panel)""",
    ),
)
def outlier_removal(spark, folder):
    rows = D.panel(spark, folder).select(
        "ID_BB_UNIQUE", "Year", "Quarter", "ARD_CAPITAL_EXPENDITURES", "CF_CASH_FROM_OPER"
    )
    return clean.drop_peak(rows, "ARD_CAPITAL_EXPENDITURES", ["CF_CASH_FROM_OPER"])


SPARSE = ["SALES_REV_TURN", "CF_CASH_FROM_OPER", "ARD_CAPITAL_EXPENDITURES", "RARE_ITEM"]


@query(
    "missing_fractions",
    with_ctes(
        D.PANEL_SQL,
        select="SELECT " + ", ".join(f"ROUND(AVG(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END), 9) AS {c}" for c in SPARSE) + " FROM panel",
    ),
)
def missing_fractions(spark, folder):
    return plain(clean.missing_fractions(D.panel(spark, folder), SPARSE), 9)


@query(
    "mark_sparse",
    with_ctes(
        D.PANEL_SQL,
        "share AS (SELECT "
        + ", ".join(f"AVG(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) AS {c}" for c in SPARSE)
        + " FROM panel)",
        select='SELECT ID_BB_UNIQUE, "Year", "Quarter", '
        + ", ".join(f"CASE WHEN share.{c} > 0.8 THEN 0.0 ELSE panel.{c} END AS {c}" for c in SPARSE)
        + " FROM panel, share",
    ),
)
def mark_sparse(spark, folder):
    rows = D.panel(spark, folder).select("ID_BB_UNIQUE", "Year", "Quarter", *SPARSE)
    return clean.mark_sparse(rows, 0.8, SPARSE)


@query(
    "log_features",
    with_ctes(
        D.PANEL_SQL,
        select="""SELECT ID_BB_UNIQUE, "Year", "Quarter",
                  ROUND(CASE WHEN SALES_REV_TURN > 0 THEN ln(SALES_REV_TURN) END, 9) AS "SALES_REV_TURN(log)",
                  ROUND(CASE WHEN EBITDA > 0 THEN ln(EBITDA) END, 9) AS "EBITDA(log)" FROM panel""",
    ),
)
def log_features(spark, folder):
    rows = cross.log_features(D.panel(spark, folder), ["SALES_REV_TURN", "EBITDA"])
    return plain(rows.select("ID_BB_UNIQUE", "Year", "Quarter", "SALES_REV_TURN(log)", "EBITDA(log)"), 9)


CROSSED = ["SALES_REV_TURN", "ARD_CAPITAL_EXPENDITURES", "BIG_COUNT"]


@query(
    "interactions",
    with_ctes(
        D.PANEL_SQL,
        select='SELECT ID_BB_UNIQUE, "Year", "Quarter", '
        + ", ".join(
            f'{a} / NULLIF({b}, 0) AS "{a}/{b}", {a} * {b} AS "{a}*{b}"'
            for a, b in (
                ("SALES_REV_TURN", "ARD_CAPITAL_EXPENDITURES"),
                ("SALES_REV_TURN", "BIG_COUNT"),
                ("ARD_CAPITAL_EXPENDITURES", "BIG_COUNT"),
            )
        )
        + " FROM panel",
    ),
)
def interactions(spark, folder):
    rows = cross.interactions(D.panel(spark, folder).select("ID_BB_UNIQUE", "Year", "Quarter", *CROSSED), CROSSED)
    return rows.drop(*CROSSED)


FILE_SQL = """f AS (
  SELECT c_custkey, c_mktsegment,
         CASE c_mktsegment WHEN 'AUTOMOBILE' THEN '/in/fundamentals_n' || c_nationkey || '_bs.out.' || c_custkey
              WHEN 'BUILDING' THEN 'x/fundamentals_n' || c_nationkey || '_sard_is_history.out'
              WHEN 'FURNITURE' THEN 'fundamentals_n' || c_nationkey || '_cf_history.out.' || c_custkey
              WHEN 'HOUSEHOLD' THEN 'a/b/FUNDAMENTALS_N' || c_nationkey || '_CR2.OUT'
              ELSE c_name || '.txt' END AS path
  FROM customer)"""


@query(
    "file_identity",
    with_ctes(
        FILE_SQL,
        select="""SELECT c_custkey, regexp_extract(path, '[^/]+$', 0) AS base,
           CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE') THEN regexp_extract(path, 's_(n[0-9]+)_', 1)
                WHEN c_mktsegment = 'HOUSEHOLD' THEN regexp_extract(path, 'S_(N[0-9]+)_', 1) ELSE 'Unknown' END AS region,
           CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'bs' WHEN 'BUILDING' THEN 'sard_is' WHEN 'FURNITURE' THEN 'cf_history'
                WHEN 'HOUSEHOLD' THEN 'CR2' ELSE 'Unknown' END AS file_type FROM f""",
    ),
)
def file_identity(spark, folder):
    n, k, seg = F.col("c_nationkey").cast("string"), F.col("c_custkey").cast("string"), F.col("c_mktsegment")
    path = (
        F.when(seg == "AUTOMOBILE", F.concat(F.lit("/in/fundamentals_n"), n, F.lit("_bs.out."), k))
        .when(seg == "BUILDING", F.concat(F.lit("x/fundamentals_n"), n, F.lit("_sard_is_history.out")))
        .when(seg == "FURNITURE", F.concat(F.lit("fundamentals_n"), n, F.lit("_cf_history.out."), k))
        .when(seg == "HOUSEHOLD", F.concat(F.lit("a/b/FUNDAMENTALS_N"), n, F.lit("_CR2.OUT")))
        .otherwise(F.concat("c_name", F.lit(".txt")))
    )
    rows = D.table(spark, folder, "customer").select("c_custkey", path.alias("path"))
    return rows.select(
        "c_custkey",
        S.base_name("path").alias("base"),
        S.file_region("path").alias("region"),
        S.file_type("path").alias("file_type"),
    )


@query(
    "sorted_output",
    with_ctes(
        D.PANEL_SQL,
        select="""SELECT ID_BB_UNIQUE, "Year", "Quarter", CAST(ANNOUNCEMENT_DT AS VARCHAR) AS ANNOUNCEMENT_DT, EBITDA
                  FROM panel ORDER BY ANNOUNCEMENT_DT, ID_BB_UNIQUE, "Year", "Quarter" LIMIT 50""",
    ),
)
def sorted_output(spark, folder):
    rows = D.panel(spark, folder).select("ID_BB_UNIQUE", "Year", "Quarter", "ANNOUNCEMENT_DT", "EBITDA")
    return plain(clean.preview(clean.sort_for_output(rows, "ANNOUNCEMENT_DT"), 50))
