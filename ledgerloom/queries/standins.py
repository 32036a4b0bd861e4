"""Fundamentals-shaped views of the given tables.

A supplier is a company, a ship-date quarter is a fiscal period, a line item is a filing with
conflicting variants, and nation and region are industry levels.  Every view reads the whole table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import stored

STATEMENT_NAMES = ["is", "cr", "cr2", "cf", "bs", "sard_bs", "sard_is", "sard_cf"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def money(c: str | Column) -> Column:
    """Exact cents, so that sums do not depend on order."""
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(18,2)")


def quarter_end(day: Column) -> Column:
    return F.last_day(F.make_date(F.year(day), F.quarter(day) * 3, F.lit(1)))


def filings(spark: SparkSession, folder: str) -> DataFrame:
    """One row per line item: record key, revision, update date and measures with gaps."""
    day = F.col("l_shipdate").cast("date")
    price = F.col("l_extendedprice")
    return table(spark, folder, "lineitem").select(
        quarter_end(day).alias("LATEST_PERIOD_END_DT_FULL_RECORD"),
        F.col("l_suppkey").cast("string").alias("ID_BB_COMPANY"),
        F.concat(F.lit("C"), F.col("l_suppkey").cast("string")).alias("ID_BB_UNIQUE"),
        F.when(F.col("l_returnflag") == "A", "MR")
        .when(F.col("l_returnflag") == "R", "OR")
        .when(F.col("l_quantity") > 40, "XX")
        .otherwise("PR")
        .alias("FILING_STATUS"),
        F.when(F.col("l_linenumber") <= 3, "IAS/IFRS").otherwise("US GAAP").alias("ACCOUNTING_STANDARD"),
        F.when(F.col("l_linestatus") == "F", "Y").otherwise("N").alias("EQY_CONSOLIDATED"),
        # A currency is unknown for some filings: a NULL key part.
        F.when(F.col("l_tax") < 0.08, "USD").alias("EQY_FUND_CRNCY"),
        F.concat(F.year(day).cast("string"), F.lit(" Q"), F.quarter(day).cast("string")).alias("FISCAL_YEAR_PERIOD"),
        F.col("l_orderkey").alias("REVISION_ID"),
        # Monthly updates leave ties; some filings have no update date.
        F.when(F.col("l_tax") > 0, F.trunc(day, "month")).alias("FUNDAMENTAL_UPDATE_DT"),
        day.alias("ANNOUNCEMENT_DT"),
        price.alias("SALES_REV_TURN"),
        F.when(F.col("l_quantity") < 45, price * -1).otherwise(price).alias("CF_CASH_FROM_OPER"),
        F.when(F.col("l_discount") > 0, F.col("l_quantity")).alias("EBITDA"),
        F.when(F.col("l_quantity") >= 25, F.col("l_partkey").cast("double")).alias("ARD_CAPITAL_EXPENDITURES"),
    )


def _reports(name: str) -> Column:
    """Whether a filing reports the item of a statement table."""
    return {
        "is": F.lit(True),
        "cr": F.col("SALES_REV_TURN") > 20000,
        "cr2": F.col("SALES_REV_TURN") > 10000,
        "cf": F.col("CF_CASH_FROM_OPER") < 0,
        "bs": F.col("EBITDA").isNotNull(),
        "sard_bs": F.col("EBITDA") > 10,
        "sard_is": F.col("ARD_CAPITAL_EXPENDITURES").isNotNull(),
        "sard_cf": F.col("SALES_REV_TURN") < 60000,
    }[name]


def statements(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of eight statement tables: the filings that report the item, under its own measure."""
    rows = filings(spark, folder)
    keys = rows.columns[:8]
    return rows.where(_reports(name)).select(
        *keys, "REVISION_ID", F.col("FUNDAMENTAL_UPDATE_DT").alias("UPDATED"), F.col("SALES_REV_TURN").alias(f"V_{name}")
    )


def unique_statements(spark: SparkSession, folder: str, names: Sequence[str]) -> dict[str, DataFrame]:
    """Statement tables with one row per record key.

    One aggregate over the filings has the sums of all of them and is written, so that the joins of the tables read plain rows:
    their shuffles are then the inputs of the joins, whose sizes decide between hashing and sorting.
    """
    rows = filings(spark, folder)
    keys = rows.columns[:8]
    cents = F.round(F.col("SALES_REV_TURN") * 100).cast("long")
    sums = [F.sum(F.when(_reports(n), cents)).alias(f"V_{n}") for n in names]
    # A key whose filings all lack the measure is in the table, with NULL.
    there = [F.coalesce(F.bool_or(_reports(n)), F.lit(False)).alias(f"__has_{n}") for n in names]
    every = stored(rows.groupBy(*keys).agg(*sums, *there), "unique")
    return {n: every.where(f"__has_{n}").select(*keys, f"V_{n}") for n in names}


FILINGS_SQL = """filings AS (
  SELECT last_day(make_date(CAST(year(l_shipdate) AS INTEGER), CAST(quarter(l_shipdate) * 3 AS INTEGER), 1))
           AS LATEST_PERIOD_END_DT_FULL_RECORD,
         CAST(l_suppkey AS VARCHAR) AS ID_BB_COMPANY,
         'C' || CAST(l_suppkey AS VARCHAR) AS ID_BB_UNIQUE,
         CASE WHEN l_returnflag = 'A' THEN 'MR' WHEN l_returnflag = 'R' THEN 'OR' WHEN l_quantity > 40 THEN 'XX'
              ELSE 'PR' END AS FILING_STATUS,
         CASE WHEN l_linenumber <= 3 THEN 'IAS/IFRS' ELSE 'US GAAP' END AS ACCOUNTING_STANDARD,
         CASE WHEN l_linestatus = 'F' THEN 'Y' ELSE 'N' END AS EQY_CONSOLIDATED,
         CASE WHEN l_tax < 0.08 THEN 'USD' END AS EQY_FUND_CRNCY,
         CAST(year(l_shipdate) AS VARCHAR) || ' Q' || CAST(quarter(l_shipdate) AS VARCHAR) AS FISCAL_YEAR_PERIOD,
         l_orderkey AS REVISION_ID,
         CASE WHEN l_tax > 0 THEN CAST(date_trunc('month', l_shipdate) AS DATE) END AS FUNDAMENTAL_UPDATE_DT,
         CAST(l_shipdate AS DATE) AS ANNOUNCEMENT_DT,
         l_extendedprice AS SALES_REV_TURN,
         CASE WHEN l_quantity < 45 THEN -l_extendedprice ELSE l_extendedprice END AS CF_CASH_FROM_OPER,
         CASE WHEN l_discount > 0 THEN l_quantity END AS EBITDA,
         CASE WHEN l_quantity >= 25 THEN CAST(l_partkey AS DOUBLE) END AS ARD_CAPITAL_EXPENDITURES
  FROM lineitem)"""

KEYS_SQL = (
    "LATEST_PERIOD_END_DT_FULL_RECORD, ID_BB_COMPANY, ID_BB_UNIQUE, FILING_STATUS, ACCOUNTING_STANDARD, "
    "EQY_CONSOLIDATED, EQY_FUND_CRNCY, FISCAL_YEAR_PERIOD"
)

_STATEMENT_FILTER_SQL = {
    "is": "TRUE",
    "cr": "SALES_REV_TURN > 20000",
    "cr2": "SALES_REV_TURN > 10000",
    "cf": "CF_CASH_FROM_OPER < 0",
    "bs": "EBITDA IS NOT NULL",
    "sard_bs": "EBITDA > 10",
    "sard_is": "ARD_CAPITAL_EXPENDITURES IS NOT NULL",
    "sard_cf": "SALES_REV_TURN < 60000",
}


def statements_sql(name: str) -> str:
    return (
        f"t_{name} AS (SELECT {KEYS_SQL}, REVISION_ID, FUNDAMENTAL_UPDATE_DT AS UPDATED, SALES_REV_TURN AS V_{name} "
        f"FROM filings WHERE {_STATEMENT_FILTER_SQL[name]})"
    )


def unique_statements_sql(name: str) -> str:
    return (
        f"u_{name} AS (SELECT {KEYS_SQL}, CAST(SUM(CAST(ROUND(SALES_REV_TURN * 100) AS BIGINT)) AS BIGINT) AS V_{name} "
        f"FROM filings WHERE {_STATEMENT_FILTER_SQL[name]} GROUP BY ALL)"
    )


def panel(spark: SparkSession, folder: str) -> DataFrame:
    """One row per company and quarter.  Measures over rarer line items have gaps."""
    day = F.col("l_shipdate").cast("date")
    # Whole cents: sums are exact in any order.
    price = F.round(F.col("l_extendedprice") * 100).cast("long")
    large = F.col("l_quantity") >= 48
    return (
        table(spark, folder, "lineitem")
        .groupBy(
            F.concat(F.lit("C"), F.col("l_suppkey").cast("string")).alias("ID_BB_UNIQUE"),
            F.year(day).alias("Year"),
            F.quarter(day).alias("Quarter"),
        )
        .agg(
            F.max(day).alias("ANNOUNCEMENT_DT"),
            quarter_end(F.max(day)).alias("LATEST_PERIOD_END_DT_FULL_RECORD"),
            F.sum(price).cast("double").alias("SALES_REV_TURN"),
            F.sum(F.when(large & (F.col("l_returnflag") != "N"), price)).cast("double").alias("CF_CASH_FROM_OPER"),
            F.sum(F.when(F.col("l_linestatus") == "O", price).otherwise(-price)).cast("double").alias("EBITDA"),
            F.sum(F.when(large, price)).cast("double").alias("ARD_CAPITAL_EXPENDITURES"),
            F.sum(F.when((F.col("l_quantity") == 50) & (F.col("l_returnflag") == "A"), price))
            .cast("double")
            .alias("RARE_ITEM"),
            # Zero and a text token stand for missing values here.
            F.when(F.sum(F.when(large, 1).otherwise(0)) > 0, F.max("l_returnflag")).otherwise("NULL").alias("NOTE"),
            F.sum(F.when(F.col("l_quantity") >= 49, 1).otherwise(0)).cast("double").alias("BIG_COUNT"),
        )
    )


PANEL_SQL = """panel AS (
  SELECT 'C' || CAST(l_suppkey AS VARCHAR) AS ID_BB_UNIQUE,
         CAST(year(l_shipdate) AS INTEGER) AS "Year",
         CAST(quarter(l_shipdate) AS INTEGER) AS "Quarter",
         CAST(MAX(l_shipdate) AS DATE) AS ANNOUNCEMENT_DT,
         last_day(make_date(CAST(year(MAX(l_shipdate)) AS INTEGER), CAST(quarter(MAX(l_shipdate)) * 3 AS INTEGER), 1))
           AS LATEST_PERIOD_END_DT_FULL_RECORD,
         CAST(SUM(CAST(ROUND(l_extendedprice * 100) AS BIGINT)) AS DOUBLE) AS SALES_REV_TURN,
         CAST(SUM(CASE WHEN l_quantity >= 48 AND l_returnflag <> 'N' THEN CAST(ROUND(l_extendedprice * 100) AS BIGINT) END)
           AS DOUBLE) AS CF_CASH_FROM_OPER,
         CAST(SUM(CASE WHEN l_linestatus = 'O' THEN CAST(ROUND(l_extendedprice * 100) AS BIGINT)
                       ELSE -CAST(ROUND(l_extendedprice * 100) AS BIGINT) END) AS DOUBLE) AS EBITDA,
         CAST(SUM(CASE WHEN l_quantity >= 48 THEN CAST(ROUND(l_extendedprice * 100) AS BIGINT) END) AS DOUBLE)
           AS ARD_CAPITAL_EXPENDITURES,
         CAST(SUM(CASE WHEN l_quantity = 50 AND l_returnflag = 'A' THEN CAST(ROUND(l_extendedprice * 100) AS BIGINT) END)
           AS DOUBLE) AS RARE_ITEM,
         CASE WHEN SUM(CASE WHEN l_quantity >= 48 THEN 1 ELSE 0 END) > 0 THEN MAX(l_returnflag) ELSE 'NULL' END AS NOTE,
         CAST(SUM(CASE WHEN l_quantity >= 49 THEN 1 ELSE 0 END) AS DOUBLE) AS BIG_COUNT
  FROM lineitem GROUP BY l_suppkey, year(l_shipdate), quarter(l_shipdate))"""


def company_info(spark: SparkSession, folder: str) -> DataFrame:
    """Company dimension: sector = region, coded industries = nation, region and account band."""
    nation = table(spark, folder, "nation")
    return (
        table(spark, folder, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left")
        .select(
            F.col("s_suppkey").cast("string").alias("ID_BB_COMPANY"),
            F.concat(F.lit("C"), F.col("s_suppkey").cast("string")).alias("ID_BB_UNIQUE"),
            F.col("n_regionkey").alias("BICS_LEVEL_1"),
            F.col("n_regionkey").cast("long").alias("INDUSTRY_SECTOR_NUM"),
            F.col("s_nationkey").cast("long").alias("INDUSTRY_GROUP_NUM"),
            # Codes above the list stay without a label.
            (F.col("s_nationkey") + F.col("n_regionkey")).cast("long").alias("INDUSTRY_SUBGROUP_NUM"),
            F.floor(F.col("s_acctbal") / 1000).cast("long").alias("Industry_level_4_num"),
            F.when(F.col("s_acctbal") > 0, F.col("s_nationkey").cast("long")).alias("Industry_level_5_num"),
            F.col("s_suppkey").alias("Industry_level_6_num"),
        )
    )


def code_rows(spark: SparkSession, folder: str) -> DataFrame:
    """(level, code, label) for the six industry levels; labels of nations and regions."""
    nation = table(spark, folder, "nation").select(
        F.col("n_nationkey").cast("long").alias("code"), F.col("n_name").alias("label")
    )
    region = table(spark, folder, "region").select(
        F.col("r_regionkey").cast("long").alias("code"), F.col("r_name").alias("label")
    )
    parts = [region.withColumn("level", F.lit("INDUSTRY_SECTOR_NUM"))]
    for level in (
        "INDUSTRY_GROUP_NUM",
        "INDUSTRY_SUBGROUP_NUM",
        "Industry_level_4_num",
        "Industry_level_5_num",
        "Industry_level_6_num",
    ):
        parts.append(nation.withColumn("level", F.lit(level)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("level", "code", "label")


INFO_SQL = """info AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS ID_BB_COMPANY, 'C' || CAST(s_suppkey AS VARCHAR) AS ID_BB_UNIQUE,
         n_regionkey AS BICS_LEVEL_1,
         n_regionkey AS c1, s_nationkey AS c2, s_nationkey + n_regionkey AS c3,
         CAST(floor(s_acctbal / 1000) AS BIGINT) AS c4,
         CASE WHEN s_acctbal > 0 THEN s_nationkey END AS c5, s_suppkey AS c6
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey),
labels AS (
  SELECT ID_BB_UNIQUE, r.r_name AS "INDUSTRY_SECTOR_NUM_mapped", a.n_name AS "INDUSTRY_GROUP_NUM_mapped",
         b.n_name AS "INDUSTRY_SUBGROUP_NUM_mapped", c.n_name AS "Industry_level_4_num_mapped",
         d.n_name AS "Industry_level_5_num_mapped", e.n_name AS "Industry_level_6_num_mapped"
  FROM info LEFT JOIN region r ON c1 = r.r_regionkey LEFT JOIN nation a ON c2 = a.n_nationkey
       LEFT JOIN nation b ON c3 = b.n_nationkey LEFT JOIN nation c ON c4 = c.n_nationkey
       LEFT JOIN nation d ON c5 = d.n_nationkey LEFT JOIN nation e ON c6 = e.n_nationkey)"""
