"""Round trips through the file formats, in new folders under the checkpoint folder."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..plans import ingest as ingest_flow
from ..operators import clean
from ..session import checkpoint_folder, small_side
from ..sources import flatfile, sinks, tables
from . import standins as D
from .catalog import plain, query, with_ctes


def _new_folder(spark, name: str) -> str:
    return f"{checkpoint_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


FIELDS = ["L_ORDERKEY", "L_QUANTITY", "L_PRICE", "L_FLAG", "L_STATUS"]
SHORT = ["L_ORDERKEY", "L_PRICE"]


def vendor_files(rows, folder: str, bucket: str, layouts: dict[bool, list[str]], rich: str) -> str:
    """Write rows as sectioned files, one per bucket; ``rich`` picks the field list of a bucket."""

    def body(names):
        return F.concat(F.concat_ws("|", *[F.coalesce(F.col(c), F.lit("N.A.")) for c in names]), F.lit("|"))

    prefix = ["SECURITY_DESCRIPTION", "RCODE", "NFIELDS"]
    data = rows.select(
        bucket, F.lit(1).alias("part"), F.lit(0).alias("at"), F.when(F.col(rich), body(prefix + layouts[True])).otherwise(body(prefix + layouts[False])).alias("value")
    )

    def frame(names):
        head = ["START-OF-FILE", "RUNDATE=x|y", flatfile.FIELDS_OPEN, *names, flatfile.FIELDS_CLOSE, "", flatfile.DATA_OPEN]
        tail = list(flatfile.DATA_CLOSE)
        return F.array(
            *[F.struct(F.lit(0).alias("part"), F.lit(i).alias("at"), F.lit(t).alias("value")) for i, t in enumerate(head)],
            *[F.struct(F.lit(2).alias("part"), F.lit(i).alias("at"), F.lit(t).alias("value")) for i, t in enumerate(tail)],
        )

    frames = (
        rows.select(bucket, rich)
        .distinct()
        .select(bucket, F.inline(F.when(F.col(rich), frame(layouts[True])).otherwise(frame(layouts[False]))))
    )
    (
        data.unionByName(frames)
        .repartition(bucket)
        .sortWithinPartitions(bucket, "part", "at")
        .select("value", bucket)
        .write.partitionBy(bucket)
        .text(folder)
    )
    return folder


def _vendor_rows(spark, folder):
    day = F.col("l_shipdate").cast("date")
    return D.table(spark, folder, "lineitem").select(
        F.concat(F.year(day).cast("string"), F.quarter(day).cast("string")).alias("bucket"),
        (F.year(day) >= 1998).alias("rich"),
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("SECURITY_DESCRIPTION"),
        F.lit("0").alias("RCODE"),
        F.when(F.year(day) >= 1998, "5").otherwise("2").alias("NFIELDS"),
        F.col("l_orderkey").cast("string").alias("L_ORDERKEY"),
        F.col("l_quantity").cast("int").cast("string").alias("L_QUANTITY"),
        D.money("l_extendedprice").cast("string").alias("L_PRICE"),
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("L_FLAG"),
        F.when(F.col("l_linestatus") == "F", "F").otherwise("").alias("L_STATUS"),
    )


VENDOR_SQL = """SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS SECURITY_DESCRIPTION, '0' AS RCODE,
  CASE WHEN rich THEN '5' ELSE '2' END AS NFIELDS, CAST(l_orderkey AS VARCHAR) AS L_ORDERKEY,
  CASE WHEN rich THEN CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS L_QUANTITY,
  CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS L_PRICE,
  CASE WHEN rich AND l_returnflag <> 'N' THEN l_returnflag END AS L_FLAG,
  CASE WHEN rich THEN CASE WHEN l_linestatus = 'F' THEN 'F' ELSE '' END END AS L_STATUS
  FROM (SELECT *, year(l_shipdate) >= 1998 AS rich FROM lineitem)"""


@query("flatfile_roundtrip", VENDOR_SQL)
def flatfile_roundtrip(spark, folder):
    files = vendor_files(
        _vendor_rows(spark, folder), _new_folder(spark, "vendor"), "bucket", {True: FIELDS, False: SHORT}, "rich"
    )
    return flatfile.read_flatfiles(spark, files, operation_date=False)


CLEAN_FIELDS = [
    "ID_BB_COMPANY",
    "FISCAL_YEAR_PERIOD",
    "FILING_STATUS",
    "EQY_CONSOLIDATED",
    "ACCOUNTING_STANDARD",
    "LATEST_PERIOD_END_DT_FULL_RECORD",
    "FUNDAMENTAL_UPDATE_DT",
    "SALES_REV_TURN",
]


@query(
    "ingest_cleaned",
    """SELECT CAST(o_orderkey AS VARCHAR) AS SECURITY_DESCRIPTION,
              CASE WHEN o_orderstatus = 'P' THEN '-1' ELSE CAST(o_custkey AS VARCHAR) END AS ID_BB_COMPANY,
              CAST(year(o_orderdate) AS VARCHAR) || ' A' AS FISCAL_YEAR_PERIOD,
              CASE WHEN o_orderpriority = '5-LOW' THEN 'Unknown' WHEN o_orderpriority <> '1-URGENT' THEN o_orderpriority END
                AS FILING_STATUS,
              CASE WHEN o_orderstatus = 'F' THEN 'Unknown' ELSE 'Y' END AS EQY_CONSOLIDATED,
              'US GAAP' AS ACCOUNTING_STANDARD,
              CASE WHEN o_orderpriority <> '3-MEDIUM' THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END
                AS LATEST_PERIOD_END_DT_FULL_RECORD,
              CASE WHEN o_orderstatus <> 'O' THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS FUNDAMENTAL_UPDATE_DT,
              CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS SALES_REV_TURN
       FROM orders""",
)
def ingest_cleaned(spark, folder):
    day = F.col("o_orderdate").cast("date")
    status, level = F.col("o_orderstatus"), F.col("o_orderpriority")
    text_day = F.date_format(day, "yyyyMMdd")
    rows = D.table(spark, folder, "orders").select(
        F.concat(F.year(day).cast("string"), F.quarter(day).cast("string")).alias("bucket"),
        F.lit(True).alias("rich"),
        F.col("o_orderkey").cast("string").alias("SECURITY_DESCRIPTION"),
        F.lit("0").alias("RCODE"),
        F.lit("8").alias("NFIELDS"),
        F.when(status == "P", "").otherwise(F.col("o_custkey").cast("string")).alias("ID_BB_COMPANY"),
        F.concat(F.year(day).cast("string"), F.lit(" A")).alias("FISCAL_YEAR_PERIOD"),
        F.when(level == "5-LOW", "").when(level != "1-URGENT", level).alias("FILING_STATUS"),
        F.when(status == "F", "").otherwise("Y").alias("EQY_CONSOLIDATED"),
        F.lit("US GAAP").alias("ACCOUNTING_STANDARD"),
        F.when(level == "3-MEDIUM", "").otherwise(text_day).alias("LATEST_PERIOD_END_DT_FULL_RECORD"),
        F.when(status != "O", text_day).alias("FUNDAMENTAL_UPDATE_DT"),
        D.money("o_totalprice").cast("string").alias("SALES_REV_TURN"),
    )
    files = vendor_files(
        rows, _new_folder(spark, "vendor"), "bucket", {True: CLEAN_FIELDS, False: CLEAN_FIELDS}, "rich"
    )
    frames = ingest_flow.ingest(spark, files)
    return plain(frames["Unknown"].drop("RCODE", "NFIELDS", "OPERATION_DATE"))


@query(
    "parquet_sink",
    with_ctes(
        D.PANEL_SQL, select='SELECT ID_BB_UNIQUE, "Year", "Quarter", SALES_REV_TURN, ARD_CAPITAL_EXPENDITURES FROM panel'
    ),
)
def parquet_sink(spark, folder):
    rows = D.panel(spark, folder).select(
        "ID_BB_UNIQUE", "Year", "Quarter", "SALES_REV_TURN", "ARD_CAPITAL_EXPENDITURES"
    )
    path = _new_folder(spark, "panel")
    sinks.write_parquet(rows, path, partition_by=["Year"])
    return spark.read.parquet(path).select(rows.columns)


@query(
    "csv_sink",
    """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS o_totalprice,
              CASE WHEN o_orderstatus = 'F' THEN 'F' ELSE '\\N' END AS o_orderstatus FROM orders""",
)
def csv_sink(spark, folder):
    rows = D.table(spark, folder, "orders").select(
        "o_orderkey",
        D.money("o_totalprice").alias("o_totalprice"),
        F.when(F.col("o_orderstatus") == "F", "F").when(F.col("o_orderstatus") == "O", "").alias("o_orderstatus"),
    )
    path = _new_folder(spark, "orders-csv")
    sinks.write_csv(rows, path)
    return spark.read.option("header", True).csv(path)


@query(
    "registry",
    """WITH e AS (
         SELECT 'fundamentals_n' || CAST(s_nationkey AS VARCHAR) || '_bs.out' AS filename,
                arg_min(s_name, '/in/fundamentals_n' || CAST(s_nationkey AS VARCHAR) || '_bs.out.' || CAST(s_suppkey AS VARCHAR))
                  AS first_name
         FROM supplier GROUP BY s_nationkey),
       h AS (SELECT *, md5(from_hex('6ba7b8109dad11d180b400c04fd430c8') || encode(filename)) AS d FROM e)
       SELECT substr(d, 1, 8) || '-' || substr(d, 9, 4) || '-3' || substr(d, 14, 3) || '-' ||
              CASE WHEN substr(d, 17, 1) IN ('0', '4', '8', 'c') THEN '8' WHEN substr(d, 17, 1) IN ('1', '5', '9', 'd') THEN '9'
                   WHEN substr(d, 17, 1) IN ('2', '6', 'a', 'e') THEN 'a' ELSE 'b' END || substr(d, 18, 3) || '-' ||
              substr(d, 21, 12) AS _id,
              filename, 'SECURITY_DESCRIPTION,' || first_name AS colnames FROM h""",
)
def registry(spark, folder):
    nation = F.col("s_nationkey").cast("string")
    files = D.table(spark, folder, "supplier").select(
        F.concat(
            F.lit("/in/fundamentals_n"), nation, F.lit("_bs.out."), F.col("s_suppkey").cast("string")
        ).alias("path"),
        F.array(F.lit("SECURITY_DESCRIPTION"), F.col("s_name")).alias("colnames"),
    )
    path = _new_folder(spark, "registry")
    entries = sinks.registry_rows(files)
    sinks.append_registry(spark, entries, path)
    sinks.append_registry(spark, entries, path)
    # As a second writer does that has not seen the first one's entries.
    entries.write.mode("append").parquet(path)
    return sinks.read_registry(spark, path).select("_id", "filename", F.concat_ws(",", "colnames").alias("colnames"))


STATEMENT_SQL = """SELECT ID_BB_UNIQUE, CAST(LATEST_PERIOD_END_DT_FULL_RECORD AS VARCHAR) AS LATEST_PERIOD_END_DT_FULL_RECORD,
  REVISION_ID, SALES_REV_TURN FROM filings
  WHERE LATEST_PERIOD_END_DT_FULL_RECORD > DATE '1996-06-30' AND LATEST_PERIOD_END_DT_FULL_RECORD < DATE '2000-12-31'
    AND ID_BB_COMPANY IN (SELECT CAST(s_suppkey AS VARCHAR) FROM supplier JOIN nation ON s_nationkey = n_nationkey
                          WHERE n_regionkey = 4)"""
STATEMENT_OUT = ["ID_BB_UNIQUE", "LATEST_PERIOD_END_DT_FULL_RECORD", "REVISION_ID", "SALES_REV_TURN"]


@query("statement_scan", with_ctes(D.FILINGS_SQL, select=STATEMENT_SQL))
def statement_scan(spark, folder):
    path = _new_folder(spark, "statements")
    sinks.write_parquet(D.filings(spark, folder), path)
    companies = small_side(clean.universe(D.company_info(spark, folder), 4))
    rows = tables.read_statements(spark, path, "is", companies, "1996-06-30", "2000-12-31")
    return plain(rows.select([F.col(f"is.{c}") for c in STATEMENT_OUT]))


@query("staging_scan", with_ctes(D.FILINGS_SQL, select=STATEMENT_SQL))
def staging_scan(spark, folder):
    name = f"staging_{uuid.uuid4().hex}"
    D.filings(spark, folder).createOrReplaceTempView(name)
    companies = small_side(clean.universe(D.company_info(spark, folder), 4))
    staged = tables.staging_tables(spark, {"is": name}, companies)["is"]
    return plain(clean.period_between(staged, "1996-06-30", "2000-12-31").select(STATEMENT_OUT))


@query(
    "csv_scan",
    "SELECT l_orderkey, l_returnflag, l_extendedprice, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS l_shipdate FROM lineitem",
)
def csv_scan(spark, folder):
    rows = D.table(spark, folder, "lineitem").select(
        "l_orderkey", "l_returnflag", "l_extendedprice", F.col("l_shipdate").cast("date").alias("l_shipdate")
    )
    path = _new_folder(spark, "csv")
    # The copy of a column, as a repeated header would name it, is dropped by the scan.
    sinks.write_csv(rows.withColumn("l_orderkey.1", F.col("l_orderkey")), path, null_marker=None)
    typed = {"l_orderkey": "long", "l_extendedprice": "double", "l_shipdate": "date"}
    return plain(tables.read_csv(spark, path, typed))


@query("sink_by_type", "SELECT o_orderstatus, o_orderkey, o_totalprice FROM orders")
def sink_by_type(spark, folder):
    rows = D.table(spark, folder, "orders").select("o_orderstatus", "o_orderkey", "o_totalprice")
    frames = {kind: rows.where(F.col("o_orderstatus") == kind) for kind in ("F", "O", "P")}
    paths = sinks.write_by_type(frames, _new_folder(spark, "by-type"))
    return clean.union_all([spark.read.parquet(path) for path in paths.values()])
