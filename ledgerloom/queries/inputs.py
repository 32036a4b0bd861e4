"""The forms in which vendor data arrives and leaves: types, file names, spellings."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.quantiles import group_quantiles
from ..operators import clean
from ..sources import flatfile, sinks, tables
from . import standins as D
from .catalog import plain, query, with_ctes
from .files import FIELDS, SHORT, _new_folder, _vendor_rows, vendor_files
from .joining import KEYS_OUT
from .settling import RESOLVE_QUARTERLY_SQL, resolved_quarterly


def _register(name: str, form) -> None:
    @query(name, RESOLVE_QUARTERLY_SQL)
    def run(spark, folder):
        return resolved_quarterly(spark, folder, form)


# The same filings with dates as whole numbers, as compact text and as ISO text.
_register("resolve_quarterly_int_dates", lambda c: F.date_format(c, "yyyyMMdd").cast("int"))
_register("resolve_quarterly_text_dates", lambda c: F.coalesce(F.date_format(c, "yyyyMMdd"), F.lit("")))
_register("resolve_quarterly_iso_dates", lambda c: F.date_format(c, "yyyy-MM-dd"))


@query(
    "company_info_scan",
    with_ctes(
        D.INFO_SQL,
        select="""SELECT ID_BB_COMPANY, ID_BB_UNIQUE, CAST(BICS_LEVEL_1 AS BIGINT) AS BICS_LEVEL_1,
                  CAST(c2 AS BIGINT) AS INDUSTRY_GROUP_NUM, CAST(c5 AS BIGINT) AS "Industry_level_5_num" FROM info""",
    ),
)
def company_info_scan(spark, folder):
    """Codes of a column with gaps are spelled as floats."""
    path = _new_folder(spark, "info")
    info = D.company_info(spark, folder)
    coded = [c for c in info.columns if c not in ("ID_BB_COMPANY", "ID_BB_UNIQUE")]
    sinks.write_csv(info.withColumns({c: F.col(c).cast("double").cast("string") for c in coded}), path, null_marker=None)
    rows, _ = tables.read_company_info(spark, path)
    return rows.select("ID_BB_COMPANY", "ID_BB_UNIQUE", "BICS_LEVEL_1", "INDUSTRY_GROUP_NUM", "Industry_level_5_num")


@query(
    "industry_code_scan",
    """SELECT 'INDUSTRY_SECTOR_NUM' AS level, CAST(r_regionkey AS BIGINT) AS code, r_name AS label FROM region
       UNION ALL SELECT l.level, CAST(n_nationkey AS BIGINT), n_name FROM nation, (SELECT unnest(['INDUSTRY_GROUP_NUM',
         'INDUSTRY_SUBGROUP_NUM', 'Industry_level_4_num', 'Industry_level_5_num', 'Industry_level_6_num']) AS level) l""",
)
def industry_code_scan(spark, folder):
    path = _new_folder(spark, "codes")
    sinks.write_csv(D.code_rows(spark, folder), path, null_marker=None)
    return tables.read_industry_codes(spark, path)


@query("failfast_rows", "SELECT count(*) AS rows, CAST(count(*) AS BIGINT) AS today FROM lineitem")
def failfast_rows(spark, folder):
    """Rows are counted without reading a value, which still looks at their widths; all carry the day of reading."""
    files = vendor_files(
        _vendor_rows(spark, folder), _new_folder(spark, "vendor"), "bucket", {True: FIELDS, False: SHORT}, "rich"
    )
    frame = flatfile.read_flatfiles(spark, files)
    return frame.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("OPERATION_DATE") == F.current_date()).alias("today"))


@query("csv_sink_by_type", "SELECT o_orderstatus, CAST(o_orderkey AS VARCHAR) AS o_orderkey FROM orders")
def csv_sink_by_type(spark, folder):
    rows = D.table(spark, folder, "orders").select("o_orderstatus", "o_orderkey")
    frames = {kind: rows.where(F.col("o_orderstatus") == kind) for kind in ("F", "O", "P")}
    paths = sinks.write_csv_by_type(frames, _new_folder(spark, "csv-by-type"))
    return clean.union_all([spark.read.option("header", True).csv(p) for p in paths.values()])


@query(
    "single_file_csv",
    "SELECT o_orderpriority, CAST(count(*) AS VARCHAR) AS rows, '1' AS files FROM orders GROUP BY o_orderpriority",
)
def single_file_csv(spark, folder):
    path = _new_folder(spark, "report")
    sinks.write_csv(clean.row_counts(D.table(spark, folder, "orders"), "o_orderpriority"), path, single_file=True)
    rows = spark.read.option("header", True).csv(path)
    files = rows.select(F.input_file_name().alias("f")).distinct().agg(F.count("*").cast("string").alias("files"))
    return rows.withColumn("files", files.scalar())


@query(
    "repeated_columns",
    """SELECT x.name, CAST(2 AS BIGINT) AS times, (SELECT count(*) FROM supplier) AS rows
       FROM (SELECT unnest(['s_nationkey', 's_suppkey']) AS name) x""",
)
def repeated_columns(spark, folder):
    rows = D.table(spark, folder, "supplier")
    twice = rows.select("s_suppkey", "s_nationkey", "s_name", "s_suppkey", "s_nationkey")
    found = F.create_map(*[F.lit(x) for pair in sorted(clean.repeated_columns(twice).items()) for x in pair])
    counted = rows.agg(F.count("*").alias("rows"))
    return counted.select(F.explode(found).alias("name", "n"), "rows").select("name", F.col("n").cast("long").alias("times"), "rows")


@query(
    "common_filings",
    with_ctes(
        D.FILINGS_SQL,
        select=f"""SELECT {KEYS_OUT}, REVISION_ID, SALES_REV_TURN FROM filings
                   WHERE FILING_STATUS = 'MR' AND EQY_CONSOLIDATED = 'Y' AND ACCOUNTING_STANDARD = 'US GAAP'
                     AND LATEST_PERIOD_END_DT_FULL_RECORD > DATE '1991-12-31'
                     AND regexp_full_match(FISCAL_YEAR_PERIOD, '[0-9]{{4}} Q[1-4]')""",
    ),
)
def common_filings(spark, folder):
    rows = clean.common_filings(D.filings(spark, folder), "1991-12-31")
    return plain(rows.select(*rows.columns[:8], "REVISION_ID", "SALES_REV_TURN"))


@query(
    "quantiles_with_nan",
    """WITH x AS (SELECT l_returnflag, CASE WHEN l_linenumber > 1 THEN l_extendedprice END AS p FROM lineitem)
       SELECT side, l_returnflag, ROUND(quantile_cont(p, 0.5), 4) AS median, ROUND(quantile_cont(p, 0.9), 4) AS high
       FROM x, (SELECT unnest(['direct', 'narrowed']) AS side) GROUP BY ALL""",
)
def quantiles_with_nan(spark, folder):
    rows = D.table(spark, folder, "lineitem").select(
        "l_returnflag", F.when(F.col("l_linenumber") > 1, F.col("l_extendedprice")).otherwise(float("nan")).alias("p")
    )
    out = []
    for side, bound in (("direct", 10**12), ("narrowed", 1000)):
        q = group_quantiles(rows, ["l_returnflag"], ["p"], (0.5, 0.9), direct_rows=bound)
        out.append(q.select(F.lit(side).alias("side"), "l_returnflag", F.col("p")[0].alias("median"), F.col("p")[1].alias("high")))
    return plain(clean.union_all(out), 4)


@query(
    "csv_mixed_headers",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber > 2 THEN l_extendedprice END AS l_extendedprice, l_returnflag,
              CASE WHEN l_linenumber <= 2 THEN CAST(CAST(l_shipdate AS DATE) AS VARCHAR) END AS l_shipdate
       FROM lineitem""",
)
def csv_mixed_headers(spark, folder):
    """Files with the same columns in other orders, and some without a column."""
    rows = D.table(spark, folder, "lineitem").withColumn("l_shipdate", F.col("l_shipdate").cast("date"))
    layouts = {
        "a": (F.col("l_linenumber") <= 2, ["l_returnflag", "l_shipdate", "l_orderkey", "l_linenumber"]),
        "b": (F.col("l_linenumber") == 3, ["l_linenumber", "l_extendedprice", "l_returnflag", "l_orderkey"]),
        "c": (F.col("l_linenumber") > 3, ["l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice"]),
    }
    path = _new_folder(spark, "csv-mixed")
    for name, (kept, columns) in layouts.items():
        sinks.write_csv(rows.where(kept).select(columns), f"{path}/{name}", null_marker=None)
    typed = {"l_orderkey": "long", "l_linenumber": "int", "l_extendedprice": "double", "l_shipdate": "date"}
    return plain(tables.read_csv(spark, [f"{path}/{n}" for n in layouts], typed))


KINDS = {"is": ["REVENUE", "COST"], "sard_is": ["REVENUE", "NOTE", "COST"], "bs": ["NOTE"]}


def named_files(spark, folder: str, kind: str) -> str:
    """Give the one file of each bucket the name that the vendor would give it; returns a pattern for all of them."""
    jvm = spark._jvm
    home = jvm.org.apache.hadoop.fs.Path(folder)
    files = home.getFileSystem(spark._jsc.hadoopConfiguration())
    for bucket in files.listStatus(home):
        if bucket.isDirectory():
            (part,) = [f.getPath() for f in files.listStatus(bucket.getPath()) if f.getPath().getName().startswith("part-")]
            region = bucket.getPath().getName().partition("=")[2]
            files.rename(part, jvm.org.apache.hadoop.fs.Path(home, f"fundamentals_{region}_{kind}.out.20250520"))
    return f"{folder}/fundamentals_*"


@query(
    "ingest_by_type",
    """WITH x AS (SELECT o_orderkey, o_totalprice, o_orderpriority, CASE WHEN o_orderkey % 3 = 0 THEN 'is'
         WHEN o_orderkey % 3 = 1 THEN 'sard_is' ELSE 'bs' END AS kind FROM orders)
       SELECT kind, 'r' || CAST(o_orderkey % 4 AS VARCHAR) AS SECURITY_DESCRIPTION,
         CASE WHEN kind <> 'bs' THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS "REVENUE",
         CASE WHEN kind <> 'bs' AND o_orderkey % 5 <> 0 THEN CAST(o_orderkey AS VARCHAR) END AS "COST",
         CASE WHEN kind <> 'is' THEN o_orderpriority END AS "NOTE" FROM x""",
)
def ingest_by_type(spark, folder):
    """Files of three types by their names, several of each, every type with fields of its own."""
    key = F.col("o_orderkey")
    region = F.concat(F.lit("r"), F.pmod(key, F.lit(4)).cast("string"))
    rows = D.table(spark, folder, "orders").select(
        F.when(key % 3 == 0, "is").when(key % 3 == 1, "sard_is").otherwise("bs").alias("kind"),
        region.alias("bucket"),
        F.lit(True).alias("rich"),
        region.alias("SECURITY_DESCRIPTION"),
        F.lit("0").alias("RCODE"),
        F.lit("3").alias("NFIELDS"),
        D.money("o_totalprice").cast("string").alias("REVENUE"),
        F.when(key % 5 != 0, key.cast("string")).alias("COST"),
        F.col("o_orderpriority").alias("NOTE"),
    )
    paths = []
    for kind, fields in KINDS.items():
        files = vendor_files(rows.where(F.col("kind") == kind), _new_folder(spark, "vendor"), "bucket", {True: fields, False: fields}, "rich")
        paths.append(named_files(spark, files, kind))
    frames = flatfile.read_by_type(spark, paths, operation_date=False)
    out = clean.union_all([frames[kind].withColumn("kind", F.lit(kind)) for kind in KINDS])
    return out.select("kind", "SECURITY_DESCRIPTION", "REVENUE", "COST", "NOTE")
