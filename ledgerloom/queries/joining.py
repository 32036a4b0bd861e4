"""Revisions, joins and the company universe."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clean, industry, joins
from ..plans import statements as flows
from ..session import small_side
from . import standins as D
from .catalog import plain, query, with_ctes

DATE = "CAST(LATEST_PERIOD_END_DT_FULL_RECORD AS VARCHAR) AS LATEST_PERIOD_END_DT_FULL_RECORD"
KEYS_OUT = D.KEYS_SQL.replace("LATEST_PERIOD_END_DT_FULL_RECORD", DATE)


def _all_tables(spark, folder, names=D.STATEMENT_NAMES):
    return {n: D.statements(spark, folder, n) for n in names}


def _latest_sql(name: str) -> str:
    return (
        f"l_{name} AS (SELECT * FROM t_{name} WHERE LATEST_PERIOD_END_DT_FULL_RECORD > DATE '1991-12-31' "
        f"AND LATEST_PERIOD_END_DT_FULL_RECORD < DATE '2002-01-01' QUALIFY RANK() OVER "
        f"(PARTITION BY {D.KEYS_SQL} ORDER BY REVISION_ID DESC) = 1)"
    )


@query(
    "latest_revision",
    with_ctes(
        D.FILINGS_SQL,
        select=f"""SELECT {KEYS_OUT}, REVISION_ID, CAST(FUNDAMENTAL_UPDATE_DT AS VARCHAR) AS FUNDAMENTAL_UPDATE_DT,
                   SALES_REV_TURN FROM filings
                   WHERE LATEST_PERIOD_END_DT_FULL_RECORD > DATE '1991-12-31'
                     AND LATEST_PERIOD_END_DT_FULL_RECORD < DATE '2002-01-01'
                   QUALIFY RANK() OVER (PARTITION BY {D.KEYS_SQL} ORDER BY REVISION_ID DESC) = 1""",
    ),
)
def latest_revision(spark, folder):
    rows = D.filings(spark, folder).transform(clean.period_between, "1991-12-31", "2002-01-01")
    kept = rows.select(*rows.columns[:8], "REVISION_ID", "FUNDAMENTAL_UPDATE_DT", "SALES_REV_TURN")
    return plain(joins.latest_revision(kept))


def _chain_sql(names, kind, prefix, hows=None):
    base, *rest = names
    joined = f"{prefix}_{base}"
    for n in rest:
        how = (hows or {}).get(n, "LEFT JOIN")
        joined += f" {how} {prefix}_{n} USING ({D.KEYS_SQL})"
    return joined


UNIQUE_ORDER = ["is", "cr", "cf", "bs", "sard_bs", "sard_is", "sard_cf", "cr2"]


@query(
    "statement_left_join",
    with_ctes(
        D.FILINGS_SQL,
        *[D.unique_statements_sql(n) for n in UNIQUE_ORDER],
        select=f"SELECT {KEYS_OUT}, {', '.join('V_' + n for n in UNIQUE_ORDER)} FROM "
        + _chain_sql(UNIQUE_ORDER, "unique", "u"),
    ),
)
def statement_left_join(spark, folder):
    return plain(joins.left_join_chain(D.unique_statements(spark, folder, UNIQUE_ORDER)))


JOIN_NO_DUP_ORDER = D.STATEMENT_NAMES


@query(
    "join_no_dup",
    with_ctes(
        D.FILINGS_SQL,
        *[D.statements_sql(n) for n in JOIN_NO_DUP_ORDER],
        *[_latest_sql(n) for n in JOIN_NO_DUP_ORDER],
        select=f"SELECT {KEYS_OUT}, l_is.REVISION_ID AS REVISION_ID, CAST(l_is.UPDATED AS VARCHAR) AS UPDATED, "
        + ", ".join("V_" + n for n in JOIN_NO_DUP_ORDER)
        + " FROM "
        + _chain_sql(JOIN_NO_DUP_ORDER, "latest", "l"),
    ),
)
def join_no_dup(spark, folder):
    tables = {
        n: t.transform(clean.period_between, "1991-12-31", "2002-01-01") for n, t in _all_tables(spark, folder).items()
    }
    return plain(joins.join_statements(tables, rank="all"))


@query(
    "rank_filtered_join",
    with_ctes(
        D.FILINGS_SQL,
        *[D.statements_sql(n) for n in ("is", "cr2", "bs")],
        f"r_cr2 AS (SELECT * FROM t_cr2 QUALIFY RANK() OVER (PARTITION BY {D.KEYS_SQL} ORDER BY REVISION_ID DESC) = 1)",
        select=f"SELECT {KEYS_OUT}, t_is.REVISION_ID AS REVISION_ID, CAST(t_is.UPDATED AS VARCHAR) AS UPDATED, "
        f"V_is, V_cr2, V_bs FROM t_is JOIN r_cr2 USING ({D.KEYS_SQL}) LEFT JOIN t_bs USING ({D.KEYS_SQL})",
    ),
)
def rank_filtered_join(spark, folder):
    return plain(joins.join_statements(_all_tables(spark, folder, ["is", "cr2", "bs"]), rank="cr2"))


@query(
    "unranked_join",
    with_ctes(
        D.FILINGS_SQL,
        *[D.statements_sql(n) for n in ("is", "cr")],
        select=f"SELECT {KEYS_OUT}, t_is.REVISION_ID AS REVISION_ID, CAST(t_is.UPDATED AS VARCHAR) AS UPDATED, "
        f"V_is, V_cr FROM t_is LEFT JOIN t_cr USING ({D.KEYS_SQL})",
    ),
)
def unranked_join(spark, folder):
    return plain(joins.join_statements(_all_tables(spark, folder, ["is", "cr"]), rank="none"))


SELECTED = [
    "BICS_LEVEL_1",
    "LATEST_PERIOD_END_DT_FULL_RECORD",
    "ID_BB_COMPANY",
    "ID_BB_UNIQUE",
    "FILING_STATUS",
    "ACCOUNTING_STANDARD",
    "EQY_CONSOLIDATED",
    "EQY_FUND_CRNCY",
    "FISCAL_YEAR_PERIOD",
    "is.REVISION_ID",
    "bs.UPDATED",
    "V_is",
    "V_bs",
    "V_sard_cf",
]


@query(
    "output_projection",
    with_ctes(
        D.FILINGS_SQL,
        *[D.statements_sql(n) for n in ("is", "bs", "sard_cf")],
        "k_is AS (SELECT * FROM t_is WHERE LATEST_PERIOD_END_DT_FULL_RECORD > DATE '1991-12-31' "
        "AND LATEST_PERIOD_END_DT_FULL_RECORD < DATE '2002-01-01')",
        select=f"""SELECT i.n_regionkey AS BICS_LEVEL_1, {KEYS_OUT}, k_is.REVISION_ID AS REVISION_ID,
                   CAST(t_bs.UPDATED AS VARCHAR) AS UPDATED, V_is, V_bs, V_sard_cf
                   FROM k_is LEFT JOIN t_bs USING ({D.KEYS_SQL}) LEFT JOIN t_sard_cf USING ({D.KEYS_SQL})
                   LEFT JOIN (SELECT CAST(s_suppkey AS VARCHAR) AS sid, n_regionkey
                              FROM supplier JOIN nation ON s_nationkey = n_nationkey) i ON ID_BB_COMPANY = i.sid""",
    ),
)
def output_projection(spark, folder):
    tables = {
        n: t.transform(clean.period_between, "1991-12-31", "2002-01-01")
        for n, t in _all_tables(spark, folder, ["is", "bs", "sard_cf"]).items()
    }
    return plain(joins.join_and_select(tables, small_side(clean.universe(D.company_info(spark, folder))), SELECTED))


@query(
    "universe_semi_join",
    with_ctes(
        D.FILINGS_SQL,
        select=f"""SELECT {KEYS_OUT}, REVISION_ID, SALES_REV_TURN FROM filings
                   WHERE LATEST_PERIOD_END_DT_FULL_RECORD > DATE '1995-12-31'
                     AND LATEST_PERIOD_END_DT_FULL_RECORD < DATE '2001-03-31'
                     AND ID_BB_COMPANY IN (SELECT DISTINCT CAST(s_suppkey AS VARCHAR) FROM supplier
                                           JOIN nation ON s_nationkey = n_nationkey WHERE n_regionkey = 2)""",
    ),
)
def universe_semi_join(spark, folder):
    companies = small_side(clean.universe(D.company_info(spark, folder), 2))
    rows = D.filings(spark, folder).transform(clean.period_between, "1995-12-31", "2001-03-31")
    kept = clean.in_universe(rows, companies)
    return plain(kept.select(*rows.columns[:8], "REVISION_ID", "SALES_REV_TURN"))


@query(
    "distinct_companies",
    """SELECT CAST(s_suppkey AS VARCHAR) AS ID_BB_COMPANY, n_regionkey AS BICS_LEVEL_1
       FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL""",
)
def distinct_companies(spark, folder):
    return clean.universe(D.company_info(spark, folder))


@query(
    "sector_join",
    with_ctes(
        D.FILINGS_SQL,
        D.INFO_SQL,
        select="""SELECT f.ID_BB_COMPANY, FISCAL_YEAR_PERIOD, REVISION_ID, SALES_REV_TURN, BICS_LEVEL_1
                  FROM filings f LEFT JOIN info i ON f.ID_BB_COMPANY = i.ID_BB_COMPANY""",
    ),
)
def sector_join(spark, folder):
    rows = D.filings(spark, folder).select("ID_BB_COMPANY", "FISCAL_YEAR_PERIOD", "REVISION_ID", "SALES_REV_TURN")
    return joins.add_sector(rows, small_side(clean.universe(D.company_info(spark, folder))))


@query(
    "latest_join_flow",
    with_ctes(
        D.FILINGS_SQL,
        D.INFO_SQL,
        *[D.statements_sql(n) for n in ("is", "cr", "cf")],
        *[
            f"s_{n} AS (SELECT * FROM t_{n} WHERE LATEST_PERIOD_END_DT_FULL_RECORD > DATE '1995-01-01' "
            f"AND LATEST_PERIOD_END_DT_FULL_RECORD < DATE '2001-01-01' AND ID_BB_COMPANY IN "
            f"(SELECT ID_BB_COMPANY FROM info WHERE BICS_LEVEL_1 = 3) QUALIFY RANK() OVER "
            f"(PARTITION BY {D.KEYS_SQL} ORDER BY REVISION_ID DESC) = 1)"
            for n in ("is", "cr", "cf")
        ],
        select=f"SELECT {KEYS_OUT}, s_is.REVISION_ID AS REVISION_ID, CAST(s_is.UPDATED AS VARCHAR) AS UPDATED, "
        f"V_is, V_cr, V_cf FROM s_is LEFT JOIN s_cr USING ({D.KEYS_SQL}) LEFT JOIN s_cf USING ({D.KEYS_SQL})",
    ),
)
def latest_join_flow(spark, folder):
    tables = _all_tables(spark, folder, ["is", "cr", "cf"])
    return plain(flows.join_latest(tables, D.company_info(spark, folder), 3, "1995-01-01", "2001-01-01"))


@query(
    "industry_labels",
    with_ctes(
        D.FILINGS_SQL,
        D.INFO_SQL,
        select="""SELECT f.ID_BB_UNIQUE, FISCAL_YEAR_PERIOD, REVISION_ID, SALES_REV_TURN,
                  "INDUSTRY_SECTOR_NUM_mapped", "INDUSTRY_GROUP_NUM_mapped", "INDUSTRY_SUBGROUP_NUM_mapped",
                  "Industry_level_4_num_mapped", "Industry_level_5_num_mapped", "Industry_level_6_num_mapped"
                  FROM filings f LEFT JOIN labels l ON f.ID_BB_UNIQUE = l.ID_BB_UNIQUE""",
    ),
)
def industry_labels(spark, folder):
    codes = small_side(industry.industry_codes(D.code_rows(spark, folder)))
    labels = small_side(industry.label_companies(D.company_info(spark, folder), codes))
    rows = D.filings(spark, folder).select("ID_BB_UNIQUE", "FISCAL_YEAR_PERIOD", "REVISION_ID", "SALES_REV_TURN")
    return industry.attach_labels(rows, labels)


@query(
    "filings_per_company",
    "SELECT 'C' || CAST(l_suppkey AS VARCHAR) AS ID_BB_UNIQUE, COUNT(*) AS rows FROM lineitem GROUP BY l_suppkey",
)
def filings_per_company(spark, folder):
    return clean.row_counts(D.filings(spark, folder), "ID_BB_UNIQUE")


@query(
    "union_by_name",
    """SELECT o_orderkey AS id, o_totalprice AS value, o_orderpriority AS note, CAST(NULL AS DOUBLE) AS discount FROM orders
       UNION ALL SELECT l_orderkey, l_extendedprice, NULL, l_discount FROM lineitem
       UNION ALL SELECT event_id, value, event_type, NULL FROM events""",
)
def union_by_name(spark, folder):
    orders = D.table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("value"), F.col("o_orderpriority").alias("note")
    )
    items = D.table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("id"), F.col("l_discount").alias("discount"), F.col("l_extendedprice").alias("value")
    )
    events = D.table(spark, folder, "events").select(
        F.col("event_type").alias("note"), F.col("event_id").alias("id"), "value"
    )
    return clean.union_all([orders, items, events])
