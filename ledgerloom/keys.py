"""Column names and lookup values of the data model."""

from __future__ import annotations

# They name columns of the incoming data and must match it exactly.
COMPANY = "ID_BB_COMPANY"
SERIES_ID = "ID_BB_UNIQUE"
PERIOD_END = "LATEST_PERIOD_END_DT_FULL_RECORD"
FISCAL_PERIOD = "FISCAL_YEAR_PERIOD"
REVISION = "REVISION_ID"
SECTOR = "BICS_LEVEL_1"
UPDATE_DT = "FUNDAMENTAL_UPDATE_DT"
ANNOUNCE_DT = "ANNOUNCEMENT_DT"
CONSOLIDATED = "EQY_CONSOLIDATED"
FILING_STATUS = "FILING_STATUS"
ACCOUNTING = "ACCOUNTING_STANDARD"
YEAR = "Year"
QUARTER = "Quarter"

RECORD_KEYS = [
    "LATEST_PERIOD_END_DT_FULL_RECORD",
    "ID_BB_COMPANY",
    "ID_BB_UNIQUE",
    "FILING_STATUS",
    "ACCOUNTING_STANDARD",
    "EQY_CONSOLIDATED",
    "EQY_FUND_CRNCY",
    "FISCAL_YEAR_PERIOD",
]

FLATFILE_PREFIX = ["SECURITY_DESCRIPTION", "RCODE", "NFIELDS"]

DATE_COLUMNS = [
    "LATEST_PERIOD_END_DT_FULL_RECORD",
    "ANNOUNCEMENT_DT",
    "FUNDAMENTAL_ENTRY_DT",
    "FUNDAMENTAL_UPDATE_DT",
]

# Replacement for an empty string, per column.
EMPTY_SENTINELS = {
    "ID_BB_COMPANY": "-1",
    "FISCAL_YEAR_PERIOD": "99999999",
    "FILING_STATUS": "Unknown",
    "EQY_CONSOLIDATED": "Unknown",
    "ACCOUNTING_STANDARD": "Unknown",
    "LATEST_PERIOD_END_DT_FULL_RECORD": "99999999",
}

# Lower number wins.
FILING_PRIORITY = {"MR": 1, "OR": 2, "PR": 3, "RS": 4, "ER": 5}
ACCOUNTING_PRIORITY = {"IAS/IFRS": 1, "US GAAP": 2}

# Columns that conflict resolution leaves out of its output.
ANNUAL_UNRESOLVED = [
    "TICKER",
    "EXCH_CODE",
    "TICKER_AND_EXCH_CODE",
    "ID_BB_COMPANY",
    "ID_BB_SECURITY",
    "ID_BB_UNIQUE",
    "EQY_FUND_IND",
    "FISCAL_YEAR_PERIOD",
    "FUNDAMENTAL_ENTRY_DT",
    "FUNDAMENTAL_UPDATE_DT",
    "EQY_CONSOLIDATED",
    "FILING_STATUS",
    "ACCOUNTING_STANDARD",
    "Year",
]
# The quarterly flow resolves the entry date like a measure, so it is not listed here.
QUARTERLY_UNRESOLVED = [c for c in ANNUAL_UNRESOLVED if c != "FUNDAMENTAL_ENTRY_DT"]

TARGET_COLUMNS = ["SALES_REV_TURN", "CF_CASH_FROM_OPER", "EBITDA", "ARD_CAPITAL_EXPENDITURES"]
CAPEX = "ARD_CAPITAL_EXPENDITURES"

INDUSTRY_COLUMNS = [
    "INDUSTRY_SECTOR_NUM",
    "INDUSTRY_GROUP_NUM",
    "INDUSTRY_SUBGROUP_NUM",
    "Industry_level_4_num",
    "Industry_level_5_num",
    "Industry_level_6_num",
]

# Join orders; the first table is the left-most one.
STATEMENT_ORDER = ["is", "cr", "cr2", "cf", "bs", "sard_bs", "sard_is", "sard_cf"]
ALL_COLUMNS_ORDER = ["is", "cr", "cf", "bs", "sard_bs", "sard_is", "sard_cf", "cr2"]

# Projection of the joined statement table; "alias.column" picks one table's copy.
JOINED_COLUMNS = [
    "BICS_LEVEL_1",
    "LATEST_PERIOD_END_DT_FULL_RECORD",
    "ID_BB_COMPANY",
    "ID_BB_UNIQUE",
    "FILING_STATUS",
    "ACCOUNTING_STANDARD",
    "EQY_CONSOLIDATED",
    "EQY_FUND_CRNCY",
    "FISCAL_YEAR_PERIOD",
    "is.SECURITY_DESCRIPTION",
    "bs.RCODE",
    "bs.NFIELDS",
    "bs.TICKER",
    "bs.EXCH_CODE",
    "bs.TICKER_AND_EXCH_CODE",
    "bs.ID_BB_SECURITY",
    "bs.EQY_FUND_IND",
    "bs.ANNOUNCEMENT_DT",
    "bs.FUNDAMENTAL_ENTRY_DT",
    "bs.FUNDAMENTAL_UPDATE_DT",
    "ARD_TOTAL_REVENUES",
    "CF_CASH_FROM_OPER",
    "EBITDA",
    "ARD_CAPITAL_EXPENDITURES",
    "IS_EPS",
]

ALL_SECTORS = -99
