"""Schemas and fixed values of the statement jobs.

Values in the "fixed values" blocks must stay exactly as written: they are
the domain values the selection logic compares against, and the output
names a downstream reader expects.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: eligible audit methods, in rank order (rank 1 = first) ---
AUDIT_METHODS = ["Unqualif'd", "Qualified", "Reviewed", "Compiled", "Co.Prep'd"]

# --- fixed values: ranked statement types, in rank order (rank 1 = first) ---
STATEMENT_TYPES = ["Annual", "Quarterly", "Monthly"]

# --- fixed values: statement types that are never eligible ---
EXCLUDED_TYPES = ["FY-To-Date", "Rolling Stmt"]

# --- fixed values: the 26 measures of a statement row ---
MEASURES = [
    "netfixedassets", "amortexpense", "deprecexpense", "cash", "marketablesec",
    "cpltd", "fixedassets", "interestexpense", "longtermdebt", "minorityinterest",
    "minintequity", "netopprofit", "retainedearnings", "stloanspayable",
    "totalnoncurasts", "intangibles", "totalnoncurliabs", "totalcurliabs",
    "acctspaytrade", "acctsrectrade", "baddebtreserve", "totalcurassets",
    "totalinventory", "netprofit", "netsales", "totalassets",
]

KEY_COLUMNS = [
    "asofdate", "entityid", "statementid", "pkid_", "statementdatekey_",
    "statementmonths", "auditmethod", "statementtype",
]

STATEMENT_SCHEMA = T.StructType(
    [
        T.StructField("asofdate", T.DateType()),
        T.StructField("entityid", T.LongType()),
        T.StructField("statementid", T.LongType()),
        T.StructField("pkid_", T.StringType()),
        T.StructField("statementdatekey_", T.DateType()),
        T.StructField("statementmonths", T.IntegerType()),
        T.StructField("auditmethod", T.StringType()),
        T.StructField("statementtype", T.StringType()),
    ]
    + [T.StructField(m, T.DoubleType()) for m in MEASURES]
)

# Cohort columns as the selection stage emits them.
COHORT_COLUMNS = [
    "entityid", "pkid_", "statementdatekey_", "statment_date", "statementtype",
    "statementmonths", "ranked_order", "CF_Type",
]

# --- fixed values: per-statement metric columns, in output order ---
METRIC_COLUMNS = [
    "CapitalExpenditures", "CashMarketableSecurities", "CurrentMaturitiesLongTermDebt",
    "DateOfFinancials", "DepreciationAmortization", "FixedAssets", "InterestExpense",
    "LongTermDebt", "MinorityInterest", "OperatingIncome", "RetainedEarnings",
    "ShortTermDebt", "TangibleAssets", "TotalLiabilities",
    "AccountsPayableCurrent", "Accounts Payable (A/P) Prior Year",
    "AccountsReceivableCurrent", "Accounts Receivable (A/R) Prior Year",
    "CurrentAssetsCurrent", "Current Assets Prior Year",
    "CurrentLiabilitiesCurrent", "Current Liabilities Prior Year",
    "Inventory Current", "Inventory Prior Year",
    "NetIncomeCurrent", "Net Income Prior Year",
    "NetSalesCurrent", "Net Sales Prior Year",
    "TotalAssetsCurrent", "Total Assets Prior Year",
]

# --- fixed values: current-year totals (output name, metric summed) ---
CURRENT_TOTALS = [
    ("CapitalExpenditures", "CapitalExpenditures"),
    ("CashMarketableSecurities", "CashMarketableSecurities"),
    ("CurrentMaturitiesLongTermDebt", "CurrentMaturitiesLongTermDebt"),
    ("DepreciationAmortization", "DepreciationAmortization"),
    ("FixedAssets", "FixedAssets"),
    ("InterestExpense", "InterestExpense"),
    ("LongTermDebt", "LongTermDebt"),
    ("MinorityInterest", "MinorityInterest"),
    ("OperatingIncome", "OperatingIncome"),
    ("RetainedEarnings", "RetainedEarnings"),
    ("ShortTermDebt", "ShortTermDebt"),
    ("TangibleAssets", "TangibleAssets"),
    ("TotalLiabilities", "TotalLiabilities"),
    ("AccountsPayableCurrent", "AccountsPayableCurrent"),
    ("AccountsReceivableCurrent", "AccountsReceivableCurrent"),
    ("Inventory Current", "Inventory Current"),
    ("CurrentAssetsCurrent", "CurrentAssetsCurrent"),
    ("CurrentLiabilitiesCurrent", "CurrentLiabilitiesCurrent"),
    ("NetIncomeCurrent", "NetIncomeCurrent"),
    ("NetSalesCurrent", "NetSalesCurrent"),
    ("TotalAssetsCurrent", "TotalAssetsCurrent"),
]

# --- fixed values: prior-year totals (output name, metric summed) ---
PRIOR_TOTALS = [
    ("AccountsPayablePriorYear", "Accounts Payable (A/P) Prior Year"),
    ("AccountsReceivablePriorYear", "Accounts Receivable (A/R) Prior Year"),
    ("InventoryPriorYear", "Inventory Prior Year"),
    ("CurrentAssetsPriorYear", "Current Assets Prior Year"),
    ("NetIncomePriorYear", "Net Income Prior Year"),
    ("NetSalesPriorYear", "Net Sales Prior Year"),
    ("TotalAssetsPriorYear", "Total Assets Prior Year"),
    ("CurrentLiabilitiesPriorYear", "CurrentLiabilitiesCurrent"),
]

# --- fixed values: the 35 output columns of the client-financials report ---
REPORT_COLUMNS = [
    "ENTITYID", "Internal ID", "Original Internal ID", "ObligorName",
    "DateOfFinancials", "DateLastAudit", "NetSalesCurrent", "NetSalesPriorYear",
    "OperatingIncome", "DepreciationAmortization", "InterestExpense",
    "NetIncomeCurrent", "NetIncomePriorYear", "CashMarketableSecurities",
    "AccountsReceivableCurrent", "AccountsReceivablePriorYear", "Inventory Current",
    "InventoryPriorYear", "CurrentAssetsCurrent", "CurrentAssetsPriorYear",
    "TangibleAssets", "FixedAssets", "TotalAssetsCurrent", "TotalAssetsPriorYear",
    "AccountsPayableCurrent", "AccountsPayablePriorYear", "ShortTermDebt",
    "CurrentMaturitiesLongTermDebt", "CurrentLiabilitiesCurrent",
    "CurrentLiabilitiesPriorYear", "LongTermDebt", "MinorityInterest",
    "TotalLiabilities", "RetainedEarnings", "CapitalExpenditures",
]

# --- fixed values: constant report columns ---
DATE_LAST_AUDIT = "12/31/9999"

# --- fixed values: the sales-target CSV drop (header names as delivered; note
# the trailing blank of "SalesRevenue ") ---
CSV_FIELDS = ["FirstName", "LastName", "SalesQuantity", "SalesRevenue ", "Year"]
CSV_WIDTHS = {"FirstName": 7, "LastName": 17}
CSV_SCHEMA = T.StructType(
    [
        T.StructField("FirstName", T.StringType()),
        T.StructField("LastName", T.StringType()),
        T.StructField("SalesQuantity", T.ShortType()),
        T.StructField("SalesRevenue ", T.IntegerType()),
        T.StructField("Year", T.ShortType()),
    ]
)

# --- fixed values: target table columns of the rep-performance load ---
TARGET_NAME_WIDTH = 50
TARGET_COLUMNS = [
    "ID", "FirstName", "LastName", "TargetSalesQuantity", "TargetSalesRevenue", "TargetYear",
]
