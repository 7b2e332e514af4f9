"""Per-statement financial line items (30 columns)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finwater.functions import numeric18, sql_round, yyyymmdd, zero_if_null
from finwater.schema import METRIC_COLUMNS

LINE_KEYS = ["TimeFrame", "entityid", "statementdatekey_", "statementmonths", "pkid_", "CF_Type", "AOD"]


def metric_columns(months_col: str = "statementmonths") -> list:
    """The 30 metric expressions over raw measure columns.

    NULL rules differ per line on purpose: capital expenditures and cash
    count a missing part as 0, tangible assets stays NULL if any part is.
    """
    r = sql_round
    z = zero_if_null
    c = F.col
    exprs = {
        "CapitalExpenditures": r(z(c("netfixedassets"))) + r(z(c("amortexpense"))) + r(z(c("deprecexpense"))),
        "CashMarketableSecurities": r(z(c("cash"))) + r(z(c("marketablesec"))),
        "CurrentMaturitiesLongTermDebt": F.when(
            c("cpltd").isNotNull(), r(r(c("cpltd")) / r(c(months_col)))
        ),
        "DateOfFinancials": yyyymmdd(c("statementdatekey_").cast("date")),
        "DepreciationAmortization": r(c("amortexpense")),
        "FixedAssets": F.when(c("fixedassets").isNotNull(), r(c("fixedassets"))).when(
            c("netfixedassets").isNotNull(), r(c("netfixedassets"))
        ),
        "InterestExpense": r(c("interestexpense")),
        "LongTermDebt": r(c("longtermdebt")),
        "MinorityInterest": F.when(c("minorityinterest").isNull(), r(c("minintequity"))).otherwise(
            r(c("minorityinterest"))
        ),
        "OperatingIncome": r(c("netopprofit")),
        "RetainedEarnings": r(c("retainedearnings")),
        "ShortTermDebt": r(c("stloanspayable")),
        "TangibleAssets": r(c("totalnoncurasts")) + r(c("amortexpense")) + r(c("intangibles")),
        "TotalLiabilities": z(numeric18(c("totalnoncurliabs"))) + z(numeric18(c("totalcurliabs"))),
    }
    receivables = r(z(numeric18(c("acctsrectrade"))) - z(numeric18(c("baddebtreserve"))))
    pairs = {
        "AccountsPayable": r(c("acctspaytrade")),
        "CurrentAssets": r(c("totalcurassets")),
        "CurrentLiabilities": r(c("totalcurliabs")),
        "Inventory": r(c("totalinventory")),
        "NetIncome": r(c("netprofit")),
        "NetSales": r(c("netsales")),
        "TotalAssets": r(c("totalassets")),
    }
    exprs.update(
        {
            "AccountsPayableCurrent": pairs["AccountsPayable"],
            "Accounts Payable (A/P) Prior Year": pairs["AccountsPayable"],
            "AccountsReceivableCurrent": receivables,
            "Accounts Receivable (A/R) Prior Year": receivables,
            "CurrentAssetsCurrent": pairs["CurrentAssets"],
            "Current Assets Prior Year": pairs["CurrentAssets"],
            "CurrentLiabilitiesCurrent": pairs["CurrentLiabilities"],
            "Current Liabilities Prior Year": pairs["CurrentLiabilities"],
            "Inventory Current": pairs["Inventory"],
            "Inventory Prior Year": pairs["Inventory"],
            "NetIncomeCurrent": pairs["NetIncome"],
            "Net Income Prior Year": pairs["NetIncome"],
            "NetSalesCurrent": pairs["NetSales"],
            "Net Sales Prior Year": pairs["NetSales"],
            "TotalAssetsCurrent": pairs["TotalAssets"],
            "Total Assets Prior Year": pairs["TotalAssets"],
        }
    )
    return [exprs[name].alias(name) for name in METRIC_COLUMNS]


def statement_metrics(periods: DataFrame, aod_col: str = "asofdate") -> DataFrame:
    """Line keys plus the 30 metric columns for each period-tagged statement,
    as DISTINCT rows (a key with several measure rows has several lines).

    In the latest-snapshot mode the measures travel with the row, so no
    lookup join back into the history is needed; the rows are already
    partitioned by entity, so the DISTINCT moves nothing.
    """
    return periods.select(
        "TimeFrame",
        "entityid",
        "statementdatekey_",
        "statementmonths",
        "pkid_",
        "CF_Type",
        F.col(aod_col).alias("AOD"),
        *metric_columns(),
    ).distinct()
