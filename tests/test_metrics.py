from finwater.plans.client_financials import client_financials
from golden import frame, months_back, row


def report(spark, rows):
    return {r["ENTITYID"]: r.asDict() for r in client_financials(frame(spark, rows)).collect()}


def test_null_rules(spark):
    d = months_back(1, 12)
    out = report(spark, [row(51, 1, d[0], 12, amortexpense=None, netfixedassets=2.0, deprecexpense=3.0)])[51]
    assert out["CapitalExpenditures"] == 5.0        # missing part counts 0
    assert out["TangibleAssets"] is None            # missing part makes it NULL
    assert out["DepreciationAmortization"] is None
    assert out["NetSalesPriorYear"] is None         # single annual: no prior rows


def test_rounding_half_away_from_zero(spark):
    d = months_back(1, 12)
    out = report(spark, [row(52, 1, d[0], 12, netsales=2.5, netprofit=-2.5, totalcurliabs=2.5, totalnoncurliabs=-2.5)])[52]
    assert out["NetSalesCurrent"] == 3.0 and out["NetIncomeCurrent"] == -3.0
    assert out["TotalLiabilities"] == 0.0  # numeric(18,0): 3 + (-3)


def test_fallbacks_and_maturities(spark):
    d = months_back(1, 12)
    out = report(spark, [row(53, 1, d[0], 12, fixedassets=None, netfixedassets=8.4, minorityinterest=None,
                             minintequity=4.6, cpltd=30.0)])[53]
    assert out["FixedAssets"] == 8.0 and out["MinorityInterest"] == 5.0
    assert out["CurrentMaturitiesLongTermDebt"] == 3.0  # round(30 / 12)


def test_current_prior_split_and_date(spark):
    rows = [row(54, 1, d, 12, netsales=float(10 * (i + 1))) for i, d in enumerate(months_back(2, 12))]
    out = report(spark, rows)[54]
    assert out["NetSalesCurrent"] == 10.0 and out["NetSalesPriorYear"] == 20.0
    assert str(out["DateOfFinancials"]) == "2024-12-31" and out["DateLastAudit"] == "12/31/9999"


def test_customer_copies_split_in_chunks(spark):
    from pyspark.sql import functions as F

    from finwater.plans.client_financials import attach_customers

    report = spark.range(5).select(F.col("id").alias("ENTITYID"), F.lit(1.0).alias("x"))
    customers = spark.range(10_000).select(F.when(F.col("id") < 9_000, F.lit(2)).otherwise(F.col("id") % 3).alias("customerid"))
    out = attach_customers(report, customers, chunk=1000)
    got = {r["ENTITYID"]: r["n"] for r in out.groupBy("ENTITYID").agg(F.count("*").alias("n")).collect()}
    assert got == {0: 334, 1: 333, 2: 9_333, 3: 1, 4: 1}


def test_all_snapshots_totals_by_hand(spark):
    """Entity 5: statements 1 (newest, annual) and 2 (annual, year before).
    Statement 1 sits in two snapshots with different net sales, statement 2
    in one.  Current = 2 dates x (100 + 110); prior = 1 date x 40."""
    from golden import OLDER, months_back

    d = months_back(2, 12)
    rows = [
        row(5, 1, d[0], 12, netsales=100.0, totalassets=7.0),
        row(5, 1, d[0], 12, netsales=110.0, totalassets=7.0, asof=OLDER),
        row(5, 2, d[1], 12, netsales=40.0, totalassets=3.0),
    ]
    out = {r["ENTITYID"]: r for r in client_financials(frame(spark, rows), snapshots="all").collect()}[5]
    assert out["NetSalesCurrent"] == 2 * (100.0 + 110.0)
    assert out["NetSalesPriorYear"] == 40.0
    # DISTINCT runs over the whole metric row: the two rows differ in net
    # sales, so an equal metric still counts twice per snapshot date
    assert out["TotalAssetsCurrent"] == 2 * 2 * 7.0
    latest = {r["ENTITYID"]: r for r in client_financials(frame(spark, rows)).collect()}[5]
    assert latest["NetSalesCurrent"] == 100.0 and latest["TotalAssetsCurrent"] == 7.0
