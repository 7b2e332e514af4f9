import datetime as dt

import pytest
from pyspark.sql import functions as F

from finwater.cli import main
from finwater.plans.client_financials import client_financials
from finwater.sources.statements import fixture_history_path, fixture_statements

SF = "/root/testdata/sf0.001"


def test_report_and_window(spark, scratch):
    hist = fixture_history_path(spark, SF)
    main(["report", "--history", hist, "--out", scratch + "/r"], spark=spark)
    out = spark.read.parquet(scratch + "/r")
    assert out.count() == client_financials(fixture_statements(spark, SF)).count()
    main(["report", "--history", hist, "--window-months", "24", "--report-date", "1998-12-31",
          "--out", scratch + "/w", "--format", "csv"], spark=spark)
    assert spark.read.option("header", True).csv(scratch + "/w").count() <= out.count()


def test_window_limits_statements(spark):
    from finwater.plans.client_financials import select_statements

    st = fixture_statements(spark, SF)
    tagged = select_statements(st, window=(dt.date(1998, 12, 31), 24))
    assert tagged.filter(F.col("statementdatekey_") < F.lit(dt.date(1996, 12, 31))).count() == 0


def test_find_columns_cli(spark):
    res = main(["find-columns", "--pattern", "%regionkey%", "--parquet-dir", SF], spark=spark)
    assert res["matches"] == [["nation", "n_regionkey"], ["region", "r_regionkey"]]


def test_report_entities_are_the_non_residual_ones(spark):
    from finwater.operators.cohorts import entity_cohorts
    from finwater.plans.client_financials import select_statements

    st = fixture_statements(spark, "/root/testdata/sf0.01")
    report = {r["ENTITYID"] for r in client_financials(st).select("ENTITYID").collect()}
    placed = {r["entityid"] for r in entity_cohorts(select_statements(st)).filter("CF_Type != 'R'").collect()}
    assert report == placed


def test_load_cli(spark, scratch):
    import os

    os.makedirs(scratch + "/d", exist_ok=True)
    with open(scratch + "/d/a.csv", "wb") as fh:
        fh.write(b"FirstName,LastName,SalesQuantity,SalesRevenue ,Year\r\nAnn,Lee,10,1000,2019\r\nAnnabell,Lee,1,1,2019\r\n")
    res = main(["load", "--drop", scratch + "/d", "--target", scratch + "/t", "--policy", "quarantine",
                "--quarantine", scratch + "/q"], spark=spark)
    assert res == {"job": "load", "rows": 1}
    assert spark.read.parquet(scratch + "/q").count() == 1
    with pytest.raises(SystemExit):
        main(["load", "--drop", scratch + "/d", "--table", "cli_target_test", "--policy", "quarantine"], spark=spark)
    res = main(["load", "--drop", scratch + "/d", "--table", "cli_target_test", "--policy", "quarantine",
                "--quarantine", scratch + "/q2", "--encoding", "ISO-8859-1"], spark=spark)
    assert res["rows"] == 1 and spark.read.parquet(scratch + "/q2").count() == 1
    spark.sql("DROP TABLE cli_target_test")
