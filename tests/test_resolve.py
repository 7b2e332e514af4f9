"""Sources by name, and keys under a collation."""

import datetime as dt

import pytest

from finwater import cli
from finwater.operators import collated as cl
from finwater.sources.resolve import is_path, name_parts, partition_dates, read_source, table_name
from finwater.sources.statements import fixture_history_path, read_statements, snapshot_dates

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize(
    "name,parts",
    [
        ("a", ["a"]), ("a.b", ["a", "b"]), ("[My Db].[dbo].[T.1]", ["My Db", "dbo", "T.1"]), ("`a``b`.c", ["a`b", "c"]),
        ('"x""y".[z]]w]', ['x"y', "z]w"]), (" a . b ", ["a", "b"]),
    ],
)
def test_name_parts(name, parts):
    assert name_parts(name) == parts


@pytest.mark.parametrize("name", ["", "a.b.c.d", "a.", ".a", "a..b", "[a", "a b]"])
def test_bad_names(name):
    with pytest.raises(ValueError):
        name_parts(name)


def test_paths_and_names():
    assert is_path("/data/x") and is_path("s3://b/x") and not is_path("db.t") and not is_path("[a/b].[c]")


@pytest.fixture(scope="module")
def history(spark):
    path = fixture_history_path(spark, SF)
    spark.sql("CREATE DATABASE IF NOT EXISTS fin_test")
    spark.sql("DROP TABLE IF EXISTS fin_test.history")
    spark.catalog.createTable("fin_test.history", path=path, source="parquet")
    spark.catalog.recoverPartitions("fin_test.history")
    yield path, "[spark_catalog].[fin_test].[History]"
    spark.sql("DROP TABLE fin_test.history")


def test_history_from_the_catalogue(spark, history):
    path, name = history
    assert snapshot_dates(spark, name) == snapshot_dates(spark, path) == [dt.date(2024, 11, 30), dt.date(2024, 12, 31)]
    assert read_statements(spark, name).count() == read_statements(spark, path).count()
    plan = read_source(spark, name).filter("asofdate = DATE'2024-12-31'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(asofdate" in plan


def test_names_that_are_not_there(spark):
    with pytest.raises(LookupError):
        table_name(spark, "no_such_db.no_such_table")
    spark.range(3).createOrReplaceTempView("seen_view")
    assert read_source(spark, "seen_view").count() == 3 and partition_dates(spark, "seen_view", "asofdate") is None
    spark.catalog.dropTempView("seen_view")


def test_report_from_tables_by_the_command_line(spark, history, scratch):
    path, name = history
    for source, out in ((name, "/a"), (path, "/b")):
        cli.main(["report", "--history", source, "--out", scratch + out], spark=spark)
    a, b = (spark.read.parquet(scratch + x) for x in ("/a", "/b"))
    assert a.count() == b.count() > 0 and a.exceptAll(b).count() == 0


def test_collated_keys(spark):
    rows = [("ab", "x9", 1), ("AB  ", "X9 ", 2), ("Ab", "x10", 3), ("b", "y", 4), (None, "n", 5), (None, "N", 6)]
    df = spark.createDataFrame(rows, "k string, v string, n int")
    ids = lambda d: sorted(r["n"] for r in d.collect())
    # 'x9' is greater than 'x10' as text; both spellings of it stay, and null is a group
    assert ids(cl.dedup_collated(df, ["k"], "v")) == [1, 2, 4, 5, 6]
    ranks = {r["n"]: r["ranked_order"] for r in cl.ranked_collated(df, ["k"], ["v"]).collect()}
    assert ranks == {1: 1, 2: 1, 3: 2, 4: 1, 5: 1, 6: 1}
    right = spark.createDataFrame([("aB", "one"), ("c", "two")], "k string, name string")
    joined = {r["n"]: (r["k"], r["name"]) for r in cl.join_collated(df, right, "k").collect()}
    assert joined[2] == ("AB  ", "one") and joined[4] == ("b", None) and joined[5] == (None, None)
    assert cl.dedup_collated(df.limit(0), ["k"], "v").collect() == []
