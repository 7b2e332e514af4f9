from finwater.operators.columns import find_columns, find_columns_by_object
from finwater.sources.catalog import columns_from_catalog, columns_from_parquet_dir


def test_find_columns_parquet_dir(spark):
    meta = columns_from_parquet_dir(spark, "/root/testdata/sf0.001")
    got = [(r["TableName"], r["ColumnName"]) for r in find_columns(meta, "%CUSTKEY%").collect()]
    assert got == [("customer", "c_custkey"), ("orders", "o_custkey")]  # case-insensitive, sorted
    assert find_columns(meta, "%CUSTKEY%", case_sensitive=True).count() == 0
    assert find_columns(meta, "%custkey%", catalog="elsewhere").count() == 0
    by_obj = [(r["TableName"], r["ColumnName"]) for r in find_columns_by_object(meta, "%custkey%").collect()]
    assert by_obj == got


def test_find_columns_catalog(spark):
    spark.range(3).selectExpr("id AS lender_id", "id AS amount").createOrReplaceTempView("loans_tmp")
    meta = columns_from_catalog(spark)
    got = [(r["TableName"], r["ColumnName"]) for r in find_columns(meta, "%Lender%").collect()]
    assert ("loans_tmp", "lender_id") in got
