from pyspark.sql import functions as F

from finwater.schema import KEY_COLUMNS, MEASURES
from finwater.sources.statements import (
    derived_statements,
    fixture_history_path,
    fixture_latest_asof,
    fixture_statements,
    snapshot_dates,
)

SF = "/root/testdata/sf0.001"


def test_materialised_history_equals_the_derivation(spark):
    cols = KEY_COLUMNS + MEASURES
    cached = fixture_statements(spark, SF).select(*cols)
    fresh = derived_statements(spark, SF).select(*cols)
    assert cached.exceptAll(fresh).count() == 0 and fresh.exceptAll(cached).count() == 0


def test_snapshot_dates_from_folders(spark):
    path = fixture_history_path(spark, SF)
    dates = snapshot_dates(spark, path)
    assert [str(d) for d in dates] == ["2024-11-30", "2024-12-31"]
    assert fixture_latest_asof(spark, SF) == fixture_statements(spark, SF).agg(F.max("asofdate")).first()[0]


def test_history_read_normalises_text_dates(spark, scratch):
    from finwater.sources.statements import read_statements

    src = derived_statements(spark, SF).withColumn("statementdatekey_", F.date_format("statementdatekey_", "yyyyMMdd"))
    src = src.drop("pkid_").withColumn("asofdate", F.col("asofdate").cast("timestamp"))
    src.write.parquet(scratch + "/h")
    back = read_statements(spark, scratch + "/h")
    assert dict(back.dtypes)["statementdatekey_"] == "date" and dict(back.dtypes)["asofdate"] == "date"
    assert back.filter(F.col("pkid_").isNull()).count() == 0
    ref = fixture_statements(spark, SF).select(*(KEY_COLUMNS + MEASURES))
    assert back.select(*(KEY_COLUMNS + MEASURES)).exceptAll(ref).count() == 0


def test_copies_follow_path_and_content(spark, scratch):
    """Two folders of the same leaf name, and a changed table, get copies of
    their own."""
    import os

    from finwater.sources.csv_drop import sales_target_drop

    orders = spark.read.parquet(f"{SF}/orders.parquet")
    counts = []
    for k, n in (("a", 40), ("b", 70)):
        os.makedirs(f"{scratch}/{k}/sf0.001")
        orders.limit(n).coalesce(1).write.parquet(f"{scratch}/{k}/sf0.001/orders.parquet")
        for t in ("customer", "nation"):
            spark.read.parquet(f"{SF}/{t}.parquet").write.parquet(f"{scratch}/{k}/sf0.001/{t}.parquet")
        counts.append(fixture_statements(spark, f"{scratch}/{k}/sf0.001").filter("asofdate = '2024-12-31'").count())
    assert counts == [40, 70]
    assert sales_target_drop(spark, f"{scratch}/a/sf0.001") != sales_target_drop(spark, f"{scratch}/b/sf0.001")
    orders.limit(90).coalesce(1).write.mode("overwrite").parquet(f"{scratch}/a/sf0.001/orders.parquet")
    assert fixture_statements(spark, f"{scratch}/a/sf0.001").filter("asofdate = '2024-12-31'").count() == 90


def test_unreadable_statement_dates(spark, scratch):
    import pytest

    from finwater.sources.statements import read_statements, unreadable_dates

    text = F.when(F.col("statementid") == 1, "2024013X").when(F.col("statementid") == 2, "31/01/2024").otherwise(
        F.date_format("statementdatekey_", "yyyyMMdd")
    )
    src = derived_statements(spark, SF).withColumn("statementdatekey_", text)
    src.write.parquet(scratch + "/h")
    with pytest.raises(Exception, match="not a statement date"):
        read_statements(spark, scratch + "/h").collect()
    good, bad = read_statements(spark, scratch + "/h", bad_dates="quarantine"), unreadable_dates(spark, scratch + "/h")
    assert {r["statementid"] for r in bad.collect()} <= {1, 2} and bad.count() > 0
    assert good.count() + bad.count() == src.count() and good.filter("statementdatekey_ IS NULL").count() == 0


def test_history_is_written_without_moving_wide_rows(spark, tmp_path, monkeypatch):
    """Only narrow rows are shuffled, and no sort by snapshot precedes the write."""
    from finwater.sources.statements import materialize_history

    key = "spark.sql.maxConcurrentOutputFileWriters"
    widths, writers, before = [], [], spark.conf.get(key, None)
    frame = spark.range(1)
    dealt, written = type(frame).repartition, type(frame.write).parquet
    monkeypatch.setattr(type(frame), "repartition", lambda self, *a: widths.append(len(self.columns)) or dealt(self, *a))
    monkeypatch.setattr(type(frame.write), "parquet", lambda self, *a, **k: writers.append(spark.conf.get(key, None)) or written(self, *a, **k))
    src = derived_statements(spark, SF)
    path = materialize_history(src, str(tmp_path / "history"))
    assert max(widths, default=0) <= 5 and writers and int(writers[-1] or 0) >= 2
    assert spark.conf.get(key, None) == before
    got, want = spark.read.parquet(path).select(*src.columns), derived_statements(spark, SF)
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()
