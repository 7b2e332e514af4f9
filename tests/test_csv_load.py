import os

import pytest
from pyspark.sql import functions as F

from finwater.operators.loads import dense_ids, quarantine, validate_fields
from finwater.plans.rep_load import load_rep_targets
from finwater.sinks import read_version
from finwater.sources.csv_drop import DropFormat, read_drop_text, read_drop_typed

HEADER = "FirstName,LastName,SalesQuantity,SalesRevenue ,Year"


def drop(folder, name, lines, header=HEADER, raw: bytes | None = None):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "wb") as fh:
        fh.write(raw if raw is not None else ("\r\n".join([header, *lines]) + "\r\n").encode("ascii"))
    return path


GOOD = ["Ann,Lee,10,1000,2019", "Bo,Ng,20,2000,2020"]


def test_typed_read_and_header_check(spark, scratch):
    p = drop(scratch, "a.csv", GOOD)
    df = read_drop_typed(spark, p)
    assert [f.dataType.simpleString() for f in df.schema.fields] == ["string", "string", "smallint", "int", "smallint"]
    assert df.count() == 2
    bad_header = drop(scratch + "/h", "b.csv", GOOD, header="FirstName,LastName,SalesQuantity,SalesRevenue,Year")
    with pytest.raises(Exception):
        read_drop_text(spark, bad_header).collect()


@pytest.mark.parametrize(
    "line,column,code",
    [
        ("Ann,Lee,ten,1000,2019", "SalesQuantity", "conversion"),
        ("Ann,Lee,40000,1000,2019", "SalesQuantity", "conversion"),
        ("Annabell,Lee,10,1000,2019", "FirstName", "truncation"),
        ("Ann,Abcdefghijklmnopqr,10,1000,2019", "LastName", "truncation"),
        ("Ann,Lee,10,1000", "line", "layout"),
    ],
)
def test_strict_fails_and_quarantine_keeps(spark, scratch, line, column, code):
    p = drop(scratch, "bad.csv", GOOD + [line])
    validated = validate_fields(read_drop_text(spark, p))
    q = quarantine(validated).collect()
    assert [(r["ErrorColumn"], r["ErrorCode"]) for r in q] == [(column, code)]
    assert q[0]["raw_line"] == line
    with pytest.raises(Exception):
        load_rep_targets(spark, p, scratch + "/target", policy="strict")


def test_empty_fields_take_defaults(spark, scratch):
    p = drop(scratch, "e.csv", ["Ann,,,1000,2019"])
    out = load_rep_targets(spark, p, scratch + "/t", policy="strict").collect()[0]
    assert out["LastName"] == "" and out["TargetSalesQuantity"] == 0 and out["TargetYear"] == 2019


def test_load_types_ids_and_staged_replace(spark, scratch):
    target = scratch + "/target"
    p = drop(scratch + "/ok", "ok.csv", GOOD)
    out = load_rep_targets(spark, p, target, policy="strict")
    assert [f.dataType.simpleString() for f in out.schema.fields] == ["int", "string", "string", "int", "decimal(19,4)", "int"]
    assert sorted(r["ID"] for r in out.collect()) == [1, 2]
    bad = drop(scratch + "/bad", "bad.csv", GOOD + ["Annabell,Lee,10,1000,2019"])
    with pytest.raises(Exception):
        load_rep_targets(spark, bad, target, policy="strict")
    assert read_version(spark, target).count() == 2  # the old table survives a failed load


def test_code_page_bytes(spark, scratch):
    raw = (HEADER + "\r\n").encode("ascii") + b"Jos\xe9,Lee,1,2,2020\r\n"
    p = drop(scratch, "cp.csv", [], raw=raw)
    assert read_drop_text(spark, p).first()["FirstName"] == "José"


def test_dense_ids_are_1_to_n(spark):
    df = spark.range(0, 5000, numPartitions=7).select((F.col("id") * 7919 % 5000).alias("k"))
    ids = dense_ids(df, ["k"]).collect()
    assert sorted(r["ID"] for r in ids) == list(range(1, 5001))
    assert all(r["ID"] == r["k"] + 1 for r in ids)


def test_quarantine_policy_loads_good_lines(spark, scratch):
    p = drop(scratch, "m.csv", GOOD + ["Annabell,Lee,10,1000,2019", "Ann,Lee,x,1,2019"])
    out = load_rep_targets(spark, p, scratch + "/t", policy="quarantine", quarantine_path=scratch + "/q")
    assert out.count() == 2 and spark.read.parquet(scratch + "/q").count() == 2


def test_streaming_drop_loader(spark, scratch):
    from finwater.streaming import start_drop_loader

    folder = scratch + "/drops"
    drop(folder, "f1.csv", GOOD)
    q = start_drop_loader(spark, folder, scratch + "/st", scratch + "/sq", scratch + "/ck")
    q.awaitTermination(120)
    drop(folder, "f2.csv", ["Cy,Wu,5,50,2021", "Annabell,Lee,10,1000,2019"])
    q = start_drop_loader(spark, folder, scratch + "/st", scratch + "/sq", scratch + "/ck")
    q.awaitTermination(120)
    target = spark.read.parquet(scratch + "/st")
    assert sorted(r["ID"] for r in target.collect()) == [1, 2, 3]
    assert spark.read.parquet(scratch + "/sq").count() == 1


def test_load_into_catalog_table_and_wider_names(spark, scratch):
    from finwater.plans.rep_load import load_rep_target_table

    p = drop(scratch, "t.csv", GOOD)
    out = load_rep_target_table(spark, p, "rep_performance_target_test")
    assert out.count() == 2
    bad = drop(scratch + "/b", "b.csv", GOOD + ["Annabell,Lee,10,1000,2019"])
    with pytest.raises(Exception):
        load_rep_target_table(spark, bad, "rep_performance_target_test")
    assert spark.table("rep_performance_target_test").count() == 2
    spark.sql("DROP TABLE rep_performance_target_test")


def test_windows_1252_code_page(spark, scratch):
    raw = (HEADER + "\r\n").encode("ascii") + b"\x80uro,Lee,1,2,2020\r\n"
    p = drop(scratch, "w.csv", [], raw=raw)
    assert read_drop_text(spark, p).first()["FirstName"] == "€uro"  # the default code page
    assert read_drop_text(spark, p, DropFormat(encoding="ISO-8859-1")).first()["FirstName"] == "\x80uro"


def test_target_name_width_parameter(spark, scratch):
    p = drop(scratch, "nw.csv", GOOD)
    assert load_rep_targets(spark, p, scratch + "/t255", name_width=255).count() == 2
    with pytest.raises(Exception):  # 'Ann' does not fit a 2-wide target column
        load_rep_targets(spark, p, scratch + "/t2", name_width=2).collect()


def test_streaming_several_batches_in_one_run(spark, scratch):
    from finwater.streaming import start_drop_loader

    folder = scratch + "/drops3"
    drop(folder, "a.csv", GOOD)
    drop(folder, "b.csv", ["Cy,Wu,5,50,2021"])
    drop(folder, "c.csv", ["Di,Xu,6,60,2022", "Ed,Yu,7,70,2023"])
    q = start_drop_loader(spark, folder, scratch + "/st3", scratch + "/sq3", scratch + "/ck3", max_files_per_trigger=1)
    q.awaitTermination(180)
    target = spark.read.parquet(scratch + "/st3")
    assert target.select("epoch").distinct().count() == 3  # one micro-batch per file
    assert sorted(r["ID"] for r in target.collect()) == [1, 2, 3, 4, 5]


def test_every_1252_byte_in_batch_table_and_stream(spark, scratch):
    from finwater.plans.rep_load import load_rep_target_table
    from finwater.streaming import start_drop_loader

    undefined = {0x81, 0x8D, 0x8F, 0x90, 0x9D}
    high = [b for b in range(0x80, 0x100) if b not in undefined]
    raw = (HEADER + "\r\n").encode("ascii") + b"".join(b"A%c,L%d,1,2,2020\r\n" % (b, b) for b in high)
    want = {f"L{b}": "A" + bytes([b]).decode("cp1252") for b in high}
    p = drop(scratch + "/d", "w.csv", [], raw=raw)
    names = lambda df: {r["LastName"]: r["FirstName"] for r in df.collect()}
    assert names(load_rep_targets(spark, p, scratch + "/t")) == want
    assert names(load_rep_target_table(spark, p, "rep_1252_test")) == want
    spark.sql("DROP TABLE rep_1252_test")
    start_drop_loader(spark, scratch + "/d", scratch + "/st", scratch + "/sq", scratch + "/ck").awaitTermination(120)
    assert names(spark.read.parquet(scratch + "/st")) == want


def test_reader_parameters(spark, scratch):
    body = "Ann|'Le|e'|10|1000|2019;Bo|Ng|20|2000|2020;"
    p = drop(scratch + "/a", "a.csv", [], raw=(HEADER.replace(",", "|") + ";" + body).encode())
    fmt = DropFormat(sep="|", quote="'", line_sep=";")
    assert [r["LastName"] for r in read_drop_text(spark, p, fmt).collect()] == ["Le|e", "Ng"]
    bare = drop(scratch + "/b", "b.csv", [], raw=body.encode())
    assert read_drop_text(spark, bare, DropFormat(sep="|", quote="'", line_sep=";", header=False)).count() == 2
    # two files, each with a title line before the header and a unit line after it
    lines = ["Report of May", HEADER, "text,text,pieces,euro,year", *GOOD, "Cy,Wu,5"]
    for name in ("x.csv", "y.csv"):
        drop(scratch + "/c", name, [], raw=("\r\n".join(lines) + "\r\n").encode())
    skip = DropFormat(skip_header_rows=1, skip_rows=1)
    rows = read_drop_text(spark, scratch + "/c", skip).collect()
    assert sorted(r["LastName"] for r in rows) == ["Lee", "Lee", "Ng", "Ng", "Wu", "Wu"]
    assert load_rep_targets(spark, scratch + "/c", scratch + "/t", "quarantine", scratch + "/q", fmt=skip).count() == 4
    assert {r["raw_line"] for r in spark.read.parquet(scratch + "/q").collect()} == {"Cy,Wu,5"}
    with pytest.raises(Exception, match="header"):
        read_drop_text(spark, scratch + "/c", DropFormat(skip_header_rows=2, skip_rows=1)).collect()


def test_no_line_is_lost(spark, scratch):
    """The policy needs a path; every line is then loaded or set aside."""
    from finwater.plans.rep_load import load_rep_target_table

    p = drop(scratch, "m.csv", GOOD + ["Annabell,Lee,10,1000,2019", "Ann,Lee,x,1,2019", "Ann"])
    for load, to in ((load_rep_targets, scratch + "/t"), (load_rep_target_table, "rep_lost_test")):
        with pytest.raises(ValueError):
            load(spark, p, to, policy="quarantine")
        done = load(spark, p, to, policy="quarantine", quarantine_path=scratch + "/q")
        assert done.count() == 2 and spark.read.parquet(scratch + "/q").count() == 3
    spark.sql("DROP TABLE rep_lost_test")


def test_typed_read_fails_on_width(spark, scratch):
    p = drop(scratch, "w.csv", GOOD + ["Annabell,Lee,10,1000,2019"])
    with pytest.raises(Exception, match="FirstName is wider"):
        read_drop_typed(spark, p).collect()


@pytest.mark.parametrize("reuse", ["true", "false"])
@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_dense_ids_at_two_million_rows(spark, reuse, adaptive):
    """A column outside the sort keys, more shuffle partitions than AQE keeps."""
    conf = {"spark.sql.exchange.reuse": reuse, "spark.sql.adaptive.enabled": adaptive, "spark.sql.shuffle.partitions": "64"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        n = 2_000_000
        df = spark.range(0, n, numPartitions=16).select((F.col("id") * 7919 % 50_000).alias("k"), F.col("id").alias("v"))
        ids = dense_ids(df, ["k"])
        got = ids.agg(
            F.count(F.lit(1)).alias("n"), F.countDistinct("ID").alias("ids"), F.min("ID").alias("least"), F.max("ID").alias("most"),
            F.countDistinct("v").alias("rows"),
        ).first()
        assert tuple(got) == (n, n, 1, n, n)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
