"""The load's single commit, its accounts, and what the target declares."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from finwater.operators import constraints as con
from finwater.operators.loads import validate_fields
from finwater.plans import rep_load
from finwater.sinks import versioned
from finwater.sources.csv_drop import read_drop_text

HEADER = "FirstName,LastName,SalesQuantity,SalesRevenue ,Year"
GOOD = ["Ann,Lee,10,1000,2019", "Bo,Ng,20,2000,2020"]


def drop(folder, lines):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, "a.csv")
    with open(path, "wb") as f:
        f.write(("\r\n".join([HEADER, *lines]) + "\r\n").encode())
    return path


def test_versions_and_conflicts(spark, scratch):
    target, df = scratch + "/v", spark.range(5).toDF("n")
    with pytest.raises(FileNotFoundError):
        versioned.read_version(spark, target)
    for n in (1, 2, 3):
        folder = versioned.stage(df.limit(n), target)
        seen = versioned.current(spark, target)
        assert (seen["version"] if seen else 0) == n - 1  # staged is not published
        versioned.commit(spark, target, folder, df.schema, {"rows": n})
        assert versioned.read_version(spark, target).count() == n
    assert [m["facts"]["rows"] for m in versioned.history(spark, target)] == [1, 2, 3]
    assert versioned.read_version(spark, target, 1).count() == 1
    late = versioned.stage(df, target)
    with pytest.raises(versioned.CommitConflict):  # it started from version 2
        versioned.commit(spark, target, late, df.schema, base=2)
    assert versioned.read_version(spark, target).count() == 3
    assert versioned.remove_superseded(spark, target, keep=1) == 2
    assert versioned.read_version(spark, target).count() == 3 and len(versioned.history(spark, target)) == 1
    with pytest.raises(ValueError):
        versioned.read_version(spark, target, 1)


def test_empty_content_keeps_its_schema(spark, scratch):
    target, df = scratch + "/v", spark.range(0).toDF("n")
    versioned.commit(spark, target, versioned.stage(df, target), df.schema)
    assert versioned.read_version(spark, target).columns == ["n"] and versioned.read_version(spark, target).count() == 0


@pytest.mark.parametrize("at", ["stage", "commit"])
def test_killed_before_the_commit(spark, scratch, monkeypatch, at):
    target = scratch + "/t"
    rep_load.load_rep_targets(spark, drop(scratch + "/a", GOOD), target)
    killed = lambda *a, **k: (_ for _ in ()).throw(KeyboardInterrupt())
    monkeypatch.setattr(versioned, at, killed)
    with pytest.raises(KeyboardInterrupt):
        rep_load.load_rep_targets(spark, drop(scratch + "/b", GOOD[:1]), target)
    monkeypatch.undo()
    assert versioned.read_version(spark, target).count() == 2
    assert rep_load.load_rep_targets(spark, drop(scratch + "/b", GOOD[:1]), target).count() == 1


def test_readers_never_miss_the_target(spark, scratch):
    """A reader polls while loads replace the content."""
    target, seen, stop = scratch + "/t", [], threading.Event()
    rep_load.load_rep_targets(spark, drop(scratch + "/a", GOOD), target)

    def poll():
        while not stop.is_set():
            seen.append(versioned.read_version(spark, target).count())

    reader = threading.Thread(target=poll)
    reader.start()
    try:
        for n in (1, 2, 1):
            rep_load.load_rep_targets(spark, drop(f"{scratch}/d{n}", GOOD[:n]), target)
    finally:
        stop.set()
        reader.join()
    assert len(seen) > 3 and set(seen) <= {1, 2}


def test_catalogue_table_is_pointed_at_each_version(spark, scratch):
    load = lambda lines: rep_load.load_rep_target_table(spark, drop(scratch + "/d", lines), "rep_pointed")
    try:
        assert load(GOOD).count() == 2
        old = spark.table("rep_pointed").inputFiles()
        assert load(GOOD[:1]).count() == 1 and not set(old) & set(spark.table("rep_pointed").inputFiles())
        assert spark.read.parquet(*old).count() == 2  # readers of the old content keep it
    finally:
        spark.sql("DROP TABLE rep_pointed")


def test_drop_is_read_once(spark, scratch, monkeypatch):
    """The drop is gone once its lines are stored; the load goes on."""
    path = drop(scratch + "/d", [*GOOD, "Annabell,Lee,10,1000,2019"])
    keep = rep_load.store_checked
    plans = []

    def store(checked, to):
        plans.append(checked._jdf.queryExecution().executedPlan().toString())
        out = keep(checked, to)
        os.remove(path)
        return out

    monkeypatch.setattr(rep_load, "store_checked", store)
    done = rep_load.load_rep_targets(spark, path, scratch + "/t", "quarantine", scratch + "/q")
    assert done.count() == 2 and spark.read.parquet(scratch + "/q").count() == 1
    assert plans[0].count("FileScan csv") == 1


def test_accounts(spark, scratch):
    lines = [*GOOD, "Annabell,Lee,10,1000,2019", "Ann,Lee,x,1,2019", "Ann", "Cy,Wu,1,99,2020"]
    limits = con.with_limits(rep_load.REP_TARGET, TargetSalesRevenue={"least": 100})
    target, q = scratch + "/t", scratch + "/q"
    done = rep_load.load_rep_targets(spark, drop(scratch + "/d", lines), target, "quarantine", q, columns=limits)
    facts = versioned.current(spark, target)["facts"]
    assert facts == {"lines": 6, "source_errors": 3, "sink_errors": 1, "loaded": 2}
    assert done.count() == 2 and spark.read.parquet(q).count() == 3
    refused = spark.read.parquet(rep_load.sink_error_path(q)).collect()
    assert [tuple(r) for r in refused] == [("Cy,Wu,1,99,2020", con.RANGE_ERROR, 5)]
    with pytest.raises(rep_load.LoadError, match="refused line"):
        rep_load.load_rep_targets(spark, drop(scratch + "/e", lines[-1:]), target, columns=limits)
    assert not rep_load.Accounts(3, 1, 0, 1).agree()


def test_each_constraint_and_its_order(spark):
    columns = [
        con.TargetColumn("a", "string", 1, nullable=False, width=3), con.TargetColumn("b", "int", 2, least=0, most=10, default="7"),
        con.TargetColumn("c", "string", 3, nullable=False, default="'none'"),
    ]
    rows = [("x", 1, "y"), (None, 99, "y"), ("long", -1, "y"), ("x", -1, "y"), ("x", 11, "y"), ("x", None, None), ("", 0, "")]
    df = con.apply_defaults(spark.createDataFrame(rows, "a string, b int, c string"), columns)
    got = [tuple(r) for r in con.check_constraints(df, columns).collect()]
    assert got == [
        ("x", 1, "y", None, None), (None, 99, "y", con.NULL_ERROR, 1), ("long", -1, "y", con.WIDTH_ERROR, 1), ("x", -1, "y", con.RANGE_ERROR, 2),
        ("x", 11, "y", con.RANGE_ERROR, 2), ("x", 7, "none", None, None), ("", 0, "", None, None),  # empty text is no NULL
    ]
    assert con.check_constraints(df, []).filter("SinkErrorCode IS NOT NULL").count() == 0


def test_declaration_from_the_catalogue(spark, scratch):
    spark.sql("CREATE TABLE rep_declared (a STRING DEFAULT 'n/a', b INT DEFAULT 1 + 1, c INT) USING parquet")
    try:
        columns = con.declared_columns(spark, "rep_declared")
    finally:
        spark.sql("DROP TABLE rep_declared")
    df = spark.createDataFrame([(None, None, None), ("", 0, 0)], "a string, b int, c int")
    assert [tuple(r) for r in con.apply_defaults(df, columns).collect()] == [("n/a", 2, None), ("", 0, 0)]


def test_retained_nulls_and_empty_defaults_differ(spark, scratch):
    path = drop(scratch + "/d", ["Ann,,,1000,2019"])
    columns = con.with_limits(rep_load.REP_TARGET, LastName={"default": "'unknown'"}, TargetSalesQuantity={"default": "-1"})
    for retain, want in ((False, ("", 0)), (True, ("unknown", -1))):
        validated = validate_fields(read_drop_text(spark, path), retain_nulls=retain)
        row = rep_load.checked_lines(validated, columns).select("LastName", "TargetSalesQuantity", F.col("ErrorColumn")).first()
        assert tuple(row) == (*want, None)
