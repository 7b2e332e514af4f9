"""Physical plan shape: what the plans must keep as the data grows."""

import datetime as dt
import re

from pyspark.sql import functions as F

from finwater.operators.eligibility import dedup_statements, eligible
from finwater.operators.ranking import topn_per_entity
from finwater.operators.snapshot import latest_snapshot
from finwater.plans.client_financials import client_financials
from finwater.schema import KEY_COLUMNS, MEASURES
from finwater.sources.statements import fixture_history_path, fixture_statements, read_statements, snapshot_dates

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(plan: str) -> list[str]:
    return re.findall(r"Exchange (\w+)\(([^,\)]*)", plan)


def test_report_plan_one_scan_two_exchanges(spark):
    st = fixture_statements(spark, SF)
    as_of = snapshot_dates(spark, fixture_history_path(spark, SF))[-1]
    plan = plan_of(client_financials(st, as_of=as_of))
    assert plan.count("FileScan parquet") == 1
    assert re.search(r"PartitionFilters: \[[^\]]*asofdate[^\]]*= 2024-12-31", plan)
    ex = exchanges(plan)
    # dedup (map-side combined, keyed by entity/date/type) + one entity shuffle
    assert len(ex) == 2, ex
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" not in plan  # no join back into the history
    # the dedup's sort aggregate (partial + final) and one sort for all entity windows
    assert plan.count("Sort [") <= 3


def test_eligibility_reaches_the_scan(spark, scratch):
    st = fixture_statements(spark, SF)
    path = scratch + "/hist"
    st.write.partitionBy("asofdate").parquet(path)
    df = eligible(latest_snapshot(read_statements(spark, path), dt.date(2024, 12, 31))).select("entityid", "netsales")
    plan = plan_of(df)
    assert "PushedFilters: [" in plan and "In(auditmethod" in plan
    assert re.search(r"ReadSchema: struct<entityid:bigint,auditmethod:string,statementtype:string,netsales:double>", plan)


def test_topn_uses_window_group_limit(spark):
    st = fixture_statements(spark, SF)
    plan = plan_of(topn_per_entity(dedup_statements(eligible(latest_snapshot(st, dt.date(2024, 12, 31)))), 2))
    assert "WindowGroupLimit" in plan


def test_hot_entity_is_combined_before_the_entity_shuffle(spark):
    from golden import frame, months_back, row

    # one entity with a third of the rows: 30 copies of each of its statements
    dates = months_back(24, 1)
    hot = [row(7, 1000 + 100 * k + i, d, 1) for i, d in enumerate(dates) for k in range(30)]
    cold = [row(e, i, d, 1) for e in range(100, 160) for i, d in enumerate(dates[:4])]
    dd = dedup_statements(eligible(frame(spark, hot + cold).select(*KEY_COLUMNS, *MEASURES)))
    per = {r["entityid"]: r["n"] for r in dd.groupBy("entityid").agg(F.count("*").alias("n")).collect()}
    assert per[7] == 24  # one row per (date, type) reaches the entity stage
    plan = plan_of(dd)
    assert plan.count("SortAggregate") >= 2 or plan.count("HashAggregate") >= 2  # partial + final


KEY_ONLY = [
    "ranked_statements", "topn_per_entity", "coverage_filter", "cohort_union", "cohort_waterfall", "period_assignment",
    "contiguous_coverage", "cohort_annual_24", "cohort_monthly_24", "cohort_monthly_12", "cohort_annual_12",
    "cohort_quarterly_24", "cohort_quarterly_12", "cohort_residual",
]


def test_key_queries_read_no_measure(spark):
    import __spark_entry__ as E

    for key in KEY_ONLY:
        scans = re.findall(r"FileScan parquet \[([^\]]*)\]", plan_of(E.queries()[key](spark, SF)))
        read = {c.split("#")[0] for s in scans for c in s.split(",")}
        assert scans and "more fields" not in str(scans) and not read & set(MEASURES), key


def test_bridge_join_is_free_of_the_hot_entity(spark):
    """One entity with a third of all (repeated) rows: both sides are distinct
    before the join and nothing depends on its partitioning after it."""
    from finwater.operators.extras import entity_system_ids
    from golden import frame, months_back, row

    dates = months_back(12, 1)
    hot = [row(7, i, d, 1) for i, d in enumerate(dates)] * 50
    cold = [row(100 + k, i, d, 1) for k in range(100) for i, d in enumerate(dates)]
    st = frame(spark, hot + cold).select(*KEY_COLUMNS)
    bridge = spark.createDataFrame([("S1", 7), ("S1", 7), ("S2", 7), ("S3", 101)], "systemid string, entityid long")
    out = entity_system_ids(st, bridge)
    assert out.filter("entityid = 7").count() == 24 and out.distinct().count() == out.count() == 24 + 1200
    plan = plan_of(out)
    join = min(plan.index(j) for j in ("SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin") if j in plan)
    assert "Aggregate" not in plan[:join]
    # the aggregate combines the copies before its exchange, which hashes all columns
    parts = st.distinct().repartition(1).count()
    assert parts == 12 + 1200


def test_all_snapshots_plan(spark):
    """Few exchanges, and the history cut to the chosen keys before its own."""
    st = fixture_statements(spark, SF)
    as_of = snapshot_dates(spark, fixture_history_path(spark, SF))[-1]
    from finwater.operators.periods import assign_period
    from finwater.plans.all_snapshots import select_statements_all

    selection = plan_of(assign_period(select_statements_all(st, as_of=as_of)))
    hashed = lambda plan: [e for e in exchanges(plan) if e[0] == "hashpartitioning"]
    assert len(hashed(selection)) == 2, hashed(selection)  # dedup group, entity
    report = plan_of(client_financials(st, as_of=as_of, snapshots="all"))
    assert len(hashed(report)) <= 3, hashed(report)  # slices, history, totals
    # the history is cut by a broadcast of the chosen keys between its scan and its exchange
    after = report[: report.index("FileScan parquet")]
    assert "LeftSemi" in after[after.rindex("Exchange hashpartitioning") :]
    assert len(hashed(selection)) + len(hashed(report)) + 1 <= 6  # and one to find colliding keys


def test_load_plan_has_one_range_exchange(spark):
    from finwater.operators.loads import good_lines, map_rep_columns, range_sorted, validate_fields
    from finwater.plans.rep_load import ID_ORDER
    from finwater.sources.csv_drop import read_drop_text, sales_target_drop

    rows = good_lines(validate_fields(read_drop_text(spark, sales_target_drop(spark, SF))))
    plan = plan_of(range_sorted(map_rep_columns(rows), ID_ORDER))
    assert plan.count("FileScan csv") == 1 and [e[0] for e in exchanges(plan)] == ["rangepartitioning"]
    assert "BatchEvalPython" not in plan and "MapInArrow" not in plan
