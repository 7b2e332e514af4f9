"""The Bloom filter that cuts the history, and the plans that use it."""

import pytest
from pyspark.sql import functions as F
from test_plans import SF, exchanges, plan_of

from finwater.operators import key_filter as kf
from finwater.operators.periods import assign_period
from finwater.plans import all_snapshots as alls
from finwater.sources.statements import fixture_history_path, fixture_statements, snapshot_dates


def keys(spark, first, n):
    return spark.range(first, first + n).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"))


@pytest.mark.parametrize("n,most", [(0, 0.0), (1, 0.001), (20_000, 0.02)])
def test_no_key_is_lost_and_few_others_pass(spark, n, most):
    words = kf.size_for(n)
    found = kf.key_filter(keys(spark, 0, n), "key", words)
    assert kf.passing(keys(spark, 0, n), F.col("key"), found, words).count() == n
    others = kf.passing(keys(spark, 10_000_000, 50_000), F.col("key"), found, words)
    assert others.columns == ["key"] and others.count() <= most * 50_000


def test_filter_is_bounded(spark):
    assert kf.size_for(10**15) == kf.MAX_WORDS and kf.size_for(0) == kf.ROW
    # far too small a filter lets more pass, and still loses nothing
    found = kf.key_filter(keys(spark, 0, 30_000), "key", kf.ROW)
    assert found.count() == 1
    assert kf.passing(keys(spark, 0, 30_000), F.col("key"), found, kf.ROW).count() == 30_000


def test_null_keys_are_in_no_filter(spark):
    df = spark.createDataFrame([("a",), (None,), ("a",)], "key string")
    found = kf.key_filter(df, "key", kf.ROW)
    assert kf.passing(df, F.col("key"), found, kf.ROW).filter("key IS NOT NULL").count() == 2


@pytest.fixture(scope="module")
def chosen(spark):
    st = fixture_statements(spark, SF)
    as_of = snapshot_dates(spark, fixture_history_path(spark, SF))[-1]
    return st, assign_period(alls.select_statements_all(st, as_of=as_of))


def rows(df):
    return sorted(map(str, df.collect()))


def test_both_branches_agree(spark, chosen):
    st, periods = chosen
    for step in (alls.statement_snapshots, alls.slice_metrics_all):
        assert rows(step(st, periods)) == rows(step(st, periods, filter_keys=0))


def test_history_is_cut_before_its_exchange(spark, chosen):
    """By a broadcast semi-join, or beyond the bound by the Bloom filter: the
    history's side of the join has its filter between scan and exchange."""
    st, periods = chosen
    for limit, sign in ((alls.MAX_FILTER_KEYS, "LeftSemi"), (0, "BroadcastHashJoin")):
        plan = plan_of(alls.statement_snapshots(st, periods, filter_keys=limit))
        side = plan[: plan.index("FileScan parquet")]
        assert sign in side[side.rindex("Exchange hashpartitioning") :]
        assert len([e for e in exchanges(plan) if e[0] == "hashpartitioning"]) <= 2
        assert not any(x in plan for x in ("CartesianProduct", "NestedLoop", "Python", "Arrow"))


def test_history_rows_before_and_after(spark, chosen):
    st, periods = chosen
    hist = st.select(F.concat(F.col("entityid").cast("string"), F.col("statementid").cast("string")).alias("_key"))
    slices = periods.select(*alls.SLICE_KEYS).distinct()
    exact = alls._cut_history(hist, slices, alls.MAX_FILTER_KEYS).count()
    bloom = alls._cut_history(hist, slices, 0).count()
    assert exact <= bloom <= exact + 0.02 * hist.count() and bloom < hist.count()
