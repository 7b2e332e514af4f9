"""Run jobs with tasks that fail on their first attempt (local[4,4] retries
them) and print whether the results equal a clean run.  Used by
test_retries.py in a separate process (it needs its own SparkContext)."""

import json
import sys
import tempfile
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from finwater.operators.cohorts import assign_cohorts  # noqa: E402
from finwater.operators.eligibility import dedup_statements, eligible  # noqa: E402
from finwater.operators.loads import dense_ids  # noqa: E402
from finwater.operators.metrics import statement_metrics  # noqa: E402
from finwater.operators.periods import assign_period  # noqa: E402
from finwater.operators.snapshot import latest_snapshot  # noqa: E402
from finwater.operators.totals import period_totals  # noqa: E402
from finwater.sources.statements import fixture_statements, fixture_latest_asof  # noqa: E402


@F.udf(T.LongType())
def fail_first_attempt(x):
    ctx = TaskContext.get()
    if ctx is not None and ctx.attemptNumber() == 0 and ctx.partitionId() == 0:
        raise RuntimeError("injected task failure")
    return x


def report(st, as_of, flaky: bool):
    latest = latest_snapshot(st, as_of)
    if flaky:  # fails in the scan stage
        latest = latest.withColumn("entityid", fail_first_attempt("entityid"))
    dd = dedup_statements(eligible(latest))
    if flaky:  # fails again after the dedup shuffle
        dd = dd.withColumn("entityid", fail_first_attempt("entityid"))
    return period_totals(statement_metrics(assign_period(assign_cohorts(dd, include_residual=False))))


def main():
    spark = (
        SparkSession.builder.master("local[4,4]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.checkpoint.dir", sys.argv[1] if len(sys.argv) > 1 else tempfile.mkdtemp())
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    sf = "/root/testdata/sf0.001"
    st = fixture_statements(spark, sf)
    as_of = fixture_latest_asof(spark, sf)
    clean = report(st, as_of, False)
    flaky = report(st, as_of, True)
    same_report = clean.exceptAll(flaky).count() == 0 and flaky.exceptAll(clean).count() == 0
    base = spark.range(0, 20000, numPartitions=6).select((F.col("id") % 997).alias("k"), F.col("id").alias("v"))
    ids_clean = dense_ids(base, ["k"]).select("ID", "k")
    ids_flaky = dense_ids(base.withColumn("v", fail_first_attempt("v")), ["k"]).select("ID", "k")
    rows = ids_flaky.collect()
    dense = sorted(r["ID"] for r in rows) == list(range(1, 20001))
    same_keys = ids_clean.groupBy("k").agg(F.min("ID"), F.max("ID")).exceptAll(
        ids_flaky.groupBy("k").agg(F.min("ID"), F.max("ID"))
    ).count() == 0
    print(json.dumps({"same_report": same_report, "rows": clean.count(), "dense_ids": dense, "same_id_ranges": same_keys}))
    spark.stop()


if __name__ == "__main__":
    main()
