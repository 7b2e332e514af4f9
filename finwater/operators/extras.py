"""Steps the source batch only sketches (commented out): trailing date
window, contiguity of a statement run, and the entity -> system-id bridge."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from finwater.operators.ranking import newest_first_window


def trailing_window(df: DataFrame, as_of: dt.date, months: int = 12) -> DataFrame:
    """Statements dated within ``months`` months up to ``as_of`` (inclusive).

    ``add_months`` clamps to month end (2024-02-29 minus 12 -> 2023-02-28).
    Literal bounds reach the scan as pushed filters.
    """
    start = F.add_months(F.lit(as_of), -months)
    return df.filter(F.col("statementdatekey_").between(start, F.lit(as_of)))


def months_in_window(df: DataFrame, statement_months: int, as_of: dt.date, months: int = 12) -> DataFrame:
    """Statements of one length that also lie in the trailing window; both
    conditions reach the scan."""
    return trailing_window(df, as_of, months).filter(F.col("statementmonths") == statement_months)


def newest_statement_date(df: DataFrame) -> dt.date | None:
    """One scalar to the driver (the newest statement date)."""
    return df.select(F.max("statementdatekey_").alias("m")).first()["m"]


def contiguous_coverage(dd: DataFrame) -> DataFrame:
    """Per entity and statement length: the newest unbroken run.

    Walking newest first, a statement continues the run when it ends
    exactly ``statementmonths`` months before the newer one (month ends
    compared with ``last_day``).  Reports the run's statements and months and
    whether it covers 24 and 12 months.  Rows per entity are bounded after
    dedup, so the windows stay small.
    """
    # one exchange serves the DISTINCT and the windows
    rows = dd.select("entityid", "statementmonths", "statementdatekey_", "pkid_")
    dd = rows.repartition("entityid", "statementmonths").distinct()
    w = newest_first_window("entityid", "statementmonths")
    newer = F.lag("statementdatekey_").over(w)
    expected = F.last_day(F.add_months(newer, -F.col("statementmonths")))
    flagged = dd.withColumn(
        "_breaks", F.when(newer.isNull(), F.lit(0)).when(F.col("statementdatekey_") == expected, F.lit(0)).otherwise(F.lit(1))
    )
    run = flagged.withColumn(
        "_broken", F.sum("_breaks").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ).filter(F.col("_broken") == 0)
    out = run.groupBy("entityid", "statementmonths").agg(
        F.max("statementdatekey_").alias("newest_date"),
        F.min("statementdatekey_").alias("oldest_date"),
        F.count(F.lit(1)).alias("run_statements"),
    )
    months = F.col("run_statements") * F.col("statementmonths")
    return out.withColumn("run_months", months.cast("bigint")).withColumn("covers_24", months >= 24).withColumn(
        "covers_12", months >= 12
    )


def entity_system_ids(statements: DataFrame, bridge: DataFrame) -> DataFrame:
    """Statements with the system ids of their entity (left join on the
    distinct bridge; an entity with several ids repeats its rows), as
    DISTINCT rows.  Both sides are made distinct before the join -- the
    statements by a hash over all their columns, which spreads a hot entity
    -- so nothing after the join depends on its partitioning and adaptive
    execution may split a hot entity there."""
    ids = bridge.select("systemid", "entityid").distinct()
    return statements.distinct().join(ids, "entityid", "left")


def entity_bridge_from_customer(customer: DataFrame) -> DataFrame:
    """Bridge stand-in: the nation of each of an entity's customers as a
    system id."""
    return customer.select(
        F.concat(F.lit("SYS"), F.col("c_nationkey").cast("string")).alias("systemid"),
        F.floor(F.col("c_custkey") / 3).cast("bigint").alias("entityid"),
    )
