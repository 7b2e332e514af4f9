"""Snapshot selection (latest AsOfDate) and the statement rank columns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finwater.functions import audit_rank, statement_type_rank


def latest_asof(stmts: DataFrame) -> dt.date | None:
    """The newest snapshot date: one scalar to the driver.

    Reading only ``asofdate`` keeps the scan to one column (on a dataset
    partitioned by ``asofdate`` it is answered from folder names).  The value
    is then used as a literal, so the snapshot filter reaches the scan as a
    pushed filter / partition filter instead of a runtime subquery.
    """
    return stmts.select(F.max(F.to_date("asofdate")).alias("m")).first()["m"]


def latest_snapshot(stmts: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Rows of the newest snapshot (or of ``as_of`` when given)."""
    snap = as_of if as_of is not None else latest_asof(stmts)
    return stmts.filter(F.col("asofdate") == F.lit(snap))


def with_statement_ranks(df: DataFrame, collation: str | None = None) -> DataFrame:
    """Add ``Audit_Rank`` (1..5) and ``StatmentType_Rank`` (1..3); unknown -> NULL.
    ``collation`` compares as ``eligible`` does."""
    return df.withColumn("Audit_Rank", audit_rank("auditmethod", collation)).withColumn(
        "StatmentType_Rank", statement_type_rank("statementtype", collation)
    )


def latest_statement_per_entity(latest: DataFrame) -> DataFrame:
    """Statements at each entity's newest statement date (within one snapshot).

    The per-entity max is a partial aggregate (map-side combine), and the
    semi-join back is keyed on (entity, date), so a hot entity spreads over
    its dates instead of landing in one task.
    """
    newest = latest.groupBy("entityid").agg(F.max("statementdatekey_").alias("statementdatekey_"))
    return (
        latest.join(newest, ["entityid", "statementdatekey_"], "left_semi")
        .select("entityid", "pkid_", F.col("statementdatekey_").alias("max_statementdate"))
        .distinct()
    )
