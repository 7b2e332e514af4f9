"""Client financials: one wide row of current / prior totals per entity.

Default plan (``snapshots='latest'``):

1. newest snapshot only (literal date -> pushed filter / partition pruning),
   eligible rows, columns pruned to what the report reads;
2. dedup to one statement key per (entity, date, type) -- a rank filter whose
   limit is applied map-side first (exchange 1);
3. one repartition on ``entityid`` (exchange 2) serves the cohort ladder's
   windows, the period tags and the per-entity conditional sums;
4. constant columns; the customer join only multiplies rows when a customer
   id repeats: ids are counted first and the copies made in spread chunks.

``snapshots='all'`` reproduces the reference's lookups into every snapshot
(see ``finwater.plans.all_snapshots``).
"""

from __future__ import annotations

import datetime as dt
import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finwater.operators.cohorts import assign_cohorts
from finwater.operators.eligibility import dedup_statements, eligible
from finwater.operators.extras import trailing_window
from finwater.operators.metrics import statement_metrics
from finwater.operators.periods import assign_period
from finwater.operators.snapshot import latest_snapshot
from finwater.operators.totals import period_totals
from finwater.schema import DATE_LAST_AUDIT, KEY_COLUMNS, MEASURES, REPORT_COLUMNS

log = logging.getLogger(__name__)


def select_statements(
    stmts: DataFrame,
    as_of: dt.date | None = None,
    include_residual: bool = True,
    window: tuple[dt.date, int] | None = None,
    measures: bool = True,
) -> DataFrame:
    """Newest snapshot -> eligible -> dedup -> cohort ladder (tagged rows).

    ``measures=False`` reads and shuffles the key columns only.  Rows that are
    alike in every column are ranked as one and may repeat; what is made of
    them (cohort rows, statement lines) is distinct.

    ``window=(report_date, months)`` keeps only statements dated within that
    many months up to the report date before selection (the batch declares
    such a window but never applies it, so the default is none).
    """
    latest = latest_snapshot(stmts.select(*KEY_COLUMNS, *(MEASURES if measures else [])), as_of)
    if window is not None:
        latest = trailing_window(latest, window[0], window[1])
    return assign_cohorts(dedup_statements(eligible(latest), distinct=False), include_residual=include_residual)


def report_columns(totals: DataFrame) -> DataFrame:
    """Final 35-column layout; measures as DOUBLE (whole numbers, exact)."""
    consts = {
        "ENTITYID": F.col("entityid"),
        "Internal ID": F.lit(""),
        "Original Internal ID": F.lit(""),
        "ObligorName": F.lit(""),
        "DateOfFinancials": F.col("DateOfFinancials"),
        "DateLastAudit": F.lit(DATE_LAST_AUDIT),
    }
    cols = []
    for name in REPORT_COLUMNS:
        if name in consts:
            cols.append(consts[name].alias(name))
        else:
            cols.append(F.col(f"`{name}`").cast("double").alias(name))
    return totals.select(*cols)


COPY_CHUNK = 4096


def attach_customers(report: DataFrame, customers: DataFrame, chunk: int = COPY_CHUNK) -> DataFrame:
    """LEFT JOIN customers on id, none of whose columns are used.

    Its only effect is one copy of the report row per matching customer
    row.  Customers are first counted per id (a map-side combined
    aggregate, so a very frequent id arrives as one row), joined once to the
    report, and the copies are made in chunks of ``chunk`` that are spread
    over tasks before they are expanded -- a repeated id is split, never
    handled by one task.
    """
    counts = customers.groupBy(F.col("customerid").alias("ENTITYID")).agg(F.count(F.lit(1)).alias("_n"))
    joined = report.join(counts, "ENTITYID", "left").withColumn("_n", F.coalesce(F.col("_n"), F.lit(1)))
    chunks = joined.withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.floor((F.col("_n") - 1) / chunk))))
    spread = chunks.repartition("ENTITYID", "_chunk")
    copies = spread.withColumn(
        "_copy", F.explode(F.sequence(F.lit(1), F.least(F.lit(chunk), F.col("_n") - F.col("_chunk") * chunk)))
    )
    return copies.drop("_n", "_chunk", "_copy")


def client_financials(
    stmts: DataFrame,
    customers: DataFrame | None = None,
    as_of: dt.date | None = None,
    snapshots: str = "latest",
    window: tuple[dt.date, int] | None = None,
) -> DataFrame:
    if snapshots == "all":
        from finwater.plans.all_snapshots import client_financials_all_snapshots

        if window is not None:
            raise ValueError("the trailing window applies to the latest-snapshot mode")
        return client_financials_all_snapshots(stmts, customers, as_of)
    if snapshots != "latest":
        raise ValueError(f"snapshots must be 'latest' or 'all', not {snapshots!r}")
    log.info("client financials: snapshot %s", as_of if as_of is not None else "newest")
    tagged = select_statements(stmts, as_of, include_residual=False, window=window)
    totals = period_totals(statement_metrics(assign_period(tagged)))
    report = report_columns(totals)
    if customers is not None:
        report = attach_customers(report, customers)
    return report
