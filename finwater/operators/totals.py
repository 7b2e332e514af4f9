"""Per-entity current and prior totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finwater.schema import CURRENT_TOTALS, PRIOR_TOTALS

# current-year lines summed as NUMERIC (whole numbers) rather than float
NUMERIC_CURRENT = {"CapitalExpenditures"}


def _weighted(col, weight_col: str | None):
    return col if weight_col is None else col * F.col(weight_col)


def period_totals(metrics: DataFrame, weight_col: str | None = None) -> DataFrame:
    """Sum current lines over 'C' rows and prior lines over 'P' rows per entity.

    Conditional sums in one ``groupBy`` replace the split into two tables
    and their left join: an entity without prior rows gets NULL prior totals
    (a SUM over no rows), exactly as the join would give.  Entities are the
    ones with current rows.  ``DateOfFinancials`` is the newest statement
    date over both periods.  ``weight_col`` repeats a row's values (used by
    the all-snapshots mode instead of materialising copies).
    """
    is_c = F.col("TimeFrame") == "C"
    is_p = F.col("TimeFrame") == "P"
    aggs = []
    for out, src in CURRENT_TOTALS:
        v = F.col(f"`{src}`")
        if out in NUMERIC_CURRENT:
            v = v.cast("decimal(18,0)")
        aggs.append(F.sum(F.when(is_c, _weighted(v, weight_col))).alias(out))
    for out, src in PRIOR_TOTALS:
        aggs.append(F.sum(F.when(is_p, _weighted(F.col(f"`{src}`"), weight_col))).alias(out))
    aggs.append(F.max(F.col("statementdatekey_").cast("date")).alias("DateOfFinancials"))
    aggs.append(F.count(F.when(is_c, 1)).alias("_n_current"))
    return metrics.groupBy("entityid").agg(*aggs).filter(F.col("_n_current") > 0).drop("_n_current")
