"""Current / prior period of each selected statement."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values: period slices (cohort, rank bound for current year) ---
# Rows ranked within the bound are current ('C'), the rest of the cohort is
# prior ('P'); a bound of None makes the whole cohort current.  Residual
# entities ('R') get no period and drop out of the report.
PERIOD_SLICES = [
    ("A", 1),
    ("C", None),
    ("B", 12),
    ("D", None),
    ("F", 4),
    ("G", None),
]


def assign_period(tagged: DataFrame) -> DataFrame:
    """Add ``TimeFrame`` ('C' / 'P') and drop statements outside every slice."""
    tf = None
    for tag, bound in PERIOD_SLICES:
        is_tag = F.col("CF_Type") == tag
        value = F.lit("C") if bound is None else F.when(F.col("ranked_order") <= bound, "C").otherwise("P")
        tf = F.when(is_tag, value) if tf is None else tf.when(is_tag, value)
    return tagged.withColumn("TimeFrame", tf).filter(F.col("TimeFrame").isNotNull())
