"""Find tables holding a column whose name matches a LIKE pattern."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def find_columns(
    meta: DataFrame,
    pattern: str,
    catalog: str | None = None,
    case_sensitive: bool = False,
    order=("TableName", "ColumnName"),
) -> DataFrame:
    """``column_name LIKE pattern`` (case-insensitive by default, as under the
    usual database collation), optionally within one catalog, as
    (TableName, ColumnName) sorted by ``order``."""
    col = F.col("column_name")
    cond = col.like(pattern) if case_sensitive else col.ilike(pattern)
    if catalog is not None:
        cond = cond & (F.col("table_catalog") == catalog)
    out = meta.filter(cond).select(F.col("table_name").alias("TableName"), F.col("column_name").alias("ColumnName"))
    return out.orderBy(*order) if order else out


def find_columns_by_object(meta: DataFrame, pattern: str, case_sensitive: bool = False) -> DataFrame:
    """The tables / columns form: column rows joined to table rows by object id."""
    tables = meta.select("object_id", F.col("table_name").alias("name")).distinct()
    cols = meta.select("object_id", F.col("column_name").alias("name"))
    cond = F.col("c.name").like(pattern) if case_sensitive else F.col("c.name").ilike(pattern)
    return (
        cols.alias("c")
        .join(tables.alias("t"), F.col("c.object_id") == F.col("t.object_id"))
        .filter(cond)
        .select(F.col("t.name").alias("TableName"), F.col("c.name").alias("ColumnName"))
        .orderBy("TableName", "ColumnName")
    )


def column_metadata(meta: DataFrame, pattern: str, case_sensitive: bool = False) -> DataFrame:
    """Full metadata rows of matching columns, ordered by table name."""
    col = F.col("column_name")
    cond = col.like(pattern) if case_sensitive else col.ilike(pattern)
    return meta.filter(cond).drop("object_id").orderBy("table_name", "ordinal_position")
