"""Newest-first ranking and top-N per group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F



def newest_first() -> list:
    """Statement order: newest date first; equal dates by key text, greatest first."""
    return [F.col("statementdatekey_").desc(), F.col("pkid_").desc()]


#: Remaining key columns, in the order that ranks rows of one key text.
KEY_TIES = ["statementmonths", "statementtype", "auditmethod", "statementid"]


def key_order(df: DataFrame) -> list:
    """``newest_first`` over distinct key rows: rows alike in all key columns
    (they differ in measures) are one statement and share a rank."""
    return [*newest_first(), *[F.col(c) for c in KEY_TIES if c in df.columns]]


def newest_first_window(*partition_cols: str):
    return Window.partitionBy(*partition_cols).orderBy(*newest_first())


def ranked_statements(df: DataFrame, partition_cols=("entityid",), rank_col: str = "ranked_order") -> DataFrame:
    """Newest first over distinct statements, with a total order (date, key
    text, other key columns): ``ROW_NUMBER`` over distinct key rows."""
    order = Window.partitionBy(*partition_cols).orderBy(*key_order(df))
    return df.withColumn(rank_col, F.dense_rank().over(order).cast("bigint"))


def topn_per_entity(df: DataFrame, n: int, partition_cols=("entityid",), rank_col: str = "ranked_order") -> DataFrame:
    """Newest ``n`` rows per group.

    A rank filter directly on the rank lets Catalyst plan a
    ``WindowGroupLimit``: a partial top-n per input partition before the
    shuffle, so a hot group ships at most n rows per map task.
    """
    return ranked_statements(df, partition_cols, rank_col).filter(F.col(rank_col) <= n)
