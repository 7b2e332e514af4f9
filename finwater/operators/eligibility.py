"""Eligibility filter and statement deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from finwater.schema import AUDIT_METHODS, EXCLUDED_TYPES

DEDUP_KEYS = ["entityid", "statementdatekey_", "statementtype"]


def eligible(
    df: DataFrame, methods=AUDIT_METHODS, excluded_types=EXCLUDED_TYPES, collation: str | None = None
) -> DataFrame:
    """Accepted audit method and a type outside the excluded list.

    ``NOT IN`` drops a NULL type as well (three-valued logic, same in Spark).
    A NULL entity never matches the work list, so it is dropped here.
    Comparison is exact by default; ``collation`` (e.g. ``UTF8_LCASE_RTRIM``:
    case-insensitive, trailing blanks ignored, as a database collation would
    compare) applies to both lists.  Exact matching keeps the filter
    pushable to the parquet scan.
    """
    method, stype = F.col("auditmethod"), F.col("statementtype")
    if collation:
        method, stype = F.collate(method, collation), F.collate(stype, collation)
    return df.filter(method.isin(list(methods)) & ~stype.isin(list(excluded_types)) & F.col("entityid").isNotNull())


def distinct_entities(df: DataFrame) -> DataFrame:
    """The work list: every entity with at least one eligible statement."""
    return eligible(df).select("entityid").distinct()


def dedup_statements(df: DataFrame, distinct: bool = True) -> DataFrame:
    """The statements of the greatest key text per (entity, statement date, type).

    ``pkid_`` is compared as text, so statement 9 beats statement 10.  A key
    that occurs several times keeps each of its distinct rows (they differ in
    other key columns or in measures).  ``rank() = 1`` plans a
    ``WindowGroupLimit``: every map task ships only the rows of its own
    greatest keys, so an entity holding a huge share of the rows arrives as a
    few rows per task; the DISTINCT needs no further shuffle.  It is left out
    (``distinct=False``) where later steps rank densely and end in a DISTINCT
    of their own.
    """
    newest_key = Window.partitionBy(*DEDUP_KEYS).orderBy(F.col("pkid_").desc())
    top = df.withColumn("_rank", F.rank().over(newest_key)).filter(F.col("_rank") == 1).drop("_rank")
    return top.distinct() if distinct else top


def dedup_statements_by_key_set(df: DataFrame) -> DataFrame:
    """Literal form: keep rows whose key is *any* group's max key.

    The key set is not tied to the group, so with colliding keys (entity 1 +
    statement 23 and entity 12 + statement 3 both read '123') a row can pass
    through another group's max.  Used by the reference-faithful mode.
    """
    # group maxima combine map-side (a hot entity sends one key per group);
    # the semi-join then moves rows by key text, which spreads a hot entity
    maxima = df.groupBy(*DEDUP_KEYS).agg(F.max("pkid_").alias("pkid_")).select("pkid_").distinct()
    return df.join(maxima, "pkid_", "left_semi")
