"""Keys compared as a database collation compares them.

The source batch runs where text is compared without case and without trailing
blanks, so 'ab', 'AB ' and 'Ab' are one key in its groups, maxima, ranks and
joins. Spark's collations do the same inside hash and sort operators; values
keep the bytes they came with, and where equal keys differ in bytes all their
rows are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Case-insensitive, trailing blanks ignored, otherwise by code point.
COLLATION = "UTF8_LCASE_RTRIM"


def collated(df: DataFrame, name: str, collation: str = COLLATION) -> Column:
    """A column for comparisons: text under the collation, others as they are."""
    c = F.col(f"`{name}`")
    return F.collate(c, collation) if df.schema[name].dataType.simpleString().startswith("string") else c


def dedup_collated(df: DataFrame, keys: list[str], greatest: str, collation: str = COLLATION) -> DataFrame:
    """The rows of the greatest ``greatest`` per group of ``keys``, both under
    the collation. ``rank() = 1`` limits each task to its own greatest rows
    before the shuffle."""
    order = Window.partitionBy(*[collated(df, k, collation) for k in keys]).orderBy(collated(df, greatest, collation).desc())
    return df.withColumn("_rank", F.rank().over(order)).filter(F.col("_rank") == 1).drop("_rank")


def ranked_collated(df: DataFrame, keys: list[str], order: list[str], collation: str = COLLATION) -> DataFrame:
    """``ranked_order``: dense rank inside a group, greatest first; equal keys
    share a rank."""
    over = Window.partitionBy(*[collated(df, k, collation) for k in keys]).orderBy(*[collated(df, o, collation).desc() for o in order])
    return df.withColumn("ranked_order", F.dense_rank().over(over))


def join_collated(left: DataFrame, right: DataFrame, key: str, how: str = "left", collation: str = COLLATION) -> DataFrame:
    """Equi-join on a text key under the collation; the left side's bytes stay."""
    other = right.withColumnRenamed(key, "_other_key")
    return left.join(other, collated(left, key, collation) == collated(other, "_other_key", collation), how).drop("_other_key")


def text_keys(statements: DataFrame) -> DataFrame:
    """Statements with text ids as several systems deliver them: mixed case and
    blank-padded (a fixed rule on the statement id)."""
    sid = F.col("statementid")
    entity = F.concat(F.lit("Ent"), F.col("entityid").cast("string"))
    spelt = lambda c: F.when(sid % 3 == 0, F.upper(c)).when(sid % 3 == 1, F.lower(c)).otherwise(F.concat(c, F.lit("  ")))
    kind = F.when(sid % 2 == 0, F.upper("statementtype")).otherwise(F.rpad("statementtype", 14, " "))
    return statements.select(
        spelt(entity).alias("entityid"), "statementdatekey_", kind.alias("statementtype"),
        spelt(F.concat(entity, F.lit("-"), (sid % 50).cast("string"))).alias("pkid_"), "statementid",
    )


__all__ = ["COLLATION", "collated", "dedup_collated", "join_collated", "ranked_collated", "text_keys"]
