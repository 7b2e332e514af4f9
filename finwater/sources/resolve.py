"""Sources by name: catalogue tables (up to three parts) or Parquet folders."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession

_PART = re.compile(r"\s*(?:\[((?:[^\]]|\]\])+)\]|`((?:[^`]|``)+)`|\"((?:[^\"]|\"\")+)\"|([^.\[\]`\"]+?))\s*(?:\.|$)")


def name_parts(name: str) -> list[str]:
    """The parts of a table name: bare, or in brackets, quotes or backticks
    (doubled inside); dots inside those are part of the name."""
    parts, at = [], 0
    while at < len(name):
        m = _PART.match(name, at)
        if m is None:
            raise ValueError(f"not a table name: {name!r}")
        bracket, tick, quoted, bare = m.groups()
        parts.append(
            bracket.replace("]]", "]") if bracket else tick.replace("``", "`") if tick else quoted.replace('""', '"') if quoted else bare
        )
        at = m.end()
    if not 1 <= len(parts) <= 3 or name.rstrip().endswith("."):
        raise ValueError(f"a table name has one to three parts: {name!r}")
    return parts


def is_path(source: str) -> bool:
    """Whether a source is a folder: it holds a slash outside quoting."""
    return "/" in re.sub(r"\[[^\]]*\]|`[^`]*`|\"[^\"]*\"", "", source)


def table_name(spark: SparkSession, source: str) -> str:
    """The full name, for SQL, of the table that a name means in the session's
    current catalogue and database; LookupError if there is none."""
    given = name_parts(source)
    full = [spark.catalog.currentCatalog(), spark.catalog.currentDatabase()][: 3 - len(given)] + given
    name = ".".join("`" + p.replace("`", "``") + "`" for p in full)
    temporary = len(given) == 1 and spark.catalog.tableExists(f"`{given[0]}`")
    if not spark.catalog.tableExists(name):
        if temporary:  # a temporary view has no catalogue
            return f"`{given[0]}`"
        raise LookupError(f"no table {name} (from {source!r})")
    return name


def read_source(spark: SparkSession, source: str) -> DataFrame:
    """A Parquet folder or a catalogue table."""
    return spark.read.parquet(source) if is_path(source) else spark.table(table_name(spark, source))


def partition_dates(spark: SparkSession, source: str, column: str) -> list[dt.date] | None:
    """Dates of a table's partitions by ``column``, from the catalogue alone;
    None if the catalogue does not keep such partitions."""
    name = table_name(spark, source)
    keys = [c.name.lower() for c in spark.catalog.listColumns(name) if c.isPartition] if "." in name else []
    if column.lower() not in keys:
        return None
    found = set()
    for row in spark.sql(f"SHOW PARTITIONS {name}").collect():  # a row per partition: metadata
        for part in row[0].split("/"):
            key, _, value = part.partition("=")
            if key.lower() == column.lower() and value != "__HIVE_DEFAULT_PARTITION__":
                found.add(dt.date.fromisoformat(value[:10]))
    return sorted(found)


__all__ = ["is_path", "name_parts", "partition_dates", "read_source", "table_name"]
