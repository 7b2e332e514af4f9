"""Statement history and customer sources.

A production history is a parquet dataset partitioned by ``asofdate``
(one folder per snapshot), so the latest-snapshot filter prunes folders.
For tests the history is derived from the driver's ``orders`` table by a
fixed rule (FIXTURES.md section 2); the same rule is written as SQL in
``finwater.sqlref`` for the DuckDB oracle.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finwater.functions import key_concat, to_statement_date, try_statement_date
from finwater.schema import MEASURES, STATEMENT_SCHEMA
from finwater.session import path_exists, publish_once, session_conf, shared_scratch, source_tag
from finwater.sources.resolve import is_path, partition_dates, read_source
from finwater.sources.tables import read_table, table_path
from pyspark.sql import types as T

# bump when the derivation rule changes (the materialised copy is keyed on it)
FIXTURE_VERSION = 1

NEWER_SNAPSHOT = dt.date(2024, 12, 31)
OLDER_SNAPSHOT = dt.date(2024, 11, 30)
# measures whose generated value is shifted down to make negatives
SIGNED_MEASURES = ("netopprofit", "retainedearnings", "netprofit")


def unreadable_dates(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a history whose statement date is given but is no date."""
    date = F.col("statementdatekey_")
    return read_source(spark, path).filter(date.isNotNull() & try_statement_date("statementdatekey_").isNull())


def read_statements(spark: SparkSession, path: str, bad_dates: str = "raise") -> DataFrame:
    """Read a statement history (a Parquet folder or a catalogue table of up to
    three name parts) and normalise its key columns.

    ``asofdate`` is truncated to a date (a time part on the newest day would
    otherwise miss the latest-snapshot filter); ``statementdatekey_`` may be a
    date or ``yyyymmdd`` text; ``pkid_`` is derived when absent.  Entity ids
    given as text stay text (leading zeros are kept).  A statement date that
    cannot be read fails the job, or, with ``bad_dates="quarantine"``, its row
    is left out here and found by ``unreadable_dates``.
    """
    if bad_dates not in ("raise", "quarantine"):
        raise ValueError(f"bad_dates must be 'raise' or 'quarantine', not {bad_dates!r}")
    df = read_source(spark, path)
    cols = set(df.columns)
    types = {f.name: f.dataType for f in df.schema.fields}
    if not isinstance(types["asofdate"], T.DateType):
        df = df.withColumn("asofdate", F.to_date("asofdate"))
    if isinstance(types["statementdatekey_"], T.TimestampType | T.TimestampNTZType):
        df = df.withColumn("statementdatekey_", F.to_date("statementdatekey_"))
    elif not isinstance(types["statementdatekey_"], T.DateType):
        if bad_dates == "quarantine":
            df = df.filter(F.col("statementdatekey_").isNull() | try_statement_date("statementdatekey_").isNotNull())
        df = df.withColumn("statementdatekey_", to_statement_date("statementdatekey_"))
    if "pkid_" not in cols:
        df = df.withColumn("pkid_", key_concat("entityid", "statementid"))
    text_ids = isinstance(types["entityid"], T.StringType)
    return df.select(*[
        F.col(f.name) if f.name == "entityid" and text_ids else F.col(f.name).cast(f.dataType)
        for f in STATEMENT_SCHEMA.fields if f.name in df.columns
    ])


def snapshot_dates(spark: SparkSession, path: str, column: str = "asofdate") -> list[dt.date]:
    """Snapshot dates of a history partitioned by ``column``, from the
    partition folder names, or a table's partitions in the catalogue, alone (no
    file is opened). Empty if there are no such partitions."""
    if not is_path(path):
        return partition_dates(spark, path, column) or []
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    prefix = f"{column}="
    dates = []
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(prefix):
            dates.append(dt.date.fromisoformat(name[len(prefix):][:10]))
    return sorted(dates)


def statements_from_orders(orders: DataFrame) -> DataFrame:
    """Statement history stand-in built from ``orders`` (about 30 statements per
    entity, two snapshots; the older holds the even statement ids with shifted
    measures)."""
    o = orders.select(
        F.floor(F.col("o_custkey") / 3).cast("bigint").alias("entityid"),
        F.col("o_orderkey").alias("statementid"),
        F.last_day(F.col("o_orderdate").cast("date")).alias("statementdatekey_"),
        F.substring("o_orderpriority", 1, 1).alias("pr"),
        F.round(F.col("o_totalprice") * 100, 0).cast("bigint").alias("c0"),
    )
    newer = o.withColumn("asofdate", F.lit(NEWER_SNAPSHOT)).withColumn("c", F.col("c0"))
    older = (
        o.filter(F.col("statementid") % 2 == 0)
        .withColumn("asofdate", F.lit(OLDER_SNAPSHOT))
        .withColumn("c", F.col("c0") + 400)
    )
    s = newer.unionByName(older)
    e, sid = F.col("entityid"), F.col("statementid")
    months = (
        F.when(e % 8 == 0, 12)
        .when(e % 8 == 1, 1)
        .when(e % 8 == 2, F.when(sid % 3 == 0, 6).otherwise(1))
        .when(e % 8 == 3, F.when(sid % 30 == 0, 12).otherwise(6))
        .when(e % 8 == 4, 3)
        .when(e % 8 == 5, F.when(sid % 4 == 0, 3).otherwise(6))
        .when(e % 8 == 6, 6)
        .otherwise(F.when(sid % 3 == 0, 1).when(sid % 3 == 1, 3).otherwise(12))
        .cast("int")
    )
    s = s.withColumn("statementmonths", months)
    pr = F.col("pr")
    audit = (
        F.when(sid % 17 == 0, "Unaudited")
        .when(pr == "1", "Unqualif'd")
        .when(pr == "2", "Qualified")
        .when(pr == "3", "Reviewed")
        .when(pr == "4", "Compiled")
        .otherwise("Co.Prep'd")
    )
    m = F.col("statementmonths")
    stype = (
        F.when(sid % 37 == 0, "FY-To-Date")
        .when(sid % 41 == 0, "Rolling Stmt")
        .when(m == 12, "Annual")
        .when(m == 3, "Quarterly")
        .when(m == 1, "Monthly")
        .otherwise("Interim")
    )
    measures = []
    for i, name in enumerate(MEASURES):
        shift = 10000 if name in SIGNED_MEASURES else 0
        value = ((F.col("c") * (i + 3)) % 40009 - shift).cast("double") / 4
        # value times (1 or NULL): ``c`` stays outside any conditional branch,
        # so codegen computes it once per row instead of once per measure
        gate = F.when((sid + i) % 7 == 0, F.lit(None).cast("double")).otherwise(F.lit(1.0))
        measures.append((value * gate).alias(name))
    out = s.select(
        "asofdate",
        "entityid",
        "statementid",
        key_concat("entityid", "statementid").alias("pkid_"),
        "statementdatekey_",
        "statementmonths",
        audit.alias("auditmethod"),
        stype.alias("statementtype"),
        *measures,
    )
    return out


def derived_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history of the ``orders`` table. Five narrow columns are dealt to the
    tasks, which make the wide statement rows and write them where they are."""
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_totalprice")
    return statements_from_orders(orders.repartition(spark.sparkContext.defaultParallelism, *orders.columns))


#: While a history is written. A task keeps a few files open (one per snapshot;
#: rows of further snapshots are sorted first), and wide rows are not made by
#: one generated method: the JVM leaves methods beyond 8000 bytes uncompiled.
WRITE_CONF = {"spark.sql.maxConcurrentOutputFileWriters": "4", "spark.sql.codegen.hugeMethodLimit": "8000"}


def materialize_history(df: DataFrame, path: str, files_per_snapshot: int | None = None) -> str:
    """Write a statement history as parquet partitioned by ``asofdate``.

    The wide rows are neither shuffled (unless ``files_per_snapshot`` asks for
    it) nor sorted by snapshot: each task writes those it has made.  Written to
    a staging folder and renamed into place, so a reader never sees a
    half-written history and a lost executor only re-runs tasks.
    """
    spark = df.sparkSession
    if path_exists(spark, path + "/_SUCCESS"):
        return path
    staging = shared_scratch(spark, "staging/history", unique=True)
    with session_conf(spark, WRITE_CONF):
        dealt = df.repartition(files_per_snapshot) if files_per_snapshot else df
        dealt.write.mode("overwrite").partitionBy("asofdate").parquet(staging)
    return publish_once(spark, staging, path)


def fixture_history_path(spark: SparkSession, sf_dir: str) -> str:
    """The derived history, materialised once per state of the source files
    (full path, lengths, modification times) under the shared checkpoint
    folder, then read like a production table."""
    tag = source_tag(spark, table_path(sf_dir, "orders"))
    path = shared_scratch(spark, f"fixtures/statements_v{FIXTURE_VERSION}_{tag}")
    if not path_exists(spark, path + "/_SUCCESS"):
        materialize_history(derived_statements(spark, sf_dir), path)
    return path


def fixture_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_statements(spark, fixture_history_path(spark, sf_dir))


def fixture_latest_asof(spark: SparkSession, sf_dir: str) -> dt.date:
    return snapshot_dates(spark, fixture_history_path(spark, sf_dir))[-1]


def customers_from_customer(customer: DataFrame) -> DataFrame:
    """Customer stand-in: ``customerid`` repeats each id three times, which
    also exercises the row multiplication of the report's customer join."""
    return customer.select(
        F.floor(F.col("c_custkey") / 3).cast("bigint").alias("customerid"),
        F.col("c_name").alias("customername"),
    )


def fixture_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customers_from_customer(read_table(spark, sf_dir, "customer").select("c_custkey", "c_name"))
