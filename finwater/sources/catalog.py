"""Column metadata as a DataFrame.

Two sources: the session catalog (tables and views it knows) and a folder
of parquet datasets (one dataset per entry, schema read from the files).
Both yield ``table_catalog, table_schema, table_name, column_name,
data_type`` plus ``object_id`` keys for the tables / columns form.  The
listing itself is metadata (one row per column), not table data.
"""

from __future__ import annotations

import zlib
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

META_SCHEMA = T.StructType(
    [
        T.StructField("table_catalog", T.StringType()),
        T.StructField("table_schema", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("data_type", T.StringType()),
        T.StructField("object_id", T.LongType()),
        T.StructField("ordinal_position", T.IntegerType()),
    ]
)


def _object_id(catalog: str, schema: str, table: str) -> int:
    return zlib.crc32(f"{catalog}.{schema}.{table}".encode())


def columns_from_catalog(spark: SparkSession, catalog: str | None = None, database: str | None = None) -> DataFrame:
    cat = catalog or spark.catalog.currentCatalog()
    rows = []
    db = database or spark.catalog.currentDatabase()
    for t in spark.catalog.listTables(db):
        schema_name = t.namespace[0] if t.namespace else ("" if t.isTemporary else db)
        tcat = t.catalog or cat
        fq = t.name if t.isTemporary else f"{schema_name}.{t.name}"
        for pos, c in enumerate(spark.catalog.listColumns(fq), start=1):
            rows.append((tcat, schema_name, t.name, c.name, c.dataType, _object_id(tcat, schema_name, t.name), pos))
    return spark.createDataFrame(rows, META_SCHEMA)


def columns_from_parquet_dir(spark: SparkSession, root: str, catalog: str = "files", schema: str = "main") -> DataFrame:
    """Schemas of every ``<name>.parquet`` dataset under ``root``."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    entries = [
        (st.getPath().getName()[: -len(".parquet")], st.getPath().toString())
        for st in fs.listStatus(path)
        if st.getPath().getName().endswith(".parquet")
    ]

    def schema_rows(entry):
        table, uri = entry
        fields = spark.read.parquet(uri).schema.fields  # footer read, no table scan
        return [
            (catalog, schema, table, f.name, f.dataType.simpleString(), _object_id(catalog, schema, table), pos)
            for pos, f in enumerate(fields, start=1)
        ]

    # schema inference is driver-side I/O per dataset: overlap it
    with ThreadPoolExecutor(max_workers=8) as pool:
        rows = [r for part in pool.map(schema_rows, entries) for r in part]
    return spark.createDataFrame(rows, META_SCHEMA)
