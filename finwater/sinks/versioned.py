"""Versioned Parquet target: a load is one commit, readers never miss it.

    <target>/_data/<id>/part-*.parquet    the content of one load
    <target>/_commits/<version>.json      a manifest: data folder, rows, facts

A load writes its own data folder with Spark's Parquet writer (``stage``), so
failed or repeated tasks leave nothing that counts, and is published by one
small file: the next manifest, written aside and renamed to a name that must
not exist. Readers take the newest manifest. Until the rename the old content
is the target, after it the new one; there is no moment without a target, on
stores that rename a file in one step (HDFS, POSIX). Two loads that start from
the same version cannot both commit it: the later one fails and leaves the
target alone. Superseded folders stay for readers that still use them, until
``remove_superseded``.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from finwater.session import delete_path, path_exists


class CommitConflict(RuntimeError):
    """Another load published this version first."""


def _commits(target: str) -> str:
    return f"{target.rstrip('/')}/_commits"


def _name(version: int) -> str:
    return f"{version:020d}.json"


def stage(df: DataFrame, target: str) -> str:
    """Writes ``df`` into a data folder of its own; nothing is published."""
    folder = f"_data/{uuid.uuid4().hex}"
    df.write.parquet(f"{target.rstrip('/')}/{folder}")
    return folder


def _versions(spark: SparkSession, target: str) -> list[int]:
    if not path_exists(spark, _commits(target)):
        return []
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_commits(target))
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in fs.listStatus(path)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def _read(spark: SparkSession, uri: str) -> dict:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(uri)
    stream = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(path)
    try:
        return json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def current(spark: SparkSession, target: str, version: int | None = None) -> dict | None:
    """The newest manifest (or that of a version); None for a new target."""
    versions = _versions(spark, target)
    if version is None and not versions:
        return None
    if version is not None and version not in versions:
        raise ValueError(f"{target} has no version {version}")
    return _read(spark, f"{_commits(target)}/{_name(versions[-1] if version is None else version)}")


def history(spark: SparkSession, target: str) -> list[dict]:
    """All manifests, oldest first."""
    return [_read(spark, f"{_commits(target)}/{_name(v)}") for v in _versions(spark, target)]


def commit(spark: SparkSession, target: str, folder: str, schema: StructType, facts: dict | None = None, base: int | None = None) -> dict:
    """Publishes a staged folder as the version after ``base`` (default: the
    newest now)."""
    versions = _versions(spark, target)
    newest = versions[-1] if versions else 0
    version = (newest if base is None else base) + 1
    manifest = {
        "version": version, "data": folder, "schema": schema.json(), "committed": dt.datetime.now(dt.timezone.utc).isoformat(),
        "facts": facts or {},
    }
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    final = jvm.org.apache.hadoop.fs.Path(f"{_commits(target)}/{_name(version)}")
    aside = jvm.org.apache.hadoop.fs.Path(f"{_commits(target)}/_{uuid.uuid4().hex}")
    fs = final.getFileSystem(conf)
    out = fs.create(aside, True)
    try:
        out.write(bytearray(json.dumps(manifest).encode()))
    finally:
        out.close()
    conflict = newest >= version or fs.exists(final)
    if conflict or not fs.rename(aside, final):  # HDFS refuses a name that is taken
        fs.delete(aside, False)
        raise CommitConflict(f"{target}: version {version} is already there")
    return manifest


def read_version(spark: SparkSession, target: str, version: int | None = None) -> DataFrame:
    """The target's content, or that of an earlier version."""
    manifest = current(spark, target, version)
    if manifest is None:
        raise FileNotFoundError(f"{target}: nothing committed")
    schema = StructType.fromJson(json.loads(manifest["schema"]))
    return spark.read.schema(schema).parquet(f"{target.rstrip('/')}/{manifest['data']}")


def remove_superseded(spark: SparkSession, target: str, keep: int = 2) -> int:
    """Removes the data of all versions but the ``keep`` newest, manifest
    first; folders of loads that are still running are left alone."""
    old = history(spark, target)[: -max(1, keep)]
    for manifest in old:
        delete_path(spark, f"{_commits(target)}/{_name(manifest['version'])}")
        delete_path(spark, f"{target.rstrip('/')}/{manifest['data']}")
    return len(old)


__all__ = ["CommitConflict", "commit", "current", "history", "read_version", "remove_superseded", "stage"]
