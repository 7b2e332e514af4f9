"""Session helpers.

Jobs never create their own session on a cluster; they take the one they are
given.  ``local_session`` exists for tests and the bench only.
"""

from __future__ import annotations

import hashlib
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on: UTC dates, AQE for runtime coalescing and
# skew splitting, ANSI arithmetic (bad casts raise instead of nulling).
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    # aggregates over mutable buffers that cannot be hashed are sort-based; let them be code-generated
    "spark.sql.codegen.aggregate.sortAggregate.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "finwater") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # no per-call call-site capture while building plans (error context only)
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for k, v in JOB_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the session.

    On a cluster ``spark.checkpoint.dir`` names a shared folder; it is read,
    never replaced.  Only when it is unset (tests on one machine) is a fresh
    folder made.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="finwater-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def shared_scratch(spark: SparkSession, name: str, unique: bool = False) -> str:
    """A folder under the shared checkpoint location for job-written tables."""
    # the configured folder itself (getCheckpointDir adds a per-app subfolder)
    configured = spark.conf.get("spark.checkpoint.dir", None)
    base = (configured or ensure_checkpoint_dir(spark)).rstrip("/")
    leaf = f"{name}-{uuid.uuid4().hex[:12]}" if unique else name
    return f"{base}/finwater/{leaf}"


@contextmanager
def session_conf(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Settings for the jobs of a block; the session's own come back after it."""
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def path_exists(spark: SparkSession, uri: str) -> bool:
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(uri)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(jpath))


def source_tag(spark: SparkSession, *paths: str) -> str:
    """A short name for the files under ``paths`` as they are now: hash of
    full paths, file names, lengths and modification times."""
    jvm = spark.sparkContext._jvm
    seen = []
    for uri in paths:
        root = jvm.org.apache.hadoop.fs.Path(uri)
        fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        seen.append(fs.makeQualified(root).toString())
        files = fs.listFiles(root, True)
        while files.hasNext():
            f = files.next()
            seen.append(f"{f.getPath()} {f.getLen()} {f.getModificationTime()}")
    return hashlib.md5("\n".join(sorted(seen)).encode()).hexdigest()[:16]


def replace_path(spark: SparkSession, staging: str, dst: str) -> str:
    """Swap a finished staging folder in for ``dst``: the old content is
    renamed aside first and deleted only after the new one is in place.

    Two renames: between them there is a moment without a target, and an
    object store copies instead of renaming.  A failed second rename puts the
    old content back.  Readers that must never miss the target should read a
    versioned folder or a catalog table instead."""
    jvm = spark.sparkContext._jvm
    s = jvm.org.apache.hadoop.fs.Path(staging)
    d = jvm.org.apache.hadoop.fs.Path(dst)
    old = jvm.org.apache.hadoop.fs.Path(f"{dst.rstrip('/')}._old_{uuid.uuid4().hex[:8]}")
    fs = s.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    had_old = bool(fs.exists(d)) and bool(fs.rename(d, old))
    if not fs.rename(s, d):
        if had_old:
            fs.rename(old, d)
        raise RuntimeError(f"could not move {staging} to {dst}")
    if had_old:
        fs.delete(old, True)
    return dst


def delete_path(spark: SparkSession, uri: str) -> None:
    """Remove a folder that this job made."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(uri)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def publish_once(spark: SparkSession, staging: str, dst: str) -> str:
    """Move a finished staging folder to ``dst`` unless another writer got
    there first; readers of an existing ``dst`` are never disturbed."""
    jvm = spark.sparkContext._jvm
    s = jvm.org.apache.hadoop.fs.Path(staging)
    d = jvm.org.apache.hadoop.fs.Path(dst)
    fs = s.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(d):
        parent = d.getParent()
        if parent is not None and not fs.exists(parent):
            fs.mkdirs(parent)
        fs.rename(s, d)  # fails (returns False) if dst appeared meanwhile
    if fs.exists(s):
        fs.delete(s, True)
    return dst


__all__ = [
    "JOB_CONF",
    "delete_path",
    "local_session",
    "ensure_checkpoint_dir",
    "session_conf",
    "shared_scratch",
    "path_exists",
    "publish_once",
    "replace_path",
    "source_tag",
]
