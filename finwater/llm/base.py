"""Shared helpers of the training-data operators.

Words are maximal runs of characters outside space and U+0009..U+000D.
``bytes.split()`` cuts UTF-8 at exactly those bytes, and ``bytes.lower()``
lower-cases A-Z only.
"""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Texts are handled in groups of about this many bytes inside a task, so
#: that a task's memory does not depend on the rows of an Arrow batch.
GROUP_BYTES = 1 << 19


#: Bytes of an Arrow batch between the JVM and Python, where the session has
#: Spark's default (64 MB): rows hold whole texts of any length, and both sides
#: keep several batches per task.
ARROW_BYTES = 4 << 20
_ARROW_CONF, _ARROW_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", 64 << 20


_SHIPPED: set[str] = set()


def prepare(spark: SparkSession) -> None:
    """What operators with Python in their tasks need from the session.

    Arrow batches are bounded by bytes, unless the session was given a bound;
    and the package goes to the executors (once per application, a zip of its
    sources), whose workers otherwise import it only where it is installed.
    """
    if spark.conf.get(_ARROW_CONF).rstrip("bB") == str(_ARROW_DEFAULT):
        spark.conf.set(_ARROW_CONF, str(ARROW_BYTES))
    sc, package = spark.sparkContext, Path(__file__).resolve().parents[1]
    if sc.applicationId in _SHIPPED or not package.is_dir():
        return
    archive = Path(tempfile.mkdtemp(prefix="finwater-")) / "finwater.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for source in sorted(package.rglob("*.py")):
            z.write(source, source.relative_to(package.parent))
    sc.addPyFile(str(archive))
    _SHIPPED.add(sc.applicationId)


def col(name: str):
    """A column by its literal name (dots are no path)."""
    return F.col("`" + name.replace("`", "``") + "`")


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null counts as empty."""
    return [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]


def groups(sizes: Iterable[int], limit: int = GROUP_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive [start, end) ranges whose sizes add up to about ``limit``."""
    start = end = total = 0
    for size in sizes:
        end += 1
        total += size
        if total >= limit:
            yield start, end
            start, total = end, 0
    if end > start:
        yield start, end


def map_texts(df: DataFrame, keep: list[str], text_col: str, fields: list[T.StructField], work) -> DataFrame:
    """``work(list of UTF-8 texts) -> list of column arrays``, run over groups
    of rows inside Arrow batches; the ``keep`` columns pass through by
    position, so that input names may clash with result names."""
    prepare(df.sparkSession)
    names = [f"_k{i}" for i in range(len(keep))]
    source = df.select(*[col(k).alias(n) for k, n in zip(keep, names)])
    if text_col in keep:
        at = keep.index(text_col)
    else:
        at, source = len(keep), df.select(*[col(k).alias(n) for k, n in zip(keep, names)], col(text_col).alias("_text"))
    out = T.StructType([T.StructField(n, df.schema[k].dataType) for k, n in zip(keep, names)] + list(fields))
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(at).cast(pa.binary())
            # bytes objects are made group by group, not for the whole batch
            for a, b in groups(pc.fill_null(pc.binary_length(column), 0).to_pylist()):
                made = work(texts_of(column.slice(a, b - a)))
                kept = [batch.column(i).slice(a, b - a) for i in range(len(names))]
                arrays = [c if c.type == f.type else c.cast(f.type) for c, f in zip(kept, arrow)]
                arrays += [pa.array(c, type=f.type) for c, f in zip(made, list(arrow)[len(names):])]
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    done = source.mapInArrow(run, out)
    return done.select(*[col(n).alias(k) for n, k in zip(names, keep)], *[col(f.name) for f in fields])


__all__ = ["ARROW_BYTES", "GROUP_BYTES", "col", "groups", "map_texts", "prepare", "texts_of"]
