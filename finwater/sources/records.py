"""Records of delimited text whose qualified fields may hold row delimiters.

Files are read line by line in splittable blocks. Whether a block begins
inside a qualified field, and which record of its file it begins with, depends
on every block before it, so two steps find it out:

1. Each block is walked once for both possible beginnings (outside or inside a
   qualified field) and gives the ending and the number of records for each:
   a row per block. A prefix over a file's blocks -- the last block that ends
   alike either way, and the changes of side since -- gives each block's real
   beginning and the number of records before it.
2. Each block is cut into records. What a block holds of a record that spans
   blocks becomes a fragment; fragments are put together per record. Only
   files that have such records are read for fragments.

So skipped rows may lie at any depth, and block borders never show. A
qualifier opens a field only at the field's start, and a doubled one inside
stands for itself; a qualifier in the middle of a bare field is text.

The rows per block go to the line scan by broadcast while there are at most
``MAX_BLOCKS`` of them that matter; beyond that lines are shuffled by block.
A field that is never closed runs to the end of its file, as one record.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from finwater.session import ensure_checkpoint_dir

#: Blocks (that begin inside a field, or within the rows to skip) up to which
#: they are broadcast; about 200 bytes each.
MAX_BLOCKS = 200_000
_BLOCK = ["file", "start"]


def lines_of(reader, path: str, line_sep: str) -> DataFrame:
    """(line, file, start): raw bytes of every line and the block it starts in,
    from a batch or streaming reader."""
    return reader.option("lineSep", line_sep).text(path).select(
        F.col("value").cast("binary").alias("line"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
    )


def line_end(sep: str, quote: str | None, charset: str) -> Callable[[bytes], tuple[bool, bool]]:
    """For a line: does it end inside a qualified field, if it begins outside
    and if it begins inside one."""
    if quote is None:
        return lambda line: (False, False)
    q, s = (re.escape(x.encode(charset)) for x in (quote, sep))
    other = lambda x: rb"[^%s]" % x if len(x) <= 2 else rb"(?:(?!%s)[\s\S])" % x
    body = rb"(?:%s++|%s%s)*+" % (other(q), q, q)  # up to the closing qualifier or the end
    bare = rb"%s*+" % other(s)
    fields = rb"(?:(?:%s%s%s%s|(?!%s)%s)%s)*+" % (q, body, q, bare, q, bare, s)
    outside = re.compile(rb"%s%s%s" % (fields, q, body))
    inside = re.compile(rb"%s(?:%s%s%s%s%s%s)?" % (body, q, bare, s, fields, q, body))
    mark = quote.encode(charset)

    def ends(line: bytes) -> tuple[bool, bool]:
        if mark not in line:
            return False, True
        return outside.fullmatch(line) is not None, inside.fullmatch(line) is not None

    return ends


def _walk(batches: Iterator[pa.RecordBatch], ends) -> Iterator[tuple]:
    """(file, start, line, ends) of each line of a task."""
    for batch in batches:
        for line, file, start in zip(*(c.to_pylist() for c in batch.columns[:3])):
            yield file, start, line, ends(line)


def block_starts(lines: DataFrame, sep: str, quote: str | None, charset: str) -> DataFrame:
    """(file, start, inside, first, open): whether a block begins inside a
    field, the number of records that start before it, and whether it ends
    inside a field. Stored: the scan behind it runs once."""
    make = line_end  # the factory itself goes to the tasks

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends = make(sep, quote, charset)
        rows, now = [], None
        for file, start, _, side in _walk(batches, ends):
            if (file, start) != now:
                now = (file, start)
                rows.append([file, start, False, True, 0, 0])
            row = rows[-1]
            for k in (0, 1):  # walked from outside, and from inside
                row[4 + k] += not row[2 + k]
                row[2 + k] = side[row[2 + k]]
        columns = list(zip(*rows)) or [[]] * 6
        types = [pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64()]
        names = ["file", "start", "end0", "end1", "n0", "n1"]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    measured = _shipped(lines, measure, "file string, start long, end0 boolean, end1 boolean, n0 long, n1 long")
    order = Window.partitionBy("file").orderBy("start")
    upto, before = order.rowsBetween(Window.unboundedPreceding, 0), order.rowsBetween(Window.unboundedPreceding, -1)
    fixed = F.col("end0") == F.col("end1")
    turns = (F.col("end0") & ~F.col("end1")).cast("long")
    walked = measured.withColumn("turns", F.sum(turns).over(upto))
    last_end = F.last(F.when(fixed, F.col("end0").cast("long")), ignorenulls=True).over(before)
    since = F.coalesce(F.lag("turns").over(order), F.lit(0)) - F.coalesce(F.last(F.when(fixed, F.col("turns")), ignorenulls=True).over(before), F.lit(0))
    walked = walked.withColumn("inside", (F.coalesce(last_end, F.lit(0)) + since) % 2 == 1)
    walked = walked.withColumn("n", F.when(F.col("inside"), F.col("n1")).otherwise(F.col("n0")))
    found = walked.select(
        *_BLOCK, "inside", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"),
        F.when(F.col("inside"), F.col("end1")).otherwise(F.col("end0")).alias("open"),
    )
    ensure_checkpoint_dir(lines.sparkSession)
    return found.checkpoint()


def _shipped(df: DataFrame, run, schema: str) -> DataFrame:
    """``mapInArrow`` whose helpers of this module travel with the function:
    the workers need not have the package."""
    import sys

    from pyspark import cloudpickle

    module = sys.modules[__name__]
    cloudpickle.register_pickle_by_value(module)
    try:
        return df.mapInArrow(run, schema)
    finally:
        cloudpickle.unregister_pickle_by_value(module)


_WHOLE, _HEAD, _TAIL = 0, 1, 2
_PARTS = "kind int, file string, start long, number long, text binary"


def _parts(lines: DataFrame, starts: DataFrame, sep: str, quote: str | None, charset: str, line_sep: str, limit: int) -> DataFrame:
    """Whole records with their number in the file, and fragments of those that
    span blocks (a head has no number: it continues an earlier block)."""
    make, glue, walk = line_end, line_sep.encode(charset), _walk
    whole, head, tail = _WHOLE, _HEAD, _TAIL
    if starts.limit(limit + 1).count() <= limit:
        placed = lines.join(F.broadcast(starts), _BLOCK, "left").select("line", *_BLOCK, "inside", "first")
    else:
        numbered = lines.withColumn("_row", F.monotonically_increasing_id())
        dealt = numbered.join(starts, _BLOCK, "left").repartition(*_BLOCK).sortWithinPartitions(*_BLOCK, "_row")
        placed = dealt.select("line", *_BLOCK, "inside", "first")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends = make(sep, quote, charset)
        now, inside, number, held, own = None, False, 0, [], None
        types = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
        names = ["kind", "file", "start", "number", "text"]

        def left() -> list[tuple]:
            """What is still open at a block's end."""
            return [(head if own is None else tail, *now, own, glue.join(held))] if held else []

        for batch in batches:
            out = []
            for (file, start, line, side), begins, first in zip(walk([batch], ends), batch.column(3).to_pylist(), batch.column(4).to_pylist()):
                if (file, start) != now:
                    out += left()
                    # blocks without a row begin outside a field, beyond the rows to skip (or at 0)
                    now, inside, number, held, own = (file, start), bool(begins), first if first is not None else (1 << 40) * (start > 0), [], None
                if not inside:
                    own, number = number, number + 1
                held.append(line)
                inside = side[inside]
                if not inside:
                    out.append((whole if own is not None else head, file, start, own, glue.join(held)))
                    held, own = [], None
            columns = list(zip(*out)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)
        columns = list(zip(*left())) or [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return _shipped(placed, cut, _PARTS)


def records(
    lines: DataFrame, *, sep: str, quote: str | None, charset: str, line_sep: str, numbered: int = 0, limit: int = MAX_BLOCKS,
) -> DataFrame:
    """(file, number, text) of every record. Numbers count from 0 in each file;
    those from ``numbered`` on may be replaced by any number beyond it."""
    starts = block_starts(lines, sep, quote, charset)
    known = starts.filter((F.col("start") > 0) & (F.col("inside") | (F.col("first") < numbered))).select(*_BLOCK, "inside", "first")
    parts = _parts(lines, known, sep, quote, charset, line_sep, limit)
    found = parts.filter(F.col("kind") == _WHOLE).select("file", "number", "text")
    if quote is None or starts.filter("open").isEmpty():
        return found
    spanning = starts.filter("open OR inside").select("file").distinct()
    theirs = lines.join(spanning, "file", "left_semi") if quote else lines
    pieces = _parts(theirs, known, sep, quote, charset, line_sep, limit).filter(F.col("kind") != _WHOLE)
    # in a block the head (of an earlier record) comes before the tail
    order = Window.partitionBy("file").orderBy("start", "kind")
    opened = F.sum((F.col("kind") == _TAIL).cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    joined = pieces.withColumn("record", opened).groupBy("file", "record").agg(
        F.max("number").alias("number"), F.array_sort(F.collect_list(F.struct("start", "kind", F.hex("text").alias("text")))).alias("pieces")
    )
    glue = line_sep.encode(charset).hex().upper()
    text = F.unhex(F.array_join(F.transform("pieces", lambda p: p["text"]), glue))
    return found.unionByName(joined.select("file", "number", text.alias("text")))


def read_records(spark: SparkSession, path: str, **how) -> DataFrame:
    """``records`` of the files under ``path``."""
    return records(lines_of(spark.read, path, how["line_sep"]), **how)


__all__ = ["MAX_BLOCKS", "block_starts", "line_end", "lines_of", "read_records", "records"]
