"""SimHash near-duplicates by covering locality-sensitive hashing.

A fingerprint bit is the majority of that bit over the XXH64 hashes of a
text's word shingles. To find every pair within ``radius`` differing bits,
each of the 64 bits gets a vector of radius+1 bits; for each non-zero vector v
of that length a mask holds the bits whose vector has an odd product with v.
The vectors of any ``radius`` positions leave some v at right angles to all of
them, so that a pair within the radius agrees on at least one whole mask: no
pair is lost.

Work per table is on distinct fingerprints (copies meet in a grouped minimum
before any shuffle of candidates). A bucket of up to ``bucket`` fingerprints
is compared in one task and gives a spanning forest, at most one link less
than it has members. A larger one is covered again over the bits that its
masks left open; after the third level a bucket differs in at most 8 bits, so
its size has a fixed bound. Components are found on the links.

Cases: a null text has no words; a text without words has fingerprint zero
and links like any other; a text with fewer words than a shingle is hashed
whole. Repeated rows are linked. A null id gets its row's component like any
other but never names one; a group without any id has a null component. An
empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finwater.session import ensure_checkpoint_dir, shared_scratch

from .base import col, map_texts, prepare
from .components import components

SEED = 42
#: Hashes whose bits are counted at a time.
VOTE_ROWS = 1 << 15
#: Fingerprints of a bucket that are compared in one task.
BUCKET = 128
BITS = 64


def fingerprint(words: list[bytes], shingle: int) -> int:
    """The 64-bit fingerprint of lower-cased words."""
    if not words:
        return 0
    if len(words) < shingle:
        parts = [b" ".join(words)]
    else:
        parts = list(map(b" ".join, zip(*(words[i:] for i in range(shingle)))))
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(parts), VOTE_ROWS):
        some = parts[at : at + VOTE_ROWS]
        h = np.fromiter(map(xxhash.xxh64_intdigest, some, repeat(SEED)), dtype="<u8", count=len(some))
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(parts), bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, *, keep: list[str], text_col: str = "text", shingle: int = 3) -> DataFrame:
    """The ``keep`` columns and ``fp``, the fingerprint's 64 bits as a long."""

    def work(texts: list[bytes]) -> list:
        made = [fingerprint(t.lower().split(), shingle) for t in texts]
        return [np.array(made, dtype=np.uint64).view(np.int64)]

    return map_texts(df, keep, text_col, [T.StructField("fp", T.LongType())], work)


def cover(open_bits: list[int], radius: int) -> list[int]:
    """Masks over ``open_bits`` such that any two values differing in at most
    ``radius`` of these bits agree on all bits of some mask."""
    vectors = range(1, 2 ** (radius + 1))
    own = {bit: 1 + i % len(vectors) for i, bit in enumerate(open_bits)}
    return [sum(1 << bit for bit, m in own.items() if (m & v).bit_count() % 2) for v in vectors]


def _next_masks(mask: int, radius: int) -> list[int]:
    """Masks of the next level below ``mask``, that mask included."""
    return [mask | m for m in cover([b for b in range(BITS) if not mask >> b & 1], radius)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _near_forest(values: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of the graph of pairs within ``radius``."""
    links, left = [], np.arange(len(values))
    while len(left):  # breadth first from the first value not yet reached
        frontier, left = left[:1], left[1:]
        while len(frontier) and len(left):
            near = np.bitwise_count(values[frontier][:, None] ^ values[left][None, :]) <= radius
            hit = near.any(axis=0)
            links += zip(values[frontier[near[:, hit].argmax(axis=0)]], values[left[hit]])
            frontier, left = left[hit], left[~hit]
    return links


def _compare(buckets: DataFrame, radius: int) -> DataFrame:
    """Links (a, b) of buckets given as an array column ``fps``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs: list[tuple[int, int]] = []
            for fps in batch.column(0).to_pylist():
                pairs += _near_forest(np.array(fps, dtype=np.int64).view(np.uint64), radius)
            ends = np.array(pairs, dtype=np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0].copy()), pa.array(ends[:, 1].copy())], names=["a", "b"])

    return buckets.select("fps").mapInArrow(run, "a long, b long")


def links(fps: DataFrame, radius: int = 3, bucket: int = BUCKET) -> DataFrame:
    """Links between the distinct values of ``fps.fp`` that connect exactly
    what all pairs within ``radius`` bits connect."""
    spark = fps.sparkSession
    ensure_checkpoint_dir(spark)
    prepare(spark)
    level_masks = [0]
    table = fps.select("fp").withColumn("mask", F.lit(0).cast("long"))
    found, level = None, 0
    while True:
        level += 1
        # masks of this level by the mask above: 1, 15 and 225 rows at radius 3
        below = {m: _next_masks(m, radius) for m in level_masks}
        if level == 1:
            masks = F.array(*[F.lit(_signed(m)) for m in below[0]])
            table = table.withColumn("mask", F.explode(masks))
        else:
            steps = spark.createDataFrame([(_signed(m), [_signed(x) for x in xs]) for m, xs in below.items()], "mask long, next array<long>")
            table = table.join(F.broadcast(steps), "mask").select("fp", F.explode("next").alias("mask"))
        level_masks = sorted({x for xs in below.values() for x in xs})
        table = table.withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))
        sizes = table.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        sized = table.join(sizes, ["mask", "key"]).checkpoint()
        # a mask of the last level leaves so few bits open that any bucket is small
        last = all(BITS - m.bit_count() <= 8 for m in level_masks)
        small = sized if last else sized.filter(F.col("n") <= bucket)
        made = _compare(small.groupBy("mask", "key").agg(F.collect_list("fp").alias("fps")), radius)
        found = made if found is None else found.union(made)
        table = sized.filter(F.col("n") > bucket).select("fp", "mask")
        if last or table.isEmpty():
            return found
        table = table.distinct()


def near_duplicates(
    df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 3
) -> DataFrame:
    """(id, ``fp`` long, ``fingerprint`` hex, ``component_id``): the smallest
    id that links of at most ``radius`` bits reach, one row per input row."""
    spark = df.sparkSession
    path = shared_scratch(spark, "simhash", unique=True)
    fingerprints(df, keep=[id_col], text_col=text_col, shingle=shingle).write.parquet(path)
    marks = spark.read.parquet(path)
    firsts = marks.groupBy("fp").agg(F.min(col(id_col)).alias("first")).checkpoint()
    groups = components(links(firsts, radius))
    rooted = firsts.join(groups.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    by_fp = rooted.select("fp", "root").join(named, "root").select(F.col("fp").alias("_fp"), "root", "component_id")
    return marks.join(by_fp, marks["fp"] == F.col("_fp"), "left").select(
        col(id_col), "fp", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "root"
    )


def keep_first(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 3) -> DataFrame:
    """The rows of ``df`` without near-duplicates: of each group the row that
    names it stays. Rows of a group that share the naming id, and groups without
    any id, keep their row with the least text."""
    names = [f"_c{i}" for i in range(len(df.columns))]
    ident, text = (names[df.columns.index(c)] for c in (id_col, text_col))
    plain = df.select(*[col(c).alias(n) for c, n in zip(df.columns, names)])
    groups = near_duplicates(plain, id_col=ident, text_col=text, shingle=shingle, radius=radius)
    names_it = F.col(ident) == F.col("component_id")
    own = groups.groupBy(F.col(ident).alias("_id")).agg(F.count(F.lit(1)).alias("_n"), F.max(names_it).alias("_own")).filter("_own")
    kept = plain.join(own, F.col(ident) == F.col("_id"))
    once = kept.filter("_n = 1").select(*names)
    least = F.struct(text, *[n for n in names if n != text])
    unpacked = [F.col("r")[n].alias(n) for n in names]
    most = own.agg(F.max("_n")).first()[0]
    if most is not None and most > 1:
        # an id on several rows may name several groups, or lie in others' too
        rows = fingerprints(kept.filter("_n > 1"), keep=names, text_col=text, shingle=shingle)
        roots = groups.filter(names_it).select(F.col(ident).alias("_id"), F.col("fp").alias("_fp"), "root").distinct()
        rows = rows.join(roots, (F.col(ident) == F.col("_id")) & (F.col("fp") == F.col("_fp")))
        once = once.union(rows.groupBy("_id", "root").agg(F.min(least).alias("r")).select(*unpacked))
    nameless = groups.filter(F.col("component_id").isNull()).select("fp", "root").distinct()
    if not nameless.isEmpty():
        rows = fingerprints(plain.filter(F.col(ident).isNull()), keep=names, text_col=text, shingle=shingle)
        first = rows.join(nameless, "fp").groupBy("root").agg(F.min(least).alias("r"))
        once = once.union(first.select(*unpacked))
    return once.select(*[F.col(n).alias(c) for n, c in zip(names, df.columns)])


__all__ = ["cover", "fingerprint", "fingerprints", "keep_first", "links", "near_duplicates"]
