"""A Bloom filter of keys as a table, for scans too large to join unfiltered.

Each key has one 64-bit word of the filter and ``BITS`` bits in it (a blocked
Bloom filter); words lie in rows of ``ROW`` words. The filter is built by
grouped bit-or sums in tasks, is never larger than ``MAX_WORDS`` words, and
goes to the scan by broadcast: that bound holds however many keys there are, a
fuller filter only lets more rows through. No key is ever lost; what else
passes is removed by the join that follows. Everything runs in built-in
functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finwater.session import ensure_checkpoint_dir

#: Bits set per key; words per row of the filter; bits of filter per key aimed
#: at; most words (64 MB of filter).
BITS, ROW, PER_KEY, MAX_WORDS = 4, 4096, 16, 8 << 20


def _place(key: Column, words: int) -> tuple[Column, Column, Column]:
    """Row of the filter, place in it (from 1) and the bits of a key."""
    word = F.pmod(F.xxhash64(key), F.lit(words))
    other = F.xxhash64(key, F.lit("bits"))
    mask = None
    for i in range(BITS):  # six bits of the second hash choose each bit of the word
        shift = F.pmod(F.shiftright(other, 6 * i), F.lit(64)).cast("int")
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), shift)
        mask = bit if mask is None else mask.bitwiseOR(bit)
    return F.floor(word / F.lit(ROW)).cast("int"), (word % F.lit(ROW) + 1).cast("int"), mask


def size_for(n_keys: int) -> int:
    """Words of a filter: about ``PER_KEY`` bits a key, within the bound."""
    return max(ROW, min(MAX_WORDS, -(-n_keys * PER_KEY // 64 // ROW) * ROW))


def key_filter(keys: DataFrame, key: str, words: int) -> DataFrame:
    """(row, words): the filter of ``keys``, a row per ``ROW`` words that hold
    any. Stored, so that its size is known before it is sent."""
    row, place, mask = _place(F.col(key), words)
    ored = keys.filter(F.col(key).isNotNull()).select(row.alias("row"), place.alias("place"), mask.alias("mask"))
    ored = ored.groupBy("row", "place").agg(F.bit_or("mask").alias("mask"))
    held = ored.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("place", "mask"))).alias("held"))  # at most ROW entries
    full = F.transform(F.sequence(F.lit(1), F.lit(ROW)), lambda i: F.coalesce(F.try_element_at("held", i), F.lit(0).cast("long")))
    ensure_checkpoint_dir(keys.sparkSession)
    return held.select("row", full.alias("words")).checkpoint()


def passing(df: DataFrame, key: Column, found: DataFrame, words: int) -> DataFrame:
    """Rows of ``df`` whose key may be in the filter (all whose key is)."""
    row, place, mask = _place(key, words)
    # at most MAX_WORDS / ROW rows of ROW words: bounded whatever the data
    joined = df.withColumn("_row", row).join(F.broadcast(found.withColumnRenamed("row", "_row")), "_row")
    there = F.element_at("words", place).bitwiseAND(mask) == mask
    return joined.filter(there).drop("_row", "words")


__all__ = ["MAX_WORDS", "ROW", "key_filter", "passing", "size_for"]
