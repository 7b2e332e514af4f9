"""Token ids as canonical length-limited Huffman codes in independent blocks.

``write`` encodes every whole text with the ``tokenizers`` library, appends an
end id to each document and writes a folder of three Parquet tables:

* ``codebook`` (id, count, bits): the code lengths, from the counts of ids in
  the whole input. Codes are canonical: by length, then id. No code is longer
  than ``MAX_BITS`` (or the least length that gives every id a code).
* ``shards`` (shard, start): number of ids before each shard.
* ``blocks``: (shard, block, first, n_ids, docs, lengths, step, checkpoints,
  payload): whole documents in ascending id order, about ``BLOCK_IDS`` ids a
  block (a longer document is a block of its own). ``first`` counts from the
  shard's start; ``docs`` and ``lengths`` are the documents' ids and numbers of
  token ids; ``payload`` holds the codes, most significant bit first;
  ``checkpoints`` the bit offset of every ``step``-th token id as little-endian
  unsigned 64-bit integers, so decoding can begin at any of them.

``read`` decodes the blocks, each on its own: a table of 2^bits entries gives
the id and length of the code a bit window starts with, and all runs between
checkpoints of a batch advance together. ``read_span`` decodes only the blocks
and the runs that a stretch of the id stream meets.

On Spark: texts are tokenised once into a stored table; counts are a grouped
sum (a row per id reaches the driver: bounded by the vocabulary); the table is
range-partitioned and sorted by (document id, text hash, row) and coded
partition by partition; a shard is a partition, and a row per shard gives the
starts. Tasks hold a group of texts, one block and bounded memories.

Cases: null or empty text: the end id alone. A null document id comes first.
Repeated ids stand side by side, ordered by their texts' hash; the row number
as last sort key spreads any number of equal rows. Very long texts are encoded
whole and make one block. An empty table gives empty tables and no rows. Other
columns are ignored, whatever their names. Strings of special tokens inside
texts are ordinary text, unless ``special_strings`` is set.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from itertools import chain, compress

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from finwater.session import delete_path, shared_scratch

from . import cuts
from .base import col, groups, prepare, texts_of
from .bytebpe import byte_chars

#: Longest code; ids of a block (at least); ids between two checkpoints.
MAX_BITS, BLOCK_IDS, STEP = 16, 1 << 16, 256
#: Bytes of text that a task cuts at a time.
TEXT_BYTES = 4 << 20
#: Parts that the byte-level pattern takes as a single match, whatever Unicode
#: version it knows: a space at most, then letters of blocks without gaps,
#: digits or ASCII punctuation. So many of them are given to the library at once.
_LONE, LONE_PARTS = (
    r"^ ?([A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{24f}\x{400}-\x{481}\x{48a}-\x{52f}\x{4e00}-\x{9fa5}\x{ac00}-\x{d7a3}]+"
    r"|[0-9]+|[!-/:-@\[-`{-~]+)$"
), 256
#: Code point of each byte's character; byte 0 stands between parts.
_POINTS = np.array([ord(" "), *map(ord, byte_chars()[1:])], dtype="<u4")


def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits by package-merge; 0 for
    counts of 0. A single id gets one bit."""
    used = np.flatnonzero(counts > 0)
    lengths = np.zeros(len(counts), dtype=np.int64)
    n = len(used)
    if n <= 1:
        lengths[used] = 1
        return lengths
    limit = max(limit, int(n - 1).bit_length())
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.float64)
    coins, is_leaf = leaves, [np.ones(n, dtype=bool)]
    for _ in range(limit - 1):
        packages = coins[: len(coins) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([leaves, packages])
        place = np.argsort(both, kind="stable")
        coins = both[place]
        is_leaf.append(place < n)
    need = 2 * n - 2
    for flags in reversed(is_leaf):  # from the shortest codes' level on
        taken = int(np.count_nonzero(flags[:need]))
        lengths[order[:taken]] += 1
        need = 2 * (need - taken)
    return lengths


def canonical(lengths: np.ndarray) -> np.ndarray:
    """Code of each id with a length: by length, then id."""
    codes = np.zeros(len(lengths), dtype=np.uint32)
    used = np.flatnonzero(lengths)
    used = used[np.argsort(lengths[used], kind="stable")]
    if len(used):
        bits = lengths[used]
        top = int(bits[-1])
        # codes as numbers of ``top`` bits: each starts where the one before ends
        starts = np.concatenate([[0], np.cumsum(1 << (top - bits[:-1]))])
        codes[used] = starts >> (top - bits)
    return codes


class Coder:
    """Encoding and decoding tables of one codebook (ids and their lengths)."""

    def __init__(self, ids: np.ndarray, bits: np.ndarray):
        self.lengths = np.zeros(int(ids.max(initial=-1)) + 1, dtype=np.int64)
        self.lengths[ids] = bits
        self.codes = canonical(self.lengths)
        self.top = max(1, int(self.lengths.max(initial=1)))
        if self.top > 25:
            raise ValueError("codes of more than 25 bits")
        used = np.flatnonzero(self.lengths)
        used = used[np.lexsort((used, self.lengths[used]))]
        width = 1 << (self.top - self.lengths[used])
        # the window that follows the last code (a lone id leaves half the table) decodes to it
        self.ids = np.zeros(1 << self.top, dtype=np.uint32)
        self.bits = np.ones(1 << self.top, dtype=np.uint8)
        self.ids[: int(width.sum())] = np.repeat(used, width)
        self.bits[: int(width.sum())] = np.repeat(self.lengths[used], width)

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Payload, and the bit offset of each id."""
        bits = self.lengths[ids]
        if len(ids) and not bits.all():
            raise ValueError("id without a code")
        end = np.cumsum(bits)
        at = end - bits
        total = int(end[-1]) if len(end) else 0
        shift = (32 - bits - (at & 7)).astype(np.uint64)
        word = self.codes[ids].astype(np.uint64) << shift
        out = np.zeros((total + 7) // 8 + 4, dtype=np.float64)
        for k in range(4):  # codes share bytes but no bits: sums are unions
            part = ((word >> np.uint64(24 - 8 * k)) & np.uint64(255)).astype(np.float64)
            out += np.bincount((at >> 3) + k, weights=part, minlength=len(out))[: len(out)]
        return out.astype(np.uint8)[: (total + 7) // 8].tobytes(), at

    def decode(self, payload: bytes, at: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Ids of runs that begin at bits ``at`` and have ``counts`` ids each,
        one run after the other; all runs advance together."""
        if not len(at):
            return np.empty(0, dtype=np.uint32)
        raw = np.frombuffer(payload + b"\0" * 8, dtype=np.uint8).astype(np.uint32)
        window = (raw[:-3] << 24) | (raw[1:-2] << 16) | (raw[2:-1] << 8) | raw[3:]
        steps, last = int(counts.max(initial=0)), len(window) - 1
        found = np.empty((steps, len(at)), dtype=np.uint32)
        pos, rest, mask = at.astype(np.int64).copy(), 32 - self.top, (1 << self.top) - 1
        for t in range(steps):
            seen = (window[np.minimum(pos >> 3, last)] >> (rest - (pos & 7)).astype(np.uint32)) & np.uint32(mask)
            found[t] = self.ids[seen]
            pos += self.bits[seen]
        return found.T[np.arange(steps) < counts[:, None]]


def _byte_sizes(config: dict) -> np.ndarray | None:
    """Bytes of each id, if the file is plain byte-level BPE: the usual pattern,
    nothing done to texts before it and no token but the model's found in them."""
    model, cut = config["model"], config.get("pre_tokenizer") or {}
    plain = (
        model.get("type") == "BPE" and cut.get("type") == "ByteLevel" and not cut.get("add_prefix_space", True) and cut.get("use_regex", True)
        and not any(config.get(k) for k in ("normalizer", "truncation", "padding"))
        and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback"))
        and all(t["special"] for t in config.get("added_tokens") or []) and all(c in model["vocab"] for c in byte_chars())
    )
    if not plain:
        return None
    sizes = np.zeros(max(model["vocab"].values()) + 1, dtype=np.int64)
    sizes[list(model["vocab"].values())] = list(map(len, model["vocab"]))
    return sizes


class Tokens:
    """Byte-level tokenizer file of the ``tokenizers`` library, over parts."""

    def __init__(self, config: str, special_strings: bool = False, limit: int = cuts.PART_CACHE):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.model = Tokenizer.from_str(config)
        self.model.encode_special_tokens = not special_strings
        # a special token's string is cut out of a text before anything else
        self.whole = special_strings and bool(self.model.get_added_tokens_decoder())
        self.sizes = None if special_strings else _byte_sizes(json.loads(config))
        self.cutting, self.between = self.model.pre_tokenizer, pre_tokenizers.CharDelimiterSplit(" ")
        self.memory = cuts.Memory(self._learn, self._forget, limit)
        self._forget()

    def _forget(self) -> None:
        self.ids, self.at = cuts.Growing(np.uint32), cuts.Growing(np.int64)
        self.at.extend([0])

    def _learn(self, parts: list[str]) -> None:
        lone = np.zeros(len(parts), dtype=bool)
        if self.sizes is not None:
            lone = pc.match_substring_regex(pa.array(parts, pa.string()), _LONE).to_numpy(zero_copy_only=False)
        done = [e.ids for e in self.model.encode_batch_fast(list(compress(parts, ~lone)), add_special_tokens=False)]
        ids, counts = self._matches(list(compress(parts, lone)))
        flat = np.concatenate([ids, np.fromiter(chain.from_iterable(done), dtype=np.uint32)])
        order = np.concatenate([np.flatnonzero(lone), np.flatnonzero(~lone)])
        length, start = np.empty((2, len(parts)), dtype=np.int64)
        length[order] = np.concatenate([counts, np.fromiter(map(len, done), dtype=np.int64, count=len(done))])
        start[order] = np.cumsum(length[order]) - length[order]
        self.at.extend(self.at.values[-1] + np.cumsum(length))
        self.ids.extend(cuts.gather(flat, start, length))

    def _matches(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of parts that are single matches, and the number of each one's.
        They go to the library many at a time, as bytes' characters with spaces
        between them: there is nothing left to cut or to map, and the ids'
        bytes tell where a part ends."""
        if not parts:
            return np.empty(0, dtype=np.uint32), np.empty(0, dtype=np.int64)
        raw = ["\0".join(parts[i : i + LONE_PARTS]).encode() for i in range(0, len(parts), LONE_PARTS)]
        shown = [_POINTS[np.frombuffer(r, dtype=np.uint8)].tobytes().decode("utf-32-le") for r in raw]
        self.model.pre_tokenizer = self.between
        try:
            done = self.model.encode_batch_fast(shown, add_special_tokens=False)
        finally:
            self.model.pre_tokenizer = self.cutting
        ids = np.fromiter(chain.from_iterable(e.ids for e in done), dtype=np.uint32)
        end, goal = np.cumsum(self.sizes[ids]), np.cumsum(pc.binary_length(pa.array(parts, pa.string())).to_numpy(), dtype=np.int64)
        at = np.searchsorted(end, goal)
        if len(end) <= at[-1] or (end[at] != goal).any():
            raise ValueError("ids that do not spell their text")
        return ids, np.diff(at + 1, prepend=0)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text of a group."""
        found = cuts.numbers(texts, self.memory, runs=True, whole=self.whole)
        ids, at = self.ids.values, self.at.values
        return [cuts.gather(ids, at[n], at[n + 1] - at[n]) for n in found]


_TOKENIZERS: dict[tuple[str, bool], Tokens] = {}


def _tokens(config: str, special_strings: bool) -> Tokens:
    key = (config, special_strings)
    if key not in _TOKENIZERS:
        _TOKENIZERS.clear()
        _TOKENIZERS[key] = Tokens(config, special_strings)
    return _TOKENIZERS[key]


def _width(ids: int) -> str:
    """Type of stored ids: two bytes where they fit."""
    return "<u2" if ids <= 1 << 16 else "<u4"


def token_table(
    docs: DataFrame, tokenizer: str, end_id: int, id_col: str, text_col: str, special_strings: bool,
) -> tuple[DataFrame, str]:
    """(id, tie, ids) -- the token ids of each text with the end id, and the
    text's hash -- and the type of the stored ids."""
    from tokenizers import Tokenizer

    with open(tokenizer, encoding="utf-8") as f:  # a vocabulary: fixed size
        text = f.read()
    config = docs.sparkSession.sparkContext.broadcast(text)
    width = _width(max(end_id + 1, *(i + 1 for i in Tokenizer.from_str(text).get_vocab().values())))
    own = docs.select(col(id_col).alias("id"), F.xxhash64(col(text_col)).alias("tie"), col(text_col).alias("text"))
    end = np.array([end_id], dtype=width).tobytes()
    kinds = {"id": docs.schema[id_col].dataType, "tie": T.LongType(), "ids": T.BinaryType()}
    schema = T.StructType([T.StructField(n, k) for n, k in kinds.items()])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _tokens(config.value, special_strings)
        for batch in batches:
            column = batch.column(2).cast(pa.binary())
            for a, b in groups(pc.fill_null(pc.binary_length(column), 0).to_pylist(), TEXT_BYTES):
                texts = [t.decode("utf-8", "replace") for t in texts_of(column.slice(a, b - a))]
                ids = [i.astype(width).tobytes() + end for i in tokens.encode(texts)]
                kept = [batch.column(i).slice(a, b - a).cast(arrow.field(i).type) for i in range(2)]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(ids, pa.binary())], schema=arrow)

    return own.mapInArrow(run, schema), width


def id_counts(table: DataFrame, width: str) -> DataFrame:
    """(id, count) over the ``ids`` of all rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            here = np.bincount(_joined(batch.column(0), width), minlength=len(total))
            here[: len(total)] += total
            total = here
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[ids])], names=["id", "count"])

    partial = table.select("ids").mapInArrow(count, "id long, count long")
    return partial.groupBy("id").agg(F.sum("count").alias("count"))


def _joined(column: pa.Array, width: str) -> np.ndarray:
    """The ids of a column of rows, one row after the other."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=width)


def _code(ordered: DataFrame, codebook, width: str, block_ids: int, step: int) -> DataFrame:
    """The blocks of sorted (id, ids) rows; a partition is a shard."""
    id_type = ordered.schema["id"].dataType
    schema = T.StructType([
        T.StructField("shard", T.IntegerType()), T.StructField("block", T.IntegerType()), T.StructField("first", T.LongType()),
        T.StructField("n_ids", T.LongType()), T.StructField("docs", T.ArrayType(id_type)),
        T.StructField("lengths", T.ArrayType(T.LongType())), T.StructField("step", T.IntegerType()),
        T.StructField("checkpoints", T.BinaryType()), T.StructField("payload", T.BinaryType()),
    ])

    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, shard = Coder(*codebook.value), TaskContext.get().partitionId()
        docs, held, size, block, first = [], [], 0, 0, 0

        def made() -> pa.RecordBatch:
            payload, at = coder.encode(np.concatenate(held))
            points = at[::step].astype("<u8").tobytes()
            row = [shard, block, first, size, docs, [len(h) for h in held], step, points, payload]
            return pa.RecordBatch.from_pydict({n: [v] for n, v in zip(schema.names, row)}, schema=arrow)

        for batch in batches:
            ids = batch.column(0).to_pylist()
            for doc, raw in zip(ids, batch.column(1).to_pylist()):
                docs.append(doc)
                held.append(np.frombuffer(raw, dtype=width))
                size += len(held[-1])
                if size >= block_ids:
                    yield made()
                    block, first = block + 1, first + size
                    docs, held, size = [], [], 0
        if docs:
            yield made()

    return ordered.mapInArrow(run, schema)


def write(
    docs: DataFrame, path: str, tokenizer: str, *, end_id: int, id_col: str = "doc_id", text_col: str = "text",
    special_strings: bool = False, max_bits: int = MAX_BITS, block_ids: int = BLOCK_IDS, step: int = STEP,
) -> str:
    """Writes the three tables under ``path`` (which must not exist)."""
    spark = docs.sparkSession
    prepare(spark)
    tokens = shared_scratch(spark, "token_ids", unique=True)
    table, width = token_table(docs, tokenizer, end_id, id_col, text_col, special_strings)
    table.write.parquet(tokens)
    stored = spark.read.parquet(tokens)
    found = id_counts(stored, width).orderBy("id").toPandas()  # a row per id of the vocabulary at most
    ids, counts = found["id"].to_numpy(dtype=np.int64), found["count"].to_numpy(dtype=np.int64)
    bits = code_lengths(counts, max_bits)
    book = pd.DataFrame({"id": ids, "count": counts, "bits": bits})
    spark.createDataFrame(book, "id long, count long, bits int").coalesce(1).write.parquet(f"{path}/codebook")
    codebook = spark.sparkContext.broadcast((ids, bits))
    order = ["id", "tie", "row"]
    rows = stored.withColumn("row", F.monotonically_increasing_id())
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "ids")
    _code(ordered, codebook, width, block_ids, step).write.parquet(f"{path}/blocks")
    delete_path(spark, tokens)
    blocks = spark.read.parquet(f"{path}/blocks")
    sizes = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n")).orderBy("shard").collect()  # a row per partition
    starts, total = [], 0
    for r in sizes:
        starts.append((r["shard"], total))
        total += r["n"]
    spark.createDataFrame(starts, "shard int, start long").coalesce(1).write.parquet(f"{path}/shards")
    return path


def _codebook(spark: SparkSession, path: str):
    book = spark.read.parquet(f"{path}/codebook").toPandas()  # bounded by the vocabulary
    return spark.sparkContext.broadcast((book["id"].to_numpy(dtype=np.int64), book["bits"].to_numpy(dtype=np.int64)))


def _blocks(spark: SparkSession, path: str) -> DataFrame:
    """Blocks with the number of ids in the file before each of them."""
    blocks, shards = spark.read.parquet(f"{path}/blocks"), spark.read.parquet(f"{path}/shards")
    return blocks.join(shards, "shard").withColumn("start", F.col("start") + F.col("first"))


def _runs(points: np.ndarray, n: int, step: int) -> np.ndarray:
    """Ids from each checkpoint to the next one."""
    counts = np.full(len(points), step, dtype=np.int64)
    if len(counts):
        counts[-1] = n - step * (len(points) - 1)
    return counts


def read(spark: SparkSession, path: str, *, id_col: str = "doc_id") -> DataFrame:
    """(id, ``start``, ``n_tokens``, ``ids``) of every document: number of ids
    before it, number of its ids, and these as little-endian unsigned 32-bit
    integers."""
    prepare(spark)
    codebook, blocks = _codebook(spark, path), _blocks(spark, path)
    id_type = blocks.schema["docs"].dataType.elementType
    schema = T.StructType([
        T.StructField("id", id_type), T.StructField("start", T.LongType()), T.StructField("n_tokens", T.LongType()),
        T.StructField("ids", T.BinaryType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(*codebook.value)
        for batch in batches:
            for i in range(batch.num_rows):
                start, n, docs, lengths, step, points, payload = (batch.column(k)[i] for k in range(7))
                at = np.frombuffer(points.as_py(), dtype="<u8").astype(np.int64)
                ids = coder.decode(payload.as_py(), at, _runs(at, n.as_py(), step.as_py())).astype("<u4").tobytes()
                size = np.array(lengths.values, dtype=np.int64)
                end = np.cumsum(size)
                yield pa.RecordBatch.from_arrays(
                    [docs.values, pa.array(start.as_py() + end - size), pa.array(size),
                     pa.array([ids[4 * a : 4 * b] for a, b in zip(end - size, end)], pa.binary())],
                    names=["id", "start", "n_tokens", "ids"],
                )

    done = blocks.select("start", "n_ids", "docs", "lengths", "step", "checkpoints", "payload").mapInArrow(run, schema)
    return done.withColumnRenamed("id", id_col)


def read_span(spark: SparkSession, path: str, first: int, count: int) -> DataFrame:
    """(``start``, ``ids``): the ids ``first`` .. ``first + count`` of the whole
    file, a row per block that holds some of them. Only the runs between
    checkpoints that meet the stretch are decoded."""
    prepare(spark)
    codebook, end = _codebook(spark, path), first + count
    blocks = _blocks(spark, path).filter((F.col("start") < end) & (F.col("start") + F.col("n_ids") > first))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(*codebook.value)
        for batch in batches:
            out = []
            for start, n, step, points, payload in zip(*(c.to_pylist() for c in batch.columns)):
                at = np.frombuffer(points, dtype="<u8").astype(np.int64)
                a, b = max(first - start, 0), min(end - start, n)
                runs = slice(a // step, -(-b // step))
                lead = a // step * step
                ids = coder.decode(payload, at[runs], _runs(at, n, step)[runs])[a - lead : b - lead]
                out.append((start + a, ids.astype("<u4").tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.binary())], names=["start", "ids"]
            )

    return blocks.select("start", "n_ids", "step", "checkpoints", "payload").mapInArrow(run, "start long, ids binary")


__all__ = ["Coder", "Tokens", "canonical", "code_lengths", "id_counts", "read", "read_span", "token_table", "write"]
