"""Alignment of two tokenizers over exactly deduplicated texts.

Tokenizer A is a byte-level BPE file of the ``tokenizers`` library, B a piece
model of ``sentencepiece``. A encodes a space and the text, B the text, to
which it adds that space. Tokens stand for bytes: A's by its byte table, B's
pieces as UTF-8 with U+2581 as a space and ``<0xHH>`` as one byte. Where a
token of A and a token of B end at the same byte, both sequences are cut; what
lies between two cuts is a group, and the two tokens that end there are a
link. The count of an id pair is the number of links of the whole input that
hold it.

Method: texts are shuffled by their full text and each distinct one is
tokenised and aligned once, with its number of copies as the weight of its
links; the measures are joined to the documents by the text's SHA-256. The
aligned texts are stored in chunks of about ``CHUNK_LINKS`` links, which hold
their distinct pairs once and a reference per link. A chunk's pairs, one row
each, are summed over all chunks and come back with their count and whether it
is the highest of their B id; chunk and answers meet in a cogroup. Nothing is
broadcast but the two vocabularies.

Memory: a task holds a group of texts, one chunk (a single longer text makes a
longer one) and a bounded memory of parts. Equal texts meet in a count that
combines before the shuffle; the final join has one row per text on one side,
so adaptive execution may split a text with very many copies.

Cases: a null or empty text, or one whose joined bytes of A or B differ from
space and text (U+2581 in the text, for instance), has no tokens: zeros and an
empty ``groups_sha256``. Strings of special tokens are ordinary text. Very
long texts are aligned whole. Repeated rows count as often as they occur. Ties
for the highest count are all best. An empty table gives an empty result.
Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from finwater.session import shared_scratch

from . import cuts
from .base import col, groups, prepare
from .bytebpe import byte_chars

#: Links of a chunk (at least), and parts remembered per Python worker.
CHUNK_LINKS, PARTS = 1 << 20, 400_000
_SHIFT = 32  # a pair is one number: A's id, then B's in the low bits

_CHUNKS = (
    "chunk long, h array<binary>, n_a array<long>, n_b array<long>, n_links array<long>, groups array<string>, "
    "refs binary, pairs binary, weights binary"
)
_MEASURES = "h binary, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


class Aligner:
    """Both tokenizers over parts of texts; made once per Python worker."""

    def __init__(self, a_config: str, b_model: bytes, limit: int = PARTS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_config)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        byte = {c: b for b, c in enumerate(byte_chars())}
        vocab = self.a.get_vocab(with_added_tokens=False)
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.a_bytes[i] = bytes(map(byte.__getitem__, token))
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        self.whole = not cuts.safe_pieces(pieces)
        self.memory = cuts.Memory(self._learn, self._forget, limit)
        self._forget()

    def _forget(self) -> None:
        self.n_a, self.n_b, self.ok = (cuts.Growing(t) for t in (np.int64, np.int64, bool))
        self.links, self.at, self.shown = cuts.Growing(np.int64), cuts.Growing(np.int64), []
        self.at.extend([0])

    def _learn(self, parts: list[str]) -> None:
        first = [e.ids for e in self.a.encode_batch_fast(parts, add_special_tokens=False)]
        second = self.b.encode([p[1:] for p in parts], num_threads=1)  # B adds the space
        links, ends, ok, at = [], [], [], int(self.at.values[-1])
        for part, a, b in zip(parts, first, second):
            shown, found = self.align(a, b)
            meant = part.encode()
            ok.append(b"".join(map(self.a_bytes.__getitem__, a)) == meant == b"".join(map(self.b_bytes.__getitem__, b)))
            links += found
            at += len(found)
            ends.append(at)
            self.shown.append(shown)
        self.n_a.extend([len(a) for a in first])
        self.n_b.extend([len(b) for b in second])
        self.ok.extend(ok)
        self.links.extend(links)
        self.at.extend(ends)

    def align(self, a: list[int], b: list[int]) -> tuple[str, list[int]]:
        """The groups as text and the linked pairs of one part."""
        shown, links, i, j, end_a, end_b, from_a, from_b = [], [], 0, 0, 0, 0, 0, 0
        while True:
            if end_a <= end_b:
                if i == len(a):
                    break
                end_a += len(self.a_bytes[a[i]])
                i += 1
            else:
                if j == len(b):
                    break
                end_b += len(self.b_bytes[b[j]])
                j += 1
            if end_a == end_b:
                shown.append(f"{','.join(map(str, a[from_a:i]))}|{','.join(map(str, b[from_b:j]))}")
                links.append(a[i - 1] << _SHIFT | b[j - 1])
                from_a, from_b = i, j
        return ";".join(shown), links

    def texts(self, texts: list[str]) -> list[tuple[int, int, str, np.ndarray] | None]:
        """(tokens of A, tokens of B, groups as text, links) of each text, None
        for texts whose bytes the tokens do not give back."""
        out = []
        for text, n in zip(texts, cuts.numbers([" " + t for t in texts], self.memory, whole=self.whole)):
            if not text or not self.ok.values[n].all():
                out.append(None)
                continue
            at = self.at.values
            links = cuts.gather(self.links.values, at[n], at[n + 1] - at[n])
            shown = ";".join(map(self.shown.__getitem__, n.tolist()))
            out.append((int(self.n_a.values[n].sum()), int(self.n_b.values[n].sum()), shown, links))
        return out


_LOADED: dict[tuple[int, int], Aligner] = {}


def _aligner(a_config: str, b_model: bytes) -> Aligner:
    key = (hash(a_config), hash(b_model))
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Aligner(a_config, b_model)
    return _LOADED[key]


class _Chunk:
    """Aligned texts until there are enough links for a row."""

    def __init__(self) -> None:
        self.rows, self.links, self.copies, self.size = [], [], [], 0

    def add(self, h: bytes, copies: int, found) -> None:
        n_a, n_b, shown, links = found
        self.rows.append((h, n_a, n_b, len(links), hashlib.sha256(shown.encode()).hexdigest()))
        self.links.append(links)
        self.copies.append(copies)
        self.size += len(links)

    def row(self, chunk: int) -> pa.RecordBatch:
        lengths = np.array([len(x) for x in self.links], dtype=np.int64)
        pairs, refs = np.unique(np.concatenate(self.links), return_inverse=True)
        weight = np.zeros(len(pairs), dtype=np.int64)
        np.add.at(weight, refs, np.repeat(np.array(self.copies, dtype=np.int64), lengths))
        h, n_a, n_b, n_links, shown = (list(c) for c in zip(*self.rows))
        narrow = refs.astype("<u2" if len(pairs) <= 1 << 16 else "<u4")
        values = [chunk, h, n_a, n_b, n_links, shown, narrow.tobytes(), pairs.astype("<i8").tobytes(), weight.astype("<i8").tobytes()]
        types = [pa.int64(), pa.list_(pa.binary()), *[pa.list_(pa.int64())] * 3, pa.list_(pa.string()), *[pa.binary()] * 3]
        names = ["chunk", "h", "n_a", "n_b", "n_links", "groups", "refs", "pairs", "weights"]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], names=names)


def align_chunks(distinct: DataFrame, a_config, b_model, chunk_links: int = CHUNK_LINKS) -> DataFrame:
    """Chunks of the aligned rows of ``distinct`` (h, copies, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, chunk, number = _aligner(a_config.value, b_model.value), _Chunk(), TaskContext.get().partitionId() << 32
        for batch in batches:
            raw = batch.column(2).cast(pa.binary())
            for a, b in groups([len(x.as_buffer()) for x in raw]):
                h, copies = (batch.column(i).slice(a, b - a).to_pylist() for i in range(2))
                found = aligner.texts([t.decode("utf-8", "replace") for t in raw.slice(a, b - a).to_pylist()])
                for row in zip(h, copies, found):
                    if row[2] is not None:
                        chunk.add(*row)
                    if chunk.size >= chunk_links:
                        yield chunk.row(number)
                        chunk, number = _Chunk(), number + 1
        if chunk.rows:
            yield chunk.row(number)

    return distinct.select("h", "copies", "text").mapInArrow(run, _CHUNKS)


def pair_answers(chunks: DataFrame) -> DataFrame:
    """(chunk, pair, count, best): for each distinct pair of a chunk its links
    in the whole input, and whether no pair of its B id has more."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, pairs, weights in zip(*batch.columns):
                p, w = (np.frombuffer(x.as_buffer(), dtype="<i8") for x in (pairs, weights))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(p), chunk.as_py())), pa.array(p), pa.array(w)], names=["chunk", "pair", "weight"]
                )

    rows = chunks.select("chunk", "pairs", "weights").mapInArrow(unpack, "chunk long, pair long, weight long")
    counts = rows.groupBy("pair").agg(F.sum("weight").alias("count"))
    b_id = F.col("pair").bitwiseAND((1 << _SHIFT) - 1)
    best = F.col("count") == F.max("count").over(Window.partitionBy(b_id))  # a row per pair of the id: bounded by A's vocabulary
    return rows.select("chunk", "pair").join(counts.withColumn("best", best), "pair")


def _measure(chunks: pa.Table, answers: pa.Table) -> pa.Table:
    """Measures of a chunk's texts."""
    row = {name: chunks.column(name)[0].as_py() for name in chunks.column_names}
    pair, count = (answers.column(n).to_numpy() for n in ("pair", "count"))
    order = np.argsort(pair)
    count = count[order]
    best = answers.column("best").to_numpy(zero_copy_only=False)[order].astype(np.int64)
    refs = np.frombuffer(row["refs"], dtype="<u2" if len(pair) <= 1 << 16 else "<u4")
    starts = np.concatenate([[0], np.cumsum(row["n_links"])])
    both = [np.concatenate([[0], np.cumsum(v[refs])]) for v in (best, count)]
    n_best, count_sum = ((c[starts[1:]] - c[starts[:-1]]) for c in both)
    made = [row["h"], row["n_a"], row["n_b"], row["n_links"], row["n_links"], n_best, count_sum, row["groups"]]
    types = [pa.binary(), *[pa.int64()] * 6, pa.string()]
    names = ["h", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return pa.Table.from_arrays([pa.array(v, t) for v, t in zip(made, types)], names=names)


def align(
    docs: DataFrame, a_file: str, b_file: str, *, id_col: str = "doc_id", text_col: str = "text", chunk_links: int = CHUNK_LINKS,
) -> DataFrame:
    """(id, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``,
    ``count_sum``, ``groups_sha256``), one row per input row."""
    spark = docs.sparkSession
    prepare(spark)
    with open(a_file, encoding="utf-8") as f, open(b_file, "rb") as g:  # vocabularies: fixed size
        a_config, b_model = spark.sparkContext.broadcast(f.read()), spark.sparkContext.broadcast(g.read())
    digest = F.unhex(F.sha2(F.col("text"), 256))
    own = docs.select(col(id_col).alias("id"), F.nullif(col(text_col), F.lit("")).alias("text"))
    distinct = own.filter(F.col("text").isNotNull()).groupBy("text").agg(F.count(F.lit(1)).alias("copies")).withColumn("h", digest)
    path = shared_scratch(spark, "aligned_chunks", unique=True)
    align_chunks(distinct, a_config, b_model, chunk_links).write.parquet(path)
    chunks = spark.read.schema(_CHUNKS).parquet(path)
    answers = pair_answers(chunks)
    measured = chunks.drop("pairs", "weights").groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_measure, _MEASURES)
    joined = own.select("id", digest.alias("h")).join(measured, "h", "left")
    zeros = [F.coalesce(n, F.lit(0).cast("long")).alias(n) for n in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]
    return joined.select(F.col("id").alias(id_col), *zeros, F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))


__all__ = ["Aligner", "align", "align_chunks", "pair_answers"]
