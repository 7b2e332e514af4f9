"""Byte-level BPE encoding and decoding with the ``tokenizers`` library.

The rank file of a public tokenizer gives each token's bytes and rank. Bytes
are mapped to printable characters (the usual byte-level table), the ranks
become a vocabulary and an ordered merge list, and texts are cut by the
tokenizer's pattern; each match is encoded on its own. A match that is itself
a token is taken whole, as rank tokenizers do. Every pair of tokens whose
joined bytes are a token is a merge, in rank order, since rank tokenizers
join by the result's rank however the parts arose.

Encoding runs over Arrow batches. The distinct matches of a group of texts go
through the library in one call and their ids are gathered back, with a
bounded memory of matches kept per Python worker.

Cases: null or empty text: no ids, empty decoded bytes. Very long texts are
encoded whole. Repeated rows give repeated results. An empty table gives an
empty result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import codecs
import os
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .base import col, map_texts, prepare

#: Matches remembered per Python worker before the memory is started anew.
PIECE_CACHE = 100_000


def byte_chars() -> list[str]:
    """Character of each byte: printable Latin-1 stands for itself, the rest
    follow from U+0100 in order."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


def read_ranks(path: str) -> bytes:
    """The rank file's bytes (a vocabulary: fixed size, about 1 MB)."""
    with open(path, "rb") as f:
        return f.read()


class ByteBPE:
    """Encoder and decoder of one vocabulary; made once per Python worker."""

    def __init__(self, rank_file: bytes, pattern: str, cache: int = PIECE_CACHE):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Regex, Tokenizer, models, pre_tokenizers

        ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, rank_file.splitlines()) if t}
        chars = byte_chars()
        self.char_byte = {c: b for b, c in enumerate(chars)}
        name = {t: "".join(map(chars.__getitem__, t)) for t in ranks}
        merges = [
            (name[t[:i]], name[t[i:]])
            for t in sorted(ranks, key=ranks.get)
            for i in range(1, len(t))
            if t[:i] in ranks and t[i:] in ranks
        ]
        vocab = {name[t]: r for t, r in ranks.items()}
        self.level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.cutting = pre_tokenizers.Sequence([pre_tokenizers.Split(Regex(pattern), "isolated"), self.level])
        self.model = Tokenizer(models.BPE(vocab=vocab, merges=merges, ignore_merges=True, cache_capacity=0))
        self.model.pre_tokenizer = self.level  # matches are cut beforehand
        self.matches = regex.compile(pattern).findall
        self.cache = cache
        self._forget()
        # decoding table: the vocabulary's characters through the reversed byte table
        size = max(vocab.values()) + 1
        table: list[bytes] = [b""] * size
        for text, token in vocab.items():
            table[token] = bytes(map(self.char_byte.__getitem__, text))
        self.known = np.zeros(size, dtype=bool)
        self.known[list(vocab.values())] = True
        self.byte_len = np.array([len(t) for t in table], dtype=np.int64)
        self.byte_at = np.concatenate([[0], np.cumsum(self.byte_len)])
        self.bytes = np.frombuffer(b"".join(table), dtype=np.uint8)
        self.table = table

    def _forget(self) -> None:
        self.slot: dict[str, int] = {}
        self.ids = np.empty(0, dtype=np.uint32)
        self.at = np.zeros(1, dtype=np.int64)

    def _learn(self, pieces: list[str]) -> None:
        done = self.model.encode(pieces, is_pretokenized=True, add_special_tokens=False)
        lengths = np.bincount(np.array(done.word_ids, dtype=np.int64), minlength=len(pieces))
        self.ids = np.concatenate([self.ids, np.array(done.ids, dtype=np.uint32)])
        self.at = np.concatenate([self.at, self.at[-1] + np.cumsum(lengths)])
        self.slot.update(zip(pieces, range(len(self.slot), len(self.slot) + len(pieces))))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        cut = [self.matches(t) for t in texts]
        new = set().union(*cut).difference(self.slot)
        if len(self.slot) + len(new) > self.cache:
            self._forget()
            new = set().union(*cut)
        if new:
            self._learn(sorted(new))
        out = []
        for pieces in cut:
            at = np.fromiter(map(self.slot.__getitem__, pieces), dtype=np.int64, count=len(pieces))
            out.append(_gather(self.ids, self.at[at], self.at[at + 1] - self.at[at]))
        return out

    def encode_offsets(self, text: str) -> tuple[list[int], list[tuple[int, int]]]:
        """Ids and character offsets of one text; a token that holds a part of
        a character spans that character."""
        self.model.pre_tokenizer = self.cutting
        done = self.model.encode(text, add_special_tokens=False)
        self.model.pre_tokenizer = self.level
        return done.ids, done.offsets

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of the ids; an unknown id raises."""
        at = np.asarray(ids, dtype=np.int64)
        if len(at) and (at.min() < 0 or at.max() >= len(self.known) or not self.known[at].all()):
            raise ValueError("id outside the vocabulary")
        return _gather(self.bytes, self.byte_at[at], self.byte_len[at]).tobytes()

    def stream(self, ids: Iterable[int]) -> Iterator[str]:
        """Text of one id after another: bytes of a character that is split
        over tokens wait for its last one; invalid bytes become U+FFFD."""
        decoder = codecs.getincrementaldecoder("utf-8")(errors="replace")
        for i in ids:
            yield decoder.decode(self.table[i])
        yield decoder.decode(b"", final=True)


def _gather(values: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """values[start : start + length], one range after the other."""
    end = np.cumsum(length)
    total = int(end[-1]) if len(end) else 0
    return values[np.repeat(start - end + length, length) + np.arange(total)]


_LOADED: dict[tuple[int, str], ByteBPE] = {}


def _coder(rank_file: bytes, pattern: str) -> ByteBPE:
    key = (hash(rank_file), pattern)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = ByteBPE(rank_file, pattern)
    return _LOADED[key]


def encode(
    df: DataFrame, ranks_path: str, pattern: str, *, keep: list[str], text_col: str = "text",
    offsets: bool = False, decoded: bool = False,
) -> DataFrame:
    """The ``keep`` columns, ``n_tokens`` and ``ids`` (little-endian unsigned
    32-bit integers) of each row's whole text.

    ``offsets`` adds ``char_start`` and ``char_end`` arrays; ``decoded`` adds
    the bytes that the ids decode to. The rank file is read once on the
    driver and broadcast (a vocabulary: fixed size).
    """
    ranks = df.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())]
    if offsets:
        fields += [T.StructField(n, T.ArrayType(T.IntegerType())) for n in ("char_start", "char_end")]
    if decoded:
        fields.append(T.StructField("decoded", T.BinaryType()))

    def work(texts: list[bytes]) -> list[list]:
        coder = _coder(ranks.value, pattern)
        strings = [t.decode("utf-8", "replace") for t in texts]
        if offsets:
            pairs = [coder.encode_offsets(t) for t in strings]
            ids = [np.array(i, dtype=np.uint32) for i, _ in pairs]
        else:
            ids = coder.encode(strings)
        out = [[len(i) for i in ids], [i.astype("<u4").tobytes() for i in ids]]
        if offsets:
            out += [[[a for a, _ in o] for _, o in pairs], [[b for _, b in o] for _, o in pairs]]
        if decoded:
            out.append([coder.decode(i) for i in ids])
        return out

    return map_texts(df, keep, text_col, fields, work)


def decode(df: DataFrame, ranks_path: str, pattern: str, *, keep: list[str], ids_col: str = "ids") -> DataFrame:
    """The ``keep`` columns, the ``decoded`` bytes of each row's ids and their
    ``text`` (bytes that are no UTF-8 become U+FFFD); null ids give both null."""
    prepare(df.sparkSession)
    ranks = df.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    names = [f"_k{i}" for i in range(len(keep))]
    source = df.select(*[col(k).alias(n) for k, n in zip(keep, names)], col(ids_col).alias("_ids"))
    schema = T.StructType(
        [T.StructField(n, df.schema[k].dataType) for k, n in zip(keep, names)]
        + [T.StructField("decoded", T.BinaryType()), T.StructField("text", T.StringType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(ranks.value, pattern)
        for batch in batches:
            raw = batch.column(len(names)).to_pylist()
            done = [None if r is None else coder.decode(np.frombuffer(r, dtype="<u4")) for r in raw]
            text = [None if b is None else b.decode("utf-8", "replace") for b in done]
            arrays = [*batch.columns[: len(names)], pa.array(done, pa.binary()), pa.array(text, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*names, "decoded", "text"])

    made = source.mapInArrow(run, schema)
    return made.select(*[col(n).alias(k) for n, k in zip(names, keep)], "decoded", "text")


__all__ = ["ByteBPE", "byte_chars", "decode", "encode", "read_ranks"]
