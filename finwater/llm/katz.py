"""Katz backoff language model: counting, storing, scoring.

Tokens are lower-cased (A-Z) words and one end per text; a text's first token
has the start symbol as history. With c the training counts of an n-gram
(history h, word w), d_r the Good-Turing discounts of counts up to ``K`` and
P' the model of one order less,

    P(w | h) = d_c * c(h, w) / c(h)    if c(h, w) > 0
    P(w | h) = a(h) * P'(w | h')       otherwise

where a(h) is what the discounts leave, divided by what P' gives to words not
seen after h, so that P(. | h) adds up to one over the vocabulary and one
unknown word; a history never seen has a(h) = 1. Words have Good-Turing
estimates, and what is left is the unknown word's. A history whose counts are
all above K leaves nothing: its denominator then gets one more.

How it runs: texts are read once into chunks (about ``CHUNK_TOKENS`` tokens:
distinct words as 64-bit hashes and token positions), stored as a table. Words
are counted first and numbered by the buckets that count them (the number's
remainder by the buckets is the bucket), so that later requests carry short
differences of numbers instead of hashes; n-grams that are histories of the
next order are numbered alike. Per
order, every chunk sends its distinct n-grams with their training counts to
buckets by history; a bucket adds up, stores its part of the model (counts;
``tables`` joins what the backoff weights are made of) and answers each chunk
with the totals it asked for. So each n-gram moves once per chunk and never
per occurrence, and a text's score is evaluated inside its chunk, order by
order, without any table of the whole vocabulary. A history with more than a
bucket's share of tokens is dealt over several buckets by word; its sums are
added up by those who ask. The driver sees counts of counts only.

Buckets also tell which n-grams only one chunk holds. Of the last order (from 3
on), n-grams whose history or lower n-gram is such a one are in that chunk
alone, so they are counted there and stay there: what they add to the sums of a
history that other chunks hold too is sent as a few whole numbers, and
``tables`` reads them out of the chunks.

Cases: null or empty text: one token, the end. A null id is training. Very
long texts make a larger chunk. Repeated rows are counted each and scored
each. Without training tokens the unknown word has probability one. An empty
table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import gc
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finwater.session import shared_scratch

from .base import col, prepare, texts_of

ORDER, K = 2, 5
#: Tokens of a chunk, and chunks per bucket: both bound a task's memory.
CHUNK_TOKENS, CHUNKS_PER_BUCKET, MIN_BUCKETS = 1_500_000, 2, 16
#: Number of the start symbol, beyond those of words. The end is the hash of
#: the empty text, which no word equals.
START = 1 << 63


# ------------------------------------------------------------ packed arrays


def pack(a: np.ndarray) -> bytes:
    """Type, then zstd of the bytes, plane by plane."""
    a = np.ascontiguousarray(a)
    kind = a.dtype.str.encode()
    planes = a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() if len(a) else b""
    return kind + b";" + zstandard.ZstdCompressor(level=3).compress(planes)


def unpack(b: bytes) -> np.ndarray:
    kind, _, rest = bytes(b).partition(b";")
    dtype = np.dtype(kind.decode())
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(rest), dtype=np.uint8)
    return np.ascontiguousarray(planes.reshape(dtype.itemsize, -1).T).view(dtype).reshape(-1)


def small(a: np.ndarray) -> np.ndarray:
    """Non-negative integers in the narrowest type that holds them."""
    return a.astype(np.min_scalar_type(int(a.max()) if len(a) else 0))


def by_bucket(words: np.ndarray, buckets: int) -> list[tuple[int, slice]]:
    """(bucket, its words) of ascending hashes; buckets are ranges of hashes."""
    bucket = ((words >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    edges = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))
    return [(b, slice(a, z)) for b, (a, z) in enumerate(zip(edges, edges[1:])) if z > a]


def pack_sorted(a: np.ndarray) -> bytes:
    """64-bit numbers as differences (modulo 2^64), short where they ascend."""
    return pack(small(np.diff(a.astype("<u8"), prepend=np.uint64(0))))


def unpack_sorted(b: bytes) -> np.ndarray:
    return np.cumsum(unpack(b), dtype=np.uint64)


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One hash of two, in order."""
    x = (a ^ np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9) + b
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def by_key(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-negative keys ascending, and the place of each, ties by place. Key and
    place are sorted as one number where they fit, which is several times faster
    than an argsort."""
    bits = len(key).bit_length()
    if len(key) and int(key.max()) >> (63 - bits):
        order = np.argsort(key, kind="stable")
        return key[order], order
    both = key.astype(np.int64) << bits
    both |= np.arange(len(key))
    both.sort()
    return both >> bits, both & ((1 << bits) - 1)


def distinct(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys ascending, the first place of each, and the number of every key."""
    ordered, order = by_key(key)
    new = np.ones(len(key), dtype=bool)
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    number = np.empty(len(key), dtype=np.int32)
    number[order] = np.cumsum(new, dtype=np.int32) - 1
    return ordered[new], order[new], number


# ---------------------------------------------------------------- discounts


def discounts(n: list[int]) -> np.ndarray:
    """d_1..d_K from the counts of counts n_1..n_{K+1}: Katz's renormalised
    Good-Turing ratios, or absolute discounting where these are undefined or
    outside (0, 1)."""
    n1, n2 = n[0], n[1]
    step = n1 / (n1 + 2 * n2) if n1 else 0.5
    absolute = np.array([1 - step / r if step < 1 else 1 - 0.75 / r for r in range(1, K + 1)])
    if min(n) <= 0 or (K + 1) * n[K] >= n1:
        return absolute
    tail = (K + 1) * n[K] / n1
    d = np.array([((r + 1) * n[r] / (r * n[r - 1]) - tail) / (1 - tail) for r in range(1, K + 1)])
    return d if ((d > 0) & (d < 1)).all() else absolute


def factor(r: np.ndarray, d: np.ndarray) -> np.ndarray:
    """d_r for counts r (1 above K)."""
    return np.concatenate([[0.0], d, [1.0]])[np.minimum(r, K + 1).astype(np.int64)]


def seen_share(r: np.ndarray, total: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Probability of n-grams seen r times after a history seen ``total`` times."""
    return factor(r, d) * r / total


def seldom(r: np.ndarray, history: np.ndarray, histories: int) -> np.ndarray:
    """How many followers of each history were seen 1..K times."""
    few = np.flatnonzero((r > 0) & (r <= K))
    return np.bincount(history[few] * K + r[few] - 1, minlength=histories * K).reshape(-1, K)


def lower_counts(low: np.ndarray, history: np.ndarray, histories: int) -> np.ndarray:
    """Of each history's (seen) followers, by their counts in the order below:
    how many have 1..K, and the sum of the counts above K. Whole numbers, from
    which follows what P' gives to the followers (``covered_by``)."""
    place = history.astype(np.int64) * (K + 1) + np.minimum(low, K + 1) - 1
    return np.bincount(place, weights=np.where(low > K, low, 1), minlength=histories * (K + 1)).astype(np.int64).reshape(-1, K + 1)


def covered_by(lower: np.ndarray, total: np.ndarray | float, d: np.ndarray) -> np.ndarray:
    """What P' gives to followers, from ``lower_counts``; ``total`` and ``d`` are
    those of the order below."""
    return lower @ np.append(d * np.arange(1, K + 1), 1.0) / total


@dataclass
class Globals:
    """What the driver knows: N, V, training texts, discounts per order."""

    tokens: int = 0
    types: int = 0
    texts: int = 0
    n: dict[int, list[int]] = field(default_factory=dict)
    buckets: int = MIN_BUCKETS
    order: int = ORDER

    def discount(self, order: int) -> np.ndarray:
        return discounts(self.n[order])

    def _unigram_left(self) -> float:
        d = self.discount(1)
        return sum((1 - d[r - 1]) * r * self.n[1][r - 1] for r in range(1, K + 1))

    def unigram_total(self) -> int:
        """What the count of a word is divided by."""
        return self.tokens + int(self._unigram_left() <= 0)

    def unigram(self, c: np.ndarray) -> np.ndarray:
        """Probabilities of words by training count (0: the unknown word)."""
        d, left, total = self.discount(1), self._unigram_left(), self.unigram_total()
        unknown = (left if left > 0 else 1) / total
        return np.where(c > 0, factor(c, d) * c / total, unknown)

    def keeps_local(self, k: int) -> bool:
        """Whether k-grams that only one chunk holds stay in it."""
        return k == self.order > 2


# ------------------------------------------------------------------- chunks


class Chunk:
    """One chunk's tokens and, per order, its distinct n-grams.

    Tokens are stored as numbers of words, most frequent first, with the places
    of these words among the chunk's ascending hashes, and get the ranks of global
    numbers once these are known; the start symbol follows them. The n-grams of
    order k are numbered by (history, word); a history of order k is an
    (k-1)-gram, for k = 2 a word or the start, in ascending order of its global
    number, which the buckets gave it (``name``)."""

    def __init__(self, places: bytes, tokens: bytes, lengths: bytes, held: bytes):
        self.places, self.tokens = unpack_sorted(places).astype(np.int64), unpack(tokens).astype(np.int32)
        self.lengths, self.held = unpack(lengths).astype(np.int64), unpack(held).astype(bool)
        self.begin = np.concatenate([[0], np.cumsum(self.lengths)[:-1]]).astype(np.int64)
        self.train = np.repeat(~self.held, self.lengths)
        self.place = (np.arange(len(self.tokens)) - np.repeat(self.begin, self.lengths)).astype(np.int32)
        self._grams: dict[int, dict] = {}

    def renumber(self, numbers: np.ndarray) -> np.ndarray:
        """Takes the words' global numbers, which become the chunk's words in
        ascending order; returns their places among the hashes."""
        order = np.argsort(numbers)
        rank = np.empty(len(order), dtype=np.int32)
        rank[order] = np.arange(len(order))
        self.words, self.tokens = numbers[order], rank[self.places][self.tokens]
        return order

    def grams(self, k: int) -> dict:
        if k not in self._grams:
            self._grams[k] = self._first() if k == 1 else self._next(k)
        return self._grams[k]

    def _first(self) -> dict:
        n = len(self.words)
        return {
            "at": np.arange(len(self.tokens)), "id": self.tokens, "hash": self.words, "n": n,
            "count": np.bincount(self.tokens[self.train], minlength=n),
        }

    def _next(self, k: int) -> dict:
        below, width = self.grams(k - 1), len(self.words) + 1
        at = np.flatnonzero(self.place >= k - 2).astype(np.int32)
        lower = np.full(len(self.tokens), -1, dtype=np.int32)
        lower[below["at"]] = below["id"]
        if k == 2:
            before = np.where(self.place > 0, np.roll(self.tokens, 1), np.int32(len(self.words)))
            hashes, place = np.append(self.words, np.uint64(START)), None
        else:
            place = by_key(below["number"].astype(np.int64))[1]
            rank = np.zeros(len(place) + 1, dtype=np.int32)  # one more for tokens without a history
            rank[place] = np.arange(len(place))
            before, hashes = rank[np.roll(lower, 1)], below["number"][place]
        key = before[at].astype(np.int64)
        del before
        key *= width
        key += self.tokens[at]
        key, first, ids = distinct(key)
        history, word = np.divmod(key, width)
        return {
            "at": at, "id": ids, "n": len(key), "history": history.astype(np.int32), "word": word.astype(np.int32),
            "lower": lower[at[first]], "history_hash": hashes, "history_place": place, "hash": mix(hashes[history], self.words[word]),
            "count": np.bincount(ids[self.train[at]], minlength=len(key)).astype(np.int32),
        }

    def name(self, k: int, numbers: np.ndarray, alone: np.ndarray) -> None:
        """Takes the global numbers of the chunk's k-grams, and which of them no
        other chunk holds."""
        self.grams(k).update(number=numbers, alone=alone)


@dataclass
class Part:
    """What a chunk asks one bucket about: n-grams and histories."""

    bucket: int
    grams: np.ndarray  # n-gram numbers, by history
    entries: np.ndarray  # indexes into the chunk's list of asked histories
    followers: np.ndarray  # n-grams of each entry
    home: np.ndarray  # whether the bucket is the first that an entry's history is dealt to


@dataclass
class Layout:
    history: np.ndarray  # the chunk's histories, each once
    index: np.ndarray  # of each n-gram, its history's place in that list
    spread: np.ndarray  # buckets over which each history is dealt
    parts: list[Part]
    local: np.ndarray  # n-grams that stay in the chunk
    shared: np.ndarray  # histories that are asked about


def layout(g: dict, history_count: np.ndarray, buckets: int, share: float, alone: np.ndarray | None = None) -> Layout:
    """How a chunk's n-grams are dealt to buckets. ``history_count``: training
    tokens after each history; a history with more than ``share`` of them is
    spread by word. ``alone``: the (k-1)-grams that no other chunk holds; n-grams
    with such a history or such an end are not dealt, and nothing is asked about
    such histories."""
    new = np.ones(g["n"], dtype=bool)  # n-grams are in the order of their histories
    np.not_equal(g["history"][1:], g["history"][:-1], out=new[1:])
    history, index = g["history"][new], np.cumsum(new) - 1
    spread = np.clip(np.ceil(history_count[history] / max(share, 1.0)), 1, buckets).astype(np.int64)
    named = g["history_hash"][history]
    shared, local = np.ones(len(history), dtype=bool), np.zeros(g["n"], dtype=bool)
    if alone is not None:
        shared = ~alone[g["history_place"][history]]
        local = ~shared[index] | alone[g["lower"]]
    # numbers of n-grams hold their bucket as remainder: they are dealt anew
    home = ((named if g["history_place"] is None else mix(named, np.uint64(2))) % np.uint64(buckets)).astype(np.int64)
    sent = np.flatnonzero(~local)
    word = (mix(g["hash"][sent], np.uint64(1)) % spread[index[sent]].astype(np.uint64)).astype(np.int64)
    bucket = (home[index[sent]] + word) % buckets
    # every history is asked of all buckets it is spread over; the first is its home
    times = np.where(shared, spread, 0)
    entry = np.repeat(np.arange(len(history)), times)
    step = np.arange(len(entry)) - np.repeat(np.cumsum(times) - times, times)
    entry_key = np.sort(((home[entry] + step) % buckets) * len(history) + entry)
    gram_key, order = by_key(bucket * len(history) + index[sent])
    followers = np.searchsorted(gram_key, entry_key, side="right") - np.searchsorted(gram_key, entry_key)
    entry_bucket, entry = np.divmod(entry_key, max(len(history), 1))
    gram_edge = np.searchsorted(gram_key, np.arange(buckets + 1) * len(history))
    entry_edge = np.searchsorted(entry_bucket, np.arange(buckets + 1))
    parts = []
    for b in range(buckets):
        a, z = entry_edge[b], entry_edge[b + 1]
        if z > a:
            at = entry[a:z]
            parts.append(Part(b, sent[order[gram_edge[b] : gram_edge[b + 1]]], at, followers[a:z], home[at] == b))
    return Layout(history, index, spread, parts, local, shared)


class Scorer:
    """A chunk with the answers to what it has asked so far."""

    def __init__(self, chunk: Chunk, known: Globals, answers: dict[tuple[int, int], dict]):
        self.chunk, self.known, self.answers = chunk, known, answers
        told = [(b, answers[1, b]) for b in range(known.buckets) if (1, b) in answers]  # by ascending hash
        number = np.concatenate([unpack_sorted(a["number"]) * np.uint64(known.buckets) + np.uint64(b) for b, a in told])
        count = np.concatenate([unpack(a["count"]).astype(np.int64) for _, a in told])
        #: Training count of each of the chunk's words.
        self.word_count = count[chunk.renumber(number)]

    def history_count(self, k: int) -> np.ndarray:
        if k == 2:
            return np.append(self.word_count, self.known.texts)
        return self.level(k - 1)[0][self.chunk.grams(k)["history_place"]]

    def layout(self, k: int) -> Layout:
        if k not in self.__dict__.setdefault("_layouts", {}):
            if k > 2:
                self.level(k - 1)  # names the histories
            alone = self.chunk.grams(k - 1)["alone"] if self.known.keeps_local(k) else None
            self._layouts[k] = layout(
                self.chunk.grams(k), self.history_count(k), self.known.buckets, self.known.tokens / self.known.buckets, alone
            )
        return self._layouts[k]

    def level(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
        """Training count and probability of each of the chunk's k-grams, and
        what the count of a seen one is divided by."""
        if k not in self.__dict__.setdefault("_levels", {}):
            self._levels[k] = self._level(k)
        return self._levels[k]

    def local_sums(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """What the n-grams that stay in the chunk add to the sums of each of its
        histories: ``seldom`` and ``lower_counts``."""
        asked, g = self.layout(k), self.chunk.grams(k)
        at = np.flatnonzero(asked.local & (g["count"] > 0))
        r, index, n = g["count"][at], asked.index[at], len(asked.history)
        return seldom(r, index, n), lower_counts(self.level(k - 1)[0][g["lower"][at]], index, n)

    def _level(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
        if k == 1:
            return self.word_count, self.known.unigram(self.word_count), None
        asked, g, d = self.layout(k), self.chunk.grams(k), self.known.discount(k)
        r, number = np.zeros(g["n"], dtype=np.int64), np.zeros(g["n"] if k < self.known.order else 0, dtype=np.uint64)
        alone = np.zeros(g["n"], dtype=bool)
        # of each history: followers seen 1..K times, and what P' gives to followers
        low, lower = np.zeros((len(asked.history), K), dtype=np.int64), np.zeros((len(asked.history), K + 1), dtype=np.int64)
        if asked.local.any():
            r[asked.local] = g["count"][asked.local]
            low, lower = self.local_sums(k)
            low[asked.shared], lower[asked.shared] = 0, 0  # their bucket has added them
        any_low = low.any(axis=1)
        for part in asked.parts:
            answer = self.answers[k, part.bucket]
            r[part.grams] = unpack(answer["count"])
            if len(number):
                number[part.grams] = unpack_sorted(answer["number"]) * np.uint64(self.known.buckets) + np.uint64(part.bucket)
            if answer["alone"] is not None:
                alone[part.grams] = np.unpackbits(unpack(answer["alone"]), count=len(part.grams)).astype(bool)
            flags = unpack(answer["flags"])
            any_low[part.entries] |= (flags & 1).astype(bool)
            told = part.entries[(flags & 2).astype(bool)]
            low[told] += unpack(answer["low"]).reshape(-1, K).astype(np.int64)
            lower[told] += unpack(answer["lower"]).reshape(-1, K + 1).astype(np.int64)
        count = self.history_count(k)[asked.history]
        total = np.maximum(count + ~any_low, 1).astype(float)
        left = np.where(any_low, low @ ((1 - d) * np.arange(1, K + 1)), 1.0)
        _, below, below_total = self.level(k - 1)
        if k == 2:
            covered = covered_by(lower, self.known.unigram_total(), self.known.discount(1))
        else:  # the n-grams of a history share the history below
            first = np.searchsorted(asked.index, np.arange(len(asked.history)))
            covered = covered_by(lower, below_total[g["lower"][first]], self.known.discount(k - 1))
        weight = np.where(count > 0, left / total / np.maximum(1 - covered, 1e-300), 1.0)
        if k < self.known.order:
            self.chunk.name(k, number, alone)
        return r, np.where(r > 0, seen_share(r, total[asked.index], d), weight[asked.index] * below[g["lower"]]), total[asked.index]

    def scores(self, order: int) -> dict[str, np.ndarray]:
        c, known = self.chunk, self.known
        log = np.zeros(len(c.tokens))
        for k in range(1, order + 1):
            g = c.grams(k)
            log[g["at"]] = np.log10(self.level(k)[1])[g["id"]]
        base = np.log10((self.word_count + 0.5) / (known.tokens + 0.5 * (known.types + 1)))
        return {
            "held_out": c.held, "n_tokens": c.lengths, "n_known": np.add.reduceat((self.word_count > 0)[c.tokens].astype(np.int64), c.begin),
            "base_score": np.add.reduceat(base[c.tokens], c.begin), "score": np.add.reduceat(log, c.begin),
        }

    def requests(self, k: int) -> Iterator[dict]:
        asked, g = self.layout(k), self.chunk.grams(k)
        low_count, told, kept = self.level(k - 1)[0], asked.spread > 1, {}
        if self.known.keeps_local(k):
            low, lower = self.local_sums(k)
            # sums are asked for where an n-gram that stays in the chunk is unseen
            told[asked.index[asked.local & (g["count"] == 0)]] = True
            kept = {"stats": counts_of_counts(g["count"][asked.local]).tolist()}
        for part in asked.parts:
            words, _, index = distinct(g["word"][part.grams])
            adds = lower[part.entries].any(axis=1) & part.home if kept else np.zeros(len(part.entries), dtype=bool)
            flags, own = told[part.entries].astype(np.uint8) | (adds.astype(np.uint8) << 1), part.entries[adds]
            yield {
                "bucket": part.bucket,
                "histories": pack_sorted(g["history_hash"][asked.history[part.entries]]),
                "followers": pack(small(part.followers)), "flags": pack(flags),
                "words": pack_sorted(self.chunk.words[words]), "word_index": pack(small(index)),
                "count": pack(small(g["count"][part.grams])),
                # P' of a word follows from its count; of longer n-grams from
                # theirs and their history's total, which those who ask know
                "word_count": pack(small(self.word_count[words])) if k == 2 else None,
                "low_count": None if k == 2 else pack(small(low_count[g["lower"][part.grams]])),
                "low": pack(small(low[own].reshape(-1))) if len(own) else None,
                "lower": pack(small(lower[own].reshape(-1))) if len(own) else None,
                "stats": kept.get("stats") if part is asked.parts[0] else None,
            }
        if kept and not asked.parts:
            yield {"bucket": 0, **kept}

    def local_grams(self, k: int) -> dict[str, np.ndarray]:
        """The seen n-grams that stay in the chunk."""
        asked, g = self.layout(k), self.chunk.grams(k)
        at = np.flatnonzero(asked.local & (g["count"] > 0))
        return {"history": g["history_hash"][g["history"][at]], "word": self.chunk.words[g["word"][at]], "count": g["count"][at].astype(np.int64)}


# ------------------------------------------------------------------ buckets


def counts_of_counts(total: np.ndarray) -> np.ndarray:
    """Tokens, types seen, n_1..n_{K+1}."""
    n = np.bincount(np.minimum(total, K + 2), minlength=K + 3)[1 : K + 2]
    return np.array([total.sum(), (total > 0).sum(), *n])


def add_up(rows: list[dict], known: Globals, k: int) -> tuple[list[dict], dict, np.ndarray]:
    """One bucket: (answers, model part, counts of counts)."""
    stats = sum(np.array(r["stats"], dtype=np.int64) for r in rows if r["stats"] is not None)
    rows = [r for r in rows if r["histories"] is not None]
    if not rows:
        return [], {}, stats
    history_lists = [unpack_sorted(r["histories"]) for r in rows]
    word_lists = [unpack_sorted(r["words"]) for r in rows]
    histories, h_index = np.unique(np.concatenate(history_lists), return_inverse=True)
    words, w_first, w_index = np.unique(np.concatenate(word_lists), return_index=True, return_inverse=True)
    followers = [unpack(r["followers"]).astype(np.int64) for r in rows]
    h_at = np.cumsum([0, *map(len, history_lists)])
    w_at = np.cumsum([0, *map(len, word_lists)])
    gram_h = np.concatenate([np.repeat(h_index[h_at[i] : h_at[i + 1]], f) for i, f in enumerate(followers)])
    gram_w = np.concatenate([w_index[w_at[i] : w_at[i + 1]][unpack(r["word_index"])] for i, r in enumerate(rows)])
    count = np.concatenate([unpack(r["count"]).astype(np.int64) for r in rows])
    key, first, gram = distinct(gram_h * len(words) + gram_w)
    del gram_h, gram_w
    total = np.bincount(gram, weights=count, minlength=len(key)).astype(np.int64)
    key_h, key_w = np.divmod(key, max(len(words), 1))
    if k == 2:
        below = np.concatenate([unpack(r["word_count"]) for r in rows]).astype(np.int64)[w_first][key_w]
    else:
        below = np.concatenate([unpack(r["low_count"]).astype(np.int64) for r in rows])[first]
    seen, named = total > 0, k < known.order
    low = seldom(total, key_h, len(histories))
    lower = lower_counts(below[seen], key_h[seen], len(histories))  # a seen n-gram's end has been seen
    flags = [unpack(r["flags"]) for r in rows]
    for i, r in enumerate(rows):
        if r["lower"] is not None:  # of n-grams that stay in the chunk
            own = h_index[h_at[i] : h_at[i + 1]][(flags[i] & 2).astype(bool)]
            low[own] += unpack(r["low"]).reshape(-1, K).astype(np.int64)
            lower[own] += unpack(r["lower"]).reshape(-1, K + 1).astype(np.int64)
    any_low = low.any(axis=1)
    alone = np.bincount(gram, minlength=len(key)) == 1 if known.keeps_local(k + 1) else None
    answers, at = [], 0
    for i, r in enumerate(rows):
        n = int(followers[i].sum())
        asked, own = gram[at : at + n], h_index[h_at[i] : h_at[i + 1]]
        mine = total[asked]
        at += n
        entry = np.repeat(np.arange(len(own)), followers[i])
        # sums are told where some follower is unseen, and where asked for
        told = (np.bincount(entry[mine == 0], minlength=len(own)) > 0) | (flags[i] & 1).astype(bool)
        answers.append({
            "chunk": r["chunk"], "count": pack(small(mine)), "number": pack_sorted(asked) if named else None,
            "alone": None if alone is None else pack(np.packbits(alone[asked])),
            "flags": pack(any_low[own].astype(np.uint8) | (told.astype(np.uint8) << 1)),
            "low": pack(small(low[own[told]].reshape(-1))), "lower": pack(small(lower[own[told]].reshape(-1))),
        })
    kept_h, kept_followers = np.unique(key_h[seen], return_counts=True)
    kept_w, kept_index = np.unique(key_w[seen], return_inverse=True)
    model = {
        "histories": pack_sorted(histories[kept_h]), "followers": pack(small(kept_followers)), "words": pack_sorted(words[kept_w]),
        "word_index": pack(small(kept_index)), "count": pack(small(total[seen])),
        "number": pack_sorted(np.flatnonzero(seen)) if named else None,
    }
    return answers, model, stats + counts_of_counts(total)


def add_up_words(rows: list[dict]) -> tuple[list[dict], dict, np.ndarray]:
    lists = [unpack_sorted(r["words"]) for r in rows]
    words, index = np.unique(np.concatenate(lists), return_inverse=True)
    total = np.bincount(index, weights=np.concatenate([unpack(r["count"]).astype(np.int64) for r in rows]), minlength=len(words)).astype(np.int64)
    at = np.cumsum([0, *map(len, lists)])
    answers = [
        {"chunk": r["chunk"], "count": pack(small(total[index[at[i] : at[i + 1]]])), "number": pack_sorted(index[at[i] : at[i + 1]])}
        for i, r in enumerate(rows)
    ]
    seen = total > 0
    model = {"words": pack_sorted(words[seen]), "count": pack(small(total[seen])), "number": pack_sorted(np.flatnonzero(seen))}
    return answers, model, counts_of_counts(total)


# --------------------------------------------------------------- Spark jobs

_BLOBS = ["histories", "followers", "flags", "words", "word_index", "count", "word_count", "low_count", "low", "lower"]
REQUEST = T.StructType(
    [T.StructField("bucket", T.IntegerType()), T.StructField("chunk", T.LongType())]
    + [T.StructField(b, T.BinaryType()) for b in _BLOBS]
    + [T.StructField("stats", T.ArrayType(T.LongType()))]
)
_STORED = ["histories", "followers", "words", "word_index", "count", "number", "alone", "flags", "low", "lower"]
REPLY = T.StructType(
    [T.StructField("kind", T.StringType()), T.StructField("bucket", T.IntegerType()), T.StructField("chunk", T.LongType())]
    + [T.StructField(b, T.BinaryType()) for b in _STORED]
    + [T.StructField("stats", T.ArrayType(T.LongType()))]
)


def _frame(rows: list[dict], schema: T.StructType) -> pd.DataFrame:
    return pd.DataFrame([[r.get(c) for c in schema.names] for r in rows], columns=schema.names, dtype=object)


def _settle(spark: SparkSession) -> None:
    """Shuffle files of finished steps go once the driver's JVM has collected
    the plans they belong to; without this they pile up over the steps."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def held_out(id_col: str):
    """crc32 of the id as text, modulo 5, is 1; a null id is not held out."""
    return F.coalesce(F.pmod(F.crc32(col(id_col).cast("string").cast("binary")), F.lit(5)) == 1, F.lit(False))


def write_chunks(df: DataFrame, path: str, *, id_col: str, text_col: str, chunk_tokens: int) -> None:
    schema = T.StructType([
        T.StructField("chunk", T.LongType()), T.StructField("ids", T.ArrayType(df.schema[id_col].dataType)),
        *[T.StructField(b, T.BinaryType()) for b in ("words", "count", "places", "tokens", "lengths", "held")],
    ])

    def build(number: int, ids: list, held: list[bool], docs: list[list[int]], index: dict[bytes, int]) -> pd.DataFrame:
        words = np.fromiter((xxhash.xxh64_intdigest(w) for w in index), dtype=np.uint64, count=len(index))
        tokens = np.concatenate([np.array(d, dtype=np.int64) for d in docs])
        # most frequent first: small numbers, which pack well; words as frequent
        # by hash, so that their places among the hashes have short differences
        hashed = np.argsort(words)
        place = np.empty(len(words), dtype=np.int64)
        place[hashed] = np.arange(len(words))
        order = np.lexsort((place, -np.bincount(tokens, minlength=len(words))))
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        words, places, tokens = words[hashed], place[order], rank[tokens]
        lengths = np.array([len(d) for d in docs])
        train = np.repeat(~np.array(held), lengths)
        row = {
            "chunk": (TaskContext.get().partitionId() << 32) + number, "ids": ids, "words": pack_sorted(words),
            "count": pack(small(np.bincount(places[tokens[train]], minlength=len(words)))),
            "places": pack_sorted(places), "tokens": pack(small(tokens)),
            "lengths": pack(small(lengths)), "held": pack(np.array(held).view(np.uint8)),
        }
        return _frame([row], schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, size, ids, held, docs, index = 0, 0, [], [], [], {}
        for batch in batches:
            own_ids, own_held = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, h, text in zip(own_ids, own_held, texts_of(batch.column(2))):
                words = text.lower().split()
                words.append(b"")  # the end
                docs.append([index.setdefault(w, len(index)) for w in words])
                ids.append(i)
                held.append(h)
                size += len(words)
                if size >= chunk_tokens:
                    yield pa.RecordBatch.from_pandas(build(number, ids, held, docs, index), arrow, preserve_index=False)
                    number, size, ids, held, docs, index = number + 1, 0, [], [], [], {}
        if docs:
            yield pa.RecordBatch.from_pandas(build(number, ids, held, docs, index), arrow, preserve_index=False)

    from pyspark.sql.pandas.types import to_arrow_schema

    prepare(df.sparkSession)
    arrow = to_arrow_schema(schema)
    rows = df.select(col(id_col).alias("id"), held_out(id_col).alias("held"), col(text_col).alias("text"))
    rows.mapInArrow(read, schema).write.option("compression", "none").parquet(path)


def _scorer(chunk: dict, replies: pd.DataFrame, known: Globals) -> Scorer:
    answers = {(int(r["level"]), int(r["bucket"])): r for r in replies.to_dict("records")}
    return Scorer(Chunk(chunk["places"], chunk["tokens"], chunk["lengths"], chunk["held"]), known, answers)


def _reduce_and_store(requests: DataFrame, path: str, known: Globals, k: int) -> list[int]:
    """Adds up the buckets, stores answers and model, returns the sums of the
    statistics: tokens, types, n_1..n_{K+1}."""
    spark = requests.sparkSession

    def bucket(frame: pd.DataFrame) -> pd.DataFrame:
        rows = frame.sort_values("chunk").to_dict("records")
        answers, model, stats = add_up_words(rows) if k == 1 else add_up(rows, known, k)
        b = rows[0]["bucket"]
        out = [{"kind": "answer", "bucket": b, **a} for a in answers]
        out.append({"kind": "model", "bucket": b, **model, "stats": stats.tolist()})
        return _frame(out, REPLY)

    requests.groupBy("bucket").applyInPandas(bucket, REPLY).write.partitionBy("kind").option("compression", "none").parquet(path)
    sums = _read(spark, path, "model").select(F.posexplode("stats")).groupBy("pos").agg(F.sum("col").alias("n"))
    stats = {r["pos"]: r["n"] for r in sums.collect()}
    return [int(stats.get(i, 0)) for i in range(K + 3)]


def _read(spark: SparkSession, path: str, kind: str) -> DataFrame:
    return spark.read.schema(REPLY).parquet(path).filter(F.col("kind") == kind)


def _answers(spark: SparkSession, paths: dict[int, str]) -> DataFrame:
    out = None
    for k, path in paths.items():
        one = _read(spark, path, "answer").select("chunk", "bucket", "count", "number", "alone", "flags", "low", "lower", F.lit(k).alias("level"))
        out = one if out is None else out.union(one)
    return out


def _chunks(spark: SparkSession, path: str) -> DataFrame:
    """Stored chunks without their words' hashes, which only the first requests need."""
    return spark.read.parquet(path).drop("words", "count")


@dataclass
class Model:
    """The stored model: a table per order, partitioned into answers and model
    parts by bucket, and the driver's sums."""

    chunks: str
    paths: dict[int, str]
    known: Globals


def fit(
    df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER, chunk_tokens: int = CHUNK_TOKENS,
) -> Model:
    """Counts the training rows of ``df`` and stores the model."""
    spark = df.sparkSession
    base = shared_scratch(spark, "katz", unique=True)
    chunks = f"{base}/chunks"
    write_chunks(df, chunks, id_col=id_col, text_col=text_col, chunk_tokens=chunk_tokens)
    table = spark.read.parquet(chunks)
    known = Globals(buckets=max(MIN_BUCKETS, table.count() // CHUNKS_PER_BUCKET), order=order)

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([int((unpack(h) == 0).sum()) for h in batch.column(0).to_pylist()], pa.int64())], names=["n"])

    known.texts = table.select("held").mapInArrow(texts, "n long").agg(F.sum("n")).first()[0] or 0
    buckets = known.buckets

    def ask_words(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for r in frame.to_dict("records"):
                words, count = unpack_sorted(r["words"]), unpack(r["count"])
                yield _frame([
                    {"bucket": b, "chunk": r["chunk"], "words": pack_sorted(words[at]), "count": pack(small(count[at]))}
                    for b, at in by_bucket(words, buckets)
                ], REQUEST)

    paths = {1: f"{base}/order=1"}
    stats = _reduce_and_store(table.select("chunk", "words", "count").mapInPandas(ask_words, REQUEST), paths[1], known, 1)
    known.tokens, known.types, known.n[1] = stats[0], stats[1], stats[2:]
    for k in range(2, order + 1):
        _settle(spark)
        paths[k] = f"{base}/order={k}"
        known.n[k] = _count_order(_chunks(spark, chunks), _answers(spark, {i: paths[i] for i in range(1, k)}), paths[k], known, k)
    _settle(spark)
    return Model(chunks, paths, known)


def _count_order(table: DataFrame, answers: DataFrame, path: str, known: Globals, k: int) -> list[int]:
    def ask(chunk: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        row = chunk.iloc[0].to_dict()
        return _frame([{"chunk": row["chunk"], **r} for r in _scorer(row, replies, known).requests(k)], REQUEST)

    asked = table.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(ask, REQUEST)
    return _reduce_and_store(asked, path, known, k)[2:]


def score(model: Model, spark: SparkSession, *, id_name: str = "doc_id") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of
    every row the model was fitted on, training or held out."""
    table, known, order = _chunks(spark, model.chunks), model.known, max(model.paths)
    ident = table.schema["ids"].dataType.elementType
    schema = T.StructType([
        T.StructField(id_name, ident), T.StructField("held_out", T.BooleanType()), T.StructField("n_tokens", T.LongType()),
        T.StructField("n_known", T.LongType()), T.StructField("train_tokens", T.LongType()),
        T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType()),
    ])

    def evaluate(chunk: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        row = chunk.iloc[0].to_dict()
        made = _scorer(row, replies, known).scores(order)
        ids = pd.Series(list(row["ids"]), dtype=object)
        return pd.DataFrame({id_name: ids, **made, "train_tokens": known.tokens})[schema.names]

    return table.groupBy("chunk").cogroup(_answers(spark, model.paths).groupBy("chunk")).applyInPandas(evaluate, schema)


def vocabulary(model: Model, spark: SparkSession) -> DataFrame:
    """The words seen in training: (number, hash, count, prob)."""
    known = model.known

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                number = unpack_sorted(r["number"]) * np.uint64(known.buckets) + np.uint64(r["bucket"])
                count = unpack(r["count"]).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(number.view(np.int64)), pa.array(unpack_sorted(r["words"]).view(np.int64)), pa.array(count), pa.array(known.unigram(count))],
                    names=["number", "hash", "count", "prob"],
                )

    stored = _read(spark, model.paths[1], "model").select("bucket", "words", "count", "number")
    return stored.mapInArrow(rows, "number long, hash long, count long, prob double")


def _counted(model: Model, spark: SparkSession, order: int) -> DataFrame:
    """The seen n-grams of an order from 2 on: (history, word, count, number),
    from the buckets' parts and, for those that stay there, from the chunks."""
    known, schema = model.known, "history long, word long, count long, number long"

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                if r["histories"] is None:
                    continue
                h = np.repeat(unpack_sorted(r["histories"]), unpack(r["followers"]))
                w = unpack_sorted(r["words"])[unpack(r["word_index"])]
                count = unpack(r["count"]).astype(np.int64)
                number = pa.nulls(len(count), pa.int64())
                if r["number"] is not None:
                    number = pa.array((unpack_sorted(r["number"]) * np.uint64(known.buckets) + np.uint64(r["bucket"])).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), pa.array(w.view(np.int64)), pa.array(count), number],
                    names=["history", "word", "count", "number"],
                )

    def local(chunk: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        made = _scorer(chunk.iloc[0].to_dict(), replies, known).local_grams(order)
        return pd.DataFrame({k: v.view(np.int64) for k, v in made.items()})

    stored = _read(spark, model.paths[order], "model").select("bucket", "histories", "followers", "words", "word_index", "count", "number")
    out = stored.mapInArrow(parts, schema)
    if not known.keeps_local(order):
        return out
    lower = _answers(spark, {k: p for k, p in model.paths.items() if k < order})
    kept = _chunks(spark, model.chunks).groupBy("chunk").cogroup(lower.groupBy("chunk"))
    kept = kept.applyInPandas(local, "history long, word long, count long")
    return out.unionByName(kept.withColumn("number", F.lit(None).cast("long")))


def _probabilities(model: Model, spark: SparkSession, order: int) -> DataFrame:
    """The seen n-grams of an order with ``prob``, their history's ``total`` and
    what its discounts leave (``left``), the number ``lower`` of the n-gram of one
    order less (of order 2: of the word) and its probability ``below``."""
    d, c = model.known.discount(order), F.col("count")
    table = F.array(*[F.lit(float(x)) for x in (0.0, *d, 1.0)])
    kept = F.element_at(table, F.least(c, F.lit(K + 1)).cast("int") + 1) * c
    rows = _counted(model, spark, order)
    sums = rows.groupBy("history").agg(F.sum("count").alias("seen"), F.sum(F.when(c <= K, c - kept)).alias("low"))
    rest = F.col("low").isNull()
    sums = sums.select("history", (F.col("seen") + rest.cast("long")).alias("total"), F.coalesce("low", F.lit(1.0)).alias("left"))
    rows = rows.join(sums, "history").withColumn("prob", kept / F.col("total"))
    if order == 2:
        one = vocabulary(model, spark).select(F.col("number").alias("word"), F.col("number").alias("lower"), F.col("prob").alias("below"))
        return rows.join(one, "word")
    under = _probabilities(model, spark, order - 1)
    ends = under.select(F.col("number").alias("history"), F.col("lower").alias("shorter"))
    seen = under.select(F.col("history").alias("shorter"), "word", F.col("number").alias("lower"), F.col("prob").alias("below"))
    return rows.join(ends, "history").join(seen, ["shorter", "word"])


def tables(model: Model, spark: SparkSession, order: int) -> tuple[DataFrame, DataFrame]:
    """A stored order from 2 on as plain rows: n-grams (history, word, count,
    prob, number) and backoff (history, total, weight); words and histories by
    number, of words (order 2) or of the n-grams of one order less. The last
    order's n-grams have no number."""
    rows = _probabilities(model, spark, order)
    sums = rows.groupBy("history").agg(F.first("total").alias("total"), F.first("left").alias("left"), F.sum("below").alias("covered"))
    backoff = sums.select("history", "total", (F.col("left") / F.col("total") / (1 - F.col("covered"))).alias("weight"))
    return rows.select("history", "word", "count", "prob", "number"), backoff


__all__ = ["Chunk", "Globals", "Model", "Scorer", "discounts", "fit", "layout", "score", "tables", "vocabulary"]
