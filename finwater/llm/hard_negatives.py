"""Hard negatives by rotated one-bit codes and exact integer scores.

Every component x of a vector becomes floor(256 x); a row's score with an
anchor is the integer inner product. An anchor's positives are its best rows of
the same label, and for each positive the negatives are the best rows of other
labels whose score lies between ``low`` / ``high`` of the positive's and the
positive's own.

Filter: vectors are rotated by a fixed random rotation. A row keeps its norm,
the signs of its rotated unit vector y as one bit a dimension (the code, read
as the unit vector b with entries +-1/sqrt(d)) and its alignment a = <b, y>.
An anchor's rotated unit vector z is rounded to ``LEVELS`` levels a dimension,
so <b, z> comes from products of whole numbers, levels and signs of the code,
of many anchors and rows at once. As y = a b + r
with r at right angles to b and |r| = sqrt(1 - a^2), Cauchy-Schwarz gives

    | <y, z> - a <b, z> |  <=  sqrt(1 - a^2) sqrt(1 - <b, z>^2)

plus the rounding of z, whose length is stored with the anchor. The interval
is certain, not probable: a row is dropped only if its interval cannot reach
the best rows found so far or the wanted window. What survives is scored with
whole numbers, so results are exact and do not depend on rotation or levels.

On Spark: rows are packed into blocks of ``BLOCK`` rows (codes, alignments,
integers) that are stored once. The anchors, a stated set of queries, are
packed likewise and meet every block: block and anchors join on the block's
number, one task step a pair of packs, so neither side is broadcast and no pair
of rows is ever emitted. A step gives at most ``k`` rows per anchor (then per
anchor and positive); a row-number window, which limits map-side, takes the
best over all blocks. Memory: one pack of each kind and a tile of scores.

Cases: rows with a null id, label or vector, or a null or non-finite
component, take no part. Rows are rows: equal rows count one by one and an
anchor's copies are other rows; ties go to the smaller id. Vectors are compared
only if they are equally long; zero and empty vectors score 0. Labels are whole
numbers. Components so large that scores might leave 64 bits raise an error. An empty table, no anchors or a single label give no rows.
Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finwater.session import shared_scratch

from .base import col, prepare

#: Rows of a block, anchors of a pack, rows of a tile of scores.
BLOCK, PACK, TILE = 8192, 512, 2048
#: Rounding levels of an anchor's rotated components.
LEVELS, SEED, SCALE = 63, 23, 256
#: Squared length up to which the window's arithmetic fits 64 bits.
TOP = float(1 << 55)
#: Room for rounding in the double-precision bounds, relative to the norms.
SLACK = 1e-9

_PACK = (
    "block long, dim int, n int, keys binary, ids binary, labels binary, ints binary, words binary, norms binary, aligns binary"
)
_ANCHOR = "part long, dim int, n int, keys binary, labels binary, ints binary, wanted binary"
_BEST = "key long, slot int, id long, other long, score long"


@lru_cache(maxsize=8)
def rotation(dim: int, seed: int = SEED) -> np.ndarray:
    """A fixed random rotation (orthogonal matrix) of ``dim`` dimensions."""
    q, r = np.linalg.qr(np.random.default_rng([seed, dim]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def integers(rows: list[list[float]]) -> np.ndarray:
    """floor(256 x) of rows of equal length."""
    x = np.floor(SCALE * np.array(rows, dtype=np.float64).reshape(len(rows), -1))
    if x.size and np.abs(x).max() ** 2 * x.shape[1] > TOP:
        raise ValueError("components too large for integer scores of 64 bits")
    return x.astype(np.int64)


def _units(x: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Norms and rotated unit vectors (a zero vector stays zero)."""
    norm = np.sqrt((x * x).sum(axis=1, dtype=np.float64))
    return norm, (x / np.where(norm > 0, norm, 1)[:, None]) @ turn


def _words(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as 64-bit words."""
    packed = np.packbits(bits, axis=1)
    room = np.zeros((len(bits), -(-packed.shape[1] // 8) * 8), dtype=np.uint8)
    room[:, : packed.shape[1]] = packed
    return room.view(np.uint64)


class Codes:
    """One-bit codes of rows of ``dim`` dimensions, with norms and alignments."""

    def __init__(self, dim: int, words: np.ndarray, norm: np.ndarray, align: np.ndarray):
        self.dim, self.words, self.norm, self.align = dim, words, norm, align
        self.ones = np.bitwise_count(words).sum(axis=1, dtype=np.int64)
        self.rest = np.sqrt(np.clip(1 - align**2, 0, None)) + SLACK

    @classmethod
    def of(cls, x: np.ndarray) -> Codes:
        norm, y = _units(x, rotation(x.shape[1]))
        # <b, y> with b = +-1/sqrt(d): the sum of the sizes over sqrt(d)
        return cls(x.shape[1], _words(y > 0), norm, np.abs(y).sum(axis=1) / np.sqrt(max(x.shape[1], 1)))

    def part(self, at: slice) -> Codes:
        return Codes(self.dim, self.words[at], self.norm[at], self.align[at])

    def signs(self) -> np.ndarray:
        """The code's bits as +1 and -1."""
        bits = np.unpackbits(np.ascontiguousarray(self.words).view(np.uint8), axis=1, count=self.dim)
        return 2.0 * bits - 1.0


class Queries:
    """Rotated anchors, rounded to levels."""

    def __init__(self, x: np.ndarray):
        self.norm, z = _units(x, rotation(x.shape[1]))
        low, high = (f(z, axis=1, initial=0.0) for f in (np.min, np.max))
        self.low, self.step = low, np.where(high > low, (high - low) / LEVELS, 1.0)
        level = np.rint((z - low[:, None]) / self.step[:, None]).astype(np.int64)
        self.levels = level.astype(np.float64)
        rounded = low[:, None] + self.step[:, None] * level
        self.off = np.sqrt(((z - rounded) ** 2).sum(axis=1)) + SLACK

    def bounds(self, codes: Codes) -> tuple[np.ndarray, np.ndarray]:
        """Certain lower and upper ends of all scores (anchors x rows)."""
        # <b, levels>: +1 where the code's bit is one, -1 elsewhere; whole
        # numbers, so the product is exact
        root = np.sqrt(max(codes.dim, 1))
        dot = self.levels @ codes.signs().T
        dot *= (self.step / root)[:, None]
        dot += (self.low / root)[:, None] * (2 * codes.ones - codes.dim)[None, :]
        off = self.off[:, None]
        # the least |<b, z>| that the rounding leaves possible
        across = np.abs(dot)
        across -= off
        np.maximum(across, 0, out=across)
        np.multiply(across, across, out=across)
        np.subtract(1, across, out=across)
        np.maximum(across, 0, out=across)
        np.sqrt(across, out=across)
        scale = self.norm[:, None] * codes.norm[None, :]
        wide = across
        wide *= codes.rest[None, :]
        wide += codes.align[None, :] * off + SLACK
        wide *= scale
        wide += SLACK
        dot *= codes.align[None, :]
        dot *= scale
        return dot - wide, dot + wide


def _raised(floor: np.ndarray, anchors: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """``floor`` (per anchor), raised to the k-th greatest of the scores found
    for an anchor in a tile, if there are as many."""
    order = np.lexsort((-scores, anchors))
    number = np.bincount(anchors, minlength=len(floor))
    enough = number >= k
    place = (np.cumsum(number) - number + k - 1)[enough]
    floor = floor.copy()
    floor[enough] = np.maximum(floor[enough], scores[order][place])
    return floor


class _Step:
    """One pack of anchors against one block of rows."""

    def __init__(self, block: dict, pack: dict):
        dim = block["dim"]
        read = lambda row, name: np.frombuffer(row[name], dtype="<i8")
        self.keys, self.ids, self.labels = (read(block, n) for n in ("keys", "ids", "labels"))
        self.x = np.frombuffer(block["ints"], dtype="<i4").reshape(block["n"], dim).astype(np.int64)
        self.a_keys, self.a_labels = (read(pack, n) for n in ("keys", "labels"))
        self.a = np.frombuffer(pack["ints"], dtype="<i4").reshape(pack["n"], dim).astype(np.int64)
        self.wanted = read(pack, "wanted").reshape(pack["n"], -1)
        most = [int(np.abs(v).max(initial=0)) for v in (self.a, self.x)]
        self.exact, self.a_float = most[0] * most[1] * dim < 1 << 53, self.a.astype(np.float64)
        words = np.frombuffer(block["words"], dtype="<u8").reshape(block["n"], -1)
        codes = Codes(dim, words, *(np.frombuffer(block[n], dtype="<f8") for n in ("norms", "aligns")))
        self.codes = [codes.part(slice(i, i + TILE)) for i in range(0, len(self.x), TILE)]
        self.queries = Queries(self.a)

    def tiles(self):
        """(first row, lower ends, upper ends) of the block's tiles."""
        for i, codes in enumerate(self.codes):
            yield (i * TILE, *self.queries.bounds(codes))

    def scores(self, live: np.ndarray, here: slice) -> np.ndarray:
        """Integer inner products of the anchors with a tile's rows, where
        ``live``: pair by pair if these are few, else as one product, whose
        sums of whole numbers below 2^53 are exact."""
        if self.exact and np.count_nonzero(live) * 16 > live.size:
            return self.a_float @ self.x[here].astype(np.float64).T
        out = np.zeros(live.shape, dtype=np.int64)
        anchors, rows = np.nonzero(live)
        for i in range(0, len(anchors), TILE * 16):
            a, r = anchors[i : i + TILE * 16], rows[i : i + TILE * 16]
            out[a, r] = np.einsum("ij,ij->i", self.a[a], self.x[here][r])
        return out

    def best(self, slot: np.ndarray, anchors: np.ndarray, rows: np.ndarray, scores: np.ndarray, k: int) -> pa.RecordBatch:
        """The first k rows of each (anchor, slot)."""
        order = np.lexsort((self.keys[rows], self.ids[rows], -scores, slot, anchors))
        slot, anchors, rows, scores = slot[order], anchors[order], rows[order], scores[order]
        new = np.ones(len(rows), dtype=bool)
        new[1:] = (anchors[1:] != anchors[:-1]) | (slot[1:] != slot[:-1])
        start = np.maximum.accumulate(np.where(new, np.arange(len(rows)), 0))
        keep = np.arange(len(rows)) - start < k
        rows = rows[keep]
        made = [self.a_keys[anchors[keep]], slot[keep].astype(np.int32), self.ids[rows], self.keys[rows], scores[keep]]
        return pa.RecordBatch.from_arrays([pa.array(v) for v in made], names=["key", "slot", "id", "other", "score"])


def positives_in(step: _Step, k: int) -> pa.RecordBatch:
    """The first k other rows of the anchors' labels in a block."""
    found, floor = [], np.full(len(step.a), -np.inf)
    for first, _, upper in step.tiles():
        here = slice(first, first + upper.shape[1])
        live = (step.labels[None, here] == step.a_labels[:, None]) & (step.keys[None, here] != step.a_keys[:, None])
        live &= upper >= floor[:, None]
        scores = step.scores(live, here)
        at = np.nonzero(live & (scores >= floor[:, None]))
        floor = _raised(floor, at[0], scores[at], k)
        found.append((at[0], at[1] + first, scores[at].astype(np.int64)))
    anchors, rows, scores = (np.concatenate([f[i] for f in found]) for i in range(3))
    return step.best(np.zeros(len(rows), dtype=np.int64), anchors, rows, scores, k)


def negatives_in(step: _Step, k: int, low: int, high: int) -> pa.RecordBatch:
    """For each anchor and wanted positive score p, the first k rows of other
    labels in a block whose score s has low p <= high s <= high p. Wanted
    scores stand in slots, then their number."""
    slots, number = step.wanted[:, :-1], step.wanted[:, -1]
    valid = np.arange(slots.shape[1])[None, :] < number[:, None]
    least = -((-low * slots) // high)  # the least whole s with low p <= high s
    margin = 1 + SLACK * np.abs(slots)  # for the ends' rounding: scores are whole
    found, floor = [], np.full(slots.shape, -np.inf)
    for first, lower, upper in step.tiles():
        here = slice(first, first + upper.shape[1])
        other = step.labels[None, here] != step.a_labels[:, None]
        # a slot's rows: their interval meets the window and the best so far
        live = []
        for j in range(slots.shape[1]):
            reach = np.where(valid[:, j], np.maximum(least[:, j] - margin[:, j], floor[:, j]), np.inf)
            live.append(other & (upper >= reach[:, None]) & (lower <= (slots[:, j] + margin[:, j])[:, None]))
        scores = step.scores(np.logical_or.reduce(live, axis=0) if live else other & False, here)
        for j, mine in enumerate(live):
            mine &= scores >= floor[:, j, None]
            mine &= scores >= least[:, j, None].astype(scores.dtype)
            mine &= scores <= slots[:, j, None].astype(scores.dtype)
            at = np.nonzero(mine)
            floor[:, j] = _raised(floor[:, j], at[0], scores[at], k)
            found.append((np.full(len(at[0]), j), at[0], at[1] + first, scores[at].astype(np.int64)))
    slot, anchors, rows, scores = (np.concatenate([f[i] for f in found]) for i in range(4))
    return step.best(slot, anchors, rows, scores, k)


def _usable(vec: str) -> Column:
    v = F.col(vec)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.isNotNull() & ~F.coalesce(bad, F.lit(True))


def _blocks(rows: DataFrame, size: int) -> DataFrame:
    """Packs of rows (id, label, vec) of equal length; a row's key is its
    block's number times ``size`` plus its place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        held: dict[int, list[tuple]] = {}

        def made(dim: int) -> pa.RecordBatch:
            nonlocal number
            part = held.pop(dim)
            ids, labels = (np.array([r[i] for r in part], dtype="<i8") for i in range(2))
            keys = number * size + np.arange(len(part), dtype="<i8")
            x = integers([r[2] for r in part])
            codes = Codes.of(x)
            arrays = (keys, ids, labels, x.astype("<i4"), codes.words.astype("<u8"), codes.norm.astype("<f8"), codes.align.astype("<f8"))
            values = [number, dim, len(part), *(v.tobytes() for v in arrays)]
            number += 1
            return _record(_PACK, values)

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                part = held.setdefault(len(row[2]), [])
                part.append(row)
                if len(part) == size:
                    yield made(len(row[2]))
        for dim in sorted(held):
            yield made(dim)

    return rows.select("id", "label", "vec").mapInArrow(run, _PACK)


_ARROW = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}


def _record(ddl: str, values: list) -> pa.RecordBatch:
    names, kinds = zip(*(f.split() for f in ddl.split(", ")))
    return pa.RecordBatch.from_arrays([pa.array([v], _ARROW[k]) for v, k in zip(values, kinds)], names=list(names))


def _anchors(blocks: DataFrame, modulus: int) -> DataFrame:
    """(key, id, dim, label, ints): the rows whose id ``modulus`` divides."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, n, keys, ids, labels, ints in zip(*(c.to_pylist() for c in batch.columns)):
                keys, ids, labels = (np.frombuffer(x, dtype="<i8") for x in (keys, ids, labels))
                at = np.flatnonzero(ids % modulus == 0)
                x = np.frombuffer(ints, dtype="<i4").reshape(n, dim)[at]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[at]), pa.array(ids[at]), pa.array(np.full(len(at), dim, dtype=np.int32)), pa.array(labels[at]),
                     pa.array([r.tobytes() for r in x], pa.binary())],
                    names=["key", "id", "dim", "label", "ints"],
                )

    read = blocks.select("dim", "n", "keys", "ids", "labels", "ints")
    return read.mapInArrow(run, "key long, id long, dim int, label long, ints binary")


def _packed(anchors: DataFrame, size: int, n: int) -> DataFrame:
    """Packs of about ``size`` of the ``n`` anchors (key, dim, label, ints, wanted)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = TaskContext.get().partitionId() << 24, {}

        def made(part: tuple[int, int]) -> pa.RecordBatch:
            nonlocal number
            rows = held.pop(part)
            number += 1
            keys, labels = (np.array([r[i] for r in rows], dtype="<i8").tobytes() for i in (0, 2))
            return _record(_ANCHOR, [number, part[0], len(rows), keys, labels, b"".join(r[3] for r in rows), b"".join(r[4] for r in rows)])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                part = (row[1], len(row[4]))
                held.setdefault(part, []).append(row)
                if len(held[part]) == size:
                    yield made(part)
        for part in sorted(held):
            yield made(part)

    dealt = anchors.select("key", "dim", "label", "ints", "wanted").repartition(max(1, math.ceil(n / size)))
    return dealt.mapInArrow(run, _ANCHOR)


def _against_all(blocks: DataFrame, packs: DataFrame, work) -> DataFrame:
    """``work(step)`` for every pack of anchors and every block of its length.
    Blocks are dealt to as many groups as there are blocks; every pack goes to
    every group."""
    n = max(1, blocks.count())
    dealt = blocks.withColumn("part", F.pmod(F.xxhash64("block"), F.lit(n)))
    sent = packs.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))))
    names = [f.split()[0] for f in _ANCHOR.split(", ") if not f.startswith(("part", "dim"))]
    pairs = dealt.join(sent.select("part", "dim", *[F.col(n).alias(f"a_{n}") for n in names]), ["part", "dim"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i].as_py() for n in batch.schema.names}
                pack = {n: row["a_" + n] for n in names}
                yield work(_Step(row, pack))

    return pairs.mapInArrow(run, _BEST)


def _first(found: DataFrame, k: int) -> DataFrame:
    """The first ``k`` of each (key, slot) with their ``rank``."""
    order = Window.partitionBy("key", "slot").orderBy(F.desc("score"), "id", "other")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(
    df: DataFrame, *, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", anchor_modulus: int = 100,
    n_positives: int = 5, n_negatives: int = 5, low: int = 80, high: int = 100, block: int = BLOCK, pack: int = PACK,
) -> DataFrame:
    """(``anchor_id``, ``positive_id``, ``rank``, ``negative_id``,
    ``positive_score``, ``negative_score``) for the anchors, the rows whose id
    ``anchor_modulus`` divides."""
    spark = df.sparkSession
    prepare(spark)
    rows = df.select(
        col(id_col).cast("long").alias("id"), col(label_col).cast("long").alias("label"), col(vec_col).cast("array<double>").alias("vec")
    )
    rows = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & _usable("vec"))
    path = shared_scratch(spark, "code_blocks", unique=True)
    _blocks(rows, block).write.parquet(path)
    blocks = spark.read.schema(_PACK).parquet(path)
    anchors = _anchors(blocks, anchor_modulus)
    n = anchors.count()
    packs = _packed(anchors.withColumn("wanted", F.lit(b"")), pack, n)
    positives = _first(_against_all(blocks, packs, lambda s: positives_in(s, n_positives)), n_positives)
    found = shared_scratch(spark, "positives", unique=True)
    positives.select("key", "id", "score", "rank").write.parquet(found)
    positives = spark.read.schema("key long, id long, score long, rank int").parquet(found)

    # an anchor's positive scores by rank (bounded by ``n_positives``), then their number, as little-endian longs
    scores = F.transform(F.array_sort(F.collect_list(F.struct("rank", "score"))), lambda s: s["score"])
    lists = positives.groupBy("key").agg(scores.alias("scores"))
    room = F.slice(F.concat("scores", F.array_repeat(F.lit(0).cast("long"), n_positives)), 1, n_positives)
    wanted = F.concat(room, F.array(F.size("scores").cast("long")))
    hexed = F.array_join(F.transform(wanted, lambda x: F.lpad(F.hex(x), 16, "0")), "")
    listed = anchors.join(lists.select("key", F.unhex(hexed).alias("wanted")), "key")
    packs = _packed(listed, pack, n)

    def negatives(step: _Step) -> pa.RecordBatch:
        step.wanted = step.wanted.byteswap()  # written by hex, most significant byte first
        return negatives_in(step, n_negatives, low, high)

    best = _first(_against_all(blocks, packs, negatives), n_negatives)
    named = positives.join(anchors.select("key", F.col("id").alias("anchor_id")), "key")
    named = named.select("key", "anchor_id", (F.col("rank") - 1).alias("slot"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return best.join(named, ["key", "slot"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


__all__ = ["Codes", "Queries", "integers", "mine", "negatives_in", "positives_in", "rotation"]
