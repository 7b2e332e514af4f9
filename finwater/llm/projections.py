"""Near-duplicate vectors by sorted projection passes.

Vectors are compared inside blocks of equal label (and length). Each pass has
its own random hyperplanes; a vector's signs on them, one after the other, are
its key, and the block is ordered by that key. Vectors at a small angle share
long prefixes, so they end up near each other in some pass; each vector is
compared with the next ``window`` ones by exact cosine, and pairs that reach
the threshold are united over all passes.

The order of a pass is a range partitioning with a sort inside partitions, so
one hot label is spread like any other; the first and last rows of a partition
go to a second step that compares across the border. Rows and links are stored
before they are read again.

Equal vectors of a label are one class: a class meets in a grouped minimum and
takes part once. Windows are bounded, so inside dense groups they cannot show
every pair; the exact way for the rest is a count inside each component found,
in squares of ``chunk`` by ``chunk`` vectors that emit counts, never pairs.

Cases: vectors that are null, empty, zero or hold null or non-finite parts,
and rows with a null label, link with nothing and name themselves. A null id
takes no part and has a null component and ``kept`` false. Repeated rows link
with each other, one link per other row. Vectors of different lengths are
never compared. An empty table gives an empty result. Other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finwater.session import ensure_checkpoint_dir, shared_scratch

from .base import col, prepare
from .components import components

#: Passes, bits of a pass's key, neighbours compared after each vector.
PASSES, BITS, WINDOW, SEED = 12, 64, 24, 11
#: Side of the squares in which a component's links are counted.
CHUNK = 256


def unit(rows: list[list[float]]) -> np.ndarray:
    """Rows of equal length as unit vectors in double precision."""
    x = np.array(rows, dtype=np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)  # no overflow in the norm
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def planes(dim: int, passes: int, bits: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim, passes * bits))


def _usable(vec: str, label: str, ident: str):
    v = F.col(vec)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (
        F.col(ident).isNotNull() & F.col(label).isNotNull() & v.isNotNull()
        & ~F.coalesce(bad, F.lit(True)) & F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False))
    )


def _keys(classes: DataFrame, passes: int, bits: int, seed: int) -> DataFrame:
    """(block, sig, cls, vec): a row per class and pass."""
    schema = "block string, sig long, cls string, vec array<double>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes_of: dict[int, np.ndarray] = {}
        weight = (np.uint64(1) << np.arange(bits - 1, -1, -1, dtype=np.uint64))
        for batch in batches:
            cls, labels, vecs = (batch.column(i).to_pylist() for i in range(3))
            by_dim: dict[int, list[int]] = {}
            for i, v in enumerate(vecs):
                by_dim.setdefault(len(v), []).append(i)
            for dim, rows in by_dim.items():
                if dim not in planes_of:
                    planes_of[dim] = planes(dim, passes, bits, seed)
                signs = (unit([vecs[i] for i in rows]) @ planes_of[dim] > 0).reshape(len(rows), passes, bits)
                sig = (signs * weight).sum(axis=2, dtype=np.uint64) ^ np.uint64(1 << 63)  # unsigned order
                sig = sig.view(np.int64)
                for p in range(passes):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([f"{p}:{dim}:{labels[i]}" for i in rows]), pa.array(sig[:, p].copy()),
                            pa.array([cls[i] for i in rows]), pa.array([vecs[i] for i in rows], pa.list_(pa.float64())),
                        ],
                        names=["block", "sig", "cls", "vec"],
                    )

    return classes.select("cls", F.col("label").cast("string"), "vec").mapInArrow(run, schema)


def _near(block: list[str], cls: list[str], vecs: list[list[float]], first: int, window: int, threshold: float):
    """Linked pairs (i, j), i < j <= i + window, j >= first, of rows sorted by
    block."""
    edges = [0, *(i for i in range(1, len(block)) if block[i] != block[i - 1]), len(block)]
    for a, b in zip(edges, edges[1:]):
        if b - a < 2 or b <= first:
            continue
        x = unit(vecs[a:b])
        for k in range(1, min(window, b - a - 1) + 1):
            hit = np.flatnonzero(np.einsum("ij,ij->i", x[:-k], x[k:]) >= threshold)
            for i in hit:
                if a + i + k >= first:
                    yield cls[a + i], cls[a + i + k]


OUT = T.StructType([
    T.StructField("kind", T.IntegerType()), T.StructField("a", T.StringType()), T.StructField("b", T.StringType()),
    T.StructField("border", T.IntegerType()), T.StructField("pos", T.IntegerType()), T.StructField("block", T.StringType()),
    T.StructField("vec", T.ArrayType(T.DoubleType())),
])
_LINK, _HEAD, _TAIL = 0, 1, 2


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.string(), pa.list_(pa.float64())]
    columns = list(zip(*rows)) or [[] for _ in kinds]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=OUT.names)


def _compare_sorted(keys: DataFrame, window: int, threshold: float) -> DataFrame:
    """Links inside sorted partitions, and each partition's border rows. Of the
    pairs found, a link is kept if it joins two sets not yet joined in its
    partition: what they connect stays the same, in at most a link a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        block, cls, vecs = [], [], []  # the last rows seen, a window of them
        seen, parent = 0, {}

        def root(k: str) -> str:
            while (up := parent.get(k, k)) != k:
                parent[k] = parent.get(up, up)
                k = up
            return k

        def joins(pair: tuple[str, str]) -> bool:
            a, b = map(root, pair)
            parent[max(a, b)] = min(a, b)
            return a != b

        for batch in batches:
            b, c, v = (batch.column(i).to_pylist() for i in range(3))
            out = [(_HEAD, k, None, part, seen + i, g, x) for i, (g, k, x) in enumerate(zip(b, c, v)) if seen + i < window]
            seen += len(b)
            held = len(block)
            block, cls, vecs = block + b, cls + c, vecs + v
            out += [(_LINK, *p, None, None, None, None) for p in _near(block, cls, vecs, held, window, threshold) if joins(p)]
            block, cls, vecs = block[-window:], cls[-window:], vecs[-window:]
            yield _rows(out)
        n = len(block)
        yield _rows([(_TAIL, k, None, part + 1, n - i, g, x) for i, (g, k, x) in enumerate(zip(block, cls, vecs))])

    ordered = keys.repartitionByRange("block", "sig", "cls").sortWithinPartitions("block", "sig", "cls")
    return ordered.select("block", "cls", "vec").mapInArrow(run, OUT)


def _across_borders(stored: DataFrame, window: int, threshold: float) -> DataFrame:
    """Links between one partition's last rows and the next one's first."""

    def compare(f):
        import pandas as pd

        tail, head = f[f["kind"] == _TAIL], f[f["kind"] == _HEAD]
        found = []
        for block in set(tail["block"]) & set(head["block"]):
            left, right = tail[tail["block"] == block], head[head["block"] == block]
            near = unit(left["vec"].tolist()) @ unit(right["vec"].tolist()).T >= threshold
            # steps from a tail row to a head row in the pass's order
            steps = left["pos"].to_numpy()[:, None] + right["pos"].to_numpy()[None, :]
            found += [(left["a"].iloc[i], right["a"].iloc[j]) for i, j in zip(*np.nonzero(near & (steps <= window)))]
        return pd.DataFrame([(min(p), max(p)) for p in found], columns=["a", "b"], dtype=object)

    borders = stored.filter(F.col("kind") != _LINK).select("kind", "a", "border", "pos", "block", "vec")
    return borders.groupBy("border").applyInPandas(compare, "a string, b string")


def _count_links(members: DataFrame, threshold: float, chunk: int) -> DataFrame:
    """(cls, links): for each class, the rows in other classes of its
    component that reach the threshold. ``members``: root, cls, dim, n, vec.
    A component is cut into squares of two chunks of about ``chunk`` classes."""
    sizes = members.groupBy("root").agg(F.count(F.lit(1)).alias("m"))
    cut = members.join(sizes, "root").withColumn("q", F.ceil(F.col("m") / chunk))
    cut = cut.withColumn("mine", F.pmod(F.xxhash64("cls"), F.col("q")))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("q") - 1)))
    squares = cut.select("root", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "cls", "n", "vec")
    dealt = squares.repartition("root", "i", "j").sortWithinPartitions("root", "i", "j", "mine", "cls")

    def count(key: tuple, rows: list[tuple]) -> tuple[list[str], list[int]]:
        _, i, j = key
        x, n = unit([r[2] for r in rows]), np.array([r[3] for r in rows], dtype=np.int64)
        side = np.array([r[0] for r in rows])
        left, right = np.flatnonzero(side == i), np.flatnonzero(side == j)
        near = x[left] @ x[right].T >= threshold
        if i == j:
            np.fill_diagonal(near, False)
            return [rows[k][1] for k in left], (near @ n[right]).tolist()
        return [rows[k][1] for k in (*left, *right)], [*(near @ n[right]).tolist(), *(near.T @ n[left]).tolist()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []
        for batch in batches:
            cls, links = [], []
            for r in zip(*(c.to_pylist() for c in batch.columns)):
                if r[:3] != key:
                    if rows:
                        made = count(key, rows)
                        cls += made[0]
                        links += made[1]
                    key, rows = r[:3], []
                rows.append(r[3:])
            yield pa.RecordBatch.from_arrays([pa.array(cls, pa.string()), pa.array(links, pa.int64())], names=["cls", "links"])
        if rows:
            cls, links = count(key, rows)
            yield pa.RecordBatch.from_arrays([pa.array(cls, pa.string()), pa.array(links, pa.int64())], names=["cls", "links"])

    made = dealt.select("root", "i", "j", "mine", "cls", "vec", "n").mapInArrow(run, "cls string, links long")
    return made.groupBy("cls").agg(F.sum("links").alias("links"))


def near_duplicates(
    df: DataFrame, *, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
    threshold: float = 0.98, passes: int = PASSES, bits: int = BITS, window: int = WINDOW, chunk: int = CHUNK, seed: int = SEED,
) -> DataFrame:
    """(id, ``n_links``, ``component_id``, ``kept``), one row per input row."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    prepare(spark)
    rows = df.select(col(id_col).alias("id"), col(label_col).alias("label"), col(vec_col).cast("array<double>").alias("vec"))
    rows = rows.withColumn("ok", _usable("vec", "label", "id"))
    text = F.concat_ws("|", F.col("label").cast("string"), F.concat_ws(",", F.col("vec").cast("array<string>")))
    rows = rows.select("id", "label", "vec", F.when(F.col("ok"), F.md5(text)).alias("cls"))
    classes = rows.filter(F.col("cls").isNotNull()).groupBy("cls").agg(
        F.min("id").alias("first"), F.count(F.lit(1)).alias("n"), F.first("label").alias("label"), F.first("vec").alias("vec")
    ).checkpoint()
    path = shared_scratch(spark, "projection_links", unique=True)
    _compare_sorted(_keys(classes, passes, bits, seed), window, threshold).write.parquet(path)
    stored = spark.read.schema(OUT).parquet(path)
    links = stored.filter(F.col("kind") == _LINK).select("a", "b").union(_across_borders(stored, window, threshold)).distinct()
    roots = components(links).withColumnRenamed("node", "cls").checkpoint()
    members = classes.join(roots, "cls").select("root", "cls", "n", "vec")
    counts = _count_links(members, threshold, chunk)
    named = classes.join(roots, "cls", "left").select("cls", "first", "n", F.coalesce("root", "cls").alias("root"))
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    result = named.join(least, "root").join(counts, "cls", "left").select(
        F.col("cls").alias("_cls"), "component_id", (F.col("n") - 1 + F.coalesce("links", F.lit(0).cast("long"))).alias("n_links")
    )
    own = rows.select("id", "cls").join(result, F.col("cls") == F.col("_cls"), "left")
    named_by = F.coalesce("component_id", "id")
    return own.select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), named_by.alias("component_id"),
        F.coalesce(F.col("id") == named_by, F.lit(False)).alias("kept"),
    )


__all__ = ["near_duplicates", "planes", "unit"]
