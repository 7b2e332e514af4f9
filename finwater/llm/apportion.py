"""Mixing sources to target weights by Sainte-Laguë apportionment.

Sources are ordered by code point (null last) and weigh 5, 2, 1 in turn. They
share ``share`` times all words by weight; a target stops at ``most`` times
its source's words and the excess is shared again by weight until none is
above. Documents are dealt by hash to shards of about ``shard_docs``; within a
shard, in hash order, their words form one line that is cut into equal blocks
of ``block_words`` (the last one may be shorter). Blocks are the seats: the
highest quotients target / (2s + 1) give every source an integer quota, and
the same rule deals a source's quota to its shards. A shard's quota is spent
on whole passes and, for the rest, on a seeded permutation of its blocks
i -> (a*i + c) mod n, of which those below the rest are taken: exactly as many
as needed, by arithmetic, without ranking or shuffling blocks.

Work: one scan for the sizes, grouped sums, one window per shard (bounded by
the shard's size). The driver holds one row per source (``MAX_SOURCES``,
checked); shards are apportioned per source in one task, a row per shard.

Cases: a null text has no words, is never taken and gives no row in
``materialise``. Null sources form one source, null ids one hash. Rows that
are alike get each their own place. Sources without words have target 0. An
empty table gives an empty result. Other columns are carried or ignored,
whatever their names.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window
from pyspark.sql.pandas.types import to_arrow_schema

from finwater.session import shared_scratch

from .base import col, prepare

WEIGHTS = (5, 2, 1)
SHARE, MOST = 1.5, 2.0
SHARD_DOCS, BLOCK_WORDS, SEED = 1000, 64, 2024
MAX_SOURCES = 200_000
WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: list[int], weights: list[float], share: float = SHARE, most: float = MOST) -> list[float]:
    """Words each source should give, in the order of the sources."""
    caps = [most * s for s in sizes]
    out, open_ = [0.0] * len(sizes), [i for i, s in enumerate(sizes) if s]
    left = min(share * sum(sizes), sum(caps))
    while open_:
        total = sum(weights[i] for i in open_)
        above = [i for i in open_ if left * weights[i] / total > caps[i]]
        if not above:
            for i in open_:
                out[i] = left * weights[i] / total
            break
        for i in above:
            out[i] = caps[i]
        left -= sum(caps[i] for i in above)
        open_ = [i for i in open_ if i not in set(above)]
    return out


def sainte_lague(votes: np.ndarray, seats: int, caps: np.ndarray) -> np.ndarray:
    """Seats by the highest quotients votes / (2s + 1), at most ``caps`` each;
    ties go to the earlier entry. All quotients above a bound are dealt at
    once, the last few one by one."""
    votes, caps = np.asarray(votes, dtype=float), np.asarray(caps, dtype=np.int64)
    seats = int(min(seats, caps[votes > 0].sum()))
    if seats <= 0:
        return np.zeros(len(votes), dtype=np.int64)

    def dealt(bound: float) -> np.ndarray:  # quotients strictly above the bound
        return np.minimum(caps, np.maximum(0, np.ceil((votes / bound - 1) / 2)).astype(np.int64))

    low, high = votes.max() / (2.0 * caps.max() + 3) * 1e-6 + 1e-300, votes.max()
    for _ in range(200):
        middle = (low * high) ** 0.5
        if dealt(middle).sum() > seats:
            low = middle
        else:
            high = middle
    quota = dealt(high * (1 + 1e-9))  # clear of ties, which rounding could deal wrongly
    line = [(-votes[i] / (2 * quota[i] + 1), i) for i in range(len(votes)) if quota[i] < caps[i] and votes[i] > 0]
    heapq.heapify(line)
    for _ in range(int(seats - quota.sum())):
        _, i = heapq.heappop(line)
        quota[i] += 1
        if quota[i] < caps[i]:
            heapq.heappush(line, (-votes[i] / (2 * quota[i] + 1), i))
    return quota


def _multiplier(n: int, wish: int) -> int:
    """The first number from ``wish`` on that has no factor in common with n."""
    a = wish % n
    while np.gcd(a, n) != 1:
        a += 1
    return max(1, int(a))


def with_place(df: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """Adds ``_size`` (words), ``_source`` and ``_hash`` (dealing order)."""
    return df.withColumns({
        "_size": F.coalesce(F.regexp_count(col(text_col), F.lit(WORD)).cast("long"), F.lit(0).cast("long")),
        "_source": col(source_col).cast("string"),
        "_hash": F.xxhash64(F.lit(SEED), col(id_col)),
    })


def _shard(n_shards):
    return F.pmod(F.col("_hash"), n_shards)


QUOTAS = T.StructType([
    T.StructField("q_source", T.StringType()), T.StructField("q_shard", T.LongType()), T.StructField("q_shards", T.LongType()),
    T.StructField("source_size", T.LongType()), T.StructField("target", T.DoubleType()), T.StructField("n", T.LongType()),
    T.StructField("passes", T.LongType()), T.StructField("rest", T.LongType()), T.StructField("a", T.LongType()), T.StructField("c", T.LongType()),
])


def quotas(sizes: DataFrame, *, block_words: int = BLOCK_WORDS, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """One row per shard of ``sizes`` (_source, _size, _hash): its number of
    blocks ``n``, whole ``passes``, the ``rest`` of its quota and the seeded
    permutation's ``a`` and ``c``, beside its source's size and target."""
    spark = sizes.sparkSession
    per_source = sizes.groupBy("_source").agg(F.sum("_size").alias("words"), F.count(F.lit(1)).alias("docs"))
    rows = per_source.limit(MAX_SOURCES + 1).collect()
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    rows = sorted(rows, key=lambda r: (r["_source"] is None, r["_source"] or ""))
    wish = targets([r["words"] for r in rows], [WEIGHTS[i % len(WEIGHTS)] for i in range(len(rows))])
    base = spark.createDataFrame(
        [(r["_source"], max(1, -(-r["docs"] // shard_docs)), r["words"], t) for r, t in zip(rows, wish)],
        "s_source string, q_shards long, source_size long, target double",
    )
    joined = sizes.join(base, F.col("_source").eqNullSafe(F.col("s_source")))
    shards = joined.groupBy("s_source", "q_shards", "source_size", "target", _shard(F.col("q_shards")).alias("q_shard")).agg(
        F.sum("_size").alias("words")
    ).withColumn("n", F.ceil(F.col("words") / block_words))
    # seats of a source: its target counted in blocks of its own average size
    blocks = {r["s_source"]: r["n"] for r in shards.groupBy("s_source").agg(F.sum("n").alias("n")).collect()}
    n = np.array([blocks.get(r["_source"], 0) for r in rows], dtype=np.int64)
    votes = np.array([t * k / max(1, r["words"]) for r, t, k in zip(rows, wish, n)])
    seats = sainte_lague(votes, int(round(votes.sum())), np.floor(MOST * n)) if len(rows) else []
    quota_of = spark.createDataFrame([(r["_source"], int(q)) for r, q in zip(rows, seats)], "u_source string, quota long")
    given = shards.join(quota_of, F.col("s_source").eqNullSafe(F.col("u_source"))).drop("u_source")

    def deal(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values("q_shard").reset_index(drop=True)
        n = f["n"].to_numpy(np.int64)
        quota = sainte_lague(f["words"].to_numpy(float), int(f["quota"].iloc[0]), np.floor(MOST * n))
        rng = np.random.default_rng([SEED, len(f), int(n.sum())])
        wish, c = rng.integers(0, 1 << 40, len(f)), rng.integers(0, 1 << 40, len(f))
        whole = np.maximum(n, 1)
        return pd.DataFrame({
            "q_source": f["s_source"], "q_shard": f["q_shard"], "q_shards": f["q_shards"], "source_size": f["source_size"],
            "target": f["target"], "n": n, "passes": quota // whole, "rest": quota % whole,
            "a": [_multiplier(int(k), int(w)) for k, w in zip(whole, wish)], "c": c % whole,
        })

    return given.groupBy("s_source").applyInPandas(deal, QUOTAS)


def mix(
    df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    keep: list[str] | None = None, block_words: int = BLOCK_WORDS, shard_docs: int = SHARD_DOCS,
) -> DataFrame:
    """The ``keep`` columns (all by default) with ``size``, ``source_size``,
    ``target``, ``taken`` and ``place`` (where the row lies and what its shard
    takes), in that order and by position: kept names may clash."""
    spark = df.sparkSession
    prepare(spark)
    keep = df.columns if keep is None else keep
    path = shared_scratch(spark, "mix_sizes", unique=True)
    placed = with_place(df, id_col, text_col, source_col)
    placed.select("_source", "_size", "_hash").write.parquet(path)
    sizes = spark.read.parquet(path)
    # materialised: a row per shard, so that plans below read a small table
    shard_path = shared_scratch(spark, "mix_quotas", unique=True)
    quotas(sizes, block_words=block_words, shard_docs=shard_docs).write.parquet(shard_path)
    shards = spark.read.schema(QUOTAS).parquet(shard_path)
    per_source = shards.groupBy("q_source").agg(F.first("q_shards").alias("p_shards")).select(F.col("q_source").alias("p_source"), "p_shards")
    rows = df.select(
        *[col(k).alias(f"_k{i}") for i, k in enumerate(keep)], col(id_col).alias("_id"), col(text_col).alias("_text"), col(source_col).alias("_src")
    )
    rows = with_place(rows, "_id", "_text", "_src").drop("_text", "_src")
    # one row per source: bounded by MAX_SOURCES
    rows = rows.join(F.broadcast(per_source), F.col("_source").eqNullSafe(F.col("p_source"))).withColumn("_shard", _shard(F.col("p_shards")))
    line = Window.partitionBy("_source", "_shard").orderBy("_hash", "_id", "_size").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_start", F.coalesce(F.sum("_size").over(line), F.lit(0).cast("long")))
    own = (F.col("_source").eqNullSafe(F.col("q_source"))) & (F.col("_shard") == F.col("q_shard"))
    rows = rows.join(shards, own)
    block = F.lit(block_words).cast("long")
    first, last = F.floor(F.col("_start") / block), F.floor((F.col("_start") + F.col("_size") - 1) / block)
    chosen = lambda i: (F.col("a") * i + F.col("c")) % F.col("n") < F.col("rest")
    overlap = lambda i: F.least((i + 1) * block, F.col("_start") + F.col("_size")) - F.greatest(i * block, F.col("_start"))
    extra = F.when((F.col("rest") > 0) & (F.col("_size") > 0), F.aggregate(
        F.sequence(first.cast("long"), last.cast("long")), F.lit(0).cast("long"),
        lambda total, i: total + F.when(chosen(i), overlap(i)).otherwise(F.lit(0).cast("long")),
    )).otherwise(F.lit(0).cast("long"))
    return rows.select(
        *[col(f"_k{i}").alias(k) for i, k in enumerate(keep)],
        F.col("_size").alias("size"), "source_size", "target", (F.col("passes") * F.col("_size") + extra).alias("taken"),
        F.struct(F.col("_start").alias("start"), "n", "passes", "rest", "a", "c").alias("place"),
    )


def taken_spans(size: int, place: dict, block_words: int) -> list[tuple[int, int]]:
    """Word ranges of one row that the rest of its shard's quota takes;
    neighbouring blocks are one range."""
    out: list[tuple[int, int]] = []
    start, end = place["start"], place["start"] + size
    for i in range(start // block_words, -(-end // block_words) if size else 0):
        if place["rest"] and (place["a"] * i + place["c"]) % place["n"] < place["rest"]:
            a, b = max(i * block_words, start) - start, min((i + 1) * block_words, end) - start
            if out and out[-1][1] == a:
                out[-1] = (out[-1][0], b)
            else:
                out.append((a, b))
    return out


def word_ends(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Byte positions at which the words of a text begin and end."""
    raw = np.frombuffer(text, dtype=np.uint8)
    inside = ~((raw == 0x20) | ((raw >= 0x09) & (raw <= 0x0D)))
    edge = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def materialise(
    df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    length_col: str | None = None, block_words: int = BLOCK_WORDS, shard_docs: int = SHARD_DOCS,
) -> DataFrame:
    """The mix itself, with the columns of ``df``: a row with its whole text
    for every whole pass, and one with the taken passages (each as it stands
    in the text, parted by a line end) for the rest. ``length_col`` is set to
    the text's characters in rows whose text was cut."""
    mixed = mix(df, id_col=id_col, text_col=text_col, source_col=source_col, block_words=block_words, shard_docs=shard_docs)
    names = [f"_k{i}" for i in range(len(df.columns))]
    plain = mixed.toDF(*names, "size", "source_size", "target", "taken", "place").filter("taken > 0").select(*names, "size", "place")
    at = df.columns.index(text_col)
    schema = T.StructType([T.StructField(n, f.dataType) for n, f in zip(names, df.schema)])
    arrow = to_arrow_schema(schema)
    length = df.columns.index(length_col) if length_col in df.columns else None

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            index: list[int] = []
            texts: list[str] = []
            lengths: list[int | None] = []
            sizes, places = batch.column(len(names)).to_pylist(), batch.column(len(names) + 1).to_pylist()
            old = batch.column(length).to_pylist() if length is not None else [None] * len(sizes)
            for i, (size, place) in enumerate(zip(sizes, places)):
                text = batch.column(at)[i].as_py()
                index += [i] * place["passes"]
                texts += [text] * place["passes"]
                lengths += [old[i]] * place["passes"]
                spans = taken_spans(size, place, block_words)
                if spans == [(0, size)]:
                    index.append(i)
                    texts.append(text)
                    lengths.append(old[i])
                elif spans:
                    raw = text.encode()
                    begin, end = word_ends(raw)
                    part = b"\n".join(raw[begin[a] : end[b - 1]] for a, b in spans).decode()
                    index.append(i)
                    texts.append(part)
                    lengths.append(len(part))
            take = pa.array(index, pa.int64())
            arrays = [batch.column(j).take(take).cast(f.type) for j, f in enumerate(arrow)]
            arrays[at] = pa.array(texts, arrow.field(at).type)
            if length is not None:
                arrays[length] = pa.array(lengths, pa.int64()).cast(arrow.field(length).type)
            yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    made = plain.mapInArrow(cut, schema)
    return made.select(*[F.col(n).alias(c) for n, c in zip(names, df.columns)])


__all__ = ["materialise", "mix", "quotas", "sainte_lague", "targets"]
