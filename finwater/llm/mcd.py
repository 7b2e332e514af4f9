"""Robust multivariate outliers among text statistics, per language and source.

Each text gives a vector of five transformed statistics: logarithms of length
and word length, and square roots of three rates. Per (language, source) group
the minimum covariance determinant is sought: from three deterministic starts
(medians with median deviations, mean and covariance of all rows, medians with
the covariance of spatial signs), concentration steps take mean and covariance
of the nearer half of the rows until the determinant no longer falls (``STEPS``
at most), and the estimate with the least determinant is kept. Every step covers all rows with
grouped aggregates, combined before the shuffle, so that a group of any size
is fitted without gathering it; statistics are fixed-point integers, which
makes sums exact and reruns equal. Only one row per group and start (mean and
precision) goes through numpy.

The estimate is then reweighted: mean and covariance once more, of all rows
within the chi-squared 97.5% point of the first estimate. Squared distances
are scaled so that the group's median equals the chi-squared median, and a row
is rejected when its own is above ``cutoff``, a chi-squared quantile. A
statistic's spread counts as its floor where it is less, so that a group in
which it never varies does not reject the first row that has some; in the
concentration steps the floors are a ridge. A rate that most rows lack has no
spread inside a group. If between ``HABIT`` shares of a language's rows, or of
all rows, have it (tables have bars, for instance), it is a habit there, and
the median of those that have it counts as the 97.5% point of its spread: the
floor is that, or the lesser one if both levels have the habit.

Cases: a null text has no words; rows that fail the base rules are rejected
and take no part in the fit. Null languages and sources are groups of their
own. Groups with fewer than ``MIN_ROWS`` rows to fit are judged by the estimate
of all rows of their language, and where that has too few by that of all rows;
only a table with fewer in all has the base rules alone. Repeated rows count each. An empty table gives an empty result.
Other columns are carried or ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finwater.session import ensure_checkpoint_dir, shared_scratch

from .base import col, map_texts, prepare

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SYMBOLS = b"#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
DIM = len(COUNTS)
#: Fixed-point steps per unit of a transformed statistic.
SCALE = 1024
#: Least standard deviation of each transformed statistic, in units; and the
#: share of its variance that is always added, which keeps matrices regular.
FLOOR = [0.3, 0.1, 0.8, 0.8, 0.8]
RIDGE = 0.01
#: Places of the rates, and the shares of rows between which one is a habit.
RATES, HABIT = (2, 3, 4), (0.02, 0.3)
#: Square root of the 97.5% point of the chi-squared distribution with one
#: degree of freedom.
CHI1_INNER = 2.24140
#: Median and 97.5% point of the chi-squared distribution with five degrees of
#: freedom.
CHI2_MEDIAN, CHI2_INNER = 4.35146, 12.8325
SUPPORT, MIN_ROWS = 0.5, 30
#: Most concentration steps, and the least fall of a log-determinant that counts.
STEPS, FALL = 6, 1e-3
#: Squared distance beyond which a row is rejected: the 99.99% point.
CUTOFF = 25.7448
#: Groups up to which the fitted parameters are broadcast (about 250 bytes each).
MAX_BROADCAST_GROUPS = 20_000


def text_counts(text: bytes) -> tuple[int, int, int, int, int]:
    """The five base counts of one text, in the order of ``COUNTS``."""
    words = text.split()
    string = text.decode("utf-8", "replace")
    chars = len(string) - sum(map(string.count, SPACES))
    symbols = sum(text.count(SYMBOLS[i : i + 1]) for i in range(len(SYMBOLS)))
    seen: set[bytes] = set()
    repeats = 0
    for line in text.split(b"\n"):
        if line.strip():
            repeats += line in seen
            seen.add(line)
    return len(words), chars, symbols, repeats, repeat_words(words)


def repeat_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur at least twice."""
    n = len(words) - 2
    if n < 2:
        return 0
    index: dict[bytes, int] = {}
    ids = np.fromiter((index.setdefault(w, len(index)) for w in words), dtype=np.int64, count=len(words))
    pair = ids[:-1] * len(index) + ids[1:]
    if len(index) >= 1 << 21:  # three ids no longer fit in 63 bits
        pair = np.unique(pair, return_inverse=True)[1]
    window = pair[:-1] * len(index) + ids[2:]
    order = np.sort(window)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    at = np.flatnonzero(np.isin(window, twice))
    covered = np.zeros(len(words), dtype=bool)
    for k in range(3):
        covered[at + k] = True
    return int(covered.sum())


def counted(df: DataFrame, *, keep: list[str], text_col: str = "text") -> DataFrame:
    """The ``keep`` columns and the five counts (``_n_words`` and so on)."""

    def work(texts: list[bytes]) -> list:
        rows = np.array([text_counts(t) for t in texts], dtype=np.int64).reshape(-1, DIM)
        return list(rows.T)

    return map_texts(df, keep, text_col, [T.StructField(f"_{c}", T.LongType()) for c in COUNTS], work)


def base_failed():
    """Under 50 words, or over half of them in repeated windows."""
    return (F.col("_n_words") < 50) | (100 * F.col("_n_repeat_words") > 50 * F.col("_n_words"))


def _vector():
    """Transformed statistics: logarithms of length and word length, and square
    roots of the rates per 100 words of symbols, repeated lines and repeated
    windows (the spread of counts grows with them)."""
    words = F.greatest(F.col("_n_words"), F.lit(1))
    rate = lambda c: F.sqrt(100.0 * F.col(c) / words)
    parts = [F.log(words), F.log(F.greatest(F.col("_word_chars"), F.lit(1)) / words), rate("_n_symbols"),
             rate("_n_dup_lines"), rate("_n_repeat_words")]
    return F.array(*[F.round(p * SCALE).cast("long") for p in parts])


def _distance():
    """Squared Mahalanobis distance of ``x`` from ``mean`` under ``precision``
    (upper triangle, off-diagonal entries doubled)."""
    d = [F.col("x")[i] - F.col("mean")[i] for i in range(DIM)]
    pairs = [(i, j) for i in range(DIM) for j in range(i, DIM)]
    return sum((d[i] * d[j] * F.col("precision")[k] for k, (i, j) in enumerate(pairs)), F.lit(0.0))


def _bin():
    """The distance on a log scale, as a whole number."""
    return F.round(F.log2(F.greatest(_distance(), F.lit(0.0)) + 1) * 256).cast("long")


_GROUP, _START = ["g1", "g2"], ["g1", "g2", "st"]
_KINDS = {"g1": "string", "g2": "string", "st": "int"}


def _params(sums: DataFrame, keys: list[str], carry: list[str] = (), *, floors: bool = False) -> DataFrame:
    """Rows of (keys, rows, n, s, q) to mean, precision and log-determinant;
    ``carry`` are further columns of doubles.
    The floors are a ridge, or (from a column ``floor``) the least standard
    deviation of each statistic."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tri, ridge = np.triu_indices(DIM), (np.array(FLOOR) * SCALE) ** 2
        for f in frames:
            means, precisions, logs = [], [], []
            for at, (n, s, q) in enumerate(zip(f["n"], f["s"], f["q"])):
                mean = np.array(s, dtype=float) / n
                cov = np.zeros((DIM, DIM))
                cov[tri] = np.array(q, dtype=float) / n
                cov = np.triu(cov) + np.triu(cov, 1).T - np.outer(mean, mean)
                least = (np.array(f["floor"].iloc[at], dtype=float) * SCALE) ** 2 if floors else ridge
                cov += np.diag(np.maximum(least - np.diag(cov), RIDGE * least) if floors else ridge)
                inverse = np.linalg.inv(cov)
                means.append(mean)
                precisions.append((2 * inverse - np.diag(np.diag(inverse)))[tri])
                logs.append(np.linalg.slogdet(cov)[1])
            made = {k: f[k] for k in [*keys, *carry]}
            yield pd.DataFrame(made | {"rows": f["rows"], "mean": means, "precision": precisions, "logdet": logs})

    shown = ", ".join([*(f"{k} {_KINDS[k]}" for k in keys), *(f"{k} double" for k in carry)])
    return sums.mapInPandas(run, f"{shown}, rows long, mean array<double>, precision array<double>, logdet double")


def _moments(rows: DataFrame, keys: list[str], x: str = "x") -> DataFrame:
    v = [F.col(x)[i] for i in range(DIM)]
    products = [F.sum(v[i] * v[j]) for i in range(DIM) for j in range(i, DIM)]
    carried = [F.max("before").alias("before")] if "before" in rows.columns else []
    return rows.groupBy(*keys).agg(
        *carried, F.max("rows").alias("rows"), F.count(F.lit(1)).alias("n"),
        F.array(*[F.sum(c) for c in v]).alias("s"), F.array(*products).alias("q"),
    )


def _bounded(small: DataFrame) -> DataFrame:
    """A hint to broadcast a checkpointed per-group table, if small enough."""
    return F.broadcast(small) if small.count() <= MAX_BROADCAST_GROUPS else small


def _grouped(left: DataFrame, small: DataFrame, keys: list[str] = _GROUP, send: bool | None = None) -> DataFrame:
    """``left`` with the per-group columns of ``small``; ``send`` tells whether
    that table is small enough to broadcast, where it has been counted."""
    right = small.select(*[F.col(k).alias(f"_{k}") for k in keys], *[c for c in small.columns if c not in keys])
    on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    right = _bounded(right) if send is None else F.broadcast(right) if send else right
    return left.join(right, on).drop(*[f"_{k}" for k in keys])


def _diagonal(variances: list) -> list:
    """Upper triangle of the precision of independent statistics."""
    return [1 / variances[i] if i == j else F.lit(0.0) for i in range(DIM) for j in range(i, DIM)]


def starts(vectors: DataFrame, min_rows: int = MIN_ROWS) -> DataFrame:
    """(g1, g2, st, rows, mean, precision, logdet): the three starts of each
    group with ``min_rows`` rows."""
    # exact percentiles keep a count per distinct fixed-point value, a bounded number
    middle = vectors.groupBy(*_GROUP).agg(
        F.count(F.lit(1)).alias("rows"), F.array(*[F.percentile(F.col("x")[i], 0.5) for i in range(DIM)]).alias("mean")
    ).filter(F.col("rows") >= min_rows).checkpoint()
    send = 3 * middle.count() <= MAX_BROADCAST_GROUPS
    spread = _grouped(vectors, middle, send=send).groupBy(*_GROUP).agg(
        F.max("rows").alias("rows"), F.first("mean").alias("mean"),
        F.array(*[F.percentile(F.abs(F.col("x")[i] - F.col("mean")[i]), 0.5) for i in range(DIM)]).alias("mad"),
    )
    own = [F.pow(1.4826 * F.col("mad")[i], 2) + (FLOOR[i] * SCALE) ** 2 for i in range(DIM)]
    spread = spread.withColumn("unit", F.array(*[F.sqrt(v) for v in own])).checkpoint()
    far = F.lit(float("inf")).alias("logdet")
    kept = ["rows", "mean", "precision", "logdet"]
    first = spread.select(*_GROUP, F.lit(0).alias("st"), "rows", "mean", F.array(*_diagonal(own)).alias("precision"), far)
    every = _params(_moments(_grouped(vectors, middle.select(*_GROUP, "rows"), send=send), _GROUP), _GROUP)
    second = every.select(*_GROUP, F.lit(1).alias("st"), *kept[:3], far)
    # spatial signs: directions from the medians in units of the spreads
    away = F.array(*[(F.col("x")[i] - F.col("mean")[i]) / F.col("unit")[i] for i in range(DIM)])
    length = F.sqrt(sum((F.col("away")[i] * F.col("away")[i] for i in range(DIM)), F.lit(0.0)))
    sign = F.array(*[F.coalesce(F.round(F.col("away")[i] * SCALE / F.nullif("length", F.lit(0.0))), F.lit(0.0)).cast("long") for i in range(DIM)])
    signs = _grouped(vectors, spread, send=send).withColumn("away", away).withColumn("length", length).withColumn("sign", sign)
    turned = _params(_moments(signs, _GROUP, "sign"), _GROUP).select(*_GROUP, F.col("precision").alias("p"))
    pairs = [(i, j) for i in range(DIM) for j in range(i, DIM)]
    unit = [F.col("p")[k] / (F.col("unit")[i] * F.col("unit")[j]) for k, (i, j) in enumerate(pairs)]
    third = _grouped(spread, turned, send=send).select(*_GROUP, F.lit(2).alias("st"), "rows", "mean", F.array(*unit).alias("precision"), far)
    return first.unionByName(second).unionByName(third).checkpoint()


def concentrated(vectors: DataFrame, now: DataFrame, support: float = SUPPORT, send: bool | None = None) -> DataFrame:
    """One concentration step of every group and start, with the determinant it
    began with (``before``). One job: a row per group and start is stored."""
    near = _grouped(vectors, now, send=send).select(*_START, "rows", "x", F.col("logdet").alias("before"), _bin().alias("bin"))
    bound = near.groupBy(*_START).agg(F.percentile("bin", support).alias("bound"))
    inside = _grouped(near, bound, _START, send).filter(F.col("bin") <= F.col("bound"))
    return _params(_moments(inside, _START), _START, ["before"]).checkpoint()


def fit(vectors: DataFrame, *, support: float = SUPPORT, steps: int = STEPS, min_rows: int = MIN_ROWS) -> DataFrame:
    """Per group of ``vectors`` (g1, g2, x: array of fixed-point longs) the
    estimate of least determinant over all starts and steps, and the distance's
    scale: (g1, g2, rows, mean, precision, logdet, scale). Groups of fewer than
    ``min_rows`` rows are left out."""
    ensure_checkpoint_dir(vectors.sparkSession)
    prepare(vectors.sparkSession)
    now, found = starts(vectors, min_rows), None
    send = now.count() <= MAX_BROADCAST_GROUPS
    for _ in range(steps):
        step = concentrated(vectors, now, support, send)
        found = step if found is None else found.unionByName(step)
        now = step.filter(F.col("logdet") < F.col("before") - FALL).drop("before")
        if now.isEmpty():
            break
    least = F.min_by(F.struct("rows", "mean", "precision", "logdet"), F.struct("logdet", "st"))
    return _scaled(vectors, found.groupBy(*_GROUP).agg(least.alias("e")).select(*_GROUP, "e.*").checkpoint(), send)


def _scaled(vectors: DataFrame, now: DataFrame, send: bool | None = None) -> DataFrame:
    """An estimate with the scale that brings each group's median distance to
    the chi-squared median, 1 at least."""
    last = _grouped(vectors, now, send=send).select(*_GROUP, _bin().alias("bin"))
    scale = last.groupBy(*_GROUP).agg(F.percentile("bin", 0.5).alias("mid"))
    scale = scale.select(*_GROUP, F.greatest((F.pow(F.lit(2.0), F.col("mid") / 256) - 1) / CHI2_MEDIAN, F.lit(1.0)).alias("scale"))
    return _grouped(now, scale, send=send).checkpoint()


def _habit() -> list:
    """Per rate the habit's spread in a group of rows, or null."""
    out = []
    for i in RATES:
        has = F.col("x")[i] > 0
        share = F.try_divide(F.count_if(has), F.count(F.lit(1)))
        spread = F.percentile(F.when(has, F.col("x")[i]), 0.5) / (CHI1_INNER * SCALE)
        out.append(F.when(share.between(*HABIT), spread).alias(f"h{i}"))
    return out


def floors(vectors: DataFrame) -> tuple[DataFrame, list[float]]:
    """(g1, floor) of each language, and the floors of all rows."""
    whole = vectors.agg(*_habit()).first()  # one row
    every = {i: whole[f"h{i}"] for i in RATES}
    least = lambda i: F.greatest(F.lit(FLOOR[i]), F.least(F.col(f"h{i}"), F.lit(every[i]).cast("double")))
    langs = vectors.groupBy("g1").agg(*_habit())
    found = langs.select("g1", F.array(*[least(i) if i in RATES else F.lit(FLOOR[i]) for i in range(DIM)]).alias("floor"))
    return found.checkpoint(), [max(f, every.get(i) or 0.0) for i, f in enumerate(FLOOR)]


def reweighted(vectors: DataFrame, fitted: DataFrame, spreads: tuple[DataFrame, list[float]], *, inner: float = CHI2_INNER) -> DataFrame:
    """``fitted`` once more, from all rows within ``inner`` of it, with the
    floors as least spreads."""
    langs, every = spreads
    near = _grouped(vectors, fitted).filter(_distance() / F.col("scale") <= inner)
    sums = _moments(near, _GROUP).join(
        _bounded(langs.withColumnRenamed("g1", "_l")), F.col("g1").eqNullSafe(F.col("_l")), "left"
    ).withColumn("floor", F.coalesce("floor", F.array(*[F.lit(f) for f in every])))
    return _scaled(vectors, _params(sums, _GROUP, floors=True).checkpoint())


def _levels(vectors: DataFrame, langs: DataFrame, whole: bool) -> DataFrame:
    """Each row in its group (g2 with an ``s`` before it), with ``langs`` in its
    language (g2 ``l``), and with ``whole`` among all rows (g2 ``a``)."""
    key = lambda g1, g2: F.struct(g1.cast("string").alias("g1"), g2.cast("string").alias("g2"))
    keys = [key(F.col("g1"), F.concat(F.lit("s"), F.col("g2"))), F.when(F.col("_l").isNotNull(), key(F.col("g1"), F.lit("l")))]
    keys += [key(F.lit(None), F.lit("a"))] * whole
    marked = vectors.join(_bounded(langs.select(F.col("g1").alias("_g1"), F.lit(1).alias("_l"))), F.col("g1").eqNullSafe(F.col("_g1")), "left")
    return marked.select("x", F.explode(F.array_compact(F.array(*keys))).alias("key")).select("key.g1", "key.g2", "x")


def estimate(vectors: DataFrame) -> DataFrame:
    """The reweighted fit of each group; groups of fewer than ``MIN_ROWS`` rows
    have their language's, or else that of all rows, from the same steps."""
    ensure_checkpoint_dir(vectors.sparkSession)
    sizes = vectors.groupBy("g1", "g2").agg(F.count(F.lit(1)).alias("n")).checkpoint()
    small = sizes.filter(F.col("n") < MIN_ROWS)
    langs = sizes.groupBy("g1").agg(F.sum("n").alias("total"), F.min("n").alias("least")).filter(F.col("least") < MIN_ROWS).checkpoint()
    whole = not langs.filter(F.col("total") < MIN_ROWS).isEmpty()
    rows = _levels(vectors, langs.filter(F.col("total") >= MIN_ROWS), whole)
    found = reweighted(rows, fit(rows), floors(vectors))
    values = [c for c in found.columns if c not in ("g1", "g2")]
    own = found.filter(F.coalesce(F.col("g2").startswith("s"), F.lit(True))).withColumn("g2", F.expr("substring(g2, 2)"))
    # the few languages take the estimate of all rows first, then their groups theirs
    lang = found.filter(F.col("g2") == "l").select("g1", *values)
    rest = langs.filter(F.col("total") < MIN_ROWS).select("g1").crossJoin(F.broadcast(found.filter(F.col("g2") == "a").select(*values)))
    wide = lang.unionByName(rest).withColumnRenamed("g1", "_l").checkpoint()
    lent = small.select("g1", "g2").join(_bounded(wide), F.col("g1").eqNullSafe(F.col("_l"))).drop("_l")
    return own.unionByName(lent).checkpoint()


def _keys(df: DataFrame, lang: str, source: str) -> DataFrame:
    return df.withColumns({"g1": col(lang).cast("string"), "g2": col(source).cast("string"), "x": _vector()})


def judge(
    df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    source_col: str = "source", cutoff: float = CUTOFF,
) -> DataFrame:
    """(id, the five counts, ``base_failed``, ``distance`` (squared and
    scaled, null without a fit), ``kept``) of every row."""
    spark = df.sparkSession
    path = shared_scratch(spark, "text_counts", unique=True)
    named = df.select(col(id_col).alias("_id"), col(text_col).alias("_text"), col(lang_col).alias("_l"), col(source_col).alias("_s"))
    counted(named, keep=["_id", "_l", "_s"], text_col="_text").write.parquet(path)
    rows = _keys(spark.read.parquet(path), "_l", "_s")
    found = _verdict(rows, estimate(rows.filter(~base_failed()).select("g1", "g2", "x")), cutoff)
    return found.select(
        F.col("_id").alias(id_col), *[F.col(f"_{c}").alias(c) for c in COUNTS], "base_failed", "distance", "kept"
    )


def _verdict(rows: DataFrame, fitted: DataFrame, cutoff: float) -> DataFrame:
    right = fitted.select(F.col("g1").alias("_g1"), F.col("g2").alias("_g2"), "mean", "precision", "scale")
    on = F.col("g1").eqNullSafe(F.col("_g1")) & F.col("g2").eqNullSafe(F.col("_g2"))
    joined = rows.join(_bounded(right), on, "left").withColumns({"base_failed": base_failed(), "distance": _distance() / F.col("scale")})
    # no fit: only the base rules speak
    return joined.withColumn("kept", ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= cutoff))


def keep_inliers(
    df: DataFrame, *, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", cutoff: float = CUTOFF
) -> DataFrame:
    """The rows of ``df`` that pass, with their own columns. The fit reads a
    stored table of counts; the verdict is taken row by row on a second pass
    over the texts, so that no text is shuffled."""
    spark = df.sparkSession
    path = shared_scratch(spark, "text_counts", unique=True)
    named = df.select(col(text_col).alias("_text"), col(lang_col).alias("_l"), col(source_col).alias("_s"))
    counted(named, keep=["_l", "_s"], text_col="_text").write.parquet(path)
    fitted = estimate(_keys(spark.read.parquet(path), "_l", "_s").filter(~base_failed()).select("g1", "g2", "x"))
    own = {c: f"_c{i}" for i, c in enumerate(df.columns)}
    plain = df.select(*[col(c).alias(n) for c, n in own.items()])
    rows = _keys(counted(plain, keep=list(own.values()), text_col=own[text_col]), own[lang_col], own[source_col])
    return _verdict(rows, fitted, cutoff).filter("kept").select(*[F.col(n).alias(c) for c, n in own.items()])


__all__ = ["counted", "estimate", "fit", "floors", "judge", "keep_inliers", "repeat_words", "reweighted", "starts", "text_counts"]
