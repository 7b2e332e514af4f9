"""Language identification from averaged hashed subword embeddings.

A text's subwords are the byte 2- to 4-grams of its words, with one space as
word border; each is hashed to a row of an embedding table. The rows are
averaged over the whole text and a linear softmax gives the languages'
probabilities. Training is stochastic gradient descent in numpy on a bounded
sample of labelled passages; prediction reads whole texts in Arrow batches
with table and softmax folded into one fixed-point score per subword and
language, so that sums are exact and do not depend on batches.

Probabilities are calibrated: a temperature is chosen on validation passages.
Whole validation documents (a quarter of the sample) set two bounds, and texts
beyond either are rejected: confidence below the ``REJECT_RATE`` quantile of
those told rightly, and a share of subwords never seen in training above their
upper ``REJECT_RATE`` quantile (``UNSEEN`` at least, as small samples tell
little). The share is its lower bound by chance, so that a few new subwords in
a short text count little. It also rejects where one or two languages were
learnt and the best probability is high for any text.

Cases: a null text, or one without a letter, is ``und`` with score 0 and
rejected. Empty and very long texts are read whole. Rows with a null language
or text are not learnt from. Repeated rows give repeated results. Without any
labelled row every text is ``und``. Other columns are ignored or carried,
whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from .base import col, map_texts, prepare

UND = "und"
#: Bounds of the sample that the model is fitted on.
DOCS_PER_LANG, PASSAGES_PER_DOC, PASSAGE_BYTES, MAX_LANGS = 300, 6, 400, 256
PASSAGE_WORDS = (1, 2, 4, 8, 16, 32)
BUCKETS, EMBED, EPOCHS, BATCH, RATE, SEED = 1 << 16, 16, 12, 64, 0.5, 7
REJECT_RATE, UNSEEN = 0.002, 0.25
SIZES = (2, 3, 4)
#: Fixed-point steps per unit of a subword's score.
SCALE = 1 << 16
#: Start positions hashed at a time.
WINDOW = 1 << 17

_LETTER = regex.compile(r"\p{L}").search
# ASCII other than letters counts as space
_FOLD = bytes(b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in range(256))


def subwords(buffer: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(start positions, hashes) of the subwords of a byte buffer in which
    spaces part words; a subword has no space but at its ends."""
    space = buffer == 0x20
    for at in range(0, len(buffer), WINDOW):
        for n in SIZES:
            end = min(at + WINDOW, len(buffer) - n + 1)
            if end <= at:
                continue
            parts = [buffer[at + k : end + k].astype(np.uint32) for k in range(n)]
            value = sum((p << np.uint32(8 * k) for k, p in enumerate(parts)), np.uint32(0))
            ok = ~(space[at:end] & space[at + n - 1 : end + n - 1])
            for k in range(1, n - 1):
                ok &= ~space[at + k : end + k]
            # multiplicative hash; the top 16 bits name the row
            mixed = (value ^ np.uint32(0x9E3779B9 * n & 0xFFFFFFFF)) * np.uint32(2654435761)
            yield np.flatnonzero(ok) + at, (mixed[ok] >> np.uint32(16)).astype(np.int64)


def buffer_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """One buffer of lower-cased texts, parted by spaces, and their starts."""
    folded = [t.decode("utf-8", "replace").lower().encode().translate(_FOLD) for t in texts]
    # every text begins with its border; two spaces keep texts apart
    starts = np.cumsum([0, *(len(t) + 2 for t in folded)])[:-1]
    return np.frombuffer(b"".join(b" " + t + b" " for t in folded) + b" ", dtype=np.uint8), starts


def features(text: bytes) -> np.ndarray:
    buffer, _ = buffer_of([text])
    return np.concatenate([h for _, h in subwords(buffer)] or [np.empty(0, np.int64)])


@dataclass
class Model:
    langs: list[str]
    table: np.ndarray  # [BUCKETS, langs] fixed-point score of a subword
    bias: np.ndarray
    temperature: float
    threshold: float
    seen: np.ndarray  # [BUCKETS] whether training held a subword of the row
    unseen: float = 1.0

    def predict(self, texts: list[bytes]) -> tuple[list[str], list[float], list[bool]]:
        lang, score, strange = self.measure(texts)
        return lang, score, [x == UND or p < self.threshold or u > self.unseen for x, p, u in zip(lang, score, strange)]

    def measure(self, texts: list[bytes]) -> tuple[list[str], list[float], list[float]]:
        """Language, confidence and share of unseen subwords of each text."""
        letters = [_LETTER(t.decode("utf-8", "replace")) is not None for t in texts]
        buffer, starts = buffer_of(texts)
        sums = np.zeros((len(texts), len(self.langs)))
        n, new = np.zeros(len(texts)), np.zeros(len(texts))
        for at, hashed in subwords(buffer):
            doc = np.searchsorted(starts, at, side="right") - 1
            n += np.bincount(doc, minlength=len(texts))
            new += np.bincount(doc[~self.seen[hashed]], minlength=len(texts))
            for k in range(len(self.langs)):  # whole numbers: exact in doubles
                sums[:, k] += np.bincount(doc, weights=self.table[hashed, k], minlength=len(texts))
        p = _softmax((sums / np.maximum(n, 1)[:, None] / SCALE + self.bias) / self.temperature)
        best = p.argmax(axis=1) if self.langs else np.zeros(len(texts), int)
        share, n = new / np.maximum(n, 1), np.maximum(n, 1)
        # subwords overlap: about nine hold the same letters
        strange = np.maximum(share - 3 * np.sqrt(9 * share * (1 - share) / n), 0.0)
        lang, score = [], []
        for i, ok in enumerate(letters):
            ok = ok and bool(self.langs)
            lang.append(self.langs[best[i]] if ok else UND)
            score.append(float(p[i, best[i]]) if ok else 0.0)
        return lang, score, strange.tolist()


def _softmax(z: np.ndarray) -> np.ndarray:
    if not z.shape[-1]:
        return z
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def passages(text: bytes, seed: int) -> list[bytes]:
    """Seeded passages of a text, of one to 32 words and bounded bytes."""
    words = text.split()
    rng = np.random.default_rng(seed & 0xFFFFFFFF)
    out = []
    for i in range(PASSAGES_PER_DOC if words else 0):
        n = PASSAGE_WORDS[(seed + i) % len(PASSAGE_WORDS)] if i else PASSAGE_WORDS[-1]
        a = int(rng.integers(0, max(1, len(words) - n + 1)))
        cut = b" ".join(words[a : a + n])[:PASSAGE_BYTES]
        out.append(cut.decode("utf-8", "ignore").encode())
    return out


def sample(labelled: DataFrame, *, id_col: str, text_col: str, lang_col: str) -> list[tuple[str, int, bytes]]:
    """(language, document key, passage), at most ``DOCS_PER_LANG`` documents
    of each language, drawn by hash, in a fixed order."""
    few = drawn(labelled, id_col=id_col, text_col=text_col, lang_col=lang_col)
    return [] if few is None else _passages(few)


def drawn(labelled: DataFrame, *, id_col: str, text_col: str, lang_col: str) -> DataFrame | None:
    """The sample's documents (lang, key, text); None without any."""
    prepare(labelled.sparkSession)
    rows = labelled.select(
        col(lang_col).cast("string").alias("lang"), F.xxhash64(col(id_col), col(text_col)).alias("key"), col(text_col).alias("text")
    ).filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(MAX_LANGS + 1).collect()}
    if len(counts) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    if not counts:
        return None
    # a threshold on the hash first, so that few texts are shuffled
    share = F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(min(1.0, 2 * DOCS_PER_LANG / n)))])
    few = rows.filter(F.pmod("key", F.lit(1 << 20)) < F.try_element_at(share, F.col("lang")) * (1 << 20))
    order = Window.partitionBy("lang").orderBy("key", "text")
    return few.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= DOCS_PER_LANG).select("lang", "key", "text")


def _passages(few: DataFrame) -> list[tuple[str, int, bytes]]:
    schema = T.StructType([T.StructField("lang", T.StringType()), T.StructField("key", T.LongType()), T.StructField("part", T.BinaryType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(a, k, p) for a, k, t in zip(*(c.to_pylist() for c in batch.columns)) for p in passages(t.encode(), k)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], ty) for i, ty in enumerate((pa.string(), pa.int64(), pa.binary()))],
                names=["lang", "key", "part"],
            )

    return sorted((r["lang"], r["key"], bytes(r["part"])) for r in few.select("lang", "key", "text").mapInArrow(cut, schema).collect())


def train(rows: list[tuple[str, int, bytes]]) -> Model:
    """Stochastic gradient descent on the sampled passages; a quarter of the
    documents calibrates."""
    langs = sorted({r[0] for r in rows})
    if not langs:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros(0), 1.0, 1.0, np.zeros(BUCKETS, dtype=bool))
    y = np.array([langs.index(r[0]) for r in rows])
    x = [features(r[2]) for r in rows]
    held = np.array([zlib.crc32(str(r[1]).encode()) % 4 == 0 for r in rows])
    usable = np.array([len(f) > 0 for f in x])
    fit = np.flatnonzero(~held & usable)
    rng = np.random.default_rng(SEED)
    embed = rng.uniform(-1, 1, (BUCKETS, EMBED)) / EMBED
    weight, bias = np.zeros((EMBED, len(langs))), np.zeros(len(langs))
    steps = max(1, EPOCHS * -(-len(fit) // BATCH))
    step = 0
    for _ in range(EPOCHS):
        for batch in np.array_split(rng.permutation(fit), max(1, -(-len(fit) // BATCH))):
            if not len(batch):
                continue
            rate = RATE * (1 - step / steps)
            step += 1
            size = np.array([len(x[i]) for i in batch])
            idx = np.concatenate([x[i] for i in batch])
            begin = np.concatenate([[0], np.cumsum(size)[:-1]])
            mean = np.add.reduceat(embed[idx], begin, axis=0) / size[:, None]
            slope = _softmax(mean @ weight + bias)
            slope[np.arange(len(batch)), y[batch]] -= 1
            back = np.repeat(slope @ weight.T / size[:, None], size, axis=0)
            weight -= rate * mean.T @ slope / len(batch) * 4
            bias -= rate * slope.mean(axis=0)
            rows_used, inverse = np.unique(idx, return_inverse=True)
            change = np.zeros((len(rows_used), EMBED))
            np.add.at(change, inverse, back)
            embed[rows_used] -= rate * 4 * change
    table = np.round(embed @ weight * SCALE)
    seen = np.zeros(BUCKETS, dtype=bool)
    for i in fit:
        seen[x[i]] = True
    valid = np.flatnonzero(held & usable)
    if not len(valid):
        return Model(langs, table, bias, 1.0, 0.0, seen)
    logits = np.array([table[x[i]].mean(axis=0) / SCALE + bias for i in valid])
    heats = np.geomspace(0.02, 20, 61)
    loss = [-np.log(np.maximum(_softmax(logits / t)[np.arange(len(valid)), y[valid]], 1e-300)).mean() for t in heats]
    heat = float(heats[int(np.argmin(loss))])
    return Model(langs, table, bias, heat, 0.0, seen)


def calibrated(model: Model, right: list[tuple[float, float]]) -> Model:
    """With bounds from (confidence, unseen share) of validation documents
    told rightly; without any, nothing but texts without letters is rejected."""
    if not right:
        return model
    score, strange = np.array(right).T
    odds = np.log(np.maximum(score, 1e-15)) - np.log(np.maximum(1 - score, 1e-15))
    least = float(np.quantile(odds, REJECT_RATE))
    if 2 < len(right) < 1 / REJECT_RATE:
        # too few to hold the quantile: log-odds go on below the median as they
        # fell from it to the least (an exponential tail)
        middle = float(np.median(odds))
        least = middle - (middle - float(odds.min())) * np.log(0.5 / REJECT_RATE) / np.log(0.5 * len(right))
    elif len(right) <= 2:
        least = -np.inf
    bound = max(float(np.quantile(strange, 1 - REJECT_RATE)), UNSEEN)
    return replace(model, threshold=float(1 / (1 + np.exp(-least))), unseen=bound)


def predict(df: DataFrame, model: Model, *, keep: list[str], text_col: str = "text", prefix: str = "") -> DataFrame:
    """The ``keep`` columns, ``lang_pred``, ``score`` (0 to 1) and
    ``rejected``. The model (65,536 rows, 256 languages at most) is broadcast."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    fields = [
        T.StructField(prefix + "lang_pred", T.StringType()), T.StructField(prefix + "score", T.DoubleType()),
        T.StructField(prefix + "rejected", T.BooleanType()),
    ]
    return map_texts(df, keep, text_col, fields, lambda texts: list(shared.value.predict(texts)))


def held_out(id_col: str = "doc_id"):
    """crc32 of the id as text, modulo 4, is 2; a null id is not held out."""
    return F.coalesce(F.pmod(F.crc32(col(id_col).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def fit(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """A model learnt from the rows of ``df`` that are not held out."""
    few = drawn(df.filter(~held_out(id_col)), id_col=id_col, text_col=text_col, lang_col=lang_col)
    model = train([] if few is None else _passages(few))
    if few is None:
        return model
    # whole texts are measured in tasks; a small row each comes back
    shared = df.sparkSession.sparkContext.broadcast(model)
    whole = few.filter(F.pmod(F.crc32(F.col("key").cast("string").cast("binary")), F.lit(4)) == 0)
    fields = [T.StructField("told", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("strange", T.DoubleType())]
    made = map_texts(whole, ["lang"], "text", fields, lambda texts: list(shared.value.measure(texts))).filter(F.col("told") == F.col("lang"))
    return calibrated(model, [(r["score"], r["strange"]) for r in made.select("score", "strange").collect()])


def keep_identified(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``df`` whose language is told with enough confidence."""
    model = fit(df, id_col=id_col, text_col=text_col, lang_col=lang_col)
    own = {c: f"_c{i}" for i, c in enumerate(df.columns)}
    plain = df.select(*[col(c).alias(n) for c, n in own.items()])
    made = predict(plain, model, keep=list(own.values()), text_col=own[text_col], prefix="_p_")
    return made.filter(~F.col("_p_rejected")).select(*[F.col(n).alias(c) for c, n in own.items()])


__all__ = ["Model", "fit", "held_out", "keep_identified", "predict", "sample", "train"]
