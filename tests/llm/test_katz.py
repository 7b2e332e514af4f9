"""Katz backoff against a direct evaluation on small tables."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finwater.llm import katz, queries

SF = "/root/testdata/sf0.001"
END, START = "</s>", "<s>"


def words(text):
    return (text or "").encode().lower().split()


def brute(rows, order):
    """Scores of (id, text) rows straight from the definition."""
    held = [i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows]
    seqs = [[START, *words(t), END] for _, t in rows]
    counts = [None, Counter()] + [defaultdict(Counter) for _ in range(2, order + 1)]
    for h, s in zip(held, seqs):
        if not h:
            for i in range(1, len(s)):
                counts[1][s[i]] += 1
                for k in range(2, order + 1):
                    if i - k + 1 >= 0:
                        counts[k][tuple(s[i - k + 1 : i])][s[i]] += 1
    total, types = sum(counts[1].values()), len(counts[1])

    def n_of(k):
        cc = Counter(counts[1].values()) if k == 1 else Counter(c for f in counts[k].values() for c in f.values())
        return [cc.get(r, 0) for r in range(1, katz.K + 2)]

    d = [None] + [katz.discounts(n_of(k)) for k in range(1, order + 1)]
    f = lambda k, r: d[k][r - 1] if r <= katz.K else 1.0
    left1 = sum((1 - f(1, c)) * c for c in counts[1].values())
    whole = total + (left1 <= 0)

    def p(k, hist, w):
        if k == 1:
            c = counts[1].get(w, 0)
            return f(1, c) * c / whole if c else (left1 if left1 > 0 else 1) / whole
        seen = counts[k].get(hist)
        if not seen:
            return p(k - 1, hist[1:], w)
        c_h = sum(seen.values())
        left = sum((1 - f(k, c)) * c for c in seen.values())
        den = c_h + (left <= 0)
        c = seen.get(w, 0)
        if c:
            return f(k, c) * c / den
        rest = 1 - sum(p(k - 1, hist[1:], x) for x in sorted(seen, key=str))
        return (left if left > 0 else 1) / den / rest * p(k - 1, hist[1:], w)

    out = []
    for (i, _), h, s in zip(rows, held, seqs):
        base = sum(math.log10((counts[1].get(w, 0) + 0.5) / (total + 0.5 * (types + 1))) for w in s[1:])
        score = sum(math.log10(p(k := min(order, j + 1), tuple(s[j - k + 1 : j]), s[j])) for j in range(1, len(s)))
        out.append((i, h, len(s) - 1, sum(counts[1].get(w, 0) > 0 for w in s[1:]), total, base, score))
    return out


def compare(got, want):
    key = lambda r: (str(r[0]), r[2], round(r[6], 6))
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:5] == w[:5]
        assert g[5:] == pytest.approx(w[5:], rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("order,chunk", [(2, 700), (3, 20_000)])
def test_scores_equal_the_definition(spark, order, chunk):
    """Small chunks make many buckets, over which frequent words are spread."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60).coalesce(2)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    model = katz.fit(docs, order=order, chunk_tokens=chunk)
    if chunk < 1000:
        most = max(Counter(w for i, t in rows for w in words(t)).values())
        assert most > model.known.tokens / model.known.buckets  # some history is spread
    compare(katz.score(model, spark).collect(), brute(rows, order))


def test_backoff_is_normalised(spark):
    """Over the vocabulary and the unknown word every history adds up to one."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(25)
    model = katz.fit(docs, chunk_tokens=900)
    known = model.known
    one = katz.vocabulary(model, spark).collect()
    assert len({r["number"] for r in one}) == len({r["hash"] for r in one}) == known.types
    assert sum(r["count"] for r in one) == known.tokens
    p1 = {r["number"]: r["prob"] for r in one}
    unknown = float(known.unigram(np.array([0]))[0])
    assert sum(p1.values()) + unknown == pytest.approx(1, abs=1e-12)
    grams, backoff = katz.tables(model, spark, 2)
    seen = defaultdict(dict)
    for r in grams.collect():
        seen[r["history"]][r["word"]] = r["prob"]
    weights = {r["history"]: r["weight"] for r in backoff.collect()}
    assert set(seen) == set(weights) and len(seen) > 100
    for h, probs in seen.items():
        assert sum(probs.values()) + weights[h] * (1 - sum(p1[w] for w in probs)) == pytest.approx(1, abs=1e-9)


def test_odd_rows(spark):
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("score", T.StringType())])
    rows = [(1, None), (2, ""), (3, " \t\n"), (None, "a b"), (4, "a A a"), (4, "a A a"), (5, "x " * 5000), (6, "É é b"), (7, "a b c d")]
    df = spark.createDataFrame([(i, t, "clash") for i, t in rows], schema)
    compare(katz.score(katz.fit(df, chunk_tokens=100), spark).collect(), brute(rows, 2))
    assert katz.score(katz.fit(df.limit(0)), spark).collect() == []


def test_all_held_out(spark):
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5 == 1][:3]
    rows = [(i, "a b") for i in held]
    compare(katz.score(katz.fit(spark.createDataFrame(rows, "doc_id long, text string")), spark).collect(), brute(rows, 2))


def test_discounts():
    d = katz.discounts([1000, 400, 200, 120, 80, 50])
    assert ((d > 0) & (d < 1)).all()
    d = katz.discounts([3, 0, 0, 0, 0, 0])
    assert ((d > 0) & (d < 1)).all()


def test_query_scores_trigrams(spark, scratch):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(40).coalesce(2)
    docs.write.parquet(f"{scratch}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{scratch}/documents.parquet").collect()]
    compare(queries.op1_katz(spark, scratch).collect(), brute(rows, 3))


def test_third_order_moves_and_stores_numbers(spark):
    """Histories of order 3 are numbers of the stored bigrams (they were 64-bit
    hashes, and probabilities were sent and stored beside them)."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60).coalesce(2)
    model = katz.fit(docs, order=3, chunk_tokens=20_000)
    two, _ = katz.tables(model, spark, 2)
    three, backoff = katz.tables(model, spark, 3)
    p2 = {r["number"]: r for r in two.collect()}
    assert len(p2) == two.count() and None not in p2
    words_of = defaultdict(list)
    for r in three.collect():
        words_of[r["history"]].append((r["word"], r["prob"]))
    assert set(words_of) <= set(p2) and len(words_of) > 100
    by_pair = {(r["history"], r["word"]): r["prob"] for r in p2.values()}
    weights = {r["history"]: r["weight"] for r in backoff.collect()}
    for h, found in words_of.items():
        lower = sum(by_pair[p2[h]["word"], w] for w, _ in found)
        assert sum(p for _, p in found) + weights[h] * (1 - lower) == pytest.approx(1, abs=1e-9)
    stored = katz._read(spark, model.paths[3], "model").agg(F.sum(F.length("histories"))).first()[0]
    assert stored < 4 * len(words_of)


def _spread_and_local():
    """Texts over several chunks: pairs that all hold, pairs of one text only,
    one pair frequent enough to be spread, and held-out texts."""
    rng = np.random.default_rng(5)
    rows = []
    for i in range(60):
        words_ = [f"w{rng.integers(12)}" if rng.random() < 0.7 else f"r{i}_{rng.integers(40)}" for _ in range(80)]
        rows.append((i, " ".join(words_ + ["a b"] * int(rng.integers(15)) + ["a b c"] * 3)))
    return rows


@pytest.mark.parametrize("order,chunk", [(3, 700), (3, 10**6), (4, 900)])
def test_ngrams_of_one_chunk_stay_in_it(spark, order, chunk):
    """Of the last order, those with a history or an end that only one chunk
    holds are neither sent nor stored again (all were), and scores stay those of
    the definition."""
    rows = _spread_and_local()
    model = katz.fit(spark.createDataFrame(rows, "doc_id long, text string").coalesce(2), order=order, chunk_tokens=chunk)
    compare(katz.score(model, spark).collect(), brute(rows, order))
    want = defaultdict(Counter)
    for i, t in rows:
        s = [START, *words(t), END]
        if zlib.crc32(str(i).encode()) % 5 != 1:
            for j in range(order - 1, len(s)):
                want[tuple(s[j - order + 1 : j])][s[j]] += 1
    grams, backoff = katz.tables(model, spark, order)
    seen = defaultdict(list)
    for r in grams.collect():
        seen[r["history"]].append(r["count"])
    assert sorted(sorted(v) for v in seen.values()) == sorted(sorted(c.values()) for c in want.values())
    assert {r["history"] for r in backoff.collect()} == set(seen)
    sent = sum(
        int(katz.unpack(r["followers"]).sum()) for r in katz._read(spark, model.paths[order], "model").collect() if r["followers"] is not None
    )
    assert sent < 0.6 * sum(map(len, seen.values()))


def test_chunks_without_hashes(spark):
    """What later steps read of a chunk are places of words (hashes before)."""
    model = katz.fit(spark.createDataFrame(_spread_and_local(), "doc_id long, text string").coalesce(2), order=3, chunk_tokens=900)
    for r in spark.read.parquet(model.chunks).collect():
        hashes, places = katz.unpack_sorted(r["words"]), katz.unpack_sorted(r["places"])
        assert (np.diff(hashes.astype(object)) > 0).all() and sorted(places) == list(range(len(hashes)))
        assert len(r["places"]) < 3 * len(places) + 40
    assert not {"words", "count"} & set(katz._chunks(spark, model.chunks).columns)
