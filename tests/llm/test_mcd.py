"""Text statistics and robust outliers against plain versions."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from odd import TEXTS, documents

from finwater.llm import mcd, queries

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_counts(text):
    text = text or ""
    w = WORD.findall(text)
    windows = list(zip(w, w[1:], w[2:]))
    often, covered = Counter(windows), set()
    for i, x in enumerate(windows):
        if often[x] > 1:
            covered |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def failed(c):
    return c[0] < 50 or 100 * c[4] > 50 * c[0]


def test_counts_and_base_rules(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in queries.op3_quality_outliers(spark, SF).collect():
        want = brute_counts(docs[r["doc_id"]])
        assert tuple(r[c] for c in mcd.COUNTS) == want
        assert r["base_failed"] == failed(want) and not (r["base_failed"] and r["kept"])


def test_odd_rows(spark):
    got = mcd.judge(documents(spark)).select("doc_id", *mcd.COUNTS, "base_failed", "kept").collect()
    want = [(i, *brute_counts(t), failed(brute_counts(t)), not failed(brute_counts(t))) for i, t, *_ in TEXTS]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert mcd.judge(documents(spark).limit(0)).collect() == []
    kept = mcd.keep_inliers(documents(spark))
    assert kept.dtypes == documents(spark).dtypes
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(w[0] for w in want if w[-1])


def step(x, mean, precision, h=mcd.SUPPORT):
    """One concentration step in numpy: mean, precision, log-determinant."""
    d = np.maximum(np.einsum("ni,ij,nj->n", x - mean, precision, x - mean), 0)
    bins = np.floor(np.log2(d + 1) * 256 + 0.5)
    near = x[bins <= np.quantile(bins, h)]
    cov = np.cov(near.T, bias=True) + np.diag((np.array(mcd.FLOOR) * mcd.SCALE) ** 2)
    return near.mean(axis=0), np.linalg.inv(cov), np.linalg.slogdet(cov)[1]


def least_of_random_starts(x, rng, n=60):
    """Log-determinants that random elemental starts reach."""
    out = []
    for _ in range(n):
        seed = x[rng.choice(len(x), mcd.DIM + 1, replace=False)]
        mean, precision = seed.mean(axis=0), np.linalg.inv(np.cov(seed.T) + np.diag((np.array(mcd.FLOOR) * mcd.SCALE) ** 2))
        last = math.inf
        for _ in range(30):
            mean, precision, log = step(x, mean, precision)
            if log >= last - 1e-9:
                break
            last = log
        out.append(last)
    return min(out)


def test_kept_start_has_the_least_determinant(spark):
    """Against random starts, and as a fixed point of the step, per group --
    with a third of the rows far off in two of them."""
    rng = np.random.default_rng(2)
    groups = {("en", "a"): (400, 0.35), ("en", None): (120, 0.1), (None, None): (90, 0.3), ("de", "b"): (10, 0)}
    by_group = {}
    for g, (n, junk) in groups.items():
        x = rng.multivariate_normal([6000, 1700, 0, 0, 0], np.diag([900, 160, 300, 200, 200]) ** 2, n).round().astype(int)
        x[: int(n * junk)] += rng.integers(2000, 9000, 5)
        by_group[g] = x
    rows = [(*g, v.tolist()) for g, x in by_group.items() for v in x]
    fitted = mcd.fit(spark.createDataFrame(rows, "g1 string, g2 string, x array<long>"))
    got = {(r["g1"], r["g2"]): r for r in fitted.collect()}
    assert set(got) == {g for g, x in by_group.items() if len(x) >= mcd.MIN_ROWS}
    tri = np.triu_indices(mcd.DIM)
    for g, r in got.items():
        x, half = by_group[g], np.zeros((mcd.DIM, mcd.DIM))
        half[tri] = r["precision"]
        precision = (half + half.T) / 2
        assert r["logdet"] <= least_of_random_starts(x, rng) + 0.02
        again = step(x, np.array(r["mean"]), precision)
        assert again[2] >= r["logdet"] - 1e-5
        assert np.linalg.slogdet(precision)[1] == pytest.approx(-r["logdet"], rel=1e-6)
        # the estimate is that of the rows that are not far off
        n = int(len(x) * groups[g][1])
        assert np.abs(np.array(r["mean"]) - x[n:].mean(axis=0)).max() < 250


def test_starts_equal_numpy(spark):
    rng = np.random.default_rng(3)
    x = rng.multivariate_normal([6000, 1700, 500, 300, 200], np.diag([900, 160, 300, 200, 200]) ** 2, 101).round().astype(int)
    df = spark.createDataFrame([("en", "a", v.tolist()) for v in x], "g1 string, g2 string, x array<long>")
    got = {r["st"]: r for r in mcd.starts(df).collect()}
    floor, tri = np.array(mcd.FLOOR) * mcd.SCALE, np.triu_indices(mcd.DIM)
    full = lambda p: (lambda h: (h + h.T) / 2)(np.array([[dict(zip(zip(*tri), p)).get((i, j), 0.0) for j in range(5)] for i in range(5)]))
    med = np.median(x, axis=0)
    unit = np.sqrt((1.4826 * np.median(np.abs(x - med), axis=0)) ** 2 + floor**2)
    assert np.allclose(got[0]["mean"], med) and np.allclose(full(got[0]["precision"]), np.diag(1 / unit**2))
    assert np.allclose(got[1]["mean"], x.mean(axis=0))
    assert np.allclose(full(got[1]["precision"]), np.linalg.inv(np.cov(x.T, bias=True) + np.diag(floor**2)))
    away = (x - med) / unit
    signs = np.round(away / np.linalg.norm(away, axis=1)[:, None] * mcd.SCALE)
    turned = np.linalg.inv(np.cov(signs.T, bias=True) + np.diag(floor**2))
    assert np.allclose(got[2]["mean"], med) and np.allclose(full(got[2]["precision"]), turned / np.outer(unit, unit), rtol=1e-6)


def prose(rng, vocab, n):
    return " ".join(rng.choices(vocab, k=n))


def test_junk_of_a_third_of_a_group_goes(spark):
    rng = random.Random(8)
    vocab = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 8))) for _ in range(3000)]
    size = lambda: int(rng.lognormvariate(5.6, 0.4)) + 60
    clean = [(i, prose(rng, vocab, size()), "en", "s") for i in range(260)]
    junk = [(1000 + i, " ".join(w + "###" if k % 2 else w for k, w in enumerate(rng.choices(vocab, k=size()))), "en", "s") for i in range(140)]
    df = spark.createDataFrame(clean + junk, "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: r["kept"] for r in mcd.judge(df).collect()}
    assert not any(got[i] for i, *_ in junk) and sum(got[i] for i, *_ in clean) >= 258


def test_a_habit_stays_and_junk_goes(spark):
    """Texts with tables (a habit of one row in twelve) and with one repeated
    line stay; texts of symbols go."""
    rng = random.Random(10)
    vocab = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 8))) for _ in range(3000)]
    line = lambda: prose(rng, vocab, 17)
    table = lambda: line() + "\n" + "\n".join(" | ".join(rng.choices(vocab, k=4)) for _ in range(12))
    again = lambda: "\n".join((lambda x: [x, *(line() for _ in range(12)), x])(line()))
    kinds = {"plain": (200, lambda: prose(rng, vocab, rng.randint(80, 400))), "table": (20, table), "again": (20, again)}
    rows = [(k, make(), "en", s) for k, (n, make) in kinds.items() for s in ("a", "b") for _ in range(n // 2)]
    rows += [("junk", " ".join(w + "###" for w in rng.choices(vocab, k=150)), "en", "a")] * 4
    df = spark.createDataFrame([(i, *r[1:]) for i, r in enumerate(rows)], "doc_id long, text string, lang string, source string")
    kept = Counter()
    for r in mcd.judge(df).collect():
        kept[rows[r["doc_id"]][0]] += r["kept"]
    assert kept["junk"] == 0 and kept["plain"] >= 198 and kept["table"] >= 16 and kept["again"] >= 18


def test_groups_beyond_the_broadcast(spark, monkeypatch):
    rows = [(i, f"{'ab cd ' * (30 + i % 17)} w{i} x{i % 7}", "en", f"s{i % 3}") for i in range(150)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    shown = lambda: sorted(map(tuple, mcd.judge(df).collect()))
    small = shown()
    monkeypatch.setattr(mcd, "MAX_BROADCAST_GROUPS", 0)
    assert shown() == small


def test_outliers_go_and_clean_stay(spark):
    rng = random.Random(4)
    vocab = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 8))) for _ in range(800)]
    clean = [(i, " ".join(rng.choices(vocab, k=rng.randint(60, 700))), "en", "s") for i in range(300)]
    junk = [(1000 + i, " ".join(w + "###" for w in rng.choices(vocab, k=200)), "en", "s") for i in range(30)]
    df = spark.createDataFrame(clean + junk, "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: r["kept"] for r in mcd.judge(df).collect()}
    assert all(got[i] for i, *_ in clean) and not any(got[i] for i, *_ in junk)
    assert {r["doc_id"] for r in mcd.keep_inliers(df).collect()} == {i for i, k in got.items() if k}


def test_cutoff_is_a_chi_squared_quantile():
    tail = lambda x: math.erfc(math.sqrt(x / 2)) + math.sqrt(2 * x / math.pi) * math.exp(-x / 2) * (1 + x / 3)
    assert tail(mcd.CUTOFF) == pytest.approx(1e-4, rel=1e-3)
    assert tail(mcd.CHI2_INNER) == pytest.approx(0.025, rel=1e-3)
    assert tail(mcd.CHI2_MEDIAN) == pytest.approx(0.5, rel=1e-3)


def test_each_statistic_rejects_alone(spark):
    """Clean texts, and for each statistic one that breaks it alone."""
    rng = random.Random(9)
    vocab = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 8))) for _ in range(3000)]
    words = lambda n: rng.choices(vocab, k=n)
    clean = [(i, " ".join(words(int(rng.lognormvariate(5.6, 0.5)) + 50)), "en", "s") for i in range(600)]
    hashed = [w[:-1] + "#" if i % 3 == 0 else w for i, w in enumerate(words(300))]
    planted = {
        "n_words": " ".join(words(40_000)),
        "word_chars": " ".join(w * 3 for w in words(300)),
        "n_symbols": " ".join(hashed),
        "n_dup_lines": "\n".join("abc defgh" if i % 2 else " ".join(words(3)) for i in range(120)),
        "n_repeat_words": " ".join(" ".join(words(5)) + (" abc defgh cab" if i % 2 else " " + " ".join(words(3))) for i in range(40)),
    }
    rows = clean + [(1000 + i, t, "en", "s") for i, t in enumerate(planted.values())]
    got = {r["doc_id"]: r for r in mcd.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert {c for i, c in enumerate(planted) if got[1000 + i]["kept"] or got[1000 + i]["base_failed"]} == set()
    assert all(got[i]["kept"] for i, *_ in clean)


def test_small_groups_meet_a_wider_estimate(spark):
    """The same junk goes in groups of 30, 29 and 1 rows, and in a rare language."""
    rng = random.Random(6)
    vocab = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 8))) for _ in range(3000)]
    text = lambda: " ".join(rng.choices(vocab, k=int(rng.lognormvariate(5.6, 0.4)) + 50))
    junk = " ".join(w + "###" for w in rng.choices(vocab, k=200))
    groups = [("en", "big", 200), ("en", "host30", 29), ("en", "host29", 28), ("en", None, 0), (None, "x", 3), ("rare", "y", 2)]
    rows = [(text(), *g) for *g, n in groups for _ in range(n)] + [(junk, *g) for *g, _ in groups]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: r for r in mcd.judge(df).collect()}
    assert len(got) == len(rows) and all(r["distance"] is not None and not r["base_failed"] for r in got.values())
    assert [got[i]["kept"] for i in range(len(rows) - len(groups), len(rows))] == [False] * len(groups)
    assert all(got[i]["kept"] for i in range(len(rows) - len(groups)))
