"""Hard negatives against all scores, and the certain intervals."""

import math

import numpy as np
import pytest
from pyspark.sql import types as T

from finwater.llm import hard_negatives as hn
from finwater.llm import queries

SF = "/root/testdata/sf0.001"
SCHEMA = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())),
    T.StructField("label", T.IntegerType()), T.StructField("score", T.StringType()), T.StructField("block", T.StringType()),
])


def plain(rows, k=5, low=80, high=100):
    """All rows (id, vector, label) one by one, in integers."""
    ok = [
        (i, [math.floor(256 * x) for x in v], lab)
        for i, v, lab in rows
        if i is not None and v is not None and lab is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for at, (i, a, lab) in enumerate(ok):
        if i % 100:
            continue
        scored = [(sum(x * y for x, y in zip(a, v)), j, m) for p, (j, v, m) in enumerate(ok) if p != at and len(v) == len(a)]
        scored.sort(key=lambda r: (-r[0], r[1]))
        for p, j, _ in [r for r in scored if r[2] == lab][:k]:
            found = [r for r in scored if r[2] != lab and low * p <= high * r[0] <= high * p][:k]
            out += [(i, j, rank, n, p, s) for rank, (s, n, _) in enumerate(found, 1)]
    return sorted(out)


@pytest.mark.parametrize("dim", [1, 7, 64, 130])
def test_intervals_hold_every_score(dim):
    rng = np.random.default_rng(dim)
    x = np.concatenate([rng.normal(0, 200, (60, dim)), rng.normal(100, 5, (60, dim)), np.zeros((2, dim)), np.full((1, dim), 3)])
    x = np.floor(x).astype(np.int64)
    lower, upper = hn.Queries(x).bounds(hn.Codes.of(x))
    scores = x @ x.T
    assert (lower <= scores).all() and (scores <= upper).all()
    if dim == 64:  # and they tell near from far
        near = np.corrcoef(((lower + upper) / 2).ravel(), scores.ravel())[0, 1]
        assert near > 0.9 and (upper - lower).mean() < 1.5 * np.outer(*[np.linalg.norm(x, axis=1)] * 2).mean()


def test_rotation_is_one():
    turn = hn.rotation(33)
    assert np.allclose(turn @ turn.T, np.eye(33)) and (turn == hn.rotation(33)).all()


def test_query_equals_all_scores(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    moved = [(r["vec_id"], r["embedding"], (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"]) for r in rows]
    got = queries.op12_hard_negatives(spark, SF)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect())) == plain(moved)


def test_close_labels_in_small_blocks(spark):
    rng = np.random.default_rng(5)
    mean = rng.normal(0, 1, 16)
    rows = [(i, (mean + rng.normal(0, 0.15, 16)).tolist(), int(rng.integers(0, 3))) for i in range(700)]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(3)
    want = plain(rows)
    assert len(want) > 100
    for block, pack in ((hn.BLOCK, hn.PACK), (50, 2)):
        assert sorted(map(tuple, hn.mine(df, block=block, pack=pack).collect())) == want


def test_odd_rows_and_empty_table(spark):
    rng = np.random.default_rng(6)
    rows = [
        (0, [0.5, 0.5], 1), (1, [0.5, 0.5], 1), (2, [0.5, 0.5], 2), (2, [0.5, 0.5], 2), (3, [0.5, 0.5], 2), (4, [0.4, 0.5], 2),
        (5, None, 1), (6, [0.5, None], 2), (7, [float("nan"), 0.5], 2), (8, [float("inf"), 0.5], 2), (9, [0.5, 0.5], None),
        (None, [0.5, 0.5], 2), (100, [0.0, 0.0], 1), (100, [0.0, 0.0], 1), (101, [0.0, 0.0], 2), (200, [], 1), (201, [], 1), (202, [], 2),
        (300, [1.0, 2.0, 3.0], 1), (301, [1.0, 2.0, 3.0], 2), (400, [-0.3, -0.2], 5), (401, [0.3, 0.2], 5),
        *[(500 + i, rng.normal(0, 1, 2).tolist(), i % 2) for i in range(60)],
    ]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(4)
    want = plain(rows)
    assert sorted(map(tuple, hn.mine(df).collect())) == want
    assert sorted(map(tuple, hn.mine(df, block=3, pack=1).collect())) == want
    assert hn.mine(df.limit(0)).collect() == []
    assert hn.mine(df.filter("vec_id % 100 > 0")).collect() == []
    with pytest.raises(Exception, match="too large"):
        hn.mine(spark.createDataFrame([(0, [1e30], 1, "", "")], SCHEMA)).collect()


def test_most_pairs_are_scored_by_products(monkeypatch):
    """Vectors of one cluster: no interval drops a pair, and the work per pair
    must not be a gathered sum (it grew with anchors times rows)."""
    rng = np.random.default_rng(9)
    x = hn.integers((1 + rng.normal(0, 0.05, (1000, 64))).tolist())
    codes = hn.Codes.of(x)
    long = lambda v: np.asarray(v, dtype="<i8").tobytes()
    ids, labels = np.arange(1000), np.arange(1000) % 3
    block = {"dim": 64, "n": 1000, "keys": long(ids), "ids": long(ids), "labels": long(labels), "ints": x.astype("<i4").tobytes(),
             "words": codes.words.tobytes(), "norms": codes.norm.tobytes(), "aligns": codes.align.tobytes()}
    scores = x[:20] @ x.T
    top = [sorted((s for j, s in enumerate(row) if j != i and j % 3 == i % 3), reverse=True)[:5] for i, row in enumerate(scores.tolist())]
    pack = {"n": 20, "keys": long(ids[:20]), "labels": long(labels[:20]), "ints": x[:20].astype("<i4").tobytes(),
            "wanted": long([[*t, 5] for t in top])}
    gathered, whole = [], np.einsum
    monkeypatch.setattr(np, "einsum", lambda spec, a, b: gathered.append(len(a)) or whole(spec, a, b))
    best = hn.positives_in(hn._Step(block, pack), 5).to_pydict()
    assert best["score"] == [s for t in top for s in t]
    found = hn.negatives_in(hn._Step(block, pack), 5, 80, 100).to_pydict()
    want = [
        s for i, t in enumerate(top) for p in t
        for s in sorted((int(s) for j, s in enumerate(scores[i]) if j % 3 != i % 3 and 80 * p <= 100 * s <= 100 * p), reverse=True)[:5]
    ]
    assert found["score"] == want
    assert sum(gathered) <= 20 * 1000 / 16
