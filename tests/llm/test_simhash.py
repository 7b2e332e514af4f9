"""SimHash linking against all pairs."""

import random
from itertools import combinations

import numpy as np
import pytest
import xxhash
from odd import TEXTS, documents

from finwater.llm import queries, simhash
from finwater.llm.components import components

SF = "/root/testdata/sf0.001"


def brute_fp(text, k=3):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    parts = [b" ".join(w[i : i + k]) for i in range(max(1, len(w) - k + 1))]
    h = [xxhash.xxh64_intdigest(p, seed=42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, radius=3):
    """Index of each value's component: the least index reachable."""
    v = np.array(fps, dtype=np.uint64)
    near = np.bitwise_count(v[:, None] ^ v[None, :]) <= radius
    label = np.arange(len(v))
    while True:
        new = np.where(near, label[None, :], len(v)).min(axis=1)
        if (new == label).all():
            return label
        label = new


def brute(rows):
    fps = [brute_fp(t) for _, t in rows]
    label = brute_components(fps) if rows else []
    name = {}
    for (i, _), c in zip(rows, label):
        if i is not None:
            name[c] = min(name.get(c, i), i)
    return [(i, format(f, "016x"), name.get(c)) for (i, _), f, c in zip(rows, fps, label)]


def test_query_equals_all_pairs(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert sorted(map(tuple, queries.op9_simhash(spark, SF).collect())) == sorted(brute(rows))


def test_odd_rows(spark):
    found = simhash.near_duplicates(documents(spark)).select("doc_id", "fingerprint", "component_id")
    assert sorted(map(tuple, found.collect()), key=str) == sorted(brute([(i, t) for i, t, *_ in TEXTS]), key=str)
    assert simhash.near_duplicates(documents(spark).limit(0)).collect() == []


def test_keep_first(spark):
    df = documents(spark)
    kept = simhash.keep_first(df)
    assert kept.columns == df.columns and kept.dtypes == df.dtypes
    got = [(r["doc_id"], r["text"]) for r in kept.collect()]
    groups = {}
    for (i, f, c), (_, text) in zip(brute([(i, t) for i, t, *_ in TEXTS]), [(i, t) for i, t, *_ in TEXTS]):
        groups.setdefault((c, f if c is None else None), []).append((i, text))
    assert len(got) == len(groups)
    for (c, _), members in groups.items():
        assert sum((i, t) in got for i, t in {(i, t) for i, t in members if i == c}) == 1
    assert simhash.keep_first(df.limit(0)).collect() == []


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_masks_cover(radius):
    rng = random.Random(radius)
    for bits in (list(range(64)), sorted(rng.sample(range(64), 20)), [3, 5, 9]):
        masks = simhash.cover(bits, radius)
        assert len(masks) == 2 ** (radius + 1) - 1
        sets = combinations(bits, min(radius, len(bits)))
        for diff in list(sets) if len(bits) <= 20 else (rng.sample(bits, radius) for _ in range(3000)):
            assert any(not any(m >> b & 1 for b in diff) for m in masks)


def test_crowded_buckets(spark):
    """Thousands of values around one centre: buckets split over all levels."""
    rng = random.Random(5)
    centre = rng.getrandbits(64)
    values = {centre}
    while len(values) < 1500:
        v = centre
        for b in rng.sample(range(64), rng.choice([1, 2, 2, 5, 6])):
            v ^= 1 << b
        values.add(v)
    values |= {rng.getrandbits(64) for _ in range(200)}
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    fps = spark.createDataFrame([(s,) for s in signed], "fp long")
    roots = {r["node"]: r["root"] for r in components(simhash.links(fps, 3, bucket=8)).collect()}
    label = brute_components(values)
    mine = {}
    for s, c in zip(signed, label):
        mine.setdefault(c, []).append(s)
    for group in mine.values():
        assert {roots.get(s, s) for s in group} == {min(group)}


def test_components_chain_and_odd_edges(spark):
    chain = [(i, i + 1) for i in range(300)] + [(5, 5), (None, 7), (1000, 1001), (1001, 1000)]
    random.Random(1).shuffle(chain)
    got = dict(map(tuple, components(spark.createDataFrame(chain, "a long, b long")).collect()))
    assert got == {**{i: 0 for i in range(301)}, 1000: 1000, 1001: 1000}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_keep_first_with_ids_on_unrelated_texts(spark):
    """An id that names two groups keeps a row in each; one that also lies in
    another's group goes there."""
    texts = [" ".join(f"{w}{i}" for i in range(60)) for w in ("red", "sea", "oak")]
    rows = [(1, texts[0]), (1, texts[1]), (2, texts[2]), (5, texts[2]), (5, "something else " + texts[0][::-1]), (5, texts[0])]
    kept = simhash.keep_first(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, kept)) == sorted([rows[0], rows[1], rows[2], rows[4]])
