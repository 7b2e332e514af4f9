"""Apportionment against plain versions; totals, spans and awkward rows."""

import heapq
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from odd import TEXTS, documents

from finwater.llm import apportion, queries

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(t):
    return WORD.findall(t or "")


def one_by_one(votes, seats, caps):
    """Highest quotients dealt seat by seat."""
    out = [0] * len(votes)
    heap = [(-v, i) for i, v in enumerate(votes) if v > 0 and caps[i] > 0]
    heapq.heapify(heap)
    for _ in range(seats):
        if not heap:
            break
        _, i = heapq.heappop(heap)
        out[i] += 1
        if out[i] < caps[i]:
            heapq.heappush(heap, (-votes[i] / (2 * out[i] + 1), i))
    return out


def test_quotas_equal_seat_by_seat():
    rng = random.Random(6)
    for _ in range(200):
        n = rng.randint(1, 12)
        votes = [rng.choice([0, 1, 1, 5, rng.random() * 50, rng.randint(1, 2000)]) for _ in range(n)]
        caps = [rng.randint(0, 300) for _ in range(n)]
        seats = rng.randint(0, 600)
        if max(votes) and max(caps):
            assert apportion.sainte_lague(np.array(votes), seats, np.array(caps)).tolist() == one_by_one(votes, seats, caps)


def test_targets():
    assert apportion.targets([100, 100, 100], [5, 2, 1]) == [200.0, pytest.approx(500 / 3), pytest.approx(250 / 3)]
    assert apportion.targets([0, 10], [5, 2]) == [0, 15]
    assert apportion.targets([], []) == []
    sizes, weights = [7, 900, 30, 0, 55], [5, 2, 1, 5, 2]
    t = apportion.targets(sizes, weights)
    assert sum(t) == pytest.approx(1.5 * sum(sizes)) and all(x <= 2 * s + 1e-9 for x, s in zip(t, sizes))
    free = [x / w for x, s, w in zip(t, sizes, weights) if x < 2 * s - 1e-9]
    assert max(free) - min(free) < 1e-9  # those not stopped share by weight


def check(rows, sources):
    """rows: (id, size, source_size, target, taken) by source."""
    per = defaultdict(list)
    for r, s in zip(rows, sources):
        per[s].append(r)
    order = sorted(per, key=lambda s: (s is None, s or ""))
    sizes = [sum(r[1] for r in per[s]) for s in order]
    want = apportion.targets(sizes, [apportion.WEIGHTS[i % 3] for i in range(len(order))])
    for s, size, target in zip(order, sizes, want):
        assert {r[2] for r in per[s]} == {size}
        assert all(r[3] == pytest.approx(target) and 0 <= r[4] <= 2 * r[1] for r in per[s])
        assert abs(sum(r[4] for r in per[s]) - target) <= 2 * apportion.BLOCK_WORDS


def test_query(spark):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = [tuple(r) for r in queries.op6_source_mix(spark, SF).collect()]
    assert Counter(r[0] for r in rows) == Counter(docs.keys())
    assert all(r[1] == len(words(docs[r[0]]["text"])) for r in rows)
    check(rows, [docs[r[0]]["source"] for r in rows])
    assert sorted(rows) == sorted(map(tuple, queries.op6_source_mix(spark, SF).collect()))


def test_odd_rows(spark):
    df = documents(spark)
    mixed = apportion.mix(df, keep=["doc_id", "source"]).drop("place").collect()
    assert len(mixed) == len(TEXTS)
    check([(r[0], *r[2:]) for r in mixed], [r[1] for r in mixed])
    assert apportion.mix(df.limit(0)).collect() == []
    assert apportion.materialise(df.limit(0)).collect() == []


@pytest.mark.parametrize("shard_docs", [1000, 7])
def test_materialised_words_are_those_taken(spark, shard_docs):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    mixed = apportion.mix(docs, shard_docs=shard_docs)
    taken = {r["doc_id"]: r["taken"] for r in mixed.collect()}
    made = apportion.materialise(docs, length_col="n_chars", shard_docs=shard_docs)
    assert made.columns == docs.columns
    got, copies = defaultdict(int), Counter()
    for r in made.collect():
        got[r["doc_id"]] += len(words(r["text"]))
        copies[r["doc_id"]] += 1
        assert r["n_chars"] == len(r["text"])
        for line in r["text"].split("\n"):
            assert line in text[r["doc_id"]]
    assert {i: n for i, n in taken.items() if n} == dict(got) and max(copies.values()) <= 2


def test_every_quota_is_spent_exactly():
    """The permutation takes as many blocks as the rest asks for."""
    for n in range(1, 60):
        a = apportion._multiplier(n, 12_345)
        for c, rest in ((0, n // 2), (n - 1, n // 3)):
            assert sum((a * i + c) % n < rest for i in range(n)) == rest
