"""Near-duplicate vectors against all pairs."""

import numpy as np
from pyspark.sql import types as T

from finwater.llm import projections

SF = "/root/testdata/sf0.1"
NOISE = 0.014  # per part of a unit vector of 64: copies at about 0.985 of each other


def usable(label, vec):
    return label is not None and vec is not None and len(vec) > 0 and all(x is not None and np.isfinite(x) for x in vec) and any(vec)


def brute(rows, threshold=0.98):
    """(id, n_links, component, kept) for (id, vec, label) rows."""
    n = len(rows)
    near = np.zeros((n, n), dtype=bool)
    blocks = {}
    for i, (ident, v, label) in enumerate(rows):
        if ident is not None and usable(label, v):
            blocks.setdefault((label, len(v)), []).append(i)
    for members in blocks.values():
        x = projections.unit([rows[i][1] for i in members])
        near[np.ix_(members, members)] = x @ x.T >= threshold
    np.fill_diagonal(near, False)
    ids = np.array([r[0] if r[0] is not None else 1 << 60 for r in rows])
    name = ids.copy()
    while True:
        new = np.minimum(name, np.where(near, name[None, :], 1 << 60).min(axis=1, initial=1 << 60))
        if (new == name).all():
            break
        name = new
    return [
        (r[0], int(near[i].sum()), None if r[0] is None else int(name[i]), r[0] is not None and r[0] == name[i]) for i, r in enumerate(rows)
    ]


def test_recall_on_the_table(spark):
    """The table's vectors, every third one with two noisy copies whose cosines
    lie on both sides of the threshold."""
    rng = np.random.default_rng(3)
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    copies = [
        (100_000 * k + i, (np.array(v) + NOISE * rng.standard_normal(len(v))).tolist(), label)
        for k in (1, 2) for i, v, label in rows[::3] if v is not None
    ]
    rows += copies
    want = {r[0]: r for r in brute(rows)}
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r[0]: tuple(r) for r in projections.near_duplicates(df).collect()}
    assert set(got) == set(want)
    links = sum(r[1] for r in want.values())
    assert links > 1000 and links < 6 * len(copies) / 2
    assert sum(min(got[i][1], want[i][1]) for i in want) >= 0.98 * links
    assert all(got[i][1] <= want[i][1] for i in want)  # no link below the threshold
    assert sum(got[i][2] == want[i][2] for i in want) >= 0.99 * len(want)


def test_dense_group_is_counted_whole(spark):
    """A group far larger than the window, beside loose vectors and copies."""
    rng = np.random.default_rng(8)
    centre = rng.standard_normal(16)
    rows = [(i, (centre + 0.02 * rng.standard_normal(16)).tolist(), 1) for i in range(400)]
    rows += [(1000 + i, rng.standard_normal(16).tolist(), int(i % 3)) for i in range(300)]
    rows += [(2000 + i, rows[3][1], 1) for i in range(50)] + [(3000 + i, rows[3][1], 2) for i in range(3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = projections.near_duplicates(df, window=4, chunk=64).collect()
    assert sorted(map(tuple, got)) == sorted(brute(rows))


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [2.0, 0.0], 1), (4, [1.0, 0.0], 2), (5, [1.0, 0.0], None), (6, None, 1),
        (7, [0.0, 0.0], 1), (8, [None, 1.0], 1), (9, [nan, 1.0], 1), (10, [inf, 1.0], 1), (11, [], 1), (12, [1.0, 0.0, 0.0], 1),
        (13, [1.0], 1), (None, [1.0, 0.0], 1), (None, None, None), (14, [-1.0, 0.0], 1), (15, [1e300, 1e298], 1), (16, [1e-30, 0.0], 1),
        (2, [1.0, 0.0], 1), (17, [0.0, 1.0], 1), (2, [0.0, 1.0], 1),
    ]
    schema = T.StructType([
        T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())), T.StructField("label", T.IntegerType()),
        T.StructField("cls", T.StringType()), T.StructField("kept", T.StringType()),
    ])
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], schema)
    got = projections.near_duplicates(df).collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute(rows), key=str)
    assert projections.near_duplicates(df.limit(0)).collect() == []
