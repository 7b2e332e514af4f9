"""Tool-call linking against a plain walk; JSON and schema rules."""

import json
import random

import pytest

from finwater.llm import queries, toolcalls as tc

SF = "/root/testdata/sf0.001"
CALLS = "conv_id long, call_id string, position long, name string, arguments string, depends_on array<string>, level string"
RESULTS = "conv_id long, call_id string, position long, content string, status string"


def low(x):
    """Sort key that puts null first."""
    return (x is not None, x if x is not None else 0)


def brute(calls, results):
    """Rows (conv, id, level, position, status, n_calls, n_results, missing)
    from a walk of each identifier's events. Positions of a kind are unique
    inside an identifier, or the rows equal."""
    out, ids = [], {}
    for n, (c, i, p, *_) in enumerate(calls):
        if None in (c, i):
            out.append((c, i, None, p, "no_id", 1, 0, 0))
        else:
            ids.setdefault((c, i), []).append((low(p), 0, n))
    for n, (c, i, p, *_) in enumerate(results):
        if None in (c, i):
            out.append((c, i, None, p, "no_id", 0, 1, 0))
        else:
            ids.setdefault((c, i), []).append((low(p), 1, n))
    answered, alone = set(), {}
    for key, events in ids.items():
        rounds = []
        for _, kind, n in sorted(events):
            if not rounds or (kind == 0 and rounds[-1][1]):
                rounds.append(([], []))
            rounds[-1][kind].append(n)
        for at, (cs, rs) in enumerate(rounds):
            k, m = len(cs), len(rs)
            answered.update(cs[max(k - m, 0) :][:m])
            word = "extra" if k else "early" if at + 1 < len(rounds) else "orphan"
            alone.update({n: word for n in rs[k:]})
    deps, missing = {}, {}
    for n, (c, i, p, _, _, wanted, *_) in enumerate(calls):
        if None in (c, i):
            continue
        deps[n], missing[n] = set(), 0
        for d in {d for d in wanted or () if d is not None}:
            there = sorted((q, m) for q, kind, m in ids.get((c, d), ()) if kind == 0)
            earlier = [m for q, m in there if q < low(p)]
            if not there:
                missing[n] += 1
            else:
                deps[n].add(earlier[-1] if earlier else there[0][1])
    level, now = {}, 0
    while front := [n for n in deps if n not in level and all(level.get(d, now) < now for d in deps[n])]:
        level.update(dict.fromkeys(front, now))
        now += 1
    size = lambda key, kind: sum(e[1] == kind for e in ids[key])
    for n in deps:
        c, i, p, *_ = calls[n]
        said = "cycle" if n not in level else "answered" if n in answered else "unanswered"
        out.append((c, i, level.get(n), p, said, size((c, i), 0), size((c, i), 1), missing[n]))
    for n, said in alone.items():
        c, i, p, *_ = results[n]
        out.append((c, i, None, p, said, size((c, i), 0), size((c, i), 1), 0))
    return out


def random_records(n=80, names=12):
    rng = random.Random(12)
    ids = [f"c{i}" for i in range(names)] + [None]
    positions = [iter(rng.sample(range(200), 200)) for _ in range(2)]
    depends = lambda: rng.choice([None, [], [rng.choice(ids), rng.choice(ids)], [f"c{rng.randint(0, 9)}"], ["nope", "nope"]])
    calls = [
        (rng.choice([1, 2, None]), rng.choice(ids), next(positions[0]), rng.choice(["search", "fetch", None]),
         rng.choice(["{}", "", None, '{"url": "u", "mode": "raw"}']), depends(), "clash")
        for _ in range(n)
    ]
    results = [(rng.choice([1, 2, None]), rng.choice(ids + ["c99"]), next(positions[1]), rng.choice(["r", "", None]), "clash") for _ in range(n)]
    return calls, results


def slim(rows):
    return sorted(((r["conv_id"], r["call_id"], r["level"], r["position"], r["status"], r["n_calls"], r["n_results"], r["missing"]) for r in rows), key=str)


def linked(spark, calls, results, schemas=tc.TOOLS, **how):
    return tc.link(spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS), schemas, **how).collect()


@pytest.mark.parametrize("partitions", ["1", "8", "40"])
def test_linking_and_levels(spark, partitions):
    """Also with more partitions than identifiers: rounds span them."""
    calls, results = random_records()
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = linked(spark, calls, results)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    want = brute(calls, results)
    assert {w[4] for w in want} == {"answered", "unanswered", "cycle", "extra", "early", "orphan", "no_id"}
    assert slim(got) == sorted(want, key=str)
    assert all((r["valid"] is not True or r["error"] is None) for r in got)
    for r in got:
        message = json.loads(r["message"])
        assert tc.canonical(message) == r["message"] and message["id"] == r["call_id"]


def test_an_identifier_in_every_turn(spark):
    """Each call has its own result and its own validation; parallel calls of
    one identifier, a lost result and an extra one."""
    bodies = ['{"query": "q", "limit": 5}', '{"query": ""}', "{"]
    calls = [(1, "call_0", 4 * t, "search", bodies[t % 3], None, "") for t in range(30)]
    results = [(1, "call_0", 4 * t + 1, f"r{t}", "") for t in range(30) if t != 10] + [(1, "call_0", 82, "again", "")]
    calls += [(2, "call_0", p, "search", bodies[0], ["call_0"] if p else None, "") for p in range(3)]
    results += [(2, "call_0", 5 + p, f"p{p}", "") for p in range(3)]
    got = {(r["conv_id"], r["position"], r["status"]): r for r in linked(spark, calls, results)}
    body = lambda *k: json.loads(got[k]["message"])["result"]
    for t in range(30):
        said = "unanswered" if t == 10 else "answered"
        assert body(1, 4 * t, said) == (None if t == 10 else f"r{t}")
        assert got[1, 4 * t, said]["valid"] == (t % 3 == 0)
    assert body(1, 82, "extra") == "again" and len(got) == 31 + 3
    assert [body(2, p, "answered") for p in range(3)] == ["p0", "p1", "p2"]
    assert [got[2, p, "answered"]["level"] for p in range(3)] == [0, 1, 2]  # each on the one before it


def test_null_identifiers_stay(spark):
    calls = [(1, None, 0, "t", "{}", None, ""), (1, None, 0, "t", "{}", None, ""), (None, "a", 1, "t", "{", ["a"], "")]
    results = [(None, None, 2, "r", ""), (None, None, 2, "r", "")]
    got = linked(spark, calls, results, {"t": {}})
    assert [r["status"] for r in got] == ["no_id"] * 5 and sorted(str(r["valid"]) for r in got) == ["False", "None", "None", "True", "True"]


@pytest.mark.parametrize("max_edges,n", [(tc.MAX_EDGES, 1000), (3, 12)])
def test_long_chain_in_one_conversation(spark, max_edges, n):
    calls = [(7, f"c{i}", n - i, "t", "{}", [f"c{i - 1}"] if i else [], "") for i in range(n)]
    calls += [(8, "x", 0, "t", "{}", ["y"], ""), (8, "y", 1, "t", "{}", ["x"], ""), (8, "z", 2, "t", "{}", ["x", "w"], ""), (8, "w", 3, "t", "{}", [], "")]
    got = linked(spark, calls, [], {"t": {"type": "object"}}, max_edges=max_edges)
    assert {r["call_id"]: r["level"] for r in got} == {f"c{i}": i for i in range(n)} | {"x": None, "y": None, "z": None, "w": 0}


def test_empty_tables(spark):
    none, some = spark.createDataFrame([], CALLS), spark.createDataFrame([(1, "a", 1, "r", "")], RESULTS)
    assert tc.link(none, some.limit(0), tc.TOOLS).collect() == []
    assert [r["status"] for r in tc.link(none, some, tc.TOOLS).collect()] == ["orphan"]


def test_query(spark):
    """The derived records, call by call."""
    turns = spark.read.parquet(f"{SF}/conversations.parquet")
    calls, results = tc.derived_records(turns)
    rows = queries.op2_tool_calls(spark, SF).collect()
    want = brute([tuple(r) + ("",) for r in calls.collect()], [tuple(r) for r in results.collect()])
    assert slim(rows) == sorted(want, key=str)
    assert {r["status"] for r in rows} >= {"answered", "unanswered", "orphan"}
    text = {(r["conv_id"], r["turn"]): r["text"] for r in turns.collect()}
    for r in rows:
        if r["status"] == "answered":  # whole texts come through
            assert json.loads(r["message"])["result"] == text[r["conv_id"], int(r["call_id"][1:]) + 1]


def test_canonical_json():
    value = tc.parse('{"b": [1.0, 1e-7, 1E21, 0.1, -0.0, 123456789012345678901], "\\u00e9": "\\u2028\\n\\"", "a": {"z": null, "y": true}, "\U0001f600": 1, "～": 2}')
    assert tc.canonical(value) == (
        '{"a":{"y":true,"z":null},"b":[1,1e-7,1e+21,0.1,0,123456789012345678901],"é":" \\n\\"","\U0001f600":1,"～":2}'
    )
    assert tc.parse(tc.canonical(value)) == value
    for bad in ("", None, "{", '{"a":1,"a":2}', "NaN", "[1e999]", '"\\ud800"', "[" * 100_000 + "]" * 100_000, "1 2", "9" * 5000):
        with pytest.raises(tc.BadJson):
            tc.parse(bad)


def test_schema_rules():
    schema = tc.TOOLS["search"]
    assert tc.violation({"query": "q", "limit": 5}, schema) is None
    assert tc.violation({"query": "q", "limit": 5.0}, schema) is None
    for bad, said in (
        ([], "$: not object"), ({"limit": 1}, "$.query: missing"), ({"query": "", "limit": 1}, "$.query: too short"),
        ({"query": "q", "limit": True}, "$.limit: not integer"), ({"query": "q", "limit": 51}, "$.limit: above maximum"),
        ({"query": "q", "limit": 1, "x": 1}, "$.x: not allowed"),
    ):
        assert tc.violation(bad, schema) == said
    assert tc.violation({"terms": [1, "2"]}, tc.TOOLS["calculate"]) == "$.terms[1]: not number"
    assert tc.violation({"url": "u", "mode": "x"}, tc.TOOLS["fetch"]) == "$.mode: not in enum"
