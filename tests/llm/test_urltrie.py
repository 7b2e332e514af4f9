"""The url trie against a scan of all entries, and against its join form."""

import random

import pytest

from finwater.llm import queries, urltrie

SF = "/root/testdata/sf0.001"


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = lambda s, marks: s[: min([s.find(m) for m in marks if m in s], default=len(s))]
    host = cut(rest, "/?#")
    return host.encode().lower().decode(), cut(rest[len(host) :], "?#")


def brute(url, entries, default="allow"):
    host, path = parts(url)
    fits = [
        (h.count("."), len(p), h + p, v)
        for (h, p), v in entries.items()
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=(0, 0, None, default))
    return host, path, best[2], best[3]


def urls():
    rng = random.Random(3)
    labels, segments = ["a", "B", "c", "ab"], ["x", "y", "xy", ""]
    out = [None, "", "no url", "://", "http://", "http://A.b?q=/x", "http://a#/x", "http://É.COM/Ä/", "http://a\n.b/x\ny?z", "a://b://c/x"]
    for _ in range(400):
        host = ".".join(rng.choices(labels, k=rng.randint(1, 4)))
        out.append(f"http://{host}/" + "/".join(rng.choices(segments, k=rng.randint(0, 3))) + rng.choice(["", "?x=/y", "#/x"]))
    return out


RULES = [
    ("allow", "a", ""), ("block", "b.a", "/x"), ("allow", "b.a", "/x/"), ("block", "C", "/"), ("allow", "ab.c", "/xy/y"),
    ("block", "c.c", "/x/y/"), ("allow", "b.a", "/x"[:1]), ("block", "a.b.a", ""), ("allow", "é.com", "/"), ("block", "ab", "//"),
]


@pytest.mark.parametrize("limit", [urltrie.MAX_ENTRIES, 0])
def test_against_all_entries(spark, limit):
    rows = [(i, u, "clash") for i, u in enumerate(urls())]
    df = spark.createDataFrame(rows, "page_id long, url string, rule string")
    rules = [r for r in RULES if r[1] != "é.com"]
    got = {r["page_id"]: tuple(r)[1:] for r in urltrie.judge(df, rules, keep=["page_id"], max_entries=limit).collect()}
    entries = urltrie.entries_of(rules)
    assert got == {i: brute(u, entries) for i, u, _ in rows}


def test_bad_lists():
    with pytest.raises(ValueError):
        urltrie.entries_of([("allow", "a", "/"), ("block", "A", "/")])
    with pytest.raises(ValueError):
        urltrie.entries_of([("allow", None, "/")])


def test_empty_and_null_ids(spark):
    df = spark.createDataFrame([(None, "http://x.com/"), (None, "http://x.com/")], "page_id long, url string")
    assert [tuple(r) for r in urltrie.judge(df, queries.URL_RULES, keep=["page_id"]).collect()] == [(None, "x.com", "/", "com/", "allow")] * 2
    assert urltrie.judge(df.limit(0), queries.URL_RULES, keep=["page_id"]).collect() == []
