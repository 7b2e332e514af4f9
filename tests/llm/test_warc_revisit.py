"""Revisit resolution against a plain search over all records."""

import random

from pyspark.sql import functions as F

from finwater.llm import warc_revisit as wr

SCHEMA = (
    "record_id long, url string, ts long, kind string, status int, etag string, last_modified string, "
    "headers array<struct<name:string,value:string>>, payload string, canonical_url string"
)


def brute(records, canon):
    out = []
    for i, url, ts, kind, _, etag, lm, headers, *_ in records:
        if kind != "revisit":
            continue
        best = None
        for r in records:
            ok = r[3] == "response" and r[4] == 200 and r[8] is not None and canon[r[0]] and canon[r[0]] == canon[i]
            if ok and ts is not None and r[2] is not None and r[2] < ts and (best is None or (r[2], r[0]) > (best[2], best[0])):
                best = r
        weak = lambda t: t.removeprefix("W/")
        if best is None:
            said = "no_response"
        elif etag is not None and best[5] is not None:
            said = "resolved" if weak(etag) == weak(best[5]) else "mismatch"
        elif lm is not None and best[6] is not None:
            said = "resolved" if lm == best[6] else "mismatch"
        else:
            said = "unverified"
        merged = None
        if said == "resolved":
            new = [(n.lower(), v) for n, v in headers or [] if n.lower() in wr.PERMITTED]
            old = [(n.lower(), v) for n, v in best[7] or [] if n.lower() not in {n for n, _ in new}]
            merged = sorted(old + new)
        out.append((i, canon[i], ts, said, best and best[0], merged))
    return out


def run(spark, records, slot):
    df = spark.createDataFrame(records, SCHEMA)
    canon = {r[0]: r[1] for r in df.select("record_id", wr.canonical(F.col("url"))).collect()}
    found = wr.resolve(df, slot=slot)
    got = [
        (r["record_id"], r["canonical_url"], r["ts"], r["outcome"], r["target_id"], r["headers"] and [tuple(h) for h in r["headers"]])
        for r in found.collect()
    ]
    assert sorted(got, key=str) == sorted(brute(records, canon), key=str)
    return df, found


def records():
    rng = random.Random(9)
    urls = ["http://A.com/x", "https://a.com/x/", "a.com/x?utm_source=1#f", "http://a.com:80/x", "http://a.com/x?b=2&a=1", "http://a.com/x?a=1&b=2", None, ""]
    out = []
    for i in range(250):
        full = rng.random() < 0.35
        tag = rng.choice(['"1"', 'W/"1"', '"2"', None])
        headers = rng.choice([None, [], [("ETag", "e"), ("Server", f"s{i}"), ("Vary", "x")], [("date", str(i)), ("DATE", "2"), ("set-cookie", "c")]])
        out.append((
            i, rng.choice(urls), rng.choice([None, *range(0, 60)]), "response" if full else "revisit", rng.choice([200, 200, 404]) if full else 304,
            tag, rng.choice(["m1", "m2", None]), headers, rng.choice(["body", "", None]) if full else None, "clash",
        ))
    return out


def test_against_all_records(spark):
    """Slots far smaller and far larger than the span of times."""
    for slot in (7, 86_400):
        df, found = run(spark, records(), slot)
    whole = wr.with_payload(found, df).collect()
    assert all((r["payload"] is not None) == (r["outcome"] == "resolved") for r in whole)


def test_repeated_rows_and_empty(spark):
    rows = records()[:40]
    assert wr.resolve(spark.createDataFrame(rows, SCHEMA).limit(0)).collect() == []
    twice = spark.createDataFrame(rows + rows, SCHEMA)
    assert wr.resolve(twice).count() == 2 * sum(r[3] == "revisit" for r in rows)


def test_canonical(spark):
    cases = {
        "HTTP://WWW.Ex.com:443/A/?utm_x=1&z=1&a#q": "www.ex.com/A?a&z=1", "ex.com": "ex.com", "http://ex.com/?": "ex.com",
        "http://ex.com?q=%20&ref=b&&c=d": "ex.com?c=d&q=%20", "https://ex.com:8080//": "ex.com:8080", "": "", None: "",
    }
    df = spark.createDataFrame([(u,) for u in cases], "u string")
    assert {r[0]: r[1] for r in df.select("u", wr.canonical(F.col("u"))).collect()} == cases
