"""Not-modified revisits resolved to the full responses they stand for.

Capture records are responses (status 200, a payload) and revisits (status
304, no payload). A revisit is joined as of its time to the latest strictly
earlier full response of the same canonical url; its validators are checked,
and the response's headers are merged with those that a 304 may update.

The as-of join is two windows instead of one sort per url: within (url, time
slot) the latest response before each record, and over a url's slots the
latest response of earlier slots, found on one row per slot. A url that holds
a third of all rows is thus split by time, and only slim rows (identifiers,
validators, headers) are moved.

Canonical url: scheme, fragment, default port and tracking parameters dropped,
host lower-cased in A-Z, query parameters sorted, trailing slashes dropped.

Outcomes: ``resolved``; ``mismatch`` (validators differ); ``unverified``
(nothing to compare); ``no_response`` (no earlier full response). An entity
tag decides if both sides have one (weak comparison), else the modification
time. Merged headers are given for resolved revisits only.

Cases: null urls are canonically empty and match nothing; null times match
nothing. Responses without payload or status 200 are no targets. Of responses
at the same time the one with the greatest record id is the latest; repeated
rows are each resolved. Null headers count as none. An empty table gives an
empty result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .base import col

#: Headers that a 304 response may carry to update a stored one.
PERMITTED = ["cache-control", "content-location", "date", "etag", "expires", "vary"]
#: Query parameters that only track the visitor.
TRACKING = "^(utm_.*|gclid|fbclid|ref)$"
#: Seconds of a time slot.
SLOT = 86_400
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def canonical(url: Column) -> Column:
    text = F.regexp_replace(F.coalesce(url.cast("string"), F.lit("")), r"#[\s\S]*$", "")
    rest = F.regexp_replace(text, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_extract(rest, r"^([^/?]*)", 1)
    host = F.regexp_replace(F.translate(host, UPPER, UPPER.lower()), r":(80|443)?$", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.regexp_extract(rest, r"^[^?]*\?([\s\S]*)$", 1)
    kept = F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.regexp_like(F.substring_index(p, "=", 1), F.lit(TRACKING)))
    query = F.array_join(F.array_sort(kept), "&")
    return F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")))


def _tag(c: str) -> Column:
    return F.regexp_replace(F.col(c), "^W/", "")


def _merged(old: Column, new: Column) -> Column:
    """Response headers without those that the revisit updates, and the
    revisit's permitted ones, names in lower case, in the order of names."""
    none = F.array().cast("array<struct<name:string,value:string>>")
    low = lambda h: F.lower(h["name"])
    allowed = F.filter(F.coalesce(new, none), lambda h: low(h).isin(PERMITTED))
    updated = F.transform(allowed, low)
    stay = F.filter(F.coalesce(old, none), lambda h: ~F.array_contains(updated, low(h)))
    both = F.concat(stay, allowed)
    return F.array_sort(F.transform(both, lambda h: F.struct(low(h).alias("name"), h["value"].alias("value"))))


def resolve(records: DataFrame, *, slot: int = SLOT) -> DataFrame:
    """One row per revisit of ``records`` (record_id, url, ts: seconds, kind,
    status, etag, last_modified, headers: array of (name, value), payload):
    record_id, canonical_url, ts, outcome, target_id, headers, payload_md5."""
    named = ["record_id", "url", "ts", "kind", "status", "etag", "last_modified", "headers", "payload"]
    r = records.select(*[col(c) for c in named])
    full = (F.col("kind") == "response") & (F.col("status") == 200) & F.col("payload").isNotNull() & F.col("ts").isNotNull()
    target = F.struct(
        F.col("ts"), F.col("record_id"), F.col("etag"), F.col("last_modified"), F.col("headers"), F.md5(F.col("payload")).alias("md5")
    )
    r = r.select(
        "record_id", canonical(F.col("url")).alias("canonical_url"), "ts", "kind", "etag", "last_modified", "headers",
        F.when(F.coalesce(full, F.lit(False)) & (canonical(F.col("url")) != ""), target).alias("full"),
    ).filter((F.col("kind") == "revisit") | F.col("full").isNotNull())
    r = r.withColumn("slot", F.floor(F.col("ts") / slot))
    # per slot its latest response (combined before the shuffle), then the latest of earlier slots
    last = r.groupBy("canonical_url", "slot").agg(F.max_by("full", F.struct("full.ts", "full.record_id")).alias("own"))
    slots = Window.partitionBy("canonical_url").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    earlier = last.select(
        F.col("canonical_url").alias("_u"), F.col("slot").alias("_slot"), F.last("own", ignorenulls=True).over(slots).alias("before")
    )
    within = Window.partitionBy("canonical_url", "slot").orderBy("ts").rangeBetween(Window.unboundedPreceding, -1)
    r = r.withColumn("inside", F.max_by("full", F.struct("full.ts", "full.record_id")).over(within)).filter(F.col("kind") == "revisit")
    on = (F.col("canonical_url") == F.col("_u")) & F.col("slot").eqNullSafe(F.col("_slot"))
    found = F.when(F.col("ts").isNotNull() & (F.col("canonical_url") != ""), F.coalesce("inside", "before"))
    r = r.join(earlier, on, "left").withColumn("t", found)
    tags = F.col("etag").isNotNull() & F.col("t.etag").isNotNull()
    times = F.col("last_modified").isNotNull() & F.col("t.last_modified").isNotNull()
    outcome = (
        F.when(F.col("t").isNull(), "no_response")
        .when(tags, F.when(_tag("etag") == _tag("t.etag"), "resolved").otherwise("mismatch"))
        .when(times, F.when(F.col("last_modified") == F.col("t.last_modified"), "resolved").otherwise("mismatch"))
        .otherwise("unverified")
    )
    done = r.withColumn("outcome", outcome)
    return done.select(
        "record_id", "canonical_url", "ts", "outcome", F.col("t.record_id").alias("target_id"),
        F.when(F.col("outcome") == "resolved", _merged(F.col("t.headers"), F.col("headers"))).alias("headers"),
        F.when(F.col("outcome") == "resolved", F.col("t.md5")).alias("payload_md5"),
    )


def with_payload(resolved: DataFrame, records: DataFrame) -> DataFrame:
    """Adds the target's ``payload`` to resolved revisits."""
    own = records.filter(F.col("kind") == "response").select(F.col("record_id").alias("_id"), "payload")
    target = F.when(F.col("outcome") == "resolved", F.col("target_id"))
    return resolved.join(own, target == F.col("_id"), "left").drop("_id")


def capture_records(pages: DataFrame) -> DataFrame:
    """Capture records derived from raw pages by a fixed rule: of every page
    one full response and three revisits in other spellings of its url, one
    with its validators, one with a stale or no entity tag, one of which every
    seventh lies before the response."""
    html = F.coalesce(F.col("html"), F.lit(""))
    tag = F.concat(F.lit('"'), F.substring(F.md5(html), 1, 16), F.lit('"'))
    modified = F.concat(F.lit("day "), (F.col("page_id") % 28).cast("string"))
    start = F.col("page_id") * 1000
    h = lambda *pairs: F.array(*[F.struct(F.lit(n).alias("name"), v.cast("string").alias("value")) for n, v in pairs])
    plain = F.regexp_replace(F.col("url"), r"[?#].*$", "")
    third = F.col("page_id") % 3
    null = F.lit(None).cast("string")
    names = ["record_id", "url", "ts", "kind", "status", "etag", "last_modified", "headers", "payload"]
    record = lambda *values: F.struct(*[v.alias(n) for n, v in zip(names, values)])
    revisit = (F.lit("revisit"), F.lit(304))
    rows = F.array(
        record(
            F.col("page_id") * 4, F.col("url"), start, F.lit("response"), F.lit(200), tag, modified,
            h(("Content-Type", F.lit("text/html")), ("ETag", tag), ("Content-Length", F.length(html)), ("Cache-Control", F.lit("max-age=60"))),
            F.col("html"),
        ),
        record(
            F.col("page_id") * 4 + 1, F.concat(plain, F.lit("?utm_medium=crawl#again")), start + 90_000, *revisit, F.concat(F.lit("W/"), tag), null,
            h(("cache-control", F.lit("max-age=600")), ("Date", start + 90_000), ("Set-Cookie", F.lit("a=1"))), null,
        ),
        record(
            F.col("page_id") * 4 + 2, plain, start + 40, *revisit, F.when(third == 0, F.lit('"stale"')), F.when(third == 1, modified),
            h(("Expires", start + 500), ("Content-Length", F.lit(0))), null,
        ),
        record(
            F.col("page_id") * 4 + 3, F.col("url"), F.when(F.col("page_id") % 7 == 0, start - 5).otherwise(start + 200_000), *revisit, tag, modified,
            h(("Vary", F.lit("Accept")), ("vary", F.lit("Origin"))), null,
        ),
    )
    return pages.select(F.explode(rows).alias("r")).select("r.*")


__all__ = ["canonical", "capture_records", "resolve", "with_payload"]
