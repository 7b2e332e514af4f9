"""Queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finwater.session import shared_scratch
from finwater.sources.tables import read_table

from . import apportion, bytebpe, cross_align, hard_negatives, huffman, katz, langid, mcd, projections, simhash, toolcalls, urltrie, warc_revisit

RANKS = "byte_bpe_multi_50k.tiktoken"
#: The two tokenizers that are aligned.
ALIGN_A, ALIGN_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Tokenizer and end id of the id files.
ID_TOKENIZER, END_ID = "byte_bpe_50k.json", 2
#: Longest n-grams of the Katz query.
KATZ_ORDER = 3

#: Fixed values of the url query: verdict, host, path.
URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def bpe_digests(docs: DataFrame) -> DataFrame:
    coded = bytebpe.encode(
        docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, keep=["doc_id"], decoded=True
    )
    return coded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op1_katz(spark: SparkSession, sf: str) -> DataFrame:
    return katz.score(katz.fit(read_table(spark, sf, "documents"), order=KATZ_ORDER), spark)


def op2_tool_calls(spark: SparkSession, sf: str) -> DataFrame:
    calls, results = toolcalls.derived_records(read_table(spark, sf, "conversations"))
    return toolcalls.link(calls, results, toolcalls.TOOLS)


def op3_quality_outliers(spark: SparkSession, sf: str) -> DataFrame:
    return mcd.judge(read_table(spark, sf, "documents"))


def op4_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents")
    marked = docs.select("doc_id", "text", langid.held_out().alias("held_out"))
    return langid.predict(marked, langid.fit(docs), keep=["doc_id", "held_out"])


def op5_warc_revisit(spark: SparkSession, sf: str) -> DataFrame:
    found = warc_revisit.resolve(warc_revisit.capture_records(read_table(spark, sf, "pages")))
    shown = F.array_join(F.transform("headers", lambda h: F.concat(h["name"], F.lit("="), h["value"])), "|")
    return found.withColumn("headers", shown)


def op6_source_mix(spark: SparkSession, sf: str) -> DataFrame:
    return apportion.mix(read_table(spark, sf, "documents"), keep=["doc_id"]).drop("place")


def op9_simhash(spark: SparkSession, sf: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf, "documents"), shingle=3, radius=3)
    return found.select("doc_id", "fingerprint", "component_id")


def op7_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    return bpe_digests(read_table(spark, sf, "documents"))


def op8_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    return urltrie.judge(read_table(spark, sf, "pages"), URL_RULES, keep=["page_id"])


OP8_SQL = r"""
WITH p AS (
  SELECT page_id, CASE WHEN instr(coalesce(url, ''), '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
u AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^([^/?#]*)([^?#]*)', 2) AS path FROM p),
r(verdict, rhost, rpath) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
  ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
pairs AS (SELECT DISTINCT host, path FROM u),
m AS (
  SELECT host, path, arg_max(r.rhost || r.rpath, length(r.rhost) * 100000 + length(r.rpath)) AS rule,
         arg_max(r.verdict, length(r.rhost) * 100000 + length(r.rpath)) AS verdict
  FROM pairs JOIN r ON (host = r.rhost OR ends_with(host, '.' || r.rhost)) AND starts_with(path, r.rpath)
  GROUP BY host, path)
SELECT page_id, u.host, u.path, m.rule, coalesce(m.verdict, 'allow') AS verdict
FROM u LEFT JOIN m ON u.host = m.host AND u.path = m.path
"""


def op10_projection_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return projections.near_duplicates(read_table(spark, sf, "embeddings"), threshold=0.98)


OP5_SQL = r"""
WITH b AS (
  SELECT page_id, url, html, '"' || substr(md5(coalesce(html, '')), 1, 16) || '"' AS tag, 'day ' || (page_id % 28) AS modified,
         page_id * 1000 AS start, regexp_replace(url, '[?#].*$', '') AS plain, length(coalesce(html, '')) AS n FROM pages),
caps AS (
  SELECT page_id * 4 AS record_id, url, start AS ts, 'response' AS kind, tag AS etag, modified AS lm,
    [{'name': 'content-type', 'value': 'text/html'}, {'name': 'etag', 'value': tag},
     {'name': 'content-length', 'value': n::VARCHAR}, {'name': 'cache-control', 'value': 'max-age=60'}] AS headers,
    html AS payload FROM b
  UNION ALL
  SELECT page_id * 4 + 1, plain || '?utm_medium=crawl#again', start + 90000, 'revisit', 'W/' || tag, NULL,
    [{'name': 'cache-control', 'value': 'max-age=600'}, {'name': 'date', 'value': (start + 90000)::VARCHAR},
     {'name': 'set-cookie', 'value': 'a=1'}], NULL FROM b
  UNION ALL
  SELECT page_id * 4 + 2, plain, start + 40, 'revisit', CASE WHEN page_id % 3 = 0 THEN '"stale"' END,
    CASE WHEN page_id % 3 = 1 THEN modified END,
    [{'name': 'expires', 'value': (start + 500)::VARCHAR}, {'name': 'content-length', 'value': '0'}], NULL FROM b
  UNION ALL
  SELECT page_id * 4 + 3, url, CASE WHEN page_id % 7 = 0 THEN start - 5 ELSE start + 200000 END, 'revisit', tag, modified,
    [{'name': 'vary', 'value': 'Accept'}, {'name': 'vary', 'value': 'Origin'}], NULL FROM b),
cut AS (
  SELECT *, regexp_replace(regexp_replace(coalesce(url, ''), '#[\s\S]*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS rest FROM caps),
parts AS (
  SELECT *, regexp_replace(translate(regexp_extract(rest, '^([^/?]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      ':(80|443)?$', '') || regexp_replace(regexp_extract(rest, '^[^/?]*([^?]*)', 1), '/+$', '') AS page,
    array_to_string(list_sort(list_filter(string_split(regexp_extract(rest, '^[^?]*\?([\s\S]*)$', 1), '&'),
      lambda p: p <> '' AND NOT regexp_matches(split_part(p, '=', 1), '^(utm_.*|gclid|fbclid|ref)$'))), '&') AS query FROM cut),
named AS (SELECT * EXCLUDE (rest, page, query), page || CASE WHEN query <> '' THEN '?' || query ELSE '' END AS canonical_url FROM parts),
full_ AS (
  SELECT canonical_url, ts, max(record_id) AS target_id, arg_max(etag, record_id) AS t_etag, arg_max(lm, record_id) AS t_lm,
    arg_max(headers, record_id) AS t_headers, arg_max(payload, record_id) AS t_payload
  FROM named WHERE kind = 'response' AND payload IS NOT NULL AND canonical_url <> '' GROUP BY canonical_url, ts),
found AS (
  SELECT r.record_id, r.canonical_url, r.ts, r.headers, f.target_id, f.t_headers, f.t_payload,
    CASE WHEN f.target_id IS NULL THEN 'no_response'
         WHEN r.etag IS NOT NULL AND t_etag IS NOT NULL THEN
           CASE WHEN regexp_replace(r.etag, '^W/', '') = regexp_replace(t_etag, '^W/', '') THEN 'resolved' ELSE 'mismatch' END
         WHEN r.lm IS NOT NULL AND t_lm IS NOT NULL THEN CASE WHEN r.lm = t_lm THEN 'resolved' ELSE 'mismatch' END
         ELSE 'unverified' END AS outcome
  FROM (SELECT * FROM named WHERE kind = 'revisit') r ASOF LEFT JOIN full_ f ON r.canonical_url = f.canonical_url AND r.ts > f.ts),
ok AS (
  SELECT *, list_filter(headers, lambda h: list_contains(['cache-control', 'content-location', 'date', 'etag', 'expires', 'vary'], h.name)) AS new_ FROM found)
SELECT record_id, canonical_url, ts, outcome, target_id,
  CASE WHEN outcome = 'resolved' THEN array_to_string(list_transform(list_sort(list_concat(
    list_filter(t_headers, lambda h: NOT list_contains(list_transform(new_, lambda x: x.name), h.name)), new_)),
    lambda h: h.name || '=' || h.value), '|') END AS headers,
  CASE WHEN outcome = 'resolved' THEN md5(t_payload) END AS payload_md5
FROM ok
"""


OP10_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs AS (
  SELECT a.vec_id AS i, b.vec_id AS j FROM v a JOIN v b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.98),
reach(vec_id, root) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION SELECT p.j, r.root FROM reach r JOIN pairs p ON p.i = r.vec_id WHERE r.root < p.j),
least AS (SELECT vec_id, min(root) AS component_id FROM reach GROUP BY vec_id),
links AS (SELECT i, count(*) AS n FROM pairs GROUP BY i)
SELECT l.vec_id, coalesce(n, 0) AS n_links, component_id, l.vec_id = component_id AS kept
FROM least l LEFT JOIN links ON l.vec_id = links.i
"""


def op11_id_files(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_scratch(spark, "id_files", unique=True)
    huffman.write(read_table(spark, sf, "documents"), path, public_tokenizers.path(ID_TOKENIZER), end_id=END_ID)
    found = huffman.read(spark, path)
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op12_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    rows, moved = read_table(spark, sf, "embeddings"), F.col("vec_id") % 7 == 0
    return hard_negatives.mine(rows.withColumn("label", F.when(moved, (F.col("label") + 1) % 10).otherwise(F.col("label"))))


OP12_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor(256 * x)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, v.vec_id AS id, a.label = v.label AS same, CAST(list_dot_product(a.e, v.e) AS BIGINT) AS score
  FROM v a JOIN v ON len(a.e) = len(v.e) AND a.vec_id <> v.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (
  SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER)
    AS rank, id AS negative_id, positive_score, score AS negative_score
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""


def op13_cross_align(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents")
    return cross_align.align(docs, public_tokenizers.path(ALIGN_A), public_tokenizers.path(ALIGN_B))


def pipeline(spark: SparkSession, sf: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf)


def queries() -> dict:
    return {
        "pipeline": pipeline,
        "op1_katz": op1_katz,
        "op2_tool_calls": op2_tool_calls,
        "op3_quality_outliers": op3_quality_outliers,
        "op4_language_id": op4_language_id,
        "op5_warc_revisit": op5_warc_revisit,
        "op6_source_mix": op6_source_mix,
        "op7_byte_bpe": op7_byte_bpe,
        "op8_url_filter": op8_url_filter,
        "op9_simhash": op9_simhash,
        "op10_projection_dedup": op10_projection_dedup,
        "op11_id_files": op11_id_files,
        "op12_hard_negatives": op12_hard_negatives,
        "op13_cross_align": op13_cross_align,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op5_warc_revisit": OP5_SQL, "op8_url_filter": OP8_SQL, "op10_projection_dedup": OP10_SQL, "op12_hard_negatives": OP12_SQL,
    }
