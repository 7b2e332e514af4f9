"""URL allow and block entries in one trie, longest match first.

An entry is a host and a path prefix. The trie's edges are the host's labels
from the top-level domain down, then the path's segments; a path prefix that
ends inside a segment hangs at its node as a tail. Walking a url's labels and
segments visits every entry that fits it, so the last entry met on the deepest
host, then on the longest path, is the one that wins.

The trie is broadcast only while the entries are at most ``max_entries``
(checked); a larger list is joined instead: each url's host suffixes and path
prefixes are looked up in the entry table by an equi-join.

Cases: a null url or one without ``://`` has an empty host and path and fits
no entry. Repeated entries count once; an entry listed as both allow and block
raises. Repeated rows give repeated results, an empty table an empty one,
other columns are ignored whatever their names. Null entry hosts raise.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .base import col, prepare

#: Entries up to which the trie is broadcast (about 300 bytes each in a worker).
MAX_ENTRIES = 200_000

_ENTRY, _PATH, _TAILS = 0, 1, 2  # keys that no label or segment (text) can equal


def entries_of(rules: Iterable[tuple[str, str, str]]) -> dict[tuple[str, str], str]:
    """(host, path) -> verdict; hosts lower-cased in A-Z."""
    out: dict[tuple[str, str], str] = {}
    for verdict, host, path in rules:
        if verdict not in ("allow", "block") or not host:
            raise ValueError(f"not an entry: {(verdict, host, path)}")
        key = (_lower(host), path or "")
        if out.setdefault(key, verdict) != verdict:
            raise ValueError(f"{host}{path} is both allowed and blocked")
    return out


def _lower(host: str) -> str:
    return host.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def build_trie(entries: dict[tuple[str, str], str]) -> dict:
    root: dict = {}
    for (host, path), verdict in entries.items():
        node = root
        for label in reversed(host.split(".")):
            node = node.setdefault(label, {})
        node = node.setdefault(_PATH, {})
        *segments, tail = path.split("/")
        for segment in segments:
            node = node.setdefault(segment, {})
        entry = (host + path, verdict)
        if tail:
            node.setdefault(_TAILS, []).append((tail, entry))
            node[_TAILS].sort(key=lambda t: -len(t[0]))
        else:
            node[_ENTRY] = entry
    return root


def _path_match(node: dict, path: str):
    """The longest entry below one host's node whose path starts the url's."""
    found, at = None, 0
    while True:
        found = node.get(_ENTRY, found)
        for tail, entry in node.get(_TAILS, ()):
            if path.startswith(tail, at):
                found = entry
                break
        end = path.find("/", at)
        if end < 0 or (node := node.get(path[at:end])) is None:
            return found
        at = end + 1


def match(root: dict, host: str, path: str):
    """(entry, verdict) of the longest match, or None."""
    found, node = None, root
    for label in reversed(host.split(".")):
        node = node.get(label)
        if node is None:
            break
        if _PATH in node:
            found = _path_match(node[_PATH], path) or found
    return found


def with_host_path(df: DataFrame, url_col: str) -> DataFrame:
    """Adds ``_host`` (A-Z lower-cased) and ``_path``."""
    url = F.coalesce(col(url_col).cast("string"), F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise(F.lit(""))
    cut = F.regexp_extract(rest, r"(?s)^([^/?#]*)([^?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^([^/?#]*)([^?#]*)", 2)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return df.withColumns({"_host": F.translate(cut, upper, upper.lower()), "_path": path})


def judge(
    df: DataFrame, rules: Iterable[tuple[str, str, str]], *, keep: list[str], url_col: str = "url",
    default: str = "allow", max_entries: int = MAX_ENTRIES,
) -> DataFrame:
    """The ``keep`` columns, ``host``, ``path``, ``rule`` (host and path of
    the entry that wins, else null) and ``verdict`` (the entry's, else
    ``default``) of each url. ``rules``: (verdict, host, path)."""
    entries = entries_of(rules)
    names = [f"_k{i}" for i in range(len(keep))]
    # the url is renamed before host and path are added: kept names may clash
    source = with_host_path(df.select(*[col(k).alias(n) for k, n in zip(keep, names)], col(url_col).alias("_url")), "_url")
    source = source.select(*names, "_host", "_path")
    made = _by_trie(source, entries, names) if len(entries) <= max_entries else _by_join(source, entries, names)
    return made.select(
        *[col(n).alias(k) for n, k in zip(names, keep)],
        F.col("_host").alias("host"),
        F.col("_path").alias("path"),
        F.col("_rule").alias("rule"),
        F.coalesce("_verdict", F.lit(default)).alias("verdict"),
    )


def _by_trie(source: DataFrame, entries: dict, names: list[str]) -> DataFrame:
    prepare(source.sparkSession)
    trie = source.sparkSession.sparkContext.broadcast(build_trie(entries))
    schema = T.StructType([*source.schema.fields, T.StructField("_rule", T.StringType()), T.StructField("_verdict", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root = trie.value
        for batch in batches:
            hosts, paths = batch.column(len(names)).to_pylist(), batch.column(len(names) + 1).to_pylist()
            found = [match(root, h, p) or (None, None) for h, p in zip(hosts, paths)]
            made = [pa.array([f[i] for f in found], pa.string()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=[f.name for f in schema])

    return source.mapInArrow(run, schema)


def _by_join(source: DataFrame, entries: dict, names: list[str]) -> DataFrame:
    """Distinct (host, path) pairs are expanded to their host suffixes and the
    path lengths that entries have, looked up, and the longest kept."""
    spark = source.sparkSession
    rules = spark.createDataFrame(
        [(h, p, v, len(h.split(".")), len(p)) for (h, p), v in entries.items()],
        "r_host string, r_path string, r_verdict string, r_labels int, r_chars int",
    )
    lengths = sorted({len(p) for _, p in entries})
    # a label and a segment count bound the expansion of one pair
    pairs = source.select("_host", "_path").distinct()
    labels = F.split("_host", r"\.")
    wide = pairs.withColumn("_i", F.explode(F.sequence(F.lit(1), F.size(labels)))).withColumn(
        "_suffix", F.array_join(F.slice(labels, F.col("_i"), F.size(labels)), ".")
    )
    wide = wide.withColumn("_n", F.explode(F.array(*[F.lit(n) for n in lengths]))).filter(F.char_length("_path") >= F.col("_n"))
    wide = wide.withColumn("_prefix", F.substr("_path", F.lit(1), F.col("_n")))
    best = (
        wide.join(rules, (F.col("_suffix") == F.col("r_host")) & (F.col("_prefix") == F.col("r_path")))
        .groupBy(F.col("_host").alias("m_host"), F.col("_path").alias("m_path"))
        .agg(F.max(F.struct("r_labels", "r_chars", "r_host", "r_path", "r_verdict")).alias("m"))
        .select("m_host", "m_path", F.concat("m.r_host", "m.r_path").alias("_rule"), F.col("m.r_verdict").alias("_verdict"))
    )
    on = (F.col("_host") == F.col("m_host")) & (F.col("_path") == F.col("m_path"))
    return source.join(best, on, "left").select(*names, "_host", "_path", "_rule", "_verdict")


__all__ = ["build_trie", "entries_of", "judge", "match"]
