"""Tool calls linked to their results, ordered, validated and serialised.

Identifiers may come again in a conversation (``call_0`` in every turn). The
calls and results of an identifier, by position (calls first), make rounds: a
run of calls and the run of results after it. In a round of k calls and m
results the i-th call has the i-th result; with fewer results than calls the
last m calls have them, with more the rest are extra. A dependency means the
latest earlier call of its identifier, or else the next one.

Both need neighbours inside an identifier, which may hold any share of the
rows, so slim events (identifier, position, kind, row) are range-sorted and
stored once; windows run inside the sorted partitions, and what they need from
other partitions is carried over by one small row per partition. Rounds, calls
and results then meet in equi-joins on numbers that no two rows of a side
share, so no key is hot. Calls are ordered by layers of their dependencies:
layer 0 depends on nothing, layer k on calls of lower layers; (conversation,
level, position) is a topological order. A conversation with up to
``MAX_EDGES`` dependencies is ordered in one grouped step, a larger one by
rounds of anti-joins, a layer each. Arguments are parsed and validated against
the tool's schema, and every message is serialised as canonical JSON (keys in
UTF-16 order, no spaces, shortest numbers), in Arrow batches.

One row per call and per result without a call of its own. Statuses:
``answered``, ``unanswered``, ``cycle`` (the call depends on itself, directly
or not, or on such a call; level null) for calls; ``extra`` (its round has no
call left), ``early`` (before the identifier's first call), ``orphan`` (no call
has the identifier) for results; ``no_id`` (null identifier or conversation)
for both, which take part in nothing.

Cases: ``n_calls`` and ``n_results`` count the identifier's rows. Equal
positions are ordered by content. Dependencies on calls that do not exist are
counted in ``missing`` and otherwise ignored. Null or empty arguments are not
JSON; arguments and contents of any length are taken whole. Empty tables give
an empty result. Other columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finwater.operators.loads import range_sorted
from finwater.session import ensure_checkpoint_dir, shared_scratch

from .base import prepare

#: Tools whose schemas are sent to the tasks.
MAX_TOOLS = 10_000
#: Dependencies of a conversation up to which one grouped step orders its calls.
MAX_EDGES = 50_000
TYPES = {
    "object": dict, "array": list, "string": str, "boolean": bool, "number": (int, float), "integer": int, "null": type(None),
}


class BadJson(ValueError):
    pass


def parse(text: str | None):
    """The value of a JSON text; repeated keys, numbers that are not finite,
    lone surrogates and over-deep nesting are errors."""

    def pairs(items):
        out = dict(items)
        if len(out) != len(items):
            raise BadJson("repeated key")
        return out

    def no_constant(_):
        raise BadJson("not a number")

    try:
        value = json.loads(text or "", object_pairs_hook=pairs, parse_constant=no_constant)
        canonical(value).encode()
        return value
    except RecursionError as e:
        raise BadJson("too deep") from e
    except UnicodeEncodeError as e:
        raise BadJson("lone surrogate") from e
    except BadJson:
        raise
    except ValueError as e:
        raise BadJson("not JSON") from e


def _number(x: int | float) -> str:
    if isinstance(x, int):
        return str(x)
    if x in (float("inf"), float("-inf")) or x != x:
        raise BadJson("number out of range")
    if x == 0:
        return "0"
    if 1e-6 <= abs(x) < 1e21:
        text = format(Decimal(repr(x)), "f")
        return text.rstrip("0").rstrip(".") if "." in text else text
    mantissa, exponent = repr(x).split("e")
    return f"{mantissa.removesuffix('.0')}e{int(exponent):+d}"


def canonical(value) -> str:
    """Canonical JSON of a parsed value."""
    if isinstance(value, dict):
        keys = sorted(value, key=lambda k: k.encode("utf-16-be", "surrogatepass"))
        return "{" + ",".join(f"{_text(k)}:{canonical(value[k])}" for k in keys) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(canonical, value)) + "]"
    if isinstance(value, str):
        return _text(value)
    if value is None or isinstance(value, bool):
        return {None: "null", True: "true", False: "false"}[value]
    return _number(value)


def _text(s: str) -> str:
    return json.dumps(s, ensure_ascii=False)


def violation(value, schema: dict, at: str = "$") -> str | None:
    """The first way in which a value breaks its schema, or None. Knows type,
    enum, minimum, maximum, minLength, maxLength, items, required, properties
    and additionalProperties."""
    kind = schema.get("type")
    if kind and (not isinstance(value, TYPES[kind]) or (isinstance(value, bool) and kind in ("number", "integer"))):
        if not (kind == "integer" and isinstance(value, float) and value.is_integer()):
            return f"{at}: not {kind}"
    if "enum" in schema and not any(type(value) is type(e) and value == e for e in schema["enum"]):
        return f"{at}: not in enum"
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        if value < schema.get("minimum", value):
            return f"{at}: below minimum"
        if value > schema.get("maximum", value):
            return f"{at}: above maximum"
    if isinstance(value, str):
        if len(value) < schema.get("minLength", 0):
            return f"{at}: too short"
        if len(value) > schema.get("maxLength", len(value)):
            return f"{at}: too long"
    if isinstance(value, list) and "items" in schema:
        for i, v in enumerate(value):
            if said := violation(v, schema["items"], f"{at}[{i}]"):
                return said
    if isinstance(value, dict):
        own = schema.get("properties", {})
        for k in schema.get("required", []):
            if k not in value:
                return f"{at}.{k}: missing"
        for k in sorted(value):
            if k in own:
                if said := violation(value[k], own[k], f"{at}.{k}"):
                    return said
            elif schema.get("additionalProperties") is False:
                return f"{at}.{k}: not allowed"
    return None


_CALL, _RESULT, _LOOKUP = 0, 1, -1
_KEY = ["conv_id", "call_id"]


def _events(calls: DataFrame, results: DataFrame) -> DataFrame:
    """Calls, results and dependencies in (identifier, position, kind) order,
    stored with partition and place."""
    spark = calls.sparkSession
    known = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    event = lambda df, kind, tie: df.filter(known).select(
        *_KEY, "position", F.lit(kind).alias("kind"), tie.alias("tie"), "row"
    )
    looked = calls.filter(known).select("conv_id", F.explode(F.array_distinct("depends_on")).alias("call_id"), "position", "row")
    every = event(calls, _CALL, F.xxhash64("name", "arguments", "depends_on")).unionByName(
        event(results, _RESULT, F.xxhash64("content"))
    ).unionByName(event(looked, _LOOKUP, F.lit(0).cast("long")))
    path = shared_scratch(spark, "call_events", unique=True)
    range_sorted(every, [*_KEY, "position", "kind", "tie", "row"]).drop("tie", "position").write.parquet(path)
    return spark.read.parquet(path)


def _carried(found: DataFrame, take: list[str], backwards: list[str] = ()) -> DataFrame:
    """(_pid, c_*): for each partition the last value that is not null in the
    partitions before it (``backwards``: after it), from a row per partition."""
    rows = sorted(found.collect(), key=lambda r: r["_pid"])
    out: dict[int, dict] = {r["_pid"]: {} for r in rows}
    for name in take:
        held = None
        for r in reversed(rows) if name in backwards else rows:
            out[r["_pid"]][name] = held
            held = r[name] if r[name] is not None else held
    schema = T.StructType([T.StructField("_pid", T.IntegerType())] + [T.StructField(f"c_{n}", found.schema[n].dataType) for n in take])
    return found.sparkSession.createDataFrame([(p, *(v[n] for n in take)) for p, v in out.items()], schema)


def _totals(found: DataFrame, take: list[str]) -> DataFrame:
    """(_pid, o_*): sums over the partitions before each."""
    rows, held, out = sorted(found.collect(), key=lambda r: r["_pid"]), [0] * len(take), []
    for r in rows:
        out.append((r["_pid"], *held))
        held = [h + (r[n] or 0) for h, n in zip(held, take)]
    return found.sparkSession.createDataFrame(out, "_pid int, " + ", ".join(f"o_{n} long" for n in take))


def _neighbours(events: DataFrame) -> DataFrame:
    """Events with marks where rounds and runs begin, and with the call that a
    dependency means (``target``) and whether a call of the identifier follows."""
    there = Window.partitionBy("_pid").orderBy("_pos")
    back = Window.partitionBy("_pid").orderBy(F.desc("_pos"))
    before, after = (w.rowsBetween(Window.unboundedPreceding, -1) for w in (there, back))
    real, is_call = F.col("kind") >= 0, F.col("kind") == _CALL
    event, call = F.when(real, F.struct(*_KEY, "kind")), F.when(is_call, F.struct(*_KEY, "row"))
    edge = events.groupBy("_pid").agg(
        F.max_by(event, F.when(real, F.col("_pos"))).alias("event"), F.max_by(call, F.when(is_call, F.col("_pos"))).alias("call"),
        F.min_by(call, F.when(is_call, F.col("_pos"))).alias("next"),
    )
    seen = events.withColumns({
        "event": F.last(event, ignorenulls=True).over(before), "call": F.last(call, ignorenulls=True).over(before),
        "next": F.last(call, ignorenulls=True).over(after),
    }).join(F.broadcast(_carried(edge, ["event", "call", "next"], ["next"])), "_pid")  # a row per partition
    names = ("event", "call", "next")
    seen = seen.withColumns({n: F.coalesce(n, f"c_{n}") for n in names}).drop(*(f"c_{n}" for n in names))
    same = lambda n: F.coalesce((F.col(f"{n}.conv_id") == F.col("conv_id")) & (F.col(f"{n}.call_id") == F.col("call_id")), F.lit(False))
    begins = real & (~same("event") | (is_call & (F.col("event.kind") == _RESULT)))
    marked = seen.withColumn("round", F.coalesce(begins, F.lit(False)))
    turns = real & (F.col("round") | (F.col("event.kind") != F.col("kind")))
    return marked.select(
        "_pid", "_pos", *_KEY, "kind", "row", "round", F.coalesce(turns, F.lit(False)).alias("run"), real.alias("real"),
        F.when(same("call"), F.col("call.row")).when(same("next"), F.col("next.row")).alias("target"), same("next").alias("later"),
    ).checkpoint()


def _placed(marked: DataFrame) -> DataFrame:
    """(conv_id, call_id, kind, row, later, round_no, index): calls and results
    with their round and their place in its run."""
    upto = Window.partitionBy("_pid").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    count = lambda c: F.sum(F.col(c).cast("long")).over(upto)
    here = marked.withColumns({"rounds": count("round"), "reals": count("real")})
    size = here.groupBy("_pid").agg(
        F.max("rounds").alias("rounds"), F.max("reals").alias("reals"), F.max(F.when(F.col("run"), F.col("reals"))).alias("start")
    )
    offsets = _totals(size, ["rounds", "reals"])
    starts = size.join(offsets, "_pid").select("_pid", (F.col("start") + F.col("o_reals")).alias("start"))
    here = here.join(F.broadcast(offsets), "_pid").join(F.broadcast(_carried(starts, ["start"])), "_pid")  # a row per partition each
    number = F.col("reals") + F.col("o_reals")
    start = F.coalesce(F.last(F.when(F.col("run"), number), ignorenulls=True).over(upto), F.col("c_start"))
    here = here.withColumn("index", number - start)
    return here.filter("real").select(*_KEY, "kind", "row", "later", (F.col("rounds") + F.col("o_rounds")).alias("round_no"), "index")


def _matched(placed: DataFrame) -> DataFrame:
    """(call_row, result_row, call_state): links, and each unlinked result
    with its status."""
    count = lambda kind: F.count_if(F.col("kind") == kind)
    rounds = placed.groupBy("round_no").agg(count(_CALL).alias("k"), count(_RESULT).alias("m"))
    both = placed.join(rounds, "round_no")
    shift = F.greatest(F.col("k") - F.col("m"), F.lit(0))
    calls = both.filter(F.col("kind") == _CALL).select("round_no", (F.col("index") - shift).alias("slot"), F.col("row").alias("call_row"))
    said = F.when(F.col("k") > 0, "extra").when(F.col("later"), "early").otherwise("orphan")
    slot = F.when(F.col("index") < F.col("k"), F.col("index")).otherwise(-1 - F.col("row"))  # a slot of its own
    results = both.filter(F.col("kind") == _RESULT).select("round_no", slot.alias("slot"), F.col("row").alias("result_row"), said.alias("said"))
    return results.join(calls.filter("slot >= 0"), ["round_no", "slot"], "left").select(
        "call_row", "result_row", F.when(F.col("call_row").isNull(), F.col("said")).alias("said")
    )


def _layers_of(edges: pa.Table) -> pa.Table:
    """Layers of one conversation's calls that depend on others."""
    waits: dict[int, set[int]] = {}
    behind: dict[int, list[int]] = {}
    for row, target in zip(edges.column("row").to_pylist(), edges.column("target").to_pylist()):
        waits.setdefault(row, set()).add(target)
        behind.setdefault(target, []).append(row)
    level, front, now = {}, [t for t in behind if t not in waits], 0
    while front:
        level.update(dict.fromkeys(front, now))
        following = []
        for done in front:
            for row in behind.get(done, ()):
                left = waits[row]
                left.discard(done)
                if not left and row not in level:
                    following.append(row)
        front, now = list(dict.fromkeys(following)), now + 1
    rows = list(waits)
    return pa.table({"row": pa.array(rows, pa.int64()), "level": pa.array([level.get(r) for r in rows], pa.int64())})


def _layers_by_rounds(edges: DataFrame) -> DataFrame:
    """The same for any number of edges, a round per layer."""
    spark, path = edges.sparkSession, shared_scratch(edges.sparkSession, "call_levels", unique=True)
    nodes, left, level = edges.select("row").distinct(), edges.checkpoint(), 1
    spark.createDataFrame([], "row long").write.parquet(f"{path}/level=0")
    solved = left.select(F.col("target").alias("row")).distinct().join(nodes, "row", "left_anti")
    while True:
        rest = left.join(solved.select(F.col("row").alias("target")), "target", "left_anti").select("row", "target").checkpoint()
        front = left.select("row").distinct().join(rest.select("row").distinct(), "row", "left_anti")
        front.write.parquet(f"{path}/level={level}")
        solved = spark.read.schema("row long").parquet(f"{path}/level={level}")
        if solved.isEmpty():
            break
        left, level = rest, level + 1
    found = spark.read.schema("row long, level long").parquet(path)
    return nodes.join(found, "row", "left")


def _layers(edges: DataFrame, limit: int) -> DataFrame:
    """(row, level) of the calls that have edges (conv_id, row, target); level
    is null inside and behind cycles."""
    sizes = edges.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    small = edges.join(sizes.filter(F.col("n") <= limit), "conv_id", "left_semi").select("conv_id", "row", "target")
    found = small.groupBy("conv_id").applyInArrow(_layers_of, "row long, level long")
    large = edges.join(sizes.filter(F.col("n") > limit), "conv_id", "left_semi").select("row", "target")
    return found if large.isEmpty() else found.unionByName(_layers_by_rounds(large))


def link(calls: DataFrame, results: DataFrame, schemas: dict[str, dict], max_edges: int = MAX_EDGES) -> DataFrame:
    """One row per call and per result without a call: conv_id, call_id, level,
    position, status, n_calls, n_results, missing, valid, error, message.

    ``calls``: conv_id, call_id, position, name, arguments, depends_on;
    ``results``: conv_id, call_id, position, content. ``valid`` and ``error``
    tell of the arguments (null for results)."""
    if len(schemas) > MAX_TOOLS:
        raise ValueError(f"more than {MAX_TOOLS} tools")
    spark = calls.sparkSession
    ensure_checkpoint_dir(spark)
    prepare(spark)
    row = F.monotonically_increasing_id().alias("row")
    c = calls.select("conv_id", "call_id", "position", "name", "arguments", "depends_on", row).checkpoint()
    r = results.select("conv_id", "call_id", "position", "content", row).checkpoint()
    marked = _neighbours(_events(c, r))
    placed = _placed(marked).checkpoint()
    links = _matched(placed).checkpoint()
    looked = marked.filter(F.col("kind") == _LOOKUP)
    absent = looked.filter("target IS NULL").groupBy("row").agg(F.count(F.lit(1)).alias("missing"))
    layers = _layers(looked.filter("target IS NOT NULL").select("conv_id", "row", "target"), max_edges)
    # one row per call that depends on something
    layers = layers.select("row", "level", F.lit(True).alias("waits")).join(absent, "row", "full")
    said = placed.groupBy(*_KEY).agg(
        F.count_if(F.col("kind") == _CALL).alias("n_calls"), F.count_if(F.col("kind") == _RESULT).alias("n_results")
    )
    known = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    answers = links.filter("call_row IS NOT NULL").join(r.select(F.col("row").alias("result_row"), "content"), "result_row")
    called = c.join(layers, "row", "left").join(answers.select(F.col("call_row").alias("row"), "result_row", "content"), "row", "left")
    none = F.lit(0).cast("long")
    level = F.when(known, F.when(F.col("waits"), F.col("level")).otherwise(none))
    status = F.when(~known, "no_id").when(level.isNull(), "cycle").when(F.col("result_row").isNull(), "unanswered").otherwise("answered")
    called = called.select(
        *_KEY, level.alias("level"), "position", status.alias("status"), F.coalesce("missing", none).alias("missing"),
        F.lit(True).alias("called"), "name", "arguments", "depends_on", "content",
    )
    empty = {f.name: F.lit(None).cast(f.dataType).alias(f.name) for f in c.schema.fields}
    alone = r.join(links.filter("said IS NOT NULL").select(F.col("result_row").alias("row"), "said"), "row", "left")
    alone = alone.filter(F.col("said").isNotNull() | ~known).select(
        *_KEY, F.lit(None).cast("long").alias("level"), "position", F.coalesce("said", F.lit("no_id")).alias("status"), none.alias("missing"),
        F.lit(False).alias("called"), empty["name"], empty["arguments"], empty["depends_on"], "content",
    )
    flat = called.unionByName(alone).join(said, _KEY, "left").withColumns({
        "n_calls": F.coalesce("n_calls", F.col("called").cast("long")), "n_results": F.coalesce("n_results", (~F.col("called")).cast("long")),
    })
    return _serialised(flat, schemas)


def _serialised(flat: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    kept = ["conv_id", "call_id", "level", "position", "status", "n_calls", "n_results", "missing"]
    out = T.StructType(
        [flat.schema[k] for k in kept]
        + [T.StructField("valid", T.BooleanType()), T.StructField("error", T.StringType()), T.StructField("message", T.StringType())]
    )

    def message(row: dict) -> tuple[bool | None, str | None, str]:
        error, arguments = None, None
        if row["called"]:
            try:
                arguments = parse(row["arguments"])
                schema = schemas.get(row["name"])
                error = "unknown tool" if schema is None else violation(arguments, schema)
            except BadJson as e:
                error = str(e)
        body = {
            "arguments": arguments, "depends_on": sorted({d for d in row["depends_on"] or [] if d is not None}), "id": row["call_id"],
            "name": row["name"], "result": row["content"], "status": row["status"],
        }
        return (error is None if row["called"] else None), error, canonical(body)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [message(r) for r in batch.to_pylist()]
            extra = [pa.array([m[i] for m in made], t) for i, t in enumerate((pa.bool_(), pa.string(), pa.string()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], *extra], names=out.names)

    return flat.select(*kept, "called", "name", "arguments", "depends_on", "content").mapInArrow(run, out)


#: Schemas of the tools in the derived records.
TOOLS = {
    "search": {
        "type": "object", "required": ["query", "limit"], "additionalProperties": False,
        "properties": {"query": {"type": "string", "minLength": 1}, "limit": {"type": "integer", "minimum": 1, "maximum": 50}},
    },
    "calculate": {
        "type": "object", "required": ["terms"], "properties": {"terms": {"type": "array", "items": {"type": "number"}}, "round": {"type": "boolean"}},
    },
    "fetch": {
        "type": "object", "required": ["url", "mode"],
        "properties": {"url": {"type": "string"}, "mode": {"type": "string", "enum": ["text", "raw"]}},
    },
}


def derived_records(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results derived from conversations by a fixed rule: each
    assistant turn is a call, whose arguments hold its whole text, and each
    user turn the result of the turn before it. Some calls have unknown tools,
    broken or invalid arguments, absent dependencies or depend on themselves."""
    mark = F.col("conv_id") + F.col("turn")
    name = F.when(mark % 13 == 0, "mystery").when(mark % 3 == 0, "search").when(mark % 3 == 1, "calculate").otherwise("fetch")
    search = F.to_json(F.struct(F.col("text").alias("query"), (F.length("text") % 60).alias("limit")))
    digits = F.array(F.length("text").cast("double") / 4, F.col("turn").cast("double"))
    calculate = F.to_json(F.struct(digits.alias("terms"), (mark % 2 == 0).alias("round"), F.md5("text").alias("note")))
    mode = F.when(mark % 7 == 0, "html").otherwise("text")
    fetch = F.to_json(F.struct(F.concat(F.lit("https://example.com/"), F.md5("text")).alias("url"), mode.alias("mode"), F.col("text").alias("body")))
    arguments = F.when(mark % 17 == 0, F.concat(F.lit('{"query": '), F.length("text"))).when(name == "search", search).when(
        name == "calculate", calculate
    ).otherwise(fetch)
    ident = lambda t: F.concat(F.lit("c"), t.cast("string"))
    depends = (
        F.when(mark % 29 == 0, F.array(ident(F.col("turn"))))
        .when(mark % 5 == 0, F.array(ident(F.col("turn") - 2), F.lit("c-none")))
        .when(mark % 3 != 0, F.array(ident(F.col("turn") - 2)))
        .otherwise(F.array().cast("array<string>"))
    )
    calls = turns.filter(F.col("role") == "assistant").select(
        "conv_id", ident(F.col("turn")).alias("call_id"), F.col("turn").cast("long").alias("position"), name.alias("name"),
        arguments.alias("arguments"), depends.alias("depends_on"),
    )
    results = turns.filter(F.col("role") == "user").select(
        "conv_id", ident(F.col("turn") - 1).alias("call_id"), F.col("turn").cast("long").alias("position"), F.col("text").alias("content")
    )
    return calls, results


__all__ = ["TOOLS", "canonical", "derived_records", "link", "parse", "violation"]
