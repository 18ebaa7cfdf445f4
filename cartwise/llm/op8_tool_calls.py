"""Chat formatting: tool calls linked with their results.

Calls and results are hash-joined by conversation and identifier. Calls are ordered by level: one more than the
highest level among the calls they depend on. Conversations of up to EDGES_OF_A_SMALL dependencies are walked in a
task, many in each; larger ones take a round of joins for each level, a table in the shared folder, which settles
the calls whose dependencies are all settled. What is never settled lies on a cycle (or behind one): level -1. Arguments are parsed and validated against the tool's schema (the keywords type, required, properties,
additionalProperties, items, enum, minimum, maximum, minLength, maxLength). Each call becomes a line of canonical
JSON: keys sorted, no white space, whole numbers without a fraction, text as it is.

The calls of a large conversation never meet in one task: joins are by call. The reading order of a conversation is (level, turn,
call_id). Of several results of a call the first by (turn, content) is linked; ``n_results`` counts all. Results
without a call come last as rows of status ``orphan``. Of repeated call ids in a conversation the first by (turn,
name, arguments) counts. Dependencies on unknown calls are ignored and reported as errors. Null arguments are an
error; null identifiers take no part. A call without a known schema is not valid. Other columns are not looked at.
"""

from __future__ import annotations

import json
import math

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise.llm import common as C
from cartwise.session import materialize

KEY = ["conv_id", "call_id"]
#: Conversations of at most so many edges are ordered in a task, with others up to about EDGES_A_TASK.
EDGES_OF_A_SMALL, EDGES_A_TASK = 20_000, 100_000
#: The tool that the query reads out of conversations, and its arguments' schema.
SCHEMAS = {
    "ask": {
        "type": "object",
        "required": ["text", "words"],
        "properties": {"text": {"type": "string", "minLength": 1}, "words": {"type": "integer", "minimum": 1, "maximum": 40}},
        "additionalProperties": False,
    }
}
TYPES = {
    "object": lambda v: isinstance(v, dict),
    "array": lambda v: isinstance(v, list),
    "string": lambda v: isinstance(v, str),
    "boolean": lambda v: isinstance(v, bool),
    "null": lambda v: v is None,
    "integer": lambda v: isinstance(v, int) and not isinstance(v, bool),
    "number": lambda v: isinstance(v, int | float) and not isinstance(v, bool),
}


def schema_errors(value, schema: dict, at: str = "$") -> list[str]:
    """What is wrong with a value, each with its place."""
    found = []
    kind = schema.get("type")
    if kind is not None and not any(TYPES[k](value) for k in ([kind] if isinstance(kind, str) else kind)):
        return [f"{at}: not {kind}"]
    if "enum" in schema and value not in schema["enum"]:
        found.append(f"{at}: not in enum")
    if isinstance(value, dict):
        properties = schema.get("properties", {})
        found += [f"{at}.{k}: missing" for k in schema.get("required", ()) if k not in value]
        for k in sorted(value):
            if k in properties:
                found += schema_errors(value[k], properties[k], f"{at}.{k}")
            elif schema.get("additionalProperties") is False:
                found.append(f"{at}.{k}: not allowed")
    elif isinstance(value, list) and "items" in schema:
        for i, item in enumerate(value):
            found += schema_errors(item, schema["items"], f"{at}[{i}]")
    elif isinstance(value, str):
        if len(value) < schema.get("minLength", 0):
            found.append(f"{at}: too short")
        if len(value) > schema.get("maxLength", math.inf):
            found.append(f"{at}: too long")
    elif TYPES["number"](value):
        if value < schema.get("minimum", -math.inf):
            found.append(f"{at}: too small")
        if value > schema.get("maximum", math.inf):
            found.append(f"{at}: too large")
    return found


def _plain(value):
    if isinstance(value, float):
        return int(value) if value.is_integer() and abs(value) < 1e21 else value
    if isinstance(value, dict):
        return {k: _plain(v) for k, v in value.items()}
    return [_plain(v) for v in value] if isinstance(value, list) else value


def canonical(value) -> str:
    return json.dumps(_plain(value), sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def _no_constants(name):
    raise ValueError(name)


def _finite(text):
    value = float(text)
    if not math.isfinite(value):
        raise ValueError(text)
    return value


def _small_levels(edges: DataFrame, n_edges: int) -> DataFrame:
    """(conv_id, call_id, level) of the calls that depend on others, in conversations of few edges: many of these
    meet in one task, about EDGES_A_TASK edges."""
    types = dict(edges.dtypes)

    def run(found):
        on: dict[tuple, list] = {}
        for conv, call, dependency in zip(*(found.column(c).to_pylist() for c in (*KEY, "on")), strict=True):
            on.setdefault((conv, call), []).append((conv, dependency))
        waiting = {call: len(deps) for call, deps in on.items()}
        users: dict[tuple, list] = {}
        for call, deps in on.items():
            for dependency in deps:
                users.setdefault(dependency, []).append(call)
        level = {call: 1 for call in users if call not in on}
        ready = list(level)
        for call in ready:  # grows while it is walked
            for user in users.get(call, ()):
                level[user] = max(level.get(user, 0), level[call] + 1)
                waiting[user] -= 1
                if not waiting[user]:
                    ready.append(user)
        done = [c for c in ready if c in on]
        return pa.table(
            {
                "conv_id": pa.array([c[0] for c in done], found.schema.field("conv_id").type),
                "call_id": pa.array([c[1] for c in done], found.schema.field("call_id").type),
                "level": pa.array([level[c] for c in done], pa.int32()),
            }
        )

    deal = F.pmod(F.xxhash64("conv_id"), F.lit(max(1, math.ceil(n_edges / EDGES_A_TASK))))
    schema = f"conv_id {types['conv_id']}, call_id {types['call_id']}, level int"
    return edges.groupBy(deal.alias("deal")).applyInArrow(lambda found: run(found), schema)


def _large_levels(edges: DataFrame) -> DataFrame:
    """The same for conversations of any size, a round of joins for each level."""
    calls = edges.select(*KEY).distinct()
    roots = edges.select("conv_id", F.col("on").alias("call_id")).distinct().join(calls, KEY, "left_anti")
    newest = materialize(roots.withColumn("level", F.lit(1)), "levels")
    edges = edges.withColumn("level", F.lit(None).cast("int"))
    parts = []
    while not newest.isEmpty():
        # Of the edges, those on the calls settled last are met; a call is ready when all of its edges are.
        met = newest.select("conv_id", F.col("call_id").alias("on"), F.col("level").alias("newer"))
        edges = edges.join(met, ["conv_id", "on"], "left").select(*KEY, "on", F.coalesce("level", "newer").alias("level"))
        edges = materialize(edges, "edges")
        ready = edges.groupBy(*KEY).agg(F.max("level").alias("last"), F.count_if(F.col("level").isNull()).alias("open"))
        last = len(parts) + 1
        newest = ready.where((F.col("open") == 0) & (F.col("last") == last)).select(*KEY, (F.col("last") + 1).alias("level"))
        newest = materialize(newest, "levels")
        parts.append(newest)
    found = edges.select(*KEY, "level").limit(0)
    for part in parts:
        found = found.unionByName(part)
    return found


def levels(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, level) of distinct calls (conv_id, call_id, depends)."""
    edges = calls.select(*KEY, F.explode("depends").alias("on")).distinct()
    known = calls.select("conv_id", F.col("call_id").alias("on"))
    edges = materialize(edges.join(known, ["conv_id", "on"], "left_semi"), "edges")
    sizes = edges.groupBy("conv_id").count()
    large = materialize(sizes.where(F.col("count") > EDGES_OF_A_SMALL).select("conv_id"), "large")
    found = _small_levels(edges.join(large, "conv_id", "left_anti"), edges.count())
    if not large.isEmpty():
        found = found.unionByName(_large_levels(edges.join(large, "conv_id")))
    waiting = edges.select(*KEY).distinct().withColumn("waits", F.lit(True))
    out = calls.select(*KEY).join(waiting, KEY, "left").join(found, KEY, "left")
    return out.select(*KEY, F.coalesce("level", F.when(F.col("waits"), F.lit(-1)).otherwise(F.lit(1))).alias("level"))


def link(calls: DataFrame, results: DataFrame, schemas: dict = SCHEMAS) -> DataFrame:
    """One row for each call, and each result without one.

    ``calls``: (conv_id, call_id, turn, name, arguments as JSON, depends: array of call ids);
    ``results``: (conv_id, call_id, turn, content). Returns conv_id, call_id, turn, level, status (linked, open,
    orphan), valid, errors, n_results and json.
    """
    named = calls.where("conv_id is not null and call_id is not null")
    first = F.min(F.struct("turn", "name", "arguments", "depends")).alias("first")
    named = named.groupBy(*KEY).agg(first).select(*KEY, "first.*")
    named = materialize(named.withColumn("depends", F.coalesce("depends", F.array().cast("array<string>"))), "calls")
    answers = results.where("conv_id is not null and call_id is not null").groupBy(*KEY).agg(
        F.min(F.struct("turn", "content")).alias("answer"), F.count("*").alias("n_results")
    )
    known = named.select("conv_id", F.col("call_id").alias("on"), F.lit(True).alias("there"))
    lost = named.select(*KEY, F.explode("depends").alias("on")).join(known, ["conv_id", "on"], "left_anti")
    lost = lost.groupBy(*KEY).agg(F.count_distinct("on").alias("lost"))
    rows = named.drop("depends").join(levels(named), KEY).join(lost, KEY, "left")
    rows = rows.join(answers.hint("shuffle_hash"), KEY, "full").select(
        *KEY,
        F.coalesce("turn", "answer.turn").alias("turn"),
        "level",
        F.when(F.col("level").isNull(), "orphan").when(F.col("n_results").isNull(), "open").otherwise("linked").alias("status"),
        F.coalesce("n_results", F.lit(0)).alias("n_results"),
        "name",
        "arguments",
        F.coalesce("lost", F.lit(0)).alias("lost"),
        F.col("answer.content").alias("content"),
    )

    def run(batches):
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                faults = ["unknown dependency"] * (row["lost"] > 0) + ["cycle"] * (row["level"] == -1)
                line = {
                    "arguments": None, "id": row["call_id"], "level": row["level"], "name": row["name"],
                    "result": row["content"], "status": row["status"],
                }
                if row["status"] == "orphan":
                    out.append((False, [], canonical(line)))
                    continue
                try:
                    arguments = json.loads(row["arguments"] or "", parse_constant=_no_constants, parse_float=_finite)
                    schema = schemas.get(row["name"])
                    errors = ["no schema"] if schema is None else schema_errors(arguments, schema)
                    text = canonical(line | {"arguments": arguments})
                    # A lone surrogate is no text: it fails here. Nesting deeper than the stack fails above.
                    text.encode()
                except (ValueError, RecursionError):
                    errors, text = ["arguments are not JSON"], canonical(line | {"arguments": row["arguments"]})
                errors += faults
                out.append((not errors, errors, text))
            kept = [batch.column(c) for c in ("conv_id", "call_id", "turn", "level", "status", "n_results")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array([o[0] for o in out]), pa.array([o[1] for o in out], pa.list_(pa.string())), pa.array([o[2] for o in out])],
                names=["conv_id", "call_id", "turn", "level", "status", "n_results", "valid", "errors", "json"],
            )

    types = dict(rows.dtypes)
    kept = ", ".join(f"{c} {types[c]}" for c in ("conv_id", "call_id", "turn", "level", "status", "n_results"))
    return rows.mapInArrow(run, f"{kept}, valid boolean, errors array<string>, json string")


def op8_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn of the conversations, read as tool use: a user's turn calls ``ask`` with its text and number of
    words and depends on the user's turn before (two turns back); an assistant's turn is the result of the turn before it."""
    turns = C.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    call_id = lambda turn: F.concat_ws("-", F.col("conv_id").cast("string"), turn.cast("string"))
    asks = turns.where("role = 'user'")
    words = F.size(F.filter(F.split("text", r"[ \n]+"), lambda w: w != ""))
    earlier = asks.select("conv_id", (F.col("turn") + 2).alias("turn")).distinct().withColumn("follows", F.lit(True))
    calls = asks.join(earlier, ["conv_id", "turn"], "left").select(
        "conv_id",
        call_id(F.col("turn")).alias("call_id"),
        "turn",
        F.lit("ask").alias("name"),
        F.to_json(F.struct(F.coalesce("text", F.lit("")).alias("text"), F.coalesce(words, F.lit(0)).alias("words"))).alias("arguments"),
        F.when(F.col("follows"), F.array(call_id(F.col("turn") - 2))).alias("depends"),
    )
    results = turns.where("role = 'assistant'").select(
        "conv_id", call_id(F.col("turn") - 1).alias("call_id"), "turn", F.col("text").alias("content")
    )
    return link(calls, results).select(
        "conv_id", "call_id", "turn", "level", "status", "n_results", "valid", F.array_join("errors", "; ").alias("errors"), "json"
    )


SQL = r"""
WITH asks AS (SELECT conv_id, turn, text, len(list_filter(regexp_split_to_array(text, '[ \n]+'), lambda w: w <> '')) AS words,
    turn - 2 * row_number() OVER (PARTITION BY conv_id, turn % 2 ORDER BY turn) AS island
  FROM conversations WHERE role = 'user'),
calls AS (SELECT *, (row_number() OVER (PARTITION BY conv_id, turn % 2, island ORDER BY turn))::INTEGER AS level FROM asks),
results AS (SELECT conv_id, turn - 1 AS asked, turn, text FROM conversations WHERE role = 'assistant'),
rows AS (SELECT coalesce(c.conv_id, r.conv_id) AS conv_id,
  coalesce(c.conv_id, r.conv_id) || '-' || coalesce(c.turn, r.asked) AS call_id, coalesce(c.turn, r.turn) AS turn, level,
  CASE WHEN level IS NULL THEN 'orphan' WHEN r.turn IS NULL THEN 'open' ELSE 'linked' END AS status,
  (CASE WHEN r.turn IS NULL THEN 0 ELSE 1 END)::BIGINT AS n_results, c.text AS asked_text, words, r.text AS content
  FROM calls c FULL JOIN results r ON c.conv_id = r.conv_id AND c.turn = r.asked),
judged AS (SELECT *, concat_ws('; ', CASE WHEN length(asked_text) < 1 THEN '$.text: too short' END,
  CASE WHEN words < 1 THEN '$.words: too small' WHEN words > 40 THEN '$.words: too large' END) AS errors FROM rows)
SELECT conv_id, call_id, turn, level, status, n_results, errors = '' AND status <> 'orphan' AS valid, errors,
  '{"arguments":' || CASE WHEN level IS NULL THEN 'null' ELSE '{"text":' || to_json(asked_text) || ',"words":' || words || '}' END
  || ',"id":' || to_json(call_id) || ',"level":' || coalesce(level::VARCHAR, 'null') || ',"name":'
  || CASE WHEN level IS NULL THEN 'null' ELSE '"ask"' END || ',"result":' || coalesce(to_json(content)::VARCHAR, 'null')
  || ',"status":"' || status || '"}' AS json
FROM judged
"""
