"""Tool calls linked with their results, ordered, checked against schemas and written as canonical JSON.

``calls`` has conv_id, call_id, name, arguments (a JSON text), after (the call_id it waits for, or
null) and at (a number that orders repeats); ``results`` has conv_id, call_id, content and at. Both
are joined by hash on (conv_id, call_id); nothing is gathered per conversation, so one conversation
may hold any share of the rows. ``depth`` is the length of the chain of calls a call waits for, found
by pointer doubling in a number of joins that grows with the logarithm of the longest chain.

Repeated calls and results of one id: the first by ``at``, then by content, counts. A call that
waits for an unknown call waits for nothing. Calls on a cycle, or behind one, have a null depth. Rows
with a null conv_id or call_id link with nothing and are left out. Arguments that are null, not JSON (NaN and
numbers past a double are not) or not an object, that hold half a surrogate pair, or that are nested more than
``DEEPEST`` levels are invalid, and are written as the text they are. A result without a call is left out of ``link``
and found by ``orphans``. Extra columns are ignored whatever their names; empty tables give no rows.
"""

from __future__ import annotations

import json
import math
from collections.abc import Mapping
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brookmark.llm.text import batch_of, map_batches, staged

KEY = ["conv_id", "call_id"]
_TYPES: dict[str, Any] = {"string": str, "array": list, "object": dict, "boolean": bool, "null": type(None)}


#: Levels of arrays and objects that arguments may have.
DEEPEST = 100


def is_of(value: Any, kind: str) -> bool:
    """Whether a value is of a schema's type; whole numbers count as integers however they are written."""
    if kind in ("integer", "number"):
        if isinstance(value, bool) or not isinstance(value, (int, float)):
            return False
        return kind == "number" or isinstance(value, int) or value.is_integer()
    return isinstance(value, _TYPES[kind])


def fits(value: Any, schema: Mapping[str, Any]) -> bool:
    """Whether a value satisfies a schema.

    Known are type (one or a list), enum, minimum, maximum, minLength, maxLength, properties, required,
    additionalProperties (true or false) and items.
    """
    kinds = schema.get("type")
    if kinds is not None and not any(is_of(value, k) for k in ([kinds] if isinstance(kinds, str) else kinds)):
        return False
    if "enum" in schema and canonical(value) not in map(canonical, schema["enum"]):  # 1 is not true
        return False
    if is_of(value, "number") and not schema.get("minimum", value) <= value <= schema.get("maximum", value):
        return False
    if isinstance(value, str) and not schema.get("minLength", 0) <= len(value) <= schema.get("maxLength", len(value)):
        return False
    if isinstance(value, dict):
        known = schema.get("properties", {})
        if not set(schema.get("required", ())) <= set(value):
            return False
        if not schema.get("additionalProperties", True) and not set(value) <= set(known):
            return False
        return all(fits(v, known[k]) for k, v in value.items() if k in known)
    if isinstance(value, list) and "items" in schema:
        return all(fits(v, schema["items"]) for v in value)
    return True


def _finite(text: str) -> float:
    if not math.isfinite(value := float(text)):
        raise ValueError(text)
    return value


def parsed(given: str | None) -> dict[str, Any] | None:
    """A call's arguments, or None where they are not an object in JSON."""
    if given is None:
        return None
    try:
        value = json.loads(given, parse_float=_finite, parse_constant=_finite)
    except (ValueError, RecursionError):
        return None
    level = [value] if isinstance(value, dict) else []
    for _ in range(DEEPEST):
        level = [v for held in level for v in (held.values() if isinstance(held, dict) else held) if isinstance(v, (dict, list))]
        if not level:
            break
    try:
        return value if isinstance(value, dict) and not level and canonical(value).encode() else None
    except ValueError:  # half a surrogate pair, or an integer of thousands of digits
        return None


def canonical(value: Any) -> str:
    """JSON with sorted keys, no white space and nothing escaped that need not be."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def first_of(rows: DataFrame, *content: str) -> DataFrame:
    """One row per id: the first by ``at``, then by content."""
    known = rows.where("conv_id is not null and call_id is not null")
    return known.groupBy(*KEY).agg(F.min(F.struct("at", *content)).alias("one")).select(*KEY, *[f"one.{c}" for c in content])


def depths(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, depth) of distinct calls."""
    ids = calls.select(F.col("conv_id").alias("c"), F.col("call_id").alias("p")).distinct()
    to = staged(
        calls.join(ids, (F.col("conv_id") == F.col("c")) & (F.col("after") == F.col("p")), "left")
        .select(*KEY, F.col("p").alias("up"), F.when(F.col("p").isNotNull(), 1).otherwise(0).cast("long").alias("depth"))
    )
    # whoever still points somewhere once chains of every possible length are covered is on a cycle
    span, total = 1, to.count()
    while span <= total and not to.where("up is not null").isEmpty():
        ahead = to.select(F.col("conv_id").alias("c"), F.col("call_id").alias("p"), F.col("up").alias("next"), F.col("depth").alias("more"))
        to = staged(
            to.join(ahead, (F.col("conv_id") == F.col("c")) & (F.col("up") == F.col("p")), "left")
            .select(*KEY, F.col("next").alias("up"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"))
        )
        span *= 2
    return to.select(*KEY, F.when(F.col("up").isNull(), F.col("depth")).alias("depth"))


def link(calls: DataFrame, results: DataFrame, schemas: Mapping[str, Mapping[str, Any]]) -> DataFrame:
    """One row per call: name, depth, answered, valid, and the call with its result as canonical JSON.

    Sorting a conversation's rows by (depth, call_id) is a topological order; a result follows its call. ``schemas`` maps
    tool names to their arguments' schemas; calls of unknown tools are invalid.
    """
    once = staged(first_of(calls, "name", "arguments", "after"))
    answers = first_of(results.withColumn("content", F.coalesce("content", F.lit(""))), "content")
    joined = once.join(depths(once), KEY).join(answers, KEY, "left").drop("after")
    kind = dict(joined.dtypes)

    def check(batch: pa.RecordBatch) -> pa.RecordBatch:
        valid, texts = [], []
        for call_id, name, given, content in zip(*(batch.column(c).to_pylist() for c in ("call_id", "name", "arguments", "content"))):
            args = parsed(given)
            valid.append(args is not None and name in schemas and fits(args, schemas[name]))
            texts.append(canonical({"arguments": given if args is None else args, "id": call_id, "name": name, "result": content}))
        return batch_of(
            **{c: batch.column(c) for c in (*KEY, "name", "depth")}, answered=batch.column("content").is_valid(),
            valid=pa.array(valid, pa.bool_()), json=pa.array(texts, pa.string()),
        )

    schema = f"conv_id {kind['conv_id']}, call_id {kind['call_id']}, name string, depth long, answered boolean, valid boolean, json string"
    return map_batches(joined, check, schema)


def orphans(calls: DataFrame, results: DataFrame) -> DataFrame:
    """Results whose call does not exist."""
    return results.join(calls.select(*KEY).distinct(), KEY, "left_anti")


#: The tool that a dialogue's user turns are read as calls of; it takes no question of over 300 characters.
ASK = {
    "ask": {
        "type": "object", "required": ["chars", "text", "turn"], "additionalProperties": False,
        "properties": {
            "chars": {"type": "integer", "maximum": 300}, "text": {"type": ["string", "null"], "minLength": 1}, "turn": {"type": "integer"},
        },
    }
}


def dialogue_calls(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A dialogue as tool calls: a user's turn asks, the next turn of another role is its result.

    A turn's question waits for the user's question two turns before. A first question waits for the one two turns later
    where that has more characters, so that both are on a cycle. A turn after no question, such as a system's at the start, is
    a result without a call. Null texts are empty.
    """
    def name(turn):
        return F.concat_ws("-", F.col("conv_id").cast("string"), turn.cast("string"))

    turn, text = F.col("turn"), F.coalesce("text", F.lit(""))
    held = turns.select("conv_id", "turn", "role", text.alias("text")).where("conv_id is not null and turn is not null")
    asked = held.where("role = 'user'").withColumn("chars", F.length("text"))
    sizes = asked.groupBy("conv_id", "turn").agg(F.max("chars").alias("most"))
    before = sizes.select("conv_id", (turn + 2).alias("turn"), F.lit(True).alias("follows"))
    later = sizes.select("conv_id", (turn - 2).alias("turn"), F.col("most").alias("next"))
    calls = asked.join(before, ["conv_id", "turn"], "left").join(later, ["conv_id", "turn"], "left").select(
        "conv_id", name(turn).alias("call_id"), F.lit("ask").alias("name"), F.to_json(F.struct("chars", "text", "turn")).alias("arguments"),
        F.when(F.col("follows"), name(turn - 2)).when(F.col("next") > F.col("chars"), name(turn + 2)).alias("after"), turn.alias("at"),
    )
    results = held.where("role <> 'user'").select("conv_id", name(turn - 1).alias("call_id"), F.col("text").alias("content"), turn.alias("at"))
    return calls, results
