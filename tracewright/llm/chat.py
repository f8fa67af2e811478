"""Tool-call linking in conversations: calls and results are joined, ordered, validated and written as canonical JSON."""

from __future__ import annotations

import json
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch

#: How a text holds calls and results: {"id": ..., "name": ..., "arguments": {...}} and {"id": ..., "content": ...}.
CALL = r"(?s)<tool_call>(.*?)</tool_call>"
RESULT = r"(?s)<tool_result>(.*?)</tool_result>"
#: A call's argument may be the result of another call.
REFERENCE = r'"\$ref"\s*:\s*"([^"]+)"'

TYPES = {"string": str, "number": (int, float), "integer": int, "boolean": bool, "object": dict, "array": list, "null": type(None)}


def fits(value, schema: dict) -> bool:
    """Whether value fits the keywords type, enum, properties, required, additionalProperties and items of a JSON schema. A {"$ref": id} stands for any value."""
    if isinstance(value, dict) and set(value) == {"$ref"}:
        return True
    kind = schema.get("type")
    if kind:
        kinds = kind if isinstance(kind, list) else [kind]
        if not any(isinstance(value, TYPES[k]) and not (isinstance(value, bool) and k in ("number", "integer")) for k in kinds):
            return False
    if "enum" in schema and value not in schema["enum"]:
        return False
    if isinstance(value, dict):
        known = schema.get("properties", {})
        if any(k not in value for k in schema.get("required", [])):
            return False
        if schema.get("additionalProperties") is False and any(k not in known for k in value):
            return False
        return all(fits(v, known[k]) for k, v in value.items() if k in known)
    if isinstance(value, list) and "items" in schema:
        return all(fits(v, schema["items"]) for v in value)
    return True


def canonical(value) -> str:
    """Keys sorted, no spaces, no escapes but those JSON needs; halves of surrogate pairs, which UTF-8 has no bytes for, stay escapes."""
    out = json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)
    return re.sub("[\ud800-\udfff]", lambda m: f"\\u{ord(m[0]):04x}", out)


def _finite(text: str) -> float:
    if not math.isfinite(out := float(text)):
        raise ValueError(text)
    return out


def _refused(text: str):
    raise ValueError(text)


def parsed(text: str | None):
    """The value of a JSON text; None where it is not JSON by the standard (NaN, Infinity, numbers beyond a double) or nested too deeply to be read and written."""
    try:
        out = json.loads(text, parse_float=_finite, parse_constant=_refused) if text is not None else None
        canonical(out)
        return out
    except (ValueError, RecursionError):
        return None


def serialised(schemas: dict[str, dict]):
    """For mapInArrow over (conv, turn, place, kind, role, text, call_id, body, result): (conv, turn, place, kind, call_id, status, json)."""

    def run(batches):
        for batch in batches:
            status, out = [], []
            for kind, role, text, call, body, result in zip(*(batch.column(k).to_pylist() for k in range(3, 9))):
                if kind == "message":
                    status.append("message")
                    out.append(canonical({"content": text, "role": role}))
                    continue
                got = parsed(body)
                if kind == "result":
                    status.append("orphan")
                    out.append(canonical({"content": got.get("content") if isinstance(got, dict) else body, "id": call, "role": "tool"}))
                    continue
                args = got.get("arguments") if isinstance(got, dict) else None
                args = parsed(args) if isinstance(args, str) else args
                name = got.get("name") if isinstance(got, dict) else None
                if not isinstance(got, dict) or not isinstance(args, dict):
                    status.append("malformed")
                elif name not in schemas:
                    status.append("unknown")
                elif not fits(args, schemas[name]):
                    status.append("invalid")
                else:
                    status.append("valid" if result is not None else "unanswered")
                answer = parsed(result)
                out.append(canonical({"arguments": args if args is not None else body, "id": call, "name": name, "result": answer.get("content") if isinstance(answer, dict) else result, "role": "tool_call"}))
            names = ["conv", "turn", "place", "kind", "call_id", "status", "json"]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], batch.column(6), pa.array(status, pa.string()), pa.array(out, pa.string())], names=names)

    return run


def link_tool_calls(turns: DataFrame, schemas: dict[str, dict] | None = None, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", scratch: Scratch | None = None) -> DataFrame:
    """(conv_id, turn, place, kind, call_id, level, status, json): one row for each message, call and unanswered-for result.

    A message's text is what is left without its calls and results. Calls and results of a conversation are joined by
    identifier; of several calls or results of one identifier the first by (turn, place, text, role) counts and the
    others, copies of it too, stay as calls without a result, or as results of their own ("orphan"). level orders calls topologically: 0 without
    references, else one more than the highest call referred to; calls on a cycle have no level (null), references to
    unknown calls do not count. status: message; for calls valid, invalid (arguments do not fit the schema), unknown
    (no schema of that name), malformed (no JSON object), unanswered; orphan. json is canonical, so equal content is
    equal text. Order by (conv_id, turn, level, place).

    Joins are by hash of (conversation, identifier), so a conversation of a third of all rows spreads over many tasks;
    levels are found for all conversations at once; a chain of n calls takes log2(n) rounds, and only calls that wait for
    two or more, one behind the other, a round each. Null texts are empty messages; null
    conversations are one conversation, as equal keys; repeated rows repeat their messages, and their calls count as
    repeated identifiers. An empty table gives an empty result.
    """
    spark = turns.sparkSession
    scratch = scratch or Scratch(spark, "chat")
    base = turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).cast("string").alias("role"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    found = base.select("*", F.regexp_extract_all("text", F.lit(CALL)).alias("calls"), F.regexp_extract_all("text", F.lit(RESULT)).alias("results"))
    plain = F.trim(F.regexp_replace(F.regexp_replace("text", CALL, ""), RESULT, ""))
    some = found.where((F.size("calls") > 0) | (F.size("results") > 0))
    messages = found.select("conv", "turn", F.lit(-1).alias("place"), F.lit("message").alias("kind"), "role", F.when((F.size("calls") > 0) | (F.size("results") > 0), plain).otherwise(F.col("text")).alias("text"), F.lit(None).cast("string").alias("call_id"), F.lit(None).cast("string").alias("body"), F.lit(None).cast("string").alias("result"))
    said = None
    for kind, col in (("call", "calls"), ("result", "results")):
        rows = some.select("conv", "turn", F.posexplode(col).alias("place", "body"), F.lit(kind).alias("kind"), "role")
        said = rows if said is None else said.union(rows)
    said = said.withColumn("call_id", F.get_json_object("body", "$.id"))
    # Copies of one row are counted and numbered, so that no task ranks all rows of a conversation.
    said = said.groupBy(*said.columns).agg(F.count("*").cast("int").alias("n")).withColumn("copy", F.explode(F.sequence(F.lit(1), "n"))).drop("n")
    said = scratch.table(said, "said")
    at = F.struct("turn", "place", "body", "role")
    first = said.where("call_id is not null").groupBy("conv", "call_id", "kind").agg(F.min(at).alias("one"))
    call, answer = (first.where(F.col("kind") == k).select(F.col("conv").alias("l_conv"), F.col("call_id").alias("l_id"), F.col("one").alias(k)) for k in ("call", "result"))
    same = lambda: F.col("conv").eqNullSafe(F.col("l_conv")) & (F.col("call_id") == F.col("l_id"))
    calls = said.where("kind = 'call'").join(answer, same(), "left").drop("l_conv", "l_id")
    # Of repeated identifiers only the first call gets the result.
    firsts = call.select(F.col("l_conv").alias("f_conv"), F.col("l_id").alias("f_id"), F.col("call").alias("f_at"))
    calls = calls.join(firsts, F.col("conv").eqNullSafe(F.col("f_conv")) & (F.col("call_id") == F.col("f_id")), "left")
    calls = calls.select("conv", "turn", "place", "kind", "role", F.lit(None).cast("string").alias("text"), "call_id", "body", F.when(at.eqNullSafe(F.col("f_at")) & (F.col("copy") == 1), F.col("result.body")).alias("result"))
    used = call.join(answer.select(F.col("l_conv").alias("a_conv"), F.col("l_id").alias("a_id"), F.col("result").alias("a_at")), F.col("l_conv").eqNullSafe(F.col("a_conv")) & (F.col("l_id") == F.col("a_id"))).select("a_conv", "a_id", "a_at")
    orphans = said.where("kind = 'result'").join(used, F.col("conv").eqNullSafe(F.col("a_conv")) & (F.col("call_id") == F.col("a_id")) & at.eqNullSafe(F.col("a_at")) & (F.col("copy") == 1), "left_anti")
    orphans = orphans.select("conv", "turn", "place", "kind", "role", F.lit(None).cast("string").alias("text"), "call_id", "body", F.lit(None).cast("string").alias("result"))
    lines = messages.union(calls).union(orphans)
    types = dict(lines.dtypes)
    out = lines.mapInArrow(serialised(schemas or {}), f"conv {types['conv']}, turn {types['turn']}, place int, kind string, call_id string, status string, json string")
    levels = _levels(said, first, scratch).select(F.col("conv").alias("v_conv"), F.col("call_id").alias("v_id"), "level")
    out = out.join(levels, F.col("conv").eqNullSafe(F.col("v_conv")) & (F.col("call_id") == F.col("v_id")) & (F.col("kind") == "call"), "left")
    return out.select(F.col("conv").alias(conv_col), F.col("turn").alias(turn_col), "place", "kind", "call_id", "level", "status", "json")


def _levels(said: DataFrame, first: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv, call_id, level): 0 for a call that refers to none, else one more than the highest call referred to.

    A row (call_id, ref, w) says that the level is w + ref's or more, without ref that it is w or more. A round puts
    the levels found last in place of their calls; a call without a ref left has its level. A ref that waits for one
    call only gives way to that call, so distances double and a chain of n calls takes log2(n) rounds; a call has no
    more rows than it has references, and one. Further than a conversation has calls leads only a cycle.
    """
    known = first.where("kind = 'call'").select("conv", "call_id", F.array_distinct(F.regexp_extract_all("one.body", F.lit(REFERENCE))).alias("refs"))
    known = scratch.table(known, "known")
    there = known.select(F.col("conv").alias("k_conv"), F.col("call_id").alias("k_id"))

    def on(conv: str, call: str, name: str):
        return F.col("conv").eqNullSafe(F.col(conv)) & (F.col(name) == F.col(call))

    pairs = known.select("conv", "call_id", F.explode("refs").alias("ref")).join(there, on("k_conv", "k_id", "ref"))
    edges = scratch.table(pairs.select("conv", "call_id", "ref", F.lit(1).cast("long").alias("w")), "edges-0")
    longest = known.groupBy("conv").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    waits = edges.select(F.col("conv").alias("e_conv"), F.col("call_id").alias("e_id")).distinct()
    layer = scratch.table(known.join(waits, on("e_conv", "e_id", "call_id"), "left_anti").select("conv", "call_id", F.lit(0).cast("long").alias("level")), "layer-0")
    done, k = layer, 0
    while not edges.isEmpty():
        k += 1
        last = layer.select(F.col("conv").alias("d_conv"), F.col("call_id").alias("d_id"), "level")
        met = edges.join(last, on("d_conv", "d_id", "ref"), "left")
        met = met.select("conv", "call_id", F.when(F.col("level").isNull(), F.col("ref")).alias("ref"), (F.col("w") + F.coalesce("level", F.lit(0))).alias("w"))
        met = met.groupBy("conv", "call_id", "ref").agg(F.max("w").alias("w"))
        calls = met.groupBy(F.col("conv").alias("c_conv"), F.col("call_id").alias("c_id")).agg(F.count("ref").alias("open"))
        met = scratch.table(met.join(calls, on("c_conv", "c_id", "call_id")).drop("c_conv", "c_id"), f"met-{k}")
        layer = scratch.table(met.where("open = 0").select("conv", "call_id", F.col("w").alias("level")), f"layer-{k}")
        via = met.where("open = 1").select(F.col("conv").alias("v_conv"), F.col("call_id").alias("v_id"), F.col("ref").alias("v_ref"), F.col("w").alias("v_w"))
        on_from = met.where("open > 0").join(via, on("v_conv", "v_id", "ref"), "left")
        moved = F.col("v_id").isNotNull()
        on_from = on_from.select("conv", "call_id", F.when(moved, F.col("v_ref")).otherwise(F.col("ref")).alias("ref"), (F.col("w") + F.coalesce("v_w", F.lit(0))).alias("w"), moved.alias("moved"))
        on_from = scratch.table(on_from.groupBy("conv", "call_id", "ref").agg(F.max("w").alias("w"), F.max("moved").alias("moved")), f"moved-{k}")
        cyclic = on_from.where((F.col("w") > longest) & F.col("ref").isNotNull()).select(F.col("conv").alias("e_conv"), F.col("call_id").alias("e_id")).distinct()
        edges = scratch.table(on_from.join(cyclic, on("e_conv", "e_id", "call_id"), "left_anti"), f"edges-{k}")
        done = done.union(layer)
        if layer.isEmpty() and edges.where("moved").isEmpty():
            break
        edges = edges.drop("moved")
    return done.withColumn("level", F.col("level").cast("int"))
