"""Chat formatting with tool calls: linking, ordering, validation and canonical JSON.

Messages are rows (conversation, turn, role, text). A text that is a JSON object with ``tool_calls`` holds
calls (``id``, ``name``, ``arguments``); one with ``tool_call_id`` is a result. Everything else is prose.
Calls and results meet by a hash join on conversation and identifier. An argument ``{"$ref": id}`` makes a call
wait for another call's result. Chains of calls with one reference each are followed by pointer doubling to where
they begin; calls with several references are settled by rounds, when all they refer to is settled, and carry the
chains that begin at them. What is left is a cycle or refers to nothing. Arguments are checked against a schema for each tool, and every message becomes one line of
canonical JSON (sorted keys, no spaces). A conversation is never gathered: its lines are rows ordered by
(level, turn, part), however long it is.

Null texts are empty prose. A repeated identifier counts once, at its first place (turn, then content); later ones are
``duplicate``. Texts that look like JSON but are not, or have the wrong shape, stay prose.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbwatch.llm.common import map_rows
from kerbwatch.session import materialise

_PARTS = "conv_id {k}, turn {t}, role string, part int, kind string, id string, name string, body string, refs array<string>"


def canonical(value) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def references(value) -> list[str]:
    """Identifiers that arguments refer to, at any depth."""
    if isinstance(value, dict):
        own = [value["$ref"]] if set(value) == {"$ref"} and isinstance(value["$ref"], str) else []
        return own + [r for v in value.values() for r in references(v)]
    return [r for v in value for r in references(v)] if isinstance(value, list) else []


def parts_of(text: str | None) -> list[tuple[str, str | None, str | None, str, list[str]]]:
    """(kind, id, name, body, references) of a message's parts."""
    if text and text.lstrip()[:1] == "{":
        try:
            value = json.loads(text)
            if isinstance(value.get("tool_call_id"), str):
                return [("result", value["tool_call_id"], None, canonical(value.get("content")), [])]
            calls = value.get("tool_calls")
            if isinstance(calls, list) and calls and all(isinstance(c, dict) and isinstance(c.get("id"), str) for c in calls):
                head = [("prose", None, None, canonical(value["content"]), [])] if value.get("content") else []
                return head + [("call", c["id"], str(c.get("name")), canonical(c.get("arguments")),
                                sorted(set(references(c.get("arguments"))))) for c in calls]
        except (ValueError, RecursionError):
            pass
    return [("prose", None, None, canonical(text or ""), [])]


def parts(messages: DataFrame) -> DataFrame:
    """One row for each part of each message."""
    def make():
        return lambda c, t, r, x: (c, t, r, [{"part": i, "kind": p[0], "id": p[1], "name": p[2], "body": p[3], "refs": p[4]}
                                             for i, p in enumerate(parts_of(x))])

    kinds = {c: messages.schema[c].dataType.simpleString() for c in ("conv_id", "turn")}
    inner = "array<struct<part:int,kind:string,id:string,name:string,body:string,refs:array<string>>>"
    rows = map_rows(messages.select("conv_id", "turn", "role", "text"), make,
                    f"conv_id {kinds['conv_id']}, turn {kinds['turn']}, role string, p {inner}")
    return rows.select("conv_id", "turn", "role", F.explode("p").alias("p")).select("conv_id", "turn", "role", "p.*")


def check(arguments: str, schema: dict | None) -> str | None:
    """What is wrong with canonical arguments, or None. Schemas have properties (type, enum), required and closed."""
    if schema is None:
        return "unknown tool"
    value = json.loads(arguments)
    if not isinstance(value, dict):
        return "arguments are no object"
    kinds = {"string": str, "integer": int, "number": (int, float), "boolean": bool, "object": dict, "array": list, "null": type(None)}
    if missing := sorted(set(schema.get("required", ())) - set(value)):
        return f"missing {missing[0]}"
    for name, v in value.items():
        rule = schema.get("properties", {}).get(name)
        if rule is None:
            if schema.get("closed"):
                return f"unexpected {name}"
            continue
        if isinstance(v, dict) and set(v) == {"$ref"}:
            continue
        if "type" in rule and (not isinstance(v, kinds[rule["type"]]) or isinstance(v, bool) and rule["type"] in ("integer", "number")):
            return f"{name} is no {rule['type']}"
        if "enum" in rule and v not in rule["enum"]:
            return f"{name} is not allowed"
    return None


def _anchored(calls: DataFrame) -> DataFrame:
    """conv_id, id, anchor and steps: the call without or with several references that a chain of single ones leads to.

    Pointers are doubled, so rounds grow with the logarithm of the longest chain. When a round brings no call to its
    anchor, those still on their way go round in a cycle; they and what refers to nothing are left out.
    """
    n = F.size("refs")
    ends = calls.where(n != 1).select("conv_id", "id", F.col("id").alias("anchor"), F.lit(0).cast("bigint").alias("steps"))
    open_ = calls.where(n == 1).select("conv_id", "id", F.get("refs", F.lit(0)).alias("ref"), F.lit(1).cast("bigint").alias("steps"))
    ends, open_ = materialise(ends, "call-anchors"), materialise(open_, "call-pointers")
    out = ends
    while open_.take(1):
        at = out.select("conv_id", F.col("id").alias("ref"), "anchor", F.col("steps").alias("behind"))
        found = materialise(open_.join(at, ["conv_id", "ref"]).select("conv_id", "id", "anchor", (F.col("steps") + F.col("behind")).alias("steps")), "call-anchors")
        if not found.take(1):
            break
        out = out.unionByName(found)
        far = open_.select("conv_id", F.col("id").alias("ref"), F.col("ref").alias("next"), F.col("steps").alias("behind"))
        left = open_.join(found.select("conv_id", "id"), ["conv_id", "id"], "left_anti")
        # a reference to nothing has no further pointer and ends here
        open_ = materialise(left.join(far, ["conv_id", "ref"]).select("conv_id", "id", F.col("next").alias("ref"), (F.col("steps") + F.col("behind")).alias("steps")),
                            "call-pointers")
    return out


def _levels(calls: DataFrame) -> DataFrame:
    """conv_id, id, level: one more than the highest call referred to; null in cycles and after dangling ones."""
    chains = materialise(_anchored(calls), "call-chains")
    none, several = F.size("refs") == 0, F.size("refs") > 1
    newest = materialise(calls.where(none).select("conv_id", F.col("id").alias("anchor"), F.lit(0).cast("bigint").alias("high")), "call-levels")
    waiting = materialise(calls.where(several).select("conv_id", "id", F.size("refs").alias("n")), "calls-waiting")
    edges = materialise(calls.where(several).select("conv_id", "id", F.explode("refs").alias("ref")), "call-references")
    out, done = newest, edges.limit(0).select("conv_id", "id", F.lit(0).cast("bigint").alias("met"), F.lit(0).cast("bigint").alias("high"))
    while waiting.take(1) and newest.take(1):
        level = chains.join(newest, ["conv_id", "anchor"]).select("conv_id", F.col("id").alias("ref"), (F.col("high") + F.col("steps")).alias("level"))
        met = edges.join(level, ["conv_id", "ref"]).groupBy("conv_id", "id").agg(F.count("*").alias("met"), F.max("level").alias("high"))
        done = materialise(done.unionByName(met).groupBy("conv_id", "id").agg(F.sum("met").alias("met"), F.max("high").alias("high")), "call-levels")
        ready = waiting.join(done, ["conv_id", "id"]).where("met = n")
        newest = materialise(ready.select("conv_id", F.col("id").alias("anchor"), (F.col("high") + 1).alias("high")), "call-levels")
        waiting = materialise(waiting.join(newest.select("conv_id", F.col("anchor").alias("id")), ["conv_id", "id"], "left_anti"), "calls-waiting")
        out = out.unionByName(newest)
    return chains.join(out, ["conv_id", "anchor"]).select("conv_id", "id", (F.col("high") + F.col("steps")).cast("int").alias("level"))


def format_chat(messages: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """conv_id, turn, part, role, kind, id, level, status, error and json for every part of every message.

    level orders a conversation's lines: a call's level, its result's the same (the result's turn is later), prose
    has that of its turn alone (0). status is ``linked``, ``no result``, ``no call``, ``duplicate``, ``unordered``
    (a cycle or a missing reference) or ``prose``.
    """
    rows = materialise(parts(messages), "chat-parts")
    tools = rows.where("kind <> 'prose'")
    first = tools.groupBy("conv_id", "kind", "id").agg(F.min(F.struct("turn", "body", "part", "role")).alias("at"))
    first = materialise(first, "chat-first")
    calls = first.where("kind = 'call'").select("conv_id", "id", F.lit(True).alias("has_call"))
    results = first.where("kind = 'result'").select("conv_id", "id", F.lit(True).alias("has_result"))
    links = calls.join(results, ["conv_id", "id"], "full")
    body = tools.where("kind = 'call'").groupBy("conv_id", "id").agg(F.min_by("refs", F.struct("turn", "body", "part", "role")).alias("refs"))
    known = _levels(body)
    facts = links.join(known, ["conv_id", "id"], "left").join(
        first.select("conv_id", F.col("kind").alias("k"), "id", "at"), ["conv_id", "id"])
    own = (F.col("at.turn") == F.col("turn")) & (F.col("at.body") == F.col("body")) & (F.col("at.part") == F.col("part"))
    # of rows that repeat in everything one is the first place, the others are duplicates
    same = Window.partitionBy("conv_id", "kind", "id", "turn", "part", "body").orderBy("role")
    rows = rows.withColumn("copy", F.when(F.col("kind") == "prose", F.lit(1)).otherwise(F.row_number().over(same)))
    judged = rows.alias("r").join(facts.alias("f"), (F.col("r.conv_id") == F.col("f.conv_id")) & (F.col("r.id") == F.col("f.id"))
                                  & (F.col("r.kind") == F.col("f.k")), "left")
    status = (F.when(F.col("kind") == "prose", "prose").when(~own | (F.col("copy") > 1), "duplicate")
              .when((F.col("kind") == "result") & F.col("has_call").isNull(), "no call")
              .when((F.col("kind") == "call") & F.col("level").isNull(), "unordered")
              .when((F.col("kind") == "call") & F.col("has_result").isNull(), "no result").otherwise("linked"))
    judged = judged.select("r.*", F.coalesce("level", F.lit(0)).alias("level"), status.alias("status")).drop("copy")

    def make():
        def line(conv, turn, part, role, kind, id_, name, body_, level, status_):
            error = check(body_, schemas.get(name)) if kind == "call" else None
            value = {"role": role, "type": kind, "content": json.loads(body_)}
            if kind != "prose":
                value["id"] = id_
            if kind == "call":
                value["name"] = name
            return conv, turn, part, role, kind, id_, level, status_, error, canonical(value)
        return line

    k, t = (messages.schema[c].dataType.simpleString() for c in ("conv_id", "turn"))
    return map_rows(judged.select("conv_id", "turn", "part", "role", "kind", "id", "name", "body", "level", "status"), make,
                    f"conv_id {k}, turn {t}, part int, role string, kind string, id string, level int, status string, error string, json string")


def as_tool_chat(turns: DataFrame) -> DataFrame:
    """Conversation turns as tool traffic: a user's turn becomes a call, the assistant's next turn its result.

    Every call refers to the call before it, if there can be one, so chains are as long as conversations. By a checksum
    of the text some calls refer to themselves, to two calls, take the identifier of the call before, name no known tool, or
    have arguments that their schema does not allow. It is how the benchmark table, which has no tools, gets something to link.
    """
    said = F.coalesce("text", F.lit(""))
    lot = F.crc32(F.concat_ws("|", F.col("conv_id").cast("string"), F.col("turn").cast("string"), said))

    def at(back: int) -> Column:
        return F.concat_ws("-", F.col("conv_id"), F.col("turn") - back)

    def ref(target: Column) -> Column:
        return F.struct(target.alias("$ref"))

    later = F.col("turn") >= 2
    call_id = F.when(later & (lot % 53 == 3), at(2)).otherwise(at(0))
    after = F.when(later, ref(F.when(lot % 101 == 4, call_id).otherwise(at(2))))
    arguments = F.struct(
        F.when(lot % 59 != 5, said).alias("query"), F.when(lot % 61 == 6, F.length(said).cast("string")).alias("size_text"),
        F.when(lot % 61 != 6, F.length(said)).alias("size"), after.alias("after"), F.when((F.col("turn") >= 4) & (lot % 43 == 7), ref(at(4))).alias("also"))
    name = F.when(lot % 67 == 8, "tell").otherwise("ask")
    call = F.to_json(F.struct(F.array(F.struct(call_id.alias("id"), name.alias("name"), arguments.alias("arguments"))).alias("tool_calls")))
    result = F.to_json(F.struct(at(1).alias("tool_call_id"), said.alias("content")))
    text = F.when(F.col("role") == "user", call).when(F.col("role") == "assistant", result).otherwise(F.col("text"))
    return turns.select("conv_id", "turn", "role", text.alias("text"))


ASK = {"ask": {"required": ["query", "size"], "closed": True,
               "properties": {"query": {"type": "string"}, "size": {"type": "integer"}, "after": {"type": "object"}, "also": {"type": "object"}}}}
