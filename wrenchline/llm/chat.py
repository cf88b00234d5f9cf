"""Chat formatting: tool calls linked to their results, ordered, validated, and written as canonical JSON.

An event is a call, a result or a plain message. Calls and results meet by identifier:
both are counted per identifier first, so an identifier that a third of all rows share
is one row per task, and every event then looks up one row.

Topological levels: a call without known dependencies has level 0, its result the level
above it, and a call that waits for others the level above the highest of their results.
A chain of calls that each wait for one other is halved in every round; rounds beyond
that are as many as calls waiting for several others follow one another. Calls in a
cycle, or waiting for one, keep no level. (conv_id, level, turn, call_id) is an order in
which nothing precedes what it depends on.

Arguments keep their JSON types. Canonical JSON has the keys of every object in order, no
blanks, numbers without trailing zeros; fields of an event that have no value are left
out, a ``null`` that an argument was given stays.

Status: ``linked``; ``unanswered`` (a call without result); ``orphan`` (a result without
call); ``ambiguous`` (several calls share the identifier); ``cycle``; ``message``.

Rows: null texts are empty; rows without conv_id or turn are plain messages; JSON that
cannot be read is a plain text. Of an argument that a call repeats the last value counts;
arguments that are no object, or repeat a key further inside, are an error of the call, and its
text is then its content. Repeated rows stay repeated, and their identifiers are ambiguous.
Other columns of the input are not looked at, whatever their names.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wrenchline.llm.common import Stages


@dataclass(frozen=True)
class Field:
    """What a value must be: JSON types joined by ``|``, one of ``choices`` where given.

    ``fields`` describes the members of an object, ``items`` the elements of an array;
    ``closed`` objects hold no other members.
    """

    kind: str
    required: bool = False
    choices: tuple = ()
    fields: dict[str, Field] = field(default_factory=dict)
    items: Field | None = None
    closed: bool = False


#: Arguments of each tool by name. Calls of unknown tools are not valid. A pair (type, required)
#: also takes a string that spells a value of the type, as in "1" for 1.
Schemas = dict[str, dict[str, "Field | tuple[str, bool]"]]
#: The tool that a plain user turn calls: the assistant's reply.
REPLY: Schemas = {"reply": {"role": Field("string", True), "text": Field("string", True)}}
_SPELLED = {
    "string": r"(?s).*",
    "integer": r"-?(0|[1-9][0-9]*)",
    "number": r"-?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][+-]?[0-9]+)?",
    "boolean": "true|false",
    "object": r"(?s)\{.*\}",
    "array": r"(?s)\[.*\]",
}
_CALL = "tool_call struct<id:string,name:string,arguments:map<string,variant>,after:array<string>>"
_RESULT = "tool_result struct<id:string,content:string>"


def last_of_each(arguments: Column) -> Column:
    """The map with one value a key: of a key that a JSON object repeats, the last value counts."""
    keys, entries = F.map_keys(arguments), F.map_entries(arguments)
    repeated = lambda e, i: F.exists(F.slice(entries, i + 2, F.size(entries)), lambda later: later["key"] == e["key"])
    last = F.map_from_entries(F.filter(entries, lambda e, i: ~repeated(e, i)))
    return F.when(F.size(F.array_distinct(keys)) == F.size(keys), arguments).otherwise(last)


def events(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, kind, call_id, name, arguments, unreadable, content, after.

    A text may be a JSON object with ``tool_call`` or ``tool_result``. Else a user's turn is a
    call of ``reply``, and an assistant's turn the result of the turn before it. Of an
    argument that an object repeats the last value counts.
    """
    text = F.coalesce("text", F.lit(""))
    parsed = F.when(F.ltrim(text).startswith("{"), F.from_json(text, f"{_CALL}, {_RESULT}"))
    rows = conversations.select("conv_id", "turn", "role", text.alias("body"), parsed.alias("parsed"))
    call, result = F.col("parsed.tool_call"), F.col("parsed.tool_result")
    named = F.col("conv_id").isNotNull() & F.col("turn").isNotNull()
    is_call, is_result = named & call["id"].isNotNull(), named & result["id"].isNotNull()
    kind = (
        F.when(is_call, "call").when(is_result, "result")
        .when(named & (F.col("role") == "user"), "call").when(named & (F.col("role") == "assistant"), "result").otherwise("message")
    )
    scope = F.concat(F.col("conv_id").cast("string"), F.lit(":"))
    own = F.concat(scope, F.col("turn").cast("string"))
    before = F.concat(scope, (F.col("turn") - 1).cast("string"))
    plain_call = F.create_map(F.lit("role"), F.col("role").cast("variant"), F.lit("text"), F.col("body").cast("variant"))
    # Arguments are there and could not be read as an object.
    unreadable = is_call & call["arguments"].isNull() & F.coalesce(F.get_json_object("body", "$.tool_call.arguments") != "null", F.lit(False))
    none = F.array().cast("array<string>")
    return rows.select(
        "conv_id", "turn", kind.alias("kind"),
        F.when(is_call, F.concat(scope, F.lit("#"), call["id"])).when(is_result, F.concat(scope, F.lit("#"), result["id"]))
        .when(F.col("kind") == "call", own).when(F.col("kind") == "result", before).alias("call_id"),
        F.when(is_call, call["name"]).when(F.col("kind") == "call", F.lit("reply")).alias("name"),
        F.when(is_call, last_of_each(F.coalesce(call["arguments"], F.create_map().cast("map<string,variant>")))).when(F.col("kind") == "call", plain_call).alias("arguments"),
        unreadable.alias("unreadable"),
        F.when(is_result, result["content"]).when(unreadable, F.col("body")).when(F.col("kind") != "call", F.col("body")).alias("content"),
        F.when(is_call, F.transform(F.coalesce(call["after"], none), lambda i: F.concat(scope, F.lit("#"), i))).otherwise(none).alias("after"),
    )


def _is(value: Column, kinds: str) -> Column:
    """Whether a value that is there has one of the JSON types."""
    shape, text = F.schema_of_variant(value), F.to_json(value)
    number = shape.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)") & ~text.startswith('"')
    tests = {
        "string": shape == "STRING",
        "integer": number & text.rlike(r"^-?[0-9]+(\.0)?$"),
        "number": number,
        "boolean": shape == "BOOLEAN",
        "object": shape.startswith("OBJECT"),
        "array": shape.startswith("ARRAY"),
        "null": shape == "VOID",
    }
    found = F.lit(False)
    for kind in kinds.split("|"):
        found = found | tests[kind]
    return F.coalesce(found, F.lit(False))


def _member(name: str) -> str:
    quote = "'" if '"' in name else '"'
    return f"$[{quote}{name}{quote}]"


def _errors(value: Column, path: str, wanted: Field | tuple[str, bool]) -> Column:
    """What is wrong with a value (null: not there), as an array of texts."""
    none = F.array().cast("array<string>")
    if not isinstance(wanted, Field):
        kind, required = wanted
        text = F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string")).otherwise(F.to_json(value))
        there = F.when(~text.rlike(f"^(?:{_SPELLED[kind]})$"), F.array(F.lit(f"{path}: not {kind}")))
        required_ = required
    else:
        inner = none
        for name, member in sorted(wanted.fields.items()):
            inner = F.concat(inner, _errors(F.try_variant_get(value, _member(name), "variant"), f"{path}.{name}", member))
        if wanted.closed:
            known = F.array(*map(F.lit, sorted(wanted.fields))) if wanted.fields else none
            others = F.array_except(F.coalesce(F.json_object_keys(F.to_json(value)), none), known)
            inner = F.concat(inner, F.transform(others, lambda k: F.concat(F.lit(f"{path}."), k, F.lit(": unknown"))))
        if wanted.items is not None:
            elements = F.coalesce(F.try_variant_get(value, "$", "array<variant>"), F.array().cast("array<variant>"))
            each = F.transform(elements, lambda e: _errors(e, f"{path}[]", wanted.items))
            inner = F.concat(inner, F.array_distinct(F.flatten(each)))
        there = F.when(~_is(value, wanted.kind), F.array(F.lit(f"{path}: not {wanted.kind}")))
        if wanted.choices:
            allowed = [json.dumps(c, ensure_ascii=False, separators=(",", ":"), sort_keys=True) for c in wanted.choices]
            there = there.when(~F.to_json(value).isin(allowed), F.array(F.lit(f"{path}: not among its values")))
        there = there.otherwise(inner)
        required_ = wanted.required
    missing = F.array(F.lit(f"{path}: missing")) if required_ else none
    return F.when(value.isNull(), missing).otherwise(F.coalesce(there, none))


def argument_errors(schemas: Schemas) -> Column:
    """What is wrong with a call's arguments, sorted; empty for a valid call."""
    checks = F.array(F.lit("unknown tool"))
    for name, fields in sorted(schemas.items()):
        found = F.array().cast("array<string>")
        for argument, wanted in sorted(fields.items()):
            found = F.concat(found, _errors(F.element_at("arguments", argument), argument, wanted))
        known = F.array(*map(F.lit, sorted(fields))) if fields else F.array().cast("array<string>")
        extra = F.transform(F.array_except(F.map_keys("arguments"), known), lambda k: F.concat(k, F.lit(": unknown")))
        checks = F.when(F.col("name") == name, F.array_sort(F.concat(found, extra))).otherwise(checks)
    return F.when(F.col("unreadable"), F.array(F.lit("arguments: not readable"))).otherwise(checks)


def canonical_json() -> Column:
    """The event as JSON: keys in order at every depth, no blanks, fields without value left out."""
    keys = F.array_sort(F.map_keys("arguments"))
    return F.to_json(
        F.struct(
            F.map_from_arrays(keys, F.transform(keys, lambda k: F.element_at("arguments", k))).alias("arguments"),
            "content",
            F.col("conv_id").cast("string").alias("conv"),
            F.col("call_id").alias("id"),
            "name",
            "turn",
            F.col("kind").alias("type"),
        )
    )


def _shortened(jumps: DataFrame, stages: Stages) -> DataFrame:
    """Chains of calls that wait for one other, each led to its end; (call_id, needs, steps, least).

    A jump says: level = max(least, level of ``needs`` + ``steps``). Two jumps in a row are one,
    so the reach doubles each round. What never ends is a cycle, or leads to one, and is left out.
    """
    names = [F.col(c).alias(f"next_{c}") for c in ("call_id", "needs", "steps", "least")]
    rounds = jumps.count().bit_length() + 1
    for number in range(rounds + 1):
        ahead = jumps.select(*names)
        joined = jumps.join(ahead, F.col("needs") == F.col("next_call_id"), "left")
        if number == rounds or not joined.where("next_call_id IS NOT NULL").head(1):
            return joined.where("next_call_id IS NULL").select("call_id", "needs", "steps", "least")
        there = F.col("next_call_id").isNotNull()
        longer = stages.save(
            joined.select(
                "call_id",
                F.when(there, F.col("next_needs")).otherwise(F.col("needs")).alias("needs"),
                F.when(there, F.col("steps") + F.col("next_steps")).otherwise(F.col("steps")).alias("steps"),
                F.when(there, F.greatest("least", F.col("next_least") + F.col("steps"))).otherwise(F.col("least")).alias("least"),
            ),
            "jumps",
        )
        stages.drop(jumps)
        jumps = longer


def call_levels(found: DataFrame, stages: Stages) -> DataFrame | None:
    """(call_id, level) of calls that wait for a known other, or are waited for; None if none waits."""
    waits = found.where("kind = 'call' AND size(after) > 0").select("call_id", F.explode("after").alias("needs")).distinct()
    waits = stages.save(waits, "waits")
    if not waits.head(1):
        return None
    calls = found.where("kind = 'call'").groupBy("call_id").agg(F.count("*").alias("n")).where("n = 1").select("call_id")
    known = stages.save(waits.join(calls.withColumnRenamed("call_id", "needs"), "needs", "left_semi").select("call_id", "needs"), "known-waits")
    # A call that waits for none has level 0; others wait until all they need have one.
    done = stages.save(known.select(F.col("needs").alias("call_id")).distinct().join(known, "call_id", "left_anti").withColumn("level", F.lit(0).cast("bigint")), "level-0")
    left = known.withColumns({"steps": F.lit(2).cast("bigint"), "least": F.lit(0).cast("bigint")})
    while True:
        at = left.join(done.withColumnRenamed("call_id", "needs"), "needs", "left")
        at = stages.save(at.withColumn("least", F.greatest("least", F.col("level") + F.col("steps"))), "edges")
        per_call = at.groupBy("call_id").agg(
            F.sum(F.col("level").isNull().cast("bigint")).alias("open"),
            F.max("least").alias("bound"),
            F.max(F.when(F.col("level").isNull(), F.struct("needs", "steps"))).alias("only"),
        )
        per_call = stages.save(per_call, "open-needs")
        settled = per_call.where("open = 0").select("call_id", F.col("bound").alias("level"))
        chains = stages.save(per_call.where("open = 1").select("call_id", "only.needs", "only.steps", F.col("bound").alias("least")), "jumps")
        chains = stages.save(_shortened(chains, stages), "chains")
        ends = settled.unionByName(done).withColumnRenamed("call_id", "needs")
        arrived = chains.join(ends, "needs").select("call_id", F.greatest("least", F.col("level") + F.col("steps")).alias("level"))
        fresh = stages.save(settled.unionByName(arrived), "fresh")
        if not fresh.head(1):
            cycle = known.select("call_id").distinct().join(done, "call_id", "left_anti").withColumn("level", F.lit(None).cast("bigint"))
            return stages.save(done.unionByName(cycle), "levels")
        several = per_call.where("open > 1").select("call_id", "bound")
        rest = at.where("level IS NULL").join(several, "call_id").select("call_id", "needs", "steps", F.col("bound").alias("least"))
        waiting = stages.save(rest.unionByName(chains.join(fresh, "call_id", "left_anti").select("call_id", "needs", "steps", "least")), "left")
        total = stages.save(done.unionByName(fresh), "done")
        for used in (at, per_call, chains, fresh, done, *([left] if hasattr(left, "staged_path") else [])):
            stages.drop(used)
        done, left = total, waiting


def formatted(conversations: DataFrame, spark: SparkSession, schemas: Schemas = REPLY) -> DataFrame:
    """One row per message: conv_id, turn, kind, call_id, level, status, errors, json."""
    stages = Stages(spark)
    found = events(conversations)
    per_id = found.where("call_id IS NOT NULL").groupBy("call_id").agg(
        F.sum((F.col("kind") == "call").cast("bigint")).alias("n_calls"), F.sum((F.col("kind") == "result").cast("bigint")).alias("n_results")
    )
    linked = found.join(per_id, "call_id", "left")
    levels = call_levels(found, stages)
    if levels is None:
        linked = linked.withColumns({"call_level": F.lit(0), "cyclic": F.lit(False)})
    else:
        linked = linked.join(levels.withColumn("listed", F.lit(True)), "call_id", "left")
        linked = linked.withColumns({"cyclic": F.col("listed").isNotNull() & F.col("level").isNull(), "call_level": F.when(F.col("listed").isNull(), 0).otherwise(F.col("level"))})
    status = (
        F.when(F.col("kind") == "message", "message").when(F.col("n_calls") > 1, "ambiguous").when(F.col("cyclic"), "cycle")
        .when(F.col("n_calls") == 0, "orphan").when(F.col("n_results") == 0, "unanswered").otherwise("linked")
    )
    level = F.when(F.col("kind") == "call", F.col("call_level")).when((F.col("kind") == "result") & (F.col("n_calls") > 0), F.col("call_level") + 1).otherwise(0)
    return linked.select(
        "conv_id", "turn", "kind", "call_id", F.when(~F.col("cyclic"), level).cast("int").alias("level"), status.alias("status"),
        F.when(F.col("kind") == "call", F.array_join(argument_errors(schemas), "; ")).alias("errors"), canonical_json().alias("json"),
    )


ORACLE = """
WITH e AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS t,
         CASE role WHEN 'user' THEN 'call' WHEN 'assistant' THEN 'result' ELSE 'message' END AS kind,
         conv_id::VARCHAR || ':' || CASE role WHEN 'user' THEN turn WHEN 'assistant' THEN turn - 1 END::VARCHAR AS call_id
  FROM conversations
), n AS (
  SELECT call_id, count(*) FILTER (WHERE kind = 'call') AS c, count(*) FILTER (WHERE kind = 'result') AS r
  FROM e WHERE call_id IS NOT NULL GROUP BY call_id
)
SELECT conv_id, turn, kind, call_id, CASE WHEN kind = 'result' AND c > 0 THEN 1 ELSE 0 END AS level,
       CASE WHEN kind = 'message' THEN 'message' WHEN c > 1 THEN 'ambiguous' WHEN c = 0 THEN 'orphan'
            WHEN r = 0 THEN 'unanswered' ELSE 'linked' END AS status,
       CASE WHEN kind = 'call' THEN '' END AS errors,
       CASE kind
         WHEN 'call' THEN '{"arguments":{"role":"user","text":' || to_json(t)::VARCHAR || '},"conv":"' || conv_id || '","id":"' || call_id ||
                          '","name":"reply","turn":' || turn || ',"type":"call"}'
         WHEN 'result' THEN '{"content":' || to_json(t)::VARCHAR || ',"conv":"' || conv_id || '","id":"' || call_id || '","turn":' || turn || ',"type":"result"}'
         ELSE '{"content":' || to_json(t)::VARCHAR || ',"conv":"' || conv_id || '","turn":' || turn || ',"type":"message"}'
       END AS json
FROM e LEFT JOIN n USING (call_id)
"""
