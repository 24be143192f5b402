"""Chat formatting with linked tool calls (operator 10).

Messages are plain, a tool call (``call_id``, ``tool``, ``arguments`` as JSON,
``after``: ids of calls it needs) or a tool's result (``call_id``).

* Calls and results are hash-joined by conversation and identifier.
* Records are ordered topologically.  A call's place starts as its turn and is
  raised above the places of the calls it needs; places are pairs (turn, step)
  that rise along every dependency.  Dependency paths are doubled, so a
  chain takes as many rounds as its length has binary digits.  A call on a
  dependency cycle, or after one, has a path longer than its conversation has
  calls; it is marked and keeps its turn.
* Arguments are validated against the tool's schema, a JSON Schema subset:
  type, properties, required, additionalProperties, items, enum, minimum,
  maximum, minLength, maxLength.
* Each record is one line of canonical JSON: keys sorted, no white space,
  characters unescaped where JSON allows.

All steps are aggregates and joins by identifier, so a conversation of any
length stays spread; records carry their place instead of being gathered.

Defined results: null text is an empty content; a call or result with a null
conversation or id links with nothing and has a record of its own; of an id used
twice in a conversation the first call and the first result by (turn, content)
link, and each later one is a record with the status ``duplicate``;
dependencies on unknown ids or on itself are reported and otherwise ignored;
repeated plain messages stay; an empty table gives no records.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import Scratch

_TYPES = {
    "string": lambda v: isinstance(v, str),
    "integer": lambda v: isinstance(v, int) and not isinstance(v, bool),
    "number": lambda v: isinstance(v, (int, float)) and not isinstance(v, bool),
    "boolean": lambda v: isinstance(v, bool),
    "object": lambda v: isinstance(v, dict),
    "array": lambda v: isinstance(v, list),
    "null": lambda v: v is None,
}


def violations(value, schema: Mapping, path: str = "$") -> list[str]:
    """Where and how a value breaks its schema, in a fixed order."""
    kind = schema.get("type")
    if kind and not _TYPES[kind](value):
        return [f"{path}: not of type {kind}"]
    out = []
    if "enum" in schema and value not in schema["enum"]:
        out.append(f"{path}: not in enum")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{path}.{k}: missing" for k in schema.get("required", ()) if k not in value]
        for k in sorted(value):
            if k in known:
                out += violations(value[k], known[k], f"{path}.{k}")
            elif schema.get("additionalProperties", True) is False:
                out.append(f"{path}.{k}: unknown")
    elif isinstance(value, list):
        for i, v in enumerate(value):
            out += violations(v, schema.get("items", {}), f"{path}[{i}]")
    elif isinstance(value, str):
        if len(value) < schema.get("minLength", 0):
            out.append(f"{path}: too short")
        if len(value) > schema.get("maxLength", len(value)):
            out.append(f"{path}: too long")
    elif _TYPES["number"](value):
        if value < schema.get("minimum", value):
            out.append(f"{path}: below minimum")
        if value > schema.get("maximum", value):
            out.append(f"{path}: above maximum")
    return out


def canonical(value) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def _record(kind, role, text, call_id, tool, arguments, result, schemas) -> tuple[str, list[str]]:
    """Canonical JSON of one record and its arguments' faults."""
    if kind == "message":
        return canonical({"content": text, "role": role}), []
    out, faults = {"role": "assistant", "type": "tool_call", "id": call_id, "name": tool}, []
    if kind == "result":
        return canonical({"role": "tool", "id": call_id, "content": result}), []
    try:
        value = json.loads(arguments if arguments is not None else "null")
    except ValueError:
        value, faults = arguments, ["$: not JSON"]
    else:
        faults = violations(value, schemas[tool]) if tool in schemas else ["unknown tool"]
    out["arguments"] = value
    if result is not None:
        out["result"] = result
    return canonical(out), faults


def _places(calls: DataFrame, scratch: Scratch, report: Callable[[int], None] | None = None) -> DataFrame:
    """``row, place, cyclic`` for calls that need others or are needed.

    A call's place is the latest turn among the calls it needs, directly or
    through others, or its own, and the most needs in a row that lead there
    from a call of that turn; ``cyclic`` calls, which lead to a cycle, have none.

    Paths are doubled: round k knows the best place over paths of fewer than
    2^k needs and, as edges, which calls are exactly 2^k needs away, so the rounds
    are the logarithm of the longest chain.  A path as long as its conversation
    has calls has gone round a cycle.  ``first`` marks the calls that an id
    stands for; every call may need them.  ``report`` gets the number of rounds.
    """
    known = calls.where("first").select("conv_id", F.col("call_id").alias("id"), F.col("row").alias("needs"))
    edges = scratch.table(calls.select("conv_id", "call_id", "row", F.explode("after").alias("id"))
                          .where("NOT id <=> call_id").join(known, ["conv_id", "id"])
                          .select("conv_id", "row", "needs").distinct())
    met = edges.select("row").unionByName(edges.select(F.col("needs").alias("row"))).distinct()
    own = F.struct(F.col("turn").alias("turn"), F.lit(0).alias("step"))
    best = scratch.table(calls.join(met, "row").select("conv_id", "row", own.alias("place")))
    sizes = scratch.table(best.groupBy("conv_id").agg(F.count("*").alias("n")))
    turning, rounds = [], 0
    while not edges.isEmpty():
        far = F.struct(F.col("p.turn").alias("turn"), (F.col("p.step") + (1 << rounds)).alias("step"))
        above = (edges.join(best.select(F.col("row").alias("needs"), F.col("place").alias("p")), "needs")
                 .groupBy("row").agg(F.max(far).alias("above")))
        raised = scratch.table(best.join(above, "row", "left").select(
            "conv_id", "row", F.greatest("place", F.coalesce("above", "place")).alias("place")))
        further = (edges.withColumnRenamed("needs", "half").join(edges.select(F.col("row").alias("half"), "needs"), "half")
                   .select("conv_id", "row", "needs").distinct())
        rounds += 1
        doubled = scratch.table(further.join(sizes, "conv_id"))
        turning.append(scratch.table(doubled.where(F.col("n") <= 1 << rounds).select("row").distinct()))
        rest = scratch.table(doubled.where(F.col("n") > 1 << rounds).drop("n"))
        scratch.drop(best, edges, doubled)
        best, edges = raised, rest
    if report:
        report(rounds)
    if not turning:
        return best.select("row", "place", F.lit(False).alias("cyclic"))
    lost = reduce(DataFrame.unionByName, turning).distinct().withColumn("cyclic", F.lit(True))
    return best.join(lost, "row", "left").select("row", "place", F.coalesce("cyclic", F.lit(False)).alias("cyclic"))


def format_chats(messages: DataFrame, schemas: Mapping[str, Mapping]) -> DataFrame:
    """``conv_id, turn, step, kind, call_id, status, n_calls, n_results, faults, json``: one row per record.

    Ordered by (turn, step) a conversation's records are in topological
    order.  ``status`` of a call is ``linked``, ``unanswered`` or, if an earlier
    one has its id, ``duplicate``, followed by ``,cyclic`` if its dependencies have
    no order; of a result without a call ``orphan``, of one after an id's first
    ``duplicate``; of a plain message ``plain``.  ``call_id`` is the id that a record
    stands for, so it is null in duplicates, whose id is in ``json``; ``n_calls`` and
    ``n_results`` count an id's rows at its first record and are 0 in duplicates.
    """
    scratch = Scratch(messages.sparkSession, "chat")
    schemas = dict(schemas)
    rows = messages.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role",
        F.coalesce("text", F.lit("")).alias("text"), "call_id", "tool", "arguments",
        F.coalesce("after", F.array().cast("array<string>")).alias("after"))
    is_call, is_result = F.col("tool").isNotNull(), F.col("role") == "tool"
    by = ["conv_id", "call_id"]
    # a stored number tells rows apart that are equal in all columns
    links = scratch.table(rows.where(is_call | is_result).withColumn("row", F.monotonically_increasing_id()))
    named = links.where("conv_id IS NOT NULL AND call_id IS NOT NULL")
    of_calls, of_results = links.where(is_call), links.where(~is_call)
    first_calls = scratch.table(named.where(is_call).groupBy(*by).agg(
        F.min(F.struct("turn", "tool", "arguments", "after", "row"))["row"].alias("row"), F.count("*").alias("n_calls")))
    first_results = scratch.table(named.where(~is_call).groupBy(*by).agg(
        F.min(F.struct("turn", "text", "row"))["row"].alias("row"), F.count("*").alias("n_results")))
    # joined by row, so that an id of many rows stays spread; rows without a match are no id's first
    calls = scratch.table(of_calls.join(first_calls.select("row", "n_calls"), "row", "left").select(
        *by, "row", "turn", "tool", "arguments", "after", "n_calls", F.col("n_calls").isNotNull().alias("first")))
    results = scratch.table(of_results.join(first_results.select("row", "n_results"), "row", "left").select(
        *by, F.col("turn").alias("result_turn"), F.col("text").alias("result"), "n_results"))
    places = _places(calls, scratch)
    lone = F.col("conv_id").isNull() | F.col("call_id").isNull()
    again = {"n_calls": F.lit(0), "n_results": F.lit(0), "duplicate": ~lone}
    linked = (calls.where("first").drop("after", "first").join(results.where("n_results IS NOT NULL"), by, "full")
              .withColumn("duplicate", F.lit(False)))
    rest = (calls.where("NOT first").drop("after", "first").withColumns(again | {"n_calls": F.when(lone, 1).otherwise(0)})
            .unionByName(results.where("n_results IS NULL")
                         .withColumns(again | {"n_results": F.when(lone, 1).otherwise(0)}), allowMissingColumns=True))
    linked = linked.unionByName(rest, allowMissingColumns=True).join(places, "row", "left")
    kind = F.when(F.col("tool").isNotNull(), "call").otherwise("result")
    cyclic = F.coalesce("cyclic", F.lit(False))
    status = F.concat(F.when(F.col("duplicate"), "duplicate").when(F.col("tool").isNull(), "orphan")
                      .when(F.col("result").isNull(), "unanswered").otherwise("linked"),
                      F.when(cyclic, ",cyclic").otherwise(""))
    turn = F.coalesce("turn", "result_turn")
    records = linked.select(
        "conv_id", F.when(cyclic | F.col("place").isNull(), turn).otherwise(F.col("place.turn")).alias("turn"),
        F.when(cyclic | F.col("place").isNull(), F.lit(0)).otherwise(F.col("place.step")).alias("step"),
        kind.alias("kind"), F.lit("").alias("role"), F.lit("").alias("text"), "call_id", "tool", "arguments", "result", "duplicate",
        status.alias("status"), F.coalesce("n_calls", F.lit(0)).cast("long").alias("n_calls"),
        F.coalesce("n_results", F.lit(0)).cast("long").alias("n_results"))
    plain = rows.where(~is_call & ~F.coalesce(is_result, F.lit(False))).select(
        "conv_id", "turn", F.lit(0).alias("step"), F.lit("message").alias("kind"), "role", "text",
        F.lit(None).cast("string").alias("call_id"), F.lit(None).cast("string").alias("tool"),
        F.lit(None).cast("string").alias("arguments"), F.lit(None).cast("string").alias("result"), F.lit(False).alias("duplicate"),
        F.lit("plain").alias("status"), F.lit(0).cast("long").alias("n_calls"), F.lit(0).cast("long").alias("n_results"))

    names = ["conv_id", "turn", "step", "kind", "call_id", "status", "n_calls", "n_results"]

    def write(batches):
        for batch in batches:
            fields = [batch.column(c).to_pylist() for c in ("kind", "role", "text", "call_id", "tool", "arguments", "result")]
            done = [_record(*values, schemas) for values in zip(*fields)]
            ids = pc.if_else(batch.column("duplicate"), pa.scalar(None, pa.string()), batch.column("call_id"))
            yield pa.RecordBatch.from_arrays(
                [*[ids if c == "call_id" else batch.column(c) for c in names], pa.array([f for _, f in done], pa.list_(pa.string())),
                 pa.array([j for j, _ in done], pa.string())], [*names, "faults", "json"])

    return records.unionByName(plain).mapInArrow(
        write, "conv_id bigint, turn bigint, step int, kind string, call_id string, status string, n_calls bigint, "
               "n_results bigint, faults array<string>, json string")


# The tools of the derived view and their schemas.
TOOLS = {
    "search": {"type": "object", "required": ["query"], "additionalProperties": False,
               "properties": {"query": {"type": "string", "minLength": 1, "maxLength": 60},
                              "limit": {"type": "integer", "minimum": 1, "maximum": 200}}},
    "summarise": {"type": "object", "required": ["text", "words"],
                  "properties": {"text": {"type": "string"}, "words": {"type": "integer", "minimum": 5}}},
    "translate": {"type": "object", "required": ["text", "to"],
                  "properties": {"text": {"type": "string"}, "to": {"type": "string", "enum": ["de", "en", "es", "fr"]}}},
}


def as_tool_dialogue(conversations: DataFrame) -> DataFrame:
    """Reads plain conversations as dialogues with tools.

    An assistant's turn is a call whose tool and arguments come from its
    place and text, a user's turn after the first answers the turn before,
    and calls need the call before them.  Texts are arguments as they are; one
    that its tool's schema doesn't admit is reported among the faults.  Every
    tenth conversation logs pairs of calls in the wrong order; some need each other.
    """
    t, c = F.col("turn"), F.col("conv_id")
    is_call, is_result = F.col("role") == "assistant", (F.col("role") == "user") & (t > 0)
    call = lambda turn: F.concat(c.cast("string"), F.lit(":"), turn.cast("string"))
    words = F.size(F.split("text", " "))
    tool = F.element_at(F.array(*[F.lit(n) for n in sorted(TOOLS)]), (F.pmod(t, F.lit(3)) + 1).cast("int"))
    arguments = F.when(tool == "search", F.to_json(F.struct(F.col("text").alias("query"), words.alias("limit")))) \
        .when(tool == "summarise", F.to_json(F.struct(words.alias("words"), F.col("text")))) \
        .otherwise(F.to_json(F.struct(F.substring("text", 1, 2).alias("to"), F.col("text"))))
    early = (F.pmod(c, F.lit(10)) == 3) & (F.pmod(t, F.lit(4)) == 1)
    needs = (F.when(early, F.array(call(t + 2)))
             .when((F.pmod(c, F.lit(50)) == 23) & (F.pmod(t, F.lit(4)) == 3), F.array(call(t - 2)))
             .when((F.pmod(c, F.lit(10)) != 3) & (t >= 3), F.array(call(t - 2))))
    return conversations.select(
        c, t, F.when(is_result, "tool").otherwise(F.col("role")).alias("role"), "text",
        F.when(is_call, call(t)).when(is_result, call(t - 1)).alias("call_id"),
        F.when(is_call, tool).alias("tool"), F.when(is_call, arguments).alias("arguments"),
        F.when(is_call, needs).alias("after"))
