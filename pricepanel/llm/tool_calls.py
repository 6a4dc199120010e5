"""Chat formatting with tool calls linked to their results.

Calls and results are joined by conversation and call id. Calls are put in a topological
order: after everything they depend on, and otherwise by turn. Arguments are validated
against the schema of their tool, and every event becomes one line of canonical JSON: keys
sorted, no white space, text unescaped.

Nothing gathers a conversation in one task. The order is a pair (turn, step) per event: a
call that depends on a later one takes over its turn and comes a step after it. These pairs
are relaxed along the dependencies by joins until none is violated, in rounds as many as the
longest chain of dependencies against the order of turns. Conversations that are not settled
after ``MAX_ROUNDS`` are settled from their first calls on: each round, by joins on the call,
calls whose parents are all settled are settled, and links to a call with a single open
parent are passed on to that parent, so that chains halve. What is left lies in or behind a
circle. Peeled from the last calls too, it is what lies in circles or between two; tangles
are told apart by the greatest ancestor of each call, in rounds as many as the longest path
in them. Places in a conversation come from one order over all events.

Each call has a status: ``ok``, ``invalid_arguments``, ``unknown_tool``, ``missing_result``
or ``cyclic`` (it depends on itself in a circle; calls that only come after one are not
cyclic). Calls of one circle go by turn, and after what they depend on outside of it. Results without a call are kept as events of
their own with status ``orphan_result``, and other messages have status ``message``.

Edge cases: if an id has several results the one of the first turn counts, and of several
calls with one id each gets it. Dependencies on ids that do not exist are ignored. A null id
does not exist: nothing depends on it, and calls and results without an id belong to no other
event; such a call still comes after what it depends on. A null turn lies before all others
of its conversation. Null texts
are null in the JSON. Events without a conversation share one. Empty tables give an empty
result. Other columns are not touched.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricepanel.llm.common import running_total, written
from pricepanel.tables import lookup_join, materialize, null_safe_join

MAX_ROUNDS = 32
CALL = "conv_id long, call_id string, turn long, name string, arguments string, depends_on array<string>"
RESULT = "conv_id long, call_id string, turn long, content string"
MESSAGE = "conv_id long, turn long, role string, content string"
SCHEMAS = "name string, schema string"
_KEYS = ["conv_id", "call_id"]
# More steps than any chain has; keeps the steps around a circle from growing on.
_FAR = 1 << 40


def canonical(value) -> str:
    """Canonical JSON: sorted keys, no white space, whole floats as integers."""

    def plain(x):
        if isinstance(x, float):
            if not math.isfinite(x):
                raise ValueError("JSON has no such number")
            return int(x) if x.is_integer() and abs(x) < 1 << 53 else x
        if isinstance(x, dict):
            return {str(k): plain(v) for k, v in x.items()}
        return [plain(v) for v in x] if isinstance(x, list) else x

    return json.dumps(
        plain(value), sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False
    )


def _is_type(value, name: str) -> bool:
    number = isinstance(value, int | float) and not isinstance(value, bool)
    return {
        "object": isinstance(value, dict),
        "array": isinstance(value, list),
        "string": isinstance(value, str),
        "boolean": isinstance(value, bool),
        "null": value is None,
        "number": number,
        "integer": number and float(value).is_integer(),
    }.get(name, True)


def violations(value, schema: dict, at: str = "$") -> list[str]:
    """What a value breaks of a JSON schema: types, bounds, enums, properties and items."""
    types = schema.get("type", [])
    types = [types] if isinstance(types, str) else types
    if types and not any(_is_type(value, t) for t in types):
        return [f"{at}: not of type {'/'.join(types)}"]
    found = []
    if "enum" in schema and value not in schema["enum"]:
        found.append(f"{at}: not one of the allowed values")
    if isinstance(value, str):
        found += _bounds(len(value), schema, "minLength", "maxLength", f"{at}: length")
    elif isinstance(value, list):
        found += _bounds(len(value), schema, "minItems", "maxItems", f"{at}: length")
        for k, item in enumerate(value):
            found += violations(item, schema.get("items", {}), f"{at}[{k}]")
    elif isinstance(value, dict):
        known = schema.get("properties", {})
        found += [f"{at}.{k}: missing" for k in schema.get("required", []) if k not in value]
        for k in sorted(value):
            if k in known:
                found += violations(value[k], known[k], f"{at}.{k}")
            elif schema.get("additionalProperties", True) is False:
                found.append(f"{at}.{k}: not allowed")
    elif isinstance(value, int | float) and not isinstance(value, bool):
        found += _bounds(value, schema, "minimum", "maximum", f"{at}: value")
    return found


def _bounds(value, schema: dict, low: str, high: str, what: str) -> list[str]:
    found = []
    if low in schema and value < schema[low]:
        found.append(f"{what} below {schema[low]}")
    if high in schema and value > schema[high]:
        found.append(f"{what} above {schema[high]}")
    return found


def check_call(call_id, name, arguments, schema, result, has_result) -> tuple[str, list[str], str]:
    """Status, errors and canonical JSON of one call."""
    try:
        parsed = json.loads(arguments)
        shown = canonical(parsed)
        errors = violations(parsed, json.loads(schema)) if schema is not None else []
    except (TypeError, ValueError, RecursionError) as problem:
        parsed, shown, errors = arguments, None, [f"$: {type(problem).__name__}"]
    event = {"id": call_id, "name": name, "type": "tool_call", "result": result}
    event["arguments"] = parsed if shown is not None else arguments
    if schema is None:
        status, errors = "unknown_tool", [*errors, "$: unknown tool"]
    elif errors:
        status = "invalid_arguments"
    else:
        status = "ok" if has_result else "missing_result"
    return status, errors, canonical(event)


def _checked(linked: DataFrame) -> DataFrame:
    @F.pandas_udf("status string, errors array<string>, json string")
    def check(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for columns in batches:
            rows = [check_call(*values) for values in zip(*columns, strict=True)]
            yield pd.DataFrame(rows, columns=["status", "errors", "json"])

    checked = check("call_id", "name", "arguments", "schema", "result", "has_result")
    return linked.withColumn("__checked", checked)


def link_results(calls: DataFrame, results: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls with their result, and results whose call does not exist."""
    named = results.where("call_id IS NOT NULL")
    first = named.groupBy(*_KEYS).agg(F.min(F.struct("turn", "content")).alias("first"))
    told = first.select(*_KEYS, F.col("first.content").alias("result"), F.lit(True).alias("found"))
    linked = null_safe_join(calls, told, _KEYS, "left")
    linked = linked.withColumn("has_result", F.coalesce("found", F.lit(False))).drop("found")
    orphans = null_safe_join(results, calls.select(*_KEYS).where("call_id IS NOT NULL").distinct(),
                             _KEYS, "left_anti")
    return linked, orphans


def _later(low: str, steps: Column) -> Column:
    """The pair (at, step) some steps after another."""
    step = F.least(F.col(f"{low}.step") + steps, F.lit(_FAR))
    return F.struct(F.col(f"{low}.at").alias("at"), step.alias("step"))


def _peeled(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes with ``low``, their pair (at, step) after all they depend on, and ``open``.

    ``nodes`` have conv_id, call_id and low, ``edges`` conv_id, call_id and parent. Nodes in
    or behind a circle stay open: they have that many links left that lead to none settled.
    """
    edges = edges.withColumn("steps", F.lit(1).cast("long"))
    before = None
    while True:
        ways = edges.groupBy(*_KEYS).agg(
            F.count(F.lit(1)).alias("open"), F.min(F.struct("parent", "steps")).alias("way")
        )
        state = materialize(
            null_safe_join(nodes.select(*_KEYS, "low"), ways, _KEYS, "left")
            .withColumn("open", F.coalesce("open", F.lit(0)))
        )
        left = state.df.where("open > 0").count()
        # As long as a node off all circles is open, one of those has settled parents only.
        if left in (0, before):
            return state.df.drop("way")
        before = left
        parents = state.derive(state.df.select(
            "conv_id", F.col("call_id").alias("parent"), F.col("low").alias("from"),
            F.col("open").alias("beyond"), "way",
        ))
        met = lookup_join(edges, parents, ["conv_id", "parent"], "inner")
        gains = met.where("beyond <= 1").groupBy(*_KEYS).agg(
            F.max(_later("from", F.col("steps"))).alias("gain")
        )
        single = F.col("beyond") == 1
        steps = F.when(single, F.col("steps") + F.col("way.steps")).otherwise(F.col("steps"))
        passed = met.where("beyond > 0").select(
            *_KEYS, F.when(single, F.col("way.parent")).otherwise(F.col("parent")).alias("parent"),
            F.least(steps, F.lit(_FAR)).alias("steps"),
        )
        nodes = null_safe_join(state.df, gains, _KEYS, "left").withColumn(
            "low", F.greatest("low", "gain")
        )
        edges = materialize(passed.groupBy(*_KEYS, "parent").agg(F.max("steps").alias("steps"))).df


def _within(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges with both ends among the nodes."""
    ends = materialize(nodes.select(*_KEYS))
    parents = ends.derive(ends.df.withColumnRenamed("call_id", "parent"))
    return lookup_join(
        lookup_join(edges, ends, _KEYS, "left_semi"), parents, ["conv_id", "parent"], "left_semi"
    )


def _turned(edges: DataFrame) -> DataFrame:
    return edges.select("conv_id", F.col("parent").alias("call_id"), F.col("call_id").alias("parent"))


def _spread(values: DataFrame, edges: DataFrame) -> DataFrame:
    """Each node's greatest ``value`` over itself and all that it depends on."""
    values = materialize(values)
    while True:
        parents = values.derive(values.df.select(
            "conv_id", F.col("call_id").alias("parent"), F.col("value").alias("above")
        ))
        above = lookup_join(edges, parents, ["conv_id", "parent"], "inner")
        above = above.groupBy(*_KEYS).agg(F.max("above").alias("above"))
        values = materialize(
            null_safe_join(values.df, above, _KEYS, "left").select(
                *_KEYS, F.greatest("value", "above").alias("value"),
                F.coalesce(F.col("above") > F.col("value"), F.lit(False)).alias("moved"),
            )
        )
        if values.df.where("moved").isEmpty():
            return values.df.drop("moved")
        values = values.derive(values.df.drop("moved"))


def _with_ends(edges: DataFrame, values: DataFrame) -> DataFrame:
    """Edges with the values ``of_call`` and ``of_parent`` of their ends."""
    table = materialize(values.select(*_KEYS, F.col("value").alias("of_call")))
    parents = table.derive(table.df.withColumnsRenamed({"call_id": "parent", "of_call": "of_parent"}))
    return lookup_join(
        lookup_join(edges, table, _KEYS, "inner"), parents, ["conv_id", "parent"], "inner"
    )


def _circles(core: DataFrame) -> DataFrame:
    """Edges on a circle, of edges whose ends all have parents and children among them."""

    def forked(ends: DataFrame) -> DataFrame:
        return ends.groupBy(*_KEYS).count().where("count > 1").select("conv_id")

    # Without a fork every call of a conversation lies on a circle of its own.
    tangled = materialize(forked(core).unionByName(forked(_turned(core))).distinct())
    found = lookup_join(core, tangled, ["conv_id"], "left_anti")
    rest = materialize(lookup_join(core, tangled, ["conv_id"], "left_semi")).df
    while not rest.isEmpty():
        calls = rest.select(*_KEYS).union(rest.select("conv_id", "parent")).distinct()
        greatest = materialize(_spread(calls.withColumn("value", F.col("call_id")), rest)).df
        # A circle has the same greatest ancestor all along, and it leads back to that one.
        same = materialize(
            _with_ends(rest, greatest).where("of_call = of_parent").select(*_KEYS, "parent")
        ).df
        back = _spread(
            greatest.select(*_KEYS, (F.col("value") == F.col("call_id")).alias("value")), _turned(same)
        )
        known = materialize(_with_ends(same, back)).df
        found = found.unionByName(known.where("of_call AND of_parent").select(*_KEYS, "parent"))
        rest = known.where("NOT of_call AND NOT of_parent").select(*_KEYS, "parent")
    return found


def _settled(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Pairs (at, step) of all nodes, and whether they are on a circle."""
    first = _peeled(nodes, edges)
    behind = first.where("open > 0")
    if behind.isEmpty():
        return first.select(*_KEYS, "low.*", F.lit(False).alias("cyclic"))
    left = materialize(_within(edges, behind)).df
    core = _within(left, _peeled(behind, _turned(left)).where("open > 0"))
    circles = materialize(_circles(materialize(core).df)).df
    # Without the links of circles all calls can be settled.
    free = null_safe_join(edges, circles, [*_KEYS, "parent"], "left_anti")
    cyclic = circles.select(*_KEYS).distinct().withColumn("cyclic", F.lit(True))
    return lookup_join(_peeled(nodes, free), materialize(cyclic), _KEYS).select(
        *_KEYS, "low.*", F.coalesce("cyclic", F.lit(False)).alias("cyclic")
    )


def _identified(calls: DataFrame) -> DataFrame:
    """Calls without an id get one by turn and dependencies, which no dependency names."""
    made = F.concat(F.lit("\0"), F.to_json(F.struct("turn", "depends_on")))
    return calls.withColumn("call_id", F.coalesce("call_id", made))


def topological_places(calls: DataFrame, max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """conv_id, call_id, the pair (at, step) each call is ordered by, and whether it is cyclic.

    Calls without an id go by a made one, see ``_identified``.
    """
    calls = _identified(calls)
    nodes = calls.groupBy(*_KEYS).agg(F.min("turn").alias("at")).withColumn(
        "step", F.lit(0).cast("long")
    )
    nodes = written(nodes, "places")
    links = calls.select(*_KEYS, F.explode("depends_on").alias("parent")).distinct()
    links = links.where("parent IS NOT NULL")
    known = nodes.select("conv_id", F.col("call_id").alias("parent"))
    edges = written(null_safe_join(links, known, ["conv_id", "parent"], "left_semi"), "edges")

    def moves(places: DataFrame) -> DataFrame:
        """Where calls have to go that do not lie after what they depend on."""
        parents = places.select("conv_id", F.col("call_id").alias("parent"),
                                F.struct("at", (F.col("step") + 1).alias("step")).alias("low"))
        needed = null_safe_join(edges, parents, ["conv_id", "parent"], "inner")
        needed = needed.groupBy(*_KEYS).agg(F.max("low").alias("low"))
        both = null_safe_join(needed, places, _KEYS, "inner")
        return both.where("low > struct(at, step)").select(*_KEYS, "low")

    for _ in range(max_rounds):
        moved = materialize(moves(nodes))
        if moved.df.isEmpty():
            return nodes.withColumn("cyclic", F.lit(False))
        nodes = written(
            lookup_join(nodes, moved, _KEYS).select(
                *_KEYS,
                F.coalesce("low.at", "at").alias("at"),
                F.coalesce("low.step", "step").alias("step"),
            ),
            "places",
        )
    open_ones = materialize(moves(nodes).select("conv_id").distinct())
    start = calls.groupBy(*_KEYS).agg(
        F.struct(F.min("turn").alias("at"), F.lit(0).cast("long").alias("step")).alias("low")
    )
    settled = _settled(
        materialize(lookup_join(start, open_ones, ["conv_id"], "left_semi")).df,
        materialize(lookup_join(edges, open_ones, ["conv_id"], "left_semi")).df,
    )
    rest = lookup_join(nodes, open_ones, ["conv_id"], "left_anti")
    return written(rest.withColumn("cyclic", F.lit(False)).unionByName(settled), "places")


def format_chats(
    calls: DataFrame, results: DataFrame, messages: DataFrame, schemas: DataFrame
) -> DataFrame:
    """One row per event: conversation, place in it, call id, status, errors and JSON."""
    linked, orphans = link_results(calls, results)
    with_schema = lookup_join(linked, materialize(schemas), ["name"])
    checked = _checked(with_schema).withColumn("__id", F.col("call_id"))
    no_errors = F.array().cast("array<string>")
    no_key = F.lit(None).cast("string").alias("__key")

    def line(**fields: str) -> Column:
        pairs = ", ".join(f"'{k}', {v}" for k, v in sorted(fields.items()))
        return F.expr(f"to_json(named_struct({pairs}), map('ignoreNullFields', 'false'))")

    events = _identified(checked).select(
        "conv_id", F.col("__id").alias("call_id"), F.col("call_id").alias("__key"), "turn",
        "__checked.status", "__checked.errors", "__checked.json",
    ).unionByName(
        orphans.select(
            "conv_id", "call_id", no_key, "turn", F.lit("orphan_result").alias("status"),
            no_errors.alias("errors"),
            line(id="call_id", result="content", type="'tool_result'").alias("json"),
        )
    ).unionByName(
        messages.select(
            "conv_id", F.lit(None).cast("string").alias("call_id"), no_key, "turn",
            F.lit("message").alias("status"), no_errors.alias("errors"),
            line(content="content", role="role", type="'message'").alias("json"),
        )
    )
    # Numbered once and stored: texts stay where they lie while narrow rows are put in order.
    events = written(events.withColumn("__row", F.monotonically_increasing_id()), "events")
    placed = _places_of_events(events, topological_places(calls))
    return events.drop("conv_id", "status").join(placed, "__row").select(
        "conv_id", "place", "turn", "call_id", "status", "errors", "json"
    )


def _places_of_events(events: DataFrame, places: DataFrame) -> DataFrame:
    """``__row``, conversation, place in it and final status of each event.

    Events that agree in everything else are ordered by a hash of their JSON.
    """
    narrow = events.select(
        "__row", "__key", "conv_id", "turn", "call_id", "status", F.xxhash64("json").alias("hash")
    )
    calls = null_safe_join(
        narrow.where("__key IS NOT NULL"), places.withColumnRenamed("call_id", "__key"),
        ["conv_id", "__key"], "left",
    ).withColumn("status", F.when(F.col("cyclic"), "cyclic").otherwise(F.col("status")))
    others = narrow.where("__key IS NULL").withColumns(
        {"at": F.col("turn"), "step": F.lit(0).cast("long")}
    )
    rows = calls.drop("cyclic", "__key").unionByName(others.drop("__key"))
    order = ["conv_id", "at", "step", "turn", "call_id", "status", "hash"]
    numbered = running_total(rows, order, "__place").select("__row", "conv_id", "status", "__place")
    numbered = written(numbered, "numbered")
    starts = materialize(numbered.groupBy("conv_id").agg(F.min("__place").alias("__first")))
    return lookup_join(numbered, starts, ["conv_id"]).select(
        "__row", "conv_id", "status", (F.col("__place") - F.col("__first")).alias("place")
    )


def events_of_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Plain conversations as calls, results and messages.

    A user's turn is a call of the tool ``answer`` with the text as its argument, the
    assistant's turn after it is the result, and a call depends on the one two turns before.
    All other turns are messages.
    """

    def call_id(turn: str) -> Column:
        return F.concat(F.lit("call_"), (F.expr(turn)).cast("string"))

    calls = conversations.where("role = 'user'").select(
        "conv_id", call_id("turn").alias("call_id"), "turn", F.lit("answer").alias("name"),
        F.to_json(
            F.struct("text", "turn"), {"ignoreNullFields": "false"}
        ).alias("arguments"),
        F.array(call_id("turn - 2")).alias("depends_on"),
    )
    results = conversations.where("role = 'assistant'").select(
        "conv_id", call_id("turn - 1").alias("call_id"), "turn", F.col("text").alias("content")
    )
    messages = conversations.where("role IS NULL OR role NOT IN ('user', 'assistant')").select(
        "conv_id", "turn", "role", F.col("text").alias("content")
    )
    return calls, results, messages


ANSWER_SCHEMA = {
    "type": "object",
    "properties": {
        "text": {"type": "string", "minLength": 1},
        "turn": {"type": "integer", "minimum": 0},
    },
    "required": ["text", "turn"],
    "additionalProperties": False,
}
