from __future__ import annotations

import json
import random
from pathlib import Path

import pytest

from pricepanel.llm import tool_calls as tc
from pricepanel.tables import BROADCAST_CONF

TOOL = {
    "type": "object",
    "properties": {"q": {"type": "string", "minLength": 1}, "n": {"type": "integer", "maximum": 5}},
    "required": ["q"],
    "additionalProperties": False,
}


@pytest.fixture
def chats(spark):
    def make(calls, results=(), messages=(), tools=(("find", json.dumps(TOOL)),), **options):
        full = [(c, i, t, name, args, list(deps)) for c, i, t, name, args, deps in calls]
        return tc.format_chats(
            spark.createDataFrame(full, tc.CALL), spark.createDataFrame(list(results), tc.RESULT),
            spark.createDataFrame(list(messages), tc.MESSAGE),
            spark.createDataFrame(list(tools), tc.SCHEMAS), **options,
        )

    return make


def test_statuses_and_canonical_json(chats):
    calls = [
        (1, "a", 1, "find", '{"n": 2.0, "q": "é\\n"}', []), (1, "b", 3, "find", '{"n": 9}', []),
        (1, "c", 5, "find", "not json", []), (1, "d", 7, "other", "{}", []),
        (1, "e", 9, "find", '{"q": "x"}', []), (1, "f", 11, "find", None, []),
    ]
    results = [(1, "a", 4, "late"), (1, "a", 2, "first"), (1, "z", 6, "whose?"), (1, "f", 12, None)]
    got = chats(calls, results, [(1, 0, "system", None), (1, 20, None, "bye")]).orderBy("place")
    rows = got.collect()
    assert [r["place"] for r in rows] == list(range(9))
    status = {r["call_id"]: r["status"] for r in rows if r["call_id"]}
    assert status == {
        "a": "ok", "b": "invalid_arguments", "c": "invalid_arguments", "d": "unknown_tool",
        "e": "missing_result", "f": "invalid_arguments", "z": "orphan_result",
    }
    by_id = {r["call_id"]: r for r in rows if r["call_id"]}
    assert by_id["a"]["json"] == (
        '{"arguments":{"n":2,"q":"é\\n"},"id":"a","name":"find","result":"first","type":"tool_call"}'
    )
    assert by_id["b"]["errors"] == ["$.q: missing", "$.n: value above 5"]
    assert by_id["z"]["json"] == '{"id":"z","result":"whose?","type":"tool_result"}'
    assert rows[0]["json"] == '{"content":null,"role":"system","type":"message"}'
    assert all(json.loads(r["json"]) is not None for r in rows)


@pytest.mark.parametrize("rounds", [32, 1])
@pytest.mark.parametrize("limit", [None, "-1"])
def test_calls_follow_what_they_depend_on(spark, chats, monkeypatch, rounds, limit):
    monkeypatch.setattr(tc.topological_places, "__defaults__", (rounds,))
    rng = random.Random(rounds)
    calls = []
    for conv in range(6):
        order = list(range(25))
        rng.shuffle(order)
        for k in range(25):
            deps = [f"c{d}" for d in range(k) if rng.random() < 0.08] + ["gone"]
            calls.append((conv, f"c{k}", order[k], "find", '{"q":"x"}', deps))
    if limit:
        spark.conf.set(BROADCAST_CONF, limit)
    try:
        rows = chats(calls).collect()
    finally:
        spark.conf.unset(BROADCAST_CONF)
    place = {(r["conv_id"], r["call_id"]): r["place"] for r in rows}
    assert all(r["status"] == "missing_result" for r in rows)
    for conv in range(6):
        assert sorted(p for (c, _), p in place.items() if c == conv) == list(range(25))
    for conv, call, _, _, _, deps in calls:
        assert all(place[conv, d] < place[conv, call] for d in deps if d != "gone")


def test_circles_are_found_and_independent_calls_keep_their_turns(chats):
    calls = [
        (1, "a", 1, "find", '{"q":"x"}', ["b"]), (1, "b", 2, "find", '{"q":"x"}', ["a"]),
        (1, "c", 3, "find", '{"q":"x"}', []), (1, "d", 4, "find", '{"q":"x"}', ["d"]),
        (2, "a", 1, "find", '{"q":"x"}', []), (None, "a", 1, "find", '{"q":"x"}', []),
        (2, "a", 1, "find", '{"q":"x"}', []),
    ]
    rows = chats(calls, [(2, "a", 3, "r"), (None, "a", 2, "s")]).collect()
    status = sorted((str(r["conv_id"]), r["call_id"], r["status"]) for r in rows)
    assert status == [
        ("1", "a", "cyclic"), ("1", "b", "cyclic"), ("1", "c", "missing_result"), ("1", "d", "cyclic"),
        ("2", "a", "ok"), ("2", "a", "ok"), ("None", "a", "ok"),
    ]


def test_plain_conversations(spark):
    turns = [
        (1, 0, "system", "be kind"), (1, 1, "user", "hi"), (1, 2, "assistant", "hello"),
        (1, 3, "user", ""), (1, 4, "assistant", "?"), (2, 0, "user", None), (2, 1, "tool", "x"),
        (3, 5, "assistant", "alone"), (4, 0, None, None),
    ]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    df = df.selectExpr("*", "'y' AS place", "1 AS json")
    tools = spark.createDataFrame([("answer", json.dumps(tc.ANSWER_SCHEMA))], tc.SCHEMAS)
    rows = tc.format_chats(*tc.events_of_turns(df), tools).collect()
    status = {(r["conv_id"], r["turn"]): r["status"] for r in rows}
    assert status == {
        (1, 0): "message", (1, 1): "ok", (1, 3): "invalid_arguments", (2, 0): "invalid_arguments",
        (2, 1): "message", (3, 5): "orphan_result", (4, 0): "message",
    }
    assert {(r["conv_id"], r["place"]) for r in rows} == {
        (1, 0), (1, 1), (1, 2), (2, 0), (2, 1), (3, 0), (4, 0),
    }


def test_empty_tables(chats):
    assert chats([]).count() == 0


@pytest.mark.parametrize(
    ("value", "text"),
    [
        ({"b": 1, "a": [1.0, 1.5, None, True]}, '{"a":[1,1.5,null,true],"b":1}'), ("é\"", '"é\\""'),
        (-0.0, "0"), (1e300, "1e+300"), (10**20, "100000000000000000000"),
    ],
)
def test_canonical_values(value, text):
    assert tc.canonical(value) == text
    assert json.loads(text) == value


def test_schema_rules():
    schema = {"type": ["array", "null"], "items": {"enum": [1, "x"]}, "maxItems": 2}
    assert tc.violations(None, schema) == [] == tc.violations([1, "x"], schema)
    assert tc.violations([2, 1, 1], schema) == ["$: length above 2", "$[0]: not one of the allowed values"]
    assert tc.violations("s", schema) == ["$: not of type array/null"]
    assert tc.violations(True, {"type": "integer"}) == ["$: not of type integer"]
    assert tc.violations(3.0, {"type": "integer", "minimum": 4}) == ["$: value below 4"]


def test_null_turns_and_null_ids(spark, chats):
    turns = [(1, None, "user", "when?"), (1, None, "assistant", "now"), (1, 1, "user", "hi"),
             (None, None, "user", "x"), (1, 2, "assistant", "ho")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    tools = spark.createDataFrame([("answer", json.dumps(tc.ANSWER_SCHEMA))], tc.SCHEMAS)
    rows = tc.format_chats(*tc.events_of_turns(df), tools).collect()
    got = sorted((str(r["conv_id"]), r["place"], str(r["turn"]), r["status"]) for r in rows)
    assert got == [
        ("1", 0, "None", "invalid_arguments"), ("1", 1, "None", "orphan_result"), ("1", 2, "1", "ok"),
        ("None", 0, "None", "invalid_arguments"),
    ]
    calls = [(1, None, 1, "find", '{"q":"x"}', ["a"]), (1, None, 9, "find", '{"q":"y"}', [None]),
             (1, "a", 5, "find", '{"q":"z"}', [None])]
    rows = chats(calls).orderBy("place").collect()
    assert [(r["call_id"], r["turn"]) for r in rows] == [("a", 5), (None, 1), (None, 9)]


def test_a_null_turn_beside_a_circle(spark):
    calls = [(1, "a", None, "find", "{}", ["b"]), (1, "b", 2, "find", "{}", ["a"]),
             (1, "c", None, "find", "{}", [])]
    rows = tc.topological_places(spark.createDataFrame(calls, tc.CALL), 1).collect()
    assert {r["call_id"]: r["at"] for r in rows} == {"a": None, "b": 2, "c": None}


def plain_places(calls):
    """Pair and circle of each call, by reachability and the longest way."""
    turn, after = {}, {}
    for conv, call, at, _, _, deps in calls:
        turn[conv, call] = min(at, turn.get((conv, call), at), key=lambda t: (t is not None, t))
        after.setdefault((conv, call), set()).update((conv, d) for d in deps)
    after = {k: {d for d in deps if d in turn} for k, deps in after.items()}

    def reached(start):
        seen, todo = set(), list(after[start])
        while todo:
            if (node := todo.pop()) not in seen:
                seen.add(node)
                todo += after[node]
        return seen

    above = {k: reached(k) for k in turn}
    place = {}
    for k in sorted(turn, key=lambda k: len(above[k] - {x for x in above[k] if k in above[x]})):
        free = [place[d] for d in after[k] if k not in above[d]]
        own = (turn[k], 0)
        place[k] = max([own, *((at, step + 1) for at, step in free)],
                       key=lambda p: (p[0] is not None, p))
    return {k: (*place[k], k in above[k]) for k in turn}


def test_circles_match_a_plain_version(spark):
    # A circle before and one behind a call, and a long chain against the order of turns.
    links = {"a": ["b"], "b": ["a"], "x": ["b"], "p": ["x", "q"], "q": ["p"], "y": ["p"], "z": ["z"]}
    calls = [(99, k, t, "find", "{}", deps) for t, (k, deps) in enumerate(links.items())]
    calls += [(98, f"c{k}", 20 - k, "find", "{}", [f"c{k - 1}"]) for k in range(20)]
    calls += [(97, f"c{k}", k, "find", "{}", [f"c{(k + 1) % 5}"]) for k in range(5)]
    rows = tc.topological_places(spark.createDataFrame(calls, tc.CALL), 1).collect()
    got = {(r["conv_id"], r["call_id"]): (r["at"], r["step"], r["cyclic"]) for r in rows}
    wanted = plain_places(calls)
    assert len(rows) == len(wanted) and got == wanted
    assert not wanted[99, "x"][2] and wanted[99, "p"][2] and not wanted[99, "y"][2]


def plain_chats(rows):
    """What the registered query gives, in plain Python: links, order, statuses and JSON."""

    def line(**fields):
        return json.dumps(fields, sort_keys=True, separators=(",", ":"), ensure_ascii=False)

    chats = {}
    for conv, turn, role, text in rows:
        chats.setdefault(conv, []).append((turn, role, text))
    found = []
    for conv, turns in chats.items():
        asked = {t for t, role, _ in turns if role == "user"}
        told = {}
        for t, role, text in sorted(turns, key=lambda x: (x[0], x[2] is not None, x[2] or "")):
            if role == "assistant":
                told.setdefault(t - 1, text)
        events = []
        for t, role, text in turns:
            if role == "user":
                broken = {None: ["$.text: not of type string"], "": ["$.text: length below 1"]}
                errors = broken.get(text, [])
                status = "ok" if t in told else "missing_result"
                status = "invalid_arguments" if errors else status
                shown = line(id=f"call_{t}", name="answer", type="tool_call", result=told.get(t),
                             arguments={"text": text, "turn": t})
                events.append((t, f"call_{t}", status, errors, shown))
            elif role == "assistant":
                if t - 1 not in asked:
                    shown = line(id=f"call_{t - 1}", result=text, type="tool_result")
                    events.append((t, f"call_{t - 1}", "orphan_result", [], shown))
            else:
                events.append((t, None, "message", [], line(content=text, role=role, type="message")))
        # A call depends on an earlier turn only, so the order of turns is topological.
        events.sort(key=lambda e: (e[0], e[1] is not None, e[1] or "", e[2]))
        found += [(conv, place, *event) for place, event in enumerate(events)]
    return found


def test_the_registered_query_matches_a_plain_version(spark):
    from pricepanel.llm import queries

    folder = "/root/testdata/sf0.01"
    table = spark.read.parquet(f"{folder}/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    got = [
        (r["conv_id"], r["place"], r["turn"], r["call_id"], r["status"], list(r["errors"]), r["json"])
        for r in queries.op7_tool_calls(spark, folder).collect()
    ]
    assert sorted(got, key=repr) == sorted(plain_chats(rows), key=repr)
    assert {r[4] for r in got} >= {"ok", "missing_result", "message"}


def test_no_conversation_is_gathered_in_python():
    assert "applyInPandas" not in Path(tc.__file__).read_text()
