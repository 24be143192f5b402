"""Chat formatting: linking, order, schemas and canonical JSON."""

from __future__ import annotations

import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from daybook.llm import chat, common

MESSAGES = ("conv_id bigint, turn bigint, role string, text string, call_id string, tool string, arguments string, "
            "after array<string>, place string, json string")
SCHEMAS = {"add": {"type": "object", "required": ["a"], "additionalProperties": False,
                   "properties": {"a": {"type": "integer", "minimum": 0}, "b": {"type": "array", "items": {"type": "string"}}}}}


def frame(spark, rows):
    return spark.createDataFrame([(*r, None, "extra") for r in rows], MESSAGES).repartition(3)


def call(conv, turn, call_id, arguments='{"a":1}', after=None, tool="add"):
    return (conv, turn, "assistant", "", call_id, tool, arguments, after)


def result(conv, turn, call_id, text):
    return (conv, turn, "tool", text, call_id, None, None, None)


def plain(conv, turn, role, text):
    return (conv, turn, role, text, None, None, None, None)


def records(df):
    return sorted(df.collect(), key=lambda r: (r.conv_id or -1, r.turn, r.step, r.call_id or "", r.json))


def test_linking(spark):
    rows = records(chat.format_chats(frame(spark, [
        plain(1, 0, "user", "hé \"q\""), call(1, 1, "x", '{"b":["s"], "a":2}'), result(1, 2, "x", "three"),
        call(1, 3, "y"), result(1, 4, "z", "nobody asked"),
        call(1, 5, "d", '{"a":5}'), call(1, 6, "d", '{"a":6}'), result(1, 7, "d", "late"), result(1, 6, "d", "soon"),
        call(2, 0, "x", "{"), call(2, 1, None), call(2, 2, "u", tool="what"), plain(2, 3, "user", None), plain(2, 3, "user", None),
        call(None, 4, "n"), result(None, 5, "n", "r")]), SCHEMAS))
    by = {(r.conv_id, r.call_id): r for r in rows if r.call_id}
    assert by[1, "x"].json == '{"arguments":{"a":2,"b":["s"]},"id":"x","name":"add","result":"three","role":"assistant","type":"tool_call"}'
    assert (by[1, "x"].status, by[1, "y"].status, by[1, "z"].status) == ("linked", "unanswered", "orphan")
    assert json.loads(by[1, "z"].json) == {"role": "tool", "id": "z", "content": "nobody asked"}
    twice = by[1, "d"]
    assert (twice.turn, twice.n_calls, twice.n_results) == (5, 2, 2)
    assert json.loads(twice.json)["arguments"] == {"a": 5} and json.loads(twice.json)["result"] == "soon"
    assert by[2, "x"].faults == ["$: not JSON"] and by[2, "u"].faults == ["unknown tool"]
    assert by[None, "n"].status in ("unanswered", "orphan")
    assert [r.json for r in rows if r.kind == "message"].count('{"content":"","role":"user"}') == 2
    assert '{"content":"hé \\"q\\"","role":"user"}' in [r.json for r in rows]


def test_topological_order(spark):
    rows = chat.format_chats(frame(spark, [
        # a needs c, c needs d: logged backwards; b has no needs
        call(1, 1, "a", after=["c", "unknown", "a"]), call(1, 2, "b"), call(1, 3, "c", after=["d"]), call(1, 4, "d"),
        # a cycle, what needs it, and one that doesn't
        call(2, 1, "p", after=["q"]), call(2, 2, "q", after=["p"]), call(2, 3, "r", after=["q"]), call(2, 4, "s"),
        # the same ids in another conversation need nothing
        call(3, 9, "c"), call(3, 8, "a")]), SCHEMAS).collect()
    order = {c: [r.call_id for r in sorted((x for x in rows if x.conv_id == c), key=lambda r: (r.turn, r.step))] for c in (1, 3)}
    assert order == {1: ["b", "d", "c", "a"], 3: ["a", "c"]}
    assert {r.call_id: r.status for r in rows if r.conv_id == 2} == {
        "p": "unanswered,cyclic", "q": "unanswered,cyclic", "r": "unanswered,cyclic", "s": "unanswered"}


def plain_places(calls):
    """{id: (turn, step)} of (turn, id, needs); None where a cycle is needed."""
    turn, needs = {i: t for t, i, _ in calls}, {i: [n for n in a if n != i] for _, i, a in calls}
    needs = {i: [n for n in a if n in turn] for i, a in needs.items()}
    place, left = {}, dict(needs)
    while ready := [i for i, a in left.items() if all(n in place for n in a)]:
        for i in ready:
            place[i] = max([(turn[i], 0), *((place[n][0], place[n][1] + 1) for n in left.pop(i))])
    return place | dict.fromkeys(left)


def placed(spark, calls):
    rounds = []
    df = spark.createDataFrame([(1, i, t, list(a), r, True) for r, (t, i, a) in enumerate(calls)],
                               "conv_id long, call_id string, turn long, after array<string>, row long, first boolean")
    scratch = common.Scratch(spark, "test")
    found = {r.row: None if r.cyclic else tuple(r.place) for r in chat._places(df, scratch, rounds.append).collect()}
    return {i: found.get(r, (t, 0)) for r, (t, i, _) in enumerate(calls)}, rounds[0]


def test_long_chain_in_few_rounds(spark):
    """A thousand calls, each of which needs the next."""
    calls = [(n, f"c{n}", [f"c{n + 1}"]) for n in range(1000)]
    found, rounds = placed(spark, calls)
    assert found == plain_places(calls) and rounds <= 12
    assert found["c0"] == (999, 999) and found["c999"] == (999, 0)


@pytest.mark.parametrize("seed", range(4))
def test_places_equal_a_plain_sorter(spark, seed):
    """Random needs forwards and backwards, with cycles from the second seed on, and calls of one turn."""
    rng = random.Random(seed)
    calls = [(rng.randrange(20), f"c{n}", [f"c{rng.randrange(n + 1, 62) if seed < 1 else rng.randrange(62)}"
                                           for _ in range(rng.choice([0, 0, 1, 1, 2]))]) for n in range(60)]
    found, rounds = placed(spark, calls)
    assert found == plain_places(calls) and rounds <= 7


def test_empty(spark):
    assert chat.format_chats(frame(spark, []), SCHEMAS).count() == 0


@pytest.mark.parametrize("value,faults", [
    ({"a": 1, "b": ["x"]}, []),
    ({"b": []}, ["$.a: missing"]),
    ({"a": True}, ["$.a: not of type integer"]),
    ({"a": -1, "b": ["x", 2], "c": 0}, ["$.a: below minimum", "$.b[1]: not of type string", "$.c: unknown"]),
    ([], ["$: not of type object"]),
])
def test_violations(value, faults):
    assert chat.violations(value, SCHEMAS["add"]) == faults


JSON = st.recursive(st.none() | st.booleans() | st.integers() | st.text(max_size=5),
                    lambda x: st.lists(x, max_size=3) | st.dictionaries(st.text(max_size=3), x, max_size=3), max_leaves=8)


@settings(max_examples=80, deadline=None)
@given(JSON)
def test_canonical_json(value):
    text = chat.canonical(value)
    assert json.loads(text) == value and chat.canonical(json.loads(text)) == text


def test_derived_dialogue(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    source = {(r.conv_id, r.turn): r for r in df.collect()}
    found = chat.format_chats(chat.as_tool_dialogue(df), chat.TOOLS).collect()
    calls = {k: r for k, r in source.items() if r.role == "assistant"}
    answers = {k: r for k, r in source.items() if r.role == "user" and k[1] > 0}
    assert sum(r.kind == "call" for r in found) == len(calls)
    assert sum(r.n_results for r in found) == len(answers)
    assert sum(r.kind == "message" for r in found) == len(source) - len(calls) - len(answers)
    for r in found:
        if r.kind == "call":
            turn = int(r.call_id.split(":")[1])
            reply = source.get((r.conv_id, turn + 1))
            assert json.loads(r.json).get("result") == (reply.text if reply and reply.role == "user" else None)


def test_derived_arguments_hold_the_whole_text(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    source = {(r.conv_id, r.turn): r.text for r in df.where("role = 'assistant'").collect()}
    found = [r for r in chat.format_chats(chat.as_tool_dialogue(df), chat.TOOLS).collect() if r.kind == "call"]
    assert len(found) == len(source)
    for r in found:
        call = json.loads(r.json)
        text = call["arguments"]["query" if call["name"] == "search" else "text"]
        assert text == source[r.conv_id, int(r.call_id.split(":")[1])]
        if call["name"] == "search":
            assert ("$.query: too long" in r.faults) == (len(text) > 60)


def test_every_row_has_its_record(spark):
    rows = [plain(1, 0, "user", "go"), call(1, 1, "d", '{"a":1}'), result(1, 9, "d", "r0")]
    rows += [call(1, 2 + i % 3, "d", f'{{"a":{i // 2}}}') for i in range(20)]          # with equal rows
    rows += [result(1, 9 + i % 2, "d", f"r{i // 2}") for i in range(20)]
    rows += [call(1, 5, None, f'{{"a":{i}}}') for i in range(10)] + [result(1, 6, None, f"n{i}") for i in range(10)]
    rows += [call(None, 5, "d", f'{{"a":{i}}}') for i in range(10)] + [result(None, 6, "d", f"c{i}") for i in range(10)]
    found = chat.format_chats(frame(spark, rows), SCHEMAS).collect()
    assert len(found) == len(rows) - 1                                                 # one linked pair
    values = [json.loads(r.json) for r in found]
    assert sorted(v["arguments"]["a"] for v in values if "arguments" in v) == sorted(
        json.loads(r[6])["a"] for r in rows if r[6])
    assert sorted(v.get("result", v.get("content")) for v in values if "result" in v or v["role"] == "tool") == sorted(
        r[3] for r in rows if r[2] == "tool")
    status = [r.status for r in found]
    assert {s: status.count(s) for s in status} == {"plain": 1, "linked": 1, "duplicate": 40, "unanswered": 20, "orphan": 20}
    for r, v in zip(found, values):
        if r.status == "duplicate":
            assert (r.conv_id, r.call_id, v["id"], r.n_calls, r.n_results) == (1, None, "d", 0, 0)
    assert sum(r.n_calls for r in found) == 41 and sum(r.n_results for r in found) == 41


def test_duplicates_follow_what_they_need(spark):
    found = chat.format_chats(frame(spark, [
        call(1, 1, "a"), call(1, 2, "a", after=["b"]), call(1, 3, None, after=["b", "a"]), call(1, 4, "b"), call(1, 5, "b", after=["b"]),
        call(2, 1, "p", after=["p2"]), call(2, 2, "p2", after=["p"]), call(2, 3, "p", after=["p2"])]), SCHEMAS).collect()
    assert sorted((r.turn, r.step, r.status) for r in found if r.conv_id == 1) == [
        (1, 0, "unanswered"), (4, 0, "unanswered"), (4, 1, "duplicate"), (4, 1, "unanswered"), (5, 0, "duplicate")]
    assert sorted(r.status for r in found if r.conv_id == 2) == ["duplicate,cyclic", "unanswered,cyclic", "unanswered,cyclic"]


def test_derived_dialogue_without_conversations(spark):
    df = spark.createDataFrame([(None, 1, "assistant", f"text {i}") for i in range(9)] + [(4, None, "assistant", f"none {i}") for i in range(3)],
                               "conv_id bigint, turn bigint, role string, text string")
    found = [json.loads(r.json) for r in chat.format_chats(chat.as_tool_dialogue(df), chat.TOOLS).collect()]
    assert len(found) == 12
    assert sorted(v["arguments"]["text"] if "arguments" in v else v["content"] for v in found) == sorted(r.text for r in df.collect())
