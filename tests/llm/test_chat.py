import json

import pytest

from meterline.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, id string, depth int, label string"
TOOLS = {"add": {"a": "BIGINT", "b": "BIGINT"}, **chat.REPLY}


def messages(spark, *rows):
    return spark.createDataFrame([(*row, None, None, "x") for row in rows], SCHEMA)


def call(*calls):
    return json.dumps({"tool_calls": [dict(zip(("id", "name", "arguments", "after"), c)) for c in calls]})


def result(call_id, content):
    return json.dumps({"tool_call_id": call_id, "content": content})


def formatted(df, schemas=TOOLS):
    return {(row.conv_id, row.id): row for row in chat.format_chat(df, schemas).collect()}


def test_calls_meet_their_results_in_any_order(spark):
    df = messages(
        spark,
        (1, 0, "tool", result("c2", "7")),
        (1, 1, "assistant", call(("c2", "add", {"b": 4, "a": 3}, "c1"), ("c1", "add", {"a": 1, "b": 2}, None))),
        (1, 2, "tool", result("c1", "3")),
        (2, 0, "tool", result("c1", "other conversation")),
    )
    found = formatted(df)
    assert found[1, "result-c2"].linked_id == "c2" and found[1, "c2"].linked_id == "c1"
    assert {key: row.depth for key, row in found.items()} == {
        (1, "c1"): 0, (1, "c2"): 1, (1, "result-c1"): 1, (1, "result-c2"): 2, (2, "result-c1"): 0,
    }
    assert all(row.valid for key, row in found.items() if key[0] == 1)
    assert found[2, "result-c1"].problems == "no call"
    assert found[1, "c2"].json == (
        '{"arguments":{"a":3,"b":4},"conv_id":1,"id":"c2","link":"c1","role":"assistant","tool":"add","turn":1}'
    )


def test_content_beside_calls_and_empty_calls(spark):
    good = {"a": 1, "b": 2}
    both = json.dumps({"content": "I add.", **json.loads(call(("c1", "add", good, None), ("c2", "add", good, None)))})
    df = messages(
        spark,
        (1, 0, "user", "hello"), (1, 1, "assistant", '{"content":"Hello","tool_calls":[]}'),
        (2, 0, "user", "add"), (2, 1, "assistant", both), (2, 2, "tool", result("c1", "3")), (2, 3, "tool", result("c2", "3")),
        (3, 0, "assistant", '{"content":"","tool_calls":[]}'), (3, 1, "assistant", '{"content":null,"tool_calls":null}'),
    )
    found = formatted(df)
    assert len(found) == 10
    assert found[1, "turn-0"].valid and found[1, "turn-1"].linked_id == "turn-0"
    assert json.loads(found[1, "turn-1"].json)["content"] == "Hello"
    assert json.loads(found[2, "turn-1"].json)["content"] == "I add." and found[2, "turn-1"].kind == "result"
    assert [found[2, key].number for key in ("turn-1", "c1", "c2")] == [0, 1, 2]
    assert all(row.valid for key, row in found.items() if key[0] < 3)
    assert json.loads(found[3, "turn-0"].json)["content"] == '{"content":"","tool_calls":[]}'
    assert json.loads(found[3, "turn-1"].json)["content"] == '{"content":null,"tool_calls":null}'


def test_arguments_are_checked(spark):
    df = messages(
        spark,
        (1, 0, "assistant", call(("a", "add", {"a": 1}, None), ("b", "add", {"a": 1, "b": "x", "c": 0}, None))),
        (1, 1, "assistant", call(("c", "nothing", {}, None), ("d", "add", "not json", None), ("e", "add", None, None))),
    )
    found = {key[1]: row.problems for key, row in formatted(df).items()}
    assert found == {
        "a": "missing b, no result",
        "b": "wrong type b, unexpected c, no result",
        "c": "unknown tool, no result",
        "d": "bad json, no result",
        "e": "bad json, no result",
    }


def test_cycles_and_repeated_ids(spark):
    good = {"a": 1, "b": 2}
    df = messages(
        spark,
        (1, 0, "assistant", call(("x", "add", good, "y"), ("y", "add", good, "x"), ("z", "add", good, "x"))),
        (1, 1, "assistant", call(("s", "add", good, "s"), ("t", "add", good, None))),
        (1, 2, "assistant", call(("t", "add", {"a": 5, "b": 5}, None))),
    )
    rows = chat.format_chat(df, TOOLS).collect()
    assert {row.id for row in rows if "cycle" in row.problems} == {"x", "y", "z", "s"}
    assert sorted("repeated id" in row.problems for row in rows if row.id == "t") == [False, True]


@pytest.mark.parametrize("length", [1, 2, 3, 40])
def test_depth_of_chains(spark, length):
    df = messages(spark, *[(1, n, "user" if n % 2 == 0 else "assistant", "hello") for n in range(length)])
    found = formatted(df)
    assert [found[1, f"turn-{n}"].depth for n in range(length)] == list(range(length))


def test_json_is_canonical(spark):
    text = 'quote " back \\ line\nend é 日 \t'
    df = messages(spark, (1, 0, "user", text), (1, 1, "assistant", '{"not": "a call"}'), (1, 2, "system", None))
    found = formatted(df)
    row = json.loads(found[1, "turn-0"].json)
    assert row["arguments"] == {"prompt": text, "turn": 0} and list(row) == sorted(row)
    assert json.loads(found[1, "turn-1"].json)["content"] == '{"not": "a call"}'
    assert json.loads(found[1, "turn-2"].json)["content"] == ""
    assert found[1, "turn-0"].valid and found[1, "turn-1"].valid


def test_odd_rows(spark):
    df = messages(
        spark,
        (None, 0, "user", "a"), (None, 1, "assistant", "b"), (1, None, "user", "c"), (1, 0, None, "d"),
        (1, 1, "tool", "not json"), (1, 2, "assistant", "{bad"), (2, 0, "user", "x" * 300_000), (2, 0, "user", "x" * 300_000),
    )
    rows = chat.format_chat(df).collect()
    assert len(rows) == 8
    assert {row.linked_id for row in rows if row.conv_id is None} == {None, "turn-0"}
    assert sum(row.conv_id == 2 for row in rows) == 2
    assert chat.format_chat(df.limit(0)).count() == 0


def test_nothing_leaves_the_jvm(spark, sf_dir):
    text = chat.op9_chat(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text
