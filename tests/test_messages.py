from __future__ import annotations

import sys

import pandas as pd
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F, types as T

from modelyard.operators import agents, messages
from modelyard.schemas import MESSAGE, UPDATE_EVENT

# Workers cannot import this file.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TURNS = "conv_id bigint, turn bigint, role string, text string"


def test_prepend_in_array_form_leaves_state_alone(spark):
    schema = T.StructType([T.StructField("messages", T.ArrayType(MESSAGE))])
    df = spark.createDataFrame([([("system", "old", None), ("user", "hi", None)],)], schema)
    shown = df.select("messages", messages.prepend_system(F.col("messages"), "new").alias("shown")).first()
    assert [m["content"] for m in shown["shown"]] == ["new", "old", "hi"]
    assert len(shown["messages"]) == 2
    for none in ("", None):
        assert len(df.select(messages.prepend_system(F.col("messages"), none)).first()[0]) == 2


def test_prepend_in_long_form(spark):
    turns = spark.createDataFrame([(1, 0, "system", "s"), (1, 1, "user", "u"), (2, 0, "user", "u")], TURNS)
    got = messages.with_system_turn(turns, "p").where("turn = -1").collect()
    assert sorted((r["conv_id"], r["text"]) for r in got) == [(1, "p"), (2, "p")]
    assert messages.with_system_turn(turns, "").count() == 3


def test_route_treats_missing_null_and_empty_alike(spark):
    call = [("1", "f", "{}")]
    rows = [(1, 0, call), (1, 1, None), (2, 0, None), (2, 1, call), (3, 0, []), (4, 5, [("1", "f", None)])]
    schema = "conv_id bigint, turn bigint, tool_calls array<struct<id:string,name:string,arguments:string>>"
    got = {r["conv_id"]: r["route"] for r in messages.route_conversations(spark.createDataFrame(rows, schema)).collect()}
    assert got == {1: "end", 2: "continue", 3: "end", 4: "continue"}


@pytest.fixture(scope="module")
def events(spark):
    schema = T.StructType([T.StructField("seq", T.LongType()), T.StructField("event", UPDATE_EVENT)])
    hello, bye = ("assistant", "hello", None), ("tool", "bye", None)
    rows = [
        (0, {"agent": ([hello, bye],), "tools": ([bye],)}),
        (1, {"agent": ([],)}),
        (2, {}),
        (3, {"agent": (None,)}),
    ]
    return spark.createDataFrame(rows, schema)


def test_flatten_keeps_order_and_skips_absent(events):
    got = messages.flatten_updates(events).orderBy("seq", "node", "msg_pos").collect()
    assert len({(r["seq"], r["node_pos"], r["msg_pos"]) for r in got}) == 3
    assert [(r["seq"], r["node"], r["msg_pos"], r["message"]["content"]) for r in got] == [
        (0, "agent", 0, "hello"),
        (0, "agent", 1, "bye"),
        (0, "tools", 0, "bye"),
    ]


def test_strict_flatten_fails_on_absent_messages(events):
    assert messages.flatten_updates(events.where("seq < 3"), strict=True).count() == 3
    with pytest.raises(Exception, match="no messages from node agent"):
        messages.flatten_updates(events, strict=True).collect()


def test_pairs_over_gaps_and_blocks(spark):
    rows = [
        (1, 0, "user", "a"),
        (1, 70000, "assistant", "b"),
        (1, 70001, "user", "c"),
        (1, 70002, "user", "d"),
        (1, 200000, "assistant", "e"),
        (1, 200001, "assistant", "f"),
        (2, 0, "assistant", "x"),
        (2, 1, "user", "y"),
    ]
    got = messages.pair_turns(spark.createDataFrame(rows, TURNS)).collect()
    assert sorted((r["request"], r["response"]) for r in got) == [("a", "b"), ("d", "e")]


def test_quarantine_is_complete(spark):
    rows = [(1, 0, "user", "a"), (1, 1, None, "a"), (1, 2, " ", "a"), (1, 3, "user", None), (1, 4, "user", "")]
    valid, bad = messages.split_valid(spark.createDataFrame(rows, TURNS))
    assert sorted(r["turn"] for r in valid.collect()) == [0, 4]
    assert {(r["turn"], r["status"]) for r in bad.collect()} == {(1, "no_role"), (2, "no_role"), (3, "no_content")}


def _countdown(batch: pd.DataFrame) -> pd.DataFrame:
    """Calls the tool until it has been called as often as the last text says."""
    rows = []
    for text, new, prompt in zip(batch["last_text"], batch["new_messages"], batch["system_prompt"]):
        if len(new) // 2 < int(text):
            rows.append(("assistant", None, [{"id": "c", "name": "shout", "arguments": f"n{len(new)}"}]))
        else:
            rows.append(("assistant", f"{prompt}:{[m['content'] for m in new]}", []))
    return pd.DataFrame(rows, columns=["role", "content", "tool_calls"])


def _turns(spark, counts):
    return spark.createDataFrame([(i, 0, "user", str(c)) for i, c in enumerate(counts)], TURNS)


def test_agent_runs_until_nothing_calls_tools(spark):
    tools = agents.Tools({"shout": F.upper})
    got = agents.run_agent(_turns(spark, [0, 3, 1]), _countdown, tools, "p").collect()
    by_conversation = {}
    for r in sorted(got, key=lambda r: (r["conv_id"], r["seq"])):
        by_conversation.setdefault(r["conv_id"], []).append((r["role"], r["content"]))
    assert by_conversation[0] == [("assistant", "p:[]")]
    assert by_conversation[2] == [("assistant", None), ("tool", "N0"), ("assistant", "p:[None, 'N0']")]
    assert len(by_conversation[1]) == 7 and by_conversation[1][5] == ("tool", "N4")
    assert all(r["finished"] for r in got)


def test_agent_round_limit_returns_the_rest_as_open(spark):
    tools = agents.Tools({"shout": F.upper})
    got = agents.run_agent(_turns(spark, [0, 5]), _countdown, tools, max_rounds=2).collect()
    assert {r["conv_id"]: r["finished"] for r in got} == {0: True, 1: False}
    assert max(r["seq"] for r in got if r["conv_id"] == 1) == 3


def test_unknown_tool_answers_with_an_error_text(spark):
    got = agents.run_agent(_turns(spark, [1]), _countdown, agents.Tools()).collect()
    assert [r["content"] for r in got if r["role"] == "tool"] == ["unknown tool: shout"]


def test_tools_by_name():
    tools = agents.Tools({"a": F.upper})
    tools.add("b", F.lower)
    assert tools.names() == ["a", "b"]
    with pytest.raises(ValueError):
        tools.add("a", F.lower)


def test_predict_once(spark):
    df = spark.createDataFrame([(1, "ab"), (2, "c")], "i int, request string")
    got = agents.predict_once(df, lambda text: text.str.upper(), "request").collect()
    assert {(r["i"], r["request"], r["response"]) for r in got} == {(1, "ab", "AB"), (2, "c", "C")}


def test_builtin_and_python_tools(spark):
    tools = agents.Tools(python={"count": lambda arguments: arguments.str.len(), "back": lambda arguments: arguments.str[::-1]})
    tools.add_builtin("upper", "md5")
    assert tools.names() == ["back", "count", "md5", "upper"]

    def ask_all(batch):
        rows = []
        for new in batch["new_messages"]:
            calls = [{"id": n, "name": n, "arguments": "abc"} for n in ("count", "upper", "missing", "back", "md5")]
            rows.append(("assistant", None, calls) if len(new) == 0 else ("assistant", "done", None))
        return pd.DataFrame(rows, columns=["role", "content", "tool_calls"])

    got = agents.run_agent(_turns(spark, [0, 0, 0]), ask_all, tools).collect()
    for conversation in range(3):
        answers = [r["content"] for r in sorted(got, key=lambda r: r["seq"]) if r["conv_id"] == conversation and r["role"] == "tool"]
        assert answers == ["3", "ABC", "unknown tool: missing", "cba", "900150983cd24fb0d6963f7d28e17f72"]


class _Transcript:
    def start(self):
        return []

    def read(self, memory, roles, texts):
        return memory + [f"{r}={t}" for r, t in zip(roles, texts)]

    def finish(self, memory):
        return " ".join(memory)


def test_history_reads_all_turns_in_order_over_batches(spark):
    rows = [(c, t, "user", f"{c}.{t}") for c in (1, 2) for t in range(25)] + [(None, 0, None, None), (3, 0, "user", "")]
    turns = spark.createDataFrame(rows[::-1], TURNS).withColumn("memory", F.lit("clash"))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
        got = {r["conv_id"]: r["memory"] for r in agents.conversation_memory(turns, _Transcript()).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert got.keys() == {None, 1, 2, 3} and got[None] == "None=None" and got[3] == "user="
    assert all(got[c] == " ".join(f"user={c}.{t}" for t in range(25)) for c in (1, 2))


def test_history_of_no_turns(spark):
    assert agents.conversation_memory(spark.createDataFrame([], TURNS), _Transcript()).collect() == []


def test_history_and_context_exclude_each_other(spark):
    with pytest.raises(ValueError):
        agents.run_agent(_turns(spark, [0]), _countdown, agents.Tools(), context={"n": F.count("*")}, history=_Transcript())
