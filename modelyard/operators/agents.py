"""Batch agents: a responder and tools applied to tables of conversations, round by round.

Every conversation is one row with a context and the messages produced since, and every round is a
narrow stage.  The context is computed once: by a `History`, which reads every turn in order and
keeps what the responder needs of it, or, for responders that need less, by aggregates (the last
message and counts by default) with map-side combine.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from typing import Any, Protocol

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from modelyard.functions.scalars import is_truthy_list
from modelyard.schemas import MESSAGE, TOOL_CALL
from modelyard.sources.shared import cut_lineage

# Gets a batch of open conversations (context columns, `new_messages`, `system_prompt`) and returns
# one message per row as a frame with columns role, content, tool_calls.
Responder = Callable[[pd.DataFrame], pd.DataFrame]

_NEW = T.ArrayType(MESSAGE)


class Tools:
    """Functions of a call's argument text, looked up by name.

    Column functions stay in the JVM; a function built into Spark needs no code, only its name.
    Python functions get all arguments of a batch at once.
    """

    def __init__(
        self,
        functions: Mapping[str, Callable[[Column], Column]] | None = None,
        python: Mapping[str, Callable[[pd.Series], pd.Series]] | None = None,
    ) -> None:
        self._functions: dict[str, Callable[[Column], Column]] = {}
        self.python: dict[str, Callable[[pd.Series], pd.Series]] = {}
        for name, function in (functions or {}).items():
            self.add(name, function)
        for name, function in (python or {}).items():
            self.add_python(name, function)

    def _check_new(self, name: str) -> None:
        if name in self._functions or name in self.python:
            raise ValueError(f"tool already there: {name}")

    def add(self, name: str, function: Callable[[Column], Column]) -> None:
        self._check_new(name)
        self._functions[name] = function

    def add_builtin(self, *names: str) -> None:
        """Spark's own functions, by their names."""
        for name in names:
            self.add(name, lambda arguments, name=name: F.call_function(name, arguments))

    def add_python(self, name: str, function: Callable[[pd.Series], pd.Series]) -> None:
        self._check_new(name)
        self.python[name] = function

    def names(self) -> list[str]:
        return sorted([*self._functions, *self.python])

    def result(self, name: Column, arguments: Column) -> Column:
        """Result text of a call; NULL for Python tools, which run in a stage of their own.  A name
        that is not there gives an error text, not a failure."""
        outcome = F.concat(F.lit("unknown tool: "), F.coalesce(name, F.lit("")))
        for known, function in self._functions.items():
            value = F.coalesce(function(arguments).cast("string"), F.lit(""))
            outcome = F.when(name == known, value).otherwise(outcome)
        if self.python:
            outcome = F.when(name.isin(*self.python), F.lit(None).cast("string")).otherwise(outcome)
        return outcome


def default_context() -> dict[str, Column]:
    """Last message and size of a conversation as aggregates over its turns."""
    return {
        "last_role": F.max_by("role", "turn"),
        "last_text": F.max_by("text", "turn"),
        "n_turns": F.count(F.lit(1)),
        "n_chars": F.coalesce(F.sum(F.length("text")), F.lit(0)),
    }


def conversation_context(turns: DataFrame, context: Mapping[str, Column] | None = None) -> DataFrame:
    """One row per conversation; the aggregates should be ones whose size is bounded."""
    chosen = dict(context or default_context())
    return turns.groupBy("conv_id").agg(*[c.alias(n) for n, c in chosen.items()])


class History(Protocol):
    """How a responder reads a whole conversation: all its turns, in order, a stretch at a time."""

    def start(self) -> Any: ...

    def read(self, memory: Any, roles: list[str | None], texts: list[str | None]) -> Any:
        """The memory after some more turns; the next stretch goes on from it."""

    def finish(self, memory: Any) -> str | None:
        """What the responder gets in the column `memory`."""


def conversation_memory(turns: DataFrame, history: History) -> DataFrame:
    """(conv_id, memory): one row per conversation; turns without id make up one conversation.

    The rows of a conversation are sorted on disk where needed and pass through a task in Arrow
    batches, so that a task holds one batch and one memory, however long the conversation is.  Their
    order is the result of reading, so one conversation is read by one task.
    """
    id_field = turns.schema["conv_id"]
    schema = T.StructType([id_field, T.StructField("memory", T.StringType())])

    def remember(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory, current, begun, kind = None, None, False, None
        for batch in batches:
            ids, roles, texts = (batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))
            kind = batch.schema.field("conv_id").type
            done_ids, done, first = [], [], 0
            for here in range(1, len(ids) + 1):
                if here < len(ids) and ids[here] == ids[first]:
                    continue
                if not begun or ids[first] != current:
                    if begun:
                        done_ids.append(current)
                        done.append(history.finish(memory))
                    memory, current, begun = history.start(), ids[first], True
                memory = history.read(memory, roles[first:here], texts[first:here])
                first = here
            yield _memories(done_ids, done, kind)
        if begun:
            yield _memories([current], [history.finish(memory)], kind)

    ordered = turns.select("conv_id", "turn", "role", "text").repartition("conv_id").sortWithinPartitions("conv_id", "turn")
    return ordered.mapInArrow(remember, schema)


def _memories(ids: list, memories: list, kind: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(memories, pa.string())], ["conv_id", "memory"])


def _with_reply(state: DataFrame, responder: Responder, prompt: str | None) -> DataFrame:
    """Appends one message per row.  The prompt is shown to the responder and not stored."""

    def respond(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if batch.empty:
                continue
            replies = responder(batch.assign(system_prompt=prompt or None))
            if len(replies) != len(batch):
                raise ValueError("a responder returns one message per conversation")
            appended = [
                [*old, {"role": r, "content": c, "tool_calls": list(t) if t is not None else None}]
                for old, r, c, t in zip(batch["new_messages"], replies["role"], replies["content"], replies["tool_calls"])
            ]
            yield batch.assign(new_messages=appended)

    return state.mapInPandas(respond, state.schema)


def _with_tool_results(state: DataFrame, tools: Tools) -> DataFrame:
    """One `tool` message for every call of the last message, as a column expression."""
    calls = F.element_at("new_messages", -1)["tool_calls"]
    results = F.transform(
        calls,
        lambda call: F.struct(
            F.lit("tool").alias("role"),
            tools.result(call["name"], call["arguments"]).alias("content"),
            F.from_json(F.lit(None).cast("string"), T.ArrayType(TOOL_CALL)).alias("tool_calls"),
        ),
    )
    answered = state.withColumn("new_messages", F.concat("new_messages", results))
    return _with_python_results(answered, tools.python) if tools.python else answered


def _with_python_results(state: DataFrame, functions: Mapping[str, Callable[[pd.Series], pd.Series]]) -> DataFrame:
    """Fills in the results of Python tools: one call per tool and batch."""

    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            lists = [[_as_dict(m) for m in messages] for messages in batch["new_messages"]]
            waiting: dict[str, list[tuple[dict, str | None]]] = {}
            for messages in lists:
                asking = max(i for i, m in enumerate(messages) if m["role"] != "tool")
                for call, answer in zip(messages[asking]["tool_calls"], messages[asking + 1 :]):
                    if call["name"] in functions:
                        waiting.setdefault(call["name"], []).append((answer, call["arguments"]))
            for name, calls in waiting.items():
                results = functions[name](pd.Series([arguments for _, arguments in calls], dtype=object))
                for (answer, _), result in zip(calls, results):
                    answer["content"] = "" if result is None else str(result)
            yield batch.assign(new_messages=lists)

    return state.mapInPandas(fill, state.schema)


def _as_dict(message) -> dict:
    """A message as Arrow hands it over, with plain calls."""
    plain = message.asDict() if hasattr(message, "asDict") else dict(message)
    calls = plain["tool_calls"]
    if calls is not None:
        plain["tool_calls"] = [c.asDict() if hasattr(c, "asDict") else dict(c) for c in calls]
    return plain


def run_agent(
    turns: DataFrame,
    responder: Responder,
    tools: Tools,
    system_prompt: str | None = None,
    context: Mapping[str, Column] | None = None,
    max_rounds: int | None = None,
    history: History | None = None,
) -> DataFrame:
    """Agent, tools, agent, ... until no message calls tools.

    Returns (conv_id, seq, role, content, tool_calls, finished): the new messages only.  Without
    `max_rounds` it goes on until every conversation has ended; with it, the rest is returned with
    `finished` false and can be continued.  Every round is written to the shared folder, so a lost
    executor costs a part of one round.  With `history` the responder's rows carry its `memory` of all
    turns, otherwise the aggregates of `context`.
    """
    if history is not None and context is not None:
        raise ValueError("either a history or a context")
    seen = conversation_context(turns, context) if history is None else conversation_memory(turns, history)
    state = seen.withColumn("new_messages", F.from_json(F.lit("[]"), _NEW))
    finished: list[DataFrame] = []
    rounds = 0
    while True:
        replied = cut_lineage(_with_reply(state, responder, system_prompt))
        rounds += 1
        goes_on = is_truthy_list(F.element_at("new_messages", -1)["tool_calls"])
        finished.append(replied.where(~goes_on).withColumn("finished", F.lit(True)))
        is_open = replied.where(goes_on)
        if is_open.isEmpty():
            break
        state = _with_tool_results(is_open, tools)
        if max_rounds is not None and rounds >= max_rounds:
            finished.append(state.withColumn("finished", F.lit(False)))
            break
    result = finished[0]
    for part in finished[1:]:
        result = result.unionByName(part)
    return result.select(
        "conv_id", "finished", F.posexplode("new_messages").alias("seq", "m")
    ).select("conv_id", F.col("seq").cast("bigint").alias("seq"), "m.role", "m.content", "m.tool_calls", "finished")


def predict_once(requests: DataFrame, predict: Callable[[pd.Series], pd.Series], request: str, out: str = "response") -> DataFrame:
    """One response per request row; the function gets the requests of a batch at once."""
    schema = T.StructType([*requests.schema.fields, T.StructField(out, T.StringType())])

    def respond(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(**{out: predict(batch[request])})

    return requests.mapInPandas(respond, schema)
