"""Message lists: long form (conv_id, turn, role, text) and array form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from modelyard.functions.scalars import is_truthy_list
from modelyard.operators.blocks import with_next

SYSTEM_TURN = -1


def prepend_system(messages: Column, prompt: str | None) -> Column:
    """Array form of the model input; the stored state is left alone.  No prompt, no change."""
    if not prompt:
        return messages
    fields = F.struct(
        F.lit("system").alias("role"),
        F.lit(prompt).alias("content"),
        F.from_json(F.lit(None).cast("string"), "array<struct<id:string,name:string,arguments:string>>").alias(
            "tool_calls"
        ),
    )
    return F.concat(F.array(fields), messages)


def with_system_turn(turns: DataFrame, prompt: str | None) -> DataFrame:
    """Long form: one more turn per conversation, before all others, even if it has system turns."""
    if not prompt:
        return turns
    first = turns.select("conv_id").distinct().select(
        "conv_id",
        F.lit(SYSTEM_TURN).cast("bigint").alias("turn"),
        F.lit("system").alias("role"),
        F.lit(prompt).alias("text"),
    )
    return turns.unionByName(first)


def last_messages(turns: DataFrame, *columns: str) -> DataFrame:
    """Last message per conversation, as an aggregate."""
    kept = columns or ("role", "text")
    return turns.groupBy("conv_id").agg(F.max_by(F.struct("turn", *kept), "turn").alias("m")).select("conv_id", "m.*")


def route(has_tool_calls: Column) -> Column:
    return F.when(F.coalesce(has_tool_calls, F.lit(False)), F.lit("continue")).otherwise(F.lit("end"))


def route_conversations(turns: DataFrame, tool_calls: str = "tool_calls") -> DataFrame:
    """`continue` where the last message calls tools, else `end`."""
    calls = is_truthy_list(F.col(tool_calls))
    return turns.groupBy("conv_id").agg(
        F.max("turn").alias("turn"), route(F.max_by(calls, "turn")).alias("route")
    )


def flatten_updates(events: DataFrame, event: str = "event", strict: bool = False) -> DataFrame:
    """Update events (node -> messages) to one row per message, positions kept for order.

    A node without messages gives no rows, or an error in strict mode.
    """
    keys = [c for c in events.columns if c != event]
    nodes = events.select(*keys, F.posexplode(F.map_entries(event)).alias("node_pos", "_node"))
    messages = F.col("_node.value.messages")
    if strict:
        absent = F.raise_error(F.concat(F.lit("no messages from node "), F.col("_node.key")))
        messages = F.coalesce(messages, absent)
    return nodes.select(
        *keys, "node_pos", F.col("_node.key").alias("node"), F.posexplode(messages).alias("msg_pos", "message")
    )


def message_status(role: Column, content: Column) -> Column:
    """`ok`, or what keeps a record from being a message."""
    blank_role = F.coalesce(F.trim(role) == "", F.lit(True))
    return (
        F.when(blank_role, F.lit("no_role"))
        .when(content.isNull(), F.lit("no_content"))
        .otherwise(F.lit("ok"))
    )


def split_valid(turns: DataFrame, role: str = "role", content: str = "text") -> tuple[DataFrame, DataFrame]:
    """(valid, quarantined) rows; together they are the input."""
    marked = turns.withColumn("status", message_status(F.col(role), F.col(content)))
    return marked.where("status = 'ok'").drop("status"), marked.where("status <> 'ok'")


def pair_turns(turns: DataFrame) -> DataFrame:
    """User turns directly followed by an assistant turn."""
    rows = turns.select("conv_id", "turn", "role", "text")
    return (
        with_next(rows, ["conv_id"], "turn", ["role", "text"])
        .where("role = 'user' AND next_role = 'assistant'")
        .select("conv_id", "turn", F.col("text").alias("request"), F.col("next_text").alias("response"))
    )


def trace_summary(turns: DataFrame) -> DataFrame:
    """Steps, roles and characters per conversation."""
    chars = F.length("text")

    def of(role: str) -> Column:
        return F.count_if(F.col("role") == role)

    return turns.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("n_steps"),
        of("user").alias("n_user"),
        of("assistant").alias("n_assistant"),
        of("system").alias("n_system"),
        F.count_if(~F.col("role").isin("user", "assistant", "system")).alias("n_other"),
        F.coalesce(F.sum(chars), F.lit(0)).alias("n_chars"),
        F.max(chars).cast("bigint").alias("longest_step"),
    )
