"""Message deltas as a stream: one whole message per delta, in event order."""

from __future__ import annotations

from pyspark.sql import DataFrame

from modelyard.operators.messages import flatten_updates


def delta_stream(events: DataFrame, event: str = "event") -> DataFrame:
    """Messages of streamed update events, one row each; an event without messages is an error.

    Stateless, so it appends; (keys, node_pos, msg_pos) orders the deltas.
    """
    return flatten_updates(events, event, strict=True).withColumnRenamed("message", "delta")
