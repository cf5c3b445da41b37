"""Conversation logs: append-only history per conversation and the
supervisor's next-worker decision.

History is expressed with running window aggregates (count, characters,
previous speaker) instead of materialising the growing message list per
turn: output stays linear in the number of messages even for a very long
conversation, and the window sort spills instead of holding a group in
memory."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The supervisor's workers and its end marker, as in the reference.
WORKERS = ["Search_Engine", "Twitter_Writer"]
FINISH = "FINISH"
ROUTE_OPTIONS = [FINISH] + WORKERS


def history(msgs: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
            text: str = "text") -> DataFrame:
    """Per message: how many messages (and characters) the conversation
    state holds after appending it, and who spoke before.  Running values
    come from the range-split running aggregate, so one very long
    conversation is spread over many tasks instead of one."""
    from .running import running
    base = msgs.select(conv, turn, role, F.coalesce(F.length(text), F.lit(0)).alias("_chars"))
    r = running(base, conv, [turn], sums=["_chars"], prev=[role])
    return r.select(conv, turn, role, F.col("_rn").alias("history_turns"),
                    F.col("_chars_run").cast("long").alias("history_chars"), F.col(f"{role}_prev").alias("prev_role"))


def next_value(msgs: DataFrame, conv: str, turn: str, col: str) -> DataFrame:
    """``<col>_next``: the value on the following turn of the same
    conversation (NULL on the last turn)."""
    from .running import running
    r = running(msgs, conv, [turn], prev=[col], descending=True)
    return r.withColumnRenamed(f"{col}_prev", f"{col}_next").drop("_rn")


def parse_route(call_json, options: Sequence[str] = ROUTE_OPTIONS) -> "F.Column":
    """``next`` field of a function-call payload, NULL unless it is one of
    the allowed options."""
    nxt = F.get_json_object(call_json, "$.next")
    return F.when(nxt.isin(list(options)), nxt)


def route_status(nxt) -> "F.Column":
    return F.when(nxt.isNull(), F.lit("reject")).when(nxt == FINISH, F.lit("finish")).otherwise(F.lit("route"))
