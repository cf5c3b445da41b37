"""Registered conversation queries over ``conversations``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import messages as M
from ..sources.tables import table
from .registry import register


@register("conversation_history", """
SELECT conv_id, turn, role,
  count(*) OVER w AS history_turns,
  CAST(sum(coalesce(length(text), 0)) OVER w AS BIGINT) AS history_chars,
  lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS prev_role
FROM conversations
WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def conversation_history(spark, d):
    return M.history(table(spark, d, "conversations"))


# Supervisor calls composed from the log: the worker asked for is derived
# from who speaks next (user -> search, assistant -> writer, system -> an
# invalid name that must be rejected, nobody -> FINISH).
def _call_spark(next_role):
    name = (F.when(next_role.isNull(), F.lit(M.FINISH))
            .when(next_role == "user", F.lit(M.WORKERS[0]))
            .when(next_role == "assistant", F.lit(M.WORKERS[1]))
            .otherwise(F.lit("Supervisor")))
    return F.concat(F.lit('{"name": "route", "next": "'), name, F.lit('"}'))


_CALL_SQL = ("'{\"name\": \"route\", \"next\": \"' || CASE WHEN nr IS NULL THEN 'FINISH' "
             f"WHEN nr = 'user' THEN '{M.WORKERS[0]}' WHEN nr = 'assistant' THEN '{M.WORKERS[1]}' "
             "ELSE 'Supervisor' END || '\"}'")
_OPTS_SQL = ", ".join(f"'{o}'" for o in M.ROUTE_OPTIONS)


@register("next_worker", f"""
WITH c AS (SELECT conv_id, turn, lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS nr FROM conversations),
p AS (SELECT conv_id, turn, json_extract_string({_CALL_SQL}, '$.next') AS nx FROM c),
v AS (SELECT conv_id, turn, CASE WHEN nx IN ({_OPTS_SQL}) THEN nx END AS next FROM p)
SELECT conv_id, turn, next,
       CASE WHEN next IS NULL THEN 'reject' WHEN next = 'FINISH' THEN 'finish' ELSE 'route' END AS status
FROM v""")
def next_worker(spark, d):
    c = table(spark, d, "conversations").select("conv_id", "turn", "role")
    # who speaks next = the previous speaker in descending turn order
    # (range-split running aggregate: no single task per conversation)
    nxt_role = M.next_value(c, "conv_id", "turn", "role")
    calls = nxt_role.select("conv_id", "turn", _call_spark(F.col("role_next")).alias("call"))
    nxt = M.parse_route(F.col("call"))
    return calls.select("conv_id", "turn", nxt.alias("next"), M.route_status(nxt).alias("status"))
