"""Nested JSON ticket source and JSON result sink."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

S = T.StringType()

RESULT_INFO = T.ArrayType(T.StructType([
    T.StructField("handleEntity", S), T.StructField("handleResult", S),
    T.StructField("handleResultImageUrls", T.ArrayType(S))]))
ACTIONS = T.ArrayType(T.StructType([
    T.StructField("target", S), T.StructField("content", S), T.StructField("action", S),
    T.StructField("timeLimit", T.IntegerType()), T.StructField("think", S),
    T.StructField("citations", T.ArrayType(S))]))

# One ticket schema for scene, dispatch and check tickets; every field is
# nullable (absent keys read as NULL, i.e. the reference's ``.get`` default).
TICKET = T.StructType([
    T.StructField("eventId", S), T.StructField("eventType", S), T.StructField("processActionCode", S),
    T.StructField("processDataParams", T.StructType([
        T.StructField(n, S) for n in ("districtName", "sourceEntity", "sceneType", "regulatedEntity",
                                      "regulatedEntityType", "reportLocation", "gridCode", "reportTime",
                                      "reporter", "reportEntity", "description")]
        + [T.StructField("longitude", T.DoubleType()), T.StructField("latitude", T.DoubleType()),
           T.StructField("imageUrls", T.ArrayType(S))])),
    T.StructField("context", T.StructType([
        T.StructField("imageDescription", S), T.StructField("dispatchTarget", S),
        T.StructField("actions", ACTIONS)])),
    T.StructField("processResultData", T.StructType([T.StructField("target", S)])),
    T.StructField("resultInfo", RESULT_INFO),
    T.StructField("checklistInfo", T.StructType([
        T.StructField("handleItems", T.ArrayType(T.StructType([
            T.StructField("item", S), T.StructField("result", S)])))])),
])


def read_tickets(spark: SparkSession, path: str) -> DataFrame:
    """JSON-lines tickets -> (raw, ticket, eventId, processActionCode), parsed
    strictly with the declared schema: a line that is not exactly one JSON
    object has a NULL ticket and keeps its raw text.  Payload keys outside the
    schema stay readable in ``raw``."""
    lines = spark.read.text(path).select(F.col("value").alias("raw")).filter(F.length(F.trim("raw")) > 0)
    parsed = lines.select("raw", parse_ticket(F.col("raw")).alias("ticket"))
    return parsed.select("raw", "ticket", F.col("ticket.eventId").alias("eventId"),
                         F.col("ticket.processActionCode").alias("processActionCode"))


def parse_ticket(raw: Column, strict: Column | None = None) -> Column:
    """Strictly parse a JSON text into the ticket struct: NULL unless the
    text is exactly one JSON object (``from_json`` alone accepts glued
    objects, so a strict single-object test guards it; ``strict`` is the
    test's result, where a column holds it)."""
    from ..functions.tickets import strict_json_object
    return F.when(strict_json_object(raw) if strict is None else strict, F.from_json(raw, TICKET))


def with_action_code(raw: Column, code: str, strict: Column | None = None) -> Column:
    """The JSON object's text with ``processActionCode`` set (overwritten, or
    added) and every other key carried through, those outside the ticket
    schema too; NULL unless the text is exactly one JSON object (``strict``,
    as in ``parse_ticket``)."""
    from ..functions.tickets import strict_json_object
    fields = F.try_variant_get(F.try_parse_json(raw), "$", "map<string,variant>")
    kept = F.map_filter(fields, lambda k, _: k != "processActionCode")
    said = F.create_map(F.lit("processActionCode"), F.parse_json(F.lit(json.dumps(code))))
    return F.when(strict_json_object(raw) if strict is None else strict, F.to_json(F.map_concat(kept, said)))


def to_json_text(c: Column) -> Column:
    """JSON text with non-ASCII characters kept literal (UTF-8)."""
    return F.to_json(c)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("encoding", "UTF-8").json(path)
