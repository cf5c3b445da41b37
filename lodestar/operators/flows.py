"""The three ticket flows end to end, on a batch of tickets: dispatch with
rules, completion check, scene consistency.  A ticket's action code says which
one it takes."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import tickets as TK
from ..session import materialize
from ..sources.tickets import to_json_text
from . import model_answers as MA
from . import tickets as OT
from .places import look_up_each, with_row_key

# The action codes of the flows.
DISPATCH, CHECK, SCENE = "EventHandlerLookup", "CheckHandleResult", "EventTypeRecognition"


@dataclass(frozen=True)
class Tools:
    """What the flows look things up in: the stored rule index and how its
    texts are embedded, captions (url, caption, error) with one row a url, a
    text model's loader and the path of its answer table."""

    index_path: str
    embed: Callable[[DataFrame, str], DataFrame]
    captions: DataFrame
    load: Callable[[], Callable[[list[str]], list[str]]]
    answers_path: str
    k: int = 10


def _captioned(tickets: DataFrame, urls: Column, captions: DataFrame, out: str) -> DataFrame:
    """Adds ``out`` and ``out``_errors: the urls' captions and errors, in
    their places; a url without a row in ``captions`` is a failure."""
    rows = with_row_key(tickets.withColumn("__urls", F.coalesce(urls, F.array().cast("array<string>"))))
    met = look_up_each(rows, "__urls", captions, "url", ["caption", "error"], "__seen")
    missing = F.lit("no caption")
    return met.withColumn(out, F.transform("__seen", lambda s: s["caption"])).withColumn(
        f"{out}_errors", F.transform("__seen", lambda s: F.when(s["caption"].isNull(), F.coalesce(s["error"], missing)))).drop(
        "__row", "__urls", "__seen")


def dispatch_flow(tickets: DataFrame, tools: Tools) -> DataFrame:
    """Result tickets of dispatch tickets, citations of the rules on them."""
    asked = OT.dispatch_prompts(OT.dispatch_contexts(tickets, tools.index_path, tools.embed, tools.k), contexts_col="contexts")
    asked = asked.withColumn("contexts", OT.citations_only("contexts"))
    told = MA.ask_list_once(asked, tools.load, tools.answers_path).withColumn(
        "responses", F.transform("answers", lambda a: a["response"]))
    return OT.dispatch_result_tickets(told, contexts_col="contexts")


def _one_answer(asked: DataFrame, tools: Tools) -> DataFrame:
    told = MA.ask_list_once(asked, tools.load, tools.answers_path)
    first = F.try_element_at("answers", F.lit(1))
    return told.select("*", first["response"].alias("response"), first["error"].alias("model_error"))


def check_flow(tickets: DataFrame, tools: Tools) -> DataFrame:
    """Checked tickets (``check_results``), the model asked where a lane's
    results need a verdict."""
    seen = _captioned(tickets, OT.check_image_urls(F.col("ticket")), tools.captions, "result_captions").withColumnRenamed(
        "result_captions_errors", "result_caption_errors")
    return OT.check_results(_one_answer(OT.check_prompts(seen), tools))


def scene_flow(tickets: DataFrame, tools: Tools) -> DataFrame:
    """Result tickets of scene tickets, their images' captions looked up."""
    seen = _captioned(tickets, F.col("ticket.processDataParams.imageUrls"), tools.captions, "captions").withColumnRenamed(
        "captions_errors", "caption_errors")
    return OT.scene_result_tickets(OT.scene_consistency(_one_answer(OT.scene_prompts(seen), tools)))


def process_tickets(messages: DataFrame, tools: Tools) -> dict[str, DataFrame]:
    """Outputs of (raw, payload, ticket) messages, each with one string column:
    ``results`` (result tickets as JSON), ``forwards`` (payloads of check
    tickets whose lane passes them on, whole), ``rejects`` (lines without a
    ticket, and tickets whose code names no flow, as they came).

    The messages are written once, each with the text that some output may
    need: the payload of a check ticket that a lane without a verdict may pass
    on, the line of a reject.  A flow reads its own rows of them.  Every ticket
    is in exactly one output."""
    code, lane = F.col("ticket.processActionCode"), TK.check_route("ticket")
    known = F.coalesce(code.isin(DISPATCH, CHECK, SCENE), F.lit(False))
    text = F.when(~known, F.col("raw")).when((code == CHECK) & ~lane.isin(*OT.CHECK_LANES), F.col("payload"))
    rows = materialize(messages.select("ticket", text.alias("text")), "messages", "zstd")
    stamps = ("processStartAt", "processStartEnd")

    def of(flow: str, *more: str) -> DataFrame:
        return rows.filter(code == flow).select("ticket", *more)

    def told(r: DataFrame, *less: str) -> Column:
        return to_json_text(F.struct(*[c for c in r.columns if c not in (*stamps, *less)], *stamps))

    own = ("__passed", "__text")
    checked = OT.check_result_tickets(check_flow(of(CHECK, "text"), tools), keep=[
        (F.col("status") == "pass").alias("__passed"), F.col("text").alias("__text")])
    checked = materialize(checked.select("__passed", F.when(F.col("__passed"), F.col("__text")).otherwise(
        told(checked, *own)).alias("value")), "checked", "zstd")  # two outputs read it
    texts = [r.select(told(r).alias("value")) for r in (dispatch_flow(of(DISPATCH), tools), scene_flow(of(SCENE), tools))]
    return {"results": texts[0].unionByName(checked.filter(~F.col("__passed")).select("value")).unionByName(texts[1]),
            "forwards": checked.filter("__passed").select("value"),
            "rejects": rows.filter(~known).select(F.col("text").alias("value"))}
