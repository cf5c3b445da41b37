"""Ticket dispatch, completion check and scene consistency as DataFrame
operators.  The reference's per-lane node functions become one literal lane
table (a map from lane key to its requested actions) that each ticket row is
exploded against: no join, no shuffle, and the same code runs on a stream."""

from __future__ import annotations

import itertools
from typing import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import tickets as TK
from ..functions.text import strip
from ..session import materialize
from . import retrieval as R
from . import vector_index as VI
from .places import look_up_each, with_row_key

# Per-lane requested actions (target, action, time limit,
# whether think/summary are kept, retrieval query suffix), as in the
# reference's dispatch nodes.
DISPATCH_LANES = {
    "transport_company": [("城市管家", "PUSH_API", None, False,
                           "\n留存基础证据；初步安全防护准备（放警示锥等）；协助交警临时管制（若污染较大）")],
    "construction_site": [("街道办", "PUSH_API", None, False,
                           "\n提醒肇事人员及时整改；批评教育（观看污染治理记录片+法规学习）；留存基础证据")],
    "subdistrict_office": [("工地企业", "PUSH_SMS", 120, True,
                            "\n提醒肇事人员及时整改；批评教育（观看污染治理记录片+法规学习）；街道办应该留存基础证据。")],
    "city_housekeeper": [("执法队", "PUSH_API", None, True, "\n案件报送执法队，协助执法队取证。"),
                         ("城市管家", "PUSH_API", None, True,
                          "\n留存基础证据；初步安全防护准备（放警示锥等）；协助交警临时管制（若污染较大）。"
                          "\n协调组织相应环卫企业清洁。")],
    "municipal_services": [("城市管家", "PUSH_API", None, False,
                            "\n留存基础证据.初步安全防护准备（放警示锥等）.协助交警临时管制（若污染较大）")],
}
# Lanes whose prompt names the target entity (the others ask the model to
# find the responsible party).
NAMED_TARGET_LANES = {"subdistrict_office", "city_housekeeper"}

# Completion-check lanes (evidence, fallback keywords, next
# target when done, default re-dispatch target).
CHECK_LANES = {
    "construction_site": ("first", ["完成", "清洗", "处理"], "住建局", "工地企业"),
    "city_housekeeper": ("merged", ["完成", "清洗", "警示锥"], "街道办", "城市管家"),
}
NO_RESULTS_REASON = "缺少处理结果信息"
NO_RESULTS_THINK = "未找到有效的处理结果信息，无法判断完成状态。"
REVIEW_ITEM, REVIEW_DONE = "复查结果", "已完成"
CLOSED_REASON = "已结案，正负清单保存在····点击按钮继续生成治理报告···"
NO_CHECKLIST_REASON = "街道办节点暂未实现超时反馈任务"
SCENE_OK_MSG = "Success: Event type matched successfully."
SCENE_BAD_MSG = "Warning: Event type mismatch detected."
SCENE_EMPTY_REASON = "一致性判断失败: 模型响应为空"

ACTION_TYPE = "array<struct<target:string,content:string,action:string,timeLimit:int>>"


def _lane_actions() -> Column:
    entries = []
    for lane, acts in DISPATCH_LANES.items():
        arr = F.array(*[F.struct(F.lit(i).alias("pos"), F.lit(t).alias("target"), F.lit(a).alias("action"),
                                 F.lit(tl).cast("int").alias("timeLimit"), F.lit(th).alias("keepThink"),
                                 F.lit(sx).alias("suffix")) for i, (t, a, tl, th, sx) in enumerate(acts)])
        entries += [F.lit(lane), arr]
    return F.create_map(*entries)


def dispatch_prompt(description, image_desc, location, source, law_context, target) -> Column:
    """Dispatch question for the model: the rules first, the report as one
    sentence, then the two headers that the section parser reads.  ``target``
    NULL asks the model to name the responsible party."""
    said = F.concat(F.lit("A report"), F.when(TK.falsy(location), F.lit("")).otherwise(F.concat(F.lit(" from "), location)),
                    F.when(TK.falsy(source), F.lit("")).otherwise(F.concat(F.lit(" by "), source)),
                    F.lit(" says: "), F.coalesce(description, F.lit("")), F.lit(" | photo: "),
                    F.coalesce(image_desc, F.lit("")))
    who = F.coalesce(target, F.lit("?"))
    return F.concat_ws("\n", F.concat(F.lit("Rules: "), F.coalesce(law_context, F.lit(""))), said,
                       F.lit("Answer in Chinese under these two headers and nothing else:"),
                       F.concat(F.lit("1. 责任主体："), who), F.lit("2. 决策理由："))


def check_prompt(description, image_desc, required, evidence, evidence_images, target: str) -> Column:
    """Completion question for the model; the verdict parser reads the JSON
    object it asks for."""
    def part(name: str, value) -> Column:
        return F.concat(F.lit(name + ": "), F.coalesce(value, F.lit("")))

    return F.concat_ws("\n", F.lit(f"Has {target} finished the work below?"), part("Work", required),
                       part("Reported", description), part("Photo then", image_desc), part("Done", evidence),
                       part("Photo now", evidence_images),
                       F.lit('Reply with one JSON object: {"completed": true or false, "reason": "why"}'))


def scene_prompt(scene, image_desc) -> Column:
    """Yes/no question whether the photos show the reported scene; the answer
    parser reads 是 near its start."""
    return F.concat(F.lit("Photos: "), F.coalesce(image_desc, F.lit("")), F.lit("\nReported scene: "),
                    F.coalesce(scene, F.lit("")), F.lit("\nDo they agree? Begin with 是 or 否, then one reason."))


def summary_prompt(lines) -> Column:
    """Request for one summary of an event's action lines (array)."""
    return F.concat(F.lit("Sum up these orders in two sentences:\n"), F.array_join(lines, "\n"))


def law_prompt(question, context) -> Column:
    """Question about retrieved rules with a JSON answer."""
    return F.concat(F.lit("Rules:\n"), F.coalesce(context, F.lit("")), F.lit("\nQuestion: "),
                    F.coalesce(question, F.lit("")), F.lit('\nReply as JSON: {"answer": "...", "citations": ["..."]}'))


def dispatch_prompts(tickets: DataFrame, ticket_col: str = "ticket", contexts_col: str | None = None,
                     out_col: str = "prompts") -> DataFrame:
    """Adds the prompts of a ticket's lane actions as an array, in the order
    ``dispatch_result_tickets`` reads answers; no actions, no prompts."""
    t = F.col(ticket_col)
    p = t["processDataParams"]
    route = TK.dispatch_route(t)
    ok = (F.size(TK.dispatch_missing(t)) == 0) & (route["route_status"] == "routed")
    named = route["lane"].isin(*NAMED_TARGET_LANES)

    def ask(a: Column) -> Column:
        rules = F.try_element_at(F.col(contexts_col), a["pos"] + 1)["law_context"] if contexts_col else F.lit("")
        return dispatch_prompt(p["description"], t["context"]["imageDescription"], p["reportLocation"], p["sourceEntity"],
                               rules, F.when(named, a["target"]))

    acts = F.when(ok, F.try_element_at(_lane_actions(), route["lane"]))
    return tickets.withColumn(out_col, F.coalesce(F.transform(acts, ask), F.array().cast("array<string>")))


def dispatch_queries(ticket: Column) -> Column:
    """Retrieval query texts of a ticket's lane actions, in their order:
    description, image text, lane suffix; no actions, no queries."""
    p, route = ticket["processDataParams"], TK.dispatch_route(ticket)
    ok = (F.size(TK.dispatch_missing(ticket)) == 0) & (route["route_status"] == "routed")
    said = F.concat(F.coalesce(p["description"], F.lit("")), F.lit("\n"),
                    F.coalesce(ticket["context"]["imageDescription"], F.lit("")))
    acts = F.when(ok, F.try_element_at(_lane_actions(), route["lane"]))
    return F.coalesce(F.transform(acts, lambda a: F.concat(said, a["suffix"])), F.array().cast("array<string>"))


def dispatch_contexts(tickets: DataFrame, index_path: str, embed: Callable[[DataFrame, str], DataFrame], k: int = 10,
                      ticket_col: str = "ticket", out_col: str = "contexts") -> DataFrame:
    """Adds the rules that each lane action of a ticket asks for, as an array
    of (law_context, citations) in the order of the actions: what
    ``dispatch_prompts`` and ``dispatch_result_tickets`` take as
    ``contexts_col``.  Tickets without actions have an empty array, and two
    tickets of one event, or two equal ones, stay two.

    The rules come from a stored index (``vector_index.build_index`` over
    chunks with id, text, source).  Every distinct query text is embedded
    (``embed(df, text_col)`` adds ``embedding``) once, and every distinct
    vector searched once; the ``k`` nearest chunks' texts are joined in rank
    order and their distinct sources cited."""
    rows = with_row_key(tickets.withColumn("__queries", dispatch_queries(F.col(ticket_col))))
    asked = embed(rows.select(F.explode("__queries").alias("__q")).distinct(), "__q")
    # written: the search reads the vectors more than once
    asked = materialize(asked.withColumn("query_id", F.xxhash64("embedding")), "asked", "zstd")
    hits = VI.search_index(asked.select("query_id", "embedding").distinct(), index_path, k)
    contexts = materialize(R.assemble_context(hits, VI.read_chunks(tickets.sparkSession, index_path), doc_id="id"), "contexts", "zstd")
    found = contexts.join(asked.select("query_id", "__q"), "query_id").select("__q", F.col("context").alias("law_context"), "citations")
    return look_up_each(rows, "__queries", found, "__q", ["law_context", "citations"], out_col).drop("__row", "__queries")


def citations_only(contexts: str | Column) -> Column:
    """``dispatch_contexts`` without the rules' texts, for what comes after the
    prompts that hold them."""
    return F.transform(contexts, lambda c: F.struct(c["citations"].alias("citations")))


def dispatch_requests(tickets: DataFrame, ticket_col: str = "ticket") -> DataFrame:
    """Validate and route each dispatch ticket, then emit one request row per
    action its lane asks for, with the retrieval query text (description,
    image text, lane suffix).  Invalid tickets carry their error instead."""
    t = F.col(ticket_col)
    missing = TK.dispatch_missing(t)
    route = TK.dispatch_route(t)
    base = tickets.select("*", missing.alias("_missing"), route.alias("_route"))
    ok = (F.size("_missing") == 0) & (F.col("_route.route_status") == "routed")
    acts = F.when(ok, F.try_element_at(_lane_actions(), F.col("_route.lane")))
    rows = base.select("*", F.explode_outer(acts).alias("_a"))
    p = t["processDataParams"]
    query = F.concat(F.coalesce(p["description"], F.lit("")), F.lit("\n"),
                     F.coalesce(t["context"]["imageDescription"], F.lit("")), F.col("_a.suffix"))
    return rows.select(
        "*", F.col("_route.lane").alias("lane"), F.col("_route.route_status").alias("route_status"),
        TK.dispatch_error(F.col("_missing")).alias("error"),
        F.col("_a.pos").alias("action_pos"), F.col("_a.target").alias("target"), F.col("_a.action").alias("action"),
        F.col("_a.timeLimit").alias("time_limit"), F.col("_a.keepThink").alias("keep_think"),
        F.when(F.col("_a").isNotNull(), query).alias("query"))


def dispatch_actions(requests: DataFrame, response_col: str = "response") -> DataFrame:
    """Parse each model answer into an action: reason text from the numbered
    sections, think text kept where the lane keeps it, and the summary
    line."""
    r = F.col(response_col)
    reason = TK.sections(TK.answer_after_think(r))["reason"]
    think = F.when(F.col("keep_think"), TK.think_before(r))
    return requests.select("*", reason.alias("content"), think.alias("think"),
                           F.when(F.col("lane").isin(*NAMED_TARGET_LANES) & F.col("action_pos").isNotNull(),
                                  TK.summary_line(F.col("target"), reason, F.col("time_limit"))).alias("summary_line"))


def _no_results() -> Column:
    return F.struct(F.lit(False).alias("completed"), F.lit(NO_RESULTS_REASON).alias("reason"),
                    F.lit(NO_RESULTS_THINK).alias("think"), F.lit("no_results").alias("parse_status"))


def _original_actions(ticket: Column) -> Column:
    return F.coalesce(F.transform(ticket["context"]["actions"], lambda a: F.struct(
        *[a[c].alias(c) for c in ("target", "content", "action", "timeLimit")])), F.array().cast(ACTION_TYPE))


def _by_lane(lane: Column, value: Callable[[str], Column], none: Column) -> Column:
    out = none
    for ln in CHECK_LANES:
        out = F.when(lane == ln, value(ln)).otherwise(out)
    return out


def check_image_urls(ticket: Column) -> Column:
    """Image URLs of the results that a check lane looks at: the first
    result's, or all of them."""
    ri = ticket["resultInfo"]
    return _by_lane(TK.check_route(ticket), lambda ln: F.coalesce(TK.result_image_urls(
        ri if CHECK_LANES[ln][0] == "merged" else F.slice(ri, 1, 1)), F.array().cast("array<string>")),
        F.array().cast("array<string>"))


def check_prompts(tickets: DataFrame, ticket_col: str = "ticket", out_col: str = "prompts") -> DataFrame:
    """Adds the completion question of a check ticket as an array: one prompt
    where its lane asks a model and results are there, else none.  Captions
    come from ``result_captions`` and ``result_caption_errors``, if there."""
    t = F.col(ticket_col)
    p, ri, lane = t["processDataParams"], t["resultInfo"], TK.check_route(t)
    captions = [F.col(c) if c in tickets.columns else F.lit(None).cast("array<string>")
                for c in ("result_captions", "result_caption_errors")]

    def ask(ln: str) -> Column:
        evidence = TK.merged_results(ri) if CHECK_LANES[ln][0] == "merged" else F.coalesce(
            F.try_element_at(ri, F.lit(1))["handleResult"], F.lit(""))
        return F.array(check_prompt(p["description"], t["context"]["imageDescription"],
                                    TK.required_content(_original_actions(t), CHECK_LANES[ln][3]), evidence,
                                    TK.caption_text(check_image_urls(t), *captions), CHECK_LANES[ln][3]))

    none = F.array().cast("array<string>")
    asked = F.coalesce(F.size(ri) > 0, F.lit(False))
    return tickets.withColumn(out_col, F.when(asked, _by_lane(lane, ask, none)).otherwise(none))


def scene_prompts(tickets: DataFrame, ticket_col: str = "ticket", captions_col: str = "captions",
                  errors_col: str = "caption_errors", out_col: str = "prompts") -> DataFrame:
    """Adds the scene question of every ticket, as an array of one."""
    p = F.col(ticket_col)["processDataParams"]
    urls = F.coalesce(p["imageUrls"], F.array().cast("array<string>"))
    return tickets.withColumn(out_col, F.array(scene_prompt(p["sceneType"], TK.caption_text(
        urls, F.col(captions_col), F.col(errors_col)))))


def check_results(tickets: DataFrame, ticket_col: str = "ticket", response_col: str = "response") -> DataFrame:
    """Completion check per ticket, routed on the exact dispatch target.

    * construction site / city housekeeper: evidence (first result, or all
      results merged) plus the model verdict; done -> next lane, not done ->
      original actions or the lane default;
    * subdistrict office: checklist review (first ``复查结果`` item);
    * pass-through lanes: only validation; unknown lane: unroutable."""
    t = F.col(ticket_col)
    lane = TK.check_route(t)
    ri = t["resultInfo"]
    has_results = F.coalesce(F.size(ri) > 0, F.lit(False))
    first = F.coalesce(F.try_element_at(ri, F.lit(1))["handleResult"], F.lit(""))
    merged = TK.merged_results(ri)
    orig = _original_actions(t)
    caption_cols = [F.col(c) if c in tickets.columns else F.lit(None).cast("array<string>")
                    for c in ("result_captions", "result_caption_errors")]
    error = F.col("model_error") if "model_error" in tickets.columns else None
    acts_given = t["context"]["actions"].isNotNull()

    # The verdict of the row's own lane is computed once into a column (a
    # CASE on the lane), then its fields are picked; repeating the verdict
    # expression in every output column would re-run its regex/JSON work.
    vcol = F.lit(None).cast("struct<completed:boolean,reason:string,think:string,parse_status:string>")
    ecol = F.lit(None).cast("string")
    for ln, (evid, kws, _, _) in CHECK_LANES.items():
        evidence = first if evid == "first" else merged
        vcol = F.when(lane == ln, F.when(has_results, TK.verdict(F.col(response_col), evidence, kws, error,
                                                                            evid == "first"))
                      .otherwise(_no_results())).otherwise(vcol)
        ecol = F.when(lane == ln, F.when(has_results, evidence).otherwise(F.lit(""))).otherwise(ecol)
    tickets = tickets.withColumn("_verdict", vcol).withColumn("_evidence", ecol)
    out = {}
    for ln, (evid, kws, done_target, default_target) in CHECK_LANES.items():
        v = F.col("_verdict")
        done = v["completed"]
        # not done: the original actions if any, else the lane's own target
        own = F.array(_action(default_target))
        redo = F.when(has_results, F.when(F.size(orig) > 0, orig).otherwise(own)).otherwise(
            F.when(acts_given, orig).otherwise(own))
        nxt = F.when(done, F.array(_action(done_target, "PUSH_API"))).otherwise(redo)
        # captions of the lane's result images, and what the dispatch asked of it
        urls = ri if evid == "merged" else F.slice(ri, 1, 1)
        shown = F.when(has_results, TK.caption_text(F.coalesce(TK.result_image_urls(urls), F.array().cast("array<string>")),
                                                    *caption_cols)).otherwise(F.lit(""))
        out[ln] = (v, F.col("_evidence"), nxt, shown, TK.required_content(orig, default_target))

    items = t["checklistInfo"]["handleItems"]
    review = TK.first_match(F.coalesce(items, F.array().cast("array<struct<item:string,result:string>>")),
                            lambda x: x["item"] == REVIEW_ITEM)["result"]
    has_list = t["checklistInfo"].isNotNull()
    sub_done = has_list & F.coalesce(review == REVIEW_DONE, F.lit(False))
    valid = TK.check_valid(t)

    def pick(field_fn, sub, passthru, unroutable):
        expr = F.when(lane.isNull(), unroutable)
        for ln in CHECK_LANES:
            expr = expr.when(lane == ln, field_fn(ln))
        return expr.when(lane == "subdistrict_office", sub).otherwise(passthru)

    status = pick(lambda ln: F.lit("checked"),
                  F.when(sub_done, F.lit("closed")).when(has_list, F.lit("redispatch")).otherwise(F.lit("pending")),
                  F.when(valid, F.lit("pass")).otherwise(F.lit("invalid")), F.lit("unroutable"))
    completed = pick(lambda ln: out[ln][0]["completed"], sub_done, F.lit(None).cast("boolean"),
                     F.lit(None).cast("boolean"))
    reason = pick(lambda ln: out[ln][0]["reason"],
                  F.when(sub_done, F.lit(CLOSED_REASON)).when(has_list, F.lit(None).cast("string"))
                  .otherwise(F.lit(NO_CHECKLIST_REASON)), F.lit(None).cast("string"), F.lit(None).cast("string"))
    think = pick(lambda ln: out[ln][0]["think"], F.lit(None).cast("string"), F.lit(None).cast("string"),
                 F.lit(None).cast("string"))
    none_s, no_actions = F.lit(None).cast("string"), F.array().cast(ACTION_TYPE)
    shown = pick(lambda ln: out[ln][3], none_s, none_s, none_s)
    required = pick(lambda ln: out[ln][4], none_s, none_s, none_s)
    nxt = pick(lambda ln: out[ln][2],
               F.when(sub_done, no_actions).when(has_list, orig).otherwise(no_actions),
               no_actions, no_actions)
    evidence = pick(lambda ln: out[ln][1], F.lit(None).cast("string"), F.lit(None).cast("string"),
                    F.lit(None).cast("string"))
    code = F.when(status == "invalid", F.lit(1)).when(status == "pass", F.lit(None).cast("int")) \
        .when(status == "unroutable", F.lit(None).cast("int")).otherwise(F.lit(0))
    out_df = tickets.select("*", lane.alias("lane"), status.alias("status"), completed.alias("completed"),
                            (status == "closed").alias("closed"), reason.alias("reason"), think.alias("think"),
                            nxt.alias("next_actions"), F.transform(nxt, lambda a: a["target"]).alias("next_targets"),
                            evidence.alias("evidence"), shown.alias("result_image_description"),
                            required.alias("required_content"), code.alias("result_code"))
    return out_df.drop("_verdict", "_evidence")


def _action(target: str, action: str | None = None) -> Column:
    return F.struct(F.lit(target).alias("target"), F.lit(None).cast("string").alias("content"),
                    F.lit(action).cast("string").alias("action"), F.lit(None).cast("int").alias("timeLimit"))


def check_result_tickets(checked: DataFrame, ticket_col: str = "ticket", keep: Sequence[Column] = ()) -> DataFrame:
    """Result ticket per checked event.  Pass-through lanes forward the ticket
    without a result; an unknown lane or an invalid ticket says why.  Columns
    in ``keep`` stay beside the result."""
    why = (F.when(F.col("status") == "unroutable", F.lit("no lane for the dispatch target"))
           .when(F.col("status") == "invalid", F.lit("ticket lacks required fields")))
    data = F.struct("completed", F.when(F.col("closed"), F.lit(True)).alias("closed"), "reason", "think",
                    F.col("result_image_description").alias("handleResultImageDescription"),
                    F.col("next_actions").alias("actions"), why.alias("error"))
    return stamped(checked.select(F.col(ticket_col)["eventId"].alias("eventId"), F.col("result_code").alias("processResultCode"),
                                  F.lit("CheckHandleResult").alias("processActionCode"),
                                  F.when(F.col("status") != "pass", data).alias("processResultData"), *keep))


def scene_result_tickets(scenes: DataFrame, ticket_col: str = "ticket") -> DataFrame:
    """Result ticket per scene check."""
    t = F.col(ticket_col)
    data = F.struct(F.col("hint_html").alias("detectedEventType"), F.col("image_description").alias("imageDescription"),
                    F.col("is_consistent").alias("isConsistency"))
    return stamped(scenes.select(F.coalesce(t["eventId"], F.lit("")).alias("eventId"),
                                 F.coalesce(t["processActionCode"], F.lit("")).alias("processActionCode"),
                                 F.col("result_code").alias("processResultCode"), F.col("result_msg").alias("processResultMsg"),
                                 data.alias("processResultData")))


def scene_consistency(tickets: DataFrame, ticket_col: str = "ticket", captions_col: str = "captions",
                      errors_col: str = "caption_errors", response_col: str = "response") -> DataFrame:
    """Caption text per ticket, yes/no consistency verdict from the model
    answer, error flag and an HTML hint; an answer of white space is empty."""
    t = F.col(ticket_col)
    urls = F.coalesce(t["processDataParams"]["imageUrls"], F.array().cast("array<string>"))
    desc = TK.caption_text(urls, F.col(captions_col), F.col(errors_col))
    r = F.col(response_col)
    empty = F.coalesce(F.length(strip(r)) == 0, F.lit(True))
    consistent = F.when(empty, F.lit(False)).otherwise(TK.yes_answer(r))
    reason = F.when(empty, F.lit(SCENE_EMPTY_REASON)).otherwise(r)
    has_error = TK.failed_caption(desc) | empty
    scene = F.coalesce(t["processDataParams"]["sceneType"], F.lit(""))
    hint = F.concat(F.lit("<div class=\"scene\"><h4>"), scene, F.lit(" · "),
                    F.when(consistent, F.lit("match")).otherwise(F.lit("mismatch")), F.lit("</h4><figure>"), desc,
                    F.lit("</figure><blockquote>"), reason, F.lit("</blockquote></div>"))
    return tickets.select("*", desc.alias("image_description"), consistent.alias("is_consistent"),
                          F.when(empty, F.lit(False)).otherwise(TK.negated_answer(r)).alias("negated"),
                          has_error.alias("has_error"),
                          F.when(has_error, F.lit("1")).otherwise(F.lit("0")).alias("result_code"),
                          F.when(consistent, F.lit(SCENE_OK_MSG)).otherwise(F.lit(SCENE_BAD_MSG)).alias("result_msg"),
                          hint.alias("hint_html"))


# ------------------------------------------------------------ model hooks
def _call(fn: Callable, inputs: list) -> tuple[list, list]:
    """(outputs, errors) of a batch function: one call for the batch, and if
    that fails one call a row, so a bad row costs no other its answer."""
    if not inputs:
        return [], []
    try:
        out = list(fn(inputs))
        if len(out) == len(inputs):
            return out, [None] * len(inputs)
        failure = f"ValueError: {len(out)} results for {len(inputs)} inputs"
    except Exception as e:  # a model's failure is data here
        failure = f"{type(e).__name__}: {e}"
    if len(inputs) == 1:
        return [None], [failure]
    rows = [_call(fn, [x]) for x in inputs]
    return [r[0][0] for r in rows], [r[1][0] for r in rows]


def model_hook(df: DataFrame, load: Callable[[], Callable[[list], list]], inputs: Sequence[str], out_col: str,
               out_type: T.DataType, error_col: str, convert: Callable = lambda x: x) -> DataFrame:
    """Adds a user model's result per row.  ``load`` runs inside the task,
    once per partition, and returns the batch function, so a model is never
    pickled and loads once; it gets one list entry per row (a tuple if there
    are several inputs).  A row whose call fails has a NULL result and its
    error in ``error_col``."""
    schema = T.StructType(df.schema.fields + [T.StructField(out_col, out_type), T.StructField(error_col, T.StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fn = load()
        for pdf in batches:
            cols = [pdf[c].tolist() for c in inputs]
            out, errors = _call(fn, cols[0] if len(cols) == 1 else list(zip(*cols)))
            pdf[out_col] = pd.Series([None if x is None else convert(x) for x in out], index=pdf.index, dtype=object)
            pdf[error_col] = pd.Series(errors, index=pdf.index, dtype=object)
            yield pdf

    return df.mapInPandas(run, schema)


def ask_model(df: DataFrame, load: Callable[[], Callable[[list[str]], list[str]]], prompt_col: str = "prompt",
              out_col: str = "response", error_col: str = "model_error") -> DataFrame:
    """Prompt -> answer by a user model (see ``model_hook``)."""
    return model_hook(df.withColumn(prompt_col, F.coalesce(prompt_col, F.lit(""))), load, [prompt_col], out_col,
                      T.StringType(), error_col)


def ask_model_list(df: DataFrame, load: Callable[[], Callable[[list[str]], list[str]]], prompts_col: str = "prompts",
                   out_col: str = "responses", error_col: str = "model_errors") -> DataFrame:
    """Array of prompts -> array of answers per row, and the errors in the
    same places: a ticket keeps its row while each of its actions is asked."""
    texts = T.ArrayType(T.StringType())
    schema = T.StructType(df.schema.fields + [T.StructField(out_col, texts), T.StructField(error_col, texts)])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fn = load()
        for pdf in batches:
            lists = [[] if x is None else ["" if p is None else p for p in x] for x in pdf[prompts_col]]
            out, errors = _call(fn, [p for x in lists for p in x])
            ends = [0, *itertools.accumulate(len(x) for x in lists)]
            for name, flat in ((out_col, out), (error_col, errors)):
                pdf[name] = pd.Series([flat[a:b] for a, b in zip(ends[:-1], ends[1:])], index=pdf.index, dtype=object)
            yield pdf

    return df.mapInPandas(run, schema)


def describe_images(images: DataFrame, load: Callable[[], Callable[[list[bytes]], list[str]]], content_col: str = "content",
                    out_col: str = "caption", error_col: str = "caption_error") -> DataFrame:
    """Image bytes -> caption by a user model over a ``binaryFile`` table;
    the caption merger renders errors as ``[image_<i>: 图片处理失败: <error>]``."""
    return model_hook(images, load, [content_col], out_col, T.StringType(), error_col)


def score_pairs(pairs: DataFrame, load: Callable[[], Callable[[list[tuple[str, str]]], list[float]]],
                query_col: str = "query", text_col: str = "text", out_col: str = "score",
                error_col: str = "score_error") -> DataFrame:
    """(query, text) -> relevance score by a user model, for reranking."""
    return model_hook(pairs, load, [query_col, text_col], out_col, T.DoubleType(), error_col, float)


def stamped(df: DataFrame, start: Column | None = None, end: Column | None = None, start_col: str = "processStartAt",
            end_col: str = "processStartEnd") -> DataFrame:
    """Processing stamps in ISO form: the given timestamp columns (the model
    call's begin and end, say), else the query's start, one value on every
    row, so re-running a failed task does not change them."""
    def iso(c: Column | None) -> Column:
        return F.date_format(F.current_timestamp() if c is None else c, "yyyy-MM-dd'T'HH:mm:ss")

    return df.withColumn(start_col, iso(start)).withColumn(end_col, iso(end if end is not None else start))


def dispatch_result_tickets(tickets: DataFrame, ticket_col: str = "ticket", responses_col: str = "responses",
                            contexts_col: str | None = None, keep: Sequence[Column] = ()) -> DataFrame:
    """Result ticket per dispatch ticket row, with the columns in ``keep``: an error for invalid and
    unroutable tickets, a single forwarded action for one-action lanes, an
    action list with citations plus summary lines for lanes that keep think
    text.  ``responses_col`` holds the model's answers in the order of the
    lane's actions; ``contexts_col``, if given, structs with ``citations``.

    The actions are an array on the ticket row: nothing is exploded or
    regrouped, so two tickets of one event stay two."""
    t = F.col(ticket_col)
    missing, route = TK.dispatch_missing(t), TK.dispatch_route(t)
    base = tickets.select(t.alias("_t"), F.col(responses_col).alias("_r"),
                          (F.col(contexts_col) if contexts_col else F.lit(None)).alias("_x"),
                          TK.dispatch_error(missing).alias("_bad"), route["lane"].alias("_lane"),
                          route["route_status"].alias("_status"), F.struct(F.lit(0).alias("_"), *keep).alias("_keep"))
    ok = F.col("_bad").isNull() & (F.col("_status") == "routed")
    asked = F.when(ok, F.try_element_at(_lane_actions(), F.col("_lane")))

    def told(a: Column) -> Column:
        said = F.try_element_at(F.col("_r"), a["pos"] + 1)
        reason = TK.sections(TK.answer_after_think(F.coalesce(said, F.lit(""))))["reason"]
        cited = F.try_element_at(F.col("_x"), a["pos"] + 1)["citations"] if contexts_col else F.lit(None)
        return F.struct(a["target"].alias("target"), reason.alias("content"), a["action"].alias("action"),
                        a["timeLimit"].alias("timeLimit"), F.when(a["keepThink"], TK.think_before(said)).alias("think"),
                        F.when(a["keepThink"], cited).cast("array<string>").alias("citations"))

    acts = base.withColumn("_acts", F.transform(asked, told))
    multi = F.col("_lane").isin(*NAMED_TARGET_LANES) & ok
    one = F.when(ok & ~multi, F.try_element_at("_acts", F.lit(1)))
    summary = F.array_join(F.transform("_acts", lambda a: TK.summary_line(a["target"], a["content"], a["timeLimit"])), "\n")
    error = F.coalesce(F.col("_bad"), F.when(F.col("_status") != "routed", F.concat(F.lit("no lane: "), F.col("_status"))))
    data = F.struct(error.alias("error"), one["target"].alias("target"), one["content"].alias("content"),
                    one["action"].alias("action"), F.when(multi, F.col("_acts")).alias("actions"),
                    F.when(multi, summary).alias("summary"))
    code = F.when(error.isNotNull(), F.lit(1)).when(multi, F.lit(0))
    return stamped(acts.select(F.col("_t.eventId").alias("eventId"), code.alias("processResultCode"),
                               F.col("_t.processActionCode").alias("processActionCode"), data.alias("processResultData"),
                               "_keep.*").drop("_"))


def retrieve_rules(requests: DataFrame, chunks: DataFrame, embed: Callable[[DataFrame, str], DataFrame], k: int = 10,
                   query_col: str = "query") -> DataFrame:
    """Rule context of dispatch requests: each distinct query text is embedded
    (``embed(df, text_col)`` adds ``embedding``), the ``k`` nearest chunks
    (doc_id, text, source, embedding) are joined in rank order, and their
    distinct sources cited.  Adds ``law_context`` and ``citations``; requests
    without a query have neither."""
    asked = requests.select(F.col(query_col).alias("_q")).filter("_q is not null").distinct().withColumn(
        "query_id", F.xxhash64("_q"))
    hits = R.knn(embed(asked, "_q"), chunks, k, corpus_id="doc_id")
    found = R.assemble_context(hits, chunks).join(asked, "query_id").select(
        F.col("_q"), F.col("context").alias("law_context"), "citations")
    return requests.join(found, requests[query_col] == F.col("_q"), "left").drop("_q")
