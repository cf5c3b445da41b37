"""Column rules for work-order tickets and model responses.

Every rule is ``Column -> Column`` built from native Spark expressions
(string, regex, JSON/variant, higher-order array functions), so it runs in
whole-stage codegen and applies unchanged to a streaming DataFrame."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _WS, falsy, strip

# Fixed values that must equal the reference's: lane trigger names, lane keys,
# validation and verdict texts, keyword lists, failure marker.
LANES = {
    "运输企业": "transport_company",
    "工地企业": "construction_site",
    "街道办": "subdistrict_office",
    "城市管家": "city_housekeeper",
    "市政服务第三方企业": "municipal_services",
}
MISSING_FIELDS_PREFIX = "工单缺失必要字段："
DEFAULT_REASON = "大模型判断结果"
ANALYSIS_PREFIX = "根据大模型分析，"
DONE_TEXT = "该工单已经完成处理"
NOT_DONE_TEXT = "该工单处理不充分或未完成"
JSON_FAIL_PREFIX = "JSON解析失败，使用备用判断："
JSON_FAIL_THINK = "JSON解析异常"
# Wording of the fallback after a failed model call.
CALL_FAIL_PREFIX, CALL_FAIL_MIDDLE = "大模型调用失败(", ")，使用备用判断："
CALL_FAIL_THINK, CALL_FAIL_THINK_END = "由于大模型调用异常，根据处理结果描述", "进行简单判断。"
DONE_KEYWORDS = ["完成", "充分", "解决"]
CAPTION_FAILURE = "图片处理失败"
THINK_CLOSE = "</think>"
TARGET_HEADER = "责任主体"
REASON_HEADER = "决策理由"
FULL_COLON = "："


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lane_of(name) -> Column:
    """Lane key for a trigger entity name; NULL when unknown.  A literal map
    lookup: no join, no shuffle."""
    m = F.create_map(*[x for k, v in LANES.items() for x in (F.lit(k), F.lit(v))])
    return F.try_element_at(m, _c(name))


def contains_any(c, words: Sequence[str]) -> Column:
    col = _c(c)
    out = F.lit(False)
    for w in words:
        out = out | F.coalesce(col.contains(w), F.lit(False))
    return out


# ------------------------------------------------------------ validation
def dispatch_missing(ticket) -> Column:
    """Names of missing dispatch fields, in check order (NULL or '' is
    missing, as with Python truthiness)."""
    t = _c(ticket)
    p = t["processDataParams"]
    checks = [("description", p["description"]), ("reportLocation", p["reportLocation"]),
              ("sourceEntity", p["sourceEntity"]), ("imageDescription", t["context"]["imageDescription"])]
    return F.array_compact(F.array(*[F.when(falsy(v), F.lit(n)) for n, v in checks]))


def dispatch_error(missing) -> Column:
    m = _c(missing)
    return F.when(F.size(m) > 0, F.concat(F.lit(MISSING_FIELDS_PREFIX), F.array_join(m, ", ")))


def check_valid(ticket) -> Column:
    """Check-time validation: description, image description, dispatch
    target and the first result's handleResult all present."""
    t = _c(ticket)
    first = F.try_element_at(t["resultInfo"], F.lit(1))
    return ~(falsy(t["processDataParams"]["description"]) | falsy(t["context"]["imageDescription"])
             | falsy(t["context"]["dispatchTarget"]) | falsy(first["handleResult"]))


# ------------------------------------------------------------ routing
def dispatch_route(ticket) -> Column:
    """struct(lane, route_status): a non-blank dispatch target decides
    (unknown -> unroutable); else a known result target; else the source
    entity (unknown -> end)."""
    t = _c(ticket)
    dt = strip(t["context"]["dispatchTarget"])
    tgt = strip(t["processResultData"]["target"])
    src = strip(F.coalesce(t["processDataParams"]["sourceEntity"], F.lit("")))
    use_dt = ~falsy(dt)
    lane = (F.when(use_dt, lane_of(dt))
            .when(lane_of(tgt).isNotNull(), lane_of(tgt))
            .otherwise(lane_of(src)))
    status = (F.when(lane.isNotNull(), F.lit("routed"))
              .when(use_dt, F.lit("unroutable")).otherwise(F.lit("end")))
    return F.struct(lane.alias("lane"), status.alias("route_status"))


def check_route(ticket) -> Column:
    """Check-time lane: exact dispatch target only; NULL -> unroutable."""
    return lane_of(_c(ticket)["context"]["dispatchTarget"])


# ------------------------------------------------------------ responses
def answer_after_think(resp) -> Column:
    """Text after the last ``</think>``, stripped (whole text when absent)."""
    return strip(F.substring_index(_c(resp), THINK_CLOSE, -1))


def think_before(resp) -> Column:
    """Text before the first ``</think>`` (opening tag kept), else ''."""
    r = _c(resp)
    return F.when(r.contains(THINK_CLOSE), F.substring_index(r, THINK_CLOSE, 1)).otherwise(F.lit(""))


def think_block(resp) -> Column:
    """Body of the first ``<think>...</think>`` block, stripped, else ''."""
    return strip(F.regexp_extract(_c(resp), "(?s)<think>(.*?)</think>", 1))


def without_think(resp) -> Column:
    """Response with every think block removed, stripped."""
    return strip(F.regexp_replace(_c(resp), "(?s)<think>.*?</think>", ""))


def sections(text) -> Column:
    """struct(target, reason) from a numbered answer: the ``1.`` line naming
    the responsible party gives the text after its first full-width colon;
    the ``2.`` reason header opens the reason, and every later non-blank
    stripped line (section 3 included) joins it until another ``1.`` header.
    A fold over the lines with a struct accumulator."""
    lines = F.split(strip(_c(text)), "\r\n|\r|\n")
    init = F.struct(F.lit("").alias("target"), F.lit("").alias("section"),
                    F.array().cast("array<string>").alias("reason"))

    def step(acc, line):
        ln = strip(line)
        is_t = ln.startswith("1.") & ln.contains(TARGET_HEADER)
        is_r = ln.startswith("2.") & ln.contains(REASON_HEADER)
        after = strip(F.regexp_extract(ln, "(?s)^[^：]*：(.*)$", 1))
        new_target = F.when(ln.contains(FULL_COLON), after).otherwise(acc["target"])
        return (F.when(F.length(ln) == 0, acc)
                .when(is_t, F.struct(new_target.alias("target"), F.lit("target").alias("section"),
                                     acc["reason"].alias("reason")))
                .when(is_r, F.struct(acc["target"].alias("target"), F.lit("reason").alias("section"),
                                     acc["reason"].alias("reason")))
                .when(acc["section"] == "reason",
                      F.struct(acc["target"].alias("target"), acc["section"].alias("section"),
                               F.concat(acc["reason"], F.array(ln)).alias("reason")))
                .otherwise(acc))

    return F.aggregate(lines, init, step,
                       lambda acc: F.struct(acc["target"].alias("target"),
                                            strip(F.array_join(acc["reason"], "\n")).alias("reason")))


def strict_json_object(text) -> Column:
    """True when the text is exactly one JSON object (glued objects,
    trailing junk and bare lists are rejected)."""
    t = _c(text)
    arr = F.concat(F.lit("["), t, F.lit("]"))
    return F.coalesce(t.rlike(f"^{_WS}*\\{{") & (F.json_array_length(arr) == 1), F.lit(False))


def verdict(resp, evidence, fallback_keywords: Sequence[str], error=None, quote_evidence: bool = False) -> Column:
    """struct(completed, reason, think, parse_status) from a completion
    verdict: greedy ``{...}`` -> strict JSON -> ``completed`` (boolean,
    default false) and ``reason``; no braces -> keyword test on the whole
    response; bad JSON -> lane keywords in the evidence text.  A call that
    failed (``error`` is set, or there is no answer) falls back to the same
    keywords and says so; ``quote_evidence`` repeats the evidence there."""
    r = _c(resp)
    err = F.lit(None).cast("string") if error is None else _c(error)
    failed = err.isNotNull() | r.isNull()
    think = think_block(r)
    content = without_think(r)
    js = F.regexp_extract(content, "(?s)(\\{.*\\})", 1)
    ok = strict_json_object(js)
    v = F.try_parse_json(js)
    j_completed = F.coalesce(F.try_variant_get(v, "$.completed", "boolean"), F.lit(False))
    j_reason = F.coalesce(F.try_variant_get(v, "$.reason", "string"), F.lit(DEFAULT_REASON))
    kw_done = contains_any(r, DONE_KEYWORDS)
    ev_done = contains_any(_c(evidence), fallback_keywords)

    def says(done):
        return F.when(done, F.lit(DONE_TEXT)).otherwise(F.lit(NOT_DONE_TEXT))

    no_json = F.length(js) == 0
    told = F.concat(F.lit("'"), F.coalesce(_c(evidence), F.lit("")), F.lit("'")) if quote_evidence else F.lit("")
    completed = F.when(failed, ev_done).when(no_json, kw_done).when(ok, j_completed).otherwise(ev_done)
    reason = (F.when(failed, F.concat(F.lit(CALL_FAIL_PREFIX), F.coalesce(err, F.lit("")), F.lit(CALL_FAIL_MIDDLE),
                                      says(ev_done)))
              .when(no_json, F.concat(F.lit(ANALYSIS_PREFIX), says(kw_done)))
              .when(ok, j_reason).otherwise(F.concat(F.lit(JSON_FAIL_PREFIX), says(ev_done))))
    th = (F.when(failed, F.concat(F.lit(CALL_FAIL_THINK), told, F.lit(CALL_FAIL_THINK_END)))
          .when(no_json, F.when(F.length(think) > 0, think)
                 .otherwise(F.concat(F.substring(content, 1, 200), F.lit("..."))))
          .when(ok, F.when(F.length(think) > 0, think).otherwise(j_reason))
          .otherwise(F.lit(JSON_FAIL_THINK)))
    status = F.when(failed, F.lit("call_failed")).when(no_json, F.lit("no_json")).when(ok, F.lit("json")).otherwise(F.lit("bad_json"))
    return F.struct(completed.alias("completed"), reason.alias("reason"), th.alias("think"),
                    status.alias("parse_status"))


# ------------------------------------------------------------ scene check
def yes_answer(resp) -> Column:
    """Character 是 within the first five characters of the answer."""
    return F.coalesce(F.substring(answer_after_think(resp), 1, 5).contains("是"), F.lit(False))


def negated_answer(resp) -> Column:
    return F.coalesce(F.substring(answer_after_think(resp), 1, 5).contains("不是"), F.lit(False))


def image_id(url) -> Column:
    """URL base name, cut at ``?``, first 12 characters."""
    base = F.substring_index(F.substring_index(_c(url), "/", -1), "?", 1)
    return F.substring(base, 1, 12)


def failed_caption(desc, marker: str = CAPTION_FAILURE) -> Column:
    """Any space-separated token starts with the failure marker."""
    return F.coalesce(F.exists(F.split(_c(desc), " "), lambda t: t.startswith(marker)), F.lit(False))


def caption_text(urls, captions, errors) -> Column:
    """``[id: caption]`` per image in order, failures as
    ``[image_<i>: 图片处理失败: <error>]``, joined by a space.  Arrays are
    aligned by position, so no regrouping is needed; a list that is shorter
    than the URLs, or NULL, reads as NULL there."""
    idx = F.sequence(F.lit(1), F.size(_c(urls)))
    parts = F.transform(idx, lambda i: F.when(
        F.try_element_at(_c(captions), i).isNotNull(),
        F.concat(F.lit("["), image_id(F.element_at(_c(urls), i)), F.lit(": "),
                 strip(F.try_element_at(_c(captions), i)), F.lit("]")))
        .otherwise(F.concat(F.lit("[image_"), i.cast("string"), F.lit(f": {CAPTION_FAILURE}: "),
                            F.coalesce(F.try_element_at(_c(errors), i), F.lit("")), F.lit("]"))))
    return F.when(F.size(_c(urls)) > 0, F.array_join(parts, " ")).otherwise(F.lit(""))


# ------------------------------------------------------------ results
def merged_results(result_info) -> Column:
    """``[entity: result]`` for every non-empty result, joined by a space."""
    ri = F.coalesce(_c(result_info), F.array().cast(
        "array<struct<handleEntity:string,handleResult:string,handleResultImageUrls:array<string>>>"))
    kept = F.filter(ri, lambda x: ~falsy(x["handleResult"]))
    return F.array_join(F.transform(kept, lambda x: F.concat(
        F.lit("["), F.coalesce(x["handleEntity"], F.lit("")), F.lit(": "), x["handleResult"], F.lit("]"))), " ")


def result_image_urls(result_info) -> Column:
    return F.flatten(F.transform(_c(result_info),
                                 lambda x: F.coalesce(x["handleResultImageUrls"], F.array().cast("array<string>"))))


def required_content(actions, target: str) -> Column:
    """What the dispatch asked of ``target``: the content of its first action
    that has any, else ''."""
    hit = first_match(_c(actions), lambda a: (a["target"] == target) & ~falsy(a["content"]))
    return F.coalesce(hit["content"], F.lit(""))


def first_match(arr, pred) -> Column:
    """First array element satisfying ``pred`` (NULL when none)."""
    return F.try_element_at(F.filter(_c(arr), pred), F.lit(1))


def summary_line(target, content, time_limit) -> Column:
    """``- target：first 100 chars...`` plus ``，N分钟内完成`` when limited."""
    tl = _c(time_limit)
    return F.concat(F.lit("- "), F.coalesce(_c(target), F.lit("")), F.lit(FULL_COLON),
                    F.substring(F.coalesce(_c(content), F.lit("")), 1, 100), F.lit("..."),
                    F.when(F.coalesce(tl, F.lit(0)) != 0,
                           F.concat(F.lit("，"), tl.cast("string"), F.lit("分钟内完成"))).otherwise(F.lit("")))
