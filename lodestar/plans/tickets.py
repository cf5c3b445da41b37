"""Registered ticket queries.  Tickets and model answers are composed from
``events`` by SQL expressions that Spark (``selectExpr``) and DuckDB read
identically; the operators under test then work on the nested ticket
struct in Spark, while the oracle re-implements each rule in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import tickets as TK
from ..operators import flows as FL
from ..operators import model_answers as MA
from ..operators import retrieval as R
from ..operators import tickets as OT
from ..operators import vector_index as VI
from ..session import shared_dir
from ..sources import tickets as TS
from ..sources.tables import table
from .registry import ORACLE, register
from .retrieval import token_vector_ctes

_NAMES = list(TK.LANES)  # trigger names in lane order


def _lane(i: str) -> str:
    return "CASE " + i + " " + " ".join(f"WHEN {n} THEN '{v}'" for n, v in enumerate(_NAMES)) + " END"


def _lane_key(x: str) -> str:
    return "CASE " + x + " " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in TK.LANES.items()) + " END"


_NL = "chr(10)"
_WS = "[ \\t\\n\\r\\f\\x0B\\x{3000}]"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^{_WS}+|{_WS}+$', '', 'g')"


def _falsy(x: str) -> str:
    return f"({x} IS NULL OR {x} = '')"


# ---------------------------------------------------------------- composition
_K = "CAST(regexp_extract(props, '[0-9]+', 0) AS INT)"
_BASE_COLS = [
    ("event_id", "event_id"), ("user_id", "user_id"), ("event_type", "event_type"), ("k", _K),
    ("eventId", "'EV-' || CAST(event_id AS STRING)"),
    ("description", f"CASE WHEN {_K} % 10 = 0 THEN '' WHEN {_K} % 10 = 1 THEN NULL "
                    "ELSE event_type || ' 遗洒 ' || CAST(user_id AS STRING) END"),
    ("reportLocation", f"CASE WHEN {_K} % 9 = 0 THEN NULL ELSE 'district-' || CAST(user_id % 50 AS STRING) END"),
    ("sourceEntity", f"CASE WHEN user_id % 6 = 5 THEN '  ' ELSE {_lane('user_id % 6')} END"),
    ("imageDescription", f"CASE WHEN {_K} % 7 = 0 THEN NULL WHEN {_K} % 7 = 1 THEN '' ELSE "
                         "'[' || substr(md5(CAST(event_id AS STRING)), 1, 12) || ': 一辆' || event_type || '车辆]' END"),
    ("dispatchTarget", f"CASE event_id % 7 WHEN 0 THEN '   ' WHEN 1 THEN {_lane(f'{_K} % 5')} WHEN 2 THEN 'X' "
                       f"WHEN 3 THEN ' ' || {_lane(f'({_K} + 1) % 5')} || ' ' ELSE NULL END"),
    ("resultTarget", f"CASE {_K} % 4 WHEN 0 THEN {_lane(f'({_K} + user_id) % 5')} WHEN 1 THEN 'nobody' ELSE NULL END"),
    # check tickets: exact dispatch target, results, actions, checklist
    ("checkTarget", f"CASE WHEN event_id % 11 = 0 THEN NULL WHEN {_K} % 6 = 5 THEN 'X' "
                    f"ELSE {_lane(f'{_K} % 6')} END"),
    ("n_res", "CAST(user_id % 4 AS INT)"),
    ("act_kind", "CAST(event_id % 3 AS INT)"),
    ("act_target", _lane(f"({_K} + 2) % 5")),
    ("list_kind", f"CAST({_K} % 3 AS INT)"),
    ("review1", f"CASE WHEN {_K} % 2 = 0 THEN '已完成' ELSE '未完成' END"),
    ("review2", "CASE WHEN user_id % 2 = 0 THEN '已完成' ELSE '未完成' END"),
    # scene tickets: image count
    ("n_img", "CAST(user_id % 3 AS INT)"),
]
for _i in range(3):
    _BASE_COLS += [(f"ent{_i}", _lane(f"({_K} + {_i}) % 5")),
                   (f"res{_i}", f"CASE WHEN (event_id + {_i}) % 4 = 0 THEN '' ELSE CASE ({_K} + {_i}) % 3 "
                                "WHEN 0 THEN '已完成清洗' WHEN 1 THEN '处理中' ELSE '现场已摆放警示锥' END END")]
for _i in range(2):
    _BASE_COLS += [(f"url{_i}", "'http://img.example.com/p/' || substr(md5(CAST(event_id * 10 + " + str(_i)
                    + " AS STRING)), 1, 16) || '.jpg?sig=" + str(_i) + "'"),
                   (f"cap{_i}", f"CASE WHEN (event_id + {_i}) % 5 = 0 THEN NULL ELSE "
                                "'一辆' || event_type || '车辆停在路边 ' END"),
                   (f"err{_i}", f"CASE WHEN (event_id + {_i}) % 5 = 0 THEN 'timeout' END")]


def _answer_sql(i: str) -> str:
    """Composed dispatch answer (numbered sections, optional think blocks)."""
    lane = _lane(f"k % 5")
    return (f"CASE ({i}) % 6 "
            f"WHEN 0 THEN '<think>' || {_NL} || '分析 ' || event_type || {_NL} || '</think>' || {_NL} || {_NL} || "
            f"'1. 责任主体：' || {lane} || {_NL} || '2. 决策理由（包括参考的法规）：' || {_NL} || '- 依据第' || "
            f"CAST(k AS STRING) || '条' || {_NL} || {_NL} || '- 现场核实' || {_NL} || '3. 应执行的具体操作：' || "
            f"{_NL} || '   - 立即措施：清理' "
            f"WHEN 1 THEN '1. 责任主体 ' || {lane} || {_NL} || '2. 决策理由：' || {_NL} || 'reason ' || "
            f"CAST(user_id AS STRING) "
            f"WHEN 2 THEN '<think>a</think><think>b</think>答案 ' || event_type || {_NL} || '1. 责任主体：甲：乙' || "
            f"{_NL} || '2. 决策理由：' || {_NL} || '  x  ' "
            f"WHEN 3 THEN '  ' || {_NL} || '1. 其他' || {_NL} || '2. 决策理由' || {_NL} || '1. 不是标题' || "
            f"{_NL} || 'y' "
            f"WHEN 4 THEN '</think>only close ' || event_type ELSE '' END")


_VERDICT_SQL = (f"CASE event_id % 7 "
                f"WHEN 0 THEN '<think>核对照片</think>' || {_NL} || "
                "'{\"completed\": true, \"reason\": \"已清洗 ' || event_type || '\"}' "
                "WHEN 1 THEN '结论如下 {\"completed\": \"false\", \"reason\": \"仍有残留\"} 完毕' "
                "WHEN 2 THEN '{\"reason\": \"信息不足\"}' "
                "WHEN 3 THEN '<think>思考</think>处理已完成，无需跟进' "
                "WHEN 4 THEN '现场情况不明' "
                "WHEN 5 THEN '{\"completed\": true}{\"completed\": false}' "
                "ELSE '{\"completed\": false, \"reason\": \"未完成\"}' END")
_EVIDENCE_SQL = f"CASE k % 3 WHEN 0 THEN '已完成清洗' WHEN 1 THEN '等待处理' ELSE '无' END"
_SCENE_RESP_SQL = (f"CASE event_id % 5 WHEN 0 THEN '<think>对比</think>' || {_NL} || '是，图片与场景一致。' "
                   "WHEN 1 THEN '否，图片显示的是道路。' WHEN 2 THEN '不是的，场景不符。' WHEN 3 THEN CASE WHEN event_id % 2 = 0 THEN '' ELSE '  ' || chr(10) END "
                   "ELSE '  结论：是' END")

_BASE_SQL = "base AS (SELECT " + ", ".join(f"{e} AS {n}" for n, e in _BASE_COLS) + " FROM events)"


def _base(spark, d, spread=False):
    """``spread`` deals the events to all tasks first: a file of few row groups
    would have few tasks compose its messages."""
    events = table(spark, d, "events")
    if spread:
        events = events.repartition("event_id", "user_id", "props")
    return events.selectExpr(*[f"{e} AS {n}" for n, e in _BASE_COLS])


def _tickets(spark, d, spread=False):
    """Nested ticket structs built from the composed columns."""
    b = _base(spark, d, spread)
    slots = F.expr("slice(array(" + ", ".join(
        f"named_struct('handleEntity', ent{i}, 'handleResult', res{i}, "
        f"'handleResultImageUrls', array_repeat('http://img.example.com/r.jpg', {i}))" for i in range(3))
        + "), 1, n_res)")
    actions = F.expr("CASE act_kind WHEN 0 THEN NULL WHEN 1 THEN slice(array(named_struct('target', act_target, "
                     "'content', '整改', 'action', 'PUSH_API', 'timeLimit', 60)), 1, 0) ELSE array(named_struct("
                     "'target', act_target, 'content', '整改', 'action', 'PUSH_API', 'timeLimit', 60)) END")
    checklist = F.expr("CASE list_kind WHEN 0 THEN NULL WHEN 1 THEN named_struct('handleItems', "
                       "array(named_struct('item', '复查结果', 'result', review1))) ELSE named_struct('handleItems', "
                       "array(named_struct('item', '备注', 'result', '无'), named_struct('item', '复查结果', "
                       "'result', review2))) END")
    urls = F.expr("slice(array(url0, url1), 1, n_img)")
    ticket = F.struct(
        F.col("eventId"), F.lit("Check").alias("eventType"), F.lit("EventHandlerLookup").alias("processActionCode"),
        F.struct(F.col("sourceEntity"), F.col("event_type").alias("sceneType"), F.col("reportLocation"),
                 F.col("description"), urls.alias("imageUrls")).alias("processDataParams"),
        F.struct(F.col("imageDescription"), F.col("dispatchTarget"), actions.alias("actions")).alias("context"),
        F.struct(F.col("resultTarget").alias("target")).alias("processResultData"),
        slots.alias("resultInfo"), checklist.alias("checklistInfo"))
    check_ticket = ticket.withField("context.dispatchTarget", F.col("checkTarget"))
    return b.select("*", ticket.alias("ticket"), check_ticket.alias("check_ticket"))


# ---------------------------------------------------------------- validation / routing
_MISSING_SQL = ("concat_ws(', ', " + ", ".join(
    f"CASE WHEN {_falsy(c)} THEN '{c}' END" for c in ("description", "reportLocation", "sourceEntity",
                                                       "imageDescription")) + ")")


@register("ticket_validate_dispatch", f"WITH {_BASE_SQL}, m AS (SELECT eventId, {_MISSING_SQL} AS missing FROM base)"
          f" SELECT eventId, missing = '' AS valid, missing AS missing_fields, CASE WHEN missing <> '' THEN "
          f"'{TK.MISSING_FIELDS_PREFIX}' || missing END AS error FROM m")
def ticket_validate_dispatch(spark, d):
    t = _tickets(spark, d)
    miss = TK.dispatch_missing(F.col("ticket"))
    return t.select("eventId", (F.size(miss) == 0).alias("valid"), F.array_join(miss, ", ").alias("missing_fields"),
                    TK.dispatch_error(miss).alias("error"))


_ROUTE_SQL = (f"r0 AS (SELECT eventId, {_strip('dispatchTarget')} AS dts, {_strip('resultTarget')} AS tgs, "
              f"{_strip('coalesce(sourceEntity, ' + chr(39) + chr(39) + ')')} AS src FROM base), "
              f"r1 AS (SELECT eventId, coalesce(length(dts) > 0, false) AS use_dt, {_lane_key('dts')} AS l_dt, "
              f"{_lane_key('tgs')} AS l_tg, {_lane_key('src')} AS l_src FROM r0), "
              "r2 AS (SELECT eventId, use_dt, CASE WHEN use_dt THEN l_dt WHEN l_tg IS NOT NULL THEN l_tg ELSE l_src END "
              "AS lane FROM r1), "
              "route AS (SELECT eventId, lane, CASE WHEN lane IS NOT NULL THEN 'routed' WHEN use_dt THEN 'unroutable' "
              "ELSE 'end' END AS route_status FROM r2)")


@register("ticket_route_dispatch", f"WITH {_BASE_SQL}, {_ROUTE_SQL} SELECT eventId, lane, route_status FROM route")
def ticket_route_dispatch(spark, d):
    r = TK.dispatch_route(F.col("ticket"))
    return _tickets(spark, d).select("eventId", r["lane"].alias("lane"), r["route_status"].alias("route_status"))


@register("ticket_validate_check", f"WITH {_BASE_SQL} SELECT eventId, NOT ({_falsy('description')} OR "
          f"{_falsy('imageDescription')} OR {_falsy('checkTarget')} OR n_res = 0 OR {_falsy('res0')}) AS valid, "
          f"{_lane_key('checkTarget')} AS lane FROM base")
def ticket_validate_check(spark, d):
    t = F.col("check_ticket")
    return _tickets(spark, d).select("eventId", TK.check_valid(t).alias("valid"), TK.check_route(t).alias("lane"))


@register("ticket_route_check", f"WITH {_BASE_SQL}, r AS (SELECT eventId, {_lane_key('checkTarget')} AS lane FROM base)"
          " SELECT eventId, lane, CASE WHEN lane IS NULL THEN 'unroutable' ELSE 'routed' END AS route_status FROM r")
def ticket_route_check(spark, d):
    lane = TK.check_route(F.col("check_ticket"))
    return _tickets(spark, d).select("eventId", lane.alias("lane"),
                                     F.when(lane.isNull(), F.lit("unroutable")).otherwise(F.lit("routed"))
                                     .alias("route_status"))


# ---------------------------------------------------------------- responses
def _after_think_sql(r: str) -> str:
    return _strip(f"string_split({r}, '</think>')[-1]")


def _sections_sql(src: str, keys: str, txt: str) -> str:
    """CTE chain parsing numbered sections of ``txt`` per key (window form)."""
    return f"""
sl AS (SELECT {keys}, unnest(range(1, len(ls) + 1)) AS i, unnest(ls) AS raw FROM (
  SELECT {keys}, regexp_split_to_array({_strip(txt)}, '\\r\\n|\\r|\\n') AS ls FROM {src})),
s2 AS (SELECT {keys}, i, {_strip('raw')} AS ln FROM sl),
s3 AS (SELECT *, CASE WHEN ln = '' THEN NULL
                      WHEN starts_with(ln, '1.') AND contains(ln, '{TK.TARGET_HEADER}') THEN 't'
                      WHEN starts_with(ln, '2.') AND contains(ln, '{TK.REASON_HEADER}') THEN 'r' END AS hdr FROM s2),
s4 AS (SELECT *, last_value(hdr IGNORE NULLS) OVER (PARTITION BY {keys} ORDER BY i
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS sec FROM s3),
sec AS (SELECT {keys},
  coalesce(arg_max({_strip("regexp_extract(ln, '(?s)^[^：]*：(.*)$', 1)")}, i)
           FILTER (WHERE hdr = 't' AND contains(ln, '：')), '') AS target,
  {_strip("coalesce(string_agg(ln, chr(10) ORDER BY i) FILTER (WHERE hdr IS NULL AND ln <> '' AND sec = 'r'), '')")}
    AS reason
  FROM s4 GROUP BY {keys})"""


@register("response_think_split", f"""WITH {_BASE_SQL}, r AS (SELECT eventId, {_answer_sql('event_id')} AS resp FROM base)
SELECT eventId, {_after_think_sql('resp')} AS answer,
  CASE WHEN contains(resp, '</think>') THEN string_split(resp, '</think>')[1] ELSE '' END AS think_prefix,
  {_strip("regexp_extract(resp, '(?s)<think>(.*?)</think>', 1)")} AS think_body,
  {_strip("regexp_replace(resp, '(?s)<think>.*?</think>', '', 'g')")} AS answer_clean FROM r""")
def response_think_split(spark, d):
    r = F.expr(_answer_sql("event_id"))
    b = _base(spark, d).select("eventId", r.alias("resp"))
    return b.select("eventId", TK.answer_after_think("resp").alias("answer"),
                    TK.think_before("resp").alias("think_prefix"), TK.think_block("resp").alias("think_body"),
                    TK.without_think("resp").alias("answer_clean"))


@register("response_sections", f"""WITH {_BASE_SQL},
r AS (SELECT eventId, {_after_think_sql(_answer_sql('event_id'))} AS ans FROM base),
{_sections_sql('r', 'eventId', 'ans')}
SELECT r.eventId, coalesce(sec.target, '') AS target, coalesce(sec.reason, '') AS reason
FROM r LEFT JOIN sec ON sec.eventId = r.eventId""")
def response_sections(spark, d):
    b = _base(spark, d).select("eventId", TK.answer_after_think(F.expr(_answer_sql("event_id"))).alias("ans"))
    s = TK.sections("ans")
    return b.select("eventId", s["target"].alias("target"), s["reason"].alias("reason"))


def _contains_any_sql(x: str, words) -> str:
    return "(" + " OR ".join(f"coalesce(contains({x}, '{w}'), false)" for w in words) + ")"


def _verdict_sql(src: str, keys: str, resp: str, evidence: str, kws, p: str = "v",
                 err: str = "CAST(NULL AS VARCHAR)", quote: bool = False) -> str:
    told = "chr(39) || coalesce(evid, '') || chr(39)" if quote else "''"
    says = lambda d: f"CASE WHEN {d} THEN '{TK.DONE_TEXT}' ELSE '{TK.NOT_DONE_TEXT}' END"
    return f"""
{p}0 AS (SELECT {keys}, {resp} AS resp, {evidence} AS evid, {err} AS err FROM {src}),
{p}1 AS (SELECT *, {_strip("regexp_extract(resp, '(?s)<think>(.*?)</think>', 1)")} AS think,
              {_strip("regexp_replace(resp, '(?s)<think>.*?</think>', '', 'g')")} AS content FROM {p}0),
{p}2 AS (SELECT *, (err IS NOT NULL OR resp IS NULL) AS failed, regexp_extract(content, '(?s)(\\{{.*\\}})', 1) AS js FROM {p}1),
{p}3 AS (SELECT *, js = '' AS no_json,
         CASE WHEN json_valid('[' || js || ']') THEN json_array_length('[' || js || ']') = 1
              AND starts_with({_strip('js')}, '{{') ELSE false END AS ok,
         {_contains_any_sql('resp', TK.DONE_KEYWORDS)} AS kw_done, {_contains_any_sql('evid', kws)} AS ev_done
       FROM {p}2),
{p}4 AS (SELECT *, CASE WHEN ok THEN coalesce(TRY_CAST(json_extract_string(js, '$.completed') AS BOOLEAN), false) END
                   AS j_completed,
                 CASE WHEN ok THEN coalesce(json_extract_string(js, '$.reason'), '{TK.DEFAULT_REASON}') END AS j_reason
       FROM {p}3),
{p}verdict AS (SELECT {keys},
  CASE WHEN failed THEN ev_done WHEN no_json THEN kw_done WHEN ok THEN j_completed ELSE ev_done END AS completed,
  CASE WHEN failed THEN '{TK.CALL_FAIL_PREFIX}' || coalesce(err, '') || '{TK.CALL_FAIL_MIDDLE}' || {says('ev_done')}
       WHEN no_json THEN '{TK.ANALYSIS_PREFIX}' || {says('kw_done')} WHEN ok THEN j_reason
       ELSE '{TK.JSON_FAIL_PREFIX}' || {says('ev_done')} END AS reason,
  CASE WHEN failed THEN '{TK.CALL_FAIL_THINK}' || {told} || '{TK.CALL_FAIL_THINK_END}'
       WHEN no_json THEN CASE WHEN length(think) > 0 THEN think ELSE substr(content, 1, 200) || '...' END
       WHEN ok THEN CASE WHEN length(think) > 0 THEN think ELSE j_reason END
       ELSE '{TK.JSON_FAIL_THINK}' END AS think,
  CASE WHEN failed THEN 'call_failed' WHEN no_json THEN 'no_json' WHEN ok THEN 'json' ELSE 'bad_json' END AS parse_status
FROM {p}4)"""


_CONSTRUCTION_KW = OT.CHECK_LANES["construction_site"][1]


# failed calls: every 13th has no answer and no error, the next one an error
_CALL_SQL = f"CASE WHEN event_id % 13 < 2 THEN NULL ELSE {_VERDICT_SQL} END"
_CALL_ERROR_SQL = "CASE WHEN event_id % 13 = 1 THEN 'TimeoutError: late' END"


@register("response_verdict", f"WITH {_BASE_SQL}, {_verdict_sql('base', 'eventId', _CALL_SQL, _EVIDENCE_SQL, _CONSTRUCTION_KW, 'v', _CALL_ERROR_SQL, True)}"
          " SELECT eventId, completed, reason, think, parse_status FROM vverdict")
def response_verdict(spark, d):
    b = _base(spark, d).select("eventId", F.expr(_CALL_SQL).alias("resp"), F.expr(_CALL_ERROR_SQL).alias("err"),
                               F.expr(_EVIDENCE_SQL).alias("evid"))
    v = TK.verdict("resp", "evid", _CONSTRUCTION_KW, "err", quote_evidence=True)
    return b.select("eventId", *[v[c].alias(c) for c in ("completed", "reason", "think", "parse_status")])


# ---------------------------------------------------------------- scene consistency
def _img_part_sql(i: int) -> str:
    # every 8th ticket's caption list is one shorter than its images
    return (f"CASE WHEN cap{i} IS NOT NULL AND NOT (event_id % 8 = 0 AND n_img = {i + 1}) THEN '[' || substr(split_part(string_split(url{i}, '/')[-1], '?', 1), 1, 12)"
            f" || ': ' || {_strip(f'cap{i}')} || ']' ELSE '[image_{i + 1}: {TK.CAPTION_FAILURE}: ' || "
            f"coalesce(err{i}, '') || ']' END")


@register("scene_consistency", f"""WITH {_BASE_SQL},
s0 AS (SELECT eventId, event_type, {_SCENE_RESP_SQL} AS resp,
              CASE n_img WHEN 0 THEN '' WHEN 1 THEN {_img_part_sql(0)}
                   ELSE {_img_part_sql(0)} || ' ' || {_img_part_sql(1)} END AS image_description FROM base),
s1 AS (SELECT *, (resp IS NULL OR {_strip('resp')} = '') AS empty, substr({_after_think_sql('resp')}, 1, 5) AS head5 FROM s0),
s2 AS (SELECT *, CASE WHEN empty THEN false ELSE coalesce(contains(head5, '是'), false) END AS is_consistent,
              CASE WHEN empty THEN false ELSE coalesce(contains(head5, '不是'), false) END AS negated,
              contains(' ' || image_description, ' {TK.CAPTION_FAILURE}') OR empty AS has_error,
              CASE WHEN empty THEN '{OT.SCENE_EMPTY_REASON}' ELSE resp END AS reason FROM s1)
SELECT eventId, image_description, is_consistent, negated, has_error,
  CASE WHEN has_error THEN '1' ELSE '0' END AS result_code,
  CASE WHEN is_consistent THEN '{OT.SCENE_OK_MSG}' ELSE '{OT.SCENE_BAD_MSG}' END AS result_msg,
  '<div class="scene"><h4>' || coalesce(event_type, '') || ' · ' || CASE WHEN is_consistent THEN 'match' ELSE 'mismatch' END
  || '</h4><figure>' || image_description || '</figure><blockquote>' || reason || '</blockquote></div>' AS hint_html
FROM s2""")
def scene_consistency(spark, d):
    return OT.scene_consistency(_scenes(spark, d)).select(
        "eventId", "image_description", "is_consistent", "negated", "has_error", "result_code", "result_msg", "hint_html")


def _scenes(spark, d):
    return _tickets(spark, d).select(
        "eventId", "ticket",
        F.expr("slice(array(cap0, cap1), 1, CASE WHEN event_id % 8 = 0 THEN greatest(n_img - 1, 0) ELSE n_img END)")
        .alias("captions"),
        F.expr("slice(array(err0, err1), 1, n_img)").alias("caption_errors"), F.expr(_SCENE_RESP_SQL).alias("response"))


@register("scene_result_ticket", f"""SELECT eventId, 'EventHandlerLookup' AS action_code, result_code, result_msg,
  hint_html AS detected, image_description, is_consistent FROM ({ORACLE["scene_consistency"]})""")
def scene_result_ticket(spark, d):
    """Result tickets of the scene check, their fields read back from JSON."""
    res = OT.scene_result_tickets(OT.scene_consistency(_scenes(spark, d)))
    v = F.parse_json(F.to_json(F.struct(*res.columns)))
    paths = {"eventId": "eventId", "action_code": "processActionCode", "result_code": "processResultCode",
             "result_msg": "processResultMsg", "detected": "processResultData.detectedEventType",
             "image_description": "processResultData.imageDescription"}
    return res.select(v.alias("v")).select(
        *[F.variant_get("v", f"$.{p}", "string").alias(c) for c, p in paths.items()],
        F.variant_get("v", "$.processResultData.isConsistency", "boolean").alias("is_consistent"))


# ---------------------------------------------------------------- dispatch actions
def _lanes_values_sql() -> str:
    rows = []
    for lane, acts in OT.DISPATCH_LANES.items():
        for i, (tg, ac, tl, th, sx) in enumerate(acts):
            tl_sql = "CAST(NULL AS INTEGER)" if tl is None else f"CAST({tl} AS INTEGER)"
            rows.append(f"('{lane}', CAST({i} AS INTEGER), '{tg}', '{ac}', {tl_sql}, {str(th).lower()}, '{sx}')")
    return "lanes AS (SELECT * FROM (VALUES " + ", ".join(rows) + \
        ") t(lane, action_pos, target, action, time_limit, keep_think, suffix))"


_NAMED_SQL = ", ".join(f"'{x}'" for x in sorted(OT.NAMED_TARGET_LANES))
_PROMPT_SQL = (f"concat_ws(chr(10), 'Rules: ', 'A report' || CASE WHEN {_falsy('rq.reportLocation')} THEN '' "
               "ELSE ' from ' || rq.reportLocation END || "
               f"CASE WHEN {_falsy('rq.sourceEntity')} THEN '' ELSE ' by ' || rq.sourceEntity END || ' says: ' || "
               "coalesce(rq.description, '') || ' | photo: ' || coalesce(rq.imageDescription, ''), "
               "'Answer in Chinese under these two headers and nothing else:', "
               f"'1. 责任主体：' || CASE WHEN rq.lane IN ({_NAMED_SQL}) THEN rq.target ELSE '?' END, '2. 决策理由：')")


@register("ticket_dispatch_actions", f"""WITH {_BASE_SQL}, {_ROUTE_SQL}, {_lanes_values_sql()},
dv AS (SELECT b.*, {_MISSING_SQL} AS missing, route.lane AS rlane, route.route_status
       FROM base b JOIN route ON route.eventId = b.eventId),
req AS (SELECT dv.*, dv.rlane AS lane_key, l.action_pos, l.target, l.action, l.time_limit, l.keep_think, l.suffix
        FROM dv LEFT JOIN lanes l ON dv.missing = '' AND dv.route_status = 'routed' AND l.lane = dv.rlane),
rq AS (SELECT *, rlane AS lane, CASE WHEN action_pos IS NOT NULL THEN {_answer_sql('event_id + action_pos')} END AS resp
       FROM req),
ans AS (SELECT eventId, action_pos, {_after_think_sql('resp')} AS ans FROM rq WHERE action_pos IS NOT NULL),
{_sections_sql('ans', 'eventId, action_pos', 'ans')}
SELECT rq.eventId, rq.lane, rq.route_status,
  CASE WHEN rq.missing <> '' THEN '{TK.MISSING_FIELDS_PREFIX}' || rq.missing END AS error,
  rq.action_pos, rq.target, rq.action, rq.time_limit,
  CASE WHEN rq.action_pos IS NOT NULL THEN coalesce(rq.description, '') || chr(10) || coalesce(rq.imageDescription, '')
       || rq.suffix END AS query,
  CASE WHEN rq.action_pos IS NOT NULL THEN {_PROMPT_SQL} END AS prompt,
  sec.reason AS content,
  CASE WHEN rq.keep_think THEN CASE WHEN contains(rq.resp, '</think>') THEN string_split(rq.resp, '</think>')[1]
       ELSE '' END END AS think,
  CASE WHEN rq.lane IN ({_NAMED_SQL}) AND rq.action_pos IS NOT NULL THEN '- ' || coalesce(rq.target, '') || '：'
       || substr(coalesce(sec.reason, ''), 1, 100) || '...' || CASE WHEN coalesce(rq.time_limit, 0) <> 0
       THEN '，' || CAST(rq.time_limit AS VARCHAR) || '分钟内完成' ELSE '' END END AS summary_line
FROM rq LEFT JOIN sec ON sec.eventId = rq.eventId AND sec.action_pos = rq.action_pos""")
def ticket_dispatch_actions(spark, d):
    req = OT.dispatch_requests(_tickets(spark, d).drop("check_ticket"))
    req = req.withColumn("response", F.when(F.col("action_pos").isNotNull(),
                                            F.expr(_answer_sql("event_id + action_pos"))))
    p = F.col("ticket.processDataParams")
    named = F.col("lane").isin(*OT.NAMED_TARGET_LANES)
    prompt = OT.dispatch_prompt(p["description"], F.col("ticket.context.imageDescription"), p["reportLocation"],
                                p["sourceEntity"], F.lit(""), F.when(named, F.col("target")))
    out = OT.dispatch_actions(req).withColumn("prompt", F.when(F.col("action_pos").isNotNull(), prompt))
    return out.select("eventId", "lane", "route_status", "error", "action_pos", "target", "action", "time_limit",
                      "query", "prompt", "content", "think", "summary_line")


# ---------------------------------------------------------------- dispatch with rules
_DIM, _TOP = 32, 10


def _stand_in_model():
    """A deterministic stand-in for a text model: it fails on every prompt
    whose md5 starts with 0."""
    import hashlib

    def answer(prompts: list[str]) -> list[str]:
        marks = [hashlib.md5(p.encode()).hexdigest() for p in prompts]
        if any(m[0] == "0" for m in marks):
            raise TimeoutError("late")
        return [f"<think>{m[:6]}</think>\n1. 责任主体：甲\n2. 决策理由：\n依据 {m}" for m in marks]

    return answer


_RULES_SQL = ("rules AS (SELECT item_id * 1000 + p AS id, CASE WHEN item_id % 10 = 0 THEN '' ELSE 'rule-' || (item_id % 9) END "
              "AS source, substr(text, CAST(p * 100 + 1 AS BIGINT), 120) AS text FROM (SELECT item_id, text, unnest(generate_series(0, "
              "CASE WHEN length(text) <= 120 THEN 0 ELSE CAST(ceil((length(text) - 120) / 100.0) AS BIGINT) END)) AS p FROM benchmark))")
_CONTEXT_PROMPT_SQL = _PROMPT_SQL.replace("'Rules: '", "'Rules: ' || coalesce(cx.context, '')", 1)


@register("ticket_dispatch_context", f"""WITH {_BASE_SQL}, {_ROUTE_SQL}, {_lanes_values_sql()}, {_RULES_SQL},
dv AS (SELECT b.*, {_MISSING_SQL} AS missing, route.lane, route.route_status
       FROM base b JOIN route ON route.eventId = b.eventId),
rq AS (SELECT dv.*, l.action_pos, l.target, l.keep_think,
              coalesce(description, '') || chr(10) || coalesce(imageDescription, '') || l.suffix AS query
       FROM dv JOIN lanes l ON dv.missing = '' AND dv.route_status = 'routed' AND l.lane = dv.lane),
qs AS (SELECT DISTINCT query FROM rq),
{token_vector_ctes('qv', 'qs', 'query', 'query', _DIM)}, {token_vector_ctes('rv', 'rules', 'id, source, text', 'text', _DIM)},
far AS (SELECT query, id, source, text, list_sum([(a.v[i] - b.v[i]) ** 2 FOR i IN range(1, {_DIM + 1})]) AS dist
        FROM qv a, rv b),
top AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY dist, id) AS rank FROM far QUALIFY rank <= {_TOP}),
cx AS (SELECT query, string_agg(text, chr(10) ORDER BY rank) AS context,
              coalesce(string_agg(DISTINCT source, ',' ORDER BY source) FILTER (WHERE source <> ''), '') AS citations
       FROM top GROUP BY query),
asked AS (SELECT rq.*, cx.citations, {_CONTEXT_PROMPT_SQL} AS prompt FROM rq JOIN cx ON cx.query = rq.query),
told AS (SELECT *, md5(prompt) AS mark, substr(md5(prompt), 1, 1) = '0' AS late FROM asked),
acts AS (SELECT eventId, string_agg(md5(prompt), '|' ORDER BY action_pos) AS prompts,
                string_agg(CASE WHEN late THEN 'TimeoutError: late' ELSE '' END, '|' ORDER BY action_pos) AS errors,
                string_agg(CASE WHEN late THEN '' ELSE '依据 ' || mark END, '|' ORDER BY action_pos) AS contents,
                string_agg(citations, '|' ORDER BY action_pos) FILTER (WHERE keep_think) AS cited,
                string_agg(CASE WHEN late THEN '' ELSE '<think>' || substr(mark, 1, 6) END, '|' ORDER BY action_pos)
                  FILTER (WHERE keep_think) AS thinks
         FROM told GROUP BY eventId)
SELECT dv.eventId, CASE WHEN dv.missing <> '' OR dv.route_status <> 'routed' THEN 1 WHEN dv.lane IN ({_NAMED_SQL}) THEN 0 END
         AS result_code, coalesce(prompts, '') AS prompts, coalesce(errors, '') AS errors,
       CASE WHEN dv.lane NOT IN ({_NAMED_SQL}) THEN contents END AS content,
       CASE WHEN dv.lane IN ({_NAMED_SQL}) THEN contents END AS contents,
       CASE WHEN dv.lane IN ({_NAMED_SQL}) THEN cited END AS citations,
       CASE WHEN dv.lane IN ({_NAMED_SQL}) THEN thinks END AS thinks
FROM dv LEFT JOIN acts ON acts.eventId = dv.eventId""")
def ticket_dispatch_context(spark, d):
    """Dispatch from ticket to result ticket: rules from a stored index for
    each lane action, prompts with them, model answers (by a stand-in model,
    each distinct prompt asked once), citations on the actions."""
    items = table(spark, d, "benchmark").select("item_id", "text")
    chunks = R.fixed_chunks(items, size=120, overlap=20, keep=("item_id",)).select(
        (F.col("item_id") * 1000 + F.col("pos")).alias("id"), F.col("chunk").alias("text"),
        F.when(F.col("item_id") % 10 == 0, "").otherwise(F.concat(F.lit("rule-"), F.col("item_id") % 9)).alias("source"))

    def embed(df, text_col):
        return R.token_hash_embed(df, text_col, _DIM, normalize=False)

    index, answers = shared_dir(spark, "rules"), shared_dir(spark, "answers")
    VI.build_index(embed(chunks, "text"), index, block_rows=256)
    t = _tickets(spark, d).select("eventId", "ticket")
    asked = OT.dispatch_prompts(OT.dispatch_contexts(t, index, embed, _TOP), contexts_col="contexts")
    marks = F.array_join(F.transform("prompts", lambda p: F.md5(p.cast("binary"))), "|")
    asked = asked.withColumns({"contexts": OT.citations_only("contexts"), "marks": marks})
    told = MA.ask_list_once(asked, _stand_in_model, answers)
    told = told.withColumn("responses", F.transform("answers", lambda a: a["response"]))
    kept = [F.col("marks").alias("prompts"),
            F.array_join(F.transform("answers", lambda a: F.coalesce(a["error"], F.lit(""))), "|").alias("errors")]
    res = OT.dispatch_result_tickets(told, contexts_col="contexts", keep=kept)
    r = F.col("processResultData")

    def joined(c):
        return F.when(r["actions"].isNotNull(), F.array_join(F.transform(r["actions"], lambda a: F.coalesce(c(a), F.lit(""))), "|"))

    return res.select("eventId", F.col("processResultCode").alias("result_code"), "prompts", "errors", r["content"].alias("content"),
                      joined(lambda a: a["content"]).alias("contents"),
                      joined(lambda a: F.array_join(a["citations"], ",")).alias("citations"),
                      joined(lambda a: a["think"]).alias("thinks"))


# ---------------------------------------------------------------- completion check
_CS_KW, _CH_KW = OT.CHECK_LANES["construction_site"][1], OT.CHECK_LANES["city_housekeeper"][1]
_MERGED_SQL = "concat_ws(' ', " + ", ".join(
    f"CASE WHEN n_res >= {i + 1} AND res{i} <> '' THEN '[' || ent{i} || ': ' || res{i} || ']' END" for i in range(3)) + ")"


def _next_sql(v: str, lane: str) -> str:
    _, _, done_t, default_t = OT.CHECK_LANES[lane]
    return (f"CASE WHEN {v}.completed AND has_results THEN '{done_t}' WHEN has_results THEN CASE WHEN orig <> '' "
            f"THEN orig ELSE '{default_t}' END WHEN acts_given THEN orig ELSE '{default_t}' END")


_NO_TARGET = "|||"


def _next_actions_sql(v: str, lane: str) -> str:
    _, _, done_t, default_t = OT.CHECK_LANES[lane]
    return (f"CASE WHEN {v}.completed AND has_results THEN '{done_t}||PUSH_API|' WHEN has_results THEN CASE WHEN orig_s <> '' "
            f"THEN orig_s ELSE '{default_t}{_NO_TARGET}' END WHEN acts_given THEN orig_s ELSE '{default_t}{_NO_TARGET}' END")


_CHECK_SQL = f"""WITH {_BASE_SQL},
c1 AS (SELECT eventId, {_lane_key('checkTarget')} AS lane, n_res > 0 AS has_results,
         CASE WHEN n_res >= 1 THEN res0 ELSE '' END AS first_res, {_MERGED_SQL} AS merged,
         CASE act_kind WHEN 2 THEN act_target ELSE '' END AS orig, n_res, act_kind, act_target,
         CASE act_kind WHEN 2 THEN act_target || '|整改|PUSH_API|60' ELSE '' END AS orig_s, act_kind <> 0 AS acts_given,
         list_kind <> 0 AS has_list,
         list_kind <> 0 AND (CASE list_kind WHEN 1 THEN review1 ELSE review2 END) = '已完成' AS sub_done,
         NOT ({_falsy('description')} OR {_falsy('imageDescription')} OR {_falsy('checkTarget')} OR n_res = 0
              OR {_falsy('res0')}) AS valid,
         {_VERDICT_SQL} AS resp FROM base),
{_verdict_sql('c1', 'eventId', 'resp', 'first_res', _CS_KW, 'a')},
{_verdict_sql('c1', 'eventId', 'resp', 'merged', _CH_KW, 'b')},
j AS (SELECT c1.*, a.completed AS a_completed, a.reason AS a_reason, a.think AS a_think,
             b.completed AS b_completed, b.reason AS b_reason, b.think AS b_think,
             {_next_sql('a', 'construction_site')} AS a_next, {_next_sql('b', 'city_housekeeper')} AS b_next,
             {_next_actions_sql('a', 'construction_site')} AS a_acts, {_next_actions_sql('b', 'city_housekeeper')} AS b_acts
      FROM c1 JOIN averdict a ON a.eventId = c1.eventId JOIN bverdict b ON b.eventId = c1.eventId),
s AS (SELECT *, CASE WHEN lane IS NULL THEN 'unroutable' WHEN lane IN ('construction_site', 'city_housekeeper')
                     THEN 'checked' WHEN lane = 'subdistrict_office' THEN CASE WHEN sub_done THEN 'closed'
                     WHEN has_list THEN 'redispatch' ELSE 'pending' END WHEN valid THEN 'pass' ELSE 'invalid' END
                AS status FROM j)
SELECT eventId, lane, status, n_res, act_kind, act_target,
  coalesce(CASE lane WHEN 'construction_site' THEN a_acts WHEN 'city_housekeeper' THEN b_acts
            WHEN 'subdistrict_office' THEN CASE WHEN sub_done THEN '' WHEN has_list THEN orig_s ELSE '' END END, '')
    AS next_actions,
  CASE lane WHEN 'construction_site' THEN CASE WHEN has_results THEN a_completed ELSE false END
            WHEN 'city_housekeeper' THEN CASE WHEN has_results THEN b_completed ELSE false END
            WHEN 'subdistrict_office' THEN sub_done END AS completed,
  status = 'closed' AS closed,
  CASE lane WHEN 'construction_site' THEN CASE WHEN has_results THEN a_reason ELSE '{OT.NO_RESULTS_REASON}' END
            WHEN 'city_housekeeper' THEN CASE WHEN has_results THEN b_reason ELSE '{OT.NO_RESULTS_REASON}' END
            WHEN 'subdistrict_office' THEN CASE WHEN sub_done THEN '{OT.CLOSED_REASON}' WHEN has_list THEN NULL
                                               ELSE '{OT.NO_CHECKLIST_REASON}' END END AS reason,
  CASE lane WHEN 'construction_site' THEN CASE WHEN has_results THEN a_think ELSE '{OT.NO_RESULTS_THINK}' END
            WHEN 'city_housekeeper' THEN CASE WHEN has_results THEN b_think ELSE '{OT.NO_RESULTS_THINK}' END
            END AS think,
  coalesce(CASE lane WHEN 'construction_site' THEN a_next WHEN 'city_housekeeper' THEN b_next
            WHEN 'subdistrict_office' THEN CASE WHEN sub_done THEN '' WHEN has_list THEN orig ELSE '' END END, '')
    AS next_targets,
  CASE lane WHEN 'construction_site' THEN CASE WHEN has_results THEN first_res ELSE '' END
            WHEN 'city_housekeeper' THEN CASE WHEN has_results THEN merged ELSE '' END END AS evidence,
  CASE WHEN status = 'invalid' THEN 1 WHEN status IN ('pass', 'unroutable') THEN NULL ELSE 0 END AS result_code
FROM s"""


def _checked(spark, d):
    shown = [F.array(*[F.lit(x).cast("string") for x in xs]) for xs in (("清洁", None, "路面"), (None, "late", None))]
    t = _tickets(spark, d).select("eventId", F.col("check_ticket").alias("ticket"), F.expr(_VERDICT_SQL).alias("response"),
                                  shown[0].alias("result_captions"), shown[1].alias("result_caption_errors"))
    return OT.check_results(t)


@register("ticket_check_result", "SELECT eventId, lane, status, completed, closed, reason, think, next_targets, evidence, "
          f"result_code FROM ({_CHECK_SQL})")
def ticket_check_result(spark, d):
    out = _checked(spark, d)
    return out.select("eventId", "lane", "status", "completed", "closed", "reason", "think",
                      F.array_join("next_targets", ",").alias("next_targets"), "evidence", "result_code")


_SHOWN_SQL = ("CASE n_res WHEN 2 THEN '[r.jpg: 清洁]' WHEN 3 THEN '[r.jpg: 清洁] [image_2: " + TK.CAPTION_FAILURE
              + ": late] [r.jpg: 路面]' ELSE '' END")
_LANE_TARGET_SQL = "CASE lane WHEN 'construction_site' THEN '工地企业' WHEN 'city_housekeeper' THEN '城市管家' END"


@register("ticket_check_ticket", f"""SELECT eventId, result_code, 'CheckHandleResult' AS action_code,
  CASE WHEN status <> 'pass' THEN completed END AS completed, CASE WHEN status <> 'pass' AND closed THEN true END AS closed,
  CASE WHEN status <> 'pass' THEN reason END AS reason, CASE WHEN status <> 'pass' THEN think END AS think,
  CASE lane WHEN 'construction_site' THEN '' WHEN 'city_housekeeper' THEN {_SHOWN_SQL} END AS image_text,
  CASE WHEN status <> 'pass' THEN next_actions END AS actions,
  CASE status WHEN 'unroutable' THEN 'no lane for the dispatch target' WHEN 'invalid' THEN 'ticket lacks required fields' END
    AS error,
  CASE WHEN {_LANE_TARGET_SQL} IS NULL THEN NULL WHEN act_kind = 2 AND act_target = {_LANE_TARGET_SQL} THEN '整改' ELSE '' END
    AS required
FROM ({_CHECK_SQL})""")
def ticket_check_ticket(spark, d):
    """Result tickets of the completion check: verdict, captions of the result
    images and the full follow-up actions."""
    r = F.col("processResultData")
    acts = F.array_join(F.transform(r["actions"], lambda a: F.concat_ws(
        "|", *[F.coalesce(a[c].cast("string"), F.lit("")) for c in ("target", "content", "action", "timeLimit")])), ";")
    return OT.check_result_tickets(_checked(spark, d), keep=[F.col("required_content").alias("required")]).select(
        "eventId", F.col("processResultCode").alias("result_code"), F.col("processActionCode").alias("action_code"),
        r["completed"].alias("completed"), r["closed"].alias("closed"), r["reason"].alias("reason"), r["think"].alias("think"),
        r["handleResultImageDescription"].alias("image_text"), acts.alias("actions"), r["error"].alias("error"),
        "required")


# ---------------------------------------------------------------- message stream
def _messages(spark, d):
    """JSON lines, every 50th with a second object glued to it."""
    raw = TS.to_json_text(F.col("ticket").withField("processActionCode", F.lit("Intake")))
    return _tickets(spark, d, spread=True).select(
        F.when(F.col("event_id") % 50 == 0, F.concat(raw, F.lit('{"x": 1}'))).otherwise(raw).alias("value"))


@register("ticket_stream", f"""WITH {_BASE_SQL}, {_ROUTE_SQL}, m AS (SELECT eventId, {_MISSING_SQL} AS missing FROM base
  WHERE event_id % 50 <> 0)
SELECT m.eventId, 'EventHandlerLookup' AS processActionCode, m.missing = '' AS valid,
  CASE WHEN m.missing <> '' THEN '{TK.MISSING_FIELDS_PREFIX}' || m.missing END AS error, route.lane, route.route_status
FROM m JOIN route ON route.eventId = m.eventId""")
def ticket_stream(spark, d):
    """Tickets written as JSON-line messages (every 50th line corrupted by a
    glued second object, which the strict parser must reject), drained by a
    Structured Streaming run, read back from its Parquet sink."""
    from ..streaming.tickets import read_outcomes, run_dispatch

    root = shared_dir(spark, "ticket-stream")
    _messages(spark, d).write.mode("overwrite").text(root + "/in")
    run_dispatch(spark, root + "/in", root + "/out", root + "/ckpt")
    return read_outcomes(spark, root + "/out").drop("payload")


@register("ticket_intake", f"""WITH {_BASE_SQL} SELECT eventId, 'EventHandlerLookup' AS code, k AS n, 'v' || user_id AS deep,
  CASE WHEN event_id % 2 = 0 THEN 'old' END AS old, 3 + CAST(event_id % 2 = 0 AS INTEGER) AS keys FROM base WHERE event_id % 50 <> 0""")
def ticket_intake(spark, d):
    """Messages with keys that the ticket schema does not know, nested ones
    too, through the intake: the payload that goes on holds them all."""
    from ..streaming.tickets import read_outcomes, run_dispatch

    root = shared_dir(spark, "ticket-intake")
    extra = F.struct(F.col("k").alias("n"), F.array(F.struct(F.concat(F.lit("v"), F.col("user_id")).alias("deep"))).alias("list"))
    old = F.when(F.col("event_id") % 2 == 0, "old")
    line = F.to_json(F.struct("eventId", old.alias("processActionCode"), old.alias("note"), extra.alias("vendorData")))
    glued = F.when(F.col("event_id") % 50 == 0, F.concat(line, F.lit("{}"))).otherwise(line)
    _base(spark, d, spread=True).select(glued.alias("value")).write.mode("overwrite").text(root + "/in")
    run_dispatch(spark, root + "/in", root + "/out", root + "/ckpt")
    v = F.parse_json("payload")
    return read_outcomes(spark, root + "/out").select(
        "eventId", F.variant_get(v, "$.processActionCode", "string").alias("code"), F.variant_get(v, "$.vendorData.n", "int").alias("n"),
        F.variant_get(v, "$.vendorData.list[0].deep", "string").alias("deep"), F.variant_get(v, "$.note", "string").alias("old"),
        F.size(F.json_object_keys("payload")).alias("keys"))


def _plain_model():
    """A stand-in model that answers by the kind of question alone."""
    def answer(prompts: list[str]) -> list[str]:
        return ["是，一致" if "Do they agree?" in p else '{"completed": true, "reason": "好"}' if "Reply with one JSON" in p
                else "1. 责任主体：甲\n2. 决策理由：\n依据" for p in prompts]

    return answer


def _shown_sql(i: int) -> str:
    return (f"CASE WHEN cap{i} IS NOT NULL THEN '[' || substr(split_part(string_split(url{i}, '/')[-1], '?', 1), 1, 12) || ': ' || "
            f"{_strip(f'cap{i}')} || ']' ELSE '[image_{i + 1}: {TK.CAPTION_FAILURE}: ' || coalesce(err{i}, '') || ']' END")


_FLOW_SQL = "CASE WHEN event_id % 50 = 0 OR event_id % 47 = 1 THEN 3 ELSE event_id % 3 END"


@register("stream_results", f"""WITH {_BASE_SQL}, {_ROUTE_SQL}, {_lanes_values_sql()},
flow AS (SELECT eventId, CAST(k AS VARCHAR) AS vendor, {_FLOW_SQL} AS f FROM base),
d0 AS (SELECT b.eventId, {_MISSING_SQL} AS missing, route.lane, route.route_status,
              (SELECT count(*) FROM lanes l WHERE l.lane = route.lane) AS n FROM base b JOIN route ON route.eventId = b.eventId),
dispatched AS (SELECT eventId, CASE WHEN missing <> '' OR route_status <> 'routed' THEN '1' WHEN lane IN ({_NAMED_SQL}) THEN '0' END
                 AS code, CASE WHEN missing <> '' THEN '{TK.MISSING_FIELDS_PREFIX}' || missing
                               WHEN route_status <> 'routed' THEN 'no lane: ' || route_status
                               ELSE array_to_string(list_resize(CAST([] AS VARCHAR[]), n, '依据'), '|') END AS said FROM d0),
checked AS (SELECT eventId, status, CAST(result_code AS VARCHAR) AS code,
                   CASE status WHEN 'unroutable' THEN 'no lane for the dispatch target' WHEN 'invalid' THEN 'ticket lacks required fields'
                   ELSE CAST(completed AS VARCHAR) || ':' || coalesce(reason, '') END AS said
            FROM ({{check_sql}})),
s0 AS (SELECT eventId, CASE n_img WHEN 0 THEN '' WHEN 1 THEN {_shown_sql(0)} ELSE {_shown_sql(0)} || ' ' || {_shown_sql(1)} END
         AS shown FROM base),
scenes AS (SELECT eventId, CASE WHEN contains(' ' || shown, ' {TK.CAPTION_FAILURE}') THEN '1' ELSE '0' END AS code,
                  shown || ':true' AS said FROM s0)
SELECT 'results' AS sink, x.eventId, code, said FROM dispatched x JOIN flow ON flow.eventId = x.eventId AND f = 0
UNION ALL SELECT CASE status WHEN 'pass' THEN 'forwards' ELSE 'results' END, x.eventId, CASE WHEN status <> 'pass' THEN code END,
  CASE status WHEN 'pass' THEN vendor ELSE said END FROM checked x JOIN flow ON flow.eventId = x.eventId AND f = 1
UNION ALL SELECT 'results', x.eventId, code, said FROM scenes x JOIN flow ON flow.eventId = x.eventId AND f = 2
UNION ALL SELECT 'rejects', eventId, NULL, NULL FROM flow WHERE f = 3""".replace("{check_sql}", _CHECK_SQL.replace(
    _VERDICT_SQL, """'{"completed": true, "reason": "好"}'""")))
def stream_results(spark, d):
    """Messages of all three flows drained by one streaming run into its
    three sinks; lines without one JSON object and unknown codes are rejects."""
    from ..streaming.tickets import read_flow, run_flows

    root = shared_dir(spark, "flows")
    items = table(spark, d, "benchmark").select("item_id", "text")

    def embed(df, text_col):
        return R.token_hash_embed(df, text_col, _DIM, normalize=False)

    VI.build_index(embed(items.select(F.col("item_id").alias("id"), "text", F.lit("rules").alias("source")), "text"), root + "/rules")
    b = _tickets(spark, d, spread=True)
    seen = [_base(spark, d).select(F.col(f"url{i}").alias("url"), F.col(f"cap{i}").alias("caption"), F.col(f"err{i}").alias("error")) for i in range(2)]
    once = spark.range(1).select(F.lit("http://img.example.com/r.jpg").alias("url"), F.lit("路面").alias("caption"),
                                 F.lit(None).cast("string").alias("error"))
    captions = seen[0].unionByName(seen[1]).unionByName(once)
    code = F.when(F.col("event_id") % 47 == 1, "Other").otherwise(F.element_at(F.array(*[F.lit(c) for c in (
        FL.DISPATCH, FL.CHECK, FL.SCENE)]), (F.col("event_id") % 3 + 1).cast("int")))
    ticket = F.when(F.col("event_id") % 3 == 1, F.col("check_ticket")).otherwise(F.col("ticket"))
    line = F.to_json(ticket.withField("processActionCode", code).withField("vendor", F.col("k").cast("string")))
    b.select(F.when(F.col("event_id") % 50 == 0, F.concat(line, F.lit("{}"))).otherwise(line).alias("value")).write.option(
        "compression", "gzip").option("maxRecordsPerFile", 100_000).text(root + "/in")
    run_flows(spark, root + "/in", root + "/out", root + "/ckpt",
              FL.Tools(root + "/rules", embed, captions, _plain_model, root + "/answers", k=3))
    v = F.parse_json("value")

    def text(path: str):
        return F.variant_get(v, "$." + path, "string")

    acts = F.variant_get(v, "$.processResultData.actions", "array<struct<content:string>>")
    said = (F.when(text("processActionCode") == FL.SCENE, F.concat(text("processResultData.imageDescription"), F.lit(":"),
                                                                    text("processResultData.isConsistency")))
            .when(text("processActionCode") == FL.CHECK, F.coalesce(text("processResultData.error"), F.concat(
                text("processResultData.completed"), F.lit(":"), F.coalesce(text("processResultData.reason"), F.lit("")))))
            .otherwise(F.coalesce(text("processResultData.error"), text("processResultData.content"),
                                  F.array_join(F.transform(acts, lambda a: a["content"]), "|"))))
    none = F.lit(None).cast("string")
    results = read_flow(spark, root + "/out", "results").select(
        F.lit("results").alias("sink"), text("eventId").alias("eventId"), text("processResultCode").alias("code"), said.alias("said"))
    forwards = read_flow(spark, root + "/out", "forwards").select(
        F.lit("forwards").alias("sink"), text("eventId").alias("eventId"), none.alias("code"), text("vendor").alias("said"))
    rejects = read_flow(spark, root + "/out", "rejects").select(
        F.lit("rejects").alias("sink"), F.regexp_extract("value", '"eventId":"([^"]*)"', 1).alias("eventId"), none.alias("code"),
        none.alias("said"))
    return results.unionByName(forwards).unionByName(rejects)


_ASK_SQL = ("concat_ws(chr(10), 'Has ' || {target} || ' finished the work below?', 'Work: ' || {required}, 'Reported: ' || "
            "coalesce(description, ''), 'Photo then: ' || coalesce(imageDescription, ''), 'Done: ' || {evidence}, 'Photo now: ' || {shown}, "
            "'Reply with one JSON object: {{\"completed\": true or false, \"reason\": \"why\"}}')")


def _ask_sql(target: str, evidence: str, shown: str) -> str:
    return _ASK_SQL.format(target=f"'{target}'", required=f"CASE WHEN act_kind = 2 AND act_target = '{target}' THEN '整改' ELSE '' END",
                           evidence=evidence, shown=shown)


@register("ticket_prompts", f"""WITH {_BASE_SQL}, p AS (SELECT *, {_lane_key('checkTarget')} AS lane FROM base)
SELECT eventId, CASE WHEN n_res = 0 THEN NULL WHEN lane = 'construction_site' THEN {_ask_sql('工地企业', 'res0', "''")}
  WHEN lane = 'city_housekeeper' THEN {_ask_sql('城市管家', _MERGED_SQL, _SHOWN_SQL)} END AS check_prompt,
  'Photos: ' || CASE n_img WHEN 0 THEN '' WHEN 1 THEN {_shown_sql(0)} ELSE {_shown_sql(0)} || ' ' || {_shown_sql(1)} END || chr(10)
  || 'Reported scene: ' || coalesce(event_type, '') || chr(10) || 'Do they agree? Begin with 是 or 否, then one reason.' AS scene_prompt,
  'Sum up these orders in two sentences:' || chr(10) || CASE WHEN act_kind = 2 THEN '- ' || coalesce(act_target, '')
  || '：整改...，60分钟内完成' ELSE '' END AS summary_prompt FROM p""")
def ticket_prompts(spark, d):
    """Questions to the model: completion check, scene, summary of orders."""
    shown = [F.array(*[F.lit(x).cast("string") for x in xs]) for xs in (("清洁", None, "路面"), (None, "late", None))]
    t = _tickets(spark, d).select("eventId", F.col("check_ticket").alias("ticket"), shown[0].alias("result_captions"),
                                  shown[1].alias("result_caption_errors"), F.array("cap0", "cap1").alias("captions"),
                                  F.array("err0", "err1").alias("caption_errors"))
    asked = OT.scene_prompts(OT.check_prompts(t, out_col="check"), out_col="scene")
    lines = F.coalesce(F.transform("ticket.context.actions", lambda a: TK.summary_line(a["target"], a["content"], a["timeLimit"])),
                       F.array().cast("array<string>"))
    return asked.select("eventId", F.try_element_at("check", F.lit(1)).alias("check_prompt"),
                        F.try_element_at("scene", F.lit(1)).alias("scene_prompt"), OT.summary_prompt(lines).alias("summary_prompt"))


@register("ticket_file_source", f"""WITH {_BASE_SQL} SELECT CASE WHEN event_id % 50 <> 0 THEN 'EV-' || CAST(event_id AS VARCHAR)
END AS eventId, event_id % 50 <> 0 AS accepted, CASE WHEN event_id % 50 <> 0 THEN event_type END AS scene FROM base""")
def ticket_file_source(spark, d):
    """Tickets written as JSON lines and read by the batch source; a glued
    line is a row without a ticket."""
    root = shared_dir(spark, "ticket-file")
    _messages(spark, d).write.mode("overwrite").text(root + "/in")
    return TS.read_tickets(spark, root + "/in").select(
        "eventId", F.col("ticket").isNotNull().alias("accepted"), F.col("ticket.processDataParams.sceneType").alias("scene"))


@register("ticket_stream_rejects", f"""WITH {_BASE_SQL} SELECT 'EV-' || CAST(event_id AS VARCHAR) AS eventId, true AS glued
FROM base WHERE event_id % 50 = 0""")
def ticket_stream_rejects(spark, d):
    """The raw lines that the stream did not accept."""
    from ..streaming.tickets import read_rejects, run_dispatch

    root = shared_dir(spark, "ticket-rejects")
    _messages(spark, d).write.mode("overwrite").text(root + "/in")
    run_dispatch(spark, root + "/in", root + "/out", root + "/ckpt")
    return read_rejects(spark, root + "/out").select(
        F.regexp_extract("raw", '"eventId":"([^"]*)"', 1).alias("eventId"), F.col("raw").endswith('{"x": 1}').alias("glued"))


@register("ticket_result_json", f"""
WITH a AS ({ORACLE["ticket_dispatch_actions"]}),
e AS (SELECT eventId, max(lane) AS lane, max(route_status) AS route_status, max(error) AS bad,
             arg_min(target, action_pos) AS target, arg_min(content, action_pos) AS content, arg_min(action, action_pos) AS action,
             count(action_pos) AS n, string_agg(coalesce(content, ''), '|' ORDER BY action_pos) AS contents,
             string_agg(coalesce(think, ''), '|' ORDER BY action_pos) AS thinks,
             string_agg(summary_line, chr(10) ORDER BY action_pos) AS lines FROM a GROUP BY eventId),
f AS (SELECT *, coalesce(bad, CASE WHEN route_status <> 'routed' THEN 'no lane: ' || route_status END) AS error FROM e),
g AS (SELECT *, error IS NULL AND lane IN ({_NAMED_SQL}) AS multi, error IS NULL AND lane NOT IN ({_NAMED_SQL}) AS one FROM f)
SELECT eventId, CASE WHEN error IS NOT NULL THEN '1' WHEN multi THEN '0' END AS result_code, error,
  CASE WHEN one THEN target END AS target, CASE WHEN one THEN content END AS content, CASE WHEN one THEN action END AS action,
  CASE WHEN multi THEN contents END AS contents, CASE WHEN multi THEN thinks END AS thinks,
  CASE WHEN multi THEN lines END AS summary
FROM g""")
def ticket_result_json(spark, d):
    """Result ticket per dispatch ticket (error, one forwarded action, or the
    action list with summary) written as JSON text; its fields read back."""
    answers = F.array(*[F.expr(_answer_sql(f"event_id + {i}")) for i in range(2)])
    t = _tickets(spark, d).select("ticket", answers.alias("responses"))
    res = OT.dispatch_result_tickets(t)
    v = F.parse_json(TS.to_json_text(F.struct(*res.columns)))
    paths = {"eventId": "eventId", "result_code": "processResultCode", **{
        c: f"processResultData.{c}" for c in ("error", "target", "content", "action", "summary")}}
    acts = F.variant_get("v", "$.processResultData.actions", "array<struct<content:string,think:string>>")

    def joined(c: str):
        return F.when(acts.isNotNull(), F.array_join(F.transform(acts, lambda a: F.coalesce(a[c], F.lit(""))), "|"))

    return res.select(v.alias("v")).select(*[F.variant_get("v", f"$.{p}", "string").alias(c) for c, p in paths.items()],
                                          joined("content").alias("contents"), joined("think").alias("thinks"))
