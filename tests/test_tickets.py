import json

from pyspark.sql import functions as F

from lodestar.functions import tickets as TK
from lodestar.operators import tickets as OT
from lodestar.sources.tickets import TICKET, parse_ticket


def tickets(spark, objs):
    raw = spark.createDataFrame([(json.dumps(o, ensure_ascii=False),) for o in objs], "raw string")
    return raw.select(parse_ticket(F.col("raw")).alias("ticket"))


def test_dispatch_blank_target_falls_to_source(spark):
    t = tickets(spark, [{"eventId": "a", "context": {"dispatchTarget": "   "},
                         "processDataParams": {"sourceEntity": "城市管家"}}])
    r = t.select(TK.dispatch_route(F.col("ticket")).alias("r")).collect()[0].r
    assert (r.lane, r.route_status) == ("city_housekeeper", "routed")


def test_dispatch_unknown_target_unroutable(spark):
    t = tickets(spark, [{"eventId": "a", "context": {"dispatchTarget": "X"},
                         "processDataParams": {"sourceEntity": "城市管家"}}])
    r = t.select(TK.dispatch_route(F.col("ticket")).alias("r")).collect()[0].r
    assert (r.lane, r.route_status) == (None, "unroutable")


def test_dispatch_validation_missing_names(spark):
    t = tickets(spark, [{"eventId": "a", "processDataParams": {"description": "x", "sourceEntity": ""},
                         "context": {}}])
    m = t.select(TK.dispatch_error(TK.dispatch_missing(F.col("ticket"))).alias("e")).collect()[0].e
    assert m == "工单缺失必要字段：reportLocation, sourceEntity, imageDescription"


def test_check_ticket_closes_through_checklist(spark):
    # the shipped sample shape: no resultInfo, checklist review says done
    sample = {"eventId": "E1", "eventType": "x", "processActionCode": "CheckHandleResult",
              "processDataParams": {"description": "d"},
              "context": {"imageDescription": "i", "dispatchTarget": "街道办",
                          "actions": [{"target": "工地企业", "content": "c"}]},
              "checklistInfo": {"handleItems": [{"item": "复查结果", "result": "已完成"}]}}
    t = tickets(spark, [sample]).withColumn("response", F.lit(None).cast("string"))
    row = OT.check_results(t).collect()[0]
    assert row.lane == "subdistrict_office" and row.status == "closed"
    assert row.completed is True and row.closed is True


def test_bad_json_message_rejected(spark):
    raw = spark.createDataFrame([('{"eventId": "a"}{"eventId": "b"}',), ('{"eventId": "c"}',)], "raw string")
    got = [r.t for r in raw.select(parse_ticket(F.col("raw"))["eventId"].alias("t")).collect()]
    assert got == [None, "c"]
    assert "resultInfo" in TICKET.fieldNames()


def test_dispatch_actions_named_lane(spark):
    t = tickets(spark, [{"eventId": "a", "processDataParams": {"description": "d", "reportLocation": "l",
                                                                "sourceEntity": "街道办"},
                         "context": {"imageDescription": "[i: c]"}}])
    req = OT.dispatch_requests(t).withColumn(
        "response", F.lit("<think>t</think>\n1. 责任主体：工地企业\n2. 决策理由：\n依法整改"))
    row = OT.dispatch_actions(req).collect()[0]
    assert (row.target, row.action, row.time_limit) == ("工地企业", "PUSH_SMS", 120)
    assert row.content == "依法整改" and row.think == "<think>t"
    assert row.summary_line == "- 工地企业：依法整改...，120分钟内完成"
    assert row.query.startswith("d\n[i: c]\n提醒肇事人员")


CITY = {"eventId": "a", "processActionCode": "EventHandlerLookup",
        "processDataParams": {"description": "d", "reportLocation": "l", "sourceEntity": "城市管家"},
        "context": {"imageDescription": "[i: c]"}}


def test_result_tickets_stay_one_row_a_ticket(spark):
    lacking = {"eventId": "b", "processActionCode": "x", "processDataParams": {"description": "d"}, "context": {}}
    lost = {**CITY, "eventId": "c", "processDataParams": {**CITY["processDataParams"], "sourceEntity": "nobody"}}
    t = tickets(spark, [CITY, CITY, lacking, lost])
    asked = OT.dispatch_prompts(t)
    assert [len(r.prompts) for r in asked.collect()] == [2, 2, 0, 0]
    answers = OT.ask_model_list(asked, lambda: lambda ps: ["1. 责任主体：x\n2. 决策理由：\nok"] * len(ps))
    ctx = answers.withColumn("ctx", F.array(*[F.struct(F.array(F.lit(c)).alias("citations")) for c in ("s1", "s2")]))
    res = OT.dispatch_result_tickets(ctx, contexts_col="ctx").collect()
    by = {}
    for r in res:
        by.setdefault(r.eventId, []).append(r)
    assert [len(by[k]) for k in "abc"] == [2, 1, 1]
    one = by["a"][0].processResultData
    assert [(a.target, a.content, a.citations) for a in one.actions] == [("执法队", "ok", ["s1"]), ("城市管家", "ok", ["s2"])]
    assert one.summary.count("\n") == 1 and by["a"][0].processResultCode == 0
    assert by["b"][0].processResultCode == 1 and by["b"][0].processResultData.error.startswith("工单缺失必要字段")
    assert by["c"][0].processResultCode == 1 and by["c"][0].processResultData.error.startswith("no lane")
    js = OT.dispatch_result_tickets(answers).select(F.to_json(F.struct("*")).alias("j")).collect()[0].j
    assert "执法队" in js  # non-ASCII kept literal


def test_hooks_load_in_the_task_and_a_bad_row_costs_itself_alone(spark):
    def load():
        def model(prompts):
            if any(p == "bad" for p in prompts):
                raise RuntimeError("endpoint down")
            return [p.upper() for p in prompts]
        return model

    df = spark.createDataFrame([("a",), ("bad",), (None,), ("b",)], "prompt string").coalesce(1)
    got = [(r.response, r.model_error) for r in OT.ask_model(df, load).collect()]
    assert got == [("A", None), (None, "RuntimeError: endpoint down"), ("", None), ("B", None)]
    imgs = spark.createDataFrame([(bytearray(b"ok"),), (bytearray(b"bad"),)], "content binary")

    def captions(bs):
        if bytes(bs[0]) != b"ok" or len(bs) > 1:
            raise ValueError("timeout")
        return ["a truck"]

    assert [(r.caption, r.caption_error) for r in OT.describe_images(imgs, lambda: captions).collect()] == [
        ("a truck", None), (None, "ValueError: timeout")]
    pairs = spark.createDataFrame([("q", "q x"), ("q", "y")], "query string, text string")
    sc = OT.score_pairs(pairs, lambda: lambda xs: [float(q in t) for q, t in xs]).collect()
    assert [(r.score, r.score_error) for r in sc] == [(1.0, None), (0.0, None)]
    few = OT.ask_model(df, lambda: lambda ps: []).collect()
    assert all(r.response is None and "0 results" in r.model_error for r in few)


def test_rules_are_retrieved_for_distinct_queries(spark):
    from lodestar.operators import retrieval as R
    rules = spark.createDataFrame([(1, "wash the road", "law-a"), (2, "guard the site", "law-b"), (3, "tax forms", None)],
                                  "doc_id long, text string, source string")
    chunks = R.hashing_embed(rules, dim=512)
    req = spark.createDataFrame([("x", "wash road"), ("y", "wash road"), ("z", None)], "eventId string, query string")
    got = {r.eventId: r for r in OT.retrieve_rules(req, chunks, lambda df, c: R.hashing_embed(df, c, dim=512), k=2).collect()}
    assert got["x"].law_context.split("\n")[0] == "wash the road" and got["x"].law_context == got["y"].law_context
    assert "law-a" in got["x"].citations and got["z"].law_context is None


def test_prompts_hold_what_the_parsers_need(spark):
    one = spark.range(1).select(
        OT.check_prompt(*[F.lit(x) for x in ("d", "i", "need", "done", None)], "工地企业").alias("check"),
        OT.scene_prompt(F.lit("scene"), F.lit("photo")).alias("scene"), OT.law_prompt(F.lit("q"), F.lit("c")).alias("law"),
        OT.summary_prompt(F.array(F.lit("- a"), F.lit("- b"))).alias("summary")).first()
    assert '"completed"' in one.check and "need" in one.check and "是" in one.scene and "- a\n- b" in one.summary
    assert '"answer"' in one.law
