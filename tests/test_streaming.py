import json
import os

from pyspark.sql import functions as F

from lodestar.sources.tickets import parse_ticket
from lodestar.streaming.tickets import dispatch_outcome, read_outcomes, read_rejects, run_dispatch


def _write(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")


def _msg(i, source="城市管家"):
    return json.dumps({"eventId": f"E{i}", "processActionCode": "old",
                       "processDataParams": {"description": "d", "reportLocation": "l", "sourceEntity": source},
                       "context": {"imageDescription": "[x: y]"}}, ensure_ascii=False)


def test_stream_equals_batch_and_resumes(spark, tmp_dir):
    inp, out, ck = tmp_dir + "/in", tmp_dir + "/out", tmp_dir + "/ck"
    _write(inp + "/a.json", [_msg(1), _msg(2, "X"), '{"eventId": "bad"}{"x": 1}'])
    run_dispatch(spark, inp, out, ck, action_code="EventHandlerLookup")
    got = {r.eventId: (r.lane, r.route_status, r.processActionCode) for r in read_outcomes(spark, out).collect()}
    assert got == {"E1": ("city_housekeeper", "routed", "EventHandlerLookup"),
                   "E2": (None, "end", "EventHandlerLookup")}
    assert [r.raw for r in read_rejects(spark, out).collect()] == ['{"eventId": "bad"}{"x": 1}']
    # a restart over the same folder processes nothing twice; new files only
    _write(inp + "/b.json", [_msg(3, "街道办")])
    run_dispatch(spark, inp, out, ck, action_code="EventHandlerLookup")
    ids = sorted(r.eventId for r in read_outcomes(spark, out).collect())
    assert ids == ["E1", "E2", "E3"]
    # batch over the same messages gives the same outcome rows
    raw = spark.read.text(inp).select(F.col("value").alias("raw"))
    batch = dispatch_outcome(raw.select("raw", parse_ticket(F.col("raw"))
                                        .withField("processActionCode", F.lit("EventHandlerLookup"))
                                        .alias("ticket"))).filter("accepted")
    cols = ["eventId", "processActionCode", "valid", "error", "lane", "route_status"]
    assert sorted(map(tuple, batch.select(cols).collect())) == sorted(map(tuple, read_outcomes(spark, out)
                                                                           .select(cols).collect()))


def _flow_tools(spark, tmp_dir):
    from lodestar.operators import flows as FL
    from lodestar.operators import retrieval as R
    from lodestar.operators import vector_index as VI

    def embed(df, text_col):
        return R.token_hash_embed(df, text_col, 8, normalize=False)

    rules = spark.createDataFrame([(1, "清理 路面", "a.txt"), (2, "d l", "b.txt")], "id long, text string, source string")
    VI.build_index(embed(rules, "text"), tmp_dir + "/rules")
    captions = spark.createDataFrame([("http://x/1.jpg", "a car", None), ("http://x/2.jpg", None, "late")],
                                     "url string, caption string, error string")
    said = tmp_dir + "/said"
    os.makedirs(said, exist_ok=True)

    def load():
        def answer(prompts):
            import uuid
            with open(f"{said}/{uuid.uuid4().hex}", "w") as f:
                f.write(json.dumps(prompts))
            return ["是" if "Do they agree?" in p else '{"completed": true, "reason": "r"}' if "JSON object" in p
                    else "1. 责任主体：甲\n2. 决策理由：\n因为" for p in prompts]
        return answer

    return FL.Tools(tmp_dir + "/rules", embed, captions, load, tmp_dir + "/answers", k=2), said


def _flow_messages():
    base = json.loads(_msg(1))
    check = base | {"eventId": "C", "processActionCode": "CheckHandleResult",
                    "context": {"imageDescription": "x", "dispatchTarget": "工地企业"}, "resultInfo": [
                        {"handleEntity": "e", "handleResult": "done", "handleResultImageUrls": ["http://x/1.jpg", "http://x/9.jpg"]}]}
    forward = check | {"eventId": "F", "context": {"imageDescription": "x", "dispatchTarget": "运输企业"}, "vendor": {"deep": [1, {"é": None}]}}
    scene = base | {"eventId": "S", "processActionCode": "EventTypeRecognition",
                    "processDataParams": {"sceneType": "spill", "imageUrls": ["http://x/1.jpg", "http://x/2.jpg"]}}
    dispatch = base | {"eventId": "D", "processActionCode": "EventHandlerLookup"}
    return [json.dumps(m, ensure_ascii=False) for m in (dispatch, dispatch, check, forward, scene, base)] + ["no json", "{} {}"]


def test_flows_stream_equals_batch_and_replays(spark, tmp_dir):
    from lodestar.operators.flows import process_tickets
    from lodestar.streaming.tickets import parse_messages, read_flow, run_flows

    tools, said = _flow_tools(spark, tmp_dir)
    lines = _flow_messages()
    _write(tmp_dir + "/in/a.json", lines)
    run_flows(spark, tmp_dir + "/in", tmp_dir + "/out", tmp_dir + "/ck", tools)

    def sinks():
        out = {}
        for name in ("results", "forwards", "rejects"):
            rows = [r.value for r in read_flow(spark, tmp_dir + "/out", name).collect()]
            if name == "results":  # stamps say when
                rows = [json.dumps({k: v for k, v in json.loads(r).items() if not k.startswith("processStart")}, sort_keys=True) for r in rows]
            out[name] = sorted(rows)
        return out

    first = sinks()
    results = {json.loads(r)["eventId"]: json.loads(r)["processResultData"] for r in first["results"]}
    assert len(first["results"]) == 4 and set(results) == {"D", "C", "S"}
    assert [a["citations"] for a in results["D"]["actions"]] == [["a.txt", "b.txt"]] * 2
    assert results["C"]["completed"] is True
    assert results["C"]["handleResultImageDescription"] == "[1.jpg: a car] [image_2: 图片处理失败: no caption]"
    assert results["S"]["isConsistency"] is True and "late" in results["S"]["imageDescription"]
    assert [json.loads(r)["vendor"] for r in first["forwards"]] == [{"deep": [1, {"é": None}]}]
    assert first["rejects"] == sorted([lines[5], "no json", "{} {}"])
    asked = sum(len(json.load(open(f"{said}/{f}"))) for f in os.listdir(said))
    assert asked == 4  # two lane actions (of two equal tickets), one check, one scene
    # a forced replay: the same batch id again, from a fresh checkpoint
    run_flows(spark, tmp_dir + "/in", tmp_dir + "/out", tmp_dir + "/ck2", tools)
    assert sinks() == first
    assert sum(len(json.load(open(f"{said}/{f}"))) for f in os.listdir(said)) == asked
    # the batch over the same lines
    raw = spark.createDataFrame([(x,) for x in lines], "raw string")
    batch = process_tickets(parse_messages(raw), tools)
    assert {n: batch[n].count() for n in batch} == {n: len(v) for n, v in first.items()}
    none = process_tickets(parse_messages(raw.limit(0)), tools)
    assert all(df.count() == 0 for df in none.values())


def test_payload_is_carried_whole(spark):
    from lodestar.streaming.tickets import parse_messages

    lines = ['{"eventId":"1","processActionCode":"x","v":{"a":[1,"1",null,{"b":2.5}]},"é":true}', '{"eventId":"2"}', "[1]", '{"a":1}{"b":2}', "", None]
    rows = parse_messages(spark.createDataFrame([(x,) for x in lines], "raw string"), "New").collect()
    assert json.loads(rows[0].payload) == json.loads(lines[0]) | {"processActionCode": "New"} and rows[0].ticket.processActionCode == "New"
    assert json.loads(rows[1].payload) == {"eventId": "2", "processActionCode": "New"}
    assert [r.payload for r in rows[2:]] == [None] * 4 and [r.ticket for r in rows[2:]] == [None] * 4


def test_a_message_is_tested_and_parsed_once(spark):
    from lodestar.streaming.tickets import parse_messages

    lines = [_msg(1), " \n\t" + _msg(2), _msg(3) + "{}", "[" + _msg(4) + "]", "x" + _msg(5), "", None]
    spark.conf.set("spark.sql.optimizer.enableJsonExpressionOptimization", "false")
    try:
        rows = dispatch_outcome(parse_messages(spark.createDataFrame([(x,) for x in lines], "raw string"), "New"))
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("lengthOfJsonArray") + plan.count("json_array_length") == 1 and plan.count("from_json") == 1
        assert [r.eventId for r in rows.collect()] == ["E1", "E2", None, None, None, None, None]
    finally:
        spark.conf.unset("spark.sql.optimizer.enableJsonExpressionOptimization")


def test_messages_are_written_once_without_a_second_text(spark, tmp_dir, monkeypatch):
    from lodestar.operators import flows as FL
    from lodestar.streaming.tickets import parse_messages

    written = {}
    plain = FL.materialize

    def noted(df, purpose, *how):
        written[purpose] = plain(df, purpose, *how)
        return written[purpose]

    monkeypatch.setattr(FL, "materialize", noted)
    lines = _flow_messages()
    raw = spark.createDataFrame([(x,) for x in lines], "raw string")
    out = FL.process_tickets(parse_messages(raw), _flow_tools(spark, tmp_dir)[0])
    assert written["messages"].columns == ["ticket", "text"]
    texts = [r.text for r in written["messages"].filter("text is not null").collect()]
    assert sorted(texts) == sorted([lines[3], *lines[5:]])  # the forward and the rejects
    assert {n: df.count() for n, df in out.items()} == {"results": 4, "forwards": 1, "rejects": 3}
