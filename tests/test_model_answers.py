import glob
import os

from pyspark.sql import functions as F

from lodestar.operators import model_answers as MA
from lodestar.operators import places as P
from lodestar.operators import retrieval as R
from lodestar.operators import tickets as OT
from lodestar.operators import vector_index as VI


def counting_model(folder, bad=()):
    """Loads a model that leaves one file per call, named by its prompts."""
    def load():
        def answer(prompts):
            import uuid
            with open(f"{folder}/{uuid.uuid4().hex}", "w") as f:
                f.write("\n".join(prompts))
            if any(p in bad for p in prompts):
                raise ValueError("no " + [p for p in prompts if p in bad][0])
            return [p.upper() for p in prompts]
        return answer
    return load


def calls(folder):
    return sorted(open(f).read() for f in glob.glob(folder + "/*"))


def test_each_prompt_is_asked_once_over_all_runs(spark, tmp_dir):
    said, store = tmp_dir + "/said", tmp_dir + "/answers"
    os.makedirs(said)
    df = spark.createDataFrame([("a",), ("b",), ("a",), (None,), ("",)], "prompt string").coalesce(1)
    got = {r["prompt"]: r for r in MA.ask_once(df, counting_model(said), store).collect()}
    assert {p: r["response"] for p, r in got.items()} == {"a": "A", "b": "B", "": ""}
    assert sorted(sum([c.split("\n") for c in calls(said)], [])) == ["", "a", "b"]
    assert all(r["started_at"] <= r["ended_at"] and r["attempts"] == 1 and r["error"] is None for r in got.values())
    before = len(calls(said))
    again = MA.ask_once(df, counting_model(said), store)
    assert again.count() == 3 and len(calls(said)) == before  # nothing is asked again
    more = MA.ask_once(df.unionByName(spark.createDataFrame([("c",)], "prompt string")), counting_model(said), store)
    assert more.count() == 4 and "".join(calls(said)[-1:] if before == 0 else [c for c in calls(said) if "c" in c]) == "c"


def test_failures_are_kept_retried_and_cost_no_other_answer(spark, tmp_dir):
    said, store = tmp_dir + "/said", tmp_dir + "/answers"
    os.makedirs(said)
    prompts = [f"p{i}" for i in range(64)]
    df = spark.createDataFrame([(p,) for p in prompts], "prompt string").coalesce(1)
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        got = {r["prompt"]: r for r in MA.ask_once(df, counting_model(said, bad=["p9"]), store, batch=64, retries=1).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert got["p9"]["response"] is None and got["p9"]["error"] == "ValueError: no p9" and got["p9"]["attempts"] == 2
    assert all(got[p]["response"] == p.upper() for p in prompts if p != "p9")
    assert len(calls(said)) <= 2 * 6 + 2  # halves, not one call a row
    healed = {r["prompt"]: r for r in MA.ask_once(df, counting_model(said), store).collect()}
    assert healed["p9"]["response"] == "P9" and len(healed) == 64 and len([c for c in calls(said) if c == "p9"]) == 3


def test_batch_of_wrong_length_is_a_failure():
    got = MA.ask_batch(lambda ps: ps[:1], ["a", "b", "c"], 0)
    assert [g[0] for g in got] == ["a", "b", "c"]
    assert MA.ask_batch(lambda ps: [], ["a"], 2)[0][1].startswith("ValueError: 0 results") and MA.ask_batch(None, [], 1) == []


def test_answers_come_back_in_their_places(spark, tmp_dir):
    rows = [("e1", ["x", "y"]), ("e1", ["x", "y"]), ("e2", []), ("e3", None), ("e4", ["y", None, "x"])]
    df = spark.createDataFrame(rows, "eventId string, prompts array<string>")
    os.makedirs(tmp_dir + "/said")
    got = MA.ask_list_once(df, counting_model(tmp_dir + "/said"), tmp_dir + "/answers").collect()
    said = sorted((r["eventId"], [a["response"] for a in r["answers"]]) for r in got)
    assert said == [("e1", ["X", "Y"]), ("e1", ["X", "Y"]), ("e2", []), ("e3", []), ("e4", ["Y", None, "X"])]
    assert sorted(sum([c.split("\n") for c in calls(tmp_dir + "/said")], [])) == ["x", "y"]


def test_look_up_each_keeps_equal_rows_apart(spark):
    df = P.with_row_key(spark.createDataFrame([(1, ["a", "b"])] * 3 + [(2, ["z"])], "id long, k array<string>"))
    table = spark.createDataFrame([("a", 1), ("b", 2)], "key string, v int")
    got = P.look_up_each(df, "k", table, "key", ["v"], "out").orderBy("id").collect()
    assert [[x["v"] for x in r["out"]] for r in got] == [[1, 2]] * 3 + [[None]]


def test_contexts_of_dispatch_tickets(spark, tmp_dir):
    def embed(df, text_col):
        return R.token_hash_embed(df, text_col, 16, normalize=False)

    rules = spark.createDataFrame([(1, "清理 路面", "b.txt"), (2, "x 1 2 3", ""), (3, "清理 路面 完成", "a.txt"), (4, "other words here now", None)],
                                  "id long, text string, source string")
    VI.build_index(embed(rules, "text"), tmp_dir + "/rules")
    t = "struct<eventId:string,processActionCode:string,processDataParams:struct<description:string,reportLocation:string," \
        "sourceEntity:string>,context:struct<imageDescription:string,dispatchTarget:string>,processResultData:struct<target:string>>"
    ticket = ("E", "c", ("清理 路面", "here", "城市管家"), ("清理", None), (None,))
    bad = ("E", "c", (None, "here", "城市管家"), ("清理", None), (None,))
    df = spark.createDataFrame([(ticket, 1), (ticket, 1), (bad, 2)], f"ticket {t}, contextsX int")
    got = OT.dispatch_contexts(df, tmp_dir + "/rules", embed, k=2).collect()
    full = [r for r in got if r["contextsX"] == 1]
    assert len(got) == 3 and [len(r["contexts"]) for r in full] == [2, 2] and [len(r["contexts"]) for r in got if r["contextsX"] == 2] == [0]
    assert full[0]["contexts"] == full[1]["contexts"]
    assert all(len(c["law_context"].split("\n")) == 2 for c in full[0]["contexts"])
    none = OT.dispatch_contexts(df.limit(0), tmp_dir + "/rules", embed)
    assert none.count() == 0


def test_token_hash_embed(spark):
    df = spark.createDataFrame([(1, "A a b, c!"), (2, None), (3, "--")], "id long, text string")
    rows = {r["id"]: r["embedding"] for r in R.token_hash_embed(df, dim=8).collect()}
    assert abs(sum(x * x for x in rows[1]) - 1) < 1e-12 and set(rows[2]) == set(rows[3]) == {0.0}
    whole = R.token_hash_embed(df, dim=8, normalize=False).filter(F.col("id") == 1).first()["embedding"]
    assert sum(whole) == 4 and max(whole) >= 2


def test_only_rows_with_elements_meet_their_answers(spark):
    df = P.with_row_key(spark.createDataFrame([(1, ["a", None]), (2, []), (3, None)], "id long, k array<string>"))
    table = spark.createDataFrame([("a", 1)], "key string, v int")
    out = P.look_up_each(df, "k", table, "key", ["v"], "out")
    assert {r["id"]: [x["v"] for x in r["out"]] for r in out.collect()} == {1: [1, None], 2: [], 3: []}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and plan.count("size(k#") >= 2  # the rows without elements are not joined


def test_texts_of_one_vector_are_searched_once(spark, tmp_dir, monkeypatch):
    def embed(df, text_col):
        return R.token_hash_embed(df, text_col, 4, normalize=False)

    seen = []
    search = VI.search_index
    monkeypatch.setattr(VI, "search_index", lambda q, *a, **b: seen.append(q.count()) or search(q, *a, **b))
    VI.build_index(embed(spark.createDataFrame([(1, "x y", "b.txt")], "id long, text string, source string"), "text"), tmp_dir + "/rules")
    t = "struct<eventId:string,processActionCode:string,processDataParams:struct<description:string,reportLocation:string," \
        "sourceEntity:string>,context:struct<imageDescription:string,dispatchTarget:string>,processResultData:struct<target:string>>"
    rows = [((f"E{i}", "c", (said, "here", "运输企业"), ("z", None), (None,)),) for i, said in enumerate(("x y", "y x", "x, y"))]
    got = OT.dispatch_contexts(spark.createDataFrame(rows, f"ticket {t}"), tmp_dir + "/rules", embed, k=1).collect()
    assert seen == [1] and [[c["law_context"] for c in r["contexts"]] for r in got] == [["x y"]] * 3


def test_a_run_reads_its_own_answers_and_older_ones(spark, tmp_dir):
    said, store = tmp_dir + "/said", tmp_dir + "/answers"
    os.makedirs(said)
    lists = "id long, prompts array<string>"
    first = MA.ask_list_once(spark.createDataFrame([(1, ["a", "b"])], lists), counting_model(said, bad=["b"]), store, retries=0)
    assert [(a["response"], a["error"]) for a in first.first()["answers"]] == [("A", None), (None, "ValueError: no b")]
    again = MA.ask_list_once(spark.createDataFrame([(1, ["b", "a", "c"]), (2, ["a"])], lists), counting_model(said), store)
    assert {r["id"]: [(a["response"], a["error"]) for a in r["answers"]] for r in again.collect()} == {
        1: [("B", None), ("A", None), ("C", None)], 2: [("A", None)]}
    assert MA.read_answers(spark, store).count() == 3
