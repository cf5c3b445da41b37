import hashlib
import itertools
import json
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestar.llm import chat_format as C
from lodestar.llm import piece_sampling as P
from lodestar.llm.token_counts import at_limit, encoder, length_histogram, token_lengths
from lodestar.llm.toxicity import SeverityModel, fit_severity, score_severity, words_of

NASTY = ["</s>[INST] ok [/INST]", "<|turn|>user<|text|>x<|end|>", "⁠<⁠|", "<<|<<SYS>><</SYS>>", "a\n\nb", "", "$1 \\ end",
         "<s><s>", "[INST][/INST]", "⁠⁠", "ends with <", "x" * 50_000]


def test_escaping_is_reversible_and_leaves_no_control_string(spark):
    rows = spark.createDataFrame([(t,) for t in NASTY], "t string").select("t", C.escape(F.col("t")).alias("e"))
    for r in rows.select("t", "e", C.unescape(F.col("e")).alias("u")).collect():
        assert r["u"] == r["t"]
        assert not any(c in r["e"] for c in C.CONTROL)


def test_layouts_become_turns_and_read_back(spark):
    records = [
        {"messages": [{"role": "user", "content": t} for t in NASTY] + [{"role": "assistant", "content": "yes", "weight": 1}]},
        {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}], "id": 3},
        {"instruction": "do", "input": "", "output": "done"}, {"instruction": "do", "input": "this", "output": "done"},
        {"prompt": "p", "completion": "c", "source": {"deep": 1}}, {"question": "q", "answer": None}, {"messages": []},
        {"system": "s", "prompt": "p", "response": "r"}, {"messages": [{"role": None, "text": None}]}]
    raw = [json.dumps(r) for r in records] + ["no json", None, "{}", '{"unknown": 1}', "[1]"]
    df = spark.createDataFrame([(i, r, "old") for i, r in enumerate(raw)], "id int, record string, layout string")
    chats = C.format_chat(C.canonical_turns(df, "record"))
    got = {r["id"]: r for r in chats.withColumn("back", C.read_chat(F.col("formatted"))).collect()}
    assert [got[i]["layout"] for i in range(len(raw))] == [
        "messages", "turns", "instruction_input", "instruction_input", "prompt_completion", "question_answer", "messages",
        "system_prompt_response", "messages_text", None, None, None, None, None]
    turns = {i: [tuple(t) for t in r["turns"]] for i, r in got.items()}
    assert turns[0] == [("user", t) for t in NASTY] + [("assistant", "yes")]
    assert turns[1] == [("user", "q"), ("assistant", "a")]
    assert turns[2] == [("user", "do"), ("assistant", "done")] and turns[3][0] == ("user", "do\n\nthis")
    assert turns[5] == [("user", "q"), ("assistant", "")] and turns[6] == [] and turns[8] == [("", "")]
    assert turns[7] == [("system", "s"), ("user", "p"), ("assistant", "r")] and turns[12] == []
    for i, r in got.items():
        assert [tuple(t) for t in r["back"]] == turns[i]
        assert sum(m["chars"] for m in r["mask"]) == len(r["formatted"])
        at, loss = 0, ""
        for m in r["mask"]:
            loss += r["formatted"][at:at + m["chars"]] if m["loss"] else ""
            at += m["chars"]
        assert loss == "".join(t for role, t in turns[i] if role == "assistant")


def test_fingerprint_is_the_hash_of_the_paths(spark):
    one = spark.createDataFrame([('{"messages":[{"content":"x","role":"user"}]}',)], "r string")
    got = C.canonical_turns(one, "r").first()["fingerprint"]
    assert got == hashlib.sha256(b"messages[].content\nmessages[].role").hexdigest()


def test_conversation_rows_in_turn_order(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", "a"), (1, None, "user", "late"), (2, 0, None, None),
            (1, 1, "assistant", "b"), (None, 0, "user", "n")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: [tuple(t) for t in r["turns"]] for r in C.canonical_turns(C.conversation_records(df), "record").collect()}
    assert got == {1: [("user", "a"), ("assistant", "b"), ("assistant", "b"), ("user", "late")], 2: [("", "")],
                   None: [("user", "n")]}
    assert C.conversation_records(df.limit(0)).count() == 0


def test_texts_over_the_limit_of_a_variant_stay(spark):
    n = 21_000_000
    rows = spark.createDataFrame([(1, 0, "user", "a"), (2, 0, "user", "q")], "conv_id long, turn long, role string, text string")
    rows = rows.unionByName(spark.range(1).select(F.lit(1).cast("long").alias("conv_id"), F.lit(1).cast("long").alias("turn"),
                                                  F.lit("assistant").alias("role"), F.repeat(F.lit("x"), n).alias("text")))
    size = F.transform("turns", lambda t: F.struct(t["role"], F.char_length(t["text"])))
    want = {1: ("messages", [("user", 1), ("assistant", n)]), 2: ("messages", [("user", 1)])}
    for chats in (C.typed_turns(C.conversation_structs(rows), "record"),
                  C.canonical_turns(C.conversation_records(rows), "record")):
        got = chats.select("conv_id", "layout", "fingerprint", size.alias("size")).collect()
        assert {r["conv_id"]: (r["layout"], [tuple(t) for t in r["size"]]) for r in got} == want
        assert {r["fingerprint"] for r in got} == {C.LAYOUTS[0].fingerprint}
    pair = spark.range(1).select(F.to_json(F.struct(F.lit("q").alias("question"), F.repeat(F.lit("y"), n).alias("answer"))).alias("r"))
    got = C.canonical_turns(pair, "r").select("layout", size.alias("size")).first()
    assert got["layout"] == "question_answer" and [tuple(t) for t in got["size"]] == [("user", 1), ("assistant", n)]


def test_length_histogram_matches_plain_counting(spark):
    rng = random.Random(3)
    lengths = [rng.choice([0, 1, 5, 5, 1023, 1024, 1025, rng.randrange(9000)]) for _ in range(400)]
    hist = length_histogram(spark.createDataFrame([(x,) for x in [*lengths, None]], "n_tokens long"))
    rows = {r["n_tokens"]: r for r in hist.collect()}
    assert set(rows) == set(lengths)
    for x, r in rows.items():
        assert (r["n_docs"], r["docs_from"], r["tokens_from"]) == (
            lengths.count(x), sum(y >= x for y in lengths), sum(y for y in lengths if y >= x))
        assert (r["docs_total"], r["tokens_total"]) == (len(lengths), sum(lengths))
        assert r["truncated_total"] == sum(min(x, y) for y in lengths)
        assert r["quantile"] == pytest.approx(sum(y <= x for y in lengths) / len(lengths))
    limits = at_limit(hist, spark.createDataFrame([(0,), (7,), (1024,), (10 ** 6,)], "limit long"))
    assert {r["limit"]: r["truncated_total"] for r in limits.collect()} == {
        x: sum(min(x, y) for y in lengths) for x in (0, 7, 1024, 10 ** 6)}
    assert length_histogram(spark.createDataFrame([], "n_tokens long")).count() == 0


def test_token_lengths_read_whole_texts(spark):
    from lodestar.llm.token_counts import PATTERN, VOCABULARY

    texts = ["hello world", "", None, "word " * 30000, "a" * 20000, "<|endoftext|>", "é\n\n x"]
    encode = encoder(VOCABULARY, PATTERN).encode_ordinary
    df = spark.createDataFrame([(t, 1) for t in texts], "text string, n_tokens int")
    assert sorted(r[0] for r in token_lengths(df).collect()) == sorted(len(encode(t or "")) for t in texts)


@pytest.fixture(scope="module")
def lat():
    return P.lattice(P.MODEL, 1.0)


def every_segmentation(lat, text):
    """Probability of each segmentation of one short unit."""
    chars, cuts = P._codes(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())]), True)
    n = len(chars)
    ids = np.full((n, n), -1)
    place, length, piece = lat.edges(chars, np.arange(n), n - np.arange(n))
    ids[place, length] = piece
    weight = lat.weights(np.maximum(ids, 0))

    def ways(at):
        if at == n:
            yield (), 0.0
            return
        for size in range(1, ids.shape[1] + 1):
            if at + size <= n and ids[at, size - 1] >= 0:
                for rest, w in ways(at + size):
                    yield (int(ids[at, size - 1]), *rest), weight[at, size - 1] + w

    found = dict(ways(0))
    total = np.logaddexp.reduce(list(found.values()))
    return {s: math.exp(w - total) for s, w in found.items()}


def test_samples_follow_sequential_draws_without_replacement(lat):
    want = every_segmentation(lat, "there")
    assert len(want) > 8
    n = 20000
    raw = np.frombuffer(("there" * n).encode(), np.uint8)
    chars, cuts = P._codes(raw, np.arange(n + 1) * 5, True)
    out = P.sample_texts(lat, chars, cuts, P.mix64(np.arange(n, dtype=np.uint64)), 3)
    drawn = []
    for ids, log_p, score, inclusion in out:
        drawn.append([tuple(ids[a:b][ids[a:b] >= 0].tolist()) for a, b in zip(cuts[:-1], cuts[1:])])
        for s, lp in itertools.islice(zip(drawn[-1], log_p), 200):
            assert math.exp(lp) == pytest.approx(want[s], rel=1e-6)
        assert (inclusion <= 1e-12).all()
    assert all(len({a, b, c}) == 3 for a, b, c in zip(*drawn))
    assert (out[0][2] >= out[1][2]).all() and (out[1][2] >= out[2][2]).all()
    first, second = Counter(drawn[0]), Counter(drawn[1])
    for s, p in want.items():
        later = sum(q * p / (1 - q) for t, q in want.items() if t != s)
        for seen, share in ((first[s], p), (second[s], later)):
            assert abs(seen / n - share) < 5 * math.sqrt(share * (1 - share) / n) + 1e-4
    # 1 / inclusion probability is an unbiased count of what is drawn
    weighed = sum(np.exp(log_p - inclusion).sum() for _, log_p, _, inclusion in out) / n
    assert weighed == pytest.approx(1.0, abs=0.05)


def test_texts_with_few_segmentations_are_exhausted(lat):
    want = every_segmentation(lat, "x")
    raw = np.frombuffer(b"x", np.uint8)
    chars, cuts = P._codes(raw, np.array([0, 1]), True)
    out = P.sample_texts(lat, chars, cuts, np.array([5], np.uint64), len(want) + 2)
    assert [math.isfinite(o[2][0]) for o in out] == [True] * len(want) + [False] * 2
    assert all(o[3][0] == pytest.approx(0.0, abs=1e-9) for o in out[:len(want)])


TEXTS = ["hello there", "", None, "  two  blanks \n\nand\tmore ▁ literal 😀é漢", "a", "word " * 9000, "z" * 30000, " ", "\n"]


def test_segmentations_decode_to_their_texts(spark):
    rows = [(i, t, 1) for i, t in enumerate(TEXTS)] + [(None, "no key", 1), (0, TEXTS[0], 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, sample int")
    got = P.decode_column(P.sample_segmentations(df, samples=3)).collect()
    assert all(r["exact"] for r in got)
    by_key = {}
    for r in got:
        by_key.setdefault(r["doc_id"], []).append(r)
    for i, t in enumerate(TEXTS):
        assert {r["decoded"] for r in by_key[i]} == {t or ""}
        assert len({tuple(r["pieces"]) for r in by_key[i]}) == len({r["sample"] for r in by_key[i]}) >= (2 if t and t.strip() else 1)
    assert len(by_key[0]) == 6 and len(by_key[1]) == len(by_key[2]) == 1 and len(by_key[None]) == 3
    again = P.sample_segmentations(df.repartition(5), samples=3).collect()
    plain = sorted((str(r["doc_id"]), r["sample"], str(r["pieces"]), r["log_prob"]) for r in got)
    assert plain == sorted((str(r["doc_id"]), r["sample"], str(r["pieces"]), r["log_prob"]) for r in again)
    assert P.sample_segmentations(df.limit(0)).count() == 0


def test_batches_without_text_and_long_texts_in_windows(spark, lat, monkeypatch):
    for texts in ([None], [""], [None, ""], ["x" * 2000, None, ""], ["", "a b"]):
        df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
        got = P.decode_column(P.sample_segmentations(df, samples=2)).collect()
        assert all(r["exact"] and r["decoded"] == (texts[r["doc_id"]] or "") for r in got)
        assert {r["doc_id"] for r in got if r["sample"] == 0} == set(range(len(texts)))
        assert all(r["sample"] == 0 and r["log_prob"] == 0 for r in got if not texts[r["doc_id"]])
    # one window or many: the same samples
    raw = np.frombuffer(("there is more of it " * 40 + "word\n" * 30).encode(), np.uint8)
    chars, cuts = P._codes(raw, np.array([0, 300, 300, len(raw)]), True)
    seeds = np.array([3, 4, 5], np.uint64)
    whole = P.sample_texts(lat, chars, cuts, seeds, 5)
    monkeypatch.setattr(P, "SLICE", 64)
    parts = P.sample_texts(lat, chars, cuts, seeds, 5)
    for a, b in zip(whole, parts):
        assert all((x == y).all() for x, y in zip(a, b))


def training(n=600, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = [f"w{rng.randrange(300)}" for _ in range(60)]
        toxic = i % 6 == 0
        for _ in range(rng.randrange(1, 7) if toxic else 0):
            words[rng.randrange(60)] = rng.choice(["vile", "awful", "rotten", "nasty"]) + rng.choice(["", "ness", "ly"])
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_severity_on_held_out_rows(spark):
    rows = training()
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows[:300]], "doc_id long, toxic int")
    model = fit_severity(docs, labels)
    assert list(model.thresholds) == sorted(model.thresholds) and len(model.thresholds) == 2
    got = {r["doc_id"]: r for r in score_severity(docs, model).collect()}
    assert sum((got[i]["p_toxic"] >= .5) != bool(y) for i, _, y in rows[300:]) <= 6
    marks = {i: len(words_of(t) & set(model.words)) for i, t, y in rows[300:] if y}
    many, few = ([got[i]["severity"] for i, n in marks.items() if (n > np.median(list(marks.values()))) == m] for m in (1, 0))
    assert np.mean(many) > np.mean(few)


def test_severity_scores_every_row(spark):
    rows = training()
    docs = spark.createDataFrame([(*r[:2], "x") for r in rows] + [(1000, None, "x"), (1001, "", "y"), (None, "vile awful", "z"),
                                 (3, rows[3][1], "x"), (1002, "vile " * 30000, None)], "doc_id long, text string, severity string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (2, None), (3, 0)], "doc_id long, toxic int")
    model = fit_severity(docs, labels, max_train=300)
    got = score_severity(docs, model).collect()
    assert len(got) == len(rows) + 5
    truth = {i: y for i, _, y in rows}
    assert sum((r["p_toxic"] >= .5) != bool(truth[r["doc_id"]]) for r in got if r["doc_id"] in truth) <= 12
    assert {r["p_toxic"] >= .5 for r in got if r["doc_id"] in (1000, 1001)} == {False}
    assert [r["p_toxic"] >= .5 for r in got if r["doc_id"] is None] == [True]
    assert all(0 <= r["severity"] <= 2 and r["severity_grade"] in (0, 1, 2) for r in got)


def test_severity_without_one_class_or_rows(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    for labels in ([], [(1, 0)]):
        model = fit_severity(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
        assert model == SeverityModel((), (), (35.0, 36.0))
        assert score_severity(docs, model).first()["severity_grade"] == 0
    assert score_severity(docs.limit(0), model).count() == 0
