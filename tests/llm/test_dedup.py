import math
import random
import re
from collections import Counter

import brute
import numpy as np
import pytest

from lodestar.llm.chunk_dedup import chunk_ends, cut_spans, repeated_spans
from lodestar.llm.components import connected_components
from lodestar.llm.embed_dedup import embedding_links, fit_axes, linked, unit_rows
from lodestar.llm.line_dedup import dedup_lines
from lodestar.llm.weighted_minhash import (CELLS, all_similarities, consistent_samples, document_frequencies, near_duplicates,
                                           shingles, unpacked, weights_of)


def prose(rng, n, vocabulary=4000):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 100 + i) for i in range(1, 40)] + [(7, 7), (200, 201), (201, 200)]
    got = dict(tuple(r) for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(31)}, **{100 + i: 100 for i in range(40)}, 200: 200, 201: 200}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def vectors(rng, dim=12):
    rows = [(i, rng.normal(size=dim).tolist()) for i in range(120)]
    base = rng.normal(size=dim)
    rows += [(200 + i, (base + 0.2 * rng.normal(size=dim)).tolist()) for i in range(60)]
    rows += [(300 + i, rows[3][1]) for i in range(20)] + [(400, [2 * x for x in rows[5][1]])]
    rows += [(401, None), (402, [0.0] * dim), (403, [float("nan")] + [1.0] * (dim - 1)), (404, [None] + [1.0] * (dim - 1)),
             (405, [math.inf] + [1.0] * (dim - 1)), (406, [1.0, 2.0]), (None, rows[0][1]), (407, []), (3, rows[3][1])]
    return rows


@pytest.mark.parametrize("tile", [16, 4096])
def test_embedding_links_match_all_pairs(spark, tile):
    rows = vectors(np.random.default_rng(1))
    df = spark.createDataFrame([(*r, 0) for r in rows], "vec_id long, embedding array<double>, n_links int")
    got = embedding_links(df, tile=tile, sample=64).collect()
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, brute.embedding_rows(rows)))


@pytest.mark.parametrize("tile", [16, 4096])
def test_vectors_of_every_length_link_with_their_own(spark, tile):
    rng = np.random.default_rng(6)
    rows = vectors(rng)
    for dim, start in ((7, 1000), (3, 2000)):
        base = rng.normal(size=dim)
        rows += [(start + i, (base + 0.3 * rng.normal(size=dim)).tolist()) for i in range(40)]
        rows += [(start + 100, rows[-1][1]), (start + 101, rng.normal(size=dim).tolist())]
    want = [r for dim in (3, 7) for r in brute.embedding_rows([x for x in rows if x[1] is not None and len(x[1]) == dim])]
    got = embedding_links(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), tile=tile, sample=64).collect()
    assert sorted(tuple(r) for r in got if r["vec_id"] is not None and r["vec_id"] >= 1000) == sorted(want)
    assert sum(r[1] for r in want) > 0
    rest = [x for x in rows if x[0] is None or x[0] < 1000]
    assert sorted(map(str, (tuple(r) for r in got if r["vec_id"] is None or r["vec_id"] < 1000))) == sorted(
        map(str, brute.embedding_rows(rest)))


def test_tiles_are_stored_once_and_never_shuffled_for_their_pairs(spark, monkeypatch):
    """Many rounds give the same rows, and what is written follows the vectors, not the pairs of tiles."""
    from lodestar.llm import embed_dedup
    written, keep = [], embed_dedup.materialize
    monkeypatch.setattr(embed_dedup, "materialize", lambda df, purpose, *a: written.append(
        (purpose, df._jdf.queryExecution().optimizedPlan().toString())) or keep(df, purpose, *a))
    monkeypatch.setattr(embed_dedup, "HELD", 12 * 8 * 60, raising=False)
    rng = np.random.default_rng(9)
    rows = [(i, v.tolist()) for i, v in enumerate(np.repeat(rng.normal(size=(60, 8)), 5, 0) + 0.15 * rng.normal(size=(300, 8)))]
    got = embedding_links(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), tile=16, sample=64).collect()
    single = [(i, np.array(v, np.float32).astype(float).tolist()) for i, v in rows]
    assert sorted(tuple(r) for r in got) == sorted(brute.embedding_rows(single))
    assert [p for p, _ in written].count("links") > 3
    assert not any("Join" in plan or "Repartition" in plan for p, plan in written if p == "links")


def test_single_precision_screens_out_no_link():
    rng = np.random.default_rng(4)
    a = unit_rows(rng.normal(size=(70, 40)))
    turn = unit_rows(rng.normal(size=(70, 40)))
    turn = unit_rows(turn - (turn * a).sum(1, keepdims=True) * a)
    for by in (-1e-9, 1e-9):  # cosines a hair below and above the threshold
        b = (0.9 + by) * a + math.sqrt(1 - (0.9 + by) ** 2) * turn
        assert (np.diag(linked(a, b, None, (), 0.9)) == (by > 0)).all()


def test_embedding_links_without_usable_rows(spark):
    for rows in ([], [(1, None), (2, [0.0])]):
        got = embedding_links(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
        assert [tuple(r) for r in got] == [(i, 0, i, True) for i, _ in rows]


def test_extreme_components(spark):
    rows = [(1, [1e200, 1e200]), (2, [1e200, 0.99e200]), (3, [1e-200, 1e-200]), (4, [5e-324, 0.0]), (5, [1e308, 0.0]),
            (6, [-1e308, 1e-300])]
    got = embedding_links(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted(tuple(r) for r in got) == [(1, 2, 1, True), (2, 2, 1, False), (3, 2, 1, False), (4, 1, 4, True),
                                             (5, 1, 4, False), (6, 0, 6, True)]


def test_axes_are_used_from_a_few_dozen_vectors_on(spark, monkeypatch):
    from lodestar.llm import embed_dedup
    fitted = []
    monkeypatch.setattr(embed_dedup, "fit_axes", lambda sample, leaves: fitted.append((len(sample), leaves)) or fit_axes(sample, leaves))
    x = np.random.default_rng(8).normal(size=(100, 16))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got = embedding_links(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert fitted == [(100, 4)]
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, brute.embedding_rows(rows)))


def test_staged_products_prune_nothing_that_links():
    rng = np.random.default_rng(3)
    x = unit_rows(np.concatenate([rng.normal(size=(300, 24)), rng.normal(size=24) + 0.3 * rng.normal(size=(80, 24))]))
    axes = fit_axes(x, 8)
    found = linked(x, x, axes.basis, axes.levels, 0.9, step=50)
    assert (found == (x @ x.T >= 0.9)).all()
    tiles, near = axes.tile(x), {tuple(p) for p in axes.near_leaves(0.9).tolist()}
    for i, j in zip(*np.nonzero(found)):
        assert tuple(sorted((tiles[i], tiles[j]))) in near


def test_near_duplicates_match_all_pairs(spark):
    rng = random.Random(5)
    texts = [prose(rng, 80) for _ in range(40)]
    for i in range(12):
        for edits in (0, 1, 2, 4, 7):
            w = texts[i].split()
            for _ in range(edits):
                w[rng.randrange(len(w))] = "changed"
            texts.append(" ".join(w))
    shared = prose(rng, 30)
    texts += [shared + " " + prose(rng, 12) for _ in range(30)]
    texts += [None, "", " \n ", "one two", "One\ttwo", "one two three", prose(rng, 30000)]
    rows = [(i, t) for i, t in enumerate(texts)]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), tile=8).collect()
    want = brute.near_classes(texts)
    # documents in which shingles are rare: the cells' own collisions hardly weigh
    assert {r["doc_id"]: r["class_id"] for r in got} == dict(enumerate(want))
    assert {r["doc_id"] for r in got if r["kept"]} == set(want)


def test_near_copies_in_a_large_group_link_as_in_a_small_one(spark):
    """A group's text is in many rows, an edit's in one: TF-IDF must not weigh that against the group."""
    rng = random.Random(12)
    base = prose(rng, 60).split()
    texts = [" ".join(base)] * 10 + [" ".join(base[:i] + ["changed"] + base[i + 1:]) for i in range(8, 52)]
    texts += [prose(rng, 12) for _ in range(1500)]
    other = prose(rng, 60).split()  # as far from its copy as the group's members from the first, in no group
    texts += [" ".join(other), " ".join(other[:30] + ["changed"] + other[31:])]
    got = near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), tile=8).collect()
    of = {r["doc_id"]: r["class_id"] for r in got}
    assert {of[i] for i in range(54)} == {0}
    assert [of[i] for i in range(54, 1554)] == list(range(54, 1554))
    assert of[1554] == of[1555] == 1554


def test_rare_and_common_shingles_keep_their_weights_in_a_large_table(spark):
    """1.5 M shingles that one row holds beside some that many rows hold."""
    rng = random.Random(8)
    common = [prose(rng, 5, 10 ** 9) for _ in range(20)]
    texts = [prose(rng, 500, 10 ** 9) + " " + common[i % 20] for i in range(3000)]
    kept = prose(rng, 60, 10 ** 9)
    texts += [common[i] + " " + kept for i in range(2)] + [kept + " " + common[i] for i in range(2, 4)]
    got = document_frequencies(spark.createDataFrame([(t,) for t in texts] + [(texts[0],), (None,), ("",)], "text string"), "text", 5)
    by_text = {r["key"]: sorted(n for h in r["held"] for n in unpacked(h)[1].tolist()) for r in got.collect()}
    twin = {r["text"]: r["h"] for r in spark.createDataFrame([(t,) for t in texts], "text string").selectExpr(
        "text", "xxhash64(text) & 4294967295L h").collect()}
    holders = Counter(s for t in texts + [texts[0]] for s in brute.shingle_counts(t))
    for t in texts[::97] + texts[:21] + texts[-4:]:
        assert by_text[twin[t]] == sorted(holders[s] for s in brute.shingle_counts(t) if holders[s] > 1)


def test_near_duplicates_rows_that_repeat_and_empty_table(spark):
    text = "a b c d e f g h"
    df = spark.createDataFrame([(2, text, "x"), (2, text, "y"), (1, text, "z"), (None, text, None), (2, "other words", "k")],
                               "doc_id long, text string, class_id string")
    got = sorted((str(r["doc_id"]), r["class_id"], r["kept"]) for r in near_duplicates(df).collect())
    assert got == [("1", 1, True), ("2", 1, False), ("2", 2, True), ("None", 1, False)]
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_consistent_samples_agree_as_often_as_weights_are_similar():
    rng = np.random.default_rng(0)
    value = rng.integers(0, 2 ** 63, 200).astype(np.uint64)
    a, b = rng.uniform(0.5, 3, 200), rng.uniform(0.5, 3, 200)
    one = consistent_samples(np.array([0, 200]), np.array([200, 200]), np.concatenate([value, value]),
                             np.concatenate([a, b]), 3000)
    assert abs((one[0] == one[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < 0.03


def test_tiles_and_pairs_measure_alike():
    rng = random.Random(2)
    texts = [" ".join(rng.choice("a b c d e f".split()) for _ in range(rng.randrange(3, 60))) for _ in range(20)] + ["", "a"]
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    row, value, count = shingles(raw, np.cumsum([0] + [len(t) for t in texts]), 2)
    idf = np.linspace(1, 5, 1 << CELLS).astype(np.float32)
    got = all_similarities(row, value, count, idf, len(texts), step=7)
    weight = weights_of(value, count, idf)
    held = [dict(zip(value[row == i].tolist(), weight[row == i])) for i in range(len(texts))]
    for i, a in enumerate(held):
        for j, b in enumerate(held):
            both = sum(min(a[s], b[s]) for s in a.keys() & b.keys())
            if i != j:
                assert got[i, j] == pytest.approx(both / max(sum(a.values()) + sum(b.values()) - both, 1e-300))


def test_shingles_see_rows_apart():
    texts = ["  a B c d e f ", "", "x", "a b c d e f", " \n"]
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    row, value, count = shingles(raw, np.cumsum([0] + [len(t) for t in texts]), 5)
    assert row.tolist() == [0, 0, 2, 3, 3] and set(count) == {1}
    assert sorted(value[:2]) == sorted(value[3:])


def test_chunks_fall_into_step_after_an_insertion():
    rng = np.random.default_rng(2)
    a = rng.integers(97, 123, 5000).astype(np.uint8)
    b = np.concatenate([a[:1000], rng.integers(97, 123, 7).astype(np.uint8), a[1000:]])
    ends_a = chunk_ends(a, np.array([0, len(a)]), 24, 8, 512)
    ends_b = chunk_ends(b, np.array([0, len(b)]), 24, 8, 512)
    far_a, far_b = ends_a[ends_a > 1200], ends_b[ends_b > 1207] - 7
    assert far_a.tolist() == far_b.tolist() and np.diff(ends_a).max() <= 512
    both = chunk_ends(np.concatenate([b, a]), np.array([0, len(b), len(b) + len(a)]), 24, 8, 512)
    assert (both[both > len(b)] - len(b)).tolist() == ends_a.tolist()


def test_repeated_passages_are_found_and_clean_rows_left_alone(spark):
    rng = random.Random(11)
    passage = [prose(rng, 60) for _ in range(4)]
    rows = [(i, prose(rng, 40) + " " + (passage[i % 4] if i < 12 else "") + " " + prose(rng, 40)) for i in range(30)]
    rows += [(50, rows[20][1]), (51, "é" * 3000), (52, ""), (53, None), (54, rows[20][1][:60])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n_chars int")
    spans = repeated_spans(df)
    got = {r["doc_id"]: r for r in spans.collect()}
    assert len(got) == len(rows)
    hit = {i for i, r in got.items() if r["repeated_chars"]}
    assert set(range(12)) | {20, 50} <= hit <= set(range(12)) | {20, 50, 51}
    text = dict(rows)
    for i in range(12):
        marked = [(s["start"], s["end"]) for s in got[i]["dropped_spans"]]
        assert bool(marked) == (i >= 4)
        for s, e in marked:
            assert text[i][s:e] in passage[i % 4] or e - s <= len(passage[i % 4]) + 40
    assert got[50]["dropped_chars"] == len(text[50])
    cut = {r["doc_id"]: r["text"] for r in cut_spans(df, spans).collect()}
    assert cut[50] == "" and cut[25] == text[25] and cut[53] is None
    assert all(len(cut[i]) == len(text[i]) - got[i]["dropped_chars"] for i in range(30))


def test_chunks_do_not_depend_on_the_row_before():
    rng = np.random.default_rng(9)
    texts = [rng.integers(97, 123, n).astype(np.uint8) for n in rng.integers(0, 120, 400)]
    alone = [chunk_ends(x, np.array([0, len(x)]), 4, 8, 512) for x in texts]
    offsets = np.cumsum([0] + [len(x) for x in texts])
    together = chunk_ends(np.concatenate(texts), offsets, 4, 8, 512)
    assert together.tolist() == [int(e + o) for ends, o in zip(alone, offsets) for e in ends]


def planted_passages(words, trials=60):
    """Documents 2i and 2i + 1 share a passage; its place in each."""
    rng = random.Random(words)
    rows, place = [], {}
    for i in range(trials):
        passage = prose(rng, words)
        for doc, mark in ((2 * i, "x"), (2 * i + 1, "y")):
            before = f"{prose(rng, rng.randrange(5, 40))} {mark}"
            rows.append((doc, f"{before}{passage}{mark} {prose(rng, rng.randrange(5, 40))}"))
            place[doc] = (len(before), len(before) + len(passage))
    return rows, place


def test_passages_are_marked_from_end_to_end(spark):
    rows, place = planted_passages(30)
    got = {r["doc_id"]: r for r in repeated_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for doc, (a, b) in place.items():
        near = [(s["start"], s["end"]) for s in got[doc]["dropped_spans"]]
        assert got[doc]["repeated_chars"] == b - a
        assert near == ([(a, b)] if doc % 2 else [])


def test_repeated_spans_of_odd_tables(spark):
    assert repeated_spans(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    text = "some words that stand here twice, in rows of one id " * 3
    df = spark.createDataFrame([(1, text), (1, text), (None, text)], "doc_id long, text string")
    got = sorted((str(r["doc_id"]), r["dropped_chars"] > 0) for r in repeated_spans(df, min_chars=40).collect())
    assert got[0][1] == got[1][1] and len(got) == 3


def test_lines_match_plain_python(spark):
    rng = random.Random(4)
    common = ["This line stands in very many of the documents, yes" + c for c in ("", " \t", "\x0b")] + ["short line"]
    rows = [(i, "\n".join(rng.choice(common + [prose(rng, 9), "", "ÉTÉ " + "x" * 60, "été " + "x" * 60])
                          for _ in range(rng.randrange(9)))) for i in range(60)]
    rows += [(60, None), (61, ""), (62, "\n\n"), (63, common[0].upper()), (64, prose(rng, 20000)), (None, common[0])]
    df = spark.createDataFrame([(*r, 7, "k") for r in rows], "doc_id long, text string, n_lines int, __ld_id string")
    got = dedup_lines(df)
    assert got.columns == ["doc_id", "text", "__ld_id", "n_lines", "n_dropped"]
    assert sorted(map(str, ((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in got.collect()))) == sorted(
        map(str, brute.dedup_lines(rows)))
    assert dedup_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_digests_are_shuffled_in_shares_that_make_the_whole(spark, monkeypatch):
    from lodestar.llm import chunk_dedup as CD

    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(400)]
    said = " ".join(words[:60])
    docs = spark.createDataFrame([(i, " ".join(rng.choice(words) for _ in range(80)) + said) for i in range(12)] + [
        (12, None), (13, ""), (None, said)], "doc_id long, text string").coalesce(1)
    cells = ("hi", "lo", "id", "at", "others")
    whole = [tuple(r) for r in CD.chunk_rows(docs).select(*cells).collect()]
    shares = [[tuple(r) for r in CD.chunk_rows(docs, part=i, parts=3).select(*cells).collect()] for i in range(3)]
    assert all(shares) and sorted(map(repr, sum(shares, []))) == sorted(map(repr, whole))
    written = []
    plain = CD.materialize
    monkeypatch.setattr(CD, "materialize", lambda df, purpose, *how: written.append(purpose) or plain(df, purpose, *how))
    spans = sorted(map(repr, CD.repeated_spans(docs).collect()))
    assert written.count("places") == CD.PARTS > 1 and written.index("chunks") == CD.PARTS
    monkeypatch.setattr(CD, "PARTS", 1)
    assert sorted(map(repr, CD.repeated_spans(docs).collect())) == spans and any("repeated_chars=0" not in s for s in spans)


def test_repeated_places_and_texts_cross_the_network_in_shares(spark, monkeypatch):
    """Places go to their documents once, texts in shares, contexts without a shuffle of their own."""
    from lodestar.llm import chunk_dedup as CD

    rng = random.Random(8)
    said = prose(rng, 60)
    rows = [(i, f"{prose(rng, 30)} {i} {said} {i} {prose(rng, 30)}") for i in range(12)]
    rows += [rows[0]] * 3 + [(None, rows[1][1])] * 4 + [(None, said), (13, ""), (14, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    plans, plain = [], CD.materialize

    def kept(df, purpose, *how):
        plans.append((purpose, df._jdf.queryExecution().executedPlan().toString()))
        return plain(df, purpose, *how)

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        monkeypatch.setattr(CD, "materialize", kept)
        spans = sorted(map(repr, CD.repeated_spans(docs).collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    initial = lambda plan: plan.split("== Initial Plan ==")[-1]
    assert all(initial(p).count("Exchange") == 1 for purpose, p in plans if purpose == "chunks")
    contexts = [initial(p) for purpose, p in plans if purpose == "contexts"]
    assert len(contexts) >= CD.PARTS > 1 and all(p.count("Exchange") == 2 for p in contexts)
    monkeypatch.setattr(CD, "PARTS", 1)
    assert sorted(map(repr, CD.repeated_spans(docs).collect())) == spans and len(spans) == len(rows)


def test_a_place_of_equal_rows_stands_twice_in_a_batch_at_most(spark):
    from lodestar.llm import chunk_dedup as CD

    text = prose(random.Random(9), 60)
    for id_type, ids in (("long", [5] * 6), ("string", [None] * 6), ("string", ["a", None, "b"] * 4)):
        rows = CD.chunk_rows(spark.createDataFrame([(i, text) for i in ids], f"doc_id {id_type}, text string").coalesce(1)).collect()
        assert rows
        for r in rows:
            places = [(r["id"], r["at"]), *map(tuple, r["others"])]
            assert {p[0] for p in places} == set(ids) and max(map(places.count, places)) == 2


def test_words_are_hashed_in_blocks_like_plain_sums(monkeypatch):
    from lodestar.llm import weighted_minhash as WM

    rng = random.Random(6)
    texts = ["".join(rng.choice(["a", "B", "é", " ", "\n", "\x0b", "Q" * 90]) for _ in range(n)) for n in (0, 1, 3, 400, 0, 90)]
    raw = b"".join(t.encode() for t in texts)
    offsets = np.cumsum([0] + [len(t.encode()) for t in texts])
    want = Counter()
    for row, text in enumerate(texts):
        found = [[int(WM.BYTE[b]) for b in w.encode()] for w in re.split("[ \t-\r]+", text) if w]
        word = [int(WM.mix64(np.array([sum(b * int(WM.BASE) ** i for i, b in enumerate(w)) % 2 ** 64], np.uint64))[0]) for w in found]
        for i in range(max(1, len(word) - 2) if word else 0):
            said = sum(w * int(WM.STEP) ** j for j, w in enumerate(word[i:i + 3])) % 2 ** 64
            want[row, int(WM.mix64(np.array([said], np.uint64))[0])] += 1
    for block in (1, 64, 1 << 14):
        monkeypatch.setattr(WM, "BLOCK", block)
        row, value, count = WM.shingles(np.frombuffer(raw, np.uint8), offsets, 3)
        assert {(r, v): c for r, v, c in zip(row.tolist(), value.tolist(), count.tolist())} == want
    row, value = np.sort(np.array([rng.randrange(5) for _ in range(300)])), np.array([rng.randrange(40) for _ in range(300)], np.uint64)
    for wide in (row, row * 70_000):  # above 16 bits another sort
        order = WM.by_row(wide, value)
        assert sorted(zip(wide.tolist(), value.tolist())) == list(zip(wide[order].tolist(), value[order].tolist()))
