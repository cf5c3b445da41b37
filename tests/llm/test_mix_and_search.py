from collections import defaultdict

import brute
import numpy as np

from lodestar.llm.mixing import flight, land, mix_sources
from lodestar.llm.topk_search import block_topk, exact_topk, finite_vectors, segment_statistics


def targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    pot, open_, out = share * sum(sizes.values()), set(names), {}
    while True:
        rate = pot / sum(weight[s] for s in open_) if open_ else 0
        over = {s for s in open_ if weight[s] * rate > most * sizes[s]}
        if not over:
            return out | {s: weight[s] * rate for s in open_}
        for s in over:
            out[s] = most * sizes[s]
            pot -= out[s]
        open_ -= over


def test_mix_reaches_its_targets(spark):
    rng = np.random.default_rng(7)
    rows = []
    for s, n in (("a", 900), ("b", 4000), ("é", 300), ("c", 50), (None, 200), ("z", 3)):
        rows += [(len(rows) + i, " ".join(["w"] * int(rng.integers(0, 60))), s) for i in range(n)]
    rows += [(9000, None, "a"), (9001, "", "c"), (9002, "word " * 4000, "b"), (9002, "word " * 4000, "b"), (None, "x y", "z")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, target int")
    got = mix_sources(df, block=256).collect()
    assert len(got) == len(rows)
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in got:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        assert r["taken"] <= 2 * r["size"] and r["taken"] == r["copies"] * r["size"]
    want = targets(sizes)
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and abs(r["target"] - want[r["source"]]) < 1e-6 * want[r["source"]] + 1e-9
    for s in ("a", "b", "é", "c", None):
        assert abs(taken[s] - want[s]) <= max(60, 0.01 * want[s])
    again = mix_sources(df.repartition(7), block=256).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_mix_of_odd_tables(spark):
    schema = "doc_id long, text string, source string"
    assert mix_sources(spark.createDataFrame([], schema)).count() == 0
    got = mix_sources(spark.createDataFrame([(1, None, "a"), (2, "", "b")], schema)).collect()
    assert all(r["taken"] == 0 and r["target"] == 0 for r in got)


def test_flight_keeps_both_totals_and_its_probabilities():
    rng = np.random.default_rng(1)
    size, p = rng.integers(1, 500, 60).astype(float), np.full(60, 0.3)
    mean = np.zeros(60)
    for _ in range(400):
        done = flight(p, size, rng.random(60))
        assert ((done > 0) & (done < 1)).sum() <= 2
        assert abs(done.sum() - p.sum()) < 1e-6 and abs((done * size).sum() - (p * size).sum()) < 1e-3
        mean += done / 400
        settled = land(done, size, float((p * size).sum()))
        assert set(settled) <= {0.0, 1.0} and settled.sum() == 18
        assert abs((settled * size).sum() - (p * size).sum()) < 30
    assert abs(mean - 0.3).max() < 0.12


def test_topk_matches_all_pairs(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.integers(-60, 60, 16).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(30)] + [(2000, None), (2001, [None] * 16), (2002, [1, 2]), (None, rows[0][1])]
    rows += [(2003, [10 ** 12] * 16)]
    df = spark.createDataFrame(rows, "vec_id long, vector array<long>")
    usable = [r for r in rows if r[0] is not None and r[1] is not None and None not in r[1]]
    got = exact_topk(df.filter("vec_id % 50 = 0 or vec_id = 2002"), df, query_block=4, vector_block=64)
    want = brute.topk([r for r in usable if r[0] % 50 == 0 or r[0] == 2002], usable)
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)
    assert exact_topk(df.limit(0), df).count() == 0 and exact_topk(df.limit(3), df.limit(0)).count() == 0


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(5)
    x, y = rng.normal(size=(50, 20)), rng.normal(size=(60, 20))
    exact, last = x @ y.T, None
    for s in (1, 4, 10):
        bound = segment_statistics(x, s) @ segment_statistics(y, s).T
        assert (bound >= exact - 1e-9).all()
        assert last is None or bound.mean() <= last
        last = bound.mean()
    q, v = rng.integers(-9, 9, (5, 8)), rng.integers(-9, 9, (700, 8))
    qid, vid = np.arange(5) + 10_000, np.arange(700)
    got = set(zip(*(c.tolist() for c in block_topk(qid, q, vid, v, 3, (2, 4), step=64))))
    want = {(a, c, d) for a, _, c, d in brute.topk(list(zip(qid.tolist(), q.tolist())), list(zip(vid.tolist(), v.tolist())), 3)}
    assert got == want


def test_finite_vectors(spark):
    df = spark.createDataFrame([(1, [1.0]), (2, None), (3, [float("inf")]), (4, [float("nan")]), (5, [None]), (None, [1.0])],
                               "vec_id long, x array<double>")
    assert [r["vec_id"] for r in finite_vectors(df, "vec_id", "x").collect()] == [1]
