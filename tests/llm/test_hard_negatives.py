import random

import numpy as np
from pyspark.sql import functions as F

from lodestar.llm import hard_negatives as H


def plain(rows, anchors, positives=5, negatives=5):
    """Brute force over (id, label, vector) rows."""
    rows = [r for r in rows if r[0] is not None and r[1] is not None and r[2] and None not in r[2]]
    out = []
    for a in {(i, lab, tuple(x)) for i, lab, x in rows if anchors(i)}:
        scored = sorted((-sum(u * v for u, v in zip(a[2], x)), i, lab) for i, lab, x in rows if i != a[0] and len(x) == len(a[2]))
        for s, p, _ in [r for r in scored if r[2] == a[1]][:positives]:
            fit = [r for r in scored if r[2] != a[1] and 80 * -s <= 100 * -r[0] <= 100 * -s][:negatives]
            out += [(a[0], p, n + 1, r[1], -s, -r[0]) for n, r in enumerate(fit)]
    return sorted(out)


def got(spark, rows, positives=5, negatives=5, **sizes):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, label int, vector array<long>, rank string, q int")
    found = H.hard_negatives(df, F.col("vec_id") % 10 == 0, positives=positives, negatives=negatives, **sizes)
    return sorted(tuple(r) for r in found.collect())


def clustered(n, dim=24, seed=0, spread=40):
    rng = random.Random(seed)
    centres = [[rng.randrange(-100, 100) for _ in range(dim)] for _ in range(6)]
    return [(i, rng.randrange(3), [v + rng.randrange(-spread, spread) for v in rng.choice(centres)]) for i in range(n)]


def test_against_brute_force_in_many_blocks(spark):
    rows = clustered(400)
    want = plain(rows, lambda i: i % 10 == 0)
    assert len(want) > 500
    assert got(spark, rows) == want
    assert got(spark, rows, anchor_block=7, vector_block=60) == want
    assert got(spark, rows, positives=2, negatives=9) == plain(rows, lambda i: i % 10 == 0, 2, 9)


def test_ties_repeats_nulls_and_lengths(spark):
    rng = random.Random(5)
    rows = [(i, i % 2, [rng.randrange(3) for _ in range(3)]) for i in range(120)]
    rows += rows[:9] * 8 + [(10, 1, [2, 2, 2]), (20, 0, None), (30, None, [1, 1, 1]), (None, 1, [2, 2, 2]), (40, 1, []),
                            (50, 0, [None, 1, 1]), (60, 1, [5, 5]), (70, 0, [5, 4]), (61, 1, [4, 4]), (80, 1, [0, 0, 0])]
    want = plain(rows, lambda i: i % 10 == 0)
    assert got(spark, rows, vector_block=50) == want
    negative = [(0, 0, [5, 5]), (1, 0, [-5, -5]), (2, 1, [-4, -4])]
    assert got(spark, negative) == plain(negative, lambda i: i % 10 == 0) == []
    zero = [(0, 0, [0, 0]), (1, 0, [1, 0]), (2, 1, [7, 7])]
    assert got(spark, zero) == plain(zero, lambda i: i % 10 == 0) == [(0, 1, 1, 2, 0, 0)]
    wide = [(0, 0, [2 ** 26, 3]), (1, 0, [2 ** 26, 4]), (2, 1, [2 ** 26, 1])]
    assert got(spark, wide) == plain(wide, lambda i: i % 10 == 0)
    assert got(spark, []) == [] and got(spark, rows[1:10]) == []


def test_intervals_hold_every_product():
    rng = np.random.default_rng(2)
    for dim in (3, 64, 100):
        a, b = (rng.integers(-300, 300, (n, dim)) for n in (20, 50))
        a[0], b[0], b[1] = 0, 0, a[1]
        planes, codes = H.Planes(a), H.Codes(b)
        rows, cols = (x.reshape(-1) for x in np.meshgrid(np.arange(20), np.arange(50), indexing="ij"))
        true = (a @ b.T).reshape(-1)
        centre, grid, wide = np.zeros(1000), np.zeros(1000), []
        for level in range(H.LEVELS):
            centre, grid, low, high = H.intervals(planes, codes, rows, cols, level, centre, grid)
            assert ((low <= true) & (true <= high)).all()
            wide.append((high - low).mean())
        assert wide == sorted(wide, reverse=True) and wide[-1] < 0.4 * wide[0]


def test_filter_leaves_few_pairs_to_score():
    rng = np.random.default_rng(1)
    x = np.floor(256 * (lambda v: v / np.linalg.norm(v, axis=1, keepdims=True))(rng.standard_normal((3000, 64)))).astype(np.int64)
    label = rng.integers(0, 10, 3000)
    a = {"id": np.arange(0, 3000, 100), "label": label[::100], "x": x[::100]}
    b = {"id": np.arange(3000), "label": label, "x": x, "codes": H.Codes(x)}
    rows, cols, score, scored = H.best_same(a, b, 5)
    assert scored < 0.2 * (label[::100][:, None] == label).sum()
    a["held"] = np.full(30, 5)
    a["targets"] = np.stack([np.sort(score[rows == i])[::-1] for i in range(30)])
    assert H.best_below(a, b, 5, (80, 100))[-1] < 0.2 * 30 * 3000
