import math

import numpy as np
import pytest

from lodestar.llm import whitening as W
from lodestar.llm.queries import QUERIES

SF001 = "/root/testdata/sf0.001"


def test_leading_components_match_a_full_decomposition():
    rng = np.random.default_rng(3)
    some = rng.standard_normal((40, 12))
    split = np.zeros((9, 9))
    split[:4, :4], split[4:, 4:] = np.diag([5.0, 5, 5, 1]), np.ones((5, 5))
    for a in (some.T @ some, np.cov(rng.standard_normal((900, 64)).T), np.diag([3.0, 3, 3, 2, 2, 1]), split, np.eye(7),
              np.full((6, 6), 2.0), np.array([[4.0]]), np.array([[2.0, 1], [1, 2]]), 1e-12 * (some.T @ some)):
        m = len(a)
        values, vectors = W.leading_components(a, m)
        assert np.allclose(values, np.linalg.eigvalsh(a)[::-1], rtol=1e-12, atol=1e-13 * np.abs(a).max())
        assert np.abs(vectors.T @ vectors - np.eye(m)).max() < 1e-10
        assert np.abs(a @ vectors - vectors * values).max() < 1e-11 * max(np.abs(values).max(), 1e-300) * m


def test_sturm_count():
    d, e = np.array([2.0, 0, -1, 3]), np.array([1.0, 0, 2])
    values = np.linalg.eigvalsh(np.diag(d) + np.diag(e, 1) + np.diag(e, -1))
    cuts = np.linspace(-5, 6, 50)
    assert W.below(d, e, cuts).tolist() == [int((values < c).sum()) for c in cuts]


def plain(rows, k=32):
    """{position: [(component, n, deviation, whitened up to sign, explained)]}"""
    x = np.array([[math.floor(64 * float(e)) + 1_000_000 for e in v] for v in rows], object)
    n, s = len(x), x.sum(0)
    y = ((n * x - s) / n).astype(float)
    v = y.T @ y / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u[:, ::-1]
    dev = [int(d) for d in ((n * x - s) ** 2).sum(1)]
    return n, dev, y @ u / np.sqrt(np.maximum(e, 1e-300)), e / np.trace(v)


def check(got, ids, rows, k):
    n, dev, white, share = plain(rows)
    for c in range(k):
        mine = {r["vec_id"]: r for r in got if r["component"] == c + 1}
        assert sorted(mine) == sorted(ids)
        w = np.array([mine[i]["whitened"] for i in ids])
        assert min(np.abs(w - white[:, c]).max(), np.abs(w + white[:, c]).max()) < 1e-6
        assert [mine[i]["deviation"] for i in ids] == dev and {r["n"] for r in mine.values()} == {n}
        assert all(r["explained"] == pytest.approx(share[c], rel=1e-4) for r in mine.values())
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-6
    assert len(got) == len(ids) * k


def test_query_against_a_plain_version(spark):
    rows = [r for r in spark.read.parquet(f"{SF001}/embeddings.parquet").collect()]
    got = QUERIES["op13_whitening"](spark, SF001).collect()
    assert set(got[0].asDict()) == {"vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"}
    check(got, [r["vec_id"] for r in rows], [r["embedding"] for r in rows], 32)


def test_odd_rows(spark):
    rng = np.random.default_rng(0)
    good = [(i, rng.standard_normal(3).tolist()) for i in range(30)]
    odd = [(100, None), (101, []), (102, [1.0, None, 2.0]), (103, [1.0, math.nan, 2.0]), (104, [1.0, math.inf, 2.0]),
           (105, [1e300, 0.0, 0.0]), (106, [1.0, 2.0])]
    df = spark.createDataFrame([(*r, 1, 0.5) for r in good + odd], "vec_id long, embedding array<double>, n int, whitened double")
    check(W.whiten(df).collect(), list(range(30)), [v for _, v in good], 3)
    # repeated rows and null ids count each
    twice = spark.createDataFrame(good + good[:5] + [(None, [0.0, 1.0, 2.0])], "vec_id long, embedding array<double>")
    got = W.whiten(twice, components=2).collect()
    assert len(got) == 36 * 2 and {r["n"] for r in got} == {36} and sum(r["vec_id"] is None for r in got) == 2
    # a constant dimension carries no component
    flat = spark.createDataFrame([(i, [*v, 7.0]) for i, v in good], "vec_id long, embedding array<float>")
    assert {r["component"] for r in W.whiten(flat).collect()} == {1, 2, 3}
    one = spark.createDataFrame([(1, [1.0, 2.0])] * 3, "vec_id long, embedding array<double>")
    assert W.whiten(one).count() == 0 and W.whiten(df.limit(0)).count() == 0
    assert W.whiten(spark.createDataFrame(odd[:5], "vec_id long, embedding array<double>")).count() == 0


def test_deviations_beyond_64_bits():
    x = np.array([[2 ** 40, 0], [0, 0]], np.int64)
    sums = np.array([2 ** 40, 0], object)
    assert W.deviations(x, 2, sums) == [None, None]
    assert W.deviations(x[1:], 1, np.array([3, 4], object)) == [25]
