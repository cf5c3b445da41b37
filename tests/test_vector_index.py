import random

import numpy as np
import pytest

from lodestar.operators import vector_index as VI


def clustered(n, dim=6, seed=0, wide=0.05):
    rng = random.Random(seed)
    centres = [[rng.uniform(-5, 5) for _ in range(dim)] for _ in range(12)]
    return [(i, [c + rng.gauss(0, wide) for c in centres[i % 12]]) for i in range(n)]


def plain(queries, rows, k, exclude_self):
    out = []
    for q, a in queries:
        near = sorted((sum((x - y) ** 2 for x, y in zip(a, b)), i) for i, b in rows if not (exclude_self and i == q))
        out += [(q, r + 1, i, pytest.approx(d, rel=1e-9, abs=1e-12)) for r, (d, i) in enumerate(near[:k])]
    return out


def search(spark, path, queries, k, **how):
    df = spark.createDataFrame(queries, "query_id long, embedding array<double>")
    return [tuple(r) for r in VI.search_index(df, path, k, **how).orderBy("query_id", "rank").collect()]


def test_search_equals_a_scan_and_skips_blocks(spark, tmp_dir):
    rows = clustered(900)
    path = tmp_dir + "/index"
    VI.build_index(spark.createDataFrame([(i, v, "s") for i, v in rows], "id long, embedding array<double>, source string"),
                   path, block_rows=40)
    assert VI.read_chunks(spark, path).count() == 900 and VI.open_blocks(spark, path).agg({"n": "sum"}).first()[0] == 900
    for queries, exclude in ((rows[::30], True), ([(10 ** 6 + i, v) for i, v in clustered(20, seed=9, wide=3.0)], False)):
        assert search(spark, path, queries, 7, exclude_self=exclude) == plain(queries, rows, 7, exclude)
    first, more, _ = VI.search_pairs(spark.createDataFrame(rows[::30], "query_id long, embedding array<double>"), path, 7)
    every = 30 * VI.open_blocks(spark, path).count()
    assert first.count() == 60 and more.count() + 60 < 0.3 * every


def test_ties_few_rows_and_crowded_blocks(spark, tmp_dir, monkeypatch):
    rows = [(i, [float(i % 3), 0.0]) for i in range(300)]
    VI.build_index(spark.createDataFrame(rows, "id long, embedding array<float>"), tmp_dir + "/a", block_rows=16)
    queries = [(i, v) for i, v in rows[:40]]
    want = plain(queries, rows, 5, True)
    assert search(spark, tmp_dir + "/a", queries, 5, exclude_self=True) == want
    monkeypatch.setattr(VI, "PAGE", 3)  # pages, parts of a block's queries
    assert search(spark, tmp_dir + "/a", queries, 5, exclude_self=True, probe=1) == want
    assert search(spark, tmp_dir + "/a", queries[:2], 400) == plain(queries[:2], rows, 400, False)


def test_unusable_rows_and_an_empty_index(spark, tmp_dir):
    odd = [(1, [1.0, 2.0]), (None, [0.0, 0.0]), (2, None), (3, [1.0]), (4, [float("nan"), 0.0]), (5, [3.0, 4.0]), (1, [1.0, 2.0])]
    df = spark.createDataFrame(odd, "id long, embedding array<double>")
    VI.build_index(df.coalesce(1), tmp_dir + "/b")
    assert VI.read_chunks(spark, tmp_dir + "/b").count() == len(odd)
    assert search(spark, tmp_dir + "/b", [(9, [1.0, 2.0]), (8, [1.0]), (7, None)], 5) == [
        (9, 1, 1, 0.0), (9, 2, 1, 0.0), (9, 3, 5, 8.0)]
    VI.build_index(df.limit(0), tmp_dir + "/c")
    assert search(spark, tmp_dir + "/c", [(9, [1.0, 2.0])], 5) == [] and search(spark, tmp_dir + "/b", [], 5) == []


def test_centres_of_equal_rows():
    assert len(VI.fit_centres(np.ones((50, 3)), 8)) == 1


def test_random_directions_move_tiles_and_no_pairs(spark, tmp_dir, monkeypatch):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 1) for _ in range(16)]) for i in range(300)]
    VI.build_index(spark.createDataFrame(rows, "id long, embedding array<double>"), tmp_dir + "/d", block_rows=4)
    monkeypatch.setattr(VI, "PAGE", 64)
    queries = spark.createDataFrame(rows, "query_id long, embedding array<double>")
    found = VI.search_index(queries, tmp_dir + "/d", 3, exclude_self=True)
    # each page gives a query's k best rows; of a block each there would be 75 or more times as many
    assert VI.search_pairs(queries, tmp_dir + "/d", 3, exclude_self=True)[2].count() == 300 * -(-300 // 64) * 3
    assert [tuple(r) for r in found.orderBy("query_id", "rank").collect()] == plain(rows, rows, 3, True)
