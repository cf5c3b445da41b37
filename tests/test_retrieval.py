import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from lodestar.operators import retrieval as R
from lodestar.sources.tables import table

from conftest import SF001


def test_recursive_chunks_bounded_and_cover(spark):
    docs = table(spark, SF001, "documents").select("doc_id", "text")
    ch = R.recursive_chunks(docs).cache()
    assert ch.agg(F.max(F.length("chunk"))).collect()[0][0] <= R.CHUNK_SIZE
    # every non-whitespace character of every document lands in some chunk
    text = {r.doc_id: r.text for r in docs.collect()}
    got = {}
    for r in ch.collect():
        got.setdefault(r.doc_id, []).append(r.chunk)
    for k, t in list(text.items())[:50]:
        words = set(t.split())
        covered = set(" ".join(got.get(k, [])).split())
        assert words <= covered or not words


def test_recursive_split_rule():
    text = "a" * 300 + "\n\n" + "b" * 300 + "\n\n" + "c" * 50
    parts = R.recursive_split(text, 500, 100)
    assert all(len(p) <= 500 for p in parts)
    assert parts[0] == "a" * 300


def test_paragraph_split_blank_lines(spark):
    df = spark.createDataFrame([(1, "p1\n\np2\n\n")], "doc_id long, text string")
    assert [(r.pos, r.chunk) for r in R.split_on(df, "\n\n").collect()] == [(0, "p1"), (1, "p2"), (2, "")]


def test_fixed_chunks(spark):
    df = spark.createDataFrame([(1, "x" * 1000)], "doc_id long, text string")
    rows = R.fixed_chunks(df, 500, 100).collect()
    assert [len(r.chunk) for r in rows] == [500, 500, 200]


import pytest


@pytest.mark.parametrize("broadcast_bytes", [0, 64 << 20])
def test_knn_matches_brute_force(spark, broadcast_bytes):
    e = table(spark, SF001, "embeddings").repartition(3)
    got = R.knn(e.select(F.col("vec_id").alias("query_id"), "embedding"),
                e.select(F.col("vec_id").alias("id"), "embedding"), 5, exclude_self=True, block_rows=128,
                broadcast_bytes=broadcast_bytes)
    got = {(r.query_id, r.rank): r.neighbor_id for r in got.collect()}
    pdf = e.toPandas()
    m = np.stack(pdf.embedding.to_numpy()).astype(np.float64)
    ids = pdf.vec_id.to_numpy()
    d = ((m[:, None, :] - m[None, :, :]) ** 2).sum(2)
    np.fill_diagonal(d, np.inf)
    for qi in range(len(ids)):
        order = np.lexsort((ids, d[qi]))[:5]
        for rank, j in enumerate(order, start=1):
            assert got[(int(ids[qi]), rank)] == int(ids[j])


def test_embed_hook_and_hashing(spark):
    df = spark.createDataFrame([(1, "a b c"), (2, "")], "doc_id long, text string")
    out = R.embed_with(df, lambda: lambda xs: np.ones((len(xs), 4)), 4).collect()
    assert np.allclose(np.linalg.norm(out[0].embedding), 1.0)
    h = R.hashing_embed(df, dim=16).collect()
    assert len(h[0].embedding) == 16 and abs(np.linalg.norm(h[0].embedding) - 1) < 1e-5


def test_context_assembly_orders_and_cites(spark):
    hits = spark.createDataFrame([(1, 2, 20), (1, 1, 10)], "query_id long, rank int, neighbor_id long")
    docs = spark.createDataFrame([(10, "first", "s2"), (20, "second", "s1")], "doc_id long, text string, source string")
    row = R.assemble_context(hits, docs).collect()[0]
    assert row.context == "first\nsecond" and row.citations == ["s1", "s2"]


def test_recursive_split_without_separators():
    text = "x" * 1234
    parts = R.recursive_split(text, 500, 100)
    assert all(len(p) <= 500 for p in parts) and "".join(parts).count("x") >= 1234


def test_rerank_ties_keep_retrieval_order(spark):
    cands = spark.createDataFrame([(1, 1, 10), (1, 2, 11), (1, 3, 12)], "query_id long, rank int, neighbor_id long")
    q = spark.createDataFrame([(1, "a b")], "query_id long, text string")
    c = spark.createDataFrame([(10, "z"), (11, "a"), (12, "a")], "doc_id long, text string")
    got = [(r.rerank, r.neighbor_id) for r in R.lexical_rerank(cands, q, c, top=2).orderBy("rerank").collect()]
    assert got == [(1, 11), (2, 12)]


def test_knn_blocked_unequal_sides(spark):
    rng = np.random.default_rng(7)
    q = rng.normal(size=(37, 8)).astype(np.float32)
    c = rng.normal(size=(301, 8)).astype(np.float32)
    qdf = spark.createDataFrame([(i, q[i].tolist()) for i in range(len(q))], "query_id long, embedding array<float>")
    cdf = spark.createDataFrame([(1000 + j, c[j].tolist()) for j in range(len(c))], "id long, embedding array<float>")
    got = R.knn(qdf, cdf, 4, block_rows=16, broadcast_bytes=0)
    got = {(r.query_id, r.rank): r.neighbor_id for r in got.collect()}
    d = ((q.astype(np.float64)[:, None, :] - c.astype(np.float64)[None, :, :]) ** 2).sum(2)
    for i in range(len(q)):
        for rank, j in enumerate(np.lexsort((np.arange(len(c)), d[i]))[:4], start=1):
            assert got[(i, rank)] == 1000 + int(j)


@pytest.mark.parametrize("broadcast_bytes", [0, 64 << 20])
def test_knn_ties_repeated_queries_and_bad_vectors(spark, broadcast_bytes):
    corpus = [(i, [1.0, 0.0]) for i in range(60)] + [(100, None), (101, [1.0]), (102, [float("nan"), 0.0]), (None, [1.0, 0.0]),
                                                      (103, [0.0, None]), (104, [5.0, 5.0])]
    queries = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [5.0, 5.0]), (2, None), (3, [1.0]), (59, [1.0, 0.0])]
    q = spark.createDataFrame(queries, "query_id long, embedding array<double>")
    c = spark.createDataFrame(corpus, "id long, embedding array<double>").repartition(3)
    got = sorted((r.query_id, r.distance, r.rank, r.neighbor_id)
                 for r in R.knn(q, c, 3, block_rows=16, broadcast_bytes=broadcast_bytes).collect())
    assert got == sorted([(1, 0.0, 1, 0), (1, 0.0, 2, 1), (1, 0.0, 3, 2), (1, 0.0, 1, 104), (1, 41.0, 2, 0), (1, 41.0, 3, 1),
                          (59, 0.0, 1, 0), (59, 0.0, 2, 1), (59, 0.0, 3, 2)])
    bad = {r.id: r.reason for r in R.vector_rejects(c, "id", "embedding", 2).collect()}
    assert bad == {100: "no vector", 101: "other length", 102: "component not finite", 103: "component not finite", None: "no id"}


@pytest.mark.parametrize("broadcast_bytes", [0, 64 << 20])
def test_knn_of_an_id_that_stands_often_beside_copies(spark, broadcast_bytes):
    rows = [(1, [1.0, 0.0])] * 9 + [(2, [1.0, 0.0])] * 2 + [(3, [0.0, 1.0])]
    c = spark.createDataFrame(rows, "id long, embedding array<float>")
    q = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.0])], "query_id long, embedding array<float>")
    got = R.knn(q, c, 3, exclude_self=True, broadcast_bytes=broadcast_bytes).orderBy("query_id", "rank")
    assert [(r.query_id, r.neighbor_id, r.distance) for r in got.collect()] == [
        (1, 2, 0.0), (1, 2, 0.0), (1, 3, 2.0), (2, 1, 0.0), (2, 1, 0.0), (2, 1, 0.0)]


def test_blocks_grow_with_the_rows_and_copies_meet_once(spark):
    # (blocks of a side) x (rows of the other) cross the network: no more than BLOCKS times the rows as far as memory allows
    assert [R._blocks(n, 4096) for n in (0, 4096, 100_000, 524_288, 5_242_880)] == [1, 1, 16, 16, 160]
    rows = [(i + 100 * j, [float(i), 1.0]) for i in range(20) for j in range(21)]
    c = spark.createDataFrame(rows, "cid long, cv array<float>")
    got = {tuple(r.cv): sorted(r.cids) for r in R._copies_together(c, 5).collect()}
    assert got == {(float(i), 1.0): [i + 100 * j for j in range(10)] for i in range(20)}


def test_token_buckets_of_a_batch(spark):
    import hashlib
    texts = ["a b a", None, "", "Ünder b", "x" * 3000]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string").coalesce(1)
    out = [r.embedding for r in R.token_hash_embed(df, dim=8, normalize=False).orderBy("id").collect()]
    want = []
    for t in texts:
        v = [0.0] * 8
        for w in (t or "").lower().split():
            v[int(hashlib.md5(w.encode()).hexdigest()[:4], 16) % 8] += 1
        want.append(v)
    assert out == want
    plan = R.token_hash_embed(df)._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "md5" not in plan  # no hash and no pass over the tokens for each bucket
