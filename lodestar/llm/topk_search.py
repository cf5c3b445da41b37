"""Exact top-k search by inner product over integer vectors, pruned with
statistics of vector segments at several resolutions."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

EXACT = 2.0 ** 52  # sums of products below this are exact in doubles


def finite_vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """Rows whose vector is not null and holds finite components only."""
    x = F.col(vec_col)
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v.cast("double")) | (F.abs(v.cast("double")) == float("inf")))
    return df.filter(F.col(id_col).isNotNull() & x.isNotNull() & ~bad)


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dim)


def segment_statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """Per segment, root(length) times mean and times deviation.  The inner
    product of two such rows is an upper bound of the vectors' own: within a
    segment it is the means' part plus the deviations' (Cauchy-Schwarz), that
    is, the squared distance is at least the sum of length * (difference of
    means ^ 2 + difference of deviations ^ 2)."""
    parts = np.array_split(np.arange(x.shape[1]), segments)
    root = np.sqrt([len(p) for p in parts])
    mean = np.stack([x[:, p].mean(1) for p in parts], 1)
    dev = np.stack([x[:, p].std(1) for p in parts], 1)
    return np.concatenate([mean * root, dev * root], 1)


def _dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of rows of ``a`` with rows of ``b``."""
    if not len(a) or not len(b):
        return np.zeros((len(a), len(b)), np.int64)
    most = float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1]
    if most < EXACT:
        return np.rint(a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    big = a.astype(object) @ b.T.astype(object)
    return np.clip(big, -2 ** 63, 2 ** 63 - 1).astype(np.int64)


def block_topk(qid: np.ndarray, q: np.ndarray, vid: np.ndarray, v: np.ndarray, k: int, levels: Sequence[int],
               step: int = 512) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, vector, score) of the k best of this block for each query:
    candidates come in steps; once a query holds k, a step's candidates are
    bounded coarse to fine, and only what may reach the k-th score (ties
    included) is computed exactly."""
    order = np.argsort(vid, kind="stable")
    vid, v = vid[order], v[order]
    dim = q.shape[1]
    sizes = [s for s in levels if s < dim]
    qf, vf = q.astype(np.float64), v.astype(np.float64)
    q_stats = [segment_statistics(qf, s) for s in sizes]
    v_stats = [segment_statistics(vf, s) for s in sizes]
    slack = 1e-9 * (1 + np.linalg.norm(qf, axis=1) * (np.linalg.norm(vf, axis=1).max() if len(vf) else 0))
    n = len(qid)
    best = np.full((n, k), np.iinfo(np.int64).min)
    best_id = np.full((n, k), -1, np.int64)
    held = np.zeros(n, np.int64)
    for start in range(0, len(vid), step):
        part = slice(start, min(start + step, len(vid)))
        open_ = np.ones((n, part.stop - part.start), bool)
        full = held >= k
        rows = np.flatnonzero(full)
        for qs, vs in zip(q_stats, v_stats):
            if not len(rows):
                break
            bound = qs[rows] @ vs[part].T
            open_[rows] &= bound >= (best[rows, -1] - slack[rows])[:, None]
            rows = rows[open_[rows].any(1)]
        for r0 in range(0, n, 256):
            mine = np.flatnonzero(open_[r0:r0 + 256].any(1)) + r0
            cols = np.flatnonzero(open_[mine].any(0)) if len(mine) else mine
            if not len(cols):
                continue
            ids = vid[part][cols]
            score = _dot(q[mine], v[part][cols])
            use = open_[np.ix_(mine, cols)] & (qid[mine][:, None] != ids[None, :])
            # larger score first, then smaller id: candidates stand in id order already
            s = np.concatenate([best[mine], np.where(use, score, np.iinfo(np.int64).min)], 1)
            i = np.concatenate([best_id[mine], np.broadcast_to(ids, score.shape)], 1)
            ok = np.concatenate([np.arange(k)[None, :] < held[mine][:, None], use], 1)
            rank = np.lexsort((i, -s.astype(np.float64) if np.abs(s[ok]).max(initial=0) < EXACT else _down(s), ~ok), 1)[:, :k]
            at = np.arange(len(mine))[:, None]
            best[mine], best_id[mine] = s[at, rank], i[at, rank]
            held[mine] = ok[at, rank].sum(1)
    there = np.arange(k)[None, :] < held[:, None]
    return np.repeat(qid, held), best_id[there], best[there]


def _down(score: np.ndarray) -> np.ndarray:
    """Keys that sort int64 scores from large to small."""
    return (~score.view(np.uint64)) ^ np.uint64(1 << 63)


def exact_topk(queries: DataFrame, vectors: DataFrame, *, k: int = 5, id_col: str = "vec_id",
               vec_col: str = "vector", levels: Sequence[int] = (4, 8, 16, 32), query_block: int = 4096,
               vector_block: int = 1024) -> DataFrame:
    """For every query the ``k`` vectors of largest integer inner product,
    ties to the smaller id: (query_id, rank, vec_id, score).  Both inputs
    have ``id_col`` (long) and ``vec_col`` (array of long); a query's own id
    is no candidate.  Only vectors of the query's length are compared.  Null
    ids or vectors, and vectors with null components, take no part; rows that
    repeat an id are candidates of their own, and as queries they count once
    per distinct vector.  Scores beyond 64 bits stop at its ends.

    Queries and vectors are cut into blocks by hash; a block of queries meets
    each block of vectors in one task, which returns k rows a query.  So a
    task holds two blocks whatever the sizes, and nothing is broadcast."""
    def clean(df: DataFrame) -> DataFrame:
        x = F.col(vec_col)
        return df.select(F.col(id_col).cast("long").alias("id"), x.alias("x"), F.size(x).alias("dim")).filter(
            F.col("id").isNotNull() & x.isNotNull() & ~F.exists(x, lambda v: v.isNull()) & (F.size(x) > 0))

    qs, vs = clean(queries).distinct(), clean(vectors)
    nq, nv = (max(1, math.ceil(df.count() / b)) for df, b in ((qs, query_block), (vs, vector_block)))
    left = qs.withColumn("qb", F.pmod(F.xxhash64("id"), F.lit(nq)).cast("int")).withColumn(
        "vb", F.explode(F.sequence(F.lit(0), F.lit(nv - 1))))
    right = vs.withColumn("vb", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(nv)).cast("int")).withColumn(
        "qb", F.explode(F.sequence(F.lit(0), F.lit(nq - 1))))

    def best(key: tuple[pa.Scalar, ...], q: pa.Table, v: pa.Table) -> pa.Table:
        names = ["query_id", "vec_id", "score"]
        if not len(q) or not len(v):
            return pa.table([pa.array([], pa.int64())] * 3, names=names)
        dim = key[0].as_py()
        found = block_topk(q["id"].to_numpy(), _matrix(q["x"], dim), v["id"].to_numpy(), _matrix(v["x"], dim),
                           k, levels)
        return pa.table([pa.array(c, pa.int64()) for c in found], names=names)

    pairs = left.groupBy("dim", "qb", "vb").cogroup(right.groupBy("dim", "qb", "vb")).applyInArrow(
        best, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return pairs.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
