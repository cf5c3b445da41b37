"""A persisted vector index with exact search.

The index is two Parquet tables: the chunks with all their columns, and
blocks of vectors that lie near each other, each with its centre and radius.
A search reads centres first, takes the distance to the k-th neighbour found
in a query's nearest blocks, and then reads only the blocks that may hold a
nearer row by the triangle inequality.  Clustering decides speed alone: the
rows found are those of a search over every row."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..session import materialize
from .retrieval import _Best, _matrix, _Vectors, _blocks, _exact, valid_vectors

SLACK = 1e-9
PAGE = 4096  # rows of a page of blocks, and of a tile of queries, as long as these are few
_BLOCK = T.StructType([T.StructField("block", T.LongType()), T.StructField("n", T.LongType()),
                       T.StructField("dim", T.IntegerType()), T.StructField("centre", T.ArrayType(T.DoubleType())),
                       T.StructField("radius", T.DoubleType()), T.StructField("ids", T.BinaryType()),
                       T.StructField("vectors", T.BinaryType())])


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T), 0.0)


def fit_centres(sample: np.ndarray, k: int, rounds: int = 8, seed: int = 0) -> np.ndarray:
    """``k`` centres of a sample by Lloyd's rounds from rows drawn far apart."""
    rng = np.random.default_rng(seed)
    chosen = [int(rng.integers(len(sample)))]
    far = _squares(sample, sample[chosen]).min(1)
    while len(chosen) < min(k, len(sample)) and far.sum() > 0:
        chosen.append(int(rng.choice(len(sample), p=far / far.sum())))
        far = np.minimum(far, _squares(sample, sample[chosen[-1:]])[:, 0])
    centres = sample[chosen]
    for _ in range(rounds):
        near = _squares(sample, centres).argmin(1)
        size = np.bincount(near, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, near, sample)
        centres = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], centres)
    return centres


def build_index(chunks: DataFrame, path: str, *, id_col: str = "id", vec_col: str = "embedding", sample: int = 8192,
                most_centres: int = 512, block_rows: int = 1024) -> None:
    """Write ``path``/chunks (all columns) and ``path``/blocks.

    Every row with an id and a usable vector of the first length is in one
    block; ``vector_rejects`` reports the rest, which stay in the chunks.  At
    most ``sample`` rows, picked by a hash of the id over all rows, fit at most
    ``most_centres`` centres (bounds of what the driver and a task hold); a
    centre's rows are cut by hash into blocks of about ``block_rows``, each with
    its own centre and radius, so a crowded centre is many blocks."""
    spark = chunks.sparkSession
    chunks.write.mode("overwrite").parquet(f"{path}/chunks")
    stored = spark.read.parquet(f"{path}/chunks")
    usable = stored.filter(F.col(id_col).isNotNull() & valid_vectors(stored, vec_col))
    head = usable.select(F.size(vec_col)).limit(1).collect()
    dim = head[0][0] if head else 0
    rows = usable.filter(F.size(vec_col) == dim).select(F.col(id_col).cast("long").alias("id"),
                                                        F.col(vec_col).cast("array<double>").alias("v"))
    total = rows.count() if head else 0
    if not total:
        spark.createDataFrame([], _BLOCK).write.mode("overwrite").parquet(f"{path}/blocks")
        return
    keep = min(1.0, 2.0 * sample / total)
    picked = rows.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(keep * (1 << 30)) + 1).select("v").limit(2 * sample)
    seen = _matrix(picked.toArrow()["v"])
    centres = fit_centres(seen if len(seen) else _matrix(rows.select("v").limit(1).toArrow()["v"]),
                          max(1, min(most_centres, math.ceil(total / block_rows))))
    known = spark.sparkContext.broadcast(centres)  # most_centres x dim, whatever the number of rows

    def deal(batches):
        for batch in batches:
            v = _matrix(batch.column(1)) if len(batch) else np.zeros((0, dim))
            near = _squares(v, known.value).argmin(1) if len(batch) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near, pa.int64())], names=["id", "v", "c"])

    dealt = materialize(rows.mapInArrow(deal, "id long, v array<double>, c long"), "dealt")
    parts = dealt.groupBy("c").agg(F.ceil(F.count(F.lit(1)) / block_rows).alias("parts"))
    split = dealt.join(parts, "c").withColumn("block", F.col("c") * (1 << 32) + F.pmod(F.xxhash64("id", "v"), F.col("parts")))

    def pack(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        v, ids = _matrix(table["v"]), table["id"].to_numpy().astype(np.int64)
        centre = v.mean(0)
        radius = math.sqrt(((v - centre) ** 2).sum(1).max())
        return pa.table({"block": [key[0].as_py()], "n": [len(v)], "dim": [v.shape[1]], "centre": [centre.tolist()],
                         "radius": [radius], "ids": [ids.tobytes()], "vectors": [v.tobytes()]},
                        schema=pa.schema([("block", pa.int64()), ("n", pa.int64()), ("dim", pa.int32()),
                                          ("centre", pa.list_(pa.float64())), ("radius", pa.float64()),
                                          ("ids", pa.binary()), ("vectors", pa.binary())]))

    split.select("id", "v", "block").groupBy("block").applyInArrow(pack, _BLOCK).write.mode("overwrite").parquet(f"{path}/blocks")


def _queries(queries: DataFrame, query_id: str, query_vec: str, dim: int) -> DataFrame:
    q = queries.filter(F.col(query_id).isNotNull() & valid_vectors(queries, query_vec, dim)).select(
        F.col(query_id).cast("long").alias("qid"), _exact(queries, query_vec).alias("qv")).distinct()
    return q.withColumn("q", F.xxhash64("qid", "qv"))


def _read_blocks(Q: np.ndarray, best: _Best, blocks: list[dict], probe: int, part: int = 4096):
    """Brings a tile's queries together with the blocks of a page; gives the
    (query index, block index) pairs that were read, of each step by itself.

    First each query meets the ``probe`` blocks whose centres are nearest, then
    the blocks that may hold a row within the k-th distance found."""
    dim = Q.shape[1]
    centre = np.array([b["centre"] for b in blocks])
    radius = np.array([b["radius"] for b in blocks])
    held = [_Vectors(np.frombuffer(b["ids"], np.int64), np.frombuffer(b["vectors"], np.float64).reshape(-1, dim), best.k)
            for b in blocks]
    probe = min(probe, len(blocks))
    steps = [], []
    for s in range(0, len(Q), part):
        v = Q[s:s + part]
        far = np.sqrt(_squares(v, centre))
        # the squared form loses half the digits near zero: sqrt(rounding) of the vectors' size
        size = np.sqrt((v ** 2).sum(1))[:, None] + np.sqrt((centre ** 2).sum(1))[None, :] + radius[None, :]
        least = far - radius[None, :] - 1e-7 * size
        first = np.zeros(far.shape, bool)
        np.put_along_axis(first, np.argpartition(far, probe - 1, axis=1)[:, :probe], True, axis=1)
        done = [], []
        for j in np.flatnonzero(first.any(0)):
            at = np.flatnonzero(first[:, j])
            best.meet(s + at, held[j])
            done[0].append((at, np.full(len(at), j)))
        limit = np.sqrt(best.distance[s:s + part, -1]) * (1 + SLACK)
        more = (least <= limit[:, None]) & ~first
        for j in np.argsort(least.mean(0)):
            at = np.flatnonzero(more[:, j])
            if len(at):
                best.meet(s + at, held[j])
                done[1].append((at, np.full(len(at), j)))
        for step, pairs in zip(steps, done):
            step += [(s + at, block) for at, block in pairs]
    return steps


def _search(q: DataFrame, blocks: DataFrame, k: int, exclude_self: bool, probe: int, trace: bool = False) -> DataFrame:
    """Candidates (q, query_id, neighbor_id, distance): tiles of queries meet
    pages of blocks, and each page gives its k nearest rows of a query.  With
    ``trace`` the pairs (q, block, step) that are read instead."""
    tiles = _blocks(q.count(), PAGE)
    pages = _blocks(blocks.agg(F.sum("n")).first()[0] or 0, PAGE)
    left = q.withColumn("tile", F.pmod("q", F.lit(tiles)).cast("int")).withColumn(
        "page", F.explode(F.sequence(F.lit(0), F.lit(pages - 1))))
    right = blocks.select("block", "centre", "radius", "ids", "vectors").withColumn(
        "page", F.pmod(F.xxhash64("block"), F.lit(pages)).cast("int")).withColumn(
        "tile", F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))))

    def read(a: pa.Table, b: pa.Table) -> pa.Table:
        found = [np.zeros(0, np.int64)] * (3 if trace else 4)
        if len(a) and len(b):
            key, rows = a["q"].to_numpy(), b.to_pylist()
            Q = _matrix(a["qv"])
            best = _Best(a["qid"].to_numpy(), Q, k, exclude_self)
            steps = _read_blocks(Q, best, rows, probe)
            if trace:
                block = np.array([r["block"] for r in rows])
                pairs = [(key[at], block[j], np.full(len(at), step)) for step in (0, 1) for at, j in steps[step]]
                found = [np.concatenate(c) for c in zip(*pairs)]
            else:
                at, neighbour, distance = best.found()
                found = [key[at], best.qid[at], neighbour, distance]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.float64()]
        return pa.table([pa.array(c, t) for c, t in zip(found, types)],
                        names=["q", "block", "step"] if trace else ["q", "query_id", "neighbor_id", "distance"])

    return left.groupBy("tile", "page").cogroup(right.groupBy("tile", "page")).applyInArrow(
        read, "q long, block long, step long" if trace else "q long, query_id long, neighbor_id long, distance double")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("q", "query_id").orderBy("distance", "neighbor_id")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def open_blocks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_BLOCK).parquet(f"{path}/blocks")


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """The stored chunks, every one, with all their columns."""
    return spark.read.parquet(f"{path}/chunks")


def search_pairs(queries: DataFrame, path: str, k: int, *, query_id: str = "query_id", query_vec: str = "embedding",
                 exclude_self: bool = False, probe: int = 2) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(first, more, found): the (q, block) pairs that are read first, those
    that the triangle inequality leaves after them, and the candidates.  The
    pairs are listed for whoever looks at them only; the search keeps them
    within its tasks."""
    blocks = open_blocks(queries.sparkSession, path)
    head = blocks.select("dim").limit(1).collect()
    q = materialize(_queries(queries, query_id, query_vec, head[0][0] if head else -1), "queries")
    pairs = _search(q, blocks, k, exclude_self, probe, trace=True)
    return (pairs.filter("step = 0").select("q", "block"), pairs.filter("step = 1").select("q", "block"),
            _search(q, blocks, k, exclude_self, probe))


def search_index(queries: DataFrame, path: str, k: int, *, query_id: str = "query_id", query_vec: str = "embedding",
                 exclude_self: bool = False, probe: int = 2) -> DataFrame:
    """Exact top-k by squared L2 distance over a stored index, ties on the
    neighbour's id: (query_id, rank, neighbor_id, distance), as ``knn`` over
    all its rows.  Every distinct (id, vector) of ``queries`` is one query;
    rows with a null id, an unusable vector or another length than the index
    holds take no part, and an empty index answers nothing.

    Tiles of queries meet pages of blocks.  In a page each query reads its
    ``probe`` nearest blocks; the k-th distance found there (none, if they hold
    fewer rows) bounds which others can matter.  Only tiles, pages and a page's
    k best rows a query cross the network, never (query, block) pairs; tiles
    and pages hold ``PAGE`` rows or more, ``MOST_ROWS`` at most, however many
    queries ask for one block."""
    found = search_pairs(queries, path, k, query_id=query_id, query_vec=query_vec, exclude_self=exclude_self, probe=probe)[2]
    return _ranked(found, k).select("query_id", "rank", "neighbor_id", "distance")
