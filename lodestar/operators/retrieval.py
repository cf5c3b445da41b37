"""Document retrieval: chunking, embedding hooks, exact k-nearest-neighbour
search, context assembly and reranking.

Search is exact and fully distributed: queries and corpus are cut into
blocks of bounded size, every (query block, corpus block) pair meets in one
task, the task scores the block pair with a numpy matrix product and emits
only the k best corpus rows per query.  A final windowed top-k merges the
per-block candidates.  No task ever holds more than two blocks, and no step
emits all pairs."""

from __future__ import annotations

import hashlib
import math
import re
from typing import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import strip
from ..session import ensure_checkpoint_dir, materialize

# Fixed values taken from the reference's chunking setup.
CHUNK_SIZE = 500
CHUNK_OVERLAP = 100
RECURSIVE_SEPARATORS = ["\n\n", "\n", " ", ""]


# ---------------------------------------------------------------- chunking
def split_on(df: DataFrame, sep: str, text_col: str = "text", keep=("doc_id",)) -> DataFrame:
    """Split text on a literal separator; keeps empty pieces and the
    position of each piece (``posexplode`` keeps order)."""
    pieces = F.split(F.col(text_col), re.escape(sep).replace("\\\n", "\n"), -1)
    return df.select(*keep, F.posexplode(pieces).alias("pos", "chunk"))


def fixed_chunks(df: DataFrame, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP,
                 text_col: str = "text", keep=("doc_id",)) -> DataFrame:
    """Character windows of ``size`` with ``overlap``: starts 0, step,
    2*step, ... until the window reaches the end of the text."""
    step = size - overlap
    last = chunk_count(F.col(text_col), size, overlap) - 1
    starts = F.sequence(F.lit(0), last.cast("int"))
    return (df.select(*keep, F.col(text_col), F.posexplode(starts).alias("pos", "_k"))
            .select(*keep, "pos", F.expr(f"substring({text_col}, _k * {step} + 1, {size})").alias("chunk")))


def chunk_count(text: Column, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> Column:
    """Number of ``fixed_chunks`` of a text, by arithmetic alone."""
    n = F.length(text)
    return F.when(n <= size, F.lit(1)).otherwise(F.ceil((n - size) / F.lit(size - overlap)) + 1).cast("long")


def _split_keep_start(text: str, sep: str) -> list[str]:
    """Split keeping each separator at the start of the following piece."""
    if sep == "":
        return [ch for ch in text]
    parts = text.split(sep)
    out = [parts[0]] + [sep + p for p in parts[1:]]
    return [p for p in out if p != ""]


def _merge(pieces: list[str], size: int, overlap: int) -> list[str]:
    """Greedy merge of small pieces into chunks of at most ``size``
    characters, carrying up to ``overlap`` characters of trailing pieces."""
    chunks, window, total = [], [], 0
    for p in pieces:
        if total + len(p) > size and window:
            text = "".join(window).strip()
            if text:
                chunks.append(text)
            while window and (total > overlap or total + len(p) > size):
                total -= len(window[0])
                window.pop(0)
        window.append(p)
        total += len(p)
    text = "".join(window).strip()
    if text:
        chunks.append(text)
    return chunks


def recursive_split(text: str, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP,
                    separators: Sequence[str] = RECURSIVE_SEPARATORS) -> list[str]:
    """Split on the first separator present, recurse into pieces that are
    still too long with the remaining separators, merge the rest greedily."""
    seps = list(separators)
    sep, rest = seps[-1], []
    for i, s in enumerate(seps):
        if s == "" or s in text:
            sep, rest = s, seps[i + 1:]
            break
    out, small = [], []
    for piece in _split_keep_start(text, sep):
        if len(piece) < size:
            small.append(piece)
            continue
        if small:
            out.extend(_merge(small, size, overlap))
            small = []
        if rest:
            out.extend(recursive_split(piece, size, overlap, rest))
        else:
            out.append(piece)
    if small:
        out.extend(_merge(small, size, overlap))
    return out


def recursive_chunks(df: DataFrame, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP,
                     text_col: str = "text", keep=("doc_id",)) -> DataFrame:
    """Recursive character chunking.  The per-text rule is sequential, so it
    runs as an Arrow-batched pandas UDF; Spark partitions the documents."""

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def _chunks(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: recursive_split(t, size, overlap) if isinstance(t, str) else [])

    return df.select(*keep, F.posexplode(_chunks(F.col(text_col))).alias("pos", "chunk"))


# ---------------------------------------------------------------- embedding
def tokens(c) -> "F.Column":
    """Lower-cased word tokens (letters and digits), empties removed."""
    col = F.col(c) if isinstance(c, str) else c
    # array_remove is code-generated; a lambda filter would be interpreted per token
    return F.array_remove(F.split(F.lower(col), "[^\\p{L}\\p{N}]+"), "")


def hashing_embed(df: DataFrame, text_col: str = "text", dim: int = 64,
                  out_col: str = "embedding") -> DataFrame:
    """Built-in text -> unit vector: hashed term frequencies (Spark ML
    ``HashingTF``) normalised to L2 length 1 (``Normalizer``), returned as
    ``array<float>``.  All JVM-side."""
    from pyspark.ml.feature import HashingTF, Normalizer
    from pyspark.ml.functions import vector_to_array

    tmp = df.withColumn("_tok", tokens(F.coalesce(F.col(text_col), F.lit(""))))  # NULL text: no tokens
    tf = HashingTF(inputCol="_tok", outputCol="_tf", numFeatures=dim).transform(tmp)
    nz = Normalizer(inputCol="_tf", outputCol="_nv", p=2.0).transform(tf)
    return nz.withColumn(out_col, vector_to_array("_nv", "float32")).drop("_tok", "_tf", "_nv")


def token_hash_embed(df: DataFrame, text_col: str = "text", dim: int = 64, out_col: str = "embedding",
                     normalize: bool = True) -> DataFrame:
    """Text -> term counts by a bucket of each token's md5, a hash that every
    engine has; of unit length if ``normalize`` (a text without tokens stays
    zero), else whole numbers.  NULL text has no tokens.  Tokens are cut in the
    JVM and counted a batch at a time."""

    @F.arrow_udf("array<double>")
    def vectors(words: pa.Array) -> pa.Array:
        known = words.flatten().cast(pa.binary()).dictionary_encode()  # each distinct token of a batch is hashed once
        marks = (hashlib.md5(w).digest() for w in known.dictionary.to_pylist())
        bucket = np.fromiter((((m[0] << 8) | m[1]) % dim for m in marks), np.int64, len(known.dictionary))
        row = np.repeat(np.arange(len(words)), pc.list_value_length(words).to_numpy(zero_copy_only=False))
        counts = np.bincount(row * dim + bucket[known.indices.to_numpy()], minlength=len(words) * dim).astype(np.float64)
        counts = counts.reshape(len(words), dim)
        if normalize:
            norm = np.sqrt((counts * counts).sum(1))[:, None]
            counts = np.divide(counts, norm, out=counts, where=norm > 0)
        return pa.ListArray.from_arrays(np.arange(len(words) + 1, dtype=np.int32) * dim, counts.reshape(-1))

    return df.withColumn(out_col, vectors(tokens(F.coalesce(F.col(text_col), F.lit("")))))


def embed_with(df: DataFrame, load: Callable[[], Callable[[list[str]], np.ndarray]], dim: int, text_col: str = "text",
               out_col: str = "embedding", normalize: bool = True, error_col: str = "embed_error") -> DataFrame:
    """User model hook: ``load`` runs once per partition inside the task and
    returns a function from a batch of texts to a (n, dim) matrix.  A row
    that fails on its own has a NULL vector and its error."""
    from .tickets import model_hook

    def unit(row) -> list[float]:
        v = np.asarray(row, dtype=np.float32).reshape(dim)
        norm = float(np.linalg.norm(v)) if normalize else 0.0
        return (v / norm if norm > 0 else v).tolist()

    return model_hook(df.withColumn(text_col, F.coalesce(text_col, F.lit(""))), load, [text_col], out_col,
                      T.ArrayType(T.FloatType()), error_col, unit)


# ---------------------------------------------------------------- search
def valid_vectors(df: DataFrame, vec_col: str, dim: int | None = None) -> Column:
    """Condition: the vector is not NULL or empty, holds finite components
    only, and has ``dim`` of them (if given)."""
    v = F.col(vec_col)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    ok = v.isNotNull() & (F.size(v) > 0) & ~bad
    return ok & (F.size(v) == dim) if dim is not None else ok


def vector_rejects(df: DataFrame, id_col: str, vec_col: str, dim: int) -> DataFrame:
    """(id, reason) of the rows that a search over ``dim`` components leaves
    out: the rejects report of ``knn``."""
    v = F.col(vec_col)
    reason = (F.when(F.col(id_col).isNull(), "no id").when(v.isNull(), "no vector").when(F.size(v) != dim, "other length")
              .when(~valid_vectors(df, vec_col), "component not finite"))
    return df.select(F.col(id_col).alias("id"), reason.alias("reason")).filter(F.col("reason").isNotNull())


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


class _Vectors:
    """Distinct vectors of a piece of the corpus, each with the ids that can be
    answers.

    After at most ``k`` rows of one id, the 2 k smallest ids of a vector are
    all that can be answers to a query, its own id left out."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, k: int):
        rows = rows + 0.0  # one zero
        keys = np.ascontiguousarray(rows).view(np.dtype((np.void, rows.itemsize * rows.shape[1])))[:, 0]
        _, first, group = np.unique(keys, return_index=True, return_inverse=True)
        order = np.lexsort((ids, group))
        group, ids = group[order], ids[order]

        def turn(new: np.ndarray) -> np.ndarray:
            start = np.flatnonzero(new)
            return np.arange(len(new)) - np.repeat(start, np.diff(np.append(start, len(new))))
        fresh = np.append(True, group[1:] != group[:-1])
        keep = turn(fresh | np.append(True, ids[1:] != ids[:-1])) < k
        group, ids = group[keep], ids[keep]
        keep = turn(np.append(True, group[1:] != group[:-1])) < 2 * k
        group, self.ids = group[keep], ids[keep]
        self.n = np.bincount(group, minlength=len(first))
        self.start = np.cumsum(self.n) - self.n
        self.rows = rows[first]
        self.squares = (self.rows ** 2).sum(1)
        self.sole = self.ids[self.start] == self.ids[self.start + self.n - 1]  # vectors of one id

    def __len__(self) -> int:
        return len(self.rows)


class _Best:
    """The k nearest (distance, id) of every query of a block so far."""

    def __init__(self, qid: np.ndarray, Q: np.ndarray, k: int, exclude_self: bool):
        self.qid, self.Q, self.k, self.exclude_self = qid, Q, k, exclude_self
        self.squares = (Q * Q).sum(1)
        self.distance = np.full((len(qid), k), np.inf)
        self.ids = np.full((len(qid), k), np.iinfo(np.int64).max)

    def add(self, row: np.ndarray, distance: np.ndarray, ids: np.ndarray) -> None:
        at, place = np.unique(row, return_inverse=True)
        r = np.concatenate([np.repeat(np.arange(len(at)), self.k), place])
        d, i = np.concatenate([self.distance[at].reshape(-1), distance]), np.concatenate([self.ids[at].reshape(-1), ids])
        order = np.lexsort((i, d, r))
        r = r[order]
        kept = order[np.arange(len(r)) - np.searchsorted(r, np.arange(len(at)))[r] < self.k]
        self.distance[at], self.ids[at] = d[kept].reshape(-1, self.k), i[kept].reshape(-1, self.k)

    def meet(self, seen: np.ndarray, v: _Vectors, part: int = 512, cut: int = 2048) -> None:
        """Queries ``seen`` (indices) against the vectors, exactly.

        The matrix form only shortlists: what lies within the k-th distance
        known so far plus a bound on its rounding error stays, and the
        differences themselves decide."""
        for s in range(0, len(seen), part):
            at = seen[s:s + part]
            qq, wide = self.squares[at], np.column_stack([self.Q[at], np.ones(len(at))])
            for c in range(0, len(v), cut):
                C, cc = v.rows[c:c + cut], v.squares[c:c + cut]
                approx = wide @ np.column_stack([-2.0 * C, cc]).T  # less the query's own square
                limit = self.distance[at, -1] - qq
                slack = 1e-9 * (qq + cc.max()) + 1e-300
                new = np.flatnonzero(np.isinf(limit))
                if len(new) and len(C) >= self.k:
                    far = approx[new]
                    if self.exclude_self:
                        own = v.ids[v.start[c:c + cut]]
                        far[(self.qid[at[new]][:, None] == own[None, :]) & v.sole[None, c:c + cut]] = np.inf
                    limit[new] = np.partition(far, self.k - 1, axis=1)[:, self.k - 1]
                row, col = np.divmod(np.flatnonzero(approx <= (limit + 2 * slack)[:, None]), len(C))
                for i in range(0, len(row), 32768):
                    r, w = row[i:i + 32768], col[i:i + 32768]
                    exact = ((self.Q[at[r]] - C[w]) ** 2).sum(1)
                    n = v.n[c + w]
                    spread = np.repeat(np.arange(len(r)), n)
                    ids = v.ids[np.repeat(v.start[c + w], n) + np.arange(len(spread)) - np.repeat(np.cumsum(n) - n, n)]
                    near = at[r[spread]]
                    keep = ids != self.qid[near] if self.exclude_self else slice(None)
                    self.add(near[keep], exact[spread][keep], ids[keep])

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(index of the query, neighbour id, distance)."""
        row, col = np.nonzero(np.isfinite(self.distance))
        return row, self.ids[row, col], self.distance[row, col]


def _nearest(qid: np.ndarray, Q: np.ndarray, cid: np.ndarray, C: np.ndarray, k: int,
             exclude_self: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of the query, neighbour id, distance): the k nearest rows of one
    corpus block for every query, ties on neighbour id, exactly."""
    best = _Best(qid, Q, k, exclude_self)
    if len(qid) and len(cid):
        best.meet(np.arange(len(qid)), _Vectors(cid, C, k))
    return best.found()


_CAND = "q long, neighbor_id long, distance double"


def knn(queries: DataFrame, corpus: DataFrame, k: int, query_id: str = "query_id",
        query_vec: str = "embedding", corpus_id: str = "id", corpus_vec: str = "embedding",
        exclude_self: bool = False, block_rows: int = 4096, broadcast_bytes: int = 2 << 20,
        candidate_rows: int = 20_000_000) -> DataFrame:
    """Exact top-k by squared L2 distance, ties on neighbour id:
    ``query_id, rank, neighbor_id, distance``.

    Every distinct (id, vector) of ``queries`` is one query, so an id that
    stands for two vectors gets k rows for each.  Rows with a NULL id, a NULL
    vector, a component that is not finite, or another length than the first
    usable query take no part; ``vector_rejects`` reports them.

    Both plans score with the same rule and give the same rows.  Where the
    queries are few (their bytes, and the k rows a query that every corpus
    partition returns, within ``broadcast_bytes`` and ``candidate_rows``),
    they are broadcast and each corpus partition is scored where it lies.
    Otherwise copies of a vector are brought together first, with the ids that
    can be answers; then both sides are cut into blocks and each pair of
    blocks meets in one task.  A block holds ``block_rows`` rows, up to
    ``BLOCKS`` blocks a side, beyond that as many more as keep to that number
    of blocks, and ``MOST_ROWS`` at most: a side is copied once per block of
    the other, the inherent cost of an exact search."""
    spark = queries.sparkSession
    usable = queries.filter(F.col(query_id).isNotNull() & valid_vectors(queries, query_vec))
    head = usable.select(F.size(query_vec)).limit(1).collect()
    if not head:
        return spark.createDataFrame([], "query_id long, rank int, neighbor_id long, distance double")
    dim = head[0][0]
    q = usable.filter(F.size(query_vec) == dim).select(
        F.col(query_id).cast("long").alias("qid"), _exact(queries, query_vec).alias("qv")).distinct()
    c = corpus.filter(F.col(corpus_id).isNotNull() & valid_vectors(corpus, corpus_vec, dim)).select(
        F.col(corpus_id).cast("long").alias("cid"), _exact(corpus, corpus_vec).alias("cv"))
    few = max(0, min(broadcast_bytes // (8 * dim), candidate_rows // (k * max(1, c.rdd.getNumPartitions()))))
    probe = q.limit(few + 1).toPandas() if few else None  # one bounded read; all of it is used if it is all there is
    if probe is not None and len(probe) <= few:
        vectors = np.stack(probe["qv"].to_numpy()).astype(np.float64)
        ids = probe["qid"].to_numpy(np.int64)
        known = spark.sparkContext.broadcast((ids, vectors))

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best = _Best(*known.value, k, exclude_self)
            every = np.arange(len(best.qid))
            for batch in batches:
                if len(batch):
                    best.meet(every, _Vectors(batch.column(0).to_numpy(), _matrix(batch.column(1)), k))
            found = best.found()
            if len(found[0]):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=["q", "neighbor_id", "distance"])

        cand = c.mapInArrow(scan, _CAND)
        names = spark.createDataFrame(pd.DataFrame({"q": np.arange(len(ids)), "query_id": ids}))
        named = _ranked(cand, k).join(F.broadcast(names), "q")  # bounded by the same check
        return named.select("query_id", "rank", "neighbor_id", "distance")

    q = materialize(q.withColumn("q", F.xxhash64("qid", "qv")), "queries")
    c = materialize(_copies_together(c, k), "corpus")
    nq, nc = q.count(), c.count()
    qb, cb = (_blocks(n, block_rows) for n in (nq, nc))
    # a query's key is a hash of all it is: two vectors of one id stay apart
    left = (q.withColumn("qb", F.pmod(F.col("q"), F.lit(qb)).cast("int"))
            .withColumn("cb", F.explode(F.sequence(F.lit(0), F.lit(cb - 1)))))
    right = (c.withColumn("cb", F.pmod(F.xxhash64("cv"), F.lit(cb)).cast("int"))
             .withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(qb - 1)))))

    def pair(a: pa.Table, b: pa.Table) -> pa.Table:
        found = [np.zeros(0, np.int64)] * 3 + [np.zeros(0)]
        if len(a) and len(b):
            qid, lists = a["qid"].to_numpy(), b["cids"].combine_chunks()
            vectors = np.repeat(_matrix(b["cv"]), np.diff(lists.offsets.to_numpy()), axis=0)
            row, near, distance = _nearest(qid, _matrix(a["qv"]), lists.flatten().to_numpy(), vectors, k, exclude_self)
            found = [a["q"].to_numpy()[row], qid[row], near, distance]
        return pa.table([pa.array(x) for x in found], names=["q", "query_id", "neighbor_id", "distance"])

    cand = left.groupBy("qb", "cb").cogroup(right.groupBy("qb", "cb")).applyInArrow(
        pair, "q long, query_id long, neighbor_id long, distance double")
    return _ranked(cand, k, "query_id").select("query_id", "rank", "neighbor_id", "distance")


BLOCKS, MOST_ROWS = 16, 32768


def _blocks(rows: int, block_rows: int) -> int:
    """Number of blocks of one side: of ``block_rows`` rows up to ``BLOCKS`` of
    them, then of more rows each, ``MOST_ROWS`` at most."""
    return max(1, min(math.ceil(rows / block_rows), max(BLOCKS, math.ceil(rows / MOST_ROWS))))


def _exact(df: DataFrame, vec_col: str) -> Column:
    """The vector as it is if its components are floats, else as doubles."""
    kind = df.schema[vec_col].dataType
    narrow = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)
    return F.col(vec_col) if narrow else F.col(vec_col).cast("array<double>")


def _copies_together(corpus: DataFrame, k: int) -> DataFrame:
    """(cv, cids): each distinct vector once, with the ids that can be answers:
    of at most ``k`` rows of one id the 2 k smallest (see ``_Vectors``)."""
    key = F.xxhash64("cv")  # sorts first, so that whole vectors are compared only with copies
    of_id = Window.partitionBy("key", "cv", "cid").orderBy("key")
    of_vector = Window.partitionBy("key", "cv").orderBy("cid")
    rows = corpus.withColumn("key", key).withColumn("n", F.row_number().over(of_id)).filter(F.col("n") <= k)
    rows = rows.withColumn("n", F.row_number().over(of_vector)).filter(F.col("n") <= 2 * k)
    return rows.groupBy("key", "cv").agg(F.collect_list("cid").alias("cids")).select("cv", "cids")


def _ranked(cand: DataFrame, k: int, *more: str) -> DataFrame:
    w = Window.partitionBy("q", *more).orderBy("distance", "neighbor_id")
    return cand.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


# ---------------------------------------------------------------- assembly
def assemble_context(hits: DataFrame, docs: DataFrame, sep: str = "\n", doc_id: str = "doc_id",
                     text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Per query: hit texts joined in rank order, and the sorted distinct
    non-blank sources cited.  The per-query list is bounded by k."""
    j = hits.join(docs.select(F.col(doc_id).alias("neighbor_id"), F.col(text_col).alias("_text"),
                              F.col(source_col).alias("_src")), "neighbor_id", "left")
    return (j.groupBy("query_id").agg(
        F.array_sort(F.collect_list(F.struct("rank", "_text"))).alias("_hits"),
        F.array_sort(F.collect_set(F.when(~(F.coalesce(F.length("_src"), F.lit(0)) == 0), F.col("_src"))))
        .alias("citations"))
        .select("query_id",
                F.array_join(F.transform("_hits", lambda h: F.coalesce(h["_text"], F.lit(""))), sep).alias("context"),
                "citations"))


def lexical_rerank(cands: DataFrame, query_text: DataFrame, cand_text: DataFrame, top: int = 3) -> DataFrame:
    """Score (query, candidate) pairs by the number of distinct shared word
    tokens, keep the ``top`` best per query (ties: earlier retrieval rank)."""
    # k rows a query, read three times below: the search behind them runs once
    ensure_checkpoint_dir(cands.sparkSession)
    cands = cands.checkpoint()
    # tokenize only texts the candidates reference, each once (semi join first)
    qids = cands.select("query_id").distinct()
    nids = cands.select(F.col("neighbor_id").alias("doc_id")).distinct()
    qtok = query_text.join(qids, "query_id", "left_semi").select(
        "query_id", F.array_distinct(tokens("text")).alias("_qt"))
    ctok = cand_text.join(nids, "doc_id", "left_semi").select(
        F.col("doc_id").alias("neighbor_id"), F.array_distinct(tokens("text")).alias("_ct"))
    j = cands.join(qtok, "query_id").join(ctok, "neighbor_id")
    scored = j.withColumn("score", F.size(F.array_intersect("_qt", "_ct")))
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), F.col("rank"))
    return (scored.withColumn("rerank", F.row_number().over(w)).filter(F.col("rerank") <= top)
            .select("query_id", "rerank", "neighbor_id", "score", F.col("rank").alias("knn_rank")))


def chunk_counts(chunks: DataFrame, source_col: str = "source", unknown: str = "unknown") -> DataFrame:
    """Chunks per source (missing source -> ``unknown``) plus a total row;
    rows are chunks, or documents with their ``n_chunks``."""
    how_many = F.sum("n_chunks") if "n_chunks" in chunks.columns else F.count(F.lit(1))
    per = chunks.groupBy(F.coalesce(F.col(source_col), F.lit(unknown)).alias("source")).agg(how_many.alias("n_chunks"))
    total = per.agg(F.sum("n_chunks").cast("long").alias("n_chunks")).select(F.lit("*total*").alias("source"),
                                                                             "n_chunks")
    return per.unionByName(total)


def hit_preview(text_col: str = "chunk", max_chars: int = 100) -> "F.Column":
    """Hit preview: first 100 characters with ``...`` always appended."""
    return F.concat(F.substring(strip(text_col), 1, max_chars), F.lit("..."))


def answer_prompt(question, context) -> "F.Column":
    """Question-answering prompt: passages between markers first, then the
    question and how to answer."""
    return F.concat(F.lit("<passages>\n"), F.coalesce(context, F.lit("")), F.lit("\n</passages>\nQ: "),
                    F.coalesce(question, F.lit("")), F.lit("\nA (from the passages alone; say so if they do not tell): "))


def ordered_join(df: DataFrame, key: str, order_col: str, text_col: str, sep: str) -> DataFrame:
    """Per key: texts joined in ``order_col`` order (groups bounded by k)."""
    return df.groupBy(key).agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct(F.col(order_col).alias("o"), F.col(text_col).alias("t")))),
        lambda x: F.coalesce(x["t"], F.lit(""))), sep).alias("context"))
