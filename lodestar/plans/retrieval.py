"""Registered retrieval queries: chunking, corpus statistics, exact kNN over
``embeddings``, context assembly, reranking and hashing embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import retrieval as R
from ..operators import tickets as OT
from ..operators import vector_index as VI
from ..session import shared_dir
from ..sources import files as FS
from ..sources.tables import table
from .registry import ORACLE, register

K_SEARCH = 5      # retrieval depth before rerank
K_CONTEXT = 3     # hits per question context
K_RERANK = 3

_LAST_SQL = "CASE WHEN length(text) <= 500 THEN 0 ELSE CAST(ceil((length(text) - 500) / 400.0) AS BIGINT) END"


@register("chunk_paragraph", """
SELECT doc_id, CAST(pos AS INTEGER) AS pos, chunk FROM (
  SELECT doc_id, unnest(range(0, len(string_split(text, chr(10))))) AS pos,
         unnest(string_split(text, chr(10))) AS chunk FROM documents)""")
def chunk_paragraph(spark, d):
    # The test documents hold no blank lines; the blank-line separator of the
    # reference is covered by unit tests with the same operator.
    return R.split_on(table(spark, d, "documents"), "\n")


@register("chunk_fixed", f"""
SELECT doc_id, CAST(k AS INTEGER) AS pos, substr(text, CAST(k * 400 + 1 AS BIGINT), 500) AS chunk FROM (
  SELECT doc_id, text, unnest(generate_series(0, {_LAST_SQL})) AS k FROM documents)""")
def chunk_fixed(spark, d):
    return R.fixed_chunks(table(spark, d, "documents"))


@register("chunk_recursive")
def chunk_recursive(spark, d):
    return R.recursive_chunks(table(spark, d, "documents"))


@register("chunk_recursive_checks", """
SELECT doc_id, true AS bounded, true AS contained, true AS covering FROM documents
WHERE length(regexp_replace(text, '[ \t\n\r\f\x0B]+', '', 'g')) > 0""")
def chunk_recursive_checks(spark, d):
    """Per document: no chunk over the size, every chunk a part of the text,
    and at least the text's characters in all chunks together."""
    chunks = R.recursive_chunks(table(spark, d, "documents"), keep=("doc_id", "text"))
    solid = "[ \\t\\n\\r\\f\\x0B]+"
    return chunks.groupBy("doc_id").agg(
        F.every(F.length("chunk") <= R.CHUNK_SIZE).alias("bounded"), F.every(F.contains("text", "chunk")).alias("contained"),
        (F.sum(F.length(F.regexp_replace("chunk", solid, ""))) >= F.first(F.length(F.regexp_replace("text", solid, ""))))
        .alias("covering"))


@register("corpus_stats", f"""
WITH per AS (SELECT coalesce(source, 'unknown') AS source, CAST(sum({_LAST_SQL} + 1) AS BIGINT) AS n_chunks
             FROM documents GROUP BY 1)
SELECT source, n_chunks FROM per UNION ALL SELECT '*total*', CAST(sum(n_chunks) AS BIGINT) FROM per""")
def corpus_stats(spark, d):
    docs = table(spark, d, "documents").select("source", R.chunk_count(F.col("text")).alias("n_chunks"))
    return R.chunk_counts(docs)


@register("index_stats", ORACLE["corpus_stats"])
def index_stats(spark, d):
    """Chunks with their vectors persisted as the index, read back and counted
    per source."""
    root = shared_dir(spark, "index")
    chunks = R.fixed_chunks(table(spark, d, "documents"), keep=("doc_id", "source"))
    FS.write_index(R.hashing_embed(chunks, "chunk", dim=16), root + "/index")
    return R.chunk_counts(FS.read_index(spark, root + "/index"))


_PAIRS_SQL = """pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id AS neighbor_id,
         list_sum([(CAST(q.embedding[i] AS DOUBLE) - CAST(c.embedding[i] AS DOUBLE)) ** 2
                   FOR i IN range(1, len(q.embedding) + 1)]) AS distance
  FROM embeddings q JOIN embeddings c ON q.vec_id <> c.vec_id),
ranked AS (SELECT query_id, neighbor_id, distance,
                  CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id) AS INTEGER) AS rank
           FROM pairs)"""


def _knn(spark, d, k):
    e = table(spark, d, "embeddings")
    return R.knn(e.select(F.col("vec_id").alias("query_id"), "embedding"),
                 e.select(F.col("vec_id").alias("id"), "embedding"), k, exclude_self=True)


@register("knn_topk", "WITH " + _PAIRS_SQL + f"""
SELECT query_id, rank, neighbor_id, round(distance, 6) AS distance FROM ranked WHERE rank <= {K_SEARCH}""")
def knn_topk(spark, d):
    return _knn(spark, d, K_SEARCH).withColumn("distance", F.round("distance", 6))


@register("index_search", ORACLE["knn_topk"])
def index_search(spark, d):
    """The vectors stored as an index, and the same search through it after
    it was opened again."""
    path = shared_dir(spark, "vector-index")
    e = table(spark, d, "embeddings")
    VI.build_index(e.select(F.col("vec_id").alias("id"), "label", "embedding"), path, block_rows=64)
    hits = VI.search_index(VI.read_chunks(spark, path).select(F.col("id").alias("query_id"), "embedding"), path, K_SEARCH,
                           exclude_self=True)
    return hits.withColumn("distance", F.round("distance", 6))


SHIFT = 1_000_000_000


@register("knn_ties", "WITH " + _PAIRS_SQL.split(",\nranked")[0] + f""",
copies AS (SELECT query_id, neighbor_id + j * CAST({SHIFT} AS BIGINT) AS neighbor_id, distance
           FROM (SELECT query_id, neighbor_id, distance FROM pairs
                 UNION ALL SELECT vec_id, vec_id, 0.0 FROM embeddings) CROSS JOIN range(0, 21) t(j)),
near AS (SELECT query_id, neighbor_id, distance,
                CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id) AS INTEGER) AS rank
         FROM copies WHERE neighbor_id <> query_id)
SELECT query_id, rank, neighbor_id, round(distance, 6) AS distance FROM near WHERE rank <= {K_SEARCH}""")
def knn_ties(spark, d):
    """Every vector stands 21 times in the corpus: ties on the id decide."""
    e = table(spark, d, "embeddings")
    corpus = e.select("vec_id", "embedding", F.explode(F.sequence(F.lit(0), F.lit(20))).alias("j")).select(
        (F.col("vec_id") + F.col("j") * F.lit(SHIFT).cast("long")).alias("id"), "embedding")
    hits = R.knn(e.select(F.col("vec_id").alias("query_id"), "embedding"), corpus, K_SEARCH, exclude_self=True)
    return hits.withColumn("distance", F.round("distance", 6))


@register("retrieval_context", "WITH " + _PAIRS_SQL + f"""
, hits AS (SELECT r.query_id, r.rank, doc.text, doc.source FROM ranked r
           LEFT JOIN documents doc ON doc.doc_id = r.neighbor_id WHERE r.rank <= {K_CONTEXT})
SELECT query_id,
       string_agg(coalesce(text, ''), chr(10) ORDER BY rank) AS context,
       coalesce(string_agg(DISTINCT CASE WHEN length(source) > 0 THEN source END, ',' ORDER BY
                CASE WHEN length(source) > 0 THEN source END), '') AS citations
FROM hits GROUP BY query_id""")
def retrieval_context(spark, d):
    hits = _knn(spark, d, K_CONTEXT)
    ctx = R.assemble_context(hits, table(spark, d, "documents"))
    return ctx.select("query_id", "context", F.array_join("citations", ",").alias("citations"))


@register("law_prompt", f"""SELECT c.query_id, 'Rules:' || chr(10) || c.context || chr(10) || 'Question: ' || coalesce(q.text, '')
  || chr(10) || 'Reply as JSON: {{"answer": "...", "citations": ["..."]}}' AS prompt
FROM ({ORACLE["retrieval_context"]}) c LEFT JOIN documents q ON q.doc_id = c.query_id""")
def law_prompt(spark, d):
    """Questions with their retrieved rules, asking for a JSON answer."""
    docs = table(spark, d, "documents")
    ctx = R.assemble_context(_knn(spark, d, K_CONTEXT), docs)
    asked = ctx.join(docs.select(F.col("doc_id").alias("query_id"), F.col("text").alias("question")), "query_id", "left")
    return asked.select("query_id", OT.law_prompt(F.col("question"), F.col("context")).alias("prompt"))


_TOK_SQL = "list_distinct(list_filter(regexp_split_to_array(lower({t}), '[^\\p{{L}}\\p{{N}}]+'), lambda x: length(x) > 0))"


@register("rerank_topk", "WITH " + _PAIRS_SQL + f"""
, cand AS (SELECT * FROM ranked WHERE rank <= {K_SEARCH})
, scored AS (
  SELECT c.query_id, c.neighbor_id, c.rank AS knn_rank,
         CAST(len(list_intersect({_TOK_SQL.format(t='qd.text')}, {_TOK_SQL.format(t='cd.text')})) AS INTEGER) AS score
  FROM cand c JOIN documents qd ON qd.doc_id = c.query_id JOIN documents cd ON cd.doc_id = c.neighbor_id)
SELECT query_id, rerank, neighbor_id, score, knn_rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, knn_rank) AS INTEGER) AS rerank
  FROM scored) WHERE rerank <= {K_RERANK}""")
def rerank_topk(spark, d):
    docs = table(spark, d, "documents")
    cands = _knn(spark, d, K_SEARCH)
    return R.lexical_rerank(cands, docs.select(F.col("doc_id").alias("query_id"), "text"),
                            docs.select("doc_id", "text"), top=K_RERANK)


@register("embed_hashing")
def embed_hashing(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    return R.hashing_embed(docs).select("doc_id", "embedding")


_BUCKETS_SQL = ("[CAST('0x' || substr(md5(t), 1, 4) AS INTEGER) % {dim} FOR t IN "
                "list_filter(regexp_split_to_array(lower(coalesce({text}, '')), '[^\\p{{L}}\\p{{N}}]+'), lambda x: length(x) > 0)]")
_COUNTS_SQL = "[CAST(len(list_filter({b}, lambda x: x = i)) AS DOUBLE) FOR i IN range(0, {dim})]"


def token_vector_ctes(name: str, source: str, keys: str, text: str, dim: int) -> str:
    """CTEs ``name``_b and ``name``: (keys, v) term counts by md5 bucket."""
    return (f"{name}_b AS (SELECT {keys}, {_BUCKETS_SQL.format(dim=dim, text=text)} AS b FROM {source}), "
            f"{name} AS (SELECT {keys}, {_COUNTS_SQL.format(b='b', dim=dim)} AS v FROM {name}_b)")


@register("embed_tokens", f"""WITH {token_vector_ctes('e', 'documents', 'doc_id', 'text', 64)},
n AS (SELECT doc_id, v, sqrt(list_sum([x * x FOR x IN v])) AS norm FROM e)
SELECT doc_id, [round(CASE WHEN norm > 0 THEN x / norm ELSE x END, 9) FOR x IN v] AS embedding FROM n""")
def embed_tokens(spark, d):
    """Unit vectors of whole documents by token buckets."""
    docs = R.token_hash_embed(table(spark, d, "documents").select("doc_id", "text"))
    return docs.select("doc_id", F.transform("embedding", lambda x: F.round(x, 9)).alias("embedding"))


_ST = "regexp_replace({x}, '^[ \\t\\n\\r\\f\\x0B\\x{{3000}}]+|[ \\t\\n\\r\\f\\x0B\\x{{3000}}]+$', '', 'g')"


@register("retrieval_hits", "WITH " + _PAIRS_SQL + f"""
SELECT r.query_id, r.rank, r.neighbor_id, doc.source,
       substr({_ST.format(x='doc.text')}, 1, 100) || '...' AS preview
FROM ranked r LEFT JOIN documents doc ON doc.doc_id = r.neighbor_id WHERE r.rank <= {K_CONTEXT}""")
def retrieval_hits(spark, d):
    hits = _knn(spark, d, K_CONTEXT)
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("neighbor_id"), F.col("text").alias("chunk"), "source")
    return hits.join(docs, "neighbor_id", "left").select("query_id", "rank", "neighbor_id", "source",
                                                         R.hit_preview("chunk").alias("preview"))


_RERANK_CTE = f"""
, cand AS (SELECT * FROM ranked WHERE rank <= {K_SEARCH})
, scored AS (
  SELECT c.query_id, c.neighbor_id, c.rank AS knn_rank,
         CAST(len(list_intersect({_TOK_SQL.format(t='qd.text')}, {_TOK_SQL.format(t='cd.text')})) AS INTEGER) AS score
  FROM cand c JOIN documents qd ON qd.doc_id = c.query_id JOIN documents cd ON cd.doc_id = c.neighbor_id)
, rr AS (SELECT * FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, knn_rank) AS INTEGER) AS rerank
  FROM scored) WHERE rerank <= {K_RERANK})"""


@register("rag_prompt", "WITH " + _PAIRS_SQL + _RERANK_CTE + """
, ctx AS (SELECT rr.query_id, string_agg(coalesce(cd.text, ''), chr(10) || chr(10) ORDER BY rr.rerank) AS context
          FROM rr LEFT JOIN documents cd ON cd.doc_id = rr.neighbor_id GROUP BY rr.query_id)
SELECT ctx.query_id, '<passages>' || chr(10) || coalesce(ctx.context, '') || chr(10) || '</passages>' || chr(10) || 'Q: '
       || coalesce(q.text, '') || chr(10) || 'A (from the passages alone; say so if they do not tell): ' AS prompt
FROM ctx LEFT JOIN documents q ON q.doc_id = ctx.query_id""")
def rag_prompt(spark, d):
    docs = table(spark, d, "documents")
    top = R.lexical_rerank(_knn(spark, d, K_SEARCH), docs.select(F.col("doc_id").alias("query_id"), "text"),
                           docs.select("doc_id", "text"), top=K_RERANK)
    texts = top.join(docs.select(F.col("doc_id").alias("neighbor_id"), "text"), "neighbor_id", "left")
    ctx = R.ordered_join(texts, "query_id", "rerank", "text", "\n\n")
    q = docs.select(F.col("doc_id").alias("query_id"), F.col("text").alias("question"))
    return ctx.join(q, "query_id", "left").select("query_id", R.answer_prompt(F.col("question"), F.col("context"))
                                                  .alias("prompt"))
