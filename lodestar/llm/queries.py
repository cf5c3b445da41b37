"""Registered queries of this package (``opN_<name>``), with DuckDB SQL where
SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chat_format import conversation_structs, format_chat, read_chat, typed_turns
from .chunk_dedup import repeated_spans
from .common import bounded_batches
from .embed_dedup import embedding_links
from .hard_negatives import hard_negatives
from .line_dedup import dedup_lines
from .mixing import mix_sources
from .piece_sampling import sample_segmentations
from .secret_scan import fit_secrets, scan_secrets, span_text
from .token_counts import length_histogram, token_lengths
from .topk_search import exact_topk, finite_vectors
from .toxicity import fit_severity, score_severity
from .weighted_minhash import near_duplicates
from .whitening import whiten

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@query("op1_embedding_dedup", """
WITH RECURSIVE ok AS (
  SELECT vec_id, [e::DOUBLE FOR e IN embedding] AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len([e FOR e IN embedding IF e IS NULL OR NOT isfinite(e)]) = 0
    AND len([e FOR e IN embedding IF e <> 0]) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.vec_id <> b.vec_id
          AND len(a.x) = len(b.x) AND list_cosine_similarity(a.x, b.x) >= 0.9),
reach(v, r) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT l.b, reach.r FROM reach JOIN links l ON l.a = reach.v),
roots AS (SELECT v, min(r) AS root FROM reach GROUP BY v),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(c.n, 0) AS n_links, r.root AS component_id, e.vec_id = r.root AS kept
FROM embeddings e JOIN roots r ON r.v = e.vec_id LEFT JOIN counts c ON c.a = e.vec_id""")
def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_links(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


@query("op2_minhash_dedup")
def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = near_duplicates(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return classes.select("doc_id", "class_id", "kept")


_CHAT = "regexp_extract_all({0}, '(<\\||<s>|</s>|<<SYS>>|<</SYS>>|\\[INST\\]|\\[/INST\\])')"
_ESCAPED = "(length({0}) + len(string_split({0}, chr(8288))) - 1 + len(" + _CHAT + "))"


@query("op3_chat_format", f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS LAST, role, text) FILTER (WHERE role = 'assistant'), ''))
         AS loss_sha256,
       CAST(sum(23 + {_ESCAPED.format("role")} + {_ESCAPED.format("text")}) AS BIGINT) AS formatted_chars
FROM rows GROUP BY conv_id""")
def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(1).select(F.lit(-7).cast("long").alias("conv_id"), F.explode(F.array(*[
        F.struct(F.lit(i).cast("long").alias("turn"), F.lit(role).alias("role"),
                 F.lit("</s>[INST] ok [/INST]").alias("text")) for i, role in enumerate(("user", "assistant"))]))
        .alias("r")).select("conv_id", "r.*")
    chats = format_chat(typed_turns(conversation_structs(rows.unionByName(probe)), "record"))
    back = chats.select("conv_id", "formatted", "layout", read_chat(F.col("formatted")).alias("back"))
    line = F.transform("back", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.array_join(F.transform(F.filter("back", lambda t: t["role"] == "assistant"), lambda t: t["text"]), "")
    return back.select(
        "conv_id", F.size("back").cast("long").alias("n_turns"), F.sha2(F.array_join(line, ""), 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))


@query("op4_topk_search", """
WITH v AS (SELECT vec_id, [floor(256 * e::DOUBLE) FOR e IN embedding] AS x FROM embeddings
           WHERE embedding IS NOT NULL AND len([e FOR e IN embedding IF e IS NULL OR NOT isfinite(e)]) = 0),
scored AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.x, c.x) AS BIGINT) AS score
           FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
best AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
         FROM scored)
SELECT query_id, rank, vec_id, score FROM best WHERE rank <= 5""")
def op4_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = finite_vectors(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"), "vec_id", "embedding")
    whole = rows.select("vec_id", F.transform(
        "embedding", lambda x: F.floor(F.lit(256.0) * x.cast("double")).cast("long")).alias("vector"))
    return exact_topk(whole.filter(F.col("vec_id") % 50 == 0), whole, k=5)


@query("op5_token_counts")
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return length_histogram(token_lengths(read(spark, sf_dir, "documents")))


@query("op10_toxicity")
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (read(spark, sf_dir, t) for t in ("documents", "labels"))
    model = fit_severity(docs.select("doc_id", "text"), labels)
    return score_severity(docs.select("doc_id", "text"), model).select(
        "doc_id", "severity", "severity_grade", "p_toxic", (F.col("p_toxic") >= 0.5).alias("toxic"))


@query("op6_substring_dedup")
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = repeated_spans(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return spans.select("doc_id", "n_chars", "repeated_chars", "dropped_chars", "dropped_spans",
                        (F.col("repeated_chars") > 0).alias("has_repeats"))


@query("op7_piece_sampling")
def op7_piece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    sampled = sample_segmentations(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return sampled.select("doc_id", "sample", F.size("pieces").cast("long").alias("n_pieces"),
                          F.xxhash64("pieces").alias("pieces_hash"), "log_prob", "score", "log_inclusion", "exact")


@query("op8_mix_sources")
def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mix_sources(read(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mix.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


@query("op9_line_dedup", r"""
WITH parts AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS p FROM documents),
lines AS (SELECT doc_id, unnest(p) AS line, unnest(range(len(p))) AS pos FROM parts),
keyed AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
shared AS (SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40
           GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (SELECT k.doc_id, k.line, k.pos, coalesce(s.keeper <> k.doc_id, false) AS gone
           FROM keyed k LEFT JOIN shared s ON k.key = s.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id""")
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query("op11_secret_scan")
def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    found = scan_secrets(docs, fit_secrets(docs, file_col="source"), file_col="source")

    def many(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", many("assign"), many("access"), many("hex"),
                        F.sha2(span_text("base"), 256).alias("base_sha256"), span_text("spans").alias("spans"))


@query("op12_hard_negatives", """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  [floor(256 * e::DOUBLE) FOR e IN embedding] AS x FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL AND vec_id IS NOT NULL
             AND len([e FOR e IN embedding IF e IS NULL OR NOT isfinite(e)]) = 0),
scored AS (SELECT a.vec_id AS anchor_id, a.label = c.label AS same, c.vec_id,
                  CAST(list_dot_product(a.x, c.x) AS BIGINT) AS score
           FROM v a JOIN v c ON a.vec_id % 100 = 0 AND c.vec_id <> a.vec_id),
pos AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM (
          SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place
          FROM scored WHERE same) WHERE place <= 5),
neg AS (SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
               CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER)
                 AS rank
        FROM pos p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
         AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM neg WHERE rank <= 5""")
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = finite_vectors(read(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"), "vec_id", "embedding")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    whole = rows.select("vec_id", label.alias("label"), F.transform(
        "embedding", lambda x: F.floor(F.lit(256.0) * x.cast("double")).cast("long")).alias("vector"))
    return hard_negatives(whole, F.col("vec_id") % 100 == 0)


@query("op13_whitening")
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
