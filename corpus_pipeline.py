"""Corpus pipeline: the stages that turn ``documents`` into sampled pieces.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``; its result is written as
Parquet and read again as the next one's ``docs``.  All but the last return
the columns of ``documents``; rows with null ids, texts or sources go through
every stage, and no rows give no rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.llm.common import bounded_batches, materialize
from lodestar.llm.line_dedup import dedup_lines
from lodestar.llm.mixing import mix_sources
from lodestar.llm.piece_sampling import sample_segmentations
from lodestar.llm.toxicity import fit_severity, score_severity
from lodestar.llm.weighted_minhash import near_duplicates

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
REJECT = 0.5  # probability of severity grade 1 or more


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are more likely toxic than not go."""
    bounded_batches(spark)
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    model = fit_severity(docs.select("doc_id", "text"), labels)
    return score_severity(docs.select(COLUMNS), model).filter(F.col("p_toxic") < REJECT).select(COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share go; ``n_chars`` follows the text."""
    kept = dedup_lines(docs.select(COLUMNS))
    return kept.withColumn("n_chars", F.char_length("text").cast("long")).select(COLUMNS)


def minhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    bounded_batches(spark)
    kept = near_duplicates(docs.select("doc_id", "text")).filter("kept").select("doc_id", "text_hash")
    hashed = docs.select(COLUMNS).withColumn("__hash", F.xxhash64("text"))
    return hashed.alias("d").join(kept.alias("k"), F.col("d.doc_id").eqNullSafe(F.col("k.doc_id")) & (
        F.col("d.__hash") == F.col("k.text_hash"))).select("d.*").dropDuplicates(["doc_id", "__hash"]).select(COLUMNS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stands as often as the mix takes it (0 to 2 times)."""
    mix = mix_sources(docs.select(COLUMNS)).select("doc_id", "text_hash", "copies", F.col("source").alias("__source"))
    # equal rows are one row here that stands for all their copies
    mix = mix.groupBy("doc_id", "text_hash", "__source").agg(F.sum("copies").alias("copies")).filter("copies > 0")
    hashed = docs.select(COLUMNS).withColumn("__hash", F.xxhash64("text"))
    taken = hashed.alias("d").join(mix.alias("m"), F.col("d.doc_id").eqNullSafe(F.col("m.doc_id"))
                                   & (F.col("d.__hash") == F.col("m.text_hash"))
                                   & F.col("d.source").eqNullSafe(F.col("m.__source")))
    one = taken.select("d.*", "m.copies").dropDuplicates(["doc_id", "__hash", "source"])
    return one.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(COLUMNS)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Two sampled segmentations of each document's whole text."""
    bounded_batches(spark)
    return sample_segmentations(docs.select("doc_id", "text")).select(
        "doc_id", "sample", "pieces", "log_prob", "log_inclusion", "exact")


STAGES = [("toxicity", toxicity), ("line dedup", line_dedup), ("MinHash near-dedup", minhash_dedup),
          ("mixing sources to target weights", mixing), ("SentencePiece encoding and decoding", pieces)]

ORACLE_SQL = None  # models, hashing and sampling are not SQL: tests hold it against a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for place, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place + 1 < len(STAGES):
            docs = materialize(docs, "stage")
    return docs
