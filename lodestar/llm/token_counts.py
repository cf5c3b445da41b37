"""Token counts: an exact histogram of encoded lengths and what follows from
its suffix sums for every context limit."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pre-token pattern that belongs to this vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BUCKET = 1024


@lru_cache(maxsize=4)
def encoder(vocabulary: str, pattern: str):
    """One encoder per Python worker, kept over its tasks."""
    import tiktoken

    with open(vocabulary, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def token_lengths(docs: DataFrame, *, text_col: str = "text", vocabulary: str = VOCABULARY,
                  pattern: str = PATTERN) -> DataFrame:
    """One row (``n_tokens``) per input row: the length of the whole text
    under the tokenizer, with no special tokens.  Null and empty texts have
    length 0.  ``vocabulary`` is a path that every executor can open."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary, pattern).encode_ordinary
        for batch in batches:
            counts = [len(encode(x.as_py())) if x.is_valid else 0 for x in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(counts, pa.int64())], ["n_tokens"])

    return docs.select(F.col(text_col)).mapInArrow(run, "n_tokens long")


def length_histogram(lengths: DataFrame, length_col: str = "n_tokens") -> DataFrame:
    """Exact histogram of document lengths with its suffix sums, one row per
    length that occurs:

    ``n_docs`` documents of this length; ``docs_from`` / ``tokens_from``
    documents and tokens at this length or above; ``docs_total`` /
    ``tokens_total`` of the corpus; ``truncated_total`` tokens that remain if
    every document is cut to this length; ``quantile`` share of documents at
    or below it.  Null lengths are left out; no rows give no rows.

    Counting combines before the shuffle, and the counts are written once, so
    that no text is encoded twice.  The suffix sums run inside buckets
    of lengths; only one total per bucket meets in one ordered window."""
    hist = materialize(lengths.filter(F.col(length_col).isNotNull()).groupBy(
        F.col(length_col).cast("long").alias("n_tokens")).agg(F.count(F.lit(1)).alias("n_docs"))
        .withColumn("__bucket", F.floor(F.col("n_tokens") / BUCKET)), "lengths")
    tokens = F.col("n_docs") * F.col("n_tokens")
    above = Window.orderBy(F.col("__bucket").desc()).rowsBetween(Window.unboundedPreceding, -1)
    buckets = (hist.groupBy("__bucket").agg(F.sum("n_docs").alias("__docs"), F.sum(tokens).alias("__tokens"))
               .select("__bucket", F.coalesce(F.sum("__docs").over(above), F.lit(0)).alias("__docs_above"),
                       F.coalesce(F.sum("__tokens").over(above), F.lit(0)).alias("__tokens_above"),
                       F.sum("__docs").over(Window.partitionBy()).alias("docs_total"),
                       F.sum("__tokens").over(Window.partitionBy()).alias("tokens_total")))
    inside = Window.partitionBy("__bucket").orderBy(F.col("n_tokens").desc())
    rows = hist.join(buckets, "__bucket").select(
        "n_tokens", "n_docs",
        (F.col("__docs_above") + F.sum("n_docs").over(inside)).alias("docs_from"),
        (F.col("__tokens_above") + F.sum(tokens).over(inside)).alias("tokens_from"),
        "docs_total", "tokens_total")
    longer = F.col("docs_from") - F.col("n_docs")
    shorter = F.col("tokens_total") - F.col("tokens_from") + F.col("n_docs") * F.col("n_tokens")
    return rows.select(
        "*", (shorter + longer * F.col("n_tokens")).alias("truncated_total"),
        ((F.col("docs_total") - longer) / F.col("docs_total")).alias("quantile"))


def at_limit(histogram: DataFrame, limits: DataFrame, limit_col: str = "limit") -> DataFrame:
    """What each context limit keeps: (limit, docs_cut, truncated_total,
    tokens_cut).  The limits are the few rows that a user asks for; the
    histogram has one row per length, so it is summed once per limit without
    a join of documents."""
    wanted = [r[0] for r in limits.select(limit_col).distinct().collect()]
    sums = [F.struct(
        F.lit(x).cast("long").alias("limit"),
        F.coalesce(F.sum(F.when(F.col("n_tokens") > x, F.col("n_docs")).otherwise(0)), F.lit(0)).alias("docs_cut"),
        F.coalesce(F.sum(F.least("n_tokens", F.lit(x)) * F.col("n_docs")), F.lit(0)).alias("truncated_total"),
        F.coalesce(F.sum(F.greatest(F.col("n_tokens") - x, F.lit(0)) * F.col("n_docs")), F.lit(0)).alias("tokens_cut"),
    ) for x in wanted if x is not None]
    return histogram.agg(F.array(*sums).alias("a")).select(F.explode("a").alias("s")).select("s.*")
