"""Line de-duplication over a corpus, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

# The ASCII white space that a line's key is stripped of.
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """The line without ASCII blanks at its ends and with A-Z in lower case.
    ``lower`` folds other letters too, so only pure ASCII takes that fast way."""
    bare = F.btrim(line, F.lit(BLANKS))
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(
        F.translate(bare, UPPER, LOWER))


def dedup_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """Drop the lines that many documents share; the document with the largest
    id among a line's holders keeps it.

    Returns the input's columns with ``text_col`` replaced, plus ``n_lines``
    (before) and ``n_dropped``; input columns of those two names are replaced.
    Keys shorter than ``min_chars`` code points, or held by fewer than
    ``min_docs`` distinct ids, lose nothing.  Null or empty text is one empty
    line.  Rows with a null id hold no line for the count, and lose every
    counted line.  Rows that repeat an id count as one document, and each row
    stays.

    Lines are exploded once as (id, position, 128-bit key hash), a small table
    that is written for its two readers: the texts cross the network one time,
    to meet their list of dropped positions.
    Distinct counting spreads a frequent line over (key, id) first; the join
    back to lines has one row per frequent key on its other side."""
    n_lines, n_dropped = "n_lines", "n_dropped"
    base = docs.select(*[c for c in docs.columns if c.lower() not in (n_lines, n_dropped)])
    lines = F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1)
    # rows that repeat an id may have other texts, so a row is an id and a text
    row = F.xxhash64(F.col(text_col))

    cut = base.select(F.col(id_col).alias("__ld_id"), row.alias("__ld_row"), F.posexplode(lines).alias("__ld_pos", "__ld_line"))
    keys = (cut.select("__ld_id", "__ld_row", "__ld_pos", line_key(F.col("__ld_line")).alias("__ld_key"))
            .filter(F.char_length("__ld_key") >= min_chars)
            .select("__ld_id", "__ld_row", "__ld_pos", F.unhex(F.md5("__ld_key")).alias("__ld_hash")))
    keys = materialize(keys, "line-keys")  # read twice below
    frequent = (keys.groupBy("__ld_hash").agg(F.countDistinct("__ld_id").alias("__ld_docs"), F.max("__ld_id").alias("__ld_keeper"))
                .filter(F.col("__ld_docs") >= min_docs).select("__ld_hash", "__ld_keeper"))
    dropped = (keys.join(frequent, "__ld_hash").filter(~F.col("__ld_id").eqNullSafe(F.col("__ld_keeper")))
               .groupBy("__ld_id", "__ld_row").agg(F.collect_set("__ld_pos").alias("__ld_drop")))

    left = base.withColumns({"__ld_id": F.col(id_col), "__ld_row": row}).alias("l")
    right = dropped.alias("r")
    joined = left.join(right, F.col("l.__ld_id").eqNullSafe(F.col("r.__ld_id")) & F.col("l.__ld_row").eqNullSafe(F.col("r.__ld_row")),
                       "left")
    parts = F.split(F.coalesce(F.col(f"l.{text_col}"), F.lit("")), "\n", -1)
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("r.__ld_drop")),
                       lambda i: F.element_at(parts, i + 1))
    text = F.when(F.col("r.__ld_drop").isNull(), F.coalesce(F.col(f"l.{text_col}"), F.lit(""))).otherwise(
        F.array_join(kept, "\n"))
    return joined.select(
        *[text.alias(c) if c == text_col else F.col(f"l.`{c}`") for c in base.columns],
        F.size(parts).cast("long").alias(n_lines),
        F.coalesce(F.size("r.__ld_drop"), F.lit(0)).cast("long").alias(n_dropped))
