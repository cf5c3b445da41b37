"""Registered file round trips: tables written by Spark to the shared
folder, then read back through the library's sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import shared_dir
from ..sources import files as FS
from ..sources.tables import table
from .registry import register

_CONV_SCHEMA = "conv_id long, turn long, role string, text string"


@register("csv_roundtrip", "SELECT conv_id, turn, role, text FROM conversations")
def csv_roundtrip(spark, d):
    """Header CSV sink and source with multi-line quoted text; the second
    input path does not exist and is skipped (optional sources)."""
    root = shared_dir(spark, "csv-roundtrip")
    FS.write_csv(table(spark, d, "conversations").select("conv_id", "turn", "role", "text"), root + "/conv")
    back = FS.read_optional_csv(spark, [root + "/conv", root + "/missing"], _CONV_SCHEMA, multi_line=True)
    return back


@register("csv_by_name", """
SELECT c_custkey AS subject_id, c_mktsegment AS icd_code FROM customer
UNION ALL SELECT o_custkey, o_orderpriority FROM orders""")
def csv_by_name(spark, d):
    """Two header files whose columns differ in number and order, and one that
    does not exist: the declared columns are found by name."""
    root = shared_dir(spark, "csv-by-name")
    FS.write_csv(table(spark, d, "customer").select(
        F.col("c_custkey").alias("subject_id"), F.col("c_acctbal").alias("hadm_id"), F.col("c_name").alias("seq_num"),
        F.col("c_mktsegment").alias("icd_code")), root + "/wide")
    FS.write_csv(table(spark, d, "orders").select(
        F.col("o_orderpriority").alias("icd_code"), F.col("o_custkey").alias("subject_id")), root + "/turned")
    return FS.read_optional_csv(spark, [root + "/wide", root + "/turned", root + "/missing"],
                                "subject_id long, icd_code string")


@register("document_scan", """
SELECT source AS src, CAST(sum(length(text) + 1) AS BIGINT) AS n_chars
FROM documents GROUP BY source""")
def document_scan(spark, d):
    """Documents written as text files (one folder per source), scanned
    back recursively; characters per source folder."""
    root = shared_dir(spark, "document-scan")
    docs = table(spark, d, "documents").select("source", "text")
    docs.write.mode("overwrite").partitionBy("source").text(root + "/docs")
    scanned = FS.scan_documents(spark, root + "/docs")
    per = scanned.select(F.regexp_extract("source", "source=([^/]*)/", 1).alias("src"), "text")
    return per.groupBy("src").agg(F.sum(F.length("text")).cast("long").alias("n_chars"))


_SECTION = 500  # lines


@register("text_sections", f"""
WITH whole AS (SELECT source, string_split(string_agg(coalesce(text, ''), chr(10) ORDER BY doc_id), chr(10)) AS ls
               FROM documents WHERE source IS NOT NULL GROUP BY source),
line AS (SELECT source, unnest(range(0, len(ls))) AS n, unnest(ls) AS l FROM whole)
SELECT source AS src, CAST(n // {_SECTION} AS BIGINT) AS section, count(*) AS n_lines,
       sha256(string_agg(l, chr(10) ORDER BY n)) AS text_sha256
FROM line GROUP BY 1, 2""")
def text_sections(spark, d):
    """Documents written as one long text file per source, read in pieces and
    put together as sections of 500 lines."""
    root = shared_dir(spark, "text-sections")
    docs = table(spark, d, "documents").filter("source IS NOT NULL").select("source", "doc_id", "text")
    docs.repartition("source").sortWithinPartitions("source", "doc_id").select("source", "text") \
        .write.partitionBy("source").text(root + "/docs", lineSep="\n")
    found = FS.text_sections(spark, root + "/docs", _SECTION)
    return found.select(F.regexp_extract("path", "source=([^/]*)/", 1).alias("src"), "section", "n_lines",
                        F.sha2("text", 256).alias("text_sha256"))


@register("image_data_url", """
SELECT item_id, 'data:image/jpeg;base64,' || to_base64(encode(text || chr(10))) AS data_url FROM benchmark""")
def image_data_url(spark, d):
    """Binary content encoded as base64 data URLs JVM-side (the file reader
    itself is unit-tested on a small folder)."""
    bytes_ = table(spark, d, "benchmark").select(
        "item_id", F.encode(F.concat("text", F.lit("\n")), "UTF-8").alias("content"))
    return FS.image_data_url(bytes_).select("item_id", "data_url")
