"""Views of the test tables in the shape the reference's inputs have
(subjects, diagnoses, admissions, notes, lab events, lab dictionary).  Each
view is a projection/join that Catalyst folds into the consuming plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cohort import union_sources
from ..sources.tables import table

# Stand-in parameters for the test tables (the reference uses diagnosis codes
# 250 / E10..E14 and nine lab keywords; those never occur in TPC-H-like data).
CASE_PREFIXES = ["1F98", "2P97", "3O96"]
LAB_KEYWORDS_TEST = ["gear", "ring"]
_COLOURS = ["blue", "cold", "hot", "large", "new", "old", "red", "small"]
# Pivot columns: every part name containing a stand-in keyword, sorted.
LAB_LABELS_TEST = sorted(f"{c} {k}" for c in _COLOURS for k in LAB_KEYWORDS_TEST)


def diagnoses(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    code = F.concat(F.substring("o_orderpriority", 1, 1), F.col("o_orderstatus"),
                    F.date_format("o_orderdate", "yy"))
    return o.select(F.col("o_custkey").alias("subject_id"), code.alias("icd_code"))


def admissions(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    return o.select(F.col("o_custkey").alias("subject_id"), "o_orderkey", "o_orderstatus",
                    "o_totalprice", "o_orderpriority")


def patients(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    return c.select(F.col("c_custkey").alias("subject_id"), "c_name", "c_nationkey",
                    "c_acctbal", "c_mktsegment")


def notes(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select(
        F.col("doc_id").alias("subject_id"), F.lit("document").alias("note_kind"), "text", "lang")
    conv = table(spark, d, "conversations").select(
        F.col("conv_id").alias("subject_id"), F.lit("conversation").alias("note_kind"),
        "turn", "role", "text")
    return union_sources([docs, conv])


def labevents(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return (li.join(o, li.l_orderkey == o.o_orderkey)
            .select(F.col("o_custkey").alias("subject_id"), F.col("l_partkey").alias("itemid"),
                    F.col("l_quantity").alias("valuenum"), "l_orderkey", "l_linenumber"))


def labitems(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    return p.select(F.col("p_partkey").alias("itemid"), F.col("p_name").alias("label"),
                    F.col("p_type").alias("fluid"), F.col("p_brand").alias("category"))


# The same stand-ins in DuckDB SQL (common table expressions).
SQL_DIAGNOSES = ("diagnoses AS (SELECT o_custkey AS subject_id, "
                 "substr(o_orderpriority, 1, 1) || o_orderstatus || strftime(o_orderdate, '%y') AS icd_code "
                 "FROM orders)")
SQL_CASES = ("cases AS (SELECT DISTINCT subject_id FROM diagnoses WHERE subject_id IS NOT NULL AND ("
             + " OR ".join(f"coalesce(starts_with(upper(icd_code), '{p}'), false)" for p in CASE_PREFIXES)
             + "))")
SQL_NOTES = ("notes AS (SELECT doc_id AS subject_id, 'document' AS note_kind, text, lang, "
             "CAST(NULL AS BIGINT) AS turn, CAST(NULL AS VARCHAR) AS role FROM documents "
             "UNION ALL SELECT conv_id, 'conversation', text, NULL, turn, role FROM conversations)")
SQL_LABEVENTS = ("labevents AS (SELECT o_custkey AS subject_id, l_partkey AS itemid, l_quantity AS valuenum, "
                 "l_orderkey, l_linenumber FROM lineitem JOIN orders ON l_orderkey = o_orderkey)")
SQL_LABITEMS = ("labitems AS (SELECT p_partkey AS itemid, p_name AS label, p_type AS fluid, p_brand AS category "
                "FROM part)")
