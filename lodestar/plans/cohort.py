"""Registered cohort queries over the stand-in views."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cohort as C
from ..session import ensure_checkpoint_dir
from . import standins as S
from .registry import register

_W = "WITH " + S.SQL_DIAGNOSES + ", " + S.SQL_CASES


def _cases(spark, d):
    return C.case_subjects(S.diagnoses(spark, d), S.CASE_PREFIXES)


def _pool(spark, d):
    return C.exclude(S.patients(spark, d).select("subject_id"), _cases(spark, d))


def _controls(spark, d):
    cases = _cases(spark, d)
    return C.control_sample(_pool(spark, d), cases.count(), seed=42)


_SQL_POOL = ("pool AS (SELECT c_custkey AS subject_id FROM customer "
             "WHERE NOT EXISTS (SELECT 1 FROM cases WHERE cases.subject_id = customer.c_custkey))")
_SQL_CONTROLS = ("controls AS (SELECT subject_id FROM (SELECT subject_id, row_number() OVER ("
                 "ORDER BY md5('42:' || CAST(subject_id AS VARCHAR)), subject_id) AS rn FROM pool) "
                 "WHERE rn <= least((SELECT count(*) FROM cases), (SELECT count(*) FROM pool)))")


@register("cohort_cases", _W + " SELECT subject_id FROM cases")
def cohort_cases(spark, d):
    return _cases(spark, d)


@register("cohort_admissions", _W + """
SELECT o_custkey AS subject_id, o_orderkey, o_orderstatus, o_totalprice, o_orderpriority
FROM orders WHERE o_custkey IN (SELECT subject_id FROM cases)""")
def cohort_admissions(spark, d):
    return C.restrict(S.admissions(spark, d), _cases(spark, d))


@register("cohort_controls_pool", _W + ", " + _SQL_POOL + " SELECT subject_id FROM pool")
def cohort_controls_pool(spark, d):
    return _pool(spark, d)


@register("cohort_control_sample", _W + ", " + _SQL_POOL + ", " + _SQL_CONTROLS
          + " SELECT subject_id FROM controls")
def cohort_control_sample(spark, d):
    return _controls(spark, d)


@register("cohort_counts", _W + ", " + _SQL_POOL + ", " + _SQL_CONTROLS + ", " + S.SQL_NOTES + """
SELECT 'patients_case' AS dataset, CAST(count(*) AS BIGINT) AS n_rows FROM customer WHERE c_custkey IN (SELECT subject_id FROM cases)
UNION ALL SELECT 'patients_control', count(*) FROM customer WHERE c_custkey IN (SELECT subject_id FROM controls)
UNION ALL SELECT 'admissions_case', count(*) FROM orders WHERE o_custkey IN (SELECT subject_id FROM cases)
UNION ALL SELECT 'admissions_control', count(*) FROM orders WHERE o_custkey IN (SELECT subject_id FROM controls)
UNION ALL SELECT 'notes_case', count(*) FROM notes WHERE subject_id IN (SELECT subject_id FROM cases)
UNION ALL SELECT 'notes_control', count(*) FROM notes WHERE subject_id IN (SELECT subject_id FROM controls)""")
def cohort_counts(spark, d):
    ensure_checkpoint_dir(spark)  # ids read several times below; Spark drops the files with the frames
    cases = _cases(spark, d).checkpoint()
    controls = C.control_sample(C.exclude(S.patients(spark, d).select("subject_id"), cases),
                                cases.count(), seed=42).checkpoint()
    pats, adm, nts = S.patients(spark, d), S.admissions(spark, d), S.notes(spark, d)
    # cases and controls are disjoint: one join and one scan per table
    return C.count_by_membership([("patients", pats), ("admissions", adm), ("notes", nts)],
                                 [("case", cases), ("control", controls)])


@register("notes_union", _W + ", " + S.SQL_NOTES + """
SELECT subject_id, note_kind, text, lang, turn, role FROM notes
WHERE subject_id IN (SELECT subject_id FROM cases)""")
def notes_union(spark, d):
    return C.restrict(S.notes(spark, d), _cases(spark, d)).select(
        "subject_id", "note_kind", "text", "lang", "turn", "role")


_STRIP_SQL = "regexp_replace(text, '^[ \\t\\n\\r\\f\\x0B\\x{3000}]+|[ \\t\\n\\r\\f\\x0B\\x{3000}]+$', '', 'g')"


@register("notes_preview", _W + ", " + S.SQL_NOTES + f"""
, base AS (SELECT subject_id, note_kind, coalesce(turn, -1) AS turn_key, {_STRIP_SQL} AS t
           FROM notes WHERE subject_id IN (SELECT subject_id FROM cases) AND text IS NOT NULL)
SELECT subject_id, note_kind, turn_key,
       CASE WHEN length(t) > 2000 THEN substr(t, 1, 2000) || '... [截断]' ELSE t END AS preview
FROM base ORDER BY subject_id, note_kind, turn_key LIMIT 3""")
def notes_preview(spark, d):
    case_notes = C.restrict(S.notes(spark, d), _cases(spark, d)).withColumn(
        "turn_key", F.coalesce(F.col("turn"), F.lit(-1)))
    return C.notes_preview(case_notes, ["subject_id", "note_kind", "turn_key"], n=3, max_chars=2000)


_KW_SQL = " OR ".join(f"contains(lower(label), '{k}')" for k in S.LAB_KEYWORDS_TEST)


@register("lab_items_keyword", "WITH " + S.SQL_LABITEMS + f"""
SELECT itemid, label, fluid, category FROM labitems WHERE coalesce({_KW_SQL}, false)""")
def lab_items_keyword(spark, d):
    return C.lab_items(S.labitems(spark, d), S.LAB_KEYWORDS_TEST)


_LAB_W = (_W + ", " + S.SQL_LABEVENTS + ", " + S.SQL_LABITEMS
          + f", items AS (SELECT * FROM labitems WHERE coalesce({_KW_SQL}, false))"
          + ", extract AS (SELECT e.subject_id, e.itemid, e.valuenum, e.l_orderkey, e.l_linenumber, "
            "i.label, i.fluid, i.category FROM labevents e LEFT JOIN items i ON e.itemid = i.itemid "
            "WHERE e.itemid IN (SELECT itemid FROM items) AND e.subject_id IN (SELECT subject_id FROM cases))")


def _lab_extract(spark, d):
    items = C.lab_items(S.labitems(spark, d), S.LAB_KEYWORDS_TEST)
    return C.lab_extract(S.labevents(spark, d), items, _cases(spark, d))


@register("lab_extract", _LAB_W + """
SELECT subject_id, itemid, valuenum, l_orderkey, l_linenumber, label, fluid, category FROM extract""")
def lab_extract(spark, d):
    return _lab_extract(spark, d).select("subject_id", "itemid", "valuenum", "l_orderkey",
                                         "l_linenumber", "label", "fluid", "category")


@register("lab_mean_long", _LAB_W + """
SELECT subject_id, label, round(avg(valuenum), 6) AS mean_value FROM extract
WHERE subject_id IS NOT NULL AND label IS NOT NULL GROUP BY subject_id, label""")
def lab_mean_long(spark, d):
    out = C.lab_mean_long(_lab_extract(spark, d))
    return out.withColumn("mean_value", F.round("mean_value", 6))


_PIVOT_SQL = ", ".join(f"round(avg(valuenum) FILTER (WHERE label = '{lab}'), 6) AS \"{lab}\""
                       for lab in S.LAB_LABELS_TEST)


@register("cohort_lab_summary", _LAB_W + f"""
SELECT subject_id, {_PIVOT_SQL} FROM extract
WHERE subject_id IS NOT NULL AND label IS NOT NULL GROUP BY subject_id""")
def cohort_lab_summary(spark, d):
    wide = C.lab_wide(_lab_extract(spark, d), S.LAB_LABELS_TEST)
    return wide.select("subject_id", *[F.round(F.col(f"`{lab}`"), 6).alias(lab) for lab in S.LAB_LABELS_TEST])
