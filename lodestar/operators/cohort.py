"""Cohort extraction: case selection by code prefix, restriction of related
tables, an exact seeded control sample, note previews and the lab summary.

Id sets are one-column DataFrames that are joined (semi / anti), never
collected into Python lists."""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import cut_with_marker, keyword_match, prefix_match, strip

# Fixed values that must equal the reference's for identical output.
DIABETES_CODE_PREFIXES = ["250", "E10", "E11", "E12", "E13", "E14"]
LAB_KEYWORDS = ["glucose", "glc", "hba1c", "hemoglobin a1c", "insulin",
                "c-peptide", "ketone", "beta-hydroxybutyrate", "urine glucose"]
PREVIEW_MARKER = "... [截断]"


def case_subjects(diagnoses: DataFrame, prefixes: Sequence[str],
                  code_col: str = "icd_code", subject_col: str = "subject_id") -> DataFrame:
    """Distinct subjects having at least one code with one of the prefixes.
    The distinct is a hash aggregate with a map-side partial step."""
    return (diagnoses.filter(prefix_match(code_col, prefixes))
            .select(F.col(subject_col).alias("subject_id"))
            .filter(F.col("subject_id").isNotNull())
            .distinct())


def restrict(df: DataFrame, ids: DataFrame, key: str = "subject_id") -> DataFrame:
    """Rows whose key is in the id set (``isin`` as a semi join)."""
    return df.join(ids.select(F.col("subject_id").alias(key)), on=key, how="left_semi")


def exclude(df: DataFrame, ids: DataFrame, key: str = "subject_id") -> DataFrame:
    """Rows whose key is not in the id set; NULL keys are kept (``~isin``)."""
    return df.join(ids.select(F.col("subject_id").alias(key)), on=key, how="left_anti")


def _hashed(ids: DataFrame, seed: int, id_col: str, prefix_hex: int) -> DataFrame:
    """Ids with their md5 draw key, cut to a reliable checkpoint in the
    cluster's shared checkpoint folder: the histogram and the selection then
    read it instead of recomputing the upstream joins."""
    from ..session import ensure_checkpoint_dir
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))
    keyed = ids.select(F.col(id_col), key.alias("_h")).withColumn("_b", F.substring("_h", 1, prefix_hex))
    ensure_checkpoint_dir(ids.sparkSession)
    return keyed.checkpoint(eager=True)


def _histogram(keyed: DataFrame) -> list[tuple[str, int]]:
    # at most 16**prefix_hex rows, whatever the data size
    return [(r["_b"], r["count"]) for r in keyed.groupBy("_b").count().orderBy("_b").collect()]


def _take_first(keyed: DataFrame, hist: list[tuple[str, int]], n: int, id_col: str) -> DataFrame:
    taken, cut, need = 0, None, 0
    for b, c in hist:
        if taken + c <= n:
            taken += c
            continue
        cut, need = b, n - taken
        break
    if cut is None:
        return keyed.select(id_col)
    whole = keyed.filter(F.col("_b") < cut).select(id_col)
    if need == 0:
        return whole
    boundary = keyed.filter(F.col("_b") == cut).orderBy("_h", id_col).limit(need).select(id_col)
    return whole.unionByName(boundary)


def seeded_sample(ids: DataFrame, n: int, seed: int = 42, id_col: str = "subject_id",
                  prefix_hex: int = 4) -> DataFrame:
    """Exactly ``n`` ids: the first ``n`` in the order of
    ``md5('<seed>:<id>')`` (ties on id).  Repeatable and identical in SQL.

    Distributed selection without funnelling the sample through one task:
    ids are bucketed by the first ``prefix_hex`` hex digits of the hash
    (at most 16**prefix_hex buckets, so the histogram that reaches the driver
    has a fixed size whatever the data size).  Whole buckets below the cut
    are kept with a filter; only the single boundary bucket is ranked."""
    if n <= 0:
        return ids.select(id_col).limit(0)
    keyed = _hashed(ids, seed, id_col, prefix_hex)
    return _take_first(keyed, _histogram(keyed), n, id_col)


def control_sample(pool: DataFrame, n_cases: int, seed: int = 42, id_col: str = "subject_id",
                   prefix_hex: int = 4) -> DataFrame:
    """Same-size control draw: min(cases, pool) ids from the pool; the pool
    size is the histogram total, so the pool is computed once."""
    keyed = _hashed(pool, seed, id_col, prefix_hex)
    hist = _histogram(keyed)
    n = min(n_cases, sum(c for _, c in hist))
    if n <= 0:
        return keyed.select(id_col).limit(0)
    return _take_first(keyed, hist, n, id_col)


def count_rows(named: Iterable[tuple[str, DataFrame]]) -> DataFrame:
    """One result table of (dataset, n_rows): a single job over a union of
    global counts instead of one action per table."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("dataset"), "n_rows")
             for name, df in named]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def count_by_membership(named_tables: Iterable[tuple[str, DataFrame]], groups: Sequence[tuple[str, DataFrame]],
                        key: str = "subject_id") -> DataFrame:
    """(dataset, n_rows) for every table x disjoint id group, with one join
    and one scan per table: the groups are tagged and unioned, each table
    row meets at most one tag (the groups are disjoint), and a grouped count
    per tag follows.  Tags with no rows still report 0."""
    tagged = None
    for tag, ids in groups:
        t = ids.select(F.col("subject_id").alias(key), F.lit(tag).alias("_tag"))
        tagged = t if tagged is None else tagged.unionByName(t)
    parts = []
    for name, df in named_tables:
        got = df.select(key).join(tagged, key).groupBy("_tag").agg(F.count(F.lit(1)).alias("n_rows"))
        zeros = df.sparkSession.createDataFrame([(tag, 0) for tag, _ in groups], "_tag string, n_rows long")
        full = got.unionByName(zeros).groupBy("_tag").agg(F.sum("n_rows").cast("long").alias("n_rows"))
        parts.append(full.select(F.concat(F.lit(f"{name}_"), F.col("_tag")).alias("dataset"), "n_rows"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def union_sources(frames: Sequence[DataFrame]) -> DataFrame:
    """Row union with column union: a column missing on one side is NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def notes_preview(notes: DataFrame, order_cols: Sequence[str], n: int = 3,
                  max_chars: int = 2000, text_col: str = "text") -> DataFrame:
    """First ``n`` non-null notes, stripped, cut at ``max_chars`` with a
    marker only when cut.  Top-n is a TakeOrderedAndProject (per-partition
    top-n, then merge of n rows)."""
    base = (notes.filter(F.col(text_col).isNotNull())
            .withColumn("_t", strip(F.col(text_col).cast("string"))))
    first = base.orderBy(*order_cols).limit(n)
    return first.select(*order_cols, cut_with_marker("_t", max_chars, PREVIEW_MARKER).alias("preview"))


def lab_items(dictionary: DataFrame, keywords: Sequence[str], label_col: str = "label") -> DataFrame:
    return dictionary.filter(keyword_match(label_col, keywords))


def lab_extract(labevents: DataFrame, items: DataFrame, subjects: DataFrame,
                attrs: Sequence[str] = ("label", "fluid", "category")) -> DataFrame:
    """Lab rows for keyword items of case subjects, with item attributes.
    Both memberships are semi joins; the attribute join is a left join that
    keeps fan-out on duplicate dictionary keys."""
    rows = restrict(labevents, subjects, "subject_id")
    rows = rows.join(items.select("itemid").distinct(), "itemid", "left_semi")
    return rows.join(items.select("itemid", *attrs), "itemid", "left")


def lab_mean_long(labs: DataFrame, key: str = "subject_id", label: str = "label",
                  value: str = "valuenum") -> DataFrame:
    """Mean value per (subject, label); NULL keys dropped, NULL values skipped."""
    return (labs.filter(F.col(key).isNotNull() & F.col(label).isNotNull())
            .groupBy(key, label).agg(F.avg(value).alias("mean_value")))


def lab_wide(labs: DataFrame, labels: Sequence[str], key: str = "subject_id",
             label: str = "label", value: str = "valuenum") -> DataFrame:
    """One row per subject, one column per label (mean), missing = NULL.
    ``labels`` fixes the output schema, so pivot needs no extra job to
    discover its values."""
    # One aggregation with a conditional mean per label: a single shuffle on
    # the subject with map-side partial (sum, count) pairs, instead of
    # pivot's aggregate-by-(subject, label) followed by a second pivot pass.
    rows = labs.filter(F.col(key).isNotNull() & F.col(label).isNotNull())
    return rows.groupBy(key).agg(*[F.avg(F.when(F.col(label) == lab, F.col(value))).alias(lab) for lab in labels])
