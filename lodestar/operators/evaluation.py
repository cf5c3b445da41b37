"""Evaluation of predicted labels: neighbour voting, accuracy, dense
confusion matrix, per-class report, prediction-file parsing and alignment,
and detection mAP.

Every metric is computed from a long ``(true_id, pred_id, n)`` count table
whose size is bounded by the vocabulary squared, so all metric steps after
the first aggregation touch tiny data."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, materialize
from .boxes import match_detections

# The class vocabulary (name -> id in list order), as in the
# reference.
CLASS_NAMES = ["Ascarid", "Hookworm", "Mansoni", "Hexacanth larva", "Egg sac", "Fluke",
               "Whipworm", "Coccidian", "Starch granule", "Muscle fiber", "Plant cell"]


def vocabulary(spark: SparkSession, names: Sequence[str] = CLASS_NAMES) -> DataFrame:
    """Dimension table (class_id, class_name); small by construction."""
    return spark.createDataFrame([(i, n) for i, n in enumerate(names)], "class_id int, class_name string")


def vote(hits: DataFrame, labels: DataFrame) -> DataFrame:
    """Majority label among each query's neighbours; ties go to the label
    whose best neighbour ranks first.  ``hits``: query_id, rank, neighbor_id;
    ``labels``: id, label."""
    lab = hits.join(labels.select(F.col("id").alias("neighbor_id"), "label"), "neighbor_id")
    per = lab.groupBy("query_id", "label").agg(F.count(F.lit(1)).alias("n"), F.min("rank").alias("best"))
    w = Window.partitionBy("query_id").orderBy(F.desc("n"), F.col("best"))
    return (per.withColumn("_r", F.row_number().over(w)).filter("_r = 1")
            .select("query_id", F.col("label").alias("pred_id")))


def pair_counts(pairs: DataFrame) -> DataFrame:
    """Long confusion counts (true_id, pred_id, n): one aggregation with a
    map-side partial step; output size <= vocabulary**2."""
    return pairs.groupBy("true_id", "pred_id").agg(F.count(F.lit(1)).alias("n"))


def accuracy(pairs: DataFrame) -> DataFrame:
    return pairs.agg(F.count(F.lit(1)).alias("n_pairs"),
                     F.avg((F.col("true_id") == F.col("pred_id")).cast("double")).alias("accuracy"))


def confusion_dense(pairs: DataFrame, vocab: DataFrame, n_classes: int) -> DataFrame:
    """Dense matrix over the whole vocabulary, zeros included: rows are true
    classes, columns ``pred_<id>``.  Pivot values are fixed, so no job is
    spent discovering them; missing rows come from the vocabulary."""
    ids = list(range(n_classes))
    # one aggregation straight to the wide form (conditional counts), then
    # every vocabulary row; the wide side has at most one row per class, so
    # it is the side broadcast into the vocabulary's left join
    wide = pairs.filter(F.col("true_id").isin(ids)).groupBy("true_id").agg(*[F.count(F.when(F.col("pred_id") == i, F.lit(1))).alias(str(i))
                                          for i in ids])
    full = vocab.select(F.col("class_id").alias("true_id"), F.col("class_name").alias("true_name")) \
        .join(F.broadcast(wide), "true_id", "left")
    return full.select("true_id", "true_name",
                       *[F.coalesce(F.col(str(i)), F.lit(0)).cast("long").alias(f"pred_{i}") for i in ids])


def classification_report(pairs: DataFrame, vocab: DataFrame, digits: int = 4) -> DataFrame:
    """Per class present in truth or prediction: precision, recall, f1 and
    support (zero division -> 0), then ``accuracy``, ``macro avg`` and
    ``weighted avg`` rows.  Values rounded to ``digits``."""
    # every count row says one thing about its true class and one about its predicted class
    zero, hit = F.lit(0).cast("long"), F.col("true_id") == F.col("pred_id")

    def told(class_id: str, *numbers):
        return F.struct(F.col(class_id).cast("long").alias("class_id"),
                        *[x.alias(c) for x, c in zip(numbers, ("support", "n_pred", "tp"))])

    said = pair_counts(pairs).select(F.explode(F.array(
        told("true_id", F.col("n"), zero, F.when(hit, F.col("n")).otherwise(zero)),
        told("pred_id", zero, F.col("n"), zero))).alias("c")).select("c.*")
    per = said.groupBy("class_id").agg(*[F.sum(c).alias(c) for c in ("support", "n_pred", "tp")])
    p = F.when(F.col("n_pred") > 0, F.col("tp") / F.col("n_pred")).otherwise(F.lit(0.0))
    r = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(F.lit(0.0))
    per = per.withColumn("precision", p).withColumn("recall", r)
    per = per.withColumn("f1_score", F.when(F.col("precision") + F.col("recall") > 0,
                                            2 * F.col("precision") * F.col("recall")
                                            / (F.col("precision") + F.col("recall"))).otherwise(F.lit(0.0)))
    # one row per class: written once, so the pairs are computed once for both parts of the report
    ensure_checkpoint_dir(pairs.sparkSession)
    per = per.join(F.broadcast(vocab), "class_id", "left").checkpoint()
    rows = per.select(F.coalesce("class_name", F.col("class_id").cast("string")).alias("class_name"),
                      "precision", "recall", "f1_score", F.col("support").cast("long").alias("support"))
    tot = F.sum("support")

    def weighted(c: str):
        return F.coalesce(F.sum(F.col(c) * F.col("support")) / F.when(tot > 0, tot), F.lit(0.0))

    scores = ("precision", "recall", "f1_score")
    none = F.lit(None).cast("double")
    totals = per.agg(tot.cast("long").alias("support"), F.coalesce(F.sum("tp") / F.when(tot > 0, tot), F.lit(0.0)).alias("acc"),
                     *[F.avg(c).alias(f"m_{c}") for c in scores], *[weighted(c).alias(f"w_{c}") for c in scores])

    def line(name: str, values):
        return F.struct(F.lit(name).alias("class_name"), *[v.alias(c) for v, c in zip(values, scores)], F.col("support"))

    summary = totals.select(F.explode(F.array(
        line("accuracy", (none, none, F.col("acc"))), line("macro avg", [F.col(f"m_{c}") for c in scores]),
        line("weighted avg", [F.col(f"w_{c}") for c in scores]))).alias("s")).select("s.*")
    out = rows.unionByName(summary)
    return out.select("class_name", *[F.round(c, digits).alias(c) for c in ("precision", "recall", "f1_score")],
                      "support")


# ---------------------------------------------------------------- prediction files
FENCE = "```"


def fenced_blocks(c) -> "F.Column":
    """Texts between one fence mark and the next, as pairs; a language word at
    a block's start goes (``json`` even where nothing parts it from what
    follows), and so does white space around the block.  Any line break, or
    none, may follow the mark; an opened block that never closes is none."""
    from ..functions.text import strip
    parts = F.split(c, FENCE)
    inner = F.filter(parts, lambda _, i: (i % 2 == 1) & (i < F.size(parts) - 1))
    return F.transform(inner, lambda b: strip(F.regexp_replace(b, "^(json|[A-Za-z]+\\s)", "")))


def _class_id(name) -> "F.Column":
    m = F.create_map(*[x for i, n in enumerate(CLASS_NAMES) for x in (F.lit(n), F.lit(i))])
    return F.try_element_at(m, name)


def strict_json_value(text) -> "F.Column":
    """True when the text is exactly one JSON value other than ``null``."""
    from ..functions.text import strip
    return _one_value(text) & (strip(text) != "null")


def _one_value(text) -> "F.Column":
    return F.coalesce(F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1, F.lit(False))


def prediction_json(content) -> "F.Column":
    """The JSON text a prediction file holds, tried in order: each fenced
    block, the whole text, then glued objects (``}{`` -> ``},{``) wrapped in
    brackets.  NULL when nothing parses."""
    from ..functions.text import strip
    return _stripped_json(strip(content))


def _stripped_json(c) -> "F.Column":
    """``prediction_json`` of a text without white space around it.  Each form
    is built and parsed once, and only where the forms before it fail."""
    def value(text) -> "F.Column":  # blocks are stripped, and glued objects begin with a bracket
        return _one_value(text) & (text != "null")

    fenced = F.try_element_at(F.filter(fenced_blocks(c), value), F.lit(1))
    glued = F.concat(F.lit("["), F.replace(c, F.lit("}{"), F.lit("},{")), F.lit("]"))
    return F.when(F.length(c) > 0, F.coalesce(F.when(c.contains(FENCE), fenced), F.when(value(c), c),
                                              F.when(value(glued), glued)))


def prediction_items(js, v) -> "F.Column":
    """Detection objects in the parsed prediction ``v`` (variant of the
    JSON text ``js``), in document order: a list as is;
    ``results[].detections[]``; ``detections[]``; else every list value's
    objects that carry ``cls`` or ``class``."""
    arr = F.try_variant_get(v, "$", "array<variant>")
    obj = F.try_variant_get(v, "$", "map<string,variant>")
    results = F.try_variant_get(v, "$.results", "array<variant>")
    from_results = F.flatten(F.transform(results, lambda r: F.coalesce(
        F.try_variant_get(r, "$.detections", "array<variant>"), F.array().cast("array<variant>"))))
    dets = F.try_variant_get(v, "$.detections", "array<variant>")
    # map<string,string> from_json keeps document key order; list values come back as JSON text
    values = F.map_values(F.from_json(js, "map<string,string>"))
    lists = F.transform(values, lambda s: F.coalesce(F.try_variant_get(F.try_parse_json(s), "$", "array<variant>"),
                                                     F.array().cast("array<variant>")))

    def keyed(o):
        m = F.try_variant_get(o, "$", "map<string,variant>")
        return F.coalesce(F.map_contains_key(m, "cls") | F.map_contains_key(m, "class"), F.lit(False))

    fallback = F.filter(F.flatten(lists), keyed)
    return (F.when(arr.isNotNull(), arr)
            .when(obj.isNotNull() & results.isNotNull(), from_results)
            .when(obj.isNotNull() & dets.isNotNull(), dets)
            .when(obj.isNotNull(), fallback))


def parse_predictions(files: DataFrame, name_col: str = "name", content_col: str = "content") -> tuple[DataFrame, DataFrame]:
    """Prediction files -> (stem, pos, cls_name, pred_id), and rejects (stem,
    reason, cls_name): names outside the vocabulary and files without JSON.
    Non-objects, empty names and unknown names are dropped before positions
    are numbered, so later items shift as in the reference.  The JSON text is
    parsed once into a variant column, and positions come from filtering the
    item array before ``posexplode`` (no regrouping by file)."""
    from ..functions.text import file_stem, strip
    base = files.select(file_stem(F.col(name_col)).alias("stem"), strip(content_col).alias("_c"))
    base = base.select("stem", _stripped_json(F.col("_c")).alias("_js"))
    base = base.select("stem", "_js", F.try_parse_json("_js").alias("_v"))
    items = base.select("stem", F.col("_v").isNull().alias("_none"), prediction_items(F.col("_js"), F.col("_v")).alias("_items"))

    def named(o):
        cls = F.try_variant_get(o, "$.cls", "string")
        klass = F.try_variant_get(o, "$.class", "string")
        nm = strip(F.coalesce(F.nullif(cls, F.lit("")), F.nullif(klass, F.lit("")), F.lit("")))
        is_obj = F.try_variant_get(o, "$", "map<string,variant>").isNotNull()
        return F.struct(F.when(is_obj, nm).otherwise(F.lit("")).alias("cls_name"))

    names = items.select("stem", "_none", F.filter(F.transform("_items", named), lambda x: F.length(x["cls_name"]) > 0)
                         .alias("_n"))
    ided = names.select("stem", "_none", F.transform("_n", lambda x: F.struct(
        x["cls_name"].alias("cls_name"), _class_id(x["cls_name"]).alias("pred_id"))).alias("_k"))
    known = ided.select("stem", F.posexplode(F.filter("_k", lambda x: x["pred_id"].isNotNull())).alias("pos", "_x")) \
        .select("stem", "pos", F.col("_x.cls_name").alias("cls_name"), F.col("_x.pred_id").alias("pred_id"))
    # one pass for both kinds of rejects: a file without JSON has no items
    none = F.array(F.struct(F.lit("no JSON").alias("reason"), F.lit(None).cast("string").alias("cls_name")))
    unknown = F.transform(F.filter("_k", lambda x: x["pred_id"].isNull()), lambda x: F.struct(
        F.lit("unknown class").alias("reason"), x["cls_name"].alias("cls_name")))
    rejects = ided.select("stem", F.explode(F.when(F.col("_none"), none).otherwise(unknown)).alias("_x")).select("stem", "_x.*")
    return known, rejects


def parse_label_lines(files: DataFrame, name_col: str = "name", content_col: str = "content") -> DataFrame:
    """Label files -> (stem, pos, true_id): blank lines skipped, first
    whitespace-separated token as the class id; positions count kept lines."""
    from ..functions.text import file_stem, strip
    lines = F.filter(F.split(F.col(content_col), "\r\n|\r|\n"), lambda l: F.length(strip(l)) > 0)
    rows = files.select(file_stem(F.col(name_col)).alias("stem"), F.posexplode(lines).alias("pos", "_l"))
    return rows.select("stem", "pos", F.split(strip(F.col("_l")), "\\s+")[0].try_cast("int").alias("true_id"))


def latest_by_stem(files: DataFrame, name_col: str = "name", content_col: str = "content") -> DataFrame:
    """One file per stem: the later name in sorted order wins.  A single
    aggregation (``max_by``) with map-side reduction, so contents are
    shuffled once and only the winners after partial aggregation."""
    from ..functions.text import file_stem
    keyed = files.withColumn("_stem", file_stem(F.col(name_col)))
    return keyed.groupBy("_stem").agg(F.max(name_col).alias(name_col),
                                      F.max_by(content_col, name_col).alias(content_col)).drop("_stem")


def align(truth: DataFrame, preds: DataFrame) -> DataFrame:
    """Pair item i with item i per stem; the shorter list decides.  Label
    lines without a class id keep their place but make no pair."""
    return truth.filter(F.col("true_id").isNotNull()).join(preds, ["stem", "pos"], "inner").select("stem", "pos", "true_id", "pred_id")


def missing_files(truth_files: DataFrame, pred_files: DataFrame, name_col: str = "name") -> DataFrame:
    """(stem, lacks): images with a label file but no prediction file, and the
    other way round."""
    from ..functions.text import file_stem
    # one aggregation: every file once, instead of two sets of stems that meet twice
    label, prediction = F.col("_label"), F.col("_prediction")
    stems = truth_files.select(file_stem(F.col(name_col)).alias("stem"), F.lit(True).alias("_l")).unionByName(
        pred_files.select(file_stem(F.col(name_col)).alias("stem"), F.lit(False).alias("_l")))
    seen = stems.groupBy("stem").agg(F.max("_l").alias("_label"), F.max(~F.col("_l")).alias("_prediction"))
    other = F.col("stem").isNull()  # a file without a name has no counterpart
    lacks = F.filter(F.array(F.when(label & (other | ~prediction), "prediction"), F.when(prediction & (other | ~label), "label")),
                     lambda x: x.isNotNull())
    return seen.select("stem", F.explode(lacks).alias("lacks"))


# ---------------------------------------------------------------- detection mAP
IOU_THRESHOLDS = [round(0.5 + 0.05 * i, 2) for i in range(10)]

def average_precision(matches: DataFrame, gt: DataFrame, n_thresholds: int) -> DataFrame:
    """AP per (class, threshold index): cumulative TP in score order gives
    precision; the precision envelope (max precision at this or any lower
    score) is a running max over the reversed order; AP is
    sum(tp_i / n_gt * envelope_i).  The score order is the same for every
    threshold, so one row per prediction carries all thresholds and both
    running passes run once per class.  They use the range-split running
    aggregate, so a class holding most predictions is not one task."""
    from .running import running
    tps = [f"tp_{i}" for i in range(n_thresholds)]
    n_gt = gt.groupBy("class_id").agg(F.count(F.lit(1)).alias("n_gt"))
    m = matches.select(F.col("class_id").cast("long").alias("class_id"), (-F.col("score")).alias("_o1"),
                       F.col("image").alias("_o2"), F.col("pred_id").alias("_o3"),
                       *[F.col(t).cast("double").alias(t) for t in tps])
    fwd = running(m, "class_id", ["_o1", "_o2", "_o3"], sums=tps)
    # rows without a hit at any threshold have counted for the places; the envelope and the sums need hits alone
    rev = fwd.filter(F.greatest(*tps) > 0 if n_thresholds > 1 else F.col(tps[0]) > 0).select("class_id", (-F.col("_o1")).alias("_r1"), (-F.col("_o2")).alias("_r2"),
                     (-F.col("_o3")).alias("_r3"), *tps,
                     # between two hits precision falls, so the hits alone make the envelope
                     *[F.when(F.col(t) > 0, F.col(f"{t}_run") / F.col("_rn")).alias(f"p_{i}") for i, t in enumerate(tps)])
    env = running(rev, "class_id", ["_r1", "_r2", "_r3"], maxes=[f"p_{i}" for i in range(n_thresholds)])
    sums = env.groupBy("class_id").agg(*[F.sum(F.when(F.col(t) > 0, F.col(f"p_{i}_runmax")).otherwise(0.0)).alias(f"a_{i}")
                                         for i, t in enumerate(tps)])
    return sums.join(n_gt.withColumn("class_id", F.col("class_id").cast("long")), "class_id").select(
        "class_id", *[(F.col(f"a_{i}") / F.col("n_gt")).alias(f"ap_{i}") for i in range(n_thresholds)])


def detection_map(gt: DataFrame, preds: DataFrame, thresholds=IOU_THRESHOLDS) -> DataFrame:
    """Per class present in truth: AP@0.5, AP@0.5:0.95, truth/prediction
    counts, precision and recall at IoU 0.5; then an ``all`` row with
    mAP@0.5 and mAP@0.5:0.95 (means over classes)."""
    nt = len(thresholds)
    matches = materialize(match_detections(gt, preds, thresholds), "box-matches")  # read twice below
    ap = average_precision(matches, gt, nt)
    n_gt = gt.groupBy(F.col("class_id").cast("long").alias("class_id")).agg(F.count(F.lit(1)).alias("n_gt"))
    at50 = matches.groupBy(F.col("class_id").cast("long").alias("class_id")).agg(
        F.count(F.lit(1)).alias("n_pred"), F.sum("tp_0").alias("tp50"))
    per_t = ap.select("class_id", F.col("ap_0").alias("ap50"),
                      (sum(F.col(f"ap_{i}") for i in range(nt)) / F.lit(nt)).alias("ap50_95"))
    per = (n_gt.join(per_t, "class_id", "left").join(at50, "class_id", "left")
           .select("class_id", F.coalesce("ap50", F.lit(0.0)).alias("ap50"),
                   F.coalesce("ap50_95", F.lit(0.0)).alias("ap50_95"), "n_gt",
                   F.coalesce("n_pred", F.lit(0)).alias("n_pred"), F.coalesce("tp50", F.lit(0)).alias("tp50")))
    rows = per.select(F.col("class_id").cast("string").alias("class"), "ap50", "ap50_95", "n_gt", "n_pred",
                      F.when(F.col("n_pred") > 0, F.col("tp50") / F.col("n_pred")).otherwise(F.lit(0.0)).alias("precision"),
                      (F.col("tp50") / F.col("n_gt")).alias("recall"))
    total = per.agg(F.avg("ap50").alias("ap50"), F.avg("ap50_95").alias("ap50_95"), F.sum("n_gt").alias("n_gt"),
                    F.sum("n_pred").alias("n_pred"),
                    (F.sum("tp50") / F.when(F.sum("n_pred") > 0, F.sum("n_pred"))).alias("precision"),
                    (F.sum("tp50") / F.sum("n_gt")).alias("recall"))
    total = total.select(F.lit("all").alias("class"), "ap50", "ap50_95", "n_gt", "n_pred",
                         F.coalesce("precision", F.lit(0.0)).alias("precision"), "recall")
    return rows.unionByName(total)
