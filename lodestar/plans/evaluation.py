"""Registered evaluation queries.  Truth is ``embeddings.label``; the
prediction is the label voted by each vector's nearest neighbours."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evaluation as EV
from ..session import materialize, shared_dir
from ..sources import files as FS
from ..sources.tables import table
from .registry import ORACLE, register
from .retrieval import K_SEARCH, _PAIRS_SQL, _knn

_VOCAB_SQL = "vocab AS (SELECT * FROM (VALUES " + ", ".join(
    f"({i}, '{n}')" for i, n in enumerate(EV.CLASS_NAMES)) + ") v(class_id, class_name))"

_PAIRS_W = "WITH " + _PAIRS_SQL + f""",
lab AS (SELECT r.query_id, r.rank, e.label FROM ranked r JOIN embeddings e ON e.vec_id = r.neighbor_id
        WHERE r.rank <= {K_SEARCH}),
votes AS (SELECT query_id, label, count(*) AS n, min(rank) AS best FROM lab GROUP BY 1, 2),
pred AS (SELECT query_id, label AS pred_id FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY n DESC, best) AS r FROM votes) WHERE r = 1),
evpairs AS (SELECT e.label AS true_id, p.pred_id FROM pred p JOIN embeddings e ON e.vec_id = p.query_id),
cnt AS (SELECT true_id, pred_id, count(*) AS n FROM evpairs GROUP BY 1, 2), {_VOCAB_SQL}"""


def _pairs(spark, d):
    e = table(spark, d, "embeddings")
    pred = EV.vote(_knn(spark, d, K_SEARCH), e.select(F.col("vec_id").alias("id"), "label"))
    return pred.join(e.select(F.col("vec_id").alias("query_id"), F.col("label").alias("true_id")), "query_id") \
        .select("true_id", "pred_id")


@register("knn_accuracy", _PAIRS_W + """
SELECT CAST(count(*) AS BIGINT) AS n_pairs, round(avg(CASE WHEN true_id = pred_id THEN 1.0 ELSE 0.0 END), 6) AS accuracy
FROM evpairs""")
def knn_accuracy(spark, d):
    return EV.accuracy(_pairs(spark, d)).withColumn("accuracy", F.round("accuracy", 6))


_N = len(EV.CLASS_NAMES)


@register("confusion_matrix", _PAIRS_W + "\nSELECT v.class_id AS true_id, v.class_name AS true_name, " + ", ".join(
    f"CAST(coalesce(sum(c.n) FILTER (WHERE c.pred_id = {i}), 0) AS BIGINT) AS pred_{i}" for i in range(_N))
    + " FROM vocab v LEFT JOIN cnt c ON c.true_id = v.class_id GROUP BY v.class_id, v.class_name")
def confusion_matrix(spark, d):
    return EV.confusion_dense(_pairs(spark, d), EV.vocabulary(spark), _N)


@register("classification_report", _PAIRS_W + """,
sup AS (SELECT true_id AS class_id, sum(n) AS support FROM cnt GROUP BY 1),
npr AS (SELECT pred_id AS class_id, sum(n) AS n_pred FROM cnt GROUP BY 1),
tp AS (SELECT true_id AS class_id, n AS tp FROM cnt WHERE true_id = pred_id),
cls AS (SELECT class_id FROM sup UNION SELECT class_id FROM npr),
per0 AS (SELECT cls.class_id, coalesce(support, 0) AS support, coalesce(n_pred, 0) AS n_pred, coalesce(tp, 0) AS tp
         FROM cls LEFT JOIN sup USING (class_id) LEFT JOIN npr USING (class_id) LEFT JOIN tp USING (class_id)),
per1 AS (SELECT *, CASE WHEN n_pred > 0 THEN tp / n_pred ELSE 0.0 END AS precision,
                   CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall FROM per0),
per AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END
                  AS f1_score FROM per1),
allrows AS (
  SELECT coalesce(v.class_name, CAST(per.class_id AS VARCHAR)) AS class_name, precision, recall, f1_score,
         CAST(support AS BIGINT) AS support FROM per LEFT JOIN vocab v ON v.class_id = per.class_id
  UNION ALL SELECT 'accuracy', NULL, NULL, coalesce(sum(tp) / sum(support), 0.0), CAST(sum(support) AS BIGINT) FROM per
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1_score), CAST(sum(support) AS BIGINT) FROM per
  UNION ALL SELECT 'weighted avg', coalesce(sum(precision * support) / nullif(sum(support), 0), 0.0),
                   coalesce(sum(recall * support) / nullif(sum(support), 0), 0.0),
                   coalesce(sum(f1_score * support) / nullif(sum(support), 0), 0.0), CAST(sum(support) AS BIGINT) FROM per)
SELECT class_name, round(precision, 4) AS precision, round(recall, 4) AS recall, round(f1_score, 4) AS f1_score,
       support FROM allrows""")
def classification_report(spark, d):
    return EV.classification_report(_pairs(spark, d), EV.vocabulary(spark))


@register("confusion_matrix_csv", "SELECT * EXCLUDE (true_name), CAST(true_id AS BIGINT) AS row_no FROM ("
          + ORACLE["confusion_matrix"] + ")")
def confusion_matrix_csv(spark, d):
    """The matrix written by class over three CSV files without header, read
    back in the order of the files: row i is class i."""
    root = shared_dir(spark, "confusion-matrix")
    matrix = EV.confusion_dense(_pairs(spark, d), EV.vocabulary(spark), len(EV.CLASS_NAMES)).drop("true_name")
    FS.write_ordered_csv(matrix, root + "/matrix", ["true_id"], header=False, parts=3)
    return FS.in_file_order(spark.read.schema(matrix.schema).csv(root + "/matrix")).drop("path")


# ---------------------------------------------------------------- detection files
# Label and prediction "files" composed per order key from its line items, one
# shape per order (list, glued objects, fenced results, detections with
# "class", any-list fallback); every 13th order has no prediction file.
def _name_sql(i: str) -> str:
    return "CASE " + i + " " + " ".join(f"WHEN {n} THEN '{v}'" for n, v in enumerate(EV.CLASS_NAMES)) + " END"


_PRED_NAME = ("CASE WHEN l_linenumber = 3 AND o_orderkey % 5 = 0 THEN '??' "
              "WHEN l_linenumber = 2 AND o_orderkey % 7 = 0 THEN ' ' "
              "WHEN l_linenumber = 1 AND o_orderkey % 2 = 0 THEN ' ' || "
              + _name_sql("(l_partkey + CASE WHEN l_suppkey % 4 = 0 THEN 1 ELSE 0 END) % 11") + " || ' ' ELSE "
              + _name_sql("(l_partkey + CASE WHEN l_suppkey % 4 = 0 THEN 1 ELSE 0 END) % 11") + " END")
_ITEM_SQL = ("CASE WHEN o_orderkey % 5 = 3 THEN '{\"class\": \"' || " + _PRED_NAME + " || '\"}' "
             "ELSE '{\"cls\": \"' || " + _PRED_NAME + " || '\", \"conf\": 0.5}' END")
_TRUTH_LINE = ("CASE WHEN l_linenumber = 2 AND o_orderkey % 3 = 0 THEN '' "
               "ELSE CAST(l_partkey % 11 AS STRING) || ' 0.5 0.5 0.1 0.1' END")


# the fence forms: language word and line feed, carriage return too, JSON on the mark's own line, a first block
# that is no JSON, no word; every 8th ends without its closing mark (read as a whole, it is no JSON)
_FENCED = ("CASE o_orderkey % 8 WHEN 0 THEN 'Result:' || chr(10) || '```json' || chr(10) || {items} || chr(10) || '```' "
           "WHEN 1 THEN '```json' || chr(13) || chr(10) || {items} || chr(13) || chr(10) || '```' "
           "WHEN 2 THEN 'so: ```json' || {items} || '``` done' WHEN 3 THEN '```' || {items} || '```' "
           "WHEN 4 THEN '```python' || chr(10) || 'x = 1' || chr(10) || '```' || chr(10) || '```json ' || {items} || '```' "
           "WHEN 5 THEN '```' || chr(10) || {items} || chr(10) || '```' || chr(10) || '```[]```' "
           "WHEN 6 THEN '```json' || chr(10) || {items} ELSE '```json  ' || {items} || chr(9) || '```' END").replace(
    "{items}", "'{{\"results\": [{{\"detections\": [' || {items} || ']}}]}}'")


def _wrap_sql(items: str, glued: str) -> str:
    return ("CASE o_orderkey % 5 WHEN 0 THEN '[' || " + items + " || ']' WHEN 1 THEN " + glued + " "
            "WHEN 2 THEN " + _FENCED.format(items=items) + " "
            "WHEN 3 THEN '{\"detections\": [' || " + items + " || ']}' "
            "ELSE '{\"meta\": \"v1\", \"items\": [' || " + items + " || ', 7]}' END")


def _files(spark, d, both=False):
    """(label files, prediction files).  With ``both`` read, the files are
    composed and written once."""
    li = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey", "l_suppkey",
                                            "l_linenumber")
    rows = li.selectExpr("o_orderkey", "l_linenumber", f"{_TRUTH_LINE} AS tline", f"{_ITEM_SQL} AS item")
    per = rows.groupBy("o_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "tline", "item")))
                                         .alias("_xs"))
    per = per.select("o_orderkey", F.array_join(F.transform("_xs", lambda x: x["tline"]), "\n").alias("truth"),
                     F.array_join(F.transform("_xs", lambda x: x["item"]), ", ").alias("items"),
                     F.array_join(F.transform("_xs", lambda x: x["item"]), "").alias("glued"))
    per = per.selectExpr("o_orderkey", "truth", f"{_wrap_sql('items', 'glued')} AS pred")
    if both:
        per = materialize(per, "files")
    truth = per.selectExpr("'img_' || CAST(o_orderkey AS STRING) || '.txt' AS name", "truth AS content")
    # every 11th image has an earlier file of the same stem, which the later name replaces
    preds = per.filter("o_orderkey % 13 <> 0").selectExpr(
        "o_orderkey", "explode(CASE WHEN o_orderkey % 11 = 0 THEN array('.json', '.bak') ELSE array('.json') END) AS ext",
        "pred").selectExpr("'img_' || CAST(o_orderkey AS STRING) || ext AS name",
                           "CASE WHEN ext = '.json' THEN pred ELSE '[{\"cls\": \"Fluke\"}]' END AS content")
    return truth, preds


_WSR = "[ \\t\\n\\r\\f\\x0B\\x{3000}]"


def _st(x: str) -> str:
    return f"regexp_replace({x}, '^{_WSR}+|{_WSR}+$', '', 'g')"


def _valid(x: str) -> str:
    a = f"'[' || {x} || ']'"
    return f"(CASE WHEN json_valid({a}) THEN json_array_length({a}) = 1 AND {_st(x)} <> 'null' ELSE false END)"


_FILES_SQL = f"""
fr AS (SELECT o_orderkey, l_linenumber, {_TRUTH_LINE} AS tline, {_ITEM_SQL} AS item
       FROM (SELECT l_orderkey AS o_orderkey, * FROM lineitem)),
fo AS (SELECT o_orderkey, string_agg(tline, chr(10) ORDER BY l_linenumber, tline, item) AS truth,
              string_agg(item, ', ' ORDER BY l_linenumber, tline, item) AS items, string_agg(item, '' ORDER BY l_linenumber, tline, item) AS glued
       FROM fr GROUP BY o_orderkey),
files AS (SELECT o_orderkey, truth, {_wrap_sql('items', 'glued')} AS pred FROM fo),
truthf AS (SELECT 'img_' || CAST(o_orderkey AS VARCHAR) AS stem, truth AS content FROM files),
predf AS (SELECT 'img_' || CAST(o_orderkey AS VARCHAR) AS stem, pred AS content FROM files WHERE o_orderkey % 13 <> 0),
tl AS (SELECT stem, unnest(range(0, len(ls))) AS pos, unnest(ls) AS line FROM (
  SELECT stem, list_filter(regexp_split_to_array(content, '\\r\\n|\\r|\\n'), lambda l: length({_st('l')}) > 0) AS ls
  FROM truthf)),
truth AS (SELECT stem, CAST(pos AS INTEGER) AS pos,
                 TRY_CAST(regexp_split_to_array({_st('line')}, '\\s+')[1] AS INTEGER) AS true_id FROM tl),
p0 AS (SELECT stem, {_st('content')} AS c FROM predf),
pb AS (SELECT stem, c, string_split(c, '```') AS parts FROM p0),
pw AS (SELECT stem, c, [CASE WHEN starts_with(parts[2 * i], 'json') THEN substr(parts[2 * i], 5)
                             WHEN length(regexp_extract(parts[2 * i], '^[A-Za-z]+[ \\t\\r\\n]')) > 0
                             THEN substr(parts[2 * i], length(regexp_extract(parts[2 * i], '^[A-Za-z]+')) + 1)
                             ELSE parts[2 * i] END
                        FOR i IN range(1, CAST((len(parts) - 1) // 2 + 1 AS BIGINT))] AS blocks FROM pb),
p1 AS (SELECT stem, c, list_filter(list_transform(blocks, lambda b: {_st('b')}), lambda b: {_valid('b')})[1] AS fenced,
              '[' || replace(c, '}}{{', '}},{{') || ']' AS glued FROM pw),
p2 AS (SELECT stem, CASE WHEN c = '' THEN NULL WHEN contains(c, '```') AND fenced IS NOT NULL THEN fenced
                         WHEN {_valid('c')} THEN c WHEN {_valid('glued')} THEN glued END AS js FROM p1),
p3 AS (SELECT stem, js, json_type(js) AS jt FROM p2 WHERE js IS NOT NULL),
p4 AS (SELECT stem, CASE
   WHEN jt = 'ARRAY' THEN json_extract(js, '$[*]')
   WHEN jt = 'OBJECT' AND json_type(js, '$.results') = 'ARRAY' THEN flatten(list_transform(
        json_extract(js, '$.results[*]'), lambda r: CASE WHEN json_type(r, '$.detections') = 'ARRAY'
        THEN json_extract(r, '$.detections[*]') ELSE CAST([] AS JSON[]) END))
   WHEN jt = 'OBJECT' AND json_type(js, '$.detections') = 'ARRAY' THEN json_extract(js, '$.detections[*]')
   WHEN jt = 'OBJECT' THEN list_filter(flatten(list_transform(json_keys(js), lambda k:
        CASE WHEN json_type(json_extract(js, '$."' || k || '"')) = 'ARRAY'
             THEN json_extract(json_extract(js, '$."' || k || '"'), '$[*]') ELSE CAST([] AS JSON[]) END)),
        lambda o: json_type(o) = 'OBJECT' AND (json_exists(o, '$.cls') OR json_exists(o, '$.class')))
   END AS items FROM p3),
p5 AS (SELECT stem, unnest(range(0, len(items))) AS i, unnest(items) AS item FROM p4),
p6 AS (SELECT stem, i, {_st("coalesce(nullif(json_extract_string(item, '$.cls'), ''), nullif(json_extract_string(item, '$.class'), ''), '')")}
              AS cls_name FROM p5 WHERE json_type(item) = 'OBJECT'),
vocab2 AS (SELECT * FROM (VALUES {", ".join(f"({i}, '{n}')" for i, n in enumerate(EV.CLASS_NAMES))}) v(class_id, class_name)),
p7 AS (SELECT p6.stem, p6.i, p6.cls_name, v.class_id AS pred_id FROM p6 JOIN vocab2 v ON v.class_name = p6.cls_name
       WHERE length(p6.cls_name) > 0),
preds AS (SELECT stem, CAST(row_number() OVER (PARTITION BY stem ORDER BY i) - 1 AS INTEGER) AS pos, cls_name, pred_id
          FROM p7)"""


def _det_parse(spark, d, both=False):
    truth_files, pred_files = _files(spark, d, both)
    preds, _rejects = EV.parse_predictions(EV.latest_by_stem(pred_files))
    truth = EV.parse_label_lines(truth_files)
    return truth, preds


@register("detections_parse", f"WITH {_FILES_SQL} SELECT stem, pos, cls_name, pred_id FROM preds")
def detections_parse(spark, d):
    return _det_parse(spark, d)[1]


@register("detections_align", f"WITH {_FILES_SQL} SELECT t.stem, t.pos, t.true_id, p.pred_id "
          "FROM truth t JOIN preds p ON p.stem = t.stem AND p.pos = t.pos")
def detections_align(spark, d):
    truth, preds = _det_parse(spark, d, both=True)
    return EV.align(truth, preds)


@register("detections_rejects", f"""WITH {_FILES_SQL}
SELECT stem, 'unknown class' AS reason, cls_name FROM p6
WHERE length(cls_name) > 0 AND cls_name NOT IN (SELECT class_name FROM vocab2)
UNION ALL SELECT stem, 'no JSON', NULL FROM p2 WHERE js IS NULL""")
def detections_rejects(spark, d):
    return EV.parse_predictions(EV.latest_by_stem(_files(spark, d)[1]))[1]


@register("detections_missing", f"""WITH {_FILES_SQL}
SELECT stem, 'prediction' AS lacks FROM truthf WHERE stem NOT IN (SELECT stem FROM predf)
UNION ALL SELECT stem, 'label' FROM predf WHERE stem NOT IN (SELECT stem FROM truthf)""")
def detections_missing(spark, d):
    return EV.missing_files(*_files(spark, d))


# ---------------------------------------------------------------- detection mAP
# Boxes composed from line items (one row a key): an image is 32 order keys, truth
# box per line item, a jittered prediction with a score, sometimes with the neighbouring class.
_BOX_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
_IMAGE = "CAST(floor(l_orderkey / 32) AS BIGINT) AS image"
_GT_BOX = [_IMAGE, "CAST(l_partkey % 11 AS INT) AS class_id",
           "CAST((l_suppkey % 50) * 10 AS DOUBLE) AS x1", "CAST((l_partkey % 40) * 10 AS DOUBLE) AS y1",
           "CAST((l_suppkey % 50) * 10 + 20 + l_quantity AS DOUBLE) AS x2",
           "CAST((l_partkey % 40) * 10 + 20 + l_quantity AS DOUBLE) AS y2"]
_PRED_BOX = [_IMAGE,
             "CAST((l_partkey + CASE WHEN l_suppkey % 5 = 0 THEN 1 ELSE 0 END) % 11 AS INT) AS class_id",
             "((l_orderkey * 8 + l_linenumber) * 100000 + l_partkey) * 1000 + l_suppkey AS pred_id", "CAST(1.0 - l_discount + l_tax AS DOUBLE) AS score",
             "CAST((l_suppkey % 50) * 10 + (l_linenumber % 4) * 3 AS DOUBLE) AS x1",
             "CAST((l_partkey % 40) * 10 + (l_linenumber % 3) * 2 AS DOUBLE) AS y1",
             "CAST((l_suppkey % 50) * 10 + 20 + l_quantity + (l_linenumber % 5) AS DOUBLE) AS x2",
             "CAST((l_partkey % 40) * 10 + 20 + l_quantity AS DOUBLE) AS y2"]

_INTER = ("greatest(least(p.x2, g.x2) - greatest(p.x1, g.x1), 0.0) * greatest(least(p.y2, g.y2) - greatest(p.y1, g.y1), 0.0)")
_AREAS = "(p.x2 - p.x1) * (p.y2 - p.y1) + (g.x2 - g.x1) * (g.y2 - g.y1)"


# every pair of an image and class; one prediction a step takes the first box on its list that is free
@register("detection_map", f"""WITH RECURSIVE
li AS (SELECT {", ".join(_BOX_KEY)}, max(l_quantity) AS l_quantity, max(l_discount) AS l_discount, max(l_tax) AS l_tax
       FROM lineitem GROUP BY {", ".join(_BOX_KEY)}),
g0 AS (SELECT {", ".join(_GT_BOX)} FROM li),
gt AS (SELECT *, row_number() OVER (PARTITION BY image, class_id ORDER BY x1, y1, x2, y2) AS gid FROM g0),
pr AS (SELECT {", ".join(_PRED_BOX)} FROM li),
th AS (SELECT unnest(range(0, 10)) AS t),
cand AS (SELECT p.image, p.class_id, p.pred_id, p.score, g.gid, {_INTER} / ({_AREAS} - {_INTER}) AS iou
         FROM pr p JOIN gt g ON g.image = p.image AND g.class_id = p.class_id),
want AS (SELECT t, image, class_id, pred_id, score, list(gid ORDER BY iou DESC, gid) AS boxes
         FROM cand, th WHERE iou >= 0.5 + 0.05 * t - 1e-12 GROUP BY ALL),
line AS (SELECT *, row_number() OVER (PARTITION BY t, image, class_id ORDER BY score DESC, pred_id) AS turn FROM want),
walk AS (SELECT t, image, class_id, pred_id, turn, boxes[1] AS took, [boxes[1]] AS used FROM line WHERE turn = 1
  UNION ALL
  SELECT t, image, class_id, pred_id, turn, took, CASE WHEN took IS NULL THEN used ELSE list_append(used, took) END
  FROM (SELECT l.t, l.image, l.class_id, l.pred_id, l.turn, w.used,
               list_filter(l.boxes, lambda b: NOT list_contains(w.used, b))[1] AS took
        FROM walk w JOIN line l ON l.t = w.t AND l.image = w.image AND l.class_id = w.class_id AND l.turn = w.turn + 1)),
tp AS (SELECT th.t, pr.class_id, pr.image, pr.pred_id, pr.score, CASE WHEN w.took IS NULL THEN 0 ELSE 1 END AS hit
       FROM pr CROSS JOIN th LEFT JOIN walk w
       ON w.t = th.t AND w.image = pr.image AND w.class_id = pr.class_id AND w.pred_id = pr.pred_id),
prec AS (SELECT *, sum(hit) OVER o / row_number() OVER o AS precision FROM tp
         WINDOW o AS (PARTITION BY t, class_id ORDER BY score DESC, image, pred_id)),
env AS (SELECT *, max(precision) OVER (PARTITION BY t, class_id ORDER BY score, image DESC, pred_id DESC
                                       ROWS UNBOUNDED PRECEDING) AS envelope FROM prec),
ngt AS (SELECT class_id, count(*) AS n_gt FROM gt GROUP BY 1),
ap AS (SELECT t, class_id, sum(hit * envelope) / any_value(n_gt) AS ap FROM env JOIN ngt USING (class_id) GROUP BY 1, 2),
per AS (SELECT class_id, n_gt, coalesce((SELECT ap FROM ap a WHERE a.class_id = n.class_id AND t = 0), 0.0) AS ap50,
               coalesce((SELECT sum(ap) / 10 FROM ap a WHERE a.class_id = n.class_id), 0.0) AS ap50_95,
               (SELECT count(*) FROM tp WHERE t = 0 AND tp.class_id = n.class_id) AS n_pred,
               (SELECT coalesce(sum(hit), 0) FROM tp WHERE t = 0 AND tp.class_id = n.class_id) AS tp50 FROM ngt n),
alls AS (SELECT CAST(class_id AS VARCHAR) AS class, ap50, ap50_95, n_gt, n_pred, tp50 FROM per
         UNION ALL SELECT 'all', avg(ap50), avg(ap50_95), sum(n_gt), sum(n_pred), sum(tp50) FROM per)
SELECT class, round(ap50, 6) AS ap50, round(ap50_95, 6) AS ap50_95, CAST(n_gt AS BIGINT) AS n_gt,
       CAST(n_pred AS BIGINT) AS n_pred, round(CASE WHEN n_pred > 0 THEN tp50 / n_pred ELSE 0.0 END, 6) AS precision,
       round(tp50 / n_gt, 6) AS recall FROM alls""")
def detection_map(spark, d):
    li = materialize(table(spark, d, "lineitem").groupBy(*_BOX_KEY).agg(
        *[F.max(c).alias(c) for c in ("l_quantity", "l_discount", "l_tax")]), "boxes")  # both sides, and the counts, read it
    gt = li.selectExpr(*_GT_BOX)
    preds = li.selectExpr(*_PRED_BOX)
    out = EV.detection_map(gt, preds)
    return out.select("class", *[F.round(c, 6).alias(c) for c in ("ap50", "ap50_95")], "n_gt", "n_pred",
                      F.round("precision", 6).alias("precision"), F.round("recall", 6).alias("recall"))
