import pytest
from pyspark.sql import functions as F

from lodestar.operators import evaluation as EV


def files(spark, rows):
    return spark.createDataFrame(rows, "name string, content string")


def test_glued_predictions(spark):
    p, rej = EV.parse_predictions(files(spark, [("a.json", '{"cls":"Fluke"}{"cls":"Mansoni"}')]))
    assert [r.pred_id for r in p.orderBy("pos").collect()] == [5, 2]


def test_dropped_class_shifts_positions(spark):
    p, rej = EV.parse_predictions(files(spark, [("a.json", '[{"cls":"Fluke"},{"cls":"??"},{"cls":"Ascarid"}]')]))
    assert [(r.pos, r.pred_id) for r in p.orderBy("pos").collect()] == [(0, 5), (1, 0)]
    assert [r.cls_name for r in rej.collect()] == ["??"]


def test_shapes(spark):
    fenced = 'x\n```json\n{"results": [{"detections": [{"cls": "Hookworm"}]}]}\n```'
    p, _ = EV.parse_predictions(files(spark, [
        ("f.json", fenced), ("d.json", '{"detections": [{"class": " Whipworm "}]}'),
        ("any.json", '{"meta": 1, "boxes": [{"cls": "Egg sac"}, 3, {"x": 1}]}'),
        ("null.json", "null"), ("empty.json", "  ")]))
    got = {(r.stem, r.pred_id) for r in p.collect()}
    assert got == {("f", 1), ("d", 6), ("any", 4)}


def test_unequal_lengths_truncate(spark):
    truth = EV.parse_label_lines(files(spark, [("a.txt", "0 1 1 1 1\n\n3 1 1 1 1\n5 0 0 0 0\n")]))
    preds, _ = EV.parse_predictions(files(spark, [("a.json", '[{"cls":"Ascarid"},{"cls":"Mansoni"}]')]))
    pairs = EV.align(truth, preds).orderBy("pos").collect()
    assert [(r.true_id, r.pred_id) for r in pairs] == [(0, 0), (3, 2)]


def test_latest_by_stem(spark):
    f = files(spark, [("a.json", "1"), ("a.txt", "2"), ("b.json", "3")])
    assert sorted(r.name for r in EV.latest_by_stem(f).collect()) == ["a.txt", "b.json"]


def test_confusion_sums_to_pairs(spark):
    pairs = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (2, 0)], "true_id int, pred_id int")
    cm = EV.confusion_dense(pairs, EV.vocabulary(spark), 11).collect()
    assert len(cm) == 11
    assert sum(sum(r[f"pred_{i}"] for i in range(11)) for r in cm) == 4


def test_report_zero_division(spark):
    pairs = spark.createDataFrame([(0, 1), (1, 1)], "true_id int, pred_id int")
    rep = {r.class_name: r for r in EV.classification_report(pairs, EV.vocabulary(spark)).collect()}
    assert rep["Ascarid"].precision == 0.0 and rep["Hookworm"].precision == 0.5
    assert rep["accuracy"].f1_score == 0.5 and rep["accuracy"].support == 2


def test_detection_map_golden(spark):
    gt = spark.createDataFrame([(1, 0, 0.0, 0.0, 10.0, 10.0), (1, 0, 20.0, 20.0, 30.0, 30.0)],
                               "image long, class_id int, x1 double, y1 double, x2 double, y2 double")
    preds = spark.createDataFrame([(1, 0, 1, 0.9, 0.0, 0.0, 10.0, 10.0), (1, 0, 2, 0.8, 50.0, 50.0, 60.0, 60.0),
                                   (1, 0, 3, 0.7, 20.0, 20.0, 30.0, 30.0)],
                                  "image long, class_id int, pred_id long, score double, "
                                  "x1 double, y1 double, x2 double, y2 double")
    rows = {r["class"]: r for r in EV.detection_map(gt, preds).collect()}
    # precision 1, 1/2, 2/3 at recall 1/2, 1/2, 1 -> envelope 1, 2/3, 2/3 -> AP = 0.5*1 + 0.5*2/3
    assert rows["0"].ap50 == pytest.approx(0.5 + 0.5 * 2 / 3)
    assert rows["all"].ap50 == pytest.approx(0.5 + 0.5 * 2 / 3)
    assert rows["0"].n_gt == 2 and rows["0"].n_pred == 3


def test_fence_forms(spark):
    body = '[{"cls": "Fluke"}]'
    forms = [f"```json\n{body}\n```", f"```json\r\n{body}\r\n```", f"```json{body}```", f"```{body}```", f"```json {body} ```",
             f"x\n```python\ny = 1\n```\nthen ```json\n{body}\n``` end", f"```\n\n{body}```", f"```JSON\t{body}```",
             f"```\nnot json\n``` {body} ```{body}```"]
    p, rejects = EV.parse_predictions(files(spark, [(f"{i}.json", c) for i, c in enumerate(forms)]))
    assert sorted((int(r.stem), r.pred_id) for r in p.collect()) == [(i, 5) for i in range(len(forms))]
    assert rejects.count() == 0
    bad = [f"```json\n{body}", "``````", "```json```", "``` ```"]
    p, rejects = EV.parse_predictions(files(spark, [(f"{i}.json", c) for i, c in enumerate(bad)]))
    assert p.count() == 0 and {r.reason for r in rejects.collect()} == {"no JSON"} and rejects.count() == len(bad)


def test_rejects_and_missing_files_read_each_file_once(spark):
    from lodestar.operators import evaluation as EV
    preds = spark.createDataFrame([("a.json", '[{"cls": "??"}, {"cls": " "}]'), ("b.json", "no"), ("c.json", "null"), (None, "[]"),
                                   ("d.json", '{"cls": "x"}{"class": "y"}')], "name string, content string")
    preds = preds.repartition(2)
    known, rejects = EV.parse_predictions(preds)
    assert sorted(tuple(map(str, r)) for r in rejects.collect()) == [
        ("a", "unknown class", "??"), ("b", "no JSON", "None"), ("d", "unknown class", "x"),
        ("d", "unknown class", "y")]
    assert rejects._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1
    labels = spark.createDataFrame([("a.txt", ""), ("e.txt", ""), (None, "")], "name string, content string").repartition(2)
    missing = EV.missing_files(labels, preds)
    assert sorted(tuple(map(str, r)) for r in missing.collect()) == [
        ("None", "label"), ("None", "prediction"), ("b", "label"), ("c", "label"), ("d", "label"), ("e", "prediction")]
    assert missing._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 2
