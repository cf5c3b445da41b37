"""Box matching on grid cells and in rounds against the plain greedy loop."""
import random

import pytest
from pyspark.sql import functions as F

from lodestar.operators import boxes as B
from lodestar.operators.evaluation import IOU_THRESHOLDS

TRUTH = "image long, class_id int, x1 double, y1 double, x2 double, y2 double"
PREDS = "image long, class_id int, pred_id long, score double, x1 double, y1 double, x2 double, y2 double"


def plain_iou(p, g):
    w = max(min(p[2], g[2]) - max(p[0], g[0]), 0.0)
    h = max(min(p[3], g[3]) - max(p[1], g[1]), 0.0)
    inter = w * h
    return inter / ((p[2] - p[0]) * (p[3] - p[1]) + (g[2] - g[0]) * (g[3] - g[1]) - inter)


def plain_match(truth, preds, threshold):
    hit, free = {}, list(truth)
    for p in sorted(preds, key=lambda p: (p[0], p[1], -p[3], p[2])):
        near = [(-plain_iou(p[4:], g[2:]), g[2:], n) for n, g in enumerate(free)
                if g is not None and g[:2] == p[:2] and plain_iou(p[4:], g[2:]) >= threshold - 1e-12]
        hit[(p[0], p[1], p[2])] = int(bool(near))
        if near:
            free[min(near)[2]] = None
    return hit


def crowded(seed, n_truth, n_pred, span):
    rnd = random.Random(seed)

    def box():
        w, h = rnd.choice([4, 5, 6, 8, 16, 60]), rnd.choice([4, 5, 6, 8, 16, 60])
        x, y = rnd.randrange(-span, span), rnd.randrange(-span, span)
        return (float(x), float(y), float(x + w), float(y + h))
    truth = [(rnd.randrange(2), rnd.randrange(2), *box()) for _ in range(n_truth)]
    truth += truth[:n_truth // 5]  # equal boxes are places of one node
    preds = []
    for i in range(n_pred):
        g = rnd.choice(truth)
        b = tuple(c + rnd.choice([0, 0, 0.5, 1]) for c in g[2:]) if rnd.random() < 0.8 else box()
        preds.append((g[0], g[1], i, rnd.randrange(20) / 20, *b))
    return truth, preds


@pytest.mark.parametrize("seed,n_truth,n_pred,span", [(1, 60, 90, 8), (2, 80, 60, 30), (3, 20, 150, 2)])
def test_same_as_greedy(spark, seed, n_truth, n_pred, span):
    truth, preds = crowded(seed, n_truth, n_pred, span)
    got = B.match_detections(spark.createDataFrame(truth, TRUTH), spark.createDataFrame(preds, PREDS), IOU_THRESHOLDS).collect()
    assert len(got) == len(preds)
    for i in (0, 3, 9):
        want = plain_match(truth, preds, IOU_THRESHOLDS[i])
        assert {(r.image, r.class_id, r.pred_id): r[f"tp_{i}"] for r in got} == want


@pytest.mark.parametrize("least", [0.3, 0.5, 0.75, 1.0])
def test_grid_loses_no_pair(spark, least):
    truth, preds = crowded(7, 120, 120, 20)
    t = spark.createDataFrame([(*r, i) for i, r in enumerate(truth)], TRUTH + ", gid long").select(
        "image", "class_id", F.struct("x1", "y1", "x2", "y2").alias("g"), "gid")
    p = spark.createDataFrame(preds, PREDS).select("image", "class_id", "pred_id", F.struct("x1", "y1", "x2", "y2").alias("p"))
    got = [(r.gid, r.pred_id) for r in B.overlapping_pairs(t, p, least).collect()]
    want = {(i, p[2]) for i, g in enumerate(truth) for p in preds if g[:2] == p[:2] and plain_iou(p[4:], g[2:]) >= least - 1e-12}
    assert len(got) == len(set(got)) and set(got) == want


def test_grid_compares_few(spark):
    """One image and class with 900 boxes in a plane: the join's candidates stay near the number of boxes."""
    rows = [(1, 1, float(10 * x), float(10 * y), float(10 * x + 9), float(10 * y + 9)) for x in range(30) for y in range(30)]
    t = spark.createDataFrame(rows, TRUTH).select("image", "class_id", F.struct("x1", "y1", "x2", "y2").alias("g"))
    p = t.withColumnRenamed("g", "p")
    cells = t.withColumn("_x", B._own_cell("g", "x1", "x2")).withColumn("_y", B._own_cell("g", "y1", "y2"))
    near = p.withColumn("_x", F.explode(B._near_cells("p", "x1", "x2", 0.5))).withColumn("_y", F.explode(B._near_cells("p", "y1", "y2", 0.5)))
    assert cells.join(near, ["image", "class_id", "_x", "_y"]).count() < 12 * len(rows)
    assert B.overlapping_pairs(t, p, 0.5).count() == len(rows)


def test_unusable_boxes(spark):
    nan, inf = float("nan"), float("inf")
    truth = [(1, 0, 0.0, 0.0, 10.0, 10.0), (None, 0, 0.0, 0.0, 10.0, 10.0), (2, 0, 0.0, 0.0, 0.0, 10.0), (2, 0, nan, 0.0, 5.0, inf)]
    preds = [(1, 0, 1, None, 0.0, 0.0, 10.0, 10.0), (1, 0, 2, 0.1, 0.0, 0.0, 10.0, 10.0), (None, 0, 3, 0.5, 0.0, 0.0, 10.0, 10.0),
             (2, 0, 4, 0.5, 0.0, 0.0, 0.0, 10.0), (2, 0, 5, nan, None, 0.0, 5.0, inf), (2, 0, 6, 0.5, 5.0, 5.0, 1.0, 1.0)]
    got = B.match_detections(spark.createDataFrame(truth, TRUTH), spark.createDataFrame(preds, PREDS), [0.5, 0.95]).collect()
    assert {r.pred_id: (r.tp_0, r.tp_1) for r in got} == {1: (0, 0), 2: (1, 1), 3: (0, 0), 4: (0, 0), 5: (0, 0), 6: (0, 0)}
    assert B.match_detections(spark.createDataFrame([], TRUTH), spark.createDataFrame(preds[:2], PREDS), [0.5]).count() == 2
    assert B.match_detections(spark.createDataFrame(truth, TRUTH), spark.createDataFrame([], PREDS), [0.5]).count() == 0


def test_small_groups_meet_without_cells(spark, monkeypatch):
    rows = [(i // 8, 0, 10.0 * (i % 8), 0.0, 10.0 * (i % 8) + 12.0, 9.0) for i in range(64)]
    cols = "image int, class_id int, x1 double, y1 double, x2 double, y2 double"
    t = spark.createDataFrame(rows, cols).selectExpr("image", "class_id", "struct(x1, y1, x2, y2) AS g")
    p = spark.createDataFrame(rows, cols).selectExpr("image", "class_id", "struct(x1, y1, x2, y2) AS p")
    calm = B.overlapping_pairs(t, p)
    assert "Generate" not in calm._jdf.queryExecution().optimizedPlan().toString()  # no copies of a box
    monkeypatch.setattr(B, "_CROWD", 4)
    cells = B.overlapping_pairs(t, p)
    assert "Generate" in cells._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(str, calm.collect())) == sorted(map(str, cells.collect())) and calm.count() == 64


def test_settled_pairs_make_no_row_for_each_threshold(spark, monkeypatch):
    from lodestar.operators import boxes
    rows, keep = {}, boxes.materialize

    def counting(df, purpose, *a):
        out = keep(df, purpose, *a)
        rows.setdefault(purpose, []).append(out.count())
        return out

    monkeypatch.setattr(boxes, "materialize", counting)
    side = [(i, 1, 0.0, 0.0, 10.0, 10.0) for i in range(20)]  # one box an image: no rivals
    gt = spark.createDataFrame(side, "image long, class_id int, x1 double, y1 double, x2 double, y2 double")
    preds = spark.createDataFrame([(i, 1, i, 0.5, 0.0, 0.0, 10.0, 10.0 - i % 5) for i in range(20)],
                                  "image long, class_id int, pred_id long, score double, x1 double, y1 double, x2 double, y2 double")
    steps = [0.5, 0.6, 0.7, 0.8, 0.9, 0.95]
    got = boxes.match_detections(gt, preds, steps).collect()
    for r in got:
        assert [r[f"tp_{i}"] for i in range(6)] == [int((10.0 - r["pred_id"] % 5) / 10 >= t - 1e-12) for t in steps]
    assert len(got) == 20 and rows["box-pairs-marked"] == [20] and sum(rows["box-open"]) == 0 and "box-round" not in rows
