"""Matching predicted boxes to truth boxes, on keys instead of per image.

Two boxes whose IoU reaches ``least`` have like widths and heights and near
centres, so they share a cell of a grid whose pitch follows the box size.
Cells are an equi-join key; a crowded image, or a class that holds most boxes,
spreads over its cells.  The greedy rule (predictions by falling score take
their best free truth box) is the one stable matching between "best IoU first"
and "best score first", so it is found in rounds over all groups at once."""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

_SIDES = ("x1", "y1", "x2", "y2")
_GROUP = ["image", "class_id"]
_ROUNDING = 1e-9  # slack of the grid's reach, so that rounding loses no pair
_SALTS = 64
_CROWD = 256  # boxes of one side from which on a group goes by cells


def iou(p: str, g: str) -> Column:
    """Intersection over union of two boxes of positive area."""
    c = {f"{s}_{side}": F.col(f"{s}.{side}") for s in (p, g) for side in _SIDES}
    w = F.least(c[f"{p}_x2"], c[f"{g}_x2"]) - F.greatest(c[f"{p}_x1"], c[f"{g}_x1"])
    h = F.least(c[f"{p}_y2"], c[f"{g}_y2"]) - F.greatest(c[f"{p}_y1"], c[f"{g}_y1"])
    inter = F.greatest(w, F.lit(0.0)) * F.greatest(h, F.lit(0.0))
    area = [(c[f"{s}_x2"] - c[f"{s}_x1"]) * (c[f"{s}_y2"] - c[f"{s}_y1"]) for s in (p, g)]
    return inter / (area[0] + area[1] - inter)


def _solid(box: str) -> Column:
    """Boxes of positive, finite extent; others overlap nothing."""
    def extent(lo: str, hi: str) -> Column:
        d = F.col(f"{box}.{hi}") - F.col(f"{box}.{lo}")
        return (d > 0) & (d < float("inf"))
    return extent("x1", "x2") & extent("y1", "y2")


def _level(size: Column) -> Column:
    return F.floor(F.log(4.0, size)).cast("int")


def _own_cell(box: str, lo: str, hi: str) -> Column:
    """The one cell that holds the box's centre, at the level of its size."""
    a, b = F.col(f"{box}.{lo}"), F.col(f"{box}.{hi}")
    level = _level(b - a)
    return F.struct(level.alias("level"), F.floor((a + b) / 2 / F.pow(F.lit(4.0), level + 1)).alias("cell"))


def _near_cells(box: str, lo: str, hi: str, least: float) -> Column:
    """Every cell in which a box of IoU >= ``least`` can have its centre.  Sizes
    differ by a factor of at most 1 / least, which leaves two or three levels at
    0.5, and centres by at most half the smaller size there, which leaves one or
    two cells a level."""
    a, b = F.col(f"{box}.{lo}"), F.col(f"{box}.{hi}")
    size, centre = b - a, (a + b) / 2
    factor = (0.5 + max(0.0, 0.5 / least - 1.0)) * (1 + _ROUNDING)
    tight = least * (1 - _ROUNDING)

    def at(level: Column) -> Column:
        pitch = F.pow(F.lit(4.0), level + 1)
        reach = F.least(size, pitch) * factor
        return F.transform(F.sequence(F.floor((centre - reach) / pitch), F.floor((centre + reach) / pitch)),
                           lambda cell: F.struct(level.alias("level"), cell.alias("cell")))
    return F.flatten(F.transform(F.sequence(_level(size * tight), _level(size / tight)), at))


def overlapping_pairs(truth: DataFrame, preds: DataFrame, least: float = 0.5) -> DataFrame:
    """All (truth, prediction) pairs of one image and class with IoU >=
    ``least``, each once.  ``truth``: image, class_id, g (struct of x1, y1, x2,
    y2) and further columns; ``preds``: image, class_id, p (struct) and further
    columns; names must not clash.  A group of up to ``_CROWD`` boxes a side meets
    on its key; only larger ones are spread over cells, which copies a
    prediction to each cell it may reach.  Both sides are read more than once.
    Rows with a null key, or with a box that is
    null, not finite or without area, pair with nothing."""
    if not 0 < least <= 1:
        raise ValueError("least must be in (0, 1]")
    left, right = truth.filter(_solid("g")), preds.filter(_solid("p"))
    large = [side.groupBy(*_GROUP).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > _CROWD).select(*_GROUP)
             for side in (left, right)]
    crowds = materialize(large[0].unionByName(large[1]).distinct(), "crowds")
    if crowds.isEmpty():
        met = left.join(right, _GROUP)
    else:
        calm, full = ([side.join(crowds, _GROUP, how) for side in (left, right)] for how in ("left_anti", "left_semi"))
        own = full[0].withColumn("_x", _own_cell("g", "x1", "x2")).withColumn("_y", _own_cell("g", "y1", "y2"))
        near = (full[1].withColumn("_x", F.explode(_near_cells("p", "x1", "x2", least)))
                .withColumn("_y", F.explode(_near_cells("p", "y1", "y2", least))))
        met = calm[0].join(calm[1], _GROUP).unionByName(own.join(near, [*_GROUP, "_x", "_y"]).drop("_x", "_y"))
    return met.withColumn("iou", iou("p", "g")).filter(F.col("iou") >= least - 1e-12)


def match_detections(gt: DataFrame, preds: DataFrame, thresholds: Sequence[float]) -> DataFrame:
    """(image, class_id, pred_id, score, ``tp_<i>`` int per threshold), one row
    per prediction: 1 where the greedy matching at that IoU threshold gives it a
    truth box.  Predictions of an image and class come by falling score (null
    and NaN last), then pred_id; each takes the free truth box of largest IoU,
    ties to the smaller (x1, y1, x2, y2).

    Equal truth boxes are one node with that many places.  A pair whose
    prediction has no other pair, and whose truth box has a place for every
    candidate, is settled without rounds.  The others meet in rounds: a
    prediction is settled when its best open truth box has it among the best
    scores for its free places.  Every round settles at least the best open
    prediction of each group of linked boxes, so rounds end; their number is
    that of the longest chain of displaced choices, not of the boxes."""
    steps = F.array(*[F.lit(float(t)) for t in thresholds])
    score = F.when(F.col("score").isNull() | F.isnan(F.col("score").cast("double")), F.lit(float("-inf"))) \
        .otherwise(F.col("score").cast("double"))
    p = materialize(preds.select(*_GROUP, "pred_id", "score", F.struct(*[F.col(c).cast("double").alias(c) for c in _SIDES]).alias("p"),
                                 F.monotonically_increasing_id().alias("_p")), "predicted-boxes")
    nodes = materialize(gt.select(*_GROUP, F.struct(*[F.col(c).cast("double").alias(c) for c in _SIDES]).alias("g")) \
        .groupBy(*_GROUP, "g").agg(F.count(F.lit(1)).alias("room")), "truth-boxes")
    turn = F.struct((-score).alias("s"), F.col("pred_id").alias("i"), F.col("_p").alias("p"))
    pairs = materialize(overlapping_pairs(nodes, p.select(*_GROUP, "p", "_p", turn.alias("turn")), min(thresholds))
                        .drop("p"), "box-pairs")

    per_pred = pairs.groupBy("_p").agg(F.count(F.lit(1)).alias("_np"))
    per_node = pairs.groupBy(*_GROUP, "g").agg(F.count(F.lit(1)).alias("_ng"))
    reached = [F.col("iou") >= float(t) - 1e-12 for t in thresholds]
    marked = materialize(pairs.join(per_pred, "_p").join(per_node, [*_GROUP, "g"]).select(
        *_GROUP, "g", "room", "_p", "turn", "iou", ((F.col("_np") == 1) & (F.col("_ng") <= F.col("room"))).alias("_free")),
        "box-pairs-marked")
    # a settled pair is its prediction's only one: its marks are its IoU's, without a row a threshold
    free = marked.filter("_free").select("_p", *[r.cast("int").alias(f"tp_{i}") for i, r in enumerate(reached)])
    open_ = materialize(marked.filter("NOT _free").select(*_GROUP, "g", "room", "_p", "turn", "iou", F.explode(F.filter(
        F.array(*[F.lit(i) for i in range(len(thresholds))]), lambda i: F.col("iou") >= F.get(steps, i) - 1e-12)).alias("t")), "box-open")
    hits = []
    node = ["t", *_GROUP, "g"]
    while not open_.isEmpty():
        # the best scores for a node's places, over salted parts first: a box that many want is no single task
        part = Window.partitionBy(*node, F.pmod("_p", F.lit(_SALTS))).orderBy("turn")
        first = open_.withColumn("_r", F.row_number().over(part)).filter("_r <= room")
        asked = first.withColumn("_r", F.row_number().over(Window.partitionBy(*node).orderBy("turn"))).filter("_r <= room")
        best = open_.groupBy("t", "_p").agg(F.min(F.struct((-F.col("iou")).alias("far"), "g")).alias("_b")) \
            .select("t", "_p", F.col("_b.g").alias("g"))
        took = materialize(asked.join(best, ["t", "_p", "g"]).select(*node, "_p"), "box-round")
        hits.append(took.select("t", "_p"))
        gone = took.groupBy(*node).agg(F.count(F.lit(1)).alias("_n"))
        open_ = materialize(
            open_.join(took.select("t", "_p"), ["t", "_p"], "left_anti").join(gone, node, "left")
            .withColumn("room", F.col("room") - F.coalesce("_n", F.lit(0))).drop("_n").filter("room > 0"), "box-open")
    flags = free
    if hits:
        flags = free.unionByName(reduce(DataFrame.unionByName, hits).groupBy("_p").agg(
            *[F.max((F.col("t") == i).cast("int")).alias(f"tp_{i}") for i in range(len(thresholds))]))
    return p.join(flags, "_p", "left").select(
        *_GROUP, "pred_id", "score", *[F.coalesce(f"tp_{i}", F.lit(0)).alias(f"tp_{i}") for i in range(len(thresholds))])
