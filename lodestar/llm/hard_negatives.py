"""Hard negatives by integer inner product: rotated one-bit codes with stored
alignments give every pair an interval, and only pairs whose interval may
matter are scored."""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize

LEVELS = 6   # one-bit codes per vector: of it, and of what the codes before left over
PLANES = 8   # bit planes of an anchor's rotated components
LOWEST = np.iinfo(np.int64).min


@lru_cache(maxsize=64)
def rotation(dim: int, level: int) -> np.ndarray:
    """The fixed random rotation of a length that comes before a level."""
    q, r = np.linalg.qr(np.random.default_rng([dim, level]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def _words(bits: np.ndarray) -> np.ndarray:
    """Rows of booleans as rows of 64-bit words."""
    packed = np.packbits(bits, axis=-1, bitorder="little")
    pad = -packed.shape[-1] % 8
    packed = np.pad(packed, [(0, 0)] * (packed.ndim - 1) + [(0, pad)])
    return np.ascontiguousarray(packed).view(np.uint64)


class Codes:
    """One-bit codes of integer vectors.  With y the rotated vector, level 1
    stores the signs t of y, its alignment a = <y, t> / root(dim), and the
    norm of the residual y - a t / root(dim), which is orthogonal to t; the
    next level rotates the residual and does the same with it."""

    def __init__(self, x: np.ndarray, levels: int = LEVELS):
        dim = x.shape[1]
        rest = x.astype(np.float64)
        self.bits, self.align, self.left, self.ones = [], [], [], []
        for level in range(levels):
            rest = rest @ rotation(dim, level)
            sign = rest >= 0
            a = np.abs(rest).sum(1) / math.sqrt(dim)
            rest = rest - np.where(sign, a[:, None], -a[:, None]) / math.sqrt(dim)
            self.bits.append(_words(sign))
            self.ones.append(sign.sum(1).astype(np.float64))
            self.align.append(a)
            self.left.append(np.sqrt((rest ** 2).sum(1)))


class Planes:
    """An anchor's rotated components, for every level, as ``PLANES`` bit
    planes over a grid (low + step * 0 .. 255), and the norm of what the grid
    leaves over."""

    def __init__(self, x: np.ndarray, levels: int = LEVELS):
        self.dim = x.shape[1]
        y = x.astype(np.float64)
        self.norm = np.sqrt((y ** 2).sum(1))
        self.low, self.step, self.error, self.words, self.total = [], [], [], [], []
        for level in range(levels):
            y = y @ rotation(self.dim, level)
            low = y.min(1)
            step = np.maximum((y.max(1) - low) / (2 ** PLANES - 1), 1e-300)
            grid = np.clip(np.rint((y - low[:, None]) / step[:, None]), 0, 2 ** PLANES - 1).astype(np.int64)
            self.low.append(low)
            self.step.append(step)
            self.error.append(np.sqrt(((y - low[:, None] - step[:, None] * grid) ** 2).sum(1)))
            self.words.append([_words(grid >> b & 1 == 1) for b in range(PLANES)])
            self.total.append(grid.sum(1).astype(np.float64))

    def along(self, rows: np.ndarray, codes: Codes, level: int, cols: np.ndarray) -> np.ndarray:
        """<anchor on the grid, unit code> of pairs, by popcounts."""
        t = codes.bits[level][cols]
        dot = np.zeros(len(rows))
        for b, words in enumerate(self.words[level]):
            dot += 2.0 ** (b + 1) * np.bitwise_count(words[rows] & t).sum(-1, dtype=np.int64)
        low, step = self.low[level][rows], self.step[level][rows]
        return (low * (2 * codes.ones[level][cols] - self.dim) + step * (dot - self.total[level][rows])) / math.sqrt(self.dim)


def intervals(planes: Planes, codes: Codes, rows: np.ndarray, cols: np.ndarray, level: int, centre: np.ndarray,
              grid: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(centre, grid error, low, high) of the pairs' inner products after
    ``level``, from centre and error of the levels before.  What the codes leave over is orthogonal to
    the last code, so by Cauchy-Schwarz it adds at most its norm times the
    norm of the anchor's part that is orthogonal to that code too."""
    g = planes.along(rows, codes, level, cols)
    centre = centre + codes.align[level][cols] * g
    error = planes.error[level][rows]
    grid = grid + error * codes.align[level][cols]
    off = np.sqrt(np.maximum(planes.norm[rows] ** 2 - np.maximum(np.abs(g) - error, 0.0) ** 2, 0.0))
    whole = np.sqrt(codes.align[0][cols] ** 2 + codes.left[0][cols] ** 2)
    wide = codes.left[level][cols] * off + grid + 1e-9 * (1 + planes.norm[rows] * whole)
    return centre, grid, centre - wide, centre + wide


def _kth(row: np.ndarray, value: np.ndarray, n: int, k: int) -> np.ndarray:
    """The k-th largest value of each row, -inf where there are fewer."""
    order = np.lexsort((-value, row))
    row, value = row[order], value[order]
    nth = np.arange(len(row)) - np.searchsorted(row, row)
    out = np.full(n, -np.inf)
    out[row[nth == k - 1]] = value[nth == k - 1]
    return out


def _scores(a: np.ndarray, b: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Integer inner products of pairs of rows."""
    if float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1] >= 2.0 ** 63:
        exact = [sum(int(x) * int(y) for x, y in zip(a[r], b[c])) for r, c in zip(rows.tolist(), cols.tolist())]
        return np.array([min(max(v, LOWEST + 1), 2 ** 63 - 1) for v in exact], np.int64)
    out = np.empty(len(rows), np.int64)
    for s in range(0, len(rows), 1 << 16):
        part = slice(s, s + (1 << 16))
        out[part] = np.einsum("ij,ij->i", a[rows[part]], b[cols[part]])
    return out


def _first(row: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of each row's first ``k``: larger score, then smaller id."""
    order = np.lexsort((ids, ~score, row))
    return order[np.arange(len(order)) - np.searchsorted(row[order], row[order]) < k]


def _refined(planes: Planes, codes: Codes, rows: np.ndarray, cols: np.ndarray, n: int, keep) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that ``keep(rows, low, high)`` leaves after every level."""
    centre, grid = np.zeros(len(rows)), np.zeros(len(rows))
    for level in range(len(codes.bits)):
        if not len(rows):
            break
        centre, grid, low, high = intervals(planes, codes, rows, cols, level, centre, grid)
        stay = keep(rows, low, high)
        rows, cols, centre, grid = rows[stay], cols[stay], centre[stay], grid[stay]
    return rows, cols


def best_same(a: dict, b: dict, k: int, step: int = 1 << 20) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(anchor place, row place, score) of each anchor's first ``k`` rows of
    its label in a block, and the number of pairs that were scored."""
    planes, codes = Planes(a["x"]), b["codes"]
    n, scored, found = len(a["id"]), 0, []
    for label in np.unique(a["label"]):
        mine, theirs = np.flatnonzero(a["label"] == label), np.flatnonzero(b["label"] == label)
        for part in np.array_split(mine, max(1, -(-len(mine) * len(theirs) // step))):
            rows, cols = (x.reshape(-1) for x in np.meshgrid(part, theirs, indexing="ij"))
            other = a["id"][rows] != b["id"][cols]
            rows, cols = _refined(planes, codes, rows[other], cols[other], n,
                                  lambda r, low, high: high >= _kth(r, low, n, k)[r])
            score = _scores(a["x"], b["x"], rows, cols)
            scored += len(rows)
            top = _first(rows, score, b["id"][cols], k)
            found.append((rows[top], cols[top], score[top]))
    rows, cols, score = (np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in range(3))
    return rows, cols, score, scored


def best_below(a: dict, b: dict, k: int, share: tuple[int, int], step: int = 1 << 20
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """(anchor place, target, row place, score): for every anchor and each of
    its ``targets`` (scores; the first ``held`` of them count) the first ``k`` rows of
    another label with share[0] * target <= share[1] * score <= share[1] *
    target, and the number of pairs that were scored."""
    planes, codes = Planes(a["x"]), b["codes"]
    n, scored, found = len(a["id"]), 0, []
    targets, held = a["targets"], a["held"]
    floors = -((-share[0] * targets.astype(object)) // share[1])
    least, most = floors.astype(np.float64), targets.astype(np.float64)

    def open_(rows: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        stay = np.zeros(len(rows), bool)
        for t in range(targets.shape[1]):
            ask = t < held[rows]
            sure = ask & (low >= least[rows, t]) & (high <= most[rows, t])
            floor = np.maximum(least[:, t], _kth(rows[sure], low[sure], n, k))
            stay |= ask & (high >= floor[rows]) & (low <= most[rows, t])
        return stay

    per = max(1, step // max(1, len(b["id"])))
    busy = np.flatnonzero(held > 0)
    for s in range(0, len(busy), per):
        rows, cols = (x.reshape(-1) for x in np.meshgrid(busy[s:s + per], np.arange(len(b["id"])), indexing="ij"))
        other = (a["id"][rows] != b["id"][cols]) & (a["label"][rows] != b["label"][cols])
        rows, cols = _refined(planes, codes, rows[other], cols[other], n, open_)
        score = _scores(a["x"], b["x"], rows, cols)
        scored += len(rows)
        for t in range(targets.shape[1]):
            # share[0] * target <= share[1] * score, in whole numbers: score >= ceil(share[0] * target / share[1])
            ok = np.flatnonzero((t < held[rows]) & (score <= targets[rows, t])
                                & (score >= np.array(floors[rows, t], np.int64)))
            top = ok[_first(rows[ok], score[ok], b["id"][cols[ok]], k)]
            found.append((rows[top], np.full(len(top), t), cols[top], score[top]))
    rows, target, cols, score = (np.concatenate([f[i] for f in found]).astype(np.int64) if found else np.zeros(0, np.int64)
                                 for i in range(4))
    return rows, target, cols, score, scored


# ------------------------------------------------------------ Spark
_PACKED = "id binary, label array<string>, x binary, width int, codes binary, align binary, left binary"


def _small(x: np.ndarray) -> np.ndarray:
    """The same integers in the narrowest type that holds them."""
    for kind in (np.int16, np.int32):
        if not len(x) or (x.min() >= np.iinfo(kind).min and x.max() <= np.iinfo(kind).max):
            return x.astype(kind)
    return x


def _pack(table: pa.Table, dim: int) -> dict[str, object]:
    """One row that holds a block of vectors and their codes."""
    x = table["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dim)
    codes = Codes(x)
    small = _small(x)
    return {"id": table["id"].to_numpy().astype(np.int64).tobytes(), "label": table["label"].to_pylist(),
            "x": small.tobytes(), "width": small.itemsize,
            "codes": np.stack(codes.bits).tobytes(), "align": np.stack(codes.align).tobytes(), "left": np.stack(codes.left).tobytes()}


def _unpack(row: dict, dim: int) -> dict:
    ids = np.frombuffer(row["id"], np.int64)
    n = len(ids)
    codes = Codes.__new__(Codes)
    codes.bits = list(np.frombuffer(row["codes"], np.uint64).reshape(LEVELS, n, -1))
    codes.align = list(np.frombuffer(row["align"], np.float64).reshape(LEVELS, n))
    codes.left = list(np.frombuffer(row["left"], np.float64).reshape(LEVELS, n))
    codes.ones = [np.bitwise_count(b).sum(-1).astype(np.float64) for b in codes.bits]
    kind = {2: np.int16, 4: np.int32, 8: np.int64}[row["width"]]
    return {"id": ids, "label": np.array(row["label"], object), "codes": codes,
            "x": np.frombuffer(row["x"], kind).astype(np.int64).reshape(n, dim)}


def _labels_as_numbers(a: dict, b: dict) -> None:
    _, number = np.unique(np.concatenate([a["label"], b["label"]]).astype(str), return_inverse=True)
    a["label"], b["label"] = number[:len(a["label"])], number[len(a["label"]):]


def hard_negatives(vectors: DataFrame, anchors: Column, *, id_col: str = "vec_id", vec_col: str = "vector",
                   label_col: str = "label", positives: int = 5, negatives: int = 5, share: tuple[int, int] = (80, 100),
                   anchor_block: int = 2048, vector_block: int = 4096) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score): for every row that ``anchors`` holds for and each of its
    first ``positives`` other rows of the same label, the first ``negatives``
    rows of other labels whose score is at most the positive's and at least
    share[0] / share[1] of it.

    A score is the integer inner product with the anchor (``vec_col`` is an
    array of long); higher ones come first, ties by the smaller id.  Rows with
    a null id, label or vector, an empty vector or a null component take no
    part, and only vectors of one length are compared.  Rows that carry the
    anchor's id are not its candidates.  Rows that repeat an id are rows of
    their own; equal anchors count once, and a row that repeats more often
    than a list is long appears as often as the list can hold it.  A positive
    score below 0 admits no negative.  Scores beyond 64 bits stop at its ends.

    All rows are indexed: a block of about ``vector_block`` vectors, chosen by
    hash whatever the labels, is one packed row with codes.  Each block of
    anchors meets each block of vectors twice, for the positives and, once
    these are known, for the negatives; a task returns at most ``positives``
    rows an anchor, and ``negatives`` for each positive.  Nothing is broadcast
    or collected but two counts."""
    k = max(positives, negatives)
    x = F.col(vec_col)
    clean = vectors.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & x.isNotNull() & (F.size(x) > 0)
                           & ~F.exists(x, lambda v: v.isNull())).select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"),
        x.cast("array<long>").alias("x"), F.coalesce(anchors, F.lit(False)).alias("a"))
    rows = materialize(clean.groupBy("id", "label", "x").agg(
        F.count(F.lit(1)).alias("n"), F.max("a").alias("a")).withColumn("d", F.size("x")), "negatives")
    asked = rows.filter("a").select(F.xxhash64("id", "label", "x").alias("q"), "id", "label", "x", "d")
    nv, na = (max(1, math.ceil(df.count() / size)) for df, size in ((rows, vector_block), (asked, anchor_block)))

    def pack_block(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        packed = _pack(table, key[0].as_py())
        return pa.table({"d": [key[0].as_py()], "vb": [key[1].as_py()], **{c: [v] for c, v in packed.items()}}).cast(
            pa.schema([("d", pa.int32()), ("vb", pa.int32()), ("id", pa.binary()), ("label", pa.list_(pa.string())),
                       ("x", pa.binary()), ("width", pa.int32())] + [(c, pa.binary()) for c in ("codes", "align", "left")]))

    copies = rows.select("id", "label", "x", "d", F.explode(F.sequence(F.lit(1), F.least("n", F.lit(k)).cast("int"))).alias("c"))
    blocks = materialize(copies.withColumn("vb", F.pmod(F.xxhash64("id", "x", "c"), F.lit(nv)).cast("int"))
                         .groupBy("d", "vb").applyInArrow(pack_block, f"d int, vb int, {_PACKED}"), "codes")
    spread = blocks.withColumn("ab", F.explode(F.sequence(F.lit(0), F.lit(na - 1))))

    def meet(left: DataFrame, score, schema: str) -> DataFrame:
        there = left.withColumn("ab", F.pmod(F.col("q"), F.lit(na)).cast("int")).withColumn(
            "vb", F.explode(F.sequence(F.lit(0), F.lit(nv - 1))))
        return there.groupBy("d", "ab", "vb").cogroup(spread.groupBy("d", "ab", "vb")).applyInArrow(score, schema)

    def anchors_of(table: pa.Table, dim: int) -> dict:
        return {"q": table["q"].to_numpy().astype(np.int64), "id": table["id"].to_numpy().astype(np.int64),
                "label": np.array(table["label"].to_pylist(), object),
                "x": table["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dim)}

    def same(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["q", "positive_id", "positive_score"]
        if not len(left) or not len(right):
            return pa.table([pa.array([], pa.int64())] * 3, names=names)
        dim = key[0].as_py()
        a, b = anchors_of(left, dim), _unpack(right.to_pylist()[0], dim)
        _labels_as_numbers(a, b)
        at, col, score, _ = best_same(a, b, positives)
        return pa.table([pa.array(c, pa.int64()) for c in (a["q"][at], b["id"][col], score)], names=names)

    near = meet(asked, same, "q long, positive_id long, positive_score long")
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("positive_score"), "positive_id"))
    chosen = materialize(near.withColumn("place", place).filter(F.col("place") <= positives), "positives")
    told = asked.join(chosen.groupBy("q").agg(F.array_sort(F.collect_list(F.struct("place", "positive_score"))).alias("p")), "q")
    told = told.withColumn("targets", F.transform("p", lambda p: p["positive_score"])).drop("p")

    def other(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["q", "anchor_id", "place", "negative_id", "negative_score"]
        if not len(left) or not len(right):
            return pa.table([pa.array([], pa.int64())] * 5, names=names)
        dim = key[0].as_py()
        a, b = anchors_of(left, dim), _unpack(right.to_pylist()[0], dim)
        _labels_as_numbers(a, b)
        lists = left["targets"].to_pylist()
        a["held"] = np.array([len(v) for v in lists])
        a["targets"] = np.array([v + [0] * (positives - len(v)) for v in lists], np.int64)
        at, target, col, score, _ = best_below(a, b, negatives, share)
        cells = (a["q"][at], a["id"][at], target + 1, b["id"][col], score)
        return pa.table([pa.array(c, pa.int64()) for c in cells], names=names)

    found = meet(told, other, "q long, anchor_id long, place long, negative_id long, negative_score long")
    rank = F.row_number().over(Window.partitionBy("q", "place").orderBy(F.desc("negative_score"), "negative_id"))
    kept = found.withColumn("rank", rank).filter(F.col("rank") <= negatives)
    return kept.join(chosen, ["q", "place"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                                                    "negative_score")
