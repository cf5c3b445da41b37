"""Mixing sources to target weights by balanced sampling (the cube method)."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import materialize

WORD = r"[^\x20\x09-\x0D]+"
EPS = 1e-9


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ranked(keys: DataFrame, col: str) -> DataFrame:
    """(``col``, ``__rank`` from 0) over distinct values in ascending order,
    null last, without one task that sorts all: values are range partitioned,
    and each partition adds the number of values before it.  The offsets are
    one row per partition."""
    n = max(1, int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    order = [F.col(col).isNull().cast("int"), F.col(col)]
    parts = materialize(keys.select(col).distinct().repartitionByRange(n, *order)
                        .withColumn("__part", F.spark_partition_id()), "ranks")
    sizes = {r["__part"]: r["n"] for r in parts.groupBy("__part").agg(F.count(F.lit(1)).alias("n")).collect()}
    offsets, before = {}, 0
    for p in sorted(sizes):
        offsets[p], before = before, before + sizes[p]
    if not offsets:
        return parts.select(col, F.lit(0).cast("long").alias("__rank"))
    shift = F.create_map(*[F.lit(x) for p in offsets.items() for x in p])
    at = F.row_number().over(Window.partitionBy("__part").orderBy(*order))
    return parts.select(col, (shift[F.col("__part")] + at - 1).cast("long").alias("__rank"))


def source_targets(sizes: DataFrame, *, source_col: str, weights: Sequence[float], share: float,
                   most: float) -> DataFrame:
    """(source, source_size) -> with ``target``: ``share`` of all sizes dealt
    by weight, the weights repeating over the sources in code point order
    (null last).  A target stops at ``most`` times its source's size and the
    excess is dealt again by weight, until none is above.  Each pass is one
    aggregate over the table of sources that brings two numbers to the
    driver; passes end when a pass caps no further source."""
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranks = ranked(sizes, source_col)
    table = materialize(sizes.alias("s").join(
        ranks.alias("r"), F.col(f"s.`{source_col}`").eqNullSafe(F.col(f"r.`{source_col}`")))
        .select("s.*", F.element_at(cycle, (F.col("__rank") % len(weights) + 1).cast("int")).alias("__weight")),
        "source-weights")
    cap = F.col("source_size") * float(most)
    total = table.agg(F.sum("source_size")).first()[0] or 0
    per_weight, capped = None, -1
    while True:
        over = F.lit(False) if per_weight is None else F.col("__weight") * per_weight > cap
        left = table.agg(F.sum(F.when(over, cap).otherwise(0.0)).alias("fixed"),
                         F.sum(F.when(over, 0.0).otherwise(F.col("__weight"))).alias("weight"),
                         F.sum(over.cast("long")).alias("n")).first()
        if left["n"] == capped or not left["weight"]:
            break
        capped = left["n"]
        per_weight = (share * total - left["fixed"]) / left["weight"]
    rate = F.lit(0.0 if per_weight is None else per_weight)
    return table.select(*sizes.columns, F.least(F.col("__weight") * rate, cap).alias("target"))


def flight(probability: np.ndarray, size: np.ndarray, draws: np.ndarray) -> np.ndarray:
    """Cube method over one block: probabilities move along the null space of
    the constraints (number of documents, number of words) until at most two
    are fractional.  Three fractional documents always leave one direction
    (the cross product of the two constraint rows); a fair step along it
    takes one of them, at least, to 0 or 1 and keeps both totals."""
    done = [float(x) for x in probability]
    z = [float(x) for x in size]
    draw = iter(draws.tolist())
    held: list[int] = []
    for k in range(len(done)):
        if done[k] <= EPS or done[k] >= 1 - EPS:
            done[k] = float(round(done[k]))
            continue
        held.append(k)
        if len(held) == 3:
            a, b, c = held
            v = (z[c] - z[b], z[a] - z[c], z[b] - z[a])
            if v == (0.0, 0.0, 0.0):  # equal sizes: trade between two
                v = (1.0, -1.0, 0.0)
            up = min(((1 - done[i]) / d if d > 0 else done[i] / -d) for i, d in zip(held, v) if d)
            down = min((done[i] / d if d > 0 else (1 - done[i]) / -d) for i, d in zip(held, v) if d)
            step = up if next(draw) * (up + down) < down else -down
            for i, d in zip(held, v):
                done[i] = min(1.0, max(0.0, done[i] + step * d))
                if done[i] <= EPS or done[i] >= 1 - EPS:
                    done[i] = float(round(done[i]))
            held = [i for i in held if 0.0 < done[i] < 1.0]
    return np.array(done)


def land(done: np.ndarray, size: np.ndarray, promised: float, swaps: int = 8, near: float = 0.005) -> np.ndarray:
    """Settle the two documents at most that a flight leaves: the larger
    probabilities go up, so that the number of documents is the nearest
    integer.  The words that this costs (a long text may be among the two)
    are won back by trading a taken for an untaken document of the block
    whose sizes differ by nearly that much, a few times at most.  Where one
    text is so long that words stay over ``near`` of the promise off, words
    go before documents: documents are dropped or added, the best fit first."""
    done = done.copy()
    loose = np.flatnonzero((done > 0) & (done < 1))
    ups = int(round(float(done[loose].sum())))
    order = loose[np.argsort(-done[loose], kind="stable")]
    done[order[:ups]], done[order[ups:]] = 1.0, 0.0
    for _ in range(swaps):
        error = float((done * size).sum()) - promised
        inside, outside = np.flatnonzero(done == 1), np.flatnonzero(done == 0)
        if abs(error) < 1 or not len(inside) or not len(outside):
            break
        outside = outside[np.argsort(size[outside], kind="stable")]
        want = size[inside] - error
        at = np.searchsorted(size[outside], want)
        beside = np.stack([np.clip(at - 1, 0, len(outside) - 1), np.clip(at, 0, len(outside) - 1)])
        gap = np.abs(size[outside[beside]] - want)
        side = gap.argmin(0)
        best = int(gap.min(0).argmin())
        if gap.min() >= abs(error):
            break
        done[inside[best]], done[outside[beside[side[best], best]]] = 0.0, 1.0
    for _ in range(len(done)):
        error = float((done * size).sum()) - promised
        able = np.flatnonzero((done == (error > 0)) & (size < 2 * abs(error)) & (size > 0))
        if abs(error) <= near * promised or not len(able):
            break
        flip = able[int(np.abs(size[able] - abs(error)).argmin())]
        done[flip] = 1 - done[flip]
    return done


def balanced_sample(units: DataFrame, *, seed: int = 0, block: int = 2048, reserve: int = 1024) -> DataFrame:
    """Rows with ``stratum`` (long), ``unit`` (long, a hash of the row), ``size``
    and ``p`` (double), and any other columns, which travel along -> the same
    rows with ``p`` settled to 0 or 1, so that the number of rows and the sum
    of sizes of each stratum stay near what ``p`` promised.

    A stratum is cut into blocks of about ``block`` rows by a hash of the
    unit, so a hot stratum is many tasks; the flight runs in each block and
    leaves two rows at most.  What is left over meets again, a block's worth
    at a time, until each stratum is one block.  That block's leftovers and a
    hashed ``reserve`` of the stratum, kept for this, take the last flight
    and land.  Rows of one unit must be equal; which of them is taken then
    makes no difference."""
    extra = [T.StructField("__block", T.LongType())]
    schema = T.StructType([*units.schema.fields, *extra])

    def step(round_no: int, landing: bool):
        def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
            table = table.sort_by([("unit", "ascending"), ("size", "ascending")])
            rng = np.random.default_rng([seed, round_no, key[0].as_py() % 2 ** 63, key[1].as_py()])
            p, size = table["p"].to_numpy(), table["size"].to_numpy().astype(np.float64)
            done = flight(p, size, rng.random(len(table)))
            if landing:
                done = land(done, size, float((p * size).sum()))
            return table.set_column(table.schema.get_field_index("p"), "p", pa.array(done, pa.float64()))
        return run

    def flown(df: DataFrame, round_no: int, landing: bool) -> DataFrame:
        return materialize(df.select(schema.names).groupBy("stratum", "__block")
                           .applyInArrow(step(round_no, landing), schema), "flight").drop("__block")

    loose = (F.col("p") > 0) & (F.col("p") < 1)
    rows = units.groupBy("stratum").agg(F.count(F.lit(1)).alias("__rows"))
    split = units.join(rows, "stratum").withColumn(
        "__kept", F.pmod(F.xxhash64("unit", F.lit("reserve")), F.col("__rows")) < reserve)
    last = split.filter("__kept").select(units.columns)
    open_, settled = split.filter("not __kept").select(units.columns), []
    while True:
        counts = open_.groupBy("stratum").agg(F.ceil(F.count(F.lit(1)) / block).alias("__blocks"))
        most = counts.agg(F.max("__blocks")).first()[0] or 0
        if most == 0:
            break
        dealt = open_.join(counts, "stratum").withColumn(
            "__block", F.pmod(F.xxhash64("unit", F.lit(len(settled))), F.col("__blocks")))
        moved = flown(dealt, len(settled), False)
        settled.append(moved.filter(~loose))
        open_ = moved.filter(loose)
        if most == 1:
            break
    result = flown(last.unionByName(open_).withColumn("__block", F.lit(0).cast("long")), len(settled), True)
    for more in settled:
        result = result.unionByName(more)
    return result


def mix_sources(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0,
                seed: int = 0, block: int = 2048) -> DataFrame:
    """How often the mix takes each document: (id, source, ``size`` in words,
    ``source_size``, ``target``, ``copies``, ``taken`` = copies * size,
    ``text_hash`` of the row's text), one row for each input row.

    A source that must give ``r`` times its size gives every document
    floor(r) times, and the rest by balanced sampling with probability
    r - floor(r), balanced on the source's documents and words.  No document
    is taken over ceil(``most``) times.  Null text has size 0, and a source
    without words takes nothing; null sources are one source, last in order.
    Rows that repeat an id count as rows of their own.  Reruns on the same
    rows agree, whatever the partitions.  An empty table gives no rows."""
    sized = materialize(docs.select(
        F.col(id_col).alias("__id"), F.col(source_col).alias("__source"),
        word_count(F.col(text_col)).alias("size"), F.xxhash64(text_col).alias("__text")), "sizes")
    sources = sized.groupBy("__source").agg(F.sum("size").cast("long").alias("source_size"))
    targets = materialize(source_targets(sources, source_col="__source", weights=weights, share=share, most=most)
                          .withColumn("__ratio", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
                                      .otherwise(0.0)), "targets")
    rows = sized.alias("d").join(targets.alias("t"), F.col("d.__source").eqNullSafe(F.col("t.__source"))).select(
        F.xxhash64("d.__source").alias("stratum"), F.xxhash64("d.__id", "d.__text", "d.__source").alias("unit"),
        "d.size", (F.col("__ratio") - F.floor("__ratio")).alias("p"), F.floor("__ratio").cast("long").alias("__whole"),
        "d.__id", "d.__source", "d.__text", "t.source_size", "t.target")
    chosen = balanced_sample(rows, seed=seed, block=block)
    copies = F.col("__whole") + F.round("p").cast("long")
    return chosen.select(F.col("__id").alias(id_col), F.col("__source").alias(source_col), "size", "source_size",
                         "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"),
                         F.col("__text").alias("text_hash"))
