"""Running aggregates per key that do not put a hot key into one task.

A window ``partitionBy(key).orderBy(o)`` sends every row of a key to one
task; a key holding a third of the data then serialises a third of the job.
Here rows are range-partitioned on ``(key, o)``, so a hot key spans many
partitions, and written once to the shared checkpoint folder, so that every
later pass sees the same partitions.  A window inside each (partition, key)
gives local running values; a summary with one row per (partition, key) gives
each the carry-in from the key's earlier partitions.  Everything is native,
streams and spills, and there is one path whatever the size."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize


def _plus(a: Column, b: Column) -> Column:
    """Sum of two partial sums: NULL only if both are, like SQL's ``sum``."""
    return F.when(a.isNull() & b.isNull(), F.lit(None)).otherwise(F.coalesce(a, F.lit(0.0)) + F.coalesce(b, F.lit(0.0)))


def running(df: DataFrame, key: str, order: Sequence[str], sums: Sequence[str] = (), maxes: Sequence[str] = (),
            prev: Sequence[str] = (), descending: bool = False, num_partitions: int | None = None) -> DataFrame:
    """Add per-key running columns in ``order`` (ties must not occur):
    ``<c>_run`` inclusive running sum for ``sums``, ``<c>_runmax`` running
    max for ``maxes``, ``<c>_prev`` previous row's value for ``prev`` (NULL on
    a key's first row), and ``_rn`` (1-based row number).  ``descending``
    orders every ``order`` column descending.  NULL values, keys and previous
    values read as in the SQL window: NULL keys are one group."""
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ocols = [F.col(o).desc() if descending else F.col(o).asc() for o in order]
    # in columns, and without the shuffle files of the write: marks and repeated values take next to no room
    ranged = materialize(df.repartitionByRange(n, F.col(key), *ocols).withColumn("_pid", F.spark_partition_id()), "ranged")

    local = Window.partitionBy("_pid", key).orderBy(*ocols)
    upto = local.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = ranged.select(
        "*", F.row_number().over(local).cast("long").alias("_lrn"),
        *[F.sum(F.col(c).cast("double")).over(upto).alias(f"_s_{c}") for c in sums],
        *[F.max(F.col(c).cast("double")).over(upto).alias(f"_m_{c}") for c in maxes],
        *[F.lag(c).over(local).alias(f"_p_{c}") for c in prev])

    # the last row of a (partition, key) in the asked order; NULLs sort lowest in either direction
    at = F.struct(*order)
    last = F.min_by if descending else F.max_by
    summary = ranged.groupBy("_pid", key).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.sum(F.col(c).cast("double")).alias(f"_st_{c}") for c in sums],
        *[F.max(F.col(c).cast("double")).alias(f"_mt_{c}") for c in maxes],
        *[last(F.struct(F.col(c).alias("v")), at).alias(f"_lt_{c}") for c in prev])
    by_part = Window.partitionBy(key).orderBy("_pid")
    before = by_part.rowsBetween(Window.unboundedPreceding, -1)
    carry = summary.select(
        F.col("_pid").alias("_cpid"), F.col(key).alias("_ckey"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n_in"),
        *[F.sum(f"_st_{c}").over(before).alias(f"_si_{c}") for c in sums],
        *[F.max(f"_mt_{c}").over(before).alias(f"_mi_{c}") for c in maxes],
        *[F.lag(f"_lt_{c}").over(by_part).getField("v").alias(f"_li_{c}") for c in prev],
    ).filter(F.col("_n_in") > 0)  # keys that cross a partition edge: at most one row per partition
    joined = rows.join(F.broadcast(carry), (F.col("_pid") == F.col("_cpid")) & F.col(key).eqNullSafe(F.col("_ckey")), "left")
    return joined.select(
        *df.columns, (F.col("_lrn") + F.coalesce("_n_in", F.lit(0))).alias("_rn"),
        *[_plus(F.col(f"_s_{c}"), F.col(f"_si_{c}")).alias(f"{c}_run") for c in sums],
        *[F.greatest(f"_m_{c}", f"_mi_{c}").alias(f"{c}_runmax") for c in maxes],
        *[F.when(F.col("_lrn") == 1, F.col(f"_li_{c}")).otherwise(F.col(f"_p_{c}")).alias(f"{c}_prev") for c in prev])
