"""Ordered fan-out and fan-in: look up every element of an array column in a
table and put the answers back in the elements' places on the same row."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

ROW = "__row"


def with_row_key(df: DataFrame) -> DataFrame:
    """Adds ``__row``, a key of the row itself: rows that are equal in every
    column keep apart.  The rows are written and read back, so the keys stay
    the same however often they are read."""
    return materialize(df.withColumn(ROW, F.monotonically_increasing_id()), "rows", "zstd")


def look_up_each(df: DataFrame, keys_col: str, table: DataFrame, table_key: str, values: Sequence[str], out_col: str) -> DataFrame:
    """Adds ``out_col``: for each element of the string array ``keys_col`` the
    struct of ``values`` of the ``table`` row with that ``table_key`` (fields
    null where there is none), in the elements' order.  No elements, and a
    null array, give an empty array; a null element matches nothing.
    ``table_key`` must be unique.

    ``df`` comes from ``with_row_key``.  What crosses the network is (row,
    place, key) and the answers; the rows that have elements meet them again
    by their key, the others stay where they lie.  A group is one row's array.
    Very many rows with one key make one skewed partition on their own side
    only, which adaptive execution splits."""
    each = df.select(ROW, F.posexplode(keys_col).alias("__place", "__key"))
    side = table.select(F.col(table_key).alias("__key"), F.struct(*[F.col(v).alias(v) for v in values]).alias("__value"))
    empty = F.struct(*[F.lit(None).cast(side.schema["__value"].dataType[v].dataType).alias(v) for v in values])
    met = each.join(side, "__key", "left").groupBy(ROW).agg(F.array_sort(F.collect_list(
        F.struct("__place", F.coalesce("__value", empty).alias("v")))).alias("__all"))
    kind = f"array<{side.schema['__value'].dataType.simpleString()}>"
    some = F.coalesce(F.size(keys_col) > 0, F.lit(False))
    full = df.filter(some).join(met, ROW).withColumn(out_col, F.transform("__all", lambda x: x["v"])).drop("__all")
    return full.unionByName(df.filter(~some).withColumn(out_col, F.array().cast(kind)))
