"""Connected components of an edge list, on Spark alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, release


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges`` (a, b) of any one orderable type -> (node, root): for each
    node of an edge the smallest node that it reaches.

    Alternating large-star and small-star steps: every step is a grouped
    minimum (combined before the shuffle, so a hub is no hot task) and an
    equi-join of the edges with one row per node (a skewed side that adaptive
    execution splits).  No neighbour list is ever gathered.  Rounds are about
    the logarithm of the longest path; each is written to the shared folder.
    Self-loops, repeated edges and either direction are allowed; rows with a
    null end are ignored; no edges give no rows."""
    def orient(df: DataFrame) -> DataFrame:
        return (df.filter(F.col("a") != F.col("b"))
                .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    nodes_in = edges.select("a", "b")
    now = materialize(orient(nodes_in), "components")
    seen = mark(now)
    for _ in range(max_rounds):
        if seen[0] == 0:
            break
        # large star: neighbours above a node move to its smallest neighbour
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (both.filter(F.col("b") > F.col("a")).join(low, "a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")))
        large = large.filter(F.col("a") != F.col("b")).distinct()
        # small star: a node's smaller neighbours, and the node, move to the smallest of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(
            F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
            F.struct(F.col("a"), F.col("m").alias("b")))).alias("e")).select("e.*")
        before, now = now, materialize(orient(small), "components")
        release(before)
        after = mark(now)
        if after == seen:
            break
        seen = after
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
