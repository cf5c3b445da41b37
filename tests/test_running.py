import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lodestar.operators.running import running


def test_running_matches_window_with_hot_key(spark):
    # key 0 holds half of all rows and must span several partitions
    df = spark.range(0, 4000).select(
        F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id") % 37).cast("long").alias("k"),
        F.col("id").alias("o"), (F.col("id") % 7).cast("double").alias("v"),
        F.concat(F.lit("r"), (F.col("id") % 3).cast("string")).alias("role"))
    got = running(df, "k", ["o"], sums=["v"], maxes=["v"], prev=["role"], num_partitions=8)
    w = Window.partitionBy("k").orderBy("o")
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    want = df.select("k", "o", F.row_number().over(w).alias("rn"), F.sum("v").over(run).alias("s"),
                     F.max("v").over(run).alias("m"), F.lag("role").over(w).alias("p"))
    g = {(r.k, r.o): (r._rn, r.v_run, r.v_runmax, r.role_prev) for r in got.collect()}
    for r in want.collect():
        assert g[(r.k, r.o)] == (r.rn, pytest.approx(r.s), pytest.approx(r.m), r.p)
    # the hot key really was split across partitions
    parts = got.select("k", F.spark_partition_id().alias("p")).filter("k = 0").distinct().count()
    assert parts > 1


def test_running_descending(spark):
    df = spark.createDataFrame([(1, 3.0, 1.0), (1, 2.0, 2.0), (1, 1.0, 4.0)], "k long, o double, v double")
    rows = sorted(running(df, "k", ["o"], sums=["v"], descending=True, num_partitions=2).collect(),
                  key=lambda r: -r.o)
    assert [r.v_run for r in rows] == [1.0, 3.0, 7.0]


def test_running_reads_nulls_as_the_window_does(spark):
    df = spark.createDataFrame([(None if i % 5 == 0 else i % 3, i, None if i % 4 else float(i), None if i % 2 else f"r{i}")
                                for i in range(200)], "k long, o long, v double, role string")
    got = running(df, "k", ["o"], sums=["v"], maxes=["v"], prev=["role"], num_partitions=9)
    w = Window.partitionBy("k").orderBy("o")
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    want = df.select("k", "o", F.row_number().over(w), F.sum("v").over(run), F.max("v").over(run), F.lag("role").over(w))
    rows = got.select("k", "o", "_rn", "v_run", "v_runmax", "role_prev").collect()
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, map(tuple, want.collect())))
    assert running(df.limit(0), "k", ["o"], sums=["v"]).count() == 0
