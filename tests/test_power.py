import math

import pytest
from pyspark.sql import functions as F

from lodestar.functions.stats import noncentrality
from lodestar.operators import power as P


def test_noncentrality_df1():
    assert noncentrality(0.05, 0.8, 1) == pytest.approx(7.848861, abs=1e-5)


def test_two_proportion_golden(spark):
    r = spark.createDataFrame([("s", "a", 0.52), ("s", "b", 0.80)], "stratum string, arm string, p double")
    row = P.two_proportion(r, "stratum", "arm", "a", "b").collect()[0]
    assert row.effect_h == pytest.approx(-0.603490, abs=1e-6)
    assert row.n_per_group == pytest.approx(43.1018, abs=1e-4)
    assert row.n_ceil == 44


@pytest.mark.parametrize("n_bins,expected", [(2, 33), (3, 40)])
def test_k_proportion_golden(spark, n_bins, expected):
    r = spark.createDataFrame([("s", "a", 0.6), ("s", "b", 0.84), ("s", "c", 0.95)],
                              "stratum string, arm string, p double")
    row = P.k_proportion(r, "stratum", n_bins=n_bins).collect()[0]
    assert row.effect_w == pytest.approx(0.283581, abs=1e-6)
    assert row.n_per_group == expected


def test_closed_form_golden(spark):
    r = spark.createDataFrame([("x", "a", 0.855), ("x", "b", 0.755), ("y", "a", 0.95), ("y", "b", 0.60),
                               ("z", "a", 0.5), ("z", "b", 0.5)], "stratum string, arm string, p double")
    got = {row.stratum: row.n_per_group for row in P.closed_form(r, "stratum", 12.65).collect()}
    assert got["x"] == pytest.approx(391.1848, abs=1e-4)
    assert got["y"] == pytest.approx(29.9948, abs=1e-4)
    assert got["z"] is None


def test_rates_from_rows(spark):
    df = spark.createDataFrame([("s", "a", True), ("s", "a", False), ("s", "b", True)], "s string, a string, ok boolean")
    got = {r.a: r.p for r in P.rates(df, "s", "a", F.col("ok")).collect()}
    assert got == {"a": 0.5, "b": 1.0}
    assert math.isclose(P.LAMBDA_EXAMPLE, 12.65)
