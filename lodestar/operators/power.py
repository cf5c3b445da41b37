"""Per-stratum sample-size calculation for comparing proportions.

Rates come from one grouped aggregation of the raw rows; every formula after
that is a column expression over a table with one row per (stratum, arm), so
no Python runs per row."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.stats import noncentrality

# Fixed value from the reference's worked example (lambda for alpha .05,
# beta .10, v = 2).
LAMBDA_EXAMPLE = 12.65


def arcsine(p) -> "F.Column":
    """Variance-stabilising transform 2*asin(sqrt(p))."""
    return 2 * F.asin(F.sqrt(p))


def rates(df: DataFrame, stratum: str, arm: str, success) -> DataFrame:
    """Success proportion per (stratum, arm)."""
    return df.groupBy(stratum, arm).agg(F.avg(F.when(success, 1.0).otherwise(0.0)).alias("p"),
                                        F.count(F.lit(1)).alias("n_obs"))


def two_proportion(r: DataFrame, stratum: str, arm: str, arm_a: str, arm_b: str,
                   alpha: float = 0.05, power: float = 0.8) -> DataFrame:
    """Cohen's h between two arms and the per-group n of a two-sided z test
    with equal groups: n = 2*nc/h**2 (NULL when h = 0)."""
    nc = noncentrality(alpha, power, 1)
    wide = r.groupBy(stratum).agg(F.max(F.when(F.col(arm) == arm_a, F.col("p"))).alias("p_a"),
                                  F.max(F.when(F.col(arm) == arm_b, F.col("p"))).alias("p_b"))
    h = arcsine(F.col("p_a")) - arcsine(F.col("p_b"))
    n = F.lit(2 * nc) / F.nullif(h * h, F.lit(0.0))
    return wide.select(stratum, "p_a", "p_b", h.alias("effect_h"), n.alias("n_per_group"),
                       F.ceil(n).alias("n_ceil"))


def k_proportion(r: DataFrame, stratum: str, alpha: float = 0.05, power: float = 0.8,
                 n_bins: int = 2) -> DataFrame:
    """Cohen's w = sqrt(sum((p_i - mean p)**2) / mean p) over the arms of a
    stratum, total n of the goodness-of-fit chi-square test (df = n_bins - 1)
    and equal per-group n = ceil(n_total / k); a stratum whose rates are all 0
    has no effect size and no n."""
    nc = noncentrality(alpha, power, n_bins - 1)
    m = r.withColumn("_m", F.avg("p").over(Window.partitionBy(stratum)))
    agg = m.groupBy(stratum).agg(F.count(F.lit(1)).alias("k"),
                                 F.sqrt(F.sum((F.col("p") - F.col("_m")) ** 2 / F.nullif(F.col("_m"), F.lit(0.0)))).alias("effect_w"))
    n_total = F.lit(nc) / F.nullif(F.col("effect_w") ** 2, F.lit(0.0))
    return agg.select(stratum, F.col("k").cast("long").alias("k"), "effect_w", n_total.alias("n_total"),
                      F.ceil(n_total / F.col("k")).alias("n_per_group"))


def closed_form(r: DataFrame, stratum: str, lam: float = LAMBDA_EXAMPLE) -> DataFrame:
    """n = 2*lambda / (2asin sqrt(p_max) - 2asin sqrt(p_min))**2; equal rates -> NULL."""
    agg = r.groupBy(stratum).agg(F.max("p").alias("p_max"), F.min("p").alias("p_min"))
    diff_sq = (arcsine(F.col("p_max")) - arcsine(F.col("p_min"))) ** 2
    n = F.lit(2 * lam) / F.nullif(diff_sq, F.lit(0.0))
    return agg.select(stratum, "p_max", "p_min", n.alias("n_per_group"), F.ceil(n).alias("n_ceil"))
