"""Registered power-analysis queries: stratum = customer market segment,
arm = order priority, success = order status 'F'."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.stats import noncentrality
from ..operators import power as P
from ..sources.tables import table
from .registry import register

ARM_A, ARM_B = "1-URGENT", "5-LOW"
_NC1 = repr(noncentrality(0.05, 0.8, 1))

_RATES_SQL = """WITH r AS (
  SELECT c_mktsegment AS stratum, o_orderpriority AS arm,
         avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END) AS p, count(*) AS n_obs
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)"""


def _rates(spark, d):
    o = table(spark, d, "orders").select("o_custkey", "o_orderpriority", "o_orderstatus")
    c = table(spark, d, "customer").select("c_custkey", F.col("c_mktsegment").alias("stratum"))
    rows = o.join(c, o.o_custkey == c.c_custkey).withColumnRenamed("o_orderpriority", "arm")
    return P.rates(rows, "stratum", "arm", F.col("o_orderstatus") == "F")


def _r(c, n=6):
    return F.round(c, n).alias(c)


@register("power_two_prop", _RATES_SQL + f""",
w AS (SELECT stratum, max(CASE WHEN arm = '{ARM_A}' THEN p END) AS p_a,
             max(CASE WHEN arm = '{ARM_B}' THEN p END) AS p_b FROM r GROUP BY 1),
h AS (SELECT *, 2 * asin(sqrt(p_a)) - 2 * asin(sqrt(p_b)) AS effect_h FROM w),
n AS (SELECT *, 2 * {_NC1} / nullif(effect_h * effect_h, 0.0) AS n_per_group FROM h)
SELECT stratum, round(p_a, 6) AS p_a, round(p_b, 6) AS p_b, round(effect_h, 6) AS effect_h,
       round(n_per_group, 4) AS n_per_group, CAST(ceil(n_per_group) AS BIGINT) AS n_ceil FROM n""")
def power_two_prop(spark, d):
    out = P.two_proportion(_rates(spark, d), "stratum", "arm", ARM_A, ARM_B)
    return out.select("stratum", _r("p_a"), _r("p_b"), _r("effect_h"), _r("n_per_group", 4), "n_ceil")


@register("power_k_prop", _RATES_SQL + f""",
r2 AS (SELECT stratum, arm, p FROM r UNION ALL SELECT 'none of ' || stratum, arm, 0.0 FROM r),
m AS (SELECT *, avg(p) OVER (PARTITION BY stratum) AS m FROM r2),
a AS (SELECT stratum, CAST(count(*) AS BIGINT) AS k, sqrt(sum((p - m) ** 2 / nullif(m, 0.0))) AS effect_w FROM m GROUP BY 1),
n AS (SELECT *, {_NC1} / nullif(effect_w ** 2, 0.0) AS n_total FROM a)
SELECT stratum, k, round(effect_w, 6) AS effect_w, round(n_total, 4) AS n_total,
       CAST(ceil(n_total / k) AS BIGINT) AS n_per_group FROM n""")
def power_k_prop(spark, d):
    rates = _rates(spark, d).select("stratum", "arm", "p")  # and strata in which nobody had success
    none = rates.select(F.concat(F.lit("none of "), "stratum").alias("stratum"), "arm", F.lit(0.0).alias("p"))
    out = P.k_proportion(rates.unionByName(none), "stratum")
    return out.select("stratum", "k", _r("effect_w"), _r("n_total", 4), "n_per_group")


@register("power_closed_form", _RATES_SQL + f""",
a AS (SELECT stratum, max(p) AS p_max, min(p) AS p_min FROM r GROUP BY 1),
n AS (SELECT *, 2 * {P.LAMBDA_EXAMPLE} / nullif((2 * asin(sqrt(p_max)) - 2 * asin(sqrt(p_min))) ** 2, 0.0)
      AS n_per_group FROM a)
SELECT stratum, round(p_max, 6) AS p_max, round(p_min, 6) AS p_min, round(n_per_group, 4) AS n_per_group,
       CAST(ceil(n_per_group) AS BIGINT) AS n_ceil FROM n""")
def power_closed_form(spark, d):
    out = P.closed_form(_rates(spark, d), "stratum")
    return out.select("stratum", _r("p_max"), _r("p_min"), _r("n_per_group", 4), "n_ceil")
