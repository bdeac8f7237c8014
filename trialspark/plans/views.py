"""The driver tables read as trial data, once as DataFrames and once as SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialspark.plans.registry import Tables


def with_clauses(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


# one row per plot: supplier = entry, region = decision group, order month = trial,
# return flag = trait, quantity = value, priority = breakout, every tenth supplier a check
TRIAL = """trial AS (
  SELECT n.n_regionkey AS decision_group, l.l_suppkey AS entry_id,
         CAST(year(o.o_orderdate) * 100 + month(o.o_orderdate) AS INTEGER) AS trial_id,
         CAST(year(o.o_orderdate) AS INTEGER) AS season_year,
         l.l_returnflag AS trait, l.l_quantity AS value, l.l_extendedprice AS price, o.o_orderpriority AS breakout,
         s.s_suppkey % 10 = 0 AS cpifl, s.s_acctbal > 0 AS cperf, s.s_nationkey AS nation_id
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey)"""


def trial(t: Tables) -> DataFrame:
    return (
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("n_regionkey").alias("decision_group"),
            F.col("l_suppkey").alias("entry_id"),
            (F.year("o_orderdate") * 100 + F.month("o_orderdate")).alias("trial_id"),
            F.year("o_orderdate").alias("season_year"),
            F.col("l_returnflag").alias("trait"),
            F.col("l_quantity").alias("value"),
            F.col("l_extendedprice").alias("price"),
            F.col("o_orderpriority").alias("breakout"),
            (F.col("s_suppkey") % 10 == 0).alias("cpifl"),
            (F.col("s_acctbal") > 0).alias("cperf"),
            F.col("s_nationkey").alias("nation_id"),
        )
    )


# predictions per group, entry and trait
PREDICTIONS = """predictions AS (
  SELECT decision_group, entry_id, trait, count(*) AS n, avg(value) AS prediction, stddev_samp(value) AS stddev,
         bool_or(cpifl) AS cpifl, bool_or(cperf) AS cperf
  FROM trial GROUP BY ALL)"""


def predictions(t: Tables) -> DataFrame:
    return (
        trial(t)
        .groupBy("decision_group", "entry_id", "trait")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg("value").alias("prediction"),
            F.stddev_samp("value").alias("stddev"),
            F.bool_or("cpifl").alias("cpifl"),
            F.bool_or("cperf").alias("cperf"),
        )
    )


# grid cells: part = place, supplier = entry, quantity = acres, price = predicted yield
GRID = """grid AS (
  SELECT l.l_partkey AS place_id, l.l_suppkey AS entry_id, l.l_suppkey % 10 = 0 AS cperf,
         p.p_brand AS brand, p.p_type AS kind, l.l_linestatus AS irrigation,
         CAST(year(l.l_shipdate) AS INTEGER) AS stage_year,
         l.l_extendedprice / 1000 AS yield, l.l_quantity AS acres, l.l_discount >= 0.08 AS is_outlier
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey)"""


def grid(t: Tables) -> DataFrame:
    return t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_partkey").alias("place_id"),
        F.col("l_suppkey").alias("entry_id"),
        (F.col("l_suppkey") % 10 == 0).alias("cperf"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("kind"),
        F.col("l_linestatus").alias("irrigation"),
        F.year("l_shipdate").alias("stage_year"),
        (F.col("l_extendedprice") / 1000).alias("yield"),
        F.col("l_quantity").alias("acres"),
        (F.col("l_discount") >= 0.08).alias("is_outlier"),
    )


def normal_cdf_sql(z: str) -> str:
    """Normal CDF of a short SQL expression, by the same published approximation."""
    a = f"abs({z})"
    num = "0.0352624965998911"
    for c in ("0.700383064443688", "6.37396220353165", "33.912866078383", "112.079291497871", "221.213596169931", "220.206867912376"):
        num = f"({num} * {a} + {c})"
    den = "0.0883883476483184"
    for c in (
        "1.75566716318264", "16.064177579207", "86.7807322029461", "296.564248779674",
        "637.333633378831", "793.826512519948", "440.413735824752",
    ):
        den = f"({den} * {a} + {c})"
    far = f"({a} + 0.65)"
    for c in (4, 3, 2, 1):
        far = f"({a} + {c} / {far})"
    tail = (
        f"(CASE WHEN {a} < 7.07106781186547 THEN exp(-{a} * {a} / 2) * {num} / {den} "
        f"WHEN {a} <= 37 THEN exp(-{a} * {a} / 2) / {far} / 2.506628274631 ELSE 0 END)"
    )
    return f"(CASE WHEN {z} > 0 THEN 1 - {tail} ELSE {tail} END)"


def beta_sql(x: str, a: str, b: str, steps: int = 4000) -> str:
    """Regularised incomplete beta by Simpson's rule in the angle (x = sin^2), for a, b >= 1/2.

    A method of its own, so it checks the continued fraction used by the operators.
    """
    theta = f"(i * asin(sqrt({x})) / {steps})"
    weight = f"(CASE WHEN i = 0 OR i = {steps} THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END)"
    inner = (
        f"list_sum(list_transform(range(0, {steps + 1}), lambda i: {weight} * "
        f"exp((2 * ({a}) - 1) * ln(greatest(sin{theta}, 1e-300)) + (2 * ({b}) - 1) * ln(greatest(cos{theta}, 1e-300)))))"
    )
    front = f"2 * exp(lgamma(({a}) + ({b})) - lgamma({a}) - lgamma({b}))"
    return f"({front} * asin(sqrt({x})) / {steps} / 3 * {inner})"


def f_sf_sql(f: str, m: str, n: str, steps: int = 4000) -> str:
    return beta_sql(f"(({n}) / (({n}) + ({m}) * ({f})))", f"(({n}) / 2.0)", f"(({m}) / 2.0)", steps)


def clamp_sql(x: str, low: float, high: float) -> str:
    return f"(CASE WHEN {x} < {low} THEN {low} WHEN {x} > {high} THEN {high} ELSE {x} END)"
