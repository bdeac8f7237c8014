"""Attribution summaries on the driver tables: columns of ``lineitem`` stand for attributions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialspark.operators import attribution as A
from trialspark.plans.registry import Tables, plan

_WIDE_SQL = """wide AS (SELECT l_orderkey, l_linenumber, l_suppkey AS be_bid, l_returnflag AS region, l_linestatus AS maturity, l_quantity - 25 AS rain, (l_discount - 0.05) * 400 AS heat, (l_tax - 0.04) * 500 AS clay, l_extendedprice / 1000 - 38 AS depth FROM lineitem)"""
_FEATURES = ["rain", "heat", "clay", "depth"]


def _wide(t: Tables) -> DataFrame:
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", F.col("l_suppkey").alias("be_bid"), F.col("l_returnflag").alias("region"), F.col("l_linestatus").alias("maturity"),
        (F.col("l_quantity") - 25).alias("rain"), ((F.col("l_discount") - 0.05) * 400).alias("heat"), ((F.col("l_tax") - 0.04) * 500).alias("clay"),
        (F.col("l_extendedprice") / 1000 - 38).alias("depth"),
    )


_TALL_SQL = f"""WITH {_WIDE_SQL}, tall AS (UNPIVOT wide ON rain, heat, clay, depth INTO NAME feature VALUE shap)"""


@plan("X1", _TALL_SQL + """,
m AS (SELECT be_bid, region, feature, avg(shap) AS shap FROM tall GROUP BY ALL),
q AS (SELECT region, feature, quantile_cont(shap, 0.05) AS q05, quantile_cont(shap, 0.25) AS q25, quantile_cont(shap, 0.5) AS q50, quantile_cont(shap, 0.75) AS q75, quantile_cont(shap, 0.95) AS q95 FROM tall GROUP BY ALL)
SELECT m.*, q05, q25, q50, q75, q95 FROM m JOIN q USING (region, feature)""")
def attribution_summary(t: Tables) -> DataFrame:
    return A.summarise(_wide(t), ["be_bid", "region"], ["region"], _FEATURES)


@plan("X2", """
WITH x AS (SELECT p_partkey, CAST(p_size AS DOUBLE) AS size, p_retailprice AS price, CAST(p_size % 5 AS DOUBLE) AS few FROM part),
e AS (SELECT quantile_cont(size, [0, 1/6, 2/6, 3/6, 4/6, 5/6, 1.0]) AS a, quantile_cont(price, [0, 1/6, 2/6, 3/6, 4/6, 5/6, 1.0]) AS b FROM x)
SELECT p_partkey, 'size' AS feature, CAST(greatest(1, least(6, len(list_filter(a, lambda v: v <= size)))) AS DOUBLE) AS binned FROM x, e
UNION ALL SELECT p_partkey, 'price', CAST(greatest(1, least(6, len(list_filter(b, lambda v: v <= price)))) AS DOUBLE) FROM x, e UNION ALL SELECT p_partkey, 'few', few FROM x""")
def binned_feature_values(t: Tables) -> DataFrame:
    x = t.part.select("p_partkey", F.col("p_size").cast("double").alias("size"), F.col("p_retailprice").alias("price"), (F.col("p_size") % 5).cast("double").alias("few"))
    return A.binned_values(x, ["p_partkey"], ["size", "price", "few"], 6)


@plan("X3 T4", _TALL_SQL + """,
l AS (SELECT 'maturity_region' AS aggregate_level, maturity || '_' || region AS aggregate_value, feature, avg(shap) AS shap FROM tall GROUP BY ALL UNION ALL SELECT 'Global', 'Global', feature, avg(shap) FROM tall GROUP BY ALL),
r AS (SELECT *, 'positive' AS direction, row_number() OVER (PARTITION BY aggregate_level, aggregate_value ORDER BY shap DESC, feature) AS rank FROM l UNION ALL
  SELECT *, 'negative', row_number() OVER (PARTITION BY aggregate_level, aggregate_value ORDER BY shap, feature) FROM l)
SELECT aggregate_level, aggregate_value, direction, CAST(rank AS INTEGER) AS rank, feature, round(shap, 8) AS shap FROM r WHERE rank <= 2""")
def top_influencers(t: Tables) -> DataFrame:
    out = A.top_influencers(_wide(t), [["maturity", "region"], []], _FEATURES, 2)
    return out.withColumn("shap", F.round("shap", 8))


@plan("X4 R11", """
WITH w AS (SELECT l_suppkey, avg(l_quantity) AS a, avg(l_tax) AS b, avg(l_discount) AS c FROM lineitem GROUP BY 1)
SELECT l_suppkey, 'shap' AS what, 'positive' AS direction, 1 AS rank, 'attribution' AS category, a AS value FROM w UNION ALL SELECT l_suppkey, 'shap', 'negative', 3, 'attribution', b FROM w UNION ALL SELECT l_suppkey, 'value', 'positive', 1, 'input', c FROM w""")
def tall_ranked_table(t: Tables) -> DataFrame:
    w = t.lineitem.groupBy("l_suppkey").agg(F.avg("l_quantity").alias("shap_TPI_0"), F.avg("l_tax").alias("shap_TNI_2"), F.avg("l_discount").alias("value_TPI_0"))
    return A.tall_ranked(w, ["l_suppkey"], ["shap_TPI_0", "shap_TNI_2", "value_TPI_0"], {"shap": "attribution", "value": "input"})


@plan("X5", f"""WITH {_WIDE_SQL},
x AS (SELECT l_orderkey, l_linenumber, region, CASE WHEN clay > 0 THEN clay END AS clay, rain, heat, depth, rain / 10 AS s_rain, heat / 9 AS s_heat, clay / 8 AS s_clay, depth / 11 AS s_depth FROM wide),
st AS (SELECT region, avg(rain) AS mr, stddev_pop(rain) AS sr, avg(heat) AS mh, stddev_pop(heat) AS sh, avg(clay) AS mc, stddev_pop(clay) AS sc, avg(depth) AS md, stddev_pop(depth) AS sd FROM x GROUP BY 1),
z AS (SELECT l_orderkey, l_linenumber, UNNEST(['rain', 'heat', 'clay', 'depth']) AS f, UNNEST([(rain - mr) / sr, (heat - mh) / sh, (clay - mc) / sc, (depth - md) / sd]) AS z, UNNEST([abs(s_rain), abs(s_heat), abs(s_clay), abs(s_depth)]) AS s,
  UNNEST([l_linenumber, l_linenumber, l_linenumber, l_linenumber]) AS ln, UNNEST([s_rain, s_rain, s_rain, s_rain]) AS k1, UNNEST([s_depth, s_depth, s_depth, s_depth]) AS k2, UNNEST([s_heat, s_heat, s_heat, s_heat]) AS k3, UNNEST([s_clay, s_clay, s_clay, s_clay]) AS k4 FROM x JOIN st USING (region)),
d AS (SELECT DISTINCT * FROM z),
t AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber, k1, k2, k3, k4 ORDER BY s DESC, f) AS rk, f || ': ' || CASE WHEN z IS NULL THEN 'missing' WHEN f = 'rain' THEN CASE WHEN z > 1.25 THEN 'very wet' WHEN z > 0.5 THEN 'wet' WHEN z > -0.5 THEN 'moderate' WHEN z > -1.25 THEN 'dry' ELSE 'very dry' END
  ELSE CASE WHEN z > 1.25 THEN 'very high' WHEN z > 0.5 THEN 'high' WHEN z > -0.5 THEN 'moderate' WHEN z > -1.25 THEN 'low' ELSE 'very low' END END AS w FROM d)
SELECT l_orderkey, l_linenumber, string_agg(w, ', ' ORDER BY rk) AS explanation FROM t WHERE rk <= 3 GROUP BY l_orderkey, l_linenumber, k1, k2, k3, k4""")
def driver_explanations(t: Tables) -> DataFrame:
    x = _wide(t).select(
        "l_orderkey", "l_linenumber", "region", F.when(F.col("clay") > 0, F.col("clay")).alias("clay"), "rain", "heat", "depth",
        (F.col("rain") / 10).alias("s_rain"), (F.col("heat") / 9).alias("s_heat"), (F.col("clay") / 8).alias("s_clay"), (F.col("depth") / 11).alias("s_depth"),
    )
    features = {c: f"s_{c}" for c in _FEATURES}
    return A.explain(x, ["l_orderkey", "l_linenumber"], features, ["region"], 3, {"rain": A.WET_WORDS})
