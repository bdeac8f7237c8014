"""Binning on the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialspark.operators import bins as B
from trialspark.plans.registry import Tables, plan


@plan("B1 B7", """
WITH e AS (SELECT quantile_cont(l_extendedprice, [0.0, 0.16666666666666666, 0.3333333333333333, 0.5, 0.6666666666666666, 0.8333333333333334, 1.0]) AS q FROM lineitem)
SELECT l_orderkey, l_linenumber, CAST(greatest(0, least(5, len(list_filter(q, lambda v: v <= l_extendedprice)) - 1)) AS INTEGER) AS bin FROM lineitem, e""")
def quantile_bins(t: Tables) -> DataFrame:
    out, _ = B.add_bins(t.lineitem, "l_extendedprice", 6, "quantile")
    return out.select("l_orderkey", "l_linenumber", "bin")


@plan("B2 B7", """
WITH e AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem)
SELECT l_orderkey, l_linenumber, CAST(greatest(0, least(9, len(list_filter(range(0, 11), lambda i: lo + (hi - lo) * i / 10 <= l_extendedprice)) - 1)) AS INTEGER) AS bin FROM lineitem, e""")
def equal_width_bins(t: Tables) -> DataFrame:
    out, _ = B.add_bins(t.lineitem, "l_extendedprice", 10, "equal")
    return out.select("l_orderkey", "l_linenumber", "bin")


@plan("B3 B7")
def kmeans_bins(t: Tables) -> DataFrame:
    out, _ = B.add_bins(t.lineitem, "l_quantity", 6, "kmeans")
    return out.select("l_orderkey", "l_linenumber", "l_quantity", "bin")


@plan("B4 B7")
def kmedian_bins(t: Tables) -> DataFrame:
    out, _ = B.add_bins(t.lineitem, "l_quantity", 6, "kmedians")
    return out.select("l_orderkey", "l_linenumber", "l_quantity", "bin")


@plan("B5", """
WITH e AS (SELECT min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem),
b AS (SELECT l_quantity, lo, hi, greatest(0, least(6, len(list_filter(range(0, 8), lambda i: lo + (hi - lo) * i / 7 <= l_quantity)) - 1)) AS bin FROM lineitem, e)
SELECT round(sqrt(avg(power(l_quantity - (lo + (hi - lo) * (bin + 0.5) / 7), 2))), 8) AS rmse FROM b""")
def bin_reconstruction_error(t: Tables) -> DataFrame:
    out, edges = B.add_bins(t.lineitem, "l_quantity", 7, "equal")
    return B.reconstruction_rmse(out, "l_quantity", "bin", edges).select(F.round("rmse", 8).alias("rmse"))


@plan("B6", """
WITH x AS (SELECT CAST(p_size AS DOUBLE) AS v, CAST(least(4, floor((p_size - 1) / 10)) AS INTEGER) AS b FROM part),
d AS (SELECT a.v, a.b, c.b AS other, sum(abs(a.v - c.v)) AS s, count(*) AS n FROM (SELECT DISTINCT v, b FROM x) a, x c GROUP BY ALL),
o AS (SELECT v, b, max(CASE WHEN other = b THEN s / (n - 1) END) AS own, min(CASE WHEN other <> b THEN s / n END) AS near FROM d GROUP BY ALL)
SELECT round(avg((near - own) / greatest(near, own)), 9) AS silhouette FROM x JOIN o USING (v, b)""")
def bin_silhouette(t: Tables) -> DataFrame:
    x = t.part.select(F.col("p_size").alias("v"), F.least(F.lit(4), F.floor((F.col("p_size") - 1) / 10)).cast("int").alias("b"))
    return B.silhouette(x, "v", "b").select(F.round("silhouette", 9).alias("silhouette"))
