"""Pivots and unpivots on the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialspark.operators import reshape as R
from trialspark.plans.registry import Tables, plan
from trialspark.plans.views import GRID, TRIAL, grid, trial, with_clauses


@plan("R1", with_clauses(TRIAL) + """
SELECT entry_id, avg(value) FILTER (trait = 'A' AND breakout = '1-URGENT') AS "A_1-URGENT", avg(value) FILTER (trait = 'R' AND breakout = '1-URGENT') AS "R_1-URGENT",
  avg(value) FILTER (trait = 'N' AND breakout = '5-LOW') AS "N_5-LOW" FROM trial GROUP BY entry_id""")
def long_to_wide(t: Tables) -> DataFrame:
    names = ["A_1-URGENT", "R_1-URGENT", "N_5-LOW"]
    return R.to_wide(trial(t), ["entry_id"], ["trait", "breakout"], {"": F.avg("value")}, names)


@plan("R1 R4", with_clauses(TRIAL) + """
SELECT decision_group, entry_id, avg(value) FILTER (trait = 'A') AS mean_A, avg(value) FILTER (trait = 'N') AS mean_N, avg(value) FILTER (trait = 'R') AS mean_R,
  max(value) FILTER (trait = 'A') AS top_A, max(value) FILTER (trait = 'N') AS top_N, max(value) FILTER (trait = 'R') AS top_R FROM trial GROUP BY ALL""")
def wide_with_several_values(t: Tables) -> DataFrame:
    return R.to_wide(trial(t), ["decision_group", "entry_id"], ["trait"], {"mean": F.avg("value"), "top": F.max("value")})


@plan("R2", """
WITH a AS (SELECT l_suppkey AS id, year(l_shipdate) AS yr, avg(l_quantity) FILTER (l_returnflag = 'R') AS q_R, avg(l_quantity) FILTER (l_returnflag = 'A') AS q_A FROM lineitem GROUP BY ALL),
b AS (SELECT l_suppkey AS id, max(l_tax) FILTER (l_linestatus = 'O') AS tax_O, max(l_tax) FILTER (l_linestatus = 'F') AS tax_F FROM lineitem GROUP BY ALL)
SELECT id, CAST(yr AS INTEGER) AS yr, q_R, q_A, tax_O, tax_F FROM a LEFT JOIN b USING (id)""")
def pivots_joined_on_common_keys(t: Tables) -> DataFrame:
    rows = t.lineitem.withColumns({"id": F.col("l_suppkey"), "yr": F.year("l_shipdate")})
    a = R.to_wide(rows, ["id", "yr"], ["l_returnflag"], {"q": F.avg("l_quantity")}, ["R", "A"])
    b = R.to_wide(rows, ["id"], ["l_linestatus"], {"tax": F.max("l_tax")}, ["O", "F"])
    return R.join_on_common([(a, "left"), (b, "left")], ["id", "yr"])


@plan("R3", """
SELECT * FROM (SELECT l_orderkey, avg(l_quantity) FILTER (l_returnflag = 'A') AS A, avg(l_quantity) FILTER (l_returnflag = 'R') AS R, avg(l_quantity) FILTER (l_returnflag = 'N') AS N
FROM lineitem GROUP BY 1) WHERE A IS NOT NULL AND R IS NOT NULL""")
def pivot_with_required_traits(t: Tables) -> DataFrame:
    wide = R.to_wide(t.lineitem, ["l_orderkey"], ["l_returnflag"], {"": F.avg("l_quantity")}, ["A", "R", "N"])
    return R.drop_incomplete(wide, ["A", "R"])


@plan("R5", """
SELECT l_orderkey, l_linenumber, 'qty_' || l_returnflag AS variable, l_quantity AS value FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'tax_' || l_returnflag, l_tax FROM lineitem""")
def melt_with_composed_names(t: Tables) -> DataFrame:
    x = t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag", F.col("l_quantity").alias("qty"), F.col("l_tax").alias("tax"))
    return R.to_long(x, ["l_orderkey", "l_linenumber"], ["qty", "tax"], prefix_from="l_returnflag")


@plan("R6", """
SELECT l_suppkey, 'O' AS sog, sum(l_quantity) FILTER (l_linestatus = 'O') AS qty, sum(l_tax) FILTER (l_linestatus = 'O') AS tax FROM lineitem GROUP BY 1
UNION ALL SELECT l_suppkey, 'F', sum(l_quantity) FILTER (l_linestatus = 'F'), sum(l_tax) FILTER (l_linestatus = 'F') FROM lineitem GROUP BY 1""")
def stubs_to_long(t: Tables) -> DataFrame:
    wide = R.to_wide(t.lineitem, ["l_suppkey"], ["l_linestatus"], {"qty": F.sum("l_quantity"), "tax": F.sum("l_tax")}, ["O", "F"])
    return R.stubs_to_long(wide, ["l_suppkey"], ["qty", "tax"], "sog")


@plan("R7", with_clauses(GRID) + """
SELECT place_id, avg(yield) FILTER (irrigation = 'O') AS mean_O, avg(yield) FILTER (irrigation = 'F') AS mean_F, max(yield) FILTER (irrigation = 'O') AS max_O,
  max(yield) FILTER (irrigation = 'F') AS max_F FROM grid GROUP BY place_id""")
def grid_statistics_by_stage(t: Tables) -> DataFrame:
    return R.to_wide(grid(t), ["place_id"], ["irrigation"], {"mean": F.avg("yield"), "max": F.max("yield")}, ["O", "F"])


@plan("R9 K7", """
WITH d AS (SELECT a.n_nationkey AS a, b.n_nationkey AS b, abs(a.n_nationkey - b.n_nationkey) + a.n_regionkey AS v FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey AND a.n_nationkey < b.n_nationkey),
both_ways AS (SELECT a AS r, b AS c, v FROM d UNION ALL SELECT b, a, v FROM d)
SELECT r AS a, max(v) FILTER (c = 0) AS "0", max(v) FILTER (c = 1) AS "1", max(v) FILTER (c = 2) AS "2", max(v) FILTER (c = 3) AS "3", max(v) FILTER (c = 4) AS "4" FROM both_ways GROUP BY r""")
def pair_table_to_matrix(t: Tables) -> DataFrame:
    a = t.nation.select(F.col("n_nationkey").alias("a"), "n_regionkey")
    b = t.nation.select(F.col("n_nationkey").alias("b"), "n_regionkey")
    d = a.join(b, "n_regionkey").filter("a < b").select("a", "b", (F.abs(F.col("a") - F.col("b")) + F.col("n_regionkey")).alias("v"))
    return R.square_matrix(d, "a", "b", "v", ["0", "1", "2", "3", "4"])


@plan("R10", """
SELECT o_orderkey, CAST(coalesce(o_orderstatus = 'F', false) AS INTEGER) AS o_orderstatus_F, CAST(coalesce(o_orderstatus = 'O', false) AS INTEGER) AS o_orderstatus_O,
  CAST(o_orderstatus IS NULL AS INTEGER) AS o_orderstatus_missing FROM (SELECT o_orderkey, nullif(o_orderstatus, CASE WHEN o_totalprice > 400000 THEN 'O' END) AS o_orderstatus FROM orders)""")
def one_hot_with_missing(t: Tables) -> DataFrame:
    hidden = (F.col("o_orderstatus") == "O") & (F.col("o_totalprice") > 400000)
    x = t.orders.select("o_orderkey", F.when(~hidden, F.col("o_orderstatus")).alias("o_orderstatus"))
    return R.one_hot(x, "o_orderstatus", ["F", "O"])


@plan("V1 M11", """
SELECT role, id, max(flag) AS flag FROM (
  SELECT 'entry' AS role, CAST(p_partkey AS VARCHAR) AS id, CAST(p_size > 40 AS INTEGER) AS flag FROM part
  UNION ALL SELECT 'female', p_brand, CAST(p_size > 40 AS INTEGER) FROM part UNION ALL SELECT 'male', p_type, CAST(p_size > 40 AS INTEGER) FROM part)
GROUP BY ALL""")
def stacked_roles(t: Tables) -> DataFrame:
    x = t.part.withColumn("flag", (F.col("p_size") > 40).cast("int"))
    rows = R.stack_roles(x, {"entry": "p_partkey", "female": "p_brand", "male": "p_type"}, "id", keep=["flag"])
    return rows.groupBy("role", "id").agg(F.max("flag").alias("flag"))
