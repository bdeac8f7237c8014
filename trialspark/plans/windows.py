"""Window-like operators on the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trialspark.operators import flags as G
from trialspark.operators import keyed
from trialspark.plans.registry import Tables, plan
from trialspark.plans.views import PREDICTIONS, TRIAL, predictions, trial, with_clauses


@plan("W2 T3 M4", """
SELECT l_partkey, l_suppkey, n FROM (SELECT l_partkey, l_suppkey, count(*) AS n FROM lineitem GROUP BY ALL)
QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY n DESC, l_suppkey) = 1""")
def best_per_key_with_tie_break(t: Tables) -> DataFrame:
    counted = t.lineitem.groupBy("l_partkey", "l_suppkey").agg(F.count(F.lit(1)).alias("n"))
    return keyed.top_per_key(counted, ["l_partkey"], ["-n", "l_suppkey"])


@plan("T3", """
SELECT l_returnflag, l_orderkey, l_linenumber, l_extendedprice, CAST(row_number() OVER w AS INTEGER) AS place FROM lineitem
WINDOW w AS (PARTITION BY l_returnflag ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) QUALIFY place <= 25""")
def top_rows_per_key(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_returnflag", "l_orderkey", "l_linenumber", "l_extendedprice")
    return keyed.top_per_key(rows, ["l_returnflag"], ["-l_extendedprice", "l_orderkey", "l_linenumber"], 25, "place")


@plan("W4 W10", with_clauses(TRIAL) + """
SELECT trial_id, entry_id, trait, value, count(*) OVER w AS n, stddev_samp(value) OVER w AS sd, value - avg(value) OVER w AS deviation
FROM trial WINDOW w AS (PARTITION BY decision_group, trial_id, trait)""")
def group_values_beside_rows(t: Tables) -> DataFrame:
    out = keyed.with_group_values(
        trial(t), ["decision_group", "trial_id", "trait"], n=F.count(F.lit(1)), sd=F.stddev_samp("value"), mean=F.avg("value")
    )
    return out.select("trial_id", "entry_id", "trait", "value", "n", "sd", (F.col("value") - F.col("mean")).alias("deviation"))


@plan("W5 H10", with_clauses(TRIAL) + """,
p AS (SELECT nation_id, breakout, entry_id, bool_or(cpifl) AND breakout < '4' AS cpifl, bool_or(cperf AND cpifl) AND breakout < '3' AS chkfl FROM trial GROUP BY nation_id, breakout, entry_id),
f AS (SELECT *, bool_or(cpifl) OVER b AS ia, bool_or(chkfl) OVER b AS it, bool_or(cpifl) OVER g AS oa, bool_or(chkfl) OVER g AS ot FROM p
  WINDOW b AS (PARTITION BY nation_id, breakout), g AS (PARTITION BY nation_id))
SELECT nation_id, breakout, entry_id, CASE WHEN NOT ia AND oa THEN true ELSE cpifl END AS cpifl,
  CASE WHEN NOT it AND ot THEN cpifl ELSE chkfl END AS chkfl FROM f""")
def breakout_flag_fill(t: Tables) -> DataFrame:
    p = trial(t).groupBy("nation_id", "breakout", "entry_id").agg(
        (F.bool_or("cpifl") & (F.col("breakout") < "4")).alias("cpifl"),
        (F.bool_or(F.col("cperf") & F.col("cpifl")) & (F.col("breakout") < "3")).alias("chkfl"),
    )
    return G.fill_breakout_flags(p, ["nation_id"], ["breakout"], F.lit(True))


@plan("W6 W8 W9 H19", with_clauses(TRIAL) + """,
e AS (SELECT nation_id, entry_id, season_year, count(*) AS stage, avg(value) AS rm FROM trial GROUP BY ALL),
s AS (SELECT *, max(season_year) OVER (PARTITION BY nation_id) AS last_year FROM e)
SELECT nation_id, CASE WHEN count(DISTINCT entry_id) = 1 THEN 'SingleExp' WHEN min(season_year) < max(season_year) THEN 'MynoET' ELSE 'MultiExp' END AS analysis_type,
  max(stage) FILTER (season_year = last_year) AS stage, median(rm) FILTER (season_year = last_year) AS decision_group_rm FROM s GROUP BY nation_id""")
def group_settings_of_latest_year(t: Tables) -> DataFrame:
    e = trial(t).groupBy("nation_id", "entry_id", "season_year").agg(
        F.count(F.lit(1)).alias("stage"), F.avg("value").alias("rm")
    )
    return G.group_settings(e, "nation_id", "entry_id", "season_year", "stage", "rm")


@plan("W7 H17", with_clauses(TRIAL) + """,
x AS (SELECT nation_id, trial_id, entry_id, trait, price, value, CAST(value > 40 AS INTEGER) AS target FROM trial),
s AS (SELECT nation_id, trial_id, count(DISTINCT value) AS trial_pts, CAST(sum(target) AS BIGINT) AS analysis_pts FROM x GROUP BY ALL)
SELECT x.*, trial_pts, analysis_pts FROM x JOIN s USING (nation_id, trial_id) WHERE trial_pts > 2 AND analysis_pts > 1""")
def supported_regression_trials(t: Tables) -> DataFrame:
    x = trial(t).select("nation_id", "trial_id", "entry_id", "trait", "price", "value", (F.col("value") > 40).cast("int").alias("target"))
    return G.supported_regression_trials(x, ["nation_id", "trial_id"], "value", "target")


@plan("W11 W12", with_clauses(TRIAL, PREDICTIONS) + """
SELECT decision_group, trait, entry_id, prediction - min(prediction) OVER w AS above_low, max(prediction) OVER w - prediction AS below_high,
  CASE WHEN sum(CAST(cpifl AND cperf AS INTEGER)) OVER w < 2 THEN cpifl ELSE cpifl AND cperf END AS flag
FROM predictions WINDOW w AS (PARTITION BY decision_group, trait)""")
def score_span_and_flag_substitution(t: Tables) -> DataFrame:
    p = predictions(t).withColumn("cmatf", F.col("cpifl") & F.col("cperf"))
    out = keyed.with_group_values(
        p, ["decision_group", "trait"], low=F.min("prediction"), high=F.max("prediction"), n_flag=F.count_if("cmatf")
    )
    return out.select(
        "decision_group", "trait", "entry_id",
        (F.col("prediction") - F.col("low")).alias("above_low"),
        (F.col("high") - F.col("prediction")).alias("below_high"),
        F.when(F.col("n_flag") < 2, F.col("cpifl")).otherwise(F.col("cmatf")).alias("flag"),
    )


@plan("W13", """
SELECT l_orderkey, l_partkey, l_quantity FROM lineitem QUALIFY count(*) OVER (PARTITION BY l_suppkey, l_partkey) = 1""")
def keys_seen_once(t: Tables) -> DataFrame:
    return keyed.keep_unique(t.lineitem, ["l_suppkey", "l_partkey"]).select("l_orderkey", "l_partkey", "l_quantity")


@plan("W14", """
WITH x AS (SELECT o_custkey, o_orderkey, o_orderdate, CASE WHEN o_orderpriority < '3' THEN CAST(o_orderdate AS DATE) END AS plant FROM orders)
SELECT o_orderkey, coalesce(last_value(plant IGNORE NULLS) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(plant IGNORE NULLS) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS plant FROM x""")
def forward_backward_fill(t: Tables) -> DataFrame:
    x = t.orders.select("o_custkey", "o_orderkey", "o_orderdate", F.when(F.col("o_orderpriority") < "3", F.to_date("o_orderdate")).alias("plant"))
    return keyed.fill_in_order(x, ["o_custkey"], ["o_orderdate", "o_orderkey"], ["plant"]).select("o_orderkey", "plant")


@plan("W15", """
SELECT o_custkey, o_orderpriority, n_seen, last_seen FROM (SELECT o_custkey, o_orderpriority, count(*) AS n_seen, max(o_orderdate) AS last_seen FROM orders GROUP BY ALL)
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY n_seen DESC, last_seen DESC, o_orderpriority) = 1""")
def most_frequent_latest_value(t: Tables) -> DataFrame:
    return keyed.most_frequent_latest(t.orders, ["o_custkey"], "o_orderpriority", "o_orderdate")


@plan("W17 K2", """
SELECT l_partkey, l_linenumber, min_by(l_quantity, ROW(l_orderkey, l_quantity)) AS call FROM lineitem
WHERE l_partkey IN (SELECT l_partkey FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_suppkey) > (SELECT count(DISTINCT l_suppkey) / 5.0 FROM lineitem))
GROUP BY l_partkey, l_linenumber""")
def coverage_filter(t: Tables) -> DataFrame:
    samples = t.lineitem.agg((F.count_distinct("l_suppkey") / 5.0).alias("needed"))
    seen = t.lineitem.groupBy("l_partkey").agg(F.count_distinct("l_suppkey").alias("n"))
    good = seen.join(F.broadcast(samples), F.col("n") > F.col("needed"), "left_semi")
    return t.lineitem.join(good, "l_partkey", "left_semi").groupBy("l_partkey", "l_linenumber").agg(
        F.min_by("l_quantity", F.struct("l_orderkey", "l_quantity")).alias("call")
    )


@plan("W18 H11", with_clauses(TRIAL) + """,
c AS (SELECT nation_id, entry_id, CAST(sum(CAST(cpifl AND breakout < '2' AS INTEGER)) AS BIGINT) AS a, CAST(sum(CAST(value > 48 AS INTEGER)) AS BIGINT) AS b, count(*) AS n FROM trial GROUP BY ALL),
g AS (SELECT *, sum(a) OVER (PARTITION BY nation_id) AS any_a FROM c)
SELECT nation_id, entry_id, CAST(any_a = 0 OR a / n > 0.05 AS INTEGER) AS a, CAST(any_a = 0 OR b / n > 0.05 AS INTEGER) AS b, n FROM g""")
def flags_by_plot_share(t: Tables) -> DataFrame:
    rows = trial(t).select(
        "nation_id", "entry_id", (F.col("cpifl") & (F.col("breakout") < "2")).cast("int").alias("a"), (F.col("value") > 48).cast("int").alias("b"), F.lit(1).alias("n")
    )
    return G.threshold_flags(rows, ["nation_id", "entry_id"], ["nation_id"], ["a", "b"], "n", F.lit(False))


@plan("T2", """
SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 10""")
def limited_sample(t: Tables) -> DataFrame:
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice").orderBy(
        F.col("l_extendedprice").desc(), "l_orderkey", "l_linenumber"
    ).limit(10)


@plan("T7", """
SELECT p_partkey, CAST(p_size > 10 AS INTEGER) + CAST(p_type <> 'SMALL' AS INTEGER) + CAST(p_retailprice > 950 AS INTEGER) AS n_known FROM part""")
def rows_by_known_values(t: Tables) -> DataFrame:
    known = [F.when(F.col("p_size") > 10, 1), F.when(F.col("p_type") != "SMALL", 1), F.when(F.col("p_retailprice") > 950, 1)]
    total = F.lit(0)
    for k in known:
        total = total + k.isNotNull().cast("int")
    return t.part.select("p_partkey", total.alias("n_known")).orderBy(F.col("n_known").desc(), "p_partkey")


@plan("S1 S2 S3 S4 S5", """
SELECT k, name FROM (SELECT n_nationkey AS k, n_name AS name FROM nation UNION SELECT r_regionkey, r_name FROM region)
UNION ALL SELECT CAST(NULL AS INTEGER), p_brand FROM (SELECT DISTINCT p_brand FROM part)""")
def unions(t: Tables) -> DataFrame:
    a = t.nation.select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("name"))
    b = t.region.select(F.col("r_regionkey").alias("k"), F.col("r_name").alias("name"))
    brands = t.part.select(F.col("p_brand").alias("name")).dropDuplicates()
    return a.union(b).distinct().unionByName(brands, allowMissingColumns=True)


@plan("T6 V9", """
SELECT p_brand, p_partkey, row_number() OVER w <= sum(CAST(p_size > 40 AS INTEGER)) OVER (PARTITION BY p_brand) AS recommended
FROM part WINDOW w AS (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey)""")
def score_ordered_cut(t: Tables) -> DataFrame:
    from trialspark.operators.evaluation import recommended_cut

    part = t.part.withColumn("was_adv", F.col("p_size") > 40)
    return recommended_cut(part, ["p_brand"], "p_retailprice", "was_adv", by=["p_partkey"]).select("p_brand", "p_partkey", "recommended")
