"""Aggregates on the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialspark.operators import aggregates as A
from trialspark.operators.keyed import modes
from trialspark.plans.registry import Tables, plan
from trialspark.plans.views import GRID, TRIAL, grid, trial, with_clauses


@plan("A1 A8 A9", with_clauses(TRIAL) + """
SELECT decision_group, trait, count(*) AS n, sum(value) AS total, avg(value) AS mean, min(value) AS low, max(value) AS high,
  stddev_samp(value) AS sd, stddev_samp(value) / sqrt(count(value)) AS se, bool_or(cperf) AS cperf FROM trial GROUP BY ALL""")
def basic_aggregates(t: Tables) -> DataFrame:
    return trial(t).groupBy("decision_group", "trait").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("value").alias("total"),
        F.avg("value").alias("mean"),
        F.min("value").alias("low"),
        F.max("value").alias("high"),
        F.stddev_samp("value").alias("sd"),
        A.standard_error("value").alias("se"),
        F.bool_or("cperf").alias("cperf"),
    )


@plan("A2 A3", """
SELECT l_suppkey, count(*) FILTER (l_returnflag = 'R') AS votes_r, count(*) FILTER (l_returnflag = 'A') AS votes_a,
  count(DISTINCT l_partkey) AS n_parts, count(DISTINCT l_linestatus) AS n_status, count(*) AS n FROM lineitem GROUP BY l_suppkey""")
def conditional_and_distinct_counts(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_suppkey").agg(
        F.count_if(F.col("l_returnflag") == "R").alias("votes_r"),
        F.count_if(F.col("l_returnflag") == "A").alias("votes_a"),
        F.count_distinct("l_partkey").alias("n_parts"),
        F.count_distinct("l_linestatus").alias("n_status"),
        F.count(F.lit(1)).alias("n"),
    )


@plan("A4", """
WITH c AS (SELECT l_suppkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL),
d AS (SELECT l_suppkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY ALL)
SELECT l_suppkey, l_linenumber, l_returnflag FROM (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, l_linenumber) = 1)
JOIN (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, l_returnflag) = 1) USING (l_suppkey)""")
def modes_per_group(t: Tables) -> DataFrame:
    return modes(t.lineitem, ["l_suppkey"], ["l_linenumber", "l_returnflag"])


@plan("A5 T1 W3", """
WITH x AS (SELECT user_id, event_id, CASE WHEN value > 20 THEN value END AS v, CASE WHEN event_type <> 'view' THEN event_type END AS k FROM events)
SELECT user_id, min_by(v, event_id) FILTER (v IS NOT NULL) AS first_v, max_by(k, event_id) FILTER (k IS NOT NULL) AS last_k FROM x GROUP BY user_id""")
def first_non_null(t: Tables) -> DataFrame:
    x = t.events.select(
        "user_id", "event_id", F.when(F.col("value") > 20, F.col("value")).alias("v"),
        F.when(F.col("event_type") != "view", F.col("event_type")).alias("k"),
    )
    return x.groupBy("user_id").agg(
        A.first_value("v", F.col("event_id")).alias("first_v"), A.latest_value("k", F.col("event_id")).alias("last_k")
    )


@plan("A6 A7 E6", """
WITH x AS (UNPIVOT (SELECT l_returnflag, l_quantity, l_extendedprice, CASE WHEN l_tax > 0.02 THEN l_tax END AS l_tax,
  CAST(l_linenumber AS DOUBLE) AS l_linenumber FROM lineitem)
  ON l_quantity, l_extendedprice, l_tax, l_linenumber INTO NAME variable VALUE value),
miss AS (SELECT l_returnflag, count(*) FILTER (l_tax <= 0.02) * 100.0 / count(*) AS pct FROM lineitem GROUP BY 1)
SELECT x.l_returnflag, variable, count(*) AS n, CASE WHEN variable = 'l_tax' THEN max(pct) ELSE 0 END AS missing_pct, avg(value) AS mean,
  stddev_samp(value) AS std, min(value) AS min, max(value) AS max, quantile_cont(value, 0.02) AS p02, quantile_cont(value, 0.25) AS p25,
  quantile_cont(value, 0.5) AS p50, quantile_cont(value, 0.75) AS p75, quantile_cont(value, 0.98) AS p98
FROM x JOIN miss USING (l_returnflag) GROUP BY x.l_returnflag, variable""")
def column_profile(t: Tables) -> DataFrame:
    x = t.lineitem.withColumn("l_tax", F.when(F.col("l_tax") > 0.02, F.col("l_tax")))
    return A.profile(x, ["l_quantity", "l_extendedprice", "l_tax", "l_linenumber"], [0.02, 0.25, 0.5, 0.75, 0.98], ["l_returnflag"])


@plan("A10 A11 A12", with_clauses(GRID) + """,
m AS (SELECT brand, entry_id, sum(yield * acres) / sum(acres) AS m FROM grid GROUP BY ALL)
SELECT brand, entry_id, max(m) AS yield, sum(acres * (yield - m) * (yield - m)) / sum(acres) AS variance,
  sqrt(sum(acres * (yield - m) * (yield - m)) / nullif(sum(acres) - sum(acres * acres) / sum(acres), 0)) AS stddev,
  sum(CASE WHEN NOT is_outlier THEN yield * acres END) / sum(CASE WHEN NOT is_outlier THEN acres END) AS yield_env
FROM grid JOIN m USING (brand, entry_id) GROUP BY ALL""")
def acre_weighted_statistics(t: Tables) -> DataFrame:
    x, w = F.col("yield"), F.col("acres")
    return grid(t).groupBy("brand", "entry_id").agg(
        A.weighted_mean(x, w).alias("yield"),
        A.weighted_variance(x, w).alias("variance"),
        A.weighted_stddev(x, w).alias("stddev"),
        A.weighted_mean(x, w, where=~F.col("is_outlier")).alias("yield_env"),
    )


@plan("A16 H13 H20", with_clauses(TRIAL) + """,
x AS (SELECT decision_group, entry_id, 'priority' AS breakout_level, breakout AS breakout_level_value, value, cpifl FROM trial
  UNION ALL SELECT decision_group, entry_id, 'na', 'all', value, cpifl FROM trial)
SELECT decision_group, entry_id, breakout_level, breakout_level_value, count(*) AS n, avg(value) AS mean,
  CAST(sum(CAST(cpifl AS INTEGER)) AS BIGINT) AS n_flagged FROM x GROUP BY ALL""")
def totals_beside_breakouts(t: Tables) -> DataFrame:
    x = trial(t).withColumns({"breakout_level": F.lit("priority"), "breakout_level_value": F.col("breakout")})
    fine = x.groupBy("decision_group", "entry_id", "breakout_level", "breakout_level_value").agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"), F.count_if("cpifl").alias("n_flagged")
    )
    both = A.totals_row(fine, "breakout_level", "breakout_level_value")
    return both.groupBy("decision_group", "entry_id", "breakout_level", "breakout_level_value").agg(
        F.sum("n").alias("n"), (F.sum("total") / F.sum("n")).alias("mean"), F.sum("n_flagged").alias("n_flagged")
    )


_ACCURACY = with_clauses(TRIAL) + """,
m AS (SELECT decision_group, trait, trial_id, entry_id, avg(value) AS a, avg(price / 1500) AS p FROM trial GROUP BY ALL),
r AS (SELECT *, rank() OVER (PARTITION BY decision_group, trait, trial_id ORDER BY a) + (count(*) OVER (PARTITION BY decision_group, trait, trial_id, a) - 1) / 2.0 AS ra,
  rank() OVER (PARTITION BY decision_group, trait, trial_id ORDER BY p) + (count(*) OVER (PARTITION BY decision_group, trait, trial_id, p) - 1) / 2.0 AS rp FROM m),
u AS (SELECT decision_group, trait, trial_id, CASE WHEN count(*) > 2 AND stddev_pop(a) > 0 AND stddev_pop(p) > 0 THEN corr(a, p) END AS pearson,
  CASE WHEN count(*) > 2 AND stddev_pop(a) > 0 AND stddev_pop(p) > 0 THEN corr(ra, rp) END AS spearman, sqrt(avg((a - p) * (a - p))) AS rmse, count(*) AS n_obs FROM r GROUP BY ALL)
"""


@plan("A18 A22", _ACCURACY + "SELECT decision_group, trait, trial_id, pearson, spearman, rmse, n_obs FROM u")
def accuracy_per_trial(t: Tables) -> DataFrame:
    m = trial(t).groupBy("decision_group", "trait", "trial_id", "entry_id").agg(
        F.avg("value").alias("a"), F.avg(F.col("price") / 1500).alias("p")
    )
    return A.accuracy(m, ["decision_group", "trait", "trial_id"], "a", "p")


@plan("A17 A18 E18", _ACCURACY + """
SELECT coalesce(CAST(decision_group AS VARCHAR), 'all') AS decision_group, coalesce(trait, 'all') AS trait, avg(pearson) AS pearson,
  avg(spearman) AS spearman, avg(rmse) AS rmse, CAST(sum(n_obs) AS BIGINT) AS n_obs
FROM u WHERE pearson IS NOT NULL GROUP BY CUBE (decision_group, trait)""")
def accuracy_over_all_combinations(t: Tables) -> DataFrame:
    rows = trial(t).select("decision_group", "trait", "trial_id", "entry_id", F.col("value").alias("a"), (F.col("price") / 1500).alias("p"))
    return A.accuracy_cube(rows, ["trial_id"], ["decision_group", "trait"], "entry_id", "a", "p")


@plan("A13", with_clauses(TRIAL) + """
SELECT decision_group, entry_id, exp(avg(ln(value))) AS plain, exp(sum(ln(value) * price) / sum(price)) AS weighted,
  sum(value * price) / sum(price) AS arithmetic FROM trial GROUP BY ALL""")
def geometric_means(t: Tables) -> DataFrame:
    return trial(t).groupBy("decision_group", "entry_id").agg(
        A.geometric_mean(F.col("value")).alias("plain"),
        A.weighted_geometric_mean(F.col("value"), F.col("price")).alias("weighted"),
        A.weighted_mean(F.col("value"), F.col("price")).alias("arithmetic"),
    )


@plan("A19 E8", with_clauses(GRID) + """
SELECT entry_id, region_type, region_name, sum(CASE WHEN yield > 60 THEN acres ELSE 0 END) AS rec_acres, sum(acres) AS total_acres
FROM (SELECT entry_id, 'brand' AS region_type, brand AS region_name, yield, acres FROM grid
      UNION ALL SELECT entry_id, 'kind', kind, yield, acres FROM grid) GROUP BY ALL""")
def recommended_acres(t: Tables) -> DataFrame:
    return A.threshold_acres(grid(t), ["entry_id"], ["brand", "kind"], "yield", "acres", 60.0)


@plan("A20", """
SELECT p_brand, list_aggregate(list_sort(list_distinct(list(p_type))), 'string_agg', ',') AS kinds FROM part GROUP BY p_brand""")
def unique_text_lists(t: Tables) -> DataFrame:
    return A.unique_texts(t.part, ["p_brand"], {"p_type": "kinds"})


@plan("A21", """
WITH x AS (SELECT p_brand, CASE WHEN p_size > 25 THEN p_size END AS a, CASE WHEN p_retailprice > 2000 THEN p_name END AS b FROM part),
g AS (SELECT p_brand, count(*) AS n_rows, count(*) - count(a) AS a, count(*) - count(b) AS b FROM x GROUP BY 1)
SELECT p_brand, n_rows, 'a' AS "column", a AS n_missing, a = n_rows AS wholly_missing FROM g
UNION ALL SELECT p_brand, n_rows, 'b', b, b = n_rows FROM g""")
def missing_values_by_group(t: Tables) -> DataFrame:
    x = t.part.select(
        "p_brand", F.when(F.col("p_size") > 25, F.col("p_size")).alias("a"), F.when(F.col("p_retailprice") > 2000, F.col("p_name")).alias("b")
    )
    return A.missing_counts(x, ["p_brand"], ["a", "b"])


@plan("A23", """
SELECT event_type, CAST(least(19, floor(value / 5)) AS INTEGER) AS bin, count(*) AS n FROM events WHERE value BETWEEN 0 AND 100 GROUP BY ALL""")
def fixed_bin_histogram(t: Tables) -> DataFrame:
    return A.histogram(t.events, "value", 0.0, 100.0, 20, ["event_type"])


@plan("A24")
def resampled_threshold(t: Tables) -> DataFrame:
    return A.resampled_distance_threshold(t.lineitem, "l_quantity", 0.0, 50.0, samples=100, repeats=5000)


@plan("A25", """
WITH x AS (SELECT l_suppkey, l_suppkey % 10 = 0 AS is_check, l_returnflag, l_quantity, l_tax FROM lineitem)
SELECT l_suppkey, is_check, CASE WHEN is_check THEN l_returnflag END AS l_returnflag, avg(l_quantity) AS l_quantity_mean,
  max(l_quantity) AS l_quantity_max, sum(l_tax) AS l_tax_sum FROM x GROUP BY ALL""")
def planned_aggregates_with_split(t: Tables) -> DataFrame:
    x = t.lineitem.select("l_suppkey", (F.col("l_suppkey") % 10 == 0).alias("is_check"), "l_returnflag", "l_quantity", "l_tax")
    return A.aggregate_by_plan(
        x, ["l_suppkey"], {"l_quantity": ["mean", "max"], "l_tax": ["sum"]}, split_by="is_check", split_keys=["l_returnflag"]
    )
