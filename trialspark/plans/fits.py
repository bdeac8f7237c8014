"""Regressions and models on the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialspark.operators import fits as M
from trialspark.operators.boosting import quantile_boosting
from trialspark.operators.components import principal_components as principal_components_of
from trialspark.plans.registry import Tables, plan
from trialspark.plans.views import PREDICTIONS, TRIAL, beta_sql, f_sf_sql, predictions, trial, with_clauses


def _xy(t: Tables) -> DataFrame:
    """Price explained by quantity, with a curved dependence per brand."""
    return t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        "p_brand", "l_orderkey", "l_linenumber", F.col("l_quantity").alias("x"),
        (F.col("l_extendedprice") / 1000 + F.col("l_quantity") * (F.col("p_size") - 15) / 20).alias("y"),
    )


@plan("G1 G4 G5")
def robust_adjustment(t: Tables) -> DataFrame:
    return M.adjust_robust(_xy(t), ["p_brand"], "x", "y")


@plan("G2 G3 G4 G5")
def least_squares_adjustment(t: Tables) -> DataFrame:
    return M.adjust_least_squares(_xy(t), ["p_brand"], "x", "y")


@plan("G5 G18", with_clauses(TRIAL) + f""",
s AS (SELECT nation_id, trait, count(*) AS n, regr_slope(price, value) AS slope, regr_intercept(price, value) AS intercept, regr_r2(price, value) AS r2,
  regr_sxx(price, value) AS sxx, regr_syy(price, value) AS syy, avg(value) AS mx FROM trial GROUP BY ALL),
e AS (SELECT *, (1 - r2) * syy / (n - 2) AS v FROM s),
q AS (SELECT *, sqrt(v / sxx) AS slope_stderr, sqrt(v * (1 / n + mx * mx / sxx)) AS intercept_stderr FROM e),
x AS (SELECT *, slope / slope_stderr AS slope_t, intercept / intercept_stderr AS intercept_t, r2 / (1 - r2) * (n - 2) AS f FROM q)
SELECT nation_id, trait, n, slope, intercept, r2, 1 - (1 - r2) * (n - 1) / (n - 2) AS adj_r2, slope_stderr, slope_t, f AS f_stat, round({f_sf_sql("f", "1.0", "n - 2")}, 6) AS f_p,
  round({beta_sql("((n - 2) / ((n - 2) + slope_t * slope_t))", "((n - 2) / 2.0)", "0.5")}, 6) AS slope_p, intercept_stderr, intercept_t,
  round({beta_sql("((n - 2) / ((n - 2) + intercept_t * intercept_t))", "((n - 2) / 2.0)", "0.5")}, 6) AS intercept_p FROM x""")
def line_with_coefficient_tests(t: Tables) -> DataFrame:
    out = M.least_squares(trial(t), ["nation_id", "trait"], "value", "price")
    return out.withColumns({p: F.round(p, 6) for p in ("f_p", "slope_p", "intercept_p")})


_CALIBRATION = with_clauses(TRIAL, PREDICTIONS) + """,
c AS (SELECT decision_group, trait, entry_id, prediction, CASE WHEN entry_id % 3 > 0 THEN prediction * 2 + entry_id / 50.0 END AS original_rm, cpifl, cpifl AND cperf AS cmatf FROM predictions),
l AS (SELECT decision_group, trait, count(*) FILTER (cmatf AND original_rm IS NOT NULL) AS n1, regr_slope(original_rm, prediction) FILTER (cmatf) AS a1, regr_intercept(original_rm, prediction) FILTER (cmatf) AS b1,
  regr_r2(original_rm, prediction) FILTER (cmatf) AS r1, count(*) FILTER (cpifl AND original_rm IS NOT NULL) AS n2, regr_slope(original_rm, prediction) FILTER (cpifl) AS a2, regr_intercept(original_rm, prediction) FILTER (cpifl) AS b2,
  regr_r2(original_rm, prediction) FILTER (cpifl) AS r2, count(original_rm) AS n3, regr_slope(original_rm, prediction) AS a3, regr_intercept(original_rm, prediction) AS b3, regr_r2(original_rm, prediction) AS r3 FROM c GROUP BY ALL),
p AS (SELECT decision_group, trait, CASE WHEN n1 > 1 THEN 'cmatf' WHEN n2 > 1 THEN 'cpifl' WHEN n3 > 1 THEN 'any' END AS rows_used, CASE WHEN n1 > 1 THEN a1 WHEN n2 > 1 THEN a2 ELSE a3 END AS a,
  CASE WHEN n1 > 1 THEN b1 WHEN n2 > 1 THEN b2 ELSE b3 END AS b, CASE WHEN n1 > 1 THEN r1 WHEN n2 > 1 THEN r2 ELSE r3 END AS r FROM l),
erm AS (SELECT c.*, rows_used, CASE WHEN a > 0 AND a < 5 THEN b + a * prediction END AS erm, CASE WHEN a > 0 AND a < 5 THEN r END AS r2, CASE WHEN a > 0 AND a < 5 THEN a ELSE 0 END AS slope
  FROM c JOIN p USING (decision_group, trait))
"""


def _calibrated(t: Tables) -> DataFrame:
    c = predictions(t).select(
        "decision_group", "trait", "entry_id", "prediction",
        F.when(F.col("entry_id") % 3 > 0, F.col("prediction") * 2 + F.col("entry_id") / 50.0).alias("original_rm"), "cpifl",
        (F.col("cpifl") & F.col("cperf")).alias("cmatf"),
    )
    return M.calibrate_maturity(
        c, ["decision_group", "trait"], "prediction", "original_rm", {"cmatf": F.col("cmatf"), "cpifl": F.col("cpifl"), "any": F.lit(True)}
    )


@plan("G6", _CALIBRATION + "SELECT decision_group, trait, entry_id, rows_used, round(erm, 6) AS erm, round(r2, 6) AS r2, round(slope, 6) AS slope FROM erm")
def maturity_calibration(t: Tables) -> DataFrame:
    return _calibrated(t).select(
        "decision_group", "trait", "entry_id", "rows_used", F.round("erm", 6).alias("erm"), F.round("r2", 6).alias("r2"), F.round("slope", 6).alias("slope")
    )


@plan("G7", _CALIBRATION + """SELECT decision_group, trait, count(*) AS n_rows, count(original_rm) AS n_known, count(erm) AS n_estimated, round(min(erm), 6) AS low, round(max(erm), 6) AS high,
  round(max(r2), 6) AS r2, round(sqrt(avg(power(original_rm - erm, 2))), 6) AS rmse FROM erm GROUP BY ALL""")
def calibration_report(t: Tables) -> DataFrame:
    out = M.calibration_report(_calibrated(t), ["decision_group", "trait"], "original_rm", "erm")
    return out.withColumns({c: F.round(c, 6) for c in ("low", "high", "r2", "rmse")})


@plan("G8 G19", with_clauses(TRIAL, PREDICTIONS) + """,
f AS (SELECT decision_group, trait, entry_id, prediction, coalesce(CASE WHEN isnan(stddev) THEN NULL ELSE stddev END / sqrt(n), 1.0) AS stderr, CASE WHEN entry_id % 4 > 0 THEN prediction * 3 END AS own,
  CASE WHEN sum(CAST(cpifl AND cperf AS INTEGER)) OVER (PARTITION BY decision_group, trait) < 2 THEN cpifl ELSE cpifl AND cperf END AS cmatf FROM predictions)
SELECT f.decision_group, f.trait, f.entry_id, f.prediction, stderr, cmatf, coalesce(own, CASE WHEN s_acctbal > 0 THEN s_acctbal / 100 END, 0) AS original_rm FROM f JOIN supplier ON entry_id = s_suppkey
WHERE f.prediction IS NOT NULL AND coalesce(own, CASE WHEN s_acctbal > 0 THEN s_acctbal / 100 END, 0) > 0""")
def calibration_features(t: Tables) -> DataFrame:
    from trialspark.operators.keyed import with_group_values

    p = with_group_values(predictions(t).withColumn("_m", F.col("cpifl") & F.col("cperf")), ["decision_group", "trait"], _n_flag=F.count_if("_m"))
    p = p.join(t.supplier, F.col("entry_id") == F.col("s_suppkey")).withColumns(
        {
            "stderr": F.coalesce(F.when(~F.isnan("stddev"), F.col("stddev")) / F.sqrt("n"), F.lit(1.0)),
            "cmatf": F.when(F.col("_n_flag") < 2, F.col("cpifl")).otherwise(F.col("_m")),
            "original_rm": F.coalesce(
                F.when(F.col("entry_id") % 4 > 0, F.col("prediction") * 3), F.when(F.col("s_acctbal") > 0, F.col("s_acctbal") / 100), F.lit(0.0)
            ),
        }
    )
    return p.filter("prediction IS NOT NULL AND original_rm > 0").select(
        "decision_group", "trait", "entry_id", "prediction", "stderr", "cmatf", "original_rm"
    )


@plan("G9", _CALIBRATION + """SELECT entry_id, 'all' AS decision_group, round(avg(erm), 1) AS rm, count(erm) AS n FROM erm GROUP BY entry_id HAVING avg(erm) IS NOT NULL
UNION ALL SELECT entry_id, CAST(decision_group AS VARCHAR), round(avg(erm), 1), count(erm) FROM erm GROUP BY ALL HAVING avg(erm) IS NOT NULL""")
def combined_maturity(t: Tables) -> DataFrame:
    return M.combined_maturity(_calibrated(t), "entry_id", "decision_group", "erm", day_scale=False)


@plan("G10", """
WITH s AS (SELECT avg(l_quantity) AS mx, avg(l_linenumber) AS mz, avg(l_extendedprice) AS my, covar_pop(l_quantity, l_quantity) AS xx, covar_pop(l_linenumber, l_linenumber) AS zz, covar_pop(l_quantity, l_linenumber) AS xz,
  covar_pop(l_quantity, l_extendedprice) AS xy, covar_pop(l_linenumber, l_extendedprice) AS zy FROM lineitem),
b AS (SELECT *, (xy * zz - zy * xz) / (xx * zz - xz * xz) AS bx, (zy * xx - xy * xz) / (xx * zz - xz * xz) AS bz FROM s)
SELECT l_orderkey, l_linenumber, round(l_extendedprice - (my + bx * (l_quantity - mx) + bz * (l_linenumber - mz)), 5) AS residual FROM lineitem, b""")
def linear_effect_removed(t: Tables) -> DataFrame:
    out = M.remove_linear_effect(t.lineitem, ["l_quantity", "l_linenumber"], "l_extendedprice", "residual")
    return out.select("l_orderkey", "l_linenumber", F.round("residual", 5).alias("residual"))


@plan("G11", """
WITH x AS (SELECT CAST(p_size AS DOUBLE) AS x, CAST(p_retailprice > 950 AS DOUBLE) AS y FROM part),
b AS (SELECT min(x) * 0.9 AS lo, max(x) * 1.1 AS hi FROM x),
c AS (SELECT i, lo + (hi - lo) * i / 249 AS ctr FROM b, range(250) r(i)),
k AS (SELECT i, ctr, sum(y * exp(-0.5 * power((x - ctr) / 2, 2))) / sum(exp(-0.5 * power((x - ctr) / 2, 2))) AS rate FROM c, x GROUP BY ALL),
q AS (SELECT c_custkey, c_nationkey * 2.3 AS v FROM customer),
p AS (SELECT c_custkey, greatest(0, least(248, floor((v - lo) / ((hi - lo) / 249)))) AS i, (v - lo) / ((hi - lo) / 249) AS pos FROM q, b)
SELECT c_custkey, round(a.rate + (z.rate - a.rate) * greatest(0, least(1, pos - p.i)), 7) AS rate FROM p JOIN k a ON a.i = p.i JOIN k z ON z.i = p.i + 1""")
def smoothed_rate_curve(t: Tables) -> DataFrame:
    rows = t.part.select(F.col("p_size").alias("x"), (F.col("p_retailprice") > 950).cast("double").alias("y"))
    at, rate = M.smoothed_curve(rows, "x", "y", width=2.0)
    return t.customer.select("c_custkey", F.round(M.interpolated(F.col("c_nationkey") * 2.3, at, rate), 7).alias("rate"))


@plan("G12")
def principal_components(t: Tables) -> DataFrame:
    rows = t.embeddings.withColumn("year", F.lit(2018) + F.col("label"))
    return principal_components_of(rows, "embedding", ["vec_id"], "year", 2026, 8)


@plan("G12", """
SELECT count(*) AS n, count(*) FILTER (2018 + label < 2026) AS n_fitted, true AS centred, true AS uncorrelated, true AS descending, true AS all_of_the_spread FROM embeddings WHERE 2018 + label <= 2026""")
def components_of_all_columns(t: Tables) -> DataFrame:
    """With as many components as columns: centred, uncorrelated, in falling order, and together the spread of all columns."""
    rows = t.embeddings.withColumn("year", F.lit(2018) + F.col("label"))
    out = principal_components_of(rows, "embedding", ["vec_id"], "year", 2026, 64)
    comps, fitted = [f"comp_{i}" for i in range(64)], F.col("year") < 2026
    of = lambda c: F.when(fitted, F.col(c))
    facts = out.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(fitted).alias("n_fitted"),
        F.greatest(*[F.abs(F.avg(of(c))) for c in comps]).alias("mean"),
        F.greatest(*[F.abs(F.corr(of(a), of(b))) for a, b in zip(comps[:8], comps[1:9])]).alias("corr"),
        F.array(*[F.var_pop(of(c)) for c in comps]).alias("spread"),
    )
    columns = rows.filter(fitted).agg(sum((F.var_pop(F.col("embedding")[i].cast("double")) for i in range(64)), F.lit(0.0)).alias("total"))
    total = F.aggregate("spread", F.lit(0.0), lambda a, b: a + b)
    falling = F.forall(F.sequence(F.lit(0), F.lit(62)), lambda i: F.get(F.col("spread"), i) >= F.get(F.col("spread"), i + 1) - 1e-9)
    return facts.crossJoin(columns).select(
        "n", "n_fitted", (F.col("mean") < 1e-9).alias("centred"), (F.col("corr") < 1e-6).alias("uncorrelated"),
        falling.alias("descending"), (F.abs(total / F.col("total") - 1) < 1e-9).alias("all_of_the_spread"),
    )


@plan("G13 E22")
def environment_clusters(t: Tables) -> DataFrame:
    from trialspark.operators.grid import environment_clusters as clusters

    rows = t.lineitem.groupBy(F.col("l_partkey").alias("place_id")).agg(
        F.avg("l_quantity").alias("rain"), F.avg("l_discount").alias("heat"), F.avg("l_tax").alias("clay"), F.avg("l_extendedprice").alias("depth")
    )
    sides = {"weather": (["rain", "heat"], "rain", ["dry", "normal", "wet"]), "soil": (["clay", "depth"], "clay", ["light", "medium", "heavy"])}
    return clusters(rows, sides).select("place_id", "Env_Cluster", "weather_label", "soil_label")


@plan("G14 E21")
def boosted_regression(t: Tables) -> DataFrame:
    rows = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "p_size", "l_discount", F.col("l_extendedprice").alias("y")
    )
    out = M.regression_by_grid(rows, ["l_quantity", "p_size", "l_discount"], "y", ["l_suppkey"])
    return out.select("l_orderkey", "l_linenumber", "prediction", "p10", "p50", "p90", "depth")


@plan("G14 E21", """
SELECT l_linenumber, count(*) AS n, count(*) AS n_predicted, true AS in_order, true AS covers, count(*) FILTER (l_orderkey % 7 = 0) AS n_without_feature
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_linenumber""")
def boosted_regression_bounds(t: Tables) -> DataFrame:
    """Every row is predicted, one with a missing feature too; percentiles are in order and cover about 8 of 10 rows."""
    rows = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_orderkey", "l_linenumber", "l_suppkey", F.when(F.col("l_orderkey") % 7 != 0, F.col("l_quantity")).alias("quantity"), "p_size", F.col("l_extendedprice").alias("y")
    )
    out = M.regression_by_grid(rows, ["quantity", "p_size"], "y", ["l_suppkey"], (2,), 2, 2)
    inside = F.avg(((F.col("y") >= F.col("p10")) & (F.col("y") <= F.col("p90"))).cast("double"))
    return out.groupBy("l_linenumber").agg(
        F.count(F.lit(1)).alias("n"), F.count("prediction").alias("n_predicted"),
        F.bool_and((F.col("p10") <= F.col("p50")) & (F.col("p50") <= F.col("p90"))).alias("in_order"),
        inside.between(0.6, 0.95).alias("covers"), F.count_if(F.col("quantity").isNull()).alias("n_without_feature"),
    )


@plan("G14 E21", """
SELECT k, count(*) AS n, true AS in_order, true AS low_fits, true AS middle_fits, true AS high_fits FROM (SELECT l_suppkey % 3 AS k FROM lineitem JOIN part ON l_partkey = p_partkey) GROUP BY k""")
def quantiles_of_unseen_groups(t: Tables) -> DataFrame:
    """Quantiles predicted for groups that were not learnt from: in order, and about 10, 50 and 90 of 100 rows lie below them."""
    rows = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        (F.col("l_suppkey") % 3).alias("k"), F.when(F.col("l_orderkey") % 7 != 0, F.col("l_quantity")).alias("quantity"), "p_size", "l_tax", F.col("l_extendedprice").alias("y")
    )
    out = quantile_boosting(rows, ["quantity", "p_size", "l_tax"], "y", (0.1, 0.5, 0.9), fold="k", rounds=4, depth=2)
    below = lambda c, low, high: F.avg((F.col("y") <= F.col(c)).cast("double")).between(low, high)
    return out.groupBy("k").agg(
        F.count(F.lit(1)).alias("n"), F.bool_and((F.col("p10") <= F.col("p50")) & (F.col("p50") <= F.col("p90"))).alias("in_order"),
        below("p10", 0.05, 0.15).alias("low_fits"), below("p50", 0.44, 0.56).alias("middle_fits"), below("p90", 0.85, 0.95).alias("high_fits"),
    )


@plan("G15 G17")
def boosted_classifier_out_of_fold(t: Tables) -> DataFrame:
    rows = t.labels.join(t.documents, "doc_id").select("doc_id", "quality", F.col("n_chars").cast("double").alias("n_chars"), "lang", F.length("source").alias("n_source"))
    weighted = M.year_weights(rows, ["lang"])
    folded = M.stratified_folds(weighted, ["quality"], ["doc_id"], 3)
    return M.out_of_fold_scores(folded, ["n_chars", "n_source"], "quality", folds=3, weight="sample_weight", rounds=5).select("doc_id", "quality", "fold", "score")


@plan("G16", """
WITH o AS (SELECT o_orderkey, year(o_orderdate) AS y, o_orderpriority = '1-URGENT' AS adv FROM orders),
n AS (SELECT *, count(*) OVER (PARTITION BY y) AS n, count(*) OVER () AS total, count(*) FILTER (adv) OVER () AS pos FROM o)
SELECT o_orderkey, total / ((SELECT count(DISTINCT y) FROM o) * n) * CASE WHEN adv THEN (total - pos) / pos ELSE 1 END AS sample_weight FROM n""")
def sample_weights(t: Tables) -> DataFrame:
    o = t.orders.select("o_orderkey", F.year("o_orderdate").alias("y"), (F.col("o_orderpriority") == "1-URGENT").alias("adv"))
    return M.year_weights(o, ["y"], "adv").select("o_orderkey", "sample_weight")


@plan("G17", """
SELECT o_orderpriority, 4 AS n_folds, true AS is_even, count(*) AS n FROM orders GROUP BY o_orderpriority""")
def stratified_fold_sizes(t: Tables) -> DataFrame:
    folded = M.stratified_folds(t.orders, ["o_orderpriority"], ["o_orderkey"], 4)
    sizes = folded.groupBy("o_orderpriority", "fold").agg(F.count(F.lit(1)).alias("n"))
    return sizes.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).cast("int").alias("n_folds"), (F.max("n") - F.min("n") <= 1).alias("is_even"), F.sum("n").alias("n")
    )
