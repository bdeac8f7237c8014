"""Fitted column transforms on the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialspark.operators import fitted as Q
from trialspark.plans.registry import Tables, plan
from trialspark.plans.views import f_sf_sql


def _train(t: Tables) -> DataFrame:
    return t.lineitem.filter(F.col("l_shipdate") < F.lit("1999-01-01").cast("timestamp"))


@plan("Q1", """
WITH s AS (SELECT avg(l_quantity) AS mq, stddev_pop(l_quantity) AS sq, avg(l_tax) AS mt, stddev_pop(l_tax) AS st FROM lineitem WHERE l_shipdate < TIMESTAMP '1999-01-01')
SELECT l_orderkey, l_linenumber, round((l_quantity - mq) / greatest(sq, 1e-5), 7) AS l_quantity, round((l_tax - mt) / greatest(st, 1e-5), 7) AS l_tax FROM lineitem, s""")
def normalised_columns(t: Tables) -> DataFrame:
    step = Q.fit_normaliser(_train(t), ["l_quantity", "l_tax"])
    out = step(t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_tax"))
    return out.withColumns({c: F.round(c, 7) for c in ("l_quantity", "l_tax")})


@plan("Q2", """
WITH x AS (SELECT l_orderkey, l_linenumber, l_shipdate, CASE WHEN l_tax > 0.03 THEN l_quantity END AS q, CASE WHEN l_discount > 0.02 THEN l_returnflag END AS r FROM lineitem),
m AS (SELECT median(q) AS q FROM x WHERE l_shipdate < TIMESTAMP '1999-01-01'),
k AS (SELECT r FROM x WHERE r IS NOT NULL AND l_shipdate < TIMESTAMP '1999-01-01' GROUP BY r ORDER BY count(*) DESC, r LIMIT 1)
SELECT l_orderkey, l_linenumber, coalesce(x.q, m.q) AS q, coalesce(x.r, k.r) AS r FROM x, m, k""")
def filled_columns(t: Tables) -> DataFrame:
    hide = lambda df: df.select(
        "l_orderkey", "l_linenumber", F.when(F.col("l_tax") > 0.03, F.col("l_quantity")).alias("q"), F.when(F.col("l_discount") > 0.02, F.col("l_returnflag")).alias("r")
    )
    return Q.fit_filler(hide(_train(t)), ["q"], ["r"])(hide(t.lineitem))


@plan("Q3", """
WITH x AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_tax > 0.02 THEN l_quantity END AS a, l_discount * 100 AS b, CASE WHEN l_linenumber > 2 THEN l_linenumber END AS c FROM lineitem)
SELECT l_orderkey, l_linenumber, list_avg([a, b, c]) AS mean, least(a, b, c) AS low, greatest(a, b, c) AS high, CAST(list_count([a, b, c]) AS INTEGER) AS n FROM x""")
def row_aggregates(t: Tables) -> DataFrame:
    x = t.lineitem.select(
        "l_orderkey", "l_linenumber", F.when(F.col("l_tax") > 0.02, F.col("l_quantity")).alias("a"), (F.col("l_discount") * 100).alias("b"),
        F.when(F.col("l_linenumber") > 2, F.col("l_linenumber")).alias("c"),
    )
    cols = ["a", "b", "c"]
    return x.select(
        "l_orderkey", "l_linenumber", Q.row_aggregate(cols, "mean").alias("mean"), Q.row_aggregate(cols, "min").alias("low"),
        Q.row_aggregate(cols, "max").alias("high"), Q.row_aggregate(cols, "count").alias("n"),
    )


@plan("Q4", """
WITH x AS (SELECT p_partkey, p_brand AS technology, CASE WHEN p_size % 3 > 0 THEN p_type END AS herb, p_name AS gene FROM part)
SELECT p_partkey, NOT coalesce((technology = 'Brand#3' AND herb IS NOT NULL AND lower(herb) <> 'small') OR (technology = 'Brand#5' AND lower(gene) IN ('red ring', 'blue bolt')), false) AS qualifiers FROM x""")
def technology_qualifiers(t: Tables) -> DataFrame:
    x = t.part.select("p_partkey", F.col("p_brand").alias("technology"), F.when(F.col("p_size") % 3 > 0, F.col("p_type")).alias("herb"), F.col("p_name").alias("gene"))
    rules = [Q.Qualifier("brand#3", "herb", expected="SMALL"), Q.Qualifier("Brand#5", "gene", forbidden=("red ring", "Blue bolt"))]
    return x.select("p_partkey", Q.qualifies(rules).alias("qualifiers"))


@plan("Q5", """
WITH x AS (SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN '"PI MR3/R14"' WHEN 1 THEN 'ms3-pek' WHEN 2 THEN 'S14--S14' END AS txt FROM part)
SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'pi' WHEN 1 THEN 'pek' END AS source, CASE p_size % 4 WHEN 0 THEN 2 WHEN 1 THEN 1 END AS race_3, CASE p_size % 4 WHEN 0 THEN 3 WHEN 2 THEN 0 END AS race_14 FROM part""")
def race_resistance_columns(t: Tables) -> DataFrame:
    k = F.col("p_size") % 4
    txt = F.when(k == 0, F.lit('"PI MR3/R14"')).when(k == 1, F.lit("ms3-pek")).when(k == 2, F.lit("S14--S14"))
    source, entries = Q.race_resistance(F.col("txt"))
    x = t.part.select("p_partkey", txt.alias("txt")).select("p_partkey", source.alias("source"), entries.alias("entries"))
    return Q.resistance_columns(x, ["p_partkey", "source"], "entries", "race", "level", ["3", "14"], ["s", "ms", "mr", "r"], "race_")


@plan("Q5", """
SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN 2 WHEN 1 THEN 0 END AS rps_1c, CASE p_size % 3 WHEN 0 THEN 1 END AS rps_3a, CASE WHEN p_size % 5 = 0 THEN 'yellow' ELSE lower(p_type) END AS colour FROM part""")
def marker_resistance_columns(t: Tables) -> DataFrame:
    k = F.col("p_size") % 3
    x = t.part.select(
        "p_partkey", F.when(k == 0, F.lit("1C_R;3a_x")).when(k == 1, F.lit("1c_S")).alias("txt"),
        Q.clean_text_trait(F.when(F.col("p_size") % 5 == 0, F.lit('"Yellow hilum"--yellow')).otherwise(F.col("p_type")), suffix="hilum").alias("colour"),
    )
    x = x.withColumn("entries", Q.marker_resistance(F.col("txt")))
    return Q.resistance_columns(x, ["p_partkey", "colour"], "entries", "marker", "resistance", ["1c", "3a"], ["s", "x", "r"], "rps_")


@plan("Q6 R10", """
WITH x AS (SELECT l_orderkey, l_linenumber, l_shipdate, CASE WHEN l_tax > 0.03 THEN l_quantity END AS q, l_returnflag AS r FROM lineitem),
m AS (SELECT median(q) AS q FROM x WHERE l_shipdate < TIMESTAMP '1999-01-01'),
s AS (SELECT avg(coalesce(x.q, m.q)) AS a, stddev_pop(coalesce(x.q, m.q)) AS d FROM x, m WHERE l_shipdate < TIMESTAMP '1999-01-01')
SELECT l_orderkey, l_linenumber, round((coalesce(x.q, m.q) - a) / d, 7) AS q, CAST(r = 'A' AS INTEGER) AS r_A, CAST(r = 'N' AS INTEGER) AS r_N, CAST(r = 'R' AS INTEGER) AS r_R, 0 AS r_missing FROM x, m, s""")
def fitted_pipeline(t: Tables) -> DataFrame:
    view = lambda df: df.select("l_orderkey", "l_linenumber", F.when(F.col("l_tax") > 0.03, F.col("l_quantity")).alias("q"), F.col("l_returnflag").alias("r"))
    steps = [lambda d: Q.fit_filler(d, ["q"]), lambda d: Q.fit_normaliser(d, ["q"]), lambda d: Q.fit_one_hot(d, "r")]
    return Q.fit_pipeline(view(_train(t)), steps)(view(t.lineitem)).withColumn("q", F.round("q", 7))


@plan("Q7", """
WITH c AS (SELECT quantile_cont(l_quantity, 0.05) AS ql, quantile_cont(l_quantity, 0.95) AS qh, quantile_cont(l_linenumber, 0.05) AS nl, quantile_cont(l_linenumber, 0.95) AS nh FROM lineitem),
x AS (SELECT l_orderkey, l_linenumber, greatest(ql, least(qh, l_quantity)) AS q, greatest(nl, least(nh, l_linenumber)) AS n FROM lineitem, c),
s AS (SELECT avg(q) AS a, stddev_samp(q) AS d FROM x)
SELECT l_orderkey, l_linenumber AS line, round((q - a) / d, 7) AS quantity, round(n - 5 / sqrt(20 / 3.0), 7) AS rating FROM x, s""")
def clipped_and_scaled(t: Tables) -> DataFrame:
    x = t.lineitem.select("l_orderkey", F.col("l_linenumber").alias("line"), F.col("l_quantity").alias("quantity"), F.col("l_linenumber").cast("double").alias("rating"))
    out = Q.fit_clipper(x, ["quantity", "rating"], ratings=["rating"])(x)
    return out.withColumns({c: F.round(c, 7) for c in ("quantity", "rating")})


@plan("V16", f"""
WITH x AS (SELECT l_returnflag, UNNEST(['l_quantity', 'l_extendedprice', 'l_tax']) AS feature, UNNEST([l_quantity, l_extendedprice, CASE WHEN l_linenumber > 3 THEN l_tax END]) AS v FROM lineitem),
c AS (SELECT feature, l_returnflag, count(v) AS n, avg(v) AS m, var_pop(v) AS s, count(*) AS al FROM x GROUP BY ALL),
g AS (SELECT feature, sum(n) AS n, sum(n * m) / sum(n) AS gm, sum(n * s) AS w, count(*) AS k, sum(n) / sum(al) AS coverage FROM c GROUP BY 1),
f AS (SELECT g.feature, CAST(max(g.n) AS BIGINT) AS n, max(coverage) AS coverage, sum(c.n * (c.m - gm) * (c.m - gm)) / (max(k) - 1) / (max(w) / (max(g.n) - max(k))) AS f, max(k) AS k FROM c JOIN g USING (feature) GROUP BY g.feature)
SELECT feature, n, coverage, round(f, 6) AS f_stat, round({f_sf_sql("f", "(k - 1)", "(n - k)", 200000)}, 4) AS p_value FROM f""")
def class_separation_by_feature(t: Tables) -> DataFrame:
    x = t.lineitem.withColumn("l_tax", F.when(F.col("l_linenumber") > 3, F.col("l_tax")))
    out = Q.one_way_f(x, ["l_quantity", "l_extendedprice", "l_tax"], "l_returnflag")
    return out.withColumns({"f_stat": F.round("f_stat", 6), "p_value": F.round("p_value", 4)})


@plan("V16", "SELECT l_quantity + l_linenumber > 28 AS late, avg(l_quantity) AS qty, avg(l_tax) AS tax FROM lineitem GROUP BY 1")
def chosen_features(t: Tables) -> DataFrame:
    x = t.lineitem.withColumns(
        {"late": F.col("l_quantity") + F.col("l_linenumber") > 28, "qty_pct": F.col("l_quantity") * 2 + 1, "price": F.col("l_extendedprice"), "qty": F.col("l_quantity"), "tax": F.col("l_tax")}
    )
    kept = Q.choose_features(x, {"quantity": ["qty", "qty_pct"], "price": ["price"], "tax": ["tax"]}, "late")
    return x.groupBy("late").agg(*[F.avg(c).alias(c) for c in kept])
