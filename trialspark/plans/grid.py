"""Environment grid and regional products on the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialspark.functions import cleaning as C
from trialspark.operators import grid as G
from trialspark.operators import headtohead as H
from trialspark.operators import keyed, lookup
from trialspark.operators import material as M
from trialspark.operators import reshape as R
from trialspark.plans.registry import Tables, plan
from trialspark.plans.views import GRID, clamp_sql, grid, normal_cdf_sql, with_clauses


@plan("E1", """
WITH acres AS (SELECT p_partkey, p_size AS maturity, p_retailprice AS maturity_acres FROM part WHERE p_retailprice > 910)
SELECT l_partkey, l_linenumber, sum(l_quantity * maturity_acres) AS weighted, max(p_brand) AS p_brand, max(p_type) AS p_type FROM lineitem JOIN acres a ON l_partkey = a.p_partkey AND l_linenumber * 7 = maturity
JOIN part p ON p.p_partkey = l_partkey GROUP BY ALL""")
def grid_with_maturity_acres(t: Tables) -> DataFrame:
    cells = t.lineitem.select(F.col("l_partkey").alias("place"), (F.col("l_linenumber") * 7).alias("maturity"), "l_linenumber", "l_quantity")
    acres = t.part.filter("p_retailprice > 910").select(F.col("p_partkey").alias("place"), F.col("p_size").alias("maturity"), F.col("p_retailprice").alias("maturity_acres"))
    classes = t.part.select(F.col("p_partkey").alias("place"), "p_brand", "p_type")
    out = G.with_acres(cells, classes, acres, "place", "maturity", ["p_brand", "p_type"])
    return out.groupBy(F.col("place").alias("l_partkey"), "l_linenumber").agg(
        F.sum(F.col("l_quantity") * F.col("maturity_acres")).alias("weighted"), F.max("p_brand").alias("p_brand"), F.max("p_type").alias("p_type")
    )


_REGIONAL = with_clauses(GRID) + """,
st AS (SELECT entry_id, cperf, irrigation, 'brand' AS region_type, brand AS region_name, yield, acres, is_outlier FROM grid UNION ALL SELECT entry_id, cperf, irrigation, 'kind', kind, yield, acres, is_outlier FROM grid),
mm AS (SELECT entry_id, irrigation, region_type, region_name, sum(yield * acres) / sum(acres) AS m FROM st GROUP BY ALL),
rg AS (SELECT entry_id, cperf, irrigation, region_type, region_name, count(*) AS n_cells, max(m) AS yield, sum(acres * (yield - m) * (yield - m)) / sum(acres) AS variance,
  sqrt(sum(acres * (yield - m) * (yield - m)) / nullif(sum(acres) - sum(acres * acres) / sum(acres), 0)) AS stddev, sum(CASE WHEN NOT is_outlier THEN yield * acres END) / sum(CASE WHEN NOT is_outlier THEN acres END) AS yield_env
  FROM st JOIN mm USING (entry_id, irrigation, region_type, region_name) GROUP BY ALL)
"""


def _regional(t: Tables) -> DataFrame:
    return G.regional_aggregates(grid(t), ["entry_id", "cperf", "irrigation"], ["brand", "kind"], "yield", "acres", "is_outlier")


@plan("E2 A10 A11 A12", _REGIONAL + "SELECT entry_id, cperf, irrigation, region_type, region_name, n_cells, round(yield, 7) AS yield, round(variance, 6) AS variance, round(stddev, 6) AS stddev, round(yield_env, 7) AS yield_env FROM rg")
def regional_aggregates(t: Tables) -> DataFrame:
    return _regional(t).withColumns(
        {"yield": F.round("yield", 7), "variance": F.round("variance", 6), "stddev": F.round("stddev", 6), "yield_env": F.round("yield_env", 7)}
    )


@plan("E3", with_clauses(GRID) + """
SELECT place_id, irrigation, count(*) AS n_cells, avg(yield) AS yield, stddev_samp(yield) AS stddev, count(*) FILTER (is_outlier) AS n_outliers, avg(yield) FILTER (NOT is_outlier) AS yield_env FROM grid GROUP BY ALL""")
def cell_aggregates_over_years(t: Tables) -> DataFrame:
    return G.cell_aggregates(grid(t), ["place_id", "irrigation"], "yield", "is_outlier")


_RANKS = """,
cl AS (SELECT brand, stage_year, irrigation, kind, avg(yield) AS cm FROM grid GROUP BY ALL),
lo AS (SELECT brand, irrigation, min(cm) AS lowest FROM cl GROUP BY ALL),
pe AS (SELECT brand, stage_year, irrigation, kind, entry_id, avg(yield) AS m FROM grid GROUP BY ALL),
pt AS (SELECT pe.brand, pe.stage_year, pe.irrigation, entry_id, avg(m * lowest / cm) AS points FROM pe JOIN cl USING (brand, stage_year, irrigation, kind) JOIN lo USING (brand, irrigation) GROUP BY ALL),
rk AS (SELECT brand AS region_name, stage_year, irrigation, entry_id, points, CAST(row_number() OVER (PARTITION BY brand, stage_year, irrigation ORDER BY round(points, 9) DESC, entry_id) AS INTEGER) AS rank FROM pt)
"""


def _ranked(t: Tables) -> DataFrame:
    return G.rank_by_environment(grid(t), "brand", ["stage_year"], "irrigation", "kind", "entry_id", "yield")


@plan("E5 W16 T5 E23", with_clauses(GRID) + _RANKS + "SELECT 'brand' AS region_type, region_name, stage_year, irrigation, entry_id, round(round(points, 9), 6) AS points, rank FROM rk")
def ranks_by_environment(t: Tables) -> DataFrame:
    return _ranked(t).withColumn("points", F.round("points", 6))


@plan("E6 ST14", with_clauses(GRID) + """
SELECT brand, irrigation, count(yield) AS n_obs, min(yield) AS min, avg(yield) AS mean, stddev_samp(yield) AS stddev, max(yield) AS max, quantile_cont(yield, 0.25) AS p25, quantile_cont(yield, 0.5) AS median, quantile_cont(yield, 0.75) AS p75
FROM grid GROUP BY ALL""")
def prediction_summary(t: Tables) -> DataFrame:
    return G.prediction_summary(grid(t), ["brand", "irrigation"], "yield").drop("lower", "upper")


@plan("E7 A19", _REGIONAL + _RANKS + """
SELECT r.entry_id, r.region_name, r.irrigation, r.stage_year, r.rank, round(rg.yield, 6) AS yield, ac.rec_acres, ac.total_acres FROM rk r JOIN rg ON rg.region_type = 'brand' AND rg.region_name = r.region_name AND rg.entry_id = r.entry_id AND rg.irrigation = r.irrigation
JOIN (SELECT entry_id, brand, sum(CASE WHEN yield > 60 THEN acres ELSE 0 END) AS rec_acres, sum(acres) AS total_acres FROM grid GROUP BY ALL) ac ON ac.entry_id = r.entry_id AND ac.brand = r.region_name""")
def ranked_regions_with_acres(t: Tables) -> DataFrame:
    from trialspark.operators.aggregates import threshold_acres

    ranks = _ranked(t).select("entry_id", "region_type", "region_name", "irrigation", "stage_year", "rank")
    products = _regional(t).select("entry_id", "irrigation", "region_type", "region_name", F.round("yield", 6).alias("yield"))
    acres = threshold_acres(grid(t), ["entry_id"], ["brand"], "yield", "acres")
    out = ranks.join(products, ["entry_id", "irrigation", "region_type", "region_name"]).join(acres, ["entry_id", "region_type", "region_name"])
    return out.dropDuplicates(["entry_id", "region_name", "irrigation", "stage_year"]).drop("region_type")


_MAHAL = """WITH x AS (SELECT l_orderkey, l_linenumber, l_quantity AS a, l_extendedprice AS b FROM lineitem),
s AS (SELECT avg(a) AS ma, avg(b) AS mb, var_samp(a) AS va, var_samp(b) AS vb, covar_samp(a, b) AS c FROM x),
d AS (SELECT l_orderkey, l_linenumber, (vb * power(a - ma, 2) - 2 * c * (a - ma) * (b - mb) + va * power(b - mb, 2)) / (va * vb - c * c) AS d2 FROM x, s)
"""


@plan("E10", _MAHAL + "SELECT l_orderkey, l_linenumber, round(sqrt(d2), 6) AS mahalanobis, round(exp(-d2 / 2), 6) AS p_value, exp(-d2 / 2) < 0.05 AS is_outlier FROM d")
def mahalanobis_outliers(t: Tables) -> DataFrame:
    # with two columns the chi-square tail is exp(-d2 / 2)
    out = G.mahalanobis(t.lineitem, ["l_quantity", "l_extendedprice"], level=0.05)
    return out.select("l_orderkey", "l_linenumber", F.round("mahalanobis", 6).alias("mahalanobis"), F.round("p_value", 6).alias("p_value"), "is_outlier")


@plan("E11 J22")
def mahalanobis_among_neighbours(t: Tables) -> DataFrame:
    points = t.customer.select("c_custkey", (F.col("c_acctbal") / 200).alias("lat"), (F.col("c_nationkey") * 5.0 - 60).alias("lon"), "c_acctbal")
    rows = t.supplier.select("s_suppkey", (F.col("s_acctbal") / 200).alias("lat"), (F.col("s_nationkey") * 5.0 - 60).alias("lon"), F.col("s_acctbal").alias("c_acctbal"))
    near = lookup.nearest(points, rows, "c_custkey", "s_suppkey", ["lat", "lon"], 12, lookup.great_circle)
    return G.mahalanobis_nearest(rows, near.select("s_suppkey", "c_custkey"), points, "s_suppkey", "c_custkey", ["lat", "c_acctbal"])


@plan("E13", "SELECT avg(l_quantity) AS l_quantity, avg(l_extendedprice) AS l_extendedprice, avg(l_discount) AS l_discount, avg(l_tax) AS l_tax FROM lineitem")
def independent_features(t: Tables) -> DataFrame:
    x = t.lineitem.select(
        "l_quantity", "l_extendedprice", "l_discount", "l_tax", (F.col("l_quantity") * 2 + F.col("l_tax")).alias("near_quantity"), (F.col("l_discount") * F.col("l_discount")).alias("squared_discount")
    )
    kept = G.independent_features(x, x.columns)
    return x.agg(*[F.avg(c).alias(c) for c in kept])


_EXTRACT = """WITH x AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, CASE l_returnflag WHEN 'A' THEN 'YGSMN' WHEN 'R' THEN 'GMSTP' ELSE 'PLHTN' END AS trait, CASE WHEN l_linenumber > 5 THEN l_tax > 0.05 END AS pr_exclude,
  CASE l_linestatus WHEN 'O' THEN 'IRR' ELSE 'NONE' END AS irrigation, c_nationkey, CASE WHEN c_nationkey < 8 THEN 'US' ELSE 'FR' END AS country, CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE c_acctbal / 100 END AS lon,
  CASE WHEN o_orderpriority < '3' THEN 'corn' WHEN o_orderpriority < '5' THEN 'Soy' END AS crop FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey),
k AS (SELECT *, CASE WHEN country = 'US' AND lon > 0 THEN -lon ELSE lon END AS flon FROM x WHERE NOT coalesce(pr_exclude, false) AND ((trait = 'YGSMN' AND l_quantity BETWEEN 3 AND 48) OR (trait = 'GMSTP' AND l_quantity BETWEEN 4.5 AND 35)))
"""


@plan("E17 E19 E20 PF7 PF8 PF11 PF14", _EXTRACT + """
SELECT l_orderkey, l_linenumber, trait, irrigation, coalesce(flon, avg(flon) OVER (PARTITION BY c_nationkey)) AS longitude, CASE WHEN lower(crop) = 'corn' THEN 2 WHEN crop IS NOT NULL THEN 0 ELSE 1 END AS previous_crop_corn, l_quantity AS result FROM k""")
def trial_extract(t: Tables) -> DataFrame:
    word = F.when(F.col("l_returnflag") == "A", F.lit("YGSMN")).when(F.col("l_returnflag") == "R", F.lit("GMSTP")).otherwise(F.lit("PLHTN"))
    x = (
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            "l_orderkey", "l_linenumber", F.col("l_quantity").alias("result"), word.alias("trait"), F.when(F.col("l_linenumber") > 5, F.col("l_tax") > 0.05).alias("pr_exclude"),
            F.when(F.col("l_linestatus") == "O", F.lit("IRR")).otherwise(F.lit("NONE")).alias("irrigation"), F.col("c_nationkey").alias("location"),
            F.when(F.col("c_nationkey") < 8, F.lit("US")).otherwise(F.lit("FR")).alias("country"),
            F.when(F.col("o_orderkey") % 6 != 0, F.col("c_acctbal") / 100).alias("longitude"),
            F.when(F.col("o_orderpriority") < "3", F.lit("corn")).when(F.col("o_orderpriority") < "5", F.lit("Soy")).alias("crop"),
        )
    )
    from trialspark.operators.extract import Market, trial_extract as extract

    market = Market(
        exclude=("pr_exclude",), ranges={"YGSMN": (3, 48), "GMSTP": (4.5, 35)}, western=("US",), crop="corn", crop_column="previous_crop_corn"
    )
    out = extract(x, market, "trait", "result", "location", "longitude", "country", "crop")
    return out.select("l_orderkey", "l_linenumber", "trait", "irrigation", "longitude", "previous_crop_corn", "result")


@plan("E14 W14 R3", """
WITH x AS (SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_shipdate, l_returnflag AS trait, l_quantity AS v, l_suppkey AS loc, CASE WHEN l_tax > 0.02 THEN CAST(l_shipdate AS DATE) END AS plant, CASE WHEN l_linestatus = 'O' THEN 'IRR' ELSE 'DRY' END AS irrigation FROM lineitem),
f AS (SELECT *, coalesce(last_value(plant IGNORE NULLS) OVER (PARTITION BY loc ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_shipdate ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(plant IGNORE NULLS) OVER (PARTITION BY loc ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_shipdate ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS planted FROM x)
SELECT loc, planted, irrigation, avg(v) FILTER (trait = 'A') AS A, avg(v) FILTER (trait = 'R') AS R FROM f GROUP BY ALL HAVING avg(v) FILTER (trait = 'A') IS NOT NULL""")
def trial_table_by_year(t: Tables) -> DataFrame:
    x = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_shipdate", F.col("l_returnflag").alias("trait"), F.col("l_quantity").alias("v"), F.col("l_suppkey").alias("loc"),
        F.when(F.col("l_tax") > 0.02, F.to_date("l_shipdate")).alias("planted"), C.normalised(F.col("l_linestatus"), {"O": "IRR"}, "DRY").alias("irrigation"),
    )
    filled = keyed.fill_in_order(x, ["loc"], ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_shipdate"], ["planted"])
    wide = R.to_wide(filled, ["loc", "planted", "irrigation"], ["trait"], {"": F.avg("v")}, ["A", "R"])
    return R.drop_incomplete(wide, ["A"])


@plan("E15 J17 J19", """
WITH pca AS (SELECT s_suppkey, s_acctbal / 100 AS comp_0, s_nationkey * 1.0 AS comp_1 FROM supplier),
g AS (SELECT DISTINCT round(c_acctbal / 1000, 0) AS lat, c_nationkey, round(c_acctbal / 1000, 0) * 2 AS rain FROM customer),
x AS (SELECT o_orderkey, o_custkey % 90 AS par1, o_orderkey % 110 AS par2, c_acctbal / 1000 AS lat, c_nationkey, year(o_orderdate) AS yr FROM orders JOIN customer ON o_custkey = c_custkey)
SELECT o_orderkey, a.comp_0 AS comp_0_par1, a.comp_1 AS comp_1_par1, b.comp_0 AS comp_0_par2, b.comp_1 AS comp_1_par2, rain, yr = 2001 AND x.c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1) AS is_current FROM x
LEFT JOIN pca a ON a.s_suppkey = par1 LEFT JOIN pca b ON b.s_suppkey = par2 LEFT JOIN g ON g.lat = round(x.lat, 0) AND g.c_nationkey = x.c_nationkey""")
def training_table_assembly(t: Tables) -> DataFrame:
    pca = t.supplier.select("s_suppkey", (F.col("s_acctbal") / 100).alias("comp_0"), (F.col("s_nationkey") * F.lit(1.0)).alias("comp_1"))
    g = t.customer.select(F.round(F.col("c_acctbal") / 1000, 0).alias("lat"), "c_nationkey").distinct().withColumn("rain", F.col("lat") * 2)
    x = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", (F.col("o_custkey") % 90).alias("par1"), (F.col("o_orderkey") % 110).alias("par2"), (F.col("c_acctbal") / 1000).alias("lat"), "c_nationkey", F.year("o_orderdate").alias("yr")
    )
    out = lookup.parent_attributes(x, pca, "s_suppkey", {"f_": "par1", "m_": "par2"}, ["comp_0", "comp_1"])
    out = G.join_rounded(out, g, ["lat"], ["c_nationkey"], 0)
    places = t.nation.filter("n_regionkey = 1").select(F.col("n_nationkey").alias("c_nationkey")).withColumn("_here", F.lit(True))
    out = out.join(places, "c_nationkey", "left").withColumn("is_current", (F.col("yr") == 2001) & F.coalesce("_here", F.lit(False)))
    return out.select(
        "o_orderkey", F.col("f_comp_0").alias("comp_0_par1"), F.col("f_comp_1").alias("comp_1_par1"), F.col("m_comp_0").alias("comp_0_par2"), F.col("m_comp_1").alias("comp_1_par2"), "rain", "is_current"
    )


@plan("E17 M17 J13", """
WITH c AS (SELECT p_partkey, p_brand AS fp_linecode, p_type AS mp_linecode, CASE WHEN p_size % 3 = 0 THEN 'pool1' WHEN p_size % 3 = 1 THEN 'pool2' END AS fp_het_pool, CASE WHEN p_size % 4 = 0 THEN 'pool1' WHEN p_size % 4 = 1 THEN 'pool2' END AS mp_het_pool FROM part),
m AS (SELECT l_partkey, avg(l_discount) AS own_lat FROM lineitem WHERE l_quantity > 30 GROUP BY 1), b AS (SELECT p_brand, avg(l_discount) AS brand_lat FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1)
SELECT c.p_partkey, coalesce(own_lat, brand_lat) AS latitude, CASE WHEN fp_het_pool <> 'pool2' THEN fp_linecode WHEN mp_het_pool = 'pool1' THEN mp_linecode END AS par_hp1_linecode,
  CASE WHEN fp_het_pool = 'pool2' THEN fp_linecode WHEN mp_het_pool <> 'pool1' THEN mp_linecode END AS par_hp2_linecode FROM c LEFT JOIN m ON l_partkey = c.p_partkey LEFT JOIN b ON b.p_brand = fp_linecode""")
def season_table_assembly(t: Tables) -> DataFrame:
    third, fourth = F.col("p_size") % 3, F.col("p_size") % 4
    pool = lambda k: F.when(k == 0, F.lit("pool1")).when(k == 1, F.lit("pool2"))
    c = t.part.select("p_partkey", "p_brand", F.col("p_brand").alias("fp_linecode"), F.col("p_type").alias("mp_linecode"), pool(third).alias("fp_het_pool"), pool(fourth).alias("mp_het_pool"))
    own = t.lineitem.filter("l_quantity > 30").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.avg("l_discount").alias("latitude"))
    brand = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).groupBy("p_brand").agg(F.avg("l_discount").alias("latitude"))
    out = lookup.fallback_join(c, [("own place", "p_partkey", own), ("brand mean", "p_brand", brand)], ["latitude"])
    return M.pool_parents(out, ["linecode"]).select("p_partkey", "latitude", "par_hp1_linecode", "par_hp2_linecode")


@plan("E21", """
SELECT l_orderkey, l_linenumber, CAST(l_quantity AS DOUBLE) AS x0, CAST(l_linenumber AS DOUBLE) AS x1, CASE WHEN l_returnflag = 'A' THEN 1.0 ELSE 0.0 END::DOUBLE AS x2 FROM lineitem WHERE l_linestatus = 'O' AND l_discount IS NOT NULL""")
def model_matrix(t: Tables) -> DataFrame:
    from trialspark.operators.extract import model_matrix as matrix

    rows = t.lineitem.withColumn("is_a", F.when(F.col("l_returnflag") == "A", 1).otherwise(0))
    out = matrix(rows, ["l_orderkey", "l_linenumber"], ["l_quantity", "l_linenumber", "is_a"], F.col("l_linestatus") == "O")
    return out.withColumnsRenamed({"x_l_quantity": "x0", "x_l_linenumber": "x1", "x_is_a": "x2"})
