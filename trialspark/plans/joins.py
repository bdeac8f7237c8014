"""Joins on the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialspark.operators import keyed, lookup
from trialspark.plans.registry import Tables, plan

from trialspark.plans.views import PREDICTIONS, TRIAL, predictions, with_clauses
from trialspark.sources.tables import small_table

_CONFIG = [
    # trait, group, stage from, stage to, level, factor
    ("A", 1, 0.0, 20.0, "entry", 1.10),
    ("A", 1, 20.0, 51.0, "entry", 0.90),
    ("R", 2, 0.0, 30.0, "entry", 1.25),
    ("R", None, 0.0, 51.0, "default", 0.75),
    ("N", None, 10.0, 40.0, "default", 0.60),
]
_CONFIG_SQL = """cfg(trait, grp, lo, hi, lvl, factor) AS (VALUES ('A', 1, 0.0::DOUBLE, 20.0::DOUBLE, 'entry', 1.10::DOUBLE),
  ('A', 1, 20.0, 51.0, 'entry', 0.90), ('R', 2, 0.0, 30.0, 'entry', 1.25), ('R', NULL, 0.0, 51.0, 'default', 0.75),
  ('N', NULL, 10.0, 40.0, 'default', 0.60))"""


def _config(t: Tables) -> DataFrame:
    return small_table(t.spark, _CONFIG, "trait string, grp int, lo double, hi double, lvl string, factor double")


@plan("J1 J2", """
SELECT o_orderpriority, c_mktsegment, count(*) AS n, count(s_name) AS n_supplier
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal > 3000) ON l_suppkey = s_suppkey GROUP BY ALL""")
def inner_and_left_joins(t: Tables) -> DataFrame:
    suppliers = t.supplier.filter("s_acctbal > 3000").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    return (
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(suppliers, "l_suppkey", "left")
        .groupBy("o_orderpriority", "c_mktsegment")
        .agg(F.count(F.lit(1)).alias("n"), F.count("s_name").alias("n_supplier"))
    )


@plan("J3", """
WITH a AS (SELECT l_suppkey AS k, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 49 GROUP BY 1),
b AS (SELECT l_suppkey AS k, count(*) AS n FROM lineitem WHERE l_returnflag = 'A' AND l_quantity < 2 GROUP BY 1)
SELECT coalesce(a.k, b.k) AS k, coalesce(a.n, 0) + coalesce(b.n, 0) AS n,
  coalesce(a.n, 0) / (coalesce(a.n, 0) + coalesce(b.n, 0)) AS share FROM a FULL JOIN b ON a.k = b.k""")
def full_join_null_as_zero(t: Tables) -> DataFrame:
    a = t.lineitem.filter("l_returnflag = 'R' AND l_quantity > 49").groupBy(F.col("l_suppkey").alias("k")).agg(F.count(F.lit(1)).alias("na"))
    b = t.lineitem.filter("l_returnflag = 'A' AND l_quantity < 2").groupBy(F.col("l_suppkey").alias("k")).agg(F.count(F.lit(1)).alias("nb"))
    na, nb = F.coalesce("na", F.lit(0)), F.coalesce("nb", F.lit(0))
    return a.join(b, "k", "full").select("k", (na + nb).alias("n"), (na / (na + nb)).alias("share"))


@plan("J4", """
SELECT a.p_partkey AS product, b.p_partkey AS candidate, abs(a.p_retailprice - b.p_retailprice) AS gap
FROM part a JOIN part b ON a.p_brand = b.p_brand AND a.p_type = b.p_type AND abs(a.p_retailprice - b.p_retailprice) <= 5""")
def candidates_within_threshold(t: Tables) -> DataFrame:
    left = t.part.select(F.col("p_partkey").alias("product"), "p_brand", "p_type", F.col("p_retailprice").alias("x"))
    right = t.part.select(F.col("p_partkey").alias("candidate"), "p_brand", "p_type", F.col("p_retailprice").alias("y"))
    pairs = lookup.range_candidates(left, right, ["p_brand", "p_type"], "x", "y", 5.0)
    return pairs.select("product", "candidate", F.abs(F.col("x") - F.col("y")).alias("gap"))


@plan("J5", f"""WITH {_CONFIG_SQL}
SELECT l_orderkey, l_linenumber, factor FROM lineitem JOIN cfg ON l_returnflag = trait AND l_quantity >= lo AND l_quantity < hi
WHERE lvl = 'default'""")
def range_config_join(t: Tables) -> DataFrame:
    rows = lookup.range_lookup(
        t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity"),
        _config(t).filter("lvl = 'default'"),
        {"l_returnflag": "trait"},
        [lookup.Band("l_quantity", "lo", "hi")],
        {"factor": "factor"},
        how="inner",
    )
    return rows.select("l_orderkey", "l_linenumber", "factor")


@plan("J6 PF4", f"""WITH {_CONFIG_SQL}
SELECT l_orderkey, l_linenumber, coalesce(a.factor, b.factor, 1.0) AS factor FROM lineitem
LEFT JOIN cfg a ON a.lvl = 'entry' AND l_returnflag = a.trait AND l_linenumber = a.grp AND l_quantity >= a.lo AND l_quantity < a.hi
LEFT JOIN cfg b ON b.lvl = 'default' AND l_returnflag = b.trait AND l_quantity >= b.lo AND l_quantity < b.hi""")
def specific_then_default_config(t: Tables) -> DataFrame:
    band = [lookup.Band("l_quantity", "lo", "hi")]
    levels = [
        lookup.ConfigLevel(F.col("lvl") == "entry", {"l_returnflag": "trait", "l_linenumber": "grp"}, band),
        lookup.ConfigLevel(F.col("lvl") == "default", {"l_returnflag": "trait"}, band),
    ]
    facts = t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity")
    return lookup.layered_lookup(facts, _config(t), levels, {"factor": F.lit(1.0)}).select("l_orderkey", "l_linenumber", "factor")


@plan("J7", """
WITH m AS (SELECT s_suppkey, CASE s_nationkey % 3 WHEN 0 THEN 'female' WHEN 1 THEN 'male' ELSE 'entry' END AS material FROM supplier),
c(material, weight) AS (VALUES ('pool1', 1), ('pool2', 2), ('entry', 3))
SELECT s_suppkey, m.material, weight FROM m LEFT JOIN c ON m.material = c.material
  OR (m.material = 'female' AND c.material = 'pool1') OR (m.material = 'male' AND c.material = 'pool2')""")
def synonym_aware_join(t: Tables) -> DataFrame:
    third = F.col("s_nationkey") % 3
    material = F.when(third == 0, F.lit("female")).when(third == 1, F.lit("male")).otherwise(F.lit("entry"))
    m = t.supplier.select("s_suppkey", material.alias("material"))
    c = small_table(t.spark, [("pool1", 1), ("pool2", 2), ("entry", 3)], "material string, weight int")
    return lookup.synonym_join(m, c, [], "material", {"female": "pool1", "male": "pool2"})


@plan("J8", """
SELECT DISTINCT s_suppkey, c_custkey FROM supplier JOIN customer ON s_nationkey = c_nationkey OR s_suppkey = c_custkey""")
def either_key_matches(t: Tables) -> DataFrame:
    return lookup.either_key_join(
        t.supplier, t.customer, [("s_nationkey", "c_nationkey"), ("s_suppkey", "c_custkey")], ["s_suppkey"], ["c_custkey"]
    )


@plan("J9 H16", with_clauses(TRIAL, PREDICTIONS, "cfg(x, y) AS (VALUES ('A', 'R'), ('N', 'R'), ('A', 'N'))") + """
SELECT p.decision_group, p.entry_id, c.x, c.y, q.prediction AS prediction_x, p.prediction
FROM predictions p JOIN cfg c ON p.trait = c.y JOIN predictions q ON q.decision_group = p.decision_group AND q.entry_id = p.entry_id AND q.trait = c.x""")
def regression_input_pairs(t: Tables) -> DataFrame:
    from trialspark.operators.flags import regression_pairs

    cfg = small_table(t.spark, [("A", "R"), ("N", "R"), ("A", "N")], "x string, y string")
    return regression_pairs(predictions(t), cfg, ["decision_group", "entry_id"], "trait", "prediction").select(
        "decision_group", "entry_id", "x", "y", "prediction_x", "prediction"
    )


@plan("J12 J17 H12", """
WITH a AS (SELECT s_suppkey, s_acctbal, s_acctbal > 0 AS flag FROM supplier)
SELECT p_partkey, f.s_acctbal AS fp_s_acctbal, f.flag AS fp_flag, m.s_acctbal AS mp_s_acctbal, m.flag AS mp_flag FROM part
LEFT JOIN a f ON f.s_suppkey = p_partkey % 120 LEFT JOIN a m ON m.s_suppkey = p_size""")
def parent_attribute_joins(t: Tables) -> DataFrame:
    a = t.supplier.select("s_suppkey", "s_acctbal", (F.col("s_acctbal") > 0).alias("flag"))
    p = t.part.select("p_partkey", (F.col("p_partkey") % 120).alias("female"), F.col("p_size").cast("bigint").alias("male"))
    out = lookup.parent_attributes(p, a, "s_suppkey", {"fp_": "female", "mp_": "male"}, ["s_acctbal", "flag"])
    return out.drop("female", "male")


_LEVELS_SQL = """WITH x AS (SELECT p_partkey, p_brand, p_type, p_retailprice, CASE WHEN p_size % 3 = 0 THEN p_size END AS attr FROM part),
by_bt AS (SELECT p_brand || p_type AS bt, max(attr) AS attr FROM x WHERE p_retailprice > 930 GROUP BY 1),
by_brand AS (SELECT p_brand, max(attr) AS attr FROM x WHERE p_retailprice < 912 GROUP BY 1),
by_type AS (SELECT p_type, min(attr) AS attr FROM x GROUP BY 1)
"""


@plan("J13 J14 M3", _LEVELS_SQL + """
SELECT x.p_partkey, coalesce(x.attr, a.attr, b.attr, c.attr) AS attr,
  CASE WHEN x.attr IS NOT NULL THEN 'own' WHEN a.attr IS NOT NULL THEN 'brand_type' WHEN b.attr IS NOT NULL THEN 'brand'
       WHEN c.attr IS NOT NULL THEN 'type' END AS attr_source
FROM x LEFT JOIN by_bt a ON a.bt = x.p_brand || x.p_type LEFT JOIN by_brand b USING (p_brand) LEFT JOIN by_type c USING (p_type)""")
def identifier_fallback(t: Tables) -> DataFrame:
    x = t.part.select(
        "p_partkey", "p_brand", "p_type", "p_retailprice", F.concat("p_brand", "p_type").alias("bt"),
        F.when(F.col("p_size") % 3 == 0, F.col("p_size")).alias("attr"),
    )
    levels = [
        ("brand_type", "bt", x.filter("p_retailprice > 930").groupBy("bt").agg(F.max("attr").alias("attr"))),
        ("brand", "p_brand", x.filter("p_retailprice < 912").groupBy("p_brand").agg(F.max("attr").alias("attr"))),
        ("type", "p_type", x.groupBy("p_type").agg(F.min("attr").alias("attr"))),
    ]
    return lookup.fallback_join(x, levels, ["attr"], "attr_source").select("p_partkey", "attr", "attr_source")


@plan("J15 J16", """
SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')
AND c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 2)""")
def semi_and_anti_joins(t: Tables) -> DataFrame:
    urgent = t.orders.filter("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    nations = t.nation.filter("n_regionkey = 2").select(F.col("n_nationkey").alias("c_nationkey"))
    return t.customer.join(urgent, "c_custkey", "left_anti").join(nations, "c_nationkey", "left_semi").select("c_custkey", "c_mktsegment")


@plan("J18 J19", """
WITH pts AS (SELECT c_custkey, round(c_acctbal / 500, 0) AS cell, c_nationkey FROM customer),
req AS (SELECT DISTINCT cell, c_nationkey FROM pts), grid AS (SELECT cell, c_nationkey, count(*) OVER (PARTITION BY cell) AS cells_at FROM req)
SELECT c_custkey, cell, cells_at FROM pts LEFT JOIN grid USING (cell, c_nationkey)""")
def rounded_coordinate_join(t: Tables) -> DataFrame:
    from trialspark.operators.grid import join_rounded

    pts = t.customer.select("c_custkey", (F.col("c_acctbal") / 500).alias("lat"), "c_nationkey")
    requests = pts.select(F.round("lat", 0).alias("lat"), "c_nationkey").dropDuplicates()
    grid = keyed.with_group_values(requests, ["lat"], cells_at=F.count(F.lit(1)))
    out = join_rounded(pts, grid, ["lat"], ["c_nationkey"], 0)
    return out.select("c_custkey", F.col("lat_key").alias("cell"), "cells_at")


@plan("J20", """
WITH a AS (SELECT l_partkey AS id, year(l_shipdate) AS yr, max(l_quantity) AS v FROM lineitem GROUP BY ALL),
al AS (SELECT p_partkey AS id, p_brand || p_type || p_size AS code FROM part),
inh AS (SELECT b.id, yr, max(v) AS v FROM a JOIN al x ON a.id = x.id JOIN al b ON b.code = x.code GROUP BY ALL)
SELECT id, CAST(yr AS INTEGER) AS yr, max(v) AS v FROM (SELECT * FROM a UNION ALL SELECT * FROM inh) GROUP BY ALL""")
def alias_expansion(t: Tables) -> DataFrame:
    rows = t.lineitem.groupBy(F.col("l_partkey").alias("id"), F.year("l_shipdate").alias("yr")).agg(F.max("l_quantity").alias("v"))
    aliases = t.part.select(F.col("p_partkey").alias("id"), F.concat("p_brand", "p_type", "p_size").alias("code"))
    return lookup.expand_aliases(rows, aliases, "id", "code", ["yr"], "v")


@plan("J21", """
WITH k AS (SELECT DISTINCT l_linenumber + l_suppkey AS key FROM lineitem),
m AS (SELECT n_nationkey AS target, CAST(n_nationkey AS VARCHAR) AS a1, CAST(n_regionkey * 10 AS VARCHAR) AS a2 FROM nation),
st AS (SELECT target, a1 AS alias, 0 AS pr FROM m UNION ALL SELECT target, a2, 1 FROM m),
best AS (SELECT alias, target FROM st QUALIFY row_number() OVER (PARTITION BY alias ORDER BY pr, target) = 1)
SELECT key, target FROM k LEFT JOIN best ON CAST(key AS VARCHAR) = alias""")
def first_alias_mapping(t: Tables) -> DataFrame:
    k = t.lineitem.select((F.col("l_linenumber") + F.col("l_suppkey")).alias("key")).distinct()
    m = t.nation.select(F.col("n_nationkey").alias("target"), F.col("n_nationkey").alias("a1"), (F.col("n_regionkey") * 10).alias("a2"))
    return lookup.first_alias_match(k, m, "key", ["a1", "a2"], "target")


@plan("J22", """
WITH q AS (SELECT s_suppkey, s_acctbal / 200 AS lat, s_nationkey * 5.0 - 60 AS lon FROM supplier),
p AS (SELECT c_custkey, c_acctbal / 200 AS lat, c_nationkey * 5.0 - 60 AS lon FROM customer),
d AS (SELECT s_suppkey, c_custkey, 2 * 6371 * asin(sqrt(power(sin(radians(p.lat - q.lat) / 2), 2)
  + cos(radians(p.lat)) * cos(radians(q.lat)) * power(sin(radians(p.lon - q.lon) / 2), 2))) AS distance FROM q, p)
SELECT s_suppkey, c_custkey, round(distance, 5) AS distance, CAST(row_number() OVER (PARTITION BY s_suppkey ORDER BY distance, c_custkey) AS INTEGER) AS rank
FROM d QUALIFY rank <= 4""")
def nearest_points(t: Tables) -> DataFrame:
    q = t.supplier.select("s_suppkey", (F.col("s_acctbal") / 200).alias("lat"), (F.col("s_nationkey") * 5.0 - 60).alias("lon"))
    p = t.customer.select("c_custkey", (F.col("c_acctbal") / 200).alias("lat"), (F.col("c_nationkey") * 5.0 - 60).alias("lon"))
    out = lookup.nearest(p, q, "c_custkey", "s_suppkey", ["lat", "lon"], 4, lookup.great_circle)
    return out.withColumn("distance", F.round("distance", 5))


@plan("J23", """
WITH q AS (SELECT vec_id AS query_id, embedding::DOUBLE[] AS e FROM embeddings),
p AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
d AS (SELECT query_id, vec_id, sqrt(list_sum(list_transform(list_zip(q.e, p.e), lambda z: (z[1] - z[2]) * (z[1] - z[2])))) AS distance FROM q, p),
k AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) <= 3)
SELECT query_id, round(max(distance), 4) AS worst, bool_or(distance > 1.0) AS is_far FROM k GROUP BY query_id""")
def nearest_in_feature_space(t: Tables) -> DataFrame:
    q = t.embeddings.select(F.col("vec_id").alias("query_id"), "embedding")
    near = lookup.nearest(t.embeddings, q, "vec_id", "query_id", "embedding", 3, lookup.euclidean)
    return near.groupBy("query_id").agg(F.round(F.max("distance"), 4).alias("worst"), F.bool_or(F.col("distance") > 1.0).alias("is_far"))


@plan("J24", """
WITH y AS (SELECT l_partkey AS id, CAST(year(l_shipdate) AS INTEGER) AS yr, sum(l_quantity) AS vol, count(*) AS n FROM lineitem GROUP BY ALL)
SELECT a.id, a.yr, a.vol, a.n, b.vol AS vol_prev, b.n AS n_prev FROM y a LEFT JOIN y b ON a.id = b.id AND a.yr = b.yr + 1""")
def previous_year_features(t: Tables) -> DataFrame:
    from trialspark.operators.history import with_previous_year

    y = t.lineitem.groupBy(F.col("l_partkey").alias("id"), F.year("l_shipdate").alias("yr")).agg(
        F.sum("l_quantity").alias("vol"), F.count(F.lit(1)).alias("n")
    )
    return with_previous_year(y, ["id"], "yr", ["vol", "n"])


@plan("J25", """
WITH g AS (SELECT l_suppkey % 20 AS experiment, l_suppkey AS grp, count(*) AS n FROM lineitem GROUP BY ALL),
present AS (SELECT s_suppkey AS grp FROM supplier WHERE s_acctbal > 1000)
SELECT experiment, grp FROM g JOIN present USING (grp) QUALIFY row_number() OVER (PARTITION BY experiment ORDER BY n DESC, grp) = 1""")
def group_of_experiment(t: Tables) -> DataFrame:
    g = t.lineitem.groupBy((F.col("l_suppkey") % 20).alias("experiment"), F.col("l_suppkey").alias("grp")).agg(F.count(F.lit(1)).alias("n"))
    present = t.supplier.filter("s_acctbal > 1000").select(F.col("s_suppkey").alias("grp"))
    return keyed.top_per_key(g.join(present, "grp", "left_semi"), ["experiment"], ["-n", "grp"]).select("experiment", "grp")


@plan("J26", """
WITH planned AS (SELECT DISTINCT p_brand, p_partkey FROM part),
scored AS (SELECT l_partkey, avg(l_quantity) AS score FROM lineitem WHERE l_quantity > 49 GROUP BY 1)
SELECT p_brand, count(*) AS n_planned, count(score) AS n_scored, count(*) - count(score) AS n_missing,
  round(sum(coalesce(score, 0)), 6) AS total FROM planned LEFT JOIN scored ON p_partkey = l_partkey GROUP BY p_brand""")
def planned_versus_scored(t: Tables) -> DataFrame:
    from trialspark.operators.history import coverage

    planned = t.part.select("p_brand", "p_partkey").distinct()
    scored = t.lineitem.filter("l_quantity > 49").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.avg("l_quantity").alias("score"))
    listed, _ = coverage(planned, scored, ["p_partkey"], "score")
    return listed.groupBy("p_brand").agg(
        F.count(F.lit(1)).alias("n_planned"),
        F.count_if("is_scored").alias("n_scored"),
        F.count_if(~F.col("is_scored")).alias("n_missing"),
        F.round(F.sum("score"), 6).alias("total"),
    )
