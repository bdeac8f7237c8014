"""Row-level cleaning rules on the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialspark.functions import cleaning as C
from trialspark.functions import text as X
from trialspark.operators import keyed, lookup, reshape
from trialspark.plans.registry import Tables, plan
from trialspark.plans.views import TRIAL, trial, with_clauses


@plan("PF3", """
SELECT l_orderkey, l_linenumber,
  coalesce(CASE WHEN l_returnflag = 'A' THEN l_quantity > 25 WHEN l_returnflag = 'R' THEN l_discount > 0.05
           ELSE l_tax > 0.04 END, false) AS chkfl FROM lineitem""")
def check_flag_by_selector(t: Tables) -> DataFrame:
    flags = t.lineitem.withColumns({"A": F.col("l_quantity") > 25, "R": F.col("l_discount") > 0.05, "base": F.col("l_tax") > 0.04})
    return flags.select("l_orderkey", "l_linenumber", C.chosen_flag(F.col("l_returnflag"), ["A", "R"], F.col("base")).alias("chkfl"))


@plan("PF4", """
SELECT o_orderkey, coalesce(CASE WHEN o_orderpriority = '1-URGENT' THEN 2.0 END,
  CASE WHEN o_orderstatus = 'F' THEN nullif(o_totalprice, 0) END, 1.0) AS threshold FROM orders""")
def layered_defaults(t: Tables) -> DataFrame:
    specific = F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(2.0))
    fallback = F.when(F.col("o_orderstatus") == "F", F.nullif("o_totalprice", F.lit(0.0)))
    return t.orders.select("o_orderkey", C.first_known(specific, fallback, F.lit(1.0)).alias("threshold"))


@plan("PF5", """
WITH p AS (SELECT l_partkey, l_returnflag, count(*) AS n, avg(l_quantity) - 20 AS prediction,
           stddev_samp(l_extendedprice) / sqrt(count(*)) AS stderr FROM lineitem GROUP BY ALL)
SELECT l_partkey, l_returnflag, CASE WHEN l_returnflag <> 'N' AND prediction < 0 THEN 0 ELSE prediction END AS prediction,
  CASE WHEN stderr > 1000 AND l_returnflag = 'R' THEN NULL WHEN stderr < 1e-4 THEN 1e-4 ELSE stderr END AS stderr,
  CASE WHEN stderr > 1000 AND l_returnflag = 'R' THEN NULL WHEN stderr < 1e-4 THEN 1e-4 ELSE stderr END * sqrt(n) AS stddev
FROM p""")
def usable_predictions(t: Tables) -> DataFrame:
    p = t.lineitem.groupBy("l_partkey", "l_returnflag").agg(
        F.count(F.lit(1)).alias("n"),
        (F.avg("l_quantity") - 20).alias("prediction"),
        (F.stddev_samp("l_extendedprice") / F.sqrt(F.count(F.lit(1)))).alias("stderr"),
    )
    p = p.withColumn("stderr", C.usable_stderr(F.col("stderr"), F.col("l_returnflag") == "R"))
    return p.select(
        "l_partkey",
        "l_returnflag",
        C.nonnegative_prediction(F.col("prediction"), F.col("l_returnflag") != "N").alias("prediction"),
        "stderr",
        C.stddev_from_stderr(F.col("stderr"), F.col("n")).alias("stddev"),
    )


@plan("PF6", """
SELECT event_id, CASE WHEN value * 40 > 1000 THEN 1000 WHEN value * 40 < 0 THEN 0 ELSE value * 40 END AS pctchk,
  CASE WHEN value - 120 < -99 THEN -99 WHEN value - 120 > 99 THEN 99 ELSE value - 120 END AS statistic,
  CASE WHEN value < 1 THEN 0 WHEN value > 99 THEN 99 ELSE value END AS metric_value FROM events""")
def clipped_metrics(t: Tables) -> DataFrame:
    raw = t.events.select(
        "event_id", (F.col("value") * 40).alias("pctchk"), (F.col("value") - 120).alias("statistic"), F.col("value").alias("metric_value")
    )
    return C.clip_metrics(raw)


@plan("PF7", """
SELECT l_orderkey, l_linenumber FROM lineitem WHERE NOT coalesce(CASE WHEN l_linenumber > 5 THEN NULL ELSE l_tax > 0.06 END, false)
AND NOT coalesce(nullif(l_returnflag, 'N') = 'R', false)""")
def exclusion_flags(t: Tables) -> DataFrame:
    tax = F.when(F.col("l_linenumber") > 5, F.lit(None)).otherwise(F.col("l_tax") > 0.06)
    returned = F.nullif("l_returnflag", F.lit("N")) == "R"
    return t.lineitem.filter(C.not_excluded(tax, returned)).select("l_orderkey", "l_linenumber")


@plan("PF8", """
SELECT l_orderkey, l_linenumber FROM lineitem
WHERE (l_returnflag = 'A' AND l_quantity BETWEEN 5 AND 35) OR (l_returnflag = 'R' AND l_quantity BETWEEN 0 AND 20)""")
def plausibility_ranges(t: Tables) -> DataFrame:
    ok = C.plausible(F.col("l_returnflag"), F.col("l_quantity"), {"A": (5, 35), "R": (0, 20)})
    return t.lineitem.filter(ok).select("l_orderkey", "l_linenumber")


@plan("PF9", """
WITH lists AS (SELECT r_regionkey, r_name || ',' || upper(substr(r_name, 1, 1)) || ', X' AS codes FROM region),
codes AS (SELECT DISTINCT upper(substr(n_name, 1, 1)) AS code FROM nation UNION SELECT r_name FROM region)
SELECT r_regionkey, code FROM lists JOIN codes ON list_contains(list_transform(string_split(codes, ','), lambda x: trim(x)), code)""")
def codes_listed_in_text(t: Tables) -> DataFrame:
    lists = t.region.select("r_regionkey", F.concat("r_name", F.lit(","), F.upper(F.substring("r_name", 1, 1)), F.lit(", X")).alias("codes"))
    codes = t.nation.select(F.upper(F.substring("n_name", 1, 1)).alias("code")).union(t.region.select("r_name")).distinct()
    return lookup.listed_in(lists, codes, "codes", "code").select("r_regionkey", "code")


@plan("PF10", """
SELECT p_partkey, p_name FROM part WHERE (lower(p_name) LIKE '%ring%' OR lower(p_name) LIKE 'red%') AND NOT lower(p_name) LIKE '%small%'""")
def pattern_filters(t: Tables) -> DataFrame:
    return t.part.filter(C.matches_but_not(F.col("p_name"), ["%ring%", "red%"], ["%small%"])).select("p_partkey", "p_name")


@plan("PF11", """
WITH loc AS (SELECT c_custkey, c_nationkey, CASE WHEN c_nationkey < 5 THEN 'US' ELSE 'FR' END AS country,
             CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE abs(c_acctbal) / 100 END AS lon FROM customer),
fixed AS (SELECT c_custkey, c_nationkey, CASE WHEN country = 'US' AND lon > 0 THEN -lon ELSE lon END AS lon FROM loc)
SELECT c_custkey, coalesce(lon, avg(lon) OVER (PARTITION BY c_nationkey)) AS longitude FROM fixed""")
def repaired_coordinates(t: Tables) -> DataFrame:
    loc = t.customer.select(
        "c_custkey",
        "c_nationkey",
        F.when(F.col("c_nationkey") < 5, F.lit("US")).otherwise(F.lit("FR")).alias("country"),
        F.when(F.col("c_custkey") % 7 != 0, F.abs("c_acctbal") / 100).alias("lon"),
    )
    fixed = loc.withColumn("lon", C.signed_longitude(F.col("lon"), F.col("country"), ["US"]))
    filled = keyed.with_group_values(fixed, ["c_nationkey"], mean_lon=F.avg("lon"))
    return filled.select("c_custkey", F.coalesce("lon", "mean_lon").alias("longitude"))


@plan("PF12", """
WITH f AS (SELECT n_nationkey, CASE WHEN n_nationkey % 4 = 0 THEN 'none' ELSE CAST(n_nationkey + 0.5 AS VARCHAR) END AS factor,
           CASE WHEN n_regionkey < 3 THEN '*' ELSE '/' END AS op FROM nation)
SELECT s_suppkey, CASE WHEN try_cast(factor AS DOUBLE) IS NULL THEN s_acctbal
  WHEN op = '*' THEN s_acctbal * try_cast(factor AS DOUBLE) ELSE s_acctbal / try_cast(factor AS DOUBLE) END AS value
FROM supplier JOIN f ON s_nationkey = n_nationkey""")
def unit_conversion(t: Tables) -> DataFrame:
    factors = t.nation.select(
        F.col("n_nationkey").alias("s_nationkey"),
        F.when(F.col("n_nationkey") % 4 == 0, F.lit("none")).otherwise((F.col("n_nationkey") + 0.5).cast("string")).alias("factor"),
        F.when(F.col("n_regionkey") < 3, F.lit("*")).otherwise(F.lit("/")).alias("op"),
    )
    return t.supplier.join(factors, "s_nationkey").select(
        "s_suppkey", C.converted(F.col("s_acctbal"), F.col("factor"), F.col("op")).alias("value")
    )


@plan("PF13 A6", """
WITH x AS (SELECT p_partkey, p_brand, CASE WHEN p_size <= 8 THEN p_size ELSE 80 + p_size % 40 END AS rm FROM part),
m AS (SELECT p_brand, median(rm) AS mid FROM x GROUP BY p_brand)
SELECT p_partkey, CAST(CASE WHEN rm < 10 THEN rm * 5 + 80 ELSE rm END AS DOUBLE) AS rm_days,
  CAST(CASE WHEN mid >= 10 AND rm >= 10 THEN (rm - 80) / 5.0 WHEN mid >= 10 THEN rm ELSE rm END AS DOUBLE) AS rm_majority
FROM x JOIN m USING (p_brand)""")
def maturity_scales(t: Tables) -> DataFrame:
    from trialspark.operators.aggregates import percentiles

    small = F.col("p_size") <= 8
    x = t.part.select("p_partkey", "p_brand", F.when(small, F.col("p_size")).otherwise(80 + F.col("p_size") % 40).cast("double").alias("rm"))
    mid = percentiles(x, ["p_brand"], "rm", {"mid": 0.5})
    both = x.join(mid, "p_brand")
    return both.select(
        "p_partkey",
        C.to_day_scale(F.col("rm")).alias("rm_days"),
        F.when(F.col("mid") >= 10, C.to_group_scale(F.col("rm"))).otherwise(F.col("rm")).alias("rm_majority"),
    )


@plan("PF14", """
SELECT o_orderkey, CASE upper(trim(o_orderstatus)) WHEN 'F' THEN 'IRR' WHEN 'O' THEN 'DRY' ELSE 'UNK' END AS irrigation FROM orders""")
def normalised_codes(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", C.normalised(F.col("o_orderstatus"), {"f": "IRR", "o": "DRY"}, "UNK").alias("irrigation"))


@plan("PF15", """
WITH c AS (SELECT c_custkey, c_nationkey, c_mktsegment, c_acctbal > -900 AS flag FROM customer)
SELECT c_custkey FROM c QUALIFY NOT bool_and(coalesce(flag, false)) OVER (PARTITION BY c_nationkey, c_mktsegment)""")
def groups_with_non_checks(t: Tables) -> DataFrame:
    c = t.customer.withColumn("flag", F.col("c_acctbal") > -900)
    return keyed.drop_all_flagged_groups(c, ["c_nationkey", "c_mktsegment"], "flag").select("c_custkey")


@plan("PF16 PF17", """
WITH x AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_tax > 0.04 THEN l_tax END AS a, CASE WHEN l_discount > 0.05 THEN l_discount END AS b,
           CASE WHEN l_quantity > 10 THEN l_quantity END AS c, l_extendedprice AS score FROM lineitem),
w AS (SELECT *, CASE WHEN a IS NULL THEN 0.5 ELSE 0 END + CASE WHEN b IS NULL THEN 0.3 ELSE 0 END + CASE WHEN c IS NULL THEN 0.2 ELSE 0 END AS missing_share,
      CAST(a IS NULL AS INTEGER) + CAST(b IS NULL AS INTEGER) + CAST(c IS NULL AS INTEGER) AS n_missing FROM x)
SELECT l_orderkey, l_linenumber, n_missing, CAST(missing_share AS DOUBLE) AS missing_share, CASE WHEN missing_share > 0.75 THEN NULL ELSE score END AS score,
  CASE WHEN missing_share > 0.75 THEN 'too many missing inputs' END AS warning FROM w""")
def missing_input_warning(t: Tables) -> DataFrame:
    x = t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_tax") > 0.04, F.col("l_tax")).alias("a"),
        F.when(F.col("l_discount") > 0.05, F.col("l_discount")).alias("b"),
        F.when(F.col("l_quantity") > 10, F.col("l_quantity")).alias("c"),
        F.col("l_extendedprice").alias("score"),
    )
    x = x.withColumns(
        {"missing_share": C.missing_weight(["a", "b", "c"], {"a": 0.5, "b": 0.3, "c": 0.2}), "n_missing": C.missing_weight(["a", "b", "c"])}
    )
    return C.warn_and_blank(x, F.col("missing_share"), ["score"]).drop("a", "b", "c")


@plan("PF18", "SELECT s_name AS s_name, s_suppkey, s_nationkey, s_acctbal FROM supplier")
def column_order(t: Tables) -> DataFrame:
    return reshape.ordered_columns(t.supplier, ["s_name", "not_there", "s_suppkey"])


@plan("PF19", """
WITH y AS (SELECT o_custkey, o_totalprice, CAST(year(o_orderdate) + CASE WHEN month(o_orderdate) > 8 AND o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END AS INTEGER) AS plant_year FROM orders)
SELECT plant_year, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM y
WHERE plant_year > (SELECT min(plant_year) FROM y) GROUP BY plant_year""")
def season_shifted_year(t: Tables) -> DataFrame:
    y = t.orders.withColumn("plant_year", C.season_year(F.col("o_orderdate"), F.col("o_orderpriority"), ["1-URGENT", "2-HIGH"]))
    yearly = y.groupBy("plant_year").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    first = keyed.with_group_values(yearly, [], first_year=F.min("plant_year"))
    return first.filter("plant_year > first_year").drop("first_year")


@plan("PF20", """
WITH x AS (SELECT c_nationkey, c_custkey, CASE WHEN c_acctbal = 0 THEN NULL ELSE 1 / c_acctbal END AS v, c_mktsegment = 'BUILDING' AS pos FROM customer),
ok AS (SELECT c_nationkey FROM x GROUP BY 1 HAVING count(*) > 50 AND count(*) FILTER (pos) > 10)
SELECT c_custkey, v FROM x WHERE c_nationkey IN (SELECT c_nationkey FROM ok)""")
def minimum_support(t: Tables) -> DataFrame:
    inverse = F.when(F.col("c_acctbal") == 0, F.lit(float("inf"))).otherwise(1 / F.nullif("c_acctbal", F.lit(0.0)))
    x = t.customer.select("c_nationkey", "c_custkey", C.known(inverse).alias("v"), (F.col("c_mktsegment") == "BUILDING").alias("pos"))
    enough = (F.count(F.lit(1)) > 50) & (F.count_if("pos") > 10)
    return keyed.keep_supported(x, ["c_nationkey"], enough).select("c_custkey", "v")


@plan("E9 E12", """
WITH p AS (SELECT c_custkey, c_acctbal / 200 AS lat, (c_acctbal - 5000) / 100 AS lon FROM customer)
SELECT c_custkey, CASE WHEN lat < 0 THEN 'S' ELSE 'N' END || lpad(CAST(CAST(round(abs(lat) * 100) AS BIGINT) AS VARCHAR), 5, '0')
  || CASE WHEN lon < 0 THEN 'W' ELSE 'E' END || lpad(CAST(CAST(round(abs(lon) * 100) AS BIGINT) AS VARCHAR), 5, '0') AS place_id,
  round(2 * 6371 * asin(sqrt(power(sin(radians(45 - lat) / 2), 2) + cos(radians(lat)) * cos(radians(45)) * power(sin(radians(10 - lon) / 2), 2))), 6) AS km
FROM p""")
def place_ids_and_distances(t: Tables) -> DataFrame:
    p = t.customer.select("c_custkey", (F.col("c_acctbal") / 200).alias("lat"), ((F.col("c_acctbal") - 5000) / 100).alias("lon"))
    return p.select(
        "c_custkey",
        X.place_id(F.col("lat"), F.col("lon")).alias("place_id"),
        F.round(X.haversine(F.col("lat"), F.col("lon"), F.lit(45.0), F.lit(10.0)), 6).alias("km"),
    )


@plan("Z14 Z22", r"""
WITH x AS (SELECT p_partkey, p_brand || ' ' || p_name || ' RM' || p_size || '.0' AS raw FROM part)
SELECT p_partkey, try_cast(nullif(regexp_extract(raw, 'RM\s*([0-9]+(?:\.[0-9]+)?)', 1), '') AS DOUBLE) AS rm,
  trim(regexp_replace(raw, '^Brand#[0-9]+\s*', '')) AS no_brand, regexp_replace(raw, '\.0+$', '') AS no_tail FROM x""")
def product_text_parsing(t: Tables) -> DataFrame:
    x = t.part.select("p_partkey", F.concat("p_brand", F.lit(" "), "p_name", F.lit(" RM"), "p_size", F.lit(".0")).alias("raw"))
    return x.select(
        "p_partkey",
        X.parse_maturity(F.col("raw")).alias("rm"),
        X.without_prefix(F.col("raw"), r"Brand#[0-9]+\s*").alias("no_brand"),
        X.without_decimal_tail(F.col("raw")).alias("no_tail"),
    )
