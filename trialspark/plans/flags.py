"""Check flags and configuration on the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialspark.operators import flags as G
from trialspark.operators import keyed, lookup
from trialspark.plans.registry import Tables, plan
from trialspark.plans.views import PREDICTIONS, TRIAL, predictions, trial, with_clauses
from trialspark.sources.tables import small_table

# hybrids: part = entry, brand = group, one parent by type, one by size
_HYBRIDS = """hybrids AS (
  SELECT p_brand AS grp, CAST(p_partkey AS VARCHAR) AS be_bid, p_type AS par1, 'S' || p_size AS par2, 'female' AS type1, 'pool2' AS type2,
    p_retailprice > 960 AS cpifl, p_retailprice > 980 AS cperf, p_size > 45 AND p_retailprice > 930 AS fp_ltb, p_size < 3 AS mp_ltb FROM part)"""


def _hybrids(t: Tables) -> DataFrame:
    return t.part.select(
        F.col("p_brand").alias("grp"),
        F.col("p_partkey").cast("string").alias("be_bid"),
        F.col("p_type").alias("par1"),
        F.concat(F.lit("S"), "p_size").alias("par2"),
        F.lit("female").alias("type1"),
        F.lit("pool2").alias("type2"),
        (F.col("p_retailprice") > 960).alias("cpifl"),
        (F.col("p_retailprice") > 980).alias("cperf"),
        ((F.col("p_size") > 45) & (F.col("p_retailprice") > 930)).alias("fp_ltb"),
        (F.col("p_size") < 3).alias("mp_ltb"),
    )


@plan("H1", f"""WITH {_HYBRIDS},
r AS (SELECT grp, par1 AS be_bid, max(type1) AS material_type, bool_or(cpifl) AS cpifl, bool_or(cperf) AS cperf, bool_or(fp_ltb) AS fp, bool_or(mp_ltb) AS mp FROM hybrids GROUP BY 1, 2
  UNION ALL SELECT grp, par2, max(type2), bool_or(cpifl), bool_or(cperf), bool_or(fp_ltb), bool_or(mp_ltb) FROM hybrids GROUP BY 1, 2),
m AS (SELECT *, bool_or(fp) OVER w AS has_fp, bool_or(mp) OVER w AS has_mp FROM r WINDOW w AS (PARTITION BY grp, material_type)),
x AS (SELECT *, CASE WHEN NOT has_fp AND NOT has_mp THEN cpifl WHEN NOT has_fp THEN mp ELSE fp END AS fm,
  CASE WHEN NOT has_fp AND NOT has_mp THEN cpifl WHEN NOT has_mp THEN CASE WHEN NOT has_fp THEN mp ELSE fp END ELSE mp END AS mm FROM m),
y AS (SELECT *, CASE WHEN material_type IN ('female', 'pool1') THEN fm ELSE mm END AS ltb FROM x)
SELECT grp, be_bid, material_type, cpifl AND ltb AS cpifl, cperf AND ltb AS cperf FROM y""")
def parent_check_flags(t: Tables) -> DataFrame:
    return G.parent_flags(_hybrids(t), ["grp"], "be_bid", {"par1": "type1", "par2": "type2"}, ["cpifl", "cperf"])


@plan("H2 J16", f"""WITH {_HYBRIDS},
p1 AS (SELECT DISTINCT grp, par1 FROM hybrids), p2 AS (SELECT DISTINCT grp, par2 FROM hybrids)
SELECT grp, par1, par2, par1 || '/' || par2 AS entry_id FROM p1 JOIN p2 USING (grp)
WHERE (grp, par1, par2) NOT IN (SELECT grp, par1, par2 FROM hybrids)""")
def untested_crosses(t: Tables) -> DataFrame:
    h = _hybrids(t)
    parents = h.select("grp", F.col("par1").alias("parent"), F.col("type1").alias("material_type")).union(h.select("grp", "par2", "type2"))
    return G.untested_crosses(parents, h, ["grp"], "parent", "material_type", ("par1", "par2"))


_FALLBACK = """WITH c AS (SELECT c_nationkey, c_mktsegment, c_custkey, c_acctbal > 9500 AS cpifl, c_acctbal > 9000 AND c_nationkey > 10 AS cperf FROM customer),
w AS (SELECT *, bool_or(cpifl) OVER g AS hc, bool_or(cperf) OVER g AS hp, count(*) OVER g AS n FROM c WINDOW g AS (PARTITION BY c_nationkey, c_mktsegment)),
x AS (SELECT *, CASE WHEN NOT hc{limit} THEN true ELSE cpifl END AS c2 FROM w)
SELECT c_custkey, c2 AS cpifl, CASE WHEN NOT hp THEN c2 ELSE cperf END AS cperf FROM x"""


def _customers(t: Tables) -> DataFrame:
    return t.customer.select(
        "c_nationkey", "c_mktsegment", "c_custkey", (F.col("c_acctbal") > 9500).alias("cpifl"),
        ((F.col("c_acctbal") > 9000) & (F.col("c_nationkey") > 10)).alias("cperf"),
    )


@plan("H3", _FALLBACK.replace("{limit}", " AND n < 10"))
def small_groups_without_checks(t: Tables) -> DataFrame:
    out = G.fill_missing_checks(_customers(t), ["c_nationkey", "c_mktsegment"], ["cpifl", "cperf"], below=10)
    return out.select("c_custkey", "cpifl", "cperf")


@plan("H24", _FALLBACK.replace("{limit}", ""))
def groups_without_checks(t: Tables) -> DataFrame:
    out = G.fill_missing_checks(_customers(t), ["c_nationkey", "c_mktsegment"], ["cpifl", "cperf"], below=None)
    return out.select("c_custkey", "cpifl", "cperf")


_FLAGGED = with_clauses(TRIAL, PREDICTIONS) + """,
p AS (SELECT *, CASE WHEN entry_id % 3 = 0 THEN 'female' ELSE 'entry' END AS material_type, CASE trait WHEN 'A' THEN 'cperf' WHEN 'R' THEN 'cmatf' END AS dme_chkfl FROM predictions),
f AS (SELECT s_suppkey AS entry_id, CASE WHEN s_suppkey % 3 = 0 THEN 'pool1' ELSE 'entry' END AS material_type, s_suppkey % 10 = 0 AS cpifl, s_acctbal > 6000 AS cperf, s_nationkey > 12 AS cmatf
  FROM supplier WHERE s_acctbal > 100)
"""


def _flag_inputs(t: Tables) -> tuple[DataFrame, DataFrame]:
    third = F.col("entry_id") % 3 == 0
    p = predictions(t).drop("cpifl", "cperf").withColumns(
        {
            "material_type": F.when(third, F.lit("female")).otherwise(F.lit("entry")),
            "dme_chkfl": F.when(F.col("trait") == "A", F.lit("cperf")).when(F.col("trait") == "R", F.lit("cmatf")),
        }
    )
    f = t.supplier.filter("s_acctbal > 100").select(
        F.col("s_suppkey").alias("entry_id"),
        F.when(F.col("s_suppkey") % 3 == 0, F.lit("pool1")).otherwise(F.lit("entry")).alias("material_type"),
        (F.col("s_suppkey") % 10 == 0).alias("cpifl"),
        (F.col("s_acctbal") > 6000).alias("cperf"),
        (F.col("s_nationkey") > 12).alias("cmatf"),
    )
    return p, f


_CHKFL_SQL = "coalesce(CASE dme_chkfl WHEN 'cperf' THEN f.cperf WHEN 'cmatf' THEN f.cmatf ELSE f.cpifl END, false)"


@plan("H4 PF3 J7", _FLAGGED + f"""SELECT p.decision_group, p.entry_id, p.trait, p.material_type, p.prediction, coalesce(f.cpifl, false) AS cpifl, {_CHKFL_SQL} AS chkfl
FROM p LEFT JOIN f ON p.entry_id = f.entry_id AND (p.material_type = f.material_type OR (p.material_type = 'female' AND f.material_type = 'pool1'))""")
def predictions_with_flags(t: Tables) -> DataFrame:
    p, f = _flag_inputs(t)
    out = G.attach_flags(p, f, ["entry_id"], "material_type", F.col("dme_chkfl"), names=("cpifl", "cperf", "cmatf"))
    return out.select("decision_group", "entry_id", "trait", "material_type", "prediction", "cpifl", "chkfl")


@plan("H5 H15", _FLAGGED + f""",
adj AS (SELECT decision_group, entry_id, trait, prediction * 0.9 + 2 AS adjusted FROM p WHERE prediction < 26)
SELECT p.decision_group, p.entry_id, p.trait, coalesce(a.adjusted, p.prediction) AS prediction, {_CHKFL_SQL} AS chkfl
FROM p LEFT JOIN f ON p.entry_id = f.entry_id AND (p.material_type = f.material_type OR (p.material_type = 'female' AND f.material_type = 'pool1'))
LEFT JOIN adj a ON a.decision_group = p.decision_group AND a.entry_id = p.entry_id AND a.trait = p.trait""")
def adjusted_predictions_with_flags(t: Tables) -> DataFrame:
    p, f = _flag_inputs(t)
    adjusted = p.filter("prediction < 26").select("decision_group", "entry_id", "trait", (F.col("prediction") * 0.9 + 2).alias("adjusted"))
    out = G.attach_flags(p, f, ["entry_id"], "material_type", F.col("dme_chkfl"), names=("cpifl", "cperf", "cmatf"))
    out = lookup.overlay(out, adjusted, ["decision_group", "entry_id", "trait"], "prediction", "adjusted")
    return out.select("decision_group", "entry_id", "trait", "prediction", "chkfl")


_GENOMIC = """WITH e AS (SELECT p_brand AS grp, CAST(p_partkey AS VARCHAR) AS be_bid, p_type AS par1, CASE WHEN p_size > 10 THEN 'S' || p_size END AS par2, 'entry' AS material_type,
    p_retailprice AS prediction, 5.0 AS stderr FROM part),
a AS (SELECT * FROM e UNION ALL SELECT grp, par1, NULL, NULL, 'female', avg(prediction), 2.0 + min(p_len) / 10.0 FROM (SELECT *, length(par1) AS p_len FROM e) GROUP BY grp, par1
  UNION ALL SELECT grp, par2, NULL, NULL, 'male', avg(prediction), 3.0 FROM e WHERE par2 IS NOT NULL AND prediction > 950 GROUP BY grp, par2),
w AS (SELECT *, count(prediction) OVER g AS n, stddev_samp(prediction) OVER g AS sd FROM a WINDOW g AS (PARTITION BY grp, material_type))
SELECT x.grp, x.be_bid, x.material_type, CAST(CASE WHEN x.material_type = 'entry' AND f.n IS NOT NULL AND m.n IS NOT NULL THEN f.n + m.n WHEN x.material_type = 'entry' AND f.n IS NOT NULL THEN f.n
    WHEN x.material_type = 'entry' AND m.n IS NOT NULL THEN m.n ELSE x.n END AS INTEGER) AS count,
  CASE WHEN x.material_type <> 'entry' THEN x.sd / x.stderr / sqrt(x.n) WHEN f.n IS NOT NULL AND m.n IS NOT NULL THEN f.sd / f.stderr / sqrt(f.n) + m.sd / m.stderr / sqrt(m.n)
    WHEN f.n IS NOT NULL THEN f.sd / f.stderr / sqrt(f.n) * 2 WHEN m.n IS NOT NULL THEN m.sd / m.stderr / sqrt(m.n) * 2 ELSE x.stderr END AS stderr,
  CASE WHEN x.material_type <> 'entry' THEN x.sd / x.stderr WHEN f.n IS NOT NULL AND m.n IS NOT NULL THEN f.sd / f.stderr + m.sd / m.stderr
    WHEN f.n IS NOT NULL THEN f.sd / f.stderr * 2 WHEN m.n IS NOT NULL THEN m.sd / m.stderr * 2 ELSE x.stderr * sqrt(x.n) END AS stddev
FROM w x LEFT JOIN w f ON f.material_type = 'female' AND f.grp = x.grp AND f.be_bid = x.par1 LEFT JOIN w m ON m.material_type = 'male' AND m.grp = x.grp AND m.be_bid = x.par2"""


@plan("H6", _GENOMIC)
def parent_derived_moments(t: Tables) -> DataFrame:
    e = t.part.select(
        F.col("p_brand").alias("grp"), F.col("p_partkey").cast("string").alias("be_bid"), F.col("p_type").alias("par1"),
        F.when(F.col("p_size") > 10, F.concat(F.lit("S"), "p_size")).alias("par2"), F.lit("entry").alias("material_type"),
        F.col("p_retailprice").alias("prediction"), F.lit(5.0).alias("stderr"),
    )
    empty = F.lit(None).cast("string")
    female = e.groupBy("grp", F.col("par1").alias("be_bid")).agg(
        F.avg("prediction").alias("prediction"), (2.0 + F.min(F.length("par1")) / 10.0).alias("stderr")
    ).withColumns({"par1": empty, "par2": empty, "material_type": F.lit("female")})
    male = e.filter("par2 IS NOT NULL AND prediction > 950").groupBy("grp", F.col("par2").alias("be_bid")).agg(
        F.avg("prediction").alias("prediction"), F.lit(3.0).alias("stderr")
    ).withColumns({"par1": empty, "par2": empty, "material_type": F.lit("male")})
    rows = e.unionByName(female).unionByName(male)
    out = G.parent_moments(rows, ["grp"], ["grp", "material_type"], "be_bid", ("par1", "par2"), "material_type")
    return out.select("grp", "be_bid", "material_type", "count", "stderr", "stddev")


@plan("H7 S1", """
SELECT 'entry' AS material_type, CAST(l_suppkey AS VARCHAR) AS entry_id, l_suppkey % 10 = 0 AS cpifl, count(*) AS n, sum(l_quantity) AS total FROM lineitem GROUP BY ALL
UNION ALL SELECT 'female', p_brand, l_partkey % 10 = 0, count(*), sum(l_quantity) FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL
UNION ALL SELECT 'male', p_type, l_linenumber = 1, count(*), sum(l_quantity) FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_type <> 'SMALL' GROUP BY ALL""")
def trial_rows_by_role(t: Tables) -> DataFrame:
    x = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_quantity", "l_suppkey", "p_brand", F.when(F.col("p_type") != "SMALL", F.col("p_type")).alias("p_type"),
        (F.col("l_suppkey") % 10 == 0).alias("c1"), (F.col("l_partkey") % 10 == 0).alias("c2"), (F.col("l_linenumber") == 1).alias("c3"),
    )
    rows = G.rows_by_role(
        x, {"entry": ("l_suppkey", None), "female": ("p_brand", None), "male": ("p_type", None)}, flag_cols={"cpifl": ["c1", "c2", "c3"]}
    )
    return rows.groupBy("material_type", "entry_id", "cpifl").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("total"))


_TRIAL_CFG = """cfg(trait, metric, grp, lo, hi, threshold, spread, weight) AS (VALUES ('A', 'yield', 1, 0.0::DOUBLE, 25.0::DOUBLE, 1.1::DOUBLE, NULL::DOUBLE, 0.7::DOUBLE),
  ('R', 'risk', 2, 10.0, 51.0, NULL, 2.0, NULL), ('performance', 'advancement', 1, 0.0, 51.0, NULL, NULL, 0.9), ('A', 'yield', 3, 25.0, 40.0, 0.8, 1.5, 0.1))"""


@plan("H8 PF4", f"""WITH {_TRIAL_CFG}
SELECT l_orderkey, l_linenumber, coalesce(a.threshold, CASE WHEN l_linestatus = 'O' THEN 4.0 ELSE 1.0 END) AS threshold, coalesce(a.spread, CASE WHEN l_linestatus = 'O' THEN 0.0 ELSE 1.0 END) AS spread,
  coalesce(a.weight, CASE WHEN l_returnflag = 'A' THEN 1.0 ELSE 0.0 END) AS weight, coalesce(b.weight, CASE WHEN l_returnflag = 'A' THEN 0.6 WHEN l_returnflag = 'R' THEN 0.3 ELSE 0.0 END) AS adv_weight
FROM (SELECT *, CASE l_returnflag WHEN 'A' THEN 'performance' ELSE 'risk' END AS metric_name FROM lineitem) l
LEFT JOIN cfg a ON a.metric <> 'advancement' AND a.trait = l_returnflag AND a.grp = l_linenumber AND l_quantity >= a.lo AND l_quantity < a.hi
LEFT JOIN cfg b ON b.metric = 'advancement' AND b.trait = metric_name AND b.grp = l_linenumber AND l_quantity >= b.lo AND l_quantity < b.hi""")
def trial_config(t: Tables) -> DataFrame:
    cfg = small_table(
        t.spark,
        [
            ("A", "yield", 1, 0.0, 25.0, 1.1, None, 0.7), ("R", "risk", 2, 10.0, 51.0, None, 2.0, None),
            ("performance", "advancement", 1, 0.0, 51.0, None, None, 0.9), ("A", "yield", 3, 25.0, 40.0, 0.8, 1.5, 0.1),
        ],
        "trait string, metric string, grp int, lo double, hi double, threshold double, spread double, weight double",
    )
    rows = t.lineitem.withColumn("metric_name", F.when(F.col("l_returnflag") == "A", F.lit("performance")).otherwise(F.lit("risk")))
    band = [lookup.Band("l_quantity", "lo", "hi")]
    own = lookup.ConfigLevel(F.col("metric") != "advancement", {"l_returnflag": "trait", "l_linenumber": "grp"}, band)
    rating = F.col("l_linestatus") == "O"
    out = lookup.layered_lookup(
        rows, cfg, [own],
        {"threshold": F.when(rating, F.lit(4.0)).otherwise(F.lit(1.0)), "spread": F.when(rating, F.lit(0.0)).otherwise(F.lit(1.0)),
         "weight": F.when(F.col("l_returnflag") == "A", F.lit(1.0)).otherwise(F.lit(0.0))},
    )
    adv = lookup.ConfigLevel(F.col("metric") == "advancement", {"metric_name": "trait", "l_linenumber": "grp"}, band)
    default = F.when(F.col("l_returnflag") == "A", F.lit(0.6)).when(F.col("l_returnflag") == "R", F.lit(0.3)).otherwise(F.lit(0.0))
    out = lookup.layered_lookup(out, cfg.withColumnRenamed("weight", "adv_weight"), [adv], {"adv_weight": default})
    return out.select("l_orderkey", "l_linenumber", "threshold", "spread", "weight", "adv_weight")


@plan("H9", with_clauses(TRIAL) + """
SELECT decision_group, entry_id, count(value) AS count, avg(value) AS prediction, stddev_samp(value) AS stddev, bool_or(cpifl) AS cpifl, bool_or(cperf) AS chkfl,
  round(avg(price / 1000), 4) AS threshold_factor FROM trial WHERE trait = 'R' GROUP BY ALL""")
def rating_aggregates(t: Tables) -> DataFrame:
    x = trial(t).filter("trait = 'R'").withColumns({"chkfl": F.col("cperf"), "threshold_factor": F.col("price") / 1000})
    return G.rating_aggregates(x, ["decision_group", "entry_id"], "value", settings=["threshold_factor"])


@plan("H14", with_clauses(TRIAL) + """,
m AS (SELECT *, coalesce(avg(value) FILTER (cpifl) OVER w, avg(value) OVER w) AS base FROM trial WINDOW w AS (PARTITION BY decision_group, trial_id, trait))
SELECT decision_group, trial_id, trait, entry_id, value, value - base AS result_diff, value / base AS result_perc FROM m""")
def deviation_features(t: Tables) -> DataFrame:
    out = G.trial_deviations(trial(t), ["decision_group", "trial_id", "trait"], "value", "cpifl")
    return out.select("decision_group", "trial_id", "trait", "entry_id", "value", "result_diff", "result_perc")


@plan("H18", """
WITH raw AS (SELECT p_type AS trait, p_brand, CASE p_size % 4 WHEN 0 THEN ' Norm' WHEN 1 THEN 'rating' WHEN 2 THEN 'ZINB' ELSE 'text' END AS d,
  CASE p_size % 3 WHEN 0 THEN 'Positive ' WHEN 1 THEN 'negative' ELSE 'unknown' END AS direction, CASE p_size % 5 WHEN 0 THEN 'Yield' WHEN 1 THEN 'agronomic' WHEN 2 THEN 'h2h' ELSE 'disease' END AS m FROM part),
c AS (SELECT trait, p_brand, trim(lower(d)) AS d, trim(lower(direction)) AS direction, trim(lower(m)) AS m FROM raw),
k AS (SELECT DISTINCT * FROM c WHERE d IN ('normal', 'norm', 'rating', 'zinb') AND direction IN ('positive', 'negative')),
o AS (SELECT *, row_number() OVER (PARTITION BY p_brand, trait ORDER BY d, direction, m) AS rn FROM k)
SELECT p_brand, trait, CASE WHEN d = 'norm' THEN 'normal' WHEN d = 'rating' AND m = 'h2h' THEN 'normal' ELSE d END AS distribution_type, direction,
  CASE WHEN m IN ('agronomic', 'disease') THEN 'risk' WHEN m = 'yield' THEN 'performance' ELSE m END AS metric_name FROM o WHERE rn = 1""")
def trait_settings(t: Tables) -> DataFrame:
    def words(modulus: int, *choices: str):
        out = F.lit(choices[-1])
        for i, c in enumerate(choices[:-1]):
            out = F.when(F.col("p_size") % modulus == i, F.lit(c)).otherwise(out)
        return out

    raw = t.part.select(
        F.col("p_type").alias("trait"), "p_brand", words(4, " Norm", "rating", "ZINB", "text").alias("distribution_type"),
        words(3, "Positive ", "negative", "unknown").alias("direction"), words(5, "Yield", "agronomic", "h2h", "disease").alias("metric_name"),
    ).distinct()
    # the metric word breaks the remaining ties
    first = raw.groupBy("p_brand", "trait", "distribution_type", "direction").agg(F.min(F.trim(F.lower("metric_name"))).alias("metric_name"))
    return G.trait_settings(first, ["p_brand"]).select("p_brand", "trait", "distribution_type", "direction", "metric_name")


@plan("H20", r"""
SELECT DISTINCT n_regionkey, 'name' AS breakout_level, lower(regexp_replace(replace(trim(trim(' ' || n_name || '-x: y.'), '.'), '-', '_'), '[ :;*+/&\\_,]+', '_', 'g')) AS breakout_level_value FROM nation""")
def breakout_feature_values(t: Tables) -> DataFrame:
    raw = F.concat(F.lit(" "), "n_name", F.lit("-x: y."))
    return t.nation.select(
        "n_regionkey", F.lit("name").alias("breakout_level"), G.clean_feature_value(raw).alias("breakout_level_value")
    ).distinct()


@plan("H22 H13", with_clauses(TRIAL) + """,
x AS (SELECT decision_group, entry_id, trait, CAST(nation_id AS VARCHAR) AS loc, CAST(cpifl AS INTEGER) AS a, CAST(cperf AND value > 10 AS INTEGER) AS b FROM trial)
SELECT decision_group, entry_id, trait, loc, count(*) AS n, CAST(sum(a) AS BIGINT) AS cpifl, CAST(sum(b) AS BIGINT) AS cperf FROM x GROUP BY ALL
UNION ALL SELECT decision_group, entry_id, trait, 'all', count(*), CAST(sum(a) AS BIGINT), CAST(sum(b) AS BIGINT) FROM x GROUP BY ALL""")
def trial_checks_from_plots(t: Tables) -> DataFrame:
    from trialspark.operators.aggregates import totals_row

    x = trial(t).select(
        "decision_group", "entry_id", "trait", F.lit("loc").alias("level"), F.col("nation_id").cast("string").alias("loc"),
        F.col("cpifl").cast("int").alias("a"), (F.col("cperf") & (F.col("value") > 10)).cast("int").alias("b"),
    )
    fine = x.groupBy("decision_group", "entry_id", "trait", "level", "loc").agg(
        F.count(F.lit(1)).alias("n"), F.sum("a").alias("cpifl"), F.sum("b").alias("cperf")
    )
    both = totals_row(fine, "level", "loc").drop("level")
    return both.groupBy("decision_group", "entry_id", "trait", "loc").agg(*[F.sum(c).alias(c) for c in ("n", "cpifl", "cperf")])


@plan("H23", with_clauses(TRIAL) + """
SELECT DISTINCT decision_group, entry_id, trait FROM trial WHERE (decision_group, trait) IN (SELECT decision_group, trait FROM trial WHERE value > 49 AND cpifl AND breakout = '1-URGENT' AND season_year = 1999)""")
def traits_present(t: Tables) -> DataFrame:
    rows = trial(t)
    present = rows.filter("value > 49 AND cpifl AND breakout = '1-URGENT' AND season_year = 1999").select("decision_group", "trait")
    return rows.select("decision_group", "entry_id", "trait").distinct().join(present, ["decision_group", "trait"], "left_semi")


@plan("H25", """
WITH r AS (SELECT l_suppkey, l_partkey, l_linenumber = 1 AS multiyear, CASE WHEN l_linestatus = 'O' THEN 'all' ELSE lower(l_linestatus) END AS loc, l_returnflag AS trait, l_quantity FROM lineitem),
c(trait, role) AS (VALUES ('A', 'performance'), ('R', 'risk'))
SELECT l_suppkey, l_partkey, r.trait, role, max(l_quantity) AS prediction FROM r JOIN c USING (trait) WHERE (multiyear AND loc <> 'all') OR (NOT multiyear AND loc = 'all') GROUP BY ALL""")
def prediction_extract(t: Tables) -> DataFrame:
    r = t.lineitem.select(
        "l_suppkey", "l_partkey", (F.col("l_linenumber") == 1).alias("multiyear"),
        F.when(F.col("l_linestatus") == "O", F.lit("all")).otherwise(F.lower("l_linestatus")).alias("loc"), F.col("l_returnflag").alias("trait"), "l_quantity",
    )
    roles = small_table(t.spark, [("A", "performance"), ("R", "risk")], "trait string, role string")
    level = (F.col("multiyear") & (F.col("loc") != "all")) | (~F.col("multiyear") & (F.col("loc") == "all"))
    return r.filter(level).join(roles, "trait").groupBy("l_suppkey", "l_partkey", "trait", "role").agg(F.max("l_quantity").alias("prediction"))
