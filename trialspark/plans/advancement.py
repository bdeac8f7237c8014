"""Stage history, labels and evaluation on the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialspark.functions import text as X
from trialspark.operators import evaluation as E
from trialspark.operators import extract
from trialspark.operators import history as H
from trialspark.operators import keyed
from trialspark.operators import reshape as R
from trialspark.plans.registry import Tables, plan
from trialspark.plans.views import beta_sql

_STAGES_SQL = """stages AS (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS yr, CAST(least(7, count(*)) AS DOUBLE) AS stage FROM orders WHERE o_orderstatus <> 'P' GROUP BY ALL)"""


def _stages(t: Tables) -> DataFrame:
    return t.orders.filter("o_orderstatus <> 'P'").groupBy("o_custkey", F.year("o_orderdate").alias("yr")).agg(
        F.least(F.lit(7), F.count(F.lit(1))).cast("double").alias("stage")
    )


_REPAIRED_SQL = f"""WITH RECURSIVE {_STAGES_SQL},
span AS (SELECT min(yr) AS a, max(yr) AS z FROM stages),
cal AS (SELECT o_custkey, CAST(y AS INTEGER) AS yr, s.stage, EXISTS (SELECT 1 FROM stages n, span WHERE n.o_custkey = c.o_custkey AND n.yr > y AND n.yr <= least(y + 4, z)) AS returns
  FROM (SELECT DISTINCT o_custkey FROM stages) c, span, range(a, z + 1) r(y) LEFT JOIN stages s USING (o_custkey, yr)),
cal2 AS (SELECT * FROM cal),
f AS (SELECT cal2.o_custkey, cal2.yr, cal2.stage FROM cal2, span WHERE yr = a
  UNION ALL SELECT n.o_custkey, n.yr, CASE WHEN n.stage IS NOT NULL THEN n.stage WHEN f.stage IS NULL THEN NULL WHEN n.returns THEN f.stage ELSE 13 END FROM f JOIN cal2 n ON n.o_custkey = f.o_custkey AND n.yr = f.yr + 1),
repaired AS (SELECT * FROM f WHERE stage IS NOT NULL)"""
_REPAIRED_SQL = _REPAIRED_SQL.replace("range(a, z + 1) r(y) LEFT JOIN stages s USING (o_custkey, yr)", "range(a, z + 1) r(y) LEFT JOIN stages s ON s.o_custkey = c.o_custkey AND s.yr = y").replace("SELECT o_custkey, CAST(y AS INTEGER)", "SELECT c.o_custkey, CAST(y AS INTEGER)")


def _repaired(t: Tables) -> DataFrame:
    return H.repaired_stages(_stages(t), ["o_custkey"], "yr", "stage")


@plan("V2", _REPAIRED_SQL + " SELECT o_custkey, yr, stage FROM repaired")
def repaired_stage_history(t: Tables) -> DataFrame:
    return _repaired(t)


@plan("V2", _REPAIRED_SQL + " SELECT o_custkey, " + ", ".join(f"max(CAST(stage = {s} AS INTEGER)) AS stage_{s}" for s in range(1, 7)) + ", max(CAST(stage = 7 AS INTEGER)) AS stage_chk FROM repaired GROUP BY 1")
def stages_ever_reached(t: Tables) -> DataFrame:
    return H.stages_reached(_repaired(t), ["o_custkey"], "stage")


_AROUND_SQL = _REPAIRED_SQL + """,
around AS (SELECT o_custkey, max(stage) FILTER (yr = 1997) AS prev_stage, max(stage) FILTER (yr = 1998) AS current_stage, max(stage) FILTER (yr = 1999) AS next_stage, max(stage) FILTER (yr = 2000) AS third_stage
  FROM repaired WHERE yr BETWEEN 1997 AND 2000 GROUP BY 1 HAVING max(stage) FILTER (yr = 1998) < 13)"""


@plan("V3", _AROUND_SQL + " SELECT * FROM around")
def stages_around_year(t: Tables) -> DataFrame:
    return H.stages_around(_repaired(t), ["o_custkey"], "yr", "stage", 1998)


@plan("V4", _AROUND_SQL + """ SELECT o_custkey, current_stage < next_stage AND current_stage < 7 AND next_stage <= 7 AS was_adv,
  (current_stage < next_stage AND current_stage < 7 AND next_stage <= 7) AND (next_stage < third_stage AND next_stage < 7 AND third_stage <= 7) AS was_adv_next FROM around""")
def advancement_labels(t: Tables) -> DataFrame:
    around = H.stages_around(_repaired(t), ["o_custkey"], "yr", "stage", 1998)
    return H.advancement_labels(around).select("o_custkey", "was_adv", "was_adv_next")


@plan("V3", """
WITH s AS (SELECT o_custkey, CASE month(o_orderdate) % 5 WHEN 0 THEN 'WNTR' WHEN 1 THEN 'SPR' WHEN 2 THEN 'SUMR' WHEN 3 THEN 'DRY' ELSE 'FALL' END AS season FROM orders)
SELECT o_custkey, max_by(season, list_position(['WNTR', 'DRY', 'SPR', 'SUMR', 'WET', 'FALL', 'AUTM'], season)) AS last_season FROM s GROUP BY 1""")
def latest_season(t: Tables) -> DataFrame:
    k = F.month("o_orderdate") % 5
    word = F.when(k == 0, F.lit("WNTR")).when(k == 1, F.lit("SPR")).when(k == 2, F.lit("SUMR")).when(k == 3, F.lit("DRY")).otherwise(F.lit("FALL"))
    return H.latest_season(t.orders.select("o_custkey", word.alias("season")), ["o_custkey"], "season")


@plan("V5", """
WITH x AS (SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN p_brand ELSE p_brand || '-' || (p_size % 7) || '-' || p_size || '-x' END AS id FROM part)
SELECT p_partkey, CASE WHEN len(string_split(id, '-')) > 2 THEN CAST(string_split(id, '-')[2] AS INTEGER) END AS stage,
  CASE WHEN len(string_split(id, '-')) > 2 THEN CASE WHEN CAST(string_split(id, '-')[3] AS INTEGER) <= 10 THEN CAST(string_split(id, '-')[3] AS INTEGER) * 5 + 80 ELSE CAST(string_split(id, '-')[3] AS INTEGER) END END AS rm FROM x""")
def group_id_parts(t: Tables) -> DataFrame:
    long = F.concat_ws("-", "p_brand", (F.col("p_size") % 7).cast("string"), F.col("p_size").cast("string"), F.lit("x"))
    x = t.part.select("p_partkey", F.when(F.col("p_size") % 4 == 0, F.col("p_brand")).otherwise(long).alias("id"))
    return x.select("p_partkey", X.group_stage(F.col("id")).alias("stage"), X.group_maturity(F.col("id")).alias("rm"))


@plan("V6", """
WITH g AS (SELECT p_brand, avg(p_size) AS rm FROM part GROUP BY 1)
SELECT p_partkey FROM part JOIN g USING (p_brand) WHERE p_size IS NULL OR p_size < 10 OR abs(p_size - rm) <= 15""")
def maturity_near_group(t: Tables) -> DataFrame:
    x = keyed.with_group_values(t.part, ["p_brand"], rm=F.avg("p_size"))
    return x.filter(H.around_maturity(F.col("p_size"), F.col("rm"))).select("p_partkey")


@plan("V7", """
WITH a AS (SELECT l_partkey AS id, avg(l_quantity) AS v FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1), b AS (SELECT p_partkey AS id, CAST(p_size AS DOUBLE) AS v FROM part WHERE p_size > 20),
c AS (SELECT l_partkey AS id, max(l_quantity) AS v FROM lineitem WHERE l_quantity < 45 GROUP BY 1)
SELECT id, avg(v) AS value, count(*) AS n_sources FROM (SELECT * FROM a UNION ALL SELECT * FROM b UNION ALL SELECT * FROM c) GROUP BY id""")
def maturity_from_several_sources(t: Tables) -> DataFrame:
    a = t.lineitem.filter("l_returnflag = 'A'").select(F.col("l_partkey").alias("id"), "l_quantity")
    b = t.part.filter("p_size > 20").select(F.col("p_partkey").alias("id"), "p_size")
    c = t.lineitem.filter("l_quantity < 45").groupBy(F.col("l_partkey").alias("id")).agg(F.max("l_quantity").alias("top"))
    return H.averaged_sources({"plot": (a, "l_quantity"), "part": (b, "p_size"), "best": (c, "top")}, ["id"])


# scored entries: documents with labels, scored by length; order status and totals for the larger case
_SCORED_SQL = """scored AS (SELECT o_orderkey, o_orderpriority AS grp, CAST(year(o_orderdate) AS INTEGER) AS yr, o_totalprice AS score, o_orderstatus = 'F' AS was_adv,
  o_orderstatus = 'F' AND o_custkey % 3 = 0 AS was_adv_next FROM orders)"""


def _scored(t: Tables) -> DataFrame:
    done = F.col("o_orderstatus") == "F"
    return t.orders.select(
        "o_orderkey", F.col("o_orderpriority").alias("grp"), F.year("o_orderdate").alias("yr"), F.col("o_totalprice").alias("score"), done.alias("was_adv"),
        (done & (F.col("o_custkey") % 3 == 0)).alias("was_adv_next"),
    )


_PR_SQL = """
c AS (SELECT {k} score, sum(CAST({y} AS INTEGER)) AS pos, count(*) AS n FROM scored GROUP BY ALL),
w AS (SELECT *, sum(pos) OVER x AS cp, sum(n) OVER x AS cn, sum(pos) OVER ({p}) AS ap FROM c WINDOW x AS ({p} ORDER BY score {d} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT {k} sum(pos / ap * (cp / cn + CASE WHEN cn = n THEN 1.0 ELSE (cp - pos) / nullif(cn - n, 0) END) / 2) AS v FROM w GROUP BY ALL"""


@plan("V8", f"""WITH {_SCORED_SQL},
a AS (WITH {_PR_SQL.format(k='grp,', y='was_adv', d='DESC', p='PARTITION BY grp')}), b AS (WITH {_PR_SQL.format(k='grp,', y='NOT was_adv', d='ASC', p='PARTITION BY grp')})
SELECT a.grp, round(a.v, 9) AS auc_pr_adv, round(b.v, 9) AS auc_pr_notadv FROM a JOIN b USING (grp)""")
def precision_recall_area(t: Tables) -> DataFrame:
    out = E.area_under_precision_recall(_scored(t), ["grp"], "score", "was_adv")
    return out.withColumns({c: F.round(c, 9) for c in ("auc_pr_adv", "auc_pr_notadv")})


# expected counts at the cut: rows tied on it share it
_CUT_SQL = f"""WITH {_SCORED_SQL},
c AS (SELECT grp, score, sum(CAST(was_adv AS INTEGER)) AS pos, count(*) AS n FROM scored GROUP BY ALL),
w AS (SELECT *, sum(n) OVER (PARTITION BY grp ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cn, sum(pos) OVER (PARTITION BY grp) AS ap, sum(n) OVER (PARTITION BY grp) AS an FROM c),
k AS (SELECT *, greatest(0, least(n, ap - (cn - n))) AS taken FROM w),
m AS (SELECT grp, CAST(sum(taken * pos / n) AS DOUBLE) AS TP, CAST(sum(taken * (n - pos) / n) AS DOUBLE) AS FP, CAST(max(ap) AS DOUBLE) AS p, CAST(max(an) AS BIGINT) AS n FROM k GROUP BY grp)"""


@plan("V10 T6", _CUT_SQL + " SELECT grp, TP, FP, p - TP AS FN, n - p - FP AS TN, n FROM m")
def confusion_at_cut(t: Tables) -> DataFrame:
    return E.cut_confusion(_scored(t), ["grp"], "score", "was_adv")


@plan("V9", _CUT_SQL + " SELECT grp, round((TP / p + (n - p - FP) / (n - p)) / 2, 10) AS balanced_acc FROM m")
def balanced_accuracy_at_cut(t: Tables) -> DataFrame:
    return E.balanced_accuracy(_scored(t), ["grp"], "score", "was_adv").withColumn("balanced_acc", F.round("balanced_acc", 10))


@plan("V10", f"""WITH {_SCORED_SQL},
c AS (SELECT grp, score, sum(CAST(was_adv AS INTEGER)) AS pos, count(*) AS n FROM scored GROUP BY ALL),
w AS (SELECT *, sum(n) OVER (PARTITION BY grp ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cn, sum(pos) OVER (PARTITION BY grp) AS ap, sum(n) OVER (PARTITION BY grp) AS an FROM c),
s AS (SELECT grp, sum(greatest(0, cn - greatest(cn - n, ceil(round(an * 0.1, 9)))) * pos / n) / max(ap) AS b90, sum(greatest(0, cn - greatest(cn - n, ceil(round(an * 0.75, 9)))) * pos / n) / max(ap) AS b25 FROM w GROUP BY grp),
q AS (SELECT grp, quantile_cont(score, 0.9) AS r90, quantile_cont(score, 0.25) AS r25 FROM scored GROUP BY grp)
SELECT grp, round(b90, 9) AS perc_adv_in_bottom_90perc, round(b25, 9) AS perc_adv_in_bottom_25perc, round(r90, 6) AS raw_thresh_90perc, round(r25, 6) AS raw_thresh_25perc FROM s JOIN q USING (grp)""")
def advanced_in_bottom(t: Tables) -> DataFrame:
    out = E.bottom_shares(_scored(t), ["grp"], "score", "was_adv", (90, 25))
    return out.withColumns(
        {c: F.round(c, 9) for c in ("perc_adv_in_bottom_90perc", "perc_adv_in_bottom_25perc")} | {c: F.round(c, 6) for c in ("raw_thresh_90perc", "raw_thresh_25perc")}
    )


@plan("V11", f"""WITH {_SCORED_SQL},
a AS (SELECT * FROM scored WHERE was_adv),
q AS (SELECT grp, quantile_cont(score, 0.0) AS c0, quantile_cont(score, 0.2) AS c20, quantile_cont(score, 0.4) AS c40, quantile_cont(score, 0.6) AS c60, quantile_cont(score, 0.8) AS c80, quantile_cont(score, 1.0) AS c100 FROM a GROUP BY grp),
s AS (SELECT grp, quantile_cont(score, 0.85) AS split FROM scored GROUP BY grp),
j AS (SELECT * FROM a JOIN q USING (grp) JOIN s USING (grp))
SELECT grp, {", ".join(f"round(avg(CAST(was_adv_next AS INTEGER)) FILTER (score > c{a} AND score <= c{a + 20}), 9) AS " + f'"future_adv_rate_{a}P-{a + 20}P", count(*) FILTER (score > c{a} AND score <= c{a + 20}) AS "n_{a}P-{a + 20}P"' for a in range(0, 100, 20))},
  round(avg(CAST(was_adv_next AS INTEGER)) FILTER (score > split), 9) AS future_adv_rate_high, count(*) FILTER (score > split) AS n_high, round(avg(CAST(was_adv_next AS INTEGER)) FILTER (score <= split), 9) AS future_adv_rate_low, count(*) FILTER (score <= split) AS n_low,
  {", ".join(f'round(max(c{a}), 6) AS "raw_thresh_{a}P"' for a in range(0, 101, 20))}, round(max(split), 6) AS raw_thresh_high_low_85P FROM j GROUP BY grp""")
def later_advancement_by_score(t: Tables) -> DataFrame:
    out = E.future_rates(_scored(t), ["grp"], "score", "was_adv", "was_adv_next")
    digits = {c: (9 if "rate" in c else 6) for c in out.columns if "rate" in c or "thresh" in c}
    return out.withColumns({c: F.round(f"`{c}`", d) for c, d in digits.items()})


_HALF = beta_sql("(dof / (dof + t_stat * t_stat))", "(dof / 2.0)", "0.5", 20000)


@plan("V11 ST15", f"""WITH {_SCORED_SQL},
s AS (SELECT grp, count(*) FILTER (was_adv_next) AS n_a, avg(score) FILTER (was_adv_next) AS mean_a, var_samp(score) FILTER (was_adv_next) AS var_a, count(*) FILTER (NOT was_adv_next) AS n_b,
  avg(score) FILTER (NOT was_adv_next) AS mean_b, var_samp(score) FILTER (NOT was_adv_next) AS var_b FROM scored WHERE was_adv GROUP BY grp),
x AS (SELECT *, (mean_a - mean_b) / sqrt(var_a / n_a + var_b / n_b) AS t_stat, power(var_a / n_a + var_b / n_b, 2) / (power(var_a / n_a, 2) / (n_a - 1) + power(var_b / n_b, 2) / (n_b - 1)) AS dof FROM s)
SELECT grp, n_a, n_b, mean_a, mean_b, var_a, var_b, t_stat, dof, round(CASE WHEN t_stat > 0 THEN {_HALF} / 2 ELSE 1 - {_HALF} / 2 END, 6) AS p_value FROM x""")
def later_advancement_test(t: Tables) -> DataFrame:
    return E.future_separation(_scored(t), ["grp"], "score", "was_adv", "was_adv_next").withColumn("p_value", F.round("p_value", 6))


_PR_PIECES = ",\n".join(
    f"{name} AS (WITH {_PR_SQL.format(k=k, y=y, d=d, p=p)})"
    for name, k, y, d, p in (
        ("pr_adv", "grp,", "was_adv", "DESC", "PARTITION BY grp"), ("pr_not", "grp,", "NOT was_adv", "ASC", "PARTITION BY grp"),
        ("pr_adv_all", "", "was_adv", "DESC", ""), ("pr_not_all", "", "NOT was_adv", "ASC", ""),
    )
) + """,
pr AS (SELECT grp, 'auc_pr_adv' AS metric, round(v, 9) AS value FROM pr_adv UNION ALL SELECT grp, 'auc_pr_notadv', round(v, 9) FROM pr_not
  UNION ALL SELECT 'all', 'auc_pr_adv', round(v, 9) FROM pr_adv_all UNION ALL SELECT 'all', 'auc_pr_notadv', round(v, 9) FROM pr_not_all)"""


@plan("V12", f"""WITH {_SCORED_SQL},
c AS (SELECT grp, score, sum(CAST(was_adv AS INTEGER)) AS pos, count(*) AS n FROM scored GROUP BY ALL UNION ALL SELECT 'all', score, sum(CAST(was_adv AS INTEGER)), count(*) FROM scored GROUP BY score),
w AS (SELECT *, sum(n) OVER (PARTITION BY grp ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cn, sum(pos) OVER (PARTITION BY grp) AS ap, sum(n) OVER (PARTITION BY grp) AS an FROM c),
k AS (SELECT *, greatest(0, least(n, ap - (cn - n))) AS taken FROM w),
m AS (SELECT grp, sum(taken * pos / n) AS TP, sum(taken * (n - pos) / n) AS FP, max(ap) AS p, max(an) AS n FROM k GROUP BY grp),
u AS (SELECT grp, 'TP' AS metric, CAST(TP AS DOUBLE) AS value FROM m UNION ALL SELECT grp, 'FP', FP FROM m UNION ALL SELECT grp, 'FN', p - TP FROM m UNION ALL SELECT grp, 'TN', n - p - FP FROM m UNION ALL SELECT grp, 'n', n FROM m
  UNION ALL SELECT grp, 'balanced_acc', round((TP / p + (n - p - FP) / (n - p)) / 2, 9) FROM m),
{_PR_PIECES}
SELECT 'total' AS mdl, grp AS decision_group, metric, value FROM (FROM u UNION ALL FROM pr)""")
def metrics_per_group(t: Tables) -> DataFrame:
    out = E.metrics_per_group(_scored(t), "grp", {"total": "score"}, "was_adv")
    rounded = F.col("metric").isin("balanced_acc", "auc_pr_adv", "auc_pr_notadv")
    return out.withColumn("value", F.when(rounded, F.round("value", 9)).otherwise(F.col("value")))


@plan("V13")
def metrics_of_random_scores(t: Tables) -> DataFrame:
    return E.shuffled_label_metrics(_scored(t), ["grp"], ["o_orderkey"], "was_adv", repeats=5)


@plan("V14", f"""WITH {_SCORED_SQL},
x AS (SELECT *, score >= 250000 AS hat, rank() OVER (PARTITION BY grp ORDER BY score) + (count(*) OVER (PARTITION BY grp, score) - 1) / 2.0 AS rk FROM scored),
s AS (SELECT grp, count(*) FILTER (was_adv AND hat) AS tp, count(*) FILTER (NOT was_adv AND hat) AS fp, count(*) FILTER (was_adv AND NOT hat) AS fn, count(*) FILTER (NOT was_adv AND NOT hat) AS tn, sum(rk) FILTER (was_adv) AS rs FROM x GROUP BY grp)
SELECT grp, 2 * tp / (2 * tp + fp + fn) AS f1, (tp + tn) / (tp + fp + fn + tn) AS accuracy, tn / (tn + fp) AS tn_rate, fp / (tn + fp) AS fp_rate, fn / (fn + tp) AS fn_rate, tp / (fn + tp) AS tp_rate,
  CAST((rs - (tp + fn) * (tp + fn + 1) / 2) / ((tp + fn) * (fp + tn)) AS DOUBLE) AS roc_auc FROM s""")
def classifier_metrics(t: Tables) -> DataFrame:
    return E.classifier_metrics(_scored(t), ["grp"], "score", "was_adv", 250000.0)


@plan("V14", """
WITH x AS (SELECT lang, n_chars, quality = 1 AS y FROM documents JOIN labels USING (doc_id)),
r AS (SELECT *, rank() OVER (PARTITION BY lang ORDER BY n_chars) + (count(*) OVER (PARTITION BY lang, n_chars) - 1) / 2.0 AS rk FROM x),
s AS (SELECT lang, count(*) FILTER (y) AS p, count(*) FILTER (NOT y) AS q, sum(rk) FILTER (y) AS rs FROM r GROUP BY lang)
SELECT lang, CAST((rs - p * (p + 1) / 2) / nullif(p * q, 0) AS DOUBLE) AS roc_auc FROM s""")
def roc_area_of_lengths(t: Tables) -> DataFrame:
    x = t.documents.join(t.labels, "doc_id").select("lang", F.col("n_chars").alias("score"), (F.col("quality") == 1).alias("y"))
    return E.roc_area(x, ["lang"], "score", "y")


@plan("V15", """
SELECT l_orderkey, l_linenumber, 2.0 * greatest(0, l_quantity - 40) + CASE WHEN l_linenumber < 6 THEN 30.0 * greatest(0, l_discount - 0.05) ELSE 0 END AS penalty FROM lineitem""")
def excess_penalty(t: Tables) -> DataFrame:
    x = t.lineitem.withColumn("d", F.when(F.col("l_linenumber") < 6, F.col("l_discount")))
    return x.select("l_orderkey", "l_linenumber", E.penalty({"l_quantity": (40.0, 2.0), "d": (0.05, 30.0)}).alias("penalty"))


@plan("V17", """
SELECT user_id, event_type, avg(value) AS value, arg_min(props, event_id) FILTER (value > 10) AS alpha_value FROM events GROUP BY ALL""")
def numeric_and_text_traits(t: Tables) -> DataFrame:
    x = t.events.withColumn("alpha", F.when(F.col("value") > 10, F.col("props")))
    return extract.numeric_and_text(x, ["user_id"], "event_type", "value", "alpha", "event_id")


@plan("V18", """
WITH x AS (SELECT l_suppkey, l_quantity AS v, CASE l_returnflag WHEN 'A' THEN 'high' WHEN 'R' THEN 'low' ELSE 'center' END AS d, l_tax + 0.01 AS w FROM lineitem)
SELECT l_suppkey, sum(w * CASE d WHEN 'high' THEN greatest(0, least(1, (v - 5) / 40)) WHEN 'low' THEN greatest(0, least(1, 1 - (v - 5) / 40)) ELSE greatest(0, least(1, 1 - abs(v - 20) / 25)) END) / sum(w) AS trait_score FROM x GROUP BY 1""")
def weighted_trait_score(t: Tables) -> DataFrame:
    word = F.when(F.col("l_returnflag") == "A", F.lit("high")).when(F.col("l_returnflag") == "R", F.lit("low")).otherwise(F.lit("center"))
    x = t.lineitem.select("l_suppkey", F.col("l_quantity").alias("v"), word.alias("d"), (F.col("l_tax") + 0.01).alias("w")).withColumns(
        {"lo": F.lit(5.0), "mid": F.lit(20.0), "hi": F.lit(45.0)}
    )
    return E.weighted_trait_score(x, ["l_suppkey"], "v", "lo", "mid", "hi", "d", "w")


@plan("V19", """
WITH x AS (SELECT o_orderpriority, o_totalprice > 300000 AS r, o_orderstatus = 'F' AS a FROM orders),
s AS (SELECT o_orderpriority, count(*) AS n, count(*) FILTER (r) AS n_recommended, count(*) FILTER (a) AS n_advanced, count(*) FILTER (r AND a) AS n_both FROM x GROUP BY 1)
SELECT *, (n_both / n_recommended) / (n_advanced / n) AS power, (n_recommended - n_both) / (n - n_advanced) AS false_positive_rate, (n_advanced - n_both) / n_advanced AS miss_rate FROM s""")
def recommendation_power(t: Tables) -> DataFrame:
    x = t.orders.select("o_orderpriority", (F.col("o_totalprice") > 300000).alias("r"), (F.col("o_orderstatus") == "F").alias("a"))
    return E.recommendation_power(x, ["o_orderpriority"], "r", "a")


@plan("V20 V24 R1 R2", """
WITH a AS (SELECT l_suppkey AS id, CAST(year(l_shipdate) AS INTEGER) AS yr, avg(l_quantity) FILTER (l_returnflag = 'A') AS q_A, avg(l_quantity) FILTER (l_returnflag = 'R') AS q_R FROM lineitem GROUP BY ALL),
b AS (SELECT l_suppkey AS id, CAST(year(o_orderdate) AS INTEGER) AS yr, max(o_totalprice) FILTER (o_orderstatus = 'F') AS t_F, max(o_totalprice) FILTER (o_orderstatus = 'O') AS t_O FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL),
w AS (SELECT id, yr, q_A, q_R, t_F, t_O FROM a LEFT JOIN b USING (id, yr))
SELECT w.*, p.q_A AS q_A_prev, p.t_O AS t_O_prev FROM w LEFT JOIN w p ON p.id = w.id AND p.yr = w.yr - 1""")
def all_years_feature_table(t: Tables) -> DataFrame:
    rows = t.lineitem.withColumns({"id": F.col("l_suppkey"), "yr": F.year("l_shipdate")})
    a = R.to_wide(rows, ["id", "yr"], ["l_returnflag"], {"q": F.avg("l_quantity")}, ["A", "R"])
    o = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).withColumns({"id": F.col("l_suppkey"), "yr": F.year("o_orderdate")})
    b = R.to_wide(o, ["id", "yr"], ["o_orderstatus"], {"t": F.max("o_totalprice")}, ["F", "O"])
    wide = R.join_on_common([(a, "left"), (b, "left")], ["id", "yr"])
    return H.with_previous_year(wide, ["id"], "yr", ["q_A", "t_O"])


@plan("V21", f"""WITH {_SCORED_SQL},
w AS (SELECT o_orderkey, grp, yr, score, rank() OVER p AS value_rank, percent_rank() OVER p AS value_percentile, (score - avg(score) OVER (PARTITION BY grp, yr)) / greatest(stddev_pop(score) OVER (PARTITION BY grp, yr), 1e-5) AS value_z
  FROM scored WINDOW p AS (PARTITION BY grp, yr ORDER BY score))
SELECT o_orderkey, value_rank, round(value_percentile, 9) AS value_percentile, round(value_z, 7) AS value_z FROM w""")
def baseline_scores(t: Tables) -> DataFrame:
    out = E.baseline_scores(_scored(t), ["grp", "yr"], "score")
    return out.select("o_orderkey", "value_rank", F.round("value_percentile", 9).alias("value_percentile"), F.round("value_z", 7).alias("value_z"))


@plan("V21 A7", f"""WITH {_SCORED_SQL},
c AS (SELECT grp, quantile_cont(score, 0.8) AS cut FROM scored GROUP BY grp)
SELECT grp, score > cut AS is_top, count(*) AS n, avg(score) AS mean, median(score) AS mid, stddev_samp(score) AS sd FROM scored JOIN c USING (grp) GROUP BY ALL""")
def trait_statistics_of_top_scores(t: Tables) -> DataFrame:
    from trialspark.operators.aggregates import percentiles

    s = _scored(t)
    marked = keyed.null_safe_join(s, percentiles(s, ["grp"], "score", {"cut": 0.8}), ["grp"]).withColumn("is_top", F.col("score") > F.col("cut"))
    base = marked.groupBy("grp", "is_top").agg(F.count(F.lit(1)).alias("n"), F.avg("score").alias("mean"), F.stddev_samp("score").alias("sd"))
    return keyed.null_safe_join(base, percentiles(marked, ["grp", "is_top"], "score", {"mid": 0.5}), ["grp", "is_top"])


@plan("V22", """
WITH x AS (SELECT l_partkey, l_suppkey, CASE l_returnflag WHEN 'A' THEN 'MultiExp' WHEN 'R' THEN 'SingleExp' ELSE 'GenoPred' END AS kind, max(l_quantity) AS score FROM lineitem GROUP BY ALL)
SELECT l_partkey, l_suppkey, kind, score FROM x QUALIFY row_number() OVER (PARTITION BY l_partkey, l_suppkey ORDER BY list_position(['MultiExp', 'SingleExp', 'GenoPred'], kind)) = 1""")
def preferred_prior_score(t: Tables) -> DataFrame:
    word = F.when(F.col("l_returnflag") == "A", F.lit("MultiExp")).when(F.col("l_returnflag") == "R", F.lit("SingleExp")).otherwise(F.lit("GenoPred"))
    x = t.lineitem.groupBy("l_partkey", "l_suppkey", word.alias("kind")).agg(F.max("l_quantity").alias("score"))
    return H.preferred_source(x, ["l_partkey", "l_suppkey"], "kind", ["MultiExp", "SingleExp", "GenoPred"])


@plan("V23", """
SELECT role, id, yr, max(rm) AS decision_group_rm FROM (SELECT 'entry' AS role, CAST(l_partkey AS VARCHAR) AS id, CAST(year(l_shipdate) AS INTEGER) AS yr, l_quantity AS rm FROM lineitem
  UNION ALL SELECT 'parent', CAST(l_suppkey AS VARCHAR), CAST(year(l_shipdate) AS INTEGER), l_quantity FROM lineitem) GROUP BY ALL""")
def group_maturity_per_entry(t: Tables) -> DataFrame:
    x = t.lineitem.select("l_partkey", "l_suppkey", F.year("l_shipdate").alias("yr"), F.col("l_quantity").alias("rm"))
    rows = R.stack_roles(x, {"entry": "l_partkey", "parent": "l_suppkey"}, "id", keep=["yr", "rm"])
    return rows.groupBy("role", "id", "yr").agg(F.max("rm").alias("decision_group_rm"))


@plan("V25", """
WITH x AS (SELECT l_orderkey, l_suppkey, l_returnflag, l_quantity, o_orderpriority, p_brand FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey WHERE NOT l_tax > 0.06)
SELECT l_suppkey, l_returnflag, p_brand, count(*) AS n, avg(l_quantity) AS mean, min(o_orderpriority) AS first_priority FROM x GROUP BY ALL""")
def phenotype_extract(t: Tables) -> DataFrame:
    x = t.lineitem.filter("NOT l_tax > 0.06").join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return x.groupBy("l_suppkey", "l_returnflag", "p_brand").agg(
        F.count(F.lit(1)).alias("n"), F.avg("l_quantity").alias("mean"), F.min("o_orderpriority").alias("first_priority")
    )


@plan("V26", """
WITH x AS (SELECT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS yr, 'Stage ' || l_linenumber || CASE WHEN l_linestatus = 'O' THEN '.5' ELSE '' END AS txt FROM lineitem UNION ALL SELECT s_suppkey, 1999, 'none' FROM supplier),
s AS (SELECT l_suppkey, yr, try_cast(nullif(regexp_extract(txt, '([0-9]+(?:\\.[0-9]+)?)', 1), '') AS DOUBLE) AS stage FROM x)
SELECT l_suppkey, yr, max(stage) AS stage FROM s WHERE stage <= 7 GROUP BY ALL""")
def staged_entries(t: Tables) -> DataFrame:
    word = F.concat(F.lit("Stage "), F.col("l_linenumber").cast("string"), F.when(F.col("l_linestatus") == "O", F.lit(".5")).otherwise(F.lit("")))
    x = t.lineitem.select("l_suppkey", F.year("l_shipdate").alias("yr"), word.alias("txt")).union(t.supplier.select("s_suppkey", F.lit(1999), F.lit("none")))
    return extract.staged_entries(x, ["l_suppkey"], "txt", "yr")
