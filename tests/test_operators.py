"""Hand-made cases and brute-force comparisons."""

import inspect
import itertools
import time
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from trialspark.functions import scoring as S
from trialspark.operators import aggregates as A
from trialspark.operators import attribution as T
from trialspark.operators import bins as B
from trialspark.operators import boosting as Q
from trialspark.operators import components as C
from trialspark.operators import evaluation as EV
from trialspark.operators import fits as M
from trialspark.operators import flags as G
from trialspark.operators import genotype as GT
from trialspark.operators import grid as E
from trialspark.operators import headtohead as HH
from trialspark.operators import history as H
from trialspark.operators import lookup as L
from trialspark.operators import portfolio as P
from trialspark.operators import ratings as R
from trialspark.operators import rollup as U
from trialspark.plans import fits as fitted_plans
from trialspark.session import SHUFFLE_CLEANUP, cut_lineage
from trialspark.sources import tables as IO


# --- lookup ---------------------------------------------------------------------

def test_range_lookup_is_half_open_with_gaps_and_overlaps(spark):
    facts = spark.createDataFrame([("a", x) for x in (0.0, 5.0, 10.0, 15.0, 20.0)], "t string, x double")
    cfg = IO.small_table(spark, [("a", 0.0, 5.0, 1), ("a", 10.0, 16.0, 2), ("a", 15.0, 20.0, 3)], "t string, lo double, hi double, v int")
    rows = L.range_lookup(facts, cfg, {"t": "t"}, [L.Band("x", "lo", "hi")], {"v": "v"}).collect()
    got = sorted((r.x, r.v or 0) for r in rows)
    assert got == [(0.0, 1), (5.0, 0), (10.0, 2), (15.0, 2), (15.0, 3), (20.0, 0)]


def test_nearest_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    pts = pd.DataFrame({"p": np.arange(300), "lat": rng.uniform(-60, 60, 300), "lon": rng.uniform(-180, 180, 300)})
    qs = pd.DataFrame({"q": np.arange(40), "lat": rng.uniform(-60, 60, 40), "lon": rng.uniform(-180, 180, 40)})
    got = L.nearest(spark.createDataFrame(pts).repartition(5), spark.createDataFrame(qs), "p", "q", ["lat", "lon"], 4, L.great_circle, block_rows=15).toPandas()
    d = L.great_circle(qs[["lat", "lon"]].to_numpy(), pts[["lat", "lon"]].to_numpy())
    for q in range(40):
        assert got[got.q == q].sort_values("rank").p.tolist() == np.lexsort((pts.p, d[q]))[:4].tolist()


def test_screened_pairs_hold_all_nearest_rows_and_few_others():
    rng = np.random.default_rng(21)
    a, b = rng.normal(0, 1, (70, 24)), rng.normal(0, 1, (3000, 24))
    b[1000:1040] = b[7]  # ties
    a[:3] = b[[7, 8, 1001]]
    for x, y, few in ((a, b, 40), (a + 1e4, b + 1e4, 40), (a * 1e12, b * 1e12, 40), (a * 1e17, b * 1e17, 3000), (a, np.ones((3000, 24)), 3000), (a * 1e-30, b * 1e-30, 3000)):
        rows, cols = (np.concatenate(part) for part in zip(*L.close_pairs(x, y, 3)))
        d = L.euclidean(x, y)
        assert np.array_equal(L.euclidean_pairs(x, y, rows, cols), d[rows, cols])
        stays = np.zeros(d.shape, dtype=bool)
        stays[rows, cols] = True
        assert stays[d <= np.partition(d, 2, axis=1)[:, 2:3]].all() and len(rows) <= few * len(x)


def test_nearest_arrays_match_brute_force_with_ties(spark):
    rng = np.random.default_rng(22)
    x = rng.normal(0, 1, (900, 12))
    x[300:340] = x[5]
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in enumerate(x)] + [(900, None), (901, [float("nan")] * 12)], "i long, e array<double>")
    for rows in (None, 400):
        got = L.nearest(df, df.withColumnRenamed("i", "q"), "i", "q", "e", 3, L.euclidean, **({"block_rows": rows} if rows else {})).toPandas()
        d = L.euclidean(x, x)
        assert len(got) == 2700
        own = got.sort_values(["q", "rank"])
        best = np.stack([np.lexsort((np.arange(900), r))[:3] for r in d])
        assert own.i.to_numpy().reshape(900, 3).tolist() == best.tolist()
        assert own.distance.to_numpy().tolist() == np.take_along_axis(d, best, axis=1).ravel().tolist()


def test_range_candidates_match_brute_force(spark):
    rng = np.random.default_rng(4)
    a, b = rng.uniform(-20, 20, 80).round(2), rng.uniform(-20, 20, 90).round(2)
    left = spark.createDataFrame([(i, "k", float(v)) for i, v in enumerate(a)], "i int, k string, x double")
    right = spark.createDataFrame([(j, "k", float(v)) for j, v in enumerate(b)], "j int, k string, y double")
    got = {(r.i, r.j) for r in L.range_candidates(left, right, ["k"], "x", "y", 1.5).collect()}
    assert got == {(i, j) for i, j in itertools.product(range(80), range(90)) if abs(a[i] - b[j]) <= 1.5}


def test_regional_scores_are_those_of_all_pairs_without_a_row_per_pair(spark):
    rng = np.random.default_rng(12)
    rows = [("a", i, bool(i % 3 == 0), float(rng.uniform(0, 60)), float(rng.uniform(0, 9)), int(rng.choice([1, 2, 5, 6, 7]))) for i in range(150)]
    rows += [("b", 1, False, 4.0, 1.0, 3), (None, 2, True, 4.0, 1.0, 3), ("a", 150, True, None, None, 4), ("a", 151, True, 0.0, 0.0, 0), ("a", 152, False, float("nan"), 1.0, 3), ("a", 0, True, 9.0, 1.0, 5)]
    base = spark.createDataFrame(rows, "r string, e int, c boolean, m double, s double, n long")
    out = HH.score_against_checks(base, ["r"], "e", "c", "m", "s", "n")
    pairs = HH.pair_with_checks(base, ["r"], "e", "c", ["m", "s", "n"], how="left")
    ours, theirs, one = S.Side.of("m", "s", "n"), S.Side.of("check_m", "check_s", "check_n"), F.lit(1.0)
    there = F.col("check_e").isNotNull()
    scored = S.apply_normal_score(pairs, S.mean_ratio(ours, theirs, one, one), F.lit("left")).withColumn("f", S.variation_ratio(ours, theirs, one)[1])
    want = scored.groupBy("r", "e", "c").agg(
        F.avg("m").alias("m"), F.avg(F.when(there, F.col("pctchk"))).alias("yield_pct_chk"), F.avg(F.col("m") - F.col("check_m")).alias("yield_diff_vs_chk"),
        A.geometric_mean(F.when(there, F.col("metric_value"))).alias("yield_metric"), A.geometric_mean(F.when(there, F.col("f"))).alias("stability_metric"),
    )
    assert out.columns == want.columns and out.dtypes == want.dtypes
    for got, row in zip(sorted(out.collect(), key=str), sorted(want.collect(), key=str), strict=True):
        assert got[:3] == row[:3]
        assert all(a is b is None or a == pytest.approx(b, rel=1e-8, abs=1e-8, nan_ok=True) for a, b in zip(got[3:], row[3:])), (got, row)
    # a task's result is sums per entry, so no step before it holds the rows of pairs
    assert "CoGroup" in out._jdf.queryExecution().analyzed().toString()


def test_replacement_candidates_need_a_distinct_only_for_repeated_keys(spark):
    rng = np.random.default_rng(9)
    rows = [(i, [None, "x", "y"][rng.integers(3)], None if rng.random() < 0.1 else float(rng.integers(40)), None if rng.random() < 0.5 else float(rng.integers(40))) for i in range(120)]
    for extra in ([], rows[:20], [(i, "x", float(i), 1.0) for i in range(0, 120, 7)] + [(None, None, 5.0, 5.0)] * 2):
        every = rows + extra
        sold = [r for r in every if (r[2] or 0) > 20]
        a, b = (spark.createDataFrame(x, "k int, tech string, rm double, erm double") for x in (every, sold))
        near = lambda p, q, limit: p is not None and q is not None and abs(p - q) < limit
        want = {(p[0], q[0]) for p in every for q in sold if (p[1] is None or q[1] is None or p[1] == q[1]) and (near(p[2], q[2], 3) or near(p[3], q[3], 2))}
        out = P.replacement_candidates(a, b, "k", "tech", {"rm": 3.0, "erm": 2.0})
        got = [(r.k, r.k_product) for r in out.collect()]
        assert len(got) == len(set(got)) and set(got) == want
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert ("Aggregate [k" in plan) == bool(set(every[120:]) - set(rows)), plan


# --- aggregates -----------------------------------------------------------------

def test_percentiles_are_numpys(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"k": rng.choice(["a", "b"], 501), "x": rng.normal(size=501).round(2)})
    got = A.percentiles(spark.createDataFrame(pdf), ["k"], "x", {"a": 0.05, "b": 0.5, "c": 0.93}).toPandas().set_index("k")
    for k, g in pdf.groupby("k"):
        assert np.allclose(got.loc[k].to_numpy(dtype=float), np.percentile(g.x, [5, 50, 93]))


def test_weighted_stddev_is_numpys_aweights(spark):
    x, w = np.array([3.0, 7.0, 4.0, 9.0]), np.array([1.0, 2.0, 0.5, 3.0])
    df = spark.createDataFrame(list(zip(x.tolist(), w.tolist())), "x double, w double")
    got = df.agg(A.weighted_stddev(F.col("x"), F.col("w")).alias("s")).first().s
    assert got == pytest.approx(np.sqrt(np.cov(x, aweights=w)))


def test_zero_weights_read_null(spark):
    df = spark.createDataFrame([(1.0, 0.0), (2.0, 0.0)], "x double, w double")
    r = df.agg(A.weighted_mean(F.col("x"), F.col("w")).alias("m"), A.weighted_geometric_mean(F.col("x"), F.col("w")).alias("g")).first()
    assert (r.m, r.g) == (None, None)


def test_resampled_threshold_is_a_distance(spark):
    df = spark.range(2000).select((F.col("id") % 50).cast("double").alias("x"))
    r = A.resampled_distance_threshold(df, "x", 0.0, 50.0, samples=100, repeats=300).first()
    assert 0.05 < r.threshold < 0.6 and r.n_bins >= 6


def test_equal_weights_roll_up_to_the_geometric_mean(spark):
    rows = [("e", v, 1.0, 1, 5.0, 2.0, 100.0, 0.5, 10, True, True, 1.0, 1) for v in (20.0, 45.0, 80.0)]
    df = spark.createDataFrame(
        rows, "entry string, metric_value double, weight double, incl_pctchk int, prediction double, stddev double, pctchk double, statistic double, count int, cpifl boolean, chkfl boolean, adv_weight double, adv_incl_pctchk int"
    )
    got = U.rollup_weighted(df, ["entry"], "weight").first()
    assert got.metric_value == pytest.approx((20 * 45 * 80) ** (1 / 3)) and got["count"] == 30


# --- bins -----------------------------------------------------------------------

@pytest.mark.parametrize("method", ["kmeans", "kmedians"])
def test_cluster_bins_of_ten_values(spark, method):
    df = spark.createDataFrame([(float(i),) for i in range(1, 11)], "x double")
    out, _ = B.add_bins(df, "x", 6, method)
    assert [r.bin for r in out.orderBy("x").collect()] == [0, 0, 1, 1, 2, 3, 3, 4, 5, 5]


def test_bin_error_and_silhouette(spark):
    bins = [0, 0, 1, 1, 2, 3, 3, 4, 5, 5]
    df = spark.createDataFrame([(float(i + 1), b) for i, b in enumerate(bins)], "x double, b int")
    assert B.reconstruction_rmse(df, "x", "b", [1, 2.5, 4.25, 5.75, 7.25, 8.75, 10]).first().rmse == pytest.approx(0.46770717334674267)
    assert B.silhouette(df, "x", "b").first().silhouette == pytest.approx(0.17666666666666667)


def test_every_value_is_binned(spark):
    df = spark.range(100).select(F.col("id").cast("double").alias("x"))
    for method in ("quantile", "equal"):
        out, edges = B.add_bins(df, "x", 10, method)
        assert len(edges) == 11
        assert {(r.bin, r["count"]) for r in out.groupBy("bin").count().collect()} == {(i, 10) for i in range(10)}


# --- fits -------------------------------------------------------------------------

def _curved(rows=400, groups=3, seed=6):
    rng = np.random.default_rng(seed)
    x = rng.uniform(5, 40, rows)
    g = rng.integers(0, groups, rows)
    y = 10 + (g + 1) * x - 0.02 * g * x**2 + rng.normal(0, 2, rows) + np.where(rng.random(rows) < 0.04, 40, 0)
    return pd.DataFrame({"g": g, "x": x, "y": y})


def test_huber_fits_are_stationary_points(spark):
    pdf = pd.concat([_curved(400), pd.DataFrame({"g": 9, "x": np.arange(1.0, 11), "y": 2 * np.arange(1.0, 11)}), _curved(30)])
    rows = M._prepared(spark.createDataFrame(pdf), ["g"], "x", "y")
    fits = {r.g: r for r in M.huber_fits(rows, ["g"]).collect()}
    assert fits.keys() == set(pdf.g) and fits[9].linear_c1 == pytest.approx(2.0) and fits[9].linear_scale < 1e-9
    for g, part in pdf[pdf.g != 9].groupby("g"):
        for kind, u in (("linear", part.x - part.x.mean()), ("quadratic", part.x - part.x.mean()), ("log", np.log(part.x))):
            design = np.vander(u, M.DEGREE[kind] + 1, increasing=True)
            beta, scale = [fits[g][f"{kind}_c{i}"] for i in range(design.shape[1])], fits[g][f"{kind}_scale"]
            r = ((part.y - part.y.mean()).to_numpy() - design @ beta) / scale
            assert np.abs(design.T @ np.clip(r, -M.EPSILON, M.EPSILON)).max() < 1e-4 * len(r)
            assert np.minimum(r**2, M.EPSILON**2).sum() == pytest.approx(len(r), rel=1e-6)


def test_few_groups_and_clusters_are_not_gathered_in_a_task_each(spark):
    big = spark.range(2_000_000).select("id", (F.col("id") % 2).alias("g"), (F.col("id") % 7).cast("double").alias("v"), F.when(F.col("id") % 3 > 0, F.col("id") % 5).alias("s"))
    told = T.explain(big, ["id"], {"v": "s"}, ["g"], 1)
    named = E.label_clusters(big, "g", "v", ["few", "many"])
    for out in (told, named):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan
    assert {r.id: r.explanation for r in told.filter("id IN (0, 1, 3, 6)").collect()} == {0: "", 1: "v: low", 3: "", 6: ""}
    assert named.groupBy("g").agg(F.first("g_label").alias("l"), F.count_distinct("g_label").alias("n")).filter("n = 1").count() == 2


def test_robust_adjustment_marks_outliers(spark):
    pdf = _curved(400)
    got = M.adjust_robust(spark.createDataFrame(pdf), ["g"], "x", "y").toPandas()
    assert len(got) == len(pdf) and got.adj_model.notna().all() and 0 < got.adj_outlier.mean() < 0.2


def test_least_squares_adjustment_matches_numpy(spark):
    pdf = _curved(300, 1)
    got = M.adjust_least_squares(spark.createDataFrame(pdf), ["g"], "x", "y").toPandas().sort_values("x")
    pdf = pdf.sort_values("x")
    x, y = pdf.x.to_numpy(), pdf.y.to_numpy()

    def refit(design, j):
        inv = np.linalg.inv(design.T @ design)
        beta = inv @ design.T @ y
        e = y - design @ beta
        h = np.einsum("ij,jk,ik->i", design, inv, design)
        s2 = (e @ e - e**2 / (1 - h)) / (len(y) - design.shape[1] - 1)
        d = (inv @ design.T)[j] * e / (1 - h) / np.sqrt(s2 * inv[j, j])
        keep = np.abs(d) < 4 / np.sqrt(len(y))
        b = np.linalg.lstsq(design[keep], y[keep], rcond=None)[0]
        res = y[keep] - design[keep] @ b
        n, k = keep.sum(), design.shape[1] - 1
        r2 = 1 - (res @ res) / ((y[keep] - y[keep].mean()) ** 2).sum()
        return b, 1 - (1 - r2) * (n - 1) / (n - k - 1)

    one = np.ones_like(x)
    fits = {"linear": refit(np.c_[one, x], 1), "quadratic": refit(np.c_[one, x, x**2], 2), "log": refit(np.c_[one, np.log(x)], 1)}
    model = got.adj_model.iloc[0]
    assert model == max(("linear", "log"), key=lambda k: fits[k][1]) or model == "quadratic"
    b = fits[model][0]
    assert got.slope1.iloc[0] == pytest.approx(b[1], rel=1e-6)
    assert got.intercept.iloc[0] == pytest.approx(b[0], rel=1e-6)


def test_stratified_folds_are_even(spark):
    df = spark.range(1003).withColumn("s", F.col("id") % 3)
    sizes = M.stratified_folds(df, ["s"], ["id"], 5).groupBy("s", "fold").count().toPandas()
    assert (sizes.groupby("s")["count"].agg(lambda c: c.max() - c.min()) <= 1).all()


# --- ratings ------------------------------------------------------------------------

@pytest.fixture(scope="module")
def played(spark):
    rng = np.random.default_rng(7)
    rows = [(int(l), int(f), int(e), float(rng.normal(e / 5, 2))) for l in range(2) for f in range(8) for e in rng.choice(10, 5, replace=False)]
    pdf = pd.DataFrame(rows, columns=["league", "field", "entry", "score"])
    return pdf, R.field_scores(spark.createDataFrame(pdf), ["league"], ["field"], "entry", "score")


def _pairwise(pdf, league):
    part = pdf[pdf.league == league]
    ids = sorted(part.entry.unique())
    at = {e: i for i, e in enumerate(ids)}
    s, m = np.zeros((len(ids),) * 2), np.zeros((len(ids),) * 2)
    for _, f in part.groupby("field"):
        for (_, a), (_, b) in itertools.permutations(list(f.iterrows()), 2):
            s[at[a.entry], at[b.entry]] += max(0.0, a.score - b.score)
            m[at[a.entry], at[b.entry]] += 1
    return ids, s, m


def test_massey_matches_listed_games(spark, played):
    pdf, scores = played
    got = R.rate(scores, ["league"], "entry").toPandas()
    for league in (0, 1):
        ids, s, m = _pairwise(pdf, league)
        lap = np.diag(m.sum(axis=1)) - m
        want = np.linalg.lstsq(lap, s.sum(axis=1) - s.sum(axis=0), rcond=None)[0]
        have = got[got.league == league].sort_values("entry")
        assert have.entry.tolist() == ids and np.allclose(have.rating, want)
        assert abs(have.rating.sum()) < 1e-8


@pytest.mark.parametrize("method", ["massey", "keener"])
def test_ratings_of_entries_that_never_met(spark, method):
    rows = [(None, 1, "a", 3.0), (None, 1, "b", 1.0), (None, 2, "c", 9.0), (None, 2, "d", 4.0), (None, 3, "e", 5.0), (1, 1, "a", 2.0)]
    scores = R.field_scores(spark.createDataFrame(rows, "l int, f int, entry string, s double"), ["l"], ["f"], "entry", "s")
    got = {(r.l, r.entry): r.rating for r in R.rate(scores, ["l"], "entry", method).collect()}
    if method == "massey":
        want = {"a": 1.0, "b": -1.0, "c": 2.5, "d": -2.5, "e": 0.0}
    else:
        m = np.full((5, 5), 0.5)
        m[0, 1], m[1, 0], m[2, 3], m[3, 2] = 3 / 4, 1 / 4, 6 / 7, 1 / 7
        value, vector = np.linalg.eig(m)
        lead = np.abs(vector[:, np.argmax(value.real)].real)
        want = dict(zip("abcde", lead / lead.sum()))
    assert {e: got[None, e] for e in "abcde"} == pytest.approx(want, abs=1e-9)
    assert got[1, "a"] == (0.0 if method == "massey" else 1.0) and len(got) == 6


def test_keener_is_the_leading_vector(spark, played):
    pdf, scores = played
    got = R.rate(scores, ["league"], "entry", "keener").toPandas()
    ids, s, _ = _pairwise(pdf, 0)
    a = (s + 1) / (s + s.T + 2)
    have = got[got.league == 0].sort_values("entry").rating.to_numpy()
    assert np.allclose(a @ have / (a @ have).sum(), have, atol=1e-9)


def test_wins_replace_differences(spark, played):
    pdf, scores = played
    got = R.games(R.signed_scores(scores, ["league"]), ["league"], "entry").toPandas()
    want = {}
    for (l, _), f in pdf.groupby(["league", "field"]):
        for a, b in itertools.permutations(f.itertuples(), 2):
            want[l, a.entry] = want.get((l, a.entry), 0) + np.sign(a.score - b.score)
    assert all(abs(want[r.league, r.entry] - r.points) < 1e-9 for r in got.itertuples())


def test_tied_ratings_fall_back_to_head_to_head_then_mean(spark):
    ratings = spark.createDataFrame([(1, "a", 2.0), (1, "b", 1.0), (1, "c", 1.0), (1, "d", 0.0), (1, "e", 0.0)], "league int, entry string, rating double")
    scores = R.field_scores(spark.createDataFrame([(1, 1, "b", 5.0), (1, 1, "c", 9.0)], "league int, f int, entry string, score double"), ["league"], ["f"], "entry", "score")
    got = {r.entry: r.ranking for r in R.rank_ratings(ratings, ["league"], "entry", scores).collect()}
    assert got == {"a": 1.0, "c": 2.0, "b": 3.0, "d": 4.5, "e": 4.5}


def test_stability_rows_are_deviations_from_the_trial_mean(spark):
    rows = [("t1", "Y", "a", 10.0), ("t1", "Y", "b", 14.0), ("t1", "Y", "c", None), ("t2", "Y", "a", 50.0), ("t1", "Z", "a", 3.0), (None, "Y", "a", 7.0)]
    plots = spark.createDataFrame(rows, "trial string, trait string, e string, v double").withColumn("metric_name", F.lit("performance"))
    out = HH.with_stability_rows(plots, "trial", "trait", "v", F.col("trait") == "Y")
    assert out.filter("metric_name = 'performance'").count() == 6
    got = sorted(((r.trial or "", r.e, r.v) for r in out.filter("metric_name = 'stability'").collect()), key=str)
    assert got == [("", "a", 0.0), ("t1", "a", -2.0), ("t1", "b", 2.0), ("t1", "c", None), ("t2", "a", 0.0)]


def test_levels_of_quantile_trees_make_no_row_per_model_and_feature(spark, monkeypatch):
    rng = np.random.default_rng(31)
    n, quantiles, models = 700, (0.2, 0.7), [(0, None), (1, None), (0, 1)]
    b, fold, y = rng.integers(-1, 8, (n, 2)), rng.integers(0, 2, n), rng.normal(0, 1, n)
    y += np.where(b[:, 0] > 3, 2.0, 0.0) + b[:, 1]
    rows = [(int(p), int(q), int(f), None if i % 40 == 0 else float(v), 0.5, 3.0, 0.5) for i, (p, q, f, v) in enumerate(zip(*b.T, fold, y))]
    state = spark.createDataFrame(rows, "_b0 int, _b1 int, _fold int, _y double, _f0 double, _f1 double, _f2 double")

    def no_rows(*_):
        raise AssertionError("rows are multiplied")

    monkeypatch.setattr(Q.F, "explode", no_rows)
    known = F.col("_y").isNotNull()
    trees, at = [Q.Tree() for _ in models], [F.col("_b0"), F.col("_b1")]
    for level in range(2):
        Q._grow(state, models, [known, known, known & (F.col("_fold") != 1)], quantiles, trees, at, level, 8, 20)
    for (q, left_out), first, tree in zip(models, (0.5, 3.0, 0.5), trees):
        learnt = (np.arange(n) % 40 > 0) & (fold != left_out if left_out is not None else True)
        slope, node, want = np.where(y > first, quantiles[q], quantiles[q] - 1), np.zeros(n, dtype=int), {}
        for level in range(2):
            for k in range((1 << level) - 1, (2 << level) - 1):
                total, count = np.zeros((2, 9)), np.zeros((2, 9))
                for j in range(2):
                    np.add.at(total[j], b[learnt & (node == k), j] + 1, slope[learnt & (node == k)])
                    np.add.at(count[j], b[learnt & (node == k), j] + 1, 1)
                if (split := Q.best_split(total, count, 20)) if count.sum() else None:
                    want[k] = split
                    left = (b[:, split[0]] <= split[1]) & (b[:, split[0]] >= 0) | (split[2] & (b[:, split[0]] < 0))
                    node = np.where(node == k, np.where(left, 2 * k + 1, 2 * k + 2), node)
        assert tree.splits == want and len(want) == 3


def test_boosted_quantiles_follow_the_spread_of_their_place(spark):
    rng = np.random.default_rng(4)
    n = 1500
    x, z = rng.uniform(0, 1, n), rng.uniform(0, 1, n)
    y = np.where(x < 0.5, 10.0, 50.0) + rng.normal(0, 1, n) * np.where(z < 0.5, 1.0, 8.0)
    gone = rng.random(n) < 0.1
    y[gone] = 100.0 + rng.normal(0, 1, gone.sum())
    rows = [(i, None if gone[i] else float(x[i]), float("nan") if i == 0 else float(z[i]), float(y[i]) if i % 50 else None, i % 3, "kept") for i in range(n)]
    df = spark.createDataFrame(rows, "i long, x double, z double, y double, f int, _note string")
    for fold in (None, "f"):
        out = Q.quantile_boosting(df, ["x", "z"], "y", (0.1, 0.5, 0.9), fold, rounds=6, depth=3)
        assert out.columns == [*df.columns, "p10", "p50", "p90"] and out.count() == n
        pdf = out.toPandas()
        assert ((pdf.p10 <= pdf.p50) & (pdf.p50 <= pdf.p90)).all()
        known = pdf[pdf.y.notna()]
        for p, share in (("p10", 0.1), ("p50", 0.5), ("p90", 0.9)):
            assert abs((known.y <= known[p]).mean() - share) < 0.07
        at = lambda q: pdf[q & pdf.x.notna()]
        assert abs(at(pdf.x < 0.45).p50.mean() - 10) < 3 and abs(at(pdf.x > 0.55).p50.mean() - 50) < 3
        wide, narrow = (pdf.p90 - pdf.p10)[pdf.z > 0.6].mean(), (pdf.p90 - pdf.p10)[(pdf.z < 0.4) & pdf.x.notna()].mean()
        assert wide > 1.3 * narrow and abs(pdf[pdf.x.isna()].p50.mean() - 100) < 5
    assert Q.quantile_boosting(df.filter("y IS NULL"), ["x"], "y").filter("p50 IS NOT NULL").count() == 0
    assert Q.quantile_boosting(df.limit(0), ["x"], "y").count() == 0


def test_the_boosted_regression_searches_the_whole_grid(spark, monkeypatch):
    whole, asked = inspect.signature(M.regression_by_grid), {}
    rows = SimpleNamespace(
        lineitem=spark.createDataFrame([(1, 1, 2, 3, 4.0, 0.1, 5.0)], "l_orderkey long, l_linenumber int, l_suppkey long, l_partkey long, l_quantity double, l_discount double, l_extendedprice double"),
        part=spark.createDataFrame([(3, 9)], "p_partkey long, p_size int"),
    )

    def regression(df, *args, **named):
        asked.update(whole.bind(df, *args, **named).arguments)
        return df.withColumns({c: F.lit(0.0) for c in ("prediction", "p10", "p50", "p90", "depth")})

    monkeypatch.setattr(M, "regression_by_grid", regression)
    assert fitted_plans.boosted_regression(rows).count() == 1
    searched = {n: asked.get(n, p.default) for n, p in whole.parameters.items()}
    assert len(searched["depths"]) > 1 and max(searched["depths"]) >= 5 and searched["rounds"] >= 10 and searched["folds"] >= 3


def test_splits_send_missing_values_to_the_better_side():
    total, count = np.array([[-8.0, 5.0, -5.0, -5.0]]), np.array([[8.0, 10.0, 10.0, 10.0]])
    assert Q.best_split(total, count, 5) == (0, 0, False)
    assert Q.best_split(np.array([[-8.0, -5.0, 5.0, 5.0]]), count, 5) == (0, 0, True)
    assert Q.best_split(np.array([[8.0, 5.0, -5.0, -5.0]]), count, 5) == (0, 0, True)
    assert Q.best_split(np.zeros((1, 4)), count, 5) is None and Q.best_split(total, count, 30) is None


def test_components_are_those_of_the_whole_matrix(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(0, 1, (700, 3)) @ rng.normal(0, 3, (3, 30)) + rng.normal(0, 0.01, (700, 30)) + 5
    rows = [(i, 2000 + i % 3, x[i].tolist()) for i in range(700)] + [(700, 2000, None), (701, 2000, [1.0]), (702, 2001, [None] * 30), (703, 2003, x[0].tolist())]
    df = spark.createDataFrame(rows, "i long, y int, v array<double>").repartition(20)
    got = {r.i: r for r in C.principal_components(df, "v", ["i"], "y", 2002, 3).collect()}
    fit = x[[i for i in range(700) if i % 3 < 2]]
    directions = np.linalg.svd(fit - fit.mean(axis=0), full_matrices=False)[2][:3]
    directions *= np.sign(directions[np.arange(3), np.abs(directions).argmax(axis=1)])[:, None]
    want = (x - fit.mean(axis=0)) @ directions.T
    assert len(got) == 703 and all(got[i].comp_0 is None for i in (700, 701, 702))
    assert np.allclose([[got[i][f"comp_{j}"] for j in range(3)] for i in range(700)], want, atol=1e-3)
    assert C.principal_components(df.filter("i > 699"), "v", ["i"], "y", 2000, 2).filter("comp_0 IS NOT NULL").count() == 0
    a, b = C.of_batch(x[:300], 30), C.of_batch(x[300:], 30)
    n, mean, basis = C.merged([a, b], 30)
    assert n == 700 and np.allclose(mean, x.mean(axis=0)) and np.allclose(basis.T @ basis, (x - mean).T @ (x - mean))


# --- portfolio -------------------------------------------------------------------------

def test_lifecycle_restarts_after_a_gap_and_retirement_absorbs(spark):
    volumes = {"x": {2000: 5.0, 2001: 50.0, 2002: 100.0, 2003: 100.0, 2004: 60.0, 2006: 30.0}, "y": {2000: 20.0, 2001: 3.0, 2002: 500.0}, "z": {y: 100.0 for y in range(2000, 2007)}}
    df = spark.createDataFrame([(p, y, v) for p, s in volumes.items() for y, v in s.items()], "p string, y int, v double")
    got = {(r.p, r.y): r.stage for r in P.lifecycle_stages(df, ["p"], "y", "v", 10.0).collect()}
    assert [got["x", y] for y in (2000, 2001, 2002, 2003, 2004, 2006)] == [7, 9, 9, 10, 11, 8] and ("x", 2005) not in got
    assert [got["y", y] for y in (2000, 2001, 2002)] == [8, 13, 13]
    assert [got["z", y] for y in range(2000, 2007)] == [8, 10, 10, 10, 11, 11, 11]


def peeled(values, eps, ids):
    """Fronts by taking away, again and again, the rows that no other row beats."""
    box = np.floor(values / eps)
    corner = (((values - box * eps) / eps) ** 2).sum(axis=1)
    order = sorted(range(len(ids)), key=lambda i: (corner[i], ids[i]))
    rank = np.argsort(order)
    le = (box[:, None] <= box[None]).all(axis=2)
    same = le & le.T
    beats = (le & ~same) | (same & (rank[:, None] < rank[None]))
    front, k = np.full(len(ids), -1), 0
    while (front < 0).any():
        rest = np.flatnonzero(front < 0)
        front[rest[~beats[np.ix_(rest, rest)].any(axis=0)]] = k
        k += 1
    return front


@pytest.mark.parametrize(("n_objectives", "eps"), [(1, 1e-9), (2, 1e-9), (2, 2.5), (3, 1e-9), (4, 1.5)])
def test_fronts_are_those_of_peeling(spark, n_objectives, eps):
    rng = np.random.default_rng(8)
    sizes = {"a": 230, "b": 75, "c": 1, None: 30}
    pdf = pd.DataFrame({"g": [g for g, n in sizes.items() for _ in range(n)]})
    for d in range(n_objectives):
        pdf[f"o{d}"] = rng.integers(0, 12, len(pdf)) + (rng.random(len(pdf)) if eps > 1 else 0.0)
    pdf["i"] = rng.permutation(len(pdf))
    want = {}
    for _, own in pdf.groupby("g", dropna=False):
        values = own[[f"o{d}" for d in range(n_objectives)]].to_numpy() * np.array([1.0] + [-1.0] * (n_objectives - 1))
        want |= dict(zip(own.i, peeled(values, eps, own.i.to_numpy()).tolist()))
    rows = [tuple(None if x is None or x != x else x for x in r) for r in pdf.itertuples(index=False)]
    df = spark.createDataFrame(rows, "g string, " + ", ".join(f"o{d} double" for d in range(n_objectives)) + ", i long")
    df = df.unionByName(df.filter("i = 0").withColumns({"i": F.lit(9999).cast("long"), "o0": F.lit(None).cast("double")}))
    smaller, larger = ["o0"], [f"o{d}" for d in range(1, n_objectives)]
    for range_rows, n_fronts in ((1000, None), (48, 3 if n_objectives < 3 else None)):
        got = {r.i: r.front_idx for r in P.pareto_fronts(df, ["g"], "i", smaller, larger, eps, n_fronts, range_rows).collect()}
        assert got.pop(9999) is None
        assert got == {i: f if n_fronts is None or f < n_fronts else None for i, f in want.items()}
    assert P.pareto_fronts(df.limit(0), ["g"], "i", smaller, larger).count() == 0


def test_trait_distance_is_one_sided(spark):
    df = spark.createDataFrame([(3.0, 5.0, 10.0, 4.0)], "GMSTP double, GMSTP_product double, PLHTN double, PLHTN_product double")
    assert df.select(P.one_sided_distance(["GMSTP", "PLHTN"]).alias("d")).first().d == pytest.approx(6.0)
    assert df.select(P.one_sided_distance(["GMSTP"], two_sided=["GMSTP"]).alias("d")).first().d == pytest.approx(2.0)


# --- genotype -----------------------------------------------------------------------------

def test_similarity_and_greedy_choice(spark):
    rng = np.random.default_rng(9)
    calls = [(int(s), int(v), int(rng.integers(1, 4))) for s in range(14) for v in range(30) if rng.random() < 0.7]
    calls += [(99, 1000, 2)]  # shares no variant with anyone
    df = spark.createDataFrame(calls, "s int, v int, c int")
    got = {(r.s, r.bench_s): r.similarity for r in GT.similarity(df, df, "s", "v", "c", block_cells=100).collect()}
    table = {}
    for s, v, c in calls:
        table.setdefault(s, {})[v] = c
    for a, b in itertools.product(table, table):
        joint = set(table[a]) & set(table[b])
        want = round(sum(table[a][v] == table[b][v] for v in joint) / max(1, len(joint)), 8)
        assert got[a, b] == pytest.approx(want)
    assert len(got) == len(table) ** 2 and got[99, 0] == 0.0 and got[3, 3] == 1.0

    pairs = GT.similarity(df, df, "s", "v", "c")
    samples = spark.createDataFrame([(s,) for s in table], "s int")
    kept = {r.s for r in GT.distinct_samples(pairs, samples, "s", [], limit=0.42).collect()}
    want: list[int] = []
    for s in sorted(table):
        if all(max(got[s, k], got[k, s]) < 0.42 for k in want):
            want.append(s)
    assert kept == set(want)


# --- flags, history, grid, sources ------------------------------------------------------------

@pytest.mark.parametrize("size, lifted", [(499, True), (500, False)])
def test_only_small_groups_become_all_checks(spark, size, lifted):
    df = spark.range(size).select(F.lit(1).alias("g"), F.lit(False).alias("cpifl"), F.lit(False).alias("cperf"))
    out = G.fill_missing_checks(df, ["g"], ["cpifl", "cperf"]).agg(F.bool_and("cpifl").alias("a"), F.bool_and("cperf").alias("b")).first()
    assert (out.a, out.b) == (lifted, lifted)


def test_skipped_year_repeats_the_stage_and_absence_drops(spark):
    df = spark.createDataFrame([("a", 2000, 2), ("a", 2002, 4), ("b", 2000, 1), ("c", 2006, 3)], "k string, y int, s int")
    got = {(r.k, r.y): r.s for r in H.repaired_stages(df, ["k"], "y", "s").collect()}
    assert [got["a", y] for y in range(2000, 2004)] == [2, 2, 4, 13]
    assert got["b", 2001] == 13 and ("c", 2005) not in got and got["c", 2006] == 3


def test_dropped_and_checks_do_not_advance(spark):
    rows = [(2.0, 3.0, 4.0), (2.0, 13.0, 13.0), (7.0, 8.0, None), (2.0, None, None), (3.0, 3.0, 4.0)]
    df = spark.createDataFrame(rows, "current_stage double, next_stage double, third_stage double")
    out = H.advancement_labels(df).collect()
    assert [r.was_adv for r in out] == [True, False, False, None, False]
    assert out[0].was_adv_next is True


def test_pair_moments_are_pairwise_complete(spark):
    rng = np.random.default_rng(10)
    pdf = pd.DataFrame({"a": rng.normal(50, 5, 300), "b": rng.normal(size=300)})
    pdf["c"] = np.where(rng.random(300) < 0.3, np.nan, pdf.a * 2 + rng.normal(size=300))
    df = spark.createDataFrame(pdf).withColumn("c", F.when(~F.isnan("c"), F.col("c"))).repartition(4)
    got = E.pair_moments(df, ["a", "b", "c"])
    assert np.allclose(got["corr"], pdf.corr().to_numpy())
    assert np.allclose(got["cov"], pdf.cov().to_numpy())


@pytest.mark.parametrize("width", [2, 3, 512])
def test_moments_by_tiles(spark, width):
    rng = np.random.default_rng(12)
    pdf = pd.DataFrame({f"c{i}": rng.normal(i * 100, 1 + i, 200) for i in range(5)})
    pdf["c3"] = pdf.c1 * 2 + rng.normal(size=200)
    pdf = pdf.mask(rng.random(pdf.shape) < 0.2)
    pdf["flat"], pdf["none"] = 4.0, np.nan
    df = spark.createDataFrame(pdf)
    df = df.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) for c in df.columns]).repartition(5)
    table, _ = E.moment_table(df, df.columns, width)
    got = {(r.i, r.j): r for r in table.collect()}
    assert len(got) == 28 and got[0, 6].n == 0 and got[0, 6].cov is None and got[0, 5].corr is None
    cov, corr = pdf.cov().to_numpy(), pdf.corr().to_numpy()
    for i, j in itertools.combinations_with_replacement(range(5), 2):
        assert got[i, j].n == (pdf.iloc[:, i].notna() & pdf.iloc[:, j].notna()).sum()
        assert got[i, j].cov == pytest.approx(cov[i, j]) and got[i, j].corr == pytest.approx(corr[i, j])


def test_moments_of_no_rows(spark):
    df = spark.createDataFrame([], "a double, b double")
    assert E.moment_table(df, ["a", "b"])[0].count() == 0
    assert E.independent_features(df, ["a", "b"]) == ["a", "b"]


def test_features_are_kept_in_order(spark):
    rng = np.random.default_rng(13)
    pdf = pd.DataFrame({f"f{i}": rng.normal(5, 1, 150) for i in range(4)})
    for i in range(4, 12):
        pdf[f"f{i}"] = pdf[f"f{i - 3}"] ** (1 + i % 2) + rng.normal(0, 0.02 * i, 150)
    want: list[str] = []
    r2 = lambda a, b: np.corrcoef(a, b)[0, 1] ** 2
    for c in pdf:
        a = pdf[c]
        if all(max(r2(a, b), r2(a, b**2), r2(a**2, b)) < 0.92 for b in (pdf[k] for k in want)):
            want.append(c)
    assert 4 <= len(want) < 12 and E.independent_features(spark.createDataFrame(pdf), list(pdf)) == want


def test_joined_texts_of_a_hot_key(spark):
    rows = [(1, f"v{i % 997:04d}", "x") for i in range(6000)] + [(2, "b", None), (2, "a", None), (2, "", "y"), (None, "n", "z"), (None, None, "z"), (3, None, None)]
    df = spark.createDataFrame(rows, "k int, a string, b string").repartition(6)
    got = {r.k: (r.as_, r.bs) for r in A.unique_texts(df, ["k"], {"a": "as_", "b": "bs"}, "|").collect()}
    assert got == {1: ("|".join(f"v{i:04d}" for i in range(997)), "x"), 2: ("|a|b", "y"), None: ("n", "z"), 3: ("", "")}


def test_mahalanobis_among_identical_neighbours_is_zero(spark):
    rows = spark.createDataFrame([(1, 5.0, 5.0)], "r int, a double, b double")
    points = spark.createDataFrame([(i, 5.0, 5.0) for i in range(4)], "p int, a double, b double")
    near = spark.createDataFrame([(1, i) for i in range(4)], "r int, p int")
    assert E.mahalanobis_nearest(rows, near, points, "r", "p", ["a", "b"]).first().mahalanobis == 0.0


def test_run_folders_and_partition_replacement(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    IO.write_run(df, str(tmp_path / "t"), "20240101")
    IO.write_run(df.filter("k = 2"), str(tmp_path / "t"), "20240102")
    assert [r.k for r in IO.newest_run(spark.read.parquet(str(tmp_path / "t"))).collect()] == [2]
    IO.write_parquet(df, str(tmp_path / "p"), ["k"])
    IO.replace_partitions(spark.createDataFrame([(2, "c")], "k int, v string"), str(tmp_path / "p"), ["k"])
    assert {(r.k, r.v) for r in spark.read.parquet(str(tmp_path / "p")).collect()} == {(1, "a"), (2, "c")}


def test_published_tables_replace_what_they_read(spark, tmp_path):
    path = str(tmp_path / "t")
    IO.publish(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), path)
    new = spark.createDataFrame([(2, "z"), (2, "c"), (3, "d")], "k int, v string")
    IO.upsert_table(new, path, ["k"], [F.col("v").desc()])
    IO.upsert_table(new.filter("v = 'c'"), path, ["k"])
    now = lambda: sorted((r.k, r.v) for r in spark.read.parquet(path).collect())
    assert now() == [(1, "a"), (2, "c"), (3, "d")]
    IO.replace_groups_in_table(spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string"), path, ["k"])
    assert now() == [(1, "x"), (1, "y"), (2, "c"), (3, "d")]
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_failed_and_interrupted_publishing_keeps_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    IO.publish(spark.createDataFrame([(1, "a")], "k int, v string"), path)
    with pytest.raises(Exception, match="no such row"):
        IO.publish(spark.read.parquet(path).select("k", F.raise_error(F.lit("no such row")).cast("string").alias("v")), path)
    assert [p.name for p in tmp_path.iterdir()] == ["t"]
    assert [tuple(r) for r in spark.read.parquet(path).collect()] == [(1, "a")]
    (tmp_path / "t").rename(tmp_path / "_t.last-lost")
    IO.upsert_table(spark.createDataFrame([(2, "b")], "k int, v string"), path, ["k"])
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [(1, "a"), (2, "b")]


def test_co_occurrence_meets_in_blocks_and_never_lists_trials_per_pair(spark, monkeypatch):
    rng = np.random.default_rng(6)
    rows = [("g", t, int(e), float(e + rng.normal()) if rng.random() > 0.1 else None, bool(e % 4 == 0 if e % 8 else t % 2 == 0), ["x", "y", None][int(rng.integers(3))])
            for t in range(12) for e in rng.permutation(40)[:25] for _ in range(2)]
    rows += [("g", 3, 0, float("nan"), True, "x"), ("g", 4, 4, float("inf"), True, "y"), (None, 1, 1, 1.0, True, "x"), ("g", None, 4, 1.0, True, "x"), ("g", 1, None, 1.0, True, "x")]
    monkeypatch.setattr(HH, "PAIR_TILE", 8)
    df = spark.createDataFrame(rows, "g string, t long, e long, v double, c boolean, b string")
    pdf = pd.DataFrame(rows, columns=["g", "t", "e", "v", "c", "b"]).dropna(subset=["g", "t", "e"])
    grown = pdf.groupby(["t", "e"]).c.any()
    for breakout in ([], ["b"]):
        made = HH.co_occurrence(df, ["g"], "t", "e", "v", "c", breakout)
        plan = made._jdf.queryExecution().toString()
        assert "FlatMapCoGroupsInArrow" in plan and "sum(_n" not in plan
        got = {tuple(r[k] for k in (*breakout, "e", "check_e")): r for r in made.collect()}
        want = 0
        for b in ([None] if not breakout else ["x", "y"]):
            for e in sorted(pdf.e.unique()):
                for c in sorted(pdf.e.unique()):
                    with_check = {t for (t, k), f in grown.items() if k == c and f}
                    with_entry = {t for (t, k) in grown.index if k == e}
                    own = [r[3] for r in rows if r[0] and r[1] in with_check and r[2] == e and r[3] is not None and (b is None or r[5] == b)]
                    other = [r[3] for r in rows if r[0] and r[1] in with_entry & with_check and r[2] == c and r[3] is not None and (b is None or r[5] == b)]
                    if len(own) > 2 and len(other) > 2:
                        want += 1
                        r = got[(e, c) if b is None else (b, e, c)]
                        assert (r["count"], r["check_count"]) == (len(own), len(other))
                        with np.errstate(invalid="ignore"):
                            for x, side in ((own, ""), (other, "check_")):
                                assert np.isclose(r[side + "prediction"], np.mean(x), equal_nan=True)
                                assert np.isclose(r[side + "stddev"], np.std(x, ddof=1), equal_nan=True)
        assert want == len(got) > 50


def test_a_written_step_leaves_no_shuffle_files(spark):
    files = lambda: {f.getName() for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles())}
    before = {f for f in files() if f.startswith("shuffle_")}
    conf = spark.conf.get(SHUFFLE_CLEANUP, None)
    step = cut_lineage(spark.range(5000).withColumn("k", F.col("id") % 900).groupBy("k").count())
    until = time.time() + 20
    while (left := {f for f in files() if f.startswith("shuffle_")} - before) and time.time() < until:
        time.sleep(0.2)
    assert not left and step.count() == 900 and spark.conf.get(SHUFFLE_CLEANUP, None) == conf


def test_few_pairs_of_many_entries_are_dealt_to_few_tasks(spark, monkeypatch):
    monkeypatch.setattr(HH, "PAIR_TILE", 4)
    rows = [("g", t, k, e, float(e + t), e < 8) for t in range(4) for k in "xy" for e in range(60)]
    df = spark.createDataFrame(rows, "g string, t long, k string, e long, v double, c boolean")
    apart = HH.co_occurrence(df, ["g", "k"], "t", "e", "v", "c")
    # two groups: one pair of blocks each, so no cell travels twice
    assert "hashpartitioning(g" in (plan := apart._jdf.queryExecution().executedPlan().toString()) and "_b1" in plan and ", 2), REPARTITION_BY_NUM" in plan
    beside = HH.co_occurrence(df, ["g", "k"], "t", "e", "v", "c", together=["k"]).collect()
    assert sorted(beside) == sorted(apart.collect()) and len(beside) == 2 * 60 * 8
    assert [(r.e, r.check_e) for r in beside[::2]] == [(r.e, r.check_e) for r in beside[1::2]]


def test_pairs_are_rolled_up_where_they_are(spark):
    rng = np.random.default_rng(5)
    some = lambda x, p=0.15: None if rng.random() < p else x
    rows = [
        ("d", some(e, 0.02), some(["", "c1", "c2"][c], 0.05), f"t{k}", ["performance", "risk", "h2h", "stability"][k % 4], some(int(k)), 3, some(float(k)), some(2.0), 5.0, some(1.0),
         some(True), some(False), some(bool(k % 2)), some(float(rng.uniform(50, 200))), some(float(rng.normal())), some(float(rng.choice([0.0, -1.0, 40.0, 90.0]))), "m",
         some([0.0, 0.5, 2.0, -1.0][int(rng.integers(4))]), some([0.0, 0.6, 0.3][int(rng.integers(3))]), some(int(rng.integers(2))), some(int(rng.integers(2))))
        for e in range(40) for c in range(3) for k in range(6)
    ]
    names = "d string, e long, check_entry_id string, trait string, metric_name string, count long, check_count long, prediction double, check_prediction double, stddev double, check_stddev double"
    names += ", cpifl boolean, chkfl boolean, check_chkfl boolean, pctchk double, statistic double, metric_value double, metric_method string, weight double, adv_weight double, incl_pctchk int, adv_incl_pctchk int"
    rows.sort(key=lambda r: (str(r[1]), str(r[2])))
    df = spark.createDataFrame(rows, names).coalesce(1)
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)  # pairs lie across batches
    try:
        out = U.rollup_head_to_head(df, ["d", "e"], together=True)
        assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
        got = sorted(out.collect(), key=str)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    plain = U.rollup_head_to_head(df, ["d", "e"])
    assert out.dtypes == plain.dtypes
    want = sorted(plain.collect(), key=str)
    assert len(got) == len(want) > 500
    text = lambda r: tuple(f"{v:.9g}" if isinstance(v, float) else str(v) for v in r)
    assert sorted(map(text, got)) == sorted(map(text, want))


def test_points_between_pairs_of_one_group_are_listed_by_field(spark):
    scores = spark.createDataFrame([("l", f, e, float(x), 1.0) for f, e, x in [(1, 1, 5), (1, 2, 3), (1, 3, 9), (2, 1, 1), (2, 2, 4), (3, 4, 7)]], "g string, _field int, e int, _x double, _w double")
    nation = spark.createDataFrame([(1, 7), (2, 7), (3, 8), (4, 7), (5, None)], "e int, nation int")
    out = R.pair_points(scores, ["g"], "e", nation, "nation")
    listed = nation.join(nation.withColumnRenamed("e", "other"), "nation").filter("e <> other").withColumn("g", F.lit("l")).drop("nation")
    want = R.pair_points(scores, ["g"], "e", listed)
    rows = sorted(map(tuple, out.select(want.columns).collect()))
    assert rows == sorted(map(tuple, want.collect())) == [("l", 1, 2, 2.0, 3.0, 2.0), ("l", 2, 1, 3.0, 2.0, 2.0)]


def test_either_key_pairs_arise_once_without_a_distinct_over_all(spark):
    left = spark.createDataFrame([(1, 5, 1), (2, 5, 9), (3, None, 8), (4, 6, None), (4, 5, 8), (None, 5, 7), (2, 5, 9)], "i int, a int, b int")
    right = spark.createDataFrame([(1, 5), (8, 5), (8, 6), (9, 7), (None, 5), (7, None), (1, 5)], "j int, c int")
    keyed = right.withColumn("d", F.col("j"))
    got = sorted(map(tuple, L.either_key_join(left, keyed, [("a", "c"), ("b", "d")], ["i"], ["j"]).collect()), key=str)
    want = left.join(keyed, (left.a == keyed.c) | (left.b == keyed.d)).select("i", "j").distinct()
    assert got == sorted(map(tuple, want.collect()), key=str) and len(got) > 9
    single = spark.range(40).selectExpr("id as i", "id % 2 as a", "id as b")
    other = spark.range(30).selectExpr("id as j", "id % 2 as c", "id as d")
    out = L.either_key_join(single, other, [("a", "c"), ("b", "d")], ["i"], ["j"])
    assert out.count() == out.distinct().count() == 600
    assert out._jdf.queryExecution().optimizedPlan().toString().startswith("Union")


def test_similarity_tiles_are_as_wide_as_their_panel():
    pdf = pd.DataFrame({"s": [1, 2], "_places": [[0, 2], [1]], "_codes": [[1, 4], [3]]})
    assert GT._dense(pdf, pd.Index([1, 2]), "s", 3).tolist() == [[1, 0, 4], [0, 3, 0]]


def test_similar_samples_meet_in_few_blocks_and_come_out_in_steps(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(None if s == 29 else s, v, int(rng.integers(1, 5))) for s in range(30) for v in range(40) if rng.random() < 0.6]
    calls = spark.createDataFrame(rows, "s long, v long, c int")
    monkeypatch.setattr(GT, "SAMPLES_AT_ONCE", 7)
    one = {(s, v): c for s, v, c in rows}
    kinds = [*range(29), None]

    def share(a, b):
        both = [v for v in range(40) if (a, v) in one and (b, v) in one]
        return round(sum(one[a, v] == one[b, v] for v in both) / max(1, len(both)), 8)

    for least in (None, 0.4):
        out = GT.similarity(calls, calls.filter("s < 20 OR s IS NULL"), "s", "v", "c", least)
        got = sorted(((r.s, r.bench_s, r.similarity) for r in out.collect()), key=str)
        want = [(a, b, share(a, b)) for a in kinds for b in [*range(20), None]]
        assert got == sorted((w for w in want if least is None or w[2] >= least), key=str) and len(got) > 20
    monkeypatch.setattr(GT, "ENOUGH_TILES", 1)
    plan = GT.similarity(calls, calls, "s", "v", "c")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(", 42), 1) as int) AS _b") == 2  # one block a side, of several steps


def test_clashes_are_halved_before_they_are_made_distinct(spark, monkeypatch):
    from trialspark.operators import keyed

    written = []
    monkeypatch.setattr(keyed, "cut_lineage", lambda df: written.append(df._jdf.queryExecution().optimizedPlan().toString()) or cut_lineage(df))
    items = spark.createDataFrame([(i, i % 3) for i in range(30)], "k long, v int")
    clashes = spark.createDataFrame([(i, j) for i in range(30) for j in range(30) if abs(i - j) == 4] * 2, "k long, _other long")
    kept = {r.k for r in keyed.kept_in_order(clashes, items, "k", [F.col("v")]).collect()}
    want = set()
    for k in sorted(range(30), key=lambda i: (i % 3, i)):
        if not {k - 4, k + 4} & want:
            want.add(k)
    assert kept == want
    pairs = next(p for p in written if "Union" in p)
    assert pairs.lstrip().startswith("Aggregate")  # distinct comes last


def test_cells_are_made_once_for_the_comparison_with_products(spark, monkeypatch):
    made = []
    monkeypatch.setattr(P, "cut_lineage", lambda df: made.append(df.columns) or cut_lineage(df))
    cells = spark.createDataFrame([(p, "r", e, float(e + p), 1.0 + e) for p in range(5) for e in range(4)], "p int, r string, e int, y double, a double")
    out = P.compare_with_products(cells, spark.createDataFrame([(1,), (2,)], "e int"), ["p"], "r", "e", "y", "a")
    assert made == [["p", "e", "r", "y", "a"]]
    assert {(r.e, r.e_product, r.r, r.a, r.win_share) for r in out.collect()} == {(e, q, r, 5.0 * (1 + e), float(e > q)) for e in range(4) for q in (1, 2) if e != q for r in ("r", "all")}


def test_products_are_compared_after_one_deal_of_the_pairs(spark):
    cells = spark.createDataFrame([(p, "ab"[p % 2], e, float(p * 7 % 5 + e), 1.0 + p % 3) for p in range(6) for e in range(4)], "place int, region string, e int, y double, acres double")
    out = P.compare_with_products(cells, spark.createDataFrame([(1,), (3,)], "e int"), ["place"], "region", "e", "y", "acres")
    deals = [x for x in out._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning(e#" in x and "e_product" in x]
    assert len(deals) == 1 and "region" not in deals[0]
    got = {(r["e"], r["e_product"], r["region"]): (r["acres"], r["win_share"]) for r in out.collect()}
    assert len(got) == 18 and got[(2, 1, "all")] == (12.0, 1.0) and got[(0, 3, "a")] == (6.0, 0.0)


def test_keener_keeps_every_pair_once_however_fields_and_blocks_are_cut(spark, monkeypatch):
    rng = np.random.default_rng(31)
    rows = [(l, f, e, float(rng.integers(9)), 1.0 + e % 2) for l in range(2) for f in range(6) for e in range(12) if rng.random() < 0.7]
    df = spark.createDataFrame([*rows, (0, 1, None, 4.0, 1.0)], "league int, f int, e int, s double, w double")
    scores = R.field_scores(df, ["league"], ["f"], "e", "s", weight="w")
    want = {(r.league, r.e): r.rating for r in R.keener(scores, ["league"], "e").collect()}
    monkeypatch.setattr(R, "FIELD_CHUNK", 3)
    monkeypatch.setattr(R, "PAIRS_IN_BLOCK", 20)
    entries = scores.select("league", "e").distinct().withColumn("_e", F.col("league") * 100 + F.coalesce("e", F.lit(50)).cast("long"))
    shares, buckets = R._met_shares(scores, ["league"], "e", entries)
    pairs = [tuple(sorted((r._i, r._j))) for r in shares.collect()]
    shares.unpersist()
    assert buckets > 2 and len(pairs) == len(set(pairs)) > 60 and not any(50 in (a % 100, b % 100) for a, b in pairs)
    got = {(r.league, r.e): r.rating for r in R.keener(scores, ["league"], "e").collect()}
    assert got == pytest.approx(want, abs=1e-9) and len(got) == len(want) > 20
    ids = sorted({e for l, _, e, _, _ in rows if l == 1})
    s = np.zeros((len(ids), len(ids)))
    for (l, f), field in itertools.groupby(rows, key=lambda r: r[:2]):
        for a, b in itertools.permutations(list(field) if l == 1 else [], 2):
            gap = a[4] * (a[3] - b[3])
            s[ids.index(a[2]), ids.index(b[2])] += gap
    size = np.zeros_like(s)
    for (l, f), field in itertools.groupby(rows, key=lambda r: r[:2]):
        for a, b in itertools.permutations(list(field) if l == 1 else [], 2):
            size[ids.index(a[2]), ids.index(b[2])] += abs(a[4] * (a[3] - b[3]))
    m = 0.5 + s / (2 * (size + 2))
    value, vector = np.linalg.eig(m)
    lead = np.abs(vector[:, np.argmax(value.real)].real)
    assert [got[1, e] for e in ids] == pytest.approx(list(lead / lead.sum()), abs=1e-9)


def test_metrics_of_random_scores_come_from_one_curve(spark, monkeypatch):
    from trialspark.operators import keyed

    rows = [(["a", "b", None][i % 3], i, None if i % 11 == 0 else i % 4 == 0 or i % 3 == 1) for i in range(90)]
    df = spark.createDataFrame(rows, "g string, i long, y boolean")
    scored = df.withColumn("s", (F.col("i") * 7 % 13).cast("double"))
    want = {r.g: r[1:] for r in EV.null_safe_join(EV.area_under_precision_recall(scored, ["g"], "s", "y"), EV.balanced_accuracy(scored, ["g"], "s", "y"), ["g"]).collect()}
    got = {r.g: r[1:] for r in EV._ranking_metrics(scored, ["g"], "s", "y").collect()}
    assert got.keys() == want.keys() and len(got) == 3
    for g in got:
        assert [None if v is None else round(v, 12) for v in got[g]] == [None if v is None else round(v, 12) for v in want[g]]
    steps = []
    monkeypatch.setattr(keyed, "cut_lineage", lambda x, cut=keyed.cut_lineage: steps.append(x) or cut(x))
    out = EV.shuffled_label_metrics(df, ["g"], ["i"], "y", repeats=3)
    assert len(steps) == 1 and {r.n_repeats for r in out.collect()} == {3}


def test_massey_steps_join_their_vectors_without_the_driver(spark, played, monkeypatch):
    plans = []
    monkeypatch.setattr(R, "cut_lineage", lambda x, cut=R.cut_lineage: plans.append(x._jdf.queryExecution().executedPlan().toString()) or cut(x))
    R.massey(played[1], ["league"], "entry")
    steps = [p for p in plans if "image" in p and "_beta" in p or "_rr1" in p]
    assert len(steps) > 2 and all("SortMergeJoin [_e" in p for p in steps)
