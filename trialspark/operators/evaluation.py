"""Classifier evaluation on whole tables: ranked curves, cuts, rates, baselines.

A group's rows are never sorted in one task. Rows collapse to one cell per
(group, score) with its label counts, and everything that depends on the score
order comes from running sums over those cells.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialspark.operators.aggregates import percentiles
from trialspark.operators.headtohead import welch_one_sided
from trialspark.operators.keyed import attach_row, group_ranks, null_safe_join, running_totals, with_group_values


def _usable(df: DataFrame, score: str, label: str) -> DataFrame:
    return df.filter(F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double")) & F.col(label).isNotNull())


def _beside(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join two tables on their group keys; without keys the right one has a single row."""
    return null_safe_join(left, right, keys) if keys else attach_row(left, right)


def _curve(df: DataFrame, keys: Sequence[str], score: str, label: str, descending: bool = True) -> DataFrame:
    """Cells per score with running positives and rows, and group totals."""
    hit = F.col(label).cast("int")
    cells = running_totals(_usable(df, score, label), keys, score, {"pos": hit, "n": F.lit(1)}, descending)
    return with_group_values(cells, keys, all_pos=F.sum("pos"), all_n=F.sum("n"))


def area_under_precision_recall(df: DataFrame, keys: Sequence[str], score: str, label: str, name: str = "auc_pr") -> DataFrame:
    """Trapezoid area under the precision-recall points, for each class as the positive one.

    The curve starts at recall 0 with precision 1. The negative class is scored
    by the reversed order. A group without positives has no curve and reads null.
    """
    out = None
    for suffix, reverse in (("adv", False), ("notadv", True)):
        rows = df.withColumn("_hit", F.col(label) if not reverse else ~F.col(label).cast("boolean"))
        c = _curve(rows, keys, score, "_hit", descending=not reverse)
        before_pos, before_n = F.col("cum_pos") - F.col("pos"), F.col("cum_n") - F.col("n")
        precision = F.col("cum_pos") / F.col("cum_n")
        previous = F.when(before_n == 0, F.lit(1.0)).otherwise(before_pos / F.nullif(before_n, F.lit(0)))
        area = F.sum(F.col("pos") / F.nullif("all_pos", F.lit(0)) * (precision + previous) / 2)
        part = c.groupBy(*keys).agg(area.alias(f"{name}_{suffix}"))
        out = part if out is None else _beside(out, part, keys)
    return out


def roc_area(df: DataFrame, keys: Sequence[str], score: str, label: str) -> DataFrame:
    """Area under the ROC curve by rank sums with mid-ranks."""
    c = _curve(df, keys, score, label, descending=False)
    mid = F.col("cum_n") - (F.col("n") - 1) / 2
    ranks = F.sum(F.col("pos") * mid)
    p = F.max("all_pos")
    q = F.max("all_n") - p
    return c.groupBy(*keys).agg(((ranks - p * (p + 1) / 2) / F.nullif(p * q, F.lit(0))).alias("roc_auc"))


def recommended_cut(df: DataFrame, keys: Sequence[str], score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Mark as many top-scored rows as were actually advanced.

    ``rank_min`` is the place by score; rows tied across the cut are ordered by
    ``by`` when given, else the tie is marked as a whole only if it fits.
    """
    rows = _usable(df, score, label)
    ranks = group_ranks(rows, keys, score, descending=True).select(*keys, score, "rank_min", "n_tied")
    totals = rows.groupBy(*keys).agg(F.sum(F.col(label).cast("int")).alias("_advanced"))
    out = null_safe_join(null_safe_join(rows, ranks, [*keys, score]), totals, keys)
    if by:
        from pyspark.sql import Window

        place = F.row_number().over(Window.partitionBy(*keys, score).orderBy(*by)) - 1
        marked = F.col("rank_min") + place <= F.col("_advanced")
    else:
        marked = F.col("rank_min") + F.col("n_tied") - 1 <= F.col("_advanced")
    return out.withColumn("recommended", marked).drop("_advanced", "n_tied")


def cut_confusion(df: DataFrame, keys: Sequence[str], score: str, label: str) -> DataFrame:
    """Confusion counts when the number recommended equals the number advanced.

    Rows tied on the cut share it in expectation: a tie of n rows with p
    positives of which m fit contributes m * p / n true positives. Without ties
    on the cut the counts are whole.
    """
    c = _curve(df, keys, score, label).groupBy(*keys).agg(*_cut_sums())
    return c.select(*keys, *[v.alias(k) for k, v in _confusion().items()], "n")


def _cut_sums() -> list[Column]:
    before = F.col("cum_n") - F.col("n")
    taken = F.greatest(F.lit(0), F.least(F.col("n"), F.col("all_pos") - before))
    return [
        F.sum(taken * F.col("pos") / F.col("n")).alias("TP"),
        F.sum(taken * (F.col("n") - F.col("pos")) / F.col("n")).alias("FP"),
        F.max("all_pos").alias("_p"),
        F.max("all_n").alias("n"),
    ]


def _confusion() -> dict[str, Column]:
    return {"TP": F.col("TP"), "FP": F.col("FP"), "FN": F.col("_p") - F.col("TP"), "TN": F.col("n") - F.col("_p") - F.col("FP")}


def _mean_recall(m: dict[str, Column]) -> Column:
    sensitivity = m["TP"] / F.nullif(m["TP"] + m["FN"], F.lit(0.0))
    specificity = m["TN"] / F.nullif(m["TN"] + m["FP"], F.lit(0.0))
    return (F.coalesce(sensitivity, specificity) + F.coalesce(specificity, sensitivity)) / 2


def balanced_accuracy(df: DataFrame, keys: Sequence[str], score: str, label: str) -> DataFrame:
    """Mean of the two class recalls at the cut; a class that is absent does not count."""
    m = cut_confusion(df, keys, score, label)
    return m.select(*keys, _mean_recall({c: F.col(c) for c in ("TP", "FP", "FN", "TN")}).alias("balanced_acc"))


def bottom_shares(df: DataFrame, keys: Sequence[str], score: str, label: str, steps: Sequence[int] = tuple(range(90, 4, -5))) -> DataFrame:
    """Share of advanced rows among the lowest-scored X % and the score at that percentile."""
    c = _curve(df, keys, score, label)
    before = F.col("cum_n") - F.col("n")
    aggregates = []
    for s in steps:
        # rows from position ceil(n * (1 - s/100)) on are the bottom
        start = F.ceil(F.round(F.col("all_n") * (1 - s / 100), 9))
        inside = F.greatest(F.lit(0), F.col("cum_n") - F.greatest(before, start))
        aggregates.append((F.sum(inside * F.col("pos") / F.col("n")) / F.nullif(F.max("all_pos"), F.lit(0))).alias(f"perc_adv_in_bottom_{s}perc"))
    shares = c.groupBy(*keys).agg(*aggregates)
    raw = percentiles(_usable(df, score, label), keys, score, {f"raw_thresh_{s}perc": s / 100 for s in steps})
    return _beside(shares, raw, keys)


def classifier_metrics(df: DataFrame, keys: Sequence[str], score: str, label: str, threshold: float = 0.5) -> DataFrame:
    """ROC area, F1, accuracy and the row-normalised confusion matrix at a threshold."""
    rows = _usable(df, score, label).withColumn("_y", F.col(label).cast("boolean")).withColumn("_hat", F.col(score) >= threshold)
    counts = rows.groupBy(*keys).agg(
        F.count_if(F.col("_y") & F.col("_hat")).alias("tp"),
        F.count_if(~F.col("_y") & F.col("_hat")).alias("fp"),
        F.count_if(F.col("_y") & ~F.col("_hat")).alias("fn"),
        F.count_if(~F.col("_y") & ~F.col("_hat")).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    out = counts.select(
        *keys,
        (2 * tp / F.nullif(2 * tp + fp + fn, F.lit(0))).alias("f1"),
        ((tp + tn) / (tp + fp + fn + tn)).alias("accuracy"),
        (tn / F.nullif(tn + fp, F.lit(0))).alias("tn_rate"),
        (fp / F.nullif(tn + fp, F.lit(0))).alias("fp_rate"),
        (fn / F.nullif(fn + tp, F.lit(0))).alias("fn_rate"),
        (tp / F.nullif(fn + tp, F.lit(0))).alias("tp_rate"),
    )
    area = roc_area(df, keys, score, label)
    return _beside(out, area, keys)


def future_rates(df: DataFrame, keys: Sequence[str], score: str, advanced: str, again: str, step: int = 20, split: float = 0.85) -> DataFrame:
    """Share advanced again by score fifth of the advanced rows, and above / below a percentile of all rows.

    A fifth is open below and closed above, so the lowest score belongs to none.
    """
    adv = df.filter(F.col(advanced) & F.col(score).isNotNull())
    edges = list(range(0, 101, step))
    cuts = percentiles(adv, keys, score, {f"_c{e}": e / 100 for e in edges})
    whole = percentiles(df, keys, score, {"_split": split})
    placed = _beside(adv, _beside(cuts, whole, keys), keys)
    parts = {f"{a}P-{b}P": (F.col(score) > F.col(f"_c{a}")) & (F.col(score) <= F.col(f"_c{b}")) for a, b in zip(edges, edges[1:])}
    parts |= {"high": F.col(score) > F.col("_split"), "low": F.col(score) <= F.col("_split")}
    aggregates = []
    for name, inside in parts.items():
        aggregates.append(F.avg(F.when(inside, F.col(again).cast("int"))).alias(f"future_adv_rate_{name}"))
        aggregates.append(F.count_if(inside).alias(f"n_{name}"))
    aggregates += [F.max(f"_c{e}").alias(f"raw_thresh_{e}P") for e in edges]
    aggregates.append(F.max("_split").alias(f"raw_thresh_high_low_{round(split * 100)}P"))
    return placed.groupBy(*keys).agg(*aggregates)


def future_separation(df: DataFrame, keys: Sequence[str], score: str, advanced: str, again: str) -> DataFrame:
    """Welch test that rows advanced again scored higher among the advanced."""
    adv = df.filter(F.col(advanced) & F.col(score).isNotNull() & F.col(again).isNotNull())
    return welch_one_sided(adv, keys, score, again)


def tall_metrics(df: DataFrame, keys: Sequence[str], model: str, group: str | None = None) -> DataFrame:
    """Metric columns to (mdl, decision_group, metric, value) rows."""
    metrics = [c for c in df.columns if c not in keys]
    tall = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in metrics]).unpivot(list(keys), metrics, "metric", "value")
    name = F.col(group).cast("string") if group else F.lit("all")
    return tall.select(F.lit(model).alias("mdl"), name.alias("decision_group"), "metric", "value")


def metrics_per_group(df: DataFrame, group: str, scores: dict[str, str], label: str, overall: bool = True) -> DataFrame:
    """Ranking metrics of several score columns, per group and over everything, as a tall table."""
    out = None
    for model, score in scores.items():
        for keys in ([group], []) if overall else ([group],):
            pieces = [
                area_under_precision_recall(df, keys, score, label),
                balanced_accuracy(df, keys, score, label),
                cut_confusion(df, keys, score, label),
            ]
            for p in pieces:
                part = tall_metrics(p, keys, model, group if keys else None)
                out = part if out is None else out.unionByName(part)
    return out


def shuffled_label_metrics(df: DataFrame, keys: Sequence[str], unit: Sequence[str], label: str, repeats: int = 10, seed: int = 11) -> DataFrame:
    """Metrics of random scores: each repeat scores every row by a seeded hash."""
    copies = df.withColumn("repeat", F.explode(F.sequence(F.lit(1), F.lit(repeats))))
    scored = copies.withColumn("_random", F.pmod(F.xxhash64(*unit, "repeat", F.lit(seed)), F.lit(1 << 40)).cast("double"))
    metrics = _ranking_metrics(scored, [*keys, "repeat"], "_random", label)
    return metrics.groupBy(*keys).agg(
        F.avg("auc_pr_adv").alias("auc_pr_adv"),
        F.avg("auc_pr_notadv").alias("auc_pr_notadv"),
        F.avg("balanced_acc").alias("balanced_acc"),
        F.count(F.lit(1)).alias("n_repeats"),
    )


def _ranking_metrics(df: DataFrame, keys: Sequence[str], score: str, label: str) -> DataFrame:
    """Both precision-recall areas and the balanced accuracy from one curve: the other class and order are what is left of the totals."""
    c = _curve(df, keys, score, label)
    none = F.lit(0)
    own = F.when(F.col("cum_n") == F.col("n"), F.lit(1.0)).otherwise((F.col("cum_pos") - F.col("pos")) / F.nullif(F.col("cum_n") - F.col("n"), none))
    adv = F.sum(F.col("pos") / F.nullif("all_pos", none) * (F.col("cum_pos") / F.col("cum_n") + own) / 2)
    # from the worst score upwards, negatives as hits
    after_n, after_pos = F.col("all_n") - F.col("cum_n"), F.col("all_pos") - F.col("cum_pos")
    neg, all_neg, after_neg = F.col("n") - F.col("pos"), F.col("all_n") - F.col("all_pos"), after_n - after_pos
    start = F.when(after_n == 0, F.lit(1.0)).otherwise(after_neg / F.nullif(after_n, none))
    notadv = F.sum(neg / F.nullif(all_neg, none) * ((after_neg + neg) / (after_n + F.col("n")) + start) / 2)
    cells = c.groupBy(*keys).agg(adv.alias("auc_pr_adv"), notadv.alias("auc_pr_notadv"), *_cut_sums())
    return cells.select(*keys, "auc_pr_adv", "auc_pr_notadv", _mean_recall(_confusion()).alias("balanced_acc"))


def baseline_scores(df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """Baselines beside a model score: rank, percentile in the group and z-normalised value."""
    ranks = group_ranks(df.filter(F.col(value).isNotNull()), group, value).select(*group, value, "rank_min")
    sized = with_group_values(df, group, _n=F.count(value), _mean=F.avg(value), _sd=F.stddev_pop(value))
    out = null_safe_join(sized, ranks, [*group, value], "left")
    percentile = F.when(F.col("_n") > 1, (F.col("rank_min") - 1) / (F.col("_n") - 1)).otherwise(F.lit(0.0))
    z = (F.col(value) - F.col("_mean")) / F.greatest(F.col("_sd"), F.lit(1e-5))
    return out.withColumns({"value_rank": F.col("rank_min"), "value_percentile": percentile, "value_z": z}).drop(
        "_n", "_mean", "_sd", "rank_min"
    )


def penalty(excess: dict[str, tuple[float, float]]) -> Column:
    """Sum of weight * max(0, x - threshold); null counts as no excess."""
    total = F.lit(0.0)
    for c, (threshold, weight) in excess.items():
        over = F.greatest(F.lit(0.0), F.col(c).cast("double") - threshold)
        total = total + F.when(F.col(c).isNotNull(), over * weight).otherwise(F.lit(0.0))
    return total


def weighted_trait_score(df: DataFrame, keys: Sequence[str], value: str, low: str, centre: str, high: str, direction: str, weight: str) -> DataFrame:
    """Weighted mean of trait scores in [0, 1]: high is better, low is better, or near the centre is better."""
    x, lo, mid, hi = (F.col(c) for c in (value, low, centre, high))
    width = F.nullif(hi - lo, F.lit(0.0))
    up = (x - lo) / width
    near = 1 - F.abs(x - mid) / F.nullif(F.greatest(hi - mid, mid - lo), F.lit(0.0))
    raw = F.when(F.col(direction) == "high", up).when(F.col(direction) == "low", 1 - up).otherwise(near)
    part = F.greatest(F.lit(0.0), F.least(F.lit(1.0), raw))
    known = raw.isNotNull()
    return df.groupBy(*keys).agg(
        (F.sum(F.when(known, part * F.col(weight))) / F.nullif(F.sum(F.when(known, F.col(weight))), F.lit(0.0))).alias("trait_score")
    )


def recommendation_power(df: DataFrame, keys: Sequence[str], recommended: str, advanced: str) -> DataFrame:
    """Advancement rate of recommended rows over the base rate, with false-positive and miss rates."""
    r, a = F.col(recommended), F.col(advanced)
    counts = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(r).alias("n_recommended"),
        F.count_if(a).alias("n_advanced"),
        F.count_if(r & a).alias("n_both"),
    )
    rate = F.col("n_both") / F.nullif("n_recommended", F.lit(0))
    base = F.col("n_advanced") / F.col("n")
    return counts.withColumns(
        {
            "power": rate / F.nullif(base, F.lit(0.0)),
            "false_positive_rate": (F.col("n_recommended") - F.col("n_both")) / F.nullif(F.col("n") - F.col("n_advanced"), F.lit(0)),
            "miss_rate": (F.col("n_advanced") - F.col("n_both")) / F.nullif("n_advanced", F.lit(0)),
        }
    )
