"""Summaries of per-row attribution columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trialspark.operators.aggregates import percentiles, unpivot
from trialspark.operators.keyed import null_safe_join, top_per_key, with_group_values
from trialspark.session import cut_lineage

# Quantiles reported, and the cuts and words of the five-step wording.
QUANTILES = {"q05": 0.05, "q25": 0.25, "q50": 0.5, "q75": 0.75, "q95": 0.95}
CUTS = (-1.25, -0.5, 0.5, 1.25)
LEVEL_WORDS = ("very low", "low", "moderate", "high", "very high")
WET_WORDS = ("very dry", "dry", "moderate", "wet", "very wet")
TALL_WORDS = ("very short", "short", "moderate", "tall", "very tall")


def summarise(df: DataFrame, ids: Sequence[str], regions: Sequence[str], features: Sequence[str]) -> DataFrame:
    """Mean attribution per id group and feature, with quantiles over the region group."""
    tall = unpivot(df, [*dict.fromkeys([*ids, *regions])], features, "feature", "shap")
    means = tall.groupBy(*ids, "feature").agg(F.avg("shap").alias("shap"))
    spread = percentiles(tall, [*regions, "feature"], "shap", QUANTILES)
    return null_safe_join(means, spread, [*regions, "feature"], "left")


def binned_values(df: DataFrame, ids: Sequence[str], features: Sequence[str], bins: int = 6) -> DataFrame:
    """Feature values as quantile bins 1..n; features with few distinct values keep them."""
    tall = unpivot(df, ids, features, "feature", "value")
    # counting (feature, value) cells first keeps the distinct count mergeable
    distinct = tall.filter(F.col("value").isNotNull()).groupBy("feature", "value").agg(F.lit(1).alias("_x")).groupBy("feature").agg(F.count(F.lit(1)).alias("_distinct"))
    edges = percentiles(tall, ["feature"], "value", {f"_e{i}": i / bins for i in range(bins + 1)})
    placed = null_safe_join(null_safe_join(tall, distinct, ["feature"], "left"), edges, ["feature"], "left")
    place = F.lit(0)
    for i in range(bins + 1):
        place = place + (F.col("value") >= F.col(f"_e{i}")).cast("int")
    number = F.greatest(F.lit(1), F.least(F.lit(bins), place)).cast("double")
    value = F.when(F.col("_distinct") <= bins, F.col("value")).otherwise(F.when(F.col("value").isNotNull(), number))
    return placed.select(*ids, "feature", value.alias("binned"))


def top_influencers(df: DataFrame, levels: Sequence[Sequence[str]], features: Sequence[str], n: int = 10) -> DataFrame:
    """The n most positive and most negative features by mean attribution, per aggregation level.

    An empty level is the global one. Rows: (aggregate_level, aggregate_value,
    direction, rank, feature, shap). Ties go to the feature name.
    """
    out = None
    tall = unpivot(df, [*dict.fromkeys([c for level in levels for c in level])], features, "feature", "shap")
    for level in levels:
        name = "_".join(level) if level else "Global"
        value = F.concat_ws("_", *[F.col(c).cast("string") for c in level]) if level else F.lit("Global")
        means = tall.groupBy(*level, "feature").agg(F.avg("shap").alias("shap")).select(value.alias("aggregate_value"), "feature", "shap")
        for direction, order in (("positive", "-shap"), ("negative", "shap")):
            part = top_per_key(means, ["aggregate_value"], [order, "feature"], n, rank_col="rank")
            part = part.select(F.lit(name).alias("aggregate_level"), "aggregate_value", F.lit(direction).alias("direction"), "rank", "feature", "shap")
            out = part if out is None else out.unionByName(part)
    return out


def tall_ranked(df: DataFrame, ids: Sequence[str], columns: Sequence[str], categories: dict[str, str]) -> DataFrame:
    """Columns named ``<what>_T<P|N>I_<rank>`` to rows with rank, direction, name, value and category."""
    long = df.unpivot([*ids], list(columns), "_column", "value")
    pattern = r"^(.*)_T([PN])I_([0-9]+)$"
    rows = long.withColumns(
        {
            "what": F.regexp_extract("_column", pattern, 1),
            "direction": F.when(F.regexp_extract("_column", pattern, 2) == "P", F.lit("positive")).otherwise(F.lit("negative")),
            "rank": F.regexp_extract("_column", pattern, 3).cast("int") + 1,
        }
    )
    category = F.lit("other")
    for prefix, word in categories.items():
        category = F.when(F.startswith("what", F.lit(prefix)), F.lit(word)).otherwise(category)
    return rows.withColumn("category", category).drop("_column")


def wording(z: Column, words: Sequence[str]) -> Column:
    """One of five words by z-score."""
    out = F.lit(words[0])
    for cut, word in zip(CUTS, words[1:]):
        out = F.when(z > cut, F.lit(word)).otherwise(out)
    return out


def explain(df: DataFrame, ids: Sequence[str], features: dict[str, str], group: Sequence[str] = (), n: int = 4, words: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """Text with the n strongest drivers of each row and how unusual their values are.

    ``features`` maps a value column to its attribution column. Values are put
    on the scale of their group; a missing value reads "missing". The strongest
    attribution comes first, ties by feature name. Each row keeps its own
    features together, so no shuffle follows the group statistics. These are
    written first: with few groups they are broadcast, and no task gets all rows of one.
    """
    stats = {}
    for i, c in enumerate(features):
        stats |= {f"_m{i}": F.avg(c), f"_s{i}": F.stddev_pop(c)}
    if group:
        totals = cut_lineage(df.groupBy(*group).agg(*[v.alias(k) for k, v in stats.items()]))
        scaled = null_safe_join(df, totals, group, "left")
    else:
        scaled = with_group_values(df, group, **stats)
    words = words or {}
    parts = []
    for i, (c, shap) in enumerate(features.items()):
        spread = F.col(f"_s{i}")
        z = F.when(spread == 0, F.lit(0.0)).otherwise((F.col(c) - F.col(f"_m{i}")) / F.nullif(spread, F.lit(0.0)))
        text = F.when(F.col(c).isNull(), F.lit("missing")).otherwise(wording(z, words.get(c, LEVEL_WORDS)))
        strength = F.abs(F.coalesce(F.col(shap), F.lit(0.0)))
        parts.append(F.struct((-strength).alias("order"), F.lit(c).alias("name"), F.concat(F.lit(f"{c}: "), text).alias("text")))
    top = F.slice(F.array_sort(F.array(*parts)), 1, min(n, len(features)))
    any_known = F.coalesce(*[F.col(s) for s in features.values()]).isNotNull()
    joined = F.array_join(F.transform(top, lambda p: p["text"]), ", ")
    return scaled.select(*ids, F.when(any_known, joined).otherwise(F.lit("")).alias("explanation"))
