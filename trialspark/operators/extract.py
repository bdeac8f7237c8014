"""Trial extracts: one operator chain, with a parameter row per market."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialspark.functions.cleaning import not_excluded, plausible, signed_longitude
from trialspark.operators.keyed import top_per_key, with_group_values


@dataclass(frozen=True)
class Market:
    """What differs between markets."""

    exclude: Sequence[str] = ()
    ranges: dict[str, tuple[float, float]] = field(default_factory=dict)
    western: Sequence[str] = ("US", "CA")
    crop: str = "corn"
    crop_column: str = "previous_crop_corn"


def previous_crop_code(x: Column, crop: str) -> Column:
    """2 for the crop itself, 0 for another known crop, 1 for unknown."""
    return F.when(F.lower(x) == crop, F.lit(2)).when(x.isNotNull(), F.lit(0)).otherwise(F.lit(1))


def trial_extract(df: DataFrame, market: Market, trait: str, value: str, location: str, longitude: str, country: str, previous_crop: str) -> DataFrame:
    """Rows without exclusion flags and inside plausible ranges, with repaired coordinates and crop code.

    A missing longitude takes the mean of its location, after signs are set.
    """
    rows = df.filter(not_excluded(*[F.col(c) for c in market.exclude]))
    if market.ranges:
        rows = rows.filter(plausible(F.col(trait), F.col(value), market.ranges))
    rows = rows.withColumn(longitude, signed_longitude(F.col(longitude), F.col(country), market.western))
    rows = with_group_values(rows, [location], _mean_longitude=F.avg(longitude))
    return rows.withColumns(
        {longitude: F.coalesce(longitude, "_mean_longitude"), market.crop_column: previous_crop_code(F.col(previous_crop), market.crop)}
    ).drop("_mean_longitude")


def model_matrix(df: DataFrame, ids: Sequence[str], features: Sequence[str], where: Column | None = None) -> DataFrame:
    """Row ids and features as doubles (``x_`` names); predictions join back on the ids."""
    rows = df.filter(where) if where is not None else df
    return rows.select(*ids, *[F.col(c).cast("double").alias(f"x_{c}") for c in features])


def numeric_and_text(df: DataFrame, keys: Sequence[str], trait: str, number: str, text: str, order: str) -> DataFrame:
    """Tall traits in one format: mean of numbers and the first text per key."""
    return df.groupBy(*keys, trait).agg(
        F.avg(number).alias("value"), F.min_by(text, F.when(F.col(text).isNotNull(), F.col(order))).alias("alpha_value")
    )


def staged_entries(df: DataFrame, keys: Sequence[str], text: str, year: str, highest: int = 7) -> DataFrame:
    """Highest stage per key and year, read from a text such as ``Stage 4.2`` and kept up to a limit."""
    stage = F.nullif(F.regexp_extract(text, r"([0-9]+(?:\.[0-9]+)?)", 1), F.lit("")).try_cast("double")
    rows = df.withColumn("stage", stage).filter(F.col("stage") <= highest)
    return rows.groupBy(*keys, year).agg(F.max("stage").alias("stage"))


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return top_per_key(df, keys, order)
