"""Row-level cleaning rules as Column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialspark.functions.scoring import FLOOR, clamp


def chosen_flag(selector: Column, flags: Sequence[str], default: Column) -> Column:
    """The flag column named by the row's selector, else the default flag; null reads false."""
    picked = F.lit(None).cast("boolean")
    for name in flags:
        picked = F.when(selector == name, F.col(name)).otherwise(picked)
    known = F.coalesce(selector.isin(*flags), F.lit(False))
    return F.coalesce(F.when(known, picked).otherwise(default), F.lit(False))


def first_known(*candidates: Column) -> Column:
    """First value that is neither null nor NaN, most specific first."""
    return F.coalesce(*candidates)


def known(x: Column) -> Column:
    """Null for NaN and infinities."""
    return F.when(F.isnan(x) | (F.abs(x) == float("inf")), F.lit(None).cast("double")).otherwise(x)


def nonnegative_prediction(prediction: Column, is_entry: Column) -> Column:
    return F.when(is_entry & (prediction < 0), F.lit(0.0)).otherwise(prediction)


def usable_stderr(stderr: Column, is_count_trait: Column, limit: float = 1000.0) -> Column:
    """Null for an exploded standard error of a count trait, floored otherwise."""
    return F.when((stderr > limit) & is_count_trait, F.lit(None).cast("double")).when(stderr < FLOOR, F.lit(FLOOR)).otherwise(stderr)


def stddev_from_stderr(stderr: Column, count: Column) -> Column:
    return stderr * F.sqrt(count)


def clip_metrics(df: DataFrame, pctchk: str = "pctchk", statistic: str = "statistic", value: str = "metric_value") -> DataFrame:
    """Bound result metrics: percent of check to [0, 1000], statistic to [-99, 99], scores below 1 to 0 and above 99 to 99."""
    score = known(F.col(value))
    return df.withColumns(
        {
            pctchk: clamp(known(F.col(pctchk)), 0.0, 1000.0),
            statistic: clamp(known(F.col(statistic)), -99.0, 99.0),
            value: F.when(score < 1, F.lit(0.0)).when(score > 99, F.lit(99.0)).otherwise(score),
        }
    )


def not_excluded(*flags: Column) -> Column:
    """True when no exclusion flag is set; a missing flag keeps the row."""
    keep = F.lit(True)
    for f in flags:
        keep = keep & ~F.coalesce(f.cast("boolean"), F.lit(False))
    return keep


def plausible(trait: Column, value: Column, ranges: dict[str, tuple[float, float]]) -> Column:
    """True when the value lies in the range of its trait; traits without a range are kept out."""
    ok = F.lit(False)
    for name, (low, high) in ranges.items():
        ok = ok | ((trait == name) & value.between(low, high))
    return ok


def matches_but_not(x: Column, wanted: Sequence[str], unwanted: Sequence[str]) -> Column:
    """Case-insensitive LIKE on any wanted pattern and on no unwanted one."""
    low = F.lower(x)
    hit = F.lit(False)
    for p in wanted:
        hit = hit | low.like(p)
    for p in unwanted:
        hit = hit & ~low.like(p)
    return hit


def signed_longitude(longitude: Column, country: Column, western: Sequence[str] = ("US", "CA")) -> Column:
    """Western countries have negative longitudes."""
    return F.when(country.isin(*western) & (longitude > 0), -longitude).otherwise(longitude)


def converted(value: Column, factor: Column, operator: Column) -> Column:
    """Apply a unit factor by its operator when the factor is a usable number."""
    number = factor.try_cast("double")
    valid = number.isNotNull() & (number != 0)
    return F.when(valid & (operator == "*"), value * number).when(valid & (operator == "/"), value / number).otherwise(value)


def to_day_scale(x: Column) -> Column:
    """Maturity on the 0-8 scale to the 80-120 scale; larger values pass through."""
    return F.when(x < 10, x * 5 + 80).otherwise(x)


def to_group_scale(x: Column) -> Column:
    """Maturity on the 80-120 scale to the 0-8 scale; small values pass through."""
    return F.when(x >= 10, (x - 80) / 5).otherwise(x)


def normalised(x: Column, words: dict[str, str], default: str | None = None) -> Column:
    """Map spellings to codes; unknown spellings take the default, or stay."""
    code = F.lit(default) if default is not None else x
    for word, target in words.items():
        code = F.when(F.upper(F.trim(x)) == word.upper(), F.lit(target)).otherwise(code)
    return code


def missing_weight(columns: Sequence[str], importance: dict[str, float] | None = None) -> Column:
    """Sum of the importances of missing columns; a plain count without importances."""
    total = F.lit(0.0) if importance else F.lit(0)
    for c in columns:
        w = F.lit(float(importance.get(c, 0.0))) if importance else F.lit(1)
        total = total + F.when(F.col(c).isNull(), w).otherwise(F.lit(0.0) if importance else F.lit(0))
    return total


def warn_and_blank(df: DataFrame, missing_share: Column, outputs: Sequence[str], limit: float = 0.75, text: str = "too many missing inputs") -> DataFrame:
    """Add a ``warning`` where too much input is missing and blank the outputs there."""
    warned = F.coalesce(missing_share > limit, F.lit(False))
    marked = df.withColumn("_warned", warned)
    blanked = {c: F.when(~F.col("_warned"), F.col(c)) for c in outputs}
    return marked.withColumns({**blanked, "warning": F.when(F.col("_warned"), F.lit(text))}).drop("_warned")


def season_year(date: Column, kind: Column, shifting: Sequence[str], cut_month: int = 8) -> Column:
    """Planting year: late-season transactions of the given kinds belong to next year."""
    return F.year(date) + F.when((F.month(date) > cut_month) & kind.isin(*shifting), F.lit(1)).otherwise(F.lit(0))


def row_mean(columns: Sequence[str]) -> Column:
    """Mean of the non-null values of a row."""
    total, n = F.lit(0.0), F.lit(0)
    for c in columns:
        total = total + F.coalesce(F.col(c).cast("double"), F.lit(0.0))
        n = n + F.col(c).isNotNull().cast("int")
    return total / F.nullif(n, F.lit(0))
