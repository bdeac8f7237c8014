"""Stage history, advancement labels and year-to-year features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Stage codes.
CHECK_STAGE = 7
DROPPED_STAGE = 13
SEASONS = ("WNTR", "DRY", "SPR", "SUMR", "WET", "FALL", "AUTM")


def with_previous_year(df: DataFrame, keys: Sequence[str], year: str, columns: Sequence[str], suffix: str = "_prev") -> DataFrame:
    """Attach last year's values of the same key."""
    before = df.select(*keys, (F.col(year) + 1).alias(year), *[F.col(c).alias(c + suffix) for c in columns])
    return df.join(before, [*keys, year], "left")


def coverage(planned: DataFrame, scored: DataFrame, keys: Sequence[str], score: str) -> tuple[DataFrame, DataFrame]:
    """Planned rows with their score (0 when missing), and the list of planned rows without one."""
    found = scored.select(*keys, score, F.lit(True).alias("_found"))
    listed = planned.join(found, list(keys), "left")
    listed = listed.withColumns({"is_scored": F.coalesce("_found", F.lit(False)), score: F.coalesce(score, F.lit(0.0))})
    return listed.drop("_found"), planned.join(scored, list(keys), "left_anti")


def repaired_stages(df: DataFrame, keys: Sequence[str], year: str, stage: str, first: int | None = None, last: int | None = None, look_ahead: int = 5) -> DataFrame:
    """One row per key and year of the calendar, with gaps after a known stage repaired.

    A missing year continues the stage before it when the key shows up again
    within ``look_ahead`` - 1 years after the gap year (inside the calendar),
    and reads 13 (dropped) when it does not. Years before the first known stage
    stay out. Every key holds at most one row per year, so the ordered pass per
    key is bounded by the calendar.
    """
    highest = df.groupBy(*keys, F.col(year).alias("_year")).agg(F.max(stage).alias("_stage"))
    if first is None or last is None:
        span = df.agg(F.min(year), F.max(year)).first()
        first, last = (span[0] if first is None else first), (span[1] if last is None else last)
    known = highest.filter(F.col("_stage").isNotNull()).groupBy(*keys).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("_year", F.col("_stage").cast("double"))))).alias("_known")
    )

    def next_state(acc: Column, y: Column) -> Column:
        now = F.element_at("_known", y)
        years_ahead = F.sequence(y + 1, F.greatest(y + 1, F.least(y + look_ahead - 1, F.lit(last))))
        returns = F.exists(years_ahead, lambda z: (z <= last) & F.map_contains_key("_known", z))
        previous = acc["stage"]
        value = (
            F.when(now.isNotNull(), now)
            .when(previous.isNull(), F.lit(None).cast("double"))
            .when(returns, previous)
            .otherwise(F.lit(float(DROPPED_STAGE)))
        )
        step = F.struct(y.alias("year"), value.alias("stage"))
        return F.struct(value.alias("stage"), F.concat(acc["rows"], F.array(step)).alias("rows"))

    start = F.struct(
        F.lit(None).cast("double").alias("stage"), F.expr("cast(array() as array<struct<year:int,stage:double>>)").alias("rows")
    )
    years = F.sequence(F.lit(first).cast("int"), F.lit(last).cast("int"))
    out = known.select(*keys, F.explode(F.aggregate(years, start, next_state, lambda a: a["rows"])).alias("_r"))
    return out.select(*keys, F.col("_r.year").alias(year), F.col("_r.stage").alias(stage)).filter(F.col(stage).isNotNull())


def stages_reached(df: DataFrame, keys: Sequence[str], stage: str) -> DataFrame:
    """0/1 columns: was the key ever in stage 1..6, was it ever a check."""
    flags = [F.max((F.col(stage) == s).cast("int")).alias(f"stage_{s}") for s in range(1, CHECK_STAGE)]
    return df.groupBy(*keys).agg(*flags, F.max((F.col(stage) == CHECK_STAGE).cast("int")).alias("stage_chk"))


def stages_around(df: DataFrame, keys: Sequence[str], year: str, stage: str, at: Column | int) -> DataFrame:
    """Previous, current, next and third-year stage around one year; keys dropped by then are left out.

    Years outside the data count as dropped.
    """
    offsets = {-1: "prev_stage", 0: "current_stage", 1: "next_stage", 2: "third_stage"}
    centre = F.lit(at) if isinstance(at, int) else at
    near = df.filter(F.col(year).between(centre - 1, centre + 2))
    out = near.groupBy(*keys).agg(
        *[F.max(F.when(F.col(year) == centre + o, F.col(stage))).alias(n) for o, n in offsets.items()]
    )
    return out.filter(F.col("current_stage") < DROPPED_STAGE)


def later_season(season: Column, last_own: Column) -> Column:
    """Whether a season comes after another one within a year."""
    order = F.array(*[F.lit(s) for s in SEASONS])
    return F.array_position(order, season) > F.array_position(order, last_own)


def advanced(current: Column, following: Column, same_stage: bool = False) -> Column:
    """A later, higher stage (or the same, when allowed); null when either is unknown.

    Checks (7) cannot advance, and the following stage must not be "dropped".
    """
    up = current <= following if same_stage else current < following
    return up & (current < CHECK_STAGE) & (following <= CHECK_STAGE)


def advancement_labels(df: DataFrame, same_stage: bool = False, other_next: str | None = None) -> DataFrame:
    """``was_adv``: advanced next year, here or in another market; ``was_adv_next``: and again the year after."""
    here = advanced(F.col("current_stage"), F.col("next_stage"), same_stage)
    was = here
    if other_next:
        elsewhere = advanced(F.col("current_stage"), F.col(other_next), same_stage)
        was = F.coalesce(here, F.lit(False)) | F.coalesce(elsewhere, F.lit(False))
        was = F.when(here.isNull() & elsewhere.isNull(), F.lit(None)).otherwise(was)
    again = advanced(F.col("next_stage"), F.col("third_stage"))
    return df.withColumn("was_adv", was).withColumn("was_adv_next", F.col("was_adv") & again)


def latest_season(df: DataFrame, keys: Sequence[str], season: str) -> DataFrame:
    """The latest season of each key in the order of the season year."""
    order = F.array(*[F.lit(s) for s in SEASONS])
    return df.groupBy(*keys).agg(F.max_by(season, F.array_position(order, F.col(season))).alias("last_season"))


def around_maturity(maturity: Column, group_maturity: Column, within: float = 15.0, small: float = 10.0) -> Column:
    """Keep maturities near the group's, unknown ones, and ones on the small scale."""
    return maturity.isNull() | group_maturity.isNull() | (maturity < small) | (F.abs(maturity - group_maturity) <= within)


def averaged_sources(sources: dict[str, tuple[DataFrame, str]], keys: Sequence[str], value: str = "value") -> DataFrame:
    """Mean of a value over several sources, one vote per source and key, with the source count."""
    stacked = None
    for name, (df, column) in sources.items():
        part = df.filter(F.col(column).isNotNull()).groupBy(*keys).agg(F.avg(column).alias(value)).withColumn("_source", F.lit(name))
        stacked = part if stacked is None else stacked.unionByName(part)
    return stacked.groupBy(*keys).agg(F.avg(value).alias(value), F.count(F.lit(1)).alias("n_sources"))


def preferred_source(df: DataFrame, keys: Sequence[str], source: str, order: Sequence[str], tie: Sequence[str] = ()) -> DataFrame:
    """One row per key from the first source in ``order`` that has one."""
    from trialspark.operators.keyed import top_per_key

    position = F.array_position(F.array(*[F.lit(s) for s in order]), F.col(source))
    ranked = df.withColumn("_pos", position).filter("_pos > 0")
    return top_per_key(ranked, keys, ["_pos", *tie]).drop("_pos")
