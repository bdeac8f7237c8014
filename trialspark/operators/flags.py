"""Check flags: where they come from, how parents inherit them, how gaps are filled."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialspark.functions.cleaning import chosen_flag
from trialspark.operators.keyed import null_safe_join, salted_join, top_per_key, with_group_values
from trialspark.operators.lookup import canonical

# Flag names, pool synonyms and thresholds of the check rules.
FLAGS = ("cpifl", "cperf", "cagrf", "cmatf", "cregf", "crtnf")
POOLS = {"female": "pool1", "male": "pool2"}
ENTRY_SHARE = 0.05
PARENT_SHARE = 0.25
ALL_CHECKS_BELOW = 500


def _or(c: str) -> Column:
    return F.coalesce(F.bool_or(c), F.lit(False))


def parent_flags(
    hybrids: DataFrame,
    group: Sequence[str],
    entry: str,
    parents: dict[str, str],
    flags: Sequence[str] = FLAGS,
    any_flag: str = "cpifl",
    beaten: tuple[str, str] = ("fp_ltb", "mp_ltb"),
    type_col: str = "material_type",
) -> DataFrame:
    """Check flags of hybrids handed to their parents.

    ``parents`` maps a parent column to the column with that parent's material
    type. A parent takes the union of its hybrids' flags. Its flags count only
    when it is a line to beat for its pool; a pool without any takes the other
    pool's marks, and a group without any in both takes the plain check flag.
    """
    roles = []
    for parent, kind in parents.items():
        own = hybrids.filter((F.col(parent) != "") & (F.col(entry) != F.col(parent)))
        roles.append(
            own.groupBy(*group, F.col(parent).alias(entry)).agg(
                F.max(kind).alias(type_col), *[_or(c).alias(c) for c in (*flags, *beaten)]
            )
        )
    stacked = roles[0]
    for r in roles[1:]:
        stacked = stacked.unionByName(r)
    fp, mp = beaten
    marked = with_group_values(stacked, [*group, type_col], _has_fp=_or(fp), _has_mp=_or(mp))
    neither = ~F.col("_has_fp") & ~F.col("_has_mp")
    fp_mark = F.when(neither, F.col(any_flag)).when(~F.col("_has_fp"), F.col(mp)).otherwise(F.col(fp))
    mp_mark = F.when(neither, F.col(any_flag)).when(~F.col("_has_mp"), fp_mark).otherwise(F.col(mp))
    pool = canonical(F.col(type_col), POOLS)
    to_beat = F.when(pool == "pool1", fp_mark).when(pool == "pool2", mp_mark).otherwise(F.lit(False))
    out = marked.withColumn("_to_beat", to_beat).withColumns({c: F.col(c) & F.col("_to_beat") for c in flags})
    return out.drop("_to_beat", "_has_fp", "_has_mp", *beaten)


def untested_crosses(parents: DataFrame, existing: DataFrame, group: Sequence[str], parent: str, type_col: str, pair: tuple[str, str]) -> DataFrame:
    """Crosses of the two pools of a group that no existing entry covers.

    The product of the two pools is the result asked for, so it is streamed:
    the larger pool is spread by a salt and nothing is collected per group.
    """
    pool = canonical(F.col(type_col), POOLS)
    first = parents.filter(pool == "pool1").select(*group, F.col(parent).alias(pair[0])).distinct()
    second = parents.filter(pool == "pool2").select(*group, F.col(parent).alias(pair[1])).distinct()
    crosses = salted_join(first, second, list(group), [pair[0]])
    fresh = crosses.join(existing.select(*group, *pair).distinct(), [*group, *pair], "left_anti")
    return fresh.withColumn("entry_id", F.concat_ws("/", *pair))


def fill_missing_checks(df: DataFrame, group: Sequence[str], flags: Sequence[str] = FLAGS, any_flag: str = "cpifl", is_entry: Column | None = None, below: int | None = ALL_CHECKS_BELOW) -> DataFrame:
    """Groups without checks: all entries become checks when the group is small.

    Then every other flag that a group lacks falls back to the check flag.
    ``below=None`` applies the first rule to groups of any size.
    """
    entry = is_entry if is_entry is not None else F.lit(True)
    sized = with_group_values(
        df, group, _n=F.count(any_flag), **{f"_has_{c}": F.bool_or(c) for c in dict.fromkeys([any_flag, *flags])}
    )
    small = F.lit(True) if below is None else F.col("_n") < below
    lifted = (F.col(f"_has_{any_flag}") == F.lit(False)) & small & entry
    out = sized.withColumn(any_flag, F.when(lifted, F.lit(True)).otherwise(F.col(any_flag)))
    others = [c for c in flags if c != any_flag]
    out = out.withColumns(
        {c: F.when((F.col(f"_has_{c}") == F.lit(False)) & entry, F.col(any_flag)).otherwise(F.col(c)) for c in others}
    )
    return out.drop("_n", *[f"_has_{c}" for c in dict.fromkeys([any_flag, *flags])])


def fill_breakout_flags(df: DataFrame, group: Sequence[str], breakout: Sequence[str], is_entry: Column, any_flag: str = "cpifl", trait_flag: str = "chkfl") -> DataFrame:
    """A breakout without checks, inside a group that has some, uses its entries.

    A breakout without trait flags takes the check flags the rows came with.
    """
    inner = with_group_values(df, [*group, *breakout], _in_any=_or(any_flag), _in_trait=_or(trait_flag))
    outer = with_group_values(inner, group, _out_any=_or(any_flag), _out_trait=_or(trait_flag))
    fill_any = ~F.col("_in_any") & F.col("_out_any") & is_entry
    fill_trait = ~F.col("_in_trait") & F.col("_out_trait") & is_entry
    return outer.withColumns(
        {
            any_flag: F.when(fill_any, F.lit(True)).otherwise(F.col(any_flag)),
            trait_flag: F.when(fill_trait, F.col(any_flag)).otherwise(F.col(trait_flag)),
        }
    ).drop("_in_any", "_in_trait", "_out_any", "_out_trait")


def attach_flags(
    predictions: DataFrame,
    flags: DataFrame,
    on: Sequence[str],
    material: str,
    selector: Column,
    default: str = "cpifl",
    names: Sequence[str] = FLAGS,
) -> DataFrame:
    """Join check flags to predictions and pick the flag that counts for the trait (``chkfl``).

    Material types match up to pool synonyms.
    """
    left = predictions.withColumn("_pool", canonical(F.col(material), POOLS))
    right = flags.withColumn("_pool", canonical(F.col(material), POOLS)).drop(material)
    out = left.join(right, [*on, "_pool"], "left").drop("_pool")
    out = out.withColumns({c: F.coalesce(F.col(c), F.lit(False)) for c in names})
    return out.withColumn("chkfl", chosen_flag(selector, names, F.col(default)))


def threshold_flags(df: DataFrame, keys: Sequence[str], group: Sequence[str], flags: Sequence[str], count: str, parent: Column) -> DataFrame:
    """0/1 flags from flagged plot counts: a share above 5 % for entries, 25 % for parents.

    When no plot of the group carries the first flag, every flag is 1.
    """
    summed = df.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in flags], F.sum(count).alias(count), F.bool_or(parent).alias("_parent")
    )
    out = with_group_values(summed, group, _any=F.sum(flags[0]))
    limit = F.when(F.col("_parent"), F.lit(PARENT_SHARE)).otherwise(F.lit(ENTRY_SHARE))
    flag = {c: ((F.col("_any") == 0) | (F.col(c) / F.col(count) > limit)).cast("int") for c in flags}
    return out.withColumn("_limit", limit).withColumns(flag).drop("_any", "_parent", "_limit")


def rows_by_role(df: DataFrame, roles: dict[str, tuple[str, str | None]], id_col: str = "entry_id", role_col: str = "material_type", flag_cols: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """Trial rows once for the entry and once for each known parent, in one pass.

    ``roles`` maps a role to (id column, required condition column or none);
    ``flag_cols`` maps an output flag to the per-role input columns, in role order.
    """
    flag_cols = flag_cols or {}
    used = {c for c, _ in roles.values()} | {c for cs in flag_cols.values() for c in cs}
    rest = [c for c in df.columns if c not in used]
    entries = []
    for i, (role, (column, _)) in enumerate(roles.items()):
        fields = [F.lit(role).alias(role_col), F.col(column).cast("string").alias(id_col)]
        fields += [F.col(cs[i]).alias(name) for name, cs in flag_cols.items()]
        entries.append(F.struct(*fields))
    out = df.select(*rest, F.explode(F.array(*entries)).alias("_role")).select(*rest, "_role.*")
    return out.filter(F.col(id_col).isNotNull() & (F.col(id_col) != ""))


def rating_aggregates(df: DataFrame, keys: Sequence[str], value: str, flags: Sequence[str] = ("cpifl", "chkfl"), settings: Sequence[str] = ()) -> DataFrame:
    """Count, mean and spread of ratings per group with flags and averaged settings."""
    return df.groupBy(*keys).agg(
        F.count(value).alias("count"),
        F.avg(value).alias("prediction"),
        F.stddev_samp(value).alias("stddev"),
        *[F.bool_or(c).alias(c) for c in flags],
        *[F.round(F.avg(c), 4).alias(c) for c in settings],
    )


def trial_deviations(df: DataFrame, trial: Sequence[str], value: str, flag: str) -> DataFrame:
    """Difference from and ratio to the check mean of the trial, or the trial mean without checks."""
    out = with_group_values(df, trial, _check=F.avg(F.when(F.col(flag), F.col(value))), _all=F.avg(value))
    base = F.coalesce("_check", "_all")
    return out.withColumns(
        {"result_diff": F.col(value) - base, "result_perc": F.col(value) / F.nullif(base, F.lit(0.0))}
    ).drop("_check", "_all")


def parent_moments(df: DataFrame, group: Sequence[str], spread_group: Sequence[str], entry: str, parents: tuple[str, str], material: str) -> DataFrame:
    """Count, stderr and stddev of genomic rows derived from their parents.

    The spread of predictions in ``spread_group`` over a row's standard error
    stands for its standard deviation. An entry adds both parents; with one
    parent known, that parent counts twice for the spread.
    """
    base = with_group_values(df, spread_group, _n=F.count("prediction"), _sd=F.stddev_samp("prediction"))
    base = base.withColumn("_ratio", F.col("_sd") / F.nullif("stderr", F.lit(0.0)))
    pool = canonical(F.col(material), POOLS)
    out = base
    for prefix, parent, side in (("f", parents[0], "pool1"), ("m", parents[1], "pool2")):
        source = base.filter(pool == side).groupBy(*group, F.col(entry).alias(parent)).agg(
            F.max("_n").alias(f"_{prefix}n"), F.max("_ratio").alias(f"_{prefix}r")
        )
        out = out.join(source, [*group, parent], "left")
    entry_row = F.col(material) == "entry"
    fn, mn, fr, mr = (F.col(c) for c in ("_fn", "_mn", "_fr", "_mr"))
    both, one = fn.isNotNull() & mn.isNotNull(), F.coalesce(fn, mn)
    single = F.when(fn.isNotNull(), fr).otherwise(mr)
    single_n = F.when(fn.isNotNull(), fn).otherwise(mn)
    count = F.when(entry_row & both, fn + mn).when(entry_row & one.isNotNull(), single_n).otherwise(F.col("_n"))
    stderr = (
        F.when(~entry_row, F.col("_ratio") / F.sqrt("_n"))
        .when(both, fr / F.sqrt(fn) + mr / F.sqrt(mn))
        .when(one.isNotNull(), single / F.sqrt(single_n) * 2)
        .otherwise(F.col("stderr"))
    )
    stddev = (
        F.when(~entry_row, F.col("_ratio"))
        .when(both, fr + mr)
        .when(one.isNotNull(), single * 2)
        .otherwise(F.col("stderr") * F.sqrt("_n"))
    )
    kept = [c for c in df.columns if c != "stderr"]
    return out.select(*kept, count.cast("int").alias("count"), stderr.alias("stderr"), stddev.alias("stddev"))


def regression_pairs(predictions: DataFrame, config: DataFrame, keys: Sequence[str], trait: str, value: str) -> DataFrame:
    """Each y-trait prediction beside the x-trait prediction of the same entry and group."""
    wanted = config.select("x", "y").distinct()
    y_side = predictions.filter(F.col(value).isNotNull()).join(wanted, F.col(trait) == F.col("y"))
    x_side = predictions.filter(F.col(value).isNotNull()).select(*keys, F.col(trait).alias("x"), F.col(value).alias(f"{value}_x"))
    return y_side.join(x_side, [*keys, "x"])


def supported_regression_trials(pairs: DataFrame, trial: Sequence[str], x: str, target: str, more_than_x: int = 2, more_than_targets: int = 1) -> DataFrame:
    """Rows of trials with enough distinct x values and enough target rows."""
    support = pairs.groupBy(*trial).agg(
        F.count_distinct(x).alias("trial_pts"), F.sum(target).alias("analysis_pts")
    )
    enough = support.filter((F.col("trial_pts") > more_than_x) & (F.col("analysis_pts") > more_than_targets))
    return null_safe_join(pairs, enough, trial)


# Metric roles and accepted directions of the trait configuration.
METRIC_ROLES = {"agronomic": "risk", "disease": "risk", "yield": "performance"}
DIRECTIONS = ("positive", "negative", "equal", "not equal", "contain", "contains", "does not contain", "equals")
DISTRIBUTIONS = ("normal", "norm", "rating", "zinb")


def trait_settings(config: DataFrame, keys: Sequence[str], trait: str = "trait", text: bool = False) -> DataFrame:
    """One cleaned configuration row per trait: lower-case words, metric role, distribution."""
    clean = config.withColumns(
        {c: F.trim(F.lower(c)) for c in ("distribution_type", "direction", "metric_name")}
    )
    allowed = F.col("distribution_type") == "text" if text else F.col("distribution_type").isin(*DISTRIBUTIONS)
    clean = clean.filter(allowed & F.col("direction").isin(*DIRECTIONS))
    one = top_per_key(clean, [*keys, trait], ["distribution_type", "direction"])
    role = F.col("metric_name")
    kind = (
        F.when(F.col("distribution_type") == "norm", F.lit("normal"))
        .when((F.col("distribution_type") == "rating") & (role == "h2h"), F.lit("normal"))
        .otherwise(F.col("distribution_type"))
    )
    return one.withColumn("distribution_type", kind).withColumn("metric_name", canonical(role, METRIC_ROLES))


def group_settings(experiments: DataFrame, group: str, experiment: str, year: str, stage: str, maturity: str) -> DataFrame:
    """Stage and maturity of a group in its latest year, and whether it spans experiments or years.

    Maturity is the median over the latest year's experiments.
    """
    from trialspark.operators.aggregates import percentiles

    span = experiments.groupBy(group).agg(
        F.count_distinct(experiment).alias("_n"), F.min(year).alias("_first"), F.max(year).alias("_last")
    )
    latest = experiments.join(span, group).filter(F.col(year) == F.col("_last"))
    last = latest.groupBy(group).agg(F.max(stage).alias("stage"))
    middle = percentiles(latest, [group], maturity, {"decision_group_rm": 0.5})
    label = (
        F.when(F.col("_n") == 1, F.lit("SingleExp"))
        .when(F.col("_first") < F.col("_last"), F.lit("MynoET"))
        .otherwise(F.lit("MultiExp"))
    )
    return span.join(last, group).join(middle, group, "left").select(
        group, label.alias("analysis_type"), "stage", "decision_group_rm"
    )


def clean_feature_value(x: Column) -> Column:
    """Feature values as lower-case words joined by single underscores."""
    return F.lower(F.regexp_replace(F.translate(F.btrim(F.trim(x), F.lit(".")), "-", "_"), r"[ :;*+/&\\_,]+", "_"))
