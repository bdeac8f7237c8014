"""Column transforms that are fitted on training rows and applied to new ones.

``fit`` reads the training table once or twice and returns a step that holds a
few numbers per column; applying it is a projection.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialspark.operators.aggregates import percentiles, unpivot
from trialspark.operators.keyed import modes

# Floor of a spread, and centre over spread of the 1 to 9 rating scale.
SPREAD_FLOOR = 1e-5
RATING_SHIFT = 5.0 / (20.0 / 3.0) ** 0.5

Step = Callable[[DataFrame], DataFrame]


def fit_normaliser(train: DataFrame, columns: Sequence[str]) -> Step:
    """(x - mean) / population deviation, the deviation floored."""
    row = train.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)], *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(columns)]).first()
    numbers = {c: (row[f"m{i}"], max(row[f"s{i}"] or 0.0, SPREAD_FLOOR)) for i, c in enumerate(columns)}
    return lambda df: df.withColumns(
        {c: (F.col(c) - float(m)) / float(s) if m is not None else F.lit(None).cast("double") for c, (m, s) in numbers.items()}
    )


def column_percentiles(train: DataFrame, columns: Sequence[str], probabilities: dict[str, float]) -> dict[str, dict[str, float]]:
    tall = unpivot(train, [], columns)
    rows = percentiles(tall, ["variable"], "value", probabilities).collect()
    return {r["variable"]: {n: r[n] for n in probabilities} for r in rows}


def fit_filler(train: DataFrame, numeric: Sequence[str] = (), text: Sequence[str] = ()) -> Step:
    """Missing numbers take the training median, missing texts the most frequent value."""
    fills: dict[str, object] = {}
    if numeric:
        fills |= {c: v["m"] for c, v in column_percentiles(train, numeric, {"m": 0.5}).items()}
    if text:
        row = modes(train, [], text).first()
        fills |= {c: row[c] for c in text if row and row[c] is not None}
    return lambda df: df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in fills.items() if c in df.columns})


def fit_clipper(train: DataFrame, columns: Sequence[str], low: float = 0.05, high: float = 0.95, ratings: Sequence[str] = ()) -> Step:
    """Clip to training percentiles, then normalise; rating columns shift by their scale instead.

    Normalisation uses the clipped training column (sample deviation).
    """
    cuts = column_percentiles(train, columns, {"lo": low, "hi": high})

    def clip(df: DataFrame) -> DataFrame:
        return df.withColumns(
            {c: F.when(F.col(c) < v["lo"], F.lit(v["lo"])).when(F.col(c) > v["hi"], F.lit(v["hi"])).otherwise(F.col(c)) for c, v in cuts.items()}
        )

    plain = [c for c in columns if c not in ratings]
    row = clip(train).agg(*[F.avg(c).alias(f"m_{c}") for c in plain], *[F.stddev_samp(c).alias(f"s_{c}") for c in plain]).first() if plain else {}

    def apply(df: DataFrame) -> DataFrame:
        out = clip(df)
        scaled = {c: (F.col(c) - float(row[f"m_{c}"])) / F.nullif(F.lit(float(row[f"s_{c}"])), F.lit(0.0)) for c in plain}
        return out.withColumns(scaled | {c: F.col(c) - RATING_SHIFT for c in columns if c in ratings})

    return apply


def fit_one_hot(train: DataFrame, column: str, limit: int = 1000, least: int = 1) -> Step:
    """0/1 columns for training categories (rarer ones than ``least`` count as missing), plus a missing column."""
    rows = train.filter(F.col(column).isNotNull()).groupBy(F.col(column).cast("string").alias("v")).agg(F.count(F.lit(1)).alias("n"))
    found = rows.filter(F.col("n") >= least).orderBy("v").limit(limit + 1).collect()
    if len(found) > limit:
        raise ValueError(f"{column} has more than {limit} categories")
    categories = [r["v"] for r in found]

    def apply(df: DataFrame) -> DataFrame:
        text = F.col(column).cast("string")
        cols = {f"{column}_{v}": F.coalesce((text == v).cast("int"), F.lit(0)) for v in categories}
        known = F.coalesce(text.isin(categories), F.lit(False)) if categories else F.lit(False)
        return df.withColumns(cols | {f"{column}_missing": (~known).cast("int")}).drop(column)

    return apply


@dataclass(frozen=True)
class Qualifier:
    """What a trait must or must not be within a technology group."""

    group: str
    trait: str
    expected: str | None = None
    forbidden: tuple[str, ...] = ()


def qualifies(rules: Sequence[Qualifier], group: str = "technology") -> Column:
    """True when no rule of the row's group is broken; unknown traits break none."""
    ok = F.lit(True)
    for r in rules:
        value = F.lower(F.col(r.trait))
        good = F.lit(True)
        if r.expected is not None:
            good = good & (value == r.expected.lower())
        for word in r.forbidden:
            good = good & (value != word.lower())
        applies = F.coalesce(F.lower(F.col(group)) == r.group.lower(), F.lit(False)) & F.col(r.trait).isNotNull()
        ok = ok & F.when(applies, good).otherwise(F.lit(True))
    return ok


def row_aggregate(columns: Sequence[str], how: str) -> Column:
    """Mean, sum, smallest or largest of the known values of a row."""
    values = F.filter(F.array(*[F.col(c).cast("double") for c in columns]), lambda v: v.isNotNull() & ~F.isnan(v))
    total = F.aggregate(values, F.lit(0.0), lambda a, v: a + v)
    size = F.nullif(F.size(values), F.lit(0))
    return {
        "mean": total / size,
        "sum": F.when(size.isNotNull(), total),
        "min": F.array_min(values),
        "max": F.array_max(values),
        "count": F.size(values),
    }[how]


# --- text traits ---------------------------------------------------------------

def clean_text_trait(x: Column, suffix: str = "", prefix: str | None = None, drop: str = "") -> Column:
    """Lower-case text without quotes, the part before a double dash, without known affixes.

    With ``prefix`` the part after the last underscore is kept and the prefix put before it.
    """
    out = F.lower(F.replace(x, F.lit('"'), F.lit("")))
    out = F.get(F.split(out, "--"), F.lit(0))
    if suffix:
        out = F.trim(F.replace(out, F.lit(suffix), F.lit("")))
    if prefix is not None:
        out = F.element_at(F.split(out, "_"), -1)
        out = F.concat(F.lit(prefix + "_"), out) if prefix else out
    if drop:
        out = F.trim(F.replace(out, F.lit(drop), F.lit("")))
    return F.when(x != '""', out)


def race_resistance(x: Column) -> tuple[Column, Column]:
    """Leading word and a map from race number to resistance of texts such as ``pi mr3/r14``."""
    words = F.split(F.regexp_replace(clean_text_trait(x), "[-;]", " "), " ")
    source = F.get(F.filter(words, lambda w: ~F.regexp_like(w, F.lit("[0-9]"))), F.lit(0))
    races = F.get(F.filter(words, lambda w: F.regexp_like(w, F.lit("[0-9]"))), F.lit(0))
    parts = F.filter(F.split(races, "/"), lambda p: F.regexp_like(p, F.lit("[0-9]")))
    entries = F.transform(parts, lambda p: F.struct(F.regexp_extract(p, "([0-9]+)", 1).alias("race"), F.trim(F.regexp_replace(p, "[0-9]+", "")).alias("level")))
    return source, entries


def marker_resistance(x: Column) -> Column:
    """(marker, resistance) pairs of texts such as ``rps1c_r;rps3a_s``; a bare marker reads ``1``."""
    parts = F.filter(F.split(clean_text_trait(x), ";"), lambda p: F.trim(p) != "")
    return F.transform(
        parts,
        lambda p: F.struct(
            F.get(F.split(F.trim(p), "_"), F.lit(0)).alias("marker"),
            F.coalesce(F.get(F.split(F.trim(p), "_"), F.lit(1)), F.lit("1")).alias("resistance"),
        ),
    )


def resistance_level(x: Column, scale: Sequence[str]) -> Column:
    """Position of a resistance word on its scale; null for other words."""
    return F.nullif(F.array_position(F.array(*[F.lit(s) for s in scale]), x), F.lit(0)) - 1


def resistance_columns(df: DataFrame, ids: Sequence[str], entries: str, name: str, value: str, names: Sequence[str], scale: Sequence[str], prefix: str) -> DataFrame:
    """One numeric column per known race or marker from its (name, word) entries."""
    tall = df.select(*ids, F.explode_outer(entries).alias("_e")).select(*ids, F.col(f"_e.{name}").alias("_n"), resistance_level(F.col(f"_e.{value}"), scale).alias("_v"))
    wide = tall.groupBy(*ids).pivot("_n", list(names)).agg(F.max("_v"))
    return wide.withColumnsRenamed({n: f"{prefix}{n}" for n in names})


# --- ordered pipelines -----------------------------------------------------------

@dataclass(frozen=True)
class Pipeline:
    """Fitted steps in order."""

    steps: tuple[Step, ...]

    def __call__(self, df: DataFrame) -> DataFrame:
        for s in self.steps:
            df = s(df)
        return df


def fit_pipeline(train: DataFrame, builders: Sequence[Callable[[DataFrame], Step]]) -> Pipeline:
    """Fit steps one after the other, each on the training rows as the steps before it left them."""
    steps, rows = [], train
    for build in builders:
        step = build(rows)
        steps.append(step)
        rows = step(rows)
    return Pipeline(tuple(steps))


# --- feature choice ----------------------------------------------------------------

def one_way_f(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """One-way F statistic of each column between the classes of a label, with p and coverage.

    Sums per column and class come from one aggregate; rows are not sorted or gathered.
    """
    from trialspark.functions.probability import f_sf

    per_class = df.filter(F.col(label).isNotNull()).groupBy(label).agg(
        F.count(F.lit(1)).alias("_all"),
        *[e.alias(f"{p}{i}") for i, c in enumerate(columns) for p, e in (("n", F.count(c)), ("m", F.avg(c)), ("v", F.var_pop(c)))],
    )
    packed = F.array(
        *[
            F.struct(F.lit(c).alias("feature"), F.col(f"n{i}").alias("n"), F.col(f"m{i}").alias("m"), F.col(f"v{i}").alias("v"))
            for i, c in enumerate(columns)
        ]
    )
    tall = per_class.select("_all", F.explode(packed).alias("_f")).select("_all", "_f.*")
    n, total = F.sum("n"), F.sum(F.col("n") * F.col("m"))
    between = F.sum(F.when(F.col("n") > 0, F.col("n") * F.col("m") * F.col("m"))) - total * total / F.nullif(n, F.lit(0))
    within = F.sum(F.when(F.col("n") > 0, F.col("n") * F.col("v")))
    classes = F.count_if(F.col("n") > 0)
    out = tall.groupBy("feature").agg(
        n.alias("n"), between.alias("_b"), within.alias("_w"), classes.alias("_k"), (n / F.sum("_all")).alias("coverage")
    )
    out = out.withColumn("f_stat", (F.col("_b") / F.nullif((F.col("_k") - 1).cast("double"), F.lit(0.0))) / F.nullif(F.col("_w") / F.nullif((F.col("n") - F.col("_k")).cast("double"), F.lit(0.0)), F.lit(0.0)))
    out = out.withColumn("p_value", f_sf(F.col("f_stat"), F.col("_k") - 1, F.col("n") - F.col("_k")))
    return out.select("feature", "n", "coverage", "f_stat", "p_value")


def choose_features(df: DataFrame, representations: dict[str, Sequence[str]], label: str, p_below: float = 0.4, cover_above: float = 0.025, collinear: float = 0.9) -> list[str]:
    """The best representation of each trait by F, without near-copies of better covered ones."""
    from trialspark.operators.grid import correlation_table

    columns = [c for group in representations.values() for c in group]
    scores = {r["feature"]: r for r in one_way_f(df, columns, label).collect()}
    chosen = []
    for group in representations.values():
        usable = [scores[c] for c in group if scores[c]["coverage"] > cover_above and scores[c]["p_value"] is not None and scores[c]["p_value"] < p_below]
        if usable:
            chosen.append(max(usable, key=lambda r: r["f_stat"])["feature"])
    r = correlation_table(df, chosen, squares=False) if len(chosen) > 1 else {}
    dropped: set[str] = set()
    for i, a in enumerate(chosen):
        for b in chosen[i + 1:]:
            if a in dropped or b in dropped or r[a, b] <= collinear:
                continue
            ca, cb = scores[a]["coverage"], scores[b]["coverage"]
            if ca != cb:
                dropped.add(b if ca > cb else a)
    return [c for c in chosen if c not in dropped]
