"""Long to wide and back, one-hot columns, stacked roles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialspark.operators.keyed import null_safe_join


def names_of(df: DataFrame, columns: Sequence[str], limit: int = 10_000) -> list[str]:
    """Distinct joined names of the variable columns, in order.

    These become columns, so there must be few; more than ``limit`` is an error
    and not a silent cut.
    """
    joined = F.concat_ws("_", *columns)
    rows = df.select(joined.alias("n")).distinct().orderBy("n").limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{columns} has more than {limit} distinct values and cannot become columns")
    return [r["n"] for r in rows]


def to_wide(df: DataFrame, ids: Sequence[str], variables: Sequence[str], values: dict[str, Column], names: Sequence[str] | None = None) -> DataFrame:
    """One column per variable name and value.

    ``values`` maps a value label to its aggregate. A single value with an empty
    label gives columns named by the variable alone. Giving ``names`` saves the
    pass that finds them, and makes absent ones appear as null columns.
    """
    names = list(names) if names is not None else names_of(df, variables)
    keyed = df.withColumn("_var", F.concat_ws("_", *variables))
    single = len(values) == 1
    aggs = [v.alias(k or "value") for k, v in values.items()]
    wide = keyed.groupBy(*ids).pivot("_var", names).agg(*aggs)
    if single:
        label = next(iter(values))
        return wide.withColumnsRenamed({n: f"{label}_{n}" for n in names}) if label else wide
    return wide.withColumnsRenamed({f"{n}_{k}": f"{k}_{n}" for n in names for k in values})


def join_on_common(tables: Sequence[tuple[DataFrame, str]], ids: Sequence[str]) -> DataFrame:
    """Chain tables by the id columns each pair has in common; each with its own join type."""
    out = tables[0][0]
    for df, how in tables[1:]:
        common = [c for c in ids if c in out.columns and c in df.columns]
        out = out.join(df, common, how)
    return out


def to_long(df: DataFrame, ids: Sequence[str], columns: Sequence[str], variable: str = "variable", value: str = "value", prefix_from: str | None = None) -> DataFrame:
    """Columns to rows; with ``prefix_from`` the name becomes ``variable_prefix`` of that column."""
    long = df.unpivot([*ids, prefix_from] if prefix_from else list(ids), list(columns), variable, value)
    if prefix_from:
        long = long.withColumn(variable, F.concat_ws("_", variable, prefix_from)).drop(prefix_from)
    return long


def stubs_to_long(df: DataFrame, ids: Sequence[str], stubs: Sequence[str], suffix_col: str, separator: str = "_") -> DataFrame:
    """Columns ``stub<separator>suffix`` become one row per suffix with one column per stub."""
    suffixes = sorted({c[len(s) + len(separator):] for s in stubs for c in df.columns if c.startswith(s + separator)})
    rows = F.array(
        *[
            F.struct(
                F.lit(x).alias(suffix_col),
                *[(F.col(f"{s}{separator}{x}") if f"{s}{separator}{x}" in df.columns else F.lit(None)).alias(s) for s in stubs],
            )
            for x in suffixes
        ]
    )
    return df.select(*ids, F.explode(rows).alias("_row")).select(*ids, "_row.*")


def stack_roles(df: DataFrame, roles: dict[str, str], id_col: str, role_col: str = "role", keep: Sequence[str] = ()) -> DataFrame:
    """One row per role from several id columns in a single pass; empty ids are dropped.

    ``roles`` maps a role label to the column with its id.
    """
    entries = F.array(*[F.struct(F.lit(r).alias(role_col), F.col(c).cast("string").alias(id_col)) for r, c in roles.items()])
    out = df.select(*keep, F.explode(entries).alias("_role")).select(*keep, "_role.*")
    return out.filter(F.col(id_col).isNotNull() & (F.col(id_col) != ""))


def one_hot(df: DataFrame, column: str, categories: Sequence[str], missing: bool = True) -> DataFrame:
    """0/1 columns for categories known from training, plus one for missing values.

    Values outside the list get zeros everywhere.
    """
    cols = {f"{column}_{v}": F.coalesce((F.col(column).cast("string") == v).cast("int"), F.lit(0)) for v in categories}
    if missing:
        cols[f"{column}_missing"] = F.col(column).isNull().cast("int")
    return df.withColumns(cols).drop(column)


def square_matrix(pairs: DataFrame, row: str, column: str, value: str, columns: Sequence[str], fill: float | None = None) -> DataFrame:
    """Pair table to a wide matrix over a bounded set of columns; both directions are filled in."""
    both = pairs.select(F.col(row).alias("_r"), F.col(column).cast("string").alias("_c"), value).unionByName(
        pairs.select(F.col(column).alias("_r"), F.col(row).cast("string").alias("_c"), value)
    )
    wide = both.groupBy(F.col("_r").alias(row)).pivot("_c", list(columns)).agg(F.max(value))
    return wide.fillna(fill, subset=list(columns)) if fill is not None else wide


def ordered_columns(df: DataFrame, first: Sequence[str]) -> DataFrame:
    """Known columns first in the given order, then all others."""
    known = [c for c in first if c in df.columns]
    return df.select(*known, *[c for c in df.columns if c not in known])


def drop_incomplete(df: DataFrame, required: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(required))


def join_pivots(base: DataFrame, other: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    return null_safe_join(base, other, keys, how)
