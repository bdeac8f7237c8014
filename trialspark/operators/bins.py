"""Binning of one numeric column.

The column is reduced once to its distinct values with running counts and sums.
A bin of a sorted column is a range of values, so its mean, median and error
come from the running sums at its two ends, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialspark.operators.aggregates import percentiles
from trialspark.operators.keyed import attach_row, running_totals, with_group_values
from trialspark.session import cut_lineage


def bin_index(x: Column, edges: Sequence[float]) -> Column:
    """0-based bin of a value: edges open a bin, values outside go to the end bins."""
    bins = len(edges) - 1
    place = F.lit(-1)
    for e in edges:
        place = place + (x >= F.lit(float(e))).cast("int")
    return F.when(x.isNotNull(), F.greatest(F.lit(0), F.least(F.lit(bins - 1), place)))


def quantile_edges(df: DataFrame, value: str, bins: int) -> list[float]:
    named = {f"e{i}": i / bins for i in range(bins + 1)}
    row = percentiles(df, [], value, named).first()
    return [row[n] for n in named]


def equal_edges(df: DataFrame, value: str, bins: int) -> list[float]:
    low, high = df.agg(F.min(value).cast("double"), F.max(value).cast("double")).first()
    return [low + (high - low) * i / bins for i in range(bins + 1)]


def _cells(df: DataFrame, value: str) -> DataFrame:
    x = F.col(value).cast("double")
    rows = df.select(x.alias("x")).filter(F.col("x").isNotNull())
    cum = running_totals(rows, [], "x", {"n": F.lit(1), "s": F.col("x")})
    return cut_lineage(cum.select("x", "n", "cum_n", "cum_s"))


def _below(cells: DataFrame, bounds: Sequence[float]) -> list[tuple[float, float]]:
    """Rows and their sum strictly below each bound, in one pass over the cells."""
    row = cells.agg(
        *[F.coalesce(F.max(F.when(F.col("x") < b, F.col("cum_n"))), F.lit(0)).alias(f"n{i}") for i, b in enumerate(bounds)],
        *[F.max_by(F.when(F.col("x") < b, F.col("cum_s")), F.when(F.col("x") < b, F.col("x"))).alias(f"s{i}") for i, b in enumerate(bounds)],
        F.max("cum_n").alias("n"),
        F.max_by("cum_s", "x").alias("s"),
    ).first()
    return [(row[f"n{i}"], row[f"s{i}"] or 0.0) for i in range(len(bounds))] + [(row["n"], row["s"])]


def _at_positions(cells: DataFrame, positions: Sequence[int]) -> list[float]:
    """Values at 0-based positions of the sorted column."""
    row = cells.agg(
        *[
            F.max(F.when((F.col("cum_n") - F.col("n") <= p) & (F.col("cum_n") > p), F.col("x"))).alias(f"v{i}")
            for i, p in enumerate(positions)
        ]
    ).first()
    return [row[f"v{i}"] for i in range(len(positions))]


def _midpoints(centres: Sequence[float]) -> list[float]:
    return [a + (b - a) / 2 for a, b in zip(centres, centres[1:])]


def _ranges(cells: DataFrame, centres: Sequence[float]) -> list[tuple[int, int, float]]:
    """(first position, row count, sum) of each centre's values; a value halfway goes to the lower centre."""
    inner = [_next_up(m) for m in _midpoints(centres)]
    marks = [(0, 0.0), *_below(cells, inner)]
    return [(a[0], b[0] - a[0], b[1] - a[1]) for a, b in zip(marks, marks[1:])]


def _next_up(x: float) -> float:
    import math

    return math.nextafter(x, math.inf)


def cluster_edges(df: DataFrame, value: str, bins: int, method: str = "mean", rounds: int | None = None) -> list[float]:
    """Edges of one-dimensional k-means or k-medians bins, started from quantile centres.

    Each round is one or two aggregates over the distinct values; the only
    things that reach the driver are the ``bins`` centres. Empty bins keep
    their centre. Means that do not settle raise; medians take 25 rounds by
    definition and may stop before they settle.
    """
    cells = _cells(df, value)
    start = percentiles(df, [], value, {f"c{i}": (i + 0.5) / bins for i in range(bins)}).first()
    centres = [start[f"c{i}"] for i in range(bins)]
    for _ in range(rounds if rounds is not None else (25 if method == "median" else 300)):
        ranges = _ranges(cells, centres)
        if method == "median":
            wanted = [p for first, n, _ in ranges if n for p in (first + (n - 1) // 2, first + n // 2)]
            found = iter(_at_positions(cells, wanted))
            moved = [(next(found) + next(found)) / 2 if n else c for c, (_, n, _) in zip(centres, ranges)]
        else:
            moved = [s / n if n else c for c, (_, n, s) in zip(centres, ranges)]
        if moved == centres:
            break
        centres = moved
    else:
        if method == "mean":
            raise RuntimeError("bins were not settled when their rounds ran out")
    low, high = cells.agg(F.min("x"), F.max("x")).first()
    return [low, *_midpoints(sorted(centres)), high]


def bin_edges(df: DataFrame, value: str, bins: int, method: str) -> list[float]:
    kinds = {
        "quantile": lambda: quantile_edges(df, value, bins),
        "equal": lambda: equal_edges(df, value, bins),
        "kmeans": lambda: cluster_edges(df, value, bins, "mean"),
        "kmedians": lambda: cluster_edges(df, value, bins, "median"),
    }
    if method.lower() not in kinds:
        raise ValueError(f"unknown binning method {method!r}; use one of {sorted(kinds)}")
    return kinds[method.lower()]()


def add_bins(df: DataFrame, value: str, bins: int, method: str, name: str = "bin") -> tuple[DataFrame, list[float]]:
    """The table with its bin column, and the bin edges."""
    edges = bin_edges(df, value, bins, method)
    if method.lower() in ("kmeans", "kmedians"):
        # a value halfway between two centres belongs to the lower one
        inner = [edges[0], *[_next_up(e) for e in edges[1:-1]], edges[-1]]
        return df.withColumn(name, bin_index(F.col(value), inner)), edges
    return df.withColumn(name, bin_index(F.col(value), edges)), edges


def reconstruction_rmse(df: DataFrame, value: str, bin_col: str, edges: Sequence[float]) -> DataFrame:
    """Root mean squared distance of values to the middle of their bin."""
    middles = F.array(*[F.lit((a + b) / 2) for a, b in zip(edges, edges[1:])])
    return df.agg(F.sqrt(F.avg(F.pow(F.col(value) - F.get(middles, F.col(bin_col)), 2))).alias("rmse"))


def silhouette(df: DataFrame, value: str, bin_col: str) -> DataFrame:
    """Exact mean silhouette of a column cut into ranges, over all rows.

    The distances of a value to the rows of a bin add up to a difference of
    sums, because every other bin lies wholly to one side of it. No pair of rows
    is formed.
    """
    x = F.col(value).cast("double")
    rows = df.select(x.alias("x"), F.col(bin_col).alias("b")).filter(F.col("x").isNotNull())
    cells = running_totals(rows, ["b"], "x", {"n": F.lit(1), "s": F.col("x")})
    own = with_group_values(cells, ["b"], size=F.sum("n"), total=F.sum("s"))
    below_n, below_s = F.col("cum_n"), F.col("cum_s")
    inside = F.col("x") * below_n - below_s + (F.col("total") - below_s) - F.col("x") * (F.col("size") - below_n)
    a = inside / F.nullif((F.col("size") - 1).cast("double"), F.lit(0.0))
    sizes = rows.groupBy("b").agg(F.count(F.lit(1)).alias("n"), F.sum("x").alias("s"))
    packed = sizes.agg(F.collect_list(F.struct("b", "n", "s")).alias("others"))
    joined = attach_row(own.withColumn("a", a), packed)
    other = F.transform(
        F.filter("others", lambda o: o["b"] != F.col("b")), lambda o: F.abs(F.col("x") - o["s"] / o["n"])
    )
    joined = joined.withColumn("d", F.array_min(other))
    score = F.when((F.col("size") == 1) | F.col("d").isNull(), F.lit(0.0)).otherwise(
        (F.col("d") - F.col("a")) / F.nullif(F.greatest("a", "d"), F.lit(0.0))
    )
    return joined.agg((F.sum(F.coalesce(score, F.lit(0.0)) * F.col("n")) / F.sum("n")).alias("silhouette"))
