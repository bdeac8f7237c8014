"""Successive fronts of non-dominated rows, sorted range by range over the cluster.

The front of a row is the length of the longest chain of rows above it, each
beating the next. Rows that beat another come before it in the order of their
objectives, so ranges of that order are settled one after another: a range takes
in how deep earlier ones reach below its rows, then sorts itself with one
staircase per front. What a settled range hands on goes out by halves: after the
first range to the second, after two to the next two, after four to the next
four; each range receives a logarithm of such hand-overs, not one per range.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialspark.operators.keyed import null_safe_join, positions
from trialspark.session import cut_lineage, release

#: Rows of a range; a task holds one range, or parts of two.
RANGE_ROWS = 20_000


class Staircase:
    """The least points of a front in two objectives: one rises along it while the other falls."""

    def __init__(self):
        self.a: list[float] = []
        self.b: list[float] = []

    def covers(self, point: Sequence[float]) -> bool:
        """Whether some point is nowhere greater."""
        i = bisect_right(self.a, point[0])
        return i > 0 and self.b[i - 1] <= point[1]

    def add(self, point: Sequence[float]) -> None:
        if self.covers(point):
            return
        i = j = bisect_left(self.a, point[0])
        while j < len(self.b) and self.b[j] >= point[1]:
            j += 1
        self.a[i:j], self.b[i:j] = [point[0]], [point[1]]


class Surface:
    """The least points of a front in any number of objectives."""

    def __init__(self):
        self.points: np.ndarray | None = None

    def covers(self, point: Sequence[float]) -> bool:
        return self.points is not None and bool((self.points <= np.asarray(point)).all(axis=1).any())

    def add(self, point: Sequence[float]) -> None:
        point = np.asarray(point)[None]
        if self.points is None:
            self.points = point
        elif not self.covers(point[0]):
            self.points = np.concatenate([self.points[~(self.points >= point).all(axis=1)], point])


def sort_range(boxes: np.ndarray, base: np.ndarray) -> np.ndarray:
    """Front of each row of a range, ``base`` being the least that earlier ranges allow.

    Rows come in the order of their boxes (then corner and id), so a row is beaten
    by those before it that are nowhere worse in the objectives but the first. If
    a row of front k above the base beats it, so does one of front k - 1: the
    fronts are searched by halves.
    """
    rest = boxes[:, 1:]
    if rest.shape[1] < 2:
        rest = np.hstack([rest, np.zeros((len(rest), 2 - rest.shape[1]))])
    kind = Staircase if rest.shape[1] == 2 else Surface
    fronts: list = []
    out = np.empty(len(boxes), np.int64)
    for i, (point, low) in enumerate(zip(rest.tolist(), base.tolist())):
        high = max(len(fronts), low)
        while low < high:
            middle = (low + high) // 2
            if middle < len(fronts) and fronts[middle].covers(point):
                low = middle + 1
            else:
                high = middle
        out[i] = low
        while len(fronts) <= low:
            fronts.append(kind())
        fronts[low].add(point)
    return out


def deepest_above(points: np.ndarray, front: np.ndarray, below: np.ndarray) -> np.ndarray:
    """For each row of ``below`` the greatest ``front`` of the ``points`` nowhere greater, -1 without one."""
    out = np.full(len(below), -1, np.int64)
    order = np.argsort(-front, kind="stable")
    points, front = points[order], front[order]
    for a in range(0, len(below), 1024):
        mine = below[a : a + 1024]
        open_ = np.arange(len(mine))
        for b in range(0, len(points), 1024):  # deepest first: the first hit is the answer
            if not len(open_):
                break
            over = np.ones((len(open_), len(points[b : b + 1024])), bool)
            for d in range(points.shape[1]):
                over &= points[None, b : b + 1024, d] <= mine[open_, None, d]
            hit = over.any(axis=1)
            out[a + open_[hit]] = front[b + over[hit].argmax(axis=1)]
            open_ = open_[~hit]
    return out


def _leading(points: np.ndarray, front: np.ndarray) -> np.ndarray:
    """Rows worth handing on: no other row is nowhere greater and as deep."""
    keep = np.zeros(len(points), bool)
    surface = Staircase() if points.shape[1] == 2 else Surface()
    for i in np.lexsort((*points.T[::-1], -front)):
        if not surface.covers(points[i].tolist()):
            keep[i] = True
            surface.add(points[i].tolist())
    return keep


def pareto_fronts(
    df: DataFrame,
    keys: Sequence[str],
    item: str,
    smaller: Sequence[str] = (),
    larger: Sequence[str] = (),
    eps: float | dict[str, float] = 1e-9,
    n_fronts: int | None = None,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """Successive fronts of non-dominated items per key as ``front_idx``; rows with a missing objective take none.

    Objectives are compared in steps of ``eps``. A row is beaten by one whose
    steps are nowhere worse and somewhere better, and within the same steps by
    the one nearer their corner, then by the smaller id. Fronts from ``n_fronts``
    on read null. ``item`` is unique within its key.

    Rows of each key are dealt into ranges of ``range_rows`` in the order of
    their objectives, and the ranges of all keys settled together, the first of
    every key, then the second, and so on. The number of steps is twice that of
    the ranges of the largest key, whatever the number of fronts.
    """
    objectives = [*smaller, *larger]
    signed = [F.col(c).cast("double") for c in smaller] + [-F.col(c).cast("double") for c in larger]
    steps = [float(eps[c] if isinstance(eps, dict) else eps) for c in objectives]
    boxes, corner = [], F.lit(0.0)
    for i, (value, step) in enumerate(zip(signed, steps)):
        steps_in = value / step
        box = F.when(F.abs(steps_in) < 2.0**53, F.floor(steps_in).cast("double")).otherwise(steps_in)  # beyond, doubles are whole
        boxes.append(box.alias(f"_b{i}"))
        corner = corner + F.pow((value - box * step) / step, 2)
    names = [f"_b{i}" for i in range(len(objectives))]
    rows = df.dropna(subset=objectives).select(*keys, item, *boxes, corner.alias("_corner"))
    largest = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).first()[0] or 0
    ranges = -(-largest // range_rows)
    if ranges > 1:
        place = positions(rows, keys, [*names, "_corner", item], "_place")
        rows = place.withColumn("_r", F.floor((F.col("_place") - 1) / range_rows).cast("int")).drop("_place")
    else:
        rows = rows.withColumn("_r", F.lit(0))
    found = _settle(rows, keys, item, names, ranges, n_fronts)
    return null_safe_join(df, found, [*keys, item], "left")


def _settle(rows: DataFrame, keys: Sequence[str], item: str, names: list[str], ranges: int, n_fronts: int | None) -> DataFrame:
    kinds = dict(rows.dtypes)
    head = ", ".join(f"`{c}` {kinds[c]}" for c in (*keys, item))
    fields = ", ".join(f"`{c}` double" for c in names)

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([*names, "_corner", item], kind="stable")
        boxes = pdf[names].to_numpy()
        front = sort_range(boxes, pdf["_base"].to_numpy())
        out = pdf[[*keys, item, "_r", *names]].assign(front_idx=front.astype("int32"))
        if n_fronts is not None:  # a row beyond is below one of the last front asked for
            asked = front < n_fronts
            out, boxes, front = out[asked], boxes[asked], front[asked]
        return out.assign(_leads=_leading(boxes[:, 1:], front) if ranges > 1 else False)

    def deepen(pdf: pd.DataFrame) -> pd.DataFrame:
        above = pdf["front_idx"].notna().to_numpy()
        boxes = pdf[names[1:]].to_numpy().reshape(len(pdf), -1)
        deep = deepest_above(boxes[above], pdf.loc[above, "front_idx"].to_numpy().astype(np.int64), boxes[~above])
        out = pdf.loc[~above, [*keys, item]].assign(_base=(deep + 1).astype("int32"))
        return out[out["_base"] > 0]

    solved = f"{head}, _r int, {fields}, front_idx int, _leads boolean"
    if ranges <= 1:
        alone = rows.withColumn("_base", F.lit(0))
        return alone.groupBy(*keys).applyInPandas(solve, solved).select(*keys, item, "front_idx")
    rows = cut_lineage(rows)
    count = rows.groupBy(*keys).agg((F.max("_r") + 1).alias("_ranges"))
    handed: list[tuple[int, int, DataFrame]] = []
    settled: list[DataFrame] = []
    for r in range(ranges):
        own = rows.filter(F.col("_r") == r)
        known: DataFrame | None = None
        for _, _, h in (x for x in handed if x[0] <= r < x[1]):
            known = h if known is None else known.unionByName(h)
        if known is None:
            own = own.withColumn("_base", F.lit(0))
        else:
            deepest = known.groupBy(*keys, item).agg(F.max("_base").alias("_base"))
            own = null_safe_join(own, deepest, [*keys, item], "left").fillna(0, ["_base"])
        settled.append(cut_lineage(own.groupBy(*keys).applyInPandas(solve, solved)))
        for x in [x for x in handed if x[1] == r + 1]:
            release(x[2])
            handed.remove(x)
        done = r + 1
        width = done & -done  # so many settled ranges hand on to as many next ones
        end = min(done + width, ranges)
        if done == ranges:
            break
        above: DataFrame | None = None
        for s in settled[done - width : done]:
            above = s if above is None else above.unionByName(s)
        above = null_safe_join(above.filter("_leads"), count.filter(F.col("_ranges") > done), keys)
        above = above.withColumn("_to", F.explode(F.sequence(F.lit(done), F.least(F.lit(end), F.col("_ranges")) - 1)))
        above = above.select(*keys, item, F.col("_r").alias("_from"), "_to", *names, "front_idx")
        below = rows.filter(F.col("_r").between(done, end - 1))
        below = below.withColumn("_from", F.explode(F.sequence(F.lit(done - width), F.lit(done - 1))))
        below = below.select(*keys, item, "_from", F.col("_r").alias("_to"), *names, F.lit(None).cast("int").alias("front_idx"))
        met = above.unionByName(below).groupBy(*keys, "_from", "_to").applyInPandas(deepen, f"{head}, _base int")
        handed.append((done, end, cut_lineage(met)))
    out = settled[0]
    for s in settled[1:]:
        out = out.unionByName(s)
    release(rows)
    return out.select(*keys, item, "front_idx")
