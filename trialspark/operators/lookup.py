"""Joins beyond plain equality: ranges, fallbacks, synonyms, aliases, neighbours."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialspark.operators.keyed import null_safe_join, paired_join, salted_join, top_per_key, with_group_values
from trialspark.session import cut_lineage


@dataclass(frozen=True)
class Band:
    """Half-open interval ``low <= value < high`` between a fact and a config column pair."""

    value: str
    low: str
    high: str


def range_lookup(facts: DataFrame, config: DataFrame, equal: dict[str, str], bands: Sequence[Band], take: dict[str, str], how: str = "left") -> DataFrame:
    """Join config rows whose equality keys match and whose intervals hold the fact's values.

    ``equal`` maps fact columns to config columns, ``take`` maps config columns
    to output names. The equality keys make it a hash join; the intervals are a
    residual condition. Spark broadcasts the config when its size allows it.
    """
    wanted = list(dict.fromkeys([*equal.values(), *[c for b in bands for c in (b.low, b.high)], *take]))
    side = config.select(*[F.col(c).alias(f"_cfg_{c}") for c in wanted])
    on = F.lit(True)
    for fact, cfg in equal.items():
        on = on & (F.col(fact) == F.col(f"_cfg_{cfg}"))
    for b in bands:
        on = on & (F.col(b.value) >= F.col(f"_cfg_{b.low}")) & (F.col(b.value) < F.col(f"_cfg_{b.high}"))
    joined = facts.join(side, on, how)
    keep = [F.col(c) for c in facts.columns] + [F.col(f"_cfg_{c}").alias(n) for c, n in take.items()]
    return joined.select(*keep)


@dataclass(frozen=True)
class ConfigLevel:
    """One level of a layered lookup: which config rows, matched on which keys."""

    rows: Column
    equal: dict[str, str]
    bands: Sequence[Band] = field(default_factory=tuple)


def layered_lookup(facts: DataFrame, config: DataFrame, levels: Sequence[ConfigLevel], settings: dict[str, Column]) -> DataFrame:
    """Resolve settings from the most specific config level that has a value.

    ``settings`` maps setting columns of the config to the value used when no
    level provides one (a column of the fact table or a literal).
    """
    out = facts
    for i, level in enumerate(levels):
        take = {c: f"_l{i}_{c}" for c in settings}
        out = range_lookup(out, config.filter(level.rows), level.equal, level.bands, take)
    resolved = {
        c: F.coalesce(*[F.col(f"_l{i}_{c}") for i in range(len(levels))], default) for c, default in settings.items()
    }
    return out.withColumns(resolved).drop(*[f"_l{i}_{c}" for i in range(len(levels)) for c in settings])


def canonical(value: Column, synonyms: dict[str, str]) -> Column:
    """Replace synonyms by their canonical word, so equality can hash."""
    out = value
    for word, target in synonyms.items():
        out = F.when(value == word, F.lit(target)).otherwise(out)
    return out


def synonym_join(left: DataFrame, right: DataFrame, on: Sequence[str], column: str, synonyms: dict[str, str], how: str = "left") -> DataFrame:
    """Equi-join where ``column`` matches up to synonyms; the left spelling is kept."""
    key = f"_canon_{column}"
    l = left.withColumn(key, canonical(F.col(column), synonyms))
    r = right.withColumn(key, canonical(F.col(column), synonyms)).drop(column)
    return l.join(r, [*on, key], how).drop(key)


def either_key_join(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]], left_id: Sequence[str], right_id: Sequence[str]) -> DataFrame:
    """Pairs of rows matching on any of several key pairs, each pair once.

    One hash join per key pair, in place of a disjunctive condition that can
    only run as a nested loop. A join leaves out the pairs that an earlier key
    pair matches, so pairs of ids with one row each arise once and need no
    distinct; only pairs with an id of several rows go through one. The right
    rows of a hot key are spread, and the left ones repeated.
    """
    ids = [f"_l{i}" for i in range(len(left_id))], [f"_r{i}" for i in range(len(right_id))]
    keys = [f"_lk{i}" for i in range(len(pairs))], [f"_rk{i}" for i in range(len(pairs))]

    def rows(side: DataFrame, own: int, id_columns: Sequence[str]) -> DataFrame:
        named = [side[c].alias(n) for c, n in zip(id_columns, ids[own])] + [side[p[own]].alias(n) for p, n in zip(pairs, keys[own])]
        return with_group_values(side.select(*named).distinct(), ids[own], **{f"_n{own}": F.count(F.lit(1))})

    l, r = rows(left, 0, left_id), rows(right, 1, right_id)

    def matches(ours: DataFrame, theirs: DataFrame) -> DataFrame:
        out = None
        for i in range(len(pairs)):
            part = salted_join(theirs.withColumn("_on", F.col(keys[1][i])), ours.withColumn("_on", F.col(keys[0][i])), ["_on"], ids[1], key_rows=2_000)
            for j in range(i):
                part = part.filter(~F.coalesce(F.col(keys[0][j]) == F.col(keys[1][j]), F.lit(False)))
            part = part.select(*ids[0], *ids[1])
            out = part if out is None else out.union(part)
        return out

    once = matches(l.filter("_n0 = 1"), r.filter("_n1 = 1"))
    repeated = matches(l.filter("_n0 > 1"), r).union(matches(l.filter("_n0 = 1"), r.filter("_n1 > 1"))).distinct()
    return once.union(repeated).toDF(*left_id, *right_id)


def listed_in(df: DataFrame, codes: DataFrame, list_col: str, code_col: str, separator: str = ",") -> DataFrame:
    """Rows of ``df`` with one row per listed code that exists in ``codes``."""
    split = df.withColumn(code_col, F.explode(F.array_distinct(F.split(list_col, separator))))
    return split.withColumn(code_col, F.trim(code_col)).join(codes, code_col)


def range_candidates(left: DataFrame, right: DataFrame, equal: Sequence[str], left_value: str, right_value: str, within: float) -> DataFrame:
    """Pairs with equal keys and values at most ``within`` apart.

    Values are cut into strips as wide as the threshold. A left row can only
    meet rows of its own strip and the two next to it, so it is copied to those
    three and the join becomes an equi-join; strips with many pairs are split, and
    pairs are dealt out by their number.
    """
    strip = F.floor(F.col(left_value) / within)
    l = cut_lineage(left.withColumn("_strip", F.explode(F.array(strip - 1, strip, strip + 1))))
    r = cut_lineage(right.withColumn("_strip", F.floor(F.col(right_value) / within)))
    joined = paired_join(l, r, [*equal, "_strip"], left.columns).drop("_strip")
    return joined.filter(F.abs(F.col(left_value) - F.col(right_value)) <= within)


def parent_attributes(df: DataFrame, attributes: DataFrame, key: str, parents: dict[str, str], take: Sequence[str], on: Sequence[str] = ()) -> DataFrame:
    """Left join the same attribute table once per parent.

    ``parents`` maps an output prefix to the parent column of ``df``.
    """
    out = df
    for prefix, parent in parents.items():
        side = attributes.select(*on, F.col(key).alias(parent), *[F.col(c).alias(f"{prefix}{c}") for c in take])
        out = out.join(side, [*on, parent], "left")
    return out


def fallback_join(df: DataFrame, levels: Sequence[tuple[str, str, DataFrame]], columns: Sequence[str], source_col: str | None = None) -> DataFrame:
    """Fill ``columns`` from ordered identifier levels; the first non-null wins.

    ``levels`` are (label, key column, table) triples; each table has the key
    and the columns, one row per key. Columns already in ``df`` come first.
    ``source_col`` receives the label of the level that supplied the first of
    ``columns`` (``own`` when the row had it).
    """
    out = df
    own = [c for c in columns if c in df.columns]
    for i, (_, key, table) in enumerate(levels):
        side = table.select(key, *[F.col(c).alias(f"_f{i}_{c}") for c in columns])
        out = out.join(side, key, "left")
    resolved = {}
    for c in columns:
        parts = ([F.col(c)] if c in own else []) + [F.col(f"_f{i}_{c}") for i in range(len(levels))]
        resolved[c] = F.coalesce(*parts)
    if source_col:
        first = columns[0]
        ladder = F.when(F.col(first).isNotNull(), F.lit("own")) if first in own else None
        for i, (label, _, _) in enumerate(levels):
            hit = F.col(f"_f{i}_{first}").isNotNull()
            ladder = ladder.when(hit, F.lit(label)) if ladder is not None else F.when(hit, F.lit(label))
        resolved[source_col] = ladder
    return out.withColumns(resolved).drop(*[f"_f{i}_{c}" for i in range(len(levels)) for c in columns])


def expand_aliases(df: DataFrame, aliases: DataFrame, id_col: str, code_col: str, keys: Sequence[str], value: str) -> DataFrame:
    """Ids that share a code inherit each other's rows; the largest value per key wins.

    The rows of a code are reduced to one maximum per key before they are handed
    to the ids of the code, so ids are never paired with each other.
    """
    coded = aliases.select(id_col, code_col).filter(F.col(code_col).isNotNull()).distinct()
    per_code = df.join(coded, id_col).groupBy(code_col, *keys).agg(F.max(value).alias(value))
    inherited = salted_join(per_code, coded, [code_col], list(keys) or [code_col]).select(id_col, *keys, value)
    own = df.select(id_col, *keys, value)
    return own.unionByName(inherited).groupBy(id_col, *keys).agg(F.max(value).alias(value))


def first_alias_match(df: DataFrame, mapping: DataFrame, key: str, alias_cols: Sequence[str], target: str) -> DataFrame:
    """Map ``key`` to ``target`` through the first alias column that knows it."""
    stacked = mapping.select(
        target, F.posexplode(F.array(*[F.col(c).cast("string") for c in alias_cols])).alias("_priority", "_alias")
    ).filter(F.col("_alias").isNotNull())
    best = top_per_key(stacked, ["_alias"], ["_priority", target])
    return df.join(best.drop("_priority"), df[key].cast("string") == best["_alias"], "left").drop("_alias")


def overlay(df: DataFrame, adjusted: DataFrame, keys: Sequence[str], column: str, adjusted_col: str) -> DataFrame:
    """Replace ``column`` by the adjusted value where there is one."""
    joined = null_safe_join(df, adjusted.select(*keys, F.col(adjusted_col).alias("_adjusted")), keys, "left")
    return joined.withColumn(column, F.coalesce("_adjusted", column)).drop("_adjusted")


def nearest(
    points: DataFrame,
    queries: DataFrame,
    point_id: str,
    query_id: str,
    coordinates: Sequence[str] | str,
    k: int,
    distance: Callable[[np.ndarray, np.ndarray], np.ndarray],
    block_rows: int | None = None,
) -> DataFrame:
    """Exact k nearest points of every query, for a ``distance`` that obeys the triangle inequality.

    ``coordinates`` names the coordinate columns, or one array column; rows
    with a missing coordinate have no neighbours and are nobody's. Points form
    cells around pivots, one pivot per block of points up to 1,024. The
    distances of a cell's k innermost points to their pivot bound how far a
    query's k-th neighbour can be, so a query only visits cells that reach into
    that radius. Cells and their visitors are cut into blocks of about
    ``block_rows``, and blocks meet in pairs; a task returns k rows per query.
    Ties go to the smaller point id. Unless given, blocks have 4,096 rows, and
    more where few cells are left out, among arrays: up to 32,768 or 16 MB.
    Under ``euclidean``, single-precision products leave a few pairs of a block
    (:func:`close_pairs`), and only their distances are computed.
    """
    names = [coordinates] if isinstance(coordinates, str) else list(coordinates)
    stacked = isinstance(coordinates, str)

    def matrix(pdf: pd.DataFrame) -> np.ndarray:
        if stacked:
            return np.stack(pdf[names[0]].to_numpy()).astype(float)
        return pdf[names].to_numpy(dtype=float)

    def whole(df: DataFrame, key: str) -> DataFrame:
        out = df.select(key, *[F.col(c).cast(kind).alias(c) for c in names])
        return out.filter(F.forall(names[0] if stacked else F.array(*names), lambda x: x.isNotNull() & ~F.isnan(x)))

    spark = points.sparkSession
    kind = "array<double>" if stacked else "double"
    query_type, point_type = dict(queries.dtypes)[query_id], dict(points.dtypes)[point_id]
    kinds = ", ".join(f"`{n}` {kind}" for n in names)
    schema = f"`{query_id}` {query_type}, `{point_id}` {point_type}, distance double"
    points, queries = whole(points, point_id), whole(queries, query_id)
    if block_rows is None:
        width = (points.agg(F.max(F.size(names[0]))).first()[0] if stacked else 0) or 0
        block_rows = max(4096, min(32768, 2**21 // width)) if width else 4096

    n_pivots = min(1024, -(-points.count() // block_rows))
    if not n_pivots:
        return spark.createDataFrame([], f"{schema}, rank int")
    # at most 1,024 rows reach the driver; which rows they are only changes the work, not the result
    pivots = matrix(points.orderBy(F.xxhash64(point_id), point_id).limit(n_pivots).toPandas())

    def to_cells(batches):
        for pdf in batches:
            for a in range(0, len(pdf), 1024):
                part = pdf.iloc[a:a + 1024]
                d = distance(matrix(part), pivots)
                cell = d.argmin(axis=1)
                yield part.assign(_cell=cell.astype(np.int32), _inner=d[np.arange(len(d)), cell])

    placed = cut_lineage(points.mapInPandas(to_cells, f"`{point_id}` {point_type}, {kinds}, _cell int, _inner double"))
    sizes = placed.groupBy("_cell").agg(F.count(F.lit(1)).alias("_n"), F.min("_inner").alias("_low"), F.max("_inner").alias("_high"))
    sizes = cut_lineage(sizes)
    innermost = top_per_key(placed.select("_cell", "_inner", point_id), ["_cell"], ["_inner", point_id], k, rank_col="_rank")
    cells, inner = sizes.toPandas(), innermost.toPandas()  # one row, and k rows, per pivot
    low, high = np.full(n_pivots, np.inf), np.full(n_pivots, -np.inf)
    low[cells["_cell"]], high[cells["_cell"]] = cells["_low"], cells["_high"]
    at, spread = inner["_cell"].to_numpy(), inner["_inner"].to_numpy()

    def to_visits(batches):
        for pdf in batches:
            for a in range(0, len(pdf), 256):
                part = pdf.iloc[a:a + 256]
                d = distance(matrix(part), pivots)
                if len(at) >= k:
                    reach = np.partition(d[:, at] + spread, k - 1, axis=1)[:, k - 1]
                else:
                    reach = np.full(len(d), np.inf)
                reach = reach * (1 + 1e-9) + 1e-6  # rounding of the distances
                near = np.maximum(d - high, low - d) <= reach[:, None]
                yield part.assign(_cells=[np.flatnonzero(row).astype(np.int32) for row in near])

    # written with the list of its cells, a query's coordinates are not repeated for each
    visits = cut_lineage(queries.mapInPandas(to_visits, f"`{query_id}` {query_type}, {kinds}, _cells array<int>"))
    visits = visits.withColumn("_cell", F.explode("_cells")).drop("_cells")

    def blocks_of(n: str) -> Column:
        return F.ceil(F.col(n) / block_rows).cast("int")

    visitors = visits.groupBy("_cell").agg(F.count(F.lit(1)).alias("_visits"))
    plan = sizes.join(visitors, "_cell").select("_cell", blocks_of("_n").alias("_pn"), blocks_of("_visits").alias("_qn"))
    plan = cut_lineage(plan)  # one row per pivot

    def blocked(df: DataFrame, key: str, own: str, own_n: str, other: str, other_n: str) -> DataFrame:
        out = df.join(F.broadcast(plan), "_cell").withColumn(own, F.pmod(F.xxhash64(key), F.col(own_n)).cast("int"))
        return out.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(other_n) - 1))).drop("_pn", "_qn")

    pair = ["_cell", "_pb", "_qb"]
    left = blocked(visits, query_id, "_qb", "_qn", "_pb", "_pn").groupBy(*pair)
    right = blocked(placed.drop("_inner"), point_id, "_pb", "_pn", "_qb", "_qn").groupBy(*pair)

    def best(asked: pd.DataFrame, there: pd.DataFrame) -> pd.DataFrame:
        there = there.sort_values(point_id, ignore_index=True)  # equal distances then stand in order of their ids
        found = []
        places, ids = (matrix(there) if len(there) else None), there[point_id].to_numpy()
        if distance is euclidean and len(there):
            own, askers = matrix(asked), asked[query_id].to_numpy()
            for rows, cols in close_pairs(own, places, k):
                d = euclidean_pairs(own, places, rows, cols)
                order = np.lexsort((cols, d, rows))
                order = order[np.arange(len(rows)) - np.searchsorted(rows, rows) < k]  # rows come in order
                found.append(pd.DataFrame({query_id: askers[rows[order]], point_id: ids[cols[order]], "distance": d[order]}))
            return pd.concat(found) if found else pd.DataFrame(columns=[query_id, point_id, "distance"])
        for a in range(0, len(asked) if len(there) else 0, 512):
            part = asked.iloc[a:a + 512]
            d = distance(matrix(part), places)
            order = np.argsort(d, axis=1, kind="stable")[:, :k]
            found.append(
                pd.DataFrame(
                    {
                        query_id: np.repeat(part[query_id].to_numpy(), order.shape[1]),
                        point_id: ids[order.ravel()],
                        "distance": np.take_along_axis(d, order, axis=1).ravel(),
                    }
                )
            )
        return pd.concat(found) if found else pd.DataFrame(columns=[query_id, point_id, "distance"])

    return top_per_key(left.cogroup(right).applyInPandas(best, schema), [query_id], ["distance", point_id], k, rank_col="rank")


def great_circle(a: np.ndarray, b: np.ndarray, radius: float = 6371.0) -> np.ndarray:
    """Distances in km between rows of (latitude, longitude) degrees."""
    la, lb = np.radians(a[:, None, :]), np.radians(b[None, :, :])
    h = np.sin((lb[..., 0] - la[..., 0]) / 2) ** 2
    h = h + np.cos(la[..., 0]) * np.cos(lb[..., 0]) * np.sin((lb[..., 1] - la[..., 1]) / 2) ** 2
    return 2 * radius * np.arcsin(np.sqrt(h))


def euclidean(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        out += (a[:, j][:, None] - b[:, j][None, :]) ** 2
    return np.sqrt(out)


def euclidean_pairs(a: np.ndarray, b: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """The entries of ``euclidean(a, b)`` at the listed places."""
    out = np.zeros(len(rows))
    for j in range(a.shape[1]):
        out += (a[rows, j] - b[cols, j]) ** 2
    return np.sqrt(out)


def close_pairs(a: np.ndarray, b: np.ndarray, k: int, groups: int = 256, at_once: int = 64) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places that hold, for every row of ``a``, its k nearest rows of ``b`` and all that tie with them, and few others.

    Rows of ``a`` are taken ``at_once``, in order. Squared distances come from one
    product in single precision, less the row's own length, which changes no
    order. The columns fall into groups; the k-th smallest of the groups' minima
    bounds the k-th distance, and every pair up to this bound and twice the
    rounding error stays. All pairs stay where single precision can't hold the
    numbers, or there are no more columns than groups.
    """
    n, width = b.shape
    groups = max(groups, 4 * k)
    whole = n - n % groups
    centre = b.mean(axis=0)
    y = b - centre
    ys = np.einsum("ij,ij->i", y, y)
    screened = n > groups and ys.max() < 1e30
    if screened:
        y, ys, longest = np.ascontiguousarray(y.T, dtype=np.float32), ys.astype(np.float32), ys.max()
    for start in range(0, len(a), at_once):
        x = a[start:start + at_once] - centre
        xs = np.einsum("ij,ij->i", x, x)
        if screened and xs.max() < 1e30:
            d = (-2 * x).astype(np.float32) @ y
            d += ys
            lowest = d[:, :whole].reshape(len(x), whole // groups, groups).min(axis=1)
            bound = np.partition(lowest, k - 1, axis=1)[:, k - 1].astype(float)
            error = (width + 8) * 2.0**-23 * (xs + longest) + 1e-30  # more than products, sums and roundings to single precision can lose
            near = d <= np.nextafter((bound + 2 * error).astype(np.float32), np.float32(np.inf))[:, None]
        else:
            near = np.ones((len(x), n), dtype=bool)
        rows, cols = np.divmod(np.flatnonzero(near), n)
        yield start + rows, cols
