"""Entries against checks: pairing, co-occurrence statistics, regional scoring."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trialspark.functions import scoring as S
from trialspark.functions.probability import f_tail_of_log, log_f_percent, log_normal_percent
from trialspark.operators.aggregates import correlation
from trialspark.operators.keyed import null_safe_join, paired_join
from trialspark.session import cut_lineage

#: Entries and checks multiplied at once, cells of a block, trials multiplied at once, and tasks over which pairs of blocks are dealt at most.
PAIR_TILE, TILE_ROWS, TRIALS_AT_ONCE, MOST_TASKS = 512, 500_000, 1024, 2000
#: Pairs of two blocks, at least and at most, and pairs of blocks that are enough; more of them let cells travel more often.
TILE_PAIRS, ENOUGH_TILES = (50_000, 32_000_000), 64
#: Entries and checks of a block of regional scores, and pairs of one kind from which a curve of the F tail is worth its making.
SCORE_TILE, LEAST_FOR_CURVE = 4096, 1024


def pair_with_checks(df: DataFrame, group: Sequence[str], entry: str, flag: str, take: Sequence[str], how: str = "inner") -> DataFrame:
    """Every row beside every check row of its group; check columns get the prefix ``check_``.

    ``df`` must already hold one row per group and entry; it is written out once.
    Pairs are dealt out by their number. Checks are few, so they are the side that
    is repeated while the entries of a large group spread over tasks.
    """
    df = cut_lineage(df)
    checks = df.filter(F.col(flag)).select(
        *group, F.col(entry).alias(f"check_{entry}"), *[F.col(c).alias(f"check_{c}") for c in take]
    )
    return paired_join(df, checks, group, [entry], how)


def _moments(df: DataFrame, keys: Sequence[str], value: str, flag: str) -> DataFrame:
    x = F.col(value)
    return df.groupBy(*keys).agg(
        F.count(x).alias("_n"), F.avg(x).alias("_mean"), (F.var_pop(x) * F.count(x)).alias("_m2"), F.bool_or(flag).alias("_flag")
    )


def _products(cells: tuple[np.ndarray, ...], met: np.ndarray, n_rows: int, n_columns: int, n_trials: int) -> tuple[np.ndarray, ...]:
    """Count, mean and sample deviation of the rows' values in the trials of every column.

    ``cells`` holds row, trial, count, mean and squared deviation per cell, sorted
    by trial, ``met`` the (trial, column) places, sorted too. Sums over trials are
    products of matrices, a few trials at a time; squares are of values less their
    common mean.
    """
    row, at, n, mean, m2 = cells
    finite = np.isfinite(mean)
    level = mean[finite].mean() if finite.any() else 0.0
    off = np.where(finite, mean - level, 0.0)
    parts = [n, np.where(finite, n * mean, 0.0), n * off, np.where(finite, m2 + n * off * off, 0.0)]
    odd = None if finite.all() else [np.isnan(mean), np.isposinf(mean), np.isneginf(mean)]
    sums = np.zeros((7 if odd else 4, n_rows, n_columns))
    for first in range(0, n_trials, TRIALS_AT_ONCE):
        last = first + TRIALS_AT_ONCE
        i, j = np.searchsorted(at, [first, last])
        k, m = np.searchsorted(met[0], [first, last])
        if i == j or k == m:
            continue
        rows, r = np.unique(row[i:j], return_inverse=True)
        columns, c = np.unique(met[1][k:m], return_inverse=True)
        grown = np.zeros((min(last, n_trials) - first, len(columns)))
        grown[met[0][k:m] - first, c] = 1.0
        for s, part in zip(sums, [*parts, *(odd or [])]):
            dense = np.zeros((len(rows), len(grown)))
            dense[r, at[i:j] - first] = part[i:j]
            s[np.ix_(rows, columns)] += dense @ grown
    with np.errstate(divide="ignore", invalid="ignore"):
        count, off = sums[0], sums[2]
        prediction = sums[1] / count
        stddev = np.sqrt(np.maximum(0.0, sums[3] - off * off / count) / (count - 1))
    if odd:
        gone, up, down = sums[4:] > 0
        prediction = np.where(gone | (up & down), np.nan, np.where(up, np.inf, np.where(down, -np.inf, prediction)))
        stddev = np.where(gone | up | down, np.nan, stddev)
    return count, prediction, stddev


def _block(table: pa.Table, entry: str, trial: str, together: Sequence[str], breakout: Sequence[str], trials: pa.Array, step: int):
    """Names of a block's entries, and per value of ``together`` and steps of so many entries their cells per breakout and the (trial, entry) places where they grew."""
    coded = table.column(entry).combine_chunks().dictionary_encode()
    at = pc.fill_null(pc.index_in(table.column(trial), value_set=trials), -1).to_numpy().astype(np.int64)
    order = np.argsort(at, kind="stable")
    order = order[at[order] >= 0]
    who = coded.indices.to_numpy()[order].astype(np.int64)
    order, who = (x[np.argsort(who // step, kind="stable")] for x in (order, who))
    at = at[order]
    numbers = [pc.fill_null(table.column(c), 0.0).to_numpy()[order] for c in ("_n", "_mean", "_m2")]
    steps = np.arange(1, -(-len(coded.dictionary) // step))

    def split(columns: Sequence[str], rows: np.ndarray) -> dict[tuple, np.ndarray]:
        if not columns:
            return {(): rows}
        parts = [table.column(c).combine_chunks().dictionary_encode() for c in columns]
        codes = np.stack([pc.fill_null(p.indices, -1).to_numpy()[order[rows]] for p in parts])
        named = np.flatnonzero((codes >= 0).all(axis=0))
        found, which = np.unique(codes[:, named], axis=1, return_inverse=True)
        return {tuple(p.dictionary[int(c)].as_py() for p, c in zip(parts, found[:, k])): rows[named[which.ravel() == k]] for k in range(found.shape[1])}

    def stepped(rows: np.ndarray) -> list[np.ndarray]:
        return np.split(rows, np.searchsorted(who[rows] // step, steps))

    out = {}
    for t, rows in split(together, np.arange(len(order))).items():
        grown = []
        for own in stepped(rows):
            grown.append(np.stack(np.divmod(np.unique(at[own] * step + who[own] % step), step)))
        cells = {b: [(who[own] % step, at[own], *(x[own] for x in numbers)) for own in stepped(some)] for b, some in split(breakout, rows).items()}
        out[t] = (grown, cells)
    return coded.dictionary, out


def _meetings(left: pa.Table, right: pa.Table, entry: str, trial: str, together: Sequence[str], breakout: Sequence[str], more_than: int, step: int):
    """For every ``step`` entries and checks the places of the pairs that met often enough, with both sides' statistics, by value of ``together`` and breakout."""
    trials = pc.unique(right.column(trial))
    names, ours = _block(left, entry, trial, together, breakout, trials, step)
    check_names, theirs = _block(right, entry, trial, together, breakout, trials, step)
    for a in range(0, len(names), step):
        for c in range(0, len(check_names), step):
            i, j = a // step, c // step
            n, m = min(step, len(names) - a), min(step, len(check_names) - c)
            met = []
            for t in sorted(ours.keys() & theirs.keys(), key=str):
                (grown, cells), (check_grown, check_cells) = ours[t], theirs[t]
                for b in sorted(cells.keys() & check_cells.keys(), key=str):
                    own = _products(cells[b][i], check_grown[j], n, m, len(trials))
                    other = [x.T for x in _products(check_cells[b][j], grown[i], m, n, len(trials))]
                    found = np.nonzero((own[0] > more_than) & (other[0] > more_than))
                    met.append(((*t, *b), *found, *(x[found] for x in (*own, *other))))
            yield names[a:a + step], check_names[c:c + step], met


def with_stability_rows(plots: DataFrame, trial: str, trait: str, value: str, is_yield: Column, metric: str = "metric_name") -> DataFrame:
    """Add for every row of a yield trait one of the metric ``stability``: what its value differs from its trial's mean.

    The deviations of an entry spread as its yields do inside trials, whatever the
    trials' own levels; their spread is what the stability test compares.
    """
    means = plots.filter(is_yield).groupBy(trial, trait).agg(F.avg(value).alias("_mean"))
    beside = null_safe_join(plots, F.broadcast(means), [trial, trait], "left")  # one pass gives both rows
    row = lambda v, m: F.struct(v.cast("double").alias(value), m.cast("string").alias(metric))
    both = F.array(row(F.col(value), F.col(metric)), F.when(is_yield, row(F.col(value) - F.col("_mean"), F.lit("stability"))))
    rows = beside.withColumn("_row", F.explode(F.array_compact(both)))
    return rows.select(*[F.col("_row")[c].alias(c) if c in (value, metric) else F.col(c) for c in plots.columns])


def co_occurrence(
    plots: DataFrame,
    group: Sequence[str],
    trial: str,
    entry: str,
    value: str,
    flag: str,
    breakout: Sequence[str] = (),
    more_than: int = 2,
    together: Sequence[str] = (),
) -> DataFrame:
    """Entry and check statistics over the trials in which both were grown.

    For an entry and a check of one group, the entry's values count in trials
    that grew the check, and the check's values in trials that grew the entry;
    both sides need more than ``more_than`` values.

    Plots are reduced to one row of moments per trial and entry, which are
    written out once. The entries of a group and its checks are dealt into blocks
    by hash, as many as their cells and pairs ask for; one task holds a block of
    entries and a block of checks with all their trials and gives the statistics
    of their pairs, a few entries and checks at a time, as products of small
    matrices. So no row per trial and pair is ever made or shuffled; a cell
    travels once per block that it meets.

    Groups that differ only in the columns ``together`` meet in the same task,
    and the rows of one entry and check follow one another (for
    :func:`trialspark.operators.rollup.rollup_head_to_head`).
    """
    place = [*group, trial]
    known = [F.col(c).isNotNull() for c in (*place, entry)]
    plots = plots.filter(reduce(and_, known))
    if breakout:  # one deal by entry and trial serves the moments and the flag over all breakouts
        plots = plots.select(*place, *breakout, entry, value, flag).repartition(*place, entry)
    cells = _moments(plots, [*place, *breakout, entry], value, flag)
    if breakout:
        cells = cells.withColumn("_flag", F.bool_or("_flag").over(Window.partitionBy(*place, entry)))
    cells = cut_lineage(cells)
    check = f"check_{entry}"
    moments = [F.col("_n").cast("double").alias("_n"), F.col("_mean").cast("double").alias("_mean"), F.col("_m2").cast("double").alias("_m2")]
    columns = [*[F.col(c).alias(c) for c in (*group, *breakout, trial, entry)], *moments]
    cells, check_cells = cells.select(*columns), cells.filter("_flag").select(*columns)
    together, breakout = list(together), list(breakout)
    apart = [c for c in group if c not in together]

    def counts(side: DataFrame, own: int) -> DataFrame:
        kinds = F.approx_count_distinct(F.xxhash64(*together, *breakout)) if together or breakout else F.lit(1)
        return side.groupBy(*apart).agg(F.count(F.lit(1)).alias(f"_c{own}"), F.approx_count_distinct(entry).alias(f"_e{own}"), kinds.alias(f"_k{own}"))

    sizes = cut_lineage(counts(cells, 0).join(counts(check_cells, 1), apart).withColumn("_pairs", F.col("_e0").cast("double") * F.col("_e1") * F.col("_k0")))
    at_once = min(max((sizes.agg(F.sum("_pairs")).first()[0] or 0) / ENOUGH_TILES, TILE_PAIRS[0]), TILE_PAIRS[1])
    # cells travel least when both sides are repeated alike
    tiles, rows = F.ceil(F.col("_pairs") / at_once), lambda own: F.ceil(F.col(f"_c{own}") / TILE_ROWS)
    sizes = sizes.withColumn("_n1", F.greatest(F.least(F.round(F.sqrt(tiles * F.col("_c1") / F.col("_c0"))), "_e1"), rows(1), F.lit(1)).cast("int"))
    sizes = sizes.withColumn("_n0", F.greatest(F.least(F.ceil(tiles / F.col("_n1")), "_e0"), rows(0), F.lit(1)).cast("int")).select(*apart, "_n0", "_n1")
    tasks = max(1, min(sizes.agg(F.sum(F.col("_n0").cast("bigint") * F.col("_n1"))).first()[0] or 1, MOST_TASKS))
    tile = [*apart, "_b0", "_b1"]

    def dealt(side: DataFrame, own: int) -> DataFrame:
        block = F.pmod(F.xxhash64(entry), F.col(f"_n{own}")).cast("int")
        facing = F.explode(F.sequence(F.lit(0), F.col(f"_n{1 - own}") - 1))
        out = side.join(F.broadcast(sizes), apart).withColumn(f"_b{own}", block).withColumn(f"_b{1 - own}", facing).drop("_n0", "_n1")
        return out.repartition(tasks, *tile)

    types = dict(cells.dtypes)
    kinds = {c: types[c] for c in (*group, *breakout, entry)} | {check: types[entry]}
    numbers = {f"{p}{c}": k for p in ("", "check_") for c, k in (("count", "bigint"), ("prediction", "double"), ("stddev", "double"))}
    schema = ", ".join(f"`{c}` {k}" for c, k in (kinds | numbers).items())
    step = PAIR_TILE if not together else max(1, PAIR_TILE // 4)
    packed = pa.schema([("left", pa.binary()), ("right", pa.binary())])

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        if not (left.num_rows and right.num_rows):
            return packed.empty_table()
        sides = []
        for side in (left, right):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, side.schema) as to:
                to.write_table(side)
            sides.append(pa.array([sink.getvalue().to_pybytes()], pa.binary()))
        return pa.table(sides, schema=packed)

    def pairs(batches):
        for both in (both for batch in batches for both in zip(*batch.columns)):
            left, right = (pa.ipc.open_stream(side.as_buffer()).read_all() for side in both)
            like = left.schema
            fields = [pa.field(c, like.field(entry if c == check else c).type) for c in kinds]
            fields += [pa.field(c, pa.int64() if k == "bigint" else pa.float64()) for c, k in numbers.items()]
            for names, check_names, met in _meetings(left, right, entry, trial, together, breakout, more_than, step):
                tables, places = [], []
                for values, i, j, *found in met:
                    one = dict(zip([*together, *breakout], values)) | {c: left.column(c)[0].as_py() for c in apart}
                    columns = [pa.repeat(pa.scalar(one[c], like.field(c).type), len(i)) for c in (*group, *breakout)]
                    columns += [names.take(pa.array(i)), check_names.take(pa.array(j))]
                    for n, prediction, stddev in (found[:3], found[3:]):
                        columns += [pa.array(n.astype(np.int64)), pa.array(prediction, mask=n < 1), pa.array(stddev, mask=n < 2)]
                    tables.append(pa.table(columns, schema=pa.schema(fields)))
                    places.append(i * len(check_names) + j)
                if tables:
                    out = pa.concat_tables(tables)
                    if together:
                        out = out.take(pa.array(np.argsort(np.concatenate(places), kind="stable")))
                    yield from out.to_batches()

    dealt_out = dealt(cells, 0).groupBy(*tile).cogroup(dealt(check_cells, 1).groupBy(*tile))
    return dealt_out.applyInArrow(meet, "left binary, right binary").mapInArrow(pairs, schema)


def score_against_checks(
    base: DataFrame,
    levels: Sequence[str],
    entry: str,
    flag: str,
    mean: str,
    stddev: str,
    count: str,
) -> DataFrame:
    """Regional scores: ratio-of-means and spread tests against each check, averaged over checks.

    Differences and percents are averaged, scores take the geometric mean.
    Entries of a level without checks keep their mean and null scores.

    All pairs are tested, but none is a row: the entries and the checks of a level
    are dealt into blocks by hash, and one task per pair of blocks returns one
    row of sums per entry.
    """
    me, se, n = S.floored(F.col(mean)), S.floored(F.col(stddev)), F.col(count).cast("double")
    spread = se / me
    terms = {"_m": me, "_v": S.over(spread * spread, n), "_x": 2 * F.log(spread), "_dof": n - 1}
    keys, numbers = [*levels, entry, flag], list(terms)
    base = cut_lineage(base.select(*keys, mean, *[t.alias(c) for c, t in terms.items()]))
    checks = base.filter(flag)
    known = reduce(and_, [F.col(c).isNotNull() for c in levels], F.lit(True))
    columns = [F.col(c).alias(c) for c in (*keys, *numbers)] + [F.col(mean).cast("double").alias("_mean")]
    ours, theirs = base.filter(known).select(*columns), checks.filter(known & F.col(entry).isNotNull()).select(*columns)

    def blocks(side: DataFrame, name: str) -> DataFrame:
        return side.groupBy(*levels).agg(F.ceil(F.count(F.lit(1)) / SCORE_TILE).cast("int").alias(name))

    sizes = cut_lineage(blocks(ours, "_n0").join(blocks(theirs, "_n1"), list(levels)))
    tiles = sizes.agg(F.sum(F.col("_n0").cast("bigint") * F.col("_n1"))).first()[0] or 1
    tile = [*levels, "_b0", "_b1"]

    def dealt(side: DataFrame, own: int) -> DataFrame:
        block = F.pmod(F.xxhash64(entry), F.col(f"_n{own}")).cast("int")
        facing = F.explode(F.sequence(F.lit(0), F.col(f"_n{1 - own}") - 1))
        out = side.join(sizes, list(levels)).withColumn(f"_b{own}", block).withColumn(f"_b{1 - own}", facing)
        return out.drop("_n0", "_n1").repartition(min(tiles, MOST_TASKS), *tile)

    types = dict(base.dtypes)
    sums = ["_copies", "_pct", "_metric", "_metrics", "_stability", "_stabilities"]
    schema = ", ".join([f"`{c}` {types[c]}" for c in keys] + [f"`{c}` double" for c in ("_pairs", *sums)])

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        got = left.select(keys)
        found = np.zeros((1 + len(sums), left.num_rows))
        if left.num_rows and right.num_rows:
            sides = [[pc.fill_null(side.column(c), np.nan).to_numpy() for c in numbers] for side in (left, right)]
            found[0], own = right.num_rows, pc.fill_null(left.column("_mean"), np.nan).to_numpy()
            for _ in range(right.num_rows):  # an entry's own mean counts once per check, summed up as a mean of its pairs is
                found[1] += own
            found[2:] = _score_sums(*sides)
        for name, column in zip(["_pairs", *sums], found):
            got = got.append_column(name, pa.array(column, mask=left.column("_mean").is_null().to_numpy() if name == "_copies" else None))
        return got

    scored = dealt(ours, 0).groupBy(*tile).cogroup(dealt(theirs, 1).groupBy(*tile)).applyInArrow(meet, schema)
    counted = F.sum(F.when(F.col("_copies").isNotNull(), F.col("_pairs"))).alias("_counted")
    total = scored.groupBy(*keys).agg(counted, *[F.sum(c).alias(c) for c in ("_pairs", *sums)])
    there = checks.groupBy(*levels).agg(F.count(mean).alias("_n"), F.sum(mean).alias("_s"))
    both = base.join(there, list(levels), "left") if levels else base.crossJoin(there)
    own = both.groupBy(*keys).agg(
        F.avg(mean).alias("_own"),
        (F.sum(F.col("_n") * F.col(mean) - F.col("_s")) / F.nullif(F.sum(F.when(F.col(mean).isNotNull(), F.col("_n"))), F.lit(0))).alias("yield_diff_vs_chk"),
    )
    out = null_safe_join(own, total, keys, "left")
    return out.select(
        *keys,
        F.coalesce(S.over(F.col("_copies"), F.col("_counted")), F.col("_own")).alias(mean),
        S.over(F.col("_pct"), F.col("_pairs")).alias("yield_pct_chk"),
        "yield_diff_vs_chk",
        F.exp(S.over(F.col("_metric"), F.col("_metrics"))).alias("yield_metric"),
        F.exp(S.over(F.col("_stability"), F.col("_stabilities"))).alias("stability_metric"),
    )


def _score_sums(entries: list[np.ndarray], checks: list[np.ndarray], pairs_at_once: int = 1 << 16) -> np.ndarray:
    """Per entry the sum of percents of the checks, and sum and number of both tests' log scores.

    Scores are read off curves of their logarithm, one for the normal tail and one
    for each pair of degrees of freedom that occurs often, and then bounded.
    Terms that are undefined (NaN) count in no sum.
    """
    low, high = np.log(S.SCORE_MIN), np.log(S.SCORE_MAX)
    mean, variance, x, dof = entries
    check_mean, check_variance, check_x, check_dof = checks
    out = np.zeros((5, len(mean)))

    def add(place: int, rows: np.ndarray | slice, logs: np.ndarray) -> None:
        np.clip(logs, low, high, out=logs)
        total = logs.sum(axis=1)
        n = np.full(len(total), float(logs.shape[1]))
        if np.isnan(total).any():
            n, total = (~np.isnan(logs)).sum(axis=1), np.nansum(logs, axis=1)
        out[place, rows] += total
        out[place + 1, rows] += n

    normal, each = log_normal_percent(), max(1, pairs_at_once // len(check_mean))
    with np.errstate(all="ignore"):
        for a in range(0, len(mean), each):
            rows = slice(a, a + each)
            ratio = mean[rows, None] / check_mean
            sem = np.sqrt(variance[rows, None] + check_variance)
            sem *= ratio
            statistic = ratio - 1
            statistic /= np.where(sem == 0, np.nan, sem)
            ratio *= 100
            out[0, rows] = np.fmin(ratio, S.PERCENT_CAP, out=ratio).sum(axis=1)
            add(1, rows, normal(statistic))
        by_dof = [(d, np.flatnonzero(check_dof == d)) for d in np.unique(check_dof[check_dof > 0])]
        for m in np.unique(dof[dof > 0]):
            alike = np.flatnonzero(dof == m)
            few = []
            for n, them in by_dof:
                if len(alike) * len(them) < LEAST_FOR_CURVE:
                    few.append(them)
                    continue
                curve, each = log_f_percent(m, n), max(1, pairs_at_once // len(them))
                for a in range(0, len(alike), each):
                    add(3, alike[a:a + each], curve(x[alike[a:a + each], None] - check_x[them]))
            few = np.concatenate(few) if few else few
            each = max(1, pairs_at_once // max(1, len(few)))
            for a in range(0, len(alike) if len(few) else 0, each):
                rows = alike[a:a + each]
                p = f_tail_of_log(x[rows, None] - check_x[few], *np.broadcast_arrays(m, np.broadcast_to(check_dof[few], (len(rows), len(few)))))
                add(3, rows, np.log(100 * p))
    return out


def welch_one_sided(df: DataFrame, keys: Sequence[str], value: str, group_flag: str) -> DataFrame:
    """Welch test that flagged rows have the larger mean: t, degrees of freedom and p."""
    from trialspark.functions.probability import t_sf

    yes, no = F.when(F.col(group_flag), F.col(value)), F.when(~F.col(group_flag), F.col(value))
    stats = df.groupBy(*keys).agg(
        *[f(side).alias(f"{name}_{label}")
          for label, side in (("a", yes), ("b", no))
          for name, f in (("n", F.count), ("mean", F.avg), ("var", F.var_samp))]
    )
    va, vb = F.col("var_a") / F.col("n_a"), F.col("var_b") / F.col("n_b")
    t = (F.col("mean_a") - F.col("mean_b")) / F.sqrt(va + vb)
    dof = F.pow(va + vb, 2) / (va * va / (F.col("n_a") - 1) + vb * vb / (F.col("n_b") - 1))
    out = stats.withColumns({"t_stat": t, "dof": dof})
    return out.withColumn("p_value", t_sf(F.col("t_stat"), F.col("dof")))


def correlation_test(df: DataFrame, keys: Sequence[str], x: str, y: str) -> DataFrame:
    """Pearson correlation per group with its two-sided p-value on n - 2 degrees of freedom."""
    from trialspark.functions.probability import t_two_sided

    both = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    out = both.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), correlation(x, y).alias("correlation"))
    r = F.col("correlation")
    out = out.withColumn("t_stat", F.when(F.col("n") > 2, r * F.sqrt((F.col("n") - 2) / F.nullif(1 - r * r, F.lit(0.0)))))
    return out.withColumn("p_value", t_two_sided(F.col("t_stat"), F.col("n") - 2))


def with_mean_interval(df: DataFrame, mean: str, stddev: str, count: str, confidence: float = 0.95) -> DataFrame:
    """Student interval of a mean; counts repeat, so each one's quantile is solved once."""
    from trialspark.functions.probability import t_quantile

    sizes = df.select(F.col(count).alias("_c")).filter("_c > 1").distinct()
    sizes = sizes.withColumn("_t", t_quantile(0.5 + confidence / 2, F.col("_c") - 1))
    half = F.col("_t") * F.col(stddev) / F.sqrt(F.col(count))
    out = df.join(sizes, F.col(count) == F.col("_c"), "left")
    return out.withColumns({"lower": F.col(mean) - half, "upper": F.col(mean) + half}).drop("_c", "_t")
