"""Per-key selection, totals and running sums that survive a hot key.

* Top rows per key use ``row_number`` with a constant bound. Spark then limits
  every key inside each input partition before the shuffle (WindowGroupLimit).
* Totals per key are aggregated (map-side combined) and joined back; a window
  over the whole key would pull a hot key into one task.
* Running sums work on blocks of the order column: sums inside a block plus
  the total of the blocks before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trialspark.session import cut_lineage, release

#: Tasks over which the pairs of a join are dealt at most.
MOST_TASKS = 2000


def _order(columns: Sequence[str | Column]) -> list[Column]:
    """``-name`` sorts descending, ``name`` ascending; nulls come last."""
    out = []
    for c in columns:
        if isinstance(c, Column):
            out.append(c)
        elif c.startswith("-"):
            out.append(F.col(c[1:]).desc_nulls_last())
        else:
            out.append(F.col(c).asc_nulls_last())
    return out


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], n: int = 1, rank_col: str | None = None) -> DataFrame:
    """The first ``n`` rows of every key under ``order``."""
    w = Window.partitionBy(*keys).orderBy(*_order(order))
    out = df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n)
    return out.withColumnRenamed("_rn", rank_col) if rank_col else out.drop("_rn")


def modes(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The most frequent known value of each column per key, the smallest among equals.

    All columns are counted per value in one pass; only counts are ranked, so no
    task holds the rows of a key. A column without known values reads null.
    """
    place = F.coalesce(*[F.when(F.grouping(c) == 0, F.lit(i)) for i, c in enumerate(columns)])
    counts = df.groupingSets([[*keys, c] for c in columns], *keys, *columns).agg(place.alias("_column"), F.count(F.lit(1)).alias("_n"))
    unknown = F.coalesce(*[F.when(F.col(c).isNotNull(), F.lit(0)) for c in columns], F.lit(1))
    best = top_per_key(counts, [*keys, "_column"], [unknown, "-_n", *columns])
    return best.groupBy(*keys).agg(*[F.max(c).alias(c) for c in columns])


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where a null key meets a null key; keys appear once."""
    other = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    on = None
    for k in keys:
        part = F.col(k).eqNullSafe(F.col(f"__r_{k}"))
        on = part if on is None else on & part
    return left.join(other, on, how).drop(*[f"__r_{k}" for k in keys])


def attach_row(df: DataFrame, row: DataFrame) -> DataFrame:
    """Put the columns of a one-row table beside every row."""
    return df.withColumn("_one", F.lit(1)).join(F.broadcast(row.withColumn("_one", F.lit(1))), "_one").drop("_one")


def numbered(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Number distinct rows from 1 in a global order without sorting them in one task.

    Rows are range-partitioned and numbered per partition; the counts of the
    partitions before it are added. The partitioning is written out first, so
    counts and numbers agree.
    """
    placed = cut_lineage(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_part").orderBy(*_order(order))
    out = placed.withColumn("_rn", F.row_number().over(inside)).join(F.broadcast(offsets), "_part")
    return out.withColumn(name, F.col("_before") + F.col("_rn")).drop("_part", "_rn", "_before")


def positions(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """Place of every row within its key, from 1, in the order of several columns.

    Rows are dealt out by ranges of key and order and written once with the
    number of their range; a key of many rows, or one value that most rows share
    while later columns tell them apart, spreads over tasks.
    """
    ordering = _order(order)
    placed = cut_lineage(df.repartitionByRange(*keys, *ordering).withColumn("_block", F.spark_partition_id()))
    per_block = placed.groupBy(*keys, "_block").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_block.select(*keys, "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy(*keys, "_block").orderBy(*ordering))
    out = null_safe_join(placed.withColumn("_rn", inside), offsets, [*keys, "_block"])
    return out.withColumn(name, F.col("_before") + F.col("_rn")).drop("_block", "_rn", "_before")


def kept_in_order(clashes: DataFrame, items: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """Items kept one after another when they clash with no item kept before; equals under ``order`` go by key.

    ``clashes`` pairs ``key`` with ``_other`` in either direction. In each round,
    items without an undecided earlier neighbour are settled: kept unless a kept
    earlier neighbour exists. This gives the same set as going through them one by
    one. The first undecided item is settled in every round, so rounds end;
    there are as many as the longest chain of waiting items.
    """
    position = cut_lineage(items.select(key, F.struct(*order, F.col(key)).alias("_at")))  # with its size known, it is broadcast if small
    both = clashes.select(key, "_other").unionByName(clashes.select(F.col("_other").alias(key), F.col(key).alias("_other")))
    earlier = cut_lineage(
        both.join(position, key)
        .join(position.select(F.col(key).alias("_other"), F.col("_at").alias("_their")), "_other")
        .filter(F.col("_their") < F.col("_at"))
        .select(key, "_other")
        .distinct()
    )
    state = cut_lineage(position.select(key, F.lit(None).cast("boolean").alias("kept")))
    release(position)
    while True:
        theirs = earlier.join(state.select(F.col(key).alias("_other"), F.col("kept").alias("_k")), "_other")
        view = theirs.groupBy(key).agg(F.bool_or(F.coalesce("_k", F.lit(False))).alias("_blocked"), F.bool_or(F.col("_k").isNull()).alias("_open"))
        joined = state.join(view, key, "left")
        blocked, waiting = F.coalesce("_blocked", F.lit(False)), F.coalesce("_open", F.lit(False))
        settled = F.when(F.col("kept").isNotNull(), F.col("kept")).when(blocked, F.lit(False)).when(~waiting, F.lit(True))
        after = cut_lineage(joined.select(key, settled.alias("kept")))
        release(state)
        state = after
        if state.filter(F.col("kept").isNull()).isEmpty():
            release(earlier)
            return items.join(state.filter("kept").select(key), key, "left_semi")


def with_group_values(df: DataFrame, keys: Sequence[str], **values: Column) -> DataFrame:
    """Attach aggregates of the row's group; values are aggregate expressions."""
    if not keys:
        keyed = df.withColumn("_all", F.lit(1))
        return with_group_values(keyed, ["_all"], **values).drop("_all")
    totals = df.groupBy(*keys).agg(*[v.alias(k) for k, v in values.items()])
    return null_safe_join(df, totals, keys, "left")


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order_col: str,
    sums: dict[str, Column],
    descending: bool = False,
) -> DataFrame:
    """Running sums over the distinct values of ``order_col`` inside each key.

    Returns one row per (key, value) with the tied rows' own sums (``name``) and
    the running sums up to and including them (``cum_name``). ``sums`` maps names
    to per-row expressions. ``order_col`` must be numeric and not null.

    Ties collapse first. The cells are then dealt out by ranges of key and value
    and written once with the number of their range; a key that fills several
    ranges spreads over as many tasks, and one row per key and range carries the
    sums of the ranges before it.
    """
    keys = list(keys)
    work = df
    if not keys:
        keys, work = ["_all"], df.withColumn("_all", F.lit(1))
    names = list(sums)
    cells = work.groupBy(*keys, order_col).agg(*[F.sum(v).alias(k) for k, v in sums.items()])
    placed = cut_lineage(cells.repartitionByRange(*keys, order_col).withColumn("_block", F.spark_partition_id()))
    direction = (lambda c: F.col(c).desc()) if descending else (lambda c: F.col(c).asc())
    per_block = placed.groupBy(*keys, "_block").agg(*[F.sum(n).alias(f"_b_{n}") for n in names])
    before = Window.partitionBy(*keys).orderBy(direction("_block")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_block.select(*keys, "_block", *[F.sum(f"_b_{n}").over(before).alias(f"_o_{n}") for n in names])
    inside = Window.partitionBy(*keys, "_block").orderBy(direction(order_col)).rowsBetween(Window.unboundedPreceding, 0)
    out = placed.withColumns({f"cum_{n}": F.sum(n).over(inside) for n in names})
    out = null_safe_join(out, offsets, [*keys, "_block"], "left")
    out = out.withColumns({f"cum_{n}": F.col(f"cum_{n}") + F.coalesce(F.col(f"_o_{n}"), F.lit(0)) for n in names})
    return out.drop("_block", "_all", *[f"_o_{n}" for n in names])


def group_ranks(df: DataFrame, keys: Sequence[str], order_col: str, descending: bool = False) -> DataFrame:
    """Per (key, value): rows tied, first and last position, and group size.

    ``rank_min`` is SQL ``rank``, ``rank_avg`` the mid-rank used by rank
    correlations and AUC. Built on :func:`running_totals`.
    """
    cum = running_totals(df, keys, order_col, {"n_tied": F.lit(1)}, descending)
    out = cum.withColumns(
        {
            "rank_min": F.col("cum_n_tied") - F.col("n_tied") + 1,
            "rank_max": F.col("cum_n_tied"),
            "rank_avg": F.col("cum_n_tied") - (F.col("n_tied") - 1) / 2,
        }
    ).drop("cum_n_tied")
    return out


def salted_join(big: DataFrame, small: DataFrame, on: Sequence[str], spread_by: Sequence[str], key_rows: int = 500_000, how: str = "inner") -> DataFrame:
    """Join where a key may be hot on the big side.

    The rows of every key of ``big`` are counted. A key of more than
    ``key_rows`` is spread over as many sub-keys as it has that many rows, by a
    hash of ``spread_by``, and only the rows of ``small`` with such a key are
    repeated, once per sub-key. There are at most rows / ``key_rows`` hot keys.
    """
    counts = big.groupBy(*on).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > key_rows)
    hot = counts.select(*on, F.ceil(F.col("_rows") / key_rows).alias("_salts"))
    salts = F.coalesce("_salts", F.lit(1))
    left = big.join(hot, list(on), "left").withColumn("_salt", F.pmod(F.xxhash64(*spread_by), salts)).drop("_salts")
    right = small.join(hot, list(on), "left").withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), salts - 1))).drop("_salts")
    return left.join(right, [*on, "_salt"], how).drop("_salt")


def paired_join(big: DataFrame, small: DataFrame, on: Sequence[str], spread_by: Sequence[str], how: str = "inner", pairs_at_once: int = 2_000_000) -> DataFrame:
    """Join whose result is much larger than its sides, dealt out by pairs and not by bytes.

    Small sides of a join with many pairs would be broadcast, or their shuffle
    packed into a few tasks, which then make all pairs. Here the pairs of every key
    are counted from its rows on both sides. A key of more than ``pairs_at_once`` is
    cut into sub-keys by a hash of ``spread_by`` with the rows of ``small`` repeated
    for each, and there are as many tasks as there are so many pairs, up to
    ``MOST_TASKS``. Give both sides as written tables: they are read twice.
    """
    on = list(on)
    ours = big.groupBy(*on).agg(F.count(F.lit(1)).alias("_rows"))
    theirs = small.groupBy(*on).agg(F.count(F.lit(1)).alias("_others"))
    sizes = ours.join(theirs, on).withColumn("_pairs", F.col("_rows") * F.col("_others"))
    sizes = cut_lineage(sizes.withColumn("_salts", F.least("_rows", F.ceil(F.col("_pairs") / pairs_at_once))))
    work = sizes.agg(F.sum(F.col("_pairs") + F.col("_rows") + F.col("_others"))).first()[0] or 0
    hot = sizes.filter("_salts > 1").select(*on, "_salts")
    tasks = max(1, min(MOST_TASKS, -(-work // pairs_at_once)))
    salts = F.coalesce("_salts", F.lit(1).cast("bigint"))
    left = big.join(hot, on, "left").withColumn("_salt", F.pmod(F.xxhash64(*spread_by), salts)).drop("_salts")
    right = small.join(hot, on, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), salts - 1))).drop("_salts")
    left, right = (side.repartition(tasks, *on, "_salt") for side in (left, right))
    return left.join(right.hint("merge"), [*on, "_salt"], how).drop("_salt")


def fill_in_order(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str], backward_too: bool = True) -> DataFrame:
    """Fill nulls from the previous row of the key, then from the next one.

    Rows are dealt out by ranges of key and order, written once with the number
    of their range, and ordered inside a range only; the nearest known values of
    the other ranges of a key are carried in from one row per range. Rows without
    an order value come last.
    """
    ordering = _order(order)
    rows = cut_lineage(df.repartitionByRange(*keys, *ordering).withColumn("_block", F.spark_partition_id()))
    at = F.struct(*[F.struct(F.col(o).isNull().alias("n"), F.col(o).alias("v")) for o in order])
    ends = []
    for c in columns:
        known = F.col(c).isNotNull()
        ends += [F.max_by(c, F.when(known, at)).alias(f"_last_{c}"), F.min_by(c, F.when(known, at)).alias(f"_first_{c}")]
    per_block = rows.groupBy(*keys, "_block").agg(*ends)
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy(*keys).orderBy("_block").rowsBetween(1, Window.unboundedFollowing)
    near = []
    for c in columns:
        near += [F.last(f"_last_{c}", ignorenulls=True).over(before).alias(f"_in_{c}"), F.first(f"_first_{c}", ignorenulls=True).over(after).alias(f"_out_{c}")]
    rows = null_safe_join(rows, per_block.select(*keys, "_block", *near), [*keys, "_block"])
    back = Window.partitionBy(*keys, "_block").orderBy(*ordering).rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy(*keys, "_block").orderBy(*ordering).rowsBetween(0, Window.unboundedFollowing)

    def value(c: str) -> Column:
        prior = F.coalesce(F.last(c, ignorenulls=True).over(back), F.col(f"_in_{c}"))
        return F.coalesce(prior, F.first(c, ignorenulls=True).over(ahead), F.col(f"_out_{c}")) if backward_too else prior

    filled = rows.withColumns({f"_v_{c}": value(c) for c in columns})
    return filled.select(*[F.col(f"_v_{c}").alias(c) if c in columns else F.col(c) for c in df.columns])


def most_frequent_latest(df: DataFrame, keys: Sequence[str], value: str, order: str) -> DataFrame:
    """Per key the value seen most often; among equals the one seen last, then the smallest."""
    counted = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n_seen"), F.max(order).alias("last_seen"))
    return top_per_key(counted, keys, ["-n_seen", "-last_seen", value])


def drop_all_flagged_groups(df: DataFrame, keys: Sequence[str], flag: str) -> DataFrame:
    """Drop groups in which every row carries ``flag``."""
    keep = df.groupBy(*keys).agg(F.bool_and(F.coalesce(F.col(flag), F.lit(False))).alias("_all_flagged"))
    return null_safe_join(df, keep.filter("not _all_flagged").drop("_all_flagged"), keys, "left_semi")


def keep_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key occurs exactly once."""
    single = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n = 1").drop("_n")
    return null_safe_join(df, single, keys, "left_semi")


def keep_supported(df: DataFrame, keys: Sequence[str], condition: Column) -> DataFrame:
    """Rows of groups that satisfy an aggregate ``condition`` (minimum support)."""
    passing = df.groupBy(*keys).agg(condition.alias("_ok")).filter("_ok").drop("_ok")
    return null_safe_join(df, passing, keys, "left_semi")
