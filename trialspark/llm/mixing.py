"""Mixing sources to target weights: hierarchical token budgets and seeded epochs, in DataFrame operations only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trialspark.llm.common import cut_lineage, put_aside

#: Rows of a leaf in one block of its epoch order, on average.
BLOCK_ROWS = 4096
#: Leaves are sent to all tasks up to this many, and joined by shuffle beyond.
BROADCAST_LEAVES = 100_000


def word_count(text: Column) -> Column:
    """Words of a text between white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def leaf_budgets(supply: DataFrame, levels: Sequence[str], weights: dict[tuple, float], budget: float, epochs: int) -> DataFrame:
    """``supply`` with the token budget of every leaf of the tree spanned by ``levels``.

    ``supply`` has one row per leaf with its ``tokens``. A leaf can give its
    tokens ``epochs`` times. From the top down each node's budget is shared among
    its children by weight (1 unless ``weights`` names the path); a child that
    cannot give its share gives all it can, and its siblings take up the rest by
    their weights. A node's budget is cut to what all its leaves can give before
    it is passed down: so a shortage reaches the ancestors, and through them the
    other branches, only when the siblings are used up. Leaves without tokens
    get 0; a weight of 0 or less gives 0 to all that lies below it.
    """
    able = F.col("tokens").cast("double") * epochs
    by_level = {}
    for depth in range(1, len(levels) + 1):
        weight = F.lit(1.0)
        for names, w in sorted((k, v) for k, v in weights.items() if len(k) == depth):
            fits = F.lit(True)
            for level, name in zip(levels, names):
                fits = fits & F.col(level).eqNullSafe(F.lit(name))
            weight = F.when(fits, F.lit(float(w))).otherwise(weight)
        by_level[f"_w{depth}"] = weight
        able = F.when(weight > 0, able).otherwise(F.lit(0.0))
    leaves = supply.withColumns({**by_level, "able": able})
    given = leaves.agg(F.least(F.sum("able"), F.lit(float(budget))).alias("given"))
    for depth in range(1, len(levels) + 1):
        path, parent = list(levels[:depth]), list(levels[: depth - 1])
        nodes = leaves.groupBy(*path).agg(F.sum("able").alias("able"), F.greatest(F.max(f"_w{depth}"), F.lit(0.0)).alias("w"))
        nodes = null_safe(nodes, given, parent) if parent else nodes.crossJoin(F.broadcast(given))
        # children by how soon they are used up: the first give all they can, the others share by weight
        nodes = nodes.withColumn("use", F.when(F.col("w") > 0, F.col("able") / F.col("w")).otherwise(F.lit(0.0)))
        family = Window.partitionBy(*(parent or [F.lit(1)]))
        order = family.orderBy("use", *[F.col(p).asc_nulls_first() for p in path])
        used = F.coalesce(F.sum("able").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
        left = F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing))
        nodes = nodes.withColumn("at", F.when(left > 0, (F.col("given") - used) / left).otherwise(F.lit(0.0)))
        # the water stands where the first child that is not used up has it
        nodes = nodes.withColumn("stands", F.max(F.when(F.col("at") < F.col("use"), F.col("at"))).over(family))
        share = F.when(F.col("stands").isNull(), F.col("able")).otherwise(F.least(F.col("able"), F.col("w") * F.col("stands")))
        given = nodes.select(*path, share.alias("given"))
    return null_safe(supply, given.withColumnRenamed("given", "budget"), levels)


def null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` where a null meets a null; keys appear once."""
    other = right.withColumnsRenamed({k: f"__{k}" for k in keys})
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return left.join(other, on, how).drop(*[f"__{k}" for k in keys])


def mix(
    docs: DataFrame,
    domain: Column,
    weights: dict[tuple, float] | None = None,
    share: float = 0.5,
    epochs: int = 2,
    seed: int = 7,
    id_col: str = "doc_id",
    text_col: str = "text",
    language_col: str = "lang",
    source_col: str = "source",
) -> DataFrame:
    """Rows of ``docs`` with ``mix_domain, mix_tokens, mix_copies``: how often each row is taken.

    The budget is ``share`` of all tokens (words between white space), divided
    over the domain, language and source of the rows (:func:`leaf_budgets`). A
    leaf gives its rows epoch by epoch: whole epochs first, then a prefix of one
    more, in an order seeded by ``seed`` and the number of that epoch. The prefix
    ends before the row that would reach past the budget. Null ids, texts and
    levels are values of their own; rows without tokens are taken as their place
    has it; equal rows are taken together. Empty tables give no rows. Columns of
    ``docs`` named like the added ones are replaced by them; all others are kept
    whatever their names.

    The order is the MD5 of seed, epoch, id and text. A leaf is cut into blocks
    along its order, by its number of rows; blocks are summed first, so only the
    block that holds the end of the prefix is ordered row by row. What comes of
    it is one block and one place in it for each leaf, with which every row
    decides for itself.
    """
    levels = ["mix_domain", language_col, source_col]
    docs, names = put_aside(docs, "_mix", "__", replaced=("mix_domain", "mix_tokens", "mix_copies"))
    rows = docs.withColumns({"mix_domain": domain, "mix_tokens": word_count(F.col(text_col))})
    digest = F.md5(F.coalesce(F.col(text_col), F.lit("")))
    slim = cut_lineage(rows.select(F.col(id_col).cast("string").alias("_mix_id"), digest.alias("_mix_text"), *levels, "mix_tokens"))
    supply = cut_lineage(slim.groupBy(*levels).agg(F.sum("mix_tokens").alias("tokens"), F.count(F.lit(1)).alias("n_rows")))
    total = supply.agg(F.sum("tokens")).first()[0] or 0
    leaves = leaf_budgets(supply, levels, weights or {}, total * share, epochs)
    whole = F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(F.lit(0)).cast("int")
    leaves = leaves.withColumn("_mix_whole", F.least(whole, F.lit(epochs)))
    leaves = leaves.withColumn("_mix_rest", F.floor(F.col("budget") - F.col("_mix_whole") * F.col("tokens")).cast("long"))
    leaves = leaves.withColumn("_mix_blocks", F.ceil(F.col("n_rows") / F.lit(BLOCK_ROWS)).cast("long"))
    leaves = cut_lineage(leaves.select(*levels, "_mix_whole", "_mix_rest", "_mix_blocks"))
    few = leaves.count() <= BROADCAST_LEAVES
    at_hand = F.broadcast if few else (lambda table: table)

    ident = F.concat_ws(":", F.lit(str(seed)), F.col("_mix_whole").cast("string"), F.coalesce("_mix_id", F.lit("")), F.col("_mix_text"))
    block = F.floor(F.conv(F.substring("_mix_order", 1, 8), 16, 10).cast("long") * F.col("_mix_blocks") / F.lit(float(1 << 32))).cast("long")
    known = null_safe(slim, at_hand(leaves), levels).withColumn("_mix_order", F.md5(ident)).withColumn("_mix_block", block)
    sums = known.groupBy(*levels, "_mix_rest", "_mix_block").agg(F.sum("mix_tokens").alias("held"))
    upto = F.coalesce(F.sum("held").over(Window.partitionBy(*levels).orderBy("_mix_block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ends = sums.withColumn("_mix_before", upto).filter(F.col("_mix_before") + F.col("held") > F.col("_mix_rest"))
    ends = cut_lineage(ends.groupBy(*levels).agg(F.min("_mix_block").alias("_mix_end"), F.min("_mix_before").alias("_mix_before")))
    last = null_safe(known, at_hand(ends), levels).filter(F.col("_mix_block") == F.col("_mix_end"))
    along = Window.partitionBy(*levels).orderBy("_mix_order")
    fits = F.col("_mix_before") + F.sum("mix_tokens").over(along) <= F.col("_mix_rest")
    upto_row = last.select(*levels, "_mix_order", fits.alias("fits")).filter("fits").groupBy(*levels).agg(F.max("_mix_order").alias("_mix_upto"))
    plan = null_safe(null_safe(leaves, ends, levels, "left"), upto_row, levels, "left")
    plan = cut_lineage(plan.select(*levels, "_mix_whole", "_mix_blocks", "_mix_end", "_mix_upto"))

    own = rows.withColumns({"_mix_id": F.col(id_col).cast("string"), "_mix_text": digest})
    own = null_safe(own, at_hand(plan), levels).withColumn("_mix_order", F.md5(ident)).withColumn("_mix_block", block)
    at_end = (F.col("_mix_block") == F.col("_mix_end")) & F.coalesce(F.col("_mix_order") <= F.col("_mix_upto"), F.lit(False))
    taken = F.col("_mix_end").isNull() | (F.col("_mix_block") < F.col("_mix_end")) | at_end
    more = F.when((F.col("_mix_whole") < epochs) & taken, F.lit(1)).otherwise(F.lit(0))
    out = own.withColumn("mix_copies", F.col("_mix_whole") + more)
    return out.select(*[F.col(f"`{c}`").alias(names.get(c, c)) for c in rows.columns], "mix_copies")
