"""Exact duplicates through an extendible-hash index on shared files."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialspark.llm.common import SPACES, cut_lineage

#: Keys of chains with several rows are broadcast up to this many (8 bytes each).
BROADCAST_KEYS = 1_000_000


def directory(entries: DataFrame, capacity: int = 50_000, max_depth: int = 24) -> tuple[int, np.ndarray]:
    """Depth and bucket of every directory cell, a cell being a prefix of the 64-bit key.

    The directory doubles while a bucket holds more than ``capacity`` entries;
    a bucket that is not overfull keeps its local depth and is shared by several
    cells. The driver sees one count per cell: at most ``2 ** max_depth``, and
    about four times the number of entries over ``capacity``. An overfull bucket
    at ``max_depth`` becomes a chain; it stays whole.
    """
    total = entries.count()
    depth = min(max_depth, max(0, math.ceil(math.log2(max(1, total / capacity)))))
    while True:
        counts = np.zeros(1 << depth, np.int64)
        for row in entries.groupBy(cell(depth).alias("c")).agg(F.count(F.lit(1)).alias("n")).toLocalIterator():
            counts[row["c"]] = row["n"]
        if counts.max(initial=0) <= capacity or depth == max_depth:
            break
        depth += 1
    bucket = np.arange(1 << depth)
    width, held = 1, counts
    while width < len(bucket):
        held = held.reshape(-1, 2)
        joined = np.flatnonzero(held.sum(axis=1) <= capacity)
        width *= 2
        whole = np.zeros(len(held), bool)
        whole[joined] = True
        # two buddies merge only where each is one bucket already
        first = bucket.reshape(-1, width)
        single = (first[:, : width // 2] == first[:, :1]).all(1) & (first[:, width // 2 :] == first[:, width // 2 : width // 2 + 1]).all(1)
        take = whole & single
        first[take] = first[take, :1]
        held = held.sum(axis=1)
    return depth, bucket


def cell(depth: int):
    """Directory cell of column ``key``: its first ``depth`` bits."""
    return F.shiftrightunsigned("key", 64 - depth).cast("int") if depth else F.lit(0)


def build_index(rows: DataFrame, capacity: int = 50_000) -> DataFrame:
    """Index entries ``bucket, cell, key, sha, n, keep`` in shared files, one per distinct digest.

    Copies are counted where they are read, so a hot text is one entry per task
    before the shuffle. Owner tasks take ranges of cells and write their buckets
    sorted by key; entries of one key follow each other as its chain.
    """
    entries = cut_lineage(rows.groupBy("key", "sha").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("keep")))
    depth, bucket = directory(entries, capacity)
    spark = rows.sparkSession
    cells = spark.createDataFrame([(int(i), int(b)) for i, b in enumerate(bucket)], "cell int, bucket int")
    placed = entries.withColumn("cell", cell(depth)).join(F.broadcast(cells), "cell")
    return cut_lineage(placed.repartitionByRange("cell", "key").sortWithinPartitions("bucket", "key", "sha"))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 50_000) -> DataFrame:
    """One row per row of ``docs``: ``id, sha, n_bytes, keep, group_size, kept``.

    Texts are compared after replacing each run of white space by one space; null
    counts as empty. Of equal texts the smallest id stays, a null id only where
    no other has the text; rows that repeat both id and text all stay with it.
    Empty tables give no rows. Other columns of ``docs`` are not read.

    Rows are hashed once and kept as slim records. The index finds chains with
    more than one row; only these texts are read again and grouped by their
    bytes. A digest that stood for two texts would end the run.
    """
    text = F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), SPACES, " ")
    texts = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    keyed = texts.select("id", "text", F.xxhash64("text").alias("key"))
    rows = cut_lineage(
        keyed.select("id", "key", F.unhex(F.sha2("text", 256)).alias("sha"), F.octet_length("text").cast("long").alias("n_bytes"))
    )
    index = build_index(rows, capacity)
    chains = cut_lineage(index.groupBy("key").agg(F.sum("n").alias("rows")).filter("rows > 1").select("key"))
    few = chains.count() <= BROADCAST_KEYS
    again = keyed.join(F.broadcast(chains) if few else chains, "key", "left_semi")
    same = again.groupBy("key", "text").agg(F.min("id").alias("keep"), F.count(F.lit(1)).alias("n"))
    compared = (
        same.select("key", F.unhex(F.sha2("text", 256)).alias("sha"), "keep", "n")
        .groupBy("key", "sha")
        .agg(F.min("keep").alias("keep"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("texts"))
    )
    clash = F.raise_error(F.lit("two texts share a digest")).cast("long")
    groups = compared.select("key", "sha", "keep", F.when(F.col("texts") > 1, clash).otherwise(F.col("n")).alias("n")).filter("n > 1")
    out = rows.join(groups, ["key", "sha"], "left")
    alone = F.col("n").isNull()
    return out.select(
        "id",
        F.lower(F.hex("sha")).alias("sha"),
        "n_bytes",
        F.when(alone, F.col("id")).otherwise(F.col("keep")).alias("keep"),
        F.when(alone, F.lit(1)).otherwise(F.col("n")).cast("long").alias("group_size"),
        F.when(alone, F.lit(True)).otherwise(F.col("id").eqNullSafe(F.col("keep"))).alias("kept"),
    )
