"""N-gram Jaccard join: points of hashed group counts in R-trees, exact checks of the pairs they leave."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialspark.llm.common import cut_lineage, in_bitmap, mix64, release, runs, slices, slot_bitmap, whole_groups
from trialspark.llm.components import connected_components

#: Groups that shingles are hashed into: the coordinates of a point.
GROUPS = 64
#: Slots in which common shingles are marked.
SLOT_BITS = 22
#: Shingles of one block that are compared in one task; a larger block is cut into tiles of about this size.
TILE_SHINGLES = 1_000_000
#: Classes of one key that are compared in one task.
TILE_POINTS = 4096

_RANDOM = np.random.default_rng(20240229)
#: A random value for each byte, with A-Z as a-z; white space has none.
_BYTES = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64)
_BYTES[65:91] = _BYTES[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_BASE = int(_RANDOM.integers(1 << 62, 1 << 63)) * 2 + 1
_POWERS: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS["up"]) < n:
        size = max(n, 2 * len(_POWERS["up"]))
        for name, base in (("up", _BASE % (1 << 64)), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps)
    return _POWERS["up"], _POWERS["down"]


def shingle_sets(texts: list[str | None], words: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the runs of ``words`` words of each text; of all words where there are fewer."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    flat = np.frombuffer(b"\n".join(raw), np.uint8)
    if not len(flat):
        return [np.zeros(0, np.uint64) for _ in raw]
    blank = _SPACE[flat]
    edge = np.flatnonzero(np.diff(np.r_[True, blank, True].view(np.int8)))
    start, end = edge[::2], edge[1::2]
    up, down = _powers(len(flat) + 1)
    total = np.r_[np.uint64(0), np.cumsum(np.where(blank, np.uint64(0), _BYTES[flat]) * up[: len(flat)])]
    word = mix64((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))
    limits = np.cumsum([len(r) + 1 for r in raw])
    ends = np.searchsorted(start, limits)
    weights = mix64(np.arange(1, words + 1, dtype=np.uint64)) | np.uint64(1)
    n = len(word) - words + 1
    shingle = mix64(sum((word[k : n + k] * weights[k] for k in range(words)), np.zeros(n, np.uint64))) if n > 0 else word[:0]
    out, first = [], 0
    for last in ends.tolist():
        if last - first >= words:
            s = np.sort(shingle[first : last - words + 1])
            out.append(s[np.r_[True, s[1:] != s[:-1]]])
        elif last > first:
            own = word[first:last] * weights[: last - first]
            out.append(mix64(own.sum(keepdims=True) + np.uint64(last - first)))
        else:
            out.append(word[:0])
        first = last
    return out


def class_of(s: np.ndarray) -> int:
    """64-bit name of a set: equal sets are one class."""
    return int(mix64(mix64(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(keepdims=True) + np.uint64(len(s)))[0].astype(np.int64))


def point_of(s: np.ndarray) -> np.ndarray:
    """Number of shingles in each hash group.

    A larger set has more groups, a power of two of about an eighth of its size:
    else sums of minima would say little about it. Points are compared in the
    coarser of their two resolutions.
    """
    groups = max(GROUPS, 1 << max(0, (len(s) // 8 - 1).bit_length()))
    return np.bincount((s & np.uint64(groups - 1)).astype(np.int64), minlength=groups).astype(np.int32)


def packed(point: np.ndarray) -> bytes:
    """A point as bytes: one per count after a 0, or four after a 1 where a count is 256 or more."""
    return b"\0" + point.astype(np.uint8).tobytes() if point.max() < 256 else b"\1" + point.tobytes()


def unpacked(point: bytes) -> np.ndarray:
    return np.frombuffer(point, np.uint8, offset=1).astype(np.int32) if point[0] == 0 else np.frombuffer(point[1:], np.int32)


def folded(point: np.ndarray, groups: int) -> np.ndarray:
    return point if len(point) == groups else point.reshape(-1, groups).sum(axis=0, dtype=np.int32)


class Points:
    """Points of the rows of a table, in full and in the coarsest resolution, with the sizes of their sets."""

    def __init__(self, data: list[bytes]):
        self.fine = [unpacked(p) for p in data]
        self.coarse = np.stack([folded(p, GROUPS) for p in self.fine])
        self.sizes = self.coarse.sum(axis=1, dtype=np.int64)

    def bound(self, i: int, rows: np.ndarray, least: int) -> np.ndarray:
        """Whether the sum of minima, in the resolution of each pair, allows similarity."""
        mine = self.fine[i]
        if len(mine) == GROUPS:
            return np.ones(len(rows), bool)
        out = np.empty(len(rows), bool)
        for k, j in enumerate(rows.tolist()):
            other = self.fine[j]
            groups = min(len(mine), len(other))
            out[k] = np.minimum(folded(mine, groups), folded(other, groups)).sum() >= needed(self.sizes[i], self.sizes[j], least)
        return out


def needed(n, m, least: int):
    """Smallest overlap of sets of ``n`` and ``m`` at which 100 * overlap >= least * union."""
    return -((-least * (n + m)) // (100 + least))


class CountTree:
    """R-tree over points of group counts, packed bottom-up from points in order of size and place.

    A node knows the largest count of each group and the smallest size below it.
    The overlap of two sets is at most the sum over groups of the smaller count,
    so a node whose sum stays below the least overlap needed is left out.
    """

    FANOUT = 16

    def __init__(self, points: np.ndarray, sizes: np.ndarray, least: int):
        self.least = least
        lead = points[:, :8] >= points[:, 8:16]
        self.order = np.lexsort((lead @ (1 << np.arange(8)), sizes))
        top, low = points[self.order], sizes[self.order]
        self.levels = [(top, low, low)]
        high = low
        while len(top) > self.FANOUT:
            starts = np.arange(0, len(top), self.FANOUT)
            top, low, high = np.maximum.reduceat(top, starts), np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts)
            self.levels.append((top, low, high))

    def near(self, point: np.ndarray, size: int, open_: np.ndarray) -> np.ndarray:
        """Points (by row) marked in ``open_`` (by place in the tree) that may be similar."""
        at = np.arange(len(self.levels[-1][0]))
        for level in range(len(self.levels) - 1, -1, -1):
            top, low, high = self.levels[level]
            if not level:
                at = at[open_[at]]
            at = at[(100 * high[at] >= self.least * size) & (self.least * low[at] <= 100 * size)]
            bound = np.minimum(top[at], point).sum(axis=1)
            at = at[bound >= needed(size, np.maximum(low[at], -(-self.least * size // 100)) if level else low[at], self.least)]
            if level:
                at = (at[:, None] * self.FANOUT + np.arange(self.FANOUT)).ravel()
                at = at[at < len(self.levels[level - 1][0])]
        return at

    def components(self, check=None, tile: np.ndarray | None = None) -> np.ndarray:
        """Component of each row, under pairs that pass the bound and ``check(row, rows)``; with ``tile``, pairs across tiles only."""
        n = len(self.order)
        points, sizes, _ = self.levels[0]
        name = np.arange(n)
        open_ = np.ones(n, bool)
        for first in range(n):
            if not open_[first]:
                continue
            open_[first] = False
            stack = [first]
            while stack:
                at = stack.pop()
                found = self.near(points[at], sizes[at], open_)
                if tile is not None and len(found):
                    found = found[tile[self.order[found]] != tile[self.order[at]]]
                if check is not None and len(found):
                    found = found[check(self.order[at], self.order[found])]
                open_[found] = False
                name[found] = first
                stack += found.tolist()
        out = np.empty(n, np.int64)
        out[self.order] = self.order[name]
        return out


def _measure(words: int):
    """Size and class of every document, then the slots of shingles that many documents of this task have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits, seen = np.zeros(1 << SLOT_BITS, np.int32), 0
        kind = None
        for batch in slices(batches, "text", 1 << 20):
            kind = batch.schema.field("id").type
            sets = shingle_sets(batch.column("text").to_pylist(), words)
            flat = np.concatenate(sets)
            np.add.at(hits, (flat >> np.uint64(64 - SLOT_BITS)).astype(np.int64), 1)
            seen += len(flat)
            names = [class_of(s) if len(s) else None for s in sets]
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(names, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())],
                ["id", "n", "class", "slot", "hits"],
            )
        if kind is not None:
            often = np.flatnonzero(hits > 8 * (1 + seen / len(hits)))
            n = len(often)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(n, kind), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.array(often << (64 - SLOT_BITS), pa.int64()) if n else pa.nulls(0, pa.int64()), pa.array(hits[often].astype(np.int64))],
                ["id", "n", "class", "slot", "hits"],
            )

    return run


def _prefixes(words: int, least: int, common):
    """The first shingles of each class in the order (not common, hash): similar sets share one of these."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in slices(batches, "text", 1 << 20):
            keys, names = [], []
            for s in shingle_sets(batch.column("text").to_pylist(), words):
                if not len(s) or (name := class_of(s)) in seen:
                    continue
                seen.add(name)
                size = len(s) - -(-least * len(s) // 100) + 1
                late = in_bitmap(common.value, s)
                keys.append(np.concatenate([s[~late][:size], s[late][: max(0, size - int((~late).sum()))]]))
                names.append(np.full(len(keys[-1]), name, np.int64))
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).astype(np.int64)), pa.array(np.concatenate(names))], ["key", "class"])

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of two or more classes with a key in common, named by a hash of the classes.

    Copies with changes share many keys; keys with the same classes make one block.
    """
    for table in whole_groups(batches, "key"):
        key, name = table.column("key").to_numpy(), table.column("class").to_numpy()
        order = np.lexsort((name, key))
        key, name = key[order], name[order]
        once = np.r_[True, (key[1:] != key[:-1]) | (name[1:] != name[:-1])]
        key, name = key[once], name[once]
        starts, sizes = runs(key)
        block = mix64(np.add.reduceat(mix64(name.astype(np.uint64)), starts) + sizes.astype(np.uint64)).astype(np.int64)
        # equal blocks once, the first of each
        _, first = np.unique(block, return_index=True)
        take = np.zeros(len(starts), bool)
        take[first] = True
        several = np.repeat(take & (sizes > 1), sizes)
        if several.any():
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(block, sizes)[several]), pa.array(name[several])], ["key", "class"])


def _wanted(words: int, wanted, name: str, value):
    """``value(set)`` of the classes marked in the bitmap, in column ``name``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in slices(batches, "text", 1 << 20):
            names, values = [], []
            for s in shingle_sets(batch.column("text").to_pylist(), words):
                if len(s) and (own := class_of(s)) not in seen and in_bitmap(wanted.value, np.array([own]))[0]:
                    seen.add(own)
                    names.append(own)
                    values.append(value(s))
            if names:
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(values, pa.binary())], ["class", name])

    return run


def _candidates(least: int):
    """Links between classes of one key whose points don't rule out that they are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "part"):
            part, name = table.column("part").to_numpy(), table.column("class").to_numpy()
            tile = table.column("tile").to_numpy()
            across = table.column("tile_a").to_numpy() != table.column("tile_b").to_numpy()
            points = Points(table.column("point").to_pylist())
            starts, many = runs(part)
            a, b = [], []
            # small blocks: one pair of places after the other, in all blocks of one size at once
            for m in range(2, 9):
                own = starts[many == m]
                for i in range(m):
                    for j in range(i + 1, m):
                        x, y = own + i, own + j
                        far = across[x] & (tile[x] == tile[y])
                        fit = ~far & (np.minimum(points.coarse[x], points.coarse[y]).sum(axis=1) >= needed(points.sizes[x], points.sizes[y], least))
                        a.append(x[fit])
                        b.append(y[fit])
            if a:
                x, y = np.concatenate(a), np.concatenate(b)
                _, first = np.unique(np.stack([name[x], name[y]], axis=1), axis=0, return_index=True)
                fit = [k for k in first.tolist() if points.bound(x[k], y[k : k + 1], least)[0]]
                a, b = [name[x[fit]]], [name[y[fit]]]
            for start, m in zip(starts[many > 8], many[many > 8]):
                own = slice(start, start + m)
                tree = CountTree(points.coarse[own], points.sizes[own], least)
                top = tree.components(lambda i, rows, start=start: points.bound(start + i, start + rows, least), tile[own] if across[start] else None)
                a.append(name[own])
                b.append(name[own][top])
            if a:
                pairs = np.stack([np.concatenate(a), np.concatenate(b)], axis=1)
                pairs = np.unique(np.sort(pairs[pairs[:, 0] != pairs[:, 1]], axis=1), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], ["a", "b"])

    return run


def _verified(least: int):
    """Links inside each block that hold exactly: a spanning tree of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "part"):
            part, name = table.column("part").to_numpy(), table.column("class").to_numpy()
            tile = table.column("tile").to_numpy()
            across = table.column("tile_a").to_numpy() != table.column("tile_b").to_numpy()
            sets = [np.frombuffer(x, np.uint64) for x in table.column("shingles").to_pylist()]
            sizes = np.array([len(x) for x in sets], np.int64)
            coarse = np.stack([folded(point_of(x), GROUPS) for x in sets])
            a, b = [], []
            for start, m in zip(*runs(part)):
                if m < 2:
                    continue
                own = slice(start, start + m)

                def check(row: int, rows: np.ndarray, start=start) -> np.ndarray:
                    mine, many = sets[start + row], sizes[start + rows]
                    other = np.concatenate([sets[start + r] for r in rows])
                    spot = np.searchsorted(mine, other)
                    spot[spot == len(mine)] = 0
                    overlap = np.add.reduceat((mine[spot] == other).astype(np.int64), np.r_[0, np.cumsum(many)[:-1]])
                    return overlap >= needed(len(mine), many, least)

                top = CountTree(coarse[own], sizes[own], least).components(check, tile[own] if across[start] else None)
                a.append(name[own])
                b.append(name[own][top])
            if a:
                x, y = np.concatenate(a), np.concatenate(b)
                yield pa.RecordBatch.from_arrays([pa.array(x[x != y]), pa.array(y[x != y])], ["a", "b"])

    return run


def _tiled(rows: DataFrame, by: str, tiles: DataFrame) -> DataFrame:
    """Rows of each block, dealt to the pairs of its tiles; ``tiles`` lists the blocks with more than one."""
    placed = rows.join(tiles, by, "left").withColumn("tiles", F.coalesce("tiles", F.lit(1)))
    placed = placed.withColumn("tile", F.pmod(F.xxhash64("class"), F.col("tiles").cast("long")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    placed = placed.withColumns({"tile_a": F.least("tile", "other"), "tile_b": F.greatest("tile", "other")})
    placed = placed.withColumn("part", F.xxhash64(by, "tile_a", "tile_b")).drop(by, "tiles", "other")
    return placed.repartition("part").sortWithinPartitions("part")


def similar_classes(texts: DataFrame, measured: DataFrame, words: int, least: int) -> DataFrame:
    """``node, component`` of classes of equal sets, linked by Jaccard similarity (see connected_components)."""
    spark = texts.sparkSession
    often = measured.filter("slot is not null").groupBy("slot").agg(F.sum("hits").alias("hits")).filter("hits >= 32")
    common = spark.sparkContext.broadcast(slot_bitmap(often, "slot", SLOT_BITS))
    keyed = texts.mapInArrow(_prefixes(words, least, common), "key long, class long")
    shared = cut_lineage(keyed.repartition("key").sortWithinPartitions("key").mapInArrow(_shared, "key long, class long").distinct())
    wanted = spark.sparkContext.broadcast(slot_bitmap(shared, "class", SLOT_BITS))
    points = texts.mapInArrow(_wanted(words, wanted, "point", lambda x: packed(point_of(x))), "class long, point binary").dropDuplicates(["class"])
    large = shared.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / TILE_POINTS).cast("int").alias("tiles")).filter("tiles > 1")
    pointed = _tiled(shared.join(points, "class"), "key", large)
    linked = cut_lineage(pointed.mapInArrow(_candidates(least), "a long, b long"))

    clusters = connected_components(linked)
    members = clusters.union(clusters.select(F.col("component").alias("node"), "component").distinct())
    members = cut_lineage(members.select(F.col("node").alias("class"), F.col("component").alias("cluster")))
    clustered = spark.sparkContext.broadcast(slot_bitmap(members, "class", SLOT_BITS))
    sets = texts.mapInArrow(_wanted(words, clustered, "shingles", lambda x: x.tobytes()), "class long, shingles binary").dropDuplicates(["class"])
    in_clusters = cut_lineage(sets.join(members, "class"))
    weights = in_clusters.groupBy("cluster").agg(F.ceil(F.sum(F.octet_length("shingles").cast("long")) / (8 * TILE_SHINGLES)).cast("int").alias("tiles"))
    exact = _tiled(in_clusters, "cluster", weights.filter("tiles > 1")).mapInArrow(_verified(least), "a long, b long")
    out = connected_components(exact)
    release(shared, linked, members, in_clusters)
    return out


def ngram_jaccard_join(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, least: int = 80
) -> DataFrame:
    """One row per row of ``docs``: ``id, n_shingles, class, component``.

    Texts with A-Z lower-cased are cut at white space (0x20, 0x09-0x0D); a text's
    set holds its runs of ``words`` words, or all its words as one run where it
    has fewer. Texts link where ``100 * overlap >= least * union``. ``component``
    is the smallest id that links reach, the row's own id included. Texts without
    words, null ones too, have no shingles, a null class and link with nothing.
    Rows with a null id take part but are never a component's name, unless all
    are null. Repeated rows repeat; an empty table gives no rows; other columns
    are not read.

    Equal sets are one class, so copies are compared once. Shingles and classes
    are 64-bit hashes. Similar classes share a shingle among the first fifth of
    each in any fixed order; the order puts shingles last that are frequent in
    some part of the input, which are marked in a bitmap of fixed size. Under
    each shared shingle an R-tree of count points links the classes whose bound
    allows similarity; the clusters of these links are then joined exactly, again
    by R-tree, with their sets at hand. Blocks beyond a size are cut into tiles and
    every pair of tiles is a task's work, so no pair is lost.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = dict(rows.dtypes)["id"]
    measured = cut_lineage(rows.mapInArrow(_measure(words), f"id {kind}, n long, class long, slot long, hits long"))
    similar = cut_lineage(similar_classes(rows.select("text"), measured, words, least))
    per_row = measured.filter("slot is null").select("id", "n", "class")
    firsts = per_row.filter("class is not null").groupBy("class").agg(F.min("id").alias("first"))
    tops = similar.select("component").distinct().withColumnRenamed("component", "node").withColumn("component", F.col("node")).union(similar)
    linked = firsts.join(tops.withColumnRenamed("node", "class"), "class")
    names = linked.groupBy("component").agg(F.min("first").alias("smallest"))
    of_class = firsts.join(tops.withColumnRenamed("node", "class"), "class", "left").join(names, "component", "left")
    of_class = of_class.select("class", F.coalesce("smallest", "first").alias("component"))
    out = per_row.join(of_class, "class", "left")
    return out.select("id", F.col("n").alias("n_shingles"), "class", F.coalesce("component", "id").alias("component"))
