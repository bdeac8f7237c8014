"""Centroid clustering over Hilbert-ordered blocks: boxes tell which centroids a block can be nearest to."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialspark.llm.common import cut_lineage, release

#: Axes that the curve runs through: the widest ones. Three bits of each make a key of 48 bits.
AXES = 16
#: Vectors of a block.
BLOCK = 256
#: Close centroids that the others are held against, block by block.
PIVOTS = 4


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each row of ``cells`` (whole numbers below ``2 ** bits``) on the Hilbert curve through all of them.

    Skilling's public construction: undo the turns of every level from the top,
    then take the rank in Gray order. The place has ``columns * bits`` bits.
    """
    x = [cells[:, i].astype(np.int64) for i in range(cells.shape[1])]
    level = 1 << (bits - 1)
    while level > 1:
        below = level - 1
        for i in range(len(x)):
            turned = (x[i] & level) != 0
            swap = np.where(turned, 0, (x[0] ^ x[i]) & below)
            x[0] = x[0] ^ np.where(turned, below, swap)
            if i:
                x[i] = x[i] ^ swap
        level >>= 1
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    flip = np.zeros(len(cells), np.int64)
    level = 1 << (bits - 1)
    while level > 1:
        flip ^= np.where((x[-1] & level) != 0, level - 1, 0)
        level >>= 1
    key = np.zeros(len(cells), np.int64)
    for bit in range(bits - 1, -1, -1):
        for column in x:
            key = key << 1 | ((column ^ flip) >> bit) & 1
    return key


def _matrix(column: pa.Array, dims: int, kind=np.int32) -> np.ndarray:
    """Rows of equal length from a column of binaries."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, dims)


def _keyed(low: np.ndarray, high: np.ndarray, axes: np.ndarray, bits: int):
    """Rows with their place on the curve; the axes are cut into equal cells between their ends."""
    wide = np.maximum(high - low + 1, 1)[axes]

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                batch = whole.slice(at, 4096)
                v = batch.column("v").flatten().to_numpy().reshape(batch.num_rows, -1)
                cells = ((v[:, axes].astype(np.int64) - low[axes]) << bits) // wide
                packed = pa.array([row.tobytes() for row in np.ascontiguousarray(v, "<i4")], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column("id"), packed, pa.array(hilbert_keys(cells, bits))], ["id", "v", "key"])

    return key


def _blocks(dims: int, size: int):
    """Blocks of ``size`` neighbours on the curve with the smallest and largest value of every component."""

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(rows: pa.Table) -> pa.RecordBatch:
            rows = rows.combine_chunks()
            v = _matrix(rows.column("v"), dims, "<i4")
            ids = rows.column("id").combine_chunks()
            ids = ids.chunk(0) if isinstance(ids, pa.ChunkedArray) else ids
            return pa.RecordBatch.from_arrays(
                [
                    pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                    *(pa.array([x.astype("<i4").tobytes()], pa.binary()) for x in (v, v.min(axis=0), v.max(axis=0))),
                ],
                ["ids", "vectors", "low", "high"],
            )

        waiting: list[pa.RecordBatch] = []
        held = 0
        for batch in batches:
            waiting.append(batch)
            held += batch.num_rows
            if held >= size:
                rows = pa.Table.from_batches(waiting)
                whole = held - held % size
                for at in range(0, whole, size):
                    yield made(rows.slice(at, size))
                waiting, held = rows.slice(whole).to_batches(), held - whole
        if held:
            yield made(pa.Table.from_batches(waiting))

    return block


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Numbers of the centroids that may be nearest to some point of the box, in ascending order.

    For centroids ``a`` and ``b`` the squared distances of a point differ by a
    linear function of it, whose extreme over a box is a sum over its sides. A
    centroid that is farther than one of the ``PIVOTS`` closest to the box at
    every point of it can't be nearest; ties stay. Everything is whole numbers.
    """
    outside = np.maximum(low - centroids, 0) + np.maximum(centroids - high, 0)
    middle = np.abs(2 * centroids - low - high)
    norms = (centroids * centroids).sum(axis=1)
    keep = np.ones(len(centroids), bool)
    for pivot in np.lexsort((middle.sum(axis=1), (outside * outside).sum(axis=1)))[:PIVOTS]:
        apart = centroids - centroids[pivot]
        most = 2 * np.maximum(low * apart, high * apart).sum(axis=1) + norms[pivot] - norms
        keep &= most >= 0
    return np.flatnonzero(keep)


def nearest(v: np.ndarray, centroids: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest of the centroids ``among`` and its squared distance, exactly; ties go to the smaller number."""
    v, own = v.astype(np.int64), centroids[among]
    largest = int(max(np.abs(v).max(initial=0), np.abs(own).max(initial=0)))
    if 4 * v.shape[1] * largest**2 < 1 << 53:  # every step is a whole number that a double holds
        x, c = v.astype(np.float64), own.astype(np.float64)
        far = (c * c).sum(axis=1) - 2 * (x @ c.T)
        best = far.argmin(axis=1)
        distance = (far[np.arange(len(v)), best] + (x * x).sum(axis=1)).astype(np.int64)
    else:
        far = np.stack([((v - c) ** 2).sum(axis=1) for c in own], axis=1)
        best = far.argmin(axis=1)
        distance = far[np.arange(len(v)), best]
    return among[best], distance


def _each_block(batches: Iterator[pa.RecordBatch], centroids: np.ndarray):
    dims = centroids.shape[1]
    for batch in batches:
        for i in range(batch.num_rows):
            low, high, v = (np.frombuffer(batch.column(c)[i].as_py(), "<i4").astype(np.int64) for c in ("low", "high", "vectors"))
            v = v.reshape(-1, dims)
            yield batch.column("ids")[i].values, v, *nearest(v, centroids, candidates(low, high, centroids))


def _sums(centroids: np.ndarray):
    """Per task: the sum of every component over each cluster, and under component -1 its number of vectors."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, dims = centroids.shape
        total = np.zeros((k, dims + 1), np.int64)
        for _, v, cluster, _ in _each_block(batches, centroids):
            order = np.argsort(cluster, kind="stable")
            own, starts, n = np.unique(cluster[order], return_index=True, return_counts=True)
            total[own, :dims] += np.add.reduceat(v[order], starts, axis=0)
            total[own, dims] += n
        own = np.flatnonzero(total[:, dims])
        component = np.r_[np.arange(dims), -1].astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(own, dims + 1).astype(np.int32)), pa.array(np.tile(component, len(own))), pa.array(total[own].reshape(-1))],
            ["cluster", "component", "total"],
        )

    return add


def _labels(centroids: np.ndarray):
    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, _, cluster, distance in _each_block(batches, centroids):
            yield pa.RecordBatch.from_arrays([ids, pa.array(cluster.astype(np.int32)), pa.array(distance)], ["id", "cluster", "distance"])

    return label


def seeded_order(seed: int, id_col: str = "id") -> Column:
    """Order in which vectors become the first centroids: the digest of the seed and the id."""
    return F.sha2(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")), 256)


def largest_component(dims: int) -> int:
    """Power of two up to which whole components keep every squared distance within 64 bits."""
    return 1 << (math.floor(math.log2(math.isqrt((1 << 62) // max(dims, 1)))) - 1)


def centroid_clusters(
    vectors: DataFrame,
    k: int = 40,
    rounds: int = 5,
    dims: int = 64,
    scale: int = 256,
    seed: int = 2,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    block: int = BLOCK,
) -> DataFrame:
    """One row per vector kept: ``id, cluster, distance, cluster_inertia, inertia, centroid``.

    Kept are vectors of exactly ``dims`` components, none null or non-finite;
    each becomes ``floor(scale * x)``. A component beyond ``largest_component``
    (2 ** 27 for 64) would not allow exact 64-bit distances; such a vector is
    left out like a non-finite one. The first centroids are the ``k`` vectors of
    smallest digest of ``seed`` and id, null ids last, rows of one id by their
    components; with fewer vectors there are fewer centroids. Every round assigns
    each vector to the nearest centroid (ties: the smaller number) and replaces
    centroids by their vectors' means, rounded down; those of no vector stay.
    An inertia that no long holds is null. Repeated rows count as often as they
    occur; an empty table gives no rows; other columns are not read.

    The vectors are sorted once along a Hilbert curve and written in blocks with
    their boxes; equal vectors are dealt out by their place in the table, so no
    range is larger than others. A round reads the blocks, compares each with
    its own candidates only, and shuffles one sum per task, cluster and
    component. The driver sees ``k`` centroids and the ends of each axis.
    """
    spark = vectors.sparkSession
    limit = largest_component(dims) / scale
    usable = f"size(v) = {dims} AND forall(v, x -> x IS NOT NULL AND x BETWEEN -{limit}D AND {limit}D)"
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v")).filter(usable)
    whole = rows.select("id", F.expr(f"transform(v, x -> cast(floor({float(scale)}D * x) AS int))").alias("v"))
    kind = dict(whole.dtypes)["id"]
    first = whole.select(seeded_order(seed).alias("o"), "v").orderBy(F.col("o").asc_nulls_last(), "v").limit(k).collect()
    if not first:
        return spark.createDataFrame([], f"id {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid array<long>")
    centroids = np.array([r["v"] for r in first], np.int64)

    ends = whole.agg(*(f(F.col("v")[i]).alias(f"{n}{i}") for i in range(dims) for n, f in (("low", F.min), ("high", F.max)))).first()
    low, high = (np.array([ends[f"{n}{i}"] for i in range(dims)], np.int64) for n in ("low", "high"))
    axes = np.argsort(low - high, kind="stable")[:AXES]
    keyed = whole.mapInArrow(_keyed(low, high, axes, min(20, 62 // len(axes), 3 if len(axes) == AXES else 20)), f"id {kind}, v binary, key long")
    keyed = cut_lineage(keyed.withColumn("place", F.monotonically_increasing_id()))
    ordered = keyed.repartitionByRange("key", "place").sortWithinPartitions("key", "place").select("id", "v")
    blocks = cut_lineage(ordered.mapInArrow(_blocks(dims, block), f"ids array<{kind}>, vectors binary, low binary, high binary"))
    release(keyed)

    for _ in range(rounds):
        sums = blocks.mapInArrow(_sums(centroids), "cluster int, component int, total long")
        total = sums.groupBy("cluster", "component").agg(F.sum(F.col("total").cast("decimal(20,0)")).alias("total")).collect()
        size = {r["cluster"]: int(r["total"]) for r in total if r["component"] < 0}
        for r in total:
            if r["component"] >= 0:
                centroids[r["cluster"], r["component"]] = int(r["total"]) // size[r["cluster"]]

    labelled = cut_lineage(blocks.mapInArrow(_labels(centroids), f"id {kind}, cluster int, distance long"))
    release(blocks)
    inertia = {r["cluster"]: int(r["s"]) for r in labelled.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("s")).collect()}
    held = lambda n: n if n < 1 << 63 else None
    of_all = held(sum(inertia.values()))
    described = [(c, held(inertia[c]), of_all, centroids[c].tolist()) for c in sorted(inertia)]
    # one row per centroid: k at most
    facts = spark.createDataFrame(described, "cluster int, cluster_inertia long, inertia long, centroid array<long>")
    return labelled.join(F.broadcast(facts), "cluster").select("id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")
