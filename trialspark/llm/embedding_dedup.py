"""Near-duplicate embeddings: random-hyperplane sign hashing in several tables, exact cosines, components."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialspark.llm.common import cut_lineage, runs, whole_groups
from trialspark.llm.components import connected_components

#: Vectors of one bucket that are compared in one task; a larger bucket is cut into tiles of about this size.
TILE = 2048
#: Buckets listed as large are broadcast up to this many.
BROADCAST_BUCKETS = 100_000


def tables_for(n: int, least: float, recall: float) -> tuple[int, int]:
    """Bits and tables: about 64 vectors a bucket, and a pair at the limit found with chance ``recall``."""
    bits = min(30, max(4, round(math.log2(max(2, n) / 64))))
    agree = (1 - math.acos(least) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(1 - recall) / math.log(1 - agree)))


def _signs(bits: int, tables: int, seed: int):
    planes: dict[int, np.ndarray] = {}

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                column = batch.column("vector")
                flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                dims = np.diff(column.offsets.to_numpy()).astype(np.int64)
                starts = np.r_[0, np.cumsum(dims)[:-1]]
                hashes = np.zeros((batch.num_rows, tables), np.int32)
                for dim in np.unique(dims):
                    if dim not in planes:
                        planes[dim] = np.random.default_rng([seed, dim]).standard_normal((dim, bits * tables))
                    own = np.flatnonzero(dims == dim)
                    side = flat[starts[own][:, None] + np.arange(dim)] @ planes[dim] >= 0
                    hashes[own] = (side.reshape(len(own), tables, bits) << np.arange(bits)).sum(axis=2)
                table = np.tile(np.arange(tables, dtype=np.int64), batch.num_rows)
                key = (table << 48) ^ ((np.repeat(dims, tables) & 0xFFFF) << 32) ^ hashes.reshape(-1)
                row = np.repeat(np.arange(batch.num_rows), tables)
                out = [batch.column(c).take(pa.array(row)) for c in ("rep", "copies", "vector")]
                packed = pa.array([h.tobytes() for h in hashes], pa.binary()).take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), pa.array(table.astype(np.int32)), packed, *out], ["bucket", "hash_table", "hashes", "rep", "copies", "vector"]
                )

    return sign


def _compare(least: float, tables: int):
    """Links inside a group: one row per vector with its number of links, and a spanning tree of the links.

    A pair counts in the first table in which its hashes agree, so tables don't
    repeat each other. Of two tiles only pairs across them count.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "part"):
            keys = table.column("part").to_numpy()
            names = {c: table.column(c).to_numpy() for c in ("rep", "copies", "tile", "tile_a", "tile_b", "hash_table")}
            hashes = np.frombuffer(b"".join(table.column("hashes").to_pylist()), np.int32).reshape(-1, tables)
            column = table.column("vector").combine_chunks()
            flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            ends = np.r_[0, np.cumsum(np.diff(column.offsets.to_numpy()))]
            rep, links, edge_a, edge_b = [], [], [], []
            for start, size in zip(*runs(keys)):
                if size < 2:
                    continue
                own = slice(start, start + size)
                vectors = flat[ends[start] : ends[start + size]].reshape(size, -1)
                unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
                tile, across = names["tile"][own], names["tile_a"][start] != names["tile_b"][start]
                counts, root = np.zeros(size, np.int64), np.arange(size)
                own_hashes, own_copies, before = hashes[own], names["copies"][own], names["hash_table"][start]
                for at in range(0, size, 256):
                    near = unit[at : at + 256] @ unit.T >= least
                    near &= np.arange(size) > np.arange(at, min(at + 256, size))[:, None]
                    if across:
                        near &= tile != tile[at : at + 256][:, None]
                    i, j = np.nonzero(near)
                    i += at
                    if before:
                        new = ~(own_hashes[i, :before] == own_hashes[j, :before]).any(axis=1)
                        i, j = i[new], j[new]
                    np.add.at(counts, i, own_copies[j])
                    np.add.at(counts, j, own_copies[i])
                    for a, b in zip(i.tolist(), j.tolist()):
                        while root[a] != a:
                            root[a] = a = root[root[a]]
                        while root[b] != b:
                            root[b] = b = root[root[b]]
                        if a != b:
                            root[max(a, b)] = min(a, b)
                for x in np.flatnonzero(root != np.arange(size)):
                    a = x
                    while root[a] != a:
                        a = root[a]
                    root[x] = a
                hit = np.flatnonzero(counts)
                ids = names["rep"][own]
                rep.append(ids[hit])
                links.append(counts[hit])
                edge_a.append(ids[hit])
                edge_b.append(ids[root[hit]])
            if rep:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x).astype(np.int64)) for x in (rep, links, edge_a, edge_b)], ["rep", "links", "a", "b"]
                )

    return compare


def embedding_duplicates(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    least: float = 0.95,
    recall: float = 0.999,
    seed: int = 11,
) -> DataFrame:
    """One row per row of ``vectors``: ``id, n_links, component, kept``; an integer id is asked for.

    Two vectors link when their hashes agree in some table and their cosine in
    double precision is ``least`` or more. Vectors that are null, empty, zero or
    hold null or non-finite components link with nothing, nor do vectors of
    different length. Rows with a null id don't take part and come out with
    ``n_links`` 0 and a null component. Equal vectors are compared once: their
    copies link with each other and share all links; rows that repeat an id with
    an equal vector count as copies. An empty table gives no rows.

    Bits and tables follow the number of distinct vectors: buckets keep their
    size, and a pair at the limit is found with chance ``recall``. A bucket
    beyond ``TILE`` vectors is cut into tiles, every pair of tiles being a group
    of its own.
    """
    spark = vectors.sparkSession
    good = F.col("v").isNotNull() & (F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists("v", lambda x: x != 0)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.transform(F.col(vector_col), lambda x: x.cast("double") + F.lit(0.0)).alias("v"))
    usable = F.coalesce(good, F.lit(False)) & F.col("id").isNotNull()
    valid = rows.filter(usable)
    classes = cut_lineage(
        valid.groupBy(F.col("v").alias("vector")).agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    )
    bits, tables = tables_for(classes.count(), least, recall)
    signed = classes.mapInArrow(_signs(bits, tables, seed), "bucket long, hash_table int, hashes binary, rep long, copies long, vector array<double>")
    light = classes.mapInArrow(_signs(bits, tables, seed), "bucket long, hash_table int, hashes binary, rep long, copies long, vector array<double>").select("bucket")
    sizes = light.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    large = cut_lineage(sizes.filter(F.col("n") > TILE).select("bucket", F.ceil(F.col("n") / TILE).cast("int").alias("tiles")))
    n_large = large.count()
    if n_large:
        placed = signed.join(F.broadcast(large) if n_large <= BROADCAST_BUCKETS else large, "bucket", "left")
        placed = placed.withColumn("tiles", F.coalesce("tiles", F.lit(1)))
    else:
        placed = signed.withColumn("tiles", F.lit(1))
    placed = placed.withColumn("tile", F.pmod(F.xxhash64("rep"), F.col("tiles").cast("long")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    placed = placed.withColumns({"tile_a": F.least("tile", "other"), "tile_b": F.greatest("tile", "other")})
    placed = placed.withColumn("part", F.xxhash64("bucket", "tile_a", "tile_b")).drop("other", "tiles", "bucket")
    found = cut_lineage(
        placed.repartition("part").sortWithinPartitions("part").mapInArrow(_compare(least, tables), "rep long, links long, a long, b long")
    )
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    joined = connected_components(found, "a", "b").withColumnsRenamed({"node": "rep"})
    per_class = classes.join(links, "rep", "left").join(joined, "rep", "left")
    per_class = per_class.select(
        "vector",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "rep").alias("component"),
    )
    keyed = per_class.withColumn("key", F.xxhash64("vector")).withColumnRenamed("vector", "class_vector")
    probe = rows.withColumn("key", F.when(usable, F.xxhash64("v")))
    out = probe.join(keyed, (probe["key"] == keyed["key"]) & (F.col("v") == F.col("class_vector")), "left")
    component = F.coalesce("component", "id")
    return out.select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component"), (F.col("id") == component).alias("kept"))
