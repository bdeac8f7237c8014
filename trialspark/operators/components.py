"""Principal components by batches: each is reduced to a small basis, bases merge pairwise up a tree of tasks."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialspark.session import cut_lineage, release

#: Rows decomposed at a time, and bases that one task merges.
BATCH, FAN = 1000, 16

Basis = tuple[int, np.ndarray, np.ndarray]


def reduced(rows: np.ndarray, rank: int) -> np.ndarray:
    """At most ``rank`` rows with the same leading squares and products as ``rows``."""
    if not len(rows):
        return rows
    _, size, directions = np.linalg.svd(rows, full_matrices=False)
    return size[:rank, None] * directions[:rank]


def of_batch(rows: np.ndarray, rank: int) -> Basis:
    """Number, mean and reduced deviations of some rows."""
    mean = rows.mean(axis=0)
    return len(rows), mean, reduced(rows - mean, rank)


def merged(parts: Sequence[Basis], rank: int) -> Basis:
    """One basis for several: their rows, and how far their means lie from the common one."""
    n = sum(p[0] for p in parts)
    mean = sum(p[0] * p[1] for p in parts) / n
    shifts = [np.sqrt(p[0]) * (p[1] - mean)[None] for p in parts]
    return n, mean, reduced(np.concatenate([*(p[2] for p in parts), *shifts]), rank)


def _row(basis: Basis) -> pa.RecordBatch:
    n, mean, rows = basis
    return pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([mean.tobytes()], pa.binary()), pa.array([rows.tobytes()], pa.binary())], ["n", "mean", "rows"])


def _bases(batch: pa.RecordBatch | pa.Table) -> list[Basis]:
    out = []
    for r in batch.to_pylist():
        mean = np.frombuffer(r["mean"])
        out.append((r["n"], mean, np.frombuffer(r["rows"]).reshape(-1, len(mean))))
    return out


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("_v").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def fit_components(vectors: DataFrame, column: str, k: int, spare: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Mean and the first ``k`` components (rows of length 1) of a column of vectors of equal length.

    Tasks keep ``k`` and ``spare`` (as many again, 10 at least) directions of what
    they have read, so one holds a batch of rows and a few of these; no matrix of
    column by column is made. With no more columns than directions the result is
    exact, else what the spare ones don't hold is lost. Signs: the largest entry
    of a component is positive.
    """
    rank = k + (max(k, 10) if spare is None else spare)
    rows = vectors.select(F.col(column).cast("array<double>").alias("_v"))

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Basis | None = None
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                part = of_batch(_matrix(batch.slice(at, BATCH)), rank)
                held = part if held is None else merged([held, part], rank)
        if held is not None:
            yield _row(held)

    def merge(table: pa.Table) -> pa.Table:
        return pa.Table.from_batches([_row(merged(_bases(table), rank))])

    kind = "n long, mean binary, rows binary"
    parts = cut_lineage(rows.mapInArrow(fit, kind))
    count = parts.count()
    while count > 1:
        groups = -(-count // FAN)
        placed = parts.withColumn("g", F.pmod(F.xxhash64("n", "mean"), F.lit(groups)))
        before, parts = parts, cut_lineage(placed.groupBy("g").applyInArrow(merge, kind))
        release(before)
        count = parts.count()
    if not count:
        return np.zeros(0), np.zeros((k, 0))
    (_, mean, basis), = _bases(parts.toArrow())
    release(parts)
    _, _, directions = np.linalg.svd(basis, full_matrices=False)
    found = np.zeros((k, len(mean)))
    found[: len(directions)] = directions[:k]
    top = np.abs(found).argmax(axis=1)
    return mean, found * np.where(found[np.arange(k), top] < 0, -1.0, 1.0)[:, None]


def principal_components(df: DataFrame, vector: str, keys: Sequence[str], year: str, before: int, k: int = 20) -> DataFrame:
    """Components fitted on rows before a year and applied to rows up to it: ``keys``, ``year``, ``comp_0``, ``comp_1``, ...

    Vectors have the length that most have; others, and those with missing
    entries, are not fitted and get null components, as all do where nothing is
    left to fit on. Values are the deviations from the mean along each component.
    """
    rows = df.filter(F.col(year) <= before)
    length = rows.agg(F.mode(F.when(F.size(vector) > 0, F.size(vector)), deterministic=True)).first()[0] or 0
    whole = F.coalesce((F.size(vector) == length) & F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v.cast("double"))), F.lit(False))
    names = [f"comp_{i}" for i in range(k)]
    mean, found = fit_components(rows.filter(whole & (F.col(year) < before)), vector, k)
    if not len(mean):
        return rows.select(*keys, year, *[F.lit(None).cast("double").alias(n) for n in names])
    model = df.sparkSession.sparkContext.broadcast((mean, found))  # k + 1 vectors
    kept = rows.select(*keys, year, F.when(whole, F.col(vector).cast("array<double>")).alias("_v"))

    def along(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, directions = model.value
        for batch in batches:
            own = batch.column("_v").is_valid()
            values = np.full((batch.num_rows, len(directions)), np.nan)
            valid = own.to_numpy(zero_copy_only=False)
            values[valid] = (_matrix(batch.filter(own)) - centre) @ directions.T
            columns = [pa.array(values[:, i], mask=~valid) for i in range(len(directions))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], [*batch.schema.names[:-1], *names])

    out = kept.drop("_v").schema
    for n in names:
        out = out.add(n, "double")
    return kept.mapInArrow(along, out)
