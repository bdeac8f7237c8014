"""Helpers of the text operators.

A document is identified by its id and its text together: rows that repeat
both are one document and share their results, rows that share only the id
stay apart.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialspark.session import cut_lineage, release

__all__ = ["cut_lineage", "release", "slices", "whole_groups", "document_key", "mix64", "runs", "SPACES"]

#: Fixed pattern: the white space that separates words.
SPACES = r"[\x20\x09-\x0D]+"


def document_key(id_col: str, text_col: str) -> Column:
    """64-bit key of a document; a null id or text counts as a value of its own."""
    return F.xxhash64(F.col(id_col).isNull(), F.col(id_col), F.coalesce(F.col(text_col), F.lit("")))


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about ``limit`` bytes of ``column`` at most (one longer text makes a batch)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        block = np.cumsum(sizes, dtype=np.int64) // limit
        starts = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
        for a, b in zip(starts, np.r_[starts[1:], batch.num_rows]):
            yield batch.slice(a, b - a)


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Regroup batches sorted by the integer ``key`` so that no key is cut in two."""
    open_key: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        if open_key and keys[-1] == open_key[-1].column(key)[0].as_py():
            open_key.append(batch)
            continue
        cut = int(np.searchsorted(keys, keys[-1], "left"))
        done = [*open_key, batch.slice(0, cut)] if cut else open_key
        if done:
            yield pa.Table.from_batches(done)
        open_key = [batch.slice(cut)]
    if open_key:
        yield pa.Table.from_batches(open_key)


def runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of equal neighbours."""
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return starts, np.diff(np.r_[starts, len(keys)])


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of the public splitmix64 generator: spreads 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def with_columns_of(df: DataFrame, schema_of: DataFrame) -> DataFrame:
    """Only the columns of ``schema_of``, in its order."""
    return df.select(*[F.col(f"`{c}`") for c in schema_of.columns])


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores behind it until ``df`` has no such column (upper and lower case alike)."""
    used = {c.lower() for c in df.columns}
    while name.lower() in used:
        name += "_"
    return name


def put_aside(df: DataFrame, *prefixes: str, replaced: tuple[str, ...] = ()) -> tuple[DataFrame, dict[str, str]]:
    """``df`` without the ``replaced`` columns, those that begin with a prefix under free names, and their names by free name."""
    df = df.drop(*[c for c in df.columns if c.lower() in replaced])
    names: dict[str, str] = {}
    for c in df.columns:
        if c.lower().startswith(prefixes):
            names[free := free_name(df, f"aside_{len(names)}")] = c
            df = df.withColumnRenamed(c, free)
    return df, names


def slot_bitmap(df: DataFrame, column: str, bits: int = 22) -> np.ndarray:
    """Which of ``2 ** bits`` slots (the top bits of a 64-bit column) occur: a bitmap of fixed size."""
    slot = f"shiftrightunsigned(`{column}`, {64 - bits})"
    words = df.selectExpr(f"cast(shiftright({slot}, 6) as int) as w", f"shiftleft(1L, cast({slot} % 64 as int)) as b")
    out = np.zeros(1 << (bits - 6), np.int64)
    table = words.groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    out[table.column("w").to_numpy()] = table.column("b").to_numpy()
    return out


def in_bitmap(bitmap: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Whether the slots of 64-bit ``values`` are marked."""
    slot = values.astype(np.uint64) >> np.uint64(64 - (len(bitmap).bit_length() + 5))
    return (bitmap[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63)).astype(np.int64)) & 1 == 1
