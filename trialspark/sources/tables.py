"""Sources, sinks and table maintenance.

Maintenance operators come in two forms: a DataFrame form that returns the new
table content, and a folder form that publishes it. Folder forms rewrite only
the partitions that changed, write a new run folder that readers select by its
run id, or stage the new table beside the old one and take its place by rename,
so no job overwrites what it is still reading.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Parquet when the path says so, otherwise CSV with a header."""
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.parquet(path)
    reader = spark.read.option("header", True)
    return reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)


def read_folder(spark: SparkSession, path: str) -> DataFrame:
    """All Parquet files under a folder as one table; marker files are skipped."""
    return spark.read.option("recursiveFileLookup", True).option("mergeSchema", True).parquet(path)


def read_tab_delimited(spark: SparkSession, path: str, schema: T.StructType | str | None = None, drop_suffix: str | None = None) -> DataFrame:
    """Tab-delimited text; ``drop_suffix`` is a pattern removed from the end of column names."""
    reader = spark.read.option("header", True).option("sep", "\t")
    df = reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)
    if drop_suffix:
        df = df.withColumnsRenamed({c: re.sub(f"(?:{drop_suffix})$", "", c) for c in df.columns})
    return df


def register_view(spark: SparkSession, path: str, view: str, schema: T.StructType | str | None = None) -> DataFrame:
    df = read_table(spark, path, schema)
    df.createOrReplaceTempView(view)
    return df


def run_template(spark: SparkSession, sql: str, args: dict | None = None, views: dict[str, DataFrame] | None = None) -> DataFrame:
    """Run SQL with named parameters (``:name``); views are passed as DataFrames.

    Values travel as parameters, never as text, so a template cannot be broken
    by the content of a value. Tables are named ``{name}`` in the template.
    """
    return spark.sql(sql, args=args or {}, **(views or {}))


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace exactly the partitions present in ``df``; all others stay untouched.

    This is both replace-by-group and delete-then-insert of a slice, and it
    never reads the old data.
    """
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def write_run(df: DataFrame, path: str, run_id: str) -> None:
    """Write ``df`` as run ``run_id`` of the table kept under ``path``."""
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/run_id={run_id}")


def _file_system(spark: SparkSession, path: str):
    """The path as Hadoop knows it, and its file system."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path.rstrip("/"))
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def _beside(at, kind: str, run: str) -> str:
    """A hidden name next to a table, which readers of the folder above skip."""
    return f"{at.getParent().toString()}/_{at.getName()}.{kind}-{run}"


def settle(spark: SparkSession, path: str) -> None:
    """Put a table back in its place when a run ended between the two renames of :func:`publish`."""
    at, fs = _file_system(spark, path)
    if not fs.exists(at):
        left = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(_beside(at, "last", "*")))
        if left:
            newest = max(left, key=lambda s: s.getModificationTime())
            if not fs.rename(newest.getPath(), at):
                raise OSError(f"{newest.getPath().toString()} could not be put back to {path}")


def publish(df: DataFrame, path: str, partition_by: Sequence[str] = (), run_id: str | None = None) -> None:
    """Replace the table at ``path`` by ``df``, which may be computed from that very table.

    The new table is written whole beside the old one under the id of the run;
    only then the old one steps aside, the new one takes its name, and the old
    files go. A run that fails while it computes or writes leaves the old table
    as it was; one that ends between the renames is mended by :func:`settle`,
    which the next call runs first. Renames are steps of the file system (one
    step on HDFS and on disks, a copy on most object stores); writers of the
    same table must not run at the same time.
    """
    spark = df.sparkSession
    settle(spark, path)
    at, fs = _file_system(spark, path)
    run = run_id or uuid.uuid4().hex
    staged, last = (_file_system(spark, _beside(at, kind, run))[0] for kind in ("next", "last"))
    try:
        write_parquet(df, staged.toString(), partition_by)
    except Exception:
        fs.delete(staged, True)
        raise
    had = fs.exists(at)
    if had and not fs.rename(at, last):
        raise OSError(f"{path} could not step aside")
    if not fs.rename(staged, at):
        if had:
            fs.rename(last, at)
        raise OSError(f"{staged.toString()} could not take the place of {path}")
    if had:
        fs.delete(last, True)


def newest_run(df: DataFrame, run_col: str = "run_id") -> DataFrame:
    """Rows of the newest run. On a partition column this prunes to one folder."""
    newest = df.agg(F.max(run_col).alias("_newest"))
    return df.join(F.broadcast(newest), F.col(run_col) == F.col("_newest"), "left_semi")


def read_jdbc(spark: SparkSession, url: str, table: str, lower: bool = True, **options: str) -> DataFrame:
    """Read a database table or query; pass partitionColumn/lowerBound/upperBound/numPartitions for large ones."""
    df = spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()
    return lower_columns(df) if lower else df


def lower_columns(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({c: c.lower() for c in df.columns})


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", batch: int = 100_000, **options: str) -> None:
    df.write.format("jdbc").options(url=url, dbtable=table, batchsize=str(batch), **options).mode(mode).save()


def empty_table(spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    return spark.createDataFrame([], schema)


def only_keys(df: DataFrame, keys: DataFrame, on: Sequence[str] | str) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``keys``: any number of keys, no batches."""
    return df.join(keys, on, "left_semi")


def replace_groups(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``old`` without the groups found in ``new``, followed by ``new``."""
    kept = old.join(new.select(*keys).distinct(), list(keys), "left_anti")
    return kept.unionByName(new, allowMissingColumns=True)


def replace_slice(old: DataFrame, new: DataFrame, inside: Column) -> DataFrame:
    """``old`` without the rows where ``inside`` holds, followed by ``new``."""
    return old.filter(~F.coalesce(inside, F.lit(False))).unionByName(new, allowMissingColumns=True)


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[str | Column] = ()) -> DataFrame:
    """Insert ``new`` and let it win over rows of ``old`` with the same key.

    Of several new rows with a key the first under ``order`` wins, without an
    order the smallest by all its columns.
    """
    w = Window.partitionBy(*keys).orderBy(*(list(order) or [c for c in new.columns if c not in keys] or keys))
    once = new.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
    return replace_groups(old, once, keys)


def upsert_table(new: DataFrame, path: str, keys: Sequence[str], order: Sequence[str | Column] = (), partition_by: Sequence[str] = ()) -> None:
    """Upsert rows into the table at ``path`` and publish the result in its place."""
    settle(new.sparkSession, path)
    publish(upsert(new.sparkSession.read.parquet(path), new, keys, order), path, partition_by)


def replace_groups_in_table(new: DataFrame, path: str, keys: Sequence[str], partition_by: Sequence[str] = ()) -> None:
    """Replace the groups found in ``new`` in the table at ``path`` and publish the result in its place."""
    settle(new.sparkSession, path)
    publish(replace_groups(new.sparkSession.read.parquet(path), new, keys), path, partition_by)


def append_log(log: DataFrame, batch: DataFrame, keys: Sequence[str], run_col: str, keep: str = "last") -> DataFrame:
    """Append a batch of results and keep the first or the last run of each key; of equal runs the smallest row."""
    order = F.col(run_col).desc() if keep == "last" else F.col(run_col).asc()
    stacked = log.unionByName(batch, allowMissingColumns=True)
    w = Window.partitionBy(*keys).orderBy(order, *[c for c in stacked.columns if c not in (*keys, run_col)])
    return stacked.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def latest_run(df: DataFrame, keys: Sequence[str], run_col: str, tie: Sequence[str] = ()) -> DataFrame:
    """Newest row of every key, ties broken by ``tie`` (largest first)."""
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in (run_col, *tie)])
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def changed_groups(sources: Sequence[tuple[DataFrame, str]], output: DataFrame, output_run: str, keys: Sequence[str]) -> DataFrame:
    """Groups with any source newer than their last output, or with no output yet.

    ``sources`` are (table, run column) pairs. Every table is reduced to one row
    per group before anything is joined.
    """
    newest = None
    for df, run in sources:
        part = df.groupBy(*keys).agg(F.max(run).alias("source_run"))
        newest = part if newest is None else newest.unionByName(part)
    newest = newest.groupBy(*keys).agg(F.max("source_run").alias("source_run"))
    done = output.groupBy(*keys).agg(F.max(output_run).alias("output_run"))
    stale = F.col("output_run").isNull() | (F.col("source_run") > F.col("output_run"))
    return newest.join(done, list(keys), "left").filter(stale)


def count_changes(df: DataFrame, inside: Column, run_col: str, since: Column, keys: Sequence[str] = ()) -> DataFrame:
    """Number of rows of a slice that are newer than ``since``."""
    return df.filter(inside & (F.col(run_col) > since)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_changed"))


def small_table(spark: SparkSession, rows: Sequence[Sequence], schema: str) -> DataFrame:
    """A configuration table from literals.

    The rows are literals of the plan, so Spark knows that the table is small
    and broadcasts it; a table made from Python objects has no known size.
    """
    fields = T.StructType.fromDDL(schema).fields
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(r, fields)]) for r in rows]
    return spark.range(1).select(F.explode(F.array(*structs)).alias("_r")).select("_r.*")
