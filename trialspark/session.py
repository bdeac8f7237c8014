"""Session defaults and lineage cutting."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: Spark deletes the shuffle files of a query when it ends; without it they stay until a garbage collection.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "trialspark",
    driver_memory: str = "20g",
) -> SparkSession:
    """Session with the settings the operators were tuned under.

    On a cluster leave ``master`` and ``shuffle_partitions`` unset: the submit
    command decides the master, and AQE coalesces the shuffle partitions.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master).config("spark.driver.memory", driver_memory)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder for written steps: the cluster's ``spark.checkpoint.dir``.

    Only a session inside one process (tests, benches) sets a folder of its own
    where none is set; on a cluster a machine-local folder would be lost together
    with its executor.
    """
    name = "spark.checkpoint.dir"
    shared = spark.conf.get(name, None) or spark.sparkContext.getConf().get(name, None)
    if not shared:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        shared = os.path.join(tempfile.gettempdir(), f"trialspark-steps-{spark.sparkContext.applicationId}")
    return shared


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from the written table.

    The table survives the loss of executors. Unlike an in-plan checkpoint it
    carries its real size, so small results are broadcast, and none of the
    constraints of the plan behind it, which pile up over the rounds of a loop.
    The shuffle files behind it are deleted as soon as it is written, so they and
    those of the next steps don't add up on disk.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/step-{uuid.uuid4().hex}"
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.step_path = path
    return out


def release(*steps: DataFrame) -> None:
    """Delete the files of steps made by :func:`cut_lineage` that nothing reads any more."""
    for step in steps:
        if path := getattr(step, "step_path", None):
            spark = step.sparkSession
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
