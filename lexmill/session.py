"""Session helpers: a tuned session for local use, the shared checkpoint folder, bounded Arrow batches."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benches; on a cluster the session is the caller's."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.variant.allowDuplicateKeys", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder: the one set already, or the one named in spark.checkpoint.dir. Where neither is, a session inside one process
    (tests) gets a temporary one; on a cluster, whose executors could not share it, that is an error."""
    sc = spark.sparkContext
    if (current := sc.getCheckpointDir()) is not None:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not named:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="lexmill-checkpoint-")
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise df once in the shared folder; a lost executor costs no recomputation and no failure."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def bounded_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes as well as rows, so that long texts cannot fill a Python worker. One bound for all operators, since the
    settings hold for the session and a plan runs with those of the moment."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16384")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "4m")


def spread(df: DataFrame) -> DataFrame:
    """df over all cores if it comes in fewer partitions than half of them, as a small table in one file does; else as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores // 2 else df
