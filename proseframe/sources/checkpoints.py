"""Checkpoints in a folder of training runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from proseframe.operators.training_log import latest_checkpoint

#: a run's folder, a checkpoint's in it, and a file anywhere below that
_CHECKPOINT = r"^(.*/([^/]+)/checkpoint-[^/]*)/.+$"


#: at most as many listing tasks for each core; Spark's own bound is a task for each of 10,000 folders
_TASKS_A_CORE = 4


def _files(spark: SparkSession, root: str) -> DataFrame:
    """The paths of all files below ``root``; a listing task takes many folders, as a task costs more than a folder does."""
    setting = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(min(int(before), _TASKS_A_CORE * spark.sparkContext.defaultParallelism)))
    try:  # folders are listed by load() itself
        return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path")
    finally:
        spark.conf.set(setting, before)


def _checkpoints(spark: SparkSession, root: str) -> DataFrame:
    """(run_id, path) of the checkpoint that each file lies in."""
    files = _files(spark, root)
    name = F.when(F.regexp_like("path", F.lit(_CHECKPOINT)), F.struct(F.regexp_extract("path", _CHECKPOINT, 2).alias("run_id"), F.regexp_extract("path", _CHECKPOINT, 1).alias("path")))
    return files.select(name.alias("c")).where(F.col("c").isNotNull()).select("c.*")


def checkpoint_manifest(spark: SparkSession, root: str) -> DataFrame:
    """(run_id, path) of the folders called checkpoint-... in the runs' folders under ``root``.

    A checkpoint holds a file that is not empty. Only names are read, which Spark lists with many tasks where there are many folders.
    """
    return _checkpoints(spark, root).distinct()


def latest_checkpoint_in(spark: SparkSession, root: str) -> DataFrame:
    """(run_id, path, step): each run's checkpoint of the highest step; a root without any is an error."""
    manifest = _checkpoints(spark, root)
    if manifest.isEmpty():
        raise ValueError(f"no checkpoints under {root!r}")
    return latest_checkpoint(manifest)
