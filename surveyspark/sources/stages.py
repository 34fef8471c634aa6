"""Stage boundaries: tables written in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession

_CHECKPOINT = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors see, as the session names it.

    Only a local session without the setting gets a folder of its own.
    """
    folder = spark.conf.get(_CHECKPOINT, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_CHECKPOINT} to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="surveyspark-")
    spark.conf.set(_CHECKPOINT, folder)
    return folder


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a table that several later steps read, and read it back.

    The plan behind it is cut: a lost executor costs a re-read, not a
    recomputation, and later steps prune columns and push filters into Parquet.
    All tables of a run share a folder named after the application, which
    ``drop_stages`` removes when the run is over.
    """
    spark = df.sparkSession
    path = f"{_run_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_counted(df: DataFrame, name: str, measures: Mapping[str, Column]) -> tuple[DataFrame, dict[str, int]]:
    """``stage``, and aggregates of the rows taken while they are written, without a job of their own."""
    seen = Observation(f"{name}-{uuid.uuid4().hex}")
    written = stage(df.observe(seen, *[c.alias(n) for n, c in measures.items()]), name)
    return written, {n: seen.get[n] or 0 for n in measures}


def _run_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/surveyspark/{spark.sparkContext.applicationId}"


def drop_stages(spark: SparkSession) -> None:
    """Remove all tables that this run has staged; DataFrames over them cannot be read any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_run_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
