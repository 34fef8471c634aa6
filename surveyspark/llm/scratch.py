"""Written tables that cut lineage, in the folder all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a temporary one on a local master without it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    return _LOCAL.setdefault(app, tempfile.mkdtemp(prefix="scratch-"))


class Scratch:
    """Tables written by one operator run; `drop` removes the ones no longer read."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        app = spark.sparkContext.applicationId
        self.root = f"{shared_folder(spark)}/{app}/{name}-{uuid.uuid4().hex[:12]}"

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        conf = self.spark._jsc.hadoopConfiguration()
        for name in names:
            path = hadoop.Path(f"{self.root}/{name}")
            path.getFileSystem(conf).delete(path, True)
