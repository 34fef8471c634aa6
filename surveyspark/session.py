"""Session settings the survey jobs are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # coalesce small shuffles, split skewed join partitions at run time
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The JVM does not compile methods above 8,000 bytes of bytecode. Many answer
    # columns in one projection exceed that and would run interpreted; with this
    # limit Spark splits them into small methods instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Keys and codes compress well, so 64 MB of shuffled rows fill a task's memory.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.session.timeZone": "UTC",
}


#: of these, what queries set in a session that was not built by ``configure``
OF_QUERIES = ("spark.sql.codegen.hugeMethodLimit", "spark.sql.adaptive.advisoryPartitionSizeInBytes")


def tune(spark: SparkSession) -> None:
    for key in OF_QUERIES:
        spark.conf.set(key, SETTINGS[key])


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder
