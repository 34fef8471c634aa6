"""Form submissions: one nested record per interview, flattened to linked tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_submissions(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Landed JSON export, one submission per line, with a declared schema."""
    return spark.read.schema(schema).json(path)


def main_table(submissions: DataFrame, groups: Sequence[str], key: str = "_id") -> DataFrame:
    """Interview-level answers, ``_index`` being the submission key."""
    return submissions.drop(*groups).withColumnRenamed(key, "_index")


def repeat_table(submissions: DataFrame, group: str, key: str = "_id") -> DataFrame:
    """One row per entry of a repeat group, linked to its submission.

    An entry's key has two columns: ``_parent_index``, the submission's key as it is,
    and ``member_no``, the position in the group. No key is computed, so none overflows.
    """
    entries = submissions.select(
        F.col(key).alias("_parent_index"), F.posexplode(group).alias("_pos", "_entry"))
    return entries.select("_parent_index", (F.col("_pos") + 1).alias("member_no"), "_entry.*")


def flatten(submissions: DataFrame, groups: Sequence[str], key: str = "_id") -> dict[str, DataFrame]:
    """All linked tables of a nested form."""
    tables = {"main": main_table(submissions, groups, key)}
    for group in groups:
        tables[group] = repeat_table(submissions, group, key)
    return tables
